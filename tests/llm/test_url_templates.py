"""Hosts, rules and templates by plain Python, purity on a small tree."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillstream.llm import url_templates as ut
from tillstream.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path):
    fits = [r for r in ut.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return (best[0] + best[1], best[2]) if best else (None, None)


def test_query(spark):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    got = QUERIES["op6_url_templates"](spark, FOLDER).collect()
    assert len(got) == len(urls)
    for r in got:
        assert (r.host, r.path) == plain(urls[r.page_id])
        rule, says = plain_rule(r.host, r.path)
        assert r.rule == rule and r.verdict in ("allow", "block") and (says is None or r.verdict == says)


def test_odd_urls(spark):
    urls = [None, "", "no scheme", "http://", "://A.Net/x", "http://NET/en/1", "http://x.example.net/en/1", "http://x.example.net/en",
            "http://y.org#a/b?c", "http://É.org/fr/?q", "a://b://c/d", "http://notnet/", "http://x.net?y/z", "http://h/" + "a/" * 5000]
    pages = spark.createDataFrame([(i, u, "n", "t") for i, u in enumerate(urls + urls[:2])], "page_id bigint, url string, n string, template string")
    labels = spark.createDataFrame([(4, True), (4, False), (99, True), (None, True)], "page_id bigint, bad boolean")
    got = {r.page_id: r for r in ut.judge(pages, labels).collect()}
    assert len(got) == len(urls) + 2
    for i, u in enumerate(urls):
        assert (got[i].host, got[i].path) == plain(u) and got[i].rule == plain_rule(*plain(u))[0]
    none = labels.limit(0)
    assert {r.verdict for r in ut.judge(pages, none).filter("rule IS NULL").collect()} == {"allow"}
    assert ut.judge(pages.limit(0), labels).count() == 0


def test_bad_branch_stays_apart_and_is_blocked(spark):
    rows, bad = [], []
    for i in range(600):
        branch = ["casino", "news", "blog"][i % 3]
        rows.append((i, f"http://h.com/{branch}/{'slug' if i % 2 else 'p'}{chr(97 + i % 26)}{chr(97 + i // 26)}/{i}.html"))
        bad.append((i, branch == "casino"))
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    labels = spark.createDataFrame(bad[::2], "page_id bigint, bad boolean")
    got = ut.judge(pages, labels)
    table = {(r.template, r.verdict) for r in got.collect()}
    assert table == {("/casino/*/{n}.html", "block"), ("/*-/*/{n}.html", "allow")}, table


@pytest.mark.parametrize("path,want", [
    ("/en/25/", ["en", "{n}"]), ("//a//b2.html", ["a", "b{n}.html"]), ("", []), ("/deadbeef01/feedback", ["{x}", "feedback"]),
    ("/1/2/3/4/5/6/7/8", ["{n}"] * 5 + ["{n}/{n}/{n}"]),
])
def test_segments(spark, path, want):
    assert spark.range(1).select(ut.segments(F.lit(path)).alias("s")).first().s == want


def _judged(spark, groups):
    """Verdicts by path of pages and labels from (path, pages, bad)."""
    rows = [(path, bad) for path, n, bad in groups for _ in range(n)]
    pages = spark.createDataFrame([(i, f"http://h.com{path}") for i, (path, _) in enumerate(rows)], "page_id bigint, url string")
    labels = spark.createDataFrame([(i, bad) for i, (_, bad) in enumerate(rows)], "page_id bigint, bad boolean")
    got = ut.judge(pages, labels).select("path", "verdict").distinct().collect()
    assert len(got) == len({path for path, _ in rows})
    return {r.path: r.verdict for r in got}


@pytest.mark.parametrize("light,heavy", [(3, 1900), (1, 4000)])
def test_heavy_branch_among_light_siblings(spark, light, heavy):
    names = [f"/{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}/p" for i in range(999)]
    got = _judged(spark, [(name, light, False) for name in names] + [("/casino/p", heavy, True)])
    assert got.pop("/casino/p") == "block" and set(got.values()) == {"allow"}


def test_branches_below_the_sixth_level(spark):
    top = "/a/b/c/d/e/f"
    groups = [(f"{top}/good/{chr(97 + i)}", 4, False) for i in range(26)] + [(f"{top}/bad/{chr(97 + i)}", 4, True) for i in range(26)]
    got = _judged(spark, groups + [(f"{top}/bad/zz", 1, False)])
    assert got[f"{top}/good/c"] == "allow" and got[f"{top}/bad/c"] == got[f"{top}/bad/zz"] == "block"


def plain_templates(paths):
    """Templates by recursion, segment by segment; `paths`: {segments: (n, labelled, bad)}."""
    out = {}

    def smoothed(bad, labelled, share):
        return (bad + ut.PRIOR * share) / (labelled + ut.PRIOR)

    def down(group, at, template):
        for segs in group:
            if len(segs) == at:
                out[segs] = template
        kids = {}
        for segs in group:
            if len(segs) > at:
                kids.setdefault(segs[at], []).append(segs)
        total = {k: [sum(paths[s][i] for s in v) for i in range(3)] for k, v in kids.items()}
        light = {k for k, t in total.items() if t[0] < ut.MIN_SEEN}
        share = (sum(t[2] for t in total.values()) + 1) / (sum(t[1] for t in total.values()) + 2)
        steps = {}
        for k, (_, labelled, bad) in total.items():
            error = ut.Z * (share * (1 - share) / (labelled + ut.PRIOR)) ** 0.5
            off = smoothed(bad, labelled, share) - share
            if len(light) >= ut.MIN_KIDS and k in light:
                step = "*"
            elif len(kids) == 1:
                step = k
            else:
                step = "*-" if off < -error else "*" if off <= error else k
            steps.setdefault(step, []).extend(kids[k])
        for step, below in steps.items():
            rests = {s[at + 1:] for s in below}
            if len(rests) == 1:  # taken as it is
                out.update({s: "/".join([f"{template}/{step}", *s[at + 1:]]) for s in below})
            else:
                down(below, at + 1, f"{template}/{step}")

    down(list(paths), 0, "")
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_templates_are_those_of_a_plain_recursion(spark, seed):
    rng = np.random.default_rng(seed)
    paths = {}
    for _ in range(700):
        segs = [str(rng.choice(["a", "b", "*", "%2A"])) for _ in range(rng.integers(0, 4))] + ["x", "y"][: rng.integers(0, 3)]
        segs += [f"s{chr(97 + int(k))}" for k in rng.integers(0, 25, rng.integers(0, 3))]
        labelled = int(rng.integers(0, 9))
        paths[tuple(segs)] = (int(rng.integers(1, 12)), labelled, int(rng.binomial(labelled, 0.9 if "b" in segs[:1] else 0.1)))
    rows = [(h, list(s), *c) for s, c in paths.items() for h in ("h", "other")]
    df = spark.createDataFrame(rows, "host string, segs array<string>, n bigint, labelled bigint, bad bigint")
    got = ut.templates(df).collect()
    want = plain_templates(paths)
    assert len(got) == 2 * len(want) and all(r.template == want[tuple(r.segs)] for r in got)


def test_rounds_follow_branchings_not_depth(spark, monkeypatch):
    made = []
    stored = ut.stored
    monkeypatch.setattr(ut, "stored", lambda df, label: made.append(label) or stored(df, label))
    deep = "/" + "/".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    got = _judged(spark, [(f"{deep}/one/{deep[1:]}/good", 40, False), (f"{deep}/one/{deep[1:]}/bad", 40, True)])
    assert made.count("nodes") == 1
    assert got[f"{deep}/one/{deep[1:]}/good"] == "allow" and got[f"{deep}/one/{deep[1:]}/bad"] == "block"


def test_a_literal_star_is_no_wildcard(spark):
    groups = [(f"/{chr(97 + i)}/p", 40, False) for i in range(12)] + [("/*/p", 40, True)]
    got = _judged(spark, groups)
    assert got.pop("/*/p") == "block" and set(got.values()) == {"allow"}
