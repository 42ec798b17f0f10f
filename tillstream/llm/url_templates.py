"""URL verdicts by rules, else by the labelled purity of path templates, a tree of which is made for each host."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, functions as F

from tillstream.llm.tables import join_checked, stored

# (host, path, verdict): fits the host and its subdomains where the path starts so.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
LEVELS = 6  # `segments` alone: deeper segments are one segment of the last level
MIN_KIDS = 20  # a node with so many light children, seen fewer than MIN_SEEN times each, is variable
MIN_SEEN = 5
Z = 1.96  # branches whose bad shares differ by fewer standard errors are alike
PRIOR = 5.0  # labels that a smoothed share counts for its parent's share
REJECT = 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.char_length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), ascii_uppercase, ascii_lowercase)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null where none does. `rules` is a short list."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        text = F.when(fits, rule_host + rule_path).otherwise(text)
        verdict = F.when(fits, says).otherwise(verdict)
    return text, verdict


def segments(path: Column, levels: int | None = LEVELS) -> Column:
    """Segments without empty ones, each run of digits being `{n}` and each long run of hex digits `{x}`; without `levels`,
    all. A star is written `%2A`, so that no segment has the name of a wildcard."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    parts = F.transform(parts, lambda s: F.regexp_replace(
        F.regexp_replace(s, r"(?i)\b(?=[a-f]*[0-9])[0-9a-f]{8,}\b", "{x}"), r"[0-9]+", "{n}"
    ))
    parts = F.transform(parts, lambda s: F.replace(s, F.lit("*"), F.lit("%2A")))
    if levels is None:
        return parts
    deep = F.array_join(F.slice(parts, levels, F.greatest(F.size(parts), F.lit(1))), "/")
    return F.when(F.size(parts) > levels, F.concat(F.slice(parts, 1, levels - 1), F.array(deep))).otherwise(parts)


def _smoothed(bad: str, labelled: str, share: Column) -> Column:
    return (F.col(bad) + PRIOR * share) / (F.col(labelled) + PRIOR)


def _below(template: str, chain: Column) -> Column:
    return F.concat(template, F.when(F.size(chain) > 0, F.concat(F.lit("/"), F.array_join(chain, "/"))).otherwise(""))


def templates(paths: DataFrame) -> DataFrame:
    """`host, segs, template` of distinct paths (`host, segs, n, labelled, bad`: pages, labelled and bad ones).

    From each host down, each child is judged by itself. The light children of a variable node become `*`. Of the
    others, those whose smoothed bad share is within Z standard errors of all siblings' together are alike and merge
    into one `*`; a branch that differs stays apart and has a subtree of its own. Segments that all paths of a node go
    on with are passed in one step, a rest that all of them share is taken as it is: there is a round for each branching
    on the way down, not for each segment. Counts combine map-side, and hosts share no task by design: the keys hold the
    segment. Each round is written, so that the plan does not double with depth.
    """
    tree, ended = paths.withColumns({"template": F.lit(""), "at": F.lit(0)}), None
    columns = [*paths.columns, "template", "at"]
    while True:
        rest = F.slice("segs", F.col("at") + 1, F.size("segs"))
        differ = F.zip_with(F.min(rest), F.max(rest), lambda low, high: ~low.eqNullSafe(high))
        ahead = tree.groupBy("host", "template").agg(F.array_position(differ, True).cast("int").alias("branch"))
        marked = stored(join_checked(tree, stored(ahead, "ahead"), ["host", "template"]), "marked")
        done = marked.filter("branch = 0").withColumn("template", _below("template", rest)).select(*paths.columns, "template")
        ended = done if ended is None else ended.union(done)
        here = marked.filter("branch > 0").withColumn("template", _below("template", F.slice("segs", F.col("at") + 1, F.col("branch") - 1)))
        here = here.withColumn("at", F.col("at") + F.col("branch")).withColumn("seg", F.get("segs", F.col("at") - 1)).drop("branch")
        if here.isEmpty():
            return stored(ended, "tree")
        nodes = here.filter("seg IS NOT NULL").groupBy("host", "template", "seg").agg(
            *[F.sum(c).alias(c) for c in ("n", "labelled", "bad")]
        )
        nodes = stored(nodes, "nodes")
        light = F.col("n") < MIN_SEEN
        parents = nodes.groupBy("host", "template").agg(
            F.count(F.lit(1)).alias("kids"), F.count_if(light).alias("light_kids"),
            *[F.sum(c).alias(f"all_{c}") for c in ("labelled", "bad")]
        )
        joined = join_checked(nodes, stored(parents, "parents"), ["host", "template"])
        share = (F.col("all_bad") + 1) / (F.col("all_labelled") + 2)
        error = F.sqrt(share * (1 - share) / (F.col("labelled") + PRIOR))
        off = _smoothed("bad", "labelled", share) - share
        step = F.when((F.col("light_kids") >= MIN_KIDS) & light, "*").when(F.col("kids") == 1, F.col("seg"))
        step = step.when(off < -Z * error, "*-").when(off <= Z * error, "*").otherwise(F.col("seg"))
        merged = joined.select("host", "template", "seg", step.alias("step"))
        tree = join_checked(here, stored(merged, "steps"), ["host", "template", "seg"], "left")
        tree = tree.withColumn("template", F.concat("template", F.coalesce(F.concat(F.lit("/"), "step"), F.lit(""))))
        tree = stored(tree.select(*columns), "tree")


def judge(
    pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]] = RULES, reject: float = REJECT,
    id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """`<id>, host, path, rule, verdict, template, bad_share` for each page.

    `labels` holds `<id>, bad` (boolean) of some pages; of repeated labels a bad one counts. A rule decides first.
    Otherwise a page is blocked if the bad share of its template, smoothed towards its host's and that towards all
    labels', is over `reject`; without any labels nothing is. Null urls, and urls without `://`, have an empty host and
    path and the template of these. Repeated pages count each and get equal answers.
    """
    host, path = host_and_path(F.col(url_col).cast("string"))
    rows = pages.select(F.col(id_col).cast("bigint").alias("_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("segs", segments(F.col("path"), None))
    known = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("bigint").alias("_id")).agg(F.max("bad").alias("_bad"))
    paths = rows.join(known, "_id", "left").groupBy("host", "segs").agg(
        F.count(F.lit(1)).alias("n"), F.count("_bad").alias("labelled"), F.count_if("_bad").alias("bad")
    )
    paths = stored(paths, "paths")
    tree = templates(paths)
    total = paths.agg(F.sum("labelled"), F.sum("bad")).first()
    overall = F.lit(((total[1] or 0) + 1) / ((total[0] or 0) + 2)) if total[0] else F.lit(0.0)
    counts = ["labelled", "bad"]
    by_host = tree.groupBy("host").agg(*[F.sum(c).alias(f"host_{c}") for c in counts])
    shares = tree.groupBy("host", "template").agg(*[F.sum(c).alias(c) for c in counts]).join(by_host, "host")
    share = _smoothed("bad", "labelled", _smoothed("host_bad", "host_labelled", overall))
    shares = shares.select("host", "template", share.alias("bad_share"))
    decided = stored(tree.select("host", "segs", "template").join(shares, ["host", "template"]), "templates")
    found = join_checked(rows, decided, ["host", "segs"])
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    verdict = F.coalesce(says, F.when(F.col("bad_share") > reject, "block").otherwise("allow"))
    return found.select(
        F.col("_id").alias(id_col), "host", "path", rule.alias("rule"), verdict.alias("verdict"), "template", "bad_share"
    )


def document_labels(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """`page_id, bad` from document labels: a page's address names the document that it shows by the first number in
    its path. Low quality or toxic is bad."""
    _, path = host_and_path(F.col("url"))
    number = F.expr("try_cast(_n AS bigint)")
    shown = pages.select("page_id", F.regexp_extract(path, "/([0-9]+)", 1).alias("_n")).select("page_id", number.alias("_doc"))
    bad = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_doc")).agg(F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return shown.join(bad, "_doc").select("page_id", "bad")
