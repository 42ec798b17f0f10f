"""SimHash groups against brute force, planted links and odd rows."""

import itertools
import random

import pytest
import xxhash

from tillstream.llm.simhash import covering_masks, fingerprint, keep_one, links, simhash_groups
from tillstream.llm.graph import components

M = (1 << 64) - 1


def plain(text):
    """Bit by bit, from the words of the contract."""
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(ids, pairs):
    at = {i: i for i in ids}
    def find(i):
        while at[i] != i:
            i = at[i]
        return i
    for a, b in pairs:
        x, y = find(a), find(b)
        at[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("text", ["", None, "One", "two WORDS", "a b c", "É b\x0bC  d e f a b c a b c", "x " * 40_000])
def test_fingerprint(text):
    assert fingerprint(text) & M == plain(text)


def test_covering_masks_never_miss():
    masks = covering_masks(3)
    assert len(masks) == 15
    for bits in itertools.chain(itertools.combinations(range(64), 3), itertools.combinations(range(64), 1)):
        assert any(all(not m >> b & 1 for b in bits) for m in masks), bits


@pytest.mark.parametrize("pairwise", [256, 1])
def test_links_connect_what_brute_force_connects(spark, pairwise):
    rng = random.Random(5)
    seeds = [rng.getrandbits(64) for _ in range(30)]
    fps = {0, M, *seeds}
    for s in seeds:
        for _ in range(12):
            for b in rng.sample(range(64), rng.randint(1, 5)):
                s ^= 1 << b
            fps.add(s)
    signed = {x - (1 << 64) if x >> 63 else x for x in fps}
    true = [(a, b) for a, b in itertools.combinations(signed, 2) if ((a ^ b) & M).bit_count() <= 3]
    found = links(spark.createDataFrame([(x,) for x in signed], "fp bigint"), 3, pairwise).collect()
    assert all(((a ^ b) & M).bit_count() <= 3 for a, b in found)
    assert roots(signed, found) == roots(signed, true)
    assert len(true) > 50


def test_components(spark):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(300)]
    pairs += [(7, x) for x in range(2000, 2300)] + [(-5, -5), (3, 3)]
    ids = {x for p in pairs if p[0] != p[1] for x in p}
    got = {r.id: r.component for r in components(spark.createDataFrame(pairs, "u bigint, v bigint")).collect()}
    assert got == roots(ids, pairs[:-2])
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_groups_of_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    fps = {r.doc_id: plain(r.text) for r in docs.collect()}
    pairs = [(a, b) for a, b in itertools.combinations(fps, 2) if (fps[a] ^ fps[b]).bit_count() <= 3]
    want = roots(fps, pairs)
    got = {r.doc_id: (r.fp & M, r.component_id) for r in simhash_groups(docs).collect()}
    assert got == {i: (fps[i], want[i]) for i in fps}
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(want.values())


def test_odd_rows(spark):
    rows = [(1, None, "c"), (2, "", "c"), (3, "one two three four", None), (3, "one two three four", None),
            (None, "one two three four", "c"), (9, "other words are here", "c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fp string")
    got = sorted(((r.doc_id, r.component_id) for r in simhash_groups(docs).collect()), key=repr)
    assert got == sorted([(1, 1), (2, 1), (3, 3), (3, 3), (None, 3), (9, 9)], key=repr)
    assert keep_one(docs).count() == 5
    assert simhash_groups(docs.limit(0)).count() == 0 and keep_one(docs.limit(0)).count() == 0
