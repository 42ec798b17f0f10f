"""Lines against a comparison of all pairs, and keys against their promise."""

import random

import pytest
from pyspark.sql import functions as F

from tillstream.llm import line_dedup as ld


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[k + 1:] == b[k + 1:] or a[k:] == b[k + 1:] or a[k + 1:] == b[k:]


def brute(rows, near_chars):
    lines = [(i, n, l) for i, t in rows if t is not None and i is not None for n, l in enumerate(t.split("\n"))
             if l.strip()]
    out = []
    for i, t in rows:
        kept = []
        for n, l in enumerate((t or "").split("\n")):
            gone = i is not None and l.strip() and any(
                (j, m) < (i, n) and (k == l or len(k) >= near_chars and len(l) >= near_chars and within_one(k, l))
                for j, m, k in lines
            )
            if not gone:
                kept.append(l)
        out.append((i, None if t is None else "\n".join(kept)))
    return sorted(out, key=repr)


def mutated(rng, line):
    k = rng.randrange(len(line) + 1)
    c = rng.choice("abé漢")
    return rng.choice([line[:k] + c + line[k:], line[:k] + line[k + 1:], line[:k] + c + line[k + 1:], line])


@pytest.mark.parametrize("near_chars", [ld.NEAR_CHARS, 1, 20])
def test_against_all_pairs(spark, near_chars):
    rng = random.Random(near_chars)
    pool = ["".join(rng.choice("abé ") for _ in range(rng.choice([2, 3, 5, 9, 10, 19, 20, 21, 31, 32, 33, 63, 64, 65, 100]))) for _ in range(40)]
    for _ in range(120):
        pool.append(mutated(rng, rng.choice(pool)))
    rows = [(i * 13 % 97, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 9)))) for i in range(60)]
    rows += [(5, None), (6, ""), (None, rows[0][1]), (200, rows[1][1]), (200, rows[1][1]), (201, "\n\n" + rows[2][1] + "\n")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, no string")
    got = ld.dedup_lines(docs, near_chars=near_chars)
    assert got.columns == ["doc_id", "text", "no", "_n_lines", "_n_removed"]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == brute(rows, near_chars)


def test_deletion_keys_meet_exactly_at_one_edit(spark):
    rng = random.Random(3)
    rows = []
    for n in [1, 2, 30, 31, 32, 33, 64, 65, 66]:
        for _ in range(12):
            a = "".join(rng.choice("aé") for _ in range(n))
            b = mutated(rng, mutated(rng, a)) if rng.random() < 0.5 else mutated(rng, a)
            rows.append((a, b))
    df = spark.createDataFrame(rows, "a string, b string").filter("b <> '' AND a <> b")
    got = df.select(
        "a", "b", F.arrays_overlap(ld.deletion_keys(F.col("a"))["k"], ld.deletion_keys(F.col("b"))["k"]).alias("meet"),
        F.arrays_overlap(ld.half_keys(F.col("a")), ld.half_keys(F.col("b"))).alias("half"),
    ).collect()
    assert len(got) > 60 and {r.meet for r in got} == {True, False}
    for r in got:
        assert r.meet == within_one(r.a, r.b) and (r.half or not r.meet), r


def test_a_large_group_of_near_copies(spark):
    """Lines that differ in one place from each other, and short lines, at the settings of the query."""
    rng = random.Random(9)
    base = "".join(rng.choice("abcdefgh ") for _ in range(150))
    rows = [(k, base[:70] + chr(0x4E00 + k) + base[71:]) for k in range(300)] + [(900, "Hi there\nLes.\n\nA\nbcd"), (901, "Hi there\nDes.\n\nB\nbd")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in ld.dedup_lines(docs).collect()}
    assert got[0] == rows[0][1] and all(got[k] == "" for k in range(1, 300))
    assert got[900] == "Hi there\nLes.\n\nA\nbcd" and got[901] == "\nB"


def test_long_lines_and_no_rows(spark):
    line = "".join(random.Random(1).choice("abcdefg") for _ in range(50_000))
    rows = [(1, line), (2, line[:40_000] + line[40_001:]), (3, line[:70] + "Z" + line[71:]), (4, line[5:])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.doc_id: r._n_removed for r in ld.dedup_lines(docs).collect()} == {1: 0, 2: 1, 3: 1, 4: 0}
    many = spark.createDataFrame([(1, "\n".join(f"line number {i % 500:06d}" for i in range(1000)))], "doc_id bigint, text string")
    row = ld.dedup_lines(many, near_chars=100).first()
    assert row._n_removed == 500 and row.text.count("\n") == 499
    assert ld.dedup_lines(docs.limit(0)).count() == 0
