"""Signatures, neighbours and likeness against plain Python."""

import hashlib
import itertools
import random
import re

from pyspark.sql import functions as F

from tillstream.llm import spotsigs as ss
from tillstream.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def chains(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    out = set()
    for i, w in enumerate(words):
        if w in ss.ANCHORS:
            out.add((w, *[x for x in words[i + 1:] if x not in ss.ANCHORS][:ss.CHAIN]))
    return out or {("", *words[i:i + ss.CHAIN]) for i in range(len(words))}


def jaccard(a, b):
    return 1.0 if not a | b else len(a & b) / len(a | b)


def test_query(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect())
    got = {r.doc_id: r for r in QUERIES["op4_spotsigs"](spark, FOLDER).collect()}
    assert len(got) == len(docs)
    prints = {}
    for (i, text), (_, after) in zip(docs, docs[1:] + docs[:1]):
        n = len(text)
        edit = text[:n - n // 4] + after[:n // 4]
        r = got[i]
        assert r.n_chars == n and r.edited_sha256 == hashlib.sha256(edit.encode()).hexdigest()
        assert abs(r.near_edited - jaccard(chains(text), chains(edit))) < 1e-12
        assert abs(r.near_next - jaccard(chains(text), chains(after))) < 1e-12
        assert prints.setdefault(frozenset(chains(text)), r.fingerprint) == r.fingerprint
        assert len(r.fingerprint) == 16 * len(chains(text))
    long = [r for i, r in got.items() if r.n_chars > 500]
    assert sum(r.near_edited for r in long) / len(long) > 0.5 > 0.2 > sum(r.near_next for r in long) / len(long)


def test_next_over_ranges(spark):
    rng = random.Random(0)
    ids = rng.sample(range(-5000, 10**12), 700)
    docs = spark.createDataFrame([(i, str(i), "x") for i in ids], "doc_id bigint, text string, next_text string").repartition(5)
    ordered = sorted(ids)
    want = {a: str(b) for a, b in zip(ordered, ordered[1:] + ordered[:1])}
    for n in (1, 7, 200):
        assert {r.doc_id: r.next_text for r in ss.with_next(docs, ranges=n).collect()} == want


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "..!"), (4, "une é"), (4, "une é"), (None, "The end of it"), (5, "a " * 30_000)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id bigint, text string, signs int")
    got = ss.fingerprint_table(docs).collect()
    assert len(got) == 7 and [len(r.signs) for r in sorted(got, key=lambda r: r.n_chars)][:3] == [0, 0, 0]
    assert ss.fingerprint_table(docs.limit(0)).count() == 0
    one = ss.fingerprint_table(docs.filter("doc_id = 5")).first()
    assert one.signs == one.next_signs and len(one.signs) == 1


def test_similar_pairs_against_all(spark):
    rng = random.Random(4)
    sets = [sorted(rng.sample(range(60), rng.randint(1, 25))) for _ in range(60)]
    for s in list(sets):
        t = set(s)
        t ^= set(rng.sample(range(60), rng.randint(0, 3)))
        sets.append(sorted(t))
    rows = list(enumerate(sets))
    classes = {}
    for i, s in rows:
        classes.setdefault(tuple(s), i)
    want = sorted(
        (*sorted((i, j)), round(jaccard(set(a), set(b)), 9)) for (a, i), (b, j) in itertools.combinations(classes.items(), 2)
        if a and b and jaccard(set(a), set(b)) >= 0.8
    )
    df = spark.createDataFrame(rows, "doc_id bigint, signs array<bigint>")
    got = sorted((r.a, r.b, round(r.likeness, 9)) for r in ss.similar_pairs(df).collect())
    assert got == want and len(want) > 10


def test_every_link_of_every_document(spark):
    rng = random.Random(8)
    sets = [sorted(rng.sample(range(40), rng.randint(5, 20))) for _ in range(25)]
    sets += [sorted({*s, 50 + i}) for i, s in enumerate(sets[:12])]  # near
    sets += [s for s in sets for _ in range(rng.randint(0, 4))]  # copies
    sets += [[], []]
    rows = list(enumerate(sets))
    want = {
        i: (min(j for j, t in rows if t == s), sum(j != i and jaccard(set(s), set(t)) >= 0.8 for j, t in rows)) for i, s in rows
    }
    df = spark.createDataFrame([*rows, (None, sets[0])], "doc_id bigint, signs array<bigint>")
    got = {r.doc_id: (r.class_id, r.n_links) for r in ss.similar_documents(df).collect()}
    assert got == want and len({c for c, _ in want.values()}) < len(rows) - 20
    assert ss.similar_documents(df.limit(0)).count() == 0


def test_five_equal_texts_are_one_class(spark):
    docs = spark.createDataFrame([(i, "The cat and the dog are in a house") for i in range(5)], "doc_id bigint, text string")
    signed = docs.select("doc_id", ss.signatures(F.col("text")).alias("signs"))
    assert {tuple(r) for r in ss.similar_documents(signed).collect()} == {(i, 0, 4) for i in range(5)}


def test_chains_reach_over_any_number_of_anchors(spark):
    text = "the " + "of a " * 40 + "far word"
    docs = spark.createDataFrame([(1, text), (2, "the far word"), (3, "word and"), (4, "no such words")], "doc_id bigint, text string")
    got = {r.doc_id: set(r.signs) for r in docs.select("doc_id", ss.signatures(F.col("text")).alias("signs")).collect()}
    assert len(got[1]) == len(chains(text)) == 3 and got[2] <= got[1]
    assert len(got[3]) == 1 and len(got[4]) == 3
