"""Held-out accuracy, rejection, and n-gram counts against a plain count."""

from collections import Counter

import numpy as np

from tillstream.llm import language_id as li
from tillstream.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def test_counts_are_of_the_whole_text(monkeypatch):
    text = "Ab, c!\n É9é " * 50
    want = li.counts(text)
    monkeypatch.setattr(li, "_CHUNK", 7)
    assert (li.counts(text) == want).all()
    letters = " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())
    grams = Counter(f" {letters} "[i:i + n] for n in (1, 2, 3) for i in range(len(letters) + 3 - n))
    assert want.sum() == sum(grams.values())
    assert li.counts("") is None and li.counts(None) is None and li.counts("12 + 3 !") is None and li.counts("é").sum() > 0


def test_cluster_finds_separate_groups():
    rng = np.random.default_rng(0)
    x = np.concatenate([np.eye(30)[j] + rng.normal(0, 0.02, (20, 30)) for j in (3, 9, 20)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    centres, likeness = li.cluster(x, 3)
    assert sorted(centres.argmax(1)) == [3, 9, 20] and likeness.min() > 0.9
    assert len(li.cluster(x[:2], 3)[0]) == 2


def test_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = QUERIES["op7_language_id"](spark, FOLDER).toPandas().merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    assert len(got) == docs.count() and got["score"].between(0, 1).all()
    held = got[got["held_out"]]
    assert 150 < len(held) < 350 and (held["lang_pred"] == held["lang"]).mean() > 0.97
    assert set(got["lang_pred"]) <= {*got["lang"], "und"} and (got["lang_pred"] == "und").mean() < 0.005


def test_odd_rows(spark):
    base = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang")
    rows = [(5001, None, "en"), (5002, "", None), (5003, "123 !?", "en"), (None, "The of and that", "en"),
            (5004, "漢字" * 300 + " 日本", None), (5004, "漢字" * 300 + " 日本", None)]
    odd = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    docs = base.union(odd).selectExpr("*", "'x' AS score", "1 AS _p")
    model = li.fit_documents(docs)
    got = sorted((r.doc_id or 0, r.lang_pred) for r in li.identify(docs, model).filter("doc_id > 5000 OR doc_id IS NULL").collect())
    assert got == [(0, "en"), (5001, "und"), (5002, "und"), (5003, "und"), (5004, "und"), (5004, "und")]
    kept = li.keep_identified(docs, model)
    assert kept.columns == docs.columns and kept.count() >= base.count() - 5
    empty = docs.limit(0)
    assert li.identify(empty).count() == 0 and li.keep_identified(empty).count() == 0
    assert li.identify(odd).filter("lang_pred <> 'und' AND lang_pred <> 'en'").count() == 0


def test_copies_take_no_places(spark):
    base = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang")
    model = li.fit_documents(base)
    texts = base.filter("lang = 'en'").orderBy("doc_id").limit(3)
    copies = texts.crossJoin(spark.range(700)).selectExpr("100000 + 1000 * doc_id + id AS doc_id", "text", "lang")
    copied = li.fit_documents(base.union(copies))
    held = base.filter(li.is_held_out(base.doc_id)).collect()
    assert len(copied.languages) == len(model.languages)
    hits = [copied.predict(r.text)[0] == r.lang for r in held if r.lang == "en"]
    assert len(hits) > 20 and sum(hits) / len(hits) > 0.95


def test_very_long_texts_go_as_vectors(spark):
    long = [(i, f"word{i} and the " * 200_000, "en") for i in range(8)]
    docs = spark.createDataFrame([*long, *((100 + i, f"le mot {i} et la", "fr") for i in range(8))], "doc_id bigint, text string, lang string")
    got = li.identify(docs).collect()
    assert all(r.lang_pred == ("en" if r.doc_id < 100 else "fr") for r in got) and len(got) == 16


def test_the_model_is_the_same_however_rows_are_dealt(spark):
    base = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one, two = (li.fit_documents(docs) for docs in (base, base.repartition(7, "text")))
    assert one.languages == two.languages and (one.idf == two.idf).all() and np.allclose(one.centroids, two.centroids)
