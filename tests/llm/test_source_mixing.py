"""Raked shares, exact in expectation, and sampling that follows them."""

import numpy as np
import pytest

from tillstream.llm import source_mixing as sm
from tillstream.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def test_rake():
    rng = np.random.default_rng(0)
    codes = np.array([[s, l, t] for s in range(4) for l in range(3) for t in range(2)]).T
    tokens = rng.integers(1, 1000, codes.shape[1]).astype(float)
    targets = [np.array([1, 2, 3, 4.0]), np.array([1, 1, 1.0]), np.array([9, 1.0])]
    w = sm.rake(tokens, codes, targets)
    for code, target in zip(codes, targets):
        got = np.bincount(code, w * tokens)
        assert np.allclose(got / got.sum(), target / target.sum(), atol=1e-9)
    factors = np.log(w).reshape(4, 3, 2)  # a product of one factor for each dimension
    assert np.allclose(factors[0] - factors[1], (factors[0] - factors[1])[0, 0])
    assert np.allclose(sm.rake(tokens, codes, [np.bincount(c, tokens) for c in codes]), 1)


def test_query_has_the_raked_shares(spark):
    got = QUERIES["op10_source_mixing"](spark, FOLDER).toPandas()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").toPandas()
    assert len(got) == len(docs) and (got.set_index("doc_id")["n_tokens"] == docs.set_index("doc_id")["text"].map(
        lambda t: len(t.encode().split()))).all()
    assert (got["topic"] == got.merge(docs, on="doc_id")["text"].map(lambda t: sm.lexical_topic(t)[0])).all()
    for d in ("source", "lang", "topic"):
        before = got.groupby(d)["n_tokens"].sum() ** sm.FLATTEN
        expected = (got["n_tokens"] * got["probability"]).groupby(got[d]).sum()
        assert np.allclose(expected / expected.sum(), before / before.sum(), atol=1e-9)
    assert 0 < got["probability"].min() and got["probability"].max() == 1
    share = got["kept"].mean()
    assert abs(share - got["probability"].mean()) < 4 * (got["probability"].mean() / len(got)) ** 0.5


def test_targets_and_odd_rows(spark):
    rows = [(i, "word " * (1 + i % 7), "ab"[i % 5 == 0], "en" if i % 2 else None, "x") for i in range(2000)]
    rows += [(5000, None, "a", "en", "x"), (5001, "", None, None, None), (None, "some words", "b", "en", "x"), (1, "word word", "b", "en", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string, topic string")
    out = sm.mixed(docs, {"source": {"a": 3, "b": 1, "gone": 9}}, topic_col="topic").toPandas()
    assert len(out) == len(rows)
    expected = (out["_tokens"] * out["_probability"]).groupby(out["source"]).sum()
    assert abs(expected["a"] / expected["b"] - 3) < 1e-6
    kept = sm.sample(docs, targets={"source": {"a": 3, "b": 1}}, topic_col="topic")
    assert kept.columns == docs.columns and kept.count() == int(sm.mixed(docs, {"source": {"a": 3, "b": 1}}, topic_col="topic").filter("_kept").count())
    assert sm.mixed(docs.filter("doc_id = 5001")).first()._probability == 1.0
    assert sm.mixed(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        sm.mixed(docs, {"source": {"gone": 1}})


def _rare(spark):
    rows = [(i, "word " * (1 + i % 7), "abc"[i % 3], ["en", "fr"][i % 5 == 0], "x") for i in range(10_000)]
    rows += [(20_000 + i, "word " * 4, "rare", "en", "x") for i in range(3)] + [(30_000 + i, "word " * 4, "a", "xx", "x") for i in range(3)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string, topic string")


def test_rare_categories_do_not_set_the_yield(spark):
    docs = _rare(spark)
    for keep in (None, 0.7):
        out = sm.mixed(docs, topic_col="topic", keep=keep).toPandas()
        expected = out["_tokens"] * out["_probability"]
        assert abs(expected.sum() / out["_tokens"].sum() - (keep or sm.LEAST_KEPT)) < 1e-9
        assert out["_probability"].between(0, 1).all() and (out.loc[out["source"] == "rare", "_probability"] == 1).all()
        assert abs(out.loc[out["_kept"], "_tokens"].sum() / out["_tokens"].sum() - (keep or sm.LEAST_KEPT)) < 0.03
        for d in ("source", "lang"):
            target = out.groupby(d)["_tokens"].sum() ** sm.FLATTEN
            off = expected.groupby(out[d]).sum() / expected.sum() - target / target.sum()
            assert np.allclose(out.groupby(d)[f"_off_{d}"].first(), off, atol=1e-9)
        assert out.loc[out["source"] == "rare", "_off_source"].iloc[0] < -1e-3


def test_no_least_yield_meets_the_targets_exactly(spark):
    out = sm.mixed(_rare(spark), topic_col="topic", least_kept=0.0).toPandas()
    assert (out["_tokens"] * out["_probability"]).sum() / out["_tokens"].sum() < sm.LEAST_KEPT
    assert all(out[f"_off_{d}"].abs().max() < 1e-9 for d in sm.DIMENSIONS)


def test_clipped_cells_leave_the_others_on_target():
    codes = np.array([[s, l] for s in range(4) for l in range(3)]).T
    tokens = np.array([9e5, 4e5, 3e5, 5e5, 6e5, 2e5, 8e5, 1e5, 7e5, 30, 20, 10])
    targets = [np.bincount(c, tokens) ** sm.FLATTEN for c in codes]
    weights = sm.rake(tokens, codes, targets)
    assert (tokens * weights).sum() / weights.max() / tokens.sum() < 0.1
    _, p = sm.probabilities(tokens, codes, targets, weights, 0.5)
    assert abs((tokens * p).sum() / tokens.sum() - 0.5) < 1e-9 and p.max() == 1 and np.allclose(p[-3:], 1, atol=1e-3)
    got = np.bincount(codes[0], tokens * p)[:3]
    assert np.allclose(got / got.sum(), targets[0][:3] / targets[0][:3].sum(), atol=1e-4)
    got = np.bincount(codes[1], tokens * p)
    assert np.allclose(got / got.sum(), targets[1] / targets[1].sum(), atol=1e-4)
    _, exact = sm.probabilities(tokens, codes, targets, weights, 0.01)
    assert abs((tokens * exact).sum() / tokens.sum() - 0.01) < 1e-9 and np.allclose(exact / weights, exact[0] / weights[0])
