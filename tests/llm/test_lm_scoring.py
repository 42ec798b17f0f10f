"""Counts and base scores by brute force; the recurrent model's gradients, likelihoods and gain on held-out texts."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tillstream.llm import lm_scoring as lm
from tillstream.llm.gru import Gru, _product
from tillstream.llm.queries import QUERIES
from tillstream.llm.words import words_of, words_of_all

FOLDER = "/root/testdata/sf0.01"


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + ["\n"]


def brute(rows):
    train = Counter()
    for i, t in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 10:
            train.update(tokens(t))
    n, v = sum(train.values()), len(train)
    out = []
    for i, t in rows:
        ts = tokens(t)
        base = sum(math.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ts)
        out.append((i, i is not None and zlib.crc32(str(i).encode()) % 10 == 0, len(ts), sum(w in train for w in ts), n, base))
    return out


def same(got, want):
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=repr)
    assert len(got) == len(want)
    for a, b in zip(got, sorted(want, key=repr)):
        assert a[:5] == b[:5] and math.isclose(a[5], b[5], rel_tol=1e-9), (a, b)


def test_gradients():
    rng = np.random.default_rng(0)
    model = Gru.start(rng.integers(1, 50, 100), 5, dtype=np.float64)
    words, starts, h = rng.integers(0, 100, (7, 3)), rng.random((7, 3)) < 0.2, rng.normal(size=(3, 5))
    _, grads, _ = model.gradients(words, starts, h)
    for name, v in model.at.items():
        for _ in range(4):
            i = tuple(rng.integers(0, s) for s in v.shape)
            old, sides = v[i], []
            for e in (1e-5, -1e-5):
                v[i] = old + e
                sides.append(model.gradients(words, starts, h)[0])
            v[i] = old
            assert abs((sides[0] - sides[1]) / 2e-5 - grads[name][i]) < 1e-6


def test_score_is_the_loss_of_the_whole_text():
    rng = np.random.default_rng(1)
    model = Gru.start(rng.integers(1, 9, 150), 6, dtype=np.float64)
    texts = [rng.integers(0, 150, n) for n in (1, 5, 64, 65, 200, 3)]
    for text, got in zip(texts, model.score(texts, lanes=4, window=64)):
        starts = np.zeros((len(text), 1), bool)
        starts[0] = True
        assert math.isclose(-model.gradients(text[:, None], starts, np.zeros((1, 6)))[0], got, rel_tol=1e-9)
    every = np.arange(150)
    h = rng.normal(size=6)
    assert math.isclose(np.exp(model.log_probabilities(np.tile(h, (150, 1)), every)).sum(), 1, rel_tol=1e-9)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    got = QUERIES["op2_lm_scoring"](spark, FOLDER).collect()
    same(got, brute(rows))
    held = [r for r in got if r.held_out]
    assert len(held) > 50 and sum(r.score for r in held) > 0.97 * sum(r.base_score for r in held)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


@pytest.mark.parametrize("frequent,vocabulary", [(40, 10), (1000, 2048)])
def test_rare_tokens_and_odd_rows(spark, frequent, vocabulary):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"W{int(x)}é" for x in rng.zipf(1.3, 30) % 500)) for i in range(200)]
    rows += [(300, None), (301, ""), (None, "w1é never seen"), (302, "new new"), (302, "new new"), (302, "other"), (303, "x " * 30_000)]
    docs = spark.createDataFrame([(i, t, "c", 1.0) for i, t in rows], "doc_id bigint, text string, token string, score double")
    same(lm.score_documents(docs, frequent=frequent, vocabulary=vocabulary).collect(), brute(rows))
    assert lm.score_documents(docs.limit(0)).count() == 0


def test_probabilities_of_all_tokens_sum_to_one(spark):
    texts = ["a b c a b d", "a b e a f"] * 5
    counts = lm.token_counts(spark.createDataFrame([(t,) for t in texts], "text string"))
    words = lm.frequent_words(counts, frequent=100, vocabulary=3)
    assert words.total == sum(len(t.split()) + 1 for t in texts) and words.distinct == 7 and words.known == 2
    share = [(c + 0.1) / words.other_mass for t, k in words.ids.items() if k > words.known for c in [words.counts[k]]]
    assert math.isclose(sum(share) + 0.1 / words.other_mass, 1)


def test_every_training_text_is_learned_once(spark, tmp_path, monkeypatch):
    """The model goes through each text in one shard of one round, however large the corpus is said to be."""
    rows = [(i, f"w{i} " * (i % 7 + 1)) for i in range(300)] + [(400, "same id"), (400, "other text")]
    docs = lm._keyed(spark.createDataFrame(rows, "doc_id bigint, text string"), "doc_id", "text")
    words = lm.frequent_words(lm.token_counts(lm._training(docs)), frequent=1000, vocabulary=1000)
    large = lm.Words(words.ids, words.counts, words.known, 100_000_000, words.distinct)
    seen = str(tmp_path)

    class Noted(Gru):
        def train(self, texts, **kwargs):
            import uuid

            np.save(f"{seen}/{uuid.uuid4().hex}.npy", np.concatenate(texts))
            return Gru(self.at)

    monkeypatch.setattr(lm.Gru, "start", classmethod(lambda cls, *a, **k: Noted({"E": np.zeros((2, 2), np.float32)})))
    monkeypatch.setattr(lm.Gru, "filled", lambda self, values: self)
    lm.train(lm._training(docs), large)
    passed = [np.load(p) for p in tmp_path.iterdir()]
    assert len(passed) > 20
    got = Counter(np.concatenate(passed).tolist())
    assert got == {k: int(c) for k, c in enumerate(words.counts) if k}


def test_texts_are_coded_once(spark, monkeypatch):
    """Training and scoring read the numbers that one pass over the texts has written."""
    given = {}
    for name in ("train", "_scored"):
        made = getattr(lm, name)
        monkeypatch.setattr(lm, name, lambda rows, *a, name=name, made=made, **k: given.update({name: rows.columns}) or made(rows, *a, **k))
    rows = [(i, f"w{i % 5} " * (i % 7)) for i in range(60)] + [(None, "w1 w9"), (70, None), (71, "w1"), (71, "w1")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    same(lm.score_documents(docs).collect(), brute(rows))
    assert set(given) == {"train", "_scored"}
    assert all("numbers" in columns and "text" not in columns for columns in given.values())


@pytest.mark.parametrize("vocabulary", [3, 300, 2048])
def test_coded_texts(spark, vocabulary):
    rows = [(i, " ".join(f"W{k}" for k in range(i * 20))) for i in range(30)] + [(None, ""), (50, None)]
    docs = lm._keyed(spark.createDataFrame(rows, "doc_id bigint, text string"), "doc_id", "text")
    words = lm.frequent_words(lm.token_counts(lm._training(docs)), frequent=400, vocabulary=vocabulary)
    kind = np.min_scalar_type(words.known)
    got = lm.coded(docs, words).join(docs.select("d1", "text").distinct(), "d1").collect()
    assert len(got) == len(rows)
    for r in got:
        own = tokens(r.text)
        places = [words.ids.get(t.encode(), 0) for t in own]
        assert np.frombuffer(r.numbers, kind).tolist() == [p if p <= words.known else 0 for p in places]
        assert list(map(bytes, r.rare)) == [t.encode() for t, p in zip(own, places) if not p] and r.n_tokens == len(own)
        assert r.n_other == sum(not p or p > words.known for p in places) and r.n_frequent == len(own) - len(r.rare)


ODD = ["", None, " ", "\n\n", "A", "  a\x0b\x1cB\u00a0c \u0085 \u00c9 a\t", "x" * 70_000, "\x00 \x1f\x7f", "İ K \u2028 ǅ", "b a a", None]


def test_words_of_a_whole_array_at_once():
    want = [words_of(t, lower=True) for t in ODD]
    for a, b in ((0, len(ODD)), (3, 7), (4, 4), (1, 2)):
        words, lens = words_of_all(pa.array(ODD, pa.string()).slice(a, b - a))
        assert lens.tolist() == [len(w) for w in want[a:b]] and words.to_pylist() == [w for ws in want[a:b] for w in ws]


@pytest.mark.parametrize("frequent", [0, 1, 3, 100])
def test_numbers_of_a_whole_array_at_once(frequent):
    own = [tokens(t) for t in ODD]
    rows = Counter(w.encode() for ws in own for w in ws).most_common(frequent)
    words = lm.Words({t: k + 1 for k, (t, _) in enumerate(rows)}, np.array([0] + [c for _, c in rows]), len(rows), 0, 0)
    found, lens, rare = words.numbers(pa.array(ODD, pa.string()))
    assert found.tolist() == [words.ids.get(w.encode(), 0) for ws in own for w in ws] and lens.tolist() == list(map(len, own))
    assert rare.to_pylist() == [w.encode() for ws in own for w in ws if w.encode() not in words.ids]


@pytest.mark.parametrize("most", [1, 3, 200_000])
def test_counts_are_whole_however_often_they_are_sent_on(spark, most):
    texts = [" ".join(f"w{i % 9} W{i % 4} u{i}" for i in range(k)) for k in range(40)] + [t for t in ODD if t is not None]
    got = lm.token_counts(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3), most).collect()
    assert len(got) == len({bytes(r.token) for r in got})
    assert {bytes(r.token).decode(): r.c for r in got} == Counter(w for t in texts for w in tokens(t))


@pytest.mark.parametrize("width", [0, 1, 511, 1535, 1536, 1537, 4096, 5000])
def test_product_by_blocks(width):
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=(7, 5)), rng.normal(size=(5, width + 9))[:, 3:width + 3]
    out = np.zeros((7, width + 4))
    _product(a, b, out[:, 2:-2])
    assert np.allclose(out[:, 2:-2], a @ b) and np.allclose(_product(a, b), a @ b) and not out[:, [0, 1, -2, -1]].any()


def test_gradients_of_a_wide_window():
    """As of its lanes one at a time."""
    rng = np.random.default_rng(3)
    model = Gru.start(rng.integers(1, 50, 100), 5, dtype=np.float64)
    words, starts, h = rng.integers(0, 100, (7, 300)), rng.random((7, 300)) < 0.02, rng.normal(size=(300, 5))
    loss, grads, after = model.gradients(words, starts, h)
    alone = [model.gradients(words[:, [k]], starts[:, [k]], h[[k]]) for k in range(300)]
    assert math.isclose(loss, sum(a[0] for a in alone)) and np.allclose(after, np.concatenate([a[2] for a in alone]))
    assert all(np.allclose(g, sum(a[1][name] for a in alone)) for name, g in grads.items())
