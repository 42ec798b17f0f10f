"""Language of a text: the nearest of a few centroids per language among TF-IDF vectors of letter n-grams."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillstream.llm.tables import join_checked, stored

UNDETERMINED = "und"
DIMENSIONS = 4096
ORDERS = 3
CENTROIDS = 3
# Distinct labelled texts per language from which centroids are made; counts of n-grams use all of them.
PER_LANGUAGE = 500
# A text is rejected if it is less like its nearest centroid than this part of the likeness of the centroid's
# least like hundredth of texts.
REJECT = 0.25
_CHUNK = 1 << 20


@cache
def _letters() -> np.ndarray:
    """Code point -> whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def counts(text: str | None, dimensions: int = DIMENSIONS) -> np.ndarray | None:
    """Counts of the 1- to 3-grams of the lower-cased letters, each run of other characters being one space, hashed
    into `dimensions`; None if there is no letter. The whole text is counted, in chunks that overlap by two."""
    total = None
    tail = np.array([32], np.uint32)
    lowered = (text or "").lower()
    for k in range(0, len(lowered), _CHUNK):
        codes = np.frombuffer(lowered[k:k + _CHUNK].encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters()[codes]
        if total is None and letter.any():
            total = np.zeros(dimensions, np.int64)
        codes = np.concatenate((tail, np.where(letter, codes, 32)))
        codes = codes[np.concatenate(([True], (codes[1:] != 32) | (codes[:-1] != 32)))]
        tail = codes[-2:]
        if total is not None:
            total += _hashed(codes, dimensions, len(tail) if k else 0)
    if total is not None and tail[-1] != 32:
        total += _hashed(np.append(tail, 32).astype(np.uint32), dimensions, len(tail))
    return total


def _hashed(codes: np.ndarray, dimensions: int, known: int) -> np.ndarray:
    """Counts of the n-grams that end after the first `known` codes."""
    x = codes.astype(np.uint64)
    out = np.zeros(dimensions, np.int64)
    gram = np.zeros(len(x), np.uint64)
    for order in range(1, ORDERS + 1):
        gram = (gram[: len(x) - order + 1] if order == 1 else gram[:-1]) * np.uint64(0x100000001B3) + x[order - 1:] + np.uint64(1)
        mixed = (gram ^ (gram >> np.uint64(15))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)
        new = mixed[max(0, known - order + 1):]
        out += np.bincount((new % np.uint64(dimensions)).astype(np.int64), minlength=dimensions)
    return out


def weighted(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(tf) * idf
    return v / max(np.linalg.norm(v), 1e-12)


def cluster(vectors: np.ndarray, k: int, rounds: int = 15) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of unit vectors by spherical k-means, and each vector's cosine with its own; starts far apart."""
    picked = [int(np.argmax(vectors @ vectors.sum(0)))]
    while len(picked) < min(k, len(vectors)):
        picked.append(int(np.argmin((vectors @ vectors[picked].T).max(1))))
    centres = vectors[picked]
    for _ in range(rounds):
        own = (vectors @ centres.T).argmax(1)
        sums = np.stack([vectors[own == j].sum(0) if (own == j).any() else centres[j] for j in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres, (vectors @ centres.T).max(1)


@dataclass
class LanguageModel:
    idf: np.ndarray
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    least: np.ndarray  # cosine under which a centroid's language is rejected

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and cosine in [0, 1]; `und` for a text without letters (0) or far from all centroids."""
        tf = counts(text, len(self.idf))
        if tf is None or not self.languages:
            return UNDETERMINED, 0.0
        likeness = self.centroids @ weighted(tf, self.idf).astype(np.float32)
        best = int(likeness.argmax())
        score = float(min(1.0, max(0.0, likeness[best])))
        return (self.languages[best] if score >= self.least[best] else UNDETERMINED), score


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE, centroids: int = CENTROIDS, reject: float = REJECT) -> LanguageModel:
    """Model from `text, lang` rows with neither null.

    Document frequencies count every row. Centroids are made from the `per_language` distinct texts of smallest hash, so
    copies take no places, a language per task, which gets vectors of fixed length, however long the texts; the driver
    gets only centroids. No rows: a model that says `und`.
    """
    df_schema = pa.schema([("i", pa.int32()), ("n", pa.int64())])

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(DIMENSIONS + 1, np.int64)
        for batch in batches:
            for text in batch.column(0):
                if (tf := counts(text.as_py())) is not None:
                    total[:-1] += tf > 0
                    total[-1] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMENSIONS + 1, dtype=np.int32)), pa.array(total)], schema=df_schema)

    seen = labelled.select("text").mapInArrow(frequencies, "i int, n bigint").groupBy("i").agg(F.sum("n").alias("n"))
    n = np.zeros(DIMENSIONS + 1)
    for i, count in seen.collect():  # one row for each dimension
        n[i] = count
    idf = np.log((1 + n[-1]) / (1 + n[:-1])) + 1

    order = F.xxhash64("text")
    sizes = stored(labelled.groupBy("lang").agg(F.count_distinct(order).alias("_size")), "languages")
    likely = join_checked(labelled.select("text", "lang"), sizes, ["lang"]).filter(
        F.pmod(order, F.lit(1 << 30)) * F.col("_size") <= F.lit(2.0 * per_language * (1 << 30))
    ).select("lang", "text").distinct()
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod(order, F.lit(1 << 30)), "text"))
    sample = likely.withColumn("_turn", turn).filter(F.col("_turn") <= per_language).select("lang", "text")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(*batch.columns):
                if (tf := counts(text.as_py())) is not None:
                    x = pa.array([weighted(tf, idf)], pa.list_(pa.float64()))
                    yield pa.RecordBatch.from_arrays([pa.array([lang.as_py()], pa.string()), x], ["lang", "x"])

    def centres(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(rows["x"].sort_values(key=lambda v: v.map(np.ndarray.tobytes)))
        made, likeness = cluster(x, centroids)
        own = (x @ made.T).argmax(1)
        least = [reject * float(np.quantile(likeness[own == j], 0.01)) if (own == j).any() else 0.0 for j in range(len(made))]
        return pd.DataFrame({"lang": key[0], "least": least, "centre": [c.astype(np.float32) for c in made]})

    sample = sample.mapInArrow(vectors, "lang string, x array<double>")
    found = sample.groupBy("lang").applyInPandas(centres, "lang string, least double, centre array<float>").collect()
    found = sorted(found, key=lambda r: r.lang)  # `centroids` rows for each language
    return LanguageModel(
        idf, [r.lang for r in found],
        np.array([r.centre for r in found], np.float32).reshape(len(found), DIMENSIONS), np.array([r.least for r in found]),
    )


def predict(model: LanguageModel, text: Column) -> Column:
    """`struct<lang string, score double>` of a text column."""
    @F.arrow_udf("struct<lang:string,score:double>")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in texts:
            found = [model.predict(t.as_py()) for t in array]
            yield pa.StructArray.from_arrays(
                [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], ["lang", "score"]
            )

    return run(text.cast("string"))


def is_held_out(doc_id: Column, modulus: int = 4, remainder: int = 2) -> Column:
    """By the CRC-32 of the id's text; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus)) == remainder, F.lit(False))


def fit_documents(docs: DataFrame, **settings) -> LanguageModel:
    """Model from the documents with an id, text and language whose id is not held out."""
    rows = docs.filter(F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
    return fit(rows.select(F.col("text").cast("string"), F.col("lang").cast("string")).dropna(), **settings)


def identify(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """`doc_id, held_out, lang_pred, score` for each row of `doc_id, text, lang`; other columns are not looked at.

    Predictions see the whole text only. Null texts and texts without letters: `und`, 0. Repeated rows get equal answers.
    """
    model = model or fit_documents(docs)
    found = docs.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), predict(model, F.col("text")).alias("_p"))
    return found.select("doc_id", "held_out", F.col("_p.lang").alias("lang_pred"), F.col("_p.score").alias("score"))


def keep_identified(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """The documents, unchanged, whose language is not rejected."""
    model = model or fit_documents(docs)
    return docs.filter(predict(model, F.col("text"))["lang"] != UNDETERMINED)
