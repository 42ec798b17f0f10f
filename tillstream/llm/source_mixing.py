"""Sampling of documents so that sources, languages and topics reach target shares of all tokens."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tillstream.llm.tables import join_checked, stored
from tillstream.llm.words import words_of

DIMENSIONS = ["source", "lang", "topic"]
TOPICS = 8
# A target share is proportional to the tokens to this power: between 1 (as they are) and 0 (all equal).
FLATTEN = 0.7
SEED = 10
# The yield: the share of all tokens that is kept at least, however rare a category is. A setting of `mixed`, to be chosen
# by how many tokens are wanted; what it costs is in the `_off_` columns.
LEAST_KEPT = 0.4
_NULL = "\x00"


def lexical_topic(text: str | None, topics: int = TOPICS) -> tuple[str, int]:
    """Topic and token count of a text. The topic is the vocabulary group with most of its longer words, a word's group
    being set by its hash; it stands in where documents have no topic of their own. No longer words: `t0`."""
    words = words_of(text, lower=True)
    groups = [xxhash.xxh64_intdigest(w) % topics for w in words if len(w) > 4]
    best = int(np.bincount(groups, minlength=topics).argmax()) if groups else 0
    return f"t{best}", len(words)


def topic_and_tokens(text: Column, topics: int = TOPICS) -> Column:
    @F.arrow_udf("struct<topic:string,tokens:bigint>")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in texts:
            made = [lexical_topic(t.as_py(), topics) for t in array]
            yield pa.StructArray.from_arrays(
                [pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64())], ["topic", "tokens"]
            )

    return run(text.cast("string"))


def rake(tokens: np.ndarray, codes: np.ndarray, targets: list[np.ndarray], sweeps: int = 500, close: float = 1e-12) -> np.ndarray:
    """Weights of the cells' tokens after which each dimension has its target shares: iterative proportional fitting.

    `tokens`: of each cell; `codes`: a row for each dimension, the category of each cell; `targets`: shares by category.
    Categories without tokens get none, the rest share what is left. Stops when no share is off by `close`.
    """
    weights = np.ones(len(tokens))
    for _ in range(sweeps):
        off = 0.0
        for code, target in zip(codes, targets):
            have = np.bincount(code, weights * tokens, len(target))
            wanted = np.where(have > 0, target, 0)
            wanted = wanted / wanted.sum()
            have = have / have.sum()
            off = max(off, np.abs(have - wanted).max())
            weights *= np.divide(wanted, have, out=np.ones(len(target)), where=have > 0)[code]
        if off < close:
            break
    return weights


def _filled(room: np.ndarray, target: np.ndarray, total: float) -> np.ndarray:
    """`total` by the shares of `target`, none over its room; what a full one leaves goes to the others."""
    scale = _scale(target, room, total)
    return np.minimum(room, scale * target)


def _scale(weights: np.ndarray, room: np.ndarray, total: float) -> float:
    """The factor of the weights with which `min(room, factor * weights)` sums to `total`, or to all the room they have."""
    some = weights > 0
    full = np.divide(room, weights, out=np.zeros(len(room)), where=some)
    order = np.argsort(full[some])
    w, r = weights[some][order], room[some][order]
    before = np.concatenate(([0.0], np.cumsum(r)[:-1]))
    factor = (total - before) / np.cumsum(w[::-1])[::-1]
    fits = np.flatnonzero(factor <= full[some][order])
    return float(factor[fits[0]] if len(fits) else full.max(initial=0.0))


def probabilities(
    tokens: np.ndarray, codes: np.ndarray, targets: list[np.ndarray], weights: np.ndarray, keep: float | None = None,
    least_kept: float = LEAST_KEPT,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and probabilities of the cells, which keep the share `keep` of all tokens in expectation.

    `weights` are the raked ones. As long as none is over 1 at that share, they are only scaled. Else probabilities are
    the weights clipped at 1, and the weights are raked again with clipped cells counted as clipped, to the targets as
    far as a category's tokens suffice. No `keep`: what the raked weights keep with the largest at 1, or `least_kept` if more.
    """
    total = tokens.sum()
    exact = (tokens * weights).sum() / weights.max() / total
    if keep is None:
        keep = max(exact, least_kept)
    if keep <= exact:
        return weights, weights / weights.max() * (keep / exact)
    goal = min(keep * total, tokens[weights > 0].sum())
    wanted = [_filled(np.bincount(c, tokens * (weights > 0), len(t)), t, goal) for c, t in zip(codes, targets)]
    raked = weights * _scale(weights * tokens, tokens, goal)
    for _ in range(500):
        off = 0.0
        for code, want in zip(codes, wanted):
            have = np.bincount(code, tokens * np.minimum(raked, 1), len(want))
            off = max(off, np.abs(have - want).max() / goal)
            raked = raked * np.divide(want, have, out=np.ones(len(want)), where=have > 0)[code]
        if off < 1e-12:
            break
    raked = raked * _scale(raked * tokens, tokens, goal)
    return raked, np.minimum(raked, 1)


def mixed(
    docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, flatten: float = FLATTEN, topic_col: str | None = None,
    seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", keep: float | None = None,
    least_kept: float = LEAST_KEPT,
) -> DataFrame:
    """The documents with `_topic, _tokens, _weight, _probability, _kept, _off_source, _off_lang, _off_topic` added.

    Tokens are words between ASCII white space. Their counts by (source, language, topic) are raked to the target
    shares: of `targets` for the dimensions it names (values it leaves out get nothing), else proportional to tokens to
    the power `flatten`. Probabilities are in proportion to the weights and keep the share `keep` of all tokens: as much
    as meets the targets exactly if it is not given, but `least_kept` at least (0: always exact). Where that takes cells at more than 1, they
    are clipped and the others raked again, see `probabilities`; `_off_<dimension>` is then how far the expected share of
    a row's category is from its target (0 where it is met; null in cells without tokens). A document is kept if a number in [0, 1) made from
    its id and text is under its probability: the same in every run and on every executor. Null categories are a
    category; texts without words have the probability of their cell, or 1 if their cell has no tokens.

    Only the cells, by number the product of sources, languages and topics seen, pass through the driver.
    """
    made = topic_and_tokens(F.col(text_col))
    rows = docs.withColumn("_made", made)
    topic = F.col("_made.topic") if topic_col is None else F.col(topic_col).cast("string")
    names = [F.col("source").cast("string"), F.col("lang").cast("string"), topic]
    keys = [F.coalesce(c, F.lit(_NULL)).alias(f"_{d}") for c, d in zip(names, DIMENSIONS)]
    keyed = rows.select(*docs.columns, *keys, F.col("_made.tokens").alias("_tokens"))
    named = [f"_{d}" for d in DIMENSIONS]
    cells = keyed.groupBy(*named).agg(F.sum("_tokens").alias("n")).filter("n > 0").toPandas().sort_values(named, ignore_index=True)
    codes, shares = [], []
    for d in DIMENSIONS:
        values, code = np.unique(cells[f"_{d}"].to_numpy(str) if len(cells) else np.zeros(0, str), return_inverse=True)
        wanted = (targets or {}).get(d)
        if wanted is None:
            share = np.bincount(code, cells["n"].to_numpy(float), len(values)) ** flatten
        else:
            share = np.array([wanted.get(v, 0.0) for v in values], float)
        if len(values) and share.sum() <= 0:
            raise ValueError(f"no target of {d} is a value that the documents have")
        codes.append(code)
        shares.append(share)
    weights = rake(cells["n"].to_numpy(float), np.array(codes), shares) if len(cells) else np.zeros(0)
    chances = weights
    if len(cells):
        tokens = cells["n"].to_numpy(float)
        weights, chances = probabilities(tokens, np.array(codes), shares, weights, keep, least_kept)
    cells["_weight"], cells["_probability"] = weights, chances
    for d, code, share in zip(DIMENSIONS, codes, shares):
        have = np.bincount(code, cells["n"].to_numpy(float) * chances, len(share))
        cells[f"_off_{d}"] = (have / have.sum() - share / share.sum())[code] if len(cells) else weights
    offs = [f"_off_{d}" for d in DIMENSIONS]
    schema = "_source string, _lang string, _topic string, " + ", ".join(f"{c} double" for c in ["_weight", "_probability", *offs])
    table = docs.sparkSession.createDataFrame(cells[[*named, "_weight", "_probability", *offs]].to_dict("records"), schema)
    found = join_checked(keyed, table, named, "left", rows=len(cells))
    chance = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)), 11) / F.lit(float(1 << 53))
    probability = F.coalesce("_probability", F.lit(1.0))
    return found.select(
        *docs.columns, F.nullif("_topic", F.lit(_NULL)).alias("_topic"), "_tokens",
        F.coalesce("_weight", F.lit(1.0)).alias("_weight"), probability.alias("_probability"), (chance < probability).alias("_kept"),
        *offs,
    )


def sample(docs: DataFrame, **settings) -> DataFrame:
    """The documents that `mixed` keeps, unchanged."""
    return mixed(docs, **settings).filter("_kept").select(*docs.columns)
