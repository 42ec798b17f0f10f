"""Log-likelihoods of whole texts: a smoothed word model of the corpus, and a gated recurrent model over it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tillstream.llm.gru import LN10, Gru
from tillstream.llm.language_id import is_held_out
from tillstream.llm.tables import stored
from tillstream.llm.words import words_of_all

END = b"\n"  # a token after each text; no word holds it
HIDDEN = 16
VOCABULARY = 2048  # outputs of the recurrent model: the most frequent tokens, and one for all others
FREQUENT = 131_072  # tokens whose counts the tasks carry with them; counts of others are joined
ROUNDS = 2
SHARD_TOKENS = 2_000_000  # of a shard, which one task trains on. More text is more shards.
RATE = 0.2
# Rows and characters of text scored at a time.
_ROWS, _CHARACTERS = 8192, 16_000_000


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_col).cast("bigint").alias("id"), text.alias("text"), F.xxhash64(text).alias("d1"),
        is_held_out(F.col(id_col), 10, 0).alias("held_out"),
    )


def _training(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("id").isNotNull() & ~F.col("held_out"))


def token_counts(texts: DataFrame, most: int = 200_000) -> DataFrame:
    """`token, c` over all rows of `text`. A task sums its counts up whenever it holds `most` of them, and sends them on if
    half as many are left."""
    schema = pa.schema([("token", pa.binary()), ("c", pa.int64())])

    def summed(tables: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(tables).group_by("token", use_threads=False).aggregate([("c", "sum")]).rename_columns(schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for a, b in _parts(batch.column(0)):
                words, _ = words_of_all(batch.column(0).slice(a, b - a))
                found = pc.value_counts(words)
                held.append(pa.table([found.field("values"), found.field("counts")], schema=schema))
                held.append(pa.table([pa.array([END], pa.binary()), pa.array([b - a], pa.int64())], schema=schema))
                size += len(found) + 1
                if size >= most:
                    held = [summed(held)]
                    size = len(held[0])
                    if size >= most / 2:
                        yield from held[0].to_batches()
                        held, size = [], 0
        if held:
            yield from summed(held).to_batches()

    return texts.select("text").mapInArrow(run, "token binary, c bigint").groupBy("token").agg(F.sum("c").alias("c"))


@dataclass
class Words:
    """Frequent tokens by falling count; number 0 of the recurrent model is any token beyond `known`."""

    ids: dict[bytes, int]  # place of a token, from 1
    counts: np.ndarray  # at a token's place; 0 at 0
    known: int  # places up to this one are outputs of the recurrent model
    total: int
    distinct: int

    @property
    def base_mass(self) -> float:
        return self.total + 0.1 * (self.distinct + 1)

    @property
    def other_mass(self) -> float:
        """What the word model gives all tokens that are not outputs, one unseen among them."""
        return self.total - float(self.counts[: self.known + 1].sum()) + 0.1 * (self.distinct - self.known + 1)

    def model_counts(self) -> np.ndarray:
        own = self.counts[: self.known + 1].astype(float)
        own[0] = self.total - own.sum()
        return own

    @cached_property
    def listed(self) -> pa.Array:
        """The tokens by their places."""
        return pa.array(sorted(self.ids, key=self.ids.get), pa.binary())

    def numbers(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Places of all tokens of the texts in order, 0 for those that are not frequent; the number of each text's
        tokens; and the tokens of place 0."""
        words, lens = words_of_all(texts)
        found = pc.index_in(words, self.listed).fill_null(-1).to_numpy() + 1
        ends = np.cumsum(lens)
        found = np.insert(found, ends, self.ids.get(END, 0))
        at = np.insert(np.arange(len(words)), ends, len(words))[found == 0]
        return found, lens + 1, pa.concat_arrays([words, pa.array([END], pa.binary())]).take(pa.array(at))


def frequent_words(counts: DataFrame, frequent: int = FREQUENT, vocabulary: int = VOCABULARY) -> Words:
    """At most `frequent` tokens come to the driver: those with counts over a bound found from a histogram of counts."""
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    band = F.floor(F.log2("c") * 16)
    bands = counts.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("band")).collect()
    taken, least = 0, None
    for b in bands:
        if taken + b.n > frequent:
            break
        taken, least = taken + b.n, b.band
    rows = counts.filter(band >= least).collect() if least is not None else []
    rows = sorted(((bytes(r.token), r.c) for r in rows), key=lambda r: (-r[1], r[0]))
    return Words(
        {t: k + 1 for k, (t, _) in enumerate(rows)}, np.array([0] + [c for _, c in rows], np.int64),
        min(len(rows), vocabulary - 1), total[0], total[1],
    )


def _parts(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of at most _ROWS rows and about _CHARACTERS characters of text, or bytes of numbers."""
    sizes = (pc.utf8_length if pa.types.is_string(column.type) else pc.binary_length)(column).to_numpy(zero_copy_only=False).astype(np.int64)
    block = np.stack((np.arange(len(sizes)) // _ROWS, np.cumsum(sizes) // _CHARACTERS))
    cuts = [0, *(np.flatnonzero(np.diff(block).any(0)) + 1).tolist(), len(sizes)]
    yield from ((a, b) for a, b in zip(cuts, cuts[1:]) if a < b)


def _bytes_of(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Runs of `values` up to each of `ends` as bytes."""
    offsets = np.append(0, ends * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def coded(rows: DataFrame, words: Words) -> DataFrame:
    """For each text what the tasks can tell by themselves: its words as outputs of the recurrent model in `numbers`, in
    the least type that holds them, its sums of the word model, and its tokens that are not frequent as `rare`."""
    carried = rows.sparkSession.sparkContext.broadcast(words)
    number = np.min_scalar_type(words.known)
    names = ["n_tokens", "n_frequent", "n_other"]
    sums = ["frequent_sum", "other_sum"]
    schema = pa.schema(
        [("id", pa.int64()), ("d1", pa.int64()), ("held_out", pa.bool_()), *[(c, pa.int64()) for c in names],
         *[(c, pa.float64()) for c in sums], ("numbers", pa.binary()), ("rare", pa.list_(pa.binary()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = carried.value
        logs = np.log10(own.counts + 0.1)
        for batch in batches:
            for a, b in _parts(batch.column(3)):
                part = batch.slice(a, b - a)
                found, lens, rare = own.numbers(part.column(3))
                ends, none, other = np.cumsum(lens), found == 0, found > own.known
                n_rare, n_other = (np.diff(np.cumsum(which)[ends - 1], prepend=0) for which in (none, other))
                values = logs[found]
                values[none] = 0
                sums = [[float(x.sum()) for x in np.split(v, cuts)] for v, cuts in (
                    (values, ends[:-1]), (values[other], np.cumsum(n_other)[:-1]),
                )]
                found[other] = 0
                yield pa.RecordBatch.from_arrays([
                    *part.columns[:3], *[pa.array(c, pa.int64()) for c in (lens, lens - n_rare, n_other + n_rare)],
                    *[pa.array(c, pa.float64()) for c in sums], _bytes_of(found.astype(number), ends),
                    pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n_rare)), pa.int32()), rare),
                ], schema=schema)

    ddl = "id bigint, d1 bigint, held_out boolean, " + ", ".join([*[f"{c} bigint" for c in names], *[f"{c} double" for c in sums]])
    return rows.select("id", "d1", "held_out", "text").mapInArrow(run, ddl + ", numbers binary, rare array<binary>")


def train(rows: DataFrame, words: Words, rounds: int = ROUNDS, hidden: int = HIDDEN, seed: int = 0) -> Gru:
    """A model trained on all texts, `coded` or not yet, by rounds of averaging.

    Each text is in one round, by hash. A round's texts are dealt into shards of some SHARD_TOKENS tokens, whatever the
    number of partitions, and cross as numbers of outputs. A task trains a copy of the model on a shard, and the copies are
    averaged by tokens: each number is summed over shards map-side. The shards grow in proportion to the corpus; the
    model does not.
    """
    model = Gru.start(words.model_counts(), hidden, seed)
    shards = max(1, round(words.total / rounds / SHARD_TOKENS))
    parameters = len(model.flat())
    number = np.min_scalar_type(words.known)
    rows = rows if "numbers" in rows.columns else coded(rows, words)

    for turn in range(rounds):
        chosen = rows.filter(F.pmod(F.xxhash64(F.lit(seed), "id", "d1"), F.lit(rounds)) == turn)
        shard = F.pmod(F.xxhash64(F.lit(seed + 1), "id", "d1"), F.lit(shards)).alias("shard")

        def run(rows: pd.DataFrame) -> pd.DataFrame:
            texts = [np.frombuffer(t, number).astype(np.int32) for t in rows.sort_values(["id", "numbers"])["numbers"]]
            size = sum(map(len, texts))
            values = np.append(model.train(texts, rate=RATE).flat().astype(np.float64), 1.0) * size
            return pd.DataFrame({"i": np.arange(len(values), dtype=np.int32), "v": values})

        trained = chosen.select("id", shard, "numbers").groupBy("shard").applyInPandas(run, "i int, v double")
        summed = trained.groupBy("i").agg(F.sum("v").alias("v"))
        values = np.zeros(parameters + 1)
        found = summed.toArrow()  # a row for each parameter
        values[found["i"].to_numpy()] = found["v"].to_numpy()
        if values[-1] > 0:
            model = model.filled(values[:-1] / values[-1])
    return model


def _scored(rows: DataFrame, words: Words, model: Gru) -> DataFrame:
    """Rows as `coded`, with `model_score` in place of their numbers."""
    carried = rows.sparkSession.sparkContext.broadcast(model)
    number = np.min_scalar_type(words.known)
    kept = [f for f in rows.schema if f.name not in ("numbers", "rare")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gru = carried.value
        for batch in batches:
            for a, b in _parts(batch.column(0)):
                part = batch.slice(a, b - a)
                numbers = [np.frombuffer(t.as_buffer(), number).astype(np.int32) for t in part.column(0)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(gru.score(numbers) / LN10)], [*part.schema.names[1:], "model_score"]
                )

    ddl = ", ".join([*[f"{f.name} {f.dataType.simpleString()}" for f in kept], "model_score double"])
    return rows.select("numbers", *[f.name for f in kept]).mapInArrow(run, ddl)


def score_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT, vocabulary: int = VOCABULARY,
    rounds: int = ROUNDS,
) -> DataFrame:
    """`<id>, held_out, n_tokens, n_known, train_tokens, base_score, score` for each row.

    Tokens are words between ASCII white space with A-Z lower-cased, and an end. Training texts are those whose id's
    CRC-32 is not 0 modulo 10, for the counts as for the recurrent model; `held_out` are the others, rows without an id are neither. `base_score` is the
    sum over tokens of log10((c + 0.1) / (N + 0.1 (V + 1))). `score` is the recurrent model's log10 probability: it
    predicts each token from all before it, and shares what it gives "another token" among the tokens that are no
    outputs, unseen ones included, in proportion to the word model, so that all probabilities sum to one. Null texts
    have an end only. Repeated rows get equal answers; without training texts all counts are 0.
    """
    rows = _keyed(docs, id_col, text_col)
    counts = stored(token_counts(_training(rows)), "counts")
    words = frequent_words(counts, frequent, vocabulary)
    known = stored(coded(rows, words), "coded")
    model = train(_training(known), words, rounds)
    scored = _scored(known, words, model)

    # Texts that share id and text come as often as they are repeated; `copies` counts that out of the sums.
    rare = known.select("id", "d1", F.posexplode("rare").alias("i", "token")).join(counts, "token", "left").groupBy("id", "d1").agg(
        F.sum(F.log10(F.coalesce("c", F.lit(0)) + 0.1)).alias("s"), F.count("c").alias("n"), F.count_if(F.col("i") == 0).alias("copies")
    )
    rare = rare.select(
        F.struct("id", "d1").alias("key"), (F.col("s") / F.col("copies")).alias("rare_sum"), (F.col("n") / F.col("copies")).alias("rare_known")
    )
    own = scored.withColumn("key", F.struct("id", "d1")).join(rare, "key", "left")
    rare_sum = F.coalesce("rare_sum", F.lit(0.0))
    base_mass, other_mass = float(np.log10(max(words.base_mass, 1e-300))), float(np.log10(max(words.other_mass, 1e-300)))
    return own.select(
        F.col("id").alias(id_col), "held_out", "n_tokens",
        (F.col("n_frequent") + F.coalesce("rare_known", F.lit(0)).cast("bigint")).alias("n_known"),
        F.lit(words.total).cast("bigint").alias("train_tokens"),
        (F.col("frequent_sum") + rare_sum - F.col("n_tokens") * base_mass).alias("base_score"),
        (F.col("model_score") + F.col("other_sum") + rare_sum - F.col("n_other") * other_mass).alias("score"),
    )
