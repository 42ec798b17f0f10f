"""Removal of word windows that an earlier document has, found by Rabin-Karp hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tillstream.llm.tables import stored
from tillstream.llm.words import map_rows, words_of

LENGTH = 50
# Odd multipliers of the two rolling hashes, so that both have an inverse modulo 2^64.
BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def rolling(hashes: np.ndarray, length: int, base: int) -> np.ndarray:
    """For each start the hash sum(h[i+j] * base^j, j < length) modulo 2^64, mixed; all by prefix sums."""
    n = len(hashes)
    if n < length:
        return np.zeros(0, np.uint64)
    powers = np.full(n, base, np.uint64)
    back = np.full(n - length + 1, pow(base, -1, 1 << 64), np.uint64)
    powers[0] = back[0] = 1
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * np.multiply.accumulate(powers), out=prefix[1:])
    return _mixed((prefix[length:] - prefix[:-length]) * np.multiply.accumulate(back))


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` neighbours, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)


def _least_grams(hashes: np.ndarray, length: int) -> np.ndarray:
    """For each window the least hash of the short word runs in it: equal windows have an equal one."""
    gram = max(1, length // 5)
    return sliding_minimum(rolling(hashes, gram, BASES[0]), length - gram + 1)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"), text.alias("text"),
        F.xxhash64(text).alias("d1"), F.xxhash64(F.lit(1), text).alias("d2"),
    )
    return rows.withColumn("key", F.struct("id", "d1"))


def _grams(rows: DataFrame, length: int) -> DataFrame:
    """`m, id, d1`: the distinct least hashes of each document, about one for twenty words."""
    schema = pa.schema([("m", pa.int64()), ("id", pa.int64()), ("d1", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[], [], []]
            for i, d1, text in zip(*batch.columns):
                words = words_of(text.as_py())
                if len(words) >= length:
                    least = np.unique(_least_grams(_word_hashes(words), length)).view(np.int64)
                    for column, values in zip(out, (least, np.full(len(least), i.as_py()), np.full(len(least), d1.as_py()))):
                        column.append(values)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], schema=schema)

    return rows.select("id", "d1", "text").mapInArrow(run, "m bigint, id bigint, d1 bigint")


def _windows(rows: DataFrame, length: int) -> DataFrame:
    """`h1, h2, id, d1, at`: the windows of each document whose least hash is in its list `shared`."""
    schema = pa.schema([(c, pa.int64()) for c in ("h1", "h2", "id", "d1")] + [("at", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, d1, text, shared in zip(*batch.columns):
                hashes = _word_hashes(words_of(text.as_py()))
                wanted = np.array(shared.as_py(), np.int64).view(np.uint64)
                at = np.flatnonzero(np.isin(_least_grams(hashes, length), wanted))
                keys = [rolling(hashes, length, base)[at].view(np.int64) for base in BASES]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, keys), pa.array(np.full(len(at), i.as_py())), pa.array(np.full(len(at), d1.as_py())),
                     pa.array(at.astype(np.int32))], schema=schema
                )

    return rows.select("key.id", "key.d1", "text", "shared").mapInArrow(run, "h1 bigint, h2 bigint, id bigint, d1 bigint, at int")


def merged(starts: list[int], length: int) -> list[tuple[int, int]]:
    """Maximal intervals [from, to) of words covered by windows at the given starts."""
    out: list[tuple[int, int]] = []
    for s in sorted(set(starts)):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], s + length)
        else:
            out.append((s, s + length))
    return out


def repeated_starts(keyed: DataFrame, length: int) -> DataFrame:
    """`id, d1, starts, whole`: where windows start that a smaller id has too; `whole` marks copies of a whole text.

    1. Of equal texts only the smallest id goes on. A copy's windows are all repeated, and its keeper has each of them.
    2. Equal windows share the least hash of their short word runs. Only documents with a least hash that another
       document has go on, with the list of these: most windows of most texts are ruled out at a twentieth of the rows.
    3. The windows left are counted by their two hashes: the smallest id of each, combined map-side, goes back to the
       windows by a join whose large partitions Spark may split; no group of copies is gathered anywhere.
    """
    rows = keyed.filter("id IS NOT NULL")
    ids = rows.select("id", "d1", "d2").distinct()
    first = ids.groupBy("d1", "d2").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last")
    copies = stored(ids.join(first, ["d1", "d2"]).filter("id > first").select("id", "d1").distinct(), "copies")

    grams = stored(_grams(rows, length), "grams")
    own = grams.join(copies, ["id", "d1"], "left_anti")
    shared = own.groupBy("m").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo < hi").select("m")
    lists = own.join(shared, "m").groupBy("id", "d1").agg(F.collect_set("m").alias("shared"))
    # The texts are dealt out by `key` here and in the end: it is never null, so that Spark sees one exchange in the two.
    keyed_lists = lists.select(F.struct("id", "d1").alias("key"), "shared")
    windows = _windows(keyed.select("key", "text").join(keyed_lists, "key"), length)

    first = windows.groupBy("h1", "h2").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last")
    late = windows.join(first.drop("last"), ["h1", "h2"]).filter("id > first")
    starts = late.groupBy("id", "d1").agg(F.collect_set("at").alias("starts"))
    return starts.withColumn("whole", F.lit(False)).unionByName(
        copies.select("id", "d1", F.lit(None).cast("array<int>").alias("starts"), F.lit(True).alias("whole"))
    )


def remove_repeated_windows(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`<id>, n_words, n_removed, spans, kept`: each text without the words of repeated windows.

    A window is `length` consecutive words of one document; it is repeated if its words also start in a document with
    a smaller id, as the texts are given. `spans` are the maximal word intervals [start, end) removed, `kept` the other
    words joined by one space. Null texts have no words; texts under `length` words stay. Rows that share an id do not
    remove each other; rows without an id neither remove nor lose words. One row out for each row in.
    """
    keyed = _keyed(docs, id_col, text_col)
    marks = repeated_starts(keyed, length)
    schema = pa.schema([
        (id_col, pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.string()),
    ])

    def make():
        def row(r):
            doc, text, starts, whole = r
            words = words_of(text)
            n = len(words)
            spans = ([(0, n)] if n >= length else []) if whole else merged(starts or [], length)
            kept, at = [], 0
            for s, e in spans:
                kept += words[at:s]
                at = e
            kept += words[at:]
            shown = [{"start": s, "end": e} for s, e in spans]
            return doc, n, n - len(kept), shown, b" ".join(kept).decode("utf-8", "replace")
        return row

    marks = marks.select(F.struct("id", "d1").alias("key"), "starts", "whole")
    joined = keyed.select("key", "text").join(marks, "key", "left").select("key.id", "text", "starts", "whole")
    ddl = f"`{id_col}` bigint, n_words bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept string"
    return map_rows(joined, make, schema, ddl)
