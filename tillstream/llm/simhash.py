"""Near-duplicates by SimHash of word shingles, found in tables of a covering code."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tillstream.llm.graph import components
from tillstream.llm.tables import stored
from tillstream.llm.words import map_rows, words_of

RADIUS = 3
# A bucket of up to this many fingerprints is compared by pairs, a larger one through flipped copies.
PAIRWISE = 256


def shingle_hashes(text: str | None, shingle: int = 3, seed: int = 42) -> np.ndarray:
    """XXH64 of each run of `shingle` words, lower-cased, in order and with repeats; of all words if they are fewer."""
    words = words_of(text, lower=True)
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    size = min(shingle, len(words))
    starts = np.concatenate(([0], ends[: len(words) - size] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[s:e], seed) for s, e in zip(starts, ends[size - 1:].tolist())], np.uint64)


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """64 bits, each the majority of that bit over the XXH64 of all shingles, as a signed integer.

    Fewer words than `shingle`: the whole sequence is the one shingle. No words, or null: 0. A tie is 0.
    """
    hashes = shingle_hashes(text, shingle, seed)
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 15):
        part = hashes[k:k + (1 << 15)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`<id>, fp`: a row for each document."""
    schema = pa.schema([(id_col, pa.int64()), ("fp", pa.int64())])
    rows = docs.select(F.col(id_col).cast("bigint").alias(id_col), F.col(text_col).cast("string").alias("text"))
    return map_rows(rows, lambda: lambda r: (r[0], fingerprint(r[1])), schema, f"`{id_col}` bigint, fp bigint")


def covering_masks(radius: int = RADIUS, bits: int = 64) -> list[int]:
    """Masks so that two fingerprints at most `radius` bits apart agree under one of them at least.

    Bit i has the code c(i), one of the non-zero vectors of radius+1 bits in turn. The mask of v holds the bits whose
    code has an odd inner product with v. The codes of `radius` differing bits span too little to have none but v = 0
    orthogonal to all of them; under that v's mask the two agree. Each mask holds about half of the bits (Pagh, 2016).
    """
    codes = 2 ** (radius + 1) - 1
    masks = [sum(1 << i for i in range(bits) if ((i % codes + 1) & v).bit_count() % 2) for v in range(1, codes + 1)]
    return [m - (1 << bits) if m >> (bits - 1) else m for m in masks]


def links(fps: DataFrame, radius: int = RADIUS, pairwise: int = PAIRWISE) -> DataFrame:
    """Links `a, b` that connect all distinct fingerprints (bigint column `fp`) at `radius` or fewer bits.

    Small buckets: every such pair. In a larger bucket pairs could grow with its square, so each fingerprint is sent
    with up to h = radius // 2 of the bits outside the mask flipped ("near") and with h + 1 or up to radius - h ("far")
    to whoever arrives at the same value. A near one and any other there are at most radius bits apart, so all hang on
    one near one; a far pair alone is no link. The rows grow with the bucket, no pair is missed, none is false.
    """
    masks = covering_masks(radius)
    table = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(masks)])
    keyed = fps.select("fp", F.explode(table).alias("k")).select("fp", "k.t", "k.key")
    counts = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = stored(keyed.join(counts, ["t", "key"]), "buckets")
    small = shared.filter(F.col("n") <= pairwise)
    other = small.select("t", "key", F.col("fp").alias("b"))
    near = small.select("t", "key", F.col("fp").alias("a")).join(other, ["t", "key"]).filter("a < b").filter(
        F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    ).select("a", "b").distinct()
    large = shared.filter(F.col("n") > pairwise)
    if large.isEmpty():
        return near
    return near.union(_large_bucket_links(large, masks, radius))


def _large_bucket_links(large: DataFrame, masks: list[int], radius: int) -> DataFrame:
    reach = radius - radius // 2
    # At most 466 rows a table for radius 3: fixed by the radius, whatever the data.
    balls = large.sparkSession.createDataFrame(
        [
            (t, n, _signed(sum(bits)))
            for t, mask in enumerate(masks)
            for n in range(reach + 1)
            for bits in combinations([1 << i for i in range(64) if not mask >> i & 1], n)
        ],
        "t int, flips int, x bigint",
    )
    sent = large.join(F.broadcast(balls), "t").select(
        "t", "key", "fp", "flips", F.col("fp").bitwiseXOR(F.col("x")).alias("value")
    )
    centre = sent.filter(F.col("flips") <= radius // 2).groupBy("t", "key", "value").agg(F.min("fp").alias("b"))
    return sent.join(centre, ["t", "key", "value"]).filter("fp <> b").select(F.col("fp").alias("a"), "b").distinct()


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """`<id>, fp, component_id` for each document: the smallest id reachable over links of `radius` or fewer bits.

    Equal fingerprints are one class, joined to the links by its smallest id; null ids are never a component's id,
    unless a class has no other. Repeated rows get the same answer each. Empty in, empty out.
    """
    fps = stored(fingerprints(docs, id_col, text_col), "fingerprints")
    classes = stored(fps.groupBy("fp").agg(F.min(id_col).alias("_least")), "classes")
    found = components(links(classes.select("fp"), radius))
    grouped = classes.join(found.select(F.col("id").alias("fp"), "component"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    least = grouped.groupBy("component").agg(F.min("_least").alias("component_id"))
    named = grouped.join(least, "component").select("fp", "component_id")
    return fps.join(named, "fp").select(id_col, "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """Documents without those of a group but its smallest id; columns and row values unchanged.

    Rows that repeat the kept id stay as they are.
    """
    groups = simhash_groups(docs, id_col, text_col, radius)
    gone = groups.filter(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("_gone")).distinct()
    return docs.join(gone, F.col(id_col).cast("bigint") == F.col("_gone"), "left_anti")
