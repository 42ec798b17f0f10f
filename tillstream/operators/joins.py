"""Lookups of a fact's keys in tables with one row per key."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

# A dimension of up to this many rows is broadcast; its rows are a handful of short fields.
MAX_BROADCAST_ROWS = 100_000


def checked_left_join(fact: DataFrame, dim: DataFrame, key: str, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast `dim` when a count shows it small enough, else shuffle both sides by key.

    In a shuffled left join adaptive execution splits the fact side of every skewed partition, for any number of hot
    keys (tested), so keys are not salted.
    """
    return fact.join(F.broadcast(dim) if dim.count() <= max_broadcast_rows else dim, key, "left")


def checked_semi_join(rows: DataFrame, keys: DataFrame, key: Column, name: str, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Rows whose `key` is in the column `name` of `keys`, one row each; broadcast when a count shows them few."""
    few = keys.limit(max_broadcast_rows + 1).count() <= max_broadcast_rows
    return rows.withColumn(name, key).join(F.broadcast(keys) if few else keys, name, "left_semi").drop(name)


# Bits of a Bloom filter: 128 KB, whatever the number of keys. With very many keys it lets more pass, never less.
BLOOM_BITS = 1 << 20
_HASHES = 4


def bloom_filter(keys: DataFrame, column: str, bits: int = BLOOM_BITS) -> Callable[[Column], Column]:
    """A condition that is true of every key of the column, as text, and of few others: 2 % at 8 bits a key.

    Bits are set by hashes in the tasks and put together map-side, 64 to a row; at most `bits` of them pass through the
    driver. Null keys are not in it.
    """
    low = F.lit((1 << 31) - 1)

    def spots(key: Column) -> list[Column]:
        first, second = F.xxhash64(key).bitwiseAND(low), F.xxhash64(F.lit(7), key).bitwiseAND(low)
        return [F.pmod(first + second * F.lit(k), F.lit(bits)) for k in range(_HASHES)]

    text = F.col(column).cast("string")
    spread = keys.filter(text.isNotNull()).select(F.explode(F.array(*spots(text))).alias("at"))
    word, bit = F.call_function("div", F.col("at"), F.lit(64)), F.pmod(F.col("at"), F.lit(64)).cast("int")
    set_bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    words = dict(spread.groupBy(word.alias("w")).agg(F.bit_or(set_bit)).collect())
    filled = F.split(F.lit(",".join(str(words.get(w, 0)) for w in range(-(-bits // 64)))), ",").cast("array<bigint>")

    def might_hold(key: Column) -> Column:
        hits = [
            F.getbit(F.get(filled, F.call_function("div", at, F.lit(64)).cast("int")), F.pmod(at, F.lit(64)).cast("int")) == 1
            for at in spots(key.cast("string"))
        ]
        return reduce(and_, hits)

    return might_hold


def matching_rows(store: DataFrame, batch: DataFrame, store_key: str, batch_key: str) -> DataFrame:
    """Rows of the store, keyed by text, whose key occurs in the batch, in one plan.

    Distinct combines map-side; the few keys of a small batch are broadcast by the planner, so the store is scanned in place.
    """
    keys = batch.select(F.col(batch_key).cast("string").alias(store_key)).distinct()
    return store.join(keys, store_key, "left_semi")


def in_list_lookup(store: DataFrame, batch: DataFrame, store_key: str, batch_key: str) -> DataFrame:
    """The same in two steps, for a store much larger than the batch: a Bloom filter of the batch's keys drops most other
    rows in the scan of the store, and what it lets pass is joined exactly."""
    might_hold = bloom_filter(batch, batch_key)
    return matching_rows(store.filter(might_hold(F.col(store_key))), batch, store_key, batch_key)
