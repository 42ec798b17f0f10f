"""Byte-level BPE: words are merged by recursive DuckDB queries inside the tasks, and decoded by ordered aggregation."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

# Bytes of the words of one query; a word of more than SHORT bytes is merged in parts of PART bytes, by the same query.
ROWS, SHORT, PART = 300_000, 255, 64
# Words whose ids a task remembers, so that common words are merged once. Others are merged in each block.
REMEMBERED = 400_000
# Characters encoded, and tokens decoded, at a time.
_BLOCK = 2_000_000

# A rank beyond all others, and the number of no pair of bytes.
_NEVER, _NONE = np.iinfo(np.int32).max, 1 << 16

# A row for each token of each word, keyed by word << 8 | position. Every step joins neighbours to the merge table,
# finds each word's pair of least rank, leftmost among equals, and puts the merged token in the place of the two: rank,
# place and the place of the second in one number, so that one minimum tells all. Words without a pair are done: they
# come out once more, marked, and drop out of the steps.
_MERGE = """
WITH RECURSIVE state(done, k, tok) AS (
  SELECT false, k, tok FROM given
  UNION ALL
  (WITH pairs AS MATERIALIZED (
     SELECT (s.k >> 8)::INTEGER AS w, s.k, s.tok, (m.rank::BIGINT << 16) | ((s.k & 255) << 8) | (s.j & 255) AS here
     FROM (SELECT k, tok, lead(tok) OVER place AS nxt, lead(k) OVER place AS j
           FROM state WHERE NOT done WINDOW place AS (ORDER BY k)) s
     LEFT JOIN merges m ON m.a = s.tok AND m.b = s.nxt AND s.j >> 8 = s.k >> 8),
   best AS (SELECT w, min(here) AS least FROM pairs GROUP BY w)
   SELECT least IS NULL, p.k, CASE WHEN here = least THEN (least >> 16)::INTEGER ELSE p.tok END
   FROM pairs p JOIN best ON best.w = p.w WHERE least IS NULL OR (p.k & 255) <> (least & 255))
)
SELECT k, tok FROM state WHERE done ORDER BY k
"""

# The same for one window too long for that, a few steps at a time: each step merges, from the left, every pair of the
# least rank that does not overlap the one before. No merge makes a pair of that or a lesser rank next to it.
_MERGE_LONG = """
WITH RECURSIVE state(step, i, tok) AS (
  SELECT 0, i, tok FROM given
  UNION ALL
  SELECT step + 1, row_number() OVER (ORDER BY i) - 1, CASE WHEN starts THEN rank ELSE tok END
  FROM (
    SELECT *, lag(starts, 1, false) OVER (ORDER BY i) AS gone
    FROM (SELECT step, i, tok, rank,
                 hit AND (i - coalesce(max(CASE WHEN hit THEN NULL ELSE i END)
                                       OVER (ORDER BY i ROWS UNBOUNDED PRECEDING), -1)) % 2 = 1 AS starts
          FROM (SELECT *, coalesce(rank = min(rank) OVER (), false) AS hit, min(rank) OVER () AS least
                FROM (SELECT step, i, tok, m.rank
                      FROM (SELECT step, i, tok, lead(tok) OVER (ORDER BY i) AS nxt FROM state WHERE step < 8) s
                      LEFT JOIN merges m ON m.a = s.tok AND m.b = s.nxt))
          WHERE least IS NOT NULL))
  WHERE NOT gone
)
SELECT step, i, tok FROM state WHERE step = (SELECT max(step) FROM state) ORDER BY i
"""

# Of all texts of a block at once, as one sort costs less than one for each text; they are cut by their lengths.
_DECODE = "SELECT string_agg(piece, '' ORDER BY i) AS text FROM given JOIN pieces USING (tok)"


class Vocabulary:
    """Tokens of a rank file (a line `<base64 of the token's bytes> <rank>` for each) and all pairs that merge into one.

    It is made once, on the driver, and goes along with the tasks: its size is the vocabulary's.
    """

    def __init__(self, ranks: bytes):
        self.ids = ids = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.bytes = np.array([ids[bytes([b])] for b in range(256)], np.int32)
        merges = [
            (ids[t[:k]], ids[t[k:]], r) for t, r in ids.items() for k in range(1, len(t)) if t[:k] in ids and t[k:] in ids
        ]
        self.merges = np.array(merges or np.zeros((0, 3)), np.int32).T.copy()
        self.first, self.over, self.under = self._byte_pairs()

    def _byte_pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each pair of bytes x << 8 | y, and last for none: its rank, if no pair with its token has that or a lesser
        one; the least rank of a token that ends in x with the byte y; that of the byte x with a token that begins with
        y, one more if that is the byte y."""
        size = max(self.ids.values(), default=0) + 1
        head, tail, long = np.zeros(size, np.int32), np.zeros(size, np.int32), np.zeros(size, bool)
        for token, number in self.ids.items():
            head[number], tail[number], long[number] = token[0], token[-1], len(token) > 1
        a, b, rank = self.merges
        later, first, over, under = (np.full(n, _NEVER, np.int32) for n in (size, _NONE + 1, _NONE + 1, _NONE + 1))
        np.minimum.at(later, a, rank)
        np.minimum.at(later, b, rank)
        pair = tail[a] << 8 | head[b]
        ends, begins = ~long[b], ~long[a]
        np.minimum.at(over, pair[ends], rank[ends])
        np.minimum.at(under, pair[begins], rank[begins] + ~long[b][begins])
        kept = ends & begins & (later[rank] > rank)
        first[pair[kept]] = rank[kept]
        return first, over, under


class Coder:
    """Encoder and decoder of one task; it holds a DuckDB database in memory until it is closed."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.pieces = regex.compile(pattern).findall
        self.ids, self.bytes = vocabulary.ids, vocabulary.bytes
        self.first, self.over, self.under = vocabulary.first, vocabulary.over, vocabulary.under
        self.tokens = {number: token for token, number in self.ids.items()}
        self.sizes = np.zeros(max(self.tokens, default=0) + 2, np.int64)  # bytes of each token; the last is of none
        self.sizes[list(self.tokens)] = [len(t) for t in self.tokens.values()]
        self.known: dict[str, bytes] = {}
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "250MB", "temp_directory": ""})
        a, b, rank = vocabulary.merges
        self._table("merges", a=a, b=b, rank=rank)
        # A byte b as the character U+0100 + b: DuckDB then joins any bytes as text.
        shown = ["".join(chr(256 + b) for b in t) for t in self.ids]
        self._table("pieces", tok=np.fromiter(self.ids.values(), np.int32), piece=pa.array(shown, pa.string()))

    def __enter__(self) -> Coder:
        return self

    def __exit__(self, *_) -> None:
        """Python workers outlive their tasks; what the task remembered goes with it."""
        self.con.close()
        self.known = {}
        pa.default_memory_pool().release_unused()

    def _table(self, name: str, **columns) -> None:
        self.con.register(f"given_{name}", pa.table(columns))
        self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM given_{name}")
        self.con.unregister(f"given_{name}")

    def _run(self, sql: str, **columns) -> pa.Table:
        self.con.register("given", pa.table(columns))
        out = self.con.sql(sql).to_arrow_table()
        self.con.unregister("given")
        return out

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word; a word that is a token is that token. Of any length, in time in proportion to it."""
        out: list[np.ndarray | None] = [np.array([self.ids[w]], np.int32) if w in self.ids else None for w in words]
        left = [k for k, ids in enumerate(out) if ids is None]
        short = [k for k in left if len(words[k]) <= SHORT]
        for k, ids in zip(short, self._merge_short([words[k] for k in short])):
            out[k] = ids
        long = [k for k in left if out[k] is None]
        if long:
            for k, ids in zip(long, self._merge_parts([words[k] for k in long])):
                out[k] = ids
        return out

    def _merge_short(self, words: list[bytes]) -> list[np.ndarray]:
        """Words of up to SHORT bytes, ROWS bytes a query."""
        out: list[np.ndarray] = []
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        query = np.cumsum(sizes) // ROWS
        for cut in np.split(np.arange(len(words)), np.flatnonzero(np.diff(query)) + 1):
            if not len(cut):
                continue
            lens = sizes[cut]
            ends = np.cumsum(lens)
            place = np.arange(ends[-1]) - np.repeat(ends - lens, lens)
            data = np.frombuffer(b"".join(words[cut[0]:cut[-1] + 1]), np.uint8)
            tok, kept = self._begin(data, ends)
            k = np.repeat(np.arange(len(cut)), lens) << 8 | place
            found = self._run(_MERGE, k=k[kept].astype(np.int32), tok=tok[kept])
            flat = found["tok"].to_numpy().astype(np.int32)
            cuts = np.searchsorted(found["k"].to_numpy() >> 8, np.arange(len(cut) + 1)).tolist()
            out += [flat[a:b] for a, b in zip(cuts, cuts[1:])]
        return out

    def _begin(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The token at each byte of the words that end at `ends`, and whether one begins there, after the merges of two
        bytes that are certain: of lesser rank than any that either byte can have with what its other neighbour may
        become, and than any of their token. Taken in any order, these change none of the others, so that the query,
        which takes one merge of a word a step, has the rest to do."""
        pairs = np.full(len(data) + 2, _NONE, np.int32)  # with the next byte, and none before the first
        pairs[1:-2] = data[:-1].astype(np.int32) << 8 | data[1:]
        pairs[ends] = _NONE
        rank = self.first[pairs[1:-1]]
        sure = rank < np.minimum(self.over[pairs[:-2]], self.under[pairs[2:]])
        kept = np.ones(len(data), bool)
        kept[1:] = ~sure[:-1]
        return np.where(sure, rank, self.bytes[data]), kept

    def _merge_parts(self, words: list[bytes]) -> list[np.ndarray]:
        """Words of any length: parts are merged by themselves and then joined in pairs, all words at once.

        Tokens are those of the whole word if and only if each two neighbours are the tokens of their two.
        """
        parts = [[w[k:k + PART] for k in range(0, len(w), PART)] for w in words]
        made = iter(self.merge([p for ps in parts for p in ps]))
        sides = [[next(made) for _ in ps] for ps in parts]
        while any(len(s) > 1 for s in sides):
            joined = iter(self._join([(s[k], s[k + 1]) for s in sides for k in range(0, len(s) - 1, 2)]))
            sides = [[next(joined) if k + 1 < len(s) else s[k] for k in range(0, len(s), 2)] for s in sides]
        return [s[0] for s in sides]

    def _join(self, pairs: list[tuple[np.ndarray, np.ndarray]], reach: int = 4) -> list[np.ndarray]:
        """The tokens of two neighbouring parts together: those around the border are merged anew, over twice as many
        tokens each time, until the outermost of them stay as they are, so that they go on with their neighbours."""
        out: list[np.ndarray | None] = [None] * len(pairs)
        left = list(range(len(pairs)))
        while left:
            around = [(pairs[k][0][-reach:], pairs[k][1][:reach]) for k in left]
            windows = [b"".join(self.tokens[t] for side in both for t in side.tolist()) for both in around]
            short = [w for w in windows if len(w) <= SHORT]
            found = iter(self.merge(short))
            again = []
            for k, (a, b), window in zip(left, around, windows):
                ids = next(found) if len(window) <= SHORT else self._merge_long(window)
                first, last = pairs[k]
                if (len(a) == len(first) or ids[0] == a[0]) and (len(b) == len(last) or ids[-1] == b[-1]):
                    out[k] = np.concatenate((first[:len(first) - len(a)], ids, last[len(b):]))
                else:
                    again.append(k)
            left, reach = again, reach * 2
        return out

    def _merge_long(self, word: bytes) -> np.ndarray:
        tokens, steps = self.bytes[np.frombuffer(word, np.uint8)], 1
        while steps:
            found = self._run(_MERGE_LONG, i=np.arange(len(tokens), dtype=np.int64), tok=tokens)
            tokens, steps = found["tok"].to_numpy().astype(np.int32), found["step"][0].as_py()
        return tokens

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        words = [self.pieces(t) for t in texts]
        known = self.known
        new = list(set().union(*words).difference(known))
        if new:
            made = {w: ids.tobytes() for w, ids in zip(new, self.merge([w.encode("utf-8", "surrogatepass") for w in new]))}
            if len(known) + len(made) <= REMEMBERED:
                known.update(made)
            else:
                known = {**{w: known[w] for ws in words for w in ws if w in known}, **made}
        return [np.frombuffer(b"".join(map(known.__getitem__, ws)), np.int32) for ws in words]

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        lens = [len(x) for x in ids]
        if not sum(lens):
            return [b""] * len(ids)
        tok = np.concatenate(ids).astype(np.int32)
        found = self._run(_DECODE, i=np.arange(len(tok), dtype=np.int32), tok=tok)["text"][0].as_py()
        data = (found or "").encode("utf-16-le")[::2]
        known = np.where((tok >= 0) & (tok < len(self.sizes)), tok, len(self.sizes) - 1)
        ends = np.concatenate(([0], np.cumsum(self.sizes[known])))[np.cumsum([0, *lens])].tolist()
        return [data[a:b] for a, b in zip(ends, ends[1:])]


def _blocks(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about `most` characters or ids each."""
    sizes = pc.utf8_length(column) if pa.types.is_string(column.type) else pc.list_value_length(column)
    block = np.cumsum(sizes.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)) // most
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(column)]
    yield from ((a, b) for a, b in zip(cuts, cuts[1:]) if a < b)


def encode(docs: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`<id>, ids`: the token ids of each whole text, every match of `pattern` encoded by itself, without special tokens.

    A row for each row; null and empty texts have no ids. No shuffle; `ranks` (the bytes of a rank file, bounded by the
    vocabulary) goes along with the tasks.
    """
    schema = pa.schema([(id_col, pa.int64()), ("ids", pa.list_(pa.int32()))])
    vocabulary = Vocabulary(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with Coder(vocabulary, pattern) as coder:
            for batch in batches:
                doc, texts = batch.columns
                for a, b in _blocks(texts, _BLOCK):
                    ids = coder.encode([t.as_py() or "" for t in texts[a:b]])
                    yield pa.RecordBatch.from_arrays([doc[a:b], _lists(ids)], schema=schema)

    rows = docs.select(F.col(id_col).cast("bigint").alias(id_col), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` bigint, ids array<int>")


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    cuts = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32)))


def decode(encoded: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """`<id>, ids, decoded`: the bytes that the ids stand for. Null ids: no bytes. An id that is no token adds nothing."""
    schema = pa.schema([(id_col, pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])
    vocabulary = Vocabulary(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with Coder(vocabulary, pattern) as coder:
            for batch in batches:
                doc, ids = batch.columns
                for a, b in _blocks(ids, _BLOCK // 8):
                    own = [x.values.to_numpy() if x.is_valid else np.zeros(0, np.int32) for x in ids[a:b]]
                    made = coder.decode(own)
                    yield pa.RecordBatch.from_arrays([doc[a:b], ids[a:b], pa.array(made, pa.binary())], schema=schema)

    return encoded.select(id_col, "ids").mapInArrow(run, f"`{id_col}` bigint, ids array<int>, decoded binary")
