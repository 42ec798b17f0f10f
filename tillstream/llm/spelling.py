"""Spelling variants: words one edit apart, found in a trie of letter-group counts, and the common form each goes by."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillstream.llm.tables import join_checked, stored

RUN = "[A-Za-zÀ-ÿ]"
MIN_CHARS, MIN_COUNT, RATIO, SLIPS = 7, 2, 10, 31
# The upper trie splits by the length and the counts of so many coarse groups of letters, as long as a node has more
# than LIGHT words; below that a node is one task's, whose trie has FINE groups and leaves of up to LEAF words.
COARSE, FINE = 8, 32
LIGHT, LEAF = 20_000, 64
_FLUSH = 200_000
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def slipped(doc_id: int | None, run: str, slips: int = SLIPS) -> str:
    """The run, without one of its characters if `slips` divides the CRC-32 of `<doc_id>:<run>`. A null id is empty."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    return run[: h % len(run)] + run[h % len(run) + 1:] if h % slips == 0 else run


def word_counts(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, slips: int = SLIPS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """`word, n`: words of at least `min_chars` characters and `min_count` occurrences in all documents.

    Words are maximal runs of letters up to U+00FF, A-Z lower-cased, after `slipped`. Null texts have none; repeated
    rows count each. Tasks add up words before the shuffle and hold some 200,000 of them at a time.
    """
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])
    runs = re.compile(f"{RUN}{{{min_chars},}}")  # shorter runs cannot become words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def flushed() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], schema=schema)
            total.clear()
            return batch

        for batch in batches:
            for doc, cell in zip(batch.column(0), batch.column(1)):
                text = (cell.as_py() or "").encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass")
                doc_id = doc.as_py()
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in Counter(runs.findall(text)).items():
                    if zlib.crc32(word.encode(), start) % slips == 0:
                        word = slipped(doc_id, word, slips)
                        if len(word) < min_chars:
                            continue
                    total[word] += n
                if len(total) >= _FLUSH:
                    yield flushed()
        yield flushed()

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    counted = rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= min_count)


def letter_counts(words: list[str], groups: int) -> np.ndarray:
    """A row for each word: how many of its characters are in each group, by code point modulo `groups`."""
    lens = np.fromiter(map(len, words), np.int64, len(words))
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    cells = np.repeat(np.arange(len(words)), lens) * groups + codes % groups
    return np.bincount(cells, minlength=len(words) * groups).reshape(len(words), groups).astype(np.int32)


def heavy_nodes(words: DataFrame, light: int = LIGHT) -> set[tuple[int, ...]]:
    """Nodes of the upper trie with more than `light` words, as (length, counts of the first groups).

    By number at most (words / light) * (COARSE + 1); counts of all nodes combine map-side.
    """
    schema = pa.schema([("node", pa.list_(pa.int32())), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[tuple[int, ...]] = Counter()

        def flushed() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(total.keys(), schema.field(0).type), pa.array(total.values(), pa.int64())], schema=schema)
            total.clear()
            return batch

        for batch in batches:
            texts = batch.column(0).to_pylist()
            for text, counts in zip(texts, letter_counts(texts, COARSE).tolist()):
                path = (len(text), *counts)
                total.update(path[:k] for k in range(1, COARSE + 1))  # the last level is never split
            if len(total) >= _FLUSH:
                yield flushed()
        yield flushed()

    nodes = words.select("word").mapInArrow(run, "node array<int>, n bigint").groupBy("node").agg(F.sum("n").alias("n"))
    return {tuple(r["node"]) for r in nodes.filter(F.col("n") > light).select("node").collect()}


def own_node(path: tuple[int, ...], heavy: set[tuple[int, ...]]) -> tuple[int, ...]:
    """Where the upper trie stops for a word of this path (length, counts of all groups)."""
    k = 1
    while path[:k] in heavy:
        k += 1
    return path[:k]


def reachable_nodes(path: tuple[int, ...], heavy: set[tuple[int, ...]]) -> list[tuple[int, ...]]:
    """The other nodes that hold words one edit away, depth first with a budget of one surplus and one deficit.

    Longer words are looked for by the shorter one, words as long in nodes of larger counts only: a pair is met once.
    """
    found = []

    def down(node: tuple[int, ...], surplus: int, deficit: int) -> None:
        if node not in heavy:
            found.append(node)
            return
        own = path[len(node)]
        down((*node, own), surplus, deficit)
        if surplus:
            down((*node, own + 1), surplus - 1, deficit)
        # as long as the word: the first difference is a surplus, so that the other node is the larger one
        if deficit and not surplus and own:
            down((*node, own - 1), surplus, deficit - 1)

    down(path[:1], 1, 1)
    down((path[0] + 1,), 1, 0)
    here = own_node(path, heavy)
    return [node for node in found if node != here]


def near_pairs(queries: list[str], words: list[str], leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """Places (in `queries`, in `words`) of all pairs one edit apart. `words` are equally long, queries as long or one shorter.

    The words are arranged by successive counts of letter groups, most varied first. All queries go down together,
    depth first; each has a budget of one letter too many and, if it is as long, one too few, and drops out where it is
    spent. At a leaf whole count vectors are compared, and what is left is verified on the characters.
    """
    none = np.zeros(0, np.int64)
    if not queries or not words:
        return none, none
    q, w = letter_counts(queries, FINE), letter_counts(words, FINE)
    levels = np.argsort(-w.var(0), kind="stable")
    q, w = q[:, levels], w[:, levels]
    order = np.lexsort(w.T[::-1])
    w = w[order]
    same = np.fromiter((len(x) == len(words[0]) for x in queries), bool, len(queries))
    # Differences add up to the difference in length, so within the budget the squared distance is 0, 1 or 2 and beyond
    # it larger: a matrix product tells. Single precision is exact for all but very long words.
    kind = np.float32 if len(words[0]) < 2_000 else np.float64
    fq, fw = q.astype(kind), w.astype(kind)
    squares_q, squares_w = ((fq * fq).sum(1) - same - 1) / 2, (fw * fw).sum(1) / 2
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def compare(low: int, high: int, alive: np.ndarray) -> None:
        step = max(1, (1 << 20) // (high - low))
        for k in range(0, len(alive), step):
            part = alive[k:k + step]
            product = fq[part] @ fw[low:high].T
            product -= squares_w[low:high]
            hits = np.flatnonzero(product >= squares_q[part, None])
            found.append((part[hits // (high - low)], order[low + hits % (high - low)]))

    def down(low: int, high: int, level: int, alive: np.ndarray, surplus: np.ndarray, deficit: np.ndarray) -> None:
        if high - low <= leaf or len(alive) <= leaf // 8 or level == FINE:
            compare(low, high, alive)
            return
        column, own = w[low:high, level], q[alive, level]
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(column)) + 1, [high - low]))
        for a, b in zip(cuts[:-1], cuts[1:]):
            differ = column[a] - own
            on = np.flatnonzero((differ == 0) | (differ == 1) & surplus | (differ == -1) & deficit)
            if len(on):
                kept = differ[on]
                down(low + a, low + b, level + 1, alive[on], surplus[on] & (kept != 1), deficit[on] & (kept != -1))

    down(0, len(words), 0, np.arange(len(queries)), np.ones(len(queries), bool), same)
    if not found:
        return none, none
    a, b = (np.concatenate(side).astype(np.int64) for side in zip(*found))
    near = one_edit_apart(queries, words, a, b)
    return a[near], b[near]


def _codes(words: list[str], width: int, right: bool) -> np.ndarray:
    """A row of code points for each word, by its front or, reversed, by its back."""
    padded = [w[::-1].ljust(width, "\0") if right else w.ljust(width, "\0") for w in words]
    codes = np.frombuffer("".join(padded).encode("utf-32-le"), np.uint32).reshape(len(words), width)
    return codes.astype(np.uint8)  # letters up to U+00FF


def one_edit_apart(queries: list[str], words: list[str], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether pairs of different words differ by one character inserted, deleted or replaced: what they share at the
    front and at the back is then the shorter word, or all of it but one character."""
    if not len(a):
        return np.zeros(0, bool)
    width = max(map(len, words))
    lens_q, lens_w = (np.fromiter(map(len, x), np.int64, len(x)) for x in (queries, words))
    shared = np.zeros(len(a), np.int64)
    step = max(1, (1 << 20) // width)
    for right in (False, True):
        codes_q, codes_w = _codes(queries, width, right), _codes(words, width, right)
        for k in range(0, len(a), step):
            off = codes_q[a[k:k + step]] != codes_w[b[k:k + step]]
            shared[k:k + step] += np.where(off.any(1), off.argmax(1), width)
    short, apart = np.minimum(lens_q[a], lens_w[b]), np.abs(lens_q[a] - lens_w[b])
    # equal words share all of their width at either side
    return (apart <= 1) & (shared >= short - (apart == 0)) & (shared < 2 * width)


def _best(words: list[str], counts: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.Table:
    """For each word of the pairs, both ways: how many others, and the one of largest count, smallest among equals."""
    own, other = np.concatenate((a, b)), np.concatenate((b, a))
    used = sorted(set(other.tolist()), key=lambda k: words[k])
    rank = np.zeros(len(words), np.int64)
    rank[used] = np.arange(len(used))
    order = np.lexsort((rank[other], -counts[other], own))
    own, other = own[order], other[order]
    first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))) if len(own) else np.zeros(0, np.int64)
    sizes = np.diff(np.concatenate((first, [len(own)])))
    text = pa.array(words, pa.string())
    return pa.table({
        "word": text.take(pa.array(own[first])), "n_near": pa.array(sizes, pa.int64()),
        "best_n": pa.array(counts[other[first]], pa.int64()), "best": text.take(pa.array(other[first])),
    })


def near_words(words: DataFrame, light: int = LIGHT) -> DataFrame:
    """`word, n_near, best, best_n`: for words (`word, n`) with others one edit away, how many, and the most frequent.

    The upper trie is walked by every word by itself; a node's words, and those that look for words there, are one group
    of a bounded number of words, unless more than `light` words share their length and all coarse counts.
    """
    heavy = heavy_nodes(words, light)
    sent = pa.schema([("node", pa.string()), ("word", pa.string()), ("n", pa.int64()), ("own", pa.bool_())])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                texts, counts = (c.to_pylist() for c in batch.slice(at, 2_000).columns)
                rows = []
                for text, n, groups in zip(texts, counts, letter_counts(texts, COARSE).tolist()):
                    path = (len(text), *groups)
                    rows.append((_name(own_node(path, heavy)), text, n, True))
                    rows += [(_name(node), text, n, False) for node in reachable_nodes(path, heavy)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), sent)], schema=sent)

    def search(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        own = group.filter(group["own"])
        if not len(own):
            return _best([], np.zeros(0, np.int64), *[np.zeros(0, np.int64)] * 2)
        guests = group.filter(pa.compute.invert(group["own"]))
        here, there = own["word"].to_pylist(), guests["word"].to_pylist()
        a, b = near_pairs(here, here)
        once = a < b
        c, d = near_pairs(there, here)
        return _best(
            here + there, np.concatenate((own["n"].to_numpy(), guests["n"].to_numpy())),
            np.concatenate((a[once], c + len(here))), np.concatenate((b[once], d)),
        )

    placed = words.select("word", "n").mapInArrow(send, "node string, word string, n bigint, own boolean")
    found = placed.groupBy("node").applyInArrow(search, "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_b")).select(
        "word", "n_near", F.col("_b.word").alias("best"), (-F.col("_b.n")).alias("best_n")
    )


def _name(node: tuple[int, ...]) -> str:
    return ",".join(map(str, node))


def roots(forms: DataFrame, longest: int) -> DataFrame:
    """`word, root` of words with a form (`word, form`): the end of the chain of forms, of at most `longest` steps.

    Each round doubles the steps taken, so few joins do. Chains must not lead back.
    """
    reached = stored(forms.select("word", F.col("form").alias("root")), "forms")
    for _ in range(max(0, math.ceil(math.log2(max(1, longest))))):
        on = reached.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        reached = stored(join_checked(reached, on, ["root"], "left").select("word", F.coalesce("_next", "root").alias("root")), "roots")
    return reached


def spelling_forms(docs: DataFrame, ratio: int = RATIO, light: int = LIGHT, count: Callable[..., DataFrame] = word_counts, **settings) -> DataFrame:
    """`word, n, n_near, form, form_n, root` of every word that `word_counts` finds.

    Near words differ by one character inserted, deleted or replaced; `n_near` is their number. `form` is the near word
    of largest n, the smallest in code-point order among equals, if that n is at least `ratio` times the word's own,
    else null. `root` follows the forms to the last one and is the word itself if it has none. No words: no rows.
    """
    words = stored(count(docs, **settings), "words")
    near = near_words(words, light)
    joined = words.join(near, "word", "left")
    takes = F.col("best_n") >= ratio * F.col("n")
    judged = stored(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(takes, F.col("best")).alias("form"), F.when(takes, F.col("best_n")).alias("form_n"),
    ), "judged")
    formed = judged.filter(F.col("form").isNotNull())
    span = formed.agg(F.max("form_n").alias("most"), F.min("n").alias("least")).first()
    longest = 1 + int(math.log(max(1.0, (span["most"] or 1) / (span["least"] or 1)), ratio) + 1e-9)
    ends = roots(formed, longest)
    return join_checked(judged, ends, ["word"], "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )
