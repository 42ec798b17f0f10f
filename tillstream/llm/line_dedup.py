"""Removal of lines that an earlier line equals or nearly equals, by a join of deletion neighbourhoods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillstream.llm.tables import join_checked, stored

# Lines from so many characters on have near ones: of a single character, any other is one edit away.
NEAR_CHARS = 2
_BLOCK = 32


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """`id, d1, no, line` of the lines that are not blank. `d1` tells texts apart that share an id."""
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text).alias("d1"), F.posexplode(F.split(text, "\n")).alias("no", "line")
    )
    return rows.filter("id IS NOT NULL").filter(F.col("line").rlike(r"[^\s]"))


def _key(line: Column) -> list[Column]:
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2")]


def half_keys(line: Column) -> Column:
    """Hashes of which two lines within one edit share at least one.

    One edit lies in the first or the second half of the shorter line, so the other half is the same in both; a line
    does not know whether it is the shorter one, and gives keys for both cases.
    """
    n = F.char_length(line)

    def halves(shorter: Column) -> list[Column]:
        cut = F.call_function("div", shorter, F.lit(2)).cast("int")
        back = (shorter - cut).cast("int")
        return [
            F.xxhash64(F.lit("a"), shorter, line.substr(F.lit(1), cut)),
            F.xxhash64(F.lit("b"), shorter, line.substr(n - back + 1, back)),
        ]

    return F.array(*halves(n), *halves(n - 1))


def edit_blocks(line: Column) -> Column:
    """The places where a line could differ from another by one edit, in blocks of 32: `b, start, taken, inside, last, alone`.

    Lines that differ inside one block only share its `b`, made from the longer one's length, the block's place, and
    hashes of all before and all after. A line takes part as the longer of two, or one as long (`taken` 1: a character
    of it is deleted), and as the shorter one (0). `alone`: the line has no other block, so that `b` rules nothing out.
    """
    n = F.char_length(line)

    def blocks(longer: Column, taken: int) -> Column:
        def around(block: Column) -> Column:
            start = block * _BLOCK
            before, after = line.substr(F.lit(1), start), line.substr(start + _BLOCK + taken, n)
            return F.struct(
                F.xxhash64(longer, start, F.xxhash64(before), F.xxhash64(after)).alias("b"), start.alias("start"),
                F.lit(taken).alias("taken"), line.substr(start + 1, F.lit(_BLOCK - 1 + taken)).alias("inside"),
                F.least(F.lit(_BLOCK - 1), longer - 1 - start).alias("last"), (longer <= _BLOCK).alias("alone"),
            )

        return F.transform(F.sequence(F.lit(0), F.call_function("div", longer - 1, F.lit(_BLOCK)).cast("int")), around)

    return F.concat(blocks(n, 1), blocks(n + 1, 0))


def block_variants(block: Column) -> Column:
    """`k, place`: the hashed deletion variants of a line at the places of one of its blocks, from 0 in the line.

    All lines that share a key differ in that place alone.
    """
    taken = block["taken"]
    return F.transform(F.sequence(F.lit(0), block["last"]), lambda q: F.struct(
        F.xxhash64(block["b"], q, block["inside"].substr(F.lit(1), q), block["inside"].substr(q + 1 + taken, F.lit(_BLOCK))).alias("k"),
        (block["start"] + q).alias("place"),
    ))


def deletion_keys(line: Column) -> Column:
    """`k, place`: all hashed variants of a line with one character less, and of the line as such a variant of a longer one."""
    return F.flatten(F.transform(edit_blocks(line), block_variants))


def one_edit_at(a: Column, b: Column, place: Column) -> Column:
    """Whether two different texts are one edit apart, made at the 0-based `place` of the longer one. Linear in length."""
    more = F.char_length(a) - F.char_length(b)
    far = F.char_length(a) + F.char_length(b)
    rest_a = a.substr(place + F.when(more >= 0, 2).otherwise(1), far)
    rest_b = b.substr(place + F.when(more <= 0, 2).otherwise(1), far)
    return more.between(-1, 1) & (a.substr(F.lit(1), place) == b.substr(F.lit(1), place)) & (rest_a == rest_b)


def near_lines(lines: DataFrame) -> DataFrame:
    """`h1, h2` of the lines (`id, no, line, h1, h2`) of which an earlier other line is one edit away.

    1. Lines that share no half with another line have none near, and stop here: two numbers a key are shuffled.
    2. The rest are one line per distinct text, numbered by their earliest place. Blocks of a line whose surroundings no
       other line has hold no edit, and stop here: a 32nd of the variants.
    3. What is left emits its deletion variants. Of equal variants the earliest line, a minimum combined map-side, goes
       back to the others; no group is paired.
    4. That the line is one edit from that earliest line is verified on the texts.
    """
    keys = lines.select("h1", F.explode(half_keys(F.col("line"))).alias("k"))
    shared = keys.groupBy("k").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi")).filter("lo <> hi").select("k")
    shared = stored(shared, "halves")
    found = lines.select("h1", "h2", F.explode(half_keys(F.col("line"))).alias("k"))
    maybe = stored(join_checked(found, shared, ["k"], "left_semi").select("h1", "h2").distinct(), "maybe")
    texts = join_checked(lines, maybe, ["h1", "h2"], "left_semi").groupBy("h1", "h2").agg(
        F.min(F.struct("id", "no")).alias("at"), F.min("line").alias("line")
    )
    # numbered in order: parts of the sorted table follow each other
    texts = stored(texts.orderBy("at").withColumn("r", F.monotonically_increasing_id()), "lines")

    blocks = texts.select("r", F.explode(edit_blocks(F.col("line"))).alias("block"))
    spread = blocks.filter("NOT block.alone")
    doubtful = spread.groupBy(F.col("block.b").alias("b")).agg(F.min("r").alias("lo"), F.max("r").alias("hi")).filter("lo <> hi")
    doubtful = stored(doubtful.select("b"), "blocks")
    left = join_checked(spread.withColumn("b", F.col("block.b")), doubtful, ["b"], "left_semi").select("r", "block")
    left = stored(left.unionByName(blocks.filter("block.alone")), "around")
    variants = left.select("r", F.explode(block_variants(F.col("block"))).alias("v")).select("r", "v.k", "v.place")
    earliest = variants.groupBy("k").agg(F.min("r").alias("first"), F.max("r").alias("last")).filter("first <> last")
    hits = variants.join(earliest.select("k", "first"), "k").filter("first < r")
    pairs = hits.groupBy("r").agg(F.min(F.struct("first", "place")).alias("hit")).select("r", "hit.first", "hit.place")
    other = texts.select(F.col("r").alias("first"), F.col("at").alias("_at"), F.col("line").alias("_line"))
    both = pairs.join(texts, "r").join(other, "first").filter("_at < at")  # not the same place of two texts that share an id
    return both.filter(one_edit_at(F.col("line"), F.col("_line"), F.col("place"))).select("h1", "h2")


def repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", near_chars: int = NEAR_CHARS
) -> DataFrame:
    """`id, d1, no`: lines (numbered from 0) of which an equal or near line stands earlier, in order of (id, no).

    Lines are what `\\n` separates. Near is one character inserted, deleted or replaced, between lines that both have
    `near_chars` characters or more. Blank lines do not count. Every line is judged on the input: an earlier line counts
    whether or not it is removed itself.
    """
    lines = _lines(docs, id_col, text_col).select("id", "d1", "no", "line", *_key(F.col("line")))
    placed = stored(lines.select("id", "d1", "no", "h1", "h2"), "places")
    long = lines.filter(F.char_length("line") >= near_chars).select("id", "no", "line", "h1", "h2")
    near = near_lines(long).withColumn("near", F.lit(True))
    first = placed.groupBy("h1", "h2").agg(F.min(F.struct("id", "no")).alias("first"), F.count(F.lit(1)).alias("n"))
    classes = first.join(near, ["h1", "h2"], "left").filter("n > 1 OR near").select("h1", "h2", "first", "near")
    joined = join_checked(placed, stored(classes, "classes"), ["h1", "h2"])
    later = "id > first.id OR id = first.id AND no > first.no"
    return joined.filter(f"({later}) OR near").select("id", "d1", "no")


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", near_chars: int = NEAR_CHARS
) -> DataFrame:
    """The documents with their repeated lines taken out of the text; other columns and rows unchanged.

    See `repeated_lines`. A text that loses all its lines is empty; null texts stay null. Rows without an id keep their
    lines; rows that share an id and a text lose the same lines. `n_lines` and `n_removed` come as added columns
    `_n_lines`, `_n_removed`.
    """
    gone = repeated_lines(docs, id_col, text_col, near_chars)
    # A bit for each line, 64 to a word, so that a line is looked up in one step however many a text has.
    bits = gone.groupBy("id", "d1", F.call_function("div", "no", F.lit(64)).cast("int").alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("no") % 64)).alias("bits")
    )
    words = bits.groupBy("id", "d1").agg(F.map_from_entries(F.collect_list(F.struct("w", "bits"))).alias("words"))
    dense = F.transform(
        F.sequence(F.lit(0), F.array_max(F.map_keys("words"))), lambda w: F.coalesce(F.col("words")[w], F.lit(0).cast("bigint"))
    )
    marked = stored(words.select(F.col("id").alias("_id"), F.col("d1").alias("_d1"), dense.alias("_bits")), "removed")
    most = marked.agg(F.sum(F.size("_bits"))).first()[0] or 0
    text = F.col(text_col).cast("string")
    keyed = docs.withColumns({"_id": F.col(id_col).cast("bigint"), "_d1": F.xxhash64(text)})
    out = join_checked(keyed, marked, ["_id", "_d1"], "left", rows=most)
    lines = F.split(text, "\n")

    def kept(_, i):
        word = F.get("_bits", F.call_function("div", i, F.lit(64)).cast("int"))
        return F.coalesce(F.call_function("getbit", word, i % 64) == 0, F.lit(True))

    left = F.filter(lines, kept)
    return out.withColumns({
        "_n_lines": F.coalesce(F.size(lines), F.lit(0)).cast("bigint"),
        "_n_removed": F.coalesce(F.size(lines) - F.size(left), F.lit(0)).cast("bigint"),
        text_col: F.when(F.col("_bits").isNull(), text).otherwise(F.array_join(left, "\n")),
    }).select(*docs.columns, "_n_lines", "_n_removed")
