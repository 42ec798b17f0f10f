"""Document fingerprints of spot signatures: chains of content words that follow common words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillstream.llm.tables import stored

# Common words of English, French, German and Spanish that anchor a chain.
ANCHORS = [
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that", "the", "to",
    "was", "were", "with", "de", "des", "du", "elle", "en", "est", "et", "il", "la", "le", "les", "par", "pour", "que", "qui",
    "un", "une", "das", "dem", "den", "der", "die", "ein", "eine", "ist", "mit", "nicht", "sich", "und", "von", "zu", "con",
    "del", "el", "los", "por", "se", "su",
]
CHAIN = 2
SIMILAR = 0.8


def signatures(text: Column, chain: int = CHAIN) -> Column:
    """Sorted distinct hashes of a text's chains.

    Words are runs of letters and digits, lower-cased. A chain is an anchor with the next `chain` other words, however
    far they are, fewer at the end of a text. A text without an anchor has a chain at each word instead, so that every
    text with a word has signatures; null texts and texts without words have none.
    """
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(F.array(words), lambda ws: _hashed_chains(ws, chain))[0]


def _hashed_chains(words: Column, chain: int) -> Column:
    # Content words keep their text, anchors become null, once for a text
    marked = F.transform(words, lambda w: F.when(~w.isin(ANCHORS), w))

    def chains(pair: Column) -> Column:
        marks, content = pair["marks"], pair["content"]
        places = F.sequence(F.lit(1), F.size(words))
        spots = F.filter(places, lambda i: F.get(marks, i - 1).isNull())
        # Before the k-th anchor (from 0), at place i (from 1), stand i - 1 - k content words
        anchored = F.transform(spots, lambda i, k: F.xxhash64(
            F.get(words, i - 1), F.array_join(F.slice(content, i - k, F.lit(chain)), " ")
        ))
        plain = F.transform(places, lambda i: F.xxhash64(F.lit(""), F.array_join(F.slice(words, i, F.lit(chain)), " ")))
        return F.when(F.size(words) == 0, F.array().cast("array<bigint>")).when(F.size(spots) > 0, anchored).otherwise(plain)

    both = F.transform(F.array(marked), lambda m: F.struct(m.alias("marks"), F.array_compact(m).alias("content")))
    return F.array_sort(F.array_distinct(F.transform(both, chains)[0]))


def rendered(signs: Column) -> Column:
    """The fingerprint as text: each signature as 16 hex digits, in order."""
    return F.array_join(F.transform(signs, lambda s: F.lpad(F.lower(F.hex(s)), 16, "0")), "")


def likeness(a: Column, b: Column, at_least: float = 0.0) -> Column:
    """Jaccard likeness of two signature sets; two empty sets are alike.

    Sets whose lengths alone rule out `at_least` are not intersected and are 0.
    """
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    common = F.size(F.array_intersect(a, b))
    return (
        F.when(large == 0, F.lit(1.0))
        .when((small == 0) | (small < F.lit(at_least) * large), F.lit(0.0))
        .otherwise(common / (small + large - common))
    )


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """`<id>, text, next_text`: each text beside that of the next larger id; the largest is followed by the smallest.

    Ids are cut into ranges at ids that occur, so that no range depends on how they are spaced, and the document at
    a range's start is also sent to the range before it (the first one to the last). Texts are dealt out once. Ties
    among repeated ids go by text; null ids come last.
    """
    n = ranges or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    ).withColumn("_at", F.coalesce(F.col(id_col), F.lit(2**63 - 1)))
    shares = F.array(*[F.lit(k / n) for k in range(n)])
    found = rows.agg(F.percentile_approx("_at", shares, 10 * n)).first()[0] or []  # n numbers
    starts = sorted({rows.agg(F.min("_at")).first()[0], *found} - {None})
    if not starts:
        return rows.select(id_col, "text", F.lit("").alias("next_text"))
    marks = F.array(*[F.lit(s).cast("bigint") for s in starts])
    bucket = F.size(F.filter(marks, lambda s: s <= F.col("_at")))
    if len(starts) > 64:  # in two steps, so that a row looks at some 2 sqrt(n) starts
        step = int(len(starts) ** 0.5)
        firsts = F.array(*[F.lit(s).cast("bigint") for s in starts[::step]])
        group = F.size(F.filter(firsts, lambda s: s <= F.col("_at")))
        part = F.slice(marks, (group - 1) * step + 1, F.lit(step))
        bucket = (group - 1) * step + F.size(F.filter(part, lambda s: s <= F.col("_at")))
    placed = rows.withColumn("_range", bucket)
    opening = F.array_contains(marks, F.col("_at"))
    before = F.when(F.col("_range") > 1, F.col("_range") - 1).otherwise(F.lit(len(starts)))
    copies = F.array_compact(F.array(
        F.struct(F.col("_range").alias("r"), F.lit(0).alias("copy")),
        F.when(opening, F.struct(before.alias("r"), F.lit(1).alias("copy"))),
    ))
    sent = placed.select(id_col, "text", "_at", F.explode(copies).alias("_to"))
    order = Window.partitionBy("_to.r").orderBy("_to.copy", "_at", "text")
    return sent.withColumn("next_text", F.lead("text").over(order)).filter("_to.copy = 0").select(
        id_col, "text", F.coalesce("next_text", "text").alias("next_text")
    )


def edited(text: Column, other: Column) -> Column:
    """The text with its last floor(n/4) characters replaced by the first as many of the other, or all of it."""
    n = F.char_length(text)
    tail = F.call_function("div", n, F.lit(4)).cast("int")
    return F.concat(text.substr(F.lit(1), n - tail), other.substr(F.lit(1), tail))


def fingerprint_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`<id>, n_chars, edited, signs, edited_signs, next_signs` for each document and the text edited from it."""
    rows = with_next(docs, id_col, text_col)
    return rows.select(
        id_col, F.char_length("text").cast("bigint").alias("n_chars"), edited(F.col("text"), F.col("next_text")).alias("edited"),
        signatures(F.col("text")).alias("signs"),
        signatures(edited(F.col("text"), F.col("next_text"))).alias("edited_signs"),
        signatures(F.col("next_text")).alias("next_signs"),
    )


def classes(signed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """`class_id, n_docs, signs`: the documents with equal signatures (`<id>, signs`), named by the smallest id, and how
    many they are. Those without signatures are one class. Rows without an id are in none; a repeated row counts again."""
    known = signed.filter(F.col(id_col).isNotNull() & F.col("signs").isNotNull())
    return known.groupBy("signs").agg(F.min(id_col).alias("class_id"), F.count(F.lit(1)).alias("n_docs")).select(
        "class_id", "n_docs", "signs"
    )


def similar_documents(signed: DataFrame, id_col: str = "doc_id", at_least: float = SIMILAR) -> DataFrame:
    """`<id>, class_id, n_links` for each document with an id: its class of equal signatures, and how many other documents
    are as alike as `at_least`, those of its own class included. With the pairs of `similar_pairs`, which are of classes,
    this holds every link, without copies expanded into pairs."""
    sets = stored(classes(signed, id_col), "classes")
    pairs = similar_pairs(signed, id_col, at_least, sets)
    ends = pairs.select("a", "b").union(pairs.select("b", "a"))
    sizes = sets.select(F.col("class_id").alias("b"), "n_docs")
    linked = ends.join(sizes, "b").groupBy(F.col("a").alias("class_id")).agg(F.sum("n_docs").alias("_others"))
    links = (F.col("n_docs") - 1 + F.coalesce("_others", F.lit(0))).alias("n_links")
    counted = sets.join(linked, "class_id", "left").select("class_id", links, "signs")
    return signed.select(id_col, "signs").filter(F.col(id_col).isNotNull()).join(counted, "signs").select(id_col, "class_id", "n_links")


def similar_pairs(
    signed: DataFrame, id_col: str = "doc_id", at_least: float = SIMILAR, sets: DataFrame | None = None
) -> DataFrame:
    """`a, b, likeness` of classes of documents (`<id>, signs`) with a likeness of `at_least` or more, smaller id first.

    Equal sets are one class (`classes`, or `sets` if they are stored already) and pair through its smallest id. Classes are partitioned by set length: lengths from l to
    l / at_least are compared with l only. Within these, two sets so alike share one of the first
    n - ceil(at_least * n) + 1 signatures of each, in the order of rarity, so only rare ones are joined on, and
    candidates are pruned by where the shared one stands. Documents without signatures pair
    with no others. Each id is to have one set: rows repeated with another text are not told apart.
    """
    sets = stored(classes(signed, id_col), "classes") if sets is None else sets
    sets = sets.filter(F.size("signs") > 0).select(F.col("class_id").alias("id"), "signs")
    seen = sets.select(F.explode("signs").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("df"))
    ranked = sets.select("id", F.explode("signs").alias("s")).join(seen, "s").groupBy("id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("df", "s"))), lambda x: x["s"]).alias("rare")
    )
    n = F.size("rare")
    prefix = F.slice("rare", F.lit(1), (n - F.ceil(n * F.lit(at_least) - 1e-9) + 1).cast("int"))
    keyed = stored(ranked.select("id", n.alias("n"), F.posexplode(prefix).alias("i", "s")), "prefixes")
    b = keyed.select(F.col("id").alias("b"), F.col("n").alias("m"), F.col("i").alias("j"), "s")
    most = F.least(F.col("n") - F.col("i"), F.col("m") - F.col("j"))  # signatures that can still be shared
    pairs = keyed.withColumnRenamed("id", "a").join(b, "s").filter(
        (F.col("a") < F.col("b"))
        & (F.least("n", "m") >= F.lit(at_least) * F.greatest("n", "m"))
        & (most + F.least("i", "j") >= F.lit(at_least) / (1 + at_least) * (F.col("n") + F.col("m")) - 1e-9)
    ).select("a", "b").distinct()
    left = sets.select(F.col("id").alias("a"), F.col("signs").alias("_a"))
    right = sets.select(F.col("id").alias("b"), F.col("signs").alias("_b"))
    both = pairs.join(left, "a").join(right, "b")
    compared = both.select("a", "b", likeness(F.col("_a"), F.col("_b"), at_least).alias("likeness"))
    return compared.filter(F.col("likeness") >= at_least)
