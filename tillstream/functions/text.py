"""Words for full-text matching: a run of letters or digits, or one Han character."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_WORD_CHAR = r"[\p{L}\p{N}&&[^\p{IsHan}]]"
_TOKEN = rf"\p{{IsHan}}|{_WORD_CHAR}+"


def tokens(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(_TOKEN), F.lit(0)))


def folded_tokens(text: Column) -> Column:
    """Words in one spelling for all that matching without case takes as equal: of each character the lower case of its
    upper case, as patterns compare them."""
    return tokens(F.translate(F.upper(text), "\u0130", "I"))


def any_token_pattern(query: str) -> Column:
    """Regex finding any query token as a whole word; null for a query without tokens.

    Made of literals only, so the optimizer folds it into one constant pattern and the scan
    runs a single regex per row, with no token array built.
    """
    words = tokens(F.lit(query))
    whole = F.transform(
        words,
        lambda w: F.when(w.rlike(r"\p{IsHan}"), w).otherwise(
            F.concat(F.lit(f"(?<!{_WORD_CHAR})"), w, F.lit(f"(?!{_WORD_CHAR})"))
        ),
    )
    return F.when(F.size(words) > 0, F.concat(F.lit("(?iu)("), F.array_join(whole, "|"), F.lit(")")))
