"""Tokens and n-grams as array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a token is two or more letters, digits or underscores of any script.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def bigrams(tokens: Column) -> Column:
    pairs = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.zip_with(
        F.slice(tokens, F.lit(1), pairs),
        F.slice(tokens, F.lit(2), pairs),
        lambda left, right: F.concat_ws(" ", left, right),
    )


def terms(tokens: Column) -> Column:
    """Single words and pairs of neighbours."""
    return F.concat(tokens, bigrams(tokens))
