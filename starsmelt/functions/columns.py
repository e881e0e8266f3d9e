"""Column expressions shared by the operators. All run inside generated JVM code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from starsmelt.schemas import NULL_TOKENS


def null_token_to_null(column: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """NULL where the trimmed, lower-cased text is a token; else the original, untrimmed text.

    Bronze columns hold long JSON text, so the byte length is tested first: only text short enough
    to be a token is lower-cased. A character is at most 4 bytes of UTF-8 before lower-casing.
    """
    text = F.trim(column)
    longest = 4 * max(len(token) for token in tokens)
    is_token = (F.octet_length(text) <= longest) & F.lower(text).isin(*tokens)
    return F.when(is_token, None).otherwise(column)


def stable_round(column: Column, digits: int) -> Column:
    """Round half up, the same for any order of summation.

    A mean of doubles depends on the order of its rows in the last bits, which flips a plain
    ``round`` at a tie. Going through a decimal with 8 places removes those bits first.
    """
    return F.round(column.cast("decimal(28,8)"), digits).cast("double")
