"""Lists written as text, such as `Auto Loan, Student Loan, and Payday Loan`.

Two tokenizers exist on purpose. `list_tokens` feeds the features: it drops one leading `and ` of a
token and keeps the case. `loose_tokens` feeds the profile: it drops `and ` anywhere and lower-cases.
Both work on the whole text before the split, so no lambda keeps the projection out of codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def list_tokens(value: Column) -> Column:
    """Tokens between commas, spaces around them and one leading `and ` removed; null has one empty token."""
    right_trimmed = F.regexp_replace(F.coalesce(value, F.lit("")), r" +(?=,|\z)", "")
    return F.split(F.regexp_replace(right_trimmed, "(,|^) *(?:and )?", "$1"), ",")


def loose_tokens(value: Column) -> Column:
    """Tokens between commas with every `and ` removed, white space trimmed, in lower case; null stays null."""
    without_and = F.lower(F.replace(value, F.lit("and "), F.lit("")))
    return F.split(F.regexp_replace(without_and, r"^\s+|\s+(?=,|\z)|(?<=,)\s+", ""), ",")


def count_token(tokens: Column, token: str) -> Column:
    """How often the token occurs in the array."""
    return F.size(tokens) - F.size(F.array_remove(tokens, token))


def safe_name(value: str) -> str:
    """A category value as part of a column name."""
    return value.translate(str.maketrans({" ": "_", "-": "_", ",": None}))
