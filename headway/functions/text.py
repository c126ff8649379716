"""Text helpers for payload fields."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def leading_number(text: Column) -> Column:
    """Digits at the start of a text as a double, else NULL (``"20 mph"`` is 20)."""
    return F.nullif(F.regexp_extract(text, r"^(\d+)", 1), F.lit("")).try_cast("double")


def flag(text: Column) -> Column:
    """Integer text to boolean; NULL when the text is not an integer."""
    return text.try_cast("int") != 0


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def text_or_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def strip(text: Column) -> Column:
    """Without white space at both ends (``trim`` only knows blanks)."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")
