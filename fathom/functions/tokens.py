"""Skill cells to skills."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INNER = r"\(([^()]*)\)"


def flat_tokens(column: str | Column) -> Column:
    """Parts between commas, semicolons and colons outside parentheses; parentheses stay in their part."""
    text = F.col(column) if isinstance(column, str) else column
    parts = F.split(F.coalesce(text, F.lit("")), r"[,;:](?![^()]*\))")
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")


def tokens(column: str | Column, depth: int = 3) -> Column:
    """Parts outside parentheses, and those inside each pair (nested pairs to ``depth``), without repeats.

    ``Azure (Logic Apps, Functions)`` gives Azure, Logic Apps, Functions. An opening sign without its partner ends its
    part. A run of three web terms without commas is three parts."""
    text = F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))
    text = F.regexp_replace(text, r"(?i)\bhtml\s+css\s+javascript\b", "HTML, CSS, JavaScript")
    found = []
    rest = text
    for _ in range(depth):  # the innermost pairs first
        found.append(F.array_join(F.regexp_extract_all(rest, F.lit(_INNER), 1), ","))
        rest = F.regexp_replace(rest, _INNER, "")
    rest = F.regexp_replace(rest, r"[()]", ",")
    joined = F.concat_ws(",", rest, *reversed(found))
    parts = F.transform(F.split(joined, "[,;:]"), lambda x: F.trim(F.regexp_replace(x, r"\s+", " ")))
    return F.array_distinct(F.filter(parts, lambda x: x != ""))
