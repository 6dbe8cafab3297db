"""Calendar expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_index(date: Column | str) -> Column:
    """Months since year 0: differences are whole calendar months."""
    return F.year(date) * 12 + F.month(date) - 1


def month_start(index: Column | str) -> Column:
    i = F.col(index) if isinstance(index, str) else index
    return F.make_date(F.floor(i / 12).cast("int"), (F.pmod(i, F.lit(12)) + 1).cast("int"), F.lit(1))


def fiscal_month(date: Column | str, first: int = 4) -> Column:
    """1 for the first month of the fiscal year."""
    return F.pmod(F.month(date) - first, F.lit(12)) + 1


def is_quarter_end(month: Column | str) -> Column:
    return (F.pmod(F.col(month) if isinstance(month, str) else month, F.lit(3)) == 0).cast("int")


def monday_weekday(date: Column | str) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(date) + 1


def cyclic(month: Column | str) -> tuple[Column, Column]:
    """Sine and cosine of the month's place in the year."""
    angle = (F.col(month) if isinstance(month, str) else month) * (2 * math.pi / 12)
    return F.sin(angle), F.cos(angle)


#: Month names, by their first three letters.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def month_number(name: Column | str) -> Column:
    """1 to 12 for a month's name or number; null if it is neither."""
    text = F.lower(F.trim(name))
    names = F.create_map(*[F.lit(x) for k, m in enumerate(MONTHS, 1) for x in (m, k)])
    return F.coalesce(text.try_cast("int"), F.try_element_at(names, F.substring(text, 1, 3)))


def month_of_column(name: str) -> tuple[int, int, str] | None:
    """(year, month, kind) of a column named like Mon-YY_kind."""
    import re

    m = re.fullmatch(r"([A-Za-z]{3})-(\d{2})_(\w+)", name)
    return (2000 + int(m[2]), MONTHS.index(m[1].lower()) + 1, m[3]) if m and m[1].lower() in MONTHS else None
