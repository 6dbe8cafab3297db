"""Cleaning, filtering and correction of service-order rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Date patterns in the order in which they are tried.
DATE_PATTERNS = ("yyyy-M-d", "M-d-yyyy", "yyyy/M/d", "M/d/yyyy", "d-MMM-yyyy", "d-MMM-yy")
SHORT_DATE_PATTERNS = ("yyyy-M-d", "M/d/yyyy", "M-d-yyyy")


def drop_empty_columns(df: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Without the listed columns and those that hold nulls only (one aggregate over all columns finds them)."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    return df.drop(*[c for c in df.columns if not counts[c] or c in also])


def keep_values(df: DataFrame, allowed: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows whose value is allowed in every listed column; null never is."""
    return reduce(lambda d, c: d.filter(F.col(c).isin(list(allowed[c]))), allowed, df)


def relabel(df: DataFrame, column: str, drop: Sequence[str], names: Mapping[str, str]) -> DataFrame:
    """Without rows of dropped values (case does not count; null stays), the others renamed by a fixed mapping."""
    upper = F.upper(F.trim(column))
    kept = df.filter(F.col(column).isNull() | ~upper.isin([d.upper() for d in drop]))
    renamed = reduce(lambda e, kv: e.when(upper == kv[0].upper(), kv[1]), names.items(), F.when(F.lit(False), ""))
    return kept.withColumn(column, renamed.otherwise(F.col(column)))


def without_values(column: str, values: Sequence[str]) -> Column:
    """The column with listed values (case and outer space do not count) as null; rows stay."""
    return F.when(~F.lower(F.trim(column)).isin([v.lower() for v in values]), F.col(column))


def fact_rows(df: DataFrame, allowed: Mapping[str, Sequence[str]], reason: tuple[str, Sequence[str]], present: str, dates: tuple[str, str], years: tuple[int, int], known: tuple[str, DataFrame]) -> DataFrame:
    """Rows that may enter the fact table: values allowed in every listed column (upper case, trimmed), a reason that is
    null, NA or listed, a value in ``present``, no start before the submission (null submissions pass), a start in the
    years, and a key that the dimension (one column of the same name) knows."""
    for c, values in allowed.items():
        df = df.filter(F.upper(F.trim(c)).isin(list(values)))
    why, reasons = reason
    start, submitted = dates
    df = df.filter(F.col(why).isNull() | F.trim(why).isin(["NA", *reasons])).filter(F.col(present).isNotNull())
    df = year_between(df.filter(F.col(submitted).isNull() | (F.col(start) >= F.col(submitted))), start, *years)
    return df.join(known[1].select(known[0]).distinct(), known[0], "left_semi")


def matches(row: str | Column, wanted: Mapping[str, Sequence[str]]) -> Column:
    """Whether a map of texts has one of the wanted values under every key, whatever the case; a key that the row lacks
    passes."""
    m = F.col(row) if isinstance(row, str) else row
    each = [F.coalesce(F.lower(F.try_element_at(m, F.lit(k))).isin([v.lower() for v in values]), F.lit(True)) for k, values in wanted.items()]
    return reduce(lambda a, b: a & b, each, F.lit(True))


def parse_date(column: str | Column, patterns: Sequence[str] = DATE_PATTERNS) -> Column:
    """The first pattern that reads the text gives the date; null if none does."""
    text = F.trim(F.col(column) if isinstance(column, str) else column)
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(p)).cast("date") for p in patterns])


def year_between(df: DataFrame, column: str, first: int, last: int) -> DataFrame:
    """As a range of dates, so that the scan can skip files."""
    return df.filter(F.col(column).between(F.make_date(F.lit(first), F.lit(1), F.lit(1)), F.make_date(F.lit(last), F.lit(12), F.lit(31))))


def chronological(df: DataFrame, start: str, submitted: str) -> DataFrame:
    return df.filter(F.col(start) >= F.col(submitted))


def null_audit(df: DataFrame) -> DataFrame:
    """(column, nulls) for each column, from one pass."""
    one = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("nulls")) for c in df.columns])).alias("x")).select("x.*")


def corrected_by_lookup(df: DataFrame, lookup: DataFrame, key: str, target: str, only: Column) -> DataFrame:
    """``target`` from a lookup (key, value) by trimmed lower-case key, where ``only`` holds and the key is known."""
    small = lookup.select(F.lower(F.trim("key")).alias("_k"), F.col("value").alias("_v")).groupBy("_k").agg(F.min("_v").alias("_v"))
    joined = df.withColumn("_k", F.lower(F.trim(key))).join(small, "_k", "left")
    return joined.withColumn(target, F.when(only & F.col("_v").isNotNull(), F.col("_v")).otherwise(F.col(target))).drop("_k", "_v")


def remapped(df: DataFrame, column: str, mapping: Mapping[str, str], where: Column, dropped: Sequence[str]) -> DataFrame:
    """``column`` renamed by the mapping where a predicate holds; rows whose result is dropped go."""
    table = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]) if mapping else None
    new = F.when(where, F.coalesce(F.try_element_at(table, F.col(column)), F.col(column))).otherwise(F.col(column)) if mapping else F.col(column)
    return df.withColumn(column, new).filter(F.col(column).isNull() | ~F.col(column).isin(list(dropped)))


def rewritten(df: DataFrame, column: str, rules: Sequence[tuple[Column, Column | str | None]]) -> DataFrame:
    """Rules in order, each seeing what those before made; None drops the rows."""
    for where, to in rules:
        if to is None:
            df = df.filter(~F.coalesce(where, F.lit(False)))
        else:
            df = df.withColumn(column, F.when(where, to if isinstance(to, Column) else F.lit(to)).otherwise(F.col(column)))
    return df


def without_rare(df: DataFrame, market: str, category: str, year: str, overall: float, yearly: float) -> DataFrame:
    """Without categories whose share of their market's rows is under ``overall``, or under ``yearly`` in any year."""
    counts = df.groupBy(market, category, year).count()
    whole = counts.groupBy(market, category).agg(F.sum("count").alias("n"))
    totals = whole.groupBy(market).agg(F.sum("n").alias("t"))
    rare = whole.join(totals, market).filter(F.col("n") < overall * F.col("t")).select(market, category)
    by_year = counts.groupBy(market, year).agg(F.sum("count").alias("t"))
    rare_once = counts.join(by_year, [market, year]).filter(F.col("count") < yearly * F.col("t")).select(market, category)
    return df.join(rare.union(rare_once).distinct(), [market, category], "left_anti")


def incomplete(df: DataFrame, market: str, category: str, year: str) -> DataFrame:
    """(market, category, missing years) of categories that lack a year which their market has."""
    seen = df.groupBy(market, category).agg(F.collect_set(year).alias("own"))
    there = df.groupBy(market).agg(F.collect_set(year).alias("all"))
    return seen.join(there, market).withColumn("missing", F.array_sort(F.array_except("all", "own"))).filter(F.size("missing") > 0).select(market, category, "missing")


def without_incomplete(df: DataFrame, market: str, category: str, year: str) -> DataFrame:
    return df.join(incomplete(df, market, category, year), [market, category], "left_anti")


def excluding_text(df: DataFrame, column: str, *parts: str) -> DataFrame:
    """Without rows whose text contains a part, whatever the case; null stays."""
    hit = reduce(lambda a, p: a | F.contains(F.upper(F.col(column)), F.lit(p.upper())), parts, F.lit(False))
    return df.filter(~F.coalesce(hit, F.lit(False)))


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows in which every group key is there and not blank."""
    return reduce(lambda d, k: d.filter(F.col(k).isNotNull() & (F.trim(F.col(k).cast("string")) != "")), keys, df)


def optional_filters(df: DataFrame, **wanted: str | None) -> DataFrame:
    """Equality without regard to case for each parameter that is set."""
    return reduce(lambda d, kv: d.filter(F.upper(kv[0]) == kv[1].upper()) if kv[1] is not None else d, wanted.items(), df)


@F.pandas_udf(StringType())
def _decoded(text: pd.Series) -> pd.Series:
    return text.map(unescape, na_action="ignore")


def unescaped(column: str | Column) -> Column:
    """All character references decoded, named and numeric ones; only texts with an ampersand leave the JVM's path."""
    c = F.col(column) if isinstance(column, str) else column
    return F.when(F.contains(c, F.lit("&")), _decoded(c)).otherwise(c)


def requirement_type(column: str) -> Column:
    c = F.lower(F.trim(column))
    return F.when(F.col(column).isNull(), "New Demand").when(c.startswith("backfill"), "Backfill").otherwise(F.col(column))


def delivery_mode(column: str) -> Column:
    c = F.lower(F.trim(column))
    return F.when(c.startswith("off"), "Offshore").when(c.startswith("on"), "Onsite").otherwise(None)


def observed(df: DataFrame, step: str) -> tuple[DataFrame, Observation]:
    """The frame with a row count that the caller's own action fills in."""
    seen = Observation(step)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def profile(df: DataFrame) -> DataFrame:
    """(column, type, nulls, share) for each column, most nulls first."""
    kinds = F.create_map(*[F.lit(x) for c, t in df.dtypes for x in (c, t)])
    total = df.agg(F.count("*").alias("_rows"))
    return null_audit(df).crossJoin(total).select("column", kinds[F.col("column")].alias("type"), "nulls", (F.col("nulls") / F.col("_rows")).alias("share")).orderBy(F.desc("nulls"), "column")
