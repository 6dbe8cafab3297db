"""Joins with the conventions of the planning tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def plain(column: str) -> Column:
    """Keys are compared trimmed and in upper case."""
    return F.upper(F.trim(F.col(column).cast("string")))


def equal_allocation(left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Sums of the right side by key, shared equally among the left rows of that key (null where the right has none)."""
    k = [f"_k{i}" for i in range(len(keys))]
    l_keyed = left.withColumns({a: plain(b) for a, b in zip(k, keys, strict=True)})
    sizes = l_keyed.groupBy(*k).agg(F.count("*").alias("_size"))
    sums = right.groupBy(*[plain(b).alias(a) for a, b in zip(k, keys, strict=True)]).agg(*[F.sum(v).alias(v) for v in values])
    shares = sums.join(sizes, k).select(*k, *[(F.col(v) / F.col("_size")).alias(v) for v in values])
    return l_keyed.join(shares, k, "left").drop(*k)


def shared_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.select(*keys).intersect(right.select(*keys))


def group_size(df: DataFrame, keys: Sequence[str], into: str = "group_size") -> DataFrame:
    return df.join(df.groupBy(*keys).agg(F.count("*").alias(into)), list(keys))


def resolved(fact: DataFrame, dims: Mapping[str, tuple[DataFrame, Sequence[str], str]]) -> DataFrame:
    """Foreign keys of a star: for each name (dimension, fact columns against its columns in order, its id). A dimension
    whose first column may match by several names lists them as rows (see ``either_name``)."""
    for name, (dim, columns, key) in dims.items():
        cols = [c for c in dim.columns if c != key]
        small = dim.select(F.col(key).alias(name), *[plain(c).alias(f"_d{i}") for i, c in enumerate(cols)]).groupBy(*[f"_d{i}" for i in range(len(cols))]).agg(F.min(name).alias(name))
        on = reduce(lambda a, b: a & b, [plain(c) == F.col(f"_d{i}") for i, c in enumerate(columns)])
        fact = fact.join(small, on, "left").drop(*[f"_d{i}" for i in range(len(cols))])
    return fact


def either_name(dim: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """(key, name): one row for each name by which a dimension row is known, so that an OR becomes an equi-join."""
    return dim.select(key, F.explode(F.array(*[F.col(n).cast("string") for n in names])).alias("name")).filter("name is not null")


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """A join in which null keys are equal to each other."""
    r = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[f"_r_{k}"]) for k in keys])
    return left.join(r, on, how).drop(*[f"_r_{k}" for k in keys])


def against_prior(df: DataFrame, keys: Sequence[str], horizon: str, value: str) -> DataFrame:
    """The value of the horizon just before, if it is there."""
    w = Window.partitionBy(*keys).orderBy(horizon)
    before = F.when(F.lag(horizon).over(w) == F.col(horizon) - 1, F.lag(value).over(w))
    return df.withColumn("prior", before)


def compared(a: DataFrame, b: DataFrame, keys: Sequence[str], value: str, names: tuple[str, str]) -> DataFrame:
    """Both values of each key, the difference, and which of them are there."""
    x, y = a.select(*keys, F.col(value).alias(names[0])), b.select(*keys, F.col(value).alias(names[1]))
    out = x.join(y, list(keys), "full_outer")
    there = F.when(F.col(names[0]).isNull(), f"{names[1]} only").when(F.col(names[1]).isNull(), f"{names[0]} only").otherwise("both")
    return out.withColumn("difference", F.col(names[0]) - F.col(names[1])).withColumn("present", there)


def preferred(first: DataFrame, second: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of ``first`` and those of ``second`` whose key it lacks."""
    return first.unionByName(second.join(first.select(*keys).distinct(), list(keys), "left_anti"), allowMissingColumns=True)


def looked_up(df: DataFrame, table: DataFrame, keys: Sequence[str], value: str, default: float | int = 0) -> DataFrame:
    """The table's value at the row's keys (a point in time among them), or the default."""
    return df.join(table.select(*keys, value), list(keys), "left").withColumn(value, F.coalesce(value, F.lit(default)))
