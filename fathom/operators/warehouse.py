"""Warehouse changes as queries: each gives the table as it is after the change."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def upserted(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Column | None = None) -> DataFrame:
    """Rows by key, new ones in place of old; of several new rows of a key the last in ``order``. Null keys are equal."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(F.desc("_new"), *([order] if order is not None else []))
    return both.withColumn("_k", F.row_number().over(w)).filter("_k = 1").drop("_new", "_k")


def with_missing(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table and the new rows whose key it lacks, once each."""
    return old.unionByName(new.dropDuplicates(list(keys)).join(old.select(*keys), list(keys), "left_anti"), allowMissingColumns=True)


def updated(df: DataFrame, other: DataFrame, keys: Sequence[str], changes: Mapping[str, Column]) -> DataFrame:
    """Columns changed where the other side has the key; changes may use its columns."""
    there = other.withColumn("_there", F.lit(True))
    joined = df.join(there, list(keys), "left")
    new = {c: F.when(F.col("_there"), e).otherwise(df[c] if c in df.columns else None) for c, e in changes.items()}
    return joined.withColumns(new).select(*df.columns, *[c for c in changes if c not in df.columns])


def tagged(df: DataFrame, batch: str) -> DataFrame:
    return df.withColumn("batch_id", F.lit(batch))


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Writes only the partitions that ``df`` holds; others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def predictions_from_json(payload: DataFrame, column: str, dims: Mapping[str, tuple[DataFrame, Sequence[str], str]]) -> DataFrame:
    """Prediction rows from JSON arrays of objects, with foreign keys resolved."""
    from fathom.operators.match import resolved

    kind = "array<struct<bu:string,cluster:string,country:string,horizon:int,predicted:double>>"
    rows = payload.select(F.explode(F.from_json(column, kind)).alias("r")).select("r.*")
    return resolved(rows, dims)


def seeded(dim: DataFrame, rows: Sequence[tuple], schema: str, parents: Mapping[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """A dimension with seed rows that it lacks (by its first column); each name among ``parents`` (table, its name
    column, its id) becomes the parent's id."""
    seeds = dim.sparkSession.createDataFrame(list(rows), schema)
    for name, (table, by, key) in parents.items():
        seeds = seeds.join(table.select(F.col(by).alias(name), F.col(key).alias(f"{name}_id")), name, "left").drop(name)
    return with_missing(dim, seeds.select(*dim.columns), [dim.columns[0]])


def orchestrated(steps: Sequence[tuple[str, Callable[[], DataFrame]]], spark: SparkSession) -> DataFrame:
    """(position, step, status, rows_out) of steps run one after another; after a failed step the others are skipped.

    A step's rows are counted by its own job; this is a log of a few lines and no data pass through the driver."""
    log: list[tuple[int, str, str, int | None]] = []
    failed = False
    for k, (name, step) in enumerate(steps):
        if failed:
            log.append((k, name, "skipped", None))
            continue
        try:
            log.append((k, name, "completed", step().count()))
        except Exception as e:  # noqa: BLE001 - the log tells it
            failed = True
            log.append((k, name, f"failed: {type(e).__name__}", None))
    return spark.createDataFrame(log, "position int, step string, status string, rows_out long")
