"""Bulk load of text files through a staging table: everything as text first, then types, rejects with reasons, and a
load that may be repeated."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.operators.clean import parse_date
from fathom.sources.files import stored


def stage(spark: SparkSession, path: str, columns: Sequence[str], batch: str, header: bool = True) -> DataFrame:
    """The lines of CSV files as text columns with ``batch`` and ``malformed``, the whole line where it does not have as
    many fields as there are columns. Empty fields are null. Stored, so that later steps see what was read once."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    read = spark.read.option("header", header).option("mode", "PERMISSIVE").option("enforceSchema", True).option("columnNameOfCorruptRecord", "malformed")
    return stored(read.schema(f"{schema}, malformed string").csv(path).withColumn("batch", F.lit(batch)))


def _typed(name: str, kind: str) -> Column:
    text = F.trim(F.col(f"`{name}`"))
    if kind == "date":
        return parse_date(text)
    return text if kind == "string" else text.try_cast(kind)


def convert(staged: DataFrame, types: Mapping[str, str], required: Sequence[str] = (), checks: Mapping[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """(loaded, rejected). loaded: the typed columns and the batch. rejected: the text columns, the batch, malformed and
    ``reasons``, every one that holds: malformed line; <column>: unreadable; <column>: missing; names of ``checks`` (over
    typed columns) that are not true. A row is in exactly one of both; repeated rows stay."""
    typed = staged.withColumns({f"_{c}": _typed(c, k) for c, k in types.items()})
    there = lambda c: F.trim(F.col(f"`{c}`")) != ""
    told = [F.when(F.col("malformed").isNotNull(), F.lit("malformed line"))]
    well = F.col("malformed").isNull()
    told += [F.when(well & there(c) & F.col(f"_{c}").isNull(), F.lit(f"{c}: unreadable")) for c, k in types.items() if k != "string"]
    told += [F.when(well & ~F.coalesce(there(c), F.lit(False)), F.lit(f"{c}: missing")) for c in required]
    told += [F.when(well & ~F.coalesce(rule, F.lit(True)), F.lit(name)) for name, rule in (checks or {}).items()]
    judged = stored(typed.withColumn("reasons", F.filter(F.array(*told), lambda x: x.isNotNull())))
    loaded = judged.filter(F.size("reasons") == 0).select(*[F.col(f"_{c}").alias(c) for c in types], "batch")
    return loaded, judged.filter(F.size("reasons") > 0).select(*staged.columns, "reasons")


def append(loaded: DataFrame, target: str) -> None:
    """The rows put into the target table by their batch. A batch that is loaded again replaces itself, so a replay adds
    no row twice; other batches are not touched."""
    loaded.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(target)
