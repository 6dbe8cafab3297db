"""Reading and writing of the planning files."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def scratch(spark: SparkSession) -> str:
    """The folder that all executors share (``spark.checkpoint.dir``). On one machine a new local one is set where that
    is unset; on a cluster that is an error, because executors would write to their own disks."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="fathom-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back: later steps start from the files, also after executors
    are lost."""
    path = f"{scratch(df.sparkSession)}/fathom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_csv(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None, schema: StructType | str | None = None, lenient: bool = False) -> DataFrame:
    """One or many CSV files with a header. Only the listed columns are kept, and a missing one is an error; without a
    schema, types are inferred; lenient reading turns unreadable fields into nulls."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE" if lenient or schema is None else "FAILFAST")
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True).option("samplingRatio", 0.1)
    df = reader.csv(list(paths) if not isinstance(paths, str) else paths)
    if columns is None:
        return df
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return df.select(*[F.col(f"`{c}`") for c in columns])


def stacked(frames: Sequence[DataFrame], as_text: bool = False) -> DataFrame:
    """All rows by column name; absent columns are null. ``as_text`` casts everything to text first."""
    if as_text:
        frames = [f.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in f.columns]) for f in frames]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def sampled(df: DataFrame, rows: int | None) -> DataFrame:
    return df if rows is None else df.limit(rows)


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A sheet of a workbook. The container has no workbook reader, so sheets come as CSV or Parquet files, one each."""
    return spark.read.parquet(path) if path.endswith(".parquet") else read_csv(spark, path)


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(variant, canonical) from {canonical: {variants: [...]}}; a canonical name is its own variant."""
    kind = "map<string, struct<variants: array<string>>>"
    text = spark.read.text(path, wholetext=True)
    entry = text.select(F.explode(F.from_json("value", kind)).alias("canonical", "v"))
    return entry.select(F.explode(F.array_union(F.coalesce("v.variants", F.array().cast("array<string>")), F.array("canonical"))).alias("variant"), "canonical")


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    """(market, cluster, members) from {market, clusters: [[...]]}; clusters are numbered from 1."""
    raw = spark.read.schema("market string, clusters array<array<string>>").json(path, multiLine=True)
    return raw.select("market", F.posexplode("clusters").alias("i", "members")).select("market", (F.col("i") + 1).alias("cluster"), "members")


def read_itemsets(spark: SparkSession, path: str) -> DataFrame:
    """(skills, skill_count, true_demand) from a list of objects, the cell split into its skills."""
    raw = spark.read.schema("skills string, skill_count int, true_demand long").json(path, multiLine=True)
    return raw.withColumn("skills", F.split("skills", r",\s*"))


def read_names(spark: SparkSession, path: str, key: str) -> list[str]:
    """A short list of names, such as the eliminated skills."""
    row = spark.read.schema(f"`{key}` array<string>").json(path, multiLine=True).first()
    return list(row[0] or []) if row else []


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("quoteAll", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_sheets(sheets: Mapping[str, DataFrame], folder: str) -> None:
    """One table for each sheet."""
    for name, df in sheets.items():
        df.write.mode("overwrite").parquet(f"{folder}/{token(name)}.parquet")


def write_groups(df: DataFrame, path: str, keys: Sequence[str], split: str) -> DataFrame:
    """Files by group and split, and the manifest (keys, split, rows)."""
    df.repartition(*keys).write.mode("overwrite").partitionBy(*keys, split).parquet(path)
    return df.groupBy(*keys, split).agg(F.count("*").alias("rows"))


def token(name: str) -> str:
    """A name as part of a file name."""
    return re.sub(r"[^a-z0-9]+", "_", name.lower()).strip("_")


def abbreviation(name: str) -> str:
    """The first letters of the words of a practice area."""
    return "".join(w[0] for w in re.findall(r"[A-Za-z]+", name) if w.lower() not in {"and", "of", "the"}).upper()


def year_range(names: Sequence[str]) -> str:
    years = sorted({int(y) for n in names for y in re.findall(r"(?<!\d)(20\d{2})(?!\d)", n)})
    return "" if not years else str(years[0]) if len(years) == 1 else f"{years[0]}-{years[-1]}"
