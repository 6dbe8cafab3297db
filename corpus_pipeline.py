"""The corpus pipeline: toxicity, quality, near-duplicates, personal data, packing.

In every stage a null text counts as empty, whole texts are read however long, an empty table gives an empty result, and
all but the last stage carry further columns along, whatever their names. Stages do not alter rows that they keep, but for
the text (and ``n_chars``) in the stage of personal data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.llm import minhash, packing, pii, quality, toxicity
from fathom.llm._store import keep, table
from fathom.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity machine rejects go. Null and empty texts stay; repeated rows share one fate."""
    return toxicity.filter_rows(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality trees reject go. Null and empty texts are judged alike; repeated rows share one fate."""
    return quality.filter_rows(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document of smallest id stays: one row of it, where rows repeat."""
    return minhash.deduplicate(docs)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the words that disclose it are replaced; n_chars follows the text. Repeated rows change alike."""
    return pii.sanitise(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as pieces of sequences of 2048 tokens; an empty text is one piece of its closing id."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_duplicates", drop_copies),
    ("personal_data", hide_personal_data),
    ("packing", pack_sequences),
]

#: The stages rest on trained models and a tokenizer, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if k == 0 else keep(docs), sf_dir)
    return docs
