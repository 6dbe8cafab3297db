"""Fill-in-the-middle samples: a text's units are cut twice and the three parts put in another order.

A unit is white space with what follows it. Units are rows: their lengths are summed by a window in the order of their
ordinals, each text's two cuts meet the sums by ordinal, and the offsets found that way cut the text by substring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
MARKS = ("<P>", "<S>", "<M>")


def _draw(name: Column, seed: int, k: int) -> Column:
    """The k-th (from 0) 32-bit number of the digest of ``seed:name``; a null name is an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(name.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def _all(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(UNIT), F.lit(0))


def transform(docs: DataFrame, seed: int = 42, rate: int = 50, suffix_first: int = 80, marks: tuple[str, str, str] = MARKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output for each row.

    ``rate`` in a hundred texts are cut, of those ``suffix_first`` in a hundred take the form spm and the others psm.
    A null text counts as empty. Empty texts and those that contain a mark stay plain, with null offsets. A null id
    draws like an empty one. Rows that repeat give repeated rows; equal ids with different texts draw alike, each with
    its own units. A text of any length is handled whole; its units are rows of one window. Other columns are not read,
    whatever their names. An empty table gives no rows.

    Only texts that are cut shuffle, once, by id and digest; windows, both joins and the grouping keep that
    partitioning, and the texts' exchange serves all of them. Joins are merged where the rows lie; nothing is broadcast.
    """
    if any(x[:1] != marks[0][:1] or x[:1] in x[1:] for mark in marks for x in [mark or "?"]):
        raise ValueError("marks begin with one character that stands nowhere else in them")
    p, s, m = map(F.lit, marks)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    plain = F.col("text") == ""
    for mark in marks:
        plain = plain | F.contains("text", F.lit(mark))
    plain = plain | (_draw(F.col("doc_id"), seed, 2) % 100 >= rate)

    none = F.lit(None).cast("long")
    kept = docs.filter(plain).select("doc_id", F.regexp_count("text", F.lit(UNIT)).cast("long").alias("n"), F.lit("plain").alias("form"), none.alias("prefix_chars"), none.alias("middle_chars"), F.col("text").alias("output"))

    # the key is one column, so that every join asks for the partitioning that is there
    texts = docs.filter(~plain).select(F.struct("doc_id", F.unhex(F.md5("text")).alias("digest")).alias("key"), "text").repartition("key")

    def cuts(n: Column) -> list[Column]:
        a, b = (_draw(F.col("key.doc_id"), seed, k) % (n + 1) for k in (0, 1))
        return [F.least(a, b).alias("first"), F.greatest(a, b).alias("second")]

    counted = texts.select("key", F.regexp_count("text", F.lit(UNIT)).cast("long").alias("n"))
    requests = counted.select("key", "n", *cuts(F.col("n"))).distinct()
    found = texts.select("key", _all(F.col("text")).alias("all")).select("key", "all", *cuts(F.size("all").cast("long")))
    # ordinal 0 is the place before every unit; past the second cut nothing is asked; outer, because an inner explode
    # would put its own filter below the exchange, which then could not be shared
    lengths = F.concat(F.array(F.lit(0)), F.transform(F.slice("all", F.lit(1), F.col("second").cast("int")), F.char_length))
    units = found.select("key", lengths.alias("lengths")).withColumn("row", F.monotonically_increasing_id()).select("key", "row", F.posexplode_outer("lengths").alias("ordinal", "length"))
    upto = F.sum("length").over(Window.partitionBy("key", "row").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, 0))
    summed = units.select("key", "ordinal", upto.alias("upto"))

    asked = requests.alias("r").join(summed.alias("u").hint("merge"), (F.col("r.key") == F.col("u.key")) & ((F.col("u.ordinal") == F.col("r.first")) | (F.col("u.ordinal") == F.col("r.second"))))
    at = lambda cut: F.max(F.when(F.col("u.ordinal") == F.col(f"r.{cut}"), F.col("u.upto")))
    offsets = asked.groupBy("r.key").agg(F.max("r.n").alias("n"), at("first").alias("prefix_chars"), at("second").alias("end"))

    form = F.when(_draw(F.col("key.doc_id"), seed, 3) % 100 < suffix_first, "spm").otherwise("psm")
    cut = texts.join(offsets.hint("merge"), "key").select("key", "text", "n", "prefix_chars", "end", form.alias("form"))
    prefix = F.substr("text", F.lit(1), F.col("prefix_chars").cast("int"))
    middle = F.substr("text", (F.col("prefix_chars") + 1).cast("int"), (F.col("end") - F.col("prefix_chars")).cast("int"))
    suffix = F.substr("text", (F.col("end") + 1).cast("int"))
    output = F.when(F.col("form") == "spm", F.concat(s, suffix, p, prefix, m, middle)).otherwise(F.concat(p, prefix, s, suffix, m, middle))
    return kept.unionByName(cut.select(F.col("key.doc_id").alias("doc_id"), "n", "form", "prefix_chars", (F.col("end") - F.col("prefix_chars")).alias("middle_chars"), output.alias("output")))


def restore(out: DataFrame, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """The rows of ``transform`` with ``restored``, the text rebuilt from ``output`` and ``form`` alone.

    The first mark that follows each part ends it: no part holds a mark, and a part's end and a mark's beginning cannot
    make up another one, as marks begin with a character that stands nowhere else in them. A null output gives null."""
    p, s, m = marks
    out_ = F.col("output")

    def parts(opening: str, second: str) -> tuple[Column, Column, Column]:
        a = F.position(F.lit(second), out_, F.lit(1))
        b = F.position(F.lit(m), out_, a + len(second))
        head = F.substr(out_, F.lit(len(opening) + 1), a - len(opening) - 1)
        return head, F.substr(out_, a + len(second), b - a - len(second)), F.substr(out_, b + len(m))

    prefix, suffix, middle = parts(p, s)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(s, p)
    spm = F.concat(prefix, middle, suffix)
    return out.withColumn("restored", F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(out_))


def digests(docs: DataFrame) -> DataFrame:
    """``transform`` with digests of the output and of the text rebuilt from it in place of the texts."""
    return restore(transform(docs)).select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))
