"""Words grouped with the spellings they are variants of: an even-partition pigeonhole join.

Two words that differ by one edit agree in one of the two halves of the shorter one: its first half begins the other, or
its second half ends the other. Every word is indexed by its two halves; every word probes the halves of words of its own
length and of one code point less, where the second half is shifted to the other's end. A pair of halves that too many
words share is split evenly again inside its open rest, by the same argument, until keys are small or one letter is open:
so no key holds all pairs of a large group, and no pair is lost."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathom.llm._store import keep

RUN = "[a-zÀ-ÿ]+"
#: Pairs of an indexed and a probing word that one key may hold before it is split.
PAIRS = 1 << 14


def words(docs: DataFrame, every: int = 199, shortest: int = 6, least: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): letter runs of whole texts with A-Z in lower case, of ``shortest`` code points and ``least``
    occurrences at least. If ``every`` divides the checksum of ``id:run``, the run loses one code point first."""
    low = F.translate(F.col(text_col), string.ascii_uppercase, string.ascii_lowercase)
    # outer, because an inner explode finds all runs once more to drop texts without any
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode_outer(F.regexp_extract_all(low, F.lit(RUN), F.lit(0))).alias("run")).filter(F.char_length("run") >= shortest)
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    word = runs.withColumn("h", h).select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word")).filter(F.char_length("word") >= shortest)
    return word.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def _split(entries: DataFrame) -> DataFrame:
    """Each entry with the first half of its open part added to the left key, and with the second added to the right."""
    a, right = F.char_length("left"), F.char_length("right")
    mid = a + F.floor((F.col("l") - a - right) / 2).cast("int")
    left = F.struct(F.substr("word", F.lit(1), mid).alias("left"), F.col("right"))
    tail = F.struct(F.col("left"), F.substr("word", F.col("size") - (F.col("l") - mid) + 1).alias("right"))
    return entries.select("word", "size", "l", F.explode(F.array(left, tail)).alias("k")).select("word", "size", "l", "k.left", "k.right")


def _one_edit(a: Column, b: Column) -> Column:
    return F.levenshtein(a, b, 1) == 1


def near(vocabulary: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """(a, b) for all words one inserted, deleted or replaced code point apart, once each: a is the shorter, or the
    smaller of equal length. Of words that repeat, one counts; null and empty words go."""
    key = ["l", "left", "right"]
    size = F.char_length("word").alias("size")
    whole = vocabulary.select("word").filter("word <> ''").distinct().select("word", size).select("word", "size", F.explode(F.array("size", F.col("size") - 1)).alias("l"), F.lit("").alias("left"), F.lit("").alias("right"))
    entries, found = keep(_split(whole.filter("l > 0"))), []
    while True:
        counts = entries.groupBy(*key).agg(F.sum(F.when(F.col("size") == F.col("l"), 1).otherwise(0)).alias("indexed"), F.count("*").alias("probing"))
        large = keep(counts.filter((F.col("indexed") * F.col("probing") > pairs) & (F.col("l") - F.char_length("left") - F.char_length("right") > 1)).select(*key))
        last = large.isEmpty()
        cold = entries if last else entries.join(large, key, "left_anti")
        a = cold.filter("size = l").select(*key, F.col("word").alias("a"))
        b = cold.select(*key, F.col("word").alias("b"), (F.col("size") > F.col("l")).alias("longer"))
        found.append(keep(a.join(b, key).filter((F.col("longer") | (F.col("a") < F.col("b"))) & _one_edit(F.col("a"), F.col("b"))).select("a", "b")))
        if last:
            break
        entries = keep(_split(entries.join(large, key, "left_semi")))
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out.distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): ends of chains of (word, form). Each round doubles the step. A form is five times as frequent as
    its word, so chains are short and never closed."""
    now = keep(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")))
    while not now.filter("moved").isEmpty():
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = keep(now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
    return now.select("word", "root")


def variants(docs: DataFrame, times: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n for each word of the texts.

    A null text has no words; a null id counts as an empty one. Texts of any length are read whole; words of any length
    are compared whole. Rows that repeat count each time. A word's form is its most frequent near word, the smallest in
    code-point order of equals, if ``times`` as frequent as the word at least. Other columns are not read, whatever
    their names. An empty table gives no rows."""
    vocabulary = keep(words(docs, id_col=id_col, text_col=text_col))
    pairs = near(vocabulary)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near")).union(pairs.select("b", "a"))
    ranked = both.join(vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near").groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    own = vocabulary.join(ranked, "word", "left")
    form_n = F.when(-F.col("best.less") >= times * F.col("n"), -F.col("best.less"))
    known = keep(own.select("word", F.when(form_n.isNotNull(), F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), form_n.alias("form_n")))
    roots = _roots(known.filter("form IS NOT NULL"))
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
