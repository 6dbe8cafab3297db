"""Lempel-Ziv fingerprints against a plain version, and on odd rows."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathom.llm import fingerprint

DOCS = "doc_id long, text string, tie long, part int, edge string, n_chars long"
COLUMNS = "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next".split()


def table(spark, rows):
    return spark.createDataFrame([(i, t, 1, 1, "first", 1) for i, t in rows], DOCS)


def phrase_set(t):
    """The phrases of the plain incremental parse."""
    seen, phrase = set(), ""
    for c in t:
        phrase += c
        if phrase not in seen:
            seen.add(phrase)
            phrase = ""
    return seen | {phrase} - {""}


def plain(rows):
    """Rows of different ids, in order."""
    one = lambda t: fingerprint.parse([t])[0][1]
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for k, (i, t) in enumerate(rows):
        n, following = len(t), rows[(k + 1) % len(rows)][1]
        changed = t[: n - n // 3] + following[: n // 3]
        f, g, h = one(t), one(changed), one(following)
        out.append((i, n, hashlib.sha256(changed.encode()).hexdigest(), fingerprint.written(f), fingerprint.written(g), fingerprint.likeness(f, g), fingerprint.likeness(f, h)))
    return out


def prose(rng, n):
    return " ".join("".join(rng.choice(["an", "er", "on", "th", "re", "st", "é", "ü"]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_phrases_are_those_of_the_plain_parse():
    rng = random.Random(13)
    for t in ["", "a", "aa", "aaaaaaa", "abababababab", "𝒳𝒳y", "a" * 20000] + [prose(rng, rng.randrange(80)) for _ in range(60)] + ["".join(rng.choice("ab") for _ in range(50)) for _ in range(60)]:
        ends = fingerprint.phrases(t)
        assert {t[a:b] for a, b in zip([0, *ends], ends, strict=False)} == phrase_set(t) and (ends[-1] if t else 0) == len(t)
        for cut in range(0, len(ends), max(1, len(ends) // 5)):
            assert fingerprint.phrases(t, ends[:cut]) == ends


def test_likeness_estimates_the_jaccard_of_phrases():
    rng = random.Random(14)
    errors = []
    for _ in range(60):
        a, b = prose(rng, 300), prose(rng, 300)
        b = a[: rng.randrange(len(a))] + b
        x, y = phrase_set(a), phrase_set(b)
        (_, f), (_, g) = fingerprint.parse([a, b])
        errors.append(fingerprint.likeness(f, g) - len(x & y) / len(x | y))
    assert np.mean(np.abs(errors)) < 0.05 and abs(np.mean(errors)) < 0.03
    (_, f), (_, g), (_, e) = fingerprint.parse(["abcabd", "abcxyz", ""])
    x, y = phrase_set("abcabd"), phrase_set("abcxyz")
    assert fingerprint.likeness(f, g) == len(x & y) / len(x | y)  # exact where sets are small
    assert fingerprint.likeness(e, e) == 1.0 and fingerprint.likeness(e, f) == 0.0
    assert np.array_equal(fingerprint.read(fingerprint.written(f)), f)


@pytest.mark.parametrize("ranges", [1, 3, 50])
def test_next_documents_equal_a_plain_version(spark, ranges):
    rng = random.Random(15)
    rows = [(i * 3, prose(rng, rng.randrange(120))) for i in range(80)] + [(1, ""), (2, None), (4, "aa"), (5, "𝒳𝒳𝒳𝒳𝒳𝒳"), (None, "no id at all"), (7, prose(rng, 60000))]
    rng.shuffle(rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = fingerprint.against_next(table(spark, rows))
        assert df.columns == COLUMNS
        got = {r["doc_id"]: tuple(r) for r in df.collect()}
        assert df.count() == len(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == {r[0]: r for r in plain(rows)}


def test_ranges_are_even_and_in_order(spark):
    keys = spark.range(20000).select(F.struct(F.lit(True).alias("known"), F.col("id").alias("doc_id"), F.xxhash64("id").alias("tie")).alias("k"))
    keys = keys.union(spark.range(10000).select(F.struct(F.lit(False), F.lit(None).cast("long"), F.xxhash64("id"))))  # a third without an id
    got = keys.groupBy(fingerprint._range(keys, 16).alias("range")).agg(F.count("*").alias("n"), F.min("k").alias("low"), F.max("k").alias("high")).orderBy("range").collect()
    assert [r["range"] for r in got] == list(range(16)) and max(r["n"] for r in got) < 2 * 30000 / 16
    order = lambda k: (k["known"], k["doc_id"] or 0, k["tie"])
    assert all(order(a["low"]) > order(b["high"]) for a, b in zip(got, got[1:], strict=False))


def test_repeats_and_single_rows(spark):
    same = [(1, "the same text of one id")] * 6 + [(None, "z")] * 3 + [(2, "the same text of one id")]
    got = fingerprint.against_next(table(spark, same)).collect()
    assert len(got) == len(same) and len({r["fingerprint"] for r in got if r["n_chars"] > 1}) == 1
    assert sum(r["near_next"] == 1.0 for r in got if r["doc_id"] == 1) == 5
    (one,) = fingerprint.against_next(table(spark, [(3, "alone here")])).collect()
    assert tuple(one) == plain([(3, "alone here")])[0] and one["near_next"] == 1.0
    assert fingerprint.against_next(table(spark, [])).collect() == []


def test_fingerprints_alone(spark):
    rows = [(1, "abcabc"), (2, None), (None, "abcabc")]
    got = {r["doc_id"]: (r["n_chars"], r["fingerprint"]) for r in fingerprint.fingerprints(table(spark, rows)).collect()}
    assert got[1] == got[None] and got[2] == (0, "") and got[1][0] == 6
