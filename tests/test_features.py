"""Staging, correlations, codes by first appearance and the leakage guard."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathom.operators import clean, features
from fathom.sources import staging


def test_lines_are_loaded_once_or_rejected_with_all_reasons(spark, tmp_path):
    src, target = f"file://{tmp_path}/in.csv", f"file://{tmp_path}/out"
    (tmp_path / "in.csv").write_text('id,day,qty,name\n1,2024-01-05,3,"a, b"\n2,05-Jan-2024,x,c\n3,never,,\n4,2024/01/05,5\n5,2024-01-06,1,d,e\n7,2024-01-07,-1,f\n1,2024-01-05,3,"a, b"\n')
    kinds = {"id": "long", "day": "date", "qty": "int", "name": "string"}
    for batch, times in (("b1", 2), ("b2", 1)):
        s = staging.stage(spark, src, list(kinds), batch)
        assert s.count() == 7
        good, bad = staging.convert(s, kinds, ["name"], {"qty: negative": F.col("_qty") >= 0})
        for _ in range(times):
            staging.append(good, target)
        assert sorted((r["id"], r["reasons"]) for r in bad.select(F.coalesce("id", F.lit("")).alias("id"), "reasons").collect()) == [("2", ["qty: unreadable"]), ("3", ["day: unreadable", "name: missing"]), ("4", ["malformed line"]), ("5", ["malformed line"]), ("7", ["qty: negative"])]
    rows = spark.read.parquet(target).select("id", F.col("day").cast("string"), "qty", "name", "batch").collect()
    assert sorted(map(tuple, rows)) == [(1, "2024-01-05", 3, "a, b", b) for b in ("b1", "b1", "b2", "b2")]


def test_correlations_over_pairs_that_are_there(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(200, 4)) + 1e9
    x[:, 1] = x[:, 0] * -2 + rng.normal(size=200)
    x[:, 3] = 5.0
    hole = rng.random((200, 4)) < 0.2
    rows = [tuple(None if h else float(v) for v, h in zip(r, g, strict=True)) for r, g in zip(x, hole, strict=True)] + [(math.nan, -2e9, math.inf, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(5)
    got = {(r["a"], r["b"]): r for r in features.correlations(df, list("abcd")).collect()}
    assert len(got) == 6
    for i, j in ((0, 1), (0, 2), (1, 2)):
        both = ~hole[:, i] & ~hole[:, j]
        r = got["abcd"[i], "abcd"[j]]
        assert r["n"] == both.sum() and abs(r["pearson"] - np.corrcoef(x[both][:, [i, j]].T)[0, 1]) < 1e-6
    assert got["a", "d"]["pearson"] is None
    pairs = spark.createDataFrame([("a", "b", 0.9, 1), ("b", "c", -0.9, 1), ("a", "c", 0.1, 1), ("a", "d", None, 1)], "a string, b string, pearson double, n long")
    assert features.uncorrelated(pairs, list("abcd"), 0.8) == ["a", "c", "d"] and features.uncorrelated(pairs, list("bacd"), 0.8) == ["b", "d"]
    empty = features.correlations(df.limit(0), ["a", "b"]).collect()
    assert [r["pearson"] for r in empty] in ([], [None])


def test_codes_by_first_appearance(spark):
    rows = [(i, "xyzxw"[i % 5] if i % 7 else None) for i in range(500)]
    got = {r["v"]: (r["first"], r["code"]) for r in features.first_seen(spark.createDataFrame(rows, "at long, v string").repartition(3), "v", "at").collect()}
    seen = {}
    for i, v in rows:
        seen.setdefault(v, (i, len(seen)))
    assert got == seen


def test_leaks_are_an_error(spark):
    df = spark.createDataFrame([(1, "a", "b", 2.0)], "rsd int, bu string, account string, revenue double")
    assert features.known_in_advance(df, ["bu"], ["rsd"], ["qty"]).columns == ["rsd", "bu"]
    features.refuse_leaks(["bu", "sma"], ["bu"], ["sma"])
    with pytest.raises(ValueError, match="not known when forecasting: revenue"):
        features.refuse_leaks(["bu", "revenue"], ["bu"], ["sma"])
    with pytest.raises(ValueError, match="missing keys: market"):
        features.known_in_advance(df, ["market"], [])


def test_observed_rows_cost_no_pass_of_their_own(spark):
    df, seen = clean.observed(spark.range(12), "read")
    assert df.filter("id > 3").count() == 8 and seen.get["rows"] == 12
