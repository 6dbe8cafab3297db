"""Fill-in-the-middle against a plain version, exact round trips, and odd rows."""

import hashlib
import random
import re
from collections import Counter

import pytest

from fathom.llm import fill_middle

DOCS = "doc_id long, text string, key string, n long, output string, form string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "k", 1, "o", "f") for i, t in rows], DOCS)


def plain(i, t):
    t = t or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", t)
    x = hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()
    h = [int(x[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return i, n, "plain", None, None, t
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return i, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return i, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_equals_a_plain_version_and_comes_back(spark):
    rng = random.Random(12)
    pieces = ["a", "ÿ", "𝒳y", " ", "  ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", " ", "<", "<S", ">", "P>", "word", "é"]
    rows = [(i, "".join(rng.choice(pieces) for _ in range(rng.randrange(40)))) for i in range(400)]
    rows += [(i, t) for i in range(400, 440) for t in (" ", "\n\n", "x", "a <P> b", "<M>", "<S", None, "")] + [(None, "some text of no id"), (None, None)]
    rows += [(k, "long text of many words " * 20000) for k in range(500, 504)]
    rows += rows[:50] * 3 + [(5, "another text of the same id")]
    out = fill_middle.restore(fill_middle.transform(table(spark, rows))).collect()
    assert Counter(tuple(r[c] for c in ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")) for r in out) == Counter(plain(*r) for r in rows)
    assert Counter((r["doc_id"], r["restored"]) for r in out) == Counter((i, t or "") for i, t in rows)
    assert {r["form"] for r in out} == {"plain", "psm", "spm"}


def test_one_shuffle_of_texts_and_nothing_broadcast(spark):
    df = fill_middle.transform(table(spark, [(i, f"some words of text {i}") for i in range(200)]))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") - plan.count("ReusedExchange") == 1 and plan.count("ReusedExchange") == 2 and "Broadcast" not in plan and "Python" not in plan


def test_digests_and_parameters(spark):
    df = table(spark, [(i, f"one two three {i}") for i in range(60)])
    got = fill_middle.digests(df)
    assert dict(got.dtypes) == {"doc_id": "bigint", "n": "bigint", "form": "string", "prefix_chars": "bigint", "middle_chars": "bigint", "output_sha256": "string", "restored_sha256": "string"}
    assert {(r["doc_id"], r["restored_sha256"]) for r in got.collect()} == {(i, hashlib.sha256(f"one two three {i}".encode()).hexdigest()) for i in range(60)}
    assert {r["form"] for r in fill_middle.transform(df, rate=100, suffix_first=0, marks=("[a]", "[b]", "[c]")).collect()} == {"psm"}
    with pytest.raises(ValueError):
        fill_middle.transform(df, marks=("<P>", "[S]", "<M>"))
    assert fill_middle.digests(table(spark, [])).collect() == []
