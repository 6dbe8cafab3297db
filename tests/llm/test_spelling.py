"""Spelling variants against a plain version, and on odd rows."""

import random
import re
import zlib
from collections import Counter

from fathom.llm import spelling

DOCS = "doc_id long, text string, word string, n long, left string, l int"


def table(spark, rows):
    """Rows with extra columns whose names clash with inner ones."""
    return spark.createDataFrame([(i, t, "w", 1, "x", 1) for i, t in rows], DOCS)


def lowered(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = lowered(run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            n[w[: h % len(w)] + w[h % len(w) + 1 :] if h % 199 == 0 else w] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


def edits(rng, w):
    i = rng.randrange(len(w))
    return rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abé") + w[i:], w[:i] + rng.choice("abé") + w[i + 1 :]])


def rows_of(rng, bases, n):
    out = []
    for i in range(n):
        ws = [rng.choice(bases) for _ in range(60)]
        out.append((i, " ".join(w if rng.random() < 0.7 else edits(rng, edits(rng, w) if rng.random() < 0.3 else w) for w in ws)))
    return out


def test_variants_equal_a_plain_version(spark):
    rng = random.Random(11)
    bases = ["letters", "Größen", "abababab", "aaaaaa", "überall", "kitten", "sitting"]
    rows = rows_of(rng, bases, 150) + [(None, "letters " * 9), (None, None), (7, ""), (3, "Ünïcödé" * 3000 + " 12 "), (9, "ÀÀÀÀÀÀ×÷ " * 30), (9, "ÀÀÀÀÀÀ×÷ " * 30)]
    got = spelling.variants(table(spark, rows))
    assert {tuple(r) for r in got.collect()} == plain(rows)
    assert got.count() == len(plain(rows))
    assert dict(got.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}


def test_chains_lead_to_their_ends(spark):
    chain = ["qqqqqqqq", "qqqqqqqw", "qqqqqqww", "qqqqqwww", "qqqqwwww"]
    rows = [(k, f"{w} " * (5 * 5**k)) for k, w in enumerate(chain)]
    got = {r["word"]: r for r in spelling.variants(table(spark, rows)).collect()}
    for r in got.values():
        assert r["root"] == (chain[-1] if r["word"] in chain else got[r["word"]]["root"])
    assert {tuple(r) for r in got.values()} == plain(rows)


def test_large_groups_are_split_and_lose_nothing(spark):
    rng = random.Random(3)
    words = {"inter" + "".join(rng.choice("abcd") for _ in range(rng.randrange(3, 6))) for _ in range(400)} | {"".join(rng.choice("abcd") for _ in range(rng.randrange(3, 6))) + "ation" for _ in range(400)} | {"", "a", "b", "ab", "ba", "é"}
    df = spark.createDataFrame([(w,) for w in words] + [("interab",), ("interab",), (None,)], "word string")
    words.add("interab")
    slow = {(min(a, b, key=lambda x: (len(x), x)), max(a, b, key=lambda x: (len(x), x))) for a in words for b in words if a and b and one_edit(a, b)}
    for most in (4, 64, 1 << 30):
        got = spelling.near(df, most).collect()
        assert len(got) == len({tuple(r) for r in got}) and {tuple(r) for r in got} == slow


def test_no_rows(spark):
    assert spelling.variants(table(spark, [])).collect() == []
    assert spelling.variants(table(spark, [(1, None), (None, "")])).collect() == []
