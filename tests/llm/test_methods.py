"""Slow versions and odd inputs of the operators' inner steps."""

import itertools
import random
import struct
import time

import numpy as np
import pyarrow.parquet as pq
import pytest

pytest.importorskip("public_tokenizers")
import public_tokenizers

from fathom.llm import html, minhash, packing, pii, quality, sentencepiece, sharding, toxicity, vectors
from tests.llm.test_llm import BPE, docs, slow_spans, text, vectors_of

SMALL = "/root/testdata/sf0.001"


def quickly(f, *args, most=5.0):
    began = time.process_time()
    out = f(*args)
    assert time.process_time() - began < most
    return out


# 1 personal data


def test_base_spans_of_long_runs():
    for t in ("7" * 1_000_000, "1." * 300_000, "a@" * 300_000, "+1 " * 300_000, "7" * 400_000 + ".1.2.3 " + "1.2.3.4"):
        quickly(pii.base_spans, t)
    assert pii.base_spans("0" * 99 + "1.2.3.4x01.2.3.4.5.6.7.8") == slow_spans("0" * 99 + "1.2.3.4x01.2.3.4.5.6.7.8")


def test_sanitise_with_clashing_columns(spark, monkeypatch):
    told = [f"{a} snowdrop {b} agent@corp.example {c}" for a, b, c in itertools.product(("red", "blue"), ("calls", "writes", "meets"), ("today", "then"))]
    rows = [(i, t, "k", "o", 5) for i, t in enumerate([*told, None, *[f"nothing {i}" for i in range(20)]])]
    df = spark.createDataFrame(rows, "doc_id long, text string, _key string, _own string, key int")
    one = sorted(map(tuple, pii.sanitise(df).collect()))
    monkeypatch.setattr(pii, "IN_MEMORY", -1)
    two = pii.sanitise(df)
    assert two.columns == df.columns and sorted(map(tuple, two.collect())) == one and one[12][1:] == (None, "k", "o", 5)


def test_disclosure_equals_a_slow_version(spark):
    """Counts of the words of distinct texts, worked out one by one."""
    rng = random.Random(3)
    vocabulary = [f"w{chr(97 + i)}" for i in range(20)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 9))) + rng.choice(["", "", " mail a@b.example", " mail c@d.example"]) for _ in range(150)]
    texts += texts[:9]
    df = docs(spark, texts)
    distinct = sorted(set(texts))
    n = len(distinct)
    word_sets, entity_sets = [], []
    for t in distinct:
        spans = slow_spans(t)
        held = {t[a:b] for a, _, b in spans} | ({"email"} if spans else set())
        rest = t
        for a, _, b in reversed(spans):
            rest = rest[:a] + " " + rest[b:]
        word_sets.append(set(rest.split()) | (set(t.replace("@", " ").replace(".", " ").split()) if spans else set()))
        entity_sets.append(held)
        word_sets[-1] = set(t.replace("@", " ").replace(".", " ").split())
    outside = [set(pii_words(t)) for t in distinct]
    want, surely, every = {}, set(), set()
    for e in {e for s in entity_sets for e in s}:
        c = sum(e in s for s in entity_sets)
        for w in {w for s, o in zip(entity_sets, outside, strict=True) if e in s for w in o}:
            both = sum(e in s and w in o for s, o in zip(entity_sets, outside, strict=True))
            k = sum(w in s for s in word_sets)
            p, z = both / k, 1.645
            low = (p + z * z / (2 * k) - z * np.sqrt(p * (1 - p) / k + z * z / (4 * k * k))) / (1 + z * z / k)
            every.add(w)
            surely |= {w} if low >= 0.25 else set()
            if np.log(low * n / c) / np.log(n / c) >= 0.2:
                want[w] = max(want.get(w, -9.0), np.log(p * n / c) / np.log(n / c))
    got = {r["term"]: r["disclosure"] for r in pii.disclosing_terms(df, generalise_at=0.2, at_least=0.0).collect()}
    hashed = {w: int(pii.words([w])[0].view(np.int64)[0]) for w in want}
    assert want and got == {hashed[w]: pytest.approx(d) for w, d in want.items()}
    got = {r["term"] for r in pii.disclosing_terms(df, generalise_at=-9.0, at_least=0.25).collect()}
    assert 1 < len(surely) < len(every) and got == {int(pii.words([w])[0].view(np.int64)[0]) for w in surely}


def test_hidden_words_do_not_grow_with_the_corpus(spark):
    """A word in one of two texts with a value is hidden in no corpus, however large; one that stands with it alone is."""
    told = ["Ossip Brandt of ward 12 and room B7 asks mail@one.example", "Brandt wrote twice", "Brandt went away", "mail@one.example asks ward again", "asks again"]
    for n in (2_000, 120_000):
        df = docs(spark, told).select("doc_id", "text").union(spark.range(10, n).selectExpr("id", "concat('line ', id % 97, ' about ', id)"))
        held = {int(pii.words([w])[0].view(np.int64)[0]): w for w in "Ossip Brandt of ward 12 and room B7 asks again".split()}
        assert {held[r["term"]] for r in pii.disclosing_terms(df).collect() if r["term"] in held} == {"Ossip", "of", "and", "room", "B7", "ward", "asks"}
    assert {held.get(r["term"]) for r in pii.disclosing_terms(df, at_least=0.0).collect()} >= {"again"}


def test_classes_of_hidden_words():
    assert [pii._class(w) for w in ("2077", "B7", "Ossip", "snowdrop", "été", "Émile", "x9")] == ["[NUMBER]", "[CODE]", "[NAME]", "[TERM]", "[TERM]", "[NAME]", "[CODE]"]


def pii_words(t):
    """The words outside personal data."""
    for a, _, b in reversed(slow_spans(t)):
        t = t[:a] + " " + t[b:]
    return t.split()


# 3 quality


def test_trees_equal_a_walk_row_by_row():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, len(quality.STATISTICS)))
    y = (x[:, 3] + 0.5 * x[:, 7] > 0.2).astype(float)
    model = quality.fit(x[:200], y[:200], trees=12)
    slow = []
    for row in x:
        raw = model.start
        for t in range(len(model.feature)):
            node = 0
            for _ in range(model.depth):
                node = 2 * node + (2 if row[model.feature[t, node]] > model.threshold[t, node] else 1)
            raw += model.value[t, node - (2**model.depth - 1)]
        slow.append(1 / (1 + np.exp(-raw)))
    assert np.allclose(model.predict(x), slow) and ((np.array(slow[200:]) >= 0.5) == y[200:]).mean() > 0.85


def test_quality_filter_keeps_columns_and_good_rows(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdefgh") * 4 for _ in range(60)) if i % 2 else "BUY NOW!! " * 40 for i in range(120)] + [None, "", "good " * 60_000]
    df = docs(spark, texts)
    model = quality.train(df, spark.createDataFrame([(i, i % 2, 0) for i in range(120)], "doc_id long, quality int, toxic int"))
    kept = quality.filter_rows(df, model)
    scores = {r["doc_id"]: r["score"] for r in quality.score(df, model).collect()}
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {i for i, s in scores.items() if s >= 0.3}
    assert quality.filter_rows(df.limit(0), model).count() == 0


# 4 SentencePiece


def _field(number, value):
    def varint(v):
        out = b""
        while True:
            out += bytes([v & 127 | (128 if v > 127 else 0)])
            v >>= 7
            if not v:
                return out

    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def unigram(pieces, byte_pieces=False):
    """A model file written by hand: nothing is trained."""
    rows = [("<unk>", 0.0, 2), *[(p, w, 1) for p, w in pieces.items()], *([(f"<0x{b:02X}>", 0.0, 6) for b in range(256)] if byte_pieces else [])]
    model = b"".join(_field(1, _field(1, p.encode()) + _field(2, w) + _field(3, k)) for p, w, k in rows)
    return model + _field(2, _field(3, 1) + (_field(35, 1) if byte_pieces else b"")) + _field(3, _field(1, b"identity") + _field(3, 1) + _field(4, 1))


def load(tmp_path, raw):
    path = tmp_path / f"{abs(hash(raw))}.model"
    path.write_bytes(raw)
    return sentencepiece.Transducer(str(path))


@pytest.mark.parametrize("byte_pieces", [False, True])
def test_weights_decide_and_equal_the_library(tmp_path, byte_pieces):
    import sentencepiece as sp

    rng = random.Random(1)
    letters = "▁abc"
    pieces = {p: -rng.uniform(1, 9) for p in {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 5))) for _ in range(40)} | {"▁" + "".join(rng.choice("abc") for _ in range(rng.randrange(0, 4))) for _ in range(20)} | set(letters)}
    raw = unigram(pieces, byte_pieces)
    fst, own = load(tmp_path, raw), sp.SentencePieceProcessor(model_proto=raw)
    for _ in range(200):
        t = "".join(rng.choice("aabbcc xé😀") for _ in range(rng.randrange(14)))
        ids, count = fst.encode([t])
        # the library adds in 32 bits, whose rounding decides where the same pieces in two orders weigh exactly the same
        assert (ids.tolist() == own.encode(t) or sorted(ids.tolist()) == sorted(own.encode(t))) and count.tolist() == [len(ids)], t
        unit = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 9)))
        every = [cut for k in range(len(unit)) for cut in itertools.combinations(range(1, len(unit)), k)]
        least = min(sum(fst.weight[fst.number[unit[a:b]]] if unit[a:b] in fst.number else np.inf for a, b in zip((0, *cut), (*cut, len(unit)), strict=True)) for cut in every)
        assert fst.shortest(unit)[1] == pytest.approx(least)
    # the same pieces under other weights are put together otherwise
    assert load(tmp_path, unigram({"a": -1.0, "b": -1.0, "ab": -3.0, "▁": -1.0})).unit("ab") != load(tmp_path, unigram({"a": -1.0, "b": -1.0, "ab": -1.5, "▁": -1.0})).unit("ab")


def test_character_map_equals_the_library():
    import sentencepiece as sp

    if not hasattr(sp, "SentencePieceNormalizer"):
        pytest.skip("no normaliser in this version")
    own = sp.SentencePieceNormalizer(rule_name="nmt_nfkc_cf")
    fst = sentencepiece.Transducer.__new__(sentencepiece.Transducer)
    options = dict(sentencepiece._fields(dict(sentencepiece._fields(own.serialized_model_proto()))[3]))
    fst.map = sentencepiece.character_map(options[2])
    fst.longest, fst.mapped, fst.dummy, fst.squeeze = max(map(len, fst.map)), frozenset(k[0] for k in fst.map), 0, 0
    rng = random.Random(2)
    assert len(fst.map) > 1000
    for _ in range(300):
        t = "".join(chr(rng.choice([rng.randrange(32, 0x250), rng.randrange(0x300, 0x370), rng.randrange(0xAC00, 0xD7A4), rng.randrange(0xFF00, 0xFFEF), rng.randrange(0x2100, 0x2200)])) for _ in range(rng.randrange(12)))
        assert fst.rewrite(t).strip(" ").replace(" ", "") == own.Normalize(t).replace("▁", "").replace(" ", ""), t


# 5 HTML extraction


def test_blocks_of_odd_tags():
    says = lambda page: [t for t, _, _ in html.blocks(page)]
    assert says("<p>one<svg width=1/>two</p><p>three<svg><path d='x'/>no</svg> four") == ["onetwo", "three four"]
    assert says('<div title="it\'s>here" class=a"b>inside</div>after') == ["inside", "after"]
    assert says("1 < 2 <3 a<b>c</b> <!-- no --> <?x?> <!doctype html>d</ >e") == ["1 < 2 <3 ac de"]
    assert says("<script/>var a = '<p>no'</script>yes<STYLE>no</Style >!") == ["yes!"]
    assert says("a<p>b<!-- no end") == ["a", "b"] and says("a<p class='") == ["a"] and says("") == []
    assert [p for _, p, _ in html.blocks('<DIV CLASS="Main-Text x9" data-class=q><p>t')] == [("<div", "main", "text", "x", "<p")]
    for page in ('<a "' * 250_000, "<" * 1_000_000, "<div>x" * 50_000, "</p" * 200_000, "<a x='" * 100_000, "<!--" * 250_000):
        quickly(html.blocks, page)


def test_blocks_agree_with_the_standard_parser():
    """Plain well-formed pages: the standard library's parser finds the same texts."""
    from html.parser import HTMLParser

    class Plain(HTMLParser):
        def __init__(self):
            super().__init__()
            self.out, self.skip = [""], 0

        def handle_starttag(self, tag, attrs):
            self.skip += tag in ("script", "style")
            if tag not in html._INLINE and tag not in ("script", "style"):
                self.out.append("")

        def handle_endtag(self, tag):
            self.skip -= tag in ("script", "style")
            if tag not in html._INLINE and tag not in ("script", "style"):
                self.out.append("")

        def handle_data(self, data):
            if not self.skip:
                self.out[-1] += data

    rng = random.Random(4)
    for _ in range(200):
        parts = [rng.choice(["<p>", "</p>", "<div class='a b'>", "</div>", "<b>", "</b>", "word ", "&amp;", "&#233; ", "<li>", "<script>x<y</script>", "<!-- c -->", "<img src=x>", "two\n\tthree "]) for _ in range(rng.randrange(20))]
        parser = Plain()
        parser.feed("".join(parts))
        parser.close()
        assert [t for t, _, _ in html.blocks("".join(parts))] == [" ".join(t.split()) for t in parser.out if t.split()]


def test_labeller_without_names():
    rng = np.random.default_rng(8)
    words = "tree river stone wind light cloud field house".split()
    sentences = [" ".join(rng.choice(words, int(rng.integers(6, 30)))) + "." for _ in range(80)]
    drawn = [html.random_page(sentences, rng) for _ in range(160)]
    model = html.Labeller().fit([p for p, _ in drawn] + [html.nameless(p) for p, _ in drawn], [y for _, y in drawn] * 2)
    held = [html.random_page(sentences, rng) for _ in range(60)]
    for change, least in ((lambda p: p, 0.9), (html.nameless, 0.75)):
        pages = [change(p) for p, _ in held]
        found = model.predict(html.vectors(pages), [len(p) for p in pages]) >= 0.5
        assert (found == np.concatenate([y for _, y in held]).astype(bool)).mean() > least


def test_scan_equals_a_slow_lstm():
    """The batched forward pass against one written out step by step."""
    rng = np.random.default_rng(6)
    model = html.Labeller(hidden=3, seed=1)
    pages = [html.random_page(["some words here.", "more."], rng)[0] for _ in range(4)]
    x, sizes = html.vectors(pages), [len(p) for p in pages]
    dense = np.hstack([x.paths[x.path], x.dense])
    sig = lambda z: 1 / (1 + np.exp(-z))
    slow, at = [], 0
    for n in sizes:
        states = {}
        for d, order in (("f", range(n)), ("b", range(n - 1, -1, -1))):
            h, c = np.zeros(3), np.zeros(3)
            for t in order:
                z = dense[at + t] @ model.p[f"wx{d}"] + h @ model.p[f"wh{d}"] + model.p[f"c{d}"]
                c = sig(z[:3]) * c + sig(z[3:6]) * np.tanh(z[9:])
                h = sig(z[6:9]) * np.tanh(c)
                states[d, t] = h
        slow += [sig(np.concatenate([states["f", t], states["b", t]]) @ model.p["out"] + model.p["bias"][0]) for t in range(n)]
        at += n
    assert np.allclose(model.predict(x, sizes), slow)


# 6 packing


def test_units_equal_the_library_over_a_table():
    texts = [t or "" for t in pq.read_table(f"{SMALL}/documents.parquet", columns=["text"]).column(0).to_pylist()]
    enc = packing.Encoder(BPE)
    ids, count = enc.encode(texts)
    want = [e.ids for e in enc.tok.encode_batch(texts, add_special_tokens=False)]
    assert enc.by_units and count.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_other_splitters_encode_whole_texts(tmp_path):
    from tokenizers import Tokenizer, pre_tokenizers

    tok = Tokenizer.from_file(BPE)
    tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=True)
    tok.save(str(tmp_path / "other.json"))
    enc = packing.Encoder(str(tmp_path / "other.json"))
    ids, _ = enc.encode(["two words", "x"])
    assert not enc.by_units and ids.tolist() == tok.encode("two words").ids + tok.encode("x").ids


def test_repeated_rows_get_places_of_their_own(spark):
    rows = packing.pack(spark.createDataFrame([(1, "same words")] * 60 + [(None, None)] * 3, "doc_id long, text string"), BPE, capacity=16).collect()
    assert len(rows) == 63 and len({(r["sequence_id"], r["offset"]) for r in rows}) == 63


# 7 sharding


def test_repeated_rows_are_sharded_together(spark):
    rows = sharding.shard(spark.createDataFrame([(1, "same")] * 50 + [(i, f"text {i}") for i in range(50)], "doc_id long, text string"), bucket_digits=1).collect()
    same = {r["shard"] for r in rows if r["doc_id"] == 1 and r["size"] == 5}
    assert len(same) == 1 and all(sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows))) for s in range(8))


# 9 toxicity


def test_kernel_equals_a_slow_version():
    names = ["idiot", "pathetic", "moron", "abcabc"]
    shown = ["idiot", "ixdiot", "idi", "pathetically", "mor0n".replace("0", "o"), "zzzzzz", "abcab", "cab"]

    def features(t):
        t, out = f"{{{t}{{", {}
        for k in (3, 4):
            for at in itertools.combinations(range(len(t)), k):
                if at[-1] - at[0] < toxicity.SPAN:
                    key = "".join(t[i] for i in at)
                    out[key] = out.get(key, 0) + toxicity.DECAY ** (at[-1] - at[0] + 1)
        return out

    dot = lambda a, b: sum(v * b.get(k, 0) for k, v in a.items())
    slow = np.array([[dot(features(s), features(n)) / np.sqrt(dot(features(s), features(s)) * dot(features(n), features(n))) for n in names] for s in shown])
    got = toxicity.Landmarks(names).kernel(shown)
    near = slow.max(1) >= toxicity.NEAR
    assert near.sum() >= 4 and np.allclose(got[near], slow[near], atol=1e-5) and (got[~near].max(1, initial=0) < toxicity.NEAR).all()


def test_units_of_odd_texts():
    assert toxicity.tokens("Ab c d e f 12 x1y éß😀") == {"ab", "c", "d", "e", "f", "cdef", "xy", toxicity.plain("éß")}
    long = toxicity.tokens("q" * 100_000)
    assert {len(t) for t in long} == {32} and toxicity.tokens("") == set() == toxicity.tokens(" 1 ")
    stream = toxicity.letters(["ab", "", "a b"])
    assert stream[1].tolist() == [0, 0, 2, 2] and [toxicity.spell(stream[0][a:b]) for a, b in zip(*toxicity.units(stream), strict=True)] == ["ab", "a", "b"]


# 10 exact top-k


def test_segments_are_skipped_and_the_answer_is_exact():
    rng = np.random.default_rng(4)
    x = np.floor(256 * rng.normal(size=(2000, 24)) * (rng.random((2000, 24)) < 0.3))
    index = vectors.Segments(np.arange(2000), np.arange(2000), x, 16)
    again = vectors.Segments.load(index.dump(), 16)
    skipped = 0
    for r in range(0, 2000, 100):
        rows, score, taken = again.top(x[r], r, 5)
        want = sorted((-(x[i] @ x[r]), i) for i in range(2000) if i != r)[:5]
        assert [(-s, i) for s, i in zip(score, rows, strict=True)] == want
        skipped += 24 * 16 - taken
    assert skipped > 0.1 * 20 * 24 * 16


def test_top_k_of_repeated_ids(spark):
    rng = np.random.default_rng(5)
    rows = [(50, [0.5, 0.25], 0), (50, [0.25, 0.5], 0), (51, [0.1, 0.1], 0), (100, [0.5, 0.25], 0), (None, [9.0, 9.0], 0), (3, [], 0)]
    rows += [(i, [float(v) for v in rng.normal(size=2)], 0) for i in range(200, 230)]
    got = sorted(map(tuple, vectors.exact_top_k(vectors_of(spark, rows), block=7, chunk=2).collect()))
    ok = [(i, np.floor(256 * np.float32(list(v) + [0] * (2 - len(v))).astype(float)).astype(int)) for i, v, _ in rows if i is not None]
    want = []
    for a, (q, w) in enumerate(ok):
        if q % 50 == 0:
            best = sorted((-int(w @ v), i) for b, (i, v) in enumerate(ok) if a != b)[:5]
            want += [(q, k, i, -s) for k, (s, i) in enumerate(best, 1)]
    assert got == sorted(want)


def test_scores_are_exact_at_any_magnitude(spark):
    rng = np.random.default_rng(33)
    for size in (1e2, 3e5, 1e8, 1e9):
        x = rng.integers(-size, size, size=(64, 64)).astype(float)
        own = vectors.Segments(np.arange(64), np.arange(64), x, 32)
        for r in range(0, 64, 16):
            at, score, _ = own.top(x[r], r, 5)
            slow = sorted(((-sum(int(a) * int(b) for a, b in zip(x[i], x[r], strict=True)), i) for i in range(64) if i != r))[:5]
            assert [(-s, i) for i, s in zip(at.tolist(), score.tolist(), strict=True)] == slow
    rows = [(i, [float(v) for v in rng.integers(-(10**6), 10**6, 8)]) for i in range(120)] + [(200, [2.0**26, 1.0]), (201, [2.0**-9, 3.0])]
    got = vectors.exact_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    whole = {i: [int(256 * v // 1) for v in x] for i, x in rows}
    dot = lambda a, b: sum(p * q for p, q in zip(a, b, strict=False))
    slow = {(q, k, i, -s) for q in (0, 50, 100, 200) for k, (s, i) in enumerate(sorted((-dot(whole[q], whole[i]), i) for i in whole if i != q)[:5], 1)}
    assert {tuple(r) for r in got.collect()} == slow


def test_deduplicate_keeps_columns_of_any_name(spark):
    rows = [(1, "one text", 10, 20, "x"), (1, "one text", 11, 21, "y"), (2, "another text", 12, 22, "z"), (None, None, 13, 23, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _id int, _CID int, cid string")
    got = minhash.deduplicate(df)
    assert got.columns == df.columns and sorted(r["_id"] for r in got.collect()) in ([10, 12, 13], [11, 12, 13])


def _crowd(rng, groups=40, alone=200):
    """Texts that share 60 % of their words, with planted groups of four at a similarity of 0.8 or a little more."""
    common, texts = text(rng, 120), []
    for _ in range(groups):
        own = text(rng, 80).split()
        texts += [common + " " + " ".join([*own[: 80 - k], *text(rng, k).split()]) for k in (0, 3, 11, 20)]
    return texts + [common + " " + text(rng, 80) for _ in range(alone)]


def test_divided_keys_lose_nothing(spark):
    """Crowded keys divided by register sets, with no stars before, against all pairs; and few rows made."""
    from pyspark.sql import functions as F

    rng = random.Random(31)
    texts = _crowd(rng)
    rows = minhash._rows(docs(spark, texts), "doc_id", "text")
    sketched = minhash._sketch(rows, minhash.ROWS * minhash.BANDS).groupBy("cid").agg(F.min("doc_id").alias("least"), F.first("sig").alias("sig")).cache()
    part = lambda i: F.substring("sig", i * 24 + 1, 24)
    keys = sketched.select("cid", F.posexplode(F.array(*[F.xxhash64(F.lit(i), part(i)) for i in range(32)])).alias("last", "key"))
    sizes = keys.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    members = keys.join(sizes, "key").select("key", "last", "size", "cid", F.col("cid").alias("root"), F.lit(True).alias("asked")).cache()
    packs = minhash._packs(rows, sketched.select("cid", "least"))
    found = {}
    for crowd in (10**6, 20):
        parts = minhash._divided(members, sketched, crowd)
        found[crowd] = {tuple(sorted(r)) for r in minhash._missing_links(parts, sketched, packs, 0.8).collect()}
        assert (parts.filter("set >= 0").count() > 0) == (crowd == 20)
    held = {r["cid"]: r["least"] for r in sketched.collect()}
    sets = [minhash.weighted([t])[1:] for t in texts]
    near = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if minhash.probability_jaccard(sets[i], sets[j]) >= 0.8]

    def roots(links):
        root = list(range(len(texts)))
        for i, j in links:
            a, b = sorted((root[i], root[j]))
            root = [a if r == b else r for r in root]
        return root

    assert len(near) > 100
    for links in found.values():
        assert roots([(held[a], held[b]) for a, b in links]) == roots(near)
    largest = members.agg(F.max("size")).first()[0]
    pairs = minhash._divided(members.filter(F.col("size") == largest), sketched, 20).groupBy("key").count().agg(F.sum(F.col("count") * F.col("count"))).first()[0]
    assert largest > 100 and pairs < 256 * largest * 8


def test_recall_of_planted_copies_at_the_threshold(spark):
    rng = random.Random(32)
    texts, planted = [], []
    for _ in range(300):
        own = text(rng, 200).split()
        changed = own[:]
        at = rng.randrange(20, 150)
        changed[at : at + 14] = text(rng, 14).split()
        texts += [" ".join(own), " ".join(changed)]
        a, b = (minhash.weighted([t])[1:] for t in texts[-2:])
        assert 0.8 <= minhash.probability_jaccard(a, b) <= 0.86
        planted.append((len(texts) - 2, len(texts) - 1))
    got = {r["doc_id"]: r["component_id"] for r in minhash.classes(docs(spark, texts)).collect()}
    assert np.mean([got[i] == got[j] for i, j in planted]) >= 0.99


def test_recall_where_lists_are_pruned(spark):
    """Eight of 400 lists are probed; pairs planted a little over the threshold."""
    rng = np.random.default_rng(33)
    x = rng.normal(size=(4000, 48))
    x /= np.linalg.norm(x, axis=1)[:, None]
    side = rng.normal(size=(1000, 48))
    side -= (side * x[:1000]).sum(1)[:, None] * x[:1000]
    side /= np.linalg.norm(side, axis=1)[:, None]
    y = 0.935 * x[:1000] + np.sqrt(1 - 0.935**2) * side
    rows = [(i, [float(c) for c in v], 1) for i, v in enumerate(np.concatenate([x, y]))]
    got = {r["vec_id"]: r["component_id"] for r in vectors.near_duplicates(vectors_of(spark, rows), list_size=1.25).collect()}
    assert np.mean([got[4000 + i] == got[i] for i in range(1000)]) >= 0.98


def test_merging_looks_at_each_pair_once(tmp_path):
    class Counted(dict):
        looked = 0

        def get(self, *a):
            Counted.looked += 1
            return super().get(*a)

    rng = random.Random(5)
    fst = sentencepiece.Transducer.__new__(sentencepiece.Transducer)
    fst.rank = Counted({"".join(rng.choices("ab", k=rng.randint(1, 6))): float(rng.randint(1, 9)) for _ in range(60)})
    for _ in range(300):
        text = "".join(rng.choices("abc", k=rng.randint(0, 40)))
        parts = list(text)
        while options := [(dict.get(fst.rank, x + y), k) for k, (x, y) in enumerate(zip(parts, parts[1:], strict=False)) if x + y in fst.rank]:
            k = min(options)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        Counted.looked = 0
        assert fst._merge(text) == parts and Counted.looked <= 3 * len(text)
