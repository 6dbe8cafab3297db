"""Sanitising of personal data by what corpus co-occurrence discloses.

Protected entities are the values of four patterns (email, ip, card, phone), and each kind as a whole. The words of
whole documents that mention an entity are counted with it; copies of one text count once. A word t discloses the
entity c as far as its pointwise mutual information reaches the information content of c:

    disclosure(t, c) = log(p(t, c) / (p(t) p(c))) / -log p(c)

with probabilities over distinct texts; 1 means that t stands in no text without c. So that this holds for entities and
words seen once or twice, ``sure`` takes for p(c | t) its lower bound by Wilson (one side, 95 %): words whose bound
reaches ``generalise_at`` for some entity are generalised to their class (number, code, name or other term); those of
them whose disclosure reaches ``remove_at`` are removed. Patterns themselves are always replaced.

The disclosure of a rare entity asks for less of p(c | t) the larger the corpus is, 1 / n to the power of 0.2 for a
value of one text among n. So that the words hidden do not grow by that, the lower bound of p(c | t) itself has to reach
``at_least`` too, whatever the size: a word in one text alone and with the value, or in five of ten, reaches 0.25; one in
two of four does not.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathom.llm import _worker
from fathom.llm._bitmap import bitmap, marked
from fathom.llm._store import keep
from fathom.llm._text import join, numbers, strings, words

KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# a match begins where a run of digits does, and runs are never given back: each digit is read a fixed number of times
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[int, int, int]  # start, number of its kind (len(KINDS): a word), end


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", m.end() if m else at + 1)


def base_spans(text: str) -> list[Span]:
    """Matches of the four patterns that hold, by start, then by kind."""
    out = [(a, 0, b) for a, b in _emails(text)]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _NOT_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(map(str.isdigit, m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def spell(spans: list[Span]) -> str:
    return ",".join(f"{(*KINDS, 'term')[k]}:{a}:{b}" for a, k, b in spans)


def _entity(kind: int, value: str) -> int:
    """A value as 61 bits of its hash and its kind: of 10**8 values some 0.002 pairs meet by chance."""
    plain = value.lower() if kind == 0 else value if kind == 1 else _NOT_DIGIT.sub("", value)
    return int.from_bytes(hashlib.blake2b(plain.encode("utf-8", "replace"), digest_size=8).digest(), "little") >> 3 << 2 | kind


_AROUND = re.compile(r"[A-Za-z0-9\x80-\U0010ffff]+")


def _mentions(texts: list[str]) -> Iterator[tuple[int, list[int], np.ndarray]]:
    """(number of the text, entities, different words outside the entities) of each text that mentions any. Each kind
    is an entity too: -1 - its number."""
    for number, t in enumerate(texts):
        spans = base_spans(t)
        if spans:
            part, done = [], 0
            for a, _, b in spans:
                part.append(t[done : max(a, done)])
                done = max(b, done)
            entities = {_entity(k, t[a:b]) for a, k, b in spans} | {-1 - k for _, k, _ in spans}
            yield number, sorted(entities), np.unique(words([" ".join([*part, t[done:]])])[0])


def _long(x: np.ndarray | list) -> pa.Array:
    return pa.array(np.asarray(x, np.uint64).view(np.int64))


def mentions(docs: DataFrame) -> DataFrame:
    """(key, entities, terms) of the rows of (key, text) that mention an entity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _worker.parts(batches, "text"):
            rows = list(_mentions(strings(b, "text")))
            key = numbers(b, "key").take(pa.array([n for n, _, _ in rows], pa.int64()))
            terms = [w.view(np.int64) for _, _, w in rows]
            yield pa.RecordBatch.from_arrays([key, pa.array([e for _, e, _ in rows], pa.list_(pa.int64())), pa.array(terms, pa.list_(pa.int64()))], ["key", "entities", "terms"])

    return docs.mapInArrow(run, "key long, entities array<long>, terms array<long>")


BITS = 22


def _hits(texts: list[str], marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    h, doc, at = words(texts)
    ok = marked(marks, h >> np.uint64(64 - BITS))
    return h[ok], doc[ok], at[ok]


def document_counts(docs: DataFrame, terms: DataFrame, repeated: DataFrame) -> DataFrame:
    """(term, in how many distinct texts it stands) for the given terms, from (key, text). Texts whose key is among
    ``repeated`` are counted by key; the others add up where they stand."""
    marks, often = bitmap(terms, F.col("term"), BITS), bitmap(repeated, F.col("key"), _KEY_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _worker.parts(batches, "text"):
            key = np.array(numbers(b, "key").to_pylist(), np.int64)
            h, doc, _ = _hits(strings(b, "text"), marks)
            own = np.where(marked(often, key.view(np.uint64) >> np.uint64(64 - _KEY_BITS)), key, 0)
            order = np.lexsort((doc, h))
            h, doc = h[order], doc[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
            h, of = h[new], own[doc[new]]
            order = np.lexsort((of, h))
            h, of = h[order], of[order]
            first = np.ones(len(h), bool)
            first[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
            at = np.flatnonzero(first)
            n = np.diff(np.append(at, len(h)))
            yield pa.RecordBatch.from_arrays([_long(h[at]), pa.array(of[at]), pa.array(n.astype(np.int64))], ["term", "key", "n"])

    found = docs.mapInArrow(run, "term long, key long, n long").groupBy("term", "key").agg(F.sum("n").alias("n"))
    return found.groupBy("term").agg(F.sum(F.when(F.col("key") == 0, F.col("n")).otherwise(1)).alias("n_term"))


_KEY_BITS = 24
#: The least lower bound of p(entity | word) at which a word is hidden, in a corpus of any size.
AT_LEAST = 0.25
#: One-sided 95 % of the normal distribution.
_Z = 1.645


def _at_least(hits: Column, trials: Column) -> Column:
    """Wilson's lower bound of a share."""
    z2, p = _Z * _Z, hits / trials
    return (p + z2 / (2 * trials) - _Z * F.sqrt(p * (1 - p) / trials + z2 / (4 * trials * trials))) / (1 + z2 / trials)


def _disclosures(docs: DataFrame, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(class, entity), and (class, term, disclosure, sure, bound). Entities that the same texts mention are one class."""
    text = F.coalesce(text_col, F.lit(""))
    keyed = docs.select(F.xxhash64(text).alias("key"), text.alias("text"))
    keys = keep(keyed.groupBy("key").agg(F.count("*").alias("copies")))
    n = F.lit(float(max(2, keys.count())))
    told = keep(mentions(keyed).groupBy("key").agg(F.first("entities").alias("entities"), F.first("terms").alias("terms")))
    by_entity = told.select("key", F.explode("entities").alias("entity"))
    print_ = F.xxhash64(F.count("*"), F.bit_xor(F.xxhash64("key")), F.bit_xor(F.xxhash64("key", F.lit(1))))
    entities = keep(by_entity.groupBy("entity").agg(print_.alias("class"), F.count("*").alias("n_entity")))
    held = entities.groupBy("class").agg(F.min("entity").alias("entity"), F.first("n_entity").alias("n_entity"))
    place = keep(by_entity.join(held, "entity").select("class", "key", "n_entity"))
    terms = told.select("key", F.explode("terms").alias("term"))
    both = place.join(terms, "key").groupBy("class", "term").agg(F.count("*").alias("n_both"), F.first("n_entity").alias("n_entity"))
    counts = document_counts(keyed, terms.select("term").distinct(), keys.filter("copies > 1"))
    share = lambda p: F.log(p * n / F.col("n_entity")) / F.log(n / F.col("n_entity"))
    scored = both.join(counts, "term").filter(F.col("n_entity") < n)
    bound = _at_least(F.col("n_both"), F.col("n_term"))
    scored = scored.select("class", "term", share(F.col("n_both") / F.col("n_term")).alias("disclosure"), share(bound).alias("sure"), bound.alias("bound"))
    return entities.select("class", "entity"), scored


def disclosing_terms(docs: DataFrame, generalise_at: float = 0.8, at_least: float = AT_LEAST, text_col: str = "text") -> DataFrame:
    """(term, disclosure) of the words that surely reach both thresholds for some entity."""
    _, scored = _disclosures(docs, text_col)
    return scored.filter((F.col("sure") >= generalise_at) & (F.col("bound") >= at_least)).groupBy("term").agg(F.max("disclosure").alias("disclosure"))


def reach(docs: DataFrame, generalise_at: float = 0.8, at_least: float = AT_LEAST, text_col: str = "text") -> DataFrame:
    """One row (entities, reached, terms): different values in the texts, how many of them some word discloses, and how
    many words disclose any value or kind."""
    entities, scored = _disclosures(docs, text_col)
    told = keep(scored.filter((F.col("sure") >= generalise_at) & (F.col("bound") >= at_least)).select("class", "term"))
    values = entities.filter("entity >= 0").join(told.select("class").distinct().withColumn("hit", F.lit(1)), "class", "left")
    return values.agg(F.count("*").alias("entities"), F.count("hit").alias("reached")).crossJoin(told.agg(F.count_distinct("term").alias("terms")))


#: Words that a task may hold in memory (16 bytes each); more are joined instead.
IN_MEMORY = 2_000_000


def _term_spans(texts: list[str], terms: np.ndarray) -> list[list[Span]]:
    """Spans, in code points, of the words whose hash is among ``terms`` (sorted)."""
    out: list[list[Span]] = [[] for _ in texts]
    if not len(terms):
        return out
    h, doc, at = words(texts)
    spot = np.minimum(np.searchsorted(terms, h), len(terms) - 1)
    ok = np.flatnonzero(terms[spot] == h)
    if len(ok):
        buf, edge = join(texts)
        points = np.cumsum((buf & 0xC0) != 0x80)
        for i in ok.tolist():
            d, a = int(doc[i]), int(at[i])
            start = int(points[a] - points[edge[d]])
            m = _AROUND.match(texts[d], start)
            if m:
                out[d].append((start, len(KINDS), m.end()))
    return out


def _merge(base: list[Span], extra: list[Span]) -> list[Span]:
    """All base spans, and those words that touch none of them."""
    if not extra:
        return base
    keep, k = [], 0
    reach = 0
    for s in sorted(extra):
        while k < len(base) and base[k][0] < s[2]:
            reach = max(reach, base[k][2])
            k += 1
        if reach <= s[0]:
            keep.append(s)
    return sorted(base + keep)


def _fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    while name.lower() in map(str.lower, docs.columns):
        name += "_"
    return name


def _with_spans(docs: DataFrame, terms: DataFrame, schema: str, make: Callable[[pa.RecordBatch, list[str], list[list[Span]], list[list[Span]], np.ndarray], pa.RecordBatch], text_col: str) -> DataFrame:
    """``make`` over batches of ``docs`` with base and word spans of each text."""
    terms = keep(terms.select("term", "disclosure"))
    held = terms.count()
    if held <= IN_MEMORY:
        got = terms.toPandas()
        known, level = got["term"].to_numpy(np.int64).view(np.uint64), got["disclosure"].to_numpy(float)
        known, level = known[np.argsort(known)], level[np.argsort(known)]
        sent = terms.sparkSession.sparkContext.broadcast((known, level))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, level = sent.value
            for b in _worker.parts(batches, text_col):
                texts = strings(b, text_col)
                yield make(b, texts, [base_spans(t) for t in texts], _term_spans(texts, known), np.stack([known.view(np.float64), level]))

        return docs.mapInArrow(run, schema)
    # too many words for a task's memory: only the words of a text that are among them travel with it
    marks = bitmap(terms, F.col("term"), BITS)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _worker.parts(batches, "text"):
            h, doc, _ = _hits(strings(b, "text"), marks)
            key = np.array(numbers(b, "key").to_pylist(), np.int64)
            pair = np.unique(np.stack([h, key[doc].view(np.uint64)]), axis=1) if len(h) else np.zeros((2, 0), np.uint64)
            yield pa.RecordBatch.from_arrays([_long(pair[0]), _long(pair[1])], ["term", "key"])

    key_col, own_col = (_fresh(docs, name) for name in ("_key", "_own"))
    keyed = docs.withColumn(key_col, F.xxhash64(F.coalesce(text_col, F.lit(""))))
    hits = keyed.select(F.col(key_col).alias("key"), F.col(text_col).alias("text")).mapInArrow(find, "term long, key long").distinct()
    own = hits.join(terms, "term").groupBy(F.col("key").alias(key_col)).agg(F.collect_list(F.struct("term", "disclosure")).alias(own_col))
    joined = keyed.join(own, key_col, "left").select(*docs.columns, own_col)

    def run_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _worker.parts(batches, text_col):
            texts, lists = strings(b, text_col), numbers(b, own_col).to_pylist()
            spans, levels = [], {}
            for t, own_terms in zip(texts, lists, strict=True):
                mine = {x["term"] & (1 << 64) - 1: x["disclosure"] for x in own_terms or []}
                levels |= mine
                spans += _term_spans([t], np.array(sorted(mine), np.uint64))
            known = np.array(sorted(levels), np.uint64)
            yield make(b, texts, [base_spans(t) for t in texts], spans, np.stack([known.view(np.float64), np.array([levels[int(k)] for k in known])]))

    return joined.mapInArrow(run_joined, schema)


FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string"


def find(docs: DataFrame, terms: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans for each row.

    A null text counts as empty and has no spans. Repeated rows are reported each. Offsets are code points, the end
    exclusive. An empty table gives no rows; other columns are not read.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    terms = disclosing_terms(narrow, **limits) if terms is None else terms

    def make(b: pa.RecordBatch, texts: list[str], base: list[list[Span]], extra: list[list[Span]], _: np.ndarray) -> pa.RecordBatch:
        count = [[sum(k == n for _, k, _ in s) for s in base] for n in range(len(KINDS))]
        cols = [numbers(b, "doc_id"), *(pa.array(c, pa.int64()) for c in count), pa.array([spell(s) for s in base], pa.string())]
        cols.append(pa.array([spell(_merge(s, x)) for s, x in zip(base, extra, strict=True)], pa.string()))
        return pa.RecordBatch.from_arrays(cols, ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base", "spans"])

    found = _with_spans(narrow, terms, FOUND, make, "text")
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


PLACEHOLDERS = ("[EMAIL]", "[IP]", "[CARD]", "[PHONE]")


def _class(word: str) -> str:
    """What stands for a disclosing word: digits alone, digits among letters, a capital first, or any other."""
    if any(map(str.isdigit, word)):
        return "[NUMBER]" if word.isdigit() else "[CODE]"
    return "[NAME]" if word[:1].isupper() else "[TERM]"


def sanitise(docs: DataFrame, remove_at: float = 0.999, text_col: str = "text", **limits) -> DataFrame:
    """``docs`` with its texts rewritten: patterns become placeholders, disclosing words their class, words that
    disclose fully go. All other columns stay, whatever their names; a null text stays null, an empty one empty.

    Equal texts are rewritten alike, repeated rows each; rows keep no order among each other; an empty table gives no
    rows."""
    terms = disclosing_terms(docs, text_col=text_col, **limits)
    names = docs.columns
    at = names.index(text_col)

    def make(b: pa.RecordBatch, texts: list[str], base: list[list[Span]], extra: list[list[Span]], levels: np.ndarray) -> pa.RecordBatch:
        full = set(levels[0].view(np.uint64)[levels[1] >= remove_at].tolist())
        out = []
        for was, t, s, x in zip(numbers(b, text_col).to_pylist(), texts, base, extra, strict=True):
            part, done = [], 0
            for a, k, z in _merge(s, x):
                if z <= done:
                    continue
                if k < len(KINDS):
                    instead = PLACEHOLDERS[k]
                else:
                    instead = "" if full and int(words([t[a:z]])[0][0]) in full else _class(t[a:z])
                part += [t[done : max(a, done)], instead]
                done = z
            out.append(None if was is None else "".join([*part, t[done:]]))
        cols = [b.column(i) for i in range(len(names))]
        cols[at] = pa.array(out, pa.string())
        return pa.RecordBatch.from_arrays(cols, names)

    return _with_spans(docs, terms, docs.schema, make, text_col)
