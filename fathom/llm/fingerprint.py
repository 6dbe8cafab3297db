"""Fingerprints of documents by Lempel-Ziv phrases.

A text is parsed into phrases, each the shortest run of characters that is no phrase yet. The phrases form a set; its
smallest hashes are the fingerprint; the share of common hashes among the smallest of two fingerprints estimates the
Jaccard similarity of both sets. Texts that compress each other share phrases."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathom.llm._text import span_hashes, strings
from fathom.llm._worker import parts

#: Hashes of a fingerprint, of 32 bits each.
SIZE = 128
_HEX = 8

Parsed = tuple[list[int], np.ndarray]  # ends of phrases, fingerprint


def phrases(text: str, begun: Sequence[int] = ()) -> list[int]:
    """Where each phrase ends. What is left at the end is a phrase too, though it may not be new. ``begun``: ends of
    phrases known to begin the parse."""
    seen: set[str] = set()
    begin, ends = 0, list(begun)
    for end in ends:
        seen.add(text[begin:end])
        begin = end
    for end in range(begin + 1, len(text) + 1):
        phrase = text[begin:end]
        if phrase not in seen:
            seen.add(phrase)
            ends.append(end)
            begin = end
    if begin < len(text):
        ends.append(len(text))
    return ends


def signatures(texts: list[str], ends: list[list[int]], size: int = SIZE) -> list[np.ndarray]:
    """The ``size`` smallest different hashes of each text's phrases, in order; fewer if there are fewer phrases. Their
    highest 32 bits: among the 128 least of 10^8 phrases three agree by chance."""
    count = np.fromiter(map(len, ends), np.int64, len(ends))
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    before = np.cumsum([0, *map(len, texts)])[:-1]
    stop = np.fromiter((e for x in ends for e in x), np.int64, int(count.sum())) + np.repeat(before, count)
    begin = np.empty_like(stop)
    begin[1:] = stop[:-1]
    first = (np.cumsum(count) - count)[count > 0]
    begin[first] = before[count > 0]
    short = (span_hashes(codes, begin, stop) >> np.uint64(32)).astype(np.uint32)
    return [np.unique(h)[:size] for h in np.split(short, np.cumsum(count)[:-1])] if texts else []


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """The share of the smallest hashes of both together that are in both; 1 for two empty texts."""
    both = np.union1d(a, b)[:size]
    if not len(both):
        return 1.0
    common = np.intersect1d(a, b, assume_unique=True)
    return int((common <= both[-1]).sum()) / len(both)


def written(fingerprint: np.ndarray) -> str:
    return fingerprint.astype(">u4").tobytes().hex()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u4").astype(np.uint32)


def parse(texts: list[str], begun: list[Sequence[int]] | None = None) -> list[Parsed]:
    ends = [phrases(t, b) for t, b in zip(texts, begun or [()] * len(texts), strict=True)]
    return list(zip(ends, signatures(texts, ends), strict=True))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, fingerprint for each row, without a shuffle.

    A null text counts as empty, which has an empty fingerprint. Equal texts have equal fingerprints; repeated rows and
    null ids each give a row. Texts are parsed whole; memory grows with the phrases of one text. Other columns are not
    read. An empty table gives no rows."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = pa.schema([("n_chars", pa.int64()), ("fingerprint", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, "text"):
            texts = strings(batch, "text")
            made = pa.record_batch([pa.array(map(len, texts), pa.int64()), pa.array((written(f) for _, f in parse(texts)), pa.string())], schema=out)
            yield pa.RecordBatch.from_arrays([batch.column(0), *made.columns], ["doc_id", *out.names])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_chars long, fingerprint string")


def edited(text: str, following: str) -> str:
    """The last third replaced by the first characters of the following document."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


_MADE = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_FIELDS = [x.split()[0] for x in _MADE.split(", ")]


def _beside(texts: list[str], own: list[Parsed], following: list[np.ndarray], next_texts: list[str]) -> list[pa.Array]:
    """The columns of texts with their next documents. An edited text's parse begins with the phrases before its cut."""
    changed = [edited(t, f) for t, f in zip(texts, next_texts, strict=True)]
    begun = []
    for t, (ends, _) in zip(texts, own, strict=True):
        cut = len(t) - len(t) // 3
        # the last end may close a phrase that is not new, which more text would have made longer
        begun.append(ends[: min(int(np.searchsorted(ends, cut, "right")), max(0, len(ends) - 1))])
    new = parse(changed, begun)
    return [
        pa.array(map(len, texts), pa.int64()),
        pa.array((sha256(t.encode("utf-8")).hexdigest() for t in changed), pa.string()),
        pa.array((written(f) for _, f in own), pa.string()),
        pa.array((written(f) for _, f in new), pa.string()),
        pa.array((likeness(f, g) for (_, f), (_, g) in zip(own, new, strict=True)), pa.float64()),
        pa.array((likeness(f, g) for (_, f), g in zip(own, following, strict=True)), pa.float64()),
    ]


def _range(keys: DataFrame, many: int) -> Column:
    """The number of a key's range, in descending order of keys, as an expression over the column k.

    Bounds are quantiles of a sample of the keys: 40 for each range, a million at most. Equal keys share a range."""
    n, kind = keys.count(), keys.schema["k"].dataType.simpleString()
    rate = max(1, n // min(40 * many, 1_000_000))
    sample = sorted((tuple(r["k"]) for r in keys.filter(F.pmod(F.xxhash64("k"), F.lit(rate)) == 0).collect()), reverse=True)
    bounds = sorted({sample[i * len(sample) // many] for i in range(1, many)}, reverse=True) if sample else []
    listed = F.from_json(F.lit(json.dumps([dict(zip(("known", "doc_id", "tie"), b, strict=True)) for b in bounds])), f"array<{kind}>")

    def further(step: int) -> Callable[[Column], Column]:
        return lambda at: F.when(F.get(listed, at + (step - 1)) > F.col("k"), at + step).otherwise(at)

    number = F.lit(0)
    for bit in reversed(range(len(bounds).bit_length())):  # the bounds above the key, by binary search
        number = F.transform(F.array(number), further(1 << bit))[0]
    return number


def against_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next: each document beside the
    one of next lower id, and beside its own text with the last third replaced by that one's beginning.

    Null ids come last; equal ids follow a hash of their texts. After the last row comes the first; a single row is its
    own next one. A null text counts as empty. Repeated rows follow each other. Other columns are not read. An empty
    table gives no rows.

    The texts are shuffled once, into ranges of ids, each with the first row of the next range as a guest at its end,
    and every range is read through in order with one text carried from slice to slice."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    rows = rows.select(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", F.xxhash64("text").alias("tie")).alias("k"), "text")
    many = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = _range(rows.select("k"), many)
    firsts = {r["range"]: r["first"] for r in rows.groupBy(number.alias("range")).agg(F.to_json(F.max("k")).alias("first")).collect()}  # a key for each range
    filled = sorted(firsts)
    before = dict(zip(filled, filled[-1:] + filled[:-1], strict=True))
    first = F.from_json(F.lit(json.dumps([json.loads(firsts.get(r, "null")) for r in range(many)])), f"array<{rows.schema['k'].dataType.simpleString()}>")
    home = F.from_json(F.lit(json.dumps([before.get(r, r) for r in range(many)])), "array<int>")
    placed = rows.withColumn("own", number)
    where = F.when(F.get(first, F.col("own")) == F.col("k"), F.array("own", F.get(home, F.col("own")))).otherwise(F.array("own"))
    dealt = placed.select("k", "text", F.posexplode_outer(where).alias("guest", "range"))
    ranged = dealt.repartitionById(many, F.col("range")).sortWithinPartitions("range", "guest", F.desc("k")).select(F.col("k.doc_id").alias("doc_id"), "text", "guest")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row that is no guest with the row that follows it."""
        carried: tuple | None = None  # id as an array of one, text, parse
        for batch in parts(batches, "text"):
            texts = strings(batch, "text")
            if not texts:
                continue
            own, ids, guest = parse(texts), batch.column(0), batch.column(2).to_pylist()
            if carried is not None:
                ids, texts, own, guest = pa.concat_arrays([carried[0], ids]), [carried[1], *texts], [carried[2], *own], [0, *guest]
            at = [i for i in range(len(texts) - 1) if not guest[i]]
            if at:
                made = _beside([texts[i] for i in at], [own[i] for i in at], [own[i + 1][1] for i in at], [texts[i + 1] for i in at])
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(at)), *made], ["doc_id", *_FIELDS])
            carried = None if guest[-1] else (ids.slice(len(texts) - 1), texts[-1], own[-1])

    return ranged.mapInArrow(scan, f"doc_id {kind}, {_MADE}")
