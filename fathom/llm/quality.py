"""Quality of documents by histogram gradient-boosted trees over statistics of the whole text.

Statistics are computed in tasks from whole texts; a bounded sample of labelled rows (``most_rows``, the rows of
smallest hash) comes to the driver as numbers, where the trees are fitted. The fitted trees are flat arrays (feature,
threshold and value by node of a complete tree), walked for all rows and trees at once by numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathom.llm import _worker
from fathom.llm._text import numbers, strings, words

_CLASSES = ("upper", "lower", "digit", "space", "line", "stop", "pipe", "bang", "sign", "other", "beyond")
_CLASS_OF = np.full(256, 9, np.uint8)
_CLASS_OF[65:91], _CLASS_OF[97:123], _CLASS_OF[48:58], _CLASS_OF[128:] = 0, 1, 2, 10
_CLASS_OF[[9, 13, 32]], _CLASS_OF[10], _CLASS_OF[[44, 46, 59, 58]], _CLASS_OF[124], _CLASS_OF[[33, 63]] = 3, 4, 5, 6, 7
_CLASS_OF[[35, 36, 37, 38, 42, 64, 94, 126, 60, 62, 61, 43, 95, 92]] = 8

STATISTICS = (*(f"share_{c}" for c in _CLASSES), "log_bytes", "log_words", "word_bytes", "distinct_words", "distinct_fives", "distinct_lines", "log_lines", "line_bytes", "top_word", "longest_word")


def _distinct(doc: np.ndarray, key: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """How many different keys each text has, and the count of its most frequent one."""
    if not len(key):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((key, doc))
    d, k = doc[order], key[order]
    first = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (k[1:] != k[:-1])]))
    count = np.diff(np.append(first, len(k)))
    top = np.zeros(n)
    np.maximum.at(top, d[first], count)
    return np.bincount(d[first], minlength=n).astype(float), top


def statistics(texts: list[str]) -> np.ndarray:
    """A row of STATISTICS for each text; an empty text has zeros."""
    n = len(texts)
    blobs = [t.encode("utf-8", "replace") for t in texts]
    size = np.array([len(b) for b in blobs], float)
    buf = np.frombuffer(b"".join(blobs), np.uint8)
    doc = np.repeat(np.arange(n), size.astype(np.int64))
    counts = np.bincount(doc * len(_CLASSES) + _CLASS_OF[buf], minlength=n * len(_CLASSES)).reshape(n, -1)
    h, of, at = words(texts)
    n_words = np.bincount(of, minlength=n).astype(float)
    distinct, top = _distinct(of, h, n)
    fives, _ = _distinct(of[4:][of[4:] == of[:-4]], (h[4:] + h[:-4] * np.uint64(3) + h[2:-2] * np.uint64(5))[of[4:] == of[:-4]], n) if len(h) > 4 else (np.zeros(n), None)
    lines = [t.split("\n") for t in texts]
    n_lines = np.array([len(x) for x in lines], float)
    same = np.array([len(set(x)) for x in lines], float)
    gap = np.zeros(n)
    inner = (buf != 32) & (buf != 10)
    edge = np.flatnonzero(np.diff(inner.astype(np.int8), prepend=0, append=0))
    if len(edge):
        np.maximum.at(gap, doc[edge[::2]], edge[1::2] - edge[::2])
    whole, many = np.maximum(size, 1), np.maximum(n_words, 1)
    letters = counts[:, [0, 1, 2, 10]].sum(1)
    return np.column_stack([counts / whole[:, None], np.log1p(size), np.log1p(n_words), letters / many, distinct / many, fives / np.maximum(n_words - 4, 1), same / n_lines, np.log1p(n_lines), size / n_lines, top / many, np.log1p(gap)])


@dataclass
class Trees:
    """Flat arrays by tree and node of a complete binary tree: the children of node i are 2i+1 and 2i+2."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    start: float
    depth: int

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each row."""
        rows, trees = np.arange(len(x))[:, None], np.arange(len(self.feature))[None, :]
        node = np.zeros((len(x), len(self.feature)), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[rows, self.feature[trees, node]] > self.threshold[trees, node])
        leaf = node - (2**self.depth - 1)
        return 1 / (1 + np.exp(-(self.start + self.value[trees, leaf].sum(1))))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64, smooth: float = 2.0) -> Trees:
    """Boosting by the logistic loss; splits are sought over histograms of ``bins`` quantile bins."""
    n, m = x.shape if x.size else (0, len(STATISTICS))
    inner = 2**depth - 1
    model = Trees(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)), 0.0, depth)
    share = (y.sum() + 1) / (n + 2)
    model.start = float(np.log(share / (1 - share)))
    if n < 2:
        return model
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(m)]
    code = np.column_stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)])
    flat = code + np.arange(m) * bins
    raw = np.full(n, model.start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            width, base = 2**level, 2**level - 1
            local = node - base
            key = (local[:, None] * (m * bins) + flat).ravel()
            G = np.bincount(key, np.repeat(g, m), width * m * bins).reshape(width, m, bins)
            H = np.bincount(key, np.repeat(h, m), width * m * bins).reshape(width, m, bins)
            gl, hl = G.cumsum(2)[:, :, :-1], H.cumsum(2)[:, :, :-1]
            gt, ht = G.sum(2)[:, :, None], H.sum(2)[:, :, None]
            gain = gl**2 / (hl + smooth) + (gt - gl) ** 2 / (ht - hl + smooth) - gt**2 / (ht + smooth)
            for k in range(width):
                f, b = np.unravel_index(int(gain[k].argmax()), gain[k].shape)
                if gain[k, f, b] > 1e-6 and b < len(cuts[f]):
                    model.feature[t, base + k], model.threshold[t, base + k] = f, cuts[f][b]
            node = 2 * node + 1 + (x[np.arange(n), model.feature[t, node]] > model.threshold[t, node])
        leaf = node - inner
        model.value[t] = -rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + smooth)
        raw += model.value[t, leaf]
    return model


def remainder(id_col: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo the divisor; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % divisor


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, wanted: Column, most_rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, y) of at most ``most_rows`` labelled documents: those of smallest hash of the id among ``wanted``.

    Null labels and null ids are left out; of several labels of one id the smallest counts, and of several rows of one id
    the smallest text does, so that the bound is one of rows: each task hands on one text of an id, however often it
    repeats. A null text counts as empty. Empty tables give no rows. Extra columns are not read."""
    one = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(label).cast("int").alias("y")).filter(wanted)
    few = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    return text.join(F.broadcast(few), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("doc_id", "text", "y")


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", divisor: int = 5, held_out: int = 0, most_rows: int = 12_000, id_col: str = "doc_id", text_col: str = "text") -> Trees:
    """Trees fitted on at most ``most_rows`` labelled rows (see ``labelled_sample``) whose id has another remainder than
    ``held_out``; whole texts, whatever their length, come to the driver as one row of STATISTICS each.

    Repeated ids count once, so ties do not occur; rows of one text under several ids count each. With fewer than two rows
    there is no split, and every text scores the share of label 1 among them, drawn towards one half."""
    sample = labelled_sample(docs, labels, label, remainder(F.col("doc_id"), divisor) != held_out, most_rows, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _worker.parts(batches, "text"):
            x = statistics(strings(b, "text"))
            yield pa.RecordBatch.from_arrays([numbers(b, "doc_id"), pa.array(list(x), pa.list_(pa.float64())), numbers(b, "y")], ["doc_id", "x", "y"])

    rows = sorted((r["doc_id"], list(r["x"]), r["y"]) for r in sample.mapInArrow(run, "doc_id long, x array<double>, y int").collect())
    return fit(np.array([x for _, x, _ in rows], float).reshape(len(rows), len(STATISTICS)), np.array([y for _, _, y in rows], float))


SCORED = "doc_id long, score double"


def score(docs: DataFrame, model: Trees, divisor: int = 5, held_out: int = 0, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for each row.

    A null text counts as empty, and both get the score of an empty text. Equal texts get equal scores; repeated rows
    are scored each. Without labels the score is 0.5 everywhere. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _worker.parts(batches, "text"):
            yield pa.RecordBatch.from_arrays([numbers(b, "doc_id"), pa.array(model.predict(statistics(strings(b, "text"))))], ["doc_id", "score"])

    scored = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCORED)
    return scored.select("doc_id", (remainder(F.col("doc_id"), divisor) == held_out).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def filter_rows(docs: DataFrame, model: Trees, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text reaches the threshold, with all their columns.

    A null text is judged as an empty one; equal texts are kept or dropped alike, repeated rows each. A text is read whole,
    whatever its length. An empty table gives no rows; other columns are carried along, whatever their names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _worker.parts(batches, text_col):
            yield b.filter(pa.array(model.predict(statistics(strings(b, text_col))) >= threshold))

    return docs.mapInArrow(run, docs.schema)
