"""Best-fit packing of token pieces into sequences of a fixed length.

Lengths form a histogram of at most ``capacity`` bins. A configuration linear program over it (columns: fillings of
one sequence) is solved by multiplicative weights: each round prices columns with one unbounded-knapsack dynamic
program, and lengths whose coverage lags get their best column. The fractional solution is rounded, and what rounding
leaves is placed by best fit, decreasing. The plan is a list of runs per length; each piece finds its place from its
rank among the pieces of its length, so the driver handles only histogram and plan.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fathom.llm import _worker
from fathom.llm._store import keep
from fathom.llm._text import strings
from fathom.llm._units import UnitMemo

_KIND: np.ndarray | None = None
_SPACE, _LETTER, _NUMBER, _OTHER = 0, 1, 2, 3


def _kinds() -> np.ndarray:
    """White space, letter, number or other for each code point."""
    global _KIND
    if _KIND is None:
        import unicodedata

        by = {"L": _LETTER, "N": _NUMBER}
        _KIND = np.array([by.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(0x110000)], np.uint8)
        _KIND[[9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = _SPACE
    return _KIND


def pretokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the joined texts, and start, end and number of its text for each unit on which byte-level BPE
    works alone: a word with the space before it, a number, a run of signs, or white space."""
    size = np.array([len(t) for t in texts], np.int64)
    edge = np.concatenate([[0], np.cumsum(size)])
    cp = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(cp)
    if not n:
        return cp, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = _kinds()[cp]
    first = np.zeros(n + 1, bool)
    first[edge] = True
    first = first[:n]
    start = first.copy()
    start[1:] |= kind[1:] != kind[:-1]
    # the last white space before a word stands alone or, if it is a plain space, belongs to the word
    word = start & (kind != _SPACE) & ~first
    at = np.flatnonzero(word)
    before = at[kind[at - 1] == _SPACE]
    start[before - 1] = True
    start[before[cp[before - 1] == 32]] = False
    # contractions: an apostrophe that begins a unit, and the letters after it
    tick = np.flatnonzero((cp == 39) & start)
    for i in tick[tick + 1 < n].tolist():
        tail = "".join(map(chr, cp[i + 1 : i + 3]))
        room = int(np.searchsorted(edge, i, "right"))
        room = int(edge[room]) - i - 1
        for s in ("s", "t", "re", "ve", "m", "ll", "d"):
            if len(s) <= room and tail.startswith(s):
                start[i + 1] = False
                if i + 1 + len(s) < n:
                    start[i + 1 + len(s)] = True
                break
    starts = np.flatnonzero(start)
    return cp, starts, np.append(starts[1:], n), np.searchsorted(edge, starts, "right") - 1


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies write for bytes: printable Latin-1 signs stand for
    themselves, the other bytes for the code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder(UnitMemo):
    """Ids of many texts by a byte-level BPE file of the tokenizers library.

    Where the file splits texts by the byte-level pattern (as ``pretokens`` does) and changes nothing before, the units
    are encoded by the file's own merging model, each distinct one once; any other file encodes whole texts.
    """

    def __init__(self, path: str, most: int = 300_000):
        from tokenizers import Tokenizer

        super().__init__(most)
        self.split, self.tok = pretokens, Tokenizer.from_file(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        splitter = json.loads(self.tok.pre_tokenizer.__getstate__()) if self.tok.pre_tokenizer else {}
        known = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        self.by_units = self.tok.normalizer is None and all(splitter.get(k) == v for k, v in known.items())
        stand_in = {b: c for c, b in _byte_alphabet().items()}
        self.signs = [stand_in[b] for b in range(256)]
        self.ascii = {b: self.signs[b] for b in range(128)}

    def unit(self, text: str) -> list[int]:  # type: ignore[override]
        signs = text.translate(self.ascii) if text.isascii() else "".join([self.signs[b] for b in text.encode("utf-8", "replace")])
        return [t.id for t in self.tok.model.tokenize(signs)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not self.by_units or any(s in t for s in self.special for t in texts):
            lists = [e.ids for e in self.tok.encode_batch(texts, add_special_tokens=False)]
            return np.array([i for x in lists for i in x], np.uint32), np.array([len(x) for x in lists], np.int64)
        return super().encode(texts)


def encoder(path: str) -> Encoder:
    """One for each tokenizer file and Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return _worker.model(("encoder", path), lambda: Encoder(path))


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The token pieces of each document: one, or for a longer document pieces of ``capacity`` tokens, the first of
    them shorter where the length asks for it. A null text counts as empty: one piece with the end id alone. Repeated
    rows are cut each; an empty table gives no pieces; other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for b in _worker.parts(batches, "text", models=True):
            ids, count = enc.encode(strings(b, "text"))
            out: list[list] = [[], [], [], [], []]
            at = 0
            for doc, n in zip(b.column(0).to_pylist(), count.tolist(), strict=True):
                own = np.append(ids[at : at + n], np.uint32(end_id)).astype("<u4").tobytes()
                at += n
                n += 1
                cut = [0, *range(n % capacity or capacity, n + 1, capacity)] if n > capacity else [0, n]
                for k, (x, y) in enumerate(zip(cut, cut[1:], strict=False)):
                    for col, v in zip(out, (doc, k, x, y - x, zlib.crc32(own[4 * x : 4 * y])), strict=True):
                        col.append(v)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, PIECES)


def solve(demand: dict[int, int], capacity: int, rounds: int = 12, eta: float = 2.0) -> list[tuple[dict[int, int], float]]:
    """Columns (how many of each length) and how often each is used, covering all demand fractionally."""
    lengths = np.array(sorted(x for x in demand if demand[x] > 0), np.int64)
    if not len(lengths):
        return []
    need = np.array([demand[x] for x in lengths.tolist()], float)
    covered = np.zeros(len(lengths))
    found: dict[tuple, float] = {}
    for r in range(1, rounds + 1):
        goal = r / rounds
        price = lengths * np.exp(-eta * rounds * np.maximum(0, covered - (r - 1) / rounds))
        best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for c in range(int(lengths[0]), capacity + 1):
            k = int(np.searchsorted(lengths, c, "right"))
            value = best[c - lengths[:k]] + price[:k]
            j = int(value.argmax())
            best[c], pick[c] = value[j], j
            if best[c - 1] > best[c]:
                best[c], pick[c] = best[c - 1], -1
        for i in range(len(lengths) - 1, -1, -1):  # long ones first: short ones fill what is left
            if covered[i] >= goal:
                continue
            column = {i: 1}
            c = capacity - int(lengths[i])
            while c > 0:
                j = int(pick[c])
                if j < 0:
                    c -= 1
                    continue
                column[j] = column.get(j, 0) + 1
                c -= int(lengths[j])
            at = np.array(list(column))
            many = np.array(list(column.values()), float)
            amount = (goal - covered[i]) * need[i] / column[i]
            over = (1.0 - covered[at]) * need[at] / many  # no length is covered more than whole
            amount = min(amount, over.min())
            if amount <= 1e-9:
                continue
            covered[at] += amount * many / need[at]
            key = tuple(sorted((int(lengths[j]), n) for j, n in column.items()))
            found[key] = found.get(key, 0.0) + amount
    return [(dict(k), x) for k, x in found.items()]


def plan(demand: dict[int, int], capacity: int) -> tuple[dict[int, list[tuple[int, int, int, int, int]]], int]:
    """For each length, runs (first rank, copies, pieces in a copy, first sequence, offset), and how many sequences.

    The linear program's columns are rounded up as far as the demand lasts, fullest first; what is left goes by best
    fit, longest first, into whole sequences and those already begun."""
    left = {x: n for x, n in demand.items() if n > 0}
    used: dict[int, int] = dict.fromkeys(left, 0)
    runs: dict[int, list[tuple[int, int, int, int, int]]] = {x: [] for x in left}
    seq = 0
    open_: dict[int, list[list[int]]] = {}  # free room: [first sequence, copies]

    def put(x: int, copies: int, each: int, first: int, offset: int) -> None:
        runs[x].append((used[x], copies, each, first, offset))
        used[x] += copies * each
        left[x] -= copies * each

    if left.get(capacity):
        put(capacity, left[capacity], 1, 0, 0)
        seq = used[capacity]
    columns = solve({x: n for x, n in left.items() if x < capacity}, capacity)
    for column, amount in sorted(columns, key=lambda c: (-sum(x * n for x, n in c[0].items()), -c[1], sorted(c[0].items()))):
        copies = min([int(np.ceil(amount)), *(left[x] // n for x, n in column.items())])
        if copies <= 0:
            continue
        offset = 0
        for x, n in sorted(column.items(), reverse=True):
            put(x, copies, n, seq, offset)
            offset += x * n
        if offset < capacity:
            open_.setdefault(capacity - offset, []).append([seq, copies])
        seq += copies
    for x in sorted((x for x in left if left[x] > 0), reverse=True):
        while left[x] > 0:
            room = min((r for r in open_ if r >= x), default=None)
            if room is None:
                copies = left[x]
                each = capacity // x
                if copies > each:  # whole sequences of this length alone
                    copies, each = copies // each, each
                else:
                    copies, each = 1, copies
                put(x, copies, each, seq, 0)
                if capacity - each * x:
                    open_.setdefault(capacity - each * x, []).append([seq, copies])
                seq += copies
                continue
            block = open_[room][-1]
            each = min(room // x, left[x])
            copies = min(block[1], left[x] // each)
            put(x, copies, each, block[0], capacity - room)
            if room - each * x:
                open_.setdefault(room - each * x, []).append([block[0], copies])
            block[0], block[1] = block[0] + copies, block[1] - copies
            if not block[1]:
                open_[room].remove(block)
                if not open_[room]:
                    del open_[room]
    return runs, seq


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for each piece of each document.

    Sequences are filled from offset 0 without gaps and hold at most ``capacity`` tokens. Null texts count as empty;
    rows that repeat are packed each; an empty table gives no rows; other columns are not read.
    """
    return place(pieces(docs, tokenizer, capacity, end_id, id_col, text_col), capacity)


def place(cut: DataFrame, capacity: int) -> DataFrame:
    """Adds sequence_id and offset to pieces (columns of PIECES), which are stored first.

    Rows that repeat get places of their own: a stored number deals them over the groups too. Lengths outside 1 to
    ``capacity`` and nulls are an error. An empty table gives no rows. Groups hold some 50,000 pieces each; their number
    stops at 2**20, so beyond 5e10 pieces they grow.
    """
    cut = keep(cut.withColumn("deal", F.xxhash64("doc_id", "piece", F.monotonically_increasing_id())))
    histogram = {int(r["length"]): r["count"] for r in cut.groupBy("length").count().collect()}
    runs, _ = plan(histogram, capacity)
    parts = int(min(1 << 20, max(64, sum(histogram.values()) // 50_000)))
    dealt = cut.withColumn("part", F.pmod("deal", F.lit(parts)).cast("int")).drop("deal")
    counts = dealt.groupBy("part", "length").count()
    base = F.sum("count").over(Window.partitionBy("length").orderBy("part")) - F.col("count")
    bases = counts.select("part", "length", base.cast("long").alias("base"))
    table = {x: np.array(r, np.int64).T for x, r in runs.items()}

    def assign(rows: pd.DataFrame, begin: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece", "start"], kind="stable")
        rank = rows.groupby("length").cumcount().to_numpy() + rows["length"].map(dict(zip(begin["length"], begin["base"], strict=True))).to_numpy()
        seq, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        length = rows["length"].to_numpy()
        for x in np.unique(length).tolist():
            at = np.flatnonzero(length == x)
            first, _, each, sequence, begins = table[x]
            k = np.searchsorted(first, rank[at], "right") - 1
            nth = rank[at] - first[k]
            seq[at] = sequence[k] + nth // each[k]
            offset[at] = begins[k] + nth % each[k] * x
        return rows.drop(columns="part").assign(sequence_id=seq, offset=offset)

    return dealt.groupBy("part").cogroup(bases.groupBy("part")).applyInPandas(assign, PIECES + ", sequence_id long, offset long")
