"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Three machines are compiled from the model file. The normaliser rewrites (the file's own character map, longest match
first; dummy prefix; spaces to the piece mark). The pieces are states of a prefix tree, whose arcs read a letter; a state
at which a piece ends writes it at a weight of minus its score. The byte fallback writes the bytes (or the unknown piece)
of a letter that is no piece. An input is composed with them, and the path of least weight in the tropical semiring
(min, +) is the encoding: every place of the input keeps the least weight of the paths that reach it. Decoding runs the
pieces backwards.

Unigram models are that alone: weights decide. For byte-pair models the sum of scores is not the criterion, so a fourth
machine is composed in: it admits a piece after another only where merging the two pieces' letters afresh, by the
weights, gives just these two. That leaves the path of byte-pair merging.

Pieces never reach over a space that follows something else, so a text's units between such places are composed alone,
and equal units once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.llm import _worker
from fathom.llm._text import numbers, strings
from fathom.llm._units import Split, UnitMemo

MARK = "▁"


def _fields(blob: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol-buffer message's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = blob[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(blob):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 2:
            n = varint()
            at += n
            yield tag >> 3, blob[at - n : at]
        else:
            n = 8 if kind == 1 else 4
            at += n
            yield tag >> 3, blob[at - n : at]


def character_map(blob: bytes) -> dict[str, str]:
    """What the normaliser writes for what it reads: a double array of the keys' bytes, and the texts they stand for."""
    if not blob:
        return {}
    size = int(np.frombuffer(blob, "<u4", 1)[0])
    tree, texts = np.frombuffer(blob, "<u4", size // 4, 4).astype(np.int64), blob[4 + size :]
    label, leaf, offset = tree & (1 << 31 | 255), tree >> 8 & 1, (tree >> 10) << ((tree & 1 << 9) >> 6)
    out: dict[str, str] = {}
    todo, each = [(int(offset[0]), b"")], np.arange(1, 256)
    while todo:
        base, key = todo.pop()
        at = base ^ each
        for c in each[(at < len(tree)) & (label[np.minimum(at, len(tree) - 1)] == each)].tolist():
            node = base ^ c
            below, own = node ^ int(offset[node]), key + bytes([c])
            if leaf[node]:
                begin = int(tree[below]) & (1 << 31) - 1
                out[own.decode("utf-8", "replace")] = texts[begin : texts.index(b"\0", begin)].decode("utf-8", "replace")
            todo.append((below, own))
    return out


UNIGRAM, BYTE_PAIRS = 1, 2
_UNKNOWN_WEIGHT = 10.0  # what an unknown letter weighs more than the rarest piece


class Transducer(UnitMemo):
    def __init__(self, path: str, most: int = 1_000_000):
        super().__init__(most)
        with open(path, "rb") as f:
            self._compile(list(_fields(f.read())))

    def _compile(self, model: list[tuple[int, int | bytes]]) -> None:
        trainer = dict(_fields(next((v for k, v in model if k == 2), b"")))
        self.kind = trainer.get(3, UNIGRAM)
        if self.kind not in (UNIGRAM, BYTE_PAIRS) or trainer.get(24):
            raise ValueError("only unigram and byte-pair models with the space before a word are supported")
        self.pieces: list[str] = []
        self.weight: list[float] = []
        self.number: dict[str, int] = {}
        self.bytes_: dict[int, int] = {}
        self.unknown = 0
        for _, raw in (x for x in model if x[0] == 1):
            part = dict(_fields(raw))
            piece, kind = part.get(1, b"").decode(), part.get(3, 1)
            number = len(self.pieces)
            self.pieces.append(piece)
            self.weight.append(-float(np.frombuffer(part.get(2, bytes(4)), "<f4")[0]))
            if kind in (1, 4):
                self.number[piece] = number
            elif kind == 6:
                self.bytes_[int(piece[3:5], 16)] = number
            elif kind == 2:
                self.unknown = number
        options = dict(_fields(next((v for k, v in model if k == 3), b"")))
        self.map = character_map(options.get(2, b""))
        self.longest, self.mapped = max(map(len, self.map), default=0), frozenset(k[0] for k in self.map)
        self.dummy, self.squeeze = options.get(3, 1), options.get(4, 1)
        # a state is its arcs by letter; an arc has the next state, the piece that ends there, or -1, and its weight
        self.root: dict[str, tuple] = {}
        self.rank = {piece: self.weight[number] for piece, number in self.number.items()}
        for piece in sorted(self.number):  # prefixes first
            state = self.root
            for c in piece[:-1]:
                if c not in state:
                    state[c] = ({}, -1, 0.0)
                state = state[c][0]
            if piece:
                state[piece[-1]] = (state[piece[-1]][0] if piece[-1] in state else {}, self.number[piece], self.rank[piece])
        self.fallback = max((self.weight[k] for k in self.number.values()), default=0.0) + _UNKNOWN_WEIGHT
        long = [p for p in self.number if len(p) > 1]
        self.alone = "".join(c for c in "\n\t" if not any(c in p for p in long))
        if any(MARK in p.lstrip(MARK) for p in long):
            raise ValueError("a piece holds a space after something else")
        self.follow: dict[int, bool] = {}
        self.surface = [p.replace(MARK, " ").encode() for p in self.pieces]
        for b, k in self.bytes_.items():
            self.surface[k] = bytes([b])
        for k, p in enumerate(self.pieces):
            if p not in self.number and k not in self.bytes_.values():
                self.surface[k] = " ⁇ ".encode() if k == self.unknown else b""

    # the normaliser
    def rewrite(self, text: str) -> str:
        """The character map alone."""
        if not self.map or self.mapped.isdisjoint(text):
            return text
        out, at = [], 0
        while at < len(text):
            n = next((n for n in range(min(self.longest, len(text) - at), 0, -1) if text[at : at + n] in self.map), 0) if text[at] in self.mapped else 0
            out.append(self.map[text[at : at + n]] if n else text[at])
            at += n or 1
        return "".join(out)

    def normalise(self, text: str) -> str:
        text = self.rewrite(text)
        if self.squeeze:
            text = " ".join(w for w in text.split(" ") if w)
        if not text:
            return ""
        return (MARK if self.dummy else "") + text.replace(" ", MARK)

    # the follow-on machine
    def _merge(self, text: str) -> list[str]:
        """Pieces by merging neighbours of least weight first, the left ones of equals."""
        parts, far, rank = list(text), float("inf"), self.rank.get
        weight = [rank(a + b, far) for a, b in zip(parts, parts[1:], strict=False)]
        while weight:
            least = min(weight)
            if least == far:
                break
            k = weight.index(least)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del weight[k]
            if k < len(weight):
                weight[k] = rank(parts[k] + parts[k + 1], far)
            if k:
                weight[k - 1] = rank(parts[k - 1] + parts[k], far)
        return parts

    def _admits(self, a: int, b: int) -> bool:
        """Whether piece b may follow piece a (-1: a place over which nothing merges)."""
        if len(self.follow) > 500_000:
            self.follow.clear()
        one, two = self.pieces[b], self.pieces[a] if a >= 0 else ""
        ok = self.follow[(a << 20) + b] = self._merge(two + one) == ([two, one] if two else [one])
        return ok

    # composition with one unit, and its shortest path
    def shortest(self, text: str) -> tuple[list[int], float]:
        """The path of least weight through the composed machines, as piece numbers (-1: one letter by the fallback)."""
        n, far = len(text), float("inf")
        best, last, before = [0.0] + [far] * n, [-1] * (n + 1), [0] * (n + 1)
        root, free, follow = self.root, self.kind == UNIGRAM, self.follow.get
        for s in range(n):
            here = best[s]
            if here == far:
                continue
            state, e, pair = root, s, last[s] << 20
            for c in text[s:]:
                if c not in state:
                    break
                state, k, weight = state[c]
                e += 1
                if k >= 0:
                    total = here + weight
                    if total < best[e]:
                        ok = free or follow(pair + k)
                        if ok is None:
                            ok = self._admits(last[s], k)
                        if ok:
                            best[e], last[e], before[e] = total, k, s
            if here + self.fallback < best[s + 1] and (text[s] not in root or root[text[s]][1] < 0):
                best[s + 1], last[s + 1], before[s + 1] = here + self.fallback, -1, s
        path = []
        at = n
        while at > 0:
            path.append(last[at])
            at = before[at]
        return path[::-1], best[n]

    def unit(self, text: str) -> list[int]:  # type: ignore[override]
        out: list[int] = []
        at, unknown = 0, False
        path = self.shortest(text)[0]
        if -1 not in path:
            return path
        for k in path:
            if k >= 0:
                out.append(k)
                at += len(self.pieces[k])
                unknown = False
                continue
            if self.bytes_:
                out += [self.bytes_.get(b, self.unknown) for b in text[at].encode("utf-8", "surrogatepass")]
            elif not unknown:  # a run of unknown letters is one piece
                out.append(self.unknown)
            at, unknown = at + 1, True
        return out

    def split(self, texts: list[str]) -> Split:  # type: ignore[override]
        normal = [self.normalise(t) for t in texts]
        size = np.array([len(t) for t in normal], np.int64)
        edge = np.concatenate([[0], np.cumsum(size)])
        cp = np.frombuffer("".join(normal).encode("utf-32-le", "surrogatepass"), np.uint32)
        n = len(cp)
        start = np.zeros(n + 1, bool)
        start[edge] = True
        start = start[:n]
        if n:
            mark = cp == ord(MARK)
            start[1:] |= mark[1:] & ~mark[:-1]
            for c in self.alone:
                own = cp == ord(c)
                start |= own
                start[1:] |= own[:-1]
        starts = np.flatnonzero(start)
        return cp, starts, np.append(starts[1:], n) if n else starts, np.searchsorted(edge, starts, "right") - 1

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.surface.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.dummy and text.startswith(" ") else text


def transducer(path: str) -> Transducer:
    """One for each model file and Python worker."""
    return _worker.model(("transducer", path), lambda: Transducer(path))


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids, n_ids, ids_crc32 (of little-endian unsigned 32-bit ids), round_trip for each row; round_trip tells
    whether decoding the ids gives the text back.

    Null and empty texts have no ids. Repeated rows are encoded each; an empty table gives no rows; other columns are
    not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = transducer(model)
        for b in _worker.parts(batches, "text", models=True):
            texts = strings(b, "text")
            ids, count = fst.encode(texts)
            edge = np.concatenate([[0], np.cumsum(count)])
            flat = ids.astype("<u4")
            crc = [zlib.crc32(flat[x:y].tobytes()) for x, y in zip(edge[:-1], edge[1:], strict=True)]
            back = [fst.decode(ids[x:y].tolist()) == t for x, y, t in zip(edge[:-1], edge[1:], texts, strict=True)]
            lists = pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([numbers(b, "doc_id"), lists, pa.array(count), pa.array(crc, pa.int64()), pa.array(back)], ["doc_id", "ids", "n_ids", "ids_crc32", "round_trip"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, "doc_id long, ids array<int>, n_ids long, ids_crc32 long, round_trip boolean")


def decode(encoded: DataFrame, model: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with a column text in place of the ids; null ids give a null text, no ids an empty one."""
    schema = encoded.drop(ids_col).schema.add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = transducer(model)
        for b in batches:
            at = b.schema.get_field_index(ids_col)
            texts = [None if x is None else fst.decode(x) for x in b.column(at).to_pylist()]
            rest = [k for k in range(b.num_columns) if k != at]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in rest), pa.array(texts, pa.string())], [*(b.schema.names[k] for k in rest), "text"])

    return encoded.mapInArrow(run, schema)
