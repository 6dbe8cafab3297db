"""Toxicity by a subsequence string kernel and a support vector machine on Nyström landmarks.

The kernel of two tokens sums, over the letter subsequences of length 3 and 4 that both hold within ``SPAN`` letters,
``DECAY`` to the power of the letters spanned in each, and is normalised; so an insult with inserted or left-out
letters stays close to the plain one. Landmarks are tokens that labelled toxic sentences hold far more often than
others. Tokens near a landmark are the instances: the Nyström map turns their kernel values into coordinates for a
linear machine with squared hinge loss, which learns from how many toxic and other texts hold each.

Disguises that leave no token near are looked for in short windows of the text's letters, whatever stands between them:
a landmark's letters in order, with one more letter at most after each. Such a window has one of ``FORMS`` forms (a part
of a longer token, over white space, with letters inserted). Chance makes some forms of some landmarks common in harmless
texts; a form counts like its landmark only where the labelled texts do not show that (see ``admitted``).

A text is judged by its largest margin and by how many tokens and windows lie on the toxic side, calibrated to a
probability by logistic regression.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.llm import _worker
from fathom.llm._text import numbers, span_hashes, strings
from fathom.llm.quality import labelled_sample, remainder

SPAN, DECAY, NEAR = 6, 0.6, 0.5
#: Gaps between the letters of a subsequence, by how far they reach.
_GAPS = {r: [(a, r - a) for a in range(1, r)] + [(a, b, r - a - b) for a in range(1, r) for b in range(1, r - a)] for r in range(2, SPAN)}
_WIDTH = 1 << 20  # codes of four letters of five bits; three letters begin with 0
_EDGE = 27  # stands before and after each token, so that its first and last letters count more
_UNIT = 32  # a longer token counts as overlapping windows of so many letters
_BEYOND = 0x250
_SPACE = 255


def _letters() -> np.ndarray:
    """Letters without accents as 1 to 26; other letters share 28 to 31; white space; 0 for all else."""
    out = np.zeros(_BEYOND + 1, np.uint8)
    for c in range(_BEYOND):
        plain = unicodedata.normalize("NFD", chr(c).lower())[0]
        if plain.isalpha():
            out[c] = ord(plain) - 96 if "a" <= plain <= "z" else 28 + ord(plain) % 4
        elif chr(c).isspace():
            out[c] = _SPACE
    return out


_CODE = _letters()

Stream = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # code, text, token of each letter; whether it stands alone


def letters(texts: list[str]) -> Stream:
    """The letters of all texts in a row. Tokens are what stands between white space."""
    cp = np.frombuffer("\n".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) + 1 for t in texts])
    code = _CODE[np.minimum(cp, _BEYOND)]
    high = np.flatnonzero(cp >= _BEYOND)
    if len(high):
        kind, back = np.unique(cp[high], return_inverse=True)
        code[high] = np.array([28 + int(k) % 4 if chr(k).isalpha() else _SPACE if chr(k).isspace() else 0 for k in kind], np.uint8)[back]
    space = code == _SPACE
    at = np.flatnonzero((code > 0) & ~space)
    token = np.cumsum(space, dtype=np.int32)
    return code[at], owner[at - 1], token[at], space[at - 1] & space[np.minimum(at + 1, len(space) - 1)]


def units(stream: Stream) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end, in the letters, of each token, and of each run of four or more letters set apart one by one."""
    code, _, token, alone = stream
    if not len(code):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    step = np.diff(token, prepend=token[0] - 2)
    starts = np.flatnonzero(step)
    ends = np.append(starts[1:], len(code))
    run = np.flatnonzero(~(alone & (step == 1) & np.append(False, alone[:-1])))
    over = np.append(run[1:], len(code))
    many = over - run >= 4
    starts, ends = np.concatenate([starts, run[many]]), np.concatenate([ends, over[many]])
    size = ends - starts
    n = np.where(size <= _UNIT, 1, -(-(size - _UNIT // 2) // (_UNIT // 2)))
    if (n > 1).any():
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        starts, ends = np.repeat(starts, n) + nth * (_UNIT // 2), np.repeat(ends, n)
    return starts, np.minimum(ends, starts + _UNIT)


def spell(code: np.ndarray) -> str:
    """Letter codes as text: a to z, and four signs for all other letters."""
    return (code + np.uint8(96)).tobytes().decode("latin-1")


def plain(token: str) -> str:
    return spell(letters([token])[0])


def tokens(text: str) -> set[str]:
    """The letters of a text's units."""
    stream = letters([text])
    return {spell(stream[0][a:b]) for a, b in zip(*units(stream), strict=True)}


def _edged(code: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters of the units in a row, whose they are, and each unit's length, edges included."""
    size = (ends - starts).astype(np.int64)
    begin = np.cumsum(size + 2) - size - 1
    out = np.full(int((size + 2).sum()), _EDGE, np.int32)
    nth = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(begin, size) + nth] = code[np.repeat(starts, size) + nth]
    return out, np.repeat(np.arange(len(size)), size + 2), size + 2


def _named(names: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for spelled units."""
    code = np.frombuffer("".join(names).encode("latin-1"), np.uint8) - np.uint8(96)
    size = np.array([len(n) for n in names], np.int64)
    return _edged(code, np.cumsum(size) - size, np.cumsum(size))


def _subsequences(c: np.ndarray, owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each pattern of gaps: (owner, code) of the subsequences, and their weight."""
    for reach, patterns in _GAPS.items():
        if len(c) > reach:
            ok = np.flatnonzero(owner[: len(c) - reach] == owner[reach:])
            own, first = owner[ok], c[ok]
            later = [first, *(c[ok + g] for g in range(1, reach + 1))]
            for gaps in patterns:
                k, at = first, 0
                for g in gaps:
                    at += g
                    k = k * 32 + later[at]
                yield own, k, DECAY ** (reach + 1)


def _norms(c: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """The kernel of each unit with itself, its square root."""
    parts = [(own.astype(np.int64) * _WIDTH + k, np.full(len(k), w)) for own, k, w in _subsequences(c, owner)]
    if not parts:
        return np.zeros(n)
    key, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    w = np.bincount(back, np.concatenate([w for _, w in parts]), len(key))
    return np.sqrt(np.bincount(key // _WIDTH, w * w, n))


@dataclass
class Landmarks:
    """Kernel values of units with fixed landmarks, as a table by subsequence."""

    names: list[str]

    def __post_init__(self) -> None:
        m = max(1, len(self.names))
        c, owner, _ = _named(self.names)
        norm = np.maximum(_norms(c, owner, m), 1e-12)
        parts = [(k.astype(np.int64) * m + own, w / norm[own]) for own, k, w in _subsequences(c, owner)]
        key, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.share = np.bincount(back, np.concatenate([w for _, w in parts]), len(key)) if parts else np.zeros(0)
        self.of = key % m
        self.begin = np.searchsorted(key // m, np.arange(_WIDTH + 1)).astype(np.int32)
        self.peak = np.zeros(_WIDTH, np.float32)
        np.maximum.at(self.peak, key // m, self.share)

    def __reduce__(self):  # tasks get the names alone
        return Landmarks, (self.names,)

    def values(self, c: np.ndarray, owner: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(units that can be near a landmark, their normalised kernel with each landmark), from edged letters.

        A unit's norm is at least that of its subsequences counted singly, and its kernel with any landmark at most the
        sum of its subsequences' largest shares: units for which that leaves no value of ``NEAR`` are passed over."""
        n, m = len(size), len(self.names)
        most, least = np.zeros(n), np.zeros(n)
        for own, k, w in _subsequences(c, owner):
            most += np.bincount(own, self.peak[k], n) * w
        for reach, patterns in _GAPS.items():
            least += np.maximum(0, size - reach) * (len(patterns) * DECAY ** (2 * reach + 2))
        near = np.flatnonzero(most >= NEAR * np.sqrt(np.maximum(least, 1e-12)) - 1e-9) if m else np.zeros(0, np.int64)
        if not len(near):
            return near, np.zeros((0, m))
        new = np.full(n, -1, np.int64)
        new[near] = np.arange(len(near))
        ok = new[owner] >= 0
        c, owner = c[ok], new[owner[ok]]
        sums = np.zeros(len(near) * m)
        for own, k, w in _subsequences(c, owner):
            lo = self.begin[k]
            many = self.begin[k + 1] - lo
            hit = np.flatnonzero(many)
            if len(hit):
                lo, many = lo[hit], many[hit]
                upto = np.cumsum(many)
                at = np.repeat(lo - (upto - many), many) + np.arange(upto[-1])
                sums += np.bincount(np.repeat(own[hit] * m, many) + self.of[at], self.share[at] * w, len(sums))
        sums = sums.reshape(len(near), m)
        some = np.flatnonzero(sums.max(1) >= NEAR * np.sqrt(np.maximum(least[near], 1e-12)))
        # the norm is `least` at least; it is worked out where that leaves a value near
        again = np.full(len(near), -1, np.int64)
        again[some] = np.arange(len(some))
        ok = again[owner] >= 0
        exact = _norms(c[ok], again[owner[ok]], len(some))
        return near[some], sums[some] / np.maximum(exact, 1e-12)[:, None]

    def kernel(self, names: list[str]) -> np.ndarray:
        """Normalised kernel of each spelled unit with each landmark; 0 where it can't reach ``NEAR``."""
        out = np.zeros((len(names), len(self.names)), np.float32)
        for a in range(0, len(names), 10_000):
            near, value = self.values(*_named(names[a : a + 10_000]))
            out[a + near] = value
        return out


FEATURES = 3
_MEMO = 19  # bits
#: Whole tokens or parts, without or with inserted letters, in one token, over several, or over tokens of one letter each.
FORMS = 12


def _short_runs(stream: Stream) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code, text and token of the letters; of a run of one letter two stay."""
    code, owner, token, _ = stream
    run = np.zeros(len(code), bool)
    run[2:] = (code[2:] == code[1:-1]) & (code[2:] == code[:-2]) & (token[2:] == token[:-2])
    code, owner, token = code[~run], owner[~run], token[~run]
    return code.astype(np.int32), owner, np.cumsum(np.diff(token, prepend=token[:1]) != 0)


class Windows:
    """Finds landmarks in letter streams: their letters in order, with one letter more at most after each."""

    def __init__(self, names: list[str]) -> None:
        self.size = np.array([len(n) for n in names], np.int64)
        child, end = [[-1] * 32], [[]]
        for i, n in enumerate(names):
            at = 0
            own = _named([n])[0][1:-1]
            zero = np.zeros(len(own), np.int32)
            for c in _short_runs((own, zero, zero, zero))[0].tolist():
                if child[at][c] < 0:
                    child[at][c] = len(child)
                    child.append([-1] * 32)
                    end.append([])
                at = child[at][c]
            if at:
                end[at].append(i)
        self.child = np.array(child, np.int32)
        width = max(map(len, end))
        self.end = np.array([e + [-1] * (width - len(e)) for e in end], np.int64).reshape(len(end), width)
        pair = np.full((32, 32), -1, np.int32)
        for c in range(32):
            if child[0][c] >= 0:
                pair[c] = self.child[child[0][c]]
        self.pair = pair.ravel()

    def find(self, texts: list[str] | Stream, allowed: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, landmark, form) of the windows, each once, of the ``allowed`` forms of each landmark if given; tokens
        that are the landmark itself are left out."""
        c, owner, token = _short_runs(letters(texts) if isinstance(texts, list) else texts)
        n = len(c)
        out: list[np.ndarray] = []
        start, at, node, more = [], [], [], []
        for g in (1, 2):
            if n > g:
                to = self.pair[c[:-g] * 32 + c[g:]]
                ok = np.flatnonzero(to >= 0)
                ok = ok[owner[ok] == owner[ok + g]]
                start.append(ok), at.append(ok + g), node.append(to[ok]), more.append(np.full(len(ok), g > 1))
        first = np.diff(token, prepend=-1) != 0
        last = np.diff(token, append=-1) != 0
        while start:
            x, y, k, m = (np.concatenate(v) for v in (start, at, node, more))
            for e in self.end.T:
                hit = np.flatnonzero(e[k] >= 0)
                if len(hit):
                    a, b, i = x[hit], y[hit], m[hit]
                    beyond = np.minimum(b + 1, n - 1)
                    ends = last[b] | ((owner[beyond] == owner[b]) & last[beyond])
                    i = i | (first[a] & ends & ~last[b])
                    tokens_ = token[b] - token[a]
                    over = np.where(tokens_ == 0, 0, np.where(tokens_ == b - a, 2, 1))
                    form = ((first[a] & ends) * 2 + i) * 3 + over
                    ok = (form != 6) if allowed is None else (form != 6) & allowed[e[k[hit]], form]
                    out.append((owner[a[ok]] * len(self.size) + e[k[hit[ok]]]) * FORMS + form[ok])
            start, at, node, more = [], [], [], []
            for g in (1, 2):
                ok = np.flatnonzero(y + g < n)
                ok = ok[owner[x[ok]] == owner[y[ok] + g]]
                to = self.child[k[ok], c[y[ok] + g]]
                go = to >= 0
                if go.any():
                    ok = ok[go]
                    start.append(x[ok]), at.append(y[ok] + g), node.append(to[go]), more.append(m[ok] | (g > 1))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        key = np.unique(np.concatenate(out))
        return key // FORMS // len(self.size), key // FORMS % len(self.size), key % FORMS


def admitted(bad: np.ndarray, good: np.ndarray, size: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Whether a form (column) of a landmark (row) counts, from how many toxic and other texts hold it: where landmarks
    of that length seldom have the form in other texts, and this one in none or far more often in toxic ones."""
    rare = np.zeros(good.shape, bool)
    for s in np.unique(size):
        rare[size == s] = good[size == s].mean(0) < 0.1
    often = (bad >= 3) & (bad / max(1, n1) >= 20 * (good + 1) / max(1, n0))
    return rare & (good == 0) | often


@dataclass
class Machine:
    landmarks: Landmarks
    weight: np.ndarray  # over kernel values: the machine's weights through the Nyström map
    bias: float
    logit: np.ndarray  # over the features of a text, the constant last
    forms: np.ndarray = field(default_factory=lambda: np.zeros((0, FORMS), bool))  # by landmark, those that count
    finder: tuple[Windows, np.ndarray] | None = None
    memo: tuple[np.ndarray, np.ndarray] | None = None  # hashes of units and their margins, by the hash's first bits

    def __reduce__(self):  # what is known of units stays with its worker
        return Machine, (self.landmarks, self.weight, self.bias, self.logit, self.forms)

    def windows(self, stream: Stream) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, landmark, form) of the windows of landmarks on the toxic side; once forms are told, of those that count."""
        names = self.landmarks.names
        if not names or not len(self.weight):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        if self.finder is None:
            self.own = self._margins(*self.landmarks.values(*_named(names)), len(names))
            toxic = np.flatnonzero((self.own > 0) & (self.forms.any(1) if len(self.forms) else True))
            self.finder = Windows([names[i] for i in toxic]), toxic
        t, i, f = self.finder[0].find(stream, self.forms[self.finder[1]] if len(self.forms) else None)
        return t, self.finder[1][i] if len(i) else i, f

    def _margins(self, near: np.ndarray, k: np.ndarray, n: int) -> np.ndarray:
        """The machine's margin of n units; -1 where no landmark is near."""
        out = np.full(n, -1.0)
        if len(near) and len(self.weight):
            reached = k.max(1) >= NEAR
            out[near[reached]] = np.where(k >= NEAR, k, 0)[reached] @ self.weight + self.bias
        return out

    def margins(self, code: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A hash of each unit, and its margin. Margins of units are remembered in a table of fixed size."""
        if self.memo is None:
            self.memo = np.zeros(1 << _MEMO, np.uint64), np.zeros(1 << _MEMO, np.float32)
        key, value = self.memo
        h = span_hashes(code, starts, ends) | np.uint64(1)  # never the 0 of an empty place
        slot = (h >> np.uint64(64 - _MEMO)).astype(np.int64)
        out = value[slot].astype(float)
        miss = np.flatnonzero(key[slot] != h)
        if len(miss):
            new, first, back = np.unique(h[miss], return_index=True, return_inverse=True)
            at = miss[first]
            found = np.full(len(at), -1.0)
            for a in range(0, len(at), 10_000):
                own = at[a : a + 10_000]
                found[a : a + 10_000] = self._margins(*self.landmarks.values(*_edged(code, starts[own], ends[own])), len(own))
            found = found.astype(np.float32)
            out[miss] = found[back]
            key[slot[at]], value[slot[at]] = new, found
        return h, out

    def features(self, texts: list[str]) -> np.ndarray:
        """Largest margin, and logarithms of how many different units and disguised landmarks have a margin over 0 and
        over 0.5."""
        stream = letters(texts)
        starts, ends = units(stream)
        h, m = self.margins(stream[0], starts, ends)
        near = np.flatnonzero(m > -1.0)
        doc = stream[1][starts[near]].astype(np.int64)
        _, one = np.unique(np.stack([doc.astype(np.uint64), h[near]]), axis=1, return_index=True) if len(near) else (None, near)
        doc, m = doc[one], m[near[one]]
        if self.forms.any():
            t, i, _ = self.windows(stream)
            pair = np.unique(t.astype(np.int64) * len(self.landmarks.names) + i)
            doc, m = np.append(doc, pair // len(self.landmarks.names)), np.append(m, self.own[pair % len(self.landmarks.names)])
        top = np.full(len(texts), -1.0)
        np.maximum.at(top, doc, m)
        return np.column_stack([np.minimum(top, 2.0), *(np.log1p(np.bincount(doc, m > over, len(texts))) for over in (0, 0.5))])

    def predict(self, texts: list[str]) -> np.ndarray:
        raw = self.features(texts) @ self.logit[:-1] + self.logit[-1]
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def choose(candidates: list[str], most: int, apart: float = 0.8) -> list[str]:
    """The first candidates that are not nearly equal (kernel ``apart``) to an earlier one."""
    taken: list[str] = []
    names = list(dict.fromkeys(candidates))
    if not names:
        return []
    k = Landmarks(names).kernel(names)
    rows: list[int] = []
    for i, p in enumerate(names):
        if len(taken) < most and (not rows or k[i, rows].max() < apart):
            taken.append(p)
            rows.append(i)
    return taken


def fit_tokens(landmarks: Landmarks, names: list[str], bad: np.ndarray, good: np.ndarray, cost: float = 0.3) -> tuple[np.ndarray, float]:
    """A linear machine with squared hinge loss over Nyström coordinates, by Newton steps. Each token stands on the
    toxic side as often as toxic texts hold it, and on the other side as often as others do."""
    m = len(landmarks.names)
    if not m or not names:
        return np.zeros(m), -1.0
    k = landmarks.kernel(landmarks.names).astype(float)
    value, vector = np.linalg.eigh((k + k.T) / 2)
    nystrom = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-2))) @ vector.T
    x = landmarks.kernel(names).astype(float)
    x[x < NEAR] = 0
    one = np.column_stack([x @ nystrom, np.ones(len(x))])
    z, s, c = np.vstack([one, one]), np.repeat([1.0, -1.0], len(one)), cost * np.concatenate([bad, good])
    w, ridge = np.zeros(m + 1), np.diag(np.append(np.ones(m), 1e-6))
    for _ in range(40):
        on = s * (z @ w) < 1
        zc = z[on] * c[on, None]
        new = np.linalg.solve(ridge + zc.T @ z[on], zc.T @ s[on])
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return nystrom @ w[:m], float(w[m])


def fit_texts(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Logistic regression by Newton steps; without both labels the constant tells their share."""
    z = np.column_stack([x, np.ones(len(x))]) if len(x) else np.zeros((0, FEATURES + 1))
    w = np.zeros(FEATURES + 1)
    share = (y.sum() + 0.5) / (len(y) + 100) if len(y) else 0.001
    w[-1] = np.log(share / (1 - share))
    if not len(x) or y.min() == y.max():
        return w
    keep_small = np.diag(np.append(np.full(FEATURES, ridge), 1e-6))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + keep_small + 1e-6 * np.eye(len(w)), z.T @ (p - y) + keep_small @ w)
        w = w - step * min(1.0, 3.0 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", divisor: int = 4, held_out: int = 2, most_rows: int = 12_000, most_landmarks: int = 160, most_candidates: int = 2_000, most_tokens: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> Machine:
    """Fits on at most ``most_rows`` labelled rows (those of smallest hash of the id; null labels are left out).

    Of the units told by their labels, the ``most_candidates`` of largest gain are looked through for at most
    ``most_landmarks`` that are unlike each other, and the ``most_tokens`` commonest units near a landmark are learnt
    from: bounds of the fit, not of what is scored. Without labels, or with one label only, the machine has no landmarks.
    Extra columns are not read; an empty table gives the same machine as no labels.
    """
    from fathom.llm._store import keep

    sample = keep(labelled_sample(docs, labels, label, remainder(F.col("doc_id"), divisor) != held_out, most_rows, id_col, text_col))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _worker.parts(batches, "text"):
            y = np.array(numbers(b, "y").to_pylist(), np.int64) > 0
            stream = letters(strings(b, "text"))
            starts, ends = units(stream)
            fit_ = (ends - starts >= 3) & (ends - starts <= _UNIT)
            starts, ends = starts[fit_], ends[fit_]
            h, doc = span_hashes(stream[0], starts, ends), stream[1][starts].astype(np.int64)
            order = np.lexsort((doc, h))
            h, doc = h[order], doc[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
            order, h, toxic = order[new], h[new], y[doc[new]]
            first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
            names = [spell(stream[0][starts[i] : ends[i]]) for i in order[first].tolist()]
            bad = np.add.reduceat(toxic.astype(np.int64), first) if len(h) else first
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(bad), pa.array(np.diff(np.append(first, len(h))) - bad)], ["token", "bad", "good"])

    both = {r["y"] > 0: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n1, n0 = both.get(True, 0), both.get(False, 0)
    names: list[str] = []
    if n1 and n0:
        seen = sample.mapInArrow(count, "token string, bad long, good long").groupBy("token").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        # log-likelihood gain of a token over the share of toxic rows; chance gives one token in some hundreds so much
        seen = keep(seen)
        total, base = F.col("bad") + F.col("good"), n1 / (n1 + n0)
        share = F.col("bad") / total
        other = F.when(F.col("good") > 0, F.col("good") * F.log((1 - share) / (1 - base))).otherwise(0.0)
        told = seen.withColumn("gain", F.col("bad") * F.log(share / base) + other).filter((share >= 4 * base / (1 + 3 * base)) & (F.col("gain") >= float(np.log(max(2, seen.count()))) - 1))
        names = [r["token"] for r in told.orderBy(F.desc("gain"), "token").limit(most_candidates).collect()]
    machine = Machine(Landmarks(choose(names, most_landmarks)), np.zeros(0), -1.0, np.zeros(FEATURES + 1))
    if names:
        landmarks = machine.landmarks

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield b.filter(pa.array(landmarks.kernel(numbers(b, "token").to_pylist()).max(1, initial=0) >= NEAR))

        close = seen.mapInArrow(near, seen.schema).orderBy(F.desc(F.col("bad") + F.col("good")), "token").limit(most_tokens).collect()
        machine.weight, machine.bias = fit_tokens(landmarks, [r["token"] for r in close], np.array([r["bad"] for r in close], float), np.array([r["good"] for r in close], float))

        def disguises(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in _worker.parts(batches, "text"):
                y = np.array(numbers(b, "y").to_pylist(), np.int64) > 0
                t, i, f = machine.windows(letters(strings(b, "text")))
                key, at = np.unique(i * FORMS + f, return_inverse=True)
                one = [np.bincount(at, y[t] == v, len(key)).astype(np.int64) for v in (True, False)]
                yield pa.RecordBatch.from_arrays([pa.array(key), *map(pa.array, one)], ["key", "bad", "good"])

        held = np.zeros((2, len(landmarks.names) * FORMS))
        for r in sample.mapInArrow(disguises, "key long, bad long, good long").groupBy("key").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).collect():
            held[:, r["key"]] = r["bad"], r["good"]
        size = np.array([len(n) for n in landmarks.names])
        machine.forms = admitted(*held.reshape(2, -1, FORMS), size, n1, n0)
    else:
        machine.weight = np.zeros(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _worker.parts(batches, "text"):
            x = machine.features(strings(b, "text"))
            yield pa.RecordBatch.from_arrays([numbers(b, "doc_id"), pa.array(list(x), pa.list_(pa.float64())), numbers(b, "y")], ["doc_id", "x", "y"])

    rows = sorted((r["doc_id"], list(r["x"]), r["y"]) for r in sample.mapInArrow(run, "doc_id long, x array<double>, y int").collect())
    machine.logit = fit_texts(np.array([x for _, x, _ in rows], float).reshape(len(rows), FEATURES), np.array([float(y > 0) for _, _, y in rows]))
    return machine


def _kept(model: Machine) -> Machine:
    """The Python worker's copy of a machine."""
    name = hashlib.md5(repr(model.landmarks.names).encode() + model.weight.tobytes() + model.logit.tobytes() + model.forms.tobytes()).hexdigest()
    return _worker.model(name, lambda: model)


def score(docs: DataFrame, model: Machine, divisor: int = 4, held_out: int = 2, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for each row.

    A null text counts as empty; an empty text is near no landmark. Equal texts get equal scores; repeated rows are
    scored each. Without toxic labels the score is near 0 everywhere. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _kept(model)
        for b in _worker.parts(batches, "text", models=True):
            yield pa.RecordBatch.from_arrays([numbers(b, "doc_id"), pa.array(own.predict(strings(b, "text")))], ["doc_id", "score"])

    scored = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", (remainder(F.col("doc_id"), divisor) == held_out).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def filter_rows(docs: DataFrame, model: Machine, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text stays under the threshold, with all their columns.

    Null and empty texts are kept, as they are near no landmark; equal texts are kept or dropped alike, repeated rows
    each; an empty table gives no rows; other columns are carried along, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _kept(model)
        for b in _worker.parts(batches, text_col, models=True):
            yield b.filter(pa.array(own.predict(strings(b, text_col)) < threshold))

    return docs.mapInArrow(run, docs.schema)
