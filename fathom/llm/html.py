"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks: the text between two block-level tags, with the path of open elements above it. Each
block becomes a vector (hashed path words, hashed text words, a few numbers); a bidirectional LSTM in numpy reads a
page's blocks in both directions and labels each as main text or not, with the whole page as context.

There are no labels, so the labeller learns from structure: blocks of a bounded sample of pages that stand in the
page's article element and in no element named for other uses, and pages laid out at random from the sample's own
sentences, in which menus, notices, adverts, forms, comments and article bodies stand under many names. Every page is
also learnt from with all names left out.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.llm import _worker
from fathom.llm._text import numbers, strings, words

_OPENS = re.compile(r"/?[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""[\s/]*(?:([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?)?""")
_NAMED = frozenset(("class", "id", "role", "itemprop"))
_PART = re.compile(r"[a-z]+")
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img picture source".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: Elements whose content is no text of the page.
_RAW = {t: re.compile(rf"</{t}(?=[\s/>]|$)", re.I) for t in "script style noscript template svg textarea iframe".split()}
_DEEP = 16  # of more open elements than twice so many, the path tells the outermost and the innermost ones

Block = tuple[str, tuple[str, ...], float]  # text, path words, share of it inside links


def _attributes(html: str, at: int) -> tuple[str, int]:
    """The naming words of a tag whose attributes begin at ``at``, and the place of its end sign."""
    named: list[str] = []
    while at < len(html) and html[at] != ">":
        m = _ATTRIBUTE.match(html, at)
        if m[1] and m[1].lower() in _NAMED:
            named.append(m[2] or m[3] or m[4] or "")
        at = m.end() if m.end() > at else at + 1
    return " ".join(named), at


def blocks(html: str) -> list[Block]:
    """The leaf blocks of a page in order: references decoded, white space made single spaces, empty ones left out.

    One pass: each place of the page is read by one tag, comment or text. A tag or comment without an end reaches to the
    end of the page, as in browsers; a sign that begins no tag is text."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    open_: dict[str, int] = {}
    text: list[str] = []
    linked = [0, 0]
    links = 0

    def end() -> None:
        nonlocal text
        if text:
            plain = " ".join(unescape("".join(text)).split())
            if plain:
                told = stack if len(stack) <= 2 * _DEEP else stack[:_DEEP] + stack[-_DEEP:]
                out.append((plain, tuple(w for _, ws in told for w in ws), linked[1] / max(1, linked[0])))
            text = []
            linked[0] = linked[1] = 0

    def say(piece: str) -> None:
        if piece:
            text.append(piece)
            linked[0] += len(piece)
            if links:
                linked[1] += len(piece)

    def pop() -> str:
        tag = stack.pop()[0]
        open_[tag] -= 1
        return tag

    def pop_to(tag: str) -> None:
        while open_.get(tag) and pop() != tag:
            pass

    at, n = 0, len(html)
    while at < n:
        begin = html.find("<", at)
        if begin < 0:
            say(html[at:])
            break
        m = _OPENS.match(html, begin + 1)
        if not m:
            if html.startswith("<!--", begin):
                say(html[at:begin])
                close = html.find("-->", begin + 4)
                at = n if close < 0 else close + 3
            elif html[begin + 1 : begin + 2] in ("!", "?", "/"):
                say(html[at:begin])
                close = html.find(">", begin + 2)
                at = n if close < 0 else close + 1
            else:
                say(html[at : begin + 1])
                at = begin + 1
            continue
        say(html[at:begin])
        closing = m[0][0] == "/"
        tag = m[0].lstrip("/").lower()
        named, close = _attributes(html, m.end())
        at = close + 1
        if tag in _RAW:
            if not closing and not (tag == "svg" and html[close - 1] == "/"):
                over = _RAW[tag].search(html, at)
                at = n if over is None else html.find(">", over.end()) + 1 or n
            continue
        if tag in _INLINE:
            if tag == "br":
                say(" ")
            elif tag == "a":
                links = 0 if closing else 1
            continue
        end()
        links = 0
        if closing:
            pop_to(tag)
        elif tag not in _VOID:
            if tag in _CLOSES_P:
                pop_to("p")
            elif tag in ("li", "option", "tr", "td", "th") and stack and stack[-1][0] == tag:
                pop()
            stack.append((tag, (f"<{tag}", *_PART.findall(named.lower()))))
            open_[tag] = open_.get(tag, 0) + 1
    end()
    return out


PATH, WORDS, NUMBERS = 192, 32, 8
WIDTH = PATH + WORDS + NUMBERS


def _path_slots(path: tuple[str, ...]) -> list[int]:
    last = max((k for k, w in enumerate(path) if w[0] == "<"), default=0)
    return sorted({zlib.crc32(w.encode()) % 128 for w in path} | {128 + zlib.crc32(b"last" + w.encode()) % 64 for w in path[last:]})


class Rows:
    """What describes blocks: the path of each as a number into the distinct paths, and the dense rest."""

    def __init__(self, paths: np.ndarray, path: np.ndarray, dense: np.ndarray):
        self.paths, self.path, self.dense = paths, path, dense

    def __len__(self) -> int:
        return len(self.path)

    def __getitem__(self, at: np.ndarray) -> Rows:
        return Rows(self.paths, self.path[at], self.dense[at])

    def project(self, w: np.ndarray) -> np.ndarray:
        return (self.paths @ w[:PATH])[self.path] + self.dense @ w[PATH:]

    def gradient(self, dz: np.ndarray) -> np.ndarray:
        by_path = np.zeros((len(self.paths), dz.shape[1]))
        np.add.at(by_path, self.path, dz)
        return np.vstack([self.paths.T @ by_path, self.dense.T @ dz])


def vectors(pages: list[list[Block]]) -> Rows:
    """A row for each block of all pages."""
    flat = [b for p in pages for b in p]
    number: dict[tuple[str, ...], int] = {}
    path = np.array([number.setdefault(p, len(number)) for _, p, _ in flat], np.int64)
    paths = np.zeros((len(number), PATH))
    for p, k in number.items():
        paths[k, _path_slots(p)] = 1
    dense = np.zeros((len(flat), WORDS + NUMBERS))
    if flat:
        h, of, _ = words([t for t, _, _ in flat])
        n = np.bincount(of, minlength=len(flat))
        count = np.bincount(of * WORDS + (h % np.uint64(WORDS)).astype(np.int64), minlength=len(flat) * WORDS).reshape(-1, WORDS)
        dense[:, :WORDS] = count / np.maximum(n, 1)[:, None]
        size = np.array([len(t) for t, _, _ in flat], float)
        place = np.concatenate([np.arange(len(p)) / len(p) for p in pages if p])
        many = np.repeat([len(p) for p in pages], [len(p) for p in pages])
        marks = np.array([t.count(",") + t.count(". ") + t.count("; ") for t, _, _ in flat], float)
        dense[:, WORDS:] = np.column_stack([np.log1p(size) / 5, np.log1p(n) / 4, [s for _, _, s in flat], [t[-1] in ".!?" for t, _, _ in flat], [len(p) / 8 for _, p, _ in flat], place, np.log1p(many) / 4, np.log1p(marks) / 2])
    return Rows(paths, path, dense)


class Labeller:
    """A bidirectional LSTM and a logistic output."""

    def __init__(self, hidden: int = 12, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        self.p = {}
        for d in ("f", "b"):
            self.p[f"wx{d}"] = rng.normal(0, 0.08, (WIDTH, 4 * hidden))
            self.p[f"wh{d}"] = rng.normal(0, 0.2, (hidden, 4 * hidden))
            self.p[f"c{d}"] = np.concatenate([np.ones(hidden), np.zeros(3 * hidden)])  # forget, in, out, new
        self.p["out"], self.p["bias"] = rng.normal(0, 0.2, 2 * hidden), np.zeros(1)

    @staticmethod
    def _cut(z: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
        s = 1 / (1 + np.exp(-np.clip(z[:, : 3 * n], -30, 30)))
        return s[:, :n], s[:, n : 2 * n], s[:, 2 * n :], np.tanh(z[:, 3 * n :])

    def _scan(self, zx: np.ndarray, mask: np.ndarray, d: str, tape: list | None = None) -> np.ndarray:
        """zx: (steps, pages, 4 hidden); padding carries the state on."""
        steps, rows, n = zx.shape[0], zx.shape[1], self.hidden
        h, c = np.zeros((rows, n)), np.zeros((rows, n))
        out = np.zeros((steps, rows, n))
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            f, i, o, g = self._cut(zx[t] + h @ self.p[f"wh{d}"], n)
            new = f * c + i * g
            squeezed = np.tanh(new)
            if tape is not None:
                tape.append((t, h, c, f, i, o, g, squeezed))
            m = mask[t][:, None]
            h, c = m * (o * squeezed) + (1 - m) * h, m * new + (1 - m) * c
            out[t] = h
        return out

    def _project(self, x: Rows) -> list[np.ndarray]:
        return [x.project(self.p[f"wx{d}"]) + self.p[f"c{d}"] for d in "fb"]

    @staticmethod
    def _pad(rows: np.ndarray, sizes: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of all pages as (steps, pages, width), the mask, and where each row went."""
        steps = max(sizes, default=0)
        page = np.repeat(np.arange(len(sizes)), sizes)
        step = np.concatenate([np.arange(s) for s in sizes]) if sizes else np.zeros(0, np.int64)
        out, mask = np.zeros((steps, len(sizes), rows.shape[1])), np.zeros((steps, len(sizes)))
        out[step, page], mask[step, page] = rows, 1
        return out, mask, step * len(sizes) + page

    def predict(self, x: Rows, sizes: list[int]) -> np.ndarray:
        """The probability of main text for each block; pages of like length go together."""
        out = np.zeros(len(x))
        first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        zf, zb = self._project(x)
        order = np.argsort(np.array(sizes), kind="stable")
        for a in range(0, len(order), 256):
            some = [k for k in order[a : a + 256].tolist() if sizes[k]]
            if not some:
                continue
            at = np.concatenate([np.arange(first[k], first[k + 1]) for k in some])
            own = [sizes[k] for k in some]
            (pf, mask, where), (pb, _, _) = self._pad(zf[at], own), self._pad(zb[at], own)
            h = np.concatenate([self._scan(pf, mask, "f"), self._scan(pb, mask, "b")], 2).reshape(-1, 2 * self.hidden)[where]
            out[at] = 1 / (1 + np.exp(-np.clip(h @ self.p["out"] + self.p["bias"], -30, 30)))
        return out

    def _step(self, x: Rows, y: np.ndarray, sizes: list[int]) -> dict[str, np.ndarray]:
        """Gradients of the mean logistic loss, by back-propagation through time."""
        n, grad = self.hidden, {k: np.zeros_like(v) for k, v in self.p.items()}
        z = self._project(x)
        tapes: dict[str, list] = {"f": [], "b": []}
        padded = [self._pad(v, sizes) for v in z]
        mask, where = padded[0][1], padded[0][2]
        hs = [self._scan(padded[k][0], mask, d, tapes[d]) for k, d in enumerate("fb")]
        h = np.concatenate(hs, 2).reshape(-1, 2 * n)[where]
        p = 1 / (1 + np.exp(-np.clip(h @ self.p["out"] + self.p["bias"], -30, 30)))
        e = (p - y) / len(y)
        grad["out"], grad["bias"] = h.T @ e, np.array([e.sum()])
        dh_all = np.zeros((mask.size, 2 * n))
        dh_all[where] = e[:, None] * self.p["out"]
        dh_all = dh_all.reshape(*mask.shape, 2 * n)
        for k, d in enumerate("fb"):
            dz_all = np.zeros_like(padded[k][0])
            dh, dc = np.zeros((mask.shape[1], n)), np.zeros((mask.shape[1], n))
            for t, h0, c0, f, i, o, g, s in reversed(tapes[d]):
                m = mask[t][:, None]
                dh = dh + dh_all[t][:, k * n : (k + 1) * n]
                inner = m * (dc + dh * o * (1 - s * s))
                dz = np.concatenate([inner * c0 * f * (1 - f), inner * g * i * (1 - i), m * dh * s * o * (1 - o), inner * i * (1 - g * g)], 1)
                dz_all[t] = dz
                grad[f"wh{d}"] += h0.T @ dz
                dh, dc = dz @ self.p[f"wh{d}"].T + (1 - m) * dh, inner * f + (1 - m) * dc
            flat = dz_all.reshape(-1, 4 * n)[where]
            grad[f"wx{d}"], grad[f"c{d}"] = x.gradient(flat), flat.sum(0)
        return grad

    def fit(self, pages: list[list[Block]], labels: list[np.ndarray], epochs: int = 4, batch: int = 16, rate: float = 0.02, seed: int = 5) -> Labeller:
        rng = np.random.default_rng(seed)
        x, sizes = vectors(pages), [len(p) for p in pages]
        first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        m1 = {k: np.zeros_like(v) for k, v in self.p.items()}
        m2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        turn = 0
        for _ in range(epochs):
            order = [k for k in rng.permutation(len(pages)).tolist() if sizes[k]]
            for a in range(0, len(order), batch):
                some = order[a : a + batch]
                at = np.concatenate([np.arange(first[k], first[k + 1]) for k in some])
                grad = self._step(x[at], np.concatenate([labels[k] for k in some]), [sizes[k] for k in some])
                turn += 1
                for k, g in grad.items():
                    g = np.clip(g, -1, 1)
                    m1[k] = 0.9 * m1[k] + 0.1 * g
                    m2[k] = 0.99 * m2[k] + 0.01 * g * g
                    self.p[k] = self.p[k] - rate * (m1[k] / (1 - 0.9**turn)) / (np.sqrt(m2[k] / (1 - 0.99**turn)) + 1e-8)
        return self


#: Names under which pages hold other things than their article, and names of article bodies.
OTHER_NAMES = {
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs toc",
    "head": "header masthead topbar banner site-header",
    "foot": "footer bottom copyright site-footer colophon",
    "side": "sidebar aside related widget recommended trending",
    "notice": "notice cookie consent alert popup newsletter subscribe disclaimer",
    "advert": "ad ads advert advertisement sponsor sponsored promo",
    "form": "form search login signup contact",
    "comments": "comments comment reply replies discussion respond",
    "share": "share social sharing",
}
BODY_NAMES = "content post entry story article article-body post-content entry-content body text main-content".split()
_TAGS = {"menu": ("nav", "div", "ul"), "head": ("header", "div"), "foot": ("footer", "div"), "side": ("aside", "div"), "form": ("form", "div"), "comments": ("section", "div", "ol")}
_BAD = frozenset(w for v in OTHER_NAMES.values() for n in v.split() for w in n.split("-")) - {"site", "top"} | {"<nav", "<header", "<footer", "<aside", "<form", "<head", "<title", "<button", "<select", "<dialog"}
_GOOD = frozenset({"<article", "<main"})


def structural_labels(page: list[Block]) -> np.ndarray:
    """1 for blocks inside an article or main element and in no element named for another use."""
    return np.array([float(bool(_GOOD & set(path)) and not (_BAD & set(path))) for _, path, _ in page])


def random_page(sentences: list[str], rng: np.random.Generator) -> tuple[list[Block], np.ndarray]:
    """A page of a random layout over the sentences, and its labels."""
    pick = lambda options: options[int(rng.integers(len(options)))]
    say = lambda: pick(sentences)
    page: list[Block] = []
    truth: list[float] = []

    def add(path: tuple[str, ...], text: str, good: bool, linked: float = 0.0) -> None:
        page.append((text, path, linked))
        truth.append(float(good))

    def other(kind: str, above: tuple[str, ...]) -> None:
        tag = pick(_TAGS.get(kind, ("div", "section")))
        named = tuple(pick(OTHER_NAMES[kind].split()).split("-")) if tag in ("div", "section", "ol", "ul") or rng.random() < 0.5 else ()
        path = (*above, f"<{tag}", *named)
        if kind == "menu":
            for _ in range(int(rng.integers(2, 8))):
                add((*path, "<ul", "<li"), say().split(" ")[0], False, 1.0)
        elif kind == "comments":
            for _ in range(int(rng.integers(1, 4))):
                add((*path, pick(("<p", "<li", "<div"))), say(), False)
        else:
            add(path if rng.random() < 0.6 else (*path, "<p"), say()[: int(rng.integers(10, 300))], False, float(rng.random() < 0.3))

    root = ("<html", "<body")
    add(("<html", "<head", "<title"), say()[:80], False)
    for kind in ("head", "menu", "notice", "advert"):
        if rng.random() < 0.5:
            other(kind, root)
    wrap = (f"<{pick(('article', 'main'))}",) if rng.random() < 0.6 else ("<div", *pick(BODY_NAMES).split("-"))
    if rng.random() < 0.3:
        wrap = ("<div", pick(("wrapper", "container", "page", "row")), *wrap)
    body = (*root, *wrap)
    add((*body, pick(("<h1", "<h2"))), say()[:90], True)
    for _ in range(int(rng.integers(1, 14))):
        tag = pick(("<p", "<p", "<p", "<p", "<h2", "<blockquote", "<li"))
        add((*body, "<ul", tag) if tag == "<li" else (*body, tag), say() if rng.random() < 0.9 else say().split(" ")[0], True)
        if rng.random() < 0.12:
            other(pick(("advert", "side", "notice", "share", "form")), body)
    for kind in ("comments", "share", "side", "form", "notice", "advert", "foot"):
        if rng.random() < 0.4:
            other(kind, body if kind in ("comments", "share") and rng.random() < 0.3 else root)
    return page, np.array(truth)


def nameless(page: list[Block]) -> list[Block]:
    """The page with every class, id and role left out: what is left are tags, text, links and places."""
    return [(t, tuple(w for w in path if w[0] == "<"), s) for t, path, s in page]


def sample(pages: DataFrame, most_pages: int, id_col: str = "page_id", html_col: str = "html") -> list[list[Block]]:
    """Blocks of the pages of smallest hash of the id; of repeated ids one page. Only the chosen pages travel."""
    own = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html")).filter("html IS NOT NULL AND id IS NOT NULL")
    few = own.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(most_pages)
    rows = own.join(F.broadcast(few), "id", "left_semi").groupBy("id").agg(F.min("html").alias("html"))
    return [p for p in (blocks(html) for _, html in sorted(map(tuple, rows.collect()))) if p]


def train(pages: DataFrame, most_pages: int = 160, made: int = 320, id_col: str = "page_id", html_col: str = "html") -> Labeller:
    """Fits on at most ``most_pages`` pages (those of smallest hash of the id) and as many random layouts as ``made``.

    Each page is learnt from twice, the second time without the names in it, so that text, links and place in the page
    have to tell what names else would. Null pages and null ids are left out; of repeated ids one page counts; without
    any page the layouts alone are learnt; other columns are not read.
    """
    own = sample(pages, most_pages, id_col, html_col)
    sentences = sorted({t for p in own for t, _, _ in p}) or ["Lorem ipsum."]
    rng = np.random.default_rng(3)
    drawn = [random_page(sentences, rng) for _ in range(made)]
    labelled = [(p, structural_labels(p)) for p in own]
    labelled = [(p, y) for p, y in labelled if y.any()] + drawn  # a page without an article teaches nothing
    return Labeller().fit([p for p, _ in labelled] + [nameless(p) for p, _ in labelled], [y for _, y in labelled] * 2)


def extract(pages: DataFrame, model: Labeller, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars for each row.

    A null page counts as empty; a page without main text gives an empty text. Repeated rows are extracted each; an
    empty table gives no rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _worker.parts(batches, "html"):
            found = [blocks(h) for h in strings(b, "html")]
            sizes = [len(p) for p in found]
            good = model.predict(vectors(found), sizes) >= 0.5
            texts, at = [], 0
            for p in found:
                texts.append("\n".join(t for (t, _, _), ok in zip(p, good[at : at + len(p)], strict=True) if ok))
                at += len(p)
            yield pa.RecordBatch.from_arrays([numbers(b, "page_id"), numbers(b, "url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    narrow = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    return narrow.mapInArrow(run, "page_id long, url string, text string, n_chars long")
