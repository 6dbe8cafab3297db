"""Near-duplicate documents by ProbMinHash over weighted word shingles, banding and exact verification.

A document is the multiset of its runs of five words; a shingle weighs as often as it occurs. Each shingle is the
source of a Poisson process with its weight as rate; its arrivals fall on random registers, a register keeps the
earliest arrival, and a shingle stops as soon as its next arrival comes after the latest register. The share of equal
registers of two documents estimates the probability Jaccard similarity

    J_P(x, y) = sum over common i of 1 / sum_j max(x_j / x_i, y_j / y_i),

which is the plain Jaccard similarity where all weights are equal. Registers are cut into bands; documents that share
a band are compared with the band's smallest member first, verified exactly, and joined into components. In bands that
still hold several components, members outside the main one look for missing links, nearest first, in blocks inside
tasks; only verified links that join something leave a task, so a group never turns into all its pairs.

Texts are told apart by 64 bits of a hash, and shingles in the comparison by 32: among 10**9 different texts 0.03 pairs
are expected to meet by chance, and two different texts of 1,000 shingles to share 0.0002 shingles more than they do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.llm import _worker
from fathom.llm._bitmap import bitmap, marked, slot
from fathom.llm._components import components
from fathom.llm._store import keep
from fathom.llm._text import mix, numbers, shingles, strings

ROWS, BANDS, WIDTH, SIMILAR = 6, 32, 5, 0.8
_BITS = 24
#: Members of one key that look for missing links; with more of them the key is divided.
CROWD = 16_384
#: The register sets by which a crowded key is divided.
_SETS = np.stack([np.random.default_rng(i).choice(ROWS * BANDS, 12, replace=False) for i in range(256)])


def weighted(texts: list[str], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the text, shingle, weight), by text, then by shingle."""
    h, doc = shingles(texts, width)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    if not len(h):
        return doc, h, np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]))
    return doc[first], h[first], np.diff(np.append(first, len(h)))


def sketches(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int, registers: int) -> np.ndarray:
    """ProbMinHash registers (32 bits of the winning shingle) of n documents."""
    earliest = np.full(n * registers, np.inf)
    winner = np.zeros(n * registers, np.uint32)
    time = np.zeros(len(doc))
    doc, shingle, rate = doc.astype(np.int64), shingle.astype(np.uint64), weight.astype(float)
    latest = np.full(n, np.inf)
    with np.errstate(over="ignore"):
        turn = np.uint64(0)
        while len(doc):
            turn += np.uint64(1)
            draw = mix(shingle + turn * np.uint64(0x9E3779B97F4A7C15))
            time = time - np.log(((draw >> np.uint64(12)).astype(float) + 0.5) / 2.0**52) / rate
            live = time < latest[doc]
            doc, shingle, rate, time, draw = doc[live], shingle[live], rate[live], time[live], draw[live]
            if not len(doc):
                break
            spot = doc * registers + (mix(draw ^ np.uint64(0xA5A5A5A5A5A5A5A5)) % np.uint64(registers)).astype(np.int64)
            np.minimum.at(earliest, spot, time)
            won = earliest[spot] == time
            winner[spot[won]] = (shingle[won] >> np.uint64(32)).astype(np.uint32)
            still = np.unique(doc)
            latest[still] = earliest.reshape(n, registers)[still].max(1)
    return winner.reshape(n, registers)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact J_P of two (sorted shingles, weights)."""
    both, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    only_x, only_y = float(a[1].sum() - a[1][i].sum()), float(b[1].sum() - b[1][j].sum())
    x, y = a[1][i].astype(float), b[1][j].astype(float)
    ratio = y / x
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    upto = np.searchsorted(ratio, ratio, "right")
    left = only_x + np.concatenate([[0], np.cumsum(x)])[upto]
    right = only_y + y.sum() - np.concatenate([[0], np.cumsum(y)])[upto]
    return float((1 / (left / x + right / y)).sum())


def _pack(h: np.ndarray, w: np.ndarray) -> bytes:
    short = (h >> np.uint64(32)).astype(np.uint32)
    short, back = np.unique(short, return_inverse=True)
    w = np.bincount(back, w).astype(np.uint32) if len(w) else np.zeros(0, np.uint32)
    return np.uint32(len(short)).tobytes() + short.tobytes() + (w.tobytes() if (w > 1).any() else b"")


def _unpack(b: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(b, np.uint32, 1)[0])
    h = np.frombuffer(b, np.uint32, n, 4)
    return h, np.frombuffer(b, np.uint32, n, 4 + 4 * n) if len(b) > 4 + 4 * n else np.ones(n, np.uint32)


def _sketch(docs: DataFrame, registers: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _worker.parts(batches, "text"):
            texts = strings(b, "text")
            doc, h, w = weighted(texts)
            sig = sketches(doc, h, w, len(texts), registers)
            has = np.bincount(doc, minlength=len(texts)) > 0
            out = [s.tobytes() if ok else None for s, ok in zip(sig, has, strict=True)]
            yield pa.RecordBatch.from_arrays([numbers(b, "doc_id"), numbers(b, "cid"), pa.array(out, pa.binary())], ["doc_id", "cid", "sig"])

    return docs.mapInArrow(run, "doc_id long, cid long, sig binary")


def _packs(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cid, pack) of the classes in ``wanted`` (cid, least): a fixed bitmap lets the scan skip other rows."""
    marks = bitmap(wanted, F.xxhash64("least", "cid"), _BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted_rows = (b.filter(pa.array(marked(marks, np.array(numbers(b, "slot").to_pylist(), np.int64)))) for b in batches)
        for b in _worker.parts(wanted_rows, "text"):
            texts = strings(b, "text")
            doc, h, w = weighted(texts)
            edge = np.searchsorted(doc, np.arange(len(texts) + 1))
            out = [_pack(h[x:y], w[x:y]) for x, y in zip(edge[:-1], edge[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([numbers(b, "doc_id"), numbers(b, "cid"), pa.array(out, pa.binary())], ["doc_id", "cid", "pack"])

    place = slot(F.xxhash64("doc_id", "cid"), _BITS).alias("slot")
    found = docs.select("doc_id", "cid", "text", place).mapInArrow(run, "doc_id long, cid long, pack binary")
    own = found.join(wanted, (found["cid"] == wanted["cid"]) & found["doc_id"].eqNullSafe(wanted["least"]), "left_semi")
    return own.select("cid", "pack").dropDuplicates(["cid"])


def _verify(pairs: DataFrame, packs: DataFrame, similar: float) -> DataFrame:
    """Those (a, b) whose exact similarity reaches the threshold. Members travel to their centre b; a centre with many
    members is dealt over several groups."""
    pairs = keep(pairs)
    many = pairs.groupBy("b").count().filter("count > 128").select("b", F.ceil(F.col("count") / 128).cast("int").alias("groups"))
    pairs = pairs.join(many, "b", "left").select("a", "b", F.coalesce("groups", F.lit(1)).alias("groups"))
    a = packs.toDF("a", "pack").join(pairs, "a").select("b", F.pmod(F.xxhash64("a"), "groups").cast("int").alias("g"), "a", "pack")
    b = packs.toDF("b", "pack").join(pairs.select("b", "groups").distinct(), "b").select("b", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("g"), F.col("pack"))

    def compare(members: pd.DataFrame, centre: pd.DataFrame) -> pd.DataFrame:
        ok: list[int] = []
        if len(members) and len(centre):
            c = _unpack(centre["pack"].iloc[0])
            total = c[1].sum()
            for one, p in zip(members["a"], members["pack"], strict=True):
                m = _unpack(p)
                if len(c[0]) and len(m[0]) and total and probability_jaccard(m, c) >= similar:
                    ok.append(one)
        return pd.DataFrame({"a": np.array(ok, np.int64), "b": np.array([centre["b"].iloc[0]] * len(ok) if ok else [], np.int64)})

    a, b = a.toDF("b", "g", "a", "pack"), b.toDF("b", "g", "pack")
    return a.groupBy("b", "g").cogroup(b.groupBy("b", "g")).applyInPandas(compare, "a long, b long")


def _stars(keys: DataFrame) -> DataFrame:
    """(a, b, n): each member with the smallest member of its keys, and in how many keys that is so."""
    centre = keep(keys.groupBy("key").agg(F.min("cid").alias("b"), F.count("*").alias("size")).filter("size > 1").select("key", "b"))
    return keys.join(centre, "key").filter("cid <> b").groupBy(F.col("cid").alias("a"), "b").agg(F.count("*").alias("n"))


def _split_keys(keys: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members with their roots, and the keys that still hold several: (key, size, most: members of the commonest root,
    top: that root)."""
    rooted = keep(keys.join(roots, keys["cid"] == roots["node"], "left").select("key", "cid", "last", F.coalesce("root", "cid").alias("root")))
    parts = rooted.groupBy("key", "root").agg(F.count("*").alias("n"))
    split = parts.groupBy("key").agg(F.sum("n").alias("size"), F.max("n").alias("most"), F.max_by("root", F.struct("n", "root")).alias("top"), F.count("*").alias("roots"))
    return rooted, keep(split.filter("roots > 1").drop("roots"))


def _divided(members: DataFrame, grouped: DataFrame, crowd: int) -> DataFrame:
    """(key, last, size, cid, root, asked, set): the members of keys in which at most ``crowd`` ask, with set -1, and those
    of other keys once for each register set in which they agree with a member of another root. Rows made grow in
    proportion to the members."""
    crowded = keep(members.filter("asked").groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > crowd).select("key"))
    calm = members.join(crowded, "key", "left_anti").withColumn("set", F.lit(-1))
    names = ["key", "last", "cid", "root", "asked"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint32).reshape(b.num_rows, -1)
                key = np.array(numbers(b, "key").to_pylist(), np.int64).view(np.uint64)
                with np.errstate(over="ignore"):
                    h = mix(key[:, None] + np.arange(len(_SETS), dtype=np.uint64)[None])
                    for k in range(_SETS.shape[1]):
                        h = mix(h + sig[:, _SETS[:, k]].astype(np.uint64))
                row = pa.array(np.repeat(np.arange(b.num_rows), len(_SETS)))
                cols = [pa.array(h.ravel().view(np.int64)), *(b.column(c).take(row) for c in names[1:])]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(np.tile(np.arange(len(_SETS), dtype=np.int32), b.num_rows))], [*names, "set"])

    dense = members.join(crowded, "key", "left_semi").join(grouped.select("cid", "sig"), "cid").select(*names, "sig")
    schema = ", ".join(f"{c} {members.schema[c].dataType.simpleString()}" for c in names) + ", set int"
    parts = keep(dense.mapInArrow(run, schema))
    open_ = parts.groupBy("key").agg(F.count("*").alias("size"), F.min("root").alias("low"), F.max("root").alias("high"), F.max("asked").alias("any"))
    met = parts.join(open_.filter("low <> high AND any").select("key", "size"), "key")
    return calm.unionByName(met.select(*calm.columns))


def _missing_links(members: DataFrame, grouped: DataFrame, packs: DataFrame, similar: float, block: int = 512, least: float = 0.7) -> DataFrame:
    """(a, b): verified links between members of one key that have different roots, as many as join what can be joined.

    members: (key, last, size, cid, root, asked, set). Members stand in blocks and the asked ones visit each block, with
    registers and shingles. A pair is looked at in the first band that it shares, if its registers agree in ``least``
    of all (three deviations under the threshold), nearest first, and only while its roots are not joined there; in a
    divided key also in the first register set that it shares."""
    blocks = F.ceil(F.col("size") / block).cast("int")
    full = members.join(grouped.select("cid", "sig"), "cid").join(packs, "cid")
    cols = ["key", "block", "last", "set", "cid", "root", "asked", "sig", "pack"]
    m = full.withColumn("block", F.pmod(F.xxhash64("cid"), blocks).cast("int")).select(*cols).toDF(*cols)
    q = full.filter("asked").withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).select(*cols).toDF(*cols)

    def join(member: pd.DataFrame, query: pd.DataFrame) -> pd.DataFrame:
        a: list[int] = []
        b: list[int] = []
        if len(member) and len(query):
            sig = np.stack([np.frombuffer(s, np.uint32) for s in member["sig"]])
            cid, asked, band = member["cid"].to_numpy(), member["asked"].to_numpy(), int(member["last"].iloc[0])
            part = int(member["set"].iloc[0])
            known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            up: dict[int, int] = {}

            def find(r: int) -> int:
                while up.get(r, r) != r:
                    r = up[r]
                return r

            roots = member["root"].tolist()
            for c, r, s, p in zip(query["cid"], query["root"], query["sig"], query["pack"], strict=True):
                same = sig == np.frombuffer(s, np.uint32)
                near = np.flatnonzero((same.mean(1) >= least) & (~asked | (cid < c)))
                near = near[same[near].reshape(len(near), BANDS, ROWS).all(2).argmax(1) == band]
                if part >= 0:
                    near = near[same[near][:, _SETS].all(2).argmax(1) == part]
                own = None
                for k in near[np.argsort(-same[near].mean(1), kind="stable")].tolist():
                    x, y = find(r), find(roots[k])
                    if x == y:
                        continue
                    own = own or _unpack(p)
                    if k not in known:
                        known[k] = _unpack(member["pack"].iloc[k])
                    if probability_jaccard(own, known[k]) >= similar:
                        up[max(x, y)] = min(x, y)
                        a.append(int(c))
                        b.append(int(cid[k]))
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    return m.groupBy("key", "block").cogroup(q.groupBy("key", "block")).applyInPandas(join, "a long, b long")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(text_col, F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("cid"), text.alias("text"))


def _grouped(rows: DataFrame, similar: float) -> DataFrame:
    """(cid, least, component_id, chosen) of each class; chosen is the cid of the component's representative, which has
    the smallest (id, cid), ids that are null last."""
    registers = ROWS * BANDS
    sketched = _sketch(rows, registers)
    grouped = keep(sketched.groupBy("cid").agg(F.min("doc_id").alias("least"), F.first("sig").alias("sig")))
    part = lambda i: F.substring("sig", i * (ROWS * 4) + 1, ROWS * 4)
    banded = grouped.filter("sig is not null").select("cid", F.array(*[F.xxhash64(F.lit(i), part(i)) for i in range(BANDS)]).alias("bands"))
    keys = banded.select("cid", F.posexplode("bands").alias("last", "key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    keys = keep(keys.join(shared, "key", "left_semi").select("key", "cid", "last"))
    star = keep(_stars(keys))
    involved = keys.select("cid").distinct().join(grouped.select("cid", "least"), "cid")
    packs = keep(_packs(rows, keep(involved)))
    links = keep(_verify(star.select("a", "b"), packs, similar))
    roots = keep(components(links))
    rooted, split = _split_keys(keys, roots)
    # beside one large component only those outside it ask
    asked = (F.col("most") * 2 < F.col("size")) | (F.col("root") != F.col("top"))
    open_ = keep(rooted.join(split, "key").select("key", "last", "size", "cid", "root", asked.alias("asked")))
    open_ = keep(_divided(open_, grouped, CROWD))
    links = keep(links.union(_missing_links(open_, grouped, packs, similar)))
    final = keep(components(links))
    told = grouped.select("cid", "least").join(final, grouped["cid"] == final["node"], "left").select("cid", "least", F.coalesce("root", "cid").alias("root"))
    told = keep(told)
    first = told.groupBy("root").agg(F.min(F.struct(F.col("least").isNull().alias("none"), "least", "cid")).alias("first"))
    first = keep(first.select("root", F.col("first.least").alias("component_id"), F.col("first.cid").alias("chosen")))
    return keep(told.join(first, "root").select("cid", "least", "component_id", "chosen"))


def classes(docs: DataFrame, similar: float = SIMILAR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id, component_id, kept for each row.

    Rows of equal text form a class (class_id: its smallest doc_id); classes of similarity ``similar`` or more are
    linked; component_id is the smallest doc_id reachable by links, and kept marks that row. Null texts count as
    empty; texts without a word form classes but link with nothing else. An empty table gives no rows; other columns
    are not read. Null ids come after all others: class_id and component_id are null where no row has an id. If texts
    share the component's smallest id, the one of smallest hash is kept; rows of equal id and text are marked alike.
    """
    rows = _rows(docs, id_col, text_col)
    out = rows.select("doc_id", "cid").join(_grouped(rows, similar), "cid")
    kept = (F.col("cid") == F.col("chosen")) & F.col("doc_id").eqNullSafe(F.col("component_id"))
    return out.select("doc_id", F.col("least").alias("class_id"), "component_id", kept.alias("kept"))


def _fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    while name.lower() in map(str.lower, docs.columns):
        name += "_"
    return name


def deduplicate(docs: DataFrame, similar: float = SIMILAR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with exactly one row of each component: the one of smallest id (null ids last), of equal ids the text of
    smallest hash, of rows equal in both any one. All columns stay, whatever their names. Null texts count as empty; an
    empty table gives no rows."""
    rows = _rows(docs, id_col, text_col)
    chosen = _grouped(rows, similar).filter("cid = chosen").select("cid", "least")
    named = rows.select("doc_id", "cid").join(chosen, "cid").filter(F.col("doc_id").eqNullSafe(F.col("least")))
    named = keep(named.groupBy("cid", F.col("doc_id").alias("id")).agg(F.count("*").alias("copies")))
    own_id, own_cid = docs[id_col].cast("long"), F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    held = lambda n: docs.join(n, (own_cid == n["cid"]) & own_id.eqNullSafe(n["id"]), "left_semi")
    # only rows equal in id and text have to meet
    cid, own = _fresh(docs, "_cid"), _fresh(docs, "_id")
    several = held(named.filter("copies > 1")).withColumn(cid, F.xxhash64(F.coalesce(text_col, F.lit("")))).withColumn(own, F.col(id_col).cast("long"))
    return held(named.filter("copies = 1")).unionByName(several.dropDuplicates([cid, own]).drop(cid, own))
