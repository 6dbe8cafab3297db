"""Vectors: near-duplicates by product quantisation, and exact top-k by an impact-ordered index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fathom.llm._components import components
from fathom.llm._store import keep

BLOCK = 512


def _usable(vector: str) -> Column:
    """Neither null nor empty, and all components finite numbers."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & (F.size(vector) > 0) & ok, F.lit(False))


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    """Rows of doubles, filled up with zeros."""
    rows = [np.asarray(x, float) for x in column]
    if all(len(r) == width for r in rows):
        return np.array(rows, float).reshape(len(rows), width)
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def _kmeans(x: np.ndarray, k: int, rounds: int, seed: int = 7) -> np.ndarray:
    k = max(1, min(k, len(x)))
    centre = x[np.random.default_rng(seed).permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        own = _nearest(x, centre, 1)[:, 0]
        n = np.bincount(own, minlength=k)
        total = np.zeros_like(centre)
        np.add.at(total, own, x)
        centre = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centre)
    return centre


def _nearest(x: np.ndarray, centre: np.ndarray, k: int) -> np.ndarray:
    """Numbers of the k nearest centres of each row, nearest first."""
    out = np.zeros((len(x), k), np.int64)
    half = (centre**2).sum(1) / 2
    for a in range(0, len(x), 4096):
        far = half - x[a : a + 4096] @ centre.T
        if k == 1:
            out[a : a + 4096, 0] = far.argmin(1)
        else:
            out[a : a + 4096] = np.argsort(far, axis=1, kind="stable")[:, :k]
    return out


class Quantiser:
    """Coarse centres, and for each part of the residual a table of 256 words."""

    def __init__(self, sample: np.ndarray, lists: int, parts: int = 8, probes: int = 8):
        self.coarse = _kmeans(sample, lists, 8)
        residual = sample - self.coarse[_nearest(sample, self.coarse, 1)[:, 0]]
        self.cut = np.array_split(np.arange(sample.shape[1]), min(parts, sample.shape[1]))
        self.books = [_kmeans(residual[:, c], 256, 8) for c in self.cut]
        self.probes = min(probes, len(self.coarse))

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probed lists (the first is its own), codes, and the distance from each vector to what its code stands for."""
        probe = _nearest(x, self.coarse, self.probes)
        residual = x - self.coarse[probe[:, 0]]
        codes = np.column_stack([_nearest(residual[:, c], b, 1)[:, 0] for c, b in zip(self.cut, self.books, strict=True)])
        back = np.zeros_like(residual)
        for k, (c, b) in enumerate(zip(self.cut, self.books, strict=True)):
            back[:, c] = b[codes[:, k]]
        return probe, codes.astype(np.uint8), np.sqrt(((residual - back) ** 2).sum(1))

    def tables(self, x: np.ndarray, which: int) -> np.ndarray:
        """Squared distances of queries, in a list, from each word of each part."""
        residual = x - self.coarse[which]
        return np.stack([((residual[:, None, c] - b[None]) ** 2).sum(2) if len(b) == 256 else np.pad(((residual[:, None, c] - b[None]) ** 2).sum(2), ((0, 0), (0, 256 - len(b)))) for c, b in zip(self.cut, self.books, strict=True)], 1)


def _local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of each of n points' component under the links a-b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, most_sample: int = 20_000, list_size: int = 64, most_lists: int = 4096, probes: int = 8, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept for each row, by an inverted file with product-quantised residuals.

    Only vectors of equal label and length are compared. Equal vectors form one class, which is indexed once and counts
    as often as it has rows. A class looks into its ``probes`` nearest lists; a member stays in play if its asymmetric
    distance is within the threshold's distance plus the member's own quantising error, so codes lose no link; exact
    cosines in double precision decide. Lists that grow past ``BLOCK`` members, and their queries, are dealt in blocks.
    Centres and words are fitted on at most ``most_sample`` classes (those of smallest hash). There are at most
    ``most_lists`` lists: beyond some 2.6 million classes they grow with the table, and so does the work for a vector.

    Rows whose label or vector is null, whose vector is empty or zero or holds null or non-finite components link with
    nothing: they are their own component. Repeated rows are vectors of their own. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), F.col(label_col).cast("string").alias("label"))
    rows = rows.withColumn("ok", F.col("label").isNotNull() & _usable("v"))
    rows = rows.withColumn("ok", F.col("ok") & F.when(F.col("ok"), (norm > 0) & (norm < float("inf"))).otherwise(False))
    key = F.when(F.col("ok"), F.xxhash64("label", "v")).alias("cid")
    rows = rows.select("vec_id", "v", "ok", key, F.xxhash64("label", F.size("v")).alias("key"))
    classes = keep(rows.filter("ok").groupBy("cid", "key").agg(F.min("vec_id").alias("least"), F.count("*").alias("many"), F.min("v").alias("v")))
    n, width = classes.agg(F.count("*"), F.max(F.size("v"))).first()
    alone = F.col("vec_id")
    if not n:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), alone.alias("component_id"), F.lit(True).alias("kept"))
    few = classes.orderBy(F.xxhash64("cid"), "cid").limit(most_sample).select("v").toPandas()
    unit = _matrix(few["v"], width)
    unit /= np.sqrt((unit**2).sum(1))[:, None]
    quantiser = Quantiser(unit, int(min(most_lists, max(4, n // (10 * list_size)))), probes=probes)
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold)))

    def index(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                x = _matrix(f["v"], width)
                x /= np.sqrt((x**2).sum(1))[:, None]
                probe, codes, error = quantiser.encode(x)
                yield pd.DataFrame({"cid": f["cid"], "key": f["key"], "many": f["many"], "v": list(f["v"]), "probe": list(probe.astype(np.int32)), "code": [c.tobytes() for c in codes], "error": error})

    indexed = keep(classes.mapInPandas(index, "cid long, key long, many long, v array<double>, probe array<int>, code binary, error double"))
    members = indexed.withColumn("list", F.col("probe")[0])
    queries = indexed.withColumn("list", F.explode("probe"))
    full = lambda df, most, name: df.groupBy("key", "list").count().filter(F.col("count") > most).select("key", "list", F.ceil(F.col("count") / most).cast("int").alias(name))
    split = keep(full(members, BLOCK, "m_blocks").join(full(queries, 2 * BLOCK, "q_blocks"), ["key", "list"], "full"))
    own_m, own_q = F.pmod(F.xxhash64("cid"), F.coalesce("m_blocks", F.lit(1))).cast("int"), F.pmod(F.xxhash64("cid", F.lit(1)), F.coalesce("q_blocks", F.lit(1))).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.coalesce(c, F.lit(1)) - 1))
    columns = ["key", "list", "mb", "qb", "cid", "many", "v", "probe", "code", "error"]
    m = members.join(split, ["key", "list"], "left").withColumn("mb", own_m).withColumn("qb", every("q_blocks")).select(*columns).toDF(*columns)
    q = queries.join(split, ["key", "list"], "left").withColumn("qb", own_q).withColumn("mb", every("m_blocks")).select(*columns).toDF(*columns)

    def link(k: tuple, member: pd.DataFrame, query: pd.DataFrame) -> pd.DataFrame:
        nothing = pd.DataFrame({"cid": np.zeros(0, np.int64), "links": np.zeros(0, np.int64), "root": np.zeros(0, np.int64)})
        if not len(member) or not len(query):
            return nothing
        here = k[1]
        y, x = _matrix(member["v"], width), _matrix(query["v"], width)
        yu, xu = y / np.sqrt((y**2).sum(1))[:, None], x / np.sqrt((x**2).sum(1))[:, None]
        code = np.frombuffer(b"".join(member["code"]), np.uint8).reshape(len(member), -1)
        limit = (reach + member["error"].to_numpy() + 1e-6) ** 2
        mid, qid = member["cid"].to_numpy(), query["cid"].to_numpy()
        a, b = [], []
        for s in range(0, len(x), 256):
            table = quantiser.tables(xu[s : s + 256], here)
            far = np.zeros((len(table), len(y)))
            for p in range(code.shape[1]):
                far += table[:, p, code[:, p]]
            i, j = np.nonzero(far <= limit[None, :])
            close = (xu[s + i] * yu[j]).sum(1) >= threshold
            i, j = s + i[close], j[close]
            other = qid[i] != mid[j]
            a.append(i[other])
            b.append(j[other])
        i, j = np.concatenate(a), np.concatenate(b)
        if not len(i):
            return nothing
        # the member finds the query by itself unless it does not probe the query's list
        home = np.array([p[0] for p in query["probe"]])
        probes_of = np.stack(list(member["probe"]))
        blind = (probes_of[j] != home[i][:, None]).all(1)
        ids, at = np.unique(np.concatenate([qid[i], mid[j]]), return_inverse=True)
        ai, bj = at[: len(i)], at[len(i) :]
        many_m, many_q = member["many"].to_numpy(), query["many"].to_numpy()
        links = np.bincount(ai, many_m[j], len(ids)) + np.bincount(bj[blind], many_q[i][blind], len(ids))
        return pd.DataFrame({"cid": ids, "links": links.astype(np.int64), "root": ids[_local_roots(len(ids), ai, bj)]})

    found = keep(m.groupBy("key", "list", "mb", "qb").cogroup(q.groupBy("key", "list", "mb", "qb")).applyInPandas(link, "cid long, links long, root long"))
    roots = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    told = classes.select("cid", "least", "many").join(links, "cid", "left").join(roots.withColumnRenamed("node", "cid"), "cid", "left")
    told = keep(told.select("cid", "least", (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("n_links"), F.coalesce("root", "cid").alias("root")))
    first = keep(told.groupBy("root").agg(F.min("least").alias("component_id")))
    whole = keep(told.join(first, "root").select("cid", "n_links", "component_id"))
    out = rows.filter("ok").select("vec_id", "cid").join(whole, "cid").select("vec_id", "n_links", "component_id")
    out = out.union(rows.filter(~F.col("ok")).select("vec_id", F.lit(0).cast("long"), "vec_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _pack(x: np.ndarray) -> bytes:
    """A matrix of whole numbers: two bytes each where they fit, else doubles."""
    small = x.size == 0 or float(np.abs(x).max()) < 2**15
    return b"s" + x.astype(np.int16).tobytes() if small else b"d" + x.tobytes()


def _unpack(raw: bytes, width: int) -> np.ndarray:
    return np.frombuffer(raw, np.int16 if raw[:1] == b"s" else np.float64, offset=1).astype(float).reshape(-1, width)


def scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers held as doubles, exact: in doubles where every partial sum fits their 53 bits, else
    in 64-bit integers, else in integers without a bound. A product outside 64 bits is an error."""
    most = x.shape[1] * float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0))
    if most < 2.0**53:
        return (x @ q).astype(np.int64)
    if most < 2.0**62:
        return x.astype(np.int64) @ q.astype(np.int64)
    whole = [int(v) for v in q.tolist()]
    return np.array([sum(int(a) * b for a, b in zip(row, whole, strict=True)) for row in x.tolist()], np.int64)


class Segments:
    """An impact-ordered index of a block of vectors.

    A segment is the posting list of the rows whose component d lies in one of ``levels`` equal levels of that
    component's range. For a query with weight w on d, each row of the segment has at least |w| * step * height above
    the component's worst value, height counting the levels from the worst one: the segment's quantised impact."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, x: np.ndarray, levels: int):
        """ids: vec_id, rows: a number of its own for each row, x: whole numbers."""
        self.ids, self.rows, self.x, self.levels = ids, rows, x, levels
        self.low = x.min(0)
        self.step = (x.max(0) - self.low + 1) / levels
        level = np.minimum(((x - self.low) / self.step).astype(np.int64), levels - 1)
        segment = level + np.arange(x.shape[1]) * levels
        self.postings = (np.argsort(segment.ravel(), kind="stable") // x.shape[1]).astype(np.uint16)
        self.begin = np.concatenate([[0], np.cumsum(np.bincount(segment.ravel(), minlength=x.shape[1] * levels))]).astype(np.int64)

    def dump(self) -> dict[str, bytes]:
        return {"ids": self.ids.tobytes(), "rows": self.rows.tobytes(), "x": _pack(self.x), "low": self.low.tobytes(), "step": self.step.tobytes(), "postings": self.postings.tobytes(), "begin": self.begin.tobytes()}

    @classmethod
    def load(cls, stored: dict[str, bytes], levels: int) -> Segments:
        self = cls.__new__(cls)
        self.levels = levels
        self.ids, self.rows, self.begin = (np.frombuffer(stored[k], np.int64) for k in ("ids", "rows", "begin"))
        self.low, self.step = np.frombuffer(stored["low"], float), np.frombuffer(stored["step"], float)
        self.x, self.postings = _unpack(stored["x"], len(self.low)), np.frombuffer(stored["postings"], np.uint16).astype(np.int64)
        return self

    def top(self, q: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """The k best rows but ``own`` for one query, their exact scores, and how many segments were taken.

        Segments are processed by descending impact, each crediting its postings. After every sixteenth part of them the
        leading rows are scored exactly, and the k-th best of these bounds the answer from below. A row is bounded from
        above by what it has gathered, the widths of the levels, and the impact of the next segment for each component
        of which its own segment has not come. Processing stops when the rows that can still belong to the answer are
        few, which proves that all others do not, or when no segment is left; those rows are scored exactly."""
        n, levels = self.x.shape[0], self.levels
        d_of, level = np.divmod(np.arange(len(self.low) * levels), levels)
        worth = (np.abs(q) * self.step)[d_of]
        impact = worth * np.where(q[d_of] >= 0, level, levels - 1 - level)
        order = np.argsort(-impact, kind="stable")
        order = order[(impact[order] > 0) & (self.begin[order + 1] > self.begin[order])]
        worst = float((q * np.where(q >= 0, self.low, self.low + self.step * levels)).sum()) + float((np.abs(q) * self.step).sum())
        rounding = 1e-12 * float((np.abs(q) * np.maximum(np.abs(self.low), np.abs(self.low + self.step * levels))).sum())  # of the bounds' own sums
        gathered, open_ = np.zeros(n), np.full(n, len(self.low))
        possible = np.flatnonzero(self.rows != own)
        few, batch, taken = max(4 * k, n // 8), max(1, -(-len(order) // 16)), 0
        while len(possible) > few and taken < len(order):
            some = order[taken : taken + batch]
            taken += len(some)
            posted = np.concatenate([self.postings[a:b] for a, b in zip(self.begin[some].tolist(), self.begin[some + 1].tolist(), strict=True)])
            gathered += np.bincount(posted, np.repeat(impact[some], self.begin[some + 1] - self.begin[some]), n)
            open_ -= np.bincount(posted, minlength=n)
            next_ = impact[order[taken]] if taken < len(order) else 0.0
            held = gathered[possible]
            lead = possible[np.argpartition(held, -2 * k)[-2 * k :]]
            best = float(np.partition(scores(self.x[lead], q), -k)[-k])
            possible = possible[held + open_[possible] * next_ + worst + 1e-6 * (1 + abs(best)) + rounding >= best]
        score = scores(self.x[possible], q)
        best = np.lexsort((self.ids[possible], -score))[:k]
        return possible[best], score[best], taken


_INDEX = ("ids", "rows", "x", "low", "step", "postings", "begin")


def impact_index(rows: DataFrame, width: int, block: int, levels: int) -> DataFrame:
    """One row for each block of the stored (rid, vec_id, v): its segments, ready to load. Blocks hold some ``block`` rows."""
    blocks = max(1, -(-rows.count() // block))

    def build(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        out = []
        for k, a in enumerate(range(0, len(f), 1 << 16)):  # a posting is a number of two bytes
            g = f.iloc[a : a + (1 << 16)]
            index = Segments(g["vec_id"].to_numpy(np.int64), g["rid"].to_numpy(np.int64), _matrix(g["v"], width), levels)
            out.append({"b": int(key[0]) + k * blocks, **index.dump()})
        return pd.DataFrame(out)

    dealt = rows.select(F.pmod(F.xxhash64("rid"), F.lit(blocks)).cast("long").alias("b"), "rid", "vec_id", "v")
    return keep(dealt.groupBy("b").applyInPandas(build, "b long, " + ", ".join(f"{c} binary" for c in _INDEX)))


def exact_top_k(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256, block: int = 16_384, chunk: int = 8192, levels: int = 32, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best inner products of floor(scale * x) for each row whose id is divisible
    by ``every``, against all other rows; ties go to the smaller id.

    Vectors that are null or hold null or non-finite components, and rows without an id, take no part; an empty or
    shorter vector counts as filled up with zeros. Each query row is answered, also where ids or whole rows repeat, and
    has all rows but itself as candidates. Scores are exact at any magnitude; one outside 64 bits is an error. No queries or no candidates give no rows; other columns are not read. The
    index is built and stored once a block; blocks of the index and chunks of queries travel whole, each pair of them
    to a task group of its own.
    """
    # doubles from 2^53 on are whole numbers; floor would cut them to 64 bits
    quantised = F.transform("v", lambda x: F.when(F.abs(x * float(scale)) < F.lit(2.0**53), F.floor(x * float(scale)).cast("double")).otherwise(x * float(scale)))
    finite = F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).filter(F.col("vec_id").isNotNull() & finite)
    rows = keep(rows.select(F.monotonically_increasing_id().alias("rid"), "vec_id", quantised.alias("v")))
    asked = rows.filter(F.pmod("vec_id", F.lit(every)) == 0)
    width = max(1, rows.agg(F.max(F.size("v"))).first()[0] or 1)
    index = impact_index(rows, width, block, levels)
    chunks = max(1, -(-asked.count() // chunk))

    def gather(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{"c": int(key[0]), "ids": f["vec_id"].to_numpy(np.int64).tobytes(), "rows": f["rid"].to_numpy(np.int64).tobytes(), "x": _pack(_matrix(f["v"], width))}])

    queries = asked.withColumn("c", F.pmod(F.xxhash64("rid", F.lit(1)), F.lit(chunks)).cast("long"))
    queries = keep(queries.groupBy("c").applyInPandas(gather, "c long, ids binary, rows binary, x binary"))
    numbers = index.select("b").withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))))
    left = numbers.join(index, "b").select("b", "c", *_INDEX)
    right = numbers.toDF("b", "c").join(queries, "c").select("b", "c", F.col("ids").alias("q_ids"), F.col("rows").alias("q_rows"), F.col("x").alias("q_x"))

    def search(blocks: pd.DataFrame, chunks_: pd.DataFrame) -> pd.DataFrame:
        out = []
        for stored in blocks.to_dict("records"):
            own = Segments.load(stored, levels)
            for c in chunks_.itertuples():
                for i, r, q in zip(np.frombuffer(c.q_ids, np.int64).tolist(), np.frombuffer(c.q_rows, np.int64).tolist(), _unpack(c.q_x, width), strict=True):
                    at, score, _ = own.top(q, r, k)
                    out.append(np.stack([np.full(len(at), r), np.full(len(at), i), own.ids[at], score], 1))
        return pd.DataFrame(np.concatenate(out) if out else np.zeros((0, 4), np.int64), columns=["rid", "query_id", "vec_id", "score"])

    found = left.groupBy("b", "c").cogroup(right.groupBy("b", "c")).applyInPandas(search, "rid long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("rid").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
