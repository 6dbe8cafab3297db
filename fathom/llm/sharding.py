"""Shards of nearly equal bytes: the minimax contiguous partition of ordered atomic groups.

Rows of equal text form one group, which is never split. Groups stand in the order of their digest. The smallest
feasible capacity of a shard is found by binary search; each guess is checked greedily; the cuts are those of the
smallest. Prefix sums over buckets of the digest (its first digits) bound where each cut can fall. A bucket that can hold
a cut is looked into by its next digits, until few groups are left, so that every table the driver sees is bounded at any
size: by 16 to the power of the digits of a step, or by ``FEW`` groups.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fathom.llm._store import keep


def _digest(text: Column) -> Column:
    return F.md5(F.encode(text, "UTF-8"))


FEW = 4096

Bucket = tuple[str, int, int]  # first digits of the digest, bytes, groups


def cuts(buckets: list[Bucket], largest: int, shards: int, fetch: Callable[[str, int], list[Bucket]]) -> list[str]:
    """The digest with which each shard but the first begins ("g", past every digest, for shards that stay empty).

    ``buckets``: ordered; ``fetch`` gives what a bucket of so many groups holds, ordered by longer digits (whole digests
    of one group each in the end), and is called only for buckets in which a guess has a cut: at most ``shards`` at each
    depth for each step of the binary search.
    """
    known: dict[str, tuple[list[Bucket], list[int]]] = {"": (buckets, [0, *accumulate(n for _, n, _ in buckets)])}
    total = known[""][1][-1]

    def cut(goal: int) -> tuple[str, int]:
        """The first group that ends past ``goal`` bytes, and the bytes before it."""
        prefix, base = "", 0
        while True:
            inside, sums = known[prefix]
            i = bisect_right(sums, goal - base) - 1
            name, _, groups = inside[i]
            base += sums[i]
            if len(name) == 32:
                return name, base
            if name not in known:
                below = fetch(name, groups)
                known[name] = below, [0, *accumulate(n for _, n, _ in below)]
            prefix = name

    def greedy(capacity: int) -> tuple[bool, list[str]]:
        """Whether that capacity is enough, and the first digest after each shard."""
        begins: list[str] = []
        done = 0
        for _ in range(shards):
            if done + capacity >= total:
                return True, begins + ["g"] * (shards - 1 - len(begins))
            name, done = cut(done + capacity)
            begins.append(name)
        return False, begins

    low = max(largest, -(-total // shards))
    high = low  # doubling steps above the bound keep guesses, and so the fetched buckets, near the answer
    step = max(1, total >> 16)
    while not greedy(high)[0]:
        low, high, step = high + 1, high + step, step * 2
    while low < high:
        mid = (low + high) // 2
        if greedy(mid)[0]:
            high = mid
        else:
            low = mid + 1
    return greedy(low)[1]


def shard(docs: DataFrame, shards: int = 8, bucket_digits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for each row.

    Size: UTF-8 bytes of the text (null: none) plus 1. Null and empty texts are one group, which stands where the
    digest of the empty text stands. Repeated rows each take a slot. An empty table gives no rows. Other columns
    are not read, whatever their names.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = keep(
        docs.select(F.col(id_col).alias("doc_id"), text.alias("_t")).select(
            "doc_id",
            (F.octet_length("_t") + 1).cast("long").alias("size"),
            F.crc32(F.encode("_t", "UTF-8")).alias("text_crc32"),
            _digest(F.col("_t")).alias("digest"),
            F.monotonically_increasing_id().alias("deal"),  # stored, so that rows that repeat are dealt over the parts
        )
    )
    groups = keep(rows.groupBy("digest").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")))

    def below(held: DataFrame, digits: int) -> list[Bucket]:
        """What the groups hold, by the first digits of their digest."""
        name = F.substring("digest", 1, digits).alias("name")
        return sorted(map(tuple, held.groupBy(name).agg(F.sum("bytes"), F.count("*")).collect()))

    def fetch(prefix: str, many: int) -> list[Bucket]:
        return below(groups.filter(F.col("digest").startswith(prefix)), 32 if many <= FEW else len(prefix) + bucket_digits)

    largest, count = groups.agg(F.max("bytes"), F.sum("rows")).first()
    cut_at = cuts(below(groups, bucket_digits), largest or 1, shards, fetch)
    parts = min(1 << 16, max(512, (count or 0) // 100_000))
    number = F.lit(0)
    for c in cut_at:
        number = number + F.when(F.col("digest") >= F.lit(c), 1).otherwise(0)
    placed = rows.withColumn("shard", number.cast("int")).withColumn("part", F.pmod(F.xxhash64("doc_id", "deal"), F.lit(parts)).cast("int"))
    # slots: each part numbers its own rows; the parts' counts (2**16 x shards at most) give where each begins
    counts = placed.groupBy("shard", "part").count()
    begin = counts.withColumn("base", F.sum("count").over(Window.partitionBy("shard").orderBy("part")) - F.col("count")).drop("count")
    within = F.row_number().over(Window.partitionBy("part", "shard").orderBy("digest", "doc_id")) - 1
    return (
        placed.withColumn("nth", within)
        .join(F.broadcast(begin), ["shard", "part"])
        .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("base") + F.col("nth")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    )
