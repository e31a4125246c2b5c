"""Sharding by sampled splitters. DataFrame functions only.

A record's key is a 64-bit hash of its text, so equal texts are neighbours. Keys are drawn with a chance in
proportion to the record's size; quantiles of the draw are the splitters of many small ranges. A range that turns
out overfull is subdivided: its own keys are drawn anew with a chance fitted to that range. The ranges, of which
there is a fixed number per shard, then fill the shards, largest first into the emptiest. Equal texts stay in one
shard, but for a text whose copies together exceed a shard's share: shards of near equal bytes cannot hold it whole, so
those copies are dealt singly.

Defined cases: null text has size 1 (no bytes, plus 1) and the key of the empty text's hash seed; very long texts stay
whole; an empty table gives no rows; repeated rows get slots of their own and null ids come first, and wherever rows
are drawn or dealt singly that goes by their place in a written table, so neither kind gathers in one task; extra
columns, whatever their names, are never read.
"""

from __future__ import annotations

import bisect
import heapq

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from notegraph.llm.common import materialize, table, utf8_bytes

#: Ranges per shard, and keys drawn per range: what the driver sees is at most about SHARDS * RANGES * DRAWS keys.
RANGES = 64
DRAWS = 24
#: A range this many times the mean is subdivided.
OVERFULL = 1.5
CHUNK_ROWS = 100_000


def _uniform(*cols: Column) -> Column:
    """A number in [0, 1) that depends on the row alone, so a lost task draws the same again."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 40)) / float(1 << 40)


def _range_of(key: Column, splitters: list[int]) -> Column:
    """How many splitters are at or below the key, found in two steps."""
    if not splitters:
        return F.lit(0)
    width = max(1, int(len(splitters) ** 0.5))
    blocks = [splitters[i : i + width] for i in range(0, len(splitters), width)]
    heads = F.array(*[F.lit(b[0]) for b in blocks])
    tails = F.array(*[F.array(*[F.lit(x) for x in b]) for b in blocks])
    block = F.size(F.filter(heads, lambda x: x <= key))
    inside = F.size(F.filter(F.element_at(tails, block), lambda x: x <= key))
    return F.when(block == 0, 0).otherwise((block - 1) * width + inside)


def _draw(slim: DataFrame, keep: Column, chance: Column) -> list[int]:
    return sorted(r[0] for r in slim.where(keep & (_uniform(F.col("key"), F.col("row"), F.lit(7)) < chance)).select("key").collect())


def _quantiles(keys: list[int], n: int) -> list[int]:
    return sorted({keys[len(keys) * i // n] for i in range(1, n)}) if keys else []


def splitters(slim: DataFrame, shards: int, total: int, ranges: int = RANGES, draws: int = DRAWS) -> list[int]:
    """Boundaries of the ranges of ``slim (row, key, size)``; overfull ranges are subdivided until none can be."""
    n = shards * ranges
    chance = F.col("size") * F.lit(n * draws / max(total, 1))
    found = _quantiles(_draw(slim, F.lit(True), chance), n)
    for _ in range(3):
        if not found:
            break
        mean = total / n
        sizes = slim.groupBy(_range_of(F.col("key"), found).alias("r")).agg(F.sum("size").alias("b"), F.min("key").alias("lo"), F.max("key").alias("hi"))
        over = {r["r"]: r["b"] for r in sizes.collect() if r["b"] > OVERFULL * mean and r["lo"] < r["hi"]}
        if not over:
            break
        r = _range_of(F.col("key"), found)
        keys = _draw(slim, r.isin(*over), chance * 4)
        more = set(found)
        for k, b in over.items():
            lo = found[k - 1] if k else None
            hi = found[k] if k < len(found) else None
            own = keys[0 if lo is None else bisect.bisect_left(keys, lo) : len(keys) if hi is None else bisect.bisect_left(keys, hi)]
            more.update(_quantiles(own, max(2, round(b / mean))))
            # a key that many records share becomes a range of its own
            more.update(x + 1 for x in set(own) if own.count(x) > 4 * draws and x + 1 < (1 << 63))
        if more == set(found):
            break
        found = sorted(more)
    return found


def shard(df: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", ranges: int = RANGES) -> DataFrame:
    """``(id, size, text_crc32, shard, slot)`` for each row of ``df``; shards are of near equal bytes."""
    body = F.col(text_col)
    slim = df.select(
        F.col(id_col).alias("id"),
        (utf8_bytes(body) + 1).alias("size"),
        F.crc32(F.coalesce(body, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(body).alias("key"),
    )
    slim = materialize(slim.withColumn("row", F.monotonically_increasing_id()), "sharding")
    total = slim.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    n_rows = slim.count()
    found = splitters(slim, shards, total, ranges)
    sizes = slim.groupBy(_range_of(F.col("key"), found).alias("r")).agg(F.sum("size").alias("b"), F.min("key").alias("lo"), F.max("key").alias("hi"))
    share = max(total, 1) / shards
    loads = [(r["r"], r["b"], r["lo"] == r["hi"]) for r in sizes.collect()]  # a bounded number of ranges
    heap = [(0, i) for i in range(shards)]
    split, home = [], {}
    for r, b, single in sorted(loads, key=lambda x: (-x[1], x[0])):
        if single and b > share:  # one text alone exceeds a shard: its copies go round
            split.append(r)
            heap = [(x + b // shards, i) for x, i in heap]
            heapq.heapify(heap)
            continue
        x, i = heapq.heappop(heap)
        home[r] = i
        heapq.heappush(heap, (x + b, i))
    homes = F.array(*[F.lit(home.get(r, 0)) for r in range(len(found) + 1)])
    ranged = slim.withColumn("r", _range_of(F.col("key"), found))
    by_range = F.element_at(homes, F.col("r") + 1)
    singly = F.pmod(F.xxhash64("row", F.lit(3)), F.lit(shards)).cast("int")
    placed = ranged.withColumn("shard", F.when(F.col("r").isin(*split), singly).otherwise(by_range) if split else by_range)
    # slots: a row's place in its chunk plus the rows of the shard's chunks before
    salts = max(1, -(-n_rows // (shards * ranges * CHUNK_ROWS)))
    placed = placed.withColumn("salt", F.pmod(F.xxhash64("row", F.lit(5)), F.lit(salts if salts > 1 else 8)))
    chunks = placed.groupBy("shard", "r", "salt").agg(F.count("*").alias("n"))
    chunks = chunks.withColumn("before", F.coalesce(F.sum("n").over(W.partitionBy("shard").orderBy("r", "salt").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    placed = placed.withColumn("rn", F.row_number().over(W.partitionBy("shard", "r", "salt").orderBy("key", F.col("id").asc_nulls_first(), "row")))
    return placed.join(chunks.drop("n"), ["shard", "r", "salt"]).select("id", "size", "text_crc32", "shard", (F.col("before") + F.col("rn") - 1).cast("long").alias("slot"))


def write_shards(df: DataFrame, plan: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """The rows of ``df`` by shard; ids must be unique. Each shard is a folder, its files sorted by slot."""
    keyed = plan.select(F.col("id").alias("__ng_id"), F.col("shard").alias("__ng_shard"), F.col("slot").alias("__ng_slot"))
    rows = df.join(keyed, df[id_col] == keyed["__ng_id"]).drop("__ng_id")
    rows.sortWithinPartitions("__ng_shard", "__ng_slot").write.partitionBy("__ng_shard").parquet(path)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = shard(table(spark, sf_dir, "documents"))
    return s.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
