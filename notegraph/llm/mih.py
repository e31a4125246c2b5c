"""Exact top-k search over binary codes by incremental multi-index hashing.

A code of 64 bits a word is cut into m segments; one index per segment maps a segment's value to the codes that have
it. A query looks up its own segments, then all values one bit off, two bits off, and so on. With all segments
searched to radius r, no code within distance m * (r + 1) - 1 can be missing; with radius r in the first a + 1
segments and r - 1 in the others, none within m * r + a. A query is done when that covers its k-th verified distance.
The values to look up are made inside tasks, so the plan does not grow with them. Where a radius would look up more
values than there are codes, the queries that are left meet all codes, block by block, which covers everything.

Equal codes are indexed once, with their k + 1 smallest ids, which is all that any top-k can show of them; queries with
equal codes are searched once. Codes of one value lie in blocks of bounded size; a block meets a block of queries in
one Arrow batch row. Per round and query only the k + 1 nearest of each task are shuffled. All joins are of tables that
grow with the codes, so all are shuffled and none goes through the driver.

Defined cases: a null vector or id takes no part; an id that occurs twice counts once, with its smallest code; all
values of a vector count, however many; a vector shorter than the longest has no bits set beyond its end, and the
empty vector none at all; distance ties go to the smaller id; fewer than k others give fewer rows; an empty table
gives none; extra columns, whatever their names, are never read.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from notegraph.llm.common import Scratch, materialize, shuffled, table

WORD = 64
BLOCK = 1024
#: Values to look up that a task holds at once.
AT_ONCE = 1 << 16
BEST = "array<struct<d:int,first:bigint,code:array<bigint>>>"


def sign_codes(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(id, code)``: one bit per value (set if it is 0 or more), packed into longs; one row per id."""
    longest = df.agg(F.max(F.size(vector_col))).first()[0] or 0
    bit = lambda acc, x: F.shiftleft(acc, 1).bitwiseOR(F.when(x >= 0, 1).otherwise(0).cast("long"))
    words = [F.aggregate(F.slice(F.col(vector_col), at + 1, WORD), F.lit(0).cast("long"), bit) for at in range(0, max(1, longest), WORD)]
    code = F.when(F.col(vector_col).isNotNull(), F.array(*words))
    return df.select(F.col(id_col).alias("id"), code.alias("code")).dropna().groupBy("id").agg(F.min("code").alias("code"))


def segment_count(n: int, bits: int = WORD) -> int:
    """So many segments that a segment's value is shared by some 16 codes on average; none is wider than 32 bits."""
    return max(2, -(-bits // 32), min(bits // 4, round(bits / max(4.0, math.log2(max(n, 2)) - 4))))


def _cuts(m: int, bits: int) -> list[tuple[int, int]]:
    """(shift, width) of each segment."""
    edges = [bits * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in itertools.pairwise(edges)]


def _segment(code: str, shift: int, width: int):
    """A segment's value; it may lie across two words."""
    word, at = divmod(shift, WORD)
    low = f"shiftrightunsigned({code}[{word}], {at})"
    if at + width > WORD:
        low = f"({low} | shiftleft({code}[{word + 1}], {WORD - at}))"
    return F.expr(f"{low} & {(1 << width) - 1}L")


def _masks(width: int, radius: int):
    """All values of ``width`` bits with ``radius`` of them set, in arrays of bounded size."""
    found = (sum(1 << i for i in c) for c in itertools.combinations(range(width), radius))
    while part := list(itertools.islice(found, AT_ONCE)):
        yield np.array(part, np.int64)


def _probes(todo: DataFrame, cuts: list[tuple[int, int]], radius: int) -> DataFrame:
    """``todo (code, worst, need)`` to ``(seg, val, code, worst)``: the values at ``radius`` that a query still needs."""
    values = todo.select("code", "worst", "need", F.array(*[_segment("code", s, w) for s, w in cuts]).alias("own"))

    def run(batches):
        for pdf in batches:
            need = pdf["need"].to_numpy()
            own = np.array(pdf["own"].tolist(), np.int64).reshape(len(pdf), len(cuts))
            for i, (_, width) in enumerate(cuts):
                rows = np.flatnonzero(need > i)
                if radius > width or not len(rows):
                    continue
                for masks in _masks(width, radius):
                    step = max(1, AT_ONCE // len(masks))
                    for at in range(0, len(rows), step):
                        r = rows[at : at + step]
                        val = (own[r, i][:, None] ^ masks[None, :]).ravel()
                        of = np.repeat(r, len(masks))
                        yield pd.DataFrame({"seg": i, "val": val, "code": pdf["code"].to_numpy()[of], "worst": pdf["worst"].to_numpy()[of]})

    return values.mapInPandas(run, "seg int, val long, code array<bigint>, worst int")


def topk(base: DataFrame, queries: DataFrame, k: int = 10, segments: int | None = None) -> DataFrame:
    """``base (id, code)``, ``queries (id, code)`` to ``(query_id, neighbor_id, distance, rank)``; a query is not its own neighbour.

    A code is a long or an array of longs, of one length in both tables.
    """
    scratch = Scratch(base.sparkSession, "mih")
    as_array = lambda df: df if dict(df.dtypes)["code"].startswith("array") else df.withColumn("code", F.array("code"))
    base, queries = as_array(base.select("id", "code")), as_array(queries.select("id", "code"))
    keep = k + 1
    by_id = W.partitionBy("code").orderBy("id")
    few = base.withColumn("rn", F.row_number().over(by_id)).where(F.col("rn") <= keep)
    members = scratch.write(few.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "members")
    n, words = members.agg(F.count("*"), F.coalesce(F.max(F.size("code")), F.lit(1))).first()
    bits = WORD * words
    m = segments or segment_count(n, bits)
    cuts = _cuts(m, bits)
    # the index: codes by (segment, value), in blocks
    entry = F.explode(F.array(*[F.struct(F.lit(i).alias("seg"), _segment("code", s, w).alias("val")) for i, (s, w) in enumerate(cuts)]))
    firsts = members.select("code", F.element_at("ids", 1).alias("first"))
    entries = firsts.select("code", "first", entry.alias("e")).select("code", "first", "e.seg", "e.val")
    counts = scratch.write(entries.groupBy("seg", "val").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")), "counts")
    blocked = entries.join(shuffled(counts), ["seg", "val"]).withColumn("block", F.pmod(F.xxhash64("code"), F.col("blocks")))
    in_blocks = lambda rows, *keys: rows.groupBy(*keys).agg(F.collect_list(F.struct("code", "first")).alias("c")).select(*keys, F.flatten("c.code").alias("codes"), F.col("c.first").alias("firsts"))
    index = scratch.write(in_blocks(blocked, "seg", "val", "block"), "index")
    asked = queries.select("code").distinct()
    state = scratch.write(asked.select("code", F.array().cast(BEST).alias("best")), "state")
    qblocks = -(-max(1, state.count()) // BLOCK)  # no block is larger, even if all queries look up one value
    qblock = F.pmod(F.xxhash64("code"), F.lit(qblocks))

    def met(probes: DataFrame, blocks: DataFrame, *keys: str) -> DataFrame:
        grouped = probes.groupBy(*keys, qblock.alias("qblock")).agg(F.collect_list(F.struct("code", "worst")).alias("q"))
        grouped = grouped.select(*keys, F.flatten("q.code").alias("qcodes"), F.col("q.worst").alias("worsts"))
        pairs = grouped.join(shuffled(blocks), list(keys)).select("qcodes", "worsts", "codes", "firsts")
        found = pairs.mapInPandas(_verify(keep, words), "code array<bigint>, d int, first long, hit array<bigint>")
        near = F.dense_rank().over(W.partitionBy("code").orderBy("d", "first", "hit"))  # limited in each task before the shuffle
        found = found.withColumn("rn", near).where(F.col("rn") <= keep)
        best = found.groupBy("code").agg(F.collect_set(F.struct("d", "first", F.col("hit").alias("code"))).alias("new"))
        merged = F.array_sort(F.array_distinct(F.concat("best", F.coalesce("new", F.array().cast(BEST)))))
        return scratch.write(state.join(shuffled(best), "code", "left").select("code", F.slice(merged, 1, keep).alias("best")), "state")

    for radius in range(max(w for _, w in cuts) + 1):
        worst = F.when(F.size("best") < keep, F.lit(bits)).otherwise(F.element_at("best", -1)["d"])
        # covered so far: m * radius - 1; the segments still to be searched at this radius
        todo = state.select("code", worst.alias("worst"), (worst - radius * m + 1).alias("need")).where(F.col("need") > 0)
        if todo.isEmpty():
            break
        if math.comb(max(w for _, w in cuts), radius) > max(n, 1):
            parts = -(-n // BLOCK)
            every = in_blocks(firsts.withColumn("part", F.pmod(F.xxhash64("code"), F.lit(parts))), "part")
            todo = todo.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
            state = met(todo, scratch.write(every, "all"), "part")
            break
        state = met(_probes(todo, cuts, radius), index, "seg", "val")
    hits = state.select(F.col("code").alias("qcode"), F.explode("best").alias("b")).select("qcode", "b.d", "b.code")
    near = hits.join(shuffled(members), "code").select("qcode", "d", F.explode("ids").alias("nid"))
    # k + 1 of each query's code are enough, whatever the query's own id
    near = near.withColumn("rn", F.row_number().over(W.partitionBy("qcode").orderBy("d", "nid"))).where(F.col("rn") <= keep)
    near = scratch.write(near.groupBy("qcode").agg(F.array_sort(F.collect_list(F.struct("d", "nid"))).alias("near")), "near")
    others = F.slice(F.filter("near", lambda x: x["nid"] != F.col("qid")), 1, k)
    ranked = queries.select(F.col("id").alias("qid"), F.col("code").alias("qcode")).join(shuffled(near), "qcode").select("qid", F.posexplode(others).alias("at", "x"))
    out = materialize(ranked.select(F.col("qid").alias("query_id"), F.col("x.nid").alias("neighbor_id"), F.col("x.d").alias("distance"), (F.col("at") + 1).alias("rank")), "mih")
    scratch.close()
    return out


def _verify(keep: int, words: int):
    def run(batches):
        for pdf in batches:
            out = []
            for qcodes, worsts, codes, firsts in zip(pdf["qcodes"], pdf["worsts"], pdf["codes"], pdf["firsts"], strict=True):
                codes, qcodes = (np.asarray(x, np.int64).reshape(-1, words) for x in (codes, qcodes))
                firsts, worsts = np.asarray(firsts, np.int64), np.asarray(worsts, np.int32)
                d = np.zeros((len(qcodes), len(codes)), np.int32)
                for w in range(words):
                    d += np.bitwise_count(qcodes[:, w].view(np.uint64)[:, None] ^ codes[:, w].view(np.uint64)[None, :])
                if len(codes) > keep:  # the keep nearest of this block, all ties of the last included
                    last = np.partition(d, keep - 1, axis=1)[:, keep - 1]
                    near = d <= np.minimum(last, worsts)[:, None]
                else:
                    near = d <= worsts[:, None]
                q, c = np.nonzero(near)
                if len(q):
                    order = np.lexsort((firsts[c], d[q, c], q))
                    q, c = q[order], c[order]
                    start = np.r_[0, np.flatnonzero(np.diff(q)) + 1]
                    place = np.arange(len(q)) - np.repeat(start, np.diff(np.r_[start, len(q)]))
                    q, c = q[place < keep], c[place < keep]
                    out.append(pd.DataFrame({"code": list(qcodes[q]), "d": d[q, c], "first": firsts[c], "hit": list(codes[c])}))
            if out:
                yield pd.concat(out)

    return run


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest others, by Hamming distance of sign codes, of every vector whose id is divisible by 50."""
    base = materialize(sign_codes(table(spark, sf_dir, "embeddings")), "mih-codes")
    hits = topk(base, base.where(F.col("id") % 50 == 0), k=10)
    return hits.select(F.col("query_id").alias("vec_id"), "rank", "neighbor_id", "distance")


OP6_SQL = """
WITH b AS (SELECT vec_id, list_transform(embedding, lambda x: x >= 0) AS bits FROM embeddings),
p AS (SELECT q.vec_id, b.vec_id AS neighbor_id,
             CAST(len(list_filter(list_zip(q.bits, b.bits), lambda z: z[1] <> z[2])) AS INTEGER) AS distance
      FROM b AS q JOIN b ON q.vec_id % 50 = 0 AND q.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbor_id) AS rank FROM p)
SELECT vec_id, CAST(rank AS INTEGER) AS rank, neighbor_id, distance FROM r WHERE rank <= 10
"""
