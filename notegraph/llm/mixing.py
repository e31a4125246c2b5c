"""Mixing sources to target weights by systematic sampling.

Each source has a target amount of words. Its documents stand in one fixed order; every document adds its
expected number of copies (target / size of the source) to a running sum, one random offset is added, and a
document is emitted once for each integer boundary that its step crosses.

The order is (size class, md5 of id and text, id). Neighbours have like sizes, so the words taken stay near the
target. A chunk of the order is (source, size class, first hex digits of the md5): the running sum is a
row_number inside a chunk plus the counts of the chunks before it, so no source is sorted in one task, and how
many hex digits make a chunk changes the plan but not the result. Rows without an id, and rows of one id, are spread
over the chunks by their texts.

Defined cases: null text has size 0, very long texts count whole; a null source is a source of its own, ordered last;
a null id counts as the empty text in the md5; equal rows are interchangeable, as they get neighbouring places; an
empty table gives an empty mix; extra columns, whatever their names (but for those that begin with ``__ng_``), come
along in `mix` and are not read. No document is emitted more often than ``cap`` times.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from notegraph.llm.common import WORD, table

#: Rows that one chunk holds on average in the largest table that one hex digit less would serve.
CHUNK_ROWS = 1 << 15
CAP = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def size_class(size: Column) -> Column:
    """Bit length and the two bits after the first: classes whose sizes differ by a fifth or so."""
    bits = F.bin(size)
    n = F.length(bits)
    return n * 4 + F.when(n > 3, F.conv(F.substring(bits, 2, 2), 2, 10).cast("int")).otherwise(0)


def place(id_: Column, text: Column) -> Column:
    """What the order inside a size class goes by."""
    part = F.coalesce(id_.cast("string"), F.lit(""))
    return F.md5(F.concat(part, F.lit(":"), F.md5(F.coalesce(text, F.lit("")).cast("binary"))).cast("binary"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = CAP) -> DataFrame:
    """``(source, source_size)`` to ``(source, source_size, target)``.

    Sources by code point, null last, take the weights in turn and share the sum of all sizes. A target stops at
    ``cap`` times its source's size; what that leaves over goes to the rest by weight, again and again. This has a
    closed form: by rising cap / weight the capped sources come first, and the rest share what they leave.
    One row per source takes part.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    s = sizes.withColumn("w", pick).withColumn("most", cap * F.col("source_size"))
    total = W.partitionBy(F.lit(1))
    order = W.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    s = s.withColumns(
        {
            "left": F.sum("source_size").over(total) - F.coalesce(F.sum("most").over(before), F.lit(0)),
            "w_left": F.sum("w").over(total) - F.coalesce(F.sum("w").over(before), F.lit(0)),
        }
    )
    s = s.withColumn("open", F.col("left") / F.col("w_left") <= F.col("most") / F.col("w"))
    level = F.min(F.when(F.col("open"), F.struct(F.col("most") / F.col("w"), F.col("left") / F.col("w_left")))).over(total)
    s = s.withColumn("level", level["col2"])
    target = F.when(F.col("level").isNull(), F.col("most").cast("double")).otherwise(
        F.least(F.col("most").cast("double"), F.col("w") * F.col("level"))
    )
    return s.select("source", "source_size", target.alias("target"))


def offset_of(source: Column) -> Column:
    """The one random offset of a source, a multiple of 2**-16 in [0, 1)."""
    digest = F.md5(F.coalesce(F.concat(F.lit("s:"), source), F.lit("null")).cast("binary"))
    return F.conv(F.substring(digest, 1, 4), 16, 10).cast("double") / 65536


def copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cap: int = CAP, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Per row of ``df``: id, h, source, size, source_size, target, copies. Only these narrow columns are shuffled."""
    text = F.col(text_col)
    slim = df.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(text).alias("__ng_size"), place(F.col(id_col), text).alias("h"))
    n = slim.count()
    digits = max(0, math.ceil(math.log(max(n, 1) / chunk_rows, 16)))
    slim = slim.withColumn("cls", size_class(F.col("__ng_size")))
    slim = slim.withColumn("part", F.substring("h", 1, digits) if digits else F.lit(""))
    chunk = slim.groupBy("source", "cls", "part").agg(F.count("*").alias("n"), F.sum("__ng_size").alias("words"))
    classes = chunk.groupBy("source", "cls").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    up = lambda *keys: W.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(W.unboundedPreceding, -1)
    classes_before = classes.select("source", "cls", F.coalesce(F.sum("n").over(up("source", "cls")), F.lit(0)).alias("b1"))
    in_class = chunk.select("source", "cls", "part", F.coalesce(F.sum("n").over(up("source", "cls", "part")), F.lit(0)).alias("b2"))
    targets = source_targets(classes.groupBy("source").agg(F.sum("words").alias("source_size")), cap=cap)
    starts = _joined(_joined(in_class, classes_before, ["source", "cls"]), targets, ["source"])
    starts = starts.withColumn("before", F.col("b1") + F.col("b2")).drop("b1", "b2")
    placed = slim.withColumn("rn", F.row_number().over(W.partitionBy("source", "cls", "part").orderBy("h", F.col("id").asc_nulls_first(), "__ng_size")))
    out = _joined(placed, starts, ["source", "cls", "part"])
    step = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    k = F.col("before") + F.col("rn")
    crossed = F.floor(k * step + offset_of(F.col("source"))) - F.floor((k - 1) * step + offset_of(F.col("source")))
    return out.select("id", "h", "source", F.col("__ng_size").alias("size"), "source_size", "target", crossed.alias("copies"))


def _joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """An inner join on keys of which nulls are equal; the keys appear once."""
    other = right.select([F.col(c).alias(f"__ng_r_{c}") if c in keys else F.col(c) for c in right.columns])
    return left.join(other, [left[k].eqNullSafe(other[f"__ng_r_{k}"]) for k in keys]).drop(*[f"__ng_r_{k}" for k in keys])


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cap: int = CAP) -> DataFrame:
    """The mixed table: rows of ``df``, all columns, each as often as its number of copies says (0 to ``cap``).

    Rows of equal id, source and text share out the copies that they got together.
    """
    plan = copies(df, id_col, text_col, source_col, cap).select(F.xxhash64("h", "source").alias("__ng_key"), "copies")
    plan = plan.groupBy("__ng_key").agg(F.sum("copies").alias("__ng_sum"), F.count("*").alias("__ng_n"))
    keyed = df.withColumn("__ng_key", F.xxhash64(place(F.col(id_col), F.col(text_col)), F.col(source_col)))
    hit = keyed.join(plan.where(F.col("__ng_sum") > 0), "__ng_key")
    hit = hit.withColumn("__ng_rn", F.row_number().over(W.partitionBy("__ng_key").orderBy(F.xxhash64(F.col(text_col)))))
    share = F.expr("__ng_sum div __ng_n + if(__ng_rn <= __ng_sum % __ng_n, 1, 0)").cast("int")
    hit = hit.withColumn("__ng_copies", share).where(F.col("__ng_copies") > 0)
    return hit.withColumn("__ng_copy", F.explode(F.sequence(F.lit(1), F.col("__ng_copies")))).select(*df.columns)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = copies(table(spark, sf_dir, "documents"))
    return c.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", F.col("copies").cast("long").alias("copies"))


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w, 3 * source_size AS most FROM s),
o AS (SELECT *, sum(source_size) OVER () - coalesce(sum(most) OVER before, 0) AS left_,
             sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS w_left
      FROM w WINDOW before AS (ORDER BY most / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, first_value(left_ / w_left) OVER (ORDER BY CASE WHEN left_ / w_left <= most / w THEN 0 ELSE 1 END, most / w, source NULLS LAST) AS level,
             max(CASE WHEN left_ / w_left <= most / w THEN 1 ELSE 0 END) OVER () AS any_open FROM o),
t AS (SELECT source, source_size,
             CASE WHEN any_open = 0 THEN CAST(most AS DOUBLE) ELSE least(CAST(most AS DOUBLE), w * level) END AS target,
             CAST(CAST('0x' || substr(md5(coalesce('s:' || source, 'null')), 1, 4) AS INTEGER) AS DOUBLE) / 65536 AS u FROM l),
c AS (SELECT *, length(bin(size)) AS b FROM d),
k AS (SELECT *, row_number() OVER (PARTITION BY source
        ORDER BY b * 4 + CASE WHEN b > 3 THEN (size >> (b - 3)) % 4 ELSE 0 END, h, doc_id NULLS FIRST, size) AS k FROM c),
e AS (SELECT k.doc_id, k.source, k.size, k.k, t.source_size, t.target, t.u,
             CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS step
      FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source),
f AS (SELECT *, CAST(floor(k * step + u) - floor((k - 1) * step + u) AS BIGINT) AS copies FROM e)
SELECT doc_id, size, source_size, target, copies * size AS taken, source, copies FROM f
"""
