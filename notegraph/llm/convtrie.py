"""The trie of conversation prefixes by the Euler-tour technique.

A node is a distinct sequence of first turns (role and text), the root is the empty one. The conversations that begin with
a node are its members; those with no more turns end there. What training saves by sharing prefixes is, per node, the
words of its last turn times its members less one.

1. *Nodes*: a prefix is known by a digest, made from digests of blocks of 1, 2, 4... turns, so rounds are the logarithm of
   the longest conversation, and no task has to see all turns of one.
2. *Tour*: a node's smallest member names it, together with its depth. Nodes with one name are a path down to the end of
   that conversation, and a node's children stand in the order of their names, so the path's own child comes first. Each
   node has an enter and an exit arc. Enter arcs of a path follow each other, and so do exit arcs between two nodes that
   others branch from; such runs of arcs are the tour's items, with their lengths as weights.
3. *List ranking*: pointer jumping over the items, one join a round, gives each item's distance to the tour's end and so
   every arc's position. Rounds are the logarithm of the number of items.
4. *Prefix sums*: values stand at enter arcs; running sums over chunks of positions, plus the sums of the chunks before,
   give each subtree's as the difference between its exit and its enter arc.

Turns are numbered, siblings follow each other and ids are digested over ranges of sorted rows, so no conversation, node
or set of siblings is one task's. Only the last step of a node's digest is: it streams pieces of `PIECE` ids each.

Defined cases: turns stand by number, null first, of equal number by role, then by a digest of the text; repeated rows are
turns of their own; null role and text are empty; rows without a conversation id are no conversation's and are left out;
very long texts count whole, and a million turns are turns like others; an empty table gives no rows, not even a root;
extra columns, whatever their names, are never read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from notegraph.llm.common import WORD, Scratch, materialize, table
from notegraph.operators.numbering import numbered

#: Places of a chunk of the tour, and ids of a piece of a digest.
CHUNK, PIECE = 1 << 16, 4096


def _digest(*parts: Column) -> Column:
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, 16)


def ordered_turns(df: DataFrame, scratch: Scratch, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(conv, pos, item, words)``: a row per turn, pos from 1 on; the item stands for role and text."""
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    item = _digest(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = df.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), item.alias("item"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")
    )
    return numbered(rows, ["conv"], ["turn", "role", "item"], scratch, "turns").select("conv", F.col("idx").alias("pos"), "item", "words")


def _prefixes(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """``turns (conv, pos, item, words)`` to ``(conv, pos, key, words)``; the key stands for the first pos turns."""
    level = scratch.write(turns.select("conv", (F.col("pos") - 1).alias("j"), F.col("item").alias("block")), "blocks-0")
    blocks, k = level.withColumn("k", F.lit(0)), 0
    while True:
        half = lambda odd: F.max(F.when(F.col("j") % 2 == odd, F.col("block")))
        level = level.groupBy("conv", F.shiftright("j", 1).alias("up")).agg(half(0).alias("a"), half(1).alias("b")).where("b is not null")
        k += 1
        level = scratch.write(level.select("conv", F.col("up").alias("j"), _digest(F.col("a"), F.col("b")).alias("block")), f"blocks-{k}")
        if level.isEmpty():
            break
        blocks = blocks.union(level.withColumn("k", F.lit(k)))  # a table a round, so the logarithm of the longest
    bits = F.expr(f"filter(sequence(0, {k - 1}), k -> shiftright(pos, k) % 2 = 1)")
    parts = turns.select("conv", "pos", F.explode(bits).alias("k")).withColumn("j", F.expr("shiftright(pos, k) - 1"))
    parts = parts.join(blocks, ["conv", "k", "j"]).groupBy("conv", "pos")
    parts = parts.agg(F.sort_array(F.collect_list(F.struct("k", "block")), asc=False).alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda acc, x: F.concat(acc, x["block"]))
    return scratch.write(parts.withColumn("key", _digest(joined)).drop("parts").join(turns.select("conv", "pos", "words"), ["conv", "pos"]), "prefixes")


def _ranked(items: DataFrame, scratch: Scratch) -> DataFrame:
    """``items (c, f, nc, nf, w)``, a linked list by (nc, nf), to ``(c, f, rest)``: the weights from an item to the end."""
    now = scratch.write(items.withColumnRenamed("w", "rest"), "list")
    while not (open_ := now.where("nc is not null")).isEmpty():
        ahead = now.select(F.col("c").alias("nc"), F.col("f").alias("nf"), F.col("nc").alias("nnc"), F.col("nf").alias("nnf"), F.col("rest").alias("more"))
        jumped = open_.join(ahead, ["nc", "nf"]).select("c", "f", F.col("nnc").alias("nc"), F.col("nnf").alias("nf"), (F.col("rest") + F.col("more")).alias("rest"))
        now = scratch.write(jumped.unionByName(now.where("nc is null")), "list")
    return now.select("c", "f", "rest")


def _each(lo: Column, hi: Column, rows: DataFrame, name: str) -> DataFrame:
    """A row for each number from lo to hi, in two steps so that arrays stay short."""
    rows = rows.withColumn("_lo", F.explode(F.sequence(lo, hi, F.lit(PIECE).cast("long")))).withColumn("_hi", F.least(F.col("_lo") + (PIECE - 1), hi))
    return rows.withColumn(name, F.explode(F.sequence("_lo", "_hi"))).drop("_lo", "_hi")


def _end_digests(ends: DataFrame, scratch: Scratch) -> DataFrame:
    """``ends (conv, d, key)`` to ``(d, key, ends_sha256)``: SHA-256 of each node's sorted ids, joined by commas."""
    pieces = numbered(ends, ["d", "key"], ["conv"], scratch, "ends").withColumn("piece", F.floor((F.col("idx") - 1) / PIECE))
    pieces = pieces.groupBy("d", "key", "piece").agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda x: x.cast("string")), ",").alias("ids"))
    pieces = pieces.repartition("d", "key").sortWithinPartitions("d", "key", "piece")

    def run(batches):
        node, sha = None, None
        done: list[tuple] = []
        for batch in batches:
            for d, key, ids in zip(batch["d"].to_pylist(), batch["key"].to_pylist(), batch["ids"].to_pylist(), strict=True):
                if node == (d, key):
                    sha.update(b",")
                else:
                    if node:
                        done.append((*node, sha.hexdigest()))
                    node, sha = (d, key), hashlib.sha256()
                sha.update(ids.encode())
            yield _batch(done)
            done = []
        if node:
            yield _batch([(*node, sha.hexdigest())])

    return pieces.select("d", "key", "ids").mapInArrow(run, "d long, key binary, ends_sha256 string")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    d, key, sha = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(key, pa.binary()), pa.array(sha, pa.string())], ["d", "key", "ends_sha256"])


def prefix_trie(turns: DataFrame, convs: DataFrame, scratch: Scratch) -> DataFrame:
    """``turns (conv, pos, item, words)``, pos from 1 on without gaps, and all ``convs (conv)``, turnless ones included, to
    a row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    prefixes = _prefixes(turns, scratch)
    none = F.lit(b"")
    root = convs.groupBy().agg(F.min("conv").alias("c"), F.count("*").alias("n"), F.lit(0).cast("long").alias("words")).where("n > 0")
    nodes = prefixes.groupBy(F.col("pos").alias("d"), "key").agg(F.min("conv").alias("c"), F.count("*").alias("n"), F.max("words").alias("words"))
    nodes = scratch.write(nodes.unionByName(root.select(F.lit(0).cast("long").alias("d"), none.alias("key"), "c", "n", "words")), "nodes")
    lengths = turns.groupBy("conv").agg(F.max("pos").alias("d"))

    # paths of nodes with one name, and the nodes that they branch from
    paths = scratch.write(nodes.groupBy("c").agg(F.min("d").alias("top"), F.max("d").alias("bottom")), "paths")
    above = paths.where("top > 0").select("c", (F.col("top") - 1).alias("d"))
    keyed = above.where("d > 0").join(prefixes.select(F.col("conv").alias("c"), F.col("pos").alias("d"), "key"), ["c", "d"])
    keyed = keyed.unionByName(above.where("d = 0").withColumn("key", none))
    branches = keyed.join(nodes.select("d", "key", F.col("c").alias("pc")), ["d", "key"]).select("pc", F.col("d").alias("pd"), "c")
    branches = numbered(branches, ["pc", "pd"], ["c"], scratch, "branches")
    forks = scratch.write(branches.groupBy("pc", "pd").agg(F.count("*").alias("nb"), F.min("c").alias("first")), "forks")
    following = branches.select("pc", "pd", (F.col("idx") - 1).alias("idx"), F.col("c").alias("sibling"))
    placed = scratch.write(branches.join(following, ["pc", "pd", "idx"], "left").select("c", "pc", "pd", "sibling"), "placed")

    # the tour: an item (c, -1) for the enter arcs of a path, one (c, f) for exit arcs from depth f upwards
    last = F.lit(-1).cast("long")
    at_end = forks.select(F.col("pc").alias("c"), F.col("pd").alias("bottom"), "first")
    enter = paths.join(at_end, ["c", "bottom"], "left").select(
        "c", last.alias("f"), F.coalesce("first", "c").alias("nc"), F.when(F.col("first").isNull(), F.col("bottom")).otherwise(last).alias("nf"), (F.col("bottom") - F.col("top") + 1).alias("w")
    )
    heads = paths.select("c", F.col("bottom").alias("f")).union(forks.select(F.col("pc").alias("c"), F.col("pd").alias("f"))).distinct()
    heads = numbered(heads, ["c"], ["f"], scratch, "heads")
    lower = heads.select("c", (F.col("idx") + 1).alias("idx"), F.col("f").alias("lower"))
    runs = heads.join(lower, ["c", "idx"], "left").join(paths.select("c", "top"), "c").withColumn("g", F.coalesce(F.col("lower") + 1, F.col("top")))
    runs = scratch.write(runs.select("c", "f", "g", "lower"), "runs")
    inner = runs.where("lower is not null").join(forks.select(F.col("pc").alias("c"), F.col("pd").alias("lower"), "first"), ["c", "lower"])
    inner = inner.select("c", "f", F.col("first").alias("nc"), last.alias("nf"), (F.col("f") - F.col("g") + 1).alias("w"))
    outer = runs.where("lower is null").join(placed, "c", "left")
    to = F.when(F.col("sibling").isNotNull(), last).otherwise(F.col("pd"))
    outer = outer.select("c", "f", F.coalesce("sibling", "pc").alias("nc"), to.alias("nf"), (F.col("f") - F.col("g") + 1).alias("w"))
    ranked = scratch.write(_ranked(enter.union(inner).union(outer), scratch), "ranked")

    # positions of all arcs
    start = ranked.select("c", "f", (F.lit(2 * nodes.count()) - F.col("rest")).alias("at"))
    down = _each(F.col("top"), F.col("bottom"), start.where("f = -1").drop("f").join(paths, "c"), "d").select("c", "d", (F.col("at") + F.col("d") - F.col("top")).alias("enter"))
    up = _each(F.col("g"), F.col("f"), start.join(runs.select("c", "f", "g"), ["c", "f"]), "d").select("c", "d", (F.col("at") + F.col("f") - F.col("d")).alias("exit"))
    full = nodes.join(down, ["c", "d"]).join(up, ["c", "d"]).join(paths, "c").join(forks.select(F.col("pc").alias("c"), F.col("pd").alias("d"), "nb"), ["c", "d"], "left")
    children = F.coalesce("nb", F.lit(0).cast("long")) + F.when(F.col("d") < F.col("bottom"), 1).otherwise(0)
    full = full.select("c", "d", "key", "n", "enter", "exit", "top", children.alias("n_children"), ((F.col("n") - 1) * F.col("words")).alias("saved"))
    full = scratch.write(full.withColumn("leaf", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")), "full")

    # prefix sums
    nothing = F.lit(0).cast("long")
    arcs = full.select("c", "d", F.col("enter").alias("at"), F.lit(True).alias("enters"), "leaf", "saved").union(full.select("c", "d", "exit", F.lit(False), nothing, nothing))
    arcs = arcs.withColumn("chunk", F.floor(F.col("at") / CHUNK))
    sums = arcs.groupBy("chunk").agg(F.sum("leaf").alias("l"), F.sum("saved").alias("s"))
    earlier = W.orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)  # a row for each 65,536 arcs
    sums = sums.select("chunk", F.coalesce(F.sum("l").over(earlier), nothing).alias("l"), F.coalesce(F.sum("s").over(earlier), nothing).alias("s"))
    so_far = W.partitionBy("chunk").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    arcs = arcs.withColumn("own_l", F.sum("leaf").over(so_far)).withColumn("own_s", F.sum("saved").over(so_far)).join(sums, "chunk")
    sign = F.when(F.col("enters"), -1).otherwise(1)
    subtree = arcs.groupBy("c", "d").agg(
        F.sum(sign * (F.col("own_l") + F.col("l")) + F.col("leaf")).alias("n_leaves"), F.sum(sign * (F.col("own_s") + F.col("s")) + F.col("saved")).alias("saved_tokens")
    )

    ends = convs.join(lengths, "conv", "left").withColumn("d", F.coalesce("d", nothing))
    ends = ends.join(prefixes.select("conv", F.col("pos").alias("d"), "key"), ["conv", "d"], "left").withColumn("key", F.coalesce("key", none))
    out = full.join(subtree, ["c", "d"]).join(_end_digests(ends.select("conv", "d", "key"), scratch), ["d", "key"], "left")
    out = out.join(placed.select("c", (F.col("pd") + 1).alias("d"), "pc"), ["c", "d"], "left")
    parent = F.when(F.col("d") > F.col("top"), F.col("c")).otherwise(F.col("pc"))
    nobody = F.lit(hashlib.sha256().hexdigest())
    return out.select(
        F.col("c").alias("conv_id"),
        F.col("d").alias("depth"),
        parent.alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", nobody).alias("ends_sha256"),
    )


def conversation_trie(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The trie of the conversations of ``df``, a row per node as in `prefix_trie`."""
    scratch = Scratch(df.sparkSession, "trie")
    turns = ordered_turns(df, scratch, id_col, turn_col, role_col, text_col)
    out = materialize(prefix_trie(turns, turns.select("conv").distinct(), scratch), "trie")
    scratch.close()
    return out


def rebuilt(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The query's conversations: the first h turns of conversation c - c % 20, then c's own without its first h."""
    h = F.crc32(F.col("conv").cast("string")) % 4
    heads = turns.where("pos <= 3").select(F.col("conv").alias("base"), "pos", "item", "words")
    plan = convs.select("conv", (F.col("conv") - F.col("conv") % 20).alias("base"), h.alias("h"))
    first = plan.join(heads, "base").where("pos <= h").select("conv", "pos", "item", "words")
    size = heads.groupBy("base").agg(F.count("*").alias("n"))
    taken = plan.join(size, "base", "left").select("conv", "h", F.least("h", F.coalesce("n", F.lit(0).cast("long"))).alias("taken"))
    own = turns.join(taken, "conv").where("pos > h").select("conv", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "item", "words")
    return first.union(own)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "trie")
    turns = ordered_turns(table(spark, sf_dir, "conversations"), scratch)
    convs = scratch.write(turns.select("conv").distinct(), "convs")
    out = materialize(prefix_trie(scratch.write(rebuilt(turns, convs), "rebuilt"), convs, scratch), "trie")
    scratch.close()
    return out


#: CRC-32 of the digits of a conversation id: eight steps a digit.
_CRC = """xor(list_reduce(list_transform(string_split(conv::VARCHAR, ''), lambda s: ascii(s)::BIGINT), lambda crc, code:
    list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, code)), 4294967295::BIGINT), 4294967295)"""

OP11_SQL = rf"""
WITH original AS (
    SELECT conv_id AS conv, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
            sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (SELECT conv, conv - conv % 20 AS base, {_CRC} % 4 AS h FROM (SELECT DISTINCT conv FROM original)
), taken AS (
    SELECT c.conv, c.base, c.h, count(o.conv) AS n FROM convs c LEFT JOIN original o ON o.conv = c.base AND o.pos <= c.h GROUP BY ALL
), turns AS (
    SELECT t.conv, o.pos, o.role, o.text FROM taken t JOIN original o ON o.conv = t.base AND o.pos <= t.h
    UNION ALL SELECT t.conv, o.pos - t.h + t.n, o.role, o.text FROM taken t JOIN original o ON o.conv = t.conv AND o.pos > t.h
), member AS (
    SELECT conv, pos AS d, list({{'role': role, 'text': text}}) OVER (PARTITION BY conv ORDER BY pos) AS k, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM turns
    UNION ALL SELECT conv, 0, [], 0 FROM convs
), node AS (SELECT k, d, min(conv) AS c, count(*) AS n, (count(*) - 1) * any_value(words) AS saved FROM member GROUP BY k, d
), inside AS (SELECT m.conv, m.d, n.c, n.n, n.saved, m.k FROM member m JOIN node n ON n.k = m.k AND n.d = m.d
), edge AS (SELECT DISTINCT a.c AS pc, a.d AS pd, b.c, b.d FROM inside a JOIN inside b ON b.conv = a.conv AND b.d = a.d + 1
), childless AS (SELECT c, d, saved, (c, d) NOT IN (SELECT (pc, pd) FROM edge) AS leaf FROM node
), below AS (SELECT DISTINCT a.c AS tc, a.d AS td, b.c, b.d FROM inside a JOIN inside b ON b.conv = a.conv AND b.d >= a.d
), subtree AS (SELECT tc, td, count(*) FILTER (leaf) AS n_leaves, sum(saved)::BIGINT AS saved FROM below JOIN childless USING (c, d) GROUP BY tc, td
), ends AS (
    SELECT c, d, string_agg(conv::VARCHAR, ',' ORDER BY conv) AS ids FROM inside i WHERE d = (SELECT max(d) FROM member m WHERE m.conv = i.conv) GROUP BY c, d
)
SELECT n.c AS conv_id, n.d AS depth, e.pc AS parent_conv_id, n.n AS n_convs, (SELECT count(*) FROM edge x WHERE x.pc = n.c AND x.pd = n.d) AS n_children,
    s.n_leaves, s.saved AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM node n LEFT JOIN edge e ON e.c = n.c AND e.d = n.d JOIN subtree s ON s.tc = n.c AND s.td = n.d LEFT JOIN ends x ON x.c = n.c AND x.d = n.d
"""
