"""Near-duplicate detection with bottom-k sketches from one hash function.

1. Texts with the same word sequence form a class at once, so groups of copies never meet each other row by row.
2. Each class has the k smallest distinct hashes of its word shingles. Inverted lists map a retained value to the
   classes that have it; values that only one class has are left out after counting.
3. Two sets with similarity of at least ``threshold`` share at least t of the retained values, so they also share
   one of the (size - t + 1) rarest of them: only those rarest values are listed. For sets that fit into a sketch t
   follows from the threshold and is exact; else t is half of k, which such a pair misses with a chance of 1e-8.
4. First each list's most central class is compared with the list's others. Classes found linked are one component
   from then on, and only pairs of a list that are still in different components remain. In short lists they are
   compared pair by pair.
5. Classes of longer lists are listed anew by their *full* sets, which splits the lists by content and is exact: a set
   of n shingles lists the n - ceil(0.8 n) + 1 that are rarest among these classes, the i-th of them only for partners
   of sizes that n - i + 1 shared shingles suffice for. A near copy that is not linked to the centre of its group has
   shingles of its own, so hardly anything of it is listed again. What is left is compared pair by pair in short lists.
   Long ones that share classes are one group: its classes are dealt to blocks of bounded bytes, and two blocks meet
   once for all lists, inside a task. No set is carried by list rows, and blocks of one component do not meet.
6. A pair from a join is dropped early only if the estimate from the union's sketch is six standard deviations below
   the threshold. All others are confirmed or refuted on the full sets.
7. Components are found by smallest labels; a document's component is the smallest id in it.

Full sets are made anew from the texts of those classes that some pair asks for. Intermediate tables are deleted.

Ids are integers. Defined cases: null texts and texts without words have an empty set and are linked with nothing;
with fewer words than a shingle has, the whole sequence is the one shingle; very long texts count whole, as any other;
rows with a null id are components of their own (null) and are kept; repeated rows share a component, and all of them
carry its smallest id; of equal sizes and ties nothing depends; an empty table gives no rows; extra columns, whatever
their names, are never read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from notegraph.llm.common import Scratch, materialize, released, sieved, small_batches, table, text_or_empty
from notegraph.operators.clusters import components

K = 64
#: Lists with more rows are split by the full sets, and compared in blocks if they are still longer. A block's bytes and rows.
SHORT, BLOCK_BYTES, BLOCK_ROWS = 8, 16_000_000, 2048
#: Word hashes that a worker remembers.
REMEMBERED = 100_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


_hashes = _WordHashes()


def shingle_set(words: list[bytes], n: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the n-word shingles; one for the whole sequence if it is shorter."""
    if not words:
        return np.empty(0, np.int64)
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    span = min(n, len(words))
    out = np.full(len(words) - span + 1, len(words) if len(words) < n else n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(span):
            out = (out ^ h[i : len(h) - span + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        out = (out ^ (out >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(31)
    return np.unique(out.view(np.int64))


def word_list(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased: what bytes.lower and bytes.split do."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def _alike(shared: Column, a: Column, b: Column, percent: int) -> Column:
    return 100 * shared >= percent * (a + b - shared)


def _sizes_fit(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _with_sets(rows: DataFrame, n: int, k: int | None) -> DataFrame:
    """``rows (id, text)`` to ``(id, cls, n, sketch)``; the k smallest hashes, or the whole set without k."""

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                cls, size, sets = [], [], []
                for text in part["text"].to_pylist():
                    words = word_list(text)
                    found = shingle_set(words, n)
                    cls.append(hashlib.md5(b" ".join(words)).digest())
                    size.append(len(found))
                    sets.append(found[:k])
                offsets = np.cumsum([0] + [len(x) for x in sets])
                values = pa.array(np.concatenate(sets) if sets else np.empty(0, np.int64), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part["id"], pa.array(cls, pa.binary()), pa.array(size, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)],
                    ["id", "cls", "n", "sketch"],
                )
        _hashes.clear()  # the worker lives on; what it remembers does not

    return rows.mapInArrow(released(run), "id long, cls binary, n long, sketch array<long>")


def classes_of(df: DataFrame, id_col: str, text_col: str, n: int, k: int) -> DataFrame:
    """``(id, cls, n, sketch)``: cls stands for the word sequence, n is the set's size."""
    return _with_sets(df.select(F.col(id_col).cast("long").alias("id"), text_or_empty(F.col(text_col)).alias("text")), n, k)


def listed(nodes: DataFrame, k: int, percent: int) -> DataFrame:
    """``nodes (node, n, sketch)`` to the inverted lists' rows ``(v, node, n, w)``; w says how central a node is."""
    rows = nodes.select("node", "n", F.size("sketch").alias("m"), F.explode("sketch").alias("v"))
    often = rows.groupBy("v").agg(F.count("*").alias("f")).where(F.col("f") > 1)
    rows = rows.join(often, "v")
    need = F.when(F.col("n") * 100 <= k * percent, F.ceil(F.col("n") * percent / 100)).otherwise(k // 2)
    own = W.partitionBy("node")
    rows = rows.select("v", "node", "n", "m", need.alias("t"), F.row_number().over(own.orderBy("f", "v")).alias("rn"), F.count("*").over(own).alias("often"), F.sum("f").over(own).alias("w"), "f")
    rare = F.col("m") - F.col("often")  # values that no one else has come first in the order
    return rows.where(F.col("rn") + rare <= F.col("m") - F.col("t") + 1).select("v", "node", "n", "w", "rn")


def star_pairs(lists: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Each list's most central node with all others of the list: ``(a, b)``."""
    hubs = lists.groupBy("v").agg(F.max(F.struct("w", F.negative("node").alias("neg"), "n")).alias("hub"), F.count("*").alias("c"))
    # a written table is joined by an exchange of its own, which adaptive execution can split at a long list
    hubs = scratch.write(hubs.where(F.col("c") > 1).select("v", F.negative("hub.neg").alias("a"), F.col("hub.n").alias("na")), "hubs")
    pairs = lists.join(hubs, "v").where((F.col("a") != F.col("node")) & _sizes_fit(F.col("n"), F.col("na"), percent))
    return pairs.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()


def mixed_lists(rows: DataFrame, name: str, scratch: Scratch) -> DataFrame:
    """The rows ``(v, label, ...)`` of lists that hold more than one component, with the list's length ``c``."""
    mixed = rows.groupBy("v").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("c"))
    mixed = scratch.write(mixed.where(F.col("lo") < F.col("hi")).select("v", "c"), f"{name}-lengths")
    return scratch.write(rows.join(mixed, "v"), name)


def _meet(rows: DataFrame, keep: Column) -> DataFrame:
    """Pairs ``(a, b)`` of two components that meet in a list and that ``keep`` lets through; for short lists only."""
    sides = [rows.select("v", *[F.col(c).alias(f"{c}_{s}") for c in rows.columns if c != "v"]) for s in "ab"]
    pairs = sides[0].join(sides[1], "v").where((F.col("node_a") < F.col("node_b")) & (F.col("label_a") != F.col("label_b")) & keep)
    return pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def full_lists(sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """``sets (node, label, sh)`` to lists by full sets ``(v, node, n, label, most, c)`` that may still hold a link.

    ``most`` is the size of the largest partner that may have ``v`` as the first value shared with the node. Of each
    pair that reaches the threshold both rows at their first shared value remain.
    """
    rows = sets.select("node", "label", F.size("sh").alias("n"), F.explode("sh").alias("v"))
    often = scratch.write(rows.groupBy("v").agg(F.count("*").alias("f")).where(F.col("f") > 1), "full-often")
    rows = rows.join(often, "v")
    own = W.partitionBy("node")
    # values that no one else has come first; left: so many values can be shared from here on
    left = F.count("*").over(own) - F.row_number().over(own.orderBy("f", "v")) + 1
    rows = rows.select("v", "node", "n", "label", left.alias("left"))
    rows = rows.withColumn("most", F.floor(F.col("left") * (100 + percent) / percent + 1e-9) - F.col("n")).where(100 * F.col("most") >= percent * F.col("n"))
    rows = scratch.write(rows.drop("left"), "full-rows")
    ends = scratch.write(rows.groupBy("v").agg(F.min("n").alias("least"), F.max("most").alias("largest"), F.count("*").alias("c")).where(F.col("c") > 1).drop("c"), "full-ends")
    rows = rows.join(ends, "v").where((F.col("most") >= F.col("least")) & (F.col("n") <= F.col("largest"))).drop("least", "largest")
    return mixed_lists(rows, "full-lists", scratch)


def blocks_of(nodes: DataFrame, size: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``nodes (node, g, label, weight)`` to ``(node, g, own, part)``, the block that a node belongs to in its group, and to
    the blocks ``(g, own, part)``.

    Labels heavier than ``size`` fill blocks of their own (own: the label), the others share blocks (own: -1).
    """
    labels = scratch.write(nodes.groupBy("g", "label").agg(F.sum("weight").alias("w")), "long-labels")
    labels = labels.select("g", "label", "w", F.when(F.col("w") > size, F.col("label")).otherwise(-1).alias("own"))
    sums = scratch.write(labels.groupBy("g", "own").agg(F.ceil(F.sum("w") / size).alias("parts")), "long-sums")
    seed = F.when(F.col("own") >= 0, F.col("node")).otherwise(F.col("label"))
    part = F.pmod(F.xxhash64(seed, F.lit(1)), F.col("parts"))
    placed = nodes.join(labels.drop("w"), ["g", "label"]).join(sums, ["g", "own"]).select("node", "g", "own", part.alias("part"))
    return placed, sums.select("g", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))


def long_links(rows: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Links across components in long lists ``rows (v, node, n, label, most)``, confirmed on the full sets.

    Lists that share nodes are one group, however many they are, and a group's nodes are dealt to blocks of bounded
    bytes. Two blocks meet once, for all their lists: a set is fetched as often as its block meets another, and blocks
    of one component do not meet.
    """
    hubs = rows.groupBy("v").agg(F.min("node").alias("hub"))
    groups = components(rows.join(hubs, "v").select(F.col("hub").alias("src"), F.col("node").alias("dst")))
    lists = rows.groupBy("node").agg(F.first("n").alias("n"), F.first("label").alias("label"), F.collect_list("v").alias("vs"), F.collect_list("most").alias("mosts"))
    lists = scratch.write(lists.join(groups.withColumnRenamed("component", "g"), "node"), "long-nodes")
    weight = 8 * F.col("n") + 16 * F.size("vs") + BLOCK_BYTES // BLOCK_ROWS
    placed, blocks = blocks_of(lists.select("node", "g", "label", weight.alias("weight")), BLOCK_BYTES, scratch)
    placed = scratch.write(placed, "long-placed")
    one, two = (blocks.select("g", F.col("own").alias(f"own_{k}"), F.col("part").alias(f"part_{k}")) for k in "ij")
    same = (F.col("own_i") == F.col("own_j")) & (F.col("part_i") == F.col("part_j"))
    meet = one.join(two, "g").where(F.when(F.col("own_i") == F.col("own_j"), (F.col("own_i") < 0) & (F.col("part_i") <= F.col("part_j"))).otherwise(F.col("own_i") < F.col("own_j")))
    meet = scratch.write(meet.select("g", "own_i", "part_i", "own_j", "part_j", same.alias("inside")), "long-meet")
    pair = ["g", "own_i", "part_i", "own_j", "part_j"]
    first = placed.join(meet.withColumns({"own": F.col("own_i"), "part": F.col("part_i")}), ["g", "own", "part"]).withColumn("side", F.lit(0))
    second = placed.join(meet.where(~F.col("inside")).withColumns({"own": F.col("own_j"), "part": F.col("part_j")}), ["g", "own", "part"]).withColumn("side", F.lit(1))
    dealt = first.unionByName(second).select("node", "inside", "side", *pair)
    dealt = dealt.join(lists.drop("g"), "node").join(sets.select("node", "sh"), "node")

    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        return _block(pdf, percent)

    return dealt.groupBy(*pair).applyInPandas(block, "a long, b long").distinct()


def _may_link(pdf: pd.DataFrame, x: np.ndarray, y: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which of the rows x and y meet in a list in which they still can share enough."""
    rows = np.repeat(np.arange(len(pdf)), [len(v) for v in pdf["vs"]])
    values, most = np.concatenate(list(pdf["vs"])), np.concatenate(list(pdf["mosts"]))
    order = np.argsort(values, kind="stable")
    values, rows, most = values[order], rows[order], most[order]
    at = np.full(len(pdf), -1)
    at[x] = np.arange(len(x))
    of = np.full(len(pdf), -1)
    of[y] = np.arange(len(y))
    near = np.zeros((len(x), len(y)), bool)
    for begin, end in zip(*(lambda c: (c[:-1], c[1:]))(np.r_[0, np.flatnonzero(np.diff(values)) + 1, len(values)]), strict=True):
        r, m = rows[begin:end], most[begin:end]
        i, j = np.flatnonzero(at[r] >= 0), np.flatnonzero(of[r] >= 0)
        if len(i) and len(j):
            near[np.ix_(at[r[i]], of[r[j]])] |= (m[i][:, None] >= size[r[j]][None, :]) & (m[j][None, :] >= size[r[i]][:, None])
    return near


def _block(pdf: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links between the two blocks (or inside one block): those that connect labels anew."""
    pdf = pdf.sort_values("node", ignore_index=True)
    sets = [np.asarray(x, np.int64) for x in pdf["sh"]]
    sizes = pdf["n"].to_numpy()
    inside = bool(pdf["inside"].iat[0])
    side, node = pdf["side"].to_numpy(), pdf["node"].to_numpy()
    x_rows = np.flatnonzero(side == 0)
    y_rows = x_rows if inside else np.flatnonzero(side == 1)
    near = _may_link(pdf, x_rows, y_rows, sizes)
    label = np.unique(pdf["label"].to_numpy(), return_inverse=True)[1].astype(np.int64)
    a, b = [], []
    for k in np.flatnonzero(near.any(axis=1)):
        x = x_rows[k]
        ys = y_rows[near[k]]
        ys = ys[(label[ys] != label[x]) & (100 * np.minimum(sizes[ys], sizes[x]) >= percent * np.maximum(sizes[ys], sizes[x])) & ((ys > x) | (not inside))]
        for at in range(0, len(ys), 256):
            part = ys[at : at + 256]
            part = part[label[part] != label[x]]
            if not len(part):
                continue
            flat = np.concatenate([sets[y] for y in part])
            found = sets[x][np.minimum(np.searchsorted(sets[x], flat), sizes[x] - 1)] == flat
            shared = np.add.reduceat(found, np.cumsum(np.r_[0, sizes[part][:-1]]), dtype=np.int64)
            for y in part[100 * shared >= percent * (sizes[x] + sizes[part] - shared)]:
                if label[y] != label[x]:
                    a.append(node[x])
                    b.append(node[y])
                    label[label == label[y]] = label[x]
    return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})


def likely(pairs: DataFrame, sketches: DataFrame, k: int, percent: int) -> DataFrame:
    """Those of ``pairs (a, b)`` that the estimate from the union's sketch does not rule out."""
    left = sketches.select(F.col("node").alias("a"), F.col("sketch").alias("sa"))
    right = sketches.select(F.col("node").alias("b"), F.col("sketch").alias("sb"))
    both = F.slice(F.sort_array(F.array_union("sa", "sb")), 1, k)
    seen = F.size(F.array_intersect(F.array_intersect("sa", "sb"), both))
    p = percent / 100
    slack = F.when(F.size(both) < k, 1e-9).otherwise(6 * (p * (1 - p) / k) ** 0.5)
    return pairs.join(left, "a").join(right, "b").where(seen / F.size(both) >= p - slack).select("a", "b")


def ends_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()


def confirmed(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs (a, b)`` that reach the threshold on the full sets."""
    joined = pairs.join(full.select(F.col("node").alias("a"), F.col("sh").alias("x")), "a").join(full.select(F.col("node").alias("b"), F.col("sh").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    return joined.where(_alike(shared, F.size("x"), F.size("y"), percent)).select("a", "b")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80, k: int = K) -> DataFrame:
    """``(id, n_shingles, component_id)`` per row of ``df``."""
    small_batches(df.sparkSession)
    scratch = Scratch(df.sparkSession, "neardup")
    known = scratch.write(classes_of(df, id_col, text_col, n, k), "known")
    one = known.where((F.col("n") > 0) & F.col("id").isNotNull()).groupBy("cls").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    nodes = scratch.write(one.select(F.monotonically_increasing_id().alias("node"), "cls", "id", "n", "sketch"), "nodes")
    rows = scratch.write(known.select("id", "cls", "n"), "rows")
    scratch.drop("known")
    texts = df.select(F.col(id_col).cast("long").alias("id"), text_or_empty(F.col(text_col)).alias("text"))

    def sets(used: DataFrame, name: str) -> DataFrame:
        """The full sets of some nodes; a text's class tells which of the rows with a node's id is meant."""
        asked = scratch.write(sieved(nodes.select("node", "cls", "id"), "node", used).join(used, "node", "left_semi"), f"{name}-asked")
        found = _with_sets(sieved(texts, "id", asked.select("id")), n, None)
        return scratch.write(asked.join(found.select("id", "cls", F.col("sketch").alias("sh")), ["id", "cls"]).dropDuplicates(["node"]).select("node", "sh"), name)

    lists = scratch.write(listed(nodes.select("node", "n", "sketch"), k, percent), "lists")
    sketches = scratch.write(sieved(nodes.select("node", "sketch"), "node", lists.select("node")), "sketches")
    first = scratch.write(likely(star_pairs(lists, percent, scratch), sketches, k, percent), "star")
    links = scratch.write(confirmed(first, sets(ends_of(first), "star-sets"), percent), "star-links")
    scratch.drop("star-sets")
    labels = components(links.toDF("src", "dst"))
    rest = lists.join(labels.withColumnRenamed("component", "label"), "node", "left").withColumn("label", F.coalesce("label", "node"))
    rest = mixed_lists(rest.select("v", "node", "n", "label"), "mixed", scratch)
    scratch.drop("lists")
    short = _meet(rest.where(F.col("c") <= SHORT), _sizes_fit(F.col("n_a"), F.col("n_b"), percent))
    short = scratch.write(likely(short, sketches, k, percent), "short")
    deep = scratch.write(rest.where(F.col("c") > SHORT).select("node", "label").distinct(), "deep")
    full = sets(ends_of(short).union(deep.select("node")).distinct(), "full-sets")
    found = full_lists(full.join(deep, "node"), percent, scratch)
    fits = (F.col("n_a") <= F.col("most_b")) & (F.col("n_b") <= F.col("most_a"))
    pairs = scratch.write(likely(_meet(found.where(F.col("c") <= SHORT), fits), sketches, k, percent).union(short).distinct(), "pairs")
    links = links.union(confirmed(pairs, full, percent))
    long = found.where(F.col("c") > SHORT)
    if not long.isEmpty():
        links = links.union(long_links(long, full, percent, scratch))
    links = scratch.write(links, "links")
    labels = components(links.toDF("src", "dst")).withColumnRenamed("component", "label")
    grouped = nodes.select("node", "cls", "id").join(labels, "node", "left").select("cls", "id", F.coalesce("label", "node").alias("label"))
    smallest = grouped.groupBy("label").agg(F.min("id").alias("component"))
    of_class = scratch.write(grouped.join(smallest, "label").select("cls", "component"), "of-class")
    out = rows.join(of_class, "cls", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce(F.when(F.col("n") > 0, F.col("component")), F.col("id")))
    out = materialize(out.select("id", F.col("n").alias("n_shingles"), component.alias("component_id")), "neardup")
    scratch.close()
    return out


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), n=4)
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", kept.alias("kept"))
