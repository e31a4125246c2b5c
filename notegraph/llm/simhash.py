"""SimHash near-duplicates by a binary trie joined with itself.

1. A text's fingerprint has 64 bits: bit b is 1 if it is set in more than half of the hashes (XXH64, seed 42) of its word
   shingles, repeats included. Equal fingerprints are one code from then on, so copies never meet row by row.
2. The codes are a binary trie. Pairs of its nodes are traversed together from the root, level by level, as a table:
   each round goes down some bits, adds the bits in which the two nodes differ, and prunes pairs whose errors exceed
   the budget, pairs of which a node has no codes, and pairs whose codes are all of one component already.
3. Two codes within e bits of each other have, if their bits are cut into s equal segments, a rotation of the segments
   in which the first j hold no more than j e / s of the differing bits, for each j. So there are s tries, one of each
   rotation, and the budget grows with depth: of a node's neighbours few pass it near the root, and no link is lost.
4. A pair of nodes that have few codes each is settled by comparing its codes in a task, after the last round. Larger ones
   go on, so no task gets more than a small node's codes, however many codes begin alike.
5. If a node of the first round is larger than is settled at once, the join runs for one bit first, then for all. What is
   linked by then is one component, and its nodes are pruned by their labels: a large group of near copies does not meet
   itself pair by pair again.

Links are drawn together in tasks, as far as a task sees them, so that few rounds are left to
`notegraph.operators.clusters.components`; each round is written to the shared folder, and the tables
are deleted in the end.

Ids are integers. Defined cases: null texts and texts without words have the fingerprint zero and are linked like any
other; with fewer words than a shingle has, the whole sequence is the one shingle; very long texts count whole; rows with
a null id have a fingerprint and a null component, and link nothing; repeated rows share a component; ties do not matter;
an empty table gives no rows; extra columns, whatever their names, are never read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notegraph.llm.common import Scratch, materialize, small_batches, table, text_or_empty
from notegraph.operators.clusters import components

#: Codes of a node that is settled in a task; of one at the depth of the first round, if codes are spread evenly; bits that
#: a later round goes down.
SMALL, SPREAD, STEP = 2048, 256, 4
#: Pairs of codes that are compared at once; links that are drawn together at once.
CELLS, LINKS = 1 << 20, 1 << 19


def fingerprint(text: str, n: int) -> int:
    """The 64-bit SimHash of the n-word shingles; 0 without words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    span = min(n, len(words))
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.r_[0, ends[:-1] + 1]
    cuts = zip(begins[: len(words) - span + 1].tolist(), ends[span - 1 :].tolist(), strict=True)
    hashes = np.fromiter((xxhash.xxh64_intdigest(line[a:b], 42) for a, b in cuts), np.uint64, len(words) - span + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5) -> DataFrame:
    """``(id, code)`` per row of ``df``; the code is a signed 64-bit number."""

    def run(batches):
        for batch in batches:
            codes = [fingerprint(text, n) for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(codes, pa.int64())], ["id", "code"])

    rows = df.select(F.col(id_col).cast("long").alias("id"), text_or_empty(F.col(text_col)).alias("text"))
    return rows.mapInArrow(run, "id long, code long")


def _segments(bits: int) -> int:
    """Into how many segments codes are cut: a power of two, at most 16."""
    s = 2
    while s < bits and s < 16:
        s *= 2
    return s


def _allowed(depth: int, bits: int, segments: int) -> int:
    """Errors that a pair of nodes may have at a depth."""
    return -(-depth * segments // 64) * bits // segments


def _masks(step: int, most: int) -> Column:
    """Element k + 1: the differences of ``step`` bits with at most k ones."""
    return F.array(*[F.array(*[F.lit(m).cast("long") for m in range(1 << step) if m.bit_count() <= k]) for k in range(most + 1)])


def code_links(codes: DataFrame, bits: int, scratch: Scratch, name: str, crowds: bool = True) -> DataFrame | None:
    """``codes (code, label)``, each code once, to links ``(src, dst)`` of the labels of codes within so many bits of each other.

    They connect what all such pairs connect, together with the labels: pairs inside a label are left out, and of many
    links between two nodes' codes a spanning forest is returned. A link may come several times. Without ``crowds``
    there is no result if a node of the first round has too many codes to be settled.
    """
    segments = _segments(bits)
    turns = F.explode(F.array(*[F.lit(64 // segments * k) for k in range(segments)])).alias("turn")
    turned = F.expr("if(turn = 0, code, shiftleft(code, turn) | shiftrightunsigned(code, 64 - turn))")
    rows = codes.select("code", "label", turns).select("turn", turned.alias("word"), "code", "label")
    zero = F.lit(0).cast("long")
    pairs = codes.sparkSession.range(1).select(turns, zero.alias("p"), zero.alias("q"), F.lit(0).alias("errors"))
    depth, met, held = 0, [], []
    # as deep as to nodes of so few codes, if these are spread evenly
    first = max(STEP, min(20, (codes.count() // SPREAD).bit_length() + 1))
    while True:
        step = min(STEP if depth else first, 64 - depth)
        depth += step
        budget = _allowed(depth, bits, segments)
        rows = rows.withColumn("node", F.shiftrightunsigned("word", 64 - depth))
        nodes = rows.groupBy("turn", "node").agg(F.count("*").alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi"))
        parent = F.shiftrightunsigned("node", step) if depth > step else zero
        nodes = scratch.write(nodes.withColumn("parent", parent), f"{name}-nodes")
        if not crowds and not nodes.where(F.col("n") > SMALL).isEmpty():
            return None
        left = nodes.select("turn", F.col("parent").alias("p"), F.col("node").alias("a"), F.col("n").alias("na"), F.col("lo").alias("lo_a"), F.col("hi").alias("hi_a"))
        right = nodes.select("turn", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("lo").alias("lo_b"), F.col("hi").alias("hi_b"))
        # a child of p, and those children of q that differ from it in so few bits that the budget holds
        mask = F.explode(F.element_at(_masks(step, budget), F.lit(budget + 1) - F.col("errors")))
        next_ = pairs.join(left, ["turn", "p"]).withColumn("mask", mask)
        low = F.col("a").bitwiseAND(F.lit((1 << step) - 1).cast("long")).bitwiseXOR(F.col("mask"))
        next_ = next_.withColumn("b", F.shiftleft("q", step).bitwiseOR(low)).withColumn("errors", (F.col("errors") + F.bit_count("mask")).cast("int"))
        next_ = next_.where((F.col("p") != F.col("q")) | (F.col("a") <= F.col("b"))).join(right, ["turn", "b"])
        one = (F.col("lo_a") == F.col("hi_a")) & (F.col("lo_b") == F.col("hi_b")) & (F.col("lo_a") == F.col("lo_b"))
        small = (F.col("na") <= SMALL) & (F.col("nb") <= SMALL)
        next_ = scratch.write(next_.where(~one).select("turn", F.lit(depth).alias("depth"), "a", "b", "errors", small.alias("small")), f"{name}-pairs-{depth}")
        met.append(next_.where("small").select("turn", "depth", "a", "b"))
        held.append(rows.select("turn", F.lit(depth).alias("depth"), "node", "code", "label"))
        pairs = next_.where(~F.col("small")).select("turn", F.col("a").alias("p"), F.col("b").alias("q"), "errors")
        if pairs.isEmpty():
            break
        # codes whose nodes are settled go no further
        open_ = pairs.select("turn", F.col("p").alias("node")).union(pairs.select("turn", F.col("q").alias("node"))).distinct()
        rows = scratch.write(rows.join(open_, ["turn", "node"], "left_semi").drop("node"), f"{name}-rows-{depth}")
    # what the rounds have left to compare, all at once
    key = ["turn", "depth", "node"]
    ready, rows = reduce(DataFrame.union, met), reduce(DataFrame.union, held)  # one table a round, 15 at most
    asked = ready.select("turn", "depth", F.col("a").alias("node")).union(ready.select("turn", "depth", F.col("b").alias("node"))).distinct()
    lists = rows.join(asked, key).groupBy(key).agg(F.collect_list(F.struct("code", "label")).alias("of"))
    lists = scratch.write(lists.select(*key, F.col("of.code").alias("codes"), F.col("of.label").alias("labels")), f"{name}-lists")
    for side, codes_, labels in (("a", "x", "of_x"), ("b", "y", "of_y")):
        ready = ready.join(lists.select("turn", "depth", F.col("node").alias(side), F.col("codes").alias(codes_), F.col("labels").alias(labels)), ["turn", "depth", side])
    return scratch.write(_compared(ready.select("x", "of_x", "y", "of_y"), bits), f"{name}-links")


def _compared(meet: DataFrame, bits: int) -> DataFrame:
    """``meet (x, of_x, y, of_y)``, two nodes' codes and labels, to links ``(src, dst)`` that connect the labels."""

    def run(batches):
        for batch in batches:
            for lists in zip(*(batch[k] for k in ("x", "of_x", "y", "of_y")), strict=True):
                a, of_a, b, of_b = (v.values.to_numpy() for v in lists)
                most = max(1, CELLS // len(b))
                for at in range(0, len(a), most):
                    near = np.bitwise_count((a[at : at + most, None] ^ b[None, :]).view(np.uint64)) <= bits
                    s, d = _linked(near, of_a[at : at + most], of_b)
                    if len(s):
                        yield _links(s, d)

    return meet.mapInArrow(run, "src long, dst long")


def _links(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64())], ["src", "dst"])


def _linked(near: np.ndarray, of_a: np.ndarray, of_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The labels of a table's rows and columns that its true places link, or a forest if these are many."""
    i, j = np.nonzero(near)
    other = of_a[i] != of_b[j]
    i, j = i[other], j[other]
    if len(i) > 4 * sum(near.shape):
        i, j = _forest(near & (of_a[:, None] != of_b[None, :]))
    return of_a[i], of_b[j]


def _stars(links: DataFrame) -> DataFrame:
    """``links (src, dst)`` to links that connect the same, as far as a task sees them as stars around the smallest node."""

    def drawn(parts):
        nodes, ends = np.unique(np.concatenate(parts), return_inverse=True)
        a, b = ends.reshape(-1, 2).T
        root = np.arange(len(nodes))
        while len(a):
            x, y = root[a], root[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while (root[root] != root).any():
                root = root[root]
        hung = root != np.arange(len(nodes))
        return np.stack([nodes[root[hung]], nodes[hung]], axis=1)

    def run(batches):
        parts, n = [], 0
        for batch in batches:
            parts.append(np.stack([batch["src"].to_numpy(), batch["dst"].to_numpy()], axis=1))
            n += batch.num_rows
            if n > LINKS:
                parts = [drawn(parts)]
                n = len(parts[0])
                if 2 * n > LINKS:  # no memory is kept for links that hardly become fewer
                    yield _links(*parts[0].T)
                    parts, n = [], 0
        if n:
            yield _links(*drawn(parts).T)

    return links.mapInArrow(run, "src long, dst long")


def _forest(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the true places of a table (row, column) those that connect rows and columns anew."""
    rows, columns = near.shape
    label = np.arange(rows + columns)
    keep = []
    for i in np.flatnonzero(near.any(axis=1)):
        at = np.flatnonzero(near[i])
        for other, k in zip(*np.unique(label[rows + at], return_index=True), strict=True):
            if other != label[i]:
                label[label == other] = label[i]
                keep.append((i, at[k]))
    found = np.array(keep, np.int64).reshape(-1, 2)
    return found[:, 0], found[:, 1]


def _labelled(codes: DataFrame, links: DataFrame) -> DataFrame:
    """``codes (code, id, label)`` with the labels that linked ones have in common."""
    found = components(_stars(links)).withColumnRenamed("node", "label")
    return codes.join(found, "label", "left").select("code", "id", F.coalesce("component", "label").alias("label"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, bits: int = 4) -> DataFrame:
    """``(id, code, component_id)`` per row of ``df``: components of texts whose fingerprints differ in ``bits`` at most."""
    small_batches(df.sparkSession)
    scratch = Scratch(df.sparkSession, "simhash")
    rows = scratch.write(fingerprints(df, id_col, text_col, n), "rows")
    codes = rows.where("id is not null").groupBy("code").agg(F.min("id").alias("id"))
    labelled = scratch.write(codes.withColumn("label", F.col("code")), "labelled")
    links = code_links(labelled, bits, scratch, "links", crowds=bits <= 1)
    if links is None:
        labelled = scratch.write(_labelled(labelled, code_links(labelled, 1, scratch, "near-links")), "labelled")
        links = code_links(labelled, bits, scratch, "links")
    labelled = scratch.write(_labelled(labelled, links), "labelled")
    smallest = labelled.groupBy("label").agg(F.min("id").alias("component_id"))
    of_code = scratch.write(labelled.join(smallest, "label").select("code", "component_id"), "of-code")
    out = rows.join(of_code, "code", "left").select("id", "code", F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))
    out = materialize(out, "simhash")
    scratch.close()
    return out


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), n=4)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id")
