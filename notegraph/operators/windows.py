"""First-per-key, ranking, numbering, budgets and running shares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from notegraph.operators.matching import first_quotes  # noqa: F401
from notegraph.session import Scratch, materialize


def rank_sources(sources: DataFrame, key: str = "slug") -> DataFrame:
    """Numbers a topic's sources B1, B2...: newest first, then most aliases and quotes, then path."""
    w = W.partitionBy(key).orderBy(F.col("mtime").desc(), F.col("hits").desc(), "rel_path")
    return sources.withColumn("n", F.row_number().over(w)).withColumn("ref", F.concat(F.lit("B"), F.col("n").cast("string")))


def unique_names(files: DataFrame, existing: DataFrame, first: int = 2, folder: str = "target", name: str = "stem", order: str = "rel_path") -> DataFrame:
    """Adds ``new_name``, free in its folder: the name itself, else with ``_2``, ``_3``... (``_1`` on with ``first=1``).

    As if the files were named one by one by ``order`` (unique in a folder), each taking the first name that neither
    ``existing`` nor an earlier file has. Files of one name take the free names in turn at once; where two names meet
    (``a`` numbered ``_2`` and a file called ``a_2``), the later file's group passes that name over, round by round.
    """
    scratch = Scratch(files.sparkSession, "names")
    w = W.partitionBy(folder, name).orderBy(order)
    ranked = scratch.write(files.select(folder, name, order, (F.row_number().over(w) - 1).alias("rank")), "ranked")
    base = F.regexp_extract("taken", r"(?s)^(.*)_[1-9]\d{0,8}$", 1)
    number = F.regexp_extract("taken", r"_([1-9]\d{0,8})$", 1)

    def blocks(taken: DataFrame) -> DataFrame:
        """``taken (folder, taken, since)`` with the groups that a name stands in the way of, and at which of their names."""
        own = taken.select(folder, "taken", F.col("taken").alias(name), F.lit(0).alias("k"), "since")
        numbered = taken.where(F.col("taken").rlike(r"_[1-9]\d{0,8}$")).select(folder, "taken", base.alias(name), (number.cast("int") - first + 1).alias("k"), "since").where("k >= 1")
        return own.unionByName(numbered)

    known = blocks(existing.select(folder, F.col(name).alias("taken"), F.lit(None).cast(dict(files.dtypes)[order]).alias("since")).distinct())
    known = scratch.write(known.join(ranked.select(folder, name).distinct(), [folder, name], "left_semi"), "blocks")
    while True:
        # a name is passed over if it was gone when the group came to it: those before ``since`` might still have had it
        earlier = known.where("since is not null").join(ranked, [folder, name]).groupBy(folder, name, "k", "since").agg(F.count_if(F.col(order) < F.col("since")).alias("from"))
        each = known.where("since is null").select(folder, name, "k", F.lit(0).cast("long").alias("from")).unionByName(earlier.drop("since"))
        each = each.groupBy(folder, name, "k").agg(F.min("from").alias("from")).groupBy(folder, name).agg(F.array_sort(F.collect_list(F.struct("k", "from"))).alias("_b"))
        none = F.array().cast("array<int>")
        gone = F.aggregate("_b", none, lambda acc, b: F.when(b["k"] - F.size(acc) >= b["from"], F.array_append(acc, b["k"])).otherwise(acc))
        # the rank-th name that is not gone: as many are passed over as are gone below it
        skip = lambda g: F.size(F.filter(F.transform(g, lambda x, i: x - i), lambda x: x <= F.col("rank")))
        k = F.col("rank") + F.when(F.col("_b").isNull(), 0).otherwise(skip(F.col("_gone")))
        named = ranked.join(each, [folder, name], "left").withColumn("_gone", gone).withColumn("_k", k)
        new = F.when(F.col("_k") == 0, F.col(name)).otherwise(F.concat(name, F.lit("_"), (F.col("_k") + (first - 1)).cast("string")))
        named = scratch.write(named.select(folder, name, order, new.alias("new_name")), "named")
        twice = named.groupBy(folder, F.col("new_name").alias("taken")).agg(F.min(order).alias("since"), F.count("*").alias("n")).where("n > 1").drop("n")
        losers = named.withColumnRenamed("new_name", "taken").join(twice, [folder, "taken"]).where(F.col(order) > F.col("since")).select(folder, name, "taken").distinct()
        more = scratch.write(blocks(twice).join(losers, [folder, name, "taken"], "left_semi"), "more")
        if more.isEmpty():
            break
        known = scratch.write(known.unionByName(more).distinct(), "blocks")
    named = materialize(named, "names")
    scratch.close()
    return files.join(named, [folder, name, order])


def claim_first(renames: DataFrame, target: str = "new", order: str = "old") -> DataFrame:
    """The first to claim a name gets it; the others are collisions."""
    rn = F.row_number().over(W.partitionBy(target).orderBy(order))
    return renames.withColumn("status", F.when(rn == 1, "renamed").otherwise("collision"))


def first_owner(topics: DataFrame) -> DataFrame:
    """``topics (rel_path, slug, alias)``: the first path owns a slug and an alias. Result: rel_path, reason or null."""
    slug_first = F.min("rel_path").over(W.partitionBy("slug"))
    alias_first = F.min("rel_path").over(W.partitionBy(F.lower("alias")))
    t = topics.withColumn("s", slug_first).withColumn("a", alias_first)
    out = t.groupBy("rel_path").agg(F.max(F.col("rel_path") > F.col("s")).alias("slug_taken"), F.max(F.col("rel_path") > F.col("a")).alias("alias_taken"))
    return out.select("rel_path", F.when(F.col("slug_taken"), "duplicate slug").when(F.col("alias_taken"), "duplicate alias").alias("reason"))


def top_n_per_group(df: DataFrame, n: int, group: str, *order) -> DataFrame:
    return df.withColumn("rn", F.row_number().over(W.partitionBy(group).orderBy(*order))).where(F.col("rn") <= n)


def budget_sources(sources: DataFrame, context: int, key: str = "slug", chars: str = "chars") -> DataFrame:
    """Characters that each source may take: all if they fit half the context, else equal shares of a quarter, an
    eighth or a sixteenth of it, the first that fits; ``degraded`` tells whether a share was cut."""
    w = W.partitionBy(key)
    total, n = F.sum(chars).over(w), F.count("*").over(w)
    out = sources.withColumn("_total", total).withColumn("_n", n)
    fits = F.lit(None).cast("long")
    for part in (16, 8, 4):
        share = F.floor(F.lit(context) / part / F.col("_n"))
        used = F.sum(F.least(F.col(chars), share)).over(w)
        fits = F.when(used <= context // 2, share).otherwise(fits)
    share = F.coalesce(fits, F.floor(F.lit(context) / 16 / F.col("_n")))
    allowed = F.when(F.col("_total") <= context // 2, F.col(chars)).otherwise(F.least(F.col(chars), share))
    return out.withColumn("allowed", allowed).withColumn("degraded", F.col("_total") > context // 2).drop("_total", "_n")


def progress(rows: DataFrame, order: str = "run_id", n: str = "n") -> DataFrame:
    """Running count and share over run totals (one row per run)."""
    w = W.orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return rows.withColumn("so_far", F.sum(n).over(w)).withColumn("share", F.col("so_far") / F.sum(n).over(W.partitionBy(F.lit(1))))
