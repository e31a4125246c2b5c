"""Aggregations: duplicates, source sets, summaries, health, audits."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def dedup_by_body(notes: DataFrame, body: str = "body") -> DataFrame:
    """Per body digest the preferred path: not numbered, then shortest, then smallest. ``(body_sha, rel_path, copies)``."""
    pick = F.struct(F.col("rel_path").rlike(r"\.\d+\.md$").alias("numbered"), F.length("rel_path").alias("n"), "rel_path")
    out = notes.groupBy(F.sha2(body, 256).alias("body_sha")).agg(F.min(pick).alias("p"), F.count("*").alias("copies"))
    return out.select("body_sha", F.col("p.rel_path").alias("rel_path"), "copies")


def source_set_hash(sources: DataFrame, keys: list[str], path: str = "rel_path", sha: str = "body_sha") -> DataFrame:
    """``(keys, n_sources, set_hash)``: the digest over a key's sorted (path, body digest) lines, as pages store it.

    The digest is one over all lines in order, so a key's rows stream through one task, sorted by Spark; the task holds
    no more than the digest. `source_tree_hash` has no such order, for keys with very many rows.
    """
    rows = sources.select(*keys, F.col(path).alias("__path"), F.col(sha).alias("__sha"))
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, "__path", "__sha")
    schema = ", ".join(f"`{k}` {dict(rows.dtypes)[k]}" for k in keys)

    def run(batches):
        key, n, h = None, 0, hashlib.sha256()
        for pdf in batches:
            done = []
            for row in zip(*[pdf[k] for k in keys], pdf["__path"], pdf["__sha"], strict=True):
                if n and row[:-2] != key:
                    done.append((*key, n, f"sha256:{h.hexdigest()}"))
                    n, h = 0, hashlib.sha256()
                key, n = row[:-2], n + 1
                h.update(f"{row[-2]}\0{row[-1]}\n".encode("utf-8", "surrogatepass"))
            if done:
                yield pd.DataFrame(done, columns=[*keys, "n_sources", "set_hash"])
        if n:
            yield pd.DataFrame([(*key, n, f"sha256:{h.hexdigest()}")], columns=[*keys, "n_sources", "set_hash"])

    return rows.mapInPandas(run, f"{schema}, n_sources long, set_hash string")


def source_tree_hash(sources: DataFrame, keys: list[str], path: str = "rel_path", sha: str = "body_sha") -> DataFrame:
    """Like `source_set_hash` with another digest, for which no task sees all rows of a key.

    Rows are digested and gathered per leading hex digit pair, then the 256 digests of a key are digested in order.
    """
    line = F.sha2(F.concat(F.col(path), F.lit("\0"), F.col(sha)), 256)
    part = sources.withColumn("_l", line).groupBy(*keys, F.left("_l", F.lit(2)).alias("_p")).agg(F.count("*").alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list("_l")), "\n"), 256).alias("_d"))
    return part.groupBy(*keys).agg(F.sum("n").alias("n_sources"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_p", "_d"))), lambda x: x["_d"]), "\n"), 256).alias("set_hash"))


def source_quality(sources: DataFrame, key: str = "slug") -> DataFrame:
    """Mean of (has quotes) and of (aliases, two at most, halved), averaged. ``(key, n, quality)``."""
    quotes = F.avg(F.when(F.size("quotes") > 0, 1.0).otherwise(0.0))
    aliases = F.avg(F.least(F.size("aliases"), F.lit(2)) / 2.0)
    return sources.groupBy(key).agg(F.count("*").alias("n"), ((quotes + aliases) / 2).alias("quality"))


def classification_summary(results: DataFrame) -> DataFrame:
    """Counts per outcome and shares: ``results (decision, by_rules)``."""
    n = F.count("*")
    auto = F.count_if(F.col("decision") == "auto")
    return results.agg(
        n.alias("processed"),
        auto.alias("auto"),
        F.count_if(F.col("decision") == "review").alias("review"),
        F.count_if(F.col("decision") == "purged").alias("purged"),
        F.count_if(F.col("decision") == "skipped").alias("skipped"),
        F.bround(100.0 * F.count_if("by_rules") / F.greatest(n, F.lit(1)), 2).alias("rules_pct"),
        F.bround(100.0 * auto / F.greatest(n, F.lit(1)), 2).alias("auto_pct"),
    )


def vault_metrics(notes: DataFrame, classified: Column, orphan: Column) -> DataFrame:
    done = F.count_if(classified)
    return notes.groupBy("vault").agg(F.count("*").alias("total"), done.alias("classified"), F.count_if(~classified).alias("unclassified"), (done / F.count("*")).alias("ratio"), F.count_if(orphan).alias("orphans"))


def corpus_totals(metrics: DataFrame) -> DataFrame:
    """The rows of `vault_metrics` and one of their sum, named ``*``."""
    total = metrics.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("total"), F.coalesce(F.sum("classified"), F.lit(0)).alias("classified"), F.coalesce(F.sum("unclassified"), F.lit(0)).alias("unclassified"), F.coalesce(F.sum("orphans"), F.lit(0)).alias("orphans"))
    ratio = F.when(F.col("total") == 0, 1.0).otherwise(F.col("classified") / F.col("total"))
    return metrics.unionByName(total.withColumn("vault", F.lit("*")).withColumn("ratio", ratio))


# fixed values: the most that a complete run, coverage, no orphans, no review queue, no exhaust and fresh topics count
HEALTH = (20.0, 35.0, 15.0, 10.0, 10.0, 10.0)


def health_score(coverage: Column, orphans: Column, queue: Column, exhaust: Column, stale: Column, complete: Column) -> Column:
    """0 to 100: coverage counts by its share, each other part in full or not at all. Without topics none is stale."""
    run, covered, *rest = HEALTH
    total = F.when(complete, run).otherwise(0.0) + covered * F.greatest(F.lit(0.0), F.least(F.lit(1.0), coverage))
    for most, n in zip(rest, (orphans, queue, exhaust, stale), strict=True):
        total = total + F.when(n == 0, most).otherwise(0.0)
    return F.greatest(F.lit(0), F.least(F.lit(100), F.bround(total, 0).cast("int")))


def latest_run(rows: DataFrame, run: str = "run_id") -> DataFrame:
    """The rows of the greatest run id; the id is found first, so rows are not sorted."""
    return rows.join(F.broadcast(rows.agg(F.max(run).alias(run))), run, "left_semi")


def audit_deletions(deletions: DataFrame) -> DataFrame:
    """Per run: rows and characters, with the share of all."""
    per = deletions.groupBy("run_id").agg(F.count("*").alias("n"), F.sum("chars").alias("chars"))
    return per.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy(F.lit(1))))


def tier_report(rows: DataFrame, tier: str = "tier", order: str = "copy", n: int = 20) -> DataFrame:
    """Count and the first n rows of each tier."""
    w = W.partitionBy(tier).orderBy(order)
    first = rows.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)
    counts = rows.groupBy(tier).agg(F.count("*").alias("n"))
    return first.groupBy(tier).agg(F.array_sort(F.collect_list(order)).alias("first")).join(counts, tier)


def review_queue_count(lines: DataFrame, col: str = "value") -> DataFrame:
    """Table rows if there is a table, else lines that are neither empty nor headings."""
    t = F.trim(F.col(col))
    row = t.startswith("|") & ~t.rlike(r"^\|[\s|:-]+\|?$")
    heads = F.count_if(t.rlike(r"^\|[\s|:-]+\|?$"))
    return lines.agg(F.when(F.count_if(row) > 0, F.greatest(F.count_if(row) - heads, F.lit(0))).otherwise(F.count_if((t != "") & ~t.startswith("#"))).alias("n"))


def deletions_of(notes: DataFrame, stripped: Column, run_id: str) -> DataFrame:
    """Manifest rows: path, stripped length, 50-character preview on one line, run."""
    preview = F.left(F.regexp_replace(stripped, r"[ \t\n\r\x0B\f]+", " "), F.lit(50))
    return notes.select(F.col("rel_path").alias("path"), F.length(stripped).alias("stripped_body_chars"), preview.alias("body_preview"), F.lit(run_id).alias("run_id"))


def run_state_rows(steps: DataFrame) -> DataFrame:
    """``steps (name, status, detail, attempts)`` as report rows, in order, with the number of failures so far."""
    w = W.orderBy("pos").rowsBetween(W.unboundedPreceding, 0)  # a handful of steps
    return steps.withColumn("failed_so_far", F.sum(F.when(F.col("status") == "failed", 1).otherwise(0)).over(w))
