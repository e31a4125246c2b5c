"""Sinks: keyed upserts, field merges, append-only logs and published reports.

A sink that replaces a table writes a new version folder and hands it out; readers of the old one are not disturbed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from notegraph.functions.text import replace_region


def merge_fields(old: DataFrame, new: DataFrame, key: str = "rel_path", fields: str = "fields") -> DataFrame:
    """Maps of header fields: new values win, other fields stay, keys without an old row are dropped."""
    n = new.select(key, F.col(fields).alias("_new"))
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    merged = F.map_concat(F.map_filter(fields, lambda k, _: ~F.array_contains(F.map_keys(F.coalesce("_new", empty)), k)), F.coalesce("_new", empty))
    return old.join(n, key, "left").withColumn(fields, merged).drop("_new")


def set_or_drop_field(notes: DataFrame, updates: DataFrame, field: str, key: str = "rel_path") -> DataFrame:
    """``updates (key, values)``: sets the list field of a note's map to the values, or drops it when there are none."""
    u = updates.select(key, F.col("values").alias("_v"))
    keep = F.map_filter("fields", lambda k, _: k != field)
    put = F.map_concat(keep, F.create_map(F.lit(field), F.to_json("_v")))
    new = F.when(F.col("_v").isNull(), F.col("fields")).when(F.size("_v") == 0, keep).otherwise(put)
    return notes.join(u, key, "left").withColumn("fields", new).drop("_v")


def upsert_lines(index: DataFrame, updates: DataFrame, key: str = "slug", section: str | None = None, order: str | None = None) -> DataFrame:
    """Replaces or adds one line per key. With ``section`` (a column of both) a key moves to the section of its update.

    Of several updates of a key the one that is last by the column ``order`` wins (without it, the greatest).
    """
    kept = [c for c in updates.columns if c != order]
    last = F.max(F.struct(*([F.col(order).alias("_o")] if order else []), *kept)).alias("_u")
    updates = updates.groupBy(key).agg(last).select(*[F.col("_u")[c].alias(c) for c in kept])
    return index.join(updates.select(key).distinct(), key, "left_anti").unionByName(updates, allowMissingColumns=section is not None)


def insert_plan(proposals: DataFrame, existing: DataFrame, key: str = "slug", dry_run: bool = False, order: str | None = None) -> DataFrame:
    """Outcome per proposal: ``unsafe`` names, ``skipped`` for known ones, else ``created`` (``would_create`` in a dry run).

    Of several proposals of a name the first by the column ``order`` is created (without it, the least row).
    """
    known = existing.select(key).distinct().withColumn("_known", F.lit(True))
    w = W.partitionBy(key).orderBy(*([order] if order else proposals.columns))
    safe = F.coalesce(F.col(key).rlike("^[a-z0-9-]+$"), F.lit(False))
    out = F.when(~safe, "unsafe").when(F.col("_known") | (F.col("_rn") > 1), "skipped").otherwise("would_create" if dry_run else "created")
    return proposals.withColumn("_rn", F.row_number().over(w)).join(known, key, "left").withColumn("outcome", out).drop("_known", "_rn")


def insert_if_absent(proposals: DataFrame, topics: DataFrame, path: str, validate, key: str = "slug", order: str | None = None) -> DataFrame:
    """Writes the new topics as a version below ``path`` if ``validate(all topics)`` finds no bad row; else rolls back."""
    plan = insert_plan(proposals, topics, key, order=order)
    fresh = plan.where("outcome = 'created'").drop("outcome")
    staged = write_version(topics.unionByName(fresh, allowMissingColumns=True), path)
    if validate(staged).isEmpty():
        return plan
    return plan.withColumn("outcome", F.when(F.col("outcome") == "created", "rolled_back").otherwise(F.col("outcome")))


def write_version(df: DataFrame, path: str) -> DataFrame:
    """Writes a new version folder below ``path`` and reads it back."""
    target = f"{path.rstrip('/')}/v-{uuid.uuid4().hex}"
    df.write.parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)


def append_deletions(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def append_log(lines: DataFrame, path: str, col: str = "line") -> None:
    lines.select(col).write.mode("append").text(path)


def write_topic_sets(sources: DataFrame, path: str) -> None:
    """One JSON document per topic with its hash and its sources in path order. A topic's sources are one document by
    definition of the format; use `source_set_hash` on the flat table where a topic may be very large."""
    src = F.array_sort(F.collect_list(F.struct("rel_path", "title", "mtime", "aliases", "quotes")))
    sources.groupBy("slug", "set_hash").agg(src.alias("sources")).write.mode("overwrite").json(path)


def write_report(df: DataFrame, path: str) -> None:
    """Rows as JSON text."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(path)


def publish_region(pages: DataFrame, bodies: DataFrame, region: str) -> DataFrame:
    """``pages (path, text)`` with ``bodies (path, body)`` in their generated region; absent pages are created. A page
    whose region is malformed keeps its text and has ``ok`` false."""
    both = pages.join(bodies, "path", "full")
    new = replace_region(F.coalesce("text", F.lit("")), F.col("body"), region)
    text = F.when(F.col("body").isNull(), F.col("text")).otherwise(F.coalesce(new, F.col("text")))
    return both.select("path", text.alias("text"), (F.col("body").isNull() | new.isNotNull()).alias("ok"))


def write_ledger(state: DataFrame, path: str, version: int = 1) -> DataFrame:
    return write_version(state.withColumn("schema_version", F.lit(version)), path)
