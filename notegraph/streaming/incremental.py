"""Incremental classification: only new or re-opened notes each run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def todo(notes: DataFrame, done: DataFrame, key: str = "rel_path", cap: int | None = None) -> DataFrame:
    """Notes that no settled result covers, in path order up to ``cap`` (None: all of the backlog)."""
    left = notes.join(done.where(~F.col("classified_by").eqNullSafe("export")).select(key).distinct(), key, "left_anti")
    return left if cap is None else left.orderBy(key).limit(cap)


def skip_unchanged(topics: DataFrame, sets: DataFrame, force: bool = False) -> DataFrame:
    """``topics (slug, source_set_hash)`` whose set moved, or that were never built, or all if forced; empty sets go."""
    both = topics.join(sets.select("slug", "set_hash", "n_sources"), "slug")
    moved = ~F.col("set_hash").eqNullSafe(F.col("source_set_hash")) | F.lit(force)
    return both.where(moved & (F.col("n_sources") > 0)).select("slug", "set_hash", "n_sources")


def classify_stream(spark: SparkSession, path: str, schema: str, classify: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, files_per_batch: int = 50):
    """A stream over new Parquet files: each is classified once and appended to ``out``. Returns the started query."""
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return classify(src).writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(out)


def windowed_counts(events: DataFrame, late: str = "1 day", width: str = "1 day", by: str = "event_type") -> DataFrame:
    """Counts per window and kind on event time; rows later than ``late`` are left out once their window is closed."""
    w = F.window("ts", width)
    return events.withWatermark("ts", late).groupBy(w, by).agg(F.count("*").alias("n"), F.sum("value").alias("value")).select(F.col("window.start").alias("start"), by, "n", "value")


def progress(df: DataFrame, name: str, done: Column) -> DataFrame:
    """Attaches counters that each run or micro-batch reports under ``name``."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"), F.count_if(done).alias("done"))
