"""Whole jobs: what `pipelines` and `generate` find is written, counted and logged here."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notegraph.functions import text as X
from notegraph.operators import aggregates as A
from notegraph.operators import sets as S
from notegraph.operators import topics as T
from notegraph.operators import windows as N
from notegraph.plans import generate as G
from notegraph.plans import pipelines as L
from notegraph.session import materialize
from notegraph.sources.sinks import append_log, upsert_lines
from notegraph.streaming.incremental import skip_unchanged


def repair_links(notes: DataFrame, guids: DataFrame, url_guid: Callable[[Column], Column]) -> dict[str, DataFrame]:
    """Links by GUID to links by title (see `pipelines.repair_links`): ``notes (rel_path, body, resolved, unresolved)`` and
    ``stats``, one row: scanned, changed, converted, unresolved. Only links that hold a GUID count."""
    done = L.repair_links(notes, guids, url_guid)
    asked = notes.select("rel_path", F.col("body").alias("_old"), F.size(F.filter(X.markdown_links(F.col("body")), lambda x: url_guid(x["url"]).isNotNull())).alias("_asked"))
    out = done.join(asked, "rel_path").select("rel_path", "body", F.col("resolved").cast("long").alias("resolved"), (F.col("_asked") - F.col("resolved")).cast("long").alias("unresolved"), (F.col("body") != F.col("_old")).alias("changed"))
    out = materialize(out, "repaired")
    return {"notes": out.drop("changed"), "stats": T.rewrite_stats(out.select("changed", "resolved", "unresolved"))}


def audit_hubs(notes: DataFrame, hubs: DataFrame, apply: bool = False) -> dict[str, DataFrame]:
    """Per vault the canonical hubs without a page, with stubs for those that notes ask for, and bad headers of others.

    ``notes (vault, rel_path, stem, up)``, ``hubs (vault, hub)``. ``missing (vault, hub, references, status, stub)``:
    status is ``skipped`` without references, else ``created`` with ``apply`` and ``would_create`` without; ``stubs``
    are the pages ``(vault, rel_path, text)`` to write then. ``problems (vault, stem, up, problem)`` as in `lint_hubs`.
    """
    names = hubs.groupBy("vault").agg(F.collect_set("hub").alias("_h")).select("vault", F.explode("_h").alias("hub"))
    pages = notes.join(names.withColumnRenamed("hub", "stem"), ["vault", "stem"], "left_semi")
    refs = notes.where("up is not null").groupBy("vault", F.col("up").alias("hub")).agg(F.count("*").alias("references"))
    gone = names.join(pages.select("vault", F.col("stem").alias("hub")).distinct(), ["vault", "hub"], "left_anti").join(refs, ["vault", "hub"], "left")
    n = F.coalesce("references", F.lit(0).cast("long"))
    status = F.when(n == 0, "skipped").otherwise("created" if apply else "would_create")
    missing = materialize(gone.select("vault", "hub", n.alias("references"), status.alias("status"), F.when(n > 0, T.hub_stub(F.col("hub"), F.col("vault"))).alias("stub")), "missing-hubs")
    stubs = missing.where("stub is not null").select("vault", F.concat("hub", F.lit(".md")).alias("rel_path"), F.col("stub").alias("text"))
    have = notes.select("vault", F.col("stem").alias("up")).distinct().withColumn("_found", F.lit(True))
    odd = pages.where("up is not null").join(have, ["vault", "up"], "left")
    problem = F.when(F.col("up") == F.col("stem"), "self").when(F.col("_found").isNull(), "missing")
    problems = odd.select("vault", "stem", "up", problem.alias("problem")).where("problem is not null")
    return {"targets": S.distinct_targets(names, "hub"), "missing": missing, "stubs": stubs if apply else stubs.where("false"), "problems": problems}


def migrate(notes: DataFrame, existing: DataFrame, context: Column, classified: Column, at: Column, log: str | None = None) -> dict[str, DataFrame]:
    """``moves (rel_path, target, new_name, how)`` of classified notes to the vault of their context, ``log (line)``, one
    line a move under a heading with the time ``at``, and ``counts (target, n)``, skipped notes included.

    With a path the lines are appended to the log there, none if nothing moves.
    """
    routed = materialize(notes.withColumn("target", L.P.route_by_context(context, classified)), "routed")
    moves = N.unique_names(routed.where("target <> 'skipped'"), existing)
    moves = materialize(moves.select("rel_path", "target", "new_name", F.concat(F.lit("to "), "target").alias("how")), "moves")
    line = F.concat(F.lit("- `"), "rel_path", F.lit("` → `"), "target", F.lit("/"), "new_name", F.lit("` ("), "how", F.lit(")"))
    head = moves.limit(1).select(F.lit(0).alias("k"), F.lit("").alias("rel_path"), F.concat(F.lit("## "), at.cast("string"), F.lit(" — migration")).alias("line"))
    lines = head.unionByName(moves.select(F.lit(1).alias("k"), "rel_path", line.alias("line")))
    if log is not None:
        append_log(lines.orderBy("k", "rel_path"), log)
    return {"moves": moves, "log": lines.select("line"), "counts": routed.groupBy("target").agg(F.count("*").alias("n"))}


def source_fields(sources: DataFrame, sets: DataFrame, degraded: DataFrame, day: Column) -> DataFrame:
    """The header fields of topic pages, a row per topic: ``(slug, fields)``.

    ``sources (slug, rel_path, title, mtime, aliases, quotes)``, ``sets (slug, set_hash)``, ``degraded (slug, degraded)``.
    Sources are links in the order of their numbers; confidence counts sources and their quality.
    """
    ranked = N.rank_sources(sources.withColumn("hits", F.size("aliases") + F.size("quotes")))
    links = F.transform(F.array_sort(F.collect_list(F.struct("n", F.concat(F.lit("[["), "title", F.lit("]]")).alias("link")))), lambda x: x["link"])
    own = ranked.groupBy("slug").agg(links.alias("sources"), F.count("*").alias("n_sources"))
    quality = A.source_quality(sources).select("slug", "quality")
    out = own.join(quality, "slug").join(sets.select("slug", "set_hash"), "slug").join(degraded.select("slug", "degraded"), "slug")
    confidence = F.round(X.topic_confidence(F.col("n_sources"), F.col("quality")), 6)
    fields = F.struct(F.col("slug"), F.lit("active").alias("status"), "sources", F.col("set_hash").alias("source_set_hash"), confidence.alias("confidence"), F.col("degraded").alias("prompt_degraded"), day.cast("string").alias("updated"))
    return out.select("slug", fields.alias("fields"))


#: The section of the index that topics stand in.
SECTION = "## Topics"


def publish_topics(
    sources: DataFrame, bodies: DataFrame, sets: DataFrame, known: DataFrame, index: DataFrame, writer: Callable, day: Column, context: int = 80_000, force: bool = False, log: str | None = None
) -> dict[str, DataFrame]:
    """Topic pages and all that is written with them: ``pages (slug, page, fields)``, ``index (slug, line, section)``,
    ``log (line)`` and ``results (slug, status, n_sources, degraded)``.

    ``sources`` are those of `collect_topics`, ``bodies (rel_path, body)`` their texts, ``known (slug, source_set_hash)``
    all topics. A topic without sources, or whose set did not move, is skipped (unless forced); one that the writer
    failed on keeps its page and its line. An index line moves to the topics' section. With a path the log is appended.
    """
    both = known.join(sets.select("slug", "set_hash", "n_sources"), "slug", "left").withColumn("n_sources", F.coalesce("n_sources", F.lit(0).cast("long")))
    moved = skip_unchanged(known, sets, force).select("slug")
    texts = sources.join(moved, "slug", "left_semi").join(bodies, "rel_path")
    texts = texts.select("slug", "rel_path", "title", "body", "mtime", (F.size("aliases") + F.size("quotes")).alias("hits"))
    pages = materialize(G.synthesize_topics(texts, writer, context), "pages")
    written = pages.where("page is not null")
    fields = source_fields(sources.join(written.select("slug"), "slug", "left_semi"), sets, written, day)
    out = materialize(written.select("slug", "page", "summary", "n_sources").join(fields, "slug"), "topic-pages")
    status = F.when(F.col("n_sources") == 0, "skipped-zero-sources").when(F.col("_error").isNotNull(), "failed").when(F.col("_got"), "wrote").otherwise("skipped-unchanged")
    results = both.join(pages.select("slug", F.col("error").alias("_error"), F.lit(True).alias("_got"), "degraded"), "slug", "left").select("slug", status.alias("status"), "n_sources", F.coalesce("degraded", F.lit(False)).alias("degraded"))
    results = materialize(results, "topic-results")
    said = F.when(F.col("status") == "wrote", F.concat(F.col("slug"), F.lit(": synthesized "), F.col("n_sources").cast("string"), F.lit(" sources"))).when(F.col("status") == "skipped-zero-sources", F.concat(F.col("slug"), F.lit(": skipped, zero sources")))
    lines = results.select(said.alias("line")).where("line is not null")
    if log is not None:
        append_log(lines, log)
    entry = F.concat(F.lit("- [["), "slug", F.lit("]] — "), "summary")
    return {
        "pages": out.select("slug", "page", "fields"),
        "index": upsert_lines(index, out.select("slug", entry.alias("line"), F.lit(SECTION).alias("section")), section="section"),
        "log": lines,
        "results": results,
    }


LEDGER = "key string, evidence double, seen_count long, distinct_anchors array<string>, last_seen string, signature string, slug string, proposed boolean"


def save_ledger(state: DataFrame, path: str, version: int = 1) -> None:
    """The ledger as lines of JSON, one a key, each with the schema's version. It is staged and put in place by a rename."""
    spark = state.sparkSession
    names = [c.split()[0] for c in LEDGER.split(", ")]
    staged = f"{path.rstrip('/')}.tmp"
    state.select(F.lit(version).alias("schema_version"), *names).write.mode("overwrite").option("ignoreNullFields", "false").json(staged)
    fs, at = _folder(spark, path)
    fs.delete(at(path), True)
    fs.rename(at(staged), at(path))


def load_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger that stands at ``path``; empty if there is none.

    One with a line that is no entry is derived state gone wrong: it is set aside as ``<path>.corrupt.<time>``, so nothing
    is lost silently, and an empty one is returned.
    """
    fs, at = _folder(spark, path)
    if not fs.exists(at(path)):
        return spark.createDataFrame([], LEDGER)
    rows = spark.read.text(path).withColumn("e", F.from_json("value", f"schema_version int, {LEDGER}, _bad string", {"columnNameOfCorruptRecord": "_bad"}))
    bad = F.col("e").isNull() | F.col("e._bad").isNotNull() | F.col("e.key").isNull() | F.col("e.evidence").isNull() | F.col("e.seen_count").isNull() | F.col("e.last_seen").isNull()
    if rows.where(bad).isEmpty():
        return materialize(rows.select("e.*").drop("schema_version", "_bad"), "ledger")
    fs.rename(at(path), at(f"{path.rstrip('/')}.corrupt.{int(time.time() * 1000)}"))
    return spark.createDataFrame([], LEDGER)


def _folder(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at
