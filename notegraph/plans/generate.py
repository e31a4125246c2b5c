"""Jobs with a pluggable generator: validated rows, cluster names, topic pages, and the nightly run."""

from __future__ import annotations

import functools
import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notegraph.functions import text as X
from notegraph.operators import aggregates as A
from notegraph.operators import clusters as C
from notegraph.operators import joins as J
from notegraph.operators import topics as P
from notegraph.operators import windows as N
from notegraph.operators.filters import sieve
from notegraph.plans import pipelines as L
from notegraph.session import materialize, shuffled, small_batches, small_broadcasts
from notegraph.streaming.incremental import skip_unchanged, todo

_CHECKS = {T.StringType: str, T.DoubleType: (int, float), T.LongType: int, T.BooleanType: bool, T.ArrayType: list}


def generate_rows(df: DataFrame, generator: Callable[[], Callable[[str], str]], schema: T.StructType, prompt: str = "prompt", retries: int = 2) -> DataFrame:
    """Adds ``result`` (a struct of ``schema``), ``error`` and ``attempts``.

    ``generator()`` is called once per task and returns prompt -> JSON text. An answer that does not fit the schema is
    asked for again, with the error appended to the prompt; after ``retries`` more attempts the row keeps its error.
    """

    def check(text: str) -> dict:
        value = json.loads(text)
        if not isinstance(value, dict):
            raise ValueError("not an object")
        for f in schema.fields:
            v = value.get(f.name)
            if v is None and not f.nullable:
                raise ValueError(f"{f.name} is missing")
            kind = _CHECKS.get(type(f.dataType))
            if v is not None and kind and (not isinstance(v, kind) or (isinstance(v, bool) and kind is not bool)):
                raise ValueError(f"{f.name} is of a wrong kind")
        return {f.name: value.get(f.name) for f in schema.fields}

    def run(batches):
        call = generator()
        for pdf in batches:
            results, errors, attempts = [], [], []
            for text in pdf[prompt]:
                result, error, n = None, None, 0
                while result is None and n <= retries:
                    n += 1
                    try:
                        result, error = check(call(text if error is None else f"{text}\n\nThe last answer was rejected: {error}")), None
                    except Exception as e:  # a bad answer must not fail the job
                        error = str(e)[:200]
                results.append(result)
                errors.append(error)
                attempts.append(n)
            yield pdf.assign(result=results, error=errors, attempts=attempts)

    out = T.StructType([*df.schema.fields, T.StructField("result", schema), T.StructField("error", T.StringType()), T.StructField("attempts", T.LongType())])
    return df.mapInPandas(run, out)


NAME = T.StructType([T.StructField("name", T.StringType(), False), T.StructField("aliases", T.ArrayType(T.StringType())), T.StructField("description", T.StringType())])


def fallback_name(anchor: Column, n: Column) -> Column:
    label = X.anchor_label(anchor)
    return F.struct(label.alias("name"), F.array(label).alias("aliases"), F.concat(F.lit("Notes about "), label, F.lit(" ("), n.cast("string"), F.lit(").")).alias("description"))


def name_clusters(clusters: DataFrame, generator: Callable | None = None) -> DataFrame:
    """Adds slug, name, aliases, description and ``named``; what a generator cannot name gets its anchor's label."""
    plain = fallback_name(F.col("dominant_anchor"), F.col("n"))
    if generator is None:
        out = clusters.withColumn("_n", plain).withColumn("named", F.lit(False))
    else:
        asked = clusters.withColumn("prompt", F.concat_ws("\n", F.lit("Name the theme of these anchors."), F.array_join("anchors", ", ")))
        out = generate_rows(asked, generator, NAME).withColumn("_n", F.coalesce("result", plain)).withColumn("named", F.col("result").isNotNull())
    slug = lambda c: F.nullif(X.slugify(c), F.lit(""))
    aliases = P.dedup_case_insensitive(F.concat(F.array("_n.name"), F.coalesce("_n.aliases", F.array().cast("array<string>"))))
    return out.select(*clusters.columns, "named", F.coalesce(slug(F.col("_n.name")), slug(X.anchor_label(F.col("dominant_anchor"))), F.lit("topic")).alias("slug"), "_n.name", aliases.alias("aliases"), "_n.description")


PAGE = T.StructType([T.StructField("summary", T.StringType(), False), T.StructField("facts", T.StringType()), T.StructField("contradictions", T.StringType())])


def synthesize_topics(sources: DataFrame, generator: Callable, context: int = 80_000) -> DataFrame:
    """``sources (slug, rel_path, title, body, mtime, hits)`` to ``(slug, page, summary, n_sources, degraded, error)``.

    Sources are ranked and numbered and share the context's budget; the generator writes, claims without a valid
    citation become inferences, and the page is put together of fixed sections.
    """
    ranked = N.rank_sources(sources.withColumn("chars", F.length("body").cast("long")))
    ranked = N.budget_sources(ranked, context)
    line = F.concat(F.col("title"), F.lit(": "), F.left("body", F.col("allowed").cast("int")))
    topic = ranked.groupBy("slug").agg(F.array_sort(F.collect_list(F.struct("n", line.alias("text"), "rel_path"))).alias("s"), F.count("*").alias("n_sources"), F.max("degraded").alias("degraded"))
    none = F.array().cast("array<string>")
    prompt = P.build_prompt(F.lit("Answer as JSON: summary, facts, contradictions."), none, F.array("slug"), F.transform("s", lambda x: x["text"]))
    got = generate_rows(topic.select("slug", "n_sources", "degraded", F.transform("s", lambda x: x["rel_path"]).alias("paths"), prompt.alias("prompt")), generator, PAGE)
    facts = P.split_verified(F.coalesce("result.facts", F.lit("")), F.col("n_sources"))
    against = P.split_verified(F.coalesce("result.contradictions", F.lit("")), F.col("n_sources"))
    page = P.assemble_page(F.col("slug"), X.summary_line(F.coalesce("result.summary", F.lit(""))), facts["kept"], against["kept"], F.concat(facts["inferences"], against["inferences"]), F.col("paths"))
    summary = F.when(F.col("error").isNull(), X.summary_line(F.coalesce("result.summary", F.lit(""))))
    return got.select("slug", F.when(F.col("error").isNull(), page).alias("page"), summary.alias("summary"), "n_sources", "degraded", "error")


def audit_hubs(notes: DataFrame, hubs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(missing hubs with their references, problems of existing ones) of ``notes (stem, up)`` and ``hubs (hub)``."""
    refs = notes.where("up is not null").select(F.col("up").alias("hub"))
    pages = notes.join(hubs.select(F.col("hub").alias("stem")).distinct(), "stem", "left_semi")
    return J.missing_hubs(hubs, pages, refs), J.lint_hubs(pages)


def nightly_tables(
    notes: DataFrame,
    done: DataFrame,
    rules: L.Rules,
    topics: DataFrame,
    cap: int | None = 50,
    writer: Callable | None = None,
    ledger: DataFrame | None = None,
    known: DataFrame | None = None,
    rejected: DataFrame | None = None,
    now: Column | None = None,
    days: int | None = 30,
    generic_tags: list[str] | None = None,
    generic_orgs: tuple[str, ...] = ("unknown", "personal", "none", "Unknown", "Personal", "None"),
    namer: Callable | None = None,
    exclude: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """One run's written tables: classified, matches, sources, sets, proposals, created, ledger, pages, links and report.

    ``ledger`` is the last run's, ``known (slug, source_set_hash)`` the pages that exist, ``rejected (slug)`` the names
    turned down. Notes of the last ``days`` before ``now`` (the newest note's time) that match no topic are proposed
    from, once per body; None takes all. People, tags and org are the notes' own where they have such columns, else
    those of this run's classification. Without a ``writer`` no page is written, and its row says so; without a
    ``namer`` no topic is created. ``topics`` of a note are wiki links.

    Tables with a row for each note are joined by shuffles, and the session's bounds of batches and broadcasts are lowered.
    """
    spark = notes.sparkSession
    small_batches(spark)
    small_broadcasts(spark)
    has = lambda c, kind: F.col(c) if c in notes.columns else F.lit(None).cast(kind)
    out = {}
    fresh = L.classify_corpus(todo(notes, done, cap=cap), rules, purge=False)
    notes = notes if "file_name" in notes.columns else notes.withColumn("file_name", F.substring_index("rel_path", "/", -1))
    out["classified"] = fresh = materialize(fresh.select("rel_path", "type", "org", "context", "people", "tags", "confidence", "decision", "by"), "nightly-classified")
    folded = notes.withColumn("folded", X.fold(F.concat_ws("\n", "file_name", "body")))
    out["matches"] = matches = materialize(J.match_topics(folded, topics.withColumn("alias", X.fold("alias"))), "nightly-matches")
    # a note's text is shuffled for its topics only if it may have one
    met = sieve(notes, F.xxhash64("rel_path"), matches.select(F.xxhash64("rel_path"))).where("__ng_maybe").drop("__ng_maybe")
    sources, _ = L.collect_topics(met, topics, exclude, matches)
    out["sources"] = sources = materialize(sources, "nightly-sources")
    out["sets"] = sets = materialize(A.source_set_hash(sources, ["slug"]), "nightly-sets")

    rest = J.unmatched_notes(notes, matches)
    # as text: years beyond 9999 have no datetime
    now = now if now is not None else F.lit(notes.agg(F.max("mtime").cast("string")).first()[0] or "2024-01-01").cast("timestamp")
    if days is not None:
        rest = rest.where(F.col("mtime").cast("timestamp") >= now - F.make_dt_interval(days=F.lit(days)))
    rest = rest.join(A.dedup_by_body(rest).select("rel_path"), "rel_path", "left_semi")
    facts = fresh.select("rel_path", *[F.col(c).alias(f"f_{c}") for c in ("people", "tags", "org")])
    own = {c: F.coalesce(has(c, kind), F.col(f"f_{c}")) for c, kind in (("people", "array<string>"), ("tags", "array<string>"), ("org", "string"))}
    rest = rest.join(shuffled(facts), "rel_path", "left").select(F.xxhash64("rel_path").alias("node"), "rel_path", "title", "stem", "body", *[v.alias(c) for c, v in own.items()])
    refs = materialize(noteref(rest, generic_tags, list(generic_orgs)), "nightly-noterefs")
    state = ledger if ledger is not None else spark.createDataFrame([], "key string, evidence double, seen long, last_seen timestamp, promoted boolean")
    none = spark.createDataFrame([], "slug string")
    found = L.propose_topics(refs, state, now, rejected if rejected is not None else none, topics.select("slug"), topics.select("alias"), namer)
    out |= {k: found[k] for k in ("proposals", "created", "ledger")}

    known = known if known is not None else none.select("slug", F.lit(None).cast("string").alias("source_set_hash"))
    stale = skip_unchanged(topics.select("slug").distinct().join(known, "slug", "left"), sets)
    texts = sources.join(stale.select("slug"), "slug", "left_semi").join(met.select("rel_path", "body"), "rel_path")
    texts = texts.select("slug", "rel_path", "title", "body", "mtime", F.size("aliases").alias("hits"))
    if writer is None:
        pages = stale.select("slug", F.lit(None).cast("string").alias("page"), F.lit(None).cast("string").alias("summary"), "n_sources", F.lit(True).alias("degraded"), F.lit("no writer").alias("error"))
    else:
        pages = synthesize_topics(texts, writer)
    out["pages"] = pages = materialize(pages.join(sets.select("slug", "set_hash"), "slug"), "nightly-pages")

    linked = F.to_json(F.coalesce(has("topics", "array<string>"), F.array().cast("array<string>")))
    links = L.reconcile(notes.select("rel_path", F.create_map(F.lit("topics"), linked).alias("fields")), sources, topics.select("slug"))
    links = links.where("status = 'updated'").select("rel_path", F.from_json(F.col("fields")["topics"], "array<string>").alias("topics"), "removed")
    out["links"] = materialize(links.fillna({"removed": 0}), "nightly-links")

    settled = done.select("rel_path").unionByName(fresh.where("decision = 'auto'").select("rel_path")).distinct().withColumn("_done", F.lit(True))
    queue = notes.select("rel_path", "vault").join(shuffled(fresh.where("decision = 'review'").select("rel_path")), "rel_path")
    built = topics.select("slug").distinct().join(known, "slug", "left").select("slug", F.lit(None).cast("string").alias("updated"), "source_set_hash")
    report = L.corpus_report(notes.join(shuffled(settled), "rel_path", "left"), F.col("_done").isNotNull(), topics=built, sets=sets, queue=queue)
    out["report"] = materialize(report["totals"], "nightly-report")
    out |= {k: materialize(report[k], f"nightly-{k}") for k in ("orphans", "dangling", "freshness")}
    return out


def nightly(notes: DataFrame, done: DataFrame, rules: L.Rules, topics: DataFrame, cap: int | None = 50, **more) -> DataFrame:
    """One run as rows ``(step, n, detail)``, one for each of classify, collect, propose, synthesize, backlink, report.

    ``more`` goes to `nightly_tables`, whose written tables hold what the steps made.
    """
    t = nightly_tables(notes, done, rules, topics, cap, **more)
    row = lambda step, df, detail: df.agg(F.count("*").alias("n"), detail.alias("detail")).select(F.lit(step).alias("step"), "n", "detail")
    count = lambda c: F.count_if(c).cast("string")
    rows = [
        row("classify", t["classified"], count(F.col("decision") == "auto")),
        row("collect", t["sets"], F.coalesce(F.sum("n_sources"), F.lit(0)).cast("string")),
        row("propose", t["proposals"], F.concat(F.lit("ledger "), F.lit(t["ledger"].count()).cast("string"))),
        row("synthesize", t["pages"], F.concat(count(F.col("page").isNotNull()), F.lit(" written, "), count(F.col("degraded")), F.lit(" degraded"))),
        row("backlink", t["links"], F.coalesce(F.sum("removed"), F.lit(0)).cast("string")),
        row("report", t["report"], F.max(F.when(F.col("vault") == "*", F.col("health"))).cast("string")),
    ]
    return functools.reduce(DataFrame.unionByName, rows)


def noteref(notes: DataFrame, generic_tags: list[str] | None = None, generic_orgs: list[str] | None = None) -> DataFrame:
    """``(node, rel_path, anchors, tokens)`` of notes with people, tags and org."""
    title = F.when(F.coalesce("title", F.lit("")) != "", F.col("title")).otherwise(F.col("stem"))
    return notes.select("node", "rel_path", C.anchors(F.col("people"), F.col("tags"), F.col("org"), generic_tags or [], generic_orgs or []).alias("anchors"), X.tokens(F.concat_ws("\n", title, "body")).alias("tokens"))
