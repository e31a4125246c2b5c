"""The jobs: classification, collection, proposals, reports, repairs, migration."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notegraph.functions import text as X
from notegraph.operators import aggregates as A
from notegraph.operators import clusters as C
from notegraph.operators import filters as P
from notegraph.operators import joins as J
from notegraph.operators import topics as T
from notegraph.operators import windows as N
from notegraph.operators.numbering import numbered
from notegraph.session import Scratch, materialize
from notegraph.sources.notes import allowed, guid_lookup
from notegraph.sources.sinks import insert_plan, set_or_drop_field, write_topic_sets
from notegraph.streaming.ledger import BAR, ledger_step

RESULT = "type string, org string, context string, people array<string>, tags array<string>, confidence double, reason string"
# fixed values: confidence that settles a note; of a body shape, a title rule, a folder's org, a lone keyword; keywords that count as more
THRESHOLD, SHAPE, TITLE, FOLDER, LONE, LEAST_HITS = 0.8, 0.85, 0.95, 0.95, 0.5, 2


@dataclass(frozen=True)
class Rules:
    """Keyword tables (order breaks ties) and title rules of a classifier."""

    types: dict[str, list[str]]
    orgs: dict[str, list[str]]
    titles: list[tuple[str, str]] = field(default_factory=list)
    folders: list[str] = field(default_factory=list)
    work_orgs: list[str] = field(default_factory=list)
    work: dict[str, float] = field(default_factory=dict)
    personal: dict[str, float] = field(default_factory=dict)
    tags: dict[str, list[str]] = field(default_factory=dict)


def classify_rules(notes: DataFrame, r: Rules, least_hits: int = LEAST_HITS) -> DataFrame:
    """Adds type, org, context, people, tags, confidence, reason by one projection without a shuffle.

    A body that is just an embed is a clipping. Else org and type each have a confidence and the smaller one counts.
    Content decides on the org; a folder that names one decides where content is silent. A title rule decides on the
    type before keywords do; a single keyword is worth one half at most.
    """
    low = F.col("_low")
    n = notes.withColumn("_low", F.lower(F.concat_ws("\n", "title", "body"))).withColumns({"_types": X.keyword_hits(low, r.types), "_orgs": X.keyword_hits(low, r.orgs), "_work": X.keyword_weight(low, r.work), "_personal": X.keyword_weight(low, r.personal), "_shape": X.body_shape(F.col("body")), "_rule": X.first_rule(F.col("title"), r.titles)})
    folder = F.coalesce(*[F.when(F.lower("folder") == f.lower(), F.lit(f)) for f in r.folders]) if r.folders else F.lit(None).cast("string")
    n = n.withColumns({"_org": X.argmax_first(F.col("_orgs"), list(r.orgs)), "_folder": folder, "_best": X.argmax_first(F.col("_types"), list(r.types)), "_top": F.array_max(F.map_values("_types"))})
    org = F.coalesce("_org", "_folder", F.lit("Personal"))
    org_conf = F.when(F.col("_org").isNotNull(), X.top_share(F.col("_orgs"))).when(F.col("_folder").isNotNull(), FOLDER).otherwise(0.0)
    type_conf = F.when(F.col("_rule").isNotNull(), TITLE).when(F.col("_top") >= least_hits, X.top_share(F.col("_types"))).when(F.col("_top") > 0, LONE).otherwise(0.0)
    fallback = F.when(F.col("_personal") > F.col("_work"), "personal").otherwise("note")
    clip = F.col("_shape").isNotNull()
    shape_org = F.coalesce("_folder", F.lit("Personal"))
    empty = F.array().cast("array<string>")
    out = n.select(
        *notes.columns,
        F.when(clip, "clipping").otherwise(F.coalesce("_rule", "_best", fallback)).alias("type"),
        F.when(clip, shape_org).otherwise(org).alias("org"),
        F.when(clip, F.when(shape_org.isin(*r.work_orgs), "work").otherwise("personal")).otherwise(P.context_of(org, F.col("_work"), F.col("_personal"), r.work_orgs)).alias("context"),
        F.when(clip, empty).otherwise(X.people(F.col("body"))).alias("people"),
        F.when(clip, empty).otherwise(X.tags(low, r.tags)).alias("tags"),
        F.when(clip, SHAPE).otherwise(F.least(org_conf, type_conf)).alias("confidence"),
        F.when(clip, F.concat(F.lit("body shape: "), "_shape")).otherwise(F.lit("rules")).alias("reason"),
    )
    return out


def enrich_with_model(df: DataFrame, model: Callable[[], Callable[[str, str], dict]]) -> DataFrame:
    """Results of a pluggable model. ``model()`` is called once per task and returns (title, body) -> fields; a failure
    becomes a row of confidence 0. Confidences are clamped and empty fields get defaults."""
    names = [f.split()[0] for f in RESULT.split(", ")]

    def run(batches):
        import pandas as pd

        call = model()
        for pdf in batches:
            rows = []
            for title, body in zip(pdf["title"], pdf["body"], strict=True):
                try:
                    d = call(title, body)
                    rows.append([d.get("type") or "note", d.get("org") or "Personal", d.get("context") or "personal", list(d.get("people") or []), list(d.get("tags") or []), max(0.0, min(1.0, float(d.get("confidence") or 0))), d.get("reason") or "model"])
                except Exception as e:  # a model's failure must not fail the job
                    rows.append(["note", "Personal", "personal", [], [], 0.0, f"error: {e}"[:200]])
            yield pd.concat([pdf[[c for c in pdf.columns if c not in names]].reset_index(drop=True), pd.DataFrame(rows, columns=names)], axis=1)

    keep = [c for c in df.columns if c not in names]
    schema = ", ".join(f"`{c}` {dict(df.dtypes)[c]}" for c in keep) + ", " + RESULT
    return df.select(*keep).mapInPandas(run, schema)


def classify_corpus(notes: DataFrame, rules: Rules, model: Callable | None = None, purge: bool = True, threshold: float = THRESHOLD) -> DataFrame:
    """The cascade: rules; then tiny bodies are purged (or queued); the model sees only the rest, and wins only if it
    is strictly surer; what stays below the threshold is for review. Adds ``decision`` and ``by``. A null body is tiny.

    Decisions are columns of one pass, as Spark puts a filter before the rules with all that they read, again for each
    place that reads it. Only a model needs its rows apart: then what the rules say is a table.
    """
    names = [f.split()[0] for f in RESULT.split(", ")]
    gone = (F.col("confidence") < threshold) & X.tiny_body(F.coalesce("body", F.lit("")))
    ruled = classify_rules(notes, rules).select("*", F.lit("rules").alias("by"), F.when(gone, "purged" if purge else "review").when(F.col("confidence") >= threshold, "auto").alias("decision"))
    ruled = ruled.withColumn("confidence", F.when(F.coalesce(F.col("decision") == "auto", F.lit(True)), F.col("confidence")).otherwise(0.0))
    if model is None:
        return ruled.withColumn("decision", F.coalesce("decision", F.lit("review")))
    ruled = materialize(ruled, "ruled")
    asked = ruled.where("decision is null").drop("by", "decision").withColumn("_rules", F.struct(*names))
    got = enrich_with_model(asked, model)
    better = F.col("confidence") > F.col("_rules.confidence")
    rest = got.select(*notes.columns, *[F.when(better, F.col(n)).otherwise(F.col(f"_rules.{n}")).alias(n) for n in names], F.when(better, "model").otherwise("rules").alias("by"))
    rest = rest.withColumn("decision", F.when(F.col("confidence") >= threshold, "auto").otherwise("review"))
    return ruled.where("decision is not null").unionByName(rest)


def classify_binary(notes: DataFrame, work: dict[str, float], personal: dict[str, float]) -> DataFrame:
    """Work or Personal by weighted keywords of title and body, Uncertain without any.

    Equal scores are Personal. Confidence is how one-sided the scores are: 0 if balanced, 1 if one of them is 0.
    """
    low = F.lower(F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("body", F.lit(""))))
    n = notes.withColumns({"_w": X.keyword_weight(low, work), "_p": X.keyword_weight(low, personal)})
    total = F.col("_w") + F.col("_p")
    label = F.when(total == 0, "Uncertain").when(F.col("_w") > F.col("_p"), "Work").otherwise("Personal")
    sided = F.when(total == 0, 0.0).otherwise(F.least(F.lit(1.0), F.abs(F.col("_w") / total - 0.5) * 2))
    matched = X.matched_keywords(low, [*work, *personal])
    return n.select(*notes.columns, label.alias("predicted"), sided.alias("confidence"), matched.alias("matched"))


def classify_binary_corpus(notes: DataFrame, work: dict[str, float], personal: dict[str, float], model: Callable | None = None, threshold: float = 0.7) -> DataFrame:
    """`classify_binary` over ``notes (raw, ...)``: title from the header block or else the stem, body without it.

    Below ``threshold`` a model, if there is one, is asked; its answer counts unless it failed. Confidence has three places.
    """
    read = notes.withColumns({"title": F.coalesce(X.header_field(F.col("raw"), "title"), F.col("stem")), "body": X.strip(X.strip_header(F.col("raw")))})
    out = classify_binary(read, work, personal)
    if model is not None:
        low = out.where(F.col("confidence") < threshold)
        asked = enrich_with_model(low.select(*[F.col(c).alias("_confidence" if c == "confidence" else c) for c in low.columns]), model)
        ok = F.col("type").isin("Work", "Personal", "Uncertain") & ~F.col("reason").startswith("error: ")
        got = asked.select(*read.columns, F.when(ok, F.col("type")).otherwise(F.col("predicted")).alias("predicted"), F.when(ok, F.col("confidence")).otherwise(F.col("_confidence")).alias("confidence"), "matched")
        out = out.where(F.col("confidence") >= threshold).unionByName(got)
    return out.withColumn("confidence", F.round("confidence", 3))


def collect_topics(notes: DataFrame, topics: DataFrame, exclude: DataFrame | None = None, matches: DataFrame | None = None, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(sources, sets): a topic's notes, one per body, with title, aliases found and first quotes; each topic's digest.

    ``notes (rel_path, file_name, stem, title, mtime, body)`` are taken by the walk for sources. ``topics (slug, alias,
    alias_pos)``: an alias stands in a note's file name or body, all folded. ``exclude (slug, glob)``: notes that a topic
    leaves out by path or name. ``matches`` is what `match_topics` found, where that is written already. With ``path``
    the sets are written there as documents.
    """
    n = notes.where(allowed(F.col("rel_path"), "source"))
    if matches is None:
        matches = J.match_topics(n.withColumn("folded", X.fold(F.concat_ws("\n", "file_name", "body"))), topics.withColumn("alias", X.fold("alias")))
    m = matches.join(n.select("rel_path", "file_name", F.sha2("body", 256).alias("body_sha")), "rel_path")
    if exclude is not None:
        out = m.join(exclude.select("slug", "glob"), "slug").where(P.matches_glob("rel_path", "glob") | P.matches_glob("file_name", "glob"))
        m = m.join(out.select("slug", "rel_path").distinct(), ["slug", "rel_path"], "left_anti")
    pick = F.min(F.struct(F.col("rel_path").rlike(r"\.\d+\.md$").alias("k"), F.length("rel_path").alias("n"), "rel_path", "aliases")).alias("p")
    one = m.groupBy("slug", "body_sha").agg(pick).select("slug", "body_sha", "p.rel_path", "p.aliases")
    title = F.when(F.coalesce("title", F.lit("")) != "", F.col("title")).otherwise(F.col("stem"))
    full = one.join(n.select("rel_path", title.alias("title"), "mtime", "body"), "rel_path")
    every = topics.groupBy("slug").agg(F.array_sort(F.collect_list("alias")).alias("every"))
    quotes = N.first_quotes(full.join(every, "slug"), "every", keys=("slug", "rel_path"))
    none = F.array().cast("array<string>")
    sources = full.drop("body").join(quotes, ["slug", "rel_path"], "left").withColumn("quotes", F.coalesce("quotes", none))
    sources = sources.select("slug", "rel_path", "title", "mtime", "aliases", "quotes", "body_sha")
    sets = A.source_set_hash(sources, ["slug"])
    if path is not None:
        write_topic_sets(sources.join(sets.select("slug", "set_hash"), "slug"), path)
    return sources, sets


def propose_topics(
    noterefs: DataFrame,
    state: DataFrame,
    now,
    rejected: DataFrame,
    taken_slugs: DataFrame,
    taken_aliases: DataFrame,
    namer: Callable | None = None,
    floor: float = C.PROPOSE,
    bar: float = BAR,
    auto: float = C.AUTO,
) -> dict[str, DataFrame]:
    """From clusters of unmatched notes to proposals, as the tables proposals, created, ledger and report.

    Clusters are routed: strong ones are created if a ``namer`` (see `name_clusters`) named them and no slug or alias is
    taken, and are proposed otherwise; middling ones are proposed; weak ones leave evidence in the ledger, which promotes
    what crosses its bar. Names that were turned down before are dropped. The report has a line for each outcome.
    """
    from notegraph.plans.generate import name_clusters

    c = materialize(C.cluster_notes(noterefs, floor=floor, auto=auto), "clusters")
    weak = c.where("route = 'ledger'").select(F.col("dominant_anchor").alias("key"), "confidence", "anchors", "signature")
    sightings = weak.groupBy("key").agg(
        F.sum("confidence").alias("evidence"), F.count("*").alias("seen"), F.lit(now).cast("timestamp").alias("last_seen"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("anchors")))).alias("anchors"), F.max("signature").alias("signature"),
    )
    ledger = materialize(ledger_step(state, sightings, now, bar=bar), "ledger")
    scratch = Scratch(noterefs.sparkSession, "proposals")
    strong = name_clusters(c.where("route <> 'ledger'"), namer).join(rejected.select("slug").distinct(), "slug", "left_anti")
    strong = scratch.write(strong, "strong")
    asked = numbered(strong.where("route = 'auto' AND named"), [], [F.col("n").desc(), "signature"], scratch, "asked").withColumnRenamed("idx", "pos")
    won = J.resolve_collisions(asked, taken_slugs, taken_aliases).select("pos", F.col("aliases").alias("kept"))
    plan = insert_plan(asked.join(won, "pos").drop("aliases").withColumnRenamed("kept", "aliases"), taken_slugs, order="pos")
    created = materialize(plan.where("outcome = 'created'").select("slug", "name", "aliases", "description", "n", "signature", "confidence"), "created")
    left = strong.join(created.select("signature"), "signature", "left_anti")
    proposals = materialize(left.select("slug", "name", "aliases", "description", "n", "signature", "confidence"), "proposals")
    scratch.close()
    line = lambda df, kind: df.select(F.lit(kind).alias("kind"), F.to_json(F.struct(*[x for x in ("slug", "key", "name", "n", "evidence") if x in df.columns])).alias("line"))
    report = line(created, "auto_created").unionByName(line(proposals, "proposed")).unionByName(line(ledger.where("newly"), "promoted"))
    return {"proposals": proposals, "created": created, "ledger": ledger, "report": report}


def reconcile(notes: DataFrame, sources: DataFrame, slugs: DataFrame) -> DataFrame:
    """Managed topic links of ``notes (rel_path, fields)``: C16, C17 and the merge into the header's fields.

    ``fields`` is a map; ``topics`` in it is a JSON list of links. Result: rel_path, fields, removed, status. A note
    without links afterwards loses the field; a field that is no list is skipped with status ``error``.
    """
    have = notes.select("rel_path", "fields", F.from_json(F.col("fields")["topics"], "array<string>").alias("topics"))
    odd = F.col("fields")["topics"].isNotNull() & ~F.col("fields")["topics"].rlike(r"(?s)^\s*\[.*\]\s*$")
    good = have.where(~F.coalesce(odd, F.lit(False))).withColumn("topics", F.coalesce("topics", F.array().cast("array<string>")))
    plan = J.reconcile_backlinks(good.select("rel_path", "topics"), J.desired_backlinks(sources), slugs, wiki=True)
    changed = plan.where("status = 'updated'").select("rel_path", F.col("topics").alias("values"))
    done = set_or_drop_field(notes.select("rel_path", "fields"), changed, "topics").join(plan.select("rel_path", "removed", "status"), "rel_path", "left")
    return done.select("rel_path", "fields", F.coalesce("removed", F.lit(0)).alias("removed"), F.coalesce("status", F.lit("error")).alias("status"))


def corpus_report(
    notes: DataFrame,
    classified,
    pages: DataFrame | None = None,
    topics: DataFrame | None = None,
    sets: DataFrame | None = None,
    queue: DataFrame | None = None,
    files: DataFrame | None = None,
    complete: bool = True,
) -> dict[str, DataFrame]:
    """The health of each vault and of all (vault ``*``), and what it was found from, as tables:

    totals (with health), orphans (parents that do not exist), dangling (links to topics that do not exist), freshness
    (per topic) and quarantine (topic pages that cannot be read). ``notes (vault, rel_path)`` may have ``up`` and
    ``topics``; ``pages`` are those of `load_topics` with vault, updated and source_set_hash, or ``topics (slug, updated,
    source_set_hash)`` stand for them, which hold for all vaults; ``queue`` and ``files`` have a row per note to review,
    and per file, with its vault. A topic without a set has unknown freshness. Stale topics of no vault count in all.
    """
    spark = notes.sparkSession
    has = lambda c, kind: F.col(c) if c in notes.columns else F.lit(None).cast(kind)
    n = notes.withColumn("up", T.normalise_parent(has("up", "string"))).withColumn("topics", has("topics", "array<string>"))
    orphans = materialize(J.orphan_parents(n), "report-orphans")
    if pages is not None:
        # each vault has its own names
        own = lambda c: F.concat(F.coalesce("vault", F.lit("")), F.lit("\x01"), c)
        topics, quarantine = T.load_topics(pages.withColumns({"slug": own(F.col("slug")), "stem": own(F.col("stem")), "aliases": F.transform("aliases", own)}))
        topics = topics.withColumn("slug", F.regexp_replace("slug", "(?s)^[^\x01]*\x01", ""))
    else:
        topics = topics.withColumn("vault", F.lit("*")) if topics is not None else spark.createDataFrame([], "vault string, slug string, updated string, source_set_hash string")
        quarantine = spark.createDataFrame([], "rel_path string, reason string")
    topics = materialize(topics.select("vault", "slug", "updated", "source_set_hash").distinct(), "report-topics")
    refs = n.select("vault", "rel_path", F.explode(T.topic_refs(F.col("topics"))).alias("slug"))
    dangling = J.dangling_refs(refs, topics, ["vault", "slug"] if pages is not None else ["slug"])
    sets = sets if sets is not None else spark.createDataFrame([], "slug string, n_sources long, set_hash string")
    freshness = J.topic_freshness(topics, sets, ("vault",))
    metrics = A.vault_metrics(n.join(orphans.select("vault", "rel_path", F.lit(True).alias("_orphan")), ["vault", "rel_path"], "left"), classified, F.col("_orphan").isNotNull())
    totals = A.corpus_totals(metrics)
    count = lambda df, name: df.select("vault", F.lit(name).alias("kind"))
    debris = count(freshness.where("hash_changed"), "stale")
    for df, name in ((queue, "queue"), (None if files is None else files.where(P.is_exhaust(F.col("file_name"))), "exhaust")):
        if df is not None:
            debris = debris.unionByName(count(df, name))
    debris = debris.where("vault <> '*'").unionByName(debris.withColumn("vault", F.lit("*"))).groupBy("vault").agg(*[F.count_if(F.col("kind") == k).alias(k) for k in ("queue", "exhaust", "stale")])
    every = totals.join(debris, "vault", "left").fillna(0, ["queue", "exhaust", "stale"])
    health = A.health_score(F.col("ratio"), F.col("orphans"), F.col("queue"), F.col("exhaust"), F.col("stale"), F.lit(complete))
    return {"totals": every.withColumn("health", health), "orphans": orphans, "dangling": dangling, "freshness": freshness, "quarantine": quarantine}


def clean_numbered(notes: DataFrame, run_id: str = "clean") -> dict[str, DataFrame]:
    """Numbered copies of ``notes (vault, rel_path, stem, body)``, as the tables plan, deletions and links.

    Exact and near copies go, with a row in the deletions' manifest. Orphans take the name of the base that is missing,
    the first in path order where several claim it; links to their old names are rewritten. The rest stays.
    """
    t = J.similar_numbered(notes)
    orphan = t.where("tier = 'orphan'").withColumn("target", F.concat_ws("/", "vault", F.regexp_replace("copy", J.NUMBERED, ".md")))
    claimed = N.claim_first(orphan.withColumnRenamed("copy", "old"), "target", "old").select("vault", F.col("old").alias("copy"), F.col("status").alias("claim"))
    action = F.when(F.col("tier") == "near_dup", "delete").when(F.col("claim") == "renamed", "rename").when(F.col("claim") == "collision", "collision").when(F.col("tier") == "review", "review").otherwise("keep")
    plan = materialize(t.join(claimed, ["vault", "copy"], "left").select("vault", "copy", "tier", "similarity", action.alias("action")), "numbered")
    gone = notes.join(plan.where("action = 'delete'").select("vault", F.col("copy").alias("rel_path")), ["vault", "rel_path"], "left_semi")
    stem = lambda c: F.regexp_replace(F.substring_index(c, "/", -1), r"\.md$", "")
    renames = plan.where("action = 'rename'").select("vault", stem(F.col("copy")).alias("old"), stem(F.regexp_replace("copy", J.NUMBERED, ".md")).alias("new")).distinct()
    links = notes.select("vault", "rel_path", F.explode(X.links(F.col("body"))).alias("target"))
    links = J.relink_renamed(links, renames, ("vault",)).where("changed")
    return {"plan": plan, "deletions": A.deletions_of(gone, X.strip(F.col("body")), run_id), "links": links}


def dedup(notes: DataFrame, run_id: str = "dedup") -> dict[str, DataFrame]:
    """Numbered copies with the text of their base: the pairs, and the rows that go into the deletions' manifest."""
    pairs = materialize(J.exact_copies(notes), "dedup-pairs")
    gone = notes.join(pairs.select("vault", F.col("copy").alias("rel_path")), ["vault", "rel_path"], "left_semi")
    return {"pairs": pairs, "deletions": A.deletions_of(gone, X.strip(F.col("body")), run_id)}


def migrate(notes: DataFrame, existing: DataFrame, context, classified) -> DataFrame:
    """Routes notes by context and gives names that no other note in the target has."""
    n = notes.withColumn("target", P.route_by_context(context, classified))
    return N.unique_names(n.where("target <> 'skipped'"), existing)


def repair_links(notes: DataFrame, guids: DataFrame, url_guid) -> DataFrame:
    """``guids (guid, title)``: links whose address holds a known GUID point to the note of that title afterwards.

    A GUID that is given with several titles points to the greatest of their notes' names, so a link is rewritten once.
    """
    links = notes.select(F.explode(X.markdown_links(F.col("body"))).alias("l")).select(F.col("l.url").alias("url")).distinct().withColumn("guid", url_guid(F.col("url")))
    lookup = guid_lookup(guids, notes.select("title", "stem")).groupBy("guid").agg(F.max("target").alias("target"))
    return J.rewrite_links(notes, links.join(lookup, "guid").select("url", "target"))
