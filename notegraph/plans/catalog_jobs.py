"""Registered queries of the jobs with a pluggable generator, and of the nightly run."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from notegraph.plans import generate as G
from notegraph.plans import jobs as J
from notegraph.plans.catalog import SQL, alias_table, k1_rules, notes, on_notes, query, table
from notegraph.plans.catalog_more import RULES
from notegraph.session import shuffled
from notegraph.sources.notes import folders, nested_tags


def _counter():
    """A stand-in for a model: it answers with the length of its prompt, and wrongly at first where that is odd."""
    import json

    def call(prompt: str) -> str:
        n = len(prompt.split("\n\nThe last answer")[0])
        return "no json" if n % 2 and "rejected" not in prompt else json.dumps({"n": n})

    return call


@query("j2_generate_rows", "SELECT conv_id, turn, CAST(length(text) AS BIGINT) AS n, CAST(1 + length(text) % 2 AS BIGINT) AS attempts FROM conversations")
def j2(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", F.col("text").alias("prompt"))
    out = G.generate_rows(c, _counter, T.StructType([T.StructField("n", T.LongType(), False)]))
    return out.select("conv_id", "turn", "result.n", "attempts")


@query("j3_name_clusters", """
SELECT p_partkey, regexp_replace(trim(regexp_replace(replace(lower(p_type), '''', ''), '[^a-z0-9]+', '-', 'g'), '-'), '-+', '-', 'g') AS slug, 'Notes about ' || array_to_string(list_transform(string_split(p_type, ' '), lambda w: upper(w[1:1]) || lower(w[2:])), ' ') || ' (' || p_size || ').' AS description FROM part""")
def j3(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.concat(F.lit("tag:"), "p_type").alias("dominant_anchor"), F.col("p_size").alias("n"), F.array("p_type").alias("anchors"))
    return G.name_clusters(p).select("p_partkey", "slug", "description")


def _writer():
    import json

    def call(prompt: str) -> str:
        return json.dumps({"summary": "All is well. (src: B1)", "facts": "It holds. (src: B1) It may hold. (src: B999999)", "contradictions": None})

    return call


@query("k6_synthesize", """
WITH s AS (SELECT o_custkey, count(*) AS n, sum(length(o_orderpriority)) AS chars, string_agg('- ' || o_orderkey, chr(10) ORDER BY o_orderdate DESC, o_totalprice DESC, CAST(o_orderkey AS VARCHAR)) AS src FROM orders GROUP BY 1)
SELECT CAST(o_custkey AS VARCHAR) AS slug, n AS n_sources, sha256('# ' || o_custkey || chr(10) || chr(10) || 'All is well.' || chr(10) || chr(10) || '## Facts' || chr(10) || '- It holds. (src: B1)' || chr(10) || chr(10) || '## Inferences' || chr(10) || '- It may hold. (src: B999999)' || chr(10) || chr(10) || '## Sources' || chr(10) || src) AS digest, chars > 60 AS degraded FROM s""")
def k6(spark, sf):
    s = table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("slug"), F.col("o_orderkey").cast("string").alias("rel_path"), F.lit("t").alias("title"), F.col("o_orderpriority").alias("body"), F.col("o_orderdate").alias("mtime"), F.col("o_totalprice").alias("hits"))
    return G.synthesize_topics(s, _writer, context=120).select("slug", "n_sources", F.sha2("page", 256).alias("digest"), "degraded")


@query("k9_audit_hubs", """
WITH h AS (SELECT DISTINCT p_type AS hub FROM part), n AS (SELECT p_name AS stem, p_type AS up FROM part UNION ALL SELECT DISTINCT p_type, p_type FROM part WHERE p_size = 1)
SELECT h.hub, count(n.up) AS "references" FROM h LEFT JOIN n ON n.up = h.hub WHERE h.hub NOT IN (SELECT p_type FROM part WHERE p_size = 1) GROUP BY 1""")
def k9(spark, sf):
    p = table(spark, sf, "part")
    n = p.select(F.col("p_name").alias("stem"), F.col("p_type").alias("up")).unionByName(p.where("p_size = 1").select(F.col("p_type").alias("stem"), F.col("p_type").alias("up")).distinct())
    return G.audit_hubs(n, p.select(F.col("p_type").alias("hub")).distinct())[0].select("hub", "references")


@query("k14_nightly")
def k14(spark, sf):
    n = notes(spark, sf)
    d = table(spark, sf, "labels").select(F.col("doc_id").alias("id"))
    done = n.join(shuffled(d), n["doc_id"] == d["id"]).select("rel_path", F.lit("rules").alias("classified_by"))
    return G.nightly(n, done, RULES, alias_table(spark, sf), cap=None, writer=_writer)


@query("h45_noteref", on_notes("""
SELECT rel_path, ['tag:' || vault, 'org:' || folder] AS anchors, len(list_distinct(regexp_extract_all(lower(CASE WHEN title <> '' THEN title ELSE stem END || chr(10) || body), '[a-z0-9]{3,}'))) AS n_tokens FROM notes"""))
def h45(spark, sf):
    n = notes(spark, sf).withColumns({"node": F.col("doc_id"), "people": F.array().cast("array<string>"), "tags": F.array("vault"), "org": F.col("folder")})
    return G.noteref(n).select("rel_path", "anchors", F.size("tokens").cast("long").alias("n_tokens"))


@query("a4_scan_folder", on_notes("SELECT folder, count(*) AS n, max(mtime) AS newest FROM notes GROUP BY folder"))
def a4(spark, sf):
    return folders(notes(spark, sf))


@query("a5_parse_header", on_notes("""
SELECT rel_path, doc_id % 2 = 0 AS ok, CASE WHEN doc_id % 2 = 0 THEN 'note ' || stem END AS title, CASE WHEN doc_id % 2 = 0 THEN [vault, folder] END AS tags, CASE WHEN doc_id % 2 = 0 THEN ['aliases'] ELSE [] END AS errors FROM notes"""))
def a5(spark, sf):
    from notegraph.sources.notes import parse_header

    good = F.concat(F.lit("---\ntitle: note "), "stem", F.lit("\ntags:\n  - "), "vault", F.lit("\n  - "), "folder", F.lit("\naliases: one\n---\n"), "body")
    raw = F.when(F.col("doc_id") % 2 == 0, good).otherwise(F.col("body"))
    n = notes(spark, sf).select("rel_path", parse_header(raw).alias("h"))
    return n.select("rel_path", "h.ok", "h.title", "h.tags", "h.errors")


@query("a13_nested_tags", on_notes("SELECT rel_path, [vault || '/' || folder, 'a/b'] AS tags FROM notes"))
def a13(spark, sf):
    tags = F.array(F.concat("vault", F.lit("_"), "folder"), F.lit("a_b"))
    return notes(spark, sf).select("rel_path", nested_tags(tags).alias("tags"))


@query("a22_publish_report", on_notes("SELECT rel_path AS path, sha256(body || CASE WHEN body = '' OR ends_with(body, chr(10)) THEN '' ELSE chr(10) END || '<!-- health:begin -->' || chr(10) || vault || chr(10) || '<!-- health:end -->' || chr(10)) AS digest, TRUE AS ok FROM notes"))
def a22(spark, sf):
    from notegraph.sources.sinks import publish_region

    n = notes(spark, sf)
    out = publish_region(n.select(F.col("rel_path").alias("path"), F.col("body").alias("text")), n.select(F.col("rel_path").alias("path"), F.col("vault").alias("body")), "health")
    return out.select("path", F.sha2("text", 256).alias("digest"), "ok")


@query("a23_set_or_drop", on_notes("SELECT rel_path, CASE doc_id % 3 WHEN 0 THEN '[\"' || vault || '\"]' WHEN 2 THEN 'old' END AS topics, folder AS org FROM notes"))
def a23(spark, sf):
    from notegraph.sources.sinks import set_or_drop_field

    n = notes(spark, sf)
    k = F.col("doc_id") % 3
    fields = n.select("rel_path", F.create_map(F.lit("org"), F.col("folder"), F.lit("topics"), F.lit("old")).alias("fields"))
    updates = n.where(k < 2).select("rel_path", F.when(k == 0, F.array("vault")).otherwise(F.array().cast("array<string>")).alias("values"))
    out = set_or_drop_field(fields, updates, "topics")
    return out.select("rel_path", F.col("fields")["topics"].alias("topics"), F.col("fields")["org"].alias("org"))


@query("h40_extract_json", "SELECT event_id, props AS json FROM events")
def h40(spark, sf):
    from notegraph.functions import text as X

    t = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("answer {: "), "props", F.lit(" {}"))).otherwise(F.concat(F.lit("so ```json\n"), "props", F.lit("\n``` done")))
    return table(spark, sf, "events").select("event_id", X.extract_json(t).alias("json"))


@query("h22_claims", "SELECT conv_id, turn, ['- It is so. (src: B1)', '- Or (perhaps) not.', 'Line ' || turn || ' (src: B2)'] AS claims FROM conversations")
def h22(spark, sf):
    from notegraph.functions import text as X

    t = F.concat(F.lit("- It is so. (src: B1) Or (perhaps) not.\n\nLine "), F.col("turn").cast("string"), F.lit(" (src: B2)"))
    return table(spark, sf, "conversations").select("conv_id", "turn", X.claims(t).alias("claims"))


@query("h39_fallback_name", "SELECT p_partkey, 'Size ' || p_size AS name, 'Notes about Size ' || p_size || ' (' || p_size || ').' AS description FROM part")
def h39(spark, sf):
    f = G.fallback_name(F.concat(F.lit("tag:size-"), F.col("p_size").cast("string")), F.col("p_size"))
    return table(spark, sf, "part").select("p_partkey", f.alias("f")).select("p_partkey", "f.name", "f.description")


@query("h47_source_fields", """
WITH s AS (SELECT o_custkey, count(*) AS n, avg(CASE WHEN o_totalprice > 100000 THEN 1.0 ELSE 0.0 END) AS q FROM orders GROUP BY 1)
SELECT CAST(o_custkey AS VARCHAR) AS slug, n AS n_sources, round(least(n / 3.0, 1.0) * 0.5 + 0.5 * q, 6) AS confidence, n * 10 > 60 AS degraded FROM s""")
def h47(spark, sf):
    from notegraph.functions import text as X
    from notegraph.operators.windows import budget_sources

    o = table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("slug"), F.lit(10).cast("long").alias("chars"), (F.col("o_totalprice") > 100000).alias("quoted"))
    g = budget_sources(o, 120).groupBy("slug").agg(F.count("*").alias("n_sources"), F.avg(F.when(F.col("quoted"), 1.0).otherwise(0.0)).alias("q"), F.max("degraded").alias("degraded"))
    return g.select("slug", "n_sources", F.round(X.topic_confidence(F.col("n_sources"), F.col("q")), 6).alias("confidence"), "degraded")


def _sure():
    return lambda title, body: {"type": "essay", "confidence": len(body) % 10 / 5.0}


@query("j1_enrich_with_model", on_notes("SELECT rel_path, 'essay' AS type, least(1.0, (length(body) % 10) / 5.0) AS confidence FROM notes"))
def j1(spark, sf):
    from notegraph.plans.pipelines import enrich_with_model

    return enrich_with_model(notes(spark, sf).select("rel_path", "title", "body"), _sure).select("rel_path", "type", "confidence")


@query("j4_cascade", on_notes("""
, c AS (SELECT CASE WHEN regexp_matches(title, '^The ') AND folder IN ('src1', 'src2') THEN 'rules' WHEN (length(body) % 10) / 5.0 > 0.6 THEN 'model' END AS by_ FROM notes)
SELECT count(*) FILTER (WHERE by_ = 'rules') AS sure FROM c"""))
def j4(spark, sf):
    from notegraph.plans.pipelines import Rules, classify_corpus

    rules = Rules(types={"none": ["\u0001"]}, orgs={}, titles=[("^The ", "article")], folders=["src1", "src2"])
    out = classify_corpus(notes(spark, sf).select("rel_path", "title", "body", "folder"), rules, _sure)
    return out.agg(F.count_if((F.col("by") == "rules") & (F.col("type") == "article") & (F.col("decision") == "auto")).alias("sure"))


@query("j6_links_as_rows", "SELECT page_id, 0 AS pos, url FROM pages UNION ALL SELECT page_id, 1, 'https://x.example/' || page_id FROM pages")
def j6(spark, sf):
    from notegraph.functions import text as X

    t = F.concat(F.lit("see [a]("), "url", F.lit(") and [b](https://x.example/"), F.col("page_id").cast("string"), F.lit(")."))
    return table(spark, sf, "pages").select("page_id", F.posexplode(X.markdown_links(t)).alias("pos", "l")).select("page_id", "pos", "l.url")


# --- whole jobs


@query("k13_repair_stats", on_notes("""
, g AS (SELECT DISTINCT md5(stem)[1:8] AS guid FROM notes WHERE doc_id % 2 = 0)
SELECT count(*) AS scanned, count(guid) AS changed, count(guid) AS converted, count(*) - count(guid) AS unresolved FROM notes LEFT JOIN g ON g.guid = md5(stem)[1:8]"""))
def k13_stats(spark, sf):
    from notegraph.functions import text as X

    n = notes(spark, sf)
    guid = F.concat(F.left(F.md5("stem"), F.lit(8)), F.lit("-0000-1111-2222-333344445555"))
    texts = n.select("rel_path", "stem", F.concat(F.lit("T "), "stem").alias("title"), F.concat(F.lit("[t](https://s/"), guid, F.lit("/) and [u](https://other.example/) end")).alias("body"))
    guids = n.where("doc_id % 2 = 0").select(guid.alias("guid"), F.concat(F.lit("t "), "stem").alias("title"))
    return J.repair_links(texts, guids, X.guid_of)["stats"]


def _part_hubs(spark, sf):
    p = table(spark, sf, "part")
    n = p.select(F.col("p_brand").alias("vault"), F.col("p_name").alias("stem"), F.col("p_type").alias("up"))
    pages = p.where("p_size < 5").select(F.col("p_brand").alias("vault"), F.col("p_type").alias("stem"), F.when(F.col("p_size") == 1, F.col("p_type")).otherwise("gone").alias("up"))
    return n.unionByName(pages).withColumn("rel_path", F.concat("stem", F.lit(".md"))), p.select(F.col("p_brand").alias("vault"), F.col("p_type").alias("hub"))


@query("k9_hub_stubs", """
WITH h AS (SELECT DISTINCT p_brand AS vault, p_type AS hub FROM part),
n AS (SELECT p_brand AS vault, p_name AS stem, p_type AS up FROM part UNION ALL SELECT p_brand, p_type, CASE WHEN p_size = 1 THEN p_type ELSE 'gone' END FROM part WHERE p_size < 5)
SELECT vault, hub, (SELECT count(*) FROM n WHERE n.vault = h.vault AND n.up = h.hub) AS "references", 'created' AS status, '---' || chr(10) || 'type: hub' || chr(10) || 'vault: ' || vault || chr(10) || '---' || chr(10) || '# ' || hub || chr(10) AS stub
FROM h WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.vault = h.vault AND n.stem = h.hub)""")
def k9_stubs(spark, sf):
    return J.audit_hubs(*_part_hubs(spark, sf), apply=True)["missing"]


@query("k9_hub_problems", """
SELECT p_brand AS vault, p_type AS stem, CASE WHEN p_size = 1 THEN p_type ELSE 'gone' END AS up, CASE WHEN p_size = 1 THEN 'self' ELSE 'missing' END AS problem FROM part WHERE p_size < 5""")
def k9_problems(spark, sf):
    return J.audit_hubs(*_part_hubs(spark, sf))["problems"]


@query("k12_migration_log", on_notes("""
, r AS (SELECT rel_path, folder AS stem, CASE vault WHEN 'en' THEN 'business' WHEN 'de' THEN 'personal' WHEN 'fr' THEN 'personal' END AS target FROM notes WHERE doc_id % 5 > 0),
k AS (SELECT *, row_number() OVER (PARTITION BY target, stem ORDER BY rel_path) AS k FROM r WHERE target IS NOT NULL)
SELECT '## 2024-02-01 10:00 — migration' AS line UNION ALL SELECT '- `' || rel_path || '` → `' || target || '/' || CASE WHEN k = 1 THEN stem ELSE stem || '_' || k END || '` (to ' || target || ')' FROM k"""))
def k12_log(spark, sf):
    n = notes(spark, sf).select("rel_path", F.col("folder").alias("stem"), "vault", "doc_id")
    context = F.when(F.col("vault") == "en", "work").when(F.col("vault") == "de", "personal").when(F.col("vault") == "fr", "education")
    none = n.where("false").select(F.lit("").alias("target"), "stem")
    return J.migrate(n, none, context, F.col("doc_id") % 5 > 0, F.lit("2024-02-01 10:00"))["log"]


@query("k6_topic_fields", """
WITH o AS (SELECT CAST(o_custkey AS VARCHAR) AS slug, CAST(o_orderkey AS VARCHAR) AS k, o_orderdate AS d, CASE WHEN o_totalprice > 100000 THEN 1 ELSE 0 END AS q, o_orderkey % 3 AS a, o_totalprice AS p FROM orders)
SELECT slug, 'active' AS status, list('[[T ' || k || ']]' ORDER BY d DESC, a + q DESC, k) AS sources, 'sha256:' || slug AS source_set_hash,
 round(least(count(*) / 3.0, 1.0) * 0.5 + 0.5 * (avg(CAST(q AS DOUBLE)) + avg(a / 2.0)) / 2, 6) AS confidence, count(*) % 2 = 0 AS prompt_degraded, '2024-02-01' AS updated FROM o GROUP BY slug""")
def k6_fields(spark, sf):
    o = table(spark, sf, "orders")
    words = lambda n: F.slice(F.array(*map(F.lit, "abc")), 1, n.cast("int"))
    s = o.select(F.col("o_custkey").cast("string").alias("slug"), F.col("o_orderkey").cast("string").alias("rel_path"), F.concat(F.lit("T "), F.col("o_orderkey").cast("string")).alias("title"), F.col("o_orderdate").alias("mtime"), words(F.col("o_orderkey") % 3).alias("aliases"), words(F.when(F.col("o_totalprice") > 100000, 1).otherwise(0)).alias("quotes"))
    n = s.groupBy("slug").agg(F.count("*").alias("n"))
    out = J.source_fields(s, n.select("slug", F.concat(F.lit("sha256:"), "slug").alias("set_hash")), n.select("slug", (F.col("n") % 2 == 0).alias("degraded")), F.lit("2024-02-01"))
    return out.select("fields.*")


@query("a17_keyed_upsert", """
SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'second' ELSE c_mktsegment END AS segment, CASE WHEN c_custkey % 7 = 0 THEN -c_acctbal ELSE c_acctbal END AS balance FROM customer""")
def a17_keyed(spark, sf):
    from notegraph.session import scratch_path
    from notegraph.sources.buckets import KeyedTable

    c = table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    kept = KeyedTable(spark, scratch_path(spark, "customers"), "c_custkey", 16)
    kept.upsert(c.where("c_custkey % 7 < 6"), batch="1")
    later = c.where("c_custkey % 7 in (0, 6)")
    some = F.col("c_custkey") % 7 == 0
    later = later.select("c_custkey", F.when(some, "second").otherwise(F.col("segment")).alias("segment"), F.when(some, -F.col("balance")).otherwise(F.col("balance")).alias("balance"))
    for _ in range(2):  # the replay changes nothing
        kept.upsert(later, batch="2")
    return kept.read()


# --- sources and sinks that write and read files, in the shared folder


@query("a9_json_sources", "SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer WHERE c_nationkey % 5 <> 3")
def a9(spark, sf):
    """A JSON document per nation; those of some nations are broken and give no rows."""
    from notegraph.session import scratch_path
    from notegraph.sources.notes import read_json

    path = scratch_path(spark, "json")
    rows = F.to_json(F.collect_list(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))))
    docs = table(spark, sf, "customer").groupBy("c_nationkey").agg(rows.alias("value"))
    docs = docs.withColumn("value", F.when(F.col("c_nationkey") % 5 == 3, F.concat(F.lit("[{"), "value")).otherwise(F.col("value")))
    docs.write.partitionBy("c_nationkey").text(path)
    return read_json(spark, path, "id long, name string, balance double").select("id", "name", "balance")


@query("a18_append_log", """
SELECT strftime(ts, '%Y-%m-%d') || ' ' || event_type || ' ' || count(*) AS line FROM events WHERE event_type <> 'view' GROUP BY strftime(ts, '%Y-%m-%d'), event_type
UNION ALL SELECT strftime(ts, '%Y-%m-%d') || ' ' || count(*) FROM events GROUP BY strftime(ts, '%Y-%m-%d')""")
def a18(spark, sf):
    from notegraph.session import scratch_path
    from notegraph.sources.sinks import append_log

    path = scratch_path(spark, "log")
    e = table(spark, sf, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    append_log(e.where("event_type <> 'view'").groupBy("day", "event_type").count().select(F.concat_ws(" ", "day", "event_type", F.col("count").cast("string")).alias("line")), path)
    append_log(e.groupBy("day").count().select(F.concat_ws(" ", "day", F.col("count").cast("string")).alias("line")), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query("a24_ledger_file", """
SELECT event_type || ':' || user_id AS key, round(count(*) * 0.05, 6) AS evidence, count(*) AS seen_count, ['a:' || event_type, 'u:' || user_id] AS distinct_anchors, strftime(max(ts), '%Y-%m-%d') AS last_seen, 'sig' AS signature, CASE WHEN count(*) > 3 THEN 's' || user_id END AS slug, count(*) > 3 AS proposed FROM events GROUP BY event_type, user_id""")
def a24(spark, sf):
    """Written twice, read back, and read back once more after a broken one was set aside."""
    from notegraph.session import scratch_path

    n = F.count("*")
    user = F.col("user_id").cast("string")
    state = table(spark, sf, "events").groupBy("event_type", "user_id").agg(n.alias("seen_count"), F.date_format(F.max("ts"), "yyyy-MM-dd").alias("last_seen"))
    state = state.select(
        F.concat("event_type", F.lit(":"), user).alias("key"), F.round(F.col("seen_count") * 0.05, 6).alias("evidence"), "seen_count", F.array(F.concat(F.lit("a:"), "event_type"), F.concat(F.lit("u:"), user)).alias("distinct_anchors"),
        "last_seen", F.lit("sig").alias("signature"), F.when(F.col("seen_count") > 3, F.concat(F.lit("s"), user)).alias("slug"), (F.col("seen_count") > 3).alias("proposed"),
    )
    path = scratch_path(spark, "ledger")
    J.save_ledger(state.where("not proposed"), path)
    J.save_ledger(state, path)
    return J.load_ledger(spark, path)


@query("i1_classify_stream", SQL["k1_classify_rules"])
def i1(spark, sf):
    """Notes arrive in two parts; each is classified once by a stream that is started for each part."""
    from notegraph.plans.pipelines import classify_rules
    from notegraph.session import scratch_path
    from notegraph.streaming.incremental import classify_stream

    n = notes(spark, sf)
    path = scratch_path(spark, "stream")
    schema = ", ".join(f"{k} {t}" for k, t in n.dtypes)
    for k in range(2):
        n.where(F.col("doc_id") % 2 == k).write.mode("append").parquet(f"{path}/in")
        classify_stream(spark, f"{path}/in", schema, lambda d: classify_rules(d, k1_rules()), f"{path}/out", f"{path}/at").awaitTermination()
    out = spark.read.parquet(f"{path}/out")
    return out.select("rel_path", "type", "org", "confidence")


@query("i6_progress_metrics", "SELECT count(*) AS rows, count(*) FILTER (WHERE doc_id % 3 = 0) AS done FROM documents")
def i6(spark, sf):
    """The counters that the micro-batches of a stream over the documents report, added up."""
    from notegraph.session import scratch_path
    from notegraph.streaming.incremental import progress

    d = table(spark, sf, "documents")
    src = spark.readStream.schema(d.schema).parquet(f"{sf}/documents.parquet*")
    at = scratch_path(spark, "progress")
    q = progress(src, "seen", F.col("doc_id") % 3 == 0).writeStream.format("noop").option("checkpointLocation", at).trigger(availableNow=True).start()
    q.awaitTermination()
    seen = [p.observedMetrics["seen"] for p in q.recentProgress if "seen" in p.observedMetrics]
    return spark.createDataFrame([(sum(r["rows"] for r in seen), sum(r["done"] for r in seen))], "rows long, done long")
