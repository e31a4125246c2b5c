"""The registered note-corpus queries, each beside the DuckDB SQL that it is checked with."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notegraph.functions import text as X
from notegraph.operators import aggregates as A
from notegraph.operators import clusters as C
from notegraph.operators import filters as P
from notegraph.operators import joins as J
from notegraph.operators import sets as S
from notegraph.operators import windows as N
from notegraph.session import materialize
from notegraph.sources.notes import NOTES_SQL, allowed, notes_from_documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Keyword tables of the queries: words that the documents hold. Operators take such tables as parameters.
KEYWORDS = {"license": ["license", "licensed", "rights reserved"], "insult": ["idiot", "stupid", "trash", "moron", "loser"], "mail": ["@", "mail"], "web": ["http", "www."]}
WORK = {"license": 2.0, "version": 1.0, "mail": 1.5}
PERSONAL = {"idiot": 1.0, "stupid": 2.0, "loser": 0.5}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def on_notes(body: str) -> str:
    return f"WITH {NOTES_SQL} {body}"


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def notes(spark, sf):
    return notes_from_documents(table(spark, sf, "documents"))


def sql_sum(words: dict[str, float], text: str = "body") -> str:
    return " + ".join(f"CASE WHEN contains(lower({text}), '{w}') THEN {x} ELSE 0.0 END" for w, x in words.items())


def fold_sql(x: str) -> str:
    """`fold` for texts whose letters beyond ASCII are those of Latin-1."""
    out = f"replace(lower({x}), 'ß', 'ss')"
    for mark in "’‘‛`":
        out = f"replace({out}, '{mark}', chr(39))"
    for c in map(chr, range(0xE0, 0x100)):
        if (d := unicodedata.normalize("NFKD", c)) != c:
            out = f"replace({out}, '{c}', '{d}')"
    return out


#: Sentences of a body as a list, in DuckDB.
SENTENCES_SQL = r"list_filter(list_transform(regexp_extract_all(trim(regexp_replace(body, '[ \t\n\r\v\f]+', ' ', 'g')), '[^.!?]+(?:[.!?]|$)'), lambda s: trim(s)), lambda s: s <> '')"


# --- sources


@query("a1_scan_policy", on_notes("""
SELECT rel_path,
  NOT regexp_matches(rel_path, '(^|/)\\.') AND split_part(rel_path, '/', 1) <> 'wiki' AND NOT starts_with(rel_path, 'Personal-backup') AND file_name <> 'classification-review.md' AS classify,
  NOT regexp_matches(rel_path, '(^|/)\\.') AND split_part(rel_path, '/', 1) <> 'wiki' AND NOT starts_with(rel_path, 'Personal-backup') AS source,
  NOT regexp_matches(rel_path, '(^|/)\\.') AND NOT regexp_matches(rel_path, '(^|/)_resources(/|$)') AS audit
FROM (SELECT * REPLACE (CASE doc_id % 5 WHEN 0 THEN 'wiki/' WHEN 1 THEN '.trash/' WHEN 2 THEN '_resources/' ELSE '' END || rel_path AS rel_path) FROM notes)"""))
def a1(spark, sf):
    prefix = F.when(F.col("doc_id") % 5 == 0, "wiki/").when(F.col("doc_id") % 5 == 1, ".trash/").when(F.col("doc_id") % 5 == 2, "_resources/").otherwise("")
    n = notes(spark, sf).withColumn("rel_path", F.concat(prefix, "rel_path"))
    return n.select("rel_path", *[allowed(F.col("rel_path"), p).alias(p) for p in ("classify", "source", "audit")])


@query("a6_header_lines", on_notes("""
SELECT rel_path, 'T' || doc_id AS title, folder AS notebook, sha256(body) AS body_sha FROM notes"""))
def a6(spark, sf):
    n = notes(spark, sf)
    raw = F.concat(F.lit('---\ntitle: "T'), F.col("doc_id").cast("string"), F.lit('"\nnotebook: '), "folder", F.lit("\n---\n"), "body")
    n = n.withColumn("raw", raw)
    return n.select("rel_path", X.header_field(F.col("raw"), "title").alias("title"), X.header_field(F.col("raw"), "notebook").alias("notebook"), F.sha2(X.strip_header(F.col("raw")), 256).alias("body_sha"))


@query("a15_deletion_rows", on_notes("""
SELECT rel_path AS path, length(trim(body, chr(32) || chr(9) || chr(10) || chr(13) || chr(11) || chr(12))) AS stripped_body_chars,
  left(regexp_replace(trim(body, chr(32) || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)), '[ \\t\\n\\r\\v\\f]+', ' ', 'g'), 50) AS body_preview, 'run1' AS run_id
FROM notes WHERE length(trim(regexp_replace(body, '[*_#>\\[\\]()\\\\\\n\\t]', '', 'g'), chr(32) || chr(9) || chr(10) || chr(13) || chr(11) || chr(12))) < 60"""))
def a15(spark, sf):
    n = notes(spark, sf).where(X.tiny_body(F.col("body"), 60))
    return A.deletions_of(n, X.strip(F.col("body")), "run1")


@query("a16_review_queue", on_notes("""
SELECT '| ' || rel_path || ' | ' || vault || ' | ' || folder || ' | ' || printf('%.2f', (doc_id % 80) / 100.0) || ' | ' || CASE WHEN title = '' THEN 'n/a' ELSE title END || ' |' AS line
FROM notes"""))
def a16(spark, sf):
    n = notes(spark, sf)
    return n.select(X.md_row(F.col("rel_path"), F.col("vault"), F.col("folder"), F.format_string("%.2f", (F.col("doc_id") % 80) / 100.0), F.col("title")).alias("line"))


@query("a11_read_review_queue", on_notes("""
SELECT rel_path AS path, vault AS type, folder AS org, CAST(printf('%.2f', (doc_id % 100) / 100.0) AS DOUBLE) AS confidence, stem AS reason FROM notes"""))
def a11(spark, sf):
    from notegraph.sources.notes import read_review_queue

    n = notes(spark, sf)
    line = X.md_row(F.col("rel_path"), F.col("vault"), F.col("folder"), F.format_string("%.2f", (F.col("doc_id") % 100) / 100.0), F.col("stem"))
    head = spark.createDataFrame([("# Review",), ("Generated: now",), ("| Path | Type | Org | Confidence | Reason |",), ("|---|---|---|---|---|",)], "value string")
    return read_review_queue(head.unionByName(n.select(line.alias("value"))))


@query("a12_read_run_log", """
SELECT event_type AS decision, 'u' || user_id AS path, CASE WHEN event_id % 2 = 0 THEN 'note' END AS type FROM events""")
def a12(spark, sf):
    from notegraph.sources.notes import read_run_log

    e = table(spark, sf, "events")
    line = F.concat_ws("\t", "event_type", F.concat(F.lit("u"), F.col("user_id").cast("string")), F.when(F.col("event_id") % 2 == 0, "-> note"))
    return read_run_log(e.select(line.alias("value")))


@query("a17_upsert_lines", on_notes("""
SELECT stem AS slug, CASE WHEN doc_id % 6 = 0 THEN 'a newer ' || title WHEN doc_id % 3 = 0 THEN 'new ' || title ELSE title END AS line FROM notes
UNION ALL SELECT 'x' || CAST(item_id AS VARCHAR), text FROM benchmark"""))
def a17(spark, sf):
    from notegraph.sources.sinks import upsert_lines

    n = notes(spark, sf)
    index = n.select(F.col("stem").alias("slug"), F.col("title").alias("line"))
    update = lambda k, at, word: n.where(F.col("doc_id") % k == 0).select(F.col("stem").alias("slug"), F.concat(F.lit(word), "title").alias("line"), F.lit(at).alias("at"))
    more = table(spark, sf, "benchmark").select(F.concat(F.lit("x"), F.col("item_id").cast("string")).alias("slug"), F.col("text").alias("line"), F.lit(0).alias("at"))
    return upsert_lines(index, update(3, 1, "new ").unionByName(update(6, 2, "a newer ")).unionByName(more), order="at")


@query("a19_insert_if_absent", """
WITH p AS (SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN lower(p_brand) ELSE replace(lower(p_brand), '#', '-') END AS slug FROM part), x AS (SELECT slug FROM p GROUP BY 1 HAVING count(*) % 2 = 0)
SELECT p_partkey, slug, CASE WHEN NOT regexp_full_match(slug, '[a-z0-9-]+') THEN 'unsafe' WHEN slug IN (SELECT slug FROM x) OR row_number() OVER (PARTITION BY slug ORDER BY p_partkey) > 1 THEN 'skipped' ELSE 'created' END AS outcome FROM p""")
def a19(spark, sf):
    from notegraph.sources.sinks import insert_plan

    brand = F.lower("p_brand")
    p = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_size") % 5 == 0, brand).otherwise(F.replace(brand, F.lit("#"), F.lit("-"))).alias("slug"))
    return insert_plan(p, p.groupBy("slug").count().where(F.col("count") % 2 == 0), order="p_partkey")


@query("a14_merge_fields", on_notes("""
SELECT rel_path, CASE WHEN doc_id % 2 = 0 THEN 'new' ELSE vault END AS type, folder AS org, CASE WHEN doc_id % 2 = 0 THEN 'yes' END AS reviewed FROM notes"""))
def a14(spark, sf):
    from notegraph.sources.sinks import merge_fields

    n = notes(spark, sf)
    old = n.select("rel_path", F.create_map(F.lit("type"), F.col("vault"), F.lit("org"), F.col("folder")).alias("fields"))
    new = n.where(F.col("doc_id") % 2 == 0).select("rel_path", F.create_map(F.lit("type"), F.lit("new"), F.lit("reviewed"), F.lit("yes")).alias("fields"))
    m = merge_fields(old, new)
    return m.select("rel_path", *[F.col("fields")[k].alias(k) for k in ("type", "org", "reviewed")])


# --- filters and scalar functions


@query("b1_is_classified", """
SELECT count(*) AS n, count(*) FILTER (WHERE d.source <> '' AND d.lang <> '' AND l.quality IS NOT NULL AND l.toxic IS NOT NULL AND NOT (l.quality = 0)) AS classified
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def b1(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    by = F.when(F.col("quality") == 0, "export")
    done = P.is_classified(F.col("source"), F.col("lang"), F.col("quality").cast("string"), F.col("toxic").cast("string"), by)
    return d.agg(F.count("*").alias("n"), F.count_if(done).alias("classified"))


@query("b3_empty_or_tiny", on_notes("""
SELECT rel_path, length(trim(body, chr(32) || chr(9) || chr(10) || chr(13) || chr(11) || chr(12))) = 0 AS empty,
 length(trim(regexp_replace(body, '[*_#>\\[\\]()\\\\\\n\\t]', '', 'g'), chr(32) || chr(9) || chr(10) || chr(13) || chr(11) || chr(12))) < 30 AS tiny FROM notes"""))
def b3(spark, sf):
    return notes(spark, sf).select("rel_path", P.is_empty_note(F.col("body")).alias("empty"), X.tiny_body(F.col("body")).alias("tiny"))


@query("b5_body_shape", """
WITH b AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN '![a](b.png)' WHEN 1 THEN ' ' || url || ' ' WHEN 2 THEN '![doc.pdf](x)' ELSE html END AS body FROM pages),
t AS (SELECT page_id, trim(body, chr(32) || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)) AS t FROM b)
SELECT page_id, CASE WHEN regexp_full_match(t, '(?i)!\\[[^\\]]*\\.pdf[^\\]]*\\]\\([^)]+\\)') THEN 'pdf' WHEN regexp_full_match(t, '!\\[[^\\]]*\\]\\([^)]+\\)') THEN 'image'
 WHEN regexp_full_match(t, '<?https?://\\S+>?') THEN 'url' END AS shape FROM t""")
def b5(spark, sf):
    p = table(spark, sf, "pages")
    body = F.when(F.col("page_id") % 4 == 0, "![a](b.png)").when(F.col("page_id") % 4 == 1, F.concat(F.lit(" "), "url", F.lit(" "))).when(F.col("page_id") % 4 == 2, "![doc.pdf](x)").otherwise(F.col("html"))
    return p.select("page_id", X.body_shape(body).alias("shape"))


@query("b6_field_filters", on_notes("SELECT rel_path FROM notes WHERE vault = 'en' AND folder = 'src3'"))
def b6(spark, sf):
    return P.field_filters(notes(spark, sf), ["vault=en", "folder=src3"]).select("rel_path")


@query("b7_exclude_globs", on_notes("SELECT rel_path FROM notes WHERE NOT (rel_path GLOB 'src1/*' OR file_name GLOB 'doc?5.md')"))
def b7(spark, sf):
    return P.exclude_globs(notes(spark, sf), ["src1/*", "doc?5.md"]).select("rel_path")


@query("b8_note_time", on_notes("""
SELECT rel_path, CASE WHEN doc_id % 3 = 0 THEN TIMESTAMP '2024-03-05 00:00:00' WHEN doc_id % 3 = 1 THEN TIMESTAMP '2024-02-01 10:30:00' ELSE mtime END AS t FROM notes"""))
def b8(spark, sf):
    n = notes(spark, sf)
    updated = F.when(F.col("doc_id") % 3 == 0, "2024-03-05").otherwise("soon")
    created = F.when(F.col("doc_id") % 3 == 1, "2024-02-01T10:30:00")
    t = X.note_time(updated, created).cast("timestamp_ntz")
    return n.select("rel_path", F.coalesce(t, "mtime").alias("t"))


@query("b9_recent", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 10 DAY")
def b9(spark, sf):
    return P.recent(table(spark, sf, "events"), F.lit("2024-01-30 00:00:00").cast("timestamp"), 10, "ts").select("event_id")


@query("b10_conflict_copies", on_notes("""
SELECT rel_path, ends_with(f, '.icloud') OR contains(lower(f), 'conflicted copy') OR regexp_matches(f, ' \\d+\\.md$') AS conflict
FROM (SELECT rel_path, CASE doc_id % 4 WHEN 0 THEN stem || ' 2.md' WHEN 1 THEN stem || ' (Conflicted copy).md' WHEN 2 THEN file_name || '.icloud' ELSE file_name END AS f FROM notes)"""))
def b10(spark, sf):
    n = notes(spark, sf)
    k = F.col("doc_id") % 4
    name = F.when(k == 0, F.concat("stem", F.lit(" 2.md"))).when(k == 1, F.concat("stem", F.lit(" (Conflicted copy).md"))).when(k == 2, F.concat("file_name", F.lit(".icloud"))).otherwise(F.col("file_name"))
    return n.select("rel_path", P.is_conflict_copy(name).alias("conflict"))


@query("b13_provisional", on_notes("SELECT rel_path, 'export' AS classified_by FROM notes WHERE doc_id % 2 = 0 AND doc_id % 3 <> 0"))
def b13(spark, sf):
    n = notes(spark, sf).withColumn("export_id", F.when(F.col("doc_id") % 2 == 0, F.col("stem"))).withColumn("classified_by", F.when(F.col("doc_id") % 3 == 0, "rules"))
    return P.provisional(n).select("rel_path", "classified_by")


@query("b14_route_by_context", """
SELECT route, count(*) AS n FROM (SELECT CASE WHEN l.doc_id IS NULL THEN 'skipped' WHEN d.lang = 'en' THEN 'business' WHEN d.lang IN ('de', 'fr') THEN 'personal' ELSE 'skipped' END AS route
 FROM documents d LEFT JOIN labels l USING (doc_id)) GROUP BY route""")
def b14(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    context = F.when(F.col("lang") == "en", "work").when(F.col("lang") == "de", "personal").when(F.col("lang") == "fr", "education").otherwise("other")
    return d.groupBy(P.route_by_context(context, F.col("quality").isNotNull()).alias("route")).agg(F.count("*").alias("n"))


@query("b15_apply_decisions", on_notes("""
SELECT status, count(*) AS n FROM (SELECT CASE WHEN vault = 'en' AND folder <> 'src1' THEN 'moved' WHEN vault = 'de' AND folder <> 'src2' THEN 'moved' ELSE 'skipped' END AS status FROM notes) GROUP BY status"""))
def b15(spark, sf):
    return notes(spark, sf).groupBy(P.decision_status(F.col("vault"), F.col("folder"), {"en": "src1", "de": "src2"}).alias("status")).agg(F.count("*").alias("n"))


@query("b16_path_inside", on_notes("""
SELECT p AS path, CASE WHEN trim(p) = '' THEN 'empty' WHEN starts_with(p, '/') OR starts_with(p, '../') OR contains(p, '/../../') THEN 'outside' END AS error
FROM (SELECT CASE doc_id % 5 WHEN 0 THEN '../' || rel_path WHEN 1 THEN '/' || rel_path WHEN 2 THEN ' ' WHEN 3 THEN folder || '/../../' || file_name ELSE folder || '/../' || rel_path END AS p FROM notes)"""))
def b16(spark, sf):
    n = notes(spark, sf)
    k = F.col("doc_id") % 5
    p = F.when(k == 0, F.concat(F.lit("../"), "rel_path")).when(k == 1, F.concat(F.lit("/"), "rel_path")).when(k == 2, F.lit(" ")).when(k == 3, F.concat("folder", F.lit("/../../"), "file_name")).otherwise(F.concat("folder", F.lit("/../"), "rel_path"))
    return n.select(p.alias("path")).select("path", P.path_inside(F.col("path")).alias("error"))


@query("b17_valid_labels", on_notes("""
SELECT rel_path, vault AS type, folder AS org, CASE WHEN folder = 'src1' THEN 'work' ELSE 'personal' END AS context, '[[' || upper(vault) || ']]' AS up, CAST(1.0 AS DOUBLE) AS confidence, 'manual' AS classified_by
FROM notes WHERE vault IN ('en', 'de') AND folder IN ('src1', 'src2')"""))
def b17(spark, sf):
    n = notes(spark, sf).select("rel_path", F.col("vault").alias("type"), F.col("folder").alias("org"))
    hubs = spark.createDataFrame([("en", "[[EN]]"), ("de", "[[DE]]")], "type string, up string")
    return P.valid_labels(n, hubs, ["src1", "src2"], ["src1"])


@query("b18_confidence_band", "SELECT band, count(*) AS n FROM (SELECT CASE WHEN l_discount * 10 >= 0.8 THEN 'high' WHEN l_discount * 10 >= 0.5 THEN 'medium' ELSE 'low' END AS band FROM lineitem) GROUP BY band")
def b18(spark, sf):
    return table(spark, sf, "lineitem").groupBy(X.confidence_band(F.col("l_discount") * 10).alias("band")).agg(F.count("*").alias("n"))


@query("b19_context", on_notes(f"""
SELECT rel_path, CASE WHEN folder = 'src1' THEN 'work' WHEN folder = 'src2' THEN 'work' WHEN ({sql_sum(WORK)}) > ({sql_sum(PERSONAL)}) THEN 'work' ELSE 'personal' END AS context FROM notes"""))
def b19(spark, sf):
    low = F.lower("body")
    return notes(spark, sf).select("rel_path", P.context_of(F.col("folder"), X.keyword_weight(low, WORK), X.keyword_weight(low, PERSONAL), ["src1", "src2"]).alias("context"))


@query("b20_excerpt", on_notes("SELECT rel_path, CASE WHEN length(body) > 220 THEN left(body, 220) || '...' ELSE body END AS excerpt FROM notes"))
def b20(spark, sf):
    return notes(spark, sf).select("rel_path", X.excerpt(F.col("body"), 220).alias("excerpt"))


@query("d1_keyword_hits", on_notes("SELECT rel_path, " + ", ".join(f"{' + '.join(f'''CASE WHEN contains(lower(body), '{w}') THEN 1 ELSE 0 END''' for w in ws)} AS {k}" for k, ws in KEYWORDS.items()) + " FROM notes"))
def d1(spark, sf):
    n = notes(spark, sf).select("rel_path", X.keyword_hits(F.lower("body"), KEYWORDS).alias("h"))
    return n.select("rel_path", *[F.col("h")[k].alias(k) for k in KEYWORDS])


@query("d2_keyword_weights", on_notes(f"SELECT rel_path, CAST({sql_sum(WORK)} AS DOUBLE) AS work, CAST({sql_sum(PERSONAL)} AS DOUBLE) AS personal FROM notes"))
def d2(spark, sf):
    low = F.lower("body")
    return notes(spark, sf).select("rel_path", X.keyword_weight(low, WORK).alias("work"), X.keyword_weight(low, PERSONAL).alias("personal"))


def _hits(k: str) -> str:
    return " + ".join(f"CASE WHEN contains(lower(body), '{w}') THEN 1 ELSE 0 END" for w in KEYWORDS[k])


@query("d3_best_category", on_notes(f"""
, h AS (SELECT rel_path, {', '.join(f'{_hits(k)} AS {k}' for k in KEYWORDS)} FROM notes)
SELECT rel_path, CASE WHEN greatest({', '.join(KEYWORDS)}) = 0 THEN NULL {' '.join(f"WHEN {k} = greatest({', '.join(KEYWORDS)}) THEN '{k}'" for k in KEYWORDS)} END AS best,
 CASE WHEN {' + '.join(KEYWORDS)} = 0 THEN 0.0 ELSE greatest({', '.join(KEYWORDS)}) / ({' + '.join(KEYWORDS)}) END AS share FROM h"""))
def d3(spark, sf):
    h = notes(spark, sf).select("rel_path", X.keyword_hits(F.lower("body"), KEYWORDS).alias("h"))
    return h.select("rel_path", X.argmax_first(F.col("h"), list(KEYWORDS)).alias("best"), X.top_share(F.col("h")).alias("share"))


@query("k1_classify_rules", on_notes(f"""
, h AS (SELECT rel_path, title, folder, {', '.join(f'{_hits(k)} AS {k}' for k in KEYWORDS)} FROM notes),
b AS (SELECT *, greatest({', '.join(KEYWORDS)}) AS top, {' + '.join(KEYWORDS)} AS total FROM h),
t AS (SELECT *, CASE WHEN regexp_matches(title, '^The ') THEN 'article' WHEN regexp_matches(title, '(?i)^of ') THEN 'fragment' END AS ruled,
  CASE WHEN top = 0 THEN NULL {' '.join(f"WHEN {k} = top THEN '{k}'" for k in KEYWORDS)} END AS best FROM b)
SELECT rel_path, coalesce(ruled, best, 'note') AS type, CASE WHEN folder IN ('src1', 'src2') THEN folder ELSE 'Personal' END AS org,
 least(CASE WHEN folder IN ('src1', 'src2') THEN 0.95 ELSE 0.0 END, CASE WHEN ruled IS NOT NULL THEN 0.95 WHEN top >= 2 THEN top / total WHEN top = 1 THEN 0.5 ELSE 0.0 END) AS confidence FROM t"""))
def k1(spark, sf):
    from notegraph.plans.pipelines import classify_rules

    return classify_rules(notes(spark, sf), k1_rules()).select("rel_path", "type", "org", "confidence")


def k1_rules():
    from notegraph.plans.pipelines import Rules

    return Rules(types=KEYWORDS, orgs={"src1": ["\u0001src1"], "src2": ["\u0001src2"]}, titles=[("^The ", "article"), ("(?i)^of ", "fragment")], folders=["src1", "src2"], work_orgs=["src1"], work=WORK, personal=PERSONAL, tags={})


@query("d5_classify_binary", on_notes(f"""
, t AS (SELECT rel_path, CASE WHEN doc_id % 4 = 0 THEN 'Version of an idiot' ELSE title END || ' ' || body AS t FROM notes),
s AS (SELECT rel_path, {sql_sum(WORK, 't')} AS w, {sql_sum(PERSONAL, 't')} AS p FROM t)
SELECT rel_path, CASE WHEN w + p = 0 THEN 'Uncertain' WHEN w > p THEN 'Work' ELSE 'Personal' END AS predicted,
 CASE WHEN w + p = 0 THEN 0.0 ELSE round(least(1.0, abs(w / (w + p) - 0.5) * 2), 9) END AS confidence FROM s"""))
def d5(spark, sf):
    from notegraph.plans.pipelines import classify_binary

    n = notes(spark, sf).withColumn("title", F.when(F.col("doc_id") % 4 == 0, "Version of an idiot").otherwise(F.col("title")))
    return classify_binary(n, WORK, PERSONAL).select("rel_path", "predicted", F.round("confidence", 9).alias("confidence"))


@query("f6_first_rule", on_notes("""
SELECT rel_path, CASE WHEN regexp_matches(title, '^The ') THEN 'the' WHEN regexp_matches(title, 'tion') THEN 'tion' WHEN regexp_matches(title, '\\d') THEN 'digit' END AS label FROM notes"""))
def f6(spark, sf):
    return notes(spark, sf).select("rel_path", X.first_rule(F.col("title"), [("^The ", "the"), ("tion", "tion"), (r"\d", "digit")]).alias("label"))


@query("h2_tokens", on_notes("SELECT rel_path, len(list_distinct(regexp_extract_all(lower(body), '[a-z0-9]{3,}'))) AS n_tokens FROM notes"))
def h2(spark, sf):
    return notes(spark, sf).select("rel_path", F.size(X.tokens(F.col("body"))).cast("long").alias("n_tokens"))


@query("h4_slugify", on_notes("SELECT rel_path, trim(regexp_replace(replace(lower(title), '''', ''), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM notes"))
def h4(spark, sf):
    return notes(spark, sf).select("rel_path", X.slugify_plain(F.col("title")).alias("slug"))


@query("h5_sentences", on_notes(f"""
, s AS (SELECT rel_path, {SENTENCES_SQL} AS l FROM (SELECT rel_path, body || '.. And so? Wait...' AS body FROM notes))
SELECT rel_path, len(l) AS n_sentences, sha256(array_to_string(l, chr(10))) AS digest FROM s"""))
def h5(spark, sf):
    n = notes(spark, sf).select("rel_path", X.sentences(F.concat("body", F.lit(".. And so? Wait..."))).alias("s"))
    return n.select("rel_path", F.size("s").cast("long").alias("n_sentences"), F.sha2(F.array_join("s", "\n"), 256).alias("digest"))


@query("h6_people", on_notes(f"""
, f AS (SELECT rel_path, unnest(regexp_extract_all(regexp_replace(body, '[À-ÖØ-öø-ɏ]', '_', 'g'), '\\b([A-Z][a-z]+(?:\\s+[A-Z][a-z]+)+)\\b', 1)) AS p FROM notes)
SELECT rel_path, count(DISTINCT p) AS n_people, min(p) AS first_person FROM f WHERE NOT regexp_matches(p, '\\b({'|'.join(X.CALENDAR)})\\b') GROUP BY rel_path"""))
def h6(spark, sf):
    n = notes(spark, sf).select("rel_path", X.people(F.col("body")).alias("p")).where(F.size("p") > 0)
    return n.select("rel_path", F.size("p").cast("long").alias("n_people"), F.array_min("p").alias("first_person"))


@query("h7_tags", on_notes("SELECT rel_path, list_filter([" + ", ".join(f"CASE WHEN {' OR '.join(f'''contains(lower(body), '{w}')''' for w in ws)} THEN '{k}' END" for k, ws in KEYWORDS.items()) + "], lambda t: t IS NOT NULL) AS tags FROM notes"))
def h7(spark, sf):
    return notes(spark, sf).select("rel_path", X.tags(F.lower("body"), KEYWORDS).alias("tags"))


@query("h14_normalise_title", on_notes("SELECT rel_path, lower(trim(regexp_replace(title, '[ \\t\\n\\r\\v\\f]+', ' ', 'g'))) AS t FROM notes"))
def h14(spark, sf):
    return notes(spark, sf).select("rel_path", X.normalise_title(F.col("title")).alias("t"))


@query("h10_strip_h1", on_notes("SELECT rel_path, sha256(CASE WHEN doc_id % 3 = 2 THEN '# ' || title || ' x' || chr(10) || chr(10) || body ELSE body END) AS digest FROM notes"))
def h10(spark, sf):
    n = notes(spark, sf)
    k = F.col("doc_id") % 3
    stem = F.when(k == 0, F.concat(F.lit("2024-01-02 "), "stem")).otherwise(F.col("stem"))
    head = F.when(k == 2, F.concat("title", F.lit(" x"))).otherwise(F.col("stem"))
    text = F.concat(F.lit("# "), head, F.lit("\n\n"), "body")
    return n.select("rel_path", F.sha2(X.strip_matching_h1(text, stem), 256).alias("digest"))


@query("h21_citations", """
WITH t AS (SELECT conv_id, turn, text || ' (src: B' || turn || ', B' || (turn + 1) || ')' AS text FROM conversations)
SELECT conv_id, turn, [turn, turn + 1] AS refs, turn >= 1 AND turn + 1 <= 4 AS ok FROM t""")
def h21(spark, sf):
    c = table(spark, sf, "conversations")
    t = F.concat("text", F.lit(" (src: B"), F.col("turn").cast("string"), F.lit(", B"), (F.col("turn") + 1).cast("string"), F.lit(")"))
    return c.select("conv_id", "turn", F.transform(X.cited(t), lambda r: r.cast("long")).alias("refs"), X.verified(t, F.lit(4)).alias("ok"))


@query("h26_deep_link", on_notes("SELECT rel_path, 'app://open?vault=' || url_encode(vault) || '&file=' || url_encode(folder || ' ä/' || file_name) AS link FROM notes"))
def h26(spark, sf):
    return notes(spark, sf).select("rel_path", X.deep_link(F.col("vault"), F.concat("folder", F.lit(" ä/"), "file_name")).alias("link"))


@query("h12_guids", "SELECT page_id, lower(md5(url)[1:8] || '-' || md5(url)[9:12] || '-' || md5(url)[13:16] || '-' || md5(url)[17:20] || '-' || md5(url)[21:32]) AS guid FROM pages")
def h12(spark, sf):
    h = F.md5("url")
    at = lambda i, n: F.substring(h, i, n)
    g = F.concat_ws("-", at(1, 8), at(9, 4), at(13, 4), at(17, 4), at(21, 12))
    return table(spark, sf, "pages").select("page_id", X.guid_of(F.concat(F.lit("https://x/"), F.upper(g), F.lit("/y"))).alias("guid"))


@query("h28_replace_region", on_notes("SELECT rel_path, sha256(CASE doc_id % 2 WHEN 0 THEN body || CASE WHEN body = '' OR ends_with(body, chr(10)) THEN '' ELSE chr(10) END ELSE 'a' || chr(10) END || '<!-- r:begin -->' || chr(10) || title || chr(10) || '<!-- r:end -->' || CASE doc_id % 2 WHEN 0 THEN chr(10) ELSE 'b' END) AS digest FROM notes"))
def h28(spark, sf):
    text = F.when(F.col("doc_id") % 2 == 0, F.col("body")).otherwise(F.lit("a\n<!-- r:begin -->\nold\n<!-- r:end -->b"))
    return notes(spark, sf).select("rel_path", F.sha2(X.replace_region(text, F.col("title"), "r"), 256).alias("digest"))


@query("h33_scores", """
SELECT l_orderkey, l_linenumber, round(pow(0.1 + 0.9 * l_discount, 0.4) * pow(0.1 + 0.9 * l_tax, 0.35) * pow(0.1 + 0.9 * CASE WHEN l_linenumber <= 1 THEN 0.0 ELSE least(1.0, ln(l_linenumber) / ln(6)) END, 0.25), 6) AS confidence FROM lineitem""")
def h33(spark, sf):
    c = X.cluster_confidence(F.col("l_discount"), F.col("l_tax"), F.col("l_linenumber"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.round(c, 6).alias("confidence"))


@query("h35_decay", "SELECT event_id, round(abs(value) * pow(0.5, greatest(date_diff('day', CAST(ts AS DATE), DATE '2024-01-20'), 0) / 30.0), 6) AS evidence FROM events")
def h35(spark, sf):
    days = F.datediff(F.lit("2024-01-20").cast("date"), F.col("ts").cast("date")).cast("double")
    return table(spark, sf, "events").select("event_id", F.round(X.decay(F.abs("value"), days), 6).alias("evidence"))


@query("h36_signature", """
SELECT p_brand, 'sig:' || left(sha256(string_agg(DISTINCT p_type, chr(0) ORDER BY p_type) || chr(0) || p_brand), 16) AS signature FROM part GROUP BY p_brand""")
def h36(spark, sf):
    g = table(spark, sf, "part").groupBy("p_brand").agg(F.collect_set("p_type").alias("m"))
    return g.select("p_brand", X.cluster_signature(F.col("m"), F.col("p_brand")).alias("signature"))


@query("h1_fold", on_notes(f"SELECT rel_path, {fold_sql('title')} AS folded FROM notes"))
def h1(spark, sf):
    return notes(spark, sf).select("rel_path", X.fold(F.col("title")).alias("folded"))


# --- joins


def alias_table(spark, sf):
    """A topic per benchmark item, its whole text as aliases of three words each: (slug, alias, alias_pos).

    The last alias begins three words before the end, so each word is in one.
    """
    b = table(spark, sf, "benchmark").select("item_id", F.split(F.regexp_replace(X.fold("text"), r"[ \t\n\r\x0B\f]+", " "), " ").alias("w"))
    starts = F.transform(F.sequence(F.lit(0), F.floor((F.size("w") - 1) / 3).cast("int")), lambda i: F.greatest(F.lit(0), F.least(3 * i, F.size("w") - 3)))
    b = b.select("item_id", "w", F.posexplode(starts).alias("alias_pos", "at"))
    alias = F.regexp_replace(F.array_join(F.slice("w", F.col("at") + 1, 3), " "), r"^[^\p{L}\p{N}_]+|[^\p{L}\p{N}_]+$", "")
    return b.select(F.concat(F.lit("t"), F.col("item_id").cast("string")).alias("slug"), alias.alias("alias"), "alias_pos").where("alias <> ''")


def mark_sql(x: str) -> str:
    """A text with a mark before and behind each word, so that it contains only whole words of another."""
    return f"regexp_replace({x}, '([\\p{{L}}\\p{{N}}_]+)', chr(1) || '\\1' || chr(2), 'g')"


#: The same in DuckDB, and which notes have which alias: ``m (slug, rel_path, alias_pos, alias)``.
ALIAS_SQL = f"""bw AS (SELECT item_id, string_split(regexp_replace({fold_sql('text')}, '[ \\t\\n\\r\\v\\f]+', ' ', 'g'), ' ') AS w FROM benchmark),
bs AS (SELECT item_id, w, unnest(range(0, (len(w) - 1) // 3 + 1)) AS alias_pos FROM bw),
ba AS (SELECT item_id, alias_pos, regexp_replace(array_to_string(list_slice(w, greatest(0, least(3 * alias_pos, len(w) - 3)) + 1, greatest(0, least(3 * alias_pos, len(w) - 3)) + 3), ' '), '^[^\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_]+$', '', 'g') AS alias FROM bs),
t AS MATERIALIZED (SELECT 't' || item_id AS slug, alias, alias_pos, {mark_sql('alias')} AS marked_alias FROM ba WHERE alias <> ''),
marked AS MATERIALIZED (SELECT rel_path, {mark_sql(fold_sql("file_name || chr(10) || body"))} AS marked FROM notes),
m AS MATERIALIZED (SELECT DISTINCT slug, rel_path, alias_pos, alias FROM marked JOIN t ON contains(marked, marked_alias))"""


def folded_notes(spark, sf):
    return notes(spark, sf).withColumn("folded", X.fold(F.concat_ws("\n", "file_name", "body")))


@query("c1_match_topics", on_notes(f"""
, {ALIAS_SQL} SELECT slug, rel_path, list(alias ORDER BY alias_pos) AS aliases FROM m GROUP BY 1, 2"""))
def c1(spark, sf):
    return J.match_topics(folded_notes(spark, sf), alias_table(spark, sf))


def copies(spark, sf):
    """Notes of equal text named as numbered copies of the first: the others get ``.2``, ``.3``..."""
    from pyspark.sql import Window as W

    n = notes(spark, sf)
    sha = F.md5("body")
    by = W.partitionBy("vault", sha)
    n = n.withColumn("least", F.min("doc_id").over(by)).withColumn("rn", F.row_number().over(by.orderBy("doc_id")))
    stem = F.concat(F.lit("doc"), F.col("least").cast("string"), F.when(F.col("rn") > 1, F.concat(F.lit("."), F.col("rn").cast("string"))).otherwise(""))
    return n.select("doc_id", "vault", "folder", "title", "mtime", "body", F.concat(F.lit("all/"), stem, F.lit(".md")).alias("rel_path"), stem.alias("stem"))


COPIES_SQL = f"""WITH {NOTES_SQL}, r AS (SELECT *, min(doc_id) OVER (PARTITION BY vault, md5(body)) AS least, row_number() OVER (PARTITION BY vault, md5(body) ORDER BY doc_id) AS rn FROM notes),
copies AS (SELECT vault, body, least, rn, 'all/doc' || least || CASE WHEN rn > 1 THEN '.' || rn ELSE '' END || '.md' AS rel_path FROM r) """


@query("c3_numbered_pairs", COPIES_SQL + "SELECT vault, rel_path AS copy, 'all/doc' || least || '.md' AS base FROM copies WHERE rn > 1")
def c3(spark, sf):
    return J.numbered_pairs(copies(spark, sf))


@query("c4_exact_copies", COPIES_SQL + "SELECT vault, rel_path AS copy, 'all/doc' || least || '.md' AS base FROM copies WHERE rn > 1")
def c4(spark, sf):
    return J.exact_copies(copies(spark, sf))


@query("c5_orphan_copies", COPIES_SQL + "SELECT vault, rel_path FROM copies WHERE rn > 1 AND least % 2 = 0")
def c5(spark, sf):
    n = copies(spark, sf)
    least = F.regexp_extract("rel_path", r"doc(\d+)", 1).cast("long")
    return J.orphan_copies(n.where(F.col("rel_path").rlike(J.NUMBERED) | (least % 2 == 1)))


@query("c24_similar_numbered")
def c24(spark, sf):
    n = copies(spark, sf)
    # the copies lose their last sentence, so that all tiers occur
    cut = F.regexp_replace("body", r"[^.]*\.?\s*$", "")
    return J.similar_numbered(n.withColumn("body", F.when(F.col("rel_path").rlike(r"\.3\.md$"), cut).otherwise(F.col("body"))))


@query("c6_title_lookup", on_notes("SELECT title, arg_max(stem, rel_path) AS stem FROM notes GROUP BY title"))
def c6(spark, sf):
    return J.title_lookup(notes(spark, sf))


@query("c7_fallback_titles", on_notes("""
, k AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN title WHEN 1 THEN lower(title) ELSE '  ' || replace(title, ' ', '  ') END AS title FROM notes),
e AS (SELECT title AS k, max(stem) AS s FROM notes GROUP BY 1), l AS (SELECT lower(title) AS k, max(stem) AS s FROM notes GROUP BY 1),
n AS (SELECT lower(trim(regexp_replace(title, '[ \\t\\n\\r\\v\\f]+', ' ', 'g'))) AS k, max(stem) AS s FROM notes GROUP BY 1)
SELECT k.doc_id, coalesce(e.s, l.s, n.s) AS target, CASE WHEN e.s IS NOT NULL THEN 'exact' WHEN l.s IS NOT NULL THEN 'lower' WHEN n.s IS NOT NULL THEN 'normal' END AS tier
FROM k LEFT JOIN e ON k.title = e.k LEFT JOIN l ON lower(k.title) = l.k LEFT JOIN n ON lower(trim(regexp_replace(k.title, '[ \\t\\n\\r\\v\\f]+', ' ', 'g'))) = n.k"""))
def c7(spark, sf):
    n = notes(spark, sf)
    k = F.col("doc_id") % 3
    keys = n.select("doc_id", F.when(k == 0, F.col("title")).when(k == 1, F.lower("title")).otherwise(F.concat(F.lit("  "), F.replace("title", F.lit(" "), F.lit("  ")))).alias("title"))
    return J.resolve_by_fallback(keys, n.select("title", "stem")).select("doc_id", "target", "tier")


@query("c8_rewrite_links", """
WITH p AS (SELECT page_id, url, '[l' || page_id || '](' || url || ') and [other](https://nowhere.example/' || page_id || ') end' AS body FROM pages),
t AS (SELECT url, 'n' || min(page_id) AS target FROM pages WHERE page_id % 2 = 0 GROUP BY url)
SELECT CAST(p.page_id AS VARCHAR) AS rel_path, sha256(CASE WHEN t.url IS NULL THEN body ELSE '[[' || target || '|l' || page_id || ']] and [other](https://nowhere.example/' || page_id || ') end' END) AS digest,
 CASE WHEN t.url IS NULL THEN 0 ELSE 1 END AS resolved, CASE WHEN t.url IS NULL THEN 2 ELSE 1 END AS unresolved FROM p LEFT JOIN t USING (url)""")
def c8(spark, sf):
    p = table(spark, sf, "pages")
    pid = F.col("page_id").cast("string")
    n = p.select(pid.alias("rel_path"), F.concat(F.lit("[l"), pid, F.lit("]("), "url", F.lit(") and [other](https://nowhere.example/"), pid, F.lit(") end")).alias("body"))
    t = p.where("page_id % 2 = 0").groupBy("url").agg(F.concat(F.lit("n"), F.min("page_id").cast("string")).alias("target"))
    return J.rewrite_links(n, t).select("rel_path", F.sha2("body", 256).alias("digest"), F.col("resolved").cast("int").alias("resolved"), F.col("unresolved").cast("int").alias("unresolved"))


@query("c9_relink", on_notes("""
SELECT rel_path, title AS target, CASE WHEN t.new IS NULL THEN title ELSE t.new END AS new_target, t.new IS NOT NULL AS changed
FROM notes LEFT JOIN (SELECT title AS old, 'N-' || min(stem) AS new FROM notes WHERE doc_id % 2 = 0 GROUP BY title) t ON t.old = regexp_replace(notes.title, '\\.md$', '')"""))
def c9(spark, sf):
    n = notes(spark, sf)
    renames = n.where("doc_id % 2 = 0").groupBy(F.col("title").alias("old")).agg(F.concat(F.lit("N-"), F.min("stem")).alias("new"))
    return J.relink_renamed(n.select("rel_path", F.col("title").alias("target")), renames)


@query("c10_orphan_parents", on_notes("""
, u AS (SELECT vault, rel_path, folder, CASE doc_id % 3 WHEN 0 THEN 'doc' || (doc_id + 1) WHEN 1 THEN folder || '/' || stem END AS up FROM notes),
h AS (SELECT DISTINCT vault, rel_path FROM notes)
SELECT vault, rel_path, up FROM u WHERE up IS NOT NULL AND NOT EXISTS (SELECT 1 FROM h WHERE h.vault = u.vault AND h.rel_path = u.up || '.md') AND NOT EXISTS (SELECT 1 FROM h WHERE h.vault = u.vault AND h.rel_path = u.folder || '/' || u.up || '.md')"""))
def c10(spark, sf):
    k = F.col("doc_id") % 3
    up = F.when(k == 0, F.concat(F.lit("doc"), (F.col("doc_id") + 1).cast("string"))).when(k == 1, F.concat("folder", F.lit("/"), "stem"))
    return J.orphan_parents(notes(spark, sf).withColumn("up", up))


@query("c11_dangling_refs", on_notes("SELECT vault, slug, count(*) AS n FROM (SELECT vault, unnest([folder, 'src' || (doc_id % 40)]) AS slug FROM notes) WHERE slug NOT IN (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL) GROUP BY 1, 2"))
def c11(spark, sf):
    n = notes(spark, sf)
    refs = n.select("vault", "rel_path", F.explode(F.array("folder", F.concat(F.lit("src"), (F.col("doc_id") % 40).cast("string")))).alias("slug"))
    topics = n.select(F.col("folder").alias("slug"))
    return J.dangling_refs(refs, topics, ["slug"]).groupBy("vault", "slug").agg(F.count("*").alias("n"))


@query("c12_missing_hubs", """
WITH h AS (SELECT DISTINCT p_type AS hub FROM part), pg AS (SELECT DISTINCT p_type AS hub FROM part WHERE p_size > 48), r AS (SELECT p_type AS hub, count(*) AS n FROM part WHERE p_size < 3 GROUP BY 1)
SELECT h.hub, coalesce(n, 0) AS "references", CASE WHEN coalesce(n, 0) > 0 THEN 'referenced' ELSE 'unused' END AS status FROM h LEFT JOIN r USING (hub) WHERE h.hub NOT IN (SELECT hub FROM pg)""")
def c12(spark, sf):
    p = table(spark, sf, "part")
    return J.missing_hubs(p.select(F.col("p_type").alias("hub")), p.where("p_size > 48").select(F.col("p_type").alias("stem")), p.where("p_size < 3").select(F.col("p_type").alias("hub")))


@query("c13_lint_hubs", "SELECT c_name AS stem, up, CASE WHEN up = c_name THEN 'self' ELSE 'missing' END AS problem FROM (SELECT c_name, CASE WHEN c_custkey % 3 = 0 THEN c_name WHEN c_custkey % 3 = 1 THEN 'x' || c_name END AS up FROM customer) WHERE up IS NOT NULL")
def c13(spark, sf):
    k = F.col("c_custkey") % 3
    return J.lint_hubs(table(spark, sf, "customer").select(F.col("c_name").alias("stem"), F.when(k == 0, F.col("c_name")).when(k == 1, F.concat(F.lit("x"), "c_name")).alias("up")))


@query("c14_hub_for_type", "SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN '[[Homes]]' WHEN 'MACHINERY' THEN '[[Work]]' ELSE '[[Personal]]' END AS up FROM customer")
def c14(spark, sf):
    hubs = spark.createDataFrame([("BUILDING", "[[Homes]]"), ("MACHINERY", "[[Work]]")], "type string, up string")
    return J.hub_for_type(table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("type")), hubs).select("c_custkey", "up")


@query("c15_freshness", """
WITH t AS (SELECT DISTINCT c_custkey FROM customer), s AS (SELECT o_custkey, count(*) AS n, max(o_orderstatus) AS h FROM orders GROUP BY 1)
SELECT CAST(c_custkey AS VARCHAR) AS slug, coalesce(n, 0) AS n_sources, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'F' <> h END AS hash_changed FROM t LEFT JOIN s ON o_custkey = c_custkey""")
def c15(spark, sf):
    t = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("slug"), F.lit(None).cast("string").alias("updated"), F.when(F.col("c_custkey") % 4 != 0, "F").alias("source_set_hash"))
    s = table(spark, sf, "orders").groupBy(F.col("o_custkey").cast("string").alias("slug")).agg(F.count("*").alias("n_sources"), F.max("o_orderstatus").alias("set_hash"))
    return J.topic_freshness(t, s).drop("updated")


@query("c16_desired_backlinks", "SELECT CAST(l_orderkey AS VARCHAR) AS rel_path, list_sort(list(DISTINCT l_returnflag || l_linestatus)) AS desired FROM lineitem GROUP BY 1")
def c16(spark, sf):
    return J.desired_backlinks(table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("rel_path"), F.concat("l_returnflag", "l_linestatus").alias("slug")))


@query("c17_reconcile_backlinks", on_notes("""
SELECT rel_path, CASE doc_id % 3 WHEN 0 THEN ['mine', 'b'] WHEN 1 THEN ['mine'] ELSE ['b'] END AS topics, CASE doc_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 1 ELSE 0 END AS removed, CASE doc_id % 3 WHEN 2 THEN 'skipped' ELSE 'updated' END AS status FROM notes"""))
def c17(spark, sf):
    n = notes(spark, sf)
    k = F.col("doc_id") % 3
    arr = lambda *x: F.array(*map(F.lit, x))
    have = n.select("rel_path", F.when(k == 0, arr("mine", "a")).when(k == 1, arr("a", "mine")).otherwise(arr("b")).alias("topics"))
    want = n.where(k != 1).select("rel_path", arr("b").alias("desired"))
    return J.reconcile_backlinks(have, want, spark.createDataFrame([("a",), ("b",)], "slug string"))


@query("c18_anchor_edges", """
WITH a AS (SELECT DISTINCT l_partkey || '/' || l_suppkey AS anchor, l_orderkey AS node FROM lineitem)
SELECT DISTINCT x.node AS src, y.node AS dst FROM a x JOIN a y ON x.anchor = y.anchor AND x.node < y.node""")
def c18(spark, sf):
    anchor = F.concat_ws("/", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"))
    return J.anchor_edges(table(spark, sf, "lineitem").select(anchor.alias("anchor"), F.col("l_orderkey").alias("node")).distinct())


@query("c21_pending_reviews", "SELECT 'd' || d.doc_id AS path, d.lang FROM documents d WHERE d.doc_id NOT IN (SELECT doc_id FROM labels)")
def c21(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    n = d.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("rel_path"), "quality", "lang")
    return J.pending_reviews(n.select(F.col("rel_path").alias("path"), "lang"), n, F.col("quality").isNotNull())[0]


# one proposal after the other, with what is taken so far
@query("c19_resolve_collisions", """
WITH RECURSIVE p AS (SELECT row_number() OVER (ORDER BY p_partkey) AS i, p_partkey AS pos, lower(p_brand) || p_size % 7 AS slug, [p_type, 'SIZE ' || p_size] AS aliases FROM part),
g AS (SELECT CAST(0 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS pos, '' AS slug, CAST([] AS VARCHAR[]) AS won, ['brand#111'] AS slugs, ['size 7'] AS keys
 UNION ALL SELECT i, pos, slug, won, CASE WHEN len(won) > 0 THEN list_append(slugs, slug) ELSE slugs END, list_concat(keys, list_transform(won, lambda a: lower(a)))
 FROM (SELECT p.i, p.pos, p.slug, g.slugs, g.keys, CASE WHEN list_contains(g.slugs, p.slug) THEN CAST([] AS VARCHAR[]) ELSE list_filter(p.aliases, lambda a: NOT list_contains(g.keys, lower(a))) END AS won FROM g JOIN p ON p.i = g.i + 1))
SELECT pos, slug, won AS aliases FROM g WHERE len(won) > 0""")
def c19(spark, sf):
    slug = F.concat(F.lower("p_brand"), (F.col("p_size") % 7).cast("string"))
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("pos"), slug.alias("slug"), F.array("p_type", F.concat(F.lit("SIZE "), F.col("p_size").cast("string"))).alias("aliases"))
    return J.resolve_collisions(p, spark.createDataFrame([("brand#111",)], "slug string"), spark.createDataFrame([("Size 7",)], "alias string"))


# --- aggregations, windows, sets


@query("d6_idf", on_notes("""
, t AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(body), '[a-z0-9]{3,}')) AS token FROM notes)
SELECT token, round(ln(((SELECT count(*) FROM notes) + 1) / (count(*) + 1)) + 1, 6) AS idf FROM t GROUP BY token"""))
def d6(spark, sf):
    refs = notes(spark, sf).select(F.col("doc_id").alias("node"), X.tokens(F.col("body")).alias("tokens"))
    return C.idf(refs).select("token", F.round("idf", 6).alias("idf"))


@query("d7_weighted_jaccard", on_notes("""
, t AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(body), '[a-z0-9]{3,}')) AS token FROM notes),
w AS (SELECT token, ln(((SELECT count(*) FROM notes) + 1) / (count(*) + 1)) + 1 AS idf FROM t GROUP BY token),
s AS (SELECT doc_id, sum(idf) AS w FROM t JOIN w USING (token) GROUP BY 1),
c AS (SELECT x.doc_id AS src, y.doc_id AS dst, sum(idf) AS shared FROM t x JOIN t y ON y.doc_id = x.doc_id + 1 AND x.token = y.token JOIN w ON w.token = x.token GROUP BY 1, 2),
p AS (SELECT doc_id AS src, doc_id + 1 AS dst FROM notes WHERE doc_id + 1 IN (SELECT doc_id FROM notes))
SELECT src, dst, round(CASE WHEN coalesce(a.w, 0) + coalesce(b.w, 0) - coalesce(shared, 0) > 0 THEN coalesce(shared, 0) / (coalesce(a.w, 0) + coalesce(b.w, 0) - coalesce(shared, 0)) ELSE 0 END, 6) AS similarity
FROM p LEFT JOIN c USING (src, dst) LEFT JOIN s a ON a.doc_id = src LEFT JOIN s b ON b.doc_id = dst"""))
def d7(spark, sf):
    refs = materialize(notes(spark, sf).select(F.col("doc_id").alias("node"), X.tokens(F.col("body")).alias("tokens")), "tokens")
    ids = refs.select("node")
    pairs = ids.select(F.col("node").alias("src"), (F.col("node") + 1).alias("dst")).join(ids.select(F.col("node").alias("dst")), "dst").select("src", "dst")
    return C.weighted_jaccard(pairs, refs, materialize(C.idf(refs), "weights")).select("src", "dst", F.round("similarity", 6).alias("similarity"))


def order_graph(spark, sf):
    """Orders and the parts in them, parts below zero: a bipartite graph over the whole table."""
    return table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("src"), (-F.col("l_partkey")).alias("dst")).distinct()


# labels of all nodes, round by round; each round takes the neighbours' smallest label, far more often than the graph is wide
@query("d9_components", """
WITH RECURSIVE g AS MATERIALIZED (SELECT DISTINCT l_orderkey AS a, -l_partkey AS b FROM lineitem), e AS MATERIALIZED (SELECT a, b FROM g UNION ALL SELECT b, a FROM g),
l AS (SELECT DISTINCT a AS node, a AS component, 0 AS i FROM e
 UNION ALL (SELECT node, min(c) AS component, max(i) + 1 FROM (SELECT node, component AS c, i FROM l WHERE i < 40 UNION ALL SELECT e.a, component, i FROM l JOIN e ON e.b = l.node WHERE i < 40) GROUP BY node))
SELECT node, component FROM l WHERE i = (SELECT max(i) FROM l)""")
def d9(spark, sf):
    return C.components(order_graph(spark, sf))


# every note has one anchor, so a cluster is all notes of an anchor
@query("d12_cluster_notes", """
WITH p AS (SELECT p_partkey AS node, 'tag:' || p_brand || '/' || p_size AS anchor, list_distinct(regexp_extract_all(lower(p_name || ' ' || p_type), '[a-z0-9]{3,}')) AS tokens FROM part),
t AS (SELECT node, unnest(tokens) AS token FROM p), w AS (SELECT token, ln(((SELECT count(*) FROM p) + 1) / (count(*) + 1)) + 1 AS idf FROM t GROUP BY 1),
g AS (SELECT anchor, min(node) AS cluster, count(*) AS n, 'sig:' || left(sha256(string_agg(CAST(node AS VARCHAR), chr(0) ORDER BY CAST(node AS VARCHAR)) || chr(0) || anchor), 16) AS signature FROM p GROUP BY 1 HAVING count(*) >= 3),
x AS (SELECT a.anchor, a.node AS a, b.node AS b, (SELECT sum(idf) FROM w WHERE list_contains(a.tokens, w.token) AND list_contains(b.tokens, w.token)) AS i, (SELECT sum(idf) FROM w WHERE list_contains(a.tokens, w.token) OR list_contains(b.tokens, w.token)) AS u FROM p a JOIN p b ON a.anchor = b.anchor AND a.node < b.node),
c AS (SELECT anchor, avg(coalesce(i, 0) / u) AS cohesion FROM x GROUP BY 1)
SELECT cluster, n, [anchor] AS anchors, anchor AS dominant_anchor, 1.0 AS dominant_share, 1.0 AS anchor_density, round(cohesion, 6) AS cohesion, signature,
 round(pow(0.1 + 0.9 * cohesion, 0.35) * pow(0.1 + 0.9 * least(1.0, ln(n) / ln(6)), 0.25), 6) AS confidence, CASE WHEN pow(0.1 + 0.9 * cohesion, 0.35) * pow(0.1 + 0.9 * least(1.0, ln(n) / ln(6)), 0.25) >= 0.35 THEN 'propose' ELSE 'ledger' END AS route FROM g JOIN c USING (anchor)""")
def d12(spark, sf):
    """Parts as notes: brand and size as anchor, the words of name and type as tokens."""
    p = table(spark, sf, "part")
    a = C.anchors(F.array().cast("array<string>"), F.array(F.concat_ws("/", "p_brand", F.col("p_size").cast("string"))), F.lit(None).cast("string"), [], [])
    refs = p.select(F.col("p_partkey").alias("node"), a.alias("anchors"), X.tokens(F.concat_ws(" ", "p_name", "p_type")).alias("tokens"))
    return C.cluster_notes(refs).withColumns({c: F.round(c, 6) for c in ("cohesion", "confidence")})


@query("d13_dedup_by_body", on_notes("""
, r AS (SELECT sha256(body) AS body_sha, rel_path, count(*) OVER (PARTITION BY body) AS copies, row_number() OVER (PARTITION BY body ORDER BY regexp_matches(rel_path, '\\.\\d+\\.md$'), length(rel_path), rel_path) AS rn FROM notes)
SELECT body_sha, rel_path, copies FROM r WHERE rn = 1"""))
def d13(spark, sf):
    return A.dedup_by_body(notes(spark, sf))


@query("d14_set_hash", on_notes("""
, l AS (SELECT vault, sha256(rel_path || chr(0) || sha256(body)) AS l FROM notes),
p AS (SELECT vault, left(l, 2) AS p, count(*) AS n, sha256(string_agg(l, chr(10) ORDER BY l)) AS d FROM l GROUP BY 1, 2),
t AS (SELECT vault, sha256(string_agg(d, chr(10) ORDER BY p)) AS tree_hash FROM p GROUP BY vault)
SELECT vault, count(*) AS n_sources, 'sha256:' || sha256(string_agg(rel_path || chr(0) || sha256(body) || chr(10), '' ORDER BY rel_path)) AS set_hash, any_value(tree_hash) AS tree_hash FROM notes JOIN t USING (vault) GROUP BY vault"""))
def d14(spark, sf):
    n = notes(spark, sf).withColumn("body_sha", F.sha2("body", 256))
    return A.source_set_hash(n, ["vault"]).join(A.source_tree_hash(n, ["vault"]).select("vault", F.col("set_hash").alias("tree_hash")), "vault")


@query("d15_source_quality", """
WITH s AS (SELECT o_custkey, count(*) AS n, avg(CASE WHEN o_totalprice > 100000 THEN 1.0 ELSE 0.0 END) AS q, avg(least(o_orderkey % 4, 2) / 2.0) AS a FROM orders GROUP BY 1)
SELECT o_custkey AS slug, n, round((q + a) / 2, 6) AS quality, round(CASE WHEN n <= 0 THEN 0 ELSE least(n / 3.0, 1.0) * 0.5 + 0.5 * greatest(0.0, least(1.0, (q + a) / 2)) END, 6) AS confidence FROM s""")
def d15(spark, sf):
    o = table(spark, sf, "orders")
    few = lambda n: F.transform(F.sequence(F.lit(1), n + 1), lambda x: x.cast("string"))
    s = o.select(F.col("o_custkey").alias("slug"), F.when(F.col("o_totalprice") > 100000, F.array(F.lit("q"))).otherwise(F.array().cast("array<string>")).alias("quotes"), F.slice(few((F.col("o_orderkey") % 4).cast("int")), F.lit(1), (F.col("o_orderkey") % 4).cast("int")).alias("aliases"))
    q = A.source_quality(s)
    return q.select("slug", "n", F.round("quality", 6).alias("quality"), F.round(X.topic_confidence(F.col("n"), F.col("quality")), 6).alias("confidence"))


@query("d17_summary", """
WITH r AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'auto' WHEN 'O' THEN 'review' ELSE 'purged' END AS decision, o_orderkey % 3 = 0 AS by_rules FROM orders)
SELECT count(*) AS processed, count(*) FILTER (WHERE decision = 'auto') AS auto, count(*) FILTER (WHERE decision = 'review') AS review, count(*) FILTER (WHERE decision = 'purged') AS purged, count(*) FILTER (WHERE decision = 'skipped') AS skipped,
 CAST(round_even(100.0 * count(*) FILTER (WHERE by_rules) / count(*), 2) AS DOUBLE) AS rules_pct, CAST(round_even(100.0 * count(*) FILTER (WHERE decision = 'auto') / count(*), 2) AS DOUBLE) AS auto_pct FROM r""")
def d17(spark, sf):
    s = F.col("o_orderstatus")
    r = table(spark, sf, "orders").select(F.when(s == "F", "auto").when(s == "O", "review").otherwise("purged").alias("decision"), (F.col("o_orderkey") % 3 == 0).alias("by_rules"))
    return A.classification_summary(r)


METRICS_SQL = """m AS (SELECT d.lang AS vault, count(*) AS total, count(l.doc_id) AS classified, count(*) - count(l.doc_id) AS unclassified, count(l.doc_id) / count(*) AS ratio, count(*) FILTER (WHERE l.toxic = 1) AS orphans
 FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1)"""


@query("d19_corpus_totals", f"""
WITH {METRICS_SQL} SELECT vault, total, classified, unclassified, ratio, orphans FROM m
UNION ALL SELECT '*', CAST(sum(total) AS BIGINT), CAST(sum(classified) AS BIGINT), CAST(sum(unclassified) AS BIGINT), sum(classified) / sum(total), CAST(sum(orphans) AS BIGINT) FROM m""")
def d19(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left").withColumn("vault", F.col("lang"))
    m = A.vault_metrics(d, F.col("quality").isNotNull(), F.coalesce(F.col("toxic") == 1, F.lit(False)))
    return A.corpus_totals(m)


@query("d21_health", f"""
WITH {METRICS_SQL} SELECT vault, CAST(round_even(CASE WHEN total % 2 = 0 THEN 20.0 ELSE 0.0 END + 35.0 * greatest(0.0, least(1.0, ratio)) + CASE WHEN orphans % 2 = 0 THEN 15.0 ELSE 0.0 END + CASE WHEN unclassified % 3 = 0 THEN 10.0 ELSE 0.0 END
 + CASE WHEN classified % 3 = 0 THEN 10.0 ELSE 0.0 END + CASE WHEN total % 3 = 0 THEN 10.0 ELSE 0.0 END, 0) AS INTEGER) AS score FROM m""")
def d21(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left").withColumn("vault", F.col("lang"))
    m = A.vault_metrics(d, F.col("quality").isNotNull(), F.coalesce(F.col("toxic") == 1, F.lit(False)))
    rest = lambda c, k: F.col(c) % k  # noqa: E731  whole numbers that are zero for some vaults
    return m.select("vault", A.health_score(F.col("ratio"), rest("orphans", 2), rest("unclassified", 3), rest("classified", 3), rest("total", 3), rest("total", 2) == 0).alias("score"))


@query("d22_audit", """
WITH p AS (SELECT CAST(o_orderdate AS DATE) AS run_id, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS chars FROM orders GROUP BY 1) SELECT CAST(run_id AS VARCHAR) AS run_id, n, chars, n / sum(n) OVER () AS share FROM p""")
def d22(spark, sf):
    o = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("run_id"), F.col("o_custkey").alias("chars"))
    return A.audit_deletions(o)


@query("e9_latest_run", "SELECT event_id FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)")
def e9(spark, sf):
    return A.latest_run(table(spark, sf, "events").select("event_id", F.col("ts").cast("date").alias("run_id"))).select("event_id")


@query("e10_progress", """
WITH r AS (SELECT CAST(ts AS DATE) AS run_id, count(*) AS n FROM events GROUP BY 1)
SELECT CAST(run_id AS VARCHAR) AS run_id, n, CAST(sum(n) OVER (ORDER BY run_id) AS BIGINT) AS so_far, sum(n) OVER (ORDER BY run_id) / sum(n) OVER () AS share FROM r""")
def e10(spark, sf):
    r = table(spark, sf, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("run_id")).agg(F.count("*").alias("n"))
    return N.progress(r)


@query("e2_first_quotes", on_notes(f"""
, s AS (SELECT rel_path, vault, generate_subscripts(l, 1) AS i, unnest(l) AS q FROM (SELECT rel_path, vault, {SENTENCES_SQL} AS l FROM notes)),
k AS (SELECT *, row_number() OVER (PARTITION BY rel_path ORDER BY i) AS rn FROM s WHERE regexp_matches({fold_sql('q')}, '(^|[^\\p{{L}}\\p{{N}}_])(en|la\\.|{unicodedata.normalize("NFKD", "ción")})($|[^\\p{{L}}\\p{{N}}_])'))
SELECT rel_path, list(q ORDER BY i) AS quotes FROM k WHERE rn <= 4 GROUP BY rel_path"""))
def e2(spark, sf):
    return N.first_quotes(notes(spark, sf).withColumn("aliases", F.array(F.lit("en"), F.lit("La."), F.lit("CIÓN"))))


@query("e3_rank_sources", """
SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_totalprice DESC, CAST(o_orderkey AS VARCHAR)) AS n FROM orders""")
def e3(spark, sf):
    s = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("slug"), F.col("o_orderdate").alias("mtime"), F.col("o_totalprice").alias("hits"), F.col("o_orderkey").cast("string").alias("rel_path"))
    return N.rank_sources(s).select("o_orderkey", F.col("n").cast("long").alias("n"))


# one file after the other, with the names that its folder has so far
@query("e4_unique_names", on_notes("""
, f AS (SELECT vault, rel_path, folder || CASE doc_id % 7 WHEN 3 THEN '_2' WHEN 5 THEN '_2_2' ELSE '' END AS stem, row_number() OVER (PARTITION BY vault ORDER BY rel_path) AS i, count(*) OVER (PARTITION BY vault) AS n FROM notes),
g AS (SELECT DISTINCT vault, CAST(0 AS BIGINT) AS i, CAST(NULL AS VARCHAR) AS rel_path, CAST(NULL AS VARCHAR) AS new_name, ['src1', 'src1_3', 'src2_2'] AS names FROM f
 UNION ALL SELECT vault, i, rel_path, new_name, list_append(names, new_name) FROM (
  SELECT f.vault, f.i, f.rel_path, g.names, list_filter(list_transform(range(0, f.n + 4), lambda k: CASE WHEN k = 0 THEN f.stem ELSE f.stem || '_' || (k + 1) END), lambda x: NOT list_contains(g.names, x))[1] AS new_name FROM g JOIN f ON f.vault = g.vault AND f.i = g.i + 1))
SELECT rel_path, new_name FROM g WHERE i > 0""").replace("WITH notes", "WITH RECURSIVE notes", 1))
def e4(spark, sf):
    k = F.col("doc_id") % 7
    stem = F.concat("folder", F.when(k == 3, "_2").when(k == 5, "_2_2").otherwise(""))
    n = notes(spark, sf).select("rel_path", F.col("vault").alias("target"), stem.alias("stem"))
    have = n.select("target", F.explode(F.array(*map(F.lit, ("src1", "src1_3", "src2_2")))).alias("stem")).distinct()
    return N.unique_names(n, have).select("rel_path", "new_name")


@query("e5_claim_first", on_notes("SELECT stem AS old, title AS new, CASE WHEN row_number() OVER (PARTITION BY title ORDER BY stem) = 1 THEN 'renamed' ELSE 'collision' END AS status FROM notes"))
def e5(spark, sf):
    return N.claim_first(notes(spark, sf).select(F.col("stem").alias("old"), F.col("title").alias("new")))


@query("e6_first_owner", """
WITH t AS (SELECT lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS rel_path, p_name AS slug, p_brand || p_type || p_size AS alias FROM part),
f AS (SELECT *, min(rel_path) OVER (PARTITION BY slug) AS s, min(rel_path) OVER (PARTITION BY lower(alias)) AS a FROM t)
SELECT rel_path, CASE WHEN max(rel_path > s) THEN 'duplicate slug' WHEN max(rel_path > a) THEN 'duplicate alias' END AS reason FROM f GROUP BY rel_path""")
def e6(spark, sf):
    p = table(spark, sf, "part").select(F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("rel_path"), F.col("p_name").alias("slug"), F.concat("p_brand", "p_type", F.col("p_size").cast("string")).alias("alias"))
    return N.first_owner(p)


@query("e7_top_n", "SELECT c_custkey, CAST(rn AS INTEGER) AS rn FROM (SELECT c_custkey, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS rn FROM customer) WHERE rn <= 20")
def e7(spark, sf):
    return N.top_n_per_group(table(spark, sf, "customer"), 20, "c_mktsegment", F.col("c_acctbal").desc(), "c_custkey").select("c_custkey", "rn")


@query("e8_budget", on_notes("""
, s AS (SELECT rel_path, length(body) AS chars, sum(length(body)) OVER (PARTITION BY folder) AS total, count(*) OVER (PARTITION BY folder) AS n, folder FROM notes),
x AS (SELECT *, sum(least(chars, floor(80000 / 4.0 / n))) OVER (PARTITION BY folder) AS u4, sum(least(chars, floor(80000 / 8.0 / n))) OVER (PARTITION BY folder) AS u8 FROM s)
SELECT rel_path, CAST(CASE WHEN total <= 40000 THEN chars WHEN u4 <= 40000 THEN least(chars, floor(80000 / 4.0 / n)) WHEN u8 <= 40000 THEN least(chars, floor(80000 / 8.0 / n)) ELSE least(chars, floor(80000 / 16.0 / n)) END AS BIGINT) AS allowed, total > 40000 AS degraded FROM x"""))
def e8(spark, sf):
    s = notes(spark, sf).select("rel_path", F.col("folder").alias("slug"), F.length("body").cast("long").alias("chars"))
    return N.budget_sources(s, 80000).select("rel_path", F.col("allowed").cast("long").alias("allowed"), "degraded")


@query("f2_limit_attempts", on_notes("SELECT rel_path FROM notes WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY rel_path LIMIT 50"))
def f2(spark, sf):
    n = notes(spark, sf).join(table(spark, sf, "labels"), "doc_id", "left")
    return P.limit_attempts(n, 50, F.col("quality").isNotNull()).select("rel_path")


@query("f3_sample", on_notes("SELECT rel_path FROM notes ORDER BY md5('7:' || rel_path), rel_path LIMIT 30"))
def f3(spark, sf):
    return P.sample(notes(spark, sf).select("rel_path"), 30, "rel_path", 7)


@query("g3_link_difference", """
WITH s AS (SELECT l_orderkey, list(DISTINCT l_returnflag) AS a, list(DISTINCT l_linestatus) AS b FROM lineitem GROUP BY 1)
SELECT l_orderkey, list_sort(list_filter(a, lambda x: NOT list_contains(b, x))) AS gone, list_sort(list_distinct(list_concat(a, b))) AS anchors FROM s""")
def g3(spark, sf):
    s = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_returnflag").alias("a"), F.collect_set("l_linestatus").alias("b"))
    return s.select("l_orderkey", S.difference(F.col("a"), F.col("b")).alias("gone"), S.merged(F.col("a"), F.col("b")).alias("anchors"))


@query("i3_ledger_step", """
WITH s AS (SELECT event_type || '-' || (user_id % 50) AS key, count(*) AS n, max(ts) AS last_seen FROM events WHERE ts < TIMESTAMP '2024-01-20' GROUP BY 1),
t AS (SELECT event_type || '-' || (user_id % 50) AS key, count(*) AS n, max(ts) AS last_seen FROM events WHERE ts >= TIMESTAMP '2024-01-20' GROUP BY 1),
m AS (SELECT coalesce(s.key, t.key) AS key, s.key IS NOT NULL AND s.n % 4 = 1 AS was, coalesce(0.05 * s.n * pow(0.5, greatest(epoch(TIMESTAMP '2024-01-30') - epoch(s.last_seen), 0) / 86400 / 30.0), 0.0) + coalesce(0.05 * t.n, 0.0) AS e, coalesce(s.n, 0) + coalesce(t.n, 0) AS seen FROM s FULL JOIN t ON s.key = t.key)
SELECT key, round(e, 6) AS evidence, seen, was OR e >= 1.0 AS promoted, NOT was AND e >= 1.0 AS newly FROM m WHERE was OR e >= 0.1""")
def i3(spark, sf):
    from notegraph.streaming.ledger import ledger_step

    e = table(spark, sf, "events").withColumn("key", F.concat("event_type", F.lit("-"), (F.col("user_id") % 50).cast("string")))
    cut = F.lit("2024-01-20 00:00:00").cast("timestamp")
    agg = lambda d: d.groupBy("key").agg((F.count("*") * 0.05).alias("evidence"), F.count("*").alias("seen"), F.max("ts").alias("last_seen"))
    state = agg(e.where(F.col("ts") < cut)).withColumn("promoted", F.col("seen") % 4 == 1)
    out = ledger_step(state, agg(e.where(F.col("ts") >= cut)), F.lit("2024-01-30 00:00:00").cast("timestamp"))
    return out.select("key", F.round("evidence", 6).alias("evidence"), "seen", "promoted", "newly")


@query("k4_collect_topics", on_notes(f"""
, {ALIAS_SQL},
o AS (SELECT m.slug, rel_path, list(m.alias ORDER BY alias_pos) AS aliases FROM m JOIN notes USING (rel_path) WHERE NOT (ends_with(m.slug, '3') AND folder = 'src2') GROUP BY 1, 2),
k AS MATERIALIZED (SELECT o.*, n.title, n.stem, n.mtime, n.body, sha256(n.body) AS body_sha FROM o JOIN notes n USING (rel_path) QUALIFY row_number() OVER (PARTITION BY slug, body ORDER BY length(rel_path), rel_path) = 1),
s AS (SELECT slug, rel_path, generate_subscripts(l, 1) AS i, unnest(l) AS q FROM (SELECT slug, rel_path, {SENTENCES_SQL} AS l FROM k)),
h AS (SELECT slug, rel_path, i, q, row_number() OVER (PARTITION BY slug, rel_path ORDER BY i) AS rn FROM (SELECT s.slug, rel_path, i, q, {mark_sql(fold_sql('q'))} AS f FROM s) x WHERE EXISTS (SELECT 1 FROM t WHERE t.slug = x.slug AND contains(x.f, t.marked_alias))),
q AS (SELECT slug, rel_path, list(q ORDER BY i) AS quotes FROM h WHERE rn <= 4 GROUP BY 1, 2)
SELECT slug, rel_path, CASE WHEN title = '' THEN stem ELSE title END AS title, mtime, aliases, coalesce(quotes, []) AS quotes, body_sha FROM k LEFT JOIN q USING (slug, rel_path)"""))
def k4(spark, sf):
    from notegraph.plans.pipelines import collect_topics

    exclude = alias_table(spark, sf).where(F.col("slug").endswith("3")).select("slug", F.lit("src2/*").alias("glob")).distinct()
    return collect_topics(notes(spark, sf), alias_table(spark, sf), exclude)[0]
