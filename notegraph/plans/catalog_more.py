"""More registered queries: topics, pages, reports, sets, scalar functions and jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from notegraph.functions import text as X
from notegraph.operators import aggregates as A
from notegraph.operators import clusters as C
from notegraph.operators import joins as J
from notegraph.operators import sets as S
from notegraph.operators import topics as T
from notegraph.operators import windows as N
from notegraph.plans import pipelines as L
from notegraph.plans.catalog import ALIAS_SQL, COPIES_SQL, KEYWORDS, METRICS_SQL, PERSONAL, WORK, _hits, alias_table, copies, fold_sql, folded_notes, notes, on_notes, query, sql_sum, table
from notegraph.streaming import incremental as I

ARR = "array<string>"


@query("a7_load_topics", """
WITH t AS (SELECT lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS rel_path, p_name AS slug, CASE WHEN p_partkey % 7 = 0 THEN 'other' ELSE p_name END AS stem, p_partkey % 5 AS k, p_brand || p_type || p_size AS alias, p_partkey % 11 = 0 AS bad FROM part WHERE p_partkey % 3 <> 0),
s AS (SELECT *, CASE WHEN slug <> stem THEN 'slug is not the file name' WHEN bad THEN 'aliases are no list' END AS reason FROM t),
g AS (SELECT * FROM s WHERE reason IS NULL AND k <> 0), f AS (SELECT *, min(rel_path) OVER (PARTITION BY slug) AS a, min(rel_path) OVER (PARTITION BY lower(alias)) AS b FROM g),
o AS (SELECT rel_path, CASE WHEN rel_path > a THEN 'duplicate slug' WHEN rel_path > b THEN 'duplicate alias' END AS reason FROM f)
SELECT rel_path, 'topic' AS outcome FROM o WHERE reason IS NULL UNION ALL SELECT rel_path, reason FROM o WHERE reason IS NOT NULL UNION ALL SELECT rel_path, reason FROM s WHERE reason IS NOT NULL""")
def a7(spark, sf):
    t, bad = T.load_topics(topic_pages(spark, sf))
    return t.select("rel_path", F.lit("topic").alias("outcome")).unionByName(bad.withColumnRenamed("reason", "outcome"))


def topic_pages(spark, sf):
    k = F.col("p_partkey")
    return table(spark, sf, "part").select(
        F.lpad(k.cast("string"), 9, "0").alias("rel_path"),
        F.when(k % 7 == 0, "other").otherwise(F.col("p_name")).alias("stem"),
        F.when(k % 3 == 0, "note").otherwise("topic").alias("type"),
        F.col("p_name").alias("slug"),
        F.array(F.concat("p_brand", "p_type", F.col("p_size").cast("string"))).alias("aliases"),
        F.when(k % 5 == 0, F.when(k % 2 == 0, "rejected").otherwise("paused")).alias("status"),
        F.when(k % 11 == 0, F.array(F.lit("aliases"))).alias("errors"),
    )


@query("a8_load_rejected", "SELECT DISTINCT p_name AS slug FROM part WHERE p_partkey % 3 <> 0 AND p_partkey % 10 = 0")
def a8(spark, sf):
    return T.load_rejected(topic_pages(spark, sf))


@query("a20_topic_sets_flat", "SELECT o_custkey AS slug, list(o_orderkey ORDER BY o_orderkey) AS sources FROM orders GROUP BY 1")
def a20(spark, sf):
    return table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("slug")).agg(F.array_sort(F.collect_list("o_orderkey")).alias("sources"))


@query("a21_proposer_report", """SELECT '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}' AS value FROM customer""")
def a21(spark, sf):
    return table(spark, sf, "customer").select(F.to_json(F.struct("c_custkey", "c_name")).alias("value"))


@query("b2_already_classified", "SELECT (SELECT count(*) FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)) AS already, (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS todo")
def b2(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    done = F.col("quality").isNotNull()
    return d.agg(F.count_if(done).alias("already"), F.count_if(~done).alias("todo"))


@query("b11_exhaust_files", on_notes("SELECT f AS file_name FROM (SELECT CASE WHEN doc_id % 6 = 0 THEN 'classification-review-' || doc_id || '.html' ELSE file_name END AS f FROM notes) WHERE regexp_matches(f, '^classification-review.*\\.html$')"))
def b11(spark, sf):
    f = F.when(F.col("doc_id") % 6 == 0, F.concat(F.lit("classification-review-"), F.col("doc_id").cast("string"), F.lit(".html"))).otherwise(F.col("file_name"))
    return notes(spark, sf).select(f.alias("file_name")).where(F.col("file_name").rlike(r"^classification-review.*\.html$"))


@query("b12_needs_review", on_notes(f"""
, s AS (SELECT rel_path, {sql_sum(WORK, "title || ' ' || body")} AS w, {sql_sum(PERSONAL, "title || ' ' || body")} AS p, vault FROM notes), l AS (SELECT rel_path, vault, CASE WHEN w + p = 0 THEN 'Uncertain' WHEN w > p THEN 'Work' ELSE 'Personal' END AS predicted FROM s)
SELECT rel_path, predicted FROM l WHERE predicted = 'Uncertain' OR predicted <> CASE WHEN vault = 'en' THEN 'Work' ELSE 'Personal' END"""))
def b12(spark, sf):
    c = L.classify_binary(notes(spark, sf), WORK, PERSONAL)
    return c.where((F.col("predicted") == "Uncertain") | (F.col("predicted") != F.when(F.col("vault") == "en", "Work").otherwise("Personal"))).select("rel_path", "predicted")


@query("b21_legacy_links", on_notes("SELECT rel_path, sha256(replace(body, 'the', 'THE')) AS digest FROM notes WHERE regexp_matches(body, 'the')"))
def b21(spark, sf):
    n = notes(spark, sf).where(F.col("body").rlike("the"))
    return n.select("rel_path", F.sha2(T.replace_parent(F.col("body"), "the", "THE"), 256).alias("digest"))


@query("c2_unmatched_notes", on_notes(f", {ALIAS_SQL} SELECT rel_path FROM notes WHERE rel_path NOT IN (SELECT rel_path FROM m)"))
def c2(spark, sf):
    n = folded_notes(spark, sf)
    return J.unmatched_notes(n, J.match_topics(n, alias_table(spark, sf))).select("rel_path")


@query("c20_drop_rejected", "SELECT p_partkey FROM part WHERE p_brand NOT IN (SELECT p_brand FROM part WHERE p_size = 7)")
def c20(spark, sf):
    p = table(spark, sf, "part")
    return p.join(p.where("p_size = 7").select("p_brand").distinct(), "p_brand", "left_anti").select("p_partkey")


@query("c22_link_whitelist", on_notes("SELECT DISTINCT stem FROM notes WHERE folder IN ('src1', 'src2')"))
def c22(spark, sf):
    return notes(spark, sf).where(F.col("folder").isin("src1", "src2")).select("stem").distinct()


@query("c23_pair_resources", on_notes("SELECT rel_path, CASE WHEN doc_id % 2 = 0 THEN '_resources/' || replace('n ' || stem, ' ', '_') || '.resources' END AS resources FROM notes"))
def c23(spark, sf):
    n = notes(spark, sf).withColumn("stem", F.concat(F.lit("n "), "stem"))
    have = n.where("doc_id % 2 = 0").select(F.concat(F.lit("_resources/"), F.replace("stem", F.lit(" "), F.lit("_")), F.lit(".resources")).alias("path"))
    return J.pair_resources(n, have).select("rel_path", "resources")


def part_graph(spark, sf):
    """Parts of one brand and size are linked through that anchor: (node, anchor)."""
    return table(spark, sf, "part").select(F.col("p_partkey").alias("node"), F.concat_ws("/", "p_brand", F.col("p_size").cast("string")).alias("anchor"))


PART_SQL = "a AS (SELECT p_partkey AS node, p_brand || '/' || p_size AS anchor FROM part), e AS (SELECT DISTINCT x.node AS src, y.node AS dst FROM a x JOIN a y ON x.anchor = y.anchor AND x.node < y.node)"


@query("d8_density", f"""
WITH {PART_SQL}, m AS (SELECT node % 50 AS cluster, node FROM a), s AS (SELECT cluster, count(*) AS n FROM m GROUP BY 1),
i AS (SELECT x.cluster, count(*) AS e FROM e JOIN m x ON x.node = src JOIN m y ON y.node = dst AND x.cluster = y.cluster GROUP BY 1)
SELECT s.cluster, n, round(CASE WHEN n < 2 THEN 0 ELSE coalesce(e, 0) / (n * (n - 1) / 2) END, 9) AS density FROM s LEFT JOIN i USING (cluster)""")
def d8(spark, sf):
    a = part_graph(spark, sf)
    d = C.anchor_density(a, a.select((F.col("node") % 50).alias("cluster"), "node"))
    return d.select("cluster", "n", F.round("density", 9).alias("density"))


@query("d10_dense_core", f"WITH {PART_SQL}, s AS (SELECT min(node) AS cluster, anchor FROM a GROUP BY anchor HAVING count(*) >= 3) SELECT cluster, node, 1.0 AS density FROM a JOIN s USING (anchor)")
def d10(spark, sf):
    a = part_graph(spark, sf)
    return C.dense_core(a, C.components(C.anchor_stars(a)))


@query("d11_cluster_profile", f"""
WITH {PART_SQL}, s AS (SELECT min(node) AS cluster, anchor, count(*) AS n FROM a GROUP BY anchor HAVING count(*) >= 3)
SELECT cluster, n, [anchor] AS anchors, anchor AS dominant_anchor, 1.0 AS dominant_share, 1.0 AS anchor_density FROM s""")
def d11(spark, sf):
    a = part_graph(spark, sf)
    m = C.dense_core(a, C.components(C.anchor_stars(a)))
    refs = table(spark, sf, "part").select(F.col("p_partkey").alias("node"), X.tokens(F.col("p_name")).alias("tokens"))
    return C.cluster_profile(m, a, refs).drop("cohesion", "signature")


@query("d18_vault_metrics", f"WITH {METRICS_SQL} SELECT * FROM m")
def d18(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left").withColumn("vault", F.col("lang"))
    return A.vault_metrics(d, F.col("quality").isNotNull(), F.coalesce(F.col("toxic") == 1, F.lit(False)))


@query("d20_queue_count", on_notes("SELECT count(*) AS n FROM notes"))
def d20(spark, sf):
    n = notes(spark, sf).select(X.md_row(F.col("rel_path"), F.col("vault")).alias("value"))
    head = spark.createDataFrame([("# Review",), ("Generated: now",), ("| Path | Vault |",), ("|---|---|",)], "value string")
    return A.review_queue_count(head.unionByName(n))


@query("d23_numbered_tiers", COPIES_SQL + ", c AS (SELECT rel_path, row_number() OVER (ORDER BY rel_path) AS k FROM copies WHERE rn > 1) SELECT 'near_dup' AS tier, (SELECT count(*) FROM c) AS n, (SELECT list(rel_path ORDER BY rel_path) FROM c WHERE k <= 20) AS first WHERE (SELECT count(*) FROM c) > 0")
def d23(spark, sf):
    return A.tier_report(J.similar_numbered(copies(spark, sf)))


@query("d24_rewrite_stats", on_notes("SELECT count(*) AS scanned, count(*) FILTER (WHERE doc_id % 3 = 0) AS changed, CAST(sum(doc_id % 4) AS BIGINT) AS converted, CAST(sum(doc_id % 5) AS BIGINT) AS unresolved FROM notes"))
def d24(spark, sf):
    n = notes(spark, sf)
    return T.rewrite_stats(n.select((F.col("doc_id") % 3 == 0).alias("changed"), (F.col("doc_id") % 4).alias("resolved"), (F.col("doc_id") % 5).alias("unresolved")))


@query("d25_majority_anchors", """
WITH c AS (SELECT l_orderkey, l_returnflag AS anchor, count(*) AS c FROM lineitem GROUP BY 1, 2), n AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)
SELECT l_orderkey, list_sort(list(anchor) FILTER (WHERE c >= floor((n + 1) / 2))) AS anchors FROM c JOIN n USING (l_orderkey) GROUP BY l_orderkey HAVING count(*) FILTER (WHERE c >= floor((n + 1) / 2)) > 0""")
def d25(spark, sf):
    li = table(spark, sf, "lineitem")
    c = li.groupBy("l_orderkey", F.col("l_returnflag").alias("anchor")).agg(F.count("*").alias("c"))
    return C.majority_anchors(c, li.groupBy("l_orderkey").agg(F.count("*").alias("n")), "l_orderkey")


@query("d26_home_summary", f"""
WITH {METRICS_SQL}, q AS (SELECT lang AS vault, count(*) AS queued FROM documents WHERE n_chars < 500 GROUP BY 1), f AS (SELECT lang AS vault, count(*) AS topics, count(*) FILTER (WHERE doc_id % 3 = 0) AS stale FROM documents WHERE doc_id % 2 = 0 GROUP BY 1)
SELECT vault, ratio, queued, coalesce(topics, 0) AS topics, coalesce(stale, 0) AS stale FROM m LEFT JOIN q USING (vault) LEFT JOIN f USING (vault)""")
def d26(spark, sf):
    d = table(spark, sf, "documents").withColumn("vault", F.col("lang"))
    m = d18(spark, sf)
    q = d.where("n_chars < 500").groupBy("vault").agg(F.count("*").alias("queued"))
    return T.home_summary(m, q, d.where("doc_id % 2 = 0").select("vault", (F.col("doc_id") % 3 == 0).alias("hash_changed")))


@query("d27_report_sections", on_notes("""
, l AS (SELECT vault, CASE doc_id % 2 WHEN 0 THEN 'proposals' ELSE 'ledger' END AS section, '- ' || stem AS line FROM notes),
g AS (SELECT vault, section, string_agg(line, chr(10) ORDER BY line) AS text FROM l GROUP BY 1, 2), v AS (SELECT DISTINCT vault FROM l), s AS (SELECT unnest(['proposals', 'ledger', 'quarantine']) AS section)
SELECT v.vault, s.section, sha256(coalesce(text, 'none')) AS digest FROM v CROSS JOIN s LEFT JOIN g ON g.vault = v.vault AND g.section = s.section"""))
def d27(spark, sf):
    n = notes(spark, sf)
    lines = n.select("vault", F.when(F.col("doc_id") % 2 == 0, "proposals").otherwise("ledger").alias("section"), F.concat(F.lit("- "), "stem").alias("line"))
    return T.report_sections(lines, ["proposals", "ledger", "quarantine"]).select("vault", "section", F.sha2("text", 256).alias("digest"))


@query("d28_run_state", """
WITH s AS (SELECT row_number() OVER (ORDER BY CAST(ts AS DATE)) AS pos, CAST(CAST(ts AS DATE) AS VARCHAR) AS name, CASE WHEN count(*) % 2 = 0 THEN 'failed' ELSE 'done' END AS status FROM events GROUP BY CAST(ts AS DATE))
SELECT pos, name, status, CAST(sum(CASE WHEN status = 'failed' THEN 1 ELSE 0 END) OVER (ORDER BY pos) AS BIGINT) AS failed_so_far FROM s""")
def d28(spark, sf):
    from pyspark.sql import Window as W

    s = table(spark, sf, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("name")).agg(F.when(F.count("*") % 2 == 0, "failed").otherwise("done").alias("status"))
    return A.run_state_rows(s.withColumn("pos", F.row_number().over(W.orderBy("name")).cast("long")))


@query("d29_hub_report", """
WITH h AS (SELECT DISTINCT p_type AS hub FROM part), r AS (SELECT p_type AS hub, count(*) AS n FROM part WHERE p_size < 3 GROUP BY 1)
SELECT '| ' || h.hub || ' | ' || coalesce(n, 0) || ' | ' || CASE WHEN coalesce(n, 0) > 0 THEN 'referenced' ELSE 'unused' END || ' |' AS line FROM h LEFT JOIN r USING (hub)""")
def d29(spark, sf):
    p = table(spark, sf, "part")
    m = J.missing_hubs(p.select(F.col("p_type").alias("hub")), p.where("false").select(F.col("p_type").alias("stem")), p.where("p_size < 3").select(F.col("p_type").alias("hub")))
    return m.select(X.md_row(F.col("hub"), F.col("references").cast("string"), F.col("status")).alias("line"))


@query("e1_prefer_base", on_notes("SELECT rel_path FROM notes QUALIFY row_number() OVER (PARTITION BY body ORDER BY length(rel_path), rel_path) = 1"))
def e1(spark, sf):
    return A.dedup_by_body(notes(spark, sf)).select("rel_path")


@query("f4_top_clusters", "SELECT p_brand, count(*) AS n, min(p_name) AS first FROM part GROUP BY 1 ORDER BY n DESC, first LIMIT 10")
def f4(spark, sf):
    return C.top_clusters(table(spark, sf, "part").groupBy("p_brand").agg(F.count("*").alias("n"), F.min("p_name").alias("first")), 10, "n", "first")


@query("f5_caps", on_notes("SELECT rel_path, left(body, 1500) AS schema_cap, array_to_string(list_slice(string_split(body, ' '), 1, 80), ' ') AS word_cap FROM notes"))
def f5(spark, sf):
    return notes(spark, sf).select("rel_path", F.left("body", F.lit(1500)).alias("schema_cap"), X.first_words(F.col("body"), 80).alias("word_cap"))


@query("f7_first_rows", "SELECT o_orderkey, CAST(rn AS INTEGER) AS rn FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn <= 10")
def f7(spark, sf):
    return N.top_n_per_group(table(spark, sf, "orders"), 10, "o_orderpriority", "o_orderdate", "o_orderkey").select("o_orderkey", "rn")


@query("g1_union_vaults", "SELECT vault, count(*) AS n FROM (SELECT 'docs' AS vault, text FROM documents UNION ALL SELECT 'bench', text FROM benchmark UNION ALL SELECT 'talk', text FROM conversations) GROUP BY 1")
def g1(spark, sf):
    parts = {v: table(spark, sf, t).select("text") for v, t in (("docs", "documents"), ("bench", "benchmark"), ("talk", "conversations"))}
    return S.union_tagged(parts, "vault").groupBy("vault").agg(F.count("*").alias("n"))


@query("g2_union_proposals", "SELECT c_name AS name, 'customer' AS source FROM customer UNION ALL SELECT s_name, 'supplier' FROM supplier")
def g2(spark, sf):
    return S.union_tagged({"customer": table(spark, sf, "customer").select(F.col("c_name").alias("name")), "supplier": table(spark, sf, "supplier").select(F.col("s_name").alias("name"))}, "source")


@query("g4_shared_tokens", on_notes("""
, t AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(title), '[a-z0-9]{3,}')) AS a, list_distinct(regexp_extract_all(lower(body), '[a-z0-9]{3,}')) AS b FROM notes)
SELECT doc_id, list_sort(list_intersect(a, b)) AS shared, len(list_distinct(list_concat(a, b))) AS n_union FROM t"""))
def g4(spark, sf):
    a, b = X.tokens(F.col("title")), X.tokens(F.col("body"))
    return notes(spark, sf).select("doc_id", a.alias("a"), b.alias("b")).select("doc_id", S.shared(F.col("a"), F.col("b")).alias("shared"), F.size(S.merged(F.col("a"), F.col("b"))).cast("long").alias("n_union"))


@query("g6_merge_anchor_sets", "SELECT l_orderkey, list_sort(list_distinct(list_concat(list(l_linestatus), ['N', 'X']))) AS anchors FROM lineitem GROUP BY 1")
def g6(spark, sf):
    g = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_linestatus").alias("a"))
    return g.select("l_orderkey", S.merged(F.col("a"), F.array(F.lit("N"), F.lit("X"))).alias("anchors"))


@query("g7_distinct_targets", "SELECT DISTINCT p_type AS target FROM part")
def g7(spark, sf):
    return S.distinct_targets(table(spark, sf, "part"), "p_type")


@query("g8_dedup_case", on_notes("SELECT rel_path, list_filter([title, upper(title), folder, title], lambda x, i: list_position(list_transform([title, upper(title), folder, title], lambda y: lower(y)), lower(x)) = i) AS kept FROM (SELECT rel_path, folder, regexp_replace(title, '[^a-zA-Z ]', '', 'g') AS title FROM notes)"))
def g8(spark, sf):
    n = notes(spark, sf).withColumn("title", F.regexp_replace("title", "[^a-zA-Z ]", ""))
    arr = F.array("title", F.upper("title"), "folder", "title")
    return n.select("rel_path", T.dedup_case_insensitive(arr).alias("kept"))


@query("h9_strip_title_field", on_notes("SELECT rel_path, sha256('---' || chr(10) || 'k: 1' || chr(10) || '---' || chr(10) || 'title: stays' || chr(10) || body) AS digest FROM notes"))
def h9(spark, sf):
    raw = F.concat(F.lit("---\ntitle: "), "title", F.lit("\nk: 1\n---\ntitle: stays\n"), "body")
    return notes(spark, sf).select("rel_path", F.sha2(X.strip_title_field(raw), 256).alias("digest"))


@query("h11_audio_embeds", on_notes("SELECT rel_path, sha256('x ![[' || stem || '.m4a]] y ![z](a.mp3) ' || title) AS digest FROM notes"))
def h11(spark, sf):
    t = F.concat(F.lit("x [memo]("), "stem", F.lit(".m4a) y ![z](a.mp3) "), "title")
    return notes(spark, sf).select("rel_path", F.sha2(X.audio_embeds(t), 256).alias("digest"))


@query("h13_extract_links", "SELECT page_id, ['a', 'b ' || page_id] AS labels, [url, 'https://x.example/' || page_id] AS urls FROM pages")
def h13(spark, sf):
    pid = F.col("page_id").cast("string")
    t = F.concat(F.lit("see [a]("), "url", F.lit(") and [b "), pid, F.lit("](https://x.example/"), pid, F.lit(")."))
    p = table(spark, sf, "pages").select("page_id", X.markdown_links(t).alias("l"))
    return p.select("page_id", F.col("l.label").alias("labels"), F.col("l.url").alias("urls"))


@query("h15_quote_title", on_notes("SELECT rel_path, 'title: ''' || replace(trim(title || ': it''s'), '''', '''''') || '''' || chr(10) || 'k: 1' AS block FROM notes"))
def h15(spark, sf):
    block = F.concat(F.lit("title: "), "title", F.lit(": it's\nk: 1"))
    return notes(spark, sf).select("rel_path", T.quote_title(block).alias("block"))


@query("h17_normalise_parent", on_notes("SELECT rel_path, CASE doc_id % 5 WHEN 4 THEN NULL ELSE stem END AS up FROM notes"))
def h17(spark, sf):
    k, s = F.col("doc_id") % 5, F.col("stem")
    raw = F.when(k == 0, F.concat(F.lit('["[['), s, F.lit('|x]]"]'))).when(k == 1, F.concat(F.lit("[["), s, F.lit(".md]]"))).when(k == 2, F.concat(F.lit("'"), s, F.lit("'"))).when(k == 3, s).otherwise(F.lit("[[]]"))
    return notes(spark, sf).select("rel_path", T.normalise_parent(raw).alias("up"))


@query("h18_topic_refs", on_notes("SELECT rel_path, [stem, folder] AS refs FROM notes"))
def h18(spark, sf):
    arr = F.array(F.concat(F.lit("[["), "stem", F.lit("#part|label]]")), F.lit(" [[]] "), F.concat("folder", F.lit(".md")))
    return notes(spark, sf).select("rel_path", T.topic_refs(arr).alias("refs"))


@query("h20_unknown_links", on_notes("SELECT rel_path, CASE WHEN folder IN ('src1', 'src2') THEN '[[' || folder || '|f]]' ELSE 'f' END || ' and x end' AS body, CASE WHEN folder IN ('src1', 'src2') THEN 1 ELSE 2 END AS unlinked FROM notes"))
def h20(spark, sf):
    n = notes(spark, sf).select("rel_path", "folder", F.concat(F.lit("[["), "folder", F.lit("|f]] and [[none|x]] end")).alias("body"))
    known = n.where(F.col("folder").isin("src1", "src2")).select(F.col("folder").alias("target"))
    return T.strip_unknown_links(n, known).select("rel_path", "body", F.col("unlinked").cast("int").alias("unlinked"))


@query("h23_verify_claims", "SELECT conv_id, turn, CASE WHEN turn BETWEEN 1 AND 4 THEN 1 ELSE 0 END AS kept, CASE WHEN turn BETWEEN 1 AND 4 THEN 1 ELSE 2 END AS inferences FROM conversations")
def h23(spark, sf):
    t = F.concat(F.lit("One thing holds. (src: B"), F.col("turn").cast("string"), F.lit(") Another does not."))
    s = table(spark, sf, "conversations").select("conv_id", "turn", T.split_verified(t, F.lit(4)).alias("s"))
    return s.select("conv_id", "turn", F.size("s.kept").alias("kept"), F.size("s.inferences").alias("inferences"))


@query("h24_assemble_page", on_notes("SELECT rel_path, sha256('# ' || stem || chr(10) || chr(10) || 'In ' || vault || chr(10) || chr(10) || '## Facts' || chr(10) || '- a' || chr(10) || '- ' || folder || chr(10) || chr(10) || '> [!warning] Contradictions' || chr(10) || '> - c' || chr(10) || chr(10) || '## Sources' || chr(10) || '- ' || rel_path) AS digest FROM notes"))
def h24(spark, sf):
    none = F.array().cast(ARR)
    page = T.assemble_page(F.col("stem"), F.concat(F.lit("In "), "vault"), F.array(F.lit("a"), F.col("folder")), F.array(F.lit("c")), none, F.array("rel_path"))
    return notes(spark, sf).select("rel_path", F.sha2(page, 256).alias("digest"))


@query("h25_summary_line", on_notes("SELECT rel_path, 'Note ' || stem || ' is here.' AS line FROM notes"))
def h25(spark, sf):
    return notes(spark, sf).select("rel_path", X.summary_line(F.concat(F.lit("Note "), "stem", F.lit(" is here. (src: B1, B2) More."))).alias("line"))


@query("h27_report_line", on_notes("SELECT printf('%4d %7d ', doc_id, length(body)) || rpad(stem, 55, ' ') || ' ' || left(title, 20) AS line FROM notes"))
def h27(spark, sf):
    return notes(spark, sf).select(T.report_line(F.col("doc_id"), F.length("body"), F.col("stem"), F.left("title", F.lit(20))).alias("line"))


@query("h30_iso_time", on_notes("SELECT rel_path, strftime(mtime, '%Y-%m-%dT%H:%M:%S') AS iso FROM notes"))
def h30(spark, sf):
    return notes(spark, sf).select("rel_path", X.iso_time(F.col("mtime")).alias("iso"))


@query("h37_anchor_label", "SELECT p_partkey, 'Data Lake ' || p_size AS label FROM part")
def h37(spark, sf):
    return table(spark, sf, "part").select("p_partkey", X.anchor_label(F.concat(F.lit("tag:data-lake_"), F.col("p_size").cast("string"))).alias("label"))


@query("h38_anchors", on_notes("SELECT rel_path, list_concat(CASE WHEN vault = 'en' THEN [] ELSE ['tag:' || vault] END, CASE WHEN folder = 'src1' THEN [] ELSE ['org:' || folder] END) AS anchors FROM notes"))
def h38(spark, sf):
    return notes(spark, sf).select("rel_path", C.anchors(F.array().cast(ARR), F.array("vault"), F.col("folder"), ["en"], ["src1"]).alias("anchors"))


@query("h42_clean_model_row", on_notes("SELECT rel_path, vault AS type, CASE WHEN doc_id % 2 = 0 THEN 'Personal' ELSE folder END AS org, least(1.0, doc_id / 100.0) AS confidence FROM notes"))
def h42(spark, sf):
    org = F.when(F.col("doc_id") % 2 == 0, "Unknown").otherwise(F.col("folder"))
    raw = F.to_json(F.struct(F.col("vault").alias("type"), org.alias("org"), (F.col("doc_id") / 100.0).alias("confidence")))
    r = notes(spark, sf).select("rel_path", T.clean_model_row(raw).alias("r"))
    return r.select("rel_path", "r.type", "r.org", "r.confidence")


@query("h43_coerce_response", "SELECT event_id, CASE event_id % 3 WHEN 2 THEN NULL ELSE props END AS value, CASE event_id % 3 WHEN 2 THEN 'no object' END AS error FROM events")
def h43(spark, sf):
    k = F.col("event_id") % 3
    raw = F.when(k == 0, F.concat(F.lit('{"result":'), "props", F.lit("}"))).when(k == 1, F.col("props")).otherwise(F.lit("sorry"))
    r = table(spark, sf, "events").select("event_id", F.col("props"), T.coerce_response(raw).alias("r"))
    return r.select("event_id", F.when(F.col("r.value").isNotNull(), F.col("props")).alias("value"), "r.error")


@query("h44_build_prompt", on_notes("SELECT rel_path, sha256('schema' || chr(10) || chr(10) || 'Links: a, b' || chr(10) || chr(10) || 'Aliases: ' || stem || chr(10) || chr(10) || '[B1] ' || title || chr(10) || '[B2] ' || folder) AS digest FROM notes"))
def h44(spark, sf):
    p = T.build_prompt(F.lit("schema"), F.array(F.lit("a"), F.lit("b")), F.array("stem"), F.array("title", "folder"))
    return notes(spark, sf).select("rel_path", F.sha2(p, 256).alias("digest"))


@query("h46_hub_stub", "SELECT DISTINCT '---' || chr(10) || 'type: hub' || chr(10) || 'vault: v' || chr(10) || '---' || chr(10) || '# ' || p_type || chr(10) AS text FROM part")
def h46(spark, sf):
    return table(spark, sf, "part").select("p_type").distinct().select(T.hub_stub(F.col("p_type"), F.lit("v")).alias("text"))


@query("h49_one_line", on_notes("SELECT rel_path, sha256(trim(regexp_replace(body, '[ \\t\\n\\r\\v\\f]+', ' ', 'g'))) AS digest FROM notes"))
def h49(spark, sf):
    return notes(spark, sf).select("rel_path", F.sha2(X.one_line(F.col("body")), 256).alias("digest"))


@query("h3_fold_list", on_notes(f"SELECT rel_path, 0 AS pos, {fold_sql('title')} AS folded FROM notes WHERE title <> '' UNION ALL SELECT rel_path, 1, {fold_sql('folder')} FROM notes WHERE folder <> ''"))
def h3(spark, sf):
    n = notes(spark, sf).select("rel_path", F.posexplode(F.array("title", "folder")).alias("pos", "x")).where("x <> ''")
    return n.select("rel_path", "pos", X.fold(F.col("x")).alias("folded"))


@query("i2_run_cap", on_notes("SELECT rel_path FROM notes WHERE doc_id % 3 <> 0 ORDER BY rel_path LIMIT 50"))
def i2(spark, sf):
    n = notes(spark, sf)
    done = n.select("rel_path", F.when(F.col("doc_id") % 3 == 0, "rules").otherwise("export").alias("classified_by"))
    return I.todo(n, done, cap=50).select("rel_path")


@query("i4_skip_unchanged", "SELECT CAST(o_custkey AS VARCHAR) AS slug, count(*) AS n_sources FROM orders GROUP BY o_custkey HAVING o_custkey % 2 = 1")
def i4(spark, sf):
    s = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n_sources"))
    s = s.select("k", F.col("k").cast("string").alias("slug"), F.lit("h").alias("set_hash"), "n_sources")
    t = s.select("slug", F.when(F.col("k") % 2 == 0, "h").alias("source_set_hash"))
    return I.skip_unchanged(t, s).select("slug", "n_sources")


@query("i5_reopen", on_notes("SELECT rel_path FROM notes WHERE doc_id % 4 = 0"))
def i5(spark, sf):
    n = notes(spark, sf)
    done = n.select("rel_path", F.when(F.col("doc_id") % 4 == 0, "export").otherwise("rules").alias("classified_by"))
    return I.todo(n, done).select("rel_path")


@query("i7_windowed_counts", "SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS start, event_type, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY 1, 2")
def i7(spark, sf):
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    w = I.windowed_counts(e)
    return w.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("value", 4).alias("value"))


RULES = L.Rules(types=KEYWORDS, orgs={}, titles=[("^The ", "article")], folders=["src1", "src2"], work_orgs=["src1"], work=WORK, personal=PERSONAL)


@query("k2_classify_corpus", on_notes(f"""
, h AS (SELECT rel_path, folder, title, body, {', '.join(f'{_hits(k)} AS {k}' for k in KEYWORDS)} FROM notes),
c AS (SELECT *, least(CASE WHEN folder IN ('src1', 'src2') THEN 0.95 ELSE 0.0 END, CASE WHEN regexp_matches(title, '^The ') THEN 0.95 WHEN greatest({', '.join(KEYWORDS)}) >= 2 THEN greatest({', '.join(KEYWORDS)}) / ({' + '.join(KEYWORDS)}) WHEN greatest({', '.join(KEYWORDS)}) = 1 THEN 0.5 ELSE 0.0 END) AS confidence FROM h),
d AS (SELECT CASE WHEN confidence >= 0.8 THEN 'auto' WHEN length(trim(regexp_replace(body, '[*_#>\\[\\]()\\\\\\n\\t]', '', 'g'), chr(32) || chr(9) || chr(10) || chr(13) || chr(11) || chr(12))) < 30 THEN 'purged' ELSE 'review' END AS decision FROM c)
SELECT decision, count(*) AS n FROM d GROUP BY 1"""))
def k2(spark, sf):
    return L.classify_corpus(notes(spark, sf), RULES).groupBy("decision").agg(F.count("*").alias("n"))


# each order is of one customer, so a customer's orders are a clique; weak ones are added to what the ledger has
@query("k5_propose_topics", """
WITH o AS (SELECT o_custkey AS c, o_orderkey AS k, lower(split_part(o_orderpriority, '-', 2)) AS token FROM orders),
t AS (SELECT token, ln(((SELECT count(*) FROM o) + 1) / (count(*) + 1)) + 1 AS idf FROM o WHERE length(token) >= 3 GROUP BY 1),
s AS (SELECT c, count(*) AS n FROM o GROUP BY 1 HAVING count(*) >= 3),
x AS (SELECT a.c, avg(CASE WHEN a.token = b.token AND length(a.token) >= 3 THEN 1.0 ELSE 0.0 END) AS cohesion FROM o a JOIN o b ON a.c = b.c AND a.k < b.k GROUP BY 1),
z AS (SELECT c, n, pow(0.1 + 0.9, 0.4) * pow(0.1 + 0.9 * cohesion, 0.35) * pow(0.1 + 0.9 * least(1.0, ln(n) / ln(6)), 0.25) AS score FROM s JOIN x USING (c)),
l AS (SELECT c, CASE WHEN c % 2 = 0 THEN 0.4 ELSE 0.0 END + score AS evidence FROM z WHERE score < 0.6)
SELECT 'proposed' AS kind, 'c' || c AS slug, n, round(score, 6) AS score FROM z WHERE score >= 0.6 AND c % 5 <> 0
UNION ALL SELECT 'promoted', 'tag:c' || c, NULL, round(evidence, 6) FROM l WHERE evidence >= 0.9""")
def k5(spark, sf):
    """Orders as notes: those of a customer share an anchor. The ledger knows every second customer from today."""
    o = table(spark, sf, "orders")
    key = F.concat(F.lit("tag:c"), F.col("o_custkey").cast("string"))
    now = F.lit("2024-02-01").cast("timestamp")
    refs = o.select(F.col("o_orderkey").alias("node"), F.array(key).alias("anchors"), X.tokens(F.substring_index("o_orderpriority", "-", -1)).alias("tokens"))
    state = o.where("o_custkey % 2 = 0").select(key.alias("key"), F.lit(0.4).alias("evidence"), F.lit(1).cast("long").alias("seen"), now.alias("last_seen"), F.lit(False).alias("promoted")).distinct()
    rejected = o.where("o_custkey % 5 = 0").select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("slug"))
    out = L.propose_topics(refs, state, now, rejected, spark.createDataFrame([], "slug string"), spark.createDataFrame([], "alias string"), floor=0.6, bar=0.9)
    proposed = out["proposals"].select(F.lit("proposed").alias("kind"), "slug", "n", F.round("confidence", 6).alias("score"))
    promoted = out["ledger"].where("newly").select(F.lit("promoted").alias("kind"), F.col("key").alias("slug"), F.lit(None).cast("long").alias("n"), F.round("evidence", 6).alias("score"))
    return proposed.unionByName(promoted)


def _namer():
    """Names a cluster after the number in its anchor; every fourth gets no answer that fits."""
    import json

    def call(prompt: str) -> str:
        c = int(prompt.rsplit(":c", 1)[1].split("\n", 1)[0])
        return "none" if c % 4 == 0 else json.dumps({"name": f"Topic {c // 3}", "aliases": [f"c{c}", f"shared {c % 2}"], "description": "d"})

    return call


# a customer's orders are a cluster of so great a score if they all say the same; names of three customers collide
@query("k5_create_topics", """
WITH o AS (SELECT o_custkey AS c, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) >= 6),
a AS (SELECT c, n, 'topic-' || (c // 3) AS slug, row_number() OVER (PARTITION BY c // 3 ORDER BY n DESC, sig) AS rn FROM (
 SELECT o.c, o.n, 'sig:' || left(sha256(string_agg(CAST(o_orderkey AS VARCHAR), chr(0) ORDER BY CAST(o_orderkey AS VARCHAR)) || chr(0) || 'tag:c' || o.c), 16) AS sig FROM o JOIN orders ON o_custkey = o.c GROUP BY 1, 2) WHERE c % 4 <> 0 AND c // 3 <> 7)
SELECT slug, n FROM a WHERE rn = 1""")
def k5_created(spark, sf):
    """Orders as notes of one word; a namer names most clusters, a bar below their scores creates their topics."""
    o = table(spark, sf, "orders")
    key = F.concat(F.lit("tag:c"), F.col("o_custkey").cast("string"))
    refs = o.select(F.col("o_orderkey").alias("node"), F.array(key).alias("anchors"), F.array(F.lit("order")).alias("tokens"))
    state = spark.createDataFrame([], "key string, evidence double, seen long, last_seen timestamp, promoted boolean")
    none = spark.createDataFrame([], "slug string")
    out = L.propose_topics(refs, state, F.lit("2024-02-01").cast("timestamp"), none, spark.createDataFrame([("topic-7",)], "slug string"), spark.createDataFrame([], "alias string"), _namer, auto=0.999)
    return out["created"].select("slug", "n")


@query("k7_reconcile", on_notes("""
, d AS (SELECT rel_path, doc_id % 3 AS k, doc_id % 2 = 0 AS wanted, vault FROM notes)
SELECT rel_path, CASE k WHEN 2 THEN CASE WHEN wanted THEN '["[[b]]"]' END WHEN 1 THEN CASE WHEN wanted THEN '["[[mine]]","[[b]]"]' ELSE '["[[mine]]"]' END ELSE '["plain","[[' || vault || ']]"' || CASE WHEN wanted THEN ',"[[b]]"' ELSE '' END || ']' END AS topics,
 CASE WHEN k = 0 AND NOT wanted THEN 'skipped' WHEN k = 2 AND NOT wanted THEN 'skipped' ELSE 'updated' END AS status, CASE k WHEN 1 THEN 1 ELSE 0 END AS removed FROM d"""))
def k7(spark, sf):
    n = notes(spark, sf)
    k = F.col("doc_id") % 3
    links = F.when(k == 0, F.array(F.lit("plain"), F.concat(F.lit("[["), "vault", F.lit("]]")))).when(k == 1, F.array(F.lit("[[a#part|x]]"), F.lit("[[mine]]")))
    fields = F.when(k < 2, F.create_map(F.lit("topics"), F.to_json(links))).otherwise(F.create_map(F.lit("other"), F.lit("x")))
    sources = n.where("doc_id % 2 = 0").select("rel_path", F.lit("b").alias("slug"))
    out = L.reconcile(n.select("rel_path", fields.alias("fields")), sources, spark.createDataFrame([("a",), ("b",)], "slug string"))
    return out.select("rel_path", F.col("fields")["topics"].alias("topics"), "status", F.col("removed").cast("int").alias("removed"))


@query("k8_corpus_report", on_notes("""
, u AS (SELECT vault, rel_path, folder, doc_id, CASE doc_id % 3 WHEN 0 THEN 'doc' || (doc_id + 1) WHEN 1 THEN folder || '/' || stem END AS up FROM notes), h AS (SELECT DISTINCT vault, rel_path FROM notes),
o AS (SELECT * FROM u WHERE up IS NOT NULL AND vault <> 'fr' AND NOT EXISTS (SELECT 1 FROM h WHERE h.vault = u.vault AND h.rel_path = u.up || '.md') AND NOT EXISTS (SELECT 1 FROM h WHERE h.vault = u.vault AND h.rel_path = u.folder || '/' || u.up || '.md')),
m AS (SELECT n.vault, count(*) AS total, count(l.doc_id) AS classified, count(o.doc_id) AS orphans FROM notes n LEFT JOIN labels l USING (doc_id) LEFT JOIN o USING (doc_id) GROUP BY 1),
d AS (SELECT vault, count(*) AS dangling FROM notes WHERE doc_id % 40 >= 5 GROUP BY 1),
f AS (SELECT vault, count(*) FILTER (WHERE folder = 'src1') AS stale FROM (SELECT DISTINCT vault, folder FROM notes WHERE folder IN ('src0', 'src1', 'src2', 'src3', 'src4')) GROUP BY 1),
a AS (SELECT vault, total, classified, orphans, CASE WHEN vault = 'de' THEN total ELSE 0 END AS queue, CASE WHEN vault = 'es' THEN 1 ELSE 0 END AS exhaust, coalesce(stale, 0) AS stale, coalesce(dangling, 0) AS dangling FROM m LEFT JOIN f USING (vault) LEFT JOIN d USING (vault)),
e AS (SELECT * FROM a UNION ALL SELECT '*', sum(total), sum(classified), sum(orphans), sum(queue), sum(exhaust), sum(stale), sum(dangling) FROM a)
SELECT vault, CAST(orphans AS BIGINT) AS orphans, CAST(queue AS BIGINT) AS queue, CAST(exhaust AS BIGINT) AS exhaust, CAST(stale AS BIGINT) AS stale, CAST(dangling AS BIGINT) AS dangling,
 CAST(round_even(20.0 + 35.0 * classified / total + CASE WHEN orphans = 0 THEN 15 ELSE 0 END + CASE WHEN queue = 0 THEN 10 ELSE 0 END + CASE WHEN exhaust = 0 THEN 10 ELSE 0 END + CASE WHEN stale = 0 THEN 10 ELSE 0 END, 0) AS INTEGER) AS health FROM e"""))
def k8(spark, sf):
    """Sources as topics of each vault, one of them stale; the notes refer to forty, of which five have pages."""
    n = notes(spark, sf).join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    k = F.col("doc_id") % 3
    up = F.when(k == 0, F.concat(F.lit("[[doc"), (F.col("doc_id") + 1).cast("string"), F.lit("]]"))).when(k == 1, F.concat("folder", F.lit("/"), "stem"))
    ref = F.concat(F.lit("[[src"), (F.col("doc_id") % 40).cast("string"), F.lit("|x]]"))
    n = n.withColumns({"up": F.when(F.col("vault") != "fr", up), "topics": F.array(ref)})
    pages = n.where(F.col("folder").isin("src0", "src1", "src2", "src3", "src4")).select("vault", F.concat_ws("/", "vault", "folder").alias("rel_path"), F.col("folder").alias("slug")).distinct()
    pages = pages.select("vault", "rel_path", "slug", F.col("slug").alias("stem"), F.lit("topic").alias("type"), F.array("rel_path").alias("aliases"), F.lit("active").alias("status"), F.array().cast(ARR).alias("errors"), F.lit("2024").alias("updated"), F.lit("h").alias("source_set_hash"))
    sets = pages.select("slug", F.lit(1).cast("long").alias("n_sources"), F.when(F.col("slug") == "src1", "other").otherwise("h").alias("set_hash")).distinct()
    files = spark.createDataFrame([("es", "classification-review-1.html"), ("es", "x.md")], "vault string, file_name string")
    out = L.corpus_report(n, F.col("quality").isNotNull(), pages, sets=sets, queue=n.where("vault = 'de'").select("vault"), files=files)
    d = out["dangling"].groupBy("vault").agg(F.count("*").alias("dangling"))
    d = d.unionByName(d.agg(F.lit("*").alias("vault"), F.sum("dangling").alias("dangling")))
    return out["totals"].join(d, "vault", "left").select("vault", "orphans", "queue", "exhaust", "stale", F.coalesce("dangling", F.lit(0)).alias("dangling"), "health")


@query("k10_clean_numbered", COPIES_SQL + """, base AS (SELECT vault, body, CASE WHEN least % 3 = 0 AND rn = 1 THEN NULL ELSE rel_path END AS rel_path, least, rn FROM copies), n AS (SELECT * FROM base WHERE rel_path IS NOT NULL),
o AS (SELECT vault, rel_path, least, row_number() OVER (PARTITION BY vault, least ORDER BY rel_path) AS k FROM n WHERE least % 3 = 0)
SELECT vault, rel_path AS copy, CASE WHEN k = 1 THEN 'rename' ELSE 'collision' END AS action, NULL AS chars FROM o
UNION ALL SELECT vault, rel_path, 'delete', length(trim(body, chr(32) || chr(9) || chr(10) || chr(13) || chr(11) || chr(12))) FROM n WHERE rn > 1 AND least % 3 <> 0
UNION ALL SELECT vault, rel_path, 'link', NULL FROM o WHERE k = 1""")
def k10(spark, sf):
    """Every third base is missing; each of its copies links to itself by name."""
    n = copies(spark, sf)
    least = F.regexp_extract("rel_path", r"doc(\d+)", 1).cast("long")
    n = n.where(F.col("rel_path").rlike(J.NUMBERED) | (least % 3 != 0))
    n = n.withColumn("body", F.when(F.col("rel_path").rlike(J.NUMBERED) & (least % 3 == 0), F.concat("body", F.lit(" [["), "stem", F.lit("|me]]"))).otherwise(F.col("body")))
    out = L.clean_numbered(n)
    gone = out["deletions"].select(F.col("path").alias("copy"), F.col("stripped_body_chars").alias("chars"))
    plan = out["plan"].select("vault", "copy", "action").join(gone, "copy", "left").select("vault", "copy", "action", "chars")
    return plan.unionByName(out["links"].select("vault", F.col("rel_path").alias("copy"), F.lit("link").alias("action"), F.lit(None).cast("int").alias("chars")))


@query("k11_dedup", COPIES_SQL + "SELECT vault, rel_path AS copy, 'all/doc' || least || '.md' AS base, length(trim(body, chr(32) || chr(9) || chr(10) || chr(13) || chr(11) || chr(12))) AS chars FROM copies WHERE rn > 1")
def k11(spark, sf):
    out = L.dedup(copies(spark, sf))
    # paths are unique over the vaults here, as they hold the id
    return out["pairs"].join(out["deletions"].select(F.col("path").alias("copy"), F.col("stripped_body_chars").alias("chars")), "copy").select("vault", "copy", "base", "chars")


@query("k3_classify_binary_corpus", on_notes(f"""
, s AS (SELECT rel_path, {sql_sum(WORK, "stem || ' ' || body")} AS w, {sql_sum(PERSONAL, "stem || ' ' || body")} AS p FROM (SELECT rel_path, CASE WHEN doc_id % 2 = 0 THEN 'My Version' ELSE stem END AS stem, body FROM notes))
SELECT rel_path, CASE WHEN w + p = 0 THEN 'Uncertain' WHEN w > p THEN 'Work' ELSE 'Personal' END AS predicted, CASE WHEN w + p = 0 THEN 0.0 ELSE round(least(1.0, abs(w / (w + p) - 0.5) * 2), 3) END AS confidence FROM s"""))
def k3(spark, sf):
    raw = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("---\ntitle: 'My Version'\n---\n"), "body")).otherwise(F.col("body"))
    return L.classify_binary_corpus(notes(spark, sf).withColumn("raw", raw), WORK, PERSONAL).select("rel_path", "predicted", "confidence")


@query("d30_topic_table", "SELECT '| ' || p_brand || ' | ' || CASE WHEN n = 0 THEN 'n/a' ELSE CAST(n AS VARCHAR) END || ' | ' || CASE WHEN p_brand < 'Brand#3' THEN '2024' ELSE 'n/a' END || ' | ' || CASE WHEN n % 3 = 0 THEN 'n/a' WHEN n % 3 = 1 THEN 'yes' ELSE 'no' END || ' |' AS line FROM (SELECT p_brand, count(*) FILTER (WHERE p_size > 10) AS n FROM part GROUP BY 1)")
def d30(spark, sf):
    g = table(spark, sf, "part").groupBy(F.col("p_brand").alias("slug")).agg(F.count_if(F.col("p_size") > 10).alias("n"))
    rows = g.select("slug", F.nullif("n", F.lit(0)).alias("n_sources"), F.when(F.col("slug") < "Brand#3", "2024").alias("updated"), F.when(F.col("n") % 3 != 0, F.col("n") % 3 == 1).alias("hash_changed"))
    return T.topic_table(rows).where("pos > 1").select("line")


@query("h19_slug_of_link", on_notes("SELECT rel_path, CASE doc_id % 4 WHEN 0 THEN stem WHEN 1 THEN folder WHEN 2 THEN stem END AS slug FROM notes"))
def h19(spark, sf):
    k = F.col("doc_id") % 4
    wrap = lambda *c: F.concat(F.lit("[["), *c, F.lit("]]"))
    link = F.when(k == 0, wrap("stem")).when(k == 1, wrap("folder", F.lit("#part|label"))).when(k == 2, F.concat(F.lit(" "), wrap("stem", F.lit(".md")), F.lit(" "))).otherwise(F.col("stem"))
    return notes(spark, sf).select("rel_path", X.slug_of_link(link).alias("slug"))


@query("h34_route_clusters", "SELECT route, count(*) AS n FROM (SELECT CASE WHEN l_discount * 10 >= 0.9 AND l_linenumber >= 3 AND l_tax * 10 >= 0.7 THEN 'auto' WHEN l_discount * 10 >= 0.35 THEN 'propose' ELSE 'ledger' END AS route FROM lineitem) GROUP BY 1")
def h34(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.groupBy(C.route(F.col("l_discount") * 10, F.col("l_linenumber"), F.col("l_tax") * 10, auto=0.9).alias("route")).agg(F.count("*").alias("n"))


@query("a10_relational_guids", on_notes("""
, k AS (SELECT stem, CASE doc_id % 3 WHEN 0 THEN title WHEN 1 THEN upper(title) ELSE title || ' missing' END AS title FROM (SELECT * REPLACE (regexp_replace(title, '[^a-zA-Z ]', '', 'g') AS title) FROM notes)),
t AS (SELECT regexp_replace(title, '[^a-zA-Z ]', '', 'g') AS title, stem FROM notes), e AS (SELECT title AS k, max(stem) AS s FROM t GROUP BY 1), l AS (SELECT lower(title) AS k, max(stem) AS s FROM t GROUP BY 1)
SELECT md5(k.stem) AS guid, coalesce(e.s, l.s) AS target FROM k LEFT JOIN e ON k.title = e.k LEFT JOIN l ON lower(k.title) = l.k WHERE coalesce(e.s, l.s) IS NOT NULL"""))
def a10(spark, sf):
    from notegraph.sources.notes import guid_lookup

    n = notes(spark, sf).withColumn("title", F.regexp_replace("title", "[^a-zA-Z ]", ""))
    k = F.col("doc_id") % 3
    rows = n.select(F.upper(F.md5("stem")).alias("guid"), F.when(k == 0, F.col("title")).when(k == 1, F.upper("title")).otherwise(F.concat("title", F.lit(" missing"))).alias("title"))
    return guid_lookup(rows, n.select("title", "stem"))


@query("k12_migrate", on_notes("""
, r AS (SELECT rel_path, folder AS stem, CASE vault WHEN 'en' THEN 'business' WHEN 'de' THEN 'personal' WHEN 'fr' THEN 'personal' ELSE 'skipped' END AS target FROM notes),
k AS (SELECT *, row_number() OVER (PARTITION BY target, stem ORDER BY rel_path) AS k FROM r WHERE target <> 'skipped')
SELECT rel_path, target, CASE WHEN k = 1 THEN stem ELSE stem || '_' || k END AS new_name FROM k"""))
def k12(spark, sf):
    n = notes(spark, sf).select("rel_path", F.col("folder").alias("stem"), "vault")
    context = F.when(F.col("vault") == "en", "work").when(F.col("vault") == "de", "personal").when(F.col("vault") == "fr", "education")
    none = n.where("false").select(F.lit("").alias("target"), "stem")
    return L.migrate(n, none, context, F.lit(True)).select("rel_path", "target", "new_name")


# the GUIDs have eight digits of a digest, so in a large table some notes share one: the greatest name with it is the target of all
@query("k13_repair_links", on_notes("""
, g AS (SELECT md5(stem)[1:8] AS guid, max(stem) AS target FROM notes WHERE doc_id % 2 = 0 GROUP BY 1)
SELECT rel_path, CASE WHEN target IS NOT NULL THEN '[[' || target || '|t]] end' ELSE '[t](https://s/' || md5(stem)[1:8] || '-0000-1111-2222-333344445555/) end' END AS body FROM notes LEFT JOIN g ON g.guid = md5(stem)[1:8]"""))
def k13(spark, sf):
    n = notes(spark, sf)
    guid = F.concat(F.left(F.md5("stem"), F.lit(8)), F.lit("-0000-1111-2222-333344445555"))
    texts = n.select("rel_path", "stem", F.concat(F.lit("T "), "stem").alias("title"), F.concat(F.lit("[t](https://s/"), guid, F.lit("/) end")).alias("body"))
    guids = n.where("doc_id % 2 = 0").select(guid.alias("guid"), F.concat(F.lit("t "), "stem").alias("title"))
    return L.repair_links(texts, guids, X.guid_of).select("rel_path", "body")
