"""Whole jobs, the bucketed sink and its stream, the ledger's file."""

import json
import re
from datetime import datetime

from pyspark.sql import functions as F

from notegraph import session as session_
from notegraph.plans import generate as G
from notegraph.plans import jobs as J
from notegraph.plans.catalog_jobs import _writer
from notegraph.plans.catalog_more import RULES
from notegraph.sources.buckets import KeyedTable, upsert_stream
from notegraph.sources.notes import notes_from_documents


def test_upserts_touch_their_buckets_only(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    t = KeyedTable(spark, path, "k", 32)
    assert t.read() is None
    t.upsert(spark.range(2000).select(F.concat(F.lit("key"), F.col("id").cast("string")).alias("k"), F.col("id").alias("v")))
    first = t.manifest()
    m = t.upsert(spark.createDataFrame([("key7", 70, 1), ("key7", 71, 2), ("new", 1, 1)], "k string, v long, at int"), order="at")
    assert m["version"] == 2 and sum(m["buckets"][b] != first["buckets"].get(b) for b in m["buckets"]) <= 2
    rows = {r.k: r.v for r in t.read().collect()}
    assert len(rows) == 2001 and rows["key7"] == 71 and rows["new"] == 1 and rows["key8"] == 8
    assert {r.k: r.v for r in t.read(1).collect()} == {f"key{i}": i for i in range(2000)}  # the old version still stands
    t.upsert(spark.createDataFrame([("key8", 0), ("newer", 2)], "k string, v long"), insert_only=True)
    rows = {r.k: r.v for r in t.read().collect()}
    assert rows["key8"] == 8 and rows["newer"] == 2
    assert t.upsert(spark.createDataFrame([("bad", -1)], "k string, v long"), validate=lambda df: df.where("v < 0"))["version"] == 3
    assert t.versions() == [1, 2, 3] and t.read().where("k = 'bad'").isEmpty()
    assert t.roll_back(1)["version"] == 4 and t.read().count() == 2000
    assert t.upsert(spark.createDataFrame([], "k string, v long"))["version"] == 5 and t.read().count() == 2000


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    """The second run has lost its checkpoint, so it gives the same batch again."""
    t = KeyedTable(spark, f"file://{tmp_path}/t", "k", 4)
    spark.range(100).select((F.col("id") % 10).alias("k"), F.lit(1).cast("long").alias("v")).write.parquet(f"{tmp_path}/in")
    stream = lambda: spark.readStream.schema("k long, v long").parquet(f"{tmp_path}/in")
    died = []

    def once(df):
        if not died:
            died.append(True)
            raise RuntimeError("killed in the middle of a batch")
        return df

    try:
        upsert_stream(stream(), t, f"{tmp_path}/cp", "notes", once).awaitTermination()
    except Exception as e:
        assert "killed" in str(e)
    assert died and t.read() is None
    upsert_stream(stream(), t, f"{tmp_path}/cp", "notes", once).awaitTermination()
    assert t.versions() == [1] and t.read().count() == 10
    upsert_stream(stream(), t, f"{tmp_path}/other", "notes").awaitTermination()
    assert t.versions() == [1]
    upsert_stream(stream(), t, f"{tmp_path}/third", "others").awaitTermination()
    assert t.versions() == [1, 2] and t.read().count() == 10


def test_ledger_file(spark, tmp_path):
    path = f"file://{tmp_path}/ledger"
    assert J.load_ledger(spark, path).count() == 0
    rows = [("tag:a", 0.5, 2, ["tag:a", "org:x"], "2024-01-01T00:00:00", "sig:1", None, False), ("tag:b", 1.5, 3, [], "2024-01-02T00:00:00", "sig:2", "b", True)]
    state = spark.createDataFrame(rows, J.LEDGER)
    J.save_ledger(state, path)
    assert sorted(tuple(r) for r in J.load_ledger(spark, path).collect()) == rows
    J.save_ledger(J.load_ledger(spark, path).where("proposed"), path)
    assert [r.key for r in J.load_ledger(spark, path).collect()] == ["tag:b"]
    lines = [json.loads(x) for f in (tmp_path / "ledger").glob("part-*") for x in f.read_text().splitlines()]
    assert lines[0]["schema_version"] == 1 and lines[0]["slug"] == "b"
    with next((tmp_path / "ledger").glob("part-*")).open("a") as f:
        f.write("{broken\n")
    for crc in (tmp_path / "ledger").glob(".*.crc"):
        crc.unlink()
    assert J.load_ledger(spark, path).count() == 0
    assert len(list(tmp_path.glob("ledger.corrupt.*"))) == 1 and not (tmp_path / "ledger").exists()


def _writer():
    def call(prompt):
        if "bad" in prompt:
            return "no json"
        return json.dumps({"summary": "All is well. (src: B1)", "facts": "It holds. (src: B1)", "contradictions": None})

    return call


def test_publishing_topics(spark, tmp_path):
    kind = "slug string, rel_path string, title string, mtime string, aliases array<string>, quotes array<string>"
    sources = spark.createDataFrame([("t", "a.md", "A", "2024-01-02", ["x", "y"], ["q"]), ("t", "b.md", "B", "2024-01-03", ["x"], []), ("u", "a.md", "A", "2024-01-02", ["z"], []), ("bad", "a.md", "A", "2024-01-02", ["z"], [])], kind)
    bodies = spark.createDataFrame([("a.md", "text of a"), ("b.md", "text of b")], "rel_path string, body string")
    sets = spark.createDataFrame([("t", 2, "h1"), ("u", 1, "h2"), ("bad", 1, "h3")], "slug string, n_sources long, set_hash string")
    known = spark.createDataFrame([("t", "old"), ("u", "h2"), ("bad", None), ("empty", None)], "slug string, source_set_hash string")
    index = spark.createDataFrame([("t", "- stray", "## Other"), ("u", "- [[u]] — kept", "## Topics")], "slug string, line string, section string")
    out = J.publish_topics(sources, bodies, sets, known, index, _writer, F.lit("2024-02-01"), log=f"{tmp_path}/log")
    assert {r.slug: r.status for r in out["results"].collect()} == {"t": "wrote", "u": "skipped-unchanged", "bad": "failed", "empty": "skipped-zero-sources"}
    page = out["pages"].collect()
    assert [r.slug for r in page] == ["t"] and page[0].page.startswith("# t\n")
    f = page[0].fields
    assert (f.status, f.sources, f.source_set_hash, f.prompt_degraded, f.updated) == ("active", ["[[B]]", "[[A]]"], "h1", False, "2024-02-01")
    assert abs(f.confidence - (0.5 * 2 / 3 + 0.5 * (0.5 + 0.75) / 2)) < 1e-6
    assert {(r.slug, r.line, r.section) for r in out["index"].collect()} == {("t", "- [[t]] — All is well.", "## Topics"), ("u", "- [[u]] — kept", "## Topics")}
    said = sorted(r.value for r in spark.read.text(f"{tmp_path}/log").collect())
    assert said == ["empty: skipped, zero sources", "t: synthesized 2 sources"]


def test_migration_log(spark, tmp_path):
    n = spark.createDataFrame([("a/x.md", "x", "work"), ("b/x.md", "x", "work"), ("c.md", "c", "odd")], "rel_path string, stem string, context string")
    for _ in range(2):
        out = J.migrate(n, n.where("false").select(F.lit("").alias("target"), "stem"), F.col("context"), F.lit(True), F.lit("now"), f"{tmp_path}/log")
    assert {r.target: r.n for r in out["counts"].collect()} == {"business": 2, "skipped": 1}
    want = ["## now — migration", "- `a/x.md` → `business/x` (to business)", "- `b/x.md` → `business/x_2` (to business)"]
    assert sorted(r.value for r in spark.read.text(f"{tmp_path}/log").collect()) == sorted(want * 2)
    J.migrate(n.where("false"), n.where("false").select(F.lit("").alias("target"), "stem"), F.col("context"), F.lit(True), F.lit("now"), f"{tmp_path}/log")
    assert spark.read.text(f"{tmp_path}/log").count() == 6


def test_hub_audit_without_apply(spark):
    n = spark.createDataFrame([("v", "a.md", "a", "Hub"), ("v", "Self.md", "Self", "Self"), ("w", "b.md", "b", None)], "vault string, rel_path string, stem string, up string")
    hubs = spark.createDataFrame([("v", "Hub"), ("v", "Self"), ("v", "Hub"), ("w", "Hub")], "vault string, hub string")
    out = J.audit_hubs(n, hubs)
    assert {(r.vault, r.hub): (r.references, r.status) for r in out["missing"].collect()} == {("v", "Hub"): (1, "would_create"), ("w", "Hub"): (0, "skipped")}
    assert out["stubs"].count() == 0 and [tuple(r) for r in out["problems"].collect()] == [("v", "Self", "Self", "self")]
    assert {r.target for r in out["targets"].collect()} == {"Hub", "Self"}
    assert [(r.rel_path, r.text[:3]) for r in J.audit_hubs(n, hubs, apply=True)["stubs"].collect()] == [("Hub.md", "---")]


def test_links_of_notes_that_share_a_guid(spark, same, tmp_path):
    """Notes 123918 and 168108 have one GUID in the registered queries, 61409 and 136844 another; a link is rewritten once."""
    import duckdb

    from notegraph.plans.catalog import QUERIES, SQL

    rows = [(i, "a text", "en", "src1") for i in (1, 2, 61409, 136844, 123918, 168108)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = {r.rel_path: r.body for r in QUERIES["k13_repair_links"](spark, str(tmp_path)).collect()}
    assert got["src1/doc123918.md"] == got["src1/doc168108.md"] == "[[doc168108|t]] end"
    assert got["src1/doc61409.md"] == got["src1/doc136844.md"] == "[[doc136844|t]] end"
    for name in ("k13_repair_links", "k13_repair_stats"):
        same(QUERIES[name](spark, str(tmp_path)), duck.sql(SQL[name]))
    assert QUERIES["k13_repair_stats"](spark, str(tmp_path)).first().asDict() == {"scanned": 6, "changed": 5, "converted": 5, "unresolved": 1}


def test_nightly_keeps_notes_out_of_the_driver(spark, monkeypatch):
    """Tables with a row for each note are not broadcast, small as they are here; only texts that may have a topic are joined with it."""
    session, plans, met = spark.newSession(), {}, []
    bound, usual = session_.SMALL_BOUND

    def seen(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return session_.materialize(df, name)

    def collect(notes, *rest, of=G.L.collect_topics):
        met.extend(r.rel_path for r in notes.select("rel_path").collect())
        return of(notes, *rest)

    monkeypatch.setattr(G, "materialize", seen)
    monkeypatch.setattr(G.L, "collect_topics", collect)
    rows = [(f"n{i}.md", f"n{i}", "v", f"Met Ann Lee {i}", f"We met Ann Lee about garden plans number {i}, once more", datetime(2024, 1, 20)) for i in range(200)]
    rows += [("cafe.md", "cafe", "v", "c", "the cafe noir has opened its doors again", datetime(2024, 1, 20))]
    n = session.createDataFrame(rows, "rel_path string, stem string, vault string, title string, body string, mtime timestamp").withColumn("folder", F.lit("x"))
    topics = session.createDataFrame([("cafe", "cafe noir", 0), ("old", "never there", 0)], "slug string, alias string, alias_pos int")
    done = session.createDataFrame([("n7.md", "rules")], "rel_path string, classified_by string")
    got = {r.step: r.n for r in G.nightly(n, done, RULES, topics, writer=_writer).collect()}
    assert got == {"classify": 50, "collect": 1, "propose": 1, "synthesize": 1, "backlink": 1, "report": 2}
    assert "cafe.md" in met and len(met) < 10
    by_note = r"BroadcastHashJoin \[rel_path#\d+\], \[rel_path#\d+\], (LeftOuter|Inner)"
    assert not [name for name in ("nightly-noterefs", "nightly-report") if re.search(by_note, plans[name])]
    assert session.conf.get(bound) == str(session_.SMALL_BYTES)
    other = spark.newSession()
    other.conf.set(bound, "1m")
    session_.small_broadcasts(other)  # a bound that someone chose stays
    assert other.conf.get(bound) == "1m" and spark.newSession().conf.get(bound) == usual


def test_nightly_with_large_ids(spark, duck):
    """Ids are longs: a copy of a table may have its ids shifted beyond 2^31, and its notes' times beyond the year 9999."""
    ids = [-1441, -1, 0, 1439, 1440, 3_000_000_007, 6_000_000_000]
    rows = [(i, "We met Ann Lee about garden plans, once more", "en", "src1") for i in ids]
    n = notes_from_documents(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    duck.sql("CREATE OR REPLACE TEMP TABLE large_ids AS SELECT unnest([-1441, -1, 0, 1439, 1440, 3000000007, 6000000000]) AS doc_id")
    minutes = "epoch_us(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id))"
    want = dict(duck.sql(f"SELECT doc_id, {minutes} FROM large_ids").fetchall())
    assert {r.doc_id: r.at for r in n.select("doc_id", F.unix_micros(F.col("mtime").cast("timestamp")).alias("at")).collect()} == want
    topics = spark.createDataFrame([("ann", "ann lee", 0)], "slug string, alias string, alias_pos int")
    done = spark.createDataFrame([], "rel_path string, classified_by string")
    got = {r.step: r.n for r in G.nightly(n, done, RULES, topics, writer=_writer).collect()}
    assert got["classify"] == len(ids) and got["collect"] == 1 and got["backlink"] == 1
