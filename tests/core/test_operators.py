"""Semantics of operators on small tables."""

import difflib
import hashlib
import itertools
import random
import unicodedata
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from notegraph.functions import text as X
from notegraph.operators import aggregates as A
from notegraph.operators import clusters as C
from notegraph.operators import filters as P
from notegraph.operators import joins as J
from notegraph.operators import windows as N
from notegraph.plans import pipelines as L
from notegraph.sources import notes as S
from notegraph.sources import sinks as K
from notegraph.streaming import incremental as I
from notegraph.streaming import ledger as G


def one(spark, text, f):
    return spark.createDataFrame([(text,)], "t string").select(f(F.col("t"))).first()[0]


@pytest.mark.parametrize(
    ("f", "text", "want"),
    [
        (X.strip_header, "---\na: 1\n---\nbody", "body"),
        (X.strip_header, "text --- no\n---\n", "text --- no\n---\n"),
        (X.strip_title_field, "---\ntitle: x\na: 1\n---\ntitle: y\n", "---\na: 1\n---\ntitle: y\n"),
        (X.people, "Ann Lee met Ann Lee on Friday Morning with Bob Ray Fox.", ["Ann Lee", "Bob Ray Fox"]),
        (X.sentences, "One.  Two!\nThree", ["One.", "Two!", "Three"]),
        (X.sentences, "Wait... what?! So", ["Wait.", "what?", "So"]),
        (X.cited, "a (src: B1, B12) b (src: B3)", [1, 12, 3]),
        (X.cited, "none", []),
        (X.claims, "- First one. (src: B1) Second (really) one. (src: B2)\n\nThird", ["- First one. (src: B1)", "- Second (really) one. (src: B2)", "Third"]),
        (X.summary_line, "First one. (src: B1) Second.", "First one."),
        (X.links, "[[A#h|x]] and [[B.md]] and [c](d)", ["A", "B"]),
        (X.slug_of_link, "[[my-topic|T]]", "my-topic"),
        (X.slug_of_link, "see [[x]]", None),
        (X.slugify, "Été à l'Eau!", "ete-a-leau"),
        (X.fold, "Straße ’Été’", unicodedata.normalize("NFKD", "Straße 'Été'").casefold()),
        (X.tokens, "The thE a1b, ab cafe", ["the", "a1b", "cafe"]),
        (X.extract_json, 'text {"a": {"b": 1}} tail {"c": 2}', '{"a": {"b": 1}}'),
        (X.extract_json, 'x ```json\n{"k": "}"}\n``` y', '{"k": "}"}'),
        (X.extract_json, "no { json", None),
        (X.audio_embeds, "a [x](y.m4a) ![z](w.mp3)", "a ![[y.m4a]] ![z](w.mp3)"),
        (X.anchor_label, "tag:data-lake_two", "Data Lake Two"),
        (X.body_shape, " ![a](b.png)\n", "image"),
        (X.body_shape, "[memo 20240101 x.mp3](y)", "audio"),
        (X.body_shape, "![a](b) and text", None),
    ],
)
def test_expression(spark, f, text, want):
    assert one(spark, text, f) == want


def test_regions(spark):
    put = lambda t: one(spark, t, lambda c: X.replace_region(c, F.lit("new"), "r"))
    b, e = "<!-- r:begin -->", "<!-- r:end -->"
    assert put(f"a{b}old{e}z") == f"a{b}\nnew\n{e}z"
    assert put("a") == f"a\n{b}\nnew\n{e}\n"
    assert put(f"{e}{b}") is None and put(b) is None and put(f"{b}{e}{b}{e}") is None
    assert put(f"```\n{b}\n{e}\n```") is None


def test_similarity_is_the_library_ratio(spark):
    a, b = "the quick brown fox " * 20, "the quick brown cat " * 19
    got = spark.createDataFrame([(a, b)], "a string, b string").select(X.similarity("a", "b")).first()[0]
    assert got == round(difflib.SequenceMatcher(None, a, b).ratio(), 6)


def test_scan_and_headers(spark, tmp_path):
    files = {"A/x.md": "---\ntitle: 'T x'\ntags: [a, b]\npeople:\n  - Ann\norg: 3\nodd: yes\n---\nbody x", "wiki/w.md": "w", ".trash/t.md": "t", "classification-review.md": "r", "b.md": "---\ntags: one\n---\nb", "n.txt": "n"}
    for name, text in files.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    got = {p: [r.rel_path for r in S.scan_notes(spark, str(tmp_path), "v", p).orderBy("rel_path").collect()] for p in ("classify", "source", "no_wiki", "no_hidden")}
    assert got["classify"] == ["A/x.md", "b.md"]
    assert got["source"] == ["A/x.md", "b.md", "classification-review.md"]
    assert "wiki/w.md" in got["no_hidden"] and "wiki/w.md" not in got["no_wiki"]
    rows = {r.rel_path: r.h for r in S.scan_notes(spark, str(tmp_path), "v").select("rel_path", S.parse_header(F.col("raw")).alias("h")).collect()}
    h = rows["A/x.md"]
    assert h.ok and h.title == "T x" and h.tags == ["a", "b"] and h.people == ["Ann"] and h.org == "3" and "odd" in h.extra
    assert rows["b.md"].ok and rows["b.md"].tags is None and rows["b.md"].errors == ["tags"]


def test_json_source(spark, tmp_path):
    (tmp_path / "good.json").write_text('{"slug": "a", "n": 1}')
    (tmp_path / "bad.json").write_text("{nope")
    assert [tuple(r) for r in S.read_json(spark, str(tmp_path), "slug string, n long").collect()] == [("a", 1)]
    assert S.read_json(spark, str(tmp_path / "none"), "slug string, n long").count() == 0
    with pytest.raises(Exception):  # noqa: B017
        S.read_json(spark, str(tmp_path), "slug string, n long", strict=True).collect()


def test_export_source(spark, tmp_path):
    (tmp_path / "e.xml").write_text("<export><note><title>A</title><created>2024</created><tag>work_x</tag><tag>b</tag><content>hi</content></note></export>")
    r = S.read_export(spark, str(tmp_path / "e.xml")).first()
    assert (r.title, r.tags, r.content) == ("A", ["work/x", "b"], "hi")


def test_sinks(spark, tmp_path):
    topics = spark.createDataFrame([("a", "active")], "slug string, status string")
    new = spark.createDataFrame([("a", "active"), ("b", "active"), ("B!", "active")], "slug string, status string")
    none = lambda df: df.where("false")
    out = {r.slug: r.outcome for r in K.insert_if_absent(new, topics, str(tmp_path / "t"), none).collect()}
    assert out == {"a": "skipped", "b": "created", "B!": "unsafe"}
    out = {r.slug: r.outcome for r in K.insert_if_absent(new, topics, str(tmp_path / "t"), lambda df: df).collect()}
    assert out["b"] == "rolled_back"
    pages = spark.createDataFrame([("p", "text"), ("q", "<!-- r:begin -->")], "path string, text string")
    bodies = spark.createDataFrame([("p", "x"), ("q", "y"), ("n", "z")], "path string, body string")
    got = {r.path: (r.text, r.ok) for r in K.publish_region(pages, bodies, "r").collect()}
    assert got["n"][1] and "z" in got["n"][0] and got["q"] == ("<!-- r:begin -->", False) and got["p"][0].startswith("text\n")
    fields = spark.createDataFrame([("a", {"x": "1", "topics": "t"})], "rel_path string, fields map<string,string>")
    drop = spark.createDataFrame([("a", [])], "rel_path string, `values` array<string>")
    assert K.set_or_drop_field(fields, drop, "topics").first().fields == {"x": "1"}


def test_alias_boundaries(spark):
    notes = spark.createDataFrame([("a", "the cafe noir opened"), ("b", "decaf and cafes"), ("c", "cafe-noir, cafe noir!")], "rel_path string, folded string")
    topics = spark.createDataFrame([("t", "cafe noir", 0), ("t", "cafe", 1), ("u", "absent", 0)], "slug string, alias string, alias_pos int")
    got = {(r.slug, r.rel_path): r.aliases for r in J.match_topics(notes, topics).collect()}
    assert got == {("t", "a"): ["cafe noir", "cafe"], ("t", "c"): ["cafe noir", "cafe"]}
    assert [r.rel_path for r in J.unmatched_notes(notes, J.match_topics(notes, topics)).collect()] == ["b"]


def test_similarity_tiers(spark):
    base = "".join(chr(97 + i % 26) for i in range(180))
    rows = [("v", "T.md", base), ("v", "T.1.md", base), ("v", "T.2.md", base[:-1] + "#"), ("v", "T.3.md", base[:150] + "#" * 30), ("v", "T.4.md", "#" * 180), ("v", "L.1.md", "x")]
    n = spark.createDataFrame(rows, "vault string, rel_path string, body string")
    got = {r["copy"]: r.tier for r in J.similar_numbered(n).collect()}
    assert got == {"T.1.md": "near_dup", "T.2.md": "near_dup", "T.3.md": "different", "T.4.md": "different", "L.1.md": "orphan"}
    n = n.unionByName(spark.createDataFrame([("v", "L.2.md", "see [[L.1|it]] and [[L.1.md]] and [[T]]")], n.schema)).withColumn("stem", F.regexp_replace("rel_path", ".md$", ""))
    out = L.clean_numbered(n)
    plan = {r["copy"]: r.action for r in out["plan"].collect()}
    assert plan == {"T.1.md": "delete", "T.2.md": "delete", "T.3.md": "keep", "T.4.md": "keep", "L.1.md": "rename", "L.2.md": "collision"}
    assert sorted(r.path for r in out["deletions"].collect()) == ["T.1.md", "T.2.md"]
    assert [(r.rel_path, r.target, r.new_target) for r in out["links"].collect()] == [("L.2.md", "L.1", "L")] * 2
    out = L.dedup(n)
    assert [(r["copy"], r["base"]) for r in out["pairs"].collect()] == [("T.1.md", "T.md")] and out["deletions"].first().stripped_body_chars == 180


def refs(spark, rows):
    return spark.createDataFrame(rows, "node long, anchors array<string>, tokens array<string>")


def test_clusters(spark):
    rows = [(i, ["person:ann"], ["alpha", f"t{i}"]) for i in range(4)] + [(10, [], ["alpha"]), (11, [], ["alpha"])]
    rows += [(20, ["x", "y"], []), (21, ["y"], []), (22, ["x"], []), (23, ["z", "x2"], []), (24, ["z"], [])]
    got = C.cluster_notes(refs(spark, rows)).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.n, r.anchors, r.dominant_anchor, r.dominant_share, r.anchor_density) == (4, ["person:ann"], "person:ann", 1.0, 1.0)
    assert 0 < r.cohesion < 1 and r.route in ("propose", "ledger")


def test_peeling_a_chain(spark):
    # a clique of four with a tail of three: the tail is peeled
    edges = [(a, b) for a in range(4) for b in range(a + 1, 4)] + [(3, 4), (4, 5), (5, 6)]
    anchors = lambda pairs: spark.createDataFrame([(x, f"{a}-{b}") for a, b in pairs for x in (a, b)], "node long, anchor string")
    a = anchors(edges)
    assert sorted(r.node for r in C.dense_core(a, C.components(C.anchor_stars(a)), min_density=0.9).collect()) == [0, 1, 2, 3]
    a = anchors([(i, i + 1) for i in range(30)])
    labels = C.components(C.anchor_stars(a))
    assert {r.component for r in labels.collect()} == {0}
    assert C.dense_core(a, labels, min_size=4).count() == 0


def brute_clusters(notes, min_size=3, min_density=0.7):
    """{cluster: (members, density)} by the rule: thin a component by its least connected member until it is dense."""
    near = {x: {y for y in notes if y != x and notes[x] & notes[y]} for x in notes}
    left, out = {x for x in notes if near[x]}, {}
    while left:
        comp, todo = set(), [min(left)]
        while todo:
            x = todo.pop()
            if x not in comp:
                comp.add(x)
                todo += near[x]
        left -= comp
        name, core = min(comp), set(comp)
        share = lambda c: sum(len(near[x] & c) for x in c) / (len(c) * (len(c) - 1))
        while len(core) >= min_size and share(core) < min_density:
            core.discard(min(core, key=lambda x: (len(near[x] & core), x)))
        if len(core) >= min_size:
            out[name] = (sorted(core), round(share(core), 9))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_clusters_brute(spark, seed):
    """Random notes with several anchors each, against the rule itself; cohesion against all pairs."""
    rng = random.Random(seed)
    notes = {i: {f"a{rng.randrange(20 + 10 * seed)}" for _ in range(rng.randrange(3))} for i in range(120)}
    a = spark.createDataFrame([(x, y) for x, ys in notes.items() for y in ys], "node long, anchor string")
    labels = C.components(C.anchor_stars(a))
    got = {}
    for r in C.dense_core(a, labels).collect():
        got.setdefault(r.cluster, ([], round(r.density, 9)))[0].append(r.node)
    assert {k: (sorted(v), d) for k, (v, d) in got.items()} == brute_clusters(notes)
    refs = spark.createDataFrame([(x, [], [f"t{rng.randrange(12)}" for _ in range(rng.randrange(6))]) for x in notes], "node long, anchors array<string>, tokens array<string>").withColumn("tokens", F.array_distinct("tokens"))
    members = spark.createDataFrame([(x % 3, x) for x in notes if x != 7], "cluster long, node long")
    weights = C.idf(refs)
    pairs = members.select("cluster", F.col("node").alias("src")).join(members.select("cluster", F.col("node").alias("dst")), "cluster").where("src < dst")
    want = pairs.join(C.weighted_jaccard(pairs.select("src", "dst"), refs, weights), ["src", "dst"]).groupBy("cluster").agg(F.avg("similarity").alias("c"))
    for block in (512, 9):
        C.BLOCK = block
        got = {r.cluster: round(r.cohesion, 9) for r in C.cohesion(members, refs, weights).collect()}
        C.BLOCK = 512
        assert got == {r.cluster: round(r.c, 9) for r in want.collect()}


@pytest.mark.parametrize("seed", range(2))
def test_anchor_density(spark, seed):
    """Random notes in overlapping clusters, against the links themselves; the links of a large anchor are never rows."""
    rng = random.Random(seed)
    rows = [(x, f"a{rng.randrange(9)}") for x in range(60) for _ in range(rng.randrange(4))] + [(3, None), (4, None)]
    a = spark.createDataFrame(rows, "node long, anchor string")
    m = spark.createDataFrame([(x % k, x) for x in range(60) for k in (4, 7)], "cluster long, node long").distinct()
    got = lambda df: {r.cluster: (r.n, round(r.density, 9)) for r in df.collect()}
    assert got(C.anchor_density(a, m)) == got(C.density(J.anchor_edges(a.distinct()), m))
    many = spark.range(400_000)
    r = C.anchor_density(many.select(F.col("id").alias("node"), F.lit("all").alias("anchor")), many.select(F.lit(0).alias("cluster"), F.col("id").alias("node"))).first()
    assert (r.n, r.density) == (400_000, 1.0)


@pytest.mark.parametrize(("block", "small"), [(512, 256), (512, 0), (3, 0)])
def test_cohesion_of_repeated_notes(spark, monkeypatch, block, small):
    """Notes of few token sets, in small clusters and in blocks, against all pairs; 300,000 equal notes are one comparison."""
    monkeypatch.setattr(C, "BLOCK", block)
    monkeypatch.setattr(C, "SMALL", small)
    monkeypatch.setattr(C, "TOKENS", 4)
    rng = random.Random(1)
    refs = spark.createDataFrame([(x, rng.sample([f"t{i}" for i in range(7)], rng.randrange(3))) for x in range(90)], "node long, tokens array<string>")
    members, weights = refs.select((F.col("node") % 4).alias("cluster"), "node"), C.idf(refs)
    pairs = members.select("cluster", F.col("node").alias("src")).join(members.select("cluster", F.col("node").alias("dst")), "cluster").where("src < dst")
    want = pairs.join(C.weighted_jaccard(pairs.select("src", "dst"), refs, weights), ["src", "dst"]).groupBy("cluster").agg(F.avg("similarity").alias("c"))
    got = {r.cluster: round(r.cohesion, 9) for r in C.cohesion(members, refs, weights).collect()}
    assert got == {r.cluster: round(r.c, 9) for r in want.collect()}
    many = spark.range(300_000).select(F.col("id").alias("node"), F.array(F.concat(F.lit("t"), F.col("id") % 2)).alias("tokens"))
    all_ = C.cohesion(many.select(F.lit(0).alias("cluster"), "node"), many, C.idf(many)).first().cohesion
    assert abs(all_ - (150_000 - 1) / (300_000 - 1)) < 1e-9


def test_texts_of_a_batch_are_held_in_slices():
    import pyarrow as pa

    from notegraph.operators import matching as M

    batch = pa.RecordBatch.from_pydict({"x": list(range(1000))})
    parts = list(M._slices(iter([batch, batch.slice(0, 0), batch.slice(5, 3)])))
    assert max(map(len, parts)) == M.ROWS
    assert [x for p in parts for x in p["x"].to_pylist()] == [*range(1000), 5, 6, 7]


def test_components_of_a_table(spark, sf):
    """The registered graph, against joining sets in Python; a star and a long chain are one component each."""
    from notegraph.plans.catalog import QUERIES, order_graph

    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for r in order_graph(spark, sf).collect():
        a, b = sorted((find(r.src), find(r.dst)))
        root[b] = a
    got = {r.node: r.component for r in QUERIES["d9_components"](spark, sf).collect()}
    assert got == {x: find(x) for x in list(root)}


def test_weighted_jaccard_reads_texts_once(spark):
    """A pair that is given twice has the same similarity both times; cutting tokens is in the plan of their weights once."""
    texts = [(1, "red blue tan"), (2, "red blue pink"), (3, "grey"), (4, "")]
    refs = spark.createDataFrame(texts, "node long, text string").repartition(2).select("node", X.tokens(F.col("text")).alias("tokens"))
    pairs = spark.createDataFrame([(1, 2), (1, 2), (2, 1), (1, 3), (3, 4), (4, 4), (1, 9)], "src long, dst long")
    got = sorted(map(tuple, C.weighted_jaccard(pairs, refs, C.idf(refs)).collect()))
    w = {r.token: r.idf for r in C.idf(refs).collect()}
    same = (w["red"] + w["blue"]) / sum(w[t] for t in ("red", "blue", "tan", "pink"))
    assert [r[:2] for r in got] == [(1, 2), (1, 2), (1, 3), (1, 9), (2, 1), (3, 4), (4, 4)]
    assert all(abs(s - (same if {a, b} == {1, 2} else 0.0)) < 1e-12 for a, b, s in got)
    plan = C.idf(refs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


def test_components_rounds_leave_out_leaves(spark, monkeypatch):
    """The rounds over a two-sided graph have no node of the upper side; loops, leaves and stars get their component."""
    from notegraph.operators import components as M

    rng = random.Random(3)
    rows = [(x, -rng.randrange(1, 60)) for x in range(1000, 1150) for _ in range(2)] + [(5, 5), (7, 8), (8, 8), (9, 7), (2000, -99), (2001, -99)]
    seen, write = [], M.Scratch.write

    def noted(self, df, name):
        out = write(self, df, name)
        if name in ("moved", "edges"):
            seen.extend(out.select("hi", "lo").collect())
        return out

    monkeypatch.setattr(M.Scratch, "write", noted)
    got = {r.node: r.component for r in C.components(spark.createDataFrame(rows, "src long, dst long")).collect()}
    root = {x: x for r in rows for x in r}
    for _ in root:
        for a, b in rows:
            root[a] = root[b] = min(root[a], root[b])
    assert got == root
    assert seen and all(hi < 0 for hi, _ in seen)
    assert C.components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_cascade_applies_its_rules_once(spark):
    """Each keyword is looked for in one place of the plan; a note without a body is decided on like an empty one."""
    schema = "rel_path string, folder string, title string, body string"
    n = spark.createDataFrame([("a", "f", "t", None), ("b", "f", "t", ""), ("c", "f", "t", "long enough to be kept for review, whatever it says")], schema)
    assert {r.rel_path: (r.decision, r.confidence) for r in L.classify_corpus(n, L.Rules(types={"x": ["zebra"]}, orgs={"o": ["okapi"]})).collect()} == {"a": ("purged", 0.0), "b": ("purged", 0.0), "c": ("review", 0.0)}
    rules = L.Rules(types={"x": ["zebra", "gnu"], "y": ["emu"]}, orgs={"o": ["okapi"]}, titles=[("^The ", "article")], folders=["g"])
    plan = L.classify_corpus(n, rules).groupBy("decision").count()._jdf.queryExecution().optimizedPlan().toString()
    assert [plan.count(w) for w in ("zebra", "gnu", "emu", "okapi")] == [1, 1, 1, 1]
    model = lambda: lambda title, body: {"type": "m", "confidence": 0.9}
    assert {r.rel_path: (r.decision, r.by) for r in L.classify_corpus(n, rules, model).collect()} == {"a": ("purged", "rules"), "b": ("purged", "rules"), "c": ("auto", "model")}


def test_ledger(spark):
    t = lambda d: datetime(2024, 1, d)
    state = spark.createDataFrame([("a", 0.9, 3, t(1), False, ["x", "z"], "old"), ("b", 0.11, 1, t(1), False, [], None), ("c", 2.0, 5, t(20), True, [], None), ("d", 0.01, 9, t(1), True, [], "s")], "key string, evidence double, seen long, last_seen timestamp, promoted boolean, anchors array<string>, signature string")
    seen = spark.createDataFrame([("a", 0.6, 1, t(31), ["y", "x"], "new")], "key string, evidence double, seen long, last_seen timestamp, anchors array<string>, signature string")
    got = {r.key: r for r in G.ledger_step(state, seen, F.lit("2024-01-31").cast("timestamp")).collect()}
    assert set(got) == {"a", "c", "d"}  # b decayed below the floor; what was promoted stays and is not promoted again
    assert (got["a"].anchors, got["a"].signature) == (["x", "y", "z"], "new") and not got["d"].newly and got["d"].signature == "s"
    half_day = G.ledger_step(state.where("key = 'a'"), seen.limit(0), F.lit("2024-01-16 12:00:00").cast("timestamp")).first()
    assert abs(half_day.evidence - 0.9 * 0.5 ** (15.5 / 30)) < 1e-9
    assert got["a"].newly and abs(got["a"].evidence - (0.45 + 0.6)) < 1e-9 and got["a"].seen == 4
    assert not got["c"].newly and got["c"].promoted


def test_first_owner_and_names(spark):
    t = spark.createDataFrame([("a", "s", "x"), ("b", "s", "y"), ("c", "u", "X"), ("d", "v", "z")], "rel_path string, slug string, alias string")
    assert {r.rel_path: r.reason for r in N.first_owner(t).collect()} == {"a": None, "b": "duplicate slug", "c": "duplicate alias", "d": None}
    f = spark.createDataFrame([("1", "f", "n"), ("2", "f", "n"), ("3", "g", "n")], "rel_path string, target string, stem string")
    none = f.where("false").select("target", "stem")
    assert {r.rel_path: r.new_name for r in N.unique_names(f, none).collect()} == {"1": "n", "2": "n_2", "3": "n"}
    assert {r.rel_path: r.new_name for r in N.unique_names(f, f.where("rel_path = '3'").select("target", "stem"), first=1).collect()} == {"1": "n", "2": "n_1", "3": "n_1"}
    names = lambda rows, have=(): {r.rel_path: r.new_name for r in N.unique_names(spark.createDataFrame([(p, "f", s) for p, s in rows], "rel_path string, target string, stem string"), spark.createDataFrame([("f", x) for x in have], "target string, stem string")).collect()}
    assert names([("1", "a")], ["a", "a_2"]) == {"1": "a_3"}
    assert names([("1", "a"), ("2", "a"), ("3", "a_2")]) == {"1": "a", "2": "a_2", "3": "a_2_2"}
    assert names([("1", "x"), ("2", "x"), ("3", "x_2"), ("4", "x_2_2"), ("5", "x_2")]) == {"1": "x", "2": "x_2", "3": "x_2_2", "4": "x_2_2_2", "5": "x_2_3"}


@pytest.mark.parametrize("seed", range(5))
def test_names_brute(spark, seed):
    """Names taken one by one, with names that look like numbered ones."""
    rng = random.Random(seed)
    stems = ["a", "a_2", "a_2_2", "a_3", "b", "b_1", "b_07"]
    files = [(f"{i:03d}", rng.choice("fg"), rng.choice(stems)) for i in range(60)]
    have = [(rng.choice("fg"), rng.choice([*stems, "a_5", "b_3", "b_4"])) for _ in range(6)]
    taken, want = set(have), {}
    for path, folder, stem in files:
        want[path] = next(x for x in itertools.chain([stem], (f"{stem}_{k}" for k in itertools.count(2))) if (folder, x) not in taken)
        taken.add((folder, want[path]))
    df = spark.createDataFrame(files, "rel_path string, target string, stem string")
    assert {r.rel_path: r.new_name for r in N.unique_names(df, spark.createDataFrame(have, "target string, stem string")).collect()} == want


@pytest.mark.parametrize("seed", range(4))
def test_collisions_brute(spark, seed):
    """Proposals accepted one by one; a slug that a rejected proposal asked for is free again."""
    rng = random.Random(seed)
    rows = [(i, f"s{rng.randrange(25)}", [rng.choice("ABcdEfgh") + rng.choice("ßSsx") + str(rng.randrange(4)) for _ in range(rng.randrange(1, 4))]) for i in range(50)]
    slugs, keys, want = {"s1"}, {"cx1"}, []
    for pos, slug, aliases in rows:
        left = [a for a in aliases if a.casefold() not in keys]
        if slug not in slugs and left:
            slugs.add(slug)
            keys |= {a.casefold() for a in left}
            want.append((pos, slug, left))
    df = spark.createDataFrame(rows, "pos long, slug string, aliases array<string>")
    got = J.resolve_collisions(df, spark.createDataFrame([("s1",)], "slug string"), spark.createDataFrame([("CX1",)], "alias string")).collect()
    assert sorted(tuple(r) for r in got) == want


def test_quotes_claims_and_digests(spark):
    n = spark.createDataFrame([("a", "A category. The cat’s here... Wait... CATS no! Un café? le Chat-Noir, oui", ["cat", "CAFÉ", "chat-noir"])], "rel_path string, body string, aliases array<string>")
    assert N.first_quotes(n).first().quotes == ["The cat’s here.", "Un café?", "le Chat-Noir, oui"]
    text = "- One. (src: B1; B2) Two!\n\n  * Three (src: B3) e.g. four\nplain?yes"
    got = spark.createDataFrame([(text,)], "t string").select(X.claims(F.col("t")).alias("c"), X.cited(F.col("t")).alias("r")).first()
    assert got.c == ["- One. (src: B1; B2)", "- Two!", "  * Three (src: B3) e.g.", "  * four", "plain?yes"] and got.r == [1, 2, 3]
    rows = [("k", "b.md", "2"), ("k", "a.md", "1"), ("j", "ü", "3"), ("k", "a.md", "0")]
    got = {r.slug: (r.n_sources, r.set_hash) for r in A.source_set_hash(spark.createDataFrame(rows, "slug string, rel_path string, body_sha string"), ["slug"]).collect()}
    digest = lambda xs: "sha256:" + hashlib.sha256("".join(f"{p}\0{s}\n" for p, s in sorted(xs)).encode()).hexdigest()
    assert got == {k: (len(xs), digest(xs)) for k in "kj" for xs in [[(p, s) for q, p, s in rows if q == k]]}
    score = lambda *x: spark.range(1).select(A.health_score(*map(F.lit, x)).alias("s")).first().s
    assert score(0.5, 3, 0, 1, 0, True) == 58 and score(2.0, 0, 0, 0, 0, True) == 100 and score(0.8, 1, 1, 1, 1, False) == 28


def test_upserts_and_inserts_of_one_key(spark):
    index = spark.createDataFrame([("a", "old"), ("z", "stays")], "slug string, line string")
    updates = spark.createDataFrame([("a", "z first", 1), ("a", "b last", 2), ("n", "new", 1)], "slug string, line string, at int")
    assert {(r.slug, r.line) for r in K.upsert_lines(index, updates, order="at").collect()} == {("a", "b last"), ("z", "stays"), ("n", "new")}
    p = spark.createDataFrame([(2, "x"), (1, "x"), (3, "x y"), (4, None)], "pos int, slug string")
    assert {r.pos: r.outcome for r in K.insert_plan(p, p.limit(0), order="pos").collect()} == {1: "created", 2: "skipped", 3: "unsafe", 4: "unsafe"}


def test_odd_aliases(spark):
    """Aliases that begin or end with a mark, or are marks alone; white space between words counts as it is."""
    n = spark.createDataFrame([("a", "c++ and .net, also c+++"), ("b", "plain c\nnet core"), ("c", "x.net or c ++ net  core"), ("d", "!?"), ("e", "net core")], "rel_path string, folded string")
    t = spark.createDataFrame([("cpp", "c++", 0), ("net", ".net", 0), ("core", "net core", 0), ("odd", "?", 0), ("q", "\\E", 0)], "slug string, alias string, alias_pos int")
    assert {(r.slug, r.rel_path) for r in J.match_topics(n, t).collect()} == {("cpp", "a"), ("net", "a"), ("core", "b"), ("core", "e"), ("odd", "d")}


def test_filters(spark):
    df = spark.createDataFrame([("x", None), ("y", "b")], "a string, b string")
    assert [r.a for r in P.field_filters(df, ["b=None"]).collect()] == ["x"]
    assert [r.a for r in P.field_filters(df, ["missing=None", "a=y"]).collect()] == ["y"]
    with pytest.raises(ValueError):
        P.field_filters(df, ["oops"])
    paths = {"a/b": None, "../a": "outside", "a/../../b": "outside", "/a": "outside", "": "empty", "a/../b": None}
    got = spark.createDataFrame([(p,) for p in paths], "p string").select("p", P.path_inside(F.col("p")).alias("e")).collect()
    assert {r.p: r.e for r in got} == paths


RULES = L.Rules(types={"meeting": ["standup", "agenda"], "recipe": ["flour", "oven"]}, orgs={"Acme": ["acme"]}, titles=[(r"(?i)\bwebinar\b", "webinar")], folders=["Acme"], work_orgs=["Acme"], tags={"food": ["oven"]})


def notes(spark, rows):
    return spark.createDataFrame([(f"{i}.md", *r) for i, r in enumerate(rows)], "rel_path string, title string, body string, folder string")


def test_cascade(spark):
    n = notes(spark, [
        ("plan", "acme standup agenda of the long meeting that we had", "x"),
        ("plan", "one standup only, and then a lot of other words here", "x"),
        ("Webinar", "talk about nothing in particular, but at length indeed", "Acme"),
        ("pic", "![a](b.png)", "Acme"),
        ("tiny", "hm", "x"),
        ("odd", "nothing that any rule knows, so the model has its say", "x"),
    ])

    def model():
        def call(title, body):
            if title == "odd":
                return {"type": "essay", "confidence": 3.0}
            if title == "plan":
                raise RuntimeError("down")
            return {"confidence": 0.1}

        return call

    got = {r.rel_path: r for r in L.classify_corpus(n, RULES, model).collect()}
    assert (got["0.md"].type, got["0.md"].org, got["0.md"].decision) == ("meeting", "Acme", "auto")
    assert (got["1.md"].type, got["1.md"].confidence, got["1.md"].decision) == ("meeting", 0.0, "review")
    assert (got["2.md"].type, got["2.md"].org, got["2.md"].confidence) == ("webinar", "Acme", 0.95)
    assert (got["3.md"].type, got["3.md"].context, got["3.md"].confidence) == ("clipping", "work", 0.85)
    assert got["4.md"].decision == "purged"
    assert (got["5.md"].type, got["5.md"].by, got["5.md"].confidence, got["5.md"].decision) == ("essay", "model", 1.0, "auto")
    kept = {r.rel_path: r.decision for r in L.classify_corpus(n, RULES, None, purge=False).collect()}
    assert kept["4.md"] == "review"


def test_repair_links(spark):
    g = "0a1b2c3d-0000-1111-2222-333344445555"
    n = notes(spark, [("Target  Note", "x", "f"), ("src", f"see [t](https://s/{g}/) and [u](https://s/none)", "f")]).withColumn("stem", F.regexp_replace("rel_path", ".md", ""))
    got = {r.rel_path: r for r in L.repair_links(n, spark.createDataFrame([(g, "target note")], "guid string, title string"), X.guid_of).collect()}
    assert got["1.md"].body == "see [[0|t]] and [u](https://s/none)"
    assert (got["1.md"].resolved, got["1.md"].unresolved) == (1, 1)


def test_report(spark):
    none = spark.createDataFrame([], "vault string, rel_path string")
    r = L.corpus_report(none, F.lit(True))["totals"].first()
    assert (r.vault, r.ratio, r.health) == ("*", 1.0, 100)
    lines = spark.createDataFrame([("# head",), ("Generated: x",), ("| a | b |",), ("|---|---|",), ("| 1 | 2 |",)], "value string")
    assert A.review_queue_count(lines).first().n == 1


def test_report_counts_debris(spark):
    n = spark.createDataFrame([("a", "x.md", None, ["[[t]]", "[[gone]]"], True), ("a", "y.md", "[[x]]", None, False), ("b", "x.md", "[[nowhere]]", None, True), ("b", "z.md", "x", None, True)], "vault string, rel_path string, up string, topics array<string>, done boolean")
    queue = spark.createDataFrame([("a",), ("a",)], "vault string")
    topics = spark.createDataFrame([("t", None, "h"), ("u", None, None)], "slug string, updated string, source_set_hash string")
    sets = spark.createDataFrame([("t", 2, "other")], "slug string, n_sources long, set_hash string")
    r = L.corpus_report(n, F.col("done"), topics=topics, sets=sets, queue=queue)
    assert {x.vault: x.health for x in r["totals"].collect()} == {"a": 72, "b": 85, "*": 56}
    assert [(x.vault, x.rel_path) for x in r["orphans"].collect()] == [("b", "x.md")] and [x.slug for x in r["dangling"].collect()] == ["gone"]
    assert {x.slug: x.hash_changed for x in r["freshness"].collect()} == {"t": True, "u": None}
    assert {x.vault: x.health for x in L.corpus_report(n, F.col("done"), complete=False)["totals"].collect()} == {"a": 62, "b": 65, "*": 56}


def test_nightly_runs_every_step(spark):
    """Unmatched notes are proposed from, topics get pages, and notes get links."""
    from notegraph.plans import generate as G2
    from notegraph.plans.catalog_jobs import _writer

    rows = [(f"n{i}.md", f"n{i}", "v", f"Met Ann Lee {i}", f"We met Ann Lee about garden plans number {i}, once more", datetime(2024, 1, 20), ["[[old]]"]) for i in range(5)]
    rows += [("cafe.md", "cafe", "v", "c", "the cafe noir has opened its doors again", datetime(2024, 1, 20), ["[[mine]]"]), ("cafe.1.md", "cafe.1", "v", "c", "the cafe noir has opened its doors again", datetime(2024, 1, 20), [])]
    n = spark.createDataFrame(rows, "rel_path string, stem string, vault string, title string, body string, mtime timestamp, topics array<string>").withColumn("folder", F.lit("x"))
    topics = spark.createDataFrame([("cafe", "cafe noir", 0), ("old", "never there", 0)], "slug string, alias string, alias_pos int")
    done = spark.createDataFrame([], "rel_path string, classified_by string")
    t = G2.nightly_tables(n, done, RULES, topics, writer=_writer)
    assert [r.slug for r in t["proposals"].collect()] == ["ann-lee"]
    assert [(r.slug, r.n_sources) for r in t["pages"].collect()] == [("cafe", 1)] and "cafe.md" in t["pages"].first().page
    links = {r.rel_path: r.topics for r in t["links"].collect()}
    assert links == {f"n{i}.md": None for i in range(5)} | {"cafe.md": ["[[mine]]", "[[cafe]]"]}
    known = t["pages"].select("slug", F.col("set_hash").alias("source_set_hash"))
    got = {r.step: (r.n, r.detail) for r in G2.nightly(n, done, RULES, topics, known=known).collect()}
    assert list(got) == ["classify", "collect", "propose", "synthesize", "backlink", "report"]
    assert got["propose"][0] == 1 and got["synthesize"] == (0, "0 written, 0 degraded") and got["backlink"] == (6, "5")


def test_incremental(spark):
    n = spark.createDataFrame([("a",), ("b",), ("c",)], "rel_path string")
    done = spark.createDataFrame([("a", None), ("b", "export")], "rel_path string, classified_by string")
    assert [r.rel_path for r in I.todo(n, done, cap=1).collect()] == ["b"]
    topics = spark.createDataFrame([("a", "h"), ("b", "old"), ("c", None), ("d", "x")], "slug string, source_set_hash string")
    sets = spark.createDataFrame([("a", "h", 2), ("b", "new", 1), ("c", "k", 1), ("d", "y", 0)], "slug string, set_hash string, n_sources long")
    assert {r.slug for r in I.skip_unchanged(topics, sets).collect()} == {"b", "c"}
    assert {r.slug for r in I.skip_unchanged(topics, sets, force=True).collect()} == {"a", "b", "c"}


def test_stream_equals_batch(spark, sf, tmp_path):
    docs = S.notes_from_documents(spark.read.parquet(f"{sf}/documents.parquet")).drop("doc_id")
    parts = docs.randomSplit([0.5, 0.5], 1)
    schema = ", ".join(f"{k} {t}" for k, t in docs.dtypes)
    classify = lambda d: L.classify_rules(d, RULES)
    for p in parts:
        p.write.mode("append").parquet(f"{tmp_path}/in")
        I.classify_stream(spark, f"{tmp_path}/in", schema, classify, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out").select("rel_path", "type", "confidence").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, classify(docs).select("rel_path", "type", "confidence").collect()))


def test_ledger_stream(spark, tmp_path):
    t = lambda d: datetime(2024, 1, d)
    schema = "key string, evidence double, ts timestamp"
    for i, rows in enumerate([[("a", 0.6, t(1)), ("b", 0.2, t(1)), ("c", 0.05, t(1))], [("a", 0.8, t(31))]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        src = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        q = G.ledger_stream(src).writeStream.foreachBatch(lambda df, _: df.write.mode("append").parquet(f"{tmp_path}/out")).outputMode("update").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
        q.awaitTermination()
        del i
    last = spark.read.parquet(f"{tmp_path}/out").groupBy("key").agg(F.max_by(F.struct("evidence", "seen", "promoted"), "seen").alias("s")).collect()
    got = {r.key: tuple(r.s) for r in last}
    assert got["a"][1:] == (2, True) and abs(got["a"][0] - (0.3 + 0.8)) < 1e-9 and got["b"][1:] == (1, False)
    assert set(got) == {"a", "b"}  # c never was above the floor


def _labels(edges):
    above = {}

    def root(x):
        above.setdefault(x, x)
        while above[x] != x:
            x = above[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        above[max(a, b)] = min(a, b)
    return {x: root(x) for x in above}


def test_components_of_hubs_and_chains(spark, monkeypatch):
    """Hubs with a large and a small number, whose joins are heavy; a shuffled chain takes rounds by its logarithm."""
    import random

    from notegraph.operators import components as O

    monkeypatch.setattr(O, "LEAST", 50)
    rounds = []
    write = O.Scratch.write
    monkeypatch.setattr(O.Scratch, "write", lambda self, df, name: (rounds.append(name), write(self, df, name))[1])
    rng = random.Random(1)
    order = list(range(1000, 3000))
    rng.shuffle(order)
    edges = [(0, i) for i in range(1, 400)] + [(900, i) for i in range(500, 900)] + list(zip(order, order[1:])) + [(5000, 5000), (4000, 4001), (4001, 4001)]
    got = {r.node: r.component for r in O.components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == _labels(edges)
    assert rounds.count("moved") <= 14
    assert O.components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_aliases_of_a_table_too_large_for_one_automaton(spark, monkeypatch):
    from notegraph.operators import matching as M

    n = spark.createDataFrame([("a", "c++ and .net, also c+++"), ("b", "plain c\nnet core, the cafe"), ("c", "x.net or c ++ net  core"), ("d", "!?"), ("e", "net core"), ("f", None), ("g", "")], "rel_path string, folded string")
    rows = [("cpp", "c++", 0), ("net", ".net", 0), ("core", "net core", 0), ("odd", "?", 0), ("cafe", "cafe", 1), ("cafe", "the cafe", 0), ("none", "the c", 0), ("gone", "absent words", 0), ("blank", "", 0)]
    t = spark.createDataFrame(rows, "slug string, alias string, alias_pos int")
    whole = sorted(tuple(r) for r in M.match_topics(n, t).collect())
    assert ("cafe", "b", ["the cafe", "cafe"]) in whole and len(whole) == 6
    monkeypatch.setattr(M, "MOST_ALIASES", 2)
    assert sorted(tuple(r) for r in M.match_topics(n, t).collect()) == whole
    assert M.match_topics(n, t.where("false")).count() == 0


def test_numbers_over_ranges(spark):
    """A group of nearly all rows, ties, nulls, and one group of all rows."""
    from notegraph.operators.numbering import numbered
    from notegraph.session import Scratch

    rows = [("big", i % 700, i) for i in range(2000)] + [(None, 1, -1), (None, None, -2), ("b", 5, -3)]
    df = spark.createDataFrame(rows, "g string, v long, id long").repartition(5)
    scratch = Scratch(spark, "test")
    got = numbered(df, ["g"], ["v", "id"], scratch, "one").collect()
    want = {}
    for g, v, i in sorted(rows, key=lambda r: (r[0] or "", r[1] is not None, r[1] or 0, r[2])):
        want.setdefault(g, []).append(i)
    assert {(r.g, r.idx): r.id for r in got} == {(g, k + 1): i for g, ids in want.items() for k, i in enumerate(ids)}
    got = numbered(df, [], [F.col("id").desc()], scratch, "all").orderBy("idx").collect()
    assert [r.idx for r in got] == list(range(1, 2004)) and [r.id for r in got] == sorted((r[2] for r in rows), reverse=True)
    scratch.close()


def test_edges_of_a_large_anchor(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 7)
    rows = [("hot", i) for i in range(40)] + [("x", i) for i in range(0, 40, 9)] + [("x", 100), ("y", 100), ("y", 101), ("z", 5)]
    got = [(r.src, r.dst) for r in J.anchor_edges(spark.createDataFrame(rows, "anchor string, node long")).collect()]
    want = {(a, b) for k, a in rows for m, b in rows if k == m and a < b}
    assert len(got) == len(set(got)) and set(got) == want


def test_cleanup_deletes_intermediate_tables(spark):
    import os

    from notegraph import session as S

    S.cleanup(spark)
    kept = S.materialize(spark.range(3), "kept")
    scratch = S.Scratch(spark, "job")
    scratch.write(spark.range(3), "t")
    folder = kept.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    assert kept.count() == 3 and os.path.isdir(folder)
    assert S.cleanup(spark) == 2 and not os.path.exists(folder) and not os.path.exists(scratch.folder.removeprefix("file:"))


def _one_by_one(rows, slugs, keys):
    out = []
    for pos, slug, aliases in sorted(rows):
        left = [a for a in aliases if a.casefold() not in keys]
        if slug not in slugs and left:
            slugs.add(slug)
            keys |= {a.casefold() for a in left}
            out.append((pos, slug, left))
    return out


def test_a_chain_of_collisions_takes_few_rounds(spark, monkeypatch):
    """10,000 proposals of which each asks for what the one before asks for; few jobs, and the outcome of one by one."""
    rounds = []
    write = J.Scratch.write
    monkeypatch.setattr(J.Scratch, "write", lambda self, df, name: (rounds.append(name), write(self, df, name))[1])
    rows = [(i, f"s{i}", [f"a{i}", f"a{i + 1}"] if i % 2 else [f"a{i}"]) for i in range(5000)]
    rows += [(5000 + i, f"t{(i + 1) // 2}", [f"b{i // 2}", f"b{i // 2}x"]) for i in range(5000)]
    df = spark.createDataFrame(rows, "pos long, slug string, aliases array<string>").repartition(8)
    got = J.resolve_collisions(df, spark.createDataFrame([("t7",)], "slug string"), spark.createDataFrame([("B9",)], "alias string")).collect()
    assert sorted(tuple(r) for r in got) == _one_by_one(rows, {"t7"}, {"b9"})
    assert rounds.count("asked") <= 6 and rounds.count("outcomes") <= 20


def test_collisions_of_random_proposals(spark):
    import random

    rng = random.Random(2)
    rows = [(i, f"s{rng.randrange(60)}", rng.sample([f"{'aA'[rng.randrange(2)]}{k}" for k in range(80)], rng.randint(1, 3))) for i in range(150)]
    df = spark.createDataFrame(rows, "pos long, slug string, aliases array<string>")
    got = J.resolve_collisions(df, spark.createDataFrame([("s1",)], "slug string"), spark.createDataFrame([("A2",)], "alias string")).collect()
    assert sorted(tuple(r) for r in got) == _one_by_one(rows, {"s1"}, {"a2"})


def test_globs_of_a_column(spark):
    rows = [("a/b.md", "a/*"), ("a/b.md", "b.md"), ("a/b.md\n", "a/b.md"), ("x1.md", "x[0-9].md"), ("xa.md", "x[!0-9].md"), (None, "*"), ("a", None), ("a+b", "a+b")]
    got = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, v string, g string").select("i", P.matches_glob("v", "g").alias("m")).orderBy("i").collect()
    assert [r.m for r in got] == [True, False, False, True, True, None, None, True]
