"""HTML extraction, top-k search, chat formatting, WARC archives and the pipeline."""

import base64
import hashlib
import io
import json
import random
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from notegraph.llm import chat, html_extract, mih, mixing, warczip
from tests.llm.test_text_ops import brute_components, check_pack, empty, odd_rows, reference_ids

# --- HTML extraction

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="</p>";</script></head>
<body class="has-sidebar"><header class="top"><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies</div><div class="ad">Buy %d</div>
<article><header><h1>Title &amp; %d</h1><p>By someone</p></header><p>First   para
graph <b>bold</b>&nbsp;x.<p>Second&#33; one<ul><li>item a<li>item b</ul><form><input value=q>Search</form>
<div class="share-buttons">Share</div><table><tr><td>c1<td>c2</table></article>
<section id="comments"><article class="comment"><p>Reader %d</p></article></section>
<aside>Related</aside><footer>&copy; Site</footer></body></html>"""
WANT = ["Title & %d", "First para graph bold x.", "Second! one", "item a", "item b", "c1", "c2"]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, host string")


def texts(df):
    return {r.id: r.blocks for r in html_extract.extract(df).collect()}


def test_html_roles(spark):
    rows = [(i, f"https://a.example/{i}", PAGE % (i, i, i)) for i in range(8)]
    got = texts(pages(spark, rows))
    assert got == {i: [WANT[0] % i, *WANT[1:]] for i in range(8)}


def test_html_wrapper(spark):
    """Without marked articles, what all pages of a host repeat goes; what varies stays; other hosts do not matter."""
    page = "<html><body><div id=logo>The Daily Page</div><div id=text><p>Story {0} begins</p><p>and it ends {0}</p></div><div id=foot>All rights reserved</div></body></html>"
    rows = [(i, f"http://news.example/{i}", page.format(i)) for i in range(9)] + [(20, "http://lone.example/", page.format(20))]
    got = texts(pages(spark, rows))
    for i in range(9):
        assert got[i] == [f"Story {i} begins", f"and it ends {i}"]
    assert got[20] == ["The Daily Page", "Story 20 begins", "and it ends 20", "All rights reserved"]


def test_html_copies_are_kept(spark):
    page = "<html><body><p>One story on many pages</p><p>with two blocks</p></body></html>"
    got = texts(pages(spark, [(i, f"http://m.example/{i}", page) for i in range(10)]))
    assert all(v == ["One story on many pages", "with two blocks"] for v in got.values())


def test_html_names_that_change(spark):
    """Ids and classes of one page only do not hide the template; copies of an article are one witness."""
    page = "<html><body class='s{0} post-{0}'><div id=logo>The Daily Page</div><div id=post-{0}><p>Story {0} begins</p><p>and it ends {0}</p></div><div id=foot>All rights reserved</div></body></html>"
    rows = [(i, f"http://n.example/{i}", page.format(i)) for i in range(9)] + [(i, f"http://small.example/{i}", page.format(i)) for i in range(20, 23)]
    got = texts(pages(spark, rows))
    assert got == {i: [f"Story {i} begins", f"and it ends {i}"] for i in [*range(9), *range(20, 23)]}
    copy = "<html><body><div>{0}</div><div><p>One story on many pages</p><p>with two blocks</p></div></body></html>"
    got = texts(pages(spark, [(i, f"http://m.example/{i}", copy.format("a" if i % 2 else "b")) for i in range(10)]))
    assert all(v[1:] == ["One story on many pages", "with two blocks"] for v in got.values())


def test_html_constant_lines_in_articles(spark):
    """A line that a whole host repeats inside its marked articles goes; copies and near copies of an article stay."""
    page = "<html><body><article><h1>Story {0}</h1>{1}<p>Read also our other stories</p></article></body></html>"
    own = lambda i: [f"Paragraph {k} of the story {i} tells something new" for k in range(1 + i % 5)]
    rows = [(i, f"http://a.example/{i}", page.format(i, "".join(f"<p>{t}</p>" for t in own(i)))) for i in range(12)]
    copies = [f"<html><body><main><p>A long story that many pages of the host repeat</p><p>Seen {i} times</p></main></body></html>" for i in range(10)]
    got = texts(pages(spark, rows + [(100 + i, f"http://c.example/{i}", x) for i, x in enumerate(copies)]))
    for i in range(12):
        assert got[i] == [f"Story {i}", *own(i)]
    for i in range(10):
        assert got[100 + i] == ["A long story that many pages of the host repeat", f"Seen {i} times"]


def test_tree_matching_large():
    """Beyond a table's bound alike children still hold the two sides together."""
    page = lambda k, n: html_extract.parse("<div>" + "".join(f"<p>{k} {i}</p>" for i in range(n)) + "<p>Read also</p>" + "".join(f"<b>{k} {i}</b>" for i in range(n)) + "</div>")
    got = [(x.text, y.text) for x, y in html_extract.match_trees(page("a", 300), page("b", 400))]
    assert ("Read also", "Read also") in got and len(got) == 601


def test_html_odd(spark):
    rows = [(1, None, None), (2, "", ""), (3, "nonsense", "<p>open <b>never closed"), (4, "http://x/", "< no tag &amp; &lt;p&gt; &unknown; &#x41;"), (None, "http://x/", "<div>" * 300 + "deep" + "</div>" * 200), (6, "http://x/", "<div>" * 5000 + "<p>far down</p>" + "</div>" * 4999 + '<p>on <a href="q"">top</a></p><b class="'), (5, "http://x/", "<p>a<br>b</p>text<!-- open comment"), (5, "http://x/", "<p>a<br>b</p>text<!-- open comment")]
    got = html_extract.extract(pages(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = {r.id: r.blocks for r in got}
    assert by_id[1] == [] and by_id[2] == [] and by_id[3] == ["open never closed"]
    assert by_id[4] == ["< no tag & <p> &unknown; A"] and by_id[None] == ["deep"] and by_id[5] == ["a b", "text"]
    assert by_id[6] == ["far down", "on top"]
    assert html_extract.extract(pages(spark, [])).count() == 0


def test_html_tables(spark, sf):
    """On the given pages the article's blocks can be found by pattern, too."""
    import html as h
    import re

    got = {r.page_id: r for r in html_extract.op3_html_extraction(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        body = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        parts = [" ".join(h.unescape(re.sub(r"<br>|</?b>", " ", x)).split()) for x in re.split(r"</?p>|</?h1>", body)]
        assert got[r.page_id].text == "\n".join(p for p in parts if p)
        assert got[r.page_id].n_chars == len(got[r.page_id].text)


@pytest.mark.parametrize("seed", range(30))
def test_tree_matching_brute(seed):
    """Random small trees against all order-preserving ways to match their children."""
    rng = random.Random(seed)

    def grow(depth):
        if not depth or rng.random() < 0.3:
            return rng.choice("stu")
        tag = rng.choice(["b", "i", 'i class="k"'])
        return f"<{tag}>" + "".join(grow(depth - 1) for _ in range(rng.randrange(4))) + f"</{tag[0]}>"

    def brute(x, y):
        if x.tag == "#":
            return 1 + (x.text == y.text)
        return x.size if x.sum == y.sum else 1 + (x.label == y.label) + ways(x.kids, y.kids)

    def ways(xs, ys):
        if not xs or not ys:
            return 0
        return max(ways(xs[1:], ys), *(brute(xs[0], y) + ways(xs[1:], ys[j + 1 :]) for j, y in enumerate(ys) if y.tag == xs[0].tag), 0)

    for _ in range(20):
        a, b = (html_extract.parse("".join(grow(3) for _ in range(3))) for _ in range(2))
        score, leaves = html_extract.best_match(a, b)
        assert score == brute(a, b)
        assert len({id(x) for x, _ in leaves}) == len(leaves) == len({id(y) for _, y in leaves})


def test_tree_matching_prefers_more():
    a = html_extract.parse("<ul><li>s</li><li><b>x</b><i>y</i><u>z</u></li></ul>")
    b = html_extract.parse("<ul><li><b>x</b><i>y</i><u>z</u></li></ul>")
    assert sorted(x.text for x, _ in html_extract.match_trees(a, b)) == ["x", "y", "z"]


def test_html_without_article_marks(spark, sf):
    """On the given pages nothing depends on the tag that marks the article."""
    p = spark.read.parquet(f"{sf}/pages.parquet")
    bare = p.withColumn("html", F.regexp_replace("html", "</?article>", ""))
    rows = lambda df: {r.id: r.blocks for r in html_extract.extract(df).collect()}
    assert rows(p) == rows(bare)


def test_html_wrapper_knows_chrome(spark):
    """A menu, an advert or a foot that one page does not mark is known by its place in the host's other pages."""
    page = "<html><body><div{1}>Buy {0} now</div><div><p>Story {0} begins</p><p>and it ends {0}</p></div><div{2}>Foot {0}</div></body></html>"
    rows = [(i, f"http://w.example/{i}", page.format(i, *(("", "") if i == 3 else (" class=ad", " class=footer")))) for i in range(12)]
    assert texts(pages(spark, rows)) == {i: [f"Story {i} begins", f"and it ends {i}"] for i in range(12)}


def test_html_keeps_what_is_no_chrome(spark):
    """Lists of links, formulas, drawings and open dialogs are text; deep elements keep their blocks and marks."""
    deep = "<div>" * 300
    rows = [
        (1, "http://a/", "<ul><li><a href=x>One</a></li><li><a href=y>Two</a></li></ul>"),
        (2, "http://b/", "<article><p>E = <math><mi>m</mi><mi>c</mi></math></p><svg><title>icon</title><text>Label</text></svg><object>An object</object><dialog>No</dialog><dialog open>Yes</dialog></article>"),
        (3, "http://c/", deep + "<div>a</div>b<nav>menu <i>x</i></nav><p>c</p>" + "</div>" * 300),
    ]
    assert texts(pages(spark, rows)) == {1: ["One", "Two"], 2: ["E = mc", "LabelAn object", "Yes"], 3: ["a", "b", "c"]}


def test_tree_matching_is_best():
    a = html_extract.parse("<div><p>x</p><ul><li>1</li></ul><p>y</p></div>").children[0]
    b = html_extract.parse("<div><ul><li>1</li><li>2</li></ul><p>y</p></div>").children[0]
    assert sorted((x.text, y.text) for x, y in html_extract.match_trees(a, b)) == [("1", "1"), ("y", "y")]


# --- top-k


def test_codes_have_all_values(spark):
    code = lambda n: [list(r.code) for r in mih.sign_codes(spark.createDataFrame([(1, [1.0] * n)], "vec_id long, embedding array<double>")).collect()]
    assert code(64) == [[-1]] and code(3) == [[7]] and code(65) == [[-1, 1]] and code(128) == [[-1, -1]]


@pytest.mark.parametrize("segments", [None, 3, 40])
def test_topk_wide(spark, segments):
    """Vectors of 128 values, and shorter ones among them, against all distances; 40 segments lie across words."""
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(size=128 if i % 9 else 100)]) for i in range(300)]
    rows += [(1000 + i, [x if rng.random() > 0.05 else -x for x in v]) for i, v in rows[:100]]
    codes = mih.sign_codes(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = {tuple(r) for r in mih.topk(codes, codes.where("id % 10 = 0"), 5, segments).collect()}
    # the bits of a word as a number, first value first, as the docstring says of vectors that end early
    pack = lambda v: tuple(int("".join("01"[x >= 0] for x in v[at : at + 64]) or "0", 2) for at in (0, 64))
    bits, want = {i: pack(v) for i, v in rows}, set()
    for q in bits:
        if q % 10 == 0:
            near = sorted((sum((a ^ b).bit_count() for a, b in zip(bits[q], bits[i], strict=True)), i) for i in bits if i != q)[:5]
            want |= {(q, i, d, k + 1) for k, (d, i) in enumerate(near)}
    assert got == want


def test_topk_sql(spark, sf, duck, same):
    same(mih.op6_exact_topk(spark, sf), duck.sql(mih.OP6_SQL))


@pytest.mark.parametrize("segments", [None, 3, 8])
def test_topk_brute(spark, segments):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, 12, dtype=np.int64)
    codes = [int(centres[i % 12] ^ np.bitwise_or.reduce(np.int64(1) << rng.integers(0, 63, int(rng.integers(0, 9))), initial=np.int64(0))) for i in range(600)] + [int(centres[0])] * 200
    base = spark.createDataFrame(list(enumerate(codes)), "id long, code long")
    got = mih.topk(base, base.where("id % 50 = 0"), 7, segments).collect()
    arr = np.array(codes, np.int64).view(np.uint64)
    want = set()
    for q in range(0, 800, 50):
        d = np.bitwise_count(arr ^ arr[q])
        order = sorted((int(d[i]), i) for i in range(800) if i != q)[:7]
        want |= {(q, i, x, rank + 1) for rank, (x, i) in enumerate(order)}
    assert {tuple(r) for r in got} == want


def test_topk_odd(spark):
    rows = [(1, [0.1, -0.2]), (2, None), (None, [1.0, 1.0]), (3, [0.1, -0.2]), (3, [0.1, -0.2]), (4, [])]
    codes = mih.sign_codes(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = {(r.query_id, r.neighbor_id, r.distance) for r in mih.topk(codes, codes, 5).collect()}
    assert got == {(1, 3, 0), (1, 4, 1), (3, 1, 0), (3, 4, 1), (4, 1, 1), (4, 3, 1)}
    none = codes.where("id < 0")
    assert mih.topk(none, none, 5).count() == 0
    extra = codes.withColumns({c: F.lit("x") for c in ("first", "d", "val", "seg", "worst", "block", "part", "rn")})
    assert mih.topk(extra, extra, 5).count() == 6


def test_topk_driver(spark, monkeypatch):
    """Nothing of a table goes through the driver, small as the tables are here: no join broadcasts a side."""
    plans = []

    def seen(self, df, name, write=mih.Scratch.write):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return write(self, df, name)

    monkeypatch.setattr(mih.Scratch, "write", seen)
    monkeypatch.setattr(mih, "materialize", lambda df, name: seen(mih.Scratch(spark, name), df, name))
    # far apart, so that the queries end with all codes, block by block
    rng = np.random.default_rng(7)
    base = spark.createDataFrame([(i, int(c)) for i, c in enumerate(rng.integers(0, 1 << 62, 300, dtype=np.int64))], "id long, code long")
    assert mih.topk(base, base.where("id % 50 = 0"), 5, 3).count() == 30
    assert {"members", "counts", "index", "state", "all", "near", "mih"} == {name for name, _ in plans}
    assert sum("SortMergeJoin" in plan for _, plan in plans) >= 5
    assert not [name for name, plan in plans if "Broadcast" in plan]


# --- chat


def digests(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        said = "".join(t for _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


def test_chat_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", chat.PLANTED), (-7, 1, "assistant", chat.PLANTED)]
    got = {r.conv_id: tuple(r)[1:5] for r in chat.op9_chat_formatting(spark, sf).collect()}
    assert got == digests(rows)


def test_chat_odd(spark):
    texts = ["", None, "\\", "\\\\", "###", "\\###", "</turn>", "x</turn>\n### User:\n", "a\\</turn>\\", "ends with \\", "é\U0001f600\r\n\x00"]
    rows = [(1, i, ("user", "assistant", None, "we:ird\nro\\le ### \0\\n a\0b")[i % 4], t) for i, t in enumerate(texts * 3)]
    rows += [(2, i, "assistant", f"t{i}") for i in range(700)] + [(None, 0, "user", "hi"), (None, 0, "assistant", "a"), (3, 0, "user", "b"), (3, 0, "user", "a"), (3, 0, "user", "a")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "conv_id long, turn long, role string, text string, conv string")
    formatted = chat.format_conversations(df)
    rows = [(-10 - i if r[0] is None else r[0], *r[1:]) for i, r in enumerate(rows)]  # rows without an id stand alone
    got = [tuple(r)[:5] for r in chat.read_back(formatted).collect()]
    assert sorted(map(repr, got)) == sorted(repr((None if k < 0 else k, *v)) for k, v in digests(rows).items())
    assert formatted.where("rewrote_at is not null").count() == 0
    assert formatted.where("conv = 2").count() == 1 and formatted.where("conv is null").count() == 2
    for r in formatted.collect():  # the mask holds the assistant's text and no mark
        for m in r.spans:
            if m.loss_start is not None:
                assert r.formatted[m.start : m.loss_start] == "### assistant:\n" and r.formatted[m.loss_end : m.end] == "</turn>\n"
    assert chat.read_back(chat.format_conversations(df.where("conv_id = 99"))).count() == 0


def test_chat_spans_of_other_templates():
    turns = [("user", "a<"), ("assistant", "b"), ("user", "c")]
    closing = lambda ts: "<s>" + "".join(f"<{r}>{t}" for r, t in ts) + "</s>"
    text, found, rewrote = chat.spans(closing, turns)
    assert rewrote is None and [text[a:b] for a, b in found] == ["<user>a<", "<assistant>b", "<user>c"]

    def forgetful(ts):  # leaves out what assistants said before the last turn
        return "".join(f"[{r}]{t if r == 'user' or i == len(ts) - 1 else ''}" for i, (r, t) in enumerate(ts))

    assert chat.spans(forgetful, turns)[2] == 2


@pytest.mark.parametrize("said", ["", "<", "</", "</t>", "\n</turn>", "> x <", "00", "1", "0</s>", "assistant"])
def test_chat_mask_of_other_templates(said):
    """The place of a text is found from outside, even if it begins or ends like the marks around it."""
    turns = [("user", "q"), ("assistant", said), ("user", "</"), ("assistant", said + "!")]
    for template in (
        lambda ts: "<s>" + "".join(f"<{r}>{t}</{r}>" for r, t in ts) + "</s>",
        lambda ts: "".join(f"{r}: {t}\n" for r, t in ts),
        lambda ts: "".join(f"<t>{t}" for r, t in ts) + "<t>",
        chat.MarkedTemplate(),
    ):
        text, marks, rewrote = chat.rendered(template, turns, ("assistant",))
        assert rewrote is None
        under = [text[m["loss_start"] : m["loss_end"]] for m in marks if m["loss_start"] is not None]
        want = [said, said + "!"]
        assert [chat.MarkedTemplate.unescape(x) for x in under] == want if isinstance(template, chat.MarkedTemplate) else under == want


def test_chat_rewrites_long_ago(spark):
    """A template that drops all but the last 300 turns is found out at turn 300 of 600."""
    turns = [(7, i, ("user", "assistant")[i % 2], f"t{i}") for i in range(600)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = chat.format_conversations(df, lambda ts: "".join(f"[{r}]{t}" for r, t in ts[-300:])).collect()
    assert len(got) == 1 and got[0].rewrote_at == 300
    for m in got[0].spans:  # no mask where the text no longer stands
        if m.loss_start is not None:
            assert got[0].formatted[m.loss_start : m.loss_end] == f"t{m.turn}"


# --- WARC


def test_warc_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/pages.parquet").collect()
    got = {r.page_id: r for r in warczip.op10_warc(spark, sf).collect()}
    last = {}
    for r in rows:
        last[r.html] = max(r.page_id, last.get(r.html, r.page_id))
    assert len(got) == len(rows)
    for r in rows:
        payload, g = (r.html or "").encode(), got[r.page_id]
        assert g.payload_bytes == len(payload)
        assert g.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        first = last[r.html] == r.page_id
        assert (g.record_type, g.refers_to) == (("response", None) if first else ("revisit", last[r.html]))


def test_warc_round_trip_odd(spark, tmp_path):
    rows = [(1, "http://a/\r\nX: y", "same"), (2, None, "same"), (2, None, "same"), (3, "u", None), (4, "ü", ""), (None, "n", "same"), (5, "u", "\r\n\r\nWARC/1.1\r\n" * 50), (6, "u", "x" * 300_000)]
    df = pages(spark, rows)
    records = warczip.with_revisits(df, "page_id", "html", "url")
    archives = warczip.write_archives(records.coalesce(2), f"file://{tmp_path}/w", archive_bytes=2000, piece=2)
    assert archives.agg(F.max(F.size("marks"))).first()[0] > 2
    got = warczip.read_archives(archives).collect()
    assert len(got) == len(rows)
    key = lambda r: (str(r.page_id), r.payload_bytes, r.record_type, str(r.refers_to))
    want = [("1", 4, "revisit", "2"), ("2", 4, "response", "None"), ("2", 4, "response", "None"), ("3", 0, "revisit", "4"), ("4", 0, "response", "None"), ("None", 4, "response", "None"), ("5", 14 * 50, "response", "None"), ("6", 300_000, "response", "None")]
    assert sorted(map(key, got)) == sorted(want)
    assert {bytes(r.payload) for r in got if r.page_id == 5} == {("\r\n\r\nWARC/1.1\r\n" * 50).encode()}
    none = warczip.with_revisits(pages(spark, []), "page_id", "html", "url")
    assert warczip.read_archives(warczip.write_archives(none, f"file://{tmp_path}/e")).count() == 0


def test_zip64_directory():
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_STORED) as z:
        for i in range(66_000):  # more members than the plain directory can count
            z.writestr(f"m{i}", str(i) if i % 1000 == 0 else "")
        with z.open("wide", "w", force_zip64=True) as f:
            f.write(b"data of the wide member")
        z.comment = b"PK\x05\x06 in a comment is no trouble at the end"[4:]
    data = raw.getvalue()
    f = io.BytesIO(data)
    members = {m.name: m for m in warczip.directory(f, len(data))}
    assert len(members) == 66_001
    for name, want in (("m5000", b"5000"), ("wide", b"data of the wide member")):
        start = warczip.data_start(f, members[name])
        assert data[start : start + members[name].size] == want
    with pytest.raises(ValueError):
        warczip.directory(io.BytesIO(b"no archive"), 10)


def test_zip64_fields(tmp_path):
    """Sizes and places that overflow 32 bits are read from the extra field, in order."""
    import struct

    extra = struct.pack("<HHQQQ", 1, 24, 7_000_000_000, 7_000_000_000, 5_000_000_000)
    entry = b"PK\x01\x02" + bytes(6) + struct.pack("<H", 0) + bytes(8) + struct.pack("<II", 0xFFFFFFFF, 0xFFFFFFFF) + struct.pack("<HHH", 1, len(extra), 0) + bytes(8) + struct.pack("<I", 0xFFFFFFFF) + b"n" + extra
    end64 = b"PK\x06\x06" + struct.pack("<Q", 44) + bytes(12) + struct.pack("<QQQQ", 1, 1, len(entry), 0)
    locator = b"PK\x06\x07" + struct.pack("<IQI", 0, len(entry), 1)
    end = b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    data = entry + end64 + locator + end
    m = warczip.directory(io.BytesIO(data), len(data))
    assert m == [warczip.Member("n", 0, 7_000_000_000, 5_000_000_000)]


def test_archive_layout(tmp_path):
    w = warczip.ArchiveWriter(f"file://{tmp_path}/a.wacz")
    for i in range(3):
        w.add(f"u{i}", warczip.record("response", f"u{i}", b"p" * i, i))
    path, n, marks = w.close()
    with zipfile.ZipFile(f"{tmp_path}/a.wacz") as z:
        assert n == 3 and z.testzip() is None and all(i.compress_type == 0 for i in z.infolist())
        assert len(json.loads(z.read("datapackage.json"))["resources"]) == 2
    assert [warczip.parse_record(r)[1] for r in warczip.read_records(path)] == [b"", b"p", b"pp"]


# --- pipeline


def stages(spark, docs, folder):
    for k, (name, f) in enumerate(corpus_pipeline.STAGES):
        out = f(spark, docs, None)
        out.write.parquet(f"{folder}/{k}")
        yield name, docs, spark.read.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")


def test_pipeline_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, before, after in stages(spark, docs, tmp_path):
        if name != "packing":
            assert after.columns == before.columns
        rows = [(r.doc_id, r.text) for r in before.collect()]
        kept = sorted(r.doc_id for r in after.select("doc_id").collect())
        if name == "language_id":
            assert kept == sorted(i for i, _ in rows)  # all of them are clean
        elif name == "near_duplicates":
            assert kept == sorted(k for k, _, c in brute_components(rows, 5) if k == c)
        elif name == "mixing":
            plan = mixing.copies(before).collect()
            assert kept == sorted(i for r in plan for i in [r["id"]] * r["copies"])
        else:
            ids = {}
            for (key, _), x in zip(rows, reference_ids([t for _, t in rows]), strict=True):
                ids.setdefault(key, []).append(x)
            check_pack([r for r in after.withColumn("loss_tokens", F.col("length")).withColumnRenamed("doc_id", "id").collect()], ids)


def test_pipeline_odd(spark, tmp_path):
    for k, docs in enumerate((odd_rows(spark), empty(spark))):
        for name, before, after in stages(spark, docs, tmp_path / str(k)):
            assert name == "packing" or after.columns == before.columns
            if name == "language_id" and k == 0:
                assert {r.doc_id for r in after.collect()} >= {1, 2, 3, 8, 9, 12} and not {4, 5, 6, 7} & {r.doc_id for r in after.collect()}
