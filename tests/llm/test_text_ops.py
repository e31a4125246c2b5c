"""Language ID, packing, near-duplicates, fingerprints, sharding and mixing against brute force."""

import hashlib
import itertools
import math
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notegraph import session
from notegraph.llm import common, fingerprint, langid, mixing, neardup, packing, sharding

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, w string, node long, size int, h string, key string, shard int, n int, copies int, words int, score double"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


TOKENIZER = public_tokenizers.path(packing.VOCABULARY)


def odd_rows(spark, rows=None):
    """Nulls in any column, empty and very long texts, ties, repeated rows, extra columns with names that operators use."""
    long_text = " ".join(f"wort{i % 997}" for i in range(40_000))
    rows = rows if rows is not None else [
        (1, "the same few words as ever in this text", "en", "a"),
        (2, "the same few words as ever in this text", "en", None),
        (2, "the same few words as ever in this text", "en", None),
        (3, "THE same few words as ever in this text", None, "b"),
        (None, "the same few words as ever in this text", "en", "a"),
        (4, None, "en", "a"),
        (5, "", "de", "a"),
        (6, " \t\n ", "de", "b"),
        (7, "12 34 --", "de", "b"),
        (8, long_text, "de", "c"),
        (9, "ÄÖÜ straße", "de", "c"),
        (10, "word", "en", "c"),
        (11, "word", "en", "c"),
        (12, "x" * 5000, "en", "c"),
        (13, "a  b \n c   d ", "en", "c"),
        (14, "² ½ Ⅷ 7", "en", "c"),
    ]
    full = [(*r, None, "x", "y", 1, 2, "z", "k", 3, 4, 5, 6, 0.5) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def empty(spark):
    return odd_rows(spark, [])


# --- language ID


def test_forward_sums_all_segmentations():
    pieces = {p: i for i, p in enumerate(["▁", "a", "b", "▁a", "ab", "ba", "▁ab"])}
    rng = np.random.default_rng(1)
    model = langid.Model(["x", "y"], pieces, rng.uniform(0.01, 0.2, (len(pieces) + 1, 2)))

    def brute(text):
        out = np.zeros(2)
        for cuts in itertools.product((0, 1), repeat=len(text) - 1):
            parts, part = [], text[0]
            for c, ch in zip(cuts, text[1:], strict=True):
                if c:
                    parts.append(part)
                    part = ch
                else:
                    part += ch
            parts.append(part)
            if all(p in pieces for p in parts):
                out += np.prod([model.p[pieces[p]] for p in parts], axis=0)
        return np.log(out)

    words = ["a", "ab", "abab", "bbaab", "baba"]
    assert np.allclose(model.score(words), [brute("▁" + w) for w in words])
    # expected uses: each letter of a word is covered once
    use = model.expected(model.lattice(words), np.ones((len(words), 2)))
    covered = sum(use[i] * len(p) for p, i in pieces.items())
    assert np.allclose(covered, sum(len(w) + 1 for w in words))


def test_language_held_out(spark):
    from notegraph.llm.common import table

    got = langid.op1_language_id(spark, "/root/testdata/sf0.01").toPandas()
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang").toPandas()
    assert len(got) == len(docs)
    m = got.merge(docs)
    assert (m.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in m.doc_id]).all()
    assert (m[m.held_out].lang_pred == m[m.held_out].lang).mean() >= 0.97
    assert m.score.between(0, 1).all()


def test_language_odd(spark):
    df = odd_rows(spark)
    model = langid.train(df)
    got = df.select("doc_id", "text", langid.identify(df, model).alias("p")).collect()
    for r in got:
        no_letter = not any(c.isalpha() for c in r.text or "")
        assert (r.p.lang_pred == "und") == no_letter
        assert (r.p.score == 0) == no_letter
    assert langid.train(empty(spark)) is None
    assert df.select(langid.identify(df, None).alias("p")).where("p.lang_pred <> 'und'").count() == 0


def plain_language_id(rows):
    """The whole query over, word by word and language by language: fit, forward sums and posteriors."""
    own = [(t, lang) for i, t, lang in rows if lang is not None and t and re.search(r"[^\W\d_]", t) and zlib.crc32(str(i).encode()) % 3 != 1]
    languages = sorted({lang for _, lang in own})
    counts = defaultdict(lambda: [0] * len(languages))
    for t, lang in own:
        for w in langid.WORDS.findall(t.lower()):
            counts[w][languages.index(lang)] += 1
    pieces = set(langid.vocabulary_pieces()) | {c for w in counts for c in w} | {"▁"}
    longest = max(map(len, pieces))
    p = [dict.fromkeys(pieces, 1 / (len(pieces) + 1)) for _ in languages]

    def arcs(text):
        for i in range(len(text)):
            fit = [text[i:j] for j in range(i + 1, min(len(text), i + longest) + 1) if text[i:j] in pieces]
            yield from ((i, x) for x in fit)
            if text[i] not in pieces:
                yield i, text[i]

    def forward(text, q):
        alpha = [1.0] + [0.0] * len(text)
        for i, x in arcs(text):
            alpha[i + len(x)] += alpha[i] * q.get(x, langid.UNSEEN)
        return alpha

    for _ in range(3):
        for k, q in enumerate(p):
            use = dict.fromkeys(pieces, 0.02)
            for w, n in counts.items():
                if n[k]:
                    text = "▁" + w
                    alpha, beta = forward(text, q), [0.0] * len(text) + [1.0]
                    every = list(arcs(text))
                    for i, x in reversed(every):
                        beta[i] += q[x] * beta[i + len(x)]
                    for i, x in every:
                        use[x] += n[k] * alpha[i] * q[x] * beta[i + len(x)] / alpha[-1]
            total = sum(use.values()) + 0.02
            p[k] = {x: v / total for x, v in use.items()}
    known = {}
    for i, t, _ in rows:
        words = langid.WORDS.findall((t or "").lower())
        for w in words:
            if w not in known:
                known[w] = [math.log(max(forward("▁" + w, q)[-1], 1e-300)) for q in p]
        logs = [sum(known[w][k] for w in words) for k in range(len(languages))]
        best = max(range(len(languages)), key=lambda k: logs[k])
        yield i, (languages[best], 1 / sum(math.exp(x - logs[best]) for x in logs)) if words else ("und", 0.0)


def test_language_id_equals_a_plain_version(spark, sf):
    """Texts are cut to a few words each as well, so that scores are not all near 1."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    short = docs.select((F.col("doc_id") + 1_000_000).alias("doc_id"), F.substring_index("text", " ", 1).alias("text"), F.lit(None).cast("string").alias("lang"))
    docs = docs.unionByName(short)
    want = dict(plain_language_id([tuple(r) for r in docs.collect()]))
    got = docs.select("doc_id", langid.identify(docs, langid.train(docs)).alias("p")).collect()
    assert len(got) == len(want)
    for r in got:
        lang, score = want[r.doc_id]
        assert abs(r.p.score - score) < 1e-4 and (r.p.lang_pred == lang or abs(score - 0.5) < 1e-3)
    assert sum(0.3 < r.p.score < 0.95 for r in got) > 5


# --- mixing


def test_mixing_sql(spark, sf, duck, same):
    same(mixing.op2_mixing(spark, sf), duck.sql(mixing.OP2_SQL))


def test_mixing_chunks_do_not_matter(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    one = {r[0]: r["copies"] for r in mixing.copies(df).collect()}
    many = {r[0]: r["copies"] for r in mixing.copies(df, chunk_rows=3).collect()}
    assert one == many


def test_mixing_spreads_rows_of_one_id(spark):
    """Rows without an id, or of one id, do not gather in one chunk of the order."""
    df = spark.range(400).select(F.when(F.col("id") % 2 == 0, 7).alias("doc_id"), F.concat(F.lit("one two three "), F.col("id").cast("string")).alias("text"), F.lit("s").alias("source"))
    assert mixing.copies(df).select("h").distinct().count() == 400
    assert sorted(r.text for r in mixing.mix(df).collect()) == sorted(r.text for r in df.collect())


def test_mixing_targets(spark):
    sizes = {"a": 10, "b": 1000, "c": 5000, None: 90}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    weight = {"a": 1, "b": 2, "c": 3, None: 1}
    fixed, left = {}, dict(weight)
    total = sum(sizes.values())
    while True:
        room = total - sum(fixed.values())
        share = {k: room * w / sum(left.values()) for k, w in left.items()}
        over = [k for k, v in share.items() if v > 3 * sizes[k]]
        if not over:
            break
        for k in over:
            fixed[k] = 3 * sizes[k]
            del left[k]
    want = fixed | share
    assert all(math.isclose(got[k], want[k]) for k in sizes)


def test_mix_odd(spark):
    df = odd_rows(spark)
    c = mixing.copies(df).collect()
    assert len(c) == df.count() and all(0 <= r["copies"] <= 3 for r in c)
    out = mixing.mix(df)
    assert out.columns == df.columns and out.count() == sum(r["copies"] for r in c)
    assert mixing.mix(empty(spark)).count() == 0
    everything = mixing.copies(df.where("source = 'a'")).collect()
    assert {r["copies"] for r in everything} == {1}  # one source alone takes all of itself


# --- packing


def reference_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(TOKENIZER)
    return [[*t.encode(x or "", add_special_tokens=False).ids, packing.END] for x in texts]


@pytest.mark.parametrize("text", ["", " ", "a", " a", "a ", "a  b", "a \n b", "\n", "x\n\n y", "don't  stop", "tab\t x", "é  b", "a <|endoftext|> b", "12 34", "  ", "a　 b", "end \x1c x"])
def test_encoder_parts(text):
    enc = packing.encoder(None)
    want = reference_ids([text])[0][:-1]
    for _ in range(2):  # fresh, then remembered
        assert list(np.frombuffer(enc.encode(text), "<u4")) == want
    assert list(np.frombuffer(packing.Encoder(TOKENIZER).encode(text), "<u4")) == want


def check_pack(rows, ids_of, limits=packing.Limits()):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        assert len(r.ids) == 4 * r.length
        by_doc[r.id].append(r)
        by_seq[r.sequence_id].append(r)
    for key, copies in ids_of.items():
        pieces = sorted(by_doc.pop(key), key=lambda r: r.start)
        got = sorted((r.start, bytes(r.ids)) for r in pieces)
        want = np.array(copies[0], "<u4").tobytes()
        for start, b in got:
            assert want[4 * start : 4 * start + len(b)] == b
        assert sum(r.length for r in pieces) == sum(map(len, copies))
        assert {r.doc_tokens for r in pieces} == {len(copies[0])}
        if len(copies) == 1:
            at = 0
            for r in pieces:
                assert r.start == at
                at += r.length
    assert not by_doc
    for pieces in by_seq.values():
        pieces.sort(key=lambda r: r.offset)
        at = 0
        for r in pieces:
            assert r.offset == at
            at += r.length
        assert at <= limits.tokens and len(pieces) <= limits.segments and sum(r.loss_tokens for r in pieces) <= limits.loss_tokens
    return by_seq


def test_packing_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    local = docs.select("doc_id", "text").toPandas()
    ids = dict(zip(local.doc_id, ([x] for x in reference_ids(local.text)), strict=True))
    seqs = check_pack(packing.pack(docs).collect(), ids)
    total = sum(len(x[0]) for x in ids.values())
    assert len(seqs) <= total // 2048 + 2 * docs.rdd.getNumPartitions()
    digest = packing.op4_packing(spark, sf).collect()
    for r in digest:
        want = np.array(ids[r.doc_id][0][r.start : r.start + r.length], "<u4").tobytes()
        assert zlib.crc32(want) == r.ids_crc32


def test_packing_limits(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("share", (F.col("doc_id") % 5) / 4)
    limits = packing.Limits(tokens=512, segments=3, loss_tokens=200)
    local = docs.select("doc_id", "text").toPandas()
    ids = dict(zip(local.doc_id, ([x] for x in reference_ids(local.text)), strict=True))
    check_pack(packing.pack(docs, loss_share_col="share", limits=limits).collect(), ids, limits)


@pytest.mark.parametrize("name, value", [("maxRecordsPerBatch", "300"), ("maxBytesPerBatch", "20000")])
def test_packing_does_not_depend_on_batches(spark, name, value):
    name = f"spark.sql.execution.arrow.{name}"
    df = spark.range(1500).select(F.col("id").alias("doc_id"), F.expr("repeat('one two three ', int(id % 90 + if(id % 400 = 7, 4000, 0)))").alias("text")).coalesce(1)
    whole = packing.pack(df).collect()
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        cut = packing.pack(df).collect()
    finally:
        spark.conf.set(name, before)
    assert sorted(map(tuple, cut)) == sorted(map(tuple, whole))


def test_texts_go_to_workers_in_small_batches(spark):
    """64 MB of texts at once, as Spark has it, are too much for a task; a bound that a user sets stays."""
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.expr("repeat('many words ', 500)").alias("text")).coalesce(1)
    name, usual = session.BATCH_BOUND
    for start in (lambda: packing.pack(df), lambda: langid.identify(df, None), lambda: neardup.near_duplicates(df.limit(3))):
        spark.conf.set(name, usual)
        start()
        sizes = [r[0] for r in df.mapInArrow(lambda batches: (b.select([0]).slice(0, 1).set_column(0, "n", [b.nbytes]) for b in batches), "n long").collect()]
        assert len(sizes) > 8 and max(sizes) < 3_000_000
    spark.conf.set(name, "5000000")
    packing.pack(df)
    assert spark.conf.get(name) == "5000000"
    spark.conf.unset(name)


def test_packing_odd(spark):
    df = odd_rows(spark)
    ids = defaultdict(list)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    for (key, _), x in zip(rows, reference_ids([t for _, t in rows]), strict=True):
        ids[key].append(x)
    check_pack(packing.pack(df).collect(), ids)
    assert packing.pack(empty(spark)).count() == 0


# --- near-duplicates


def shingles(text, n):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute_components(rows, n, percent=80):
    sets = [shingles(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    lists = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            lists[x].append(i)
    shared = defaultdict(int)
    for members in lists.values():
        for a, b in itertools.combinations(members, 2):
            shared[a, b] += 1
    for (a, b), s in shared.items():
        if 100 * s >= percent * (len(sets[a]) + len(sets[b]) - s):
            root[find(a)] = find(b)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return [(key, len(s), None if key is None else (least[find(i)] if s else key)) for i, ((key, _), s) in enumerate(zip(rows, sets, strict=True))]


def near_rows(seed=3):
    """A base text with many copies that differ in a word or a few, chains, and texts that share a passage."""
    rng = np.random.default_rng(seed)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 5))
    base = [word() for _ in range(120)]
    passage = [word() for _ in range(60)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(int(rng.integers(0, 6))):
            w[int(rng.integers(len(w)))] = word()
        rows.append((i, " ".join(w)))
    for i in range(150, 250):
        rows.append((i, " ".join([word() for _ in range(int(rng.integers(5, 40)))] + passage)))
    w = list(base)
    for i in range(250, 290):
        w = list(w)
        w[int(rng.integers(len(w)))] = word()
        rows.append((i, " ".join(w)))
    rows += [(i + 1000, t.upper()) for i, t in rows[::7]]
    return [rows[i] for i in rng.permutation(len(rows))]


def test_sieve_lets_all_wanted_through(spark, monkeypatch):
    rows, wanted = spark.range(-5000, 5000).withColumn("x", F.col("id") * 3), spark.range(-3000, 9000, 7).toDF("w")
    asked = {r.id for r in rows.join(wanted, rows.id == wanted.w, "left_semi").collect()}
    got = [r.id for r in common.sieved(rows, "id", wanted).collect()]
    assert asked <= set(got) and len(got) < len(asked) + 20 and len(set(got)) == len(got)
    monkeypatch.setattr(common, "SIEVE_BITS", 1 << 10)  # too small: more comes through, nothing is lost
    got = [r.id for r in common.sieved(rows, "id", wanted).collect()]
    assert asked <= set(got) and len(set(got)) == len(got)
    assert common.sieved(rows, "id", wanted.limit(0)).count() == 0


@pytest.mark.parametrize(("short", "size", "most"), [(8, 16_000_000, 2048), (2, 40_000, 4), (0, 4_000, 32)])
def test_near_duplicates_brute(spark, monkeypatch, short, size, most):
    monkeypatch.setattr(neardup, "SHORT", short)
    monkeypatch.setattr(neardup, "BLOCK_BYTES", size)
    monkeypatch.setattr(neardup, "BLOCK_ROWS", most)
    rows = near_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for n in (4, 5):
        got = sorted(tuple(r) for r in neardup.near_duplicates(df, n=n).collect())
        assert got == sorted(brute_components(rows, n))


def test_near_duplicates_of_many_long_lists(spark, monkeypatch):
    """Texts that share most of their passages with all others meet in hundreds of long lists; their sets are fetched once."""
    meets = []
    write = neardup.Scratch.write

    def spy(self, df, name):
        out = write(self, df, name)
        if name == "long-meet":
            meets.append((out.count(), out.where("inside").count()))
        return out

    monkeypatch.setattr(neardup.Scratch, "write", spy)
    rng = np.random.default_rng(7)
    passages = [" ".join(f"w{x}" for x in rng.integers(0, 4000, 12)) for _ in range(100)]
    rows = [(i, " ".join(passages[j] for j in sorted(rng.choice(100, 88, replace=False)))) for i in range(150)]
    got = sorted(tuple(r) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect())
    assert got == sorted(brute_components(rows, 5)) and len({r[2] for r in got}) > 100
    assert meets == [(1, 1)]


def test_near_duplicates_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.op5_near_dedup(spark, "/root/testdata/sf0.01").collect())
    assert got == sorted((a, b, c, a == c) for a, b, c in brute_components(rows, 4))


def test_near_duplicates_odd(spark):
    df = odd_rows(spark)
    key = lambda r: tuple(str(x) for x in r)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = sorted((tuple(r) for r in neardup.near_duplicates(df).collect()), key=key)
    assert got == sorted(brute_components(rows, 5), key=key)
    assert neardup.near_duplicates(empty(spark)).count() == 0


# --- sharding


def check_shards(df, rows, shards=16):
    got = sharding.shard(df, shards).collect()
    want = sorted((str(k), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in rows)
    assert sorted((str(r.id), r.size, r.text_crc32) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return got


def test_sharding_balance(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = check_shards(df, [(r.doc_id, r.text) for r in df.collect()])
    loads, homes = defaultdict(int), defaultdict(set)
    for r in got:
        loads[r.shard] += r.size
        homes[r.text_crc32].add(r.shard)
    assert max(loads.values()) <= 1.02 * min(loads.values())
    assert all(len(h) == 1 for h in homes.values())


def test_sharding_hot_text(spark):
    rows = [(i, "the one text that is everywhere") for i in range(3000)] + [(i, f"text number {i} " * (i % 9)) for i in range(3000, 6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = check_shards(df, rows)
    loads = defaultdict(int)
    for r in got:
        loads[r.shard] += r.size
    assert len(loads) == 16 and max(loads.values()) <= 1.15 * min(loads.values())


def test_sharding_copies_without_ids(spark):
    """Copies of a text above a shard's share are dealt evenly, even if they have one id or none."""
    df = spark.range(3000).select(F.when(F.col("id") % 2 == 0, 7).alias("doc_id"), F.when(F.col("id") % 3 < 2, "the one text that is everywhere").otherwise(F.concat(F.lit("some text of number "), F.col("id").cast("string"))).alias("text"))
    loads = defaultdict(int)
    for r in check_shards(df, [(r.doc_id, r.text) for r in df.collect()]):
        loads[r.shard] += r.size
    assert len(loads) == 16 and max(loads.values()) <= 1.25 * min(loads.values())


def test_sharding_odd(spark):
    df = odd_rows(spark)
    check_shards(df, [(r.doc_id, r.text) for r in df.collect()])
    assert sharding.shard(empty(spark)).count() == 0


# --- fingerprints


def brute_sketch(text, k=fingerprint.K, n=fingerprint.SHINGLE):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))

    def chained(words):  # Spark hashes an array value by value, each hash seeding the next
        h = 42
        for x in words:
            h = xxhash.xxh64_intdigest(x.encode(), seed=h)
        return h - (1 << 64) if h >= 1 << 63 else h

    found = {chained(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()
    return sorted(found)[:k]


def brute_likeness(a, b, k=fingerprint.K):
    both = sorted({*a, *b})[:k]
    return 1.0 if not both else len({*a} & {*b} & {*both}) / len(both)


def check_fingerprints(got, rows):
    rows = sorted(rows, key=lambda r: r[0])
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    as_text = lambda s: "".join(f"{x & (1 << 64) - 1:016X}" for x in s)
    for (key, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        text, after, r = text or "", after or "", by_id[key]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = brute_sketch(text), brute_sketch(edited), brute_sketch(after)
        assert (r.fingerprint, r.edited_fingerprint) == (as_text(a), as_text(b))
        assert math.isclose(r.near_edited, brute_likeness(a, b)) and math.isclose(r.near_next, brute_likeness(a, c))


@pytest.mark.parametrize("chunk", [4096, 40])
def test_fingerprints_brute(spark, sf, monkeypatch, chunk):
    monkeypatch.setattr(fingerprint, "CHUNK_ROWS", chunk)
    monkeypatch.setattr(fingerprint.with_next, "__defaults__", (chunk,))
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check_fingerprints(fingerprint.op8_fingerprints(spark, sf).collect(), rows)


def test_fingerprints_odd(spark, tmp_path):
    df = odd_rows(spark).dropDuplicates(["doc_id"]).where("doc_id is not null")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    check_fingerprints(fingerprint.op8_fingerprints(spark, str(tmp_path)).collect(), rows)
    odd_rows(spark).write.parquet(f"{tmp_path}/b/documents.parquet")
    assert fingerprint.op8_fingerprints(spark, f"{tmp_path}/b").count() == odd_rows(spark).count()
    empty(spark).write.parquet(f"{tmp_path}/c/documents.parquet")
    assert fingerprint.op8_fingerprints(spark, f"{tmp_path}/c").count() == 0


def test_next_rows_of_one_id(spark):
    """The order (null ids first, then id, then hash) holds across chunks, also where one id or none fills many."""
    rows = [(None if i < 60 else 5 if i < 150 else i // 2, f"text {i}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    w = fingerprint.next_window("doc_id", ["text"])
    got = fingerprint.with_next(df, "doc_id", ["text"], 10)
    assert got.groupBy("__ng_chunk").count().agg(F.max("count")).first()[0] < 40
    after = got.withColumn("after", F.lead("text").over(w)).where("not __ng_guest").collect()
    signed = lambda t: (h := xxhash.xxh64_intdigest(t.encode(), seed=42)) - (1 << 64 if h >= 1 << 63 else 0)
    order = [t for k, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, signed(r[1])))]
    assert {r.text: r.after for r in after} == dict(zip(order, order[1:] + order[:1], strict=True))


def test_sketches_merge_and_estimate(spark):
    words = [f"w{i}" for i in range(3000)]
    parts = [" ".join(words[:2000]), " ".join(words[1000:])]
    df = spark.createDataFrame([(0, p) for p in parts], "g int, t string").withColumn("s", fingerprint.sketch(F.col("t"), k=512))
    whole = fingerprint.merge_sketches(df, ["g"], "s", k=512).first()["s"]
    union = sorted({x for r in df.collect() for x in brute_sketch(r.t, k=10**6)})
    assert list(whole) == union[:512]
    two = df.groupBy("g").agg(F.min_by("s", "t").alias("a"), F.max_by("s", "t").alias("b"))
    r = two.select(fingerprint.distinct_count(F.col("a"), 512), fingerprint.resemblance(F.col("a"), F.col("b"), 512), fingerprint.containment(F.col("a"), F.col("b"), 512)).first()
    assert abs(r[0] / 1998 - 1) < 0.15 and abs(r[1] - 1 / 3) < 0.07 and abs(r[2] - 0.5) < 0.1
    assert isinstance(two.schema["a"].dataType, T.ArrayType)


def test_workers_give_freed_memory_back():
    """A task's freed memory does not stay with its worker; one object at its end keeps the allocator from shrinking by itself."""
    import psutil

    from notegraph.session import released

    size = lambda: psutil.Process().memory_info().rss >> 20
    pins, seen = [], []

    def run(batches):
        held = [bytes(1000) for _ in range(200_000)]
        pins.append(bytes(1000))
        del held
        seen.append(size())
        yield from batches

    assert list(released(run)(iter([1, 2]))) == [1, 2]
    assert size() < seen[0] - 100
