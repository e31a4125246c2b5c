"""SimHash near-duplicates against brute force."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from notegraph import session
from notegraph.llm import simhash
from notegraph.llm.common import Scratch
from tests.llm.test_text_ops import empty, odd_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_code(text, n):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    k = min(n, len(w))
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + k]).encode(), 42) for i in range(len(w) - k + 1)] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(codes, bits):
    """{key: smallest key reachable} of {key: code}."""
    keys = sorted(codes)
    values = np.array([codes[k] for k in keys], np.uint64)
    label = np.arange(len(keys))
    for i in range(len(keys)):
        near = np.flatnonzero(np.bitwise_count(values[i] ^ values) <= bits)
        for other in np.unique(label[near]):
            label[label == other] = label[near].min()
    first = {}
    for k, x in zip(keys, label.tolist(), strict=True):
        first.setdefault(x, k)
    return {k: first[x] for k, x in zip(keys, label.tolist(), strict=True)}


def test_fingerprint_of_texts():
    for text in ("", " \n", "one", "One two", "a b c d", "a b c d e f g a b c d", "Straße ÄÖ x y z " * 30):
        for n in (4, 5):
            assert simhash.fingerprint(text, n) % 2**64 == brute_code(text, n)


@pytest.mark.parametrize(("small", "bits"), [(16, 4), (4, 1)])
def test_links_connect_all_near_codes(spark, monkeypatch, small, bits):
    """Random codes, chains of flips, and a ball of codes around one: nodes far larger than those that are settled at once."""
    monkeypatch.setattr(simhash, "SMALL", small)
    rng = np.random.default_rng(bits * 10 + small)
    codes = [int(x) for x in rng.integers(0, 2**64, 60, np.uint64)]
    for c in list(codes[:12]):
        for _ in range(5):
            for b in rng.choice(64, rng.integers(1, bits + 2), replace=False):
                c ^= 1 << int(b)
            codes.append(c)
    for _ in range(60):
        c = codes[0]
        for b in rng.choice(64, rng.integers(0, 5), replace=False):
            c ^= 1 << int(b)
        codes.append(c)
    codes = list(dict.fromkeys(codes))
    signed = [c - 2**64 if c >= 2**63 else c for c in codes]
    scratch = Scratch(spark, "test")
    found = simhash.code_links(spark.createDataFrame([(c, c) for c in signed], "code long, label long"), bits, scratch, "t").collect()
    place = {c: i for i, c in enumerate(signed)}
    label = list(range(len(codes)))
    for r in found:
        assert ((r.src ^ r.dst) % 2**64).bit_count() <= bits
        a, b = label[place[r.src]], label[place[r.dst]]
        label = [min(a, b) if x in (a, b) else x for x in label]
    assert {i: x for i, x in enumerate(label)} == brute_components(dict(enumerate(codes)), bits)


def ball(spark, n, others, seed=5):
    """``(id, code)``: n codes within 4 bits of one, and others; and the brute force's ``{id: component}``."""
    rng = np.random.default_rng(seed)
    codes = [int(x) for x in rng.integers(0, 2**64, others, np.uint64)]
    for _ in range(n):
        c = codes[0]
        for b in rng.choice(64, rng.integers(1, 5), replace=False):
            c ^= 1 << int(b)
        codes.append(c)
    codes = dict(enumerate(rng.permutation(np.array(codes, np.uint64)).tolist()))
    signed = [(k, c - 2**64 if c >= 2**63 else c) for k, c in codes.items()]
    return spark.createDataFrame(signed, "id long, code long"), brute_components(codes, 4)


def test_many_near_copies_take_few_rounds(spark, monkeypatch):
    """A group of a few hundred codes is compared at once and not cut finer and finer, each time with shuffles of all."""
    df, want = ball(spark, 500, 300)
    written, write = [], session._write
    monkeypatch.setattr(session, "_write", lambda table, path: (written.append(path), write(table, path))[1])
    monkeypatch.setattr(simhash, "fingerprints", lambda rows, *_: rows)
    assert {r.id: r.component_id for r in simhash.near_duplicates(df).collect()} == want
    assert len(written) <= 20


def test_crowded_nodes_are_cut_finer(spark, monkeypatch):
    """Nodes too large to be settled, few cells compared at once, few links drawn together at once: the same components."""
    df, want = ball(spark, 200, 60)
    for name, value in (("SMALL", 32), ("CELLS", 100), ("LINKS", 50)):
        monkeypatch.setattr(simhash, name, value)
    monkeypatch.setattr(simhash, "fingerprints", lambda rows, *_: rows)
    codes = df.withColumn("label", F.col("code"))
    scratch = Scratch(spark, "test")
    assert simhash.code_links(codes, 4, scratch, "none", crowds=False) is None
    assert {r.id: r.component_id for r in simhash.near_duplicates(df).collect()} == want


def test_query_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    codes = {r.doc_id: brute_code(r.text, 4) for r in docs}
    want = brute_components(codes, 4)
    got = simhash.op13_simhash(spark, sf).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {k: (f"{codes[k]:016x}", want[k]) for k in codes}
    assert len(got) == len(docs)


def test_defined_cases(spark):
    df = odd_rows(spark)
    texts = {}
    rows = df.select("doc_id", "text").collect()
    for r in rows:
        texts.setdefault(r.doc_id, []).append(r.text)
    codes = {k: brute_code(v[0], 5) for k, v in texts.items()}
    want = brute_components({k: v for k, v in codes.items() if k is not None}, 4)
    got = simhash.near_duplicates(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.code % 2**64 == codes[r.id] and r.component_id == want.get(r.id)
    assert want[6] == 4 and codes[4] == 0  # texts without words are alike
    assert simhash.near_duplicates(empty(spark)).count() == 0
