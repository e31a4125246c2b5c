"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from notegraph.llm import runs
from tests.llm.test_text_ops import empty, odd_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w, least=6, power=4):
    """(start, length, period) of every run: period by period, a stretch once."""
    found = {}
    for q in range(1, len(w) // power + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            begin = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - begin >= max(least, power * q):
                found.setdefault((begin, i + q - begin), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    w = WORD.findall(text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute(w)
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
    gone = {i for s, k, q in found for i in range(s + q, s + k)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    milli = 1000 * best[1] // best[2] if found else None
    return (doc_id, len(found), *best, milli, sha("".join(f"{s},{k},{q}\n" for s, k, q in found)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_small_alphabets(seed):
    rng = random.Random(seed)
    for _ in range(150):
        docs = []
        for _ in range(rng.randint(1, 4)):
            k, n = rng.choice([1, 2, 2, 3, 5]), rng.choice([0, 1, 3, 8, 20, 60, 120])
            w = [rng.randrange(k) for _ in range(n)]
            if n and rng.random() < 0.5:
                a, p = rng.randrange(n), rng.randint(1, max(1, n // 5))
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            docs.append(w)
        sizes = np.array([len(d) for d in docs])
        flat = np.array([x + 6 * k for k, d in enumerate(docs) for x in d], np.int64)
        want, first = [], 0
        for d in docs:
            want += [(first + s, first + s + n, q) for s, n, q in brute(d)]
            first += len(d)
        assert [tuple(map(int, r)) for r in runs.runs_of(flat, sizes, 6, 4)] == want


def test_places_agree():
    """The grammar's extensions are those of comparing word by word, onwards and backwards."""
    rng = np.random.default_rng(3)
    for size, kinds in ((300, 2), (300, 1), (400, 3)):
        s = np.r_[rng.integers(0, kinds, size), np.zeros(50, int), np.tile(rng.integers(0, kinds, 7), 30)]
        g = runs.Grammar(s)
        x = rng.integers(0, len(s) - 1, 3000)
        y = x + 1 + rng.integers(0, len(s), 3000) % (len(s) - 1 - x)
        on, back = g.agree(x, y), g.agree(x, y, back=True)
        for a, b, f, r in zip(x, y, on, back, strict=True):
            assert f == next((k for k in range(len(s) - b) if s[a + k] != s[b + k]), len(s) - b)
            assert r == next((k for k in range(a) if s[a - 1 - k] != s[b - 1 - k]), a)


def test_small_batches_ask_the_same(monkeypatch):
    s = np.tile(np.arange(5), 100)
    whole = runs.runs_of(s, np.array([500]), 6, 4).tolist()
    monkeypatch.setattr(runs, "ASKED", 16)
    assert runs.runs_of(s, np.array([500]), 6, 4).tolist() == whole == [[0, 500, 5]]


def test_long_block():
    """One word, a million times: the grammar is one block."""
    assert runs.runs_of(np.zeros(1_000_000, np.int64), np.array([1_000_000]), 6, 4).tolist() == [[0, 1_000_000, 1]]


def test_query_equals_brute_force(spark, sf):
    got = sorted(tuple(r) for r in runs.op12_periodic_runs(spark, sf).collect())
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert got == sorted(brute_row(r.doc_id, r.text) for r in docs)


def test_defined_cases(spark, monkeypatch):
    rows = [*[(i, "ha " * i + "and then " * 9 + "end", "en", "a") for i in range(40)], (None, "x " * 30, "en", "a"), (50, "x " * 30, "en", "a"), (50, "x " * 30, "en", "a"), (51, None, None, None), (52, " \n ", "de", "b")]
    for n, df in ((len(rows), odd_rows(spark, rows)), (16, odd_rows(spark))):
        found = {}
        for r in runs.find_runs(df, edit=runs.planted).collect():
            found.setdefault(r.id, []).append(r)
        assert sum(map(len, found.values())) == n
        for r in df.select("doc_id", "text").collect():
            want = brute_row(r.doc_id, r.text) if len(r.text or "") < 10_000 else None
            got = found[r.doc_id][0]
            if want:
                assert (len(got.runs), *(got.best or (None, None, None))) == want[1:5]
                assert hashlib.sha256(got.collapsed.encode()).hexdigest() == want[7]
    assert runs.find_runs(empty(spark)).count() == 0
