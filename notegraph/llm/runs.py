"""Periodic runs of words by recompression.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) that no neighbouring word
extends and that is at least ``power`` periods and ``least`` words long.

1. *Recompression*: the words of some documents become one sequence of numbers, equal only within a document. Rounds
   of block compression (a maximal block of one symbol becomes a symbol) and pair compression (symbols fall into left
   and right ones; a left one followed by a right one becomes a symbol) shorten it until no symbol occurs twice. Equal
   pairs and blocks get equal names, so this is a run-length grammar, and equal stretches are parsed alike but for
   their ends.
2. *Extensions*: how far two places agree, onwards or backwards, is asked of the grammar: climb while both places
   begin (or end) a symbol of the next level, step over equal symbols (over blocks at once), and sink where they
   differ. That takes a few steps a level, for all questions of a batch at once, and is exact. There is no suffix array.
3. *Harmonic grid*: a run of period q with ``power`` periods holds a place i, a multiple of (power - 1) q, with i + q in it,
   too. For each period these places are asked, n/q of them, in all n log n. The extensions from i and i + q give the
   whole stretch. Of stretches that are found with several periods the smallest holds (the others are its multiples).

A document is one task's, as all its words are; rows are read where they are, without a shuffle. Memory is that of one
document or of ``BATCH`` words, whichever is more; time is that of n log n words.

Defined cases: null and empty texts and texts of white space have no words, no runs and an empty collapsed text; very long
texts count whole; a null id is kept; repeated rows give a row each; runs with equal length/period go by start, then
period; an empty table gives no rows; extra columns, whatever their names, are never read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notegraph.llm.common import table, text_or_empty

#: Words whose grammar is built together, and places of the grid that are asked together.
BATCH, ASKED = 100_000, 1 << 20


class Grammar:
    """The levels of a sequence's recompression, one behind the other: each with a place before its first symbol and one
    behind its last. A place stands for the boundary before its symbol, too."""

    def __init__(self, symbols: np.ndarray):
        self.n = len(symbols)
        levels, kept = [symbols.astype(np.int64)], []
        names, rounds = int(symbols.max()) + 1 if self.n else 0, 0
        while _repeats(now := levels[-1], names):
            begins = np.flatnonzero(np.r_[True, now[1:] != now[:-1]])
            if len(begins) < len(now):
                sizes = np.diff(np.r_[begins, len(now)])
                blocks = np.flatnonzero(sizes > 1)
                kept.append(begins)
                now = now[begins]
                names = _name(now, blocks, now[blocks] * (len(levels[-1]) + 1) + sizes[blocks], names)
                levels.append(now)
            rounds += 1
            right = _right(now, rounds)
            pairs = np.flatnonzero(~right[:-1] & right[1:])
            if len(pairs):
                stay = np.ones(len(now), bool)
                stay[pairs + 1] = False
                keys = now[pairs] * names + now[pairs + 1]
                merged = now.copy()
                names = _name(merged, pairs, keys, names)
                kept.append(np.flatnonzero(stay))
                levels.append(merged[stay])
        self._lay_out(levels, kept)

    def _lay_out(self, levels: list[np.ndarray], kept: list[np.ndarray]) -> None:
        at = np.cumsum([0] + [len(s) + 2 for s in levels])
        self.symbol = np.full(at[-1], -1, np.int64)
        self.onwards, self.backwards = np.ones(at[-1], np.int64), np.ones(at[-1], np.int64)
        self.up, self.down = np.full(at[-1], -1, np.int64), np.full(at[-1], -1, np.int64)
        for t, s in enumerate(levels):
            first = at[t] + 1
            self.symbol[first : first + len(s)] = s
            begins = np.flatnonzero(np.r_[True, s[1:] != s[:-1]]) if len(s) else np.empty(0, np.int64)
            if len(begins) < len(s):  # places of a block know how much of it is left
                sizes = np.diff(np.r_[begins, len(s)])
                inside = np.arange(len(s)) - np.repeat(begins, sizes)
                self.backwards[first : first + len(s)] = inside + 1
                self.onwards[first : first + len(s)] = np.repeat(sizes, sizes) - inside
            if t:
                below, k = at[t - 1] + 1, kept[t - 1]
                bounds = np.r_[k, len(levels[t - 1])] + below
                self.up[bounds] = np.arange(len(bounds)) + first
                self.down[first : first + len(bounds)] = bounds

    def agree(self, x: np.ndarray, y: np.ndarray, back: bool = False) -> np.ndarray:
        """For words ``x < y``: how many words from there on agree; with ``back`` how many before them."""
        size, side, way = (self.backwards, 1, -1) if back else (self.onwards, 0, 1)
        start = x + 1
        x, y = x + 1, y + 1

        def equal(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            same = self.symbol[a - side] == self.symbol[b - side]
            return same, np.where(same, np.minimum(size[a - side], size[b - side]) * way, 0)

        going = np.arange(len(x))
        while len(going):
            a, b = x[going], y[going]
            ups, upside = self.up[a], self.up[b]
            climb = (ups >= 0) & (upside >= 0)
            same, step = equal(a, b)
            x[going], y[going] = np.where(climb, ups, a + step), np.where(climb, upside, b + step)
            going = going[climb | same]
        going = np.flatnonzero(self.down[x] >= 0)
        while len(going):
            a, b = self.down[x[going]], self.down[y[going]]
            same, step = equal(a, b)
            while same.any():
                a, b = a + step, b + step
                same, step = equal(a, b)
            x[going], y[going] = a, b
            going = going[self.down[a] >= 0]
        return (x - start) * way


def _repeats(symbols: np.ndarray, names: int) -> bool:
    if len(symbols) < names // 16:
        return len(np.unique(symbols)) < len(symbols)
    return len(symbols) > 1 and np.bincount(symbols).max() > 1


def _name(symbols: np.ndarray, places: np.ndarray, keys: np.ndarray, names: int) -> int:
    """Gives equal keys equal new names, in place; returns the next free name."""
    distinct, which = np.unique(keys, return_inverse=True)
    symbols[places] = which + names
    return names + len(distinct)


def _right(symbols: np.ndarray, rounds: int) -> np.ndarray:
    """Which symbols are right ones in a round: half of them, another half each round."""
    with np.errstate(over="ignore"):
        h = (symbols.astype(np.uint64) + np.uint64(rounds) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return (h >> np.uint64(40)) & np.uint64(1) == 1


def _ragged(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... counts[0] - 1, 0, 1, ... counts[1] - 1, ..."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def runs_of(symbols: np.ndarray, sizes: np.ndarray, least: int, power: int) -> np.ndarray:
    """Runs of documents that stand one behind the other (``sizes`` words each, no symbol in two of them).

    Rows of start, end, period, by start, then period; places count over all documents.
    """
    grammar = Grammar(symbols)
    first = np.cumsum(sizes) - sizes
    periods = sizes // power
    doc = np.repeat(np.arange(len(sizes)), periods)
    q = _ragged(periods) + 1
    grid = (power - 1) * q
    places = (sizes[doc] - 1 - q) // grid + 1
    found = [np.empty((0, 3), np.int64)]
    cuts = np.searchsorted(np.cumsum(places), np.arange(ASKED, places.sum() + 1, ASKED)) + 1
    for part in np.split(np.arange(len(q)), cuts):
        n = places[part]
        x = np.repeat(first[doc[part]], n) + _ragged(n) * np.repeat(grid[part], n)
        period = np.repeat(q[part], n)
        likely = symbols[x] == symbols[x + period]
        x, period = x[likely], period[likely]
        end = x + period + grammar.agree(x, x + period)
        begin = x - grammar.agree(x, x + period, back=True)
        long = end - begin >= np.maximum(least, power * period)
        found.append(np.stack([begin, end, period], 1)[long])
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(1)] if len(rows) else np.empty(0, bool)
    rows = rows[new]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _best(runs: np.ndarray) -> tuple[int, int, int]:
    """Of (start, length, period) by start, then period, the first with the greatest length/period."""
    best = runs[0]
    for run in runs[1:]:
        if run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


#: Which words of a document to read in its place: gets its id and number of words, returns their numbers; None: all.
Edit = Callable[[int | None, int], np.ndarray | None]
_RUN = "struct<start:long,length:long,period:long>"
_ARROW_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def find_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 6, power: int = 4, edit: Edit | None = None) -> DataFrame:
    """``(id, runs, best, collapsed)`` per row of ``df``.

    ``runs (start, length, period)`` go by start, then period; ``best`` is the one with the greatest length/period, null
    without runs. ``collapsed`` is the text with single spaces, without the words that repeat: those that some run holds
    after its first period.
    """

    def run(batches):
        for batch in batches:
            held, words, symbols, sizes, fresh, so_far = [], [], [], [], count(), 0
            for id_, text in zip(batch["id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                own = text.encode().split()
                order = edit(id_, len(own)) if edit else None
                if order is not None:
                    own = [own[k] for k in order]
                number = defaultdict(fresh.__next__)
                symbols.append(np.fromiter(map(number.__getitem__, own), np.int64, len(own)))
                held.append(id_)
                words.append(own)
                sizes.append(len(own))
                so_far += len(own)
                if so_far >= BATCH:
                    yield _rows(held, words, symbols, sizes, least, power)
                    held, words, symbols, sizes, fresh, so_far = [], [], [], [], count(), 0
            if held:
                yield _rows(held, words, symbols, sizes, least, power)

    rows = df.select(F.col(id_col).cast("long").alias("id"), text_or_empty(F.col(text_col)).alias("text"))
    return rows.mapInArrow(run, f"id long, runs array<{_RUN}>, best {_RUN}, collapsed string")


def _rows(ids: list, words: list[list[bytes]], symbols: list[np.ndarray], sizes: list[int], least: int, power: int) -> pa.RecordBatch:
    size = np.array(sizes, np.int64)
    found = runs_of(np.concatenate(symbols), size, least, power)
    first = np.cumsum(size) - size
    doc = np.searchsorted(first + size, found[:, 0], side="right")
    change = np.zeros(size.sum() + 1, np.int64)
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 1], -1)
    kept = np.cumsum(change)[:-1] == 0
    local = np.stack([found[:, 0] - first[doc], found[:, 1] - found[:, 0], found[:, 2]], 1)
    ends = np.searchsorted(doc, np.arange(len(ids)), side="right")
    runs, best, text = [], [], []
    for k in range(len(ids)):
        own = [tuple(map(int, r)) for r in local[ends[k - 1] if k else 0 : ends[k]]]
        runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in own])
        best.append(dict(zip(("start", "length", "period"), _best(own), strict=True)) if own else None)
        text.append(b" ".join(compress(words[k], kept[first[k] : first[k] + size[k]]) if own else words[k]))
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(runs, pa.list_(_ARROW_RUN)), pa.array(best, _ARROW_RUN), pa.array(text, pa.string())], ["id", "runs", "best", "collapsed"]
    )


def planted(id_: int | None, n: int) -> np.ndarray | None:
    """The edit of the query: every tenth document (by its id's CRC-32) repeats words from some place on."""
    if id_ is None or n == 0 or (h := zlib.crc32(str(id_).encode())) % 10:
        return None
    g = h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    return np.r_[np.arange(a), a + np.arange(n - a) % period]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(table(spark, sf_dir, "documents"), edit=planted)
    line = lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
