"""Many aliases in many texts: one automaton for all of them, and quotes found in one pass."""

from __future__ import annotations

import functools
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from notegraph.functions import text as X
from notegraph.session import released

#: Distinct aliases, and characters of theirs, that one automaton may have: its memory in a task is a few hundred MB then.
MOST_ALIASES, MOST_CHARS = 200_000, 8_000_000


#: Rows whose texts a worker holds as Python strings at once.
ROWS = 64


def _slices(batches):
    """Small slices of a task's batches: what a worker holds does not grow with the rows of a batch."""
    for batch in batches:
        for begin in range(0, len(batch), ROWS):
            yield batch.slice(begin, ROWS)


def _inner(c: str) -> bool:
    """Whether a character belongs to a word: a letter, a number or ``_``."""
    return c == "_" or c.isalnum()


@functools.lru_cache(maxsize=2)  # the worker lives on, so its next tasks need not build it again
def _machine(aliases: tuple[str, ...]) -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for alias in aliases:
        machine.add_word(alias, alias)
    machine.make_automaton()
    return machine


def standing(machine: ahocorasick.Automaton, text: str) -> list[str]:
    """The machine's aliases that stand in a text between word boundaries, each once."""
    found = set()
    last = len(text) - 1
    for end, alias in machine.iter(text):
        if alias not in found:
            start = end - len(alias) + 1
            if (start == 0 or not _inner(text[start - 1])) and (end == last or not _inner(text[end + 1])):
                found.add(alias)
    return list(found)


def _hits(notes: DataFrame, folded: str, aliases: list[str] | None) -> DataFrame:
    """``(rel_path, alias)`` for notes, of these aliases or of each row's own ``aliases``."""
    kind = dict(notes.dtypes)["rel_path"]
    shared = notes.sparkSession.sparkContext.broadcast(tuple(aliases)) if aliases is not None else None

    def run(batches):
        for batch in _slices(batches):
            at, found = [], []
            own = batch["aliases"].to_pylist() if shared is None else None
            machine = _machine(shared.value) if own is None else None
            for i, text in enumerate(batch["folded"].to_pylist()):
                if text:
                    hits = standing(machine or _machine.__wrapped__(tuple(own[i])), text)
                    at += [i] * len(hits)
                    found += hits
            yield pa.RecordBatch.from_arrays([batch["rel_path"].take(pa.array(at, pa.int64())), pa.array(found, pa.string())], ["rel_path", "alias"])

    cols = ["rel_path", F.col(folded).alias("folded"), *(["aliases"] if aliases is None else [])]
    return notes.select(*cols).mapInArrow(released(run), f"rel_path {kind}, alias string")


def _units(c):
    """The distinct words of a text and its distinct other characters."""
    marks = F.split(F.regexp_replace(c, r"[\p{L}\p{N}_\s]+", ""), "")
    return F.array_distinct(F.filter(F.concat(F.split(c, r"[^\p{L}\p{N}_]+"), marks), lambda x: x != ""))


def _candidates(notes: DataFrame, aliases: DataFrame, folded: str) -> DataFrame:
    """Notes with the ``aliases`` whose rarest word or mark they have; the others cannot stand in them."""
    units = notes.select("rel_path", F.explode(_units(F.col(folded))).alias("unit"))
    keys = aliases.select("alias", F.explode(_units(F.col("alias"))).alias("unit"))
    often = units.join(keys.select("unit").distinct(), "unit", "left_semi").groupBy("unit").agg(F.count("*").alias("n"))
    # a word that no note has is the rarest: its alias is out
    least = keys.join(often, "unit", "left").withColumn("n", F.coalesce("n", F.lit(0))).withColumn("rn", F.row_number().over(W.partitionBy("alias").orderBy("n", "unit")))
    pairs = units.join(least.where("rn = 1 and n > 0").select("alias", "unit"), "unit").groupBy("rel_path").agg(F.collect_list("alias").alias("aliases"))
    return notes.select("rel_path", folded).join(pairs, "rel_path")


def match_topics(notes: DataFrame, topics: DataFrame, folded: str = "folded") -> DataFrame:
    """``(slug, rel_path, aliases)``: topics one of whose aliases stands in a note between word boundaries.

    ``notes (rel_path, folded)``, ``topics (slug, alias, alias_pos)`` with folded aliases. Each text runs once through an
    automaton of all aliases where it is read, so nothing of it is shuffled. Of more aliases than one automaton may have,
    a note is searched for those whose rarest word or mark it has, which a join finds.
    """
    t = topics.select("slug", "alias", "alias_pos").where("alias <> ''")
    distinct = t.select("alias").distinct()
    head = [r.alias for r in distinct.limit(MOST_ALIASES + 1).collect()]
    if len(head) <= MOST_ALIASES and sum(map(len, head)) <= MOST_CHARS:
        hits = _hits(notes, folded, sorted(head)) if head else t.select(F.lit(None).cast(dict(notes.dtypes)["rel_path"]).alias("rel_path"), "alias").where("false")
    else:
        hits = _hits(_candidates(notes, distinct, folded).withColumnRenamed(folded, "_folded"), "_folded", None)
    each = F.transform(F.array_sort(F.collect_list(F.struct("alias_pos", "alias"))), lambda x: x["alias"])
    return hits.join(t, "alias").groupBy("slug", "rel_path").agg(each.alias("aliases"))


SENTENCE, BLANKS = re.compile(r"[^.!?]+[.!?]?"), re.compile(r"[ \t\n\r\x0b\f]+")


@functools.lru_cache(maxsize=4096)
def _pattern(aliases: tuple[str, ...]) -> re.Pattern:
    return re.compile(rf"(?<!\w)(?:{'|'.join(re.escape(X.folded(a)) for a in aliases)})(?!\w)")


def quotes_of(body: str, aliases: tuple[str, ...], k: int) -> list[str]:
    """The first k sentences in which an alias stands, all folded; what follows the k-th is not looked at."""
    pattern, found = _pattern(aliases), []
    for m in SENTENCE.finditer(BLANKS.sub(" ", body).strip(" ")):
        quote = m[0].strip(" ")
        if quote and pattern.search(X.folded(quote)):
            found.append(quote)
            if len(found) == k:
                break
    return found


def first_quotes(notes: DataFrame, aliases: str = "aliases", k: int = 4, body: str = "body", keys: tuple[str, ...] = ("rel_path",)) -> DataFrame:
    """``(keys, quotes)``: the first k sentences of a note in which an alias stands between word boundaries.

    Sentences and aliases (an array column) are folded for the comparison. Notes without a quote have no row. A note is
    cut and searched in one pass that ends at its k-th quote; a pattern is compiled once for its aliases.
    """
    kinds = dict(notes.dtypes)

    def run(batches):
        for batch in _slices(batches):
            at, found = [], []
            for i, (text, names) in enumerate(zip(batch["_body"].to_pylist(), batch["_aliases"].to_pylist(), strict=True)):
                names = tuple(a for a in names or () if a is not None)
                quotes = quotes_of(text, names, k) if text and names else None
                if quotes:
                    at.append(i)
                    found.append(quotes)
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch[c].take(rows) for c in keys], pa.array(found, pa.list_(pa.string()))], [*keys, "quotes"])

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keys) + ", quotes array<string>"
    return notes.select(*keys, F.col(body).alias("_body"), F.col(aliases).alias("_aliases")).mapInArrow(released(run), schema)
