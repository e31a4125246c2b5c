"""Predicates, filters and routing of notes."""

from __future__ import annotations

import functools
import operator
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notegraph.functions import text as X


def is_classified(type_: Column, org: Column, context: Column, up: Column, classified_by: Column) -> Column:
    """Four filled fields, and not stamped ``export``; an absent stamp counts as settled."""
    filled = [F.coalesce(c, F.lit("")) != "" for c in (type_, org, context, up)]
    return functools.reduce(operator.and_, filled) & ~classified_by.eqNullSafe("export")


def split_classified(df: DataFrame, done: Column) -> tuple[DataFrame, DataFrame]:
    """(still to do, number of rows that are done), in one pass each."""
    return df.where(~done), df.agg(F.count_if(done).alias("already"))


def is_empty_note(raw: Column) -> Column:
    return X.strip(X.strip_header(raw, strict=True)) == ""


def field_filters(df: DataFrame, filters: list[str]) -> DataFrame:
    """Keeps rows for which every ``field=value`` holds; an absent field is the text ``None``; bad syntax is an error."""
    ok = F.lit(True)
    for f in filters:
        name, sep, value = f.partition("=")
        if not sep or not name.strip():
            raise ValueError(f"a filter is field=value, not {f!r}")
        name = name.strip()
        have = F.coalesce(F.col(name).cast("string"), F.lit("None")) if name in df.columns else F.lit("None")
        ok = ok & (have == value.strip())
    return df.where(ok)


def glob_pattern(glob: str) -> str:
    """A glob as a regular expression; ``*`` crosses folders."""
    out, i = "", 0
    while i < len(glob):
        c = glob[i]
        if c == "*":
            out += ".*"
        elif c == "?":
            out += "."
        elif c == "[" and (j := glob.find("]", i + 2)) > 0:
            inner = glob[i + 1 : j].replace("\\", "\\\\")
            out += "[" + ("^" + inner[1:] if inner[0] == "!" else inner) + "]"
            i = j
        else:
            out += "\\" + c if not c.isalnum() and ord(c) < 128 and c != "_" else c
        i += 1
    return rf"(?s)\A{out}\z"


@functools.lru_cache(maxsize=4096)
def _compiled(glob: str) -> re.Pattern:
    return re.compile(glob_pattern(glob).removesuffix(r"\z") + r"\Z")  # the end, in Python's words


@F.pandas_udf(T.BooleanType())
def matches_glob(values: pd.Series, globs: pd.Series) -> pd.Series:
    """Whether a value matches the glob beside it; null where one is null. Python: a pattern is compiled once a worker,
    which Spark does for constant patterns only."""
    return pd.Series([None if v is None or g is None else _compiled(g).search(v) is not None for v, g in zip(values, globs, strict=True)], dtype="boolean")


def is_exhaust(name: Column) -> Column:
    """Files that a review run leaves behind."""
    return name.rlike(r"^classification-review.*\.html$")


def exclude_globs(df: DataFrame, globs: list[str], path: str = "rel_path", name: str = "file_name") -> DataFrame:
    for g in globs:
        p = glob_pattern(g)
        df = df.where(~(F.col(path).rlike(p) | F.col(name).rlike(p)))
    return df


def recent(df: DataFrame, now: Column, days: int = 30, time: str = "mtime", full: bool = False) -> DataFrame:
    return df if full else df.where(F.col(time) >= now - F.make_dt_interval(F.lit(days)))


def is_conflict_copy(name: Column) -> Column:
    return name.endswith(".icloud") | F.lower(name).contains("conflicted copy") | name.rlike(r" \d+\.md$")


def provisional(df: DataFrame, source_id: str = "export_id", stamp: str = "classified_by") -> DataFrame:
    """Stamps exported notes that nobody has classified."""
    return df.where((F.coalesce(F.col(source_id), F.lit("")) != "") & F.col(stamp).isNull()).withColumn(stamp, F.lit("export"))


def route_by_context(context: Column, classified: Column) -> Column:
    return F.when(~classified, "skipped").when(context == "work", "business").when(context.isin("personal", "education"), "personal").otherwise("skipped")


def decision_status(decision: Column, folder: Column, targets: dict[str, str]) -> Column:
    """``moved`` if a known decision names another folder than the note's own, else ``skipped``."""
    target = F.coalesce(*[F.when(decision == k, F.lit(v)) for k, v in targets.items()])
    return F.when(target.isNotNull() & (target != folder), "moved").otherwise("skipped")


def path_inside(path: Column) -> Column:
    """The error of a path that is empty, absolute or leaves its root; null for a good one."""
    depth = F.aggregate(
        F.filter(F.split(path, "/"), lambda s: (s != "") & (s != ".")),
        F.struct(F.lit(0).alias("d"), F.lit(0).alias("least")),
        lambda a, s: F.struct(
            F.when(s == "..", a["d"] - 1).otherwise(a["d"] + 1).alias("d"), F.least(a["least"], F.when(s == "..", a["d"] - 1).otherwise(a["d"] + 1)).alias("least")
        ),
    )
    return F.when(F.coalesce(X.strip(path), F.lit("")) == "", "empty").when(path.startswith("/") | (depth["least"] < 0), "outside")


def context_of(org: Column, work: Column, personal: Column, work_orgs: list[str]) -> Column:
    return F.when(org.isin(*work_orgs), "work").when(org == "Personal", "personal").when(work > personal, "work").otherwise("personal")


def valid_labels(df: DataFrame, hubs: DataFrame, orgs: list[str], work_orgs: list[str]) -> DataFrame:
    """``(rel_path, type, org)`` asked for by hand: rows with a known type and org, settled with certainty and a hub."""
    known = df.join(hubs, "type").where(F.col("org").isin(*orgs, "Personal"))
    context = F.when(F.col("org").isin(*work_orgs), "work").otherwise("personal")
    return known.select("rel_path", "type", "org", context.alias("context"), "up", F.lit(1.0).alias("confidence"), F.lit("manual").alias("classified_by"))


def limit_attempts(df: DataFrame, n: int, done: Column, order: str = "rel_path") -> DataFrame:
    """The first n rows in path order that are not done."""
    return df.where(~done).orderBy(order).limit(n)


def sample(df: DataFrame, n: int, key: str, seed: int = 0) -> DataFrame:
    """n rows in the order of a hash of seed and key: the same for every run and partitioning."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"))
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")


def sample_per_group(df: DataFrame, n: int, group: str, key: str, seed: int = 0) -> DataFrame:
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"))
    return df.withColumn("_r", F.row_number().over(W.partitionBy(group).orderBy(h, key))).where(F.col("_r") <= n).drop("_r")


#: Bits of a sieve: 8 MB, whatever the size of the tables.
SIEVE_BITS = 1 << 26


def sieve(df: DataFrame, key: Column, wanted: DataFrame, size: int = SIEVE_BITS) -> DataFrame:
    """Adds ``__ng_maybe``: whether the long ``key`` may be one of ``wanted`` (a table of one column). It is true for all
    that are, and for few others.

    A bitmap of fixed size over the hashes of the wanted keys is broadcast, so that rows that no one asks for need not be
    shuffled. With very many keys it lets more through, never less; a join decides afterwards.
    """
    spot = lambda c: F.pmod(F.xxhash64(c.cast("long")), F.lit(size))
    h = spot(F.col(wanted.columns[0]))
    bits = wanted.select(F.bitmap_bucket_number(h).alias("__ng_bucket"), F.bitmap_bit_position(h).alias("at"))
    bits = bits.groupBy("__ng_bucket").agg(F.bitmap_construct_agg("at").alias("__ng_bits"))
    mine = spot(key)
    joined = df.join(F.broadcast(bits), F.bitmap_bucket_number(mine) == F.col("__ng_bucket"), "left")
    at = F.bitmap_bit_position(mine)
    byte = F.conv(F.hex(F.substring(F.col("__ng_bits"), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    maybe = F.coalesce(F.floor(byte / F.pow(F.lit(2), at % 8)) % 2 == 1, F.lit(False))
    return joined.select(*df.columns, maybe.alias("__ng_maybe"))
