"""Shared helpers of the training-data operators: table access, shared folders, row hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notegraph.operators import filters
from notegraph.operators.filters import SIEVE_BITS
from notegraph.session import Scratch, materialize, released, shared_dir, shuffled, small_batches  # noqa: F401

#: White space as all operators here see it; a word is a maximal run of anything else.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def utf8_bytes(col: Column) -> Column:
    """UTF-8 bytes of a text; none for null."""
    return F.coalesce(F.octet_length(col), F.lit(0)).cast("long")


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does that exactly on texts of ASCII alone and is much faster."""
    upper, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.length(col) == F.octet_length(col), F.lower(col)).otherwise(F.translate(col, upper, small))


def words(col: Column) -> Column:
    """The words of a text as an array; empty for null and for white space alone."""
    return F.array_remove(F.split(text_or_empty(col), SPACE), "")


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def shingle_hashes(word_array: Column, n: int) -> Column:
    """Distinct 64-bit hashes of the n-word shingles.

    With fewer than n words the whole sequence is the one shingle; without words there is none.
    """

    def of(w: Column) -> Column:
        last = F.size(w) - n
        many = F.transform(F.sequence(F.lit(1), last + 1), lambda i: F.xxhash64(F.slice(w, i, n)))
        return (
            F.when(F.size(w) == 0, F.array().cast("array<bigint>"))
            .when(last <= 0, F.array(F.xxhash64(w)))
            .otherwise(F.array_distinct(many))
        )

    return let(word_array, of)


def sieve(df: DataFrame, key: Column, wanted: DataFrame) -> DataFrame:
    """`filters.sieve` of ``SIEVE_BITS``."""
    return filters.sieve(df, key, wanted, SIEVE_BITS)


def sieved(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Those rows of ``df`` whose long ``key`` may be one of ``wanted``."""
    return sieve(df, F.col(key), wanted).where("__ng_maybe").select(*df.columns)
