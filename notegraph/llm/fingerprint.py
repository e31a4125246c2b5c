"""Document fingerprints: bottom-k sketches of shingle hashes. DataFrame functions only.

A sketch holds the k smallest distinct 64-bit hashes of a text's word shingles, sorted. Sketches of parts merge into
the sketch of the whole, and two of them estimate resemblance, containment and the number of distinct shingles: the
k smallest values of the union are a fair sample of the union's shingles, and those in both sketches are shared.

Defined cases: a null text is empty; very long texts count whole; a text without words has an empty sketch; with fewer
words than a shingle has, the whole sequence is the one shingle. Two empty sketches are alike (1.0), an empty and another
are not (0.0). Rows of one id are ordered by their text's hash, those without an id come first, and many of either kind
are sorted in parts by that hash; the one row of a table is its own next document; an empty table gives no rows; extra
columns, whatever their names, are never read.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from notegraph.llm.common import lower_ascii, shingle_hashes, table, text_or_empty, words
from notegraph.llm.sharding import _range_of

K, SHINGLE = 64, 3
#: Rows that are sorted together to find each document's next one.
CHUNK_ROWS = 4096
#: The first rows of so many chunks at most are broadcast; beyond that the chunks grow, and their sort spills.
MOST_CHUNKS = 20_000


def sketch(text: Column, k: int = K, n: int = SHINGLE) -> Column:
    return F.slice(F.sort_array(shingle_hashes(words(lower_ascii(text_or_empty(text))), n)), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts taken together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_sketches(df: DataFrame, keys: list[str], sketch_col: str, k: int = K) -> DataFrame:
    """One sketch per key, of all rows of that key; at most k values per task and key are shuffled."""
    values = df.select(*keys, F.explode(sketch_col).alias("__ng_v")).groupBy(*keys, "__ng_v").agg(F.lit(1).alias("__ng_one"))
    first = values.withColumn("__ng_rn", F.row_number().over(W.partitionBy(*keys).orderBy("__ng_v"))).where(F.col("__ng_rn") <= k)
    return first.groupBy(*keys).agg(F.sort_array(F.collect_list("__ng_v")).alias(sketch_col))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    both = merged(a, b, k)
    shared = F.size(F.array_intersect(F.array_intersect(a, b), both))
    return F.when(F.size(both) == 0, 1.0).otherwise(shared / F.size(both))


def distinct_count(a: Column, k: int = K) -> Column:
    """Exact below k shingles, else (k - 1) over the share of the hash range that k values took."""
    share = (F.element_at(a, -1).cast("double") + float(1 << 63)) / float(1 << 64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """The share of a's shingles that b has too."""
    r = resemblance(a, b, k)
    shared = r / (1 + r) * (distinct_count(a, k) + distinct_count(b, k))
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), shared / distinct_count(a, k)))


def as_string(a: Column) -> Column:
    """16 hexadecimal digits per value."""
    return F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def with_next(df: DataFrame, id_col: str, columns: list[str], chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``df (id_col, chunked columns)`` with the chunk and a copy of each chunk's first row at the end of the one before.

    Rows marked ``__ng_guest`` are those copies; a lead over ``next_window()`` then never has to leave its chunk.
    """
    key = F.col(id_col)
    n, no_id = df.agg(F.count("*"), F.count_if(key.isNull())).first()
    chunks = max(1, min(MOST_CHUNKS, (n - no_id) // chunk_rows))
    met = Counter()
    if chunks > 1:
        shares = [i / chunks for i in range(1, chunks)]
        met = Counter(df.agg(F.percentile_approx(key, shares, max(10_000, 10 * chunks))).first()[0])
    # an id that fills chunks has a range of its own, which is cut by the hash of the rows; so are rows without an id
    parts = {x: c + 1 for x, c in met.items() if c > 1}
    bounds = sorted(set(met) | {x + 1 for x in parts})
    many = F.lit(max(1, no_id // chunk_rows))
    for x, c in parts.items():
        many = F.when(key == x, c).otherwise(many)
    h = F.xxhash64(*columns)
    split = F.when(key.isNull() | key.isin(*parts), F.floor((h.cast("double") / float(1 << 64) + 0.5) * many)).otherwise(0)
    chunk = F.when(key.isNull(), -1).otherwise(_range_of(key, bounds)).cast("long") * (1 << 30) + split
    rows = df.withColumn("__ng_chunk", chunk)
    order = [key.isNotNull(), key, h]
    heads = rows.groupBy("__ng_chunk").agg(F.min(F.struct(order[0].alias("a"), key.alias("id"), order[2].alias("h"))).alias("head"))
    before = F.coalesce(F.lag("__ng_chunk").over(W.orderBy("__ng_chunk")), F.max("__ng_chunk").over(W.partitionBy(F.lit(1))))
    heads = heads.select("head", before.alias("__ng_to"))  # a row per chunk
    match = key.eqNullSafe(F.col("head.id")) & (h == F.col("head.h"))
    guests = rows.join(F.broadcast(heads), match).dropDuplicates(["__ng_to"])
    guests = guests.select(*df.columns, F.col("__ng_to").alias("__ng_chunk"), F.lit(True).alias("__ng_guest"))
    return rows.select(*df.columns, "__ng_chunk", F.lit(False).alias("__ng_guest")).unionByName(guests)


def next_window(id_col: str, columns: list[str]):
    return W.partitionBy("__ng_chunk").orderBy("__ng_guest", F.col(id_col).asc_nulls_first(), F.xxhash64(*columns))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(F.col("text")).alias("text"))
    w = next_window("doc_id", ["text"])
    rows = with_next(docs, "doc_id", ["text"]).withColumn("after", F.lead("text").over(w))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.coalesce("after", F.lit("")), F.lit(1), half))
    rows = rows.select("__ng_chunk", "__ng_guest", "doc_id", F.xxhash64("text").alias("h"), n.cast("long").alias("n_chars"), sketch(F.col("text")).alias("s"), edited.alias("edited"))
    rows = rows.select("*", F.sha2("edited", 256).alias("edited_sha256"), sketch(F.col("edited")).alias("es")).drop("edited")
    again = W.partitionBy("__ng_chunk").orderBy("__ng_guest", F.col("doc_id").asc_nulls_first(), F.col("h"))
    rows = rows.withColumn("ns", F.lead("s").over(again)).where(~F.col("__ng_guest"))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_string(F.col("s")).alias("fingerprint"),
        as_string(F.col("es")).alias("edited_fingerprint"),
        resemblance(F.col("s"), F.col("es")).alias("near_edited"),
        resemblance(F.col("s"), F.col("ns")).alias("near_next"),
    )
