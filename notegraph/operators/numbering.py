"""Numbers within groups, however large a group is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from notegraph.session import Scratch


def numbered(df: DataFrame, group: list[str], order: list, scratch: Scratch, name: str) -> DataFrame:
    """Adds ``idx``, from 1 on within each group (of all rows without one), by columns or sort expressions ``order``.

    Rows are sorted in ranges, and a range's rows are numbered on from the ranges before it. So a large group is many
    tasks', which `row_number` over a window is not.
    """
    by = [*[F.col(c).asc_nulls_first() for c in group], *[F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order]]
    rows = df.repartitionByRange(*by).sortWithinPartitions(*by)
    rows = scratch.write(rows.withColumn("_at", F.monotonically_increasing_id()), f"{name}-sorted").withColumn("_part", F.shiftright("_at", 33))
    pieces = rows.groupBy("_part", *group).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(W.partitionBy(*group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    pieces = pieces.select(F.col("_part").alias("_p"), *[F.col(c).alias(f"_of_{c}") for c in group], "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    # a null in a group's column is a value like others
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in group]
    out = rows.join(pieces, [F.col("_part") == F.col("_p"), *same]).select(*df.columns, (F.col("_at") - F.col("_first") + F.col("_before") + 1).alias("idx"))
    return scratch.write(out, name)
