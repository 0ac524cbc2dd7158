"""Running numbers over a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from snapbook.session import bytes_of, cut

ROW_BITS = 33

# Bytes of input files behind one range partition at most, so that a task sorts no more when the table grows.
NUMBERED_BYTES = 16 << 20


def number_rows(df: DataFrame, order: Sequence[Column], name: str, partitions: int | None = None) -> DataFrame:
    """1, 2, 3, ... over the whole frame, without gathering it in one task.

    Range partitions are sorted on their own and written to the shared folder. A row's number
    is the size of the partitions before its own plus its place inside; only the sizes (one row per
    partition) are summed in one task. Copies of one row are told apart by their input position, so even
    a frame of equal rows spreads.
    """
    spark = df.sparkSession
    parts = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-bytes_of(spark, df.inputFiles()) // NUMBERED_BYTES))
    by = [*order, F.col("_position").asc()]
    placed = cut(
        df.withColumn("_position", F.monotonically_increasing_id())
        .repartitionByRange(parts, *by)
        .sortWithinPartitions(*by)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    # The slot holds the partition number in its upper bits and the place in the lower ones.
    rows = placed.withColumns(
        {
            "_part": F.shiftright("_slot", ROW_BITS),
            "_row": F.col("_slot").bitwiseAND(F.lit((1 << ROW_BITS) - 1)),
        }
    )
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    return rows.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_offset") + F.col("_row") + 1).alias(name)
    )
