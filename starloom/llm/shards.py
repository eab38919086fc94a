"""Contiguous shards of near-equal bytes from global prefix sums. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators.durable import durable

SHARDS = 16


def byte_shards(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, shard, slot.

    size is the text's UTF-8 bytes plus 1, text_crc32 its CRC-32; a null text has no bytes. Rows stand in
    the order (doc_id, text_crc32, size), null ids first. With T bytes in all, shard s takes the rows whose
    middle byte lies in [s T / shards, (s + 1) T / shards): shards are contiguous and differ from T / shards
    by at most one row's size. slot counts from 0 in each shard. Rows that agree in all three order
    columns are interchangeable in the result. An empty table gives no rows. Good up to 2^63 / (2 shards) bytes.

    Rows are range-partitioned (a unique tag splits even fully equal rows) and stored with their range
    number. Only range totals, one row per partition, meet in one task; they are broadcast as offsets.
    """
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    slim = durable(docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(raw) + F.lit(1)).cast("bigint").alias("size"),
                               F.crc32(raw).alias("text_crc32"), F.monotonically_increasing_id().alias("tag")), "shard-sizes")
    order = ["doc_id", "text_crc32", "size", "tag"]
    ranged = durable(slim.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "shard-ranges")
    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "part", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"), F.sum("bytes").over(Window.partitionBy()).alias("all_bytes"))
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ranged.select("*", F.sum("size").over(inside).alias("upto"), F.count(F.lit(1)).over(inside).alias("nth")).join(
        F.broadcast(offsets), "part")  # one row per shuffle partition
    twice_middle = (F.col("bytes_before") + F.col("upto")) * 2 - F.col("size")
    placed = durable(placed.select(
        "doc_id", "size", "text_crc32", twice_middle.alias("twice_middle"), "all_bytes",
        (F.col("rows_before") + F.col("nth") - 1).alias("row")
    ).withColumn("shard", F.expr(f"(twice_middle * {int(shards)}) div (2 * all_bytes)").cast("int")).drop("twice_middle", "all_bytes"),
        "shard-rows")
    starts = placed.groupBy("shard").agg(F.min("row").alias("first_row"))
    return placed.join(F.broadcast(starts), "shard").select(  # one row per shard
        "doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("first_row")).alias("slot"))
