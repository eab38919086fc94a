"""Tiles: bounded groups of items under small count vectors, and the pairs of tiles whose vectors are near."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.durable import durable


def steps(parts: int, radius: int) -> list[list[int]]:
    """Differences between two vectors of `parts` counts with an L1 length up to radius; of a difference and its negative only one."""
    found = [[]]
    for _ in range(parts):
        found = [[*s, d] for s, d in product(found, range(-radius, radius + 1)) if sum(map(abs, s)) + abs(d) <= radius]
    return [s for s in found if next((d for d in s if d), 1) > 0]


def tiled(items: DataFrame, key: Column, most: Column, columns: list[str]) -> DataFrame:
    """(key, block, one array per column): the items of each key, dealt by hash over enough blocks for about `most` (of the key) in each.

    A key with very many items is counted with partial sums and has many blocks, so no task meets it whole. Rows must be distinct.
    """
    keyed = items.select("*", key.alias("key"))
    sizes = durable(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("key").alias("of_key"), F.ceil(F.col("n") / most).cast("int").alias("blocks")), "tile-sizes")
    dealt = keyed.join(sizes, F.col("key") == F.col("of_key")).withColumn("block", F.pmod(F.xxhash64(*columns), F.col("blocks")).cast("int"))
    rows = dealt.groupBy("key", "block").agg(F.first("blocks").alias("blocks"), F.collect_list(F.struct(*columns)).alias("rows"))
    return durable(rows.select("key", "block", "blocks", *[F.col(f"rows.{c}").alias(c) for c in columns]), "tiles")


def tile_pairs(tiles: DataFrame, differences: list[list[int]], columns: list[str]) -> DataFrame:
    """Rows (one, other: a struct of the columns each, same: whether they are one tile): all pairs of tiles whose keys differ by one of the differences.

    A pair of different keys is found once, as are two blocks of one key. Keys meet their neighbours as keys, in a small table; tiles join afterwards,
    a tile at a time, and a tile's partners of one key are multiplied only where the tile stands.
    """
    keys = tiles.groupBy("key").agg(F.max("blocks").alias("blocks"))
    moves = F.array(*[F.array(*map(F.lit, d)) for d in differences])
    near = keys.select(F.col("key").alias("one_key"), F.explode(moves).alias("move")).select(
        "one_key", F.zip_with("one_key", "move", lambda a, b: a + b).alias("other_key"))
    met = durable(near.join(keys.select(F.col("key").alias("other_key"), F.col("blocks").alias("other_blocks")), "other_key"), "tile-keys")
    one = tiles.select(F.col("key").alias("one_key"), F.col("block").alias("one_block"), F.struct(*columns).alias("one"))
    other = tiles.select(F.col("key").alias("other_key"), F.col("block").alias("other_block"), F.struct(*columns).alias("other"))
    dealt = one.join(met, "one_key").withColumn("other_block", F.explode(F.sequence(F.lit(0), F.col("other_blocks") - 1)))
    own = F.col("one_key") == F.col("other_key")
    dealt = dealt.where(~own | (F.col("one_block") <= F.col("other_block")))
    return dealt.join(other, ["other_key", "other_block"]).select("one", "other", (own & (F.col("one_block") == F.col("other_block"))).alias("same"))
