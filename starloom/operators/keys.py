"""Surrogate keys 1..n without a single-partition window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from starloom.operators.durable import durable

HEX_DIGITS = 8  # of the digest that place a key: 2^32 places
KEYS_PER_TASK = 50_000  # fewer keys than this for each of the session's partitions are dealt to fewer tasks


def _numbered(stored: DataFrame, name: str, label: str, columns: list[str], folder: str | None = None) -> DataFrame:
    """Number the rows of a stored table by file and place in the file: no shuffle and no sort of rows.

    Only the row counts of the files meet in one task.
    """
    placed = stored.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    first = [F.min("_part").alias("_part")] if "_part" in stored.columns else []  # files of one task have ascending names
    sizes = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"), *first)
    before = Window.orderBy(*[c for c in ("_part", "_file") if c in sizes.columns]).rowsBetween(Window.unboundedPreceding, -1)
    # a row per file, stored, so that its measured size decides how it is joined
    starts = durable(sizes.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")), f"{label}-offsets", folder=folder)
    return placed.join(starts, "_file").withColumn(name, (F.col("_start") + F.col("_row") + 1).cast("bigint")).select(name, *columns)


def _by_digest(keyed: DataFrame, key: str, name: str, digits: int, folder: str | None, most: int) -> DataFrame:
    """Add the 1-based rank in (md5(key), key) order to at most so many rows, unique on key.

    A key's place among the partitions is known from its digest alone, so nothing is sampled and the rows are computed once:
    they are dealt to partitions of consecutive digests, sorted and stored, and the files give the ranks.
    """
    partitions = max(1, min(int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-most // KEYS_PER_TASK)))
    digest = F.md5(F.col(key).cast("string").cast("binary"))
    # a null key has no digest and stands first
    place = F.coalesce(F.conv(F.substring("_digest", 1, digits), 16, 10).cast("bigint"), F.lit(0))
    part = F.floor(place * partitions / F.lit(16 ** digits)).cast("int")
    dealt = keyed.withColumn("_digest", digest).withColumn("_part", part).repartitionById(partitions, F.col("_part"))
    stored = durable(dealt.sortWithinPartitions("_digest", key).drop("_digest"), f"{name}-ranked", folder=folder)
    return _numbered(stored, name, name, keyed.columns, folder)


def dense_keys(df: DataFrame, key: str, name: str, unique: bool = False, digits: int = HEX_DIGITS, folder: str | None = None) -> DataFrame:
    """Number the distinct values of a natural key 1..n and attach the number to every row. df is computed once.

    df is stored as it is and counted on the way, which fixes the number of tasks. unique=True states that df was grouped by key; then
    its rows are dealt once and no join is needed. Otherwise only its distinct keys are, so copies of one key collapse before they meet,
    and all copies share one number (the audit's uniqueness checks then report them). Intermediate tables stand below `folder` if given,
    whose owner deletes it.
    """
    seen = Observation(f"{name}-rows")
    stored = durable(df.observe(seen, F.count(F.lit(1)).alias("n")), f"{name}-rows", folder=folder)
    most = seen.get.get("n", 0)
    if unique:
        return _by_digest(stored, key, name, digits, folder, most)
    numbered = _by_digest(stored.select(F.col(key).alias("_key")).distinct(), "_key", name, digits, folder, most)
    return stored.join(numbered, F.col(key).eqNullSafe(F.col("_key")), "left").select(name, *df.columns)


def row_keys(df: DataFrame, name: str, label: str, folder: str | None = None) -> DataFrame:
    """Number rows 1..n with no shuffle and no sort.

    The rows are written once; a row's number is the row count of the files before its own plus its
    position in its file. Skewed or repeated values cannot matter, and the files fix the result.
    """
    return _numbered(durable(df, label, folder=folder), name, label, df.columns, folder)
