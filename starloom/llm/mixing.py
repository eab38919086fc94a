"""Mixing sources to target weights: repetition rates from grouped sizes, then whole copies and one Bernoulli copy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators.durable import durable

WORD = r"[^\x20\x09-\x0D]+"
MOST_REPEATS = 3  # a source is never taken more than so many times
SEED = "mix-1"


def word_count(text: Column) -> Column:
    """Number of words between ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def cyclic_weights(sources: DataFrame, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Give (source, source_size) rows the weights of `cycle` in turn, sources by code point, null last.

    Only source names, not documents, meet in the one window.
    """
    nth = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    at = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), (nth % len(cycle) + 1).cast("int"))
    return sources.select("source", "source_size", at.alias("weight"))


def targets(sources: DataFrame, most: int = MOST_REPEATS) -> DataFrame:
    """Add `target` to (source, source_size, weight) rows.

    The sum of all sizes is shared by weight; no target exceeds `most` times its source's size, and what is
    above goes to the others by weight until none is above. That end state is min(most * size, level * weight)
    for one level, found in one pass over the sources in the order of size / weight: the first source that the
    level left by all earlier (full) ones does not fill sets it.
    """
    full = F.col("source_size") * most
    order = [F.col("source_size") / F.col("weight"), F.asc_nulls_last("source")]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    onwards = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum(full).over(before), F.lit(0))).cast("double") / F.sum("weight").over(onwards)
    steps = sources.select("*", level.alias("level"), F.row_number().over(Window.orderBy(*order)).alias("nth"))
    open_ = F.col("level") * F.col("weight") <= full
    found = steps.withColumn("level", F.min_by(F.when(open_, F.col("level")), F.when(open_, F.col("nth"))).over(whole))
    return found.select("source", "source_size", "weight", F.least(full.cast("double"), F.col("level") * F.col("weight")).alias("target"))


def draw(id_: Column, text: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) fixed by seed and id; by seed and text where the id is null."""
    key = F.coalesce(id_.cast("string"), F.concat(F.lit("text "), F.coalesce(text, F.lit(""))))
    digits = F.substring(F.md5(F.concat(F.lit(seed + " "), key).cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("bigint").cast("double") / F.lit(float(1 << 52))


def with_copies(sized: DataFrame, planned: DataFrame) -> DataFrame:
    """Add source_size, target and `copies` to rows with source, size and draw.

    A row is taken floor(rate) times, and once more if its draw is below the rate's fraction, where rate is
    target / source_size. `planned` is a stored table with a row per source: it is broadcast if its measured
    size allows that, and joined by a shuffle (hot sources split by AQE) if not.
    """
    plan = planned.select(F.col("source").alias("p_source"), "source_size", "target")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    joined = sized.join(plan, F.col("source").eqNullSafe(F.col("p_source"))).withColumn("rate", rate)
    extra = (F.col("draw") < F.col("rate") - F.floor("rate")).cast("bigint")
    return joined.withColumn("copies", F.floor("rate") + extra).drop("p_source", "rate")


def plan_mixture(sized: DataFrame, weights=cyclic_weights, most: int = MOST_REPEATS) -> DataFrame:
    """Sizes, weights and targets of all sources, stored. `weights` turns (source, source_size) into rows with a weight above 0."""
    return durable(targets(weights(sized.groupBy("source").agg(F.sum("size").alias("source_size"))), most), "mix-sources")


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **plan) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, copies.

    Null text has size 0; a null source is a source of its own; a source of size 0 has target 0. The draw
    depends on the id alone, so reruns agree and repeated rows share it. An empty table gives no rows.
    """
    sized = durable(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
                                draw(F.col(id_col), F.col(text_col)).alias("draw")), "mix-sizes")
    return with_copies(sized, plan_mixture(sized, **plan)).drop("draw")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **plan) -> DataFrame:
    """The mixed corpus: each row of docs, all columns, as many times as it is taken."""
    sized = docs.select(F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    rows = docs.select(F.struct("*").alias("row"), F.col(source_col).alias("source"), draw(F.col(id_col), F.col(text_col)).alias("draw"))
    taken = with_copies(rows, plan_mixture(sized, **plan))
    return taken.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("row.*")
