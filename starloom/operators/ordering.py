"""Whole-table order: row numbers, running sums and n-tiles over any number of rows.

An order is a list of column names; a leading minus makes one descending. As Spark sorts by default, nulls come first ascending
and last descending. Where a row's place matters, the last column must be unique: then equal values spread over ranges too.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators.durable import durable

RANGES = 4  # per shuffle partition
MOST_RANGES = 16_384  # their bounds go to every task
SAMPLED = 16  # rows per range


def _named(order: Iterable[str]) -> list[tuple[str, bool]]:
    """(column, whether descending)"""
    return [(term.removeprefix("-"), term.startswith("-")) for term in order]


def sorting(order: list[str]) -> list[Column]:
    return [F.desc(name) if down else F.asc(name) for name, down in _named(order)]


def stands_before(x: Column, order: list[str], or_equal: bool = False) -> Column:
    """Whether x, a struct of the order's columns, stands before the row at hand in that order."""
    result = F.lit(or_equal)
    for name, down in reversed(_named(order)):
        own, other = F.col(name), x.getField(name)
        less = (other > own) if down else (other < own)
        null_first, null_last = (own, other) if down else (other, own)
        less = F.coalesce(less, F.lit(False)) | (null_first.isNull() & null_last.isNotNull())
        result = less | (other.eqNullSafe(own) & result)
    return result


def bounds(df: DataFrame, by: dict[str, list[str]], ranges: int) -> DataFrame:
    """One stored row: for each name an array of the first rows of all ranges of its order but the first range.

    They are every so many-th row of a sorted sample of some SAMPLED rows per range, which a hash of the rows' values chooses. Any bounds give right
    results; even ones keep tasks even.
    """
    columns = sorted({name for order in by.values() for name, _ in _named(order)})
    skipped = max(1, df.count() // (ranges * SAMPLED))
    sample = df.select(*columns).where(F.pmod(F.xxhash64(*columns), F.lit(skipped)) == 0)

    def listed(order: list[str]) -> Column:
        at = sample.select(F.struct(*[name for name, _ in _named(order)]).alias("bound"), F.row_number().over(Window.orderBy(*sorting(order))).alias("i"),
                           F.count(F.lit(1)).over(Window.partitionBy()).alias("n"))
        step = F.greatest(F.lit(1), F.ceil(F.col("n") / ranges))
        found = F.array_sort(F.collect_list(F.struct("i", "bound")))
        return at.where(F.col("i") % step == 0).agg(F.transform(found, lambda b: b["bound"])).scalar()

    return durable(df.sparkSession.range(1).select(*[listed(order).alias(name) for name, order in by.items()]), "bounds")


def range_of(bound: str, order: list[str]) -> Column:
    """The number of bounds in a column that stand before a row or are equal to it, by bisection."""
    bound = F.col(bound)
    halves = F.array(*[F.lit(1 << k) for k in reversed(range(MOST_RANGES.bit_length()))])
    return F.aggregate(halves, F.lit(0), lambda at, step: F.when(
        (at + step <= F.size(bound)) & stands_before(F.get(bound, at + step - 1), order, or_equal=True), at + step).otherwise(at))


def range_count(df: DataFrame) -> int:
    return min(MOST_RANGES, RANGES * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def ordered(df: DataFrame, order: list[str], running: dict[str, str] | None = None, row_no: str = "row_no",
            row_count: str | None = None, totals: dict[str, str] | None = None) -> DataFrame:
    """Add the 1-based row number in a total order, running sums (`running`) and whole sums (`totals`) of columns.

    The rows are shuffled once. Without running sums they are range-partitioned, sorted and stored, and a row's number is the row count of the
    files before its own plus its place in its file. Running sums need a window, which would shuffle the ranges again; so the ranges' bounds
    are taken from a sample beforehand, the window itself deals the rows by range, and its result is stored. Only the totals of files or ranges
    meet in one task, and repeated tasks change nothing.
    """
    running, totals = running or {}, totals or {}
    if running:
        bound = bounds(df, {"_bound": order}, range_count(df)).scalar()
        inside = Window.partitionBy("_range").orderBy(*sorting(order)).rowsBetween(Window.unboundedPreceding, 0)
        ranged = df.withColumn("_bound", bound).withColumn("_range", range_of("_bound", order)).drop("_bound").select(
            "*", F.row_number().over(inside).alias("_row"), *[F.sum(col).over(inside).alias(f"_run_{name}") for name, col in running.items()])
        stored, part = durable(ranged, "ordered"), ["_range"]
    else:
        ranged = df.repartitionByRange(*sorting(order)).withColumn("_range", F.spark_partition_id()).sortWithinPartitions(*sorting(order))
        stored, part = durable(ranged, "ordered").select(
            "*", F.col("_metadata.file_name").alias("_file"), (F.col("_metadata.row_index") + 1).alias("_row")), ["_range", "_file"]
    sizes = stored.groupBy(*part).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(col).alias(f"_sum_{name}") for name, col in {**running, **totals}.items()])
    before = Window.orderBy(*part).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    offsets = sizes.select(
        F.col(part[-1]).alias("_of"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n_before"),
        F.sum("_n").over(whole).alias("_n_all"),
        *[F.sum(f"_sum_{name}").over(before).alias(f"_before_{name}") for name in running],
        *[F.sum(f"_sum_{name}").over(whole).alias(name) for name in totals],
    )
    # a row per file or range, stored, so that its measured size decides how it is joined
    out = stored.join(durable(offsets, "ordered-offsets"), F.col(part[-1]) == F.col("_of"))
    extra = [(F.col("_n_before") + F.col("_row")).cast("bigint").alias(row_no)]
    if row_count:
        extra.append(F.col("_n_all").cast("bigint").alias(row_count))
    for name in running:
        before_sum, run = F.col(f"_before_{name}"), F.col(f"_run_{name}")
        extra.append(F.coalesce(before_sum + run, before_sum, run).alias(name))
    extra += [F.col(name) for name in totals]
    return out.select(*df.columns, *extra)


def ntiles(df: DataFrame, by: dict[str, list[str]], tiles: int) -> DataFrame:
    """Add an exact NTILE over the whole table for each name and order of `by`: the first (n mod tiles) tiles hold one row more.

    Rows are neither sorted nor moved. A sample gives bounds of ranges, and one pass counts the rows of each range; only rows of ranges that
    hold a tile's last row are ranked, and every row is labelled by how many of these last rows stand before it. df is read four times,
    three of them without its other columns; store it first if it is costly.
    """
    if tiles == 1:
        return df.select("*", *[F.lit(1).alias(name) for name in by])
    found = bounds(df, by, range_count(df))
    columns = sorted({c for order in by.values() for c, _ in _named(order)})
    bounded = df.select(*columns, *[found.select(name).scalar().alias(f"_bound_{name}") for name in by])
    places = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), range_of(f"_bound_{name}", order).alias("range")) for name, order in by.items()]))
    spread = bounded.select(*columns, places.alias("at")).select(*columns, "at.name", "at.range")

    # a row per name and range
    upto = F.sum("n").over(Window.partitionBy("name").orderBy("range"))
    counted = spread.groupBy("name", "range").agg(F.count(F.lit(1)).alias("n")).select(
        "name", "range", upto.alias("upto"), "n", F.sum("n").over(Window.partitionBy("name")).alias("all"))
    last = F.col("tile") * F.floor(F.col("all") / tiles) + F.least(F.col("tile"), F.col("all") % tiles)
    wanted = counted.select("*", F.explode(F.sequence(F.lit(1), F.lit(tiles - 1))).alias("tile")).where(
        (last <= F.col("upto")) & (last > F.col("upto") - F.col("n"))).groupBy(F.col("name").alias("of"), F.col("range").alias("of_range")).agg(
        F.collect_list(last - F.col("upto") + F.col("n")).alias("nth"))

    held = spread.join(F.broadcast(wanted), (F.col("name") == F.col("of")) & (F.col("range") == F.col("of_range")))  # at most tiles - 1 rows per name
    own = [F.when(F.col("name") == name, F.col(c)) for name, order in by.items() for c, _ in _named(order)]  # null, so without effect, for other names
    down = [d for order in by.values() for _, d in _named(order)]
    rank = F.row_number().over(Window.partitionBy("name", "range").orderBy(*[c.desc() if d else c.asc() for c, d in zip(own, down)]))
    cut = held.select("name", "nth", F.struct(*columns).alias("row"), rank.alias("rank"))
    last_rows = F.filter("nth", lambda n: n == F.col("rank"))  # tiles without rows end where others do
    cuts = cut.select("name", F.explode(F.transform(last_rows, lambda n: F.col("row"))).alias("row")).agg(
        *[F.collect_list(F.when(F.col("name") == name, F.col("row"))).alias(name) for name in by])
    cuts = durable(cuts, "ntile-cuts")
    labelled = df.select("*", *[cuts.select(name).scalar().alias(f"_cuts_{name}") for name in by])

    def tile(name: str) -> Column:
        return F.size(F.filter(f"_cuts_{name}", lambda cut: stands_before(cut, by[name]))) + 1

    return labelled.select(*df.columns, *[tile(name).cast("int").alias(name) for name in by])


def ntile(df: DataFrame, order: list[str], tiles: int, name: str) -> DataFrame:
    """ntiles() of one order."""
    return ntiles(df, {name: order}, tiles)


def weighted_percentiles(counts: DataFrame, group: str, value: str, n: str, points: Iterable[float], total_as: str) -> DataFrame:
    """(group, total_as, p<percent> ...) of stored rows (group, value, n) that are unique on (group, value): exact interpolated percentiles.

    Running sums of n over ranges of (group, value) give the place of each value in its group, so no task holds a group. A point
    falls between the values at two places, of which each is a grouped minimum. Null is a group; null values are left out.
    """
    counts, points = counts.where(F.col(value).isNotNull()), list(points)
    placed = ordered(counts.select(group, value, n), [group, value], running={"_upto": n})
    sizes = counts.groupBy(group).agg(F.sum(n).cast("bigint").alias(total_as))
    # a row per group
    before = Window.orderBy(F.asc(group)).rowsBetween(Window.unboundedPreceding, -1)
    starts = durable(sizes.select(F.col(group).alias("_group"), total_as, F.coalesce(F.sum(total_as).over(before), F.lit(0)).alias("_before")), "percentile-groups")
    met = placed.join(starts, F.col(group).eqNullSafe(F.col("_group")))
    number, upto = F.col(value).cast("double"), F.col("_upto") - F.col("_before")

    def at(place: Column) -> Column:
        return F.min(F.when(upto > place, number))

    place = [F.lit(float(p)) * (F.col(total_as) - 1) for p in points]
    found = met.groupBy(group, total_as).agg(*[c for k, p in enumerate(place) for c in (at(F.floor(p)).alias(f"_low{k}"), at(F.ceil(p)).alias(f"_high{k}"))])
    low, high = ([F.col(f"_{end}{k}") for k in range(len(points))] for end in ("low", "high"))
    return found.select(group, total_as, *[
        F.when(a == b, a).otherwise((F.ceil(at) - at) * a + (at - F.floor(at)) * b).alias(f"p{round(p * 100)}")
        for p, at, a, b in zip(points, place, low, high)])


def top_k(df: DataFrame, order: list[Column], k: int, rank_as: str | None = None) -> DataFrame:
    """First k rows of an order (each task keeps k rows), optionally numbered from 1."""
    best = df.orderBy(*order).limit(k)
    if rank_as is None:
        return best
    return best.select(F.row_number().over(Window.orderBy(*order)).cast("int").alias(rank_as), *df.columns)
