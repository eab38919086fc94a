"""CSV records that may span lines, read by as many tasks as the files have splits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WHOLE, HEAD, TAIL = 0, 1, 2  # a record inside one split; the end of one that an earlier split began; the begin of one that a later split ends


def records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """One row (record) per non-empty record of quoted CSV files, without the line break at its end; line breaks inside quotes are kept as they are.

    A line break ends a record where the number of quotes before it in the file is even, as in files whose quotes are doubled inside
    values and stand nowhere else. One pass counts the quotes of each split; sums over the splits before it, a row each, tell
    whether a split begins inside quotes. With that every split is cut on its own, in its own task. Records that cross splits
    are put together from their parts, at most two per split, by a second pass that sends nothing else.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    quotes = F.char_length("value") - F.char_length(F.replace("value", F.lit('"'), F.lit("")))
    odd = lines.groupBy("file", "start").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    opened = odd.select(F.col("file").alias("o_file"), F.col("start").alias("o_start"), (F.sum("odd").over(before) % 2).alias("inside")).where("inside = 1")
    # at most a row per split, about a millionth of the files; its rows must come to the lines, whose order counts
    marked = lines.join(F.broadcast(opened), (F.col("file") == F.col("o_file")) & (F.col("start") == F.col("o_start")), "left").select(
        "value", "file", "start", F.col("inside").isNotNull().alias("inside"))
    whole = marked.mapInArrow(_cut(header, [WHOLE]), "record string, file string, start bigint, kind int").select("record")
    parts = marked.mapInArrow(_cut(header, [HEAD, TAIL]), "record string, file string, start bigint, kind int")
    # a head belongs to the last tail before it; splits between have a head that does not end the record
    upto = Window.partitionBy("file").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    joined = parts.withColumn("nth", F.count_if(F.col("kind") == TAIL).over(upto)).groupBy("file", "nth").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "record"))).alias("parts"))
    crossing = joined.select(F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"))
    return whole.unionByName(crossing).select(F.regexp_replace("record", "\r$", "").alias("record")).where("record <> ''")


def _cut(header: bool, wanted: list[int]):
    """Cut the lines of each split, which come in order, into records and parts of records."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, waiting, inside, kind, first = None, [], False, WHOLE, False

        def out(found: pa.Array, as_kind: int) -> pa.RecordBatch:
            size = len(found)
            return pa.RecordBatch.from_arrays([found, pa.array([at[0]] * size, pa.string()), pa.array([at[1]] * size, pa.int64()),
                                               pa.array([as_kind] * size, pa.int32())], names=["record", "file", "start", "kind"])

        def rest() -> Iterator[pa.RecordBatch]:
            """What the split at hand leaves open."""
            last = HEAD if kind == HEAD else TAIL
            if waiting and last in wanted:
                yield out(pa.array(["\n".join(waiting)]), last)

        for batch in batches:
            files, starts = batch.column("file"), batch.column("start").to_numpy()
            changes = np.flatnonzero(np.diff(starts) != 0) + 1
            same_file = pc.equal(files.slice(1), files.slice(0, len(files) - 1)).to_numpy(zero_copy_only=False) if len(files) > 1 else np.zeros(0, bool)
            cuts = [0, *sorted({*changes.tolist(), *(np.flatnonzero(~same_file) + 1).tolist()}), batch.num_rows]
            for low, high in zip(cuts, cuts[1:]):
                if low == high:
                    continue
                here = (files[low].as_py(), int(starts[low]))
                if here != at:
                    yield from rest()
                    at, waiting, inside = here, [], batch.column("inside")[low].as_py()
                    kind, first = (HEAD if inside else WHOLE), header and here[1] == 0
                values = batch.column("value").slice(low, high - low)
                parity = (np.cumsum(pc.count_substring(values, '"').to_numpy()) + inside) % 2
                ends = np.flatnonzero(parity == 0)
                inside = bool(parity[-1])
                if not len(ends):
                    waiting += values.to_pylist()
                    continue
                begun = "\n".join([*waiting, *values.slice(0, ends[0] + 1).to_pylist()])
                if kind in wanted and not first:
                    yield out(pa.array([begun]), kind)
                first = False
                if WHOLE in wanted and len(ends) > 1:
                    offsets = pa.array(ends - ends[0], pa.int32())
                    lines = values.slice(ends[0] + 1, ends[-1] - ends[0])
                    joined = lines if len(lines) == len(ends) - 1 else pc.binary_join(pa.ListArray.from_arrays(offsets, lines), "\n")
                    yield out(joined, WHOLE)
                kind, waiting = WHOLE, values.slice(ends[-1] + 1).to_pylist()
        yield from rest()

    return run
