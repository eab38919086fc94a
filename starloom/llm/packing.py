"""Best-fit packing of documents into sequences of a fixed number of tokens.

Only the counts of piece lengths, one number for each length up to the capacity, decide which lengths share a
sequence; that plan is a few thousand runs whatever the corpus holds. The pieces are then numbered within
their length and find their place in the runs.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.batches import text_slices
from starloom.llm.tokens import encoder
from starloom.operators.durable import durable

CAPACITY = 2048
END_ID = 0  # closes each document


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The token pieces of all documents, stored: doc_id, piece, start, length, ids, part, nth.

    A document's ids are its whole text's and END_ID; null text counts as empty, so each row has a piece.
    Only documents longer than the capacity are cut. ids holds little-endian unsigned 32-bit numbers.
    part is the task that made the piece, nth its number among that task's pieces of equal length.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        rules = docs.sparkSession.sparkContext.broadcast(f.read())  # one vocabulary file
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("part", T.IntegerType()),
        T.StructField("nth", T.LongType())])

    def run(batches):
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        encode = encoder(rules.value).encode
        for batch in batches:
            for low, texts in text_slices(batch.column(1), rows=batch.num_rows):
                yield _cut(batch.column(0).slice(low, len(texts)), encode(texts), capacity, part, seen)

    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return durable(slim.mapInArrow(run, schema), "pack-pieces")


def _cut(names: pa.Array, ids: list[np.ndarray], capacity: int, part: int, seen: np.ndarray) -> pa.RecordBatch:
    """Pieces of some documents; `seen` counts the pieces of each length so far."""
    size = np.array([len(x) + 1 for x in ids], np.int64)
    flat = np.zeros(size.sum(), "<u4")
    ends = np.cumsum(size)
    for x, end in zip(ids, ends):
        flat[end - len(x) - 1:end - 1] = x
        flat[end - 1] = END_ID
    count = -(-size // capacity)
    row = np.repeat(np.arange(len(ids)), count)
    piece = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    start = piece * capacity
    length = np.minimum(size[row] - start, capacity)
    by_length = np.argsort(length, kind="stable")
    ordered = length[by_length]
    first = np.r_[True, ordered[1:] != ordered[:-1]]
    nth = np.empty(len(length), np.int64)
    nth[by_length] = np.arange(len(length)) - np.flatnonzero(first)[np.cumsum(first) - 1] + seen[ordered]
    seen += np.bincount(length, minlength=len(seen))
    edges = pa.py_buffer(np.r_[0, np.cumsum(length)].astype(np.int64) * 4)
    binary = pa.Array.from_buffers(pa.large_binary(), len(length), [None, edges, pa.py_buffer(flat)]).cast(pa.binary())
    return pa.RecordBatch.from_arrays(
        [names.take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), binary,
         pa.array(np.full(len(length), part, np.int32)), pa.array(nth)],
        names=["doc_id", "piece", "start", "length", "ids", "part", "nth"])


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first, count, sequence, per_sequence, offset) that place counts[length] pieces of each length.

    Pieces first .. first + count - 1 of a length go per_sequence at a time to the sequences from `sequence` on,
    side by side from `offset`.

    Pieces over a third of the capacity share a sequence with at most one other such piece: from the longest
    down, each is matched with the longest that still fits. Then smaller ones, from the longest down, go to the
    smallest gap that takes them, as often as it does, and to new sequences when no gap is large enough. Equal
    pieces and equal gaps are handled together, so the steps do not depend on the number of pieces.
    """
    left = {n: c for n, c in counts.items() if c}
    used: dict[int, int] = defaultdict(int)
    runs: list[tuple[int, int, int, int, int, int]] = []
    gaps: list[int] = []  # sorted gap sizes that occur
    open_: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> (first sequence, sequences)
    sequences = 0

    def put(length: int, bins: int, sequence: int, per: int, offset: int) -> None:
        runs.append((length, used[length], bins * per, sequence, per, offset))
        used[length] += bins * per
        left[length] -= bins * per

    def offer(gap: int, sequence: int, bins: int) -> None:
        if gap and bins:
            if not open_[gap]:
                insort(gaps, gap)
            open_[gap].append((sequence, bins))

    def fresh(length: int, bins: int, per: int = 1) -> int:
        nonlocal sequences
        at, sequences = sequences, sequences + bins
        put(length, bins, at, per, 0)
        return at

    large = sorted(n for n in left if 3 * n > capacity)
    for length in reversed(large):
        while left[length]:
            mates = [m for m in large[:bisect_left(large, capacity - length + 1)] if m <= length and left[m] > (m == length)]
            if not mates:
                bins = left[length]
                offer(capacity - length, fresh(length, bins), bins)
                break
            mate = mates[-1]
            if mate == length:
                bins = left[length] // 2
                offer(capacity - 2 * length, fresh(length, bins, 2), bins)
            else:
                bins = min(left[length], left[mate])
                at = fresh(length, bins)
                put(mate, bins, at, 1, length)
                offer(capacity - length - mate, at, bins)
    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[length]:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                per = capacity // length
                bins = -(-left[length] // per)
                offer(capacity, sequences, bins)
                sequences += bins
                continue
            gap = gaps[at]
            first, bins = open_[gap].pop()
            if not open_[gap]:
                gaps.pop(at)
            per = min(gap // length, left[length])
            full = min(bins, left[length] // per)
            put(length, full, first, per, capacity - gap)
            offer(gap - per * length, first, full)
            offer(gap, first + full, bins - full)
    return runs


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to stored pieces (length, part, nth and any columns); drops part and nth.

    Counts by (part, length) give each piece its number among all pieces of its length; at most `capacity`
    numbers go to the driver, and the plan made of them comes back as a broadcast of bounded size. One part's
    pieces of one length are bounded by a scan task, so no key of the join is hot.
    """
    groups = durable(cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "pack-counts")
    counts = {r["length"]: r["n"] for r in groups.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = groups.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = cut.join(starts, ["part", "length"]).withColumn("nth", F.col("nth") + F.col("before")).drop("before", "part")
    runs = np.array(sorted(plan(counts, capacity)), np.int64).reshape(-1, 6)
    sent = cut.sparkSession.sparkContext.broadcast(runs)
    out = T.StructType([f for f in numbered.schema if f.name != "nth"]).add("sequence_id", T.LongType()).add("offset", T.LongType())

    def run(batches):
        length_of, first, _, sequence, per, offset = sent.value.T
        span = int(first.max(initial=0)) + int(sent.value[:, 2].max(initial=0)) + 1
        keys = length_of * span + first  # below 2^63 up to 4e15 pieces
        for batch in batches:
            length, nth = (batch.column(c).to_numpy() for c in ("length", "nth"))
            at = np.searchsorted(keys, length * span + nth, side="right") - 1
            k = nth - first[at]
            kept = [i for i, f in enumerate(batch.schema.names) if f != "nth"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in kept] + [pa.array(sequence[at] + k // per[at]), pa.array(offset[at] + k % per[at] * length)],
                names=[batch.schema.names[i] for i in kept] + ["sequence_id", "offset"])

    return numbered.mapInArrow(run, out)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All pieces with their ids and places: doc_id, piece, start, length, ids, sequence_id, offset. An empty table gives no rows."""
    return place(pieces(docs, tokenizer_path, capacity, id_col, text_col), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: sequence_id, length, ids (bytes of its pieces in order). A sequence holds at most the capacity."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids", "length"))).alias("p"))
    joined = F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    total = F.aggregate("p", F.lit(0).cast("bigint"), lambda a, x: a + x["length"])
    return parts.select("sequence_id", total.alias("length"), joined.alias("ids"))
