"""Exact top-k by inner product with MaxScore: vectors are documents, places are terms, integer products their scores."""

from __future__ import annotations

from operator import mul

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators.durable import durable

SCALE = 256
SHARD = 4096  # vectors of a shard at most
BLOCK = 256  # queries that meet a shard at once, at most
GROUP = 4  # shards that one copy of the queries is sent to, on average; fewer while that leaves cores idle
TASKS = 3  # per group, so that few groups meet in one task; the planner would pack tasks by their few bytes, but a task's work is their product
FIRST_TERMS = 8  # terms traversed before the first threshold is set
EXACT = 1 << 53  # double arithmetic is exact while sums of products stay below; other pairs are scored with whole numbers
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def usable(vector: Column) -> Column:
    """Whether a vector takes part: it and its components are not null, and all are finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(~bad, F.lit(False))


def _packed(rows: int):
    """Turn (tag, vec_id, vector) rows into blocks of at most so many: a number, tags, ids, and integer components by place."""
    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for low in range(0, batch.num_rows, rows):
                part = batch.slice(low, rows)
                vectors = [np.floor(SCALE * np.asarray(v, np.float64)) for v in part.column(2).to_pylist()]
                width = max(map(len, vectors))
                by_place = np.zeros((width, len(vectors)))
                for i, v in enumerate(vectors):
                    by_place[:len(v), i] = v
                cells = [np.asarray(part.column(k), np.int64).tobytes() for k in (0, 1)] + [by_place.tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([number]), *[pa.array([c], pa.binary()) for c in cells]], names=["number", "tags", "ids", "cells"])
                number += 1

    return run


def max_score(query: np.ndarray, by_place: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and scores of the k best documents of a shard, and all that tie with the k-th.

    low and high are the least and largest product of each term over the shard, order its terms by falling spread.
    Terms are taken in that order (the essential ones) for all documents until what the rest can add, at most the sum
    of their spreads, could not lift a document with the least sum so far above the threshold; the others are probed only for
    documents still competitive. The threshold is the k-th best full score among the documents that lead early.
    """
    spread = high - low
    rest = np.r_[np.cumsum(spread[order][::-1])[::-1], 0.0]  # what terms from here on can add beyond their least
    floor = np.r_[np.cumsum(low[order][::-1])[::-1], 0.0]
    n = by_place.shape[1]
    partial = np.zeros(n)
    alive = np.ones(n, bool)
    if own >= 0:
        alive[own] = False
    threshold, at = -np.inf, 0
    rows = np.flatnonzero(alive)
    while at < len(order):
        upto = min(at + FIRST_TERMS, len(order))
        terms = order[at:upto]
        if len(rows) == n or len(rows) > n // 4:
            partial += query[terms] @ by_place[terms]
        else:
            partial[rows] += query[terms] @ by_place[np.ix_(terms, rows)]
        at = upto
        if len(rows) > k:
            lead = rows[np.argpartition(partial[rows], len(rows) - k)[-k:]]
            full = partial[lead] + query[order[at:]] @ by_place[np.ix_(order[at:], lead)]
            threshold = max(threshold, full.min())
            rows = rows[partial[rows] + floor[at] + rest[at] >= threshold]
    if len(rows) > k:
        rows = rows[partial[rows] >= np.partition(partial[rows], len(rows) - k)[len(rows) - k]]
    return rows, partial[rows]


def _order_of(score: int) -> bytes | None:
    """Bytes that sort like the scores from MOST on, or up to LEAST; none for scores between."""
    if LEAST < score < MOST:
        return None
    n = (abs(score).bit_length() + 7) // 8
    size, value = ((1 << 15) + n, score) if score > 0 else ((1 << 15) - n, score + (1 << 8 * n))
    return size.to_bytes(2) + value.to_bytes(n)


def _search(k: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                q_tags, q_ids, tags, ids = (np.frombuffer(row[c], np.int64) for c in ("q_tags", "q_ids", "tags", "ids"))
                queries = np.frombuffer(row["q_cells"]).reshape(-1, len(q_ids))
                shard = np.frombuffer(row["cells"]).reshape(-1, len(ids))
                width = min(len(queries), len(shard))  # a missing place counts as 0
                queries, shard = queries[:width], shard[:width]
                least, most = (shard.min(axis=1), shard.max(axis=1)) if width else (np.zeros(0), np.zeros(0))
                largest = [np.abs(x).max(axis=0) if width else np.zeros(x.shape[1]) for x in (queries, shard)]
                place = {t: i for i, t in enumerate(tags)}
                out: list[list] = [[], [], [], [], []]
                for j in range(len(q_ids)):
                    q, own = queries[:, j], place.get(q_tags[j], -1)
                    small = np.flatnonzero(~(largest[0][j] * largest[1] * width >= EXACT))
                    if len(small) == shard.shape[1]:
                        part, lo, hi = shard, least, most
                    else:
                        part = shard[:, small]
                        lo, hi = (part.min(axis=1), part.max(axis=1)) if len(small) else (np.zeros(width), np.zeros(width))
                        at = np.searchsorted(small, own)
                        own_small = int(at) if at < len(small) and small[at] == own else -1
                    low, high = np.minimum(q * lo, q * hi), np.maximum(q * lo, q * hi)
                    order = np.argsort(low - high, kind="stable")
                    rows, scores = max_score(q, part, order, low, high, own if part is shard else own_small, k)
                    rows = small[rows]
                    best = np.lexsort((ids[rows], -scores))[:k]
                    rows, scores = rows[best], scores[best].astype(np.int64).tolist()
                    if part is not shard:
                        whole = list(map(int, q.tolist()))
                        large = [r for r in np.setdiff1d(np.arange(shard.shape[1]), small).tolist() if r != own]
                        found = [*zip(scores, rows.tolist()), *((sum(map(mul, whole, map(int, shard[:, r].tolist()))), r) for r in large)]
                        found = sorted(found, key=lambda f: (-f[0], ids[f[1]]))[:k]
                        scores, rows = [f[0] for f in found], np.array([f[1] for f in found], np.int64)
                    for o, v in zip(out, (np.full(len(rows), q_tags[j]), np.full(len(rows), q_ids[j]), ids[rows], [min(max(x, LEAST), MOST) for x in scores], map(_order_of, scores))):
                        o.extend(v)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(o, kind) for o, kind in zip(out, kinds)], names=["tag", "query_id", "vec_id", "score", "beyond"])

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row where `is_query` holds, the k other rows with the largest integer inner product.

    Components are floor(256 x). Products are exact whole numbers of any size, and rank as such; a score outside the range of a long is
    given as the nearest long. Ties go to the smaller id; a query gets all other rows if there are fewer than k. Rows with a null
    id, or whose vector is not usable, take no part. Of two vectors of different length the shorter counts as filled with 0.
    Repeated rows are rows of their own: each may answer the other, and each asks. An empty table gives no rows.

    Rows are packed into shards and queries into blocks, a few thousand and a few hundred rows at most. Every block meets
    every shard once, by an equi-join on groups of shards. Each group gets a copy of all blocks, which the planner does not count in
    their size, so the join is told to sort both sides and broadcasts neither. A task sends on k rows of each query; these are merged per query.
    """
    tagged = durable(vectors.where(F.col(id_col).isNotNull() & usable(F.col(vector_col))).select(
        F.monotonically_increasing_id().alias("tag"), F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks")), "search-vectors")
    schema = "number long, tags binary, ids binary, cells binary"
    shards = durable(tagged.select("tag", "vec_id", "vector").mapInArrow(_packed(SHARD), schema), "search-shards")
    blocks = durable(tagged.where("asks").select("tag", "vec_id", "vector").mapInArrow(_packed(BLOCK), schema), "search-queries")
    held = shards.count()
    groups = max(1, -(-held // GROUP), min(held, 2 * vectors.sparkSession.sparkContext.defaultParallelism))
    dealt = shards.withColumn("group", F.pmod(F.xxhash64("number"), F.lit(groups))).repartition(TASKS * groups, "group").hint("merge")
    asked = blocks.select(*[F.col(c).alias(f"q_{c}") for c in ("tags", "ids", "cells")],
                          F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint"))).alias("group")).repartition(TASKS * groups, "group")
    found = asked.join(dealt, "group").drop("group", "number").mapInArrow(_search(k), "tag long, query_id long, vec_id long, score long, beyond binary")
    best = Window.partitionBy("tag").orderBy(F.desc("score"), F.desc_nulls_last("beyond"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
