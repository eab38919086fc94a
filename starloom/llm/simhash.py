"""Near copies by SimHash: all fingerprints are compared, tile by tile, with exclusive-or and bit counts.

Fingerprints are grouped by the population counts of their equal parts. Each part's counts differ by no more than its bits do, so two
tiles can hold a link only if their counts differ by `radius` at most, added up over the parts; all other pairs of tiles are skipped.
The comparison is exact: every link is found.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.batches import text_slices
from starloom.llm.components import components
from starloom.llm.tiles import steps, tile_pairs, tiled
from starloom.operators.durable import durable

WIDTH, RADIUS = 3, 2
SEED = 42
TILE = 1024  # fingerprints of a tile, about
ROWS = 128  # of a tile that are compared at once
FEW = 1 << 24  # fingerprints up to which four parts keep tiles full; with more, eight parts skip more pairs
CHUNK = 1 << 15  # shingles whose bits are counted at once


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """The 64-bit fingerprint, unsigned: a bit is set where more than half of the shingles' hashes have it; repeated shingles count again."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # both only for ASCII
    if not words:
        return 0
    width = min(width, len(words))
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    first = np.concatenate([[0], ends[:-1] + 1])[:len(words) - width + 1].tolist()
    last = ends[width - 1:].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, len(first), CHUNK):
        part = slice(at, at + CHUNK)
        h = np.fromiter(map(xxhash.xxh64_intdigest, (line[a:b] for a, b in zip(first[part], last[part])), repeat(SEED)), ">u8", len(first[part]))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(first)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """One row per input row: doc_id, bits (the fingerprint as a signed number). One narrow pass over whole texts."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("bits", T.LongType())])

    def run(batches):
        for batch in batches:
            for low, texts in text_slices(batch.column(1)):
                bits = np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, len(texts)), pa.array(bits)], names=["doc_id", "bits"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def part_counts(bits: Column, parts: int) -> Column:
    """The population count of each of the equal parts of 64 bits."""
    width = 64 // parts
    return F.array(*[F.bit_count(F.shiftrightunsigned(bits, k * width).bitwiseAND(F.lit((1 << width) - 1))).cast("int") for k in range(parts)])


def links_of(one: np.ndarray, other: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (u, v) that connect what the links between two tiles connect: one per fingerprint at most, not one per pair."""
    values, place = np.unique(np.concatenate([one, other]), return_inverse=True)
    left, right = place[:len(one)], place[len(one):]
    label = np.arange(len(values))
    a, b = one.view(np.uint64), other.view(np.uint64)
    hits = []
    for at in range(0, len(a), ROWS):
        i, j = np.nonzero(np.bitwise_count(a[at:at + ROWS, None] ^ b) <= radius)
        u, v = left[i + at], right[j]
        hits.append((u[u != v].astype(np.int32), v[u != v].astype(np.int32)))
    u, v = (np.concatenate([h[k] for h in hits]) for k in (0, 1))
    while len(u):  # the least label spreads over the links, and on along its own chain
        before = label.copy()
        np.minimum.at(label, u, label[v])
        np.minimum.at(label, v, label[u])
        label = label[label]
        if np.array_equal(before, label):
            break
    moved = np.flatnonzero(label != np.arange(len(values)))
    return values[moved], values[label[moved]]


def _links(radius: int):
    def run(batches):
        for batch in batches:
            found = []
            for k in range(batch.num_rows):
                one, other = (batch.column(c)[k]["bits"].values.to_numpy() for c in (0, 1))
                found.append(links_of(one, other, radius))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[c] for f in found])) for c in (0, 1)], names=["u", "v"])

    return run


def linked(values: DataFrame, radius: int = RADIUS, parts: int | None = None) -> DataFrame:
    """(node, component) for the distinct fingerprints `bits` that have a link; component is the smallest reachable as a signed number."""
    parts = parts or (4 if values.count() <= FEW else 8)
    tiles = tiled(values, part_counts(F.col("bits"), parts), F.lit(TILE), ["bits"])
    pairs = tile_pairs(tiles, steps(parts, radius), ["bits"])
    return components(durable(pairs.mapInArrow(_links(radius), "u bigint, v bigint").distinct(), "simhash-links"))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """One row per input row: doc_id, bits (fingerprint, signed), component_id, kept.

    Rows whose fingerprints differ in at most `radius` bits are linked; component_id is the smallest doc_id reachable over links, and the row
    with that id is kept. A text with fewer words than a shingle is one shingle; a null, empty or wordless one has fingerprint 0 and is linked
    like any other. Rows with one fingerprint are one node, so copies and repeated rows are never paired; rows that share an id keep
    their own fingerprints. A row with a null id links others, but gives no id: its component_id is the smallest id it reaches, null if there
    is none, and it is kept only then. Other columns are left out. An empty table gives no rows.
    """
    rows = durable(fingerprints(docs, id_col, text_col, width), "simhash-rows")
    nodes = durable(rows.groupBy("bits").agg(F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("copies")), "simhash-nodes")
    joined = linked(nodes.select("bits"), radius)
    met = nodes.join(joined, F.col("bits") == F.col("node"))
    least = met.groupBy("component").agg(F.min("least_id").alias("component_id"))
    found = met.join(least, "component").select("bits", "component_id")
    alone = nodes.join(found.select("bits"), "bits", "left_anti").where("copies > 1").select("bits", F.col("least_id").alias("component_id"))
    moved = found.unionByName(alone).select(F.col("bits").alias("m_bits"), "component_id", F.lit(True).alias("moved"))
    out = rows.join(moved, F.col("bits") == F.col("m_bits"), "left")
    component = F.when(F.col("moved"), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "bits", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))
