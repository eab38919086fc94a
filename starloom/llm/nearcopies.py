"""Near copies by MinHash with tensored tables: a table's key joins one key of each of two small collections.

A document gets KEYS keys (20, or more for a lower threshold; see keys_for) in collection A and KEYS in collection B, each made of ROWS MinHash values. Table (i, j) is
keyed by (A_i, B_j), so 2 * KEYS * ROWS hash functions serve KEYS^2 tables of 2 * ROWS values each. At similarity s a
pair meets in some table with probability (1 - (1 - s^ROWS)^KEYS)^2: 0.99998 with 5 and 20 at 0.85, and with 5 and 30 at 0.8.
Every link is confirmed on the full shingle sets.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.batches import text_slices
from starloom.llm.components import components
from starloom.operators.durable import durable

KEYS, ROWS = 20, 5  # KEYS at PERCENT
WIDTH = 3  # words of a shingle, if not given
PERCENT = 85  # least similarity of a link, if not given
BIT_WORDS, PLANES = 3, 3  # 3 bits of each of 64 * 3 MinHash values, plane by plane, for a first comparison
LONG_WORDS, LONG_PLANES = 16, 2  # the second comparison: 2 bits of each of 64 * 16 further values, for the few nodes that get so far
LOST = 4e-10  # share of the links at exactly the threshold that each of the two comparisons may lose
MEMBERS = 128  # documents compared with one hub in one group
BLOCK = 256  # nodes of one bucket that meet another block of it in one group


def keys_for(percent: int) -> int:
    """Keys of a collection with which a pair at the threshold meets as surely as with KEYS at PERCENT."""
    missed = (1 - (PERCENT / 100) ** ROWS) ** KEYS
    return max(KEYS, math.ceil(math.log(missed) / math.log1p(-((percent / 100) ** ROWS)))) if percent < 100 else KEYS


def most_differing(values: int, planes: int, percent: int) -> int:
    """Most of so many values that differ in some of their bits, of a pair that is compared in full.

    At similarity s a value's bits differ with probability (1 - s) * (1 - 2^-planes). The limit is the least one that a pair at the threshold
    exceeds with a probability of at most LOST, by the binomial distribution; more similar pairs exceed it less often.
    """
    p = (1 - percent / 100) * (1 - 0.5 ** planes)
    tail = 0.0
    for k in range(values, 0, -1):
        tail += math.exp(math.lgamma(values + 1) - math.lgamma(k + 1) - math.lgamma(values - k + 1) + k * math.log(p) + (values - k) * math.log1p(-p)) if p else 0.0
        if tail > LOST:
            return k
    return 0


MOST_KEYS = 64  # of a collection, which serves thresholds from 0.7 on
_rng = np.random.default_rng(20240501)
_MULT = _rng.integers(1, 1 << 32, 2 * KEYS * ROWS, dtype=np.uint32) | np.uint32(1)
_XOR = _rng.integers(0, 1 << 32, 2 * KEYS * ROWS, dtype=np.uint32)
_LONG_MULT = _rng.integers(1, 1 << 32, 64 * LONG_WORDS, dtype=np.uint32) | np.uint32(1)
_LONG_XOR = _rng.integers(0, 1 << 32, 64 * LONG_WORDS, dtype=np.uint32)
_JOIN = _rng.integers(1, 1 << 63, (2 * KEYS, ROWS), dtype=np.uint64) | np.uint64(1)
_PLACE = _rng.integers(1, 1 << 63, WIDTH, dtype=np.uint64) | np.uint64(1)
_SHORT = _rng.integers(1, 1 << 63, WIDTH + 1, dtype=np.uint64)
MOST_WIDTH = 16
_more = np.random.default_rng(20240502)  # for further keys and wider shingles
_MULT = np.r_[_MULT, _more.integers(1, 1 << 32, 2 * (MOST_KEYS - KEYS) * ROWS, dtype=np.uint32) | np.uint32(1)]
_XOR = np.r_[_XOR, _more.integers(0, 1 << 32, 2 * (MOST_KEYS - KEYS) * ROWS, dtype=np.uint32)]
_JOIN = np.r_[_JOIN, _more.integers(1, 1 << 63, (2 * (MOST_KEYS - KEYS), ROWS), dtype=np.uint64) | np.uint64(1)]
_PLACE = np.r_[_PLACE, _more.integers(1, 1 << 63, MOST_WIDTH - WIDTH, dtype=np.uint64) | np.uint64(1)]
_SHORT = np.r_[_SHORT, _more.integers(1, 1 << 63, MOST_WIDTH - WIDTH, dtype=np.uint64)]


def _mixed(x: np.ndarray, by: int = 0xBF58476D1CE4E5B9) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(by)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; of its whole word sequence if that is shorter than one."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # both only for ASCII
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(w) == 0:
        return w
    width = min(width, len(w))
    total = np.zeros(len(w) - width + 1, np.uint64)
    for k in range(width):
        total += w[k:len(w) - width + 1 + k] * _PLACE[k]
    return np.unique(_mixed(total + _SHORT[width]))


def name_of(hashes: np.ndarray) -> bytes:
    """128 bits that stand for a (non-empty) set of shingles."""
    return np.array([_mixed(hashes).sum(), _mixed(hashes, 0xD6E8FEB86659FD93).sum()], np.uint64).tobytes()


def minima(sets: list[np.ndarray], mult: np.ndarray, xor: np.ndarray) -> np.ndarray:
    """The MinHash values of each (non-empty) set, a row per set."""
    out = np.empty((len(sets), len(mult)), np.uint32)
    for i, s in enumerate(sets):
        x = (s >> np.uint64(32)).astype(np.uint32)
        low = np.full(len(mult), 0xFFFFFFFF, np.uint32)
        for at in range(0, len(x), 128):
            h = (x[at:at + 128, None] ^ xor) * mult
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x2C1B3C6D)
            np.minimum(low, h.min(axis=0), out=low)
        out[i] = low
    return out


def planes_of(values: np.ndarray, planes: int) -> np.ndarray:
    """So many bits of each value of a row, all first bits in 64-bit numbers, then all second bits, and so on."""
    mixed = values * np.uint32(0x9E3779B1)
    return np.concatenate([np.packbits((mixed >> np.uint32(31 - p) & np.uint32(1)).astype(np.uint8), axis=1).view(np.int64) for p in range(planes)], axis=1)


def _lengthened(batches):
    """The long sketch of (node, common, hashes) rows."""
    for batch in batches:
        for low in range(0, batch.num_rows, 64):
            part = batch.slice(low, 64)
            sets = [np.asarray(h, np.int64).view(np.uint64) for h in part.column(2).to_pylist()]
            words = planes_of(minima(sets, _LONG_MULT, _LONG_XOR), LONG_PLANES)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *[pa.array(words[:, k].copy()) for k in range(len(LONG))]], names=["node", "common", *LONG])


def _sketch(width: int, keys: int):
    """Size, name, keys and bits of (doc_id, text) rows."""
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for low, texts in text_slices(batch.column(1)):
                sets = [shingles(t, width) for t in texts]
                size = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(size)
                found, bits, names = np.zeros((len(sets), 2 * keys), np.int64), np.zeros((len(sets), len(BITS)), np.int64), [b""] * len(sets)
                if len(full):
                    least = minima([sets[i] for i in full], _MULT[:2 * keys * ROWS], _XOR[:2 * keys * ROWS])
                    joined = (least.reshape(len(full), 2 * keys, ROWS).astype(np.uint64) * _JOIN[:2 * keys]).sum(axis=2) + np.arange(2 * keys, dtype=np.uint64)
                    found[full] = _mixed(joined).view(np.int64)
                    bits[full] = planes_of(least[:, :64 * BIT_WORDS], PLANES)
                for i in full:
                    names[i] = name_of(sets[i])
                a, b = (pa.FixedSizeListArray.from_arrays(pa.array(np.ascontiguousarray(k).ravel()), keys).cast(pa.list_(pa.int64())) for k in (found[:, :keys], found[:, keys:]))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(low, len(texts)), pa.array(size), pa.array(names, pa.binary()), a, b, *[pa.array(bits[:, k].copy()) for k in range(len(BITS))]],
                    names=["doc_id", "n", "name", "a", "b", *BITS])

    return run


BITS = [f"bits{k}" for k in range(PLANES * BIT_WORDS)]


LONG = [f"long{k}" for k in range(LONG_PLANES * LONG_WORDS)]


def _differing(x: str, y: str, columns: list[str], words: int) -> Column:
    """How many values of two rows' sketches differ in some bit."""
    xor = [F.col(f"{x}.{b}").bitwiseXOR(F.col(f"{y}.{b}")) for b in columns]
    return sum((F.bit_count(reduce(Column.bitwiseOR, xor[k::words])) for k in range(words)), F.lit(0))


def _alike(x: str, y: str, percent: int) -> Column:
    """Whether two rows' sizes allow a link and their bits suggest one."""
    sizes = (F.least(f"{x}.n", f"{y}.n") * 100 >= F.greatest(f"{x}.n", f"{y}.n") * percent)
    return sizes & (_differing(x, y, BITS, BIT_WORDS) <= most_differing(64 * BIT_WORDS, PLANES, percent))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (hub, node) whose full sets are similar enough. A hub's set travels once for MEMBERS of its pairs."""
    groups = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("groups"))
    one = pairs.join(groups, "hub").withColumn("part", F.pmod(F.xxhash64("node"), F.col("groups")).cast("int"))
    members = one.join(sets, "node").select("hub", "part", "node", "hashes")
    hubs = groups.select(F.col("hub").alias("h_hub"), F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("h_part")).join(
        sets.select(F.col("node").alias("h_hub"), F.col("hashes").alias("h_hashes")), "h_hub").select("h_hub", "h_part", "h_hashes")

    def check(left, right):
        if not len(left) or not len(right):
            return pd.DataFrame({"u": pd.Series(dtype="int64"), "v": pd.Series(dtype="int64")})
        own = right["h_hashes"].iloc[0]
        linked = []
        for other in left["hashes"]:
            at = np.searchsorted(own, other)
            both = int((own[np.minimum(at, len(own) - 1)] == other).sum())
            linked.append(100 * both >= percent * (len(own) + len(other) - both))
        found = left[linked]
        return pd.DataFrame({"u": found["hub"], "v": found["node"]})

    kind = pairs.schema["node"].dataType.simpleString()
    return members.groupBy("hub", "part").cogroup(hubs.groupBy("h_hub", "h_part")).applyInPandas(check, f"u {kind}, v {kind}").distinct()


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Two documents are linked if their sets of shingles of `width` words have a similarity of percent / 100 or more. component_id is the
    smallest id reachable over links; the row with that id is kept. A text without words has no shingles, is linked with
    nothing and is its own component. A row with a null id takes no part: its component is null and it is kept. Rows with
    equal sets are one node, so copies are never paired, nor are repeats of a row. Rows with one id and different sets are
    nodes of their own: each has its own links, and they are not linked by their id. An empty table gives no rows.

    1. A node that shares no A key with another is in no table with it. The others are dealt to the tables by the combined keys (A_i, B_j).
       In each table the node whose A keys met most often is the hub; pairs of hub and other nodes are confirmed, and linked nodes form preliminary components.
    2. Only nodes in A buckets that still hold several components go on. Shingles that no other node of any bucket holds are counted:
       they are in no intersection, which bounds a node's similarity to any other, and rules out most pairs of copies with
       edits of their own, however large their group. What is left meets by A_i, block by block of a bucket, and B is tested within:
       so a pair is taken up once, not in each table that it shares. Pairs of different
       components that no earlier step compared are confirmed. Of the filters before a confirmation,
       set sizes and own shingles are exact bounds; the two sketches lose a linked pair with a probability below 1e-9 together.
       The tables themselves miss one at the threshold in about 1 of 60,000 cases. Nothing caps buckets or partners.
    """
    return _resolved(docs, id_col, text_col, width, percent).drop("name")


def _resolved(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """near_copies with the name of each row's set."""
    keys = keys_for(percent)
    if not (1 <= width <= MOST_WIDTH and percent <= 100 and keys <= MOST_KEYS):
        raise ValueError("shingles or threshold out of range")
    kind = docs.schema[id_col].dataType
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("n", T.LongType()), T.StructField("name", T.BinaryType()),
                           T.StructField("a", T.ArrayType(T.LongType())), T.StructField("b", T.ArrayType(T.LongType())),
                           *[T.StructField(b, T.LongType()) for b in BITS]])
    sketched = durable(slim.mapInArrow(_sketch(width, keys), schema).withColumn("row", F.monotonically_increasing_id()), "near-sketch")
    usable = sketched.where("n > 0 AND doc_id IS NOT NULL")
    # a node is a set, whatever the ids of its rows: the number of the first of its rows, and the smallest of their ids
    classes = durable(usable.groupBy("name").agg(F.min("row").alias("node"), F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("copies")), "near-classes")
    nodes = durable(usable.select("row", "a").join(classes.select("node"), F.col("row") == F.col("node")).select("node", "a"), "near-nodes")

    rows = nodes.select("node", F.explode("a").alias("a_key"))
    shared = durable(rows.groupBy("a_key").agg(F.count(F.lit(1)).alias("met")).where("met > 1"), "near-shared")
    own = rows.join(shared, "a_key").groupBy("node").agg(F.sum("met").alias("meetings"), F.collect_list("a_key").alias("a_shared"))  # of a node's own keys
    met = durable(usable.select("row", "n", *BITS, "a", "b").join(own, F.col("row") == F.col("node")).drop("row"), "near-met")
    wanted = classes.join(met.select("node"), "node").select("node", "name", "least_id", (F.col("copies") > 1).alias("repeated")).hint("shuffle_hash")
    read = durable(slim.join(wanted, F.col("doc_id") == F.col("least_id")).select("node", "text", "name", "repeated").mapInArrow(_hashes(width), T.StructType(
        [T.StructField("node", T.LongType()), T.StructField("hashes", T.ArrayType(T.LongType())), T.StructField("repeated", T.BooleanType())])), "near-read")
    once = durable(read.where("repeated").select("node", "hashes").dropDuplicates(["node"]), "near-once")  # rows may repeat with their ids
    sets = read.where("NOT repeated").select("node", "hashes").unionByName(once)

    # table (i, j) is keyed by A_i and B_j; a key that holds i and a key that holds j are hashed to one
    placed = met.select("node", "meetings", "b", F.explode("a_shared").alias("a_key")).select("node", "meetings", "a_key", F.explode("b").alias("b_key")).select(
        F.xxhash64("a_key", "b_key").alias("table"), "node", "meetings")  # KEYS^2 rows of a row that the planner counts, so no side to broadcast
    hubs = durable(placed.groupBy("table").agg(F.max(F.struct("meetings", "node")).alias("h"), F.count(F.lit(1)).alias("held")).where("held > 1").select(
        "table", F.col("h.node").alias("hub")), "near-hubs")
    pairs = placed.hint("merge").join(hubs, "table").where("node <> hub").select("hub", "node").distinct()
    traits = met.select("node", "n", *BITS)
    named = traits.select(*[F.col(c).alias(f"h_{c}") for c in traits.columns])
    known = durable(pairs.join(traits, "node").join(named, F.col("hub") == F.col("h_node")).select(
        F.struct("n", *BITS).alias("x"), F.struct(F.col("h_n").alias("n"), *[F.col(f"h_{b}").alias(b) for b in BITS]).alias("y"), "hub", "node").where(
        _alike("x", "y", percent)).select("hub", "node"), "near-pairs")
    links = durable(_confirmed(known, sets, percent), "near-links")
    joined = components(links)

    marked = durable(met.join(joined, "node", "left").select("node", "n", F.coalesce("component", "node").alias("component"), "a_shared"), "near-marked")
    mixed = durable(_several(marked.select("node", "n", "component", F.explode("a_shared").alias("a_key")), "a_key"), "near-mixed")
    able = _held_by_others(mixed.select("node", "n").distinct(), read).where(F.col("common") * 100 >= F.col("n") * percent).select("node", "common")
    able = durable(able.join(sets, "node").select("node", "common", "hashes").mapInArrow(_lengthened, T.StructType(
        [T.StructField("node", T.LongType()), T.StructField("common", T.LongType()), *[T.StructField(c, T.LongType()) for c in LONG]])).dropDuplicates(["node"]), "near-able")
    left = durable(_several(mixed.join(able.select("node"), "node"), "a_key"), "near-left")
    sizes = durable(left.groupBy("a_key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")), "near-blocks")
    dealt = left.join(sizes, "a_key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    full = durable(dealt.join(met.select("node", *BITS, "a", "b"), "node").join(able, "node"), "near-full")
    # every two blocks of a bucket meet in a task of their own; the planner sees neither how often a row is repeated nor how well repeats were stored, so no side to broadcast
    low = full.withColumn("low", F.col("block")).withColumn("high", F.explode(F.sequence("block", F.col("blocks") - 1)))
    high = full.withColumn("high", F.col("block")).withColumn("low", F.explode(F.sequence(F.lit(0), F.col("block"))))
    apart = (F.col("x.component") < F.col("y.component")) | ((F.col("x.low") < F.col("x.high")) & (F.col("x.component") > F.col("y.component")))
    most = F.least("x.common", "y.common")  # of shingles that both can have
    # a pair is taken up under the least A key that it shares, so once, and only if B keys agree too
    first_shared = F.col("x.a_key") == F.array_min(F.array_intersect("x.a", "y.a"))
    same = (F.col("x.a_key") == F.col("y.a_key")) & (F.col("x.low") == F.col("y.low")) & (F.col("x.high") == F.col("y.high"))
    second = low.hint("merge").alias("x").join(high.alias("y"), same & apart & (most * 100 >= (F.col("x.n") + F.col("y.n") - most) * percent) & _alike("x", "y", percent)
        & (_differing("x", "y", LONG, LONG_WORDS) <= most_differing(64 * LONG_WORDS, LONG_PLANES, percent)) & F.arrays_overlap("x.b", "y.b") & first_shared).select(
        F.col("x.node").alias("hub"), F.col("y.node").alias("node"))
    known = known.unionByName(known.select(F.col("node").alias("hub"), F.col("hub").alias("node")))
    more = durable(_confirmed(durable(second.join(known, ["hub", "node"], "left_anti"), "near-pairs-2"), sets, percent), "near-links-2")
    if not more.isEmpty():
        joined = components(links.unionByName(more))

    linked = classes.join(joined, "node").select("node", "component", "least_id")
    # stored, so that a component with very many nodes can be split in the join
    least = durable(linked.groupBy("component").agg(F.min("least_id").alias("component_id")), "near-least")
    linked = linked.join(least, "component").select("node", "component_id")
    moved = classes.join(linked, "node", "left").select("name", F.coalesce("component_id", "least_id").alias("component"), "copies", "least_id").where(
        (F.col("copies") > 1) | (F.col("component") != F.col("least_id"))).select(F.col("name").alias("m_name"), "component")
    done = sketched.select("doc_id", "n", "name").join(moved, (F.col("name") == F.col("m_name")) & (F.col("n") > 0) & F.col("doc_id").isNotNull(), "left")
    component = F.coalesce("component", "doc_id")
    return done.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                       F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"), "name")


def _hashes(width: int):
    """Sorted hashes, as signed numbers, of the shingles of those (node, text, name, repeated) rows whose text has the set of that name."""
    def run(batches):
        for batch in batches:
            for low, texts in text_slices(batch.column(1)):
                part = batch.slice(low, len(texts))
                sets = [shingles(t, width) for t in texts]
                own = [len(s) > 0 and name_of(s) == name for s, name in zip(sets, part.column(2).to_pylist())]
                found = [np.sort(s.view(np.int64)) for s, o in zip(sets, own) if o]
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                values = np.concatenate(found) if found else np.zeros(0, np.int64)
                node, repeated = (part.column(k).filter(pa.array(own, pa.bool_())) for k in (0, 3))
                yield pa.RecordBatch.from_arrays([node, pa.ListArray.from_arrays(pa.array(ends), pa.array(values)), repeated], names=["node", "hashes", "repeated"])

    return run


def _held_by_others(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """Add `common`, the number of a node's shingles that another node with a set holds too; a node's set may be there several times."""
    held = sets.select("node", F.explode("hashes").alias("hash")).groupBy("hash").agg(F.min("node").alias("node"), F.max("node").alias("last"))
    own = held.where("node = last").groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    return nodes.join(own, "node", "left").withColumn("common", F.col("n") - F.coalesce("own", F.lit(0)))


def _several(rows: DataFrame, key: str) -> DataFrame:
    """The rows whose key occurs with more than one component. The keys are stored, so that a hot one can be split in the join."""
    ends = rows.groupBy(key).agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select(key)
    return rows.join(durable(ends, "near-several"), key, "left_semi")


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows of docs that stay, with all their columns: of each component the document with the smallest id."""
    found = durable(_resolved(docs, id_col, text_col, width, percent).where("doc_id IS NOT NULL").select("doc_id", "name", "kept"), "near-found")
    ids = durable(found.groupBy("doc_id").agg(F.max("kept").alias("some"), F.min("kept").alias("every")).where("NOT every").select(
        F.col("doc_id").alias("gone_id"), "some"), "near-gone")
    packed = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("row_id"))
    stay = packed.join(ids.select("gone_id").hint("shuffle_hash"), F.col("row_id") == F.col("gone_id"), "left_anti").select("row.*")
    partly = ids.where("some").select("gone_id")
    if partly.isEmpty():
        return stay
    # ids with several texts, of which some stay
    gone = found.where("NOT kept").join(partly, F.col("doc_id") == F.col("gone_id"), "left_semi").select("doc_id", F.col("name").alias("gone_name")).distinct()
    mixed = packed.join(partly, F.col("row_id") == F.col("gone_id"), "left_semi").withColumn("text", F.col("row").getField(text_col))
    schema = T.StructType([*mixed.schema.fields, T.StructField("name", T.BinaryType())])
    kept = mixed.mapInArrow(_named(width), schema).join(gone, (F.col("row_id") == F.col("doc_id")) & (F.col("name") == F.col("gone_name")), "left_anti")
    return stay.unionByName(kept.select("row.*"))


def _named(width: int):
    """Add to (row, row_id, text) rows the name of the text's set, empty if it has no words."""
    def run(batches):
        for batch in batches:
            for low, texts in text_slices(batch.column(2)):
                sets = [shingles(t, width) for t in texts]
                names = pa.array([name_of(x) if len(x) else b"" for x in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.slice(low, len(texts)).columns, names], names=["row", "row_id", "text", "name"])

    return run
