"""Fill-in-the-middle rewriting of documents, with cuts found in an indexable skip list.

A text's units are its runs of ASCII letters and its other code points, one by one. Lane 0 of the skip list links all units,
every higher lane about a quarter of those below. Each link of a lane carries its width in units and in code points, so a descent
that adds up widths reaches any unit's place, by rank, in a number of steps that grows with the logarithm of the text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.batches import text_slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM = 90  # of 100: draws from here on leave a text plain
SPM_BELOW = 20  # of 100: draws below put the suffix first
SEED = 1
TOP = 8  # links of the highest lane, at most


class SkipList:
    """The units of one text. Lane k holds the widths of its links in units and in code points, and where each link's unit stands in the lane below."""

    def __init__(self, text: str):
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        letter = ((code | np.uint32(32)) - np.uint32(97)) < 26
        within = np.zeros(len(code), bool)
        np.logical_and(letter[1:], letter[:-1], out=within[1:])  # not the first letter of its run
        place = np.flatnonzero(~within).astype(np.int32 if len(code) < 2**31 else np.int64)
        self.n, self.chars = len(place), len(code)
        self.lanes: list[tuple[np.ndarray, np.ndarray, np.ndarray | None]] = []
        rank, down = np.arange(self.n, dtype=place.dtype), None
        while self.n:
            self.lanes.append((np.diff(rank, append=rank.dtype.type(self.n)), np.diff(place, append=place.dtype.type(self.chars)), down))
            if len(rank) <= TOP:
                break
            coin = (rank.astype(np.uint64) + np.uint64(len(self.lanes) << 40)) * np.uint64(0x9E3779B97F4A7C15)
            coin = (coin ^ coin >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(62)
            coin[0] = 0  # the first unit is in every lane
            down = np.flatnonzero(coin == 0)
            rank, place = rank[down], place[down]

    def place(self, rank: int) -> int:
        """The code point at which unit `rank` starts; the length of the text for rank n."""
        units = chars = at = 0
        for lane in range(len(self.lanes) - 1, -1, -1):
            wide, long, down = self.lanes[lane]
            while at < len(wide) and units + wide[at] <= rank:
                units += int(wide[at])
                chars += int(long[at])
                at += 1
            if down is not None:
                at = int(down[at]) if at < len(down) else len(self.lanes[lane - 1][0])
        return chars


def draws(doc_id, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four 32-bit numbers that depend on the seed and the id alone."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[k:k + 8], 16) for k in (0, 8, 16, 24))


def rewritten(text: str, doc_id, seed: int = SEED) -> tuple[int, str, int | None, int | None, str]:
    """n, form, code points of prefix and middle (None if plain), output."""
    units = SkipList(text)
    first, second, plain, order = draws(doc_id, seed)
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or plain % 100 >= PLAIN_FROM:
        return units.n, "plain", None, None, text
    low, high = sorted((first % (units.n + 1), second % (units.n + 1)))
    low, high = units.place(low), units.place(high)
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if order % 100 < SPM_BELOW:
        return units.n, "spm", low, high - low, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return units.n, "psm", low, high - low, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """One row per input row: doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars (code points), output.

    Both cuts fall on units drawn from a hash of seed and id, so rows with one id are cut at the same draws and reruns agree; a null
    id draws like an empty one. A text stays plain if it is empty or null (then the output is empty), if it already holds one of the three
    marks, or by its draw; its prefix_chars and middle_chars are null. Prefix, middle or suffix may be empty. Other columns are left out,
    whatever their names. An empty table gives no rows. One narrow pass; a task holds one text's lanes at a time.
    """
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
                           T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())])

    def run(batches):
        for batch in batches:
            for low, texts in text_slices(batch.column(1)):
                ids = batch.column(0).slice(low, len(texts))
                columns = list(zip(*(rewritten(t, i, seed) for t, i in zip(texts, ids.to_pylist()))))
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, k) for c, k in zip(columns, kinds))], names=schema.names)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def restored(output: Column | str, form: Column | str) -> Column:
    """The text that fill_in_middle rewrote. Only the three marks are searched: neither a text that holds one nor a cut makes another."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    part = [F.get(F.split(output, "<[PSM]>", -1), F.lit(k)) for k in range(4)]
    return F.when(form == "psm", F.concat(part[1], part[3], part[2])).when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output)
