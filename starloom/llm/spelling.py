"""Spelling variants: words one edit apart, found by blocked Gram matrices of letter counts.

With x and y the letter counts of two words, |x|^2 + |y|^2 - 2 xy is 1 after one insertion or deletion and 2 after one replacement. Words are
blocked by length and by how many letters of each of a few classes they have: one edit moves at most one letter between classes or to the next
length, so only blocks that near multiply. Every product at most two is verified letter by letter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.tiles import tile_pairs, tiled
from starloom.operators.durable import durable

RUN = "[A-Za-z\\u00C0-\\u00FF]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHORTEST, LEAST = 7, 2  # code points and occurrences of a word
STRONGER = 10  # times as frequent as the word, at least, is its form
DROPPED = 31  # of so many runs of a document, one loses a letter
ORDER = "etaoinshrdlucmfwypvbgkqjxz"  # by frequency; dealt in turn to the classes
TILE_WORDS, TILE_LETTERS = 512, 1 << 20  # of a block, about
FEW = 4_000_000  # words up to which six classes keep blocks full; with more, eight classes skip more pairs
ROUNDS = 6  # forms grow tenfold in n, so a chain has under 20 of them and 2^6 is beyond any


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """(doc_id, run): every maximal run of at least `shortest` Latin letters, with only A-Z lower-cased; a null text has none."""
    found = F.explode(F.regexp_extract_all(F.col(text_col), F.lit(f"{RUN}{{{shortest},}}"), F.lit(0)))
    return docs.select(F.col(id_col).alias("doc_id"), found.alias("run")).select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))


def noisy(run: Column, doc_id: Column) -> Column:
    """The run, or in one of DROPPED cases by the CRC-32 of `<doc_id>:<run>` (null id: nothing before the colon) the run without one of its letters."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.char_length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(h % DROPPED == 0, cut).otherwise(run)


def vocabulary(words: DataFrame, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """(word, n) of a table of word occurrences, counted with partial sums."""
    return words.where(F.char_length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def classes_of(word: Column, classes: int) -> Column:
    """How many of a word's letters are in each class; together its length."""
    letters = ORDER + "".join(map(chr, range(0xC0, 0x100)))
    return F.array(*[F.char_length(F.regexp_replace(word, f"[^{letters[k::classes]}]", "")) for k in range(classes)])


def edits(classes: int) -> list[list[int]]:
    """What one edit adds to class counts, towards the longer word; of a replacement and its reverse only one."""
    unit = np.eye(classes, dtype=int)
    return [[0] * classes, *unit.tolist(), *[(unit[a] - unit[b]).tolist() for a in range(classes) for b in range(a)]]


def counts_of(codes: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Letter counts, a row per word; whole numbers that the float type holds exactly."""
    column = np.full(256, len(letters), np.int64)
    column[letters] = np.arange(len(letters))
    size, width = codes.shape
    flat = np.bincount((np.arange(size)[:, None] * (len(letters) + 1) + column[codes]).ravel(), minlength=size * (len(letters) + 1))
    return flat.reshape(size, -1)[:, :len(letters)].astype(np.float32 if width < 2048 else np.float64)


def near_pairs(one: np.ndarray, other: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of words one edit apart. Rows are words as Latin-1 codes, those of `other` as long or one longer; within one block each pair comes once."""
    letters = np.flatnonzero(np.bincount(one.ravel(), minlength=256) + np.bincount(other.ravel(), minlength=256))
    x, y = counts_of(one, letters), counts_of(other, letters)
    squared = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1) - 2 * (x @ y.T)
    longer = other.shape[1] > one.shape[1]
    i, j = np.nonzero(squared == (1 if longer else 2))
    if same:
        i, j = i[i < j], j[i < j]
    ok = np.zeros(len(i), bool)
    step = max(1, TILE_LETTERS // other.shape[1])
    for at in range(0, len(i), step):
        a, b = one[i[at:at + step]], other[j[at:at + step]]
        if longer:  # common letters from the front and from the back leave one letter of the longer word
            front = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(axis=1)
            back = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
            ok[at:at + step] = front + back >= a.shape[1]
        else:
            ok[at:at + step] = (a != b).sum(axis=1) == 1
    return i[ok], j[ok]


def _best(i: np.ndarray, j: np.ndarray, words: np.ndarray, near: np.ndarray, n: np.ndarray):
    """Per word of i: the word, how many of j, and the most frequent of them, of equal ones the first by code points."""
    order = np.lexsort((near[j], -n[j], i))
    i, j = i[order], j[order]
    at = np.flatnonzero(np.diff(i, prepend=-1))
    return words[i[at]], np.diff(at, append=len(i)), n[j[at]], near[j[at]]


def _neighbours(batches):
    """(word, n_near, form_n, near) of each pair of blocks, the best near word of a word there."""
    for batch in batches:
        found = []
        for k in range(batch.num_rows):
            blocks = []
            for c in (0, 1):
                block = batch.column(c)[k]
                words = block["word"].values.to_pylist()
                codes = np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)
                blocks.append((np.array(words, object), codes, block["n"].values.to_numpy()))
            (u, a, n), (v, b, m) = blocks
            i, j = near_pairs(a, b, batch.column(2)[k].as_py())
            if len(i):
                found += [_best(i, j, u, v, m), _best(j, i, v, u, n)]
        if found:
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[c] for f in found]), t) for c, t in enumerate(kinds)], names=["word", "n_near", "near_n", "near"])


def neighbours(words: DataFrame, classes: int | None = None) -> DataFrame:
    """(word, n_near, near, near_n) for the words of (word, n) that have a near word: how many, and the most frequent of them."""
    classes = classes or (6 if words.count() <= FEW else 8)
    most = F.greatest(F.lit(1), F.least(F.lit(TILE_WORDS), F.lit(TILE_LETTERS) / F.aggregate("key", F.lit(0), lambda a, b: a + b)))
    tiles = tiled(words, classes_of(F.col("word"), classes), most, ["word", "n"])
    pairs = tile_pairs(tiles, edits(classes), ["word", "n"])
    best = pairs.mapInArrow(_neighbours, "word string, n_near bigint, near_n bigint, near string")
    return best.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")).select(
        "word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the links (word, form): each round follows a link as far again as all rounds before it."""
    at = forms.select("word", F.col("form").alias("root"))
    for _ in range(ROUNDS):
        further = at.select(F.col("word").alias("via"), F.col("root").alias("next"))
        at = durable(at.join(further, F.col("root") == F.col("via"), "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")
    return at


def variants(words: DataFrame, stronger: int = STRONGER, classes: int | None = None) -> DataFrame:
    """One row per row of (word, n), whose words are distinct, not empty and of letters up to U+00FF: word, form, root, n, n_near, form_n.

    Two words are near if one inserted, deleted or replaced code point makes one of the other. form is the near word of largest n, of equal ones the
    smallest in code-point order, if its n is at least `stronger` times the word's; else form and form_n are null. root follows forms to the last; it is
    the word itself if it has no form. Letters differ by accent and, but for A-Z, by case. An empty table gives no rows. Words of any length are
    compared whole; longer ones in smaller blocks.
    """
    if stronger < 2:
        raise ValueError("a form must be more frequent than its word, or forms could run in a ring")
    words = durable(words.select("word", "n"), "spelling-words")
    near = durable(neighbours(words, classes), "spelling-near")
    rows = words.join(near.withColumnRenamed("word", "of_word"), F.col("word") == F.col("of_word"), "left")
    known = F.col("near_n") >= F.col("n") * stronger
    rows = durable(rows.select("word", F.when(known, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                               F.when(known, F.col("near_n")).alias("form_n")), "spelling-forms")
    found = roots(rows.where("form IS NOT NULL")).withColumnRenamed("word", "of_word")
    return rows.join(found, F.col("word") == F.col("of_word"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def document_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """variants() of the documents' runs after noisy(). Null and empty texts have no words; repeated rows count again; other columns do not matter."""
    found = runs(docs, id_col, text_col)
    return variants(vocabulary(found.select(noisy(F.col("run"), F.col("doc_id")).alias("word"))))
