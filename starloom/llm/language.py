"""Language by the nearest of several centroids per language, over hashed TF-IDF character n-grams."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.batches import slices, text_slices
from starloom.operators.durable import durable

DIMS = 8192  # n-grams are hashed to so many places
CLUSTERS = 4  # centroids per language at most
SAMPLE = 1000  # labelled texts per language that the model is fitted on, about
MOST_LANGUAGES = 512  # the most frequent labels are learned, of equal ones the first; a model holds at most 512 * 4 centroids of 32 kB
FEWEST = 8  # different texts of a cluster at least; smaller ones are no centroid of their own
LOW = 0.02  # share of a cluster's texts, the farthest ones, that do not count for its gate
SLACK = 0.3  # a text is rejected when nearer to no centroid than SLACK times the farthest of that centroid's other texts
FULL = 200  # different n-grams from which a text can come as near as any; fewer lower its gate by the square root of their share
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
SPACE = 32
#: Which characters below U+0250 are letters; all others count as letters here.
IS_LETTER = np.array([chr(c).isalpha() for c in range(0x250)])


def letters_of(text: str) -> np.ndarray:
    """Code points of the lower-cased text between spaces, each run of other characters than letters one space."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), "<u4")
    codes = np.where(IS_LETTER[np.minimum(codes, 0x24F)] | (codes >= 0x250), codes, SPACE)
    gap = codes == SPACE
    return codes[~gap | np.r_[True, ~gap[:-1]]]


def counts_of(texts: list[str], dims: int = DIMS) -> np.ndarray:
    """Counts of hashed 2- and 3-grams of the texts' letters and word ends, a row per text."""
    codes = [letters_of(t) for t in texts]
    rows = np.repeat(np.arange(len(codes), dtype=np.int64), [len(c) for c in codes])
    c = np.concatenate(codes).astype(np.uint32) if codes else np.zeros(0, np.uint32)
    out = np.zeros(len(texts) * dims, np.int64)
    shift = np.uint32(32 - int(dims).bit_length() + 1)
    pair = c[:-1] * np.uint32(0x9E3779B1) + c[1:] * np.uint32(0x85EBCA77)
    triple = pair[:-1] * np.uint32(0xC2B2AE3D) + c[2:] * np.uint32(0x27D4EB2F)
    for n, hashed in ((1, pair), (2, triple)):
        hashed = (hashed ^ hashed >> np.uint32(15)) * np.uint32(0x2C1B3C6D) >> shift
        whole = rows[:-n] == rows[n:]  # not across two texts
        out += np.bincount(rows[:-n][whole] * dims + hashed[whole], minlength=len(out))
    return out.reshape(len(texts), dims)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of square-root frequencies times idf, of length 1 (0 where empty)."""
    v = np.sqrt(counts.astype(np.float32)) * idf
    size = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.where(size > 0, size, 1)


def clustered(v: np.ndarray, k: int, rounds: int = 8, fewest: int = FEWEST) -> tuple[np.ndarray, np.ndarray]:
    """Up to k unit centroids of different texts by k-means with cosine, and the cosine that all but the share LOW of each one's texts reach.

    k-means++ chooses the starts with a chance that grows with the distance from those before. A cluster of fewer than `fewest` texts is
    given up, the smallest first, and its texts join the nearest other one; the last cluster stays, whatever its size.
    """
    rng = np.random.default_rng(len(v))
    centres = v[[int(rng.integers(len(v)))]]
    while len(centres) < min(k, len(v)):
        apart = np.maximum(1 - (v @ centres.T).max(axis=1), 0) ** 2
        if not apart.any():
            break
        centres = np.concatenate([centres, v[[int(rng.choice(len(v), p=apart / apart.sum()))]]])
    while True:
        for _ in range(rounds):
            of = (v @ centres.T).argmax(axis=1)
            centres = np.stack([v[of == j].sum(axis=0) for j in np.unique(of)])
            centres /= np.linalg.norm(centres, axis=1, keepdims=True)
        cosine = v @ centres.T
        of = cosine.argmax(axis=1)
        size = np.bincount(of, minlength=len(centres))
        if size.min() >= fewest or len(centres) == 1:
            return centres, np.array([np.quantile(cosine[of == j, j], LOW, method="higher") for j in range(len(centres))])
        centres = np.delete(centres, size.argmin(), axis=0)


@dataclass
class Model:
    """Centroids of all languages. Without any, every text is UNKNOWN and only texts without a letter are rejected."""

    idf: np.ndarray
    languages: list[str]  # of each centroid
    centres: np.ndarray
    least: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine in [0, 1], and whether the text is rejected."""
        names, scores, rejected = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        asked = [i for i, t in enumerate(texts) if t and LETTER.search(t)]
        if not self.languages:
            rejected[asked] = False
            return names, scores, rejected
        inside = [texts[i] for i in asked]
        for low, high in slices(inside):
            counts = counts_of(inside[low:high], len(self.idf))
            cosine = weighted(counts, self.idf) @ self.centres.T
            best = cosine.argmax(axis=1)
            value = np.clip(cosine[np.arange(len(best)), best], 0, 1)
            at = asked[low:high]
            scores[at] = value
            rejected[at] = value < SLACK * self.least[best] * np.sqrt(np.minimum((counts > 0).sum(axis=1) / FULL, 1))
            for i, j in zip(at, best):
                names[i] = self.languages[j]
        return names, scores, rejected


def fit(docs: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, dims: int = DIMS,
        clusters: int = CLUSTERS) -> Model:
    """Fit on rows where `usable` holds and text and language are not null.

    Per language about `sample` rows are taken, by a hash of their id and text (all, if there are fewer). They are stored;
    document frequencies are summed by place, and the different texts of each language are clustered in a task of their own.
    With more than MOST_LANGUAGES labels the rarer ones are not learned; their texts are still predicted.
    """
    spark = docs.sparkSession
    rows = docs.where(usable & F.col(lang_col).isNotNull())
    counted = rows.groupBy(F.col(lang_col).alias("lang")).agg(F.count(F.lit(1)).alias("n"))
    sizes = {r["lang"]: r["n"] for r in counted.orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES).collect()}
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, sample / n))).otherwise(share)
    drawn = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.col(text_col), F.lit("lang")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    taken = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), drawn.alias("drawn"))
    taken = durable(taken.where(F.col("text").isNotNull() & (F.col("drawn") < share)).drop("drawn"), "lang-sample")

    def seen(batches):
        total = np.zeros(dims, np.int64)
        for batch in batches:
            texts = [t for t in batch.column(1).to_pylist()]
            for low, high in slices(texts):
                total += (counts_of(texts[low:high], dims) > 0).sum(axis=0)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["place", "n"])

    texts = taken.count()
    found = taken.mapInArrow(seen, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()  # at most `dims` rows
    idf = np.full(dims, np.log(1 + texts), np.float32)
    for r in found:
        idf[r["place"]] = np.log((1 + texts) / (1 + r["n"])) + 0.1
    sent = spark.sparkContext.broadcast(idf)

    def centroids(key, frame):
        texts = sorted(set(frame["text"]))  # rows arrive in any order, and copies are no cluster
        parts = [weighted(counts_of(texts[low:high], dims), sent.value) for low, high in slices(texts)]
        v = np.concatenate(parts)
        v = v[v.any(axis=1)]
        centres, least = clustered(v, clusters) if len(v) else (np.zeros((0, dims), np.float32), np.zeros(0))
        return pd.DataFrame({"lang": key[0], "least": least, "centre": [c.astype("<f4").tobytes() for c in centres]})

    rows = taken.groupBy("lang").applyInPandas(centroids, "lang string, least double, centre binary").collect()  # MOST_LANGUAGES * clusters rows at most
    rows.sort(key=lambda r: (r["lang"], bytes(r["centre"])))
    centres = np.array([np.frombuffer(r["centre"], "<f4") for r in rows], np.float32).reshape(-1, dims)
    return Model(idf, [r["lang"] for r in rows], centres, np.array([r["least"] for r in rows]))


def fold(id_col: str = "doc_id", folds: int = 3) -> Column:
    """crc32 of the id as text modulo `folds`; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, lang_pred, score, rejected. A null text or one without a letter is UNKNOWN with score 0 and rejected.

    A text far from all centroids is rejected too, but its nearest language is given. An empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded, see MOST_LANGUAGES
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType([slim.schema["doc_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("rejected", T.BooleanType())])

    def run(batches):
        for batch in batches:
            for low, texts in text_slices(batch.column(1)):
                names, scores, rejected = sent.value.predict(texts)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, len(texts)), pa.array(names, pa.string()), pa.array(scores), pa.array(rejected)],
                                                 names=schema.names)

    return slim.mapInArrow(run, schema)


def accepted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of docs that are not rejected, with all their columns."""
    sent, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for low, texts in text_slices(batch.column(at)):
                yield batch.slice(low, len(texts)).filter(pa.array(~sent.value.predict(texts)[2]))

    return docs.mapInArrow(run, docs.schema)
