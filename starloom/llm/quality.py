"""Document quality by hierarchical empirical Bayes: a document's own evidence on top of what its path and host suggest."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.batches import text_slices
from starloom.operators.durable import durable

SAMPLE = 20_000  # labelled documents that the classifier is fitted on, about
KEEP = 0.5  # least posterior of a kept document
FEATURES = ["letters", "digits", "marks", "upper", "distinct_words", "top_word", "distinct_lines", "word_length", "long_words", "marked_words", "log_words",
            "log_lines"]
#: Bounds on the prior strength of a level, in documents.
WEAKEST, STRONGEST = 1.0, 1e6


def features_of(text: str | None) -> list[float]:
    """Shares and logarithms that describe a whole text; all 0 for a text without words."""
    words = (text or "").split()
    if not words:
        return [0.0] * len(FEATURES)
    chars = sum(map(len, words))
    letters = sum(map(str.isalpha, text))
    digits = sum(map(str.isdigit, text))
    lines = text.splitlines()
    counts = Counter(words)
    return [letters / chars, digits / chars, max(0, chars - letters - digits) / chars, sum(map(str.isupper, text)) / chars, len(counts) / len(words),
            max(counts.values()) / len(words), len(set(lines)) / len(lines), chars / len(words) / 10, sum(len(w) > 20 for w in counts) / len(counts),
            sum(not w[-1].isalnum() and w[-1] not in ".,;:!?" for w in words) / len(words), math.log1p(len(words)) / 10, math.log1p(len(lines)) / 10]


def described(docs: DataFrame, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, host, path and the features of every document, stored."""
    slim = docs.select(F.col(id_col).alias("doc_id"), host.cast("string").alias("host"), path.cast("string").alias("path"), F.col(text_col).alias("text"))
    schema = T.StructType([slim.schema["doc_id"], T.StructField("host", T.StringType()), T.StructField("path", T.StringType()),
                           *[T.StructField(f, T.DoubleType()) for f in FEATURES]])

    def run(batches):
        for batch in batches:
            values = np.array([features_of(t) for _, texts in text_slices(batch.column(3)) for t in texts]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), *[pa.array(values[:, k].copy()) for k in range(len(FEATURES))]],
                                             names=schema.names)

    return durable(slim.mapInArrow(run, schema), "quality-features")


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Weights (the last one constant) of a ridge logistic regression by Newton steps, features standardised inside."""
    mean, spread = x.mean(axis=0), x.std(axis=0)
    spread = np.where(spread > 1e-9, spread, 1)
    z = np.c_[(x - mean) / spread, np.ones(len(x))]
    w, penalty = np.zeros(z.shape[1]), np.r_[np.full(x.shape[1], ridge), 1e-6]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-9), z.T @ (y - p) - penalty * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    inner = w[:-1] / spread
    return np.r_[inner, w[-1] - inner @ mean]


def fit(rows: DataFrame, labels: DataFrame, usable: Column, sample: int = SAMPLE) -> np.ndarray:
    """Weights fitted on about `sample` labelled documents where `usable` holds (all, if fewer), taken by a hash of the id.

    `labels` has doc_id and quality (0 or 1; null is no label); several labels of a document count by their mean.
    With one class or none, the weights are 0 but for the constant.
    """
    one = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").alias("l_id")).agg(F.avg("quality").alias("quality"))
    known = durable(rows.where(usable).join(one, F.col("doc_id") == F.col("l_id")).select("doc_id", "quality", *FEATURES), "quality-labelled")
    n = known.count()
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    got = known.where(drawn < min(1.0, sample / max(n, 1))).select("quality", *FEATURES).toPandas().to_numpy(dtype=float)  # about `sample` rows
    y = (got[:, 0] >= 0.5).astype(float) if len(got) else np.zeros(0)
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return np.r_[np.zeros(len(FEATURES)), math.log(share / (1 - share))]
    return logistic(got[:, 1:], y)


def _strength(groups: DataFrame, above: Column, parents: int) -> float:
    """How many documents a level's prior is worth: the variance of documents within a group over that of the groups' rates (method of moments).

    `groups` has n, the sum `good` of its documents' probabilities and the sum `squares` of their squares, `above` is the rate that a group is
    shrunk to, of which there are `parents`. Both variances are those seen: the within part from the documents themselves, as
    probabilities vary less than yes and no would, the rest of the groups' spread from what it would explain.
    """
    rate = F.col("good") / F.col("n")
    r = groups.agg(F.count(F.lit(1)).alias("groups"), F.sum("n").alias("n"), F.sum(F.col("squares") - F.col("n") * rate ** 2).alias("within"),
                   F.sum(F.col("n") * (rate - above) ** 2).alias("between"), F.sum(F.col("n") * F.col("n") / F.col("of")).alias("own")).first()
    if not r["groups"] or r["groups"] <= parents or r["n"] <= r["groups"]:  # nothing shows a spread
        return STRONGEST
    within = max(r["within"], 0.0) / (r["n"] - r["groups"])
    between = (r["between"] - within * (r["groups"] - parents)) / (r["n"] - r["own"])
    return float(min(max(within / between if between > 0 else STRONGEST, WEAKEST), STRONGEST))


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def posteriors(rows: DataFrame, weights: np.ndarray) -> DataFrame:
    """One row per document: doc_id, host_rate, path_rate, score.

    Each document's classifier probability counts as so much of a good document for its path. Grouped sums by path, then
    by host, give rates; a host's rate is shrunk toward the global one and a path's toward its host's, each with a
    strength estimated from the data, so sparse sites stay close to what stands above them. The document itself is taken out
    of its site's sums. Posterior odds are its path's odds times the document's likelihood ratio, its classifier
    odds over the global odds. Null hosts and paths are sites of their own.
    """
    evidence = sum((F.col(f) * float(w) for f, w in zip(FEATURES, weights)), F.lit(float(weights[-1])))
    scored = rows.select("doc_id", "host", "path", evidence.alias("evidence")).withColumn("own", 1 / (1 + F.exp(-F.col("evidence"))))
    paths = durable(scored.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"), F.sum("own").alias("good"), F.sum(F.col("own") ** 2).alias("squares")), "quality-paths")
    hosts = durable(paths.groupBy("host").agg(*[F.sum(c).alias(c) for c in ("n", "good", "squares")]), "quality-hosts")
    whole = hosts.agg(F.sum("good"), F.sum("n"), F.count(F.lit(1))).first()
    mean = whole[0] / whole[1] if whole[1] else 0.5
    host_worth = _strength(hosts.withColumn("of", F.lit(whole[1])), F.lit(float(mean)), 1)
    above = hosts.select(F.col("host").alias("a_host"), (F.col("good") / F.col("n")).alias("above"), F.col("n").alias("of"))
    path_worth = _strength(paths.join(above, F.col("host").eqNullSafe(F.col("a_host"))), F.col("above"), whole[2])
    sites = durable(paths.alias("p").join(hosts.alias("h"), F.col("p.host").eqNullSafe(F.col("h.host"))).select(
        F.col("p.host").alias("s_host"), F.col("p.path").alias("s_path"), F.col("p.n").alias("path_n"), F.col("p.good").alias("path_good"),
        F.col("h.n").alias("host_n"), F.col("h.good").alias("host_good")), "quality-sites")  # its measured size decides how it is joined
    met = scored.join(sites, F.col("host").eqNullSafe(F.col("s_host")) & F.col("path").eqNullSafe(F.col("s_path")))
    host_rate = (F.col("host_good") - F.col("own") + host_worth * mean) / (F.col("host_n") - 1 + host_worth)
    path_rate = (F.col("path_good") - F.col("own") + path_worth * F.col("host_rate")) / (F.col("path_n") - 1 + path_worth)
    met = met.withColumn("host_rate", host_rate).withColumn("path_rate", path_rate)
    odds = _logit(F.col("path_rate")) + F.col("evidence") - _logit(F.lit(float(mean)))
    return met.select("doc_id", "host_rate", "path_rate", (1 / (1 + F.exp(-odds))).alias("score"))


def classify(docs: DataFrame, labels: DataFrame, host: Column, path: Column, usable: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, host_rate, path_rate, score and kept (score >= KEEP) of every document; `usable` names those labels may be learned from.

    A null or empty text has features 0. Rows that repeat count as often as they stand there. An empty table gives no rows.
    """
    rows = described(docs, host, path, id_col, text_col)
    return posteriors(rows, fit(rows, labels, usable)).withColumn("kept", F.col("score") >= KEEP)
