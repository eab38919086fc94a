"""Exact duplicates: frequent digests are settled map-side, the others by an ordinary shuffle. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators.durable import durable

TRACKED = 16_384  # counters of a Misra-Gries summary: a digest with more than 3.5 / TRACKED of all rows is always found
WINNERS = 4_096  # frequent digests broadcast at most: about 100 bytes each
SUMMARIES = 256  # summaries are merged in two levels, so that no single task merges one from every scan task


def digest_of(text: Column) -> Column:
    """SHA-256 of the UTF-8 bytes; a null text counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def frequent_digests(slim: DataFrame, tracked: int = TRACKED, most: int = WINNERS) -> DataFrame:
    """Candidates for frequent digests, at most `most` rows, from merged Misra-Gries summaries."""
    most = min(most, tracked)
    item = F.hex("digest").alias("item")
    task = F.shiftright("tag", 33)
    summaries = slim.select(item, F.pmod(task, F.lit(SUMMARIES)).alias("part")).groupBy("part").agg(
        F.expr(f"approx_top_k_accumulate(item, {tracked})").alias("summary"))
    # grouped by a constant: merging without a key fails on empty partitions, whose summaries know no item type
    top = summaries.groupBy((F.col("part") * 0).alias("all")).agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(summary, {tracked}), {most})").alias("top"))
    return top.select(F.inline("top")).where("count > 1").select(F.unhex("item").alias("digest"))


def resolve(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tracked: int = TRACKED) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, digest.

    Of equal texts the row with the largest id stays. A null id is smaller than any other; among rows
    that agree in id and text exactly one stays. A null text equals an empty one. No rows give no rows.
    Other columns are not read.

    Rows are tagged and stored once, so every later pass sees the same tags. The summaries name frequent
    digests; their exact counts and winners (a grouped aggregate, combined map-side) are broadcast, at
    most WINNERS rows, and settle their rows without a shuffle. What is left has at most about
    3.5 / tracked of all rows per digest and is settled in a window over the digest.
    """
    slim = durable(docs.select(F.col(id_col).alias("doc_id"), digest_of(F.col(text_col)).alias("digest"),
                               F.monotonically_increasing_id().alias("tag")), "exact-digests")
    me = F.struct("doc_id", "tag")
    candidates = durable(frequent_digests(slim, tracked), "exact-candidates")
    winners = durable(
        slim.join(F.broadcast(candidates), "digest").groupBy("digest").agg(F.max(me).alias("top"), F.count(F.lit(1)).alias("n")),
        "exact-winners")
    split = slim.join(F.broadcast(winners), "digest", "left")
    frequent = split.where(F.col("n").isNotNull())
    same = Window.partitionBy("digest")
    rest = split.where(F.col("n").isNull()).select(
        "doc_id", "digest", "tag", F.max(me).over(same).alias("top"), F.count(F.lit(1)).over(same).alias("n"))
    both = frequent.select("doc_id", "digest", "tag", "top", "n").unionByName(rest)
    return both.select("doc_id", F.col("top.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
                       (F.col("tag") == F.col("top.tag")).alias("kept"), "digest")


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns.

    Kept rows are found by (id, digest), which is unique among them; where several input rows share both,
    one of them is taken by a grouped aggregate, so repeated rows never meet uncombined.
    """
    kept = resolve(docs, id_col, text_col)
    chosen = kept.where("kept").select(F.col("doc_id").alias("k_id"), F.col("digest").alias("k_digest"))
    twice = kept.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    chosen = durable(chosen.join(
        twice.select(F.col("doc_id").alias("t_id"), F.col("digest").alias("t_digest"), F.lit(True).alias("again")),
        F.col("k_id").eqNullSafe(F.col("t_id")) & (F.col("k_digest") == F.col("t_digest")), "left",
    ).select("k_id", "k_digest", F.coalesce("again", F.lit(False)).alias("again")), "exact-kept")
    rows = docs.select(F.struct("*").alias("r"), F.col(id_col).alias("id"), digest_of(F.col(text_col)).alias("digest"))
    met = rows.join(chosen.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("k_id")) & (F.col("digest") == F.col("k_digest")))
    single = met.where("NOT again").select("r.*")
    repeated = met.where("again").groupBy("id", "digest").agg(F.any_value("r").alias("r")).select("r.*")
    return single.unionByName(repeated)
