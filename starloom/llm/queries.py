"""Registered queries of the operators, over whole tables, with the SQL that expresses them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import exact, fim, language, licenses, lm, mixing, nearcopies, packing, quality, search, shards, simhash, spelling


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mixture(documents(spark, sf_dir))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP1_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('mix-1 ' || coalesce(doc_id::VARCHAR, 'text ' || coalesce(text, ''))), 1, 13))::BIGINT::DOUBLE
           / 4503599627370496.0::DOUBLE AS draw
  FROM documents),
sources AS (
  SELECT source, source_size, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source)),
steps AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
             / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level, row_number() OVER o AS nth
  FROM sources WINDOW o AS (ORDER BY source_size / weight, source NULLS LAST)),
found AS (
  SELECT source, source_size, least((3 * source_size)::DOUBLE, weight * (
      SELECT min_by(level, nth) FROM steps WHERE level * weight <= 3 * source_size)) AS target FROM steps),
rated AS (
  SELECT doc_id, size, source_size, target, draw, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
  FROM sized JOIN found ON sized.source IS NOT DISTINCT FROM found.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate)::BIGINT + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rated"""


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    cut = packing.pieces(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    slim = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "part", "nth")
    return packing.place(slim)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = documents(spark, sf_dir), language.fold() == 1
    found = language.identify(docs, language.fit(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(documents(spark, sf_dir))
    base = F.filter("matches", lambda m: m["base"])
    joined = [F.array_join(F.array_sort(F.array_distinct(F.transform(m, lambda x: x["label"]))), ",") for m in (base, F.col("matches"))]
    starts = F.transform(base, lambda m: m["start"])
    return found.select(
        "doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined[0].alias("base_labels"), joined[1].alias("labels"), (F.col("covered") / F.greatest("n_words", F.lit(1))).alias("score"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact.resolve(documents(spark, sf_dir))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP5_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""


def op6_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shards.byte_shards(documents(spark, sf_dir))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


OP6_SQL = r"""
WITH crc AS (
  SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS step
  FROM range(256) t(b)),
texts AS (SELECT doc_id, coalesce(text, '') AS text, strlen(coalesce(text, '')) + 1 AS size, hex(encode(coalesce(text, ''))) AS bytes FROM documents),
sized AS (
  SELECT doc_id, size, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(regexp_extract_all(bytes, '..'), lambda pair: ('0x' || pair)::BIGINT)),
    lambda c, x: xor(c >> 8, step[(xor(c, x) & 255) + 1])))::BIGINT AS text_crc32 FROM texts, crc),
placed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING) AS upto, sum(size) OVER () AS whole,
         row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) AS place FROM sized),
dealt AS (SELECT *, ((upto * 2 - size) * 16 // (2 * whole))::INTEGER AS shard FROM placed)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'bytes' AS law, shard, (row_number() OVER (PARTITION BY shard ORDER BY place) - 1)::BIGINT AS slot,
       NULL::INTEGER AS grown_shard
FROM dealt"""


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's host is its source, its path the language section of the source. Labels of a fifth of all ids are never used."""
    docs, held_out = documents(spark, sf_dir), language.fold(folds=5) == 0
    found = quality.classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), F.col("source"), F.col("lang"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "host_rate", "path_rate", "score", "kept")


def op8_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearcopies.near_copies(documents(spark, sf_dir), width=3, percent=85)


def op9_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


OP9_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS tag, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score,
         row_number() OVER (PARTITION BY q.tag ORDER BY list_inner_product(q.e, c.e) DESC, c.vec_id) AS rank
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.tag <> c.tag)
WHERE rank <= 5"""


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = documents(spark, sf_dir), language.fold(folds=10) == 0
    return lm.score(docs, ~held_out).select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fim.fill_in_middle(documents(spark, sf_dir))
    digests = [F.sha2(c.cast("binary"), 256).alias(name) for c, name in ((F.col("output"), "output_sha256"), (fim.restored("output", "form"), "restored_sha256"))]
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


OP11_SQL = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
drawn AS (
  SELECT *, len(u)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(u) + 1) AS x, ('0x' || substr(h, 9, 8))::BIGINT % (len(u) + 1) AS y,
         CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
              WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM units),
cut AS (
  SELECT *, array_to_string(u[1:least(x, y)], '') AS prefix, array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS middle,
         array_to_string(u[greatest(x, y) + 1:], '') AS suffix
  FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN len(prefix) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN len(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut"""


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_copies(documents(spark, sf_dir))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.document_variants(documents(spark, sf_dir))


OP13_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS step
  FROM range(256) t(b)),
runs AS (
  SELECT doc_id, run, count(*) AS times, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS bytes
  FROM (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]{7,}')),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents) GROUP BY doc_id, run),
hashed AS (
  SELECT run, times, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(len(bytes) // 2), lambda i: ('0x' || substr(bytes, (2 * i + 1)::BIGINT, 2))::BIGINT)),
    lambda c, x: xor(c >> 8, step[(xor(c, x) & 255) + 1]))) AS h
  FROM runs, crc),
words AS MATERIALIZED (
  SELECT word, sum(times)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % len(run)) || substr(run, h % len(run) + 2) ELSE run END AS word, times FROM hashed)
  WHERE len(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
holes AS MATERIALIZED (
  SELECT word, n, substr(word, 1, k - 1) AS head, substr(word, k + 1) AS tail FROM (SELECT word, n, unnest(range(1, len(word) + 1)) AS k FROM words)),
shorter AS (SELECT h.word AS long, h.n AS long_n, w.word AS short, w.n AS short_n FROM holes h JOIN words w ON h.head || h.tail = w.word),
near AS (
  SELECT DISTINCT word, near, near_n FROM (
    SELECT long AS word, short AS near, short_n AS near_n FROM shorter UNION ALL SELECT short, long, long_n FROM shorter
    UNION ALL SELECT a.word, b.word, b.n FROM holes a JOIN holes b ON a.head = b.head AND a.tail = b.tail AND a.word <> b.word)),
best AS (SELECT word, count(*) AS n_near, max(near_n) AS form_n, arg_min(near, (-near_n, near)) AS form FROM near GROUP BY word),
formed AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN form_n >= 10 * w.n THEN form END AS form, CASE WHEN form_n >= 10 * w.n THEN form_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS root FROM formed
  UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON c.root = f.word WHERE f.form IS NOT NULL)
SELECT f.word, form, root, n, n_near, form_n FROM formed f JOIN (SELECT word, root FROM chain c WHERE root NOT IN (SELECT word FROM formed WHERE form IS NOT NULL)) USING (word)"""


QUERIES = {"op1_mix": op1_mix, "op2_pack": op2_pack, "op3_language": op3_language, "op4_licenses": op4_licenses, "op5_exact_dedup": op5_exact_dedup, "op6_shard": op6_shard, "op7_quality": op7_quality, "op8_near_copies": op8_near_copies, "op9_search": op9_search, "op10_lm_score": op10_lm_score,
           "op11_fill_in_middle": op11_fill_in_middle, "op12_simhash": op12_simhash, "op13_spelling": op13_spelling}
SQL = {"op1_mix": OP1_SQL, "op5_exact_dedup": OP5_SQL, "op6_shard": OP6_SQL, "op9_search": OP9_SQL, "op11_fill_in_middle": OP11_SQL, "op13_spelling": OP13_SQL}
