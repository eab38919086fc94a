"""The operators against plain versions, exact round trips and held-out accuracy."""

from __future__ import annotations

import hashlib
import math
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
import corpus  # noqa: E402

from starloom.llm import components, exact, language, licenses, lm, mixing, nearcopies, packing, quality, search, shards, tokens, trie  # noqa: E402

SF = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return corpus.documents(spark)


def test_mixture_targets_and_repeats(spark, docs):
    rows = mixing.mixture(docs).collect()
    size = Counter()
    for _, text, _, source, _ in corpus.rows():
        size[source] += len(corpus.words(text))
    names = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    full, total = set(), sum(size.values())  # raise full sources one by one until no target is above
    while True:
        left = total - sum(3 * size[s] for s in full)
        target = {s: 3 * size[s] if s in full else left * weight[s] / sum(weight[x] for x in names if x not in full) for s in names}
        above = {s for s in names if target[s] > 3 * size[s]}
        if not above:
            break
        full |= above
    for r in rows:
        assert r["source_size"] == size[r["source"]] and math.isclose(r["target"], target[r["source"]], rel_tol=1e-12)
        rate = r["target"] / r["source_size"]
        assert math.floor(rate) <= r["copies"] <= math.ceil(rate) <= 3
    again = {(r["doc_id"], r["size"]): r["copies"] for r in mixing.mixture(docs.repartition(5)).collect()}
    assert all(again[r["doc_id"], r["size"]] == r["copies"] for r in rows)
    assert mixing.mix(docs).count() == sum(r["copies"] for r in rows)


def test_mixture_comes_near_its_targets(spark):
    data = [(i, "w " * (1 + i % 7), None, f"s{i % 3}", 0) for i in range(6000)]
    taken, target = Counter(), {}
    for r in mixing.mixture(corpus.documents(spark, data=data)).collect():
        taken[r["source"]] += r["copies"] * r["size"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] / target[s] - 1) < 0.06 for s in target)


def test_word_encoder_equals_whole_text():
    encoder = tokens.WordEncoder(Path(TOKENIZER).read_text(encoding="utf-8"))
    rng = random.Random(1)
    alphabets = ["abcXYZ 'stre  ll.,|\n\t\x85\xa0éÉßſ²½ªº09<|endoftext|>İ\x1cΣσ—", [chr(c) for c in range(0x250)]]
    texts = ["".join(rng.choice(a) for _ in range(rng.randint(0, 40))) for a in alphabets for _ in range(1500)]
    texts += [t or "" for _, t, *_ in corpus.rows()]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_word_encoder_empties_its_store(monkeypatch):
    monkeypatch.setattr(tokens, "MOST_WORDS", 50)
    encoder = tokens.WordEncoder(Path(TOKENIZER).read_text(encoding="utf-8"))
    for k in range(20):
        text = " ".join(f"word{k}x{i}." for i in range(30))
        assert encoder.encode([text])[0].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_packing_round_trip(spark, docs):
    encoder = tokens.WordEncoder(Path(TOKENIZER).read_text(encoding="utf-8"))
    packed = packing.pack(docs, TOKENIZER)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in packed.collect():
        ids = np.frombuffer(bytes(r["ids"]), "<u4")
        assert len(ids) == r["length"] <= packing.CAPACITY
        by_doc[r["doc_id"]].append((r["piece"], r["start"], ids))
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc_id, text in {(r[0], r[1]) for r in corpus.rows()}:
        want = encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        got = {(p, s): i.tolist() for p, s, i in by_doc[doc_id]}
        assert sum((got[k] for k in sorted(got)), []) == want
        assert all(s == p * packing.CAPACITY for p, s in got)
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= packing.CAPACITY
    whole = {r["sequence_id"]: r["length"] for r in packing.sequences(packed).collect()}
    assert whole == {s: sum(n for _, n in p) for s, p in by_sequence.items()}


@pytest.mark.parametrize("capacity, n", [(2048, 20000), (2048, 500), (64, 1000), (10, 50), (3, 9), (1, 4)])
def test_plan_is_whole_and_tight(capacity, n):
    rng = random.Random(capacity + n)
    counts = Counter(min(capacity, max(1, int(rng.lognormvariate(5.5, 1.2) * capacity / 2048))) for _ in range(n))
    filled, placed = defaultdict(list), Counter()
    for length, first, count, sequence, per, offset in packing.plan(counts, capacity):
        assert first == placed[length]
        placed[length] += count
        for i in range(count):
            filled[sequence + i // per].append((offset + i % per * length, length))
    assert placed == counts
    for places in filled.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
        assert sum(3 * length > capacity for _, length in places) <= 2 or capacity < 3
    assert len(filled) <= sum(k * v for k, v in counts.items()) / capacity * 1.03 + 2


def test_languages_on_held_out_documents(spark, docs):
    model = language.fit(docs, language.fold() != 1)
    rows = language.identify(docs, model).join(docs.select("doc_id", "lang", "text").distinct(), "doc_id").collect()
    held = [r for r in rows if corpus.crc(r["doc_id"]) % 3 == 1 and r["lang"] and len(r["text"]) > 60]
    assert len(held) > 20 and sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.95
    for r in rows:
        assert 0 <= r["score"] <= 1
        if not re.search(r"[^\W\d_]", r["text"] or ""):
            assert r["lang_pred"] == language.UNKNOWN and r["rejected"]
    assert not any(r["rejected"] for r in held)


def test_language_fit_does_not_depend_on_the_order_of_rows(spark, docs):
    models = [language.fit(docs.repartition(n).sortWithinPartitions(order), language.fold() != 1) for n, order in ((1, F.asc("doc_id")), (5, F.desc("doc_id")))]
    assert models[0].languages == models[1].languages
    assert (models[0].centres == models[1].centres).all() and (models[0].least == models[1].least).all()


def test_language_labels_are_no_input(spark, docs):
    model = language.fit(docs, language.fold() != 1)
    one = {(r["doc_id"], r["score"]) for r in language.identify(docs, model).collect()}
    assert one == {(r["doc_id"], r["score"]) for r in language.identify(docs.withColumn("lang", F.lit("xx")), model).collect()}


def plain_base(text):
    line = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", corpus.ascii_lower(text))
    found = []
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        found += [(i, label) for i in range(len(line)) if line[i:i + len(p)] == p]
    return len(line), sorted(found)


def test_licenses_base_places(spark):
    data = corpus.rows() + [(1000 + i, r["text"], None, None, 0) for i, r in enumerate(spark.read.parquet(f"{SF}/documents.parquet").select("text").collect())]
    got = licenses.scan(corpus.documents(spark, data=data)).collect()
    assert Counter((r["doc_id"], r["n_words"], tuple(sorted((m["start"], m["label"]) for m in r["matches"] if m["base"]))) for r in got) == Counter(
        (r[0], plain_base(r[1])[0], tuple(plain_base(r[1])[1])) for r in data)


def test_license_regions():
    a = [licenses.compile_template("x", "one two [[three [[four]] five]] six {{2}} seven")]
    match = {t: bool(licenses.scan_text(t, a)[1]) for t in (
        "one two six seven", "one two three five six seven", "one two three four five six a b seven", "One, two: six a seven", "one two six a b c seven",
        "one two four six seven", "one two three six seven", "one six seven", "one two")}
    assert list(match.values()) == [True] * 4 + [False] * 5
    for bad in ("[[one]] two", "{{3}} one", "one [[two"):
        with pytest.raises(ValueError):
            licenses.compile_template("bad", bad)


@pytest.mark.parametrize("tracked", [16, exact.TRACKED])
def test_exact_copies(spark, docs, tracked):
    groups = defaultdict(list)
    for doc_id, text, *_ in corpus.rows():
        groups[text or ""].append(-1 if doc_id is None else doc_id)
    rows = exact.resolve(docs, tracked=tracked).collect()
    by_digest = {hashlib.sha256(t.encode()).digest(): v for t, v in groups.items()}
    kept = Counter()
    for r in rows:
        ids = by_digest[bytes(r["digest"])]
        best = None if max(ids) == -1 else max(ids)
        assert (r["keep_id"], r["group_size"]) == (best, len(ids))
        if r["kept"]:
            assert r["doc_id"] == best
            kept[bytes(r["digest"])] += 1
    assert len(rows) == len(corpus.rows()) and kept == Counter(by_digest.keys())
    stay = exact.distinct_documents(docs).collect()
    assert sorted((r["text"] or "", -1 if r["doc_id"] is None else r["doc_id"]) for r in stay) == sorted((t, max(v)) for t, v in groups.items())


def test_exact_copies_over_many_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "61")
    try:
        data = [(i, "hot" if i % 3 else f"text {i // 2}", None, None, 0) for i in range(900)]
        rows = exact.resolve(corpus.documents(spark, data=data)).collect()
        assert sum(r["kept"] for r in rows) == len({d[1] for d in data}) and max(r["group_size"] for r in rows) == 600
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_shards(spark, docs):
    n = 4
    data = sorted(((-1 if i is None else i, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for i, t, *_ in corpus.rows()))
    total, upto, want, starts = sum(d[2] for d in data), 0, [], {}
    for k, d in enumerate(data):
        shard = (2 * upto + d[2]) * n // (2 * total)
        upto += d[2]
        want.append((*d, shard, k - starts.setdefault(shard, k)))
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["text_crc32"], r["size"], r["shard"], r["slot"]) for r in shards.byte_shards(docs, n).collect())
    assert got == sorted(want)


def test_quality_ranks_held_out_documents_and_shrinks_sites(spark):
    rng = random.Random(2)
    data = [(i, corpus.prose(rng, "en", 80) if i % 4 else " | ".join(["%%% x9 ###"] * 30), "en", f"s{i % 6}" if i else "rare", 0) for i in range(400)]
    df = corpus.documents(spark, data=data)
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(400)], "doc_id long, quality int")
    rows = quality.classify(df, labels, F.col("source"), F.col("lang"), F.col("doc_id") % 5 != 0).collect()
    held = [r for r in rows if r["doc_id"] % 5 == 0]
    assert min(r["score"] for r in held if r["doc_id"] % 4) > max(r["score"] for r in held if r["doc_id"] % 4 == 0)
    assert all(r["kept"] == (r["score"] >= 0.5) for r in rows)
    rare = next(r for r in rows if r["doc_id"] == 0)
    assert abs(rare["path_rate"] - 0.75) < 0.05  # alone in its site: the global rate stands in


def test_near_copies(spark, docs):
    data = [r for r in corpus.rows() if r[0] is not None]
    want = corpus.near_components([(r[0], r[1]) for r in data])
    got = [r for r in nearcopies.near_copies(docs).collect() if r["doc_id"] is not None]
    assert len(got) == len(data)
    for r in got:
        assert r["component_id"] == want[r["doc_id"]] and r["kept"] == (r["doc_id"] == r["component_id"])
        assert r["n_shingles"] == len(corpus.shingle_set(next(t for i, t, *_ in data if i == r["doc_id"])))


def test_near_copies_in_chains_and_around_a_centre(spark):
    rng = random.Random(4)
    base, data = [f"w{rng.randrange(10**6)}" for _ in range(150)], []
    chain = list(base)
    for i in range(30):  # neighbours are linked, the ends are not
        data.append((i, " ".join(chain), None, None, 0))
        chain[i * 5] = f"new{i}"
    centre = [f"v{rng.randrange(10**6)}" for _ in range(200)]
    data.append((500, " ".join(centre), None, None, 0))
    for i in range(60):  # linked with the centre, mostly not with each other
        words = list(centre)
        for k in rng.sample(range(0, 200, 4), 4):
            words[k] = f"x{i}y{k}"
        data.append((100 + i, " ".join(words), None, None, 0))
    want = corpus.near_components([(d[0], d[1]) for d in data])
    got = {r["doc_id"]: r["component_id"] for r in nearcopies.near_copies(corpus.documents(spark, data=data)).collect()}
    assert got == want and len(set(want.values())) == 2


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(200, i) for i in range(201, 260)] + [(300, 300), (7, 3)]
    found = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{i: 200 for i in range(200, 260)}}


def test_search_equals_sql(spark):
    from starloom.llm.queries import OP9_SQL, op9_search

    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    want = con.execute(f"SELECT query_id, rank, vec_id, score FROM ({OP9_SQL})").fetchall()
    assert sorted(map(tuple, op9_search(spark, SF).collect())) == sorted(want)


def test_max_score_with_ties_and_few_terms():
    rng = np.random.default_rng(5)
    for _ in range(200):
        n, width = int(rng.integers(1, 60)), int(rng.integers(1, 30))
        shard, q = rng.integers(-3, 4, (width, n)).astype(float), rng.integers(-3, 4, width).astype(float)
        own = int(rng.integers(-1, n))
        low, high = np.minimum(q * shard.min(1), q * shard.max(1)), np.maximum(q * shard.min(1), q * shard.max(1))
        rows, scores = search.max_score(q, shard, np.argsort(low - high, kind="stable"), low, high, own, 5)
        full = q @ shard
        others = [i for i in range(n) if i != own]
        best = sorted(others, key=lambda i: (-full[i], i))[:5]
        assert (scores == full[rows]).all()
        assert sorted(rows, key=lambda i: (-full[i], i))[:5] == best


def test_language_model(spark, docs):
    rows = lm.score(docs, language.fold(folds=10) != 0).collect()
    data = corpus.rows()
    count, pair, context = Counter(), Counter(), Counter()
    tokens_of = [[*corpus.words(corpus.ascii_lower(t)), None] for _, t, *_ in data]
    for (doc_id, *_), line in zip(data, tokens_of):
        if corpus.crc(doc_id) % 10:
            count.update(line)
            pair.update(zip([0, *line], line))
            context.update([0, *line[:-1]])
    n, v = sum(count.values()), len(count)
    single = lambda w: (count[w] + 0.1) / (n + 0.1 * (v + 1))
    want = defaultdict(list)
    for (doc_id, *_), line in zip(data, tokens_of):
        base = sum(math.log10(single(w)) for w in line)
        full = sum(math.log10((pair[u, w] + lm.MU * single(w)) / (context[u] + lm.MU)) for u, w in zip([0, *line], line))
        want[doc_id].append((len(line), sum(count[w] > 0 for w in line), base, full))
    assert len(rows) == len(data)
    for r in rows:
        assert r["train_tokens"] == n
        assert any(r["n_tokens"] == t and r["n_known"] == k and math.isclose(r["base_score"], b, rel_tol=1e-9) and abs(r["score"] - s) < 3e-4 * t
                   for t, k, b, s in want[r["doc_id"]])


def test_language_model_splits_frequent_contexts(spark, docs, monkeypatch):
    plain = {(r["doc_id"], r["n_tokens"]): r["score"] for r in lm.score(docs, F.lit(True)).collect()}
    monkeypatch.setattr(lm, "LEAST_SHARDS", 3000)
    for r in lm.score(docs, F.lit(True)).collect():
        assert math.isclose(r["score"], plain[r["doc_id"], r["n_tokens"]], rel_tol=1e-9)


def test_language_model_without_training_texts(spark, docs):
    assert all(r["base_score"] == r["score"] == 0 for r in lm.score(docs, F.lit(False)).collect())


@pytest.mark.parametrize("n, top", [(0, 10), (1, 1), (1, 2**63), (5, 2**64 - 1), (100, 120), (3000, 2**40), (3000, 4000)])
def test_elias_fano(n, top):
    rng = np.random.default_rng(n)
    x = np.unique(rng.integers(0, top, n, dtype=np.uint64, endpoint=True))
    e = trie.EliasFano.of(x)
    assert (e.get(np.arange(len(x))) == x).all()
    asked = np.r_[x, rng.integers(0, top, 300, dtype=np.uint64, endpoint=True)]
    where = {v: i for i, v in enumerate(x.tolist())}
    assert e.find(asked).tolist() == [where.get(v, -1) for v in asked.tolist()]


def test_trie_round_trip():
    rng = np.random.default_rng(9)
    pairs = sorted({(int(c), int(s)) for c, s in zip(rng.integers(0, 50, 2000) * 12345678910111, rng.integers(0, 2**40, 2000))})
    context, successor = (np.array(v, np.uint64) for v in zip(*pairs))
    p = rng.random(len(pairs))
    t = trie.BigramTrie.of(context, successor, p)
    one = np.ones(len(pairs), int)
    assert np.allclose(trie.restored(t.codes_of(context, one, successor)), p, rtol=5e-4)
    assert not t.codes_of(context, one, successor ^ np.uint64(1)).any()
    assert [s for s, _ in t.successors_of(int(context[0]))] == successor[context == context[0]].tolist()


def test_word_encoder_takes_more_words_at_once_than_its_store(monkeypatch):
    monkeypatch.setattr(tokens, "MOST_WORDS", 50)
    encoder = tokens.WordEncoder(Path(TOKENIZER).read_text(encoding="utf-8"))
    for words in (range(40), range(80), range(60, 300), range(40)):
        text = " ".join(f"Word{k}, w{'ab' * k} {'xyz'[k % 3] * k}'s." for k in words)
        assert encoder.encode([text, "", " the "])[0].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert len(encoder.place) <= 50
