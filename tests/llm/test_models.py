"""Language centroids and quality posteriors against plain versions."""

from __future__ import annotations

import base64
import math
import random
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
import corpus  # noqa: E402

from starloom.llm import language, quality  # noqa: E402


def labelled(n: int = 240, seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    return [(i, corpus.prose(rng, lang, rng.randint(30, 120)), lang, "s", 0) for i in range(n) for lang in [("en", "de", "fr")[i % 3]]]


def test_gram_weights_equal_a_plain_version():
    texts = ["Ab ab, Über 1x", "ab", "", "zz top"]
    dims = 1 << 16
    counts = language.counts_of(texts, dims)
    for text, row in zip(texts, counts):
        line = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
        line = "".join(c for k, c in enumerate(line) if c != " " or k == 0 or line[k - 1] != " ")
        grams = Counter(line[k:k + n] for n in (2, 3) for k in range(len(line) - n + 1))
        assert sorted(row[row > 0]) == sorted(grams.values())  # places apart, as there are many
    idf = np.linspace(1, 2, dims).astype(np.float32)
    got = language.weighted(counts, idf)
    plain = np.sqrt(counts) * idf
    for g, p in zip(got, plain):
        norm = math.sqrt((p * p).sum())
        assert np.allclose(g, p / norm if norm else p, atol=1e-6)


def test_clusters_hold_several_texts_and_junk_opens_no_gate():
    rng = np.random.default_rng(5)
    groups = [rng.normal(size=64) * 3 for _ in range(3)]
    v = np.concatenate([g + rng.normal(size=(60, 64)) for g in groups] + [rng.normal(size=(2, 64)) * 9]).astype(np.float32)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    centres, least = language.clustered(v, 4)
    of = (v @ centres.T).argmax(axis=1)
    assert 2 <= len(centres) <= 4 and min(np.bincount(of, minlength=len(centres))) >= language.FEWEST
    assert least.min() > 0.5  # the two strays do not count for any gate
    again, same = language.clustered(v, 4)
    assert (centres == again).all() and (least == same).all()
    few, _ = language.clustered(v[:3], 4)
    assert len(few) == 1


def test_nearest_centroid_equals_a_plain_version(spark):
    data = labelled() + [(1000, base64.b64encode(random.Random(1).randbytes(3000)).decode(), "de", "s", 0)]
    docs = corpus.documents(spark, data=data)
    model = language.fit(docs, F.lit(True))
    assert min(Counter(model.languages).values()) >= 1 and len(model.least) == len(model.languages)
    texts = {r[0]: r[1] for r in data}
    found = {r["doc_id"]: r for r in language.identify(docs, model).collect()}
    for i, text in texts.items():
        x = language.weighted(language.counts_of([text], len(model.idf)), model.idf)[0]
        cosine = [float(x @ c) for c in model.centres]
        best = max(range(len(cosine)), key=lambda k: cosine[k])
        r = found[i]
        assert abs(r["score"] - min(max(cosine[best], 0), 1)) < 1e-5
        assert cosine[model.languages.index(r["lang_pred"])] <= cosine[best] and abs(max(c for c, n in zip(cosine, model.languages) if n == r["lang_pred"]) - cosine[best]) < 1e-5
        grams = min(1, (language.counts_of([text], len(model.idf)) > 0).sum() / language.FULL)
        assert r["rejected"] == (r["score"] < language.SLACK * model.least[best] * math.sqrt(grams))
    assert not any(found[r[0]]["rejected"] for r in data[:-1]) and found[1000]["rejected"]


def test_junk_and_foreign_texts_are_rejected(spark):
    model = language.fit(corpus.documents(spark, data=labelled(300)), F.lit(True))
    rng = random.Random(9)
    junk = [base64.b64encode(rng.randbytes(4000)).decode(), rng.randbytes(3000).hex(), "Ελληνικά γράμματα " * 200, "zxqj vkwy pqzj " * 300]
    names, _, rejected = model.predict(junk)
    assert rejected.all() and set(names) <= {"en", "de", "fr"}
    short = ["the", "Ungschver", "eau que", "And."]  # a word or two of a language cannot come near
    assert not model.predict(short)[2].any()


def test_rare_labels_are_not_learned_but_end_nothing(spark, monkeypatch):
    monkeypatch.setattr(language, "MOST_LANGUAGES", 2)
    data = [r for r in labelled(90)] + [(500 + k, corpus.prose(random.Random(k), "en", 40), "en", "s", 0) for k in range(3)]
    model = language.fit(corpus.documents(spark, data=data), F.lit(True))
    assert set(model.languages) == {"en", "de"}  # most rows; of equal ones the first by name


def sites(seed: int = 1) -> list[tuple]:
    """(doc_id, host, path, probability): hosts that differ, a host with unlike paths, single documents, null sites."""
    rng, out = random.Random(seed), []
    for host, level in (("good", .9), ("bad", .1), ("mixed", None), (None, .5)):
        for k in range(60):
            path = f"p{k % 3}" if host else None
            base = level if level is not None else (.95, .5, .05)[k % 3]
            out.append((len(out), host, path, min(max(base + rng.uniform(-.15, .15), .01), .99)))
    return out + [(len(out) + k, f"single{k}", "p", rng.random()) for k in range(8)]


def plain_posteriors(rows):
    """(doc_id) -> host rate, path rate, score, from the formulas."""
    def rate(members):
        return sum(members) / len(members)

    whole = [p for *_, p in rows]
    mean, by_host, by_path = rate(whole), defaultdict(list), defaultdict(list)
    for _, h, q, p in rows:
        by_host[h].append(p)
        by_path[h, q].append(p)

    def strength(groups, above, of, parents):
        n = sum(map(len, groups.values()))
        within = sum(sum((p - rate(g)) ** 2 for p in g) for g in groups.values()) / (n - len(groups))
        between = sum(len(g) * (rate(g) - above(k)) ** 2 for k, g in groups.items()) - within * (len(groups) - parents)
        between /= n - sum(len(g) ** 2 / of(k) for k, g in groups.items())
        return min(max(within / between if between > 0 else 1e6, 1.0), 1e6)

    host_worth = strength(by_host, lambda k: mean, lambda k: len(whole), 1)
    path_worth = strength(by_path, lambda k: rate(by_host[k[0]]), lambda k: len(by_host[k[0]]), len(by_host))
    out = {}
    for i, h, q, p in rows:
        a = (sum(by_host[h]) - p + host_worth * mean) / (len(by_host[h]) - 1 + host_worth)
        b = (sum(by_path[h, q]) - p + path_worth * a) / (len(by_path[h, q]) - 1 + path_worth)
        odds = math.log(b / (1 - b)) + math.log(p / (1 - p)) - math.log(mean / (1 - mean))
        out[i] = (a, b, 1 / (1 + math.exp(-odds)))
    return out, host_worth, path_worth


def test_posteriors_equal_the_formulas_and_sites_flip_decisions(spark):
    rows = sites()
    weights = np.r_[1.0, np.zeros(len(quality.FEATURES))]  # the first feature is the evidence itself
    names = ["doc_id", "host", "path", *quality.FEATURES]
    data = [(i, h, q, math.log(p / (1 - p)), *[0.0] * (len(quality.FEATURES) - 1)) for i, h, q, p in rows]
    df = spark.createDataFrame(data, ", ".join(f"{n} {'long' if n == 'doc_id' else 'string' if n in ('host', 'path') else 'double'}" for n in names))
    expected, host_worth, path_worth = plain_posteriors(rows)
    assert 1 <= host_worth < 100 and 1 <= path_worth < 100  # sites that differ count
    got = {r["doc_id"]: (r["host_rate"], r["path_rate"], r["score"]) for r in quality.posteriors(df, weights).collect()}
    assert got.keys() == expected.keys()
    for i in got:
        assert np.allclose(got[i], expected[i], atol=1e-9), i
    own = {i: p for i, _, _, p in rows}
    flipped = [i for i in got if (own[i] >= .5) != (got[i][2] >= .5)]
    assert flipped


def test_sites_without_a_spread_leave_the_classifier_alone(spark):
    rng = random.Random(4)
    rows = [(i, f"h{i % 5}", f"p{i % 2}", rng.uniform(.05, .95)) for i in range(400)]
    data = [(i, h, q, math.log(p / (1 - p)), *[0.0] * (len(quality.FEATURES) - 1)) for i, h, q, p in rows]
    names = ["doc_id", "host", "path", *quality.FEATURES]
    df = spark.createDataFrame(data, ", ".join(f"{n} {'long' if n == 'doc_id' else 'string' if n in ('host', 'path') else 'double'}" for n in names))
    got = {r["doc_id"]: r["score"] for r in quality.posteriors(df, np.r_[1.0, np.zeros(len(quality.FEATURES))]).collect()}
    assert max(abs(got[i] - p) for i, _, _, p in rows) < .15
