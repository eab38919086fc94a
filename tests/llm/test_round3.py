"""Fill-in-the-middle, SimHash and spelling variants against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from corpus import SCHEMA, ascii_lower, crc, documents, prose, rows, words
from pyspark.sql import functions as F

from starloom.llm import fim, simhash, spelling
from starloom.llm.queries import QUERIES
from starloom.llm.tiles import steps


def stored(tmp_path, data, spark, extra=False):
    documents(spark, extra, data).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def awkward() -> list[tuple]:
    rng = random.Random(3)
    more = [(900, "<S> is a mark"), (901, "x<P"), (902, "a\U0001F600b\n\r\tÀé 1"), (903, "abc" * 400_000 + " é " * 300_000), (904, "<" * 50 + "P" * 3 + ">" * 50),
            (905, prose(rng, "fr", 20_000)), (None, "<<<>>>SMP"), (None, None)]
    return rows() + [(i, t, None, None, 0) for i, t in more]


# fill in the middle

def plain_fim(doc_id, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text, re.S)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k:k + 8], 16) for k in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    sha = hashlib.sha256(text.encode()).hexdigest()
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return doc_id, len(units), "plain", None, None, sha, sha
    form = "spm" if h[3] % 100 < 20 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, len(units), form, len(p), len(m), hashlib.sha256(out.encode()).hexdigest(), sha


@pytest.mark.parametrize("extra", [False, True])
def test_op11_equals_a_plain_version(spark, tmp_path, extra):
    data = awkward()
    got = [tuple(r) for r in QUERIES["op11_fill_in_middle"](spark, stored(tmp_path, data, spark, extra)).collect()]
    assert Counter(got) == Counter(plain_fim(r[0], r[1]) for r in data)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_every_rank_is_reached_by_widths():
    rng = random.Random(1)
    for size in (0, 1, 2, 9, 500, 4000):
        text = "".join(rng.choice("ab cdé1\n\U0001F600Z") for _ in range(size))
        units, listed = re.findall("[A-Za-z]+|[^A-Za-z]", text, re.S), fim.SkipList(text)
        starts = np.cumsum([0, *map(len, units)]).tolist()
        assert listed.n == len(units) and [listed.place(k) for k in range(listed.n + 1)] == starts
    assert 5 <= len(fim.SkipList("a1" * 40_000).lanes) <= 14


def test_fim_of_an_empty_table(spark):
    assert fim.fill_in_middle(spark.createDataFrame([], SCHEMA)).count() == 0


# SimHash

def plain_fingerprint(text):
    w = words(ascii_lower(text))
    grams = [" ".join(w[k:k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def plain_components(bits: list[int], ids: list) -> list:
    """The least non-null id reachable, by comparing all pairs."""
    b = np.array(bits, np.uint64)
    label = np.arange(len(b))
    near = np.bitwise_count(b[:, None] ^ b) <= 2
    while True:
        new = np.where(near, label[None, :], len(b)).min(axis=1)
        if (new == label).all():
            break
        label = new
    least = defaultdict(list)
    for k, i in zip(label, ids):
        least[k] += [i] if i is not None else []
    return [min(least[k], default=None) for k in label]


@pytest.mark.parametrize("extra", [False, True])
def test_op12_equals_a_plain_version(spark, tmp_path, extra):
    data = [r for r in awkward() if len(r[1] or "") < 200_000]
    bits = [plain_fingerprint(r[1]) for r in data]
    got = [tuple(r) for r in QUERIES["op12_simhash"](spark, stored(tmp_path, data, spark, extra)).collect()]
    assert Counter(got) == Counter((r[0], f"{b:016x}", c) for r, b, c in zip(data, bits, plain_components(bits, [r[0] for r in data])))


def test_spark_has_the_same_hash(spark):
    shingle = "über die Brücke"
    got = spark.createDataFrame([(shingle,)], "s string").select(F.xxhash64("s")).first()[0]
    assert got % 2**64 == xxhash.xxh64_intdigest(shingle.encode(), seed=42)


def test_long_texts_count_their_bits_in_parts():
    text = "word other third " * 40_000
    w = text.split()
    h = np.array([xxhash.xxh64_intdigest(" ".join(w[k:k + 3]).encode(), seed=42) for k in range(6)], np.uint64)
    counts = {int(h[k % 3]): len(range(k, len(w) - 2, 3)) for k in range(3)}
    expected = sum(1 << k for k in range(64) if 2 * sum(n for x, n in counts.items() if x >> k & 1) > len(w) - 2)
    assert simhash.fingerprint(text) == expected


@pytest.mark.parametrize("parts", [2, 4, 8])
def test_tiles_find_all_links(spark, monkeypatch, parts):
    """Balls of near fingerprints, over many small tiles; a ball has far more pairs than links."""
    monkeypatch.setattr(simhash, "TILE", 16)
    rng = random.Random(parts)
    bits = {0, 2**64 - 1, 1, 3, 7}
    for _ in range(12):
        center = rng.getrandbits(64)
        for _ in range(60):
            bits.add(center ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 3))))
    bits = sorted(bits | {rng.getrandbits(64) for _ in range(200)})
    signed = [b - 2**64 if b >= 2**63 else b for b in bits]
    df = spark.createDataFrame([(b,) for b in signed], "bits long").repartition(5)
    found = {r.node: r.component for r in simhash.linked(df, 2, parts).collect()}
    label = plain_components(bits, signed)
    assert [found.get(b, b) for b in signed] == label
    assert len(set(label)) < len(bits)


def test_links_between_tiles_are_a_forest():
    one = np.array([k for k in range(4)] + [0xFFF << 40], np.int64)
    u, v = simhash.links_of(one, one, 2)
    assert len(u) == 3 and set(u.tolist()) | set(v.tolist()) == {0, 1, 2, 3}


def test_steps_cover_each_difference_once():
    for parts in (1, 3, 4):
        found = {tuple(s) for s in steps(parts, 2)}
        both = found | {tuple(-x for x in s) for s in found}
        assert len(both) == 2 * len(found) - 1 and all(sum(map(abs, s)) <= 2 for s in both)
        assert len(both) == 1 + 2 * parts + 2 * parts + 4 * parts * (parts - 1) // 2


def test_simhash_of_an_empty_table_and_of_null_ids(spark):
    assert simhash.near_copies(spark.createDataFrame([], SCHEMA)).count() == 0
    data = [(None, "", None, None, 0), (None, "a b c d", None, None, 0), (4, "a b c d", None, None, 0), (3, "A b c d", None, None, 0)]
    got = Counter((r.doc_id, r.component_id, r.kept) for r in simhash.near_copies(documents(spark, data=data)).collect())
    assert got == Counter([(None, None, True), (None, 3, False), (4, 3, False), (3, 3, True)])


# spelling variants

def plain_words(data) -> Counter:
    n = Counter()
    for r in data:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r[1] or ""):
            run = ascii_lower(run)
            h = crc(f"{'' if r[0] is None else r[0]}:{run}")
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    return Counter({w: k for w, k in n.items() if len(w) >= 7 and k >= 2})


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def plain_variants(n: dict) -> set:
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    best = {w: min(v, key=lambda x: (-n[x], x)) for w, v in near.items() if v}
    form = {w: v for w, v in best.items() if n[v] >= 10 * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n}


def misspelt() -> list[tuple]:
    """Documents with planted variants: chains of forms, ties, anagrams, accents and long runs."""
    rng, out = random.Random(11), []
    base = ["".join(rng.choice("abcdeéàüst") for _ in range(rng.randint(7, 12))) for _ in range(40)]
    for i in range(60):
        text = []
        for _ in range(120):
            w = rng.choice(base[:10] if rng.random() < .8 else base)
            if rng.random() < .1:
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1:], w[:k] + "x" + w[k:], w[:k] + "x" + w[k + 1:], w[::-1]])
            text.append(w.capitalize() if rng.random() < .2 else w)
        out.append((i, " ".join(text), None, None, 0))
    chain = ["rooooot"] * 300 + ["roooooot"] * 30 + ["rooooooot"] * 3
    long = "a" * 3000
    out += [(100, " ".join(chain), None, None, 0), (101, f"{long} {long}b {long} {long}b {long[1:]}c", None, None, 0), (102, f"{long[1:]}c {long}", None, None, 0),
            (None, "nullids nullids Nullidss nullidss ×÷×÷×÷× ×÷×÷×÷× Ābcdefgh", None, None, 0)]
    return out + out[:2]


@pytest.mark.parametrize("extra", [False, True])
def test_op13_equals_a_plain_version(spark, tmp_path, extra):
    data = rows() + misspelt()
    got = [tuple(r) for r in QUERIES["op13_spelling"](spark, stored(tmp_path, data, spark, extra)).collect()]
    expected = plain_variants(plain_words(data))
    assert len(got) == len(set(got)) and set(got) == expected
    assert any(r[1] and r[2] != r[1] for r in got)


@pytest.mark.parametrize("classes", [1, 6, 8])
def test_blocks_find_all_near_words(spark, monkeypatch, classes):
    monkeypatch.setattr(spelling, "TILE_WORDS", 8)
    n = plain_words(misspelt())
    table = spark.createDataFrame(list(n.items()), "word string, n long").repartition(4)
    assert {tuple(r) for r in spelling.variants(table, classes=classes).collect()} == plain_variants(n)


def test_spelling_without_words(spark):
    assert spelling.document_variants(spark.createDataFrame([], SCHEMA)).count() == 0
    assert spelling.document_variants(documents(spark, data=[(1, None, None, None, 0), (2, "", None, None, 0), (3, "short words", None, None, 0)])).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(spark.createDataFrame([("abcdefg", 2)], "word string, n long"), stronger=1)
