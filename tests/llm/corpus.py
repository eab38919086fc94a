"""A small corpus with awkward rows, and plain versions of what the operators compute."""

from __future__ import annotations

import random
import re
import zlib

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
SYLLABLES = {"en": ["the", "ing", "ou", "wh", "and", "tion"], "de": ["ein", "sch", "ung", "ver", "zu", "keit"], "fr": ["eau", "que", "les", "aux", "oi", "ment"]}


def prose(rng: random.Random, lang: str, words: int) -> str:
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(words)).capitalize() + "."


def rows(seed: int = 7, n: int = 90) -> list[tuple]:
    """Prose in three languages, exact and near copies, and null, empty, long, symbol-only and repeated rows."""
    rng, out = random.Random(seed), []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        out.append([i, prose(rng, lang, rng.randint(1, 160)), lang, f"s{rng.randint(0, 4)}"])
    for i in range(n, n + 20):  # copies of the first documents
        out.append([i, out[i % 4][1], out[i % 4][2], "copies"])
    base = prose(rng, "en", 120).split()
    for i in range(n + 20, n + 40):  # near copies
        words = list(base)
        words[rng.randrange(len(words))] = f"edit{i}"
        out.append([i, " ".join(words), "en", "copies"])
    i = n + 40
    for text in (None, "", "  \t\n ", "12 34 %% $$", "word", "two words", "Τελικός λόγος ΣΑΣ", "word " * 3000, "under the MIT license, Under-the MIT License! cc-by-nc 4.0",
                 prose(rng, "de", 6000), "a<|endoftext|>b", "\x1c é́ ½²", "Apache License, Version 2.0"):
        out.append([i, text, None, None])
        i += 1
    out.append([None, "no id here", "en", "s1"])
    out.append(list(out[5]))  # a repeated row
    out.append(list(out[5]))
    return [(a, b, c, d, len(b or "")) for a, b, c, d in out]


def documents(spark, extra: bool = False, data: list[tuple] | None = None):
    """As a DataFrame; with extra columns named like the operators' own, if asked for."""
    df = spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(3)
    if extra:
        for name in ("size", "kept", "digest", "tag", "node", "name", "row", "r", "id", "shard", "part", "nth", "length", "score", "chunk", "copies", "target",
                     "component", "draw", "weight", "host", "path", "n", "a", "b", "words", "tokens", "start", "offset", "ids"):
            df = df.withColumn(name, df["source"])
    return df


def crc(doc_id) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode())


def ascii_lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingle_set(text: str | None) -> frozenset:
    w = words(ascii_lower(text))
    return frozenset(tuple(w[k:k + 3]) for k in range(len(w) - 2)) if len(w) >= 3 else frozenset([tuple(w)] if w else [])


def near_components(pairs: list[tuple]) -> dict:
    """(doc_id, text) -> component by comparing all pairs."""
    sets = {i: shingle_set(t) for i, t in pairs if i is not None}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, u in enumerate(ids):
        for v in ids[:k]:
            both = len(sets[u] & sets[v])
            if both and 100 * both >= 85 * (len(sets[u]) + len(sets[v]) - both):
                a, b = root(u), root(v)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in sets}
