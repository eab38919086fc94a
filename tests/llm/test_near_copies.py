"""Near copies with other shingles and thresholds, and the stage against plain versions."""

from __future__ import annotations

import random
import sys
from fractions import Fraction
from math import comb
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))
import corpus  # noqa: E402

import corpus_pipeline  # noqa: E402
from starloom.llm import nearcopies  # noqa: E402


def test_near_stage_takes_five_words_and_four_fifths(spark):
    rng = random.Random(11)
    fresh = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    data = []
    for i in range(0, 80, 4):  # a text, the same with 45 words more (a near copy), and one with five scattered edits (none)
        base = fresh(200)
        edited = list(base)
        for k in (20, 60, 100, 140, 180):
            edited[k] = f"e{i}"
        data += [(i, base), (i + 1, base + fresh(45)), (i + 2, edited), (i + 3, base[:4])]
    sets = {i: frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) for i, w in data}
    component = {i: i for i in sets}
    for _ in sets:  # least ids along links, until nothing changes
        before = dict(component)
        for i in sets:
            for j in sets:
                if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                    component[i] = min(component[i], component[j])
        if component == before:
            break
    docs = corpus.documents(spark, data=[(i, " ".join(w), None, None, 0) for i, w in data])
    kept = {r["doc_id"] for r in dict(corpus_pipeline.STAGES)["near dedup"](spark, docs, "").collect()}
    assert kept == {i for i in sets if component[i] == i} == {i for i in sets if i % 4 != 1}


def test_limits_of_the_comparisons_hold_at_other_thresholds():
    for percent in (80, 85, 100):
        met = (1 - (1 - (percent / 100) ** nearcopies.ROWS) ** nearcopies.keys_for(percent)) ** 2
        assert met > 0.99998
    assert nearcopies.keys_for(85) == 20 and nearcopies.keys_for(80) == 30


def test_comparisons_lose_less_than_one_link_in_a_billion():
    for percent in (80, 85):
        lost = Fraction(0)
        for values, planes in ((64 * nearcopies.BIT_WORDS, nearcopies.PLANES), (64 * nearcopies.LONG_WORDS, nearcopies.LONG_PLANES)):
            p = Fraction(100 - percent, 100) * (1 - Fraction(1, 2**planes))
            most = nearcopies.most_differing(values, planes, percent)
            lost += sum(comb(values, k) * p**k * (1 - p) ** (values - k) for k in range(most + 1, values + 1))
        assert lost < Fraction(1, 10**9)


def test_rows_that_share_an_id(spark):
    rng = random.Random(12)
    fresh = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    near = lambda w: " ".join([*w, *fresh(4)])
    first, second, alone, twin = fresh(200), fresh(200), " ".join(fresh(200)), fresh(200)
    data = [(7, near(first)), (7, near(second)), (3, near(first)), (9, near(second)), (12, " ".join(second)),  # id 7 in two groups
            (20, near(first)), (20, alone),  # one of id 20's texts stays
            *[(30, " ".join(twin))] * 40, (31, near(twin)), (31, " ".join(twin))]  # repeats of a row
    docs = corpus.documents(spark, data=[(i, t, None, None, 0) for i, t in data])
    got = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in nearcopies.near_copies(docs).collect())
    want = [(7, 3, False), (7, 7, True), (3, 3, True), (9, 7, False), (12, 7, False), (20, 3, False), (20, 20, True),
            *[(30, 30, True)] * 40, (31, 30, False), (31, 30, False)]
    assert got == sorted(want)
    stay = [(r["doc_id"], r["text"]) for r in nearcopies.without_near_copies(docs).collect()]
    assert sorted(stay) == sorted(d for d, w in zip(data, want) if w[2])


def test_exploded_rows_are_not_broadcast(spark, monkeypatch):
    plans = {}

    def recorded(df, label, *args, **options):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return stored(df, label, *args, **options)

    stored = nearcopies.durable
    monkeypatch.setattr(nearcopies, "durable", recorded)
    rng = random.Random(12)
    base = [f"w{k}" for k in range(60)]
    data = [(i, " ".join(w if rng.random() < 0.99 else f"e{i}" for w in base), None, None, 0) for i in range(30)]
    nearcopies.near_copies(corpus.documents(spark, data=data)).collect()
    # a row of the tables' input stands for KEYS^2 rows, one of a bucket for as many as it has blocks: the planner's sizes know of neither
    for label, join in (("near-pairs", "Join [table#"), ("near-pairs-2", "Join [a_key#")):
        kinds = {line.split(join)[0].split()[-1] for line in plans[label].splitlines() if join in line}
        assert kinds == {"SortMerge"}, (label, kinds)
