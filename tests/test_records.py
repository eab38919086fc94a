"""Multi-line CSV files read by several tasks give what one task reads."""

from __future__ import annotations

import random

import pytest

from starloom.schemas import RAW_COLUMNS, raw_schema
from starloom.sources.extracts import read_extract
from starloom.sources.records import records

HEADER = ",".join(RAW_COLUMNS["order_reviews"])


def quoted(value: str) -> str:
    return '"' + value.replace('"', '""') + '"'


def review_lines(rng: random.Random, n: int) -> list[str]:
    """Rows with line breaks, doubled quotes, commas, carriage returns and empty values; every fortieth message is long."""
    out = []
    for i in range(n):
        words = [rng.choice(["good", 'so "so"', "a,b", "né\nnext line", "x\r\ny", "", "\n\n", '"', "end"]) for _ in range(rng.randint(0, 6) + (3000 if i % 40 == 7 else 0))]
        message = " ".join(words)
        cells = [f"r{i:05d}", f"o{i}", rng.choice(["1", "5", ""]), rng.choice(['""', "", quoted("title, with comma")]), quoted(message) if message else "",
                 '"2018-01-01 00:00:00"', "2018-01-02 10:00:00"]
        out.append(",".join(cells))
    return out


def one_task(spark, path):
    return spark.read.schema(raw_schema("order_reviews")).options(header=True, enforceSchema=True, quote='"', escape='"', mode="FAILFAST", multiLine=True).csv(path)


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda size: (spark.conf.set("spark.sql.files.maxPartitionBytes", str(size)), spark.conf.set("spark.sql.files.openCostInBytes", "0"))
    for k, v in before.items():
        spark.conf.set(k, v)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_splits_do_not_change_the_rows(spark, tmp_path, small_splits, seed):
    rng, path = random.Random(seed), str(tmp_path / "a_order_reviews_dataset.csv")
    body = "\n".join([HEADER, *review_lines(rng, 300)]) + ("\n" if seed % 2 else "")
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(("﻿" if seed == 2 else "") + body)
    expected = rows(one_task(spark, path))
    assert len(expected) == 300
    for size in (10_000_000, len(body.encode()) // 4 + 1, 997, 20_011):
        small_splits(size)
        assert rows(read_extract(spark, "order_reviews", path)) == expected


def test_every_split_is_a_task(spark, tmp_path, small_splits):
    path = str(tmp_path / "order_reviews_dataset.csv")
    body = "\n".join([HEADER, *review_lines(random.Random(5), 400)])
    (tmp_path / "order_reviews_dataset.csv").write_text(body, encoding="utf-8", newline="")
    small_splits(len(body.encode()) // 4 + 1)
    splits = spark.read.text(path).rdd.getNumPartitions()
    assert splits >= 4 > one_task(spark, path).rdd.getNumPartitions()
    # a task per split for whole records, and others that join what crosses splits
    assert read_extract(spark, "order_reviews", path).rdd.getNumPartitions() >= splits
    small_splits(10_000_000)
    assert read_extract(spark, "order_reviews", path).count() == 400


def test_several_files_each_with_its_header(spark, tmp_path, small_splits):
    for k in range(3):
        (tmp_path / f"{k}_order_reviews_dataset.csv").write_text("\r\n".join([HEADER, *[f"r{k}{i},o{i},5,,\"two\nlines\",a,b" for i in range(50 * k)], ""]), newline="")
    pattern = f"{tmp_path}/*_order_reviews_dataset.csv"
    small_splits(301)
    got = read_extract(spark, "order_reviews", pattern)
    assert rows(got) == rows(one_task(spark, pattern)) and got.count() == 150
    assert {r.review_comment_message for r in got.collect()} == {"two\nlines"}


def test_empty_lines_and_files(spark, tmp_path, small_splits):
    (tmp_path / "x.csv").write_text(HEADER + "\n\n\nr,o,5,,m,a,b\n\n", newline="")
    (tmp_path / "y.csv").write_text("", newline="")
    (tmp_path / "z.csv").write_text(HEADER, newline="")
    assert [r.record for r in records(spark, f"{tmp_path}/x.csv").collect()] == ["r,o,5,,m,a,b"]
    assert records(spark, f"{tmp_path}/x.csv", header=False).count() == 2
    assert records(spark, f"{tmp_path}/[yz].csv").isEmpty()


def test_short_and_long_rows_raise(spark, tmp_path):
    for k, row in enumerate(["r,o,5", "r,o,5,,m,a,b,c"]):
        path = tmp_path / f"{k}.csv"
        path.write_text(f"{HEADER}\n{row}\n")
        with pytest.raises(Exception, match="(?i)malformed"):
            read_extract(spark, "order_reviews", str(path)).collect()
