"""Sampling against brute force, with hot classes and the ranks that only large inputs reach."""

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import sampling


def digest(key, purpose, seed=42):
    return hashlib.md5(f"{seed}|{purpose}|{key}".encode()).hexdigest()


def ranked(rows, purpose):
    return sorted(rows, key=lambda row: (digest(row[0], purpose), row[0]))


def table(spark, sizes):
    """(id, class) rows with the given class sizes; None is a missing class."""
    names = [name for name, size in sizes.items() for _ in range(size)]
    return spark.createDataFrame(list(enumerate(names)), "id long, class string"), list(enumerate(names))


HOT = {"hot": 3000, **{f"c{size}": size for size in range(1, 60)}, None: 40, " hot ": 7, "": 5}


@pytest.fixture(autouse=True, params=[(10**6, 100_000), (10, 12)])
def bucket_rows(request, monkeypatch):
    """Small classes alone, and large ones with so few buckets that it takes several rounds."""
    monkeypatch.setattr(sampling, "BUCKET_ROWS", request.param[0])
    monkeypatch.setattr(sampling, "MOST_BUCKETS", request.param[1])


@pytest.mark.parametrize("top_rows", [0, sampling.TOP_ROWS])
@pytest.mark.parametrize("low,high", [(20, 50), (0, 1), (30, 10), (0, 100000)])
def test_balance(spark, low, high, top_rows):
    df, rows = table(spark, HOT)
    classes = defaultdict(list)
    for row in rows:
        classes["Unknown" if row[1] is None else row[1].strip()].append((row[0],))
    expected = set()
    for name, members in classes.items():
        n = len(members) if len(members) <= low else min(len(members), high)
        expected |= {(key, name) for key, in ranked(members, "balance")[:n]}
    found = sampling.balance_classes(df, "class", "id", low, high, top_rows=top_rows).collect()
    assert len(found) == len(expected)
    assert {tuple(row) for row in found} == expected


def test_balance_does_not_depend_on_partitioning(spark):
    df, _ = table(spark, HOT)
    one = sampling.balance_classes(df.coalesce(1), "class", "id", 5, 25).collect()
    many = sampling.balance_classes(df.repartition(31, "id"), "class", "id", 5, 25, top_rows=0).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many))


@pytest.mark.parametrize("n", [0, 1, 2500, 4999, 6000])
def test_cap_is_exact(spark, n):
    df = spark.range(5000)
    found = sorted(row[0] for row in sampling.cap_rows(df, n, "id").collect())
    assert found == sorted(key for key, in ranked([(key,) for key in range(5000)], "cap")[:n])


def test_cap_filters_rows_where_they_are(spark):
    df = spark.range(5000).repartition(13)
    found = sampling.cap_rows(df, 16, "id")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Sort" not in plan and plan.count("Exchange") == 1
    assert found.rdd.getNumPartitions() == 13 and found.count() == 16


def test_rounds_reach_the_row_in_a_class_of_any_size(spark, monkeypatch):
    """With two buckets a round, all rounds are used and what is left is ranked."""
    monkeypatch.setattr(sampling, "BUCKET_ROWS", 1)
    monkeypatch.setattr(sampling, "MOST_BUCKETS", 2)
    found = sorted(row[0] for row in sampling.cap_rows(spark.range(900), 450, "id").collect())
    assert found == sorted(key for key, in ranked([(key,) for key in range(900)], "cap")[:450])


def test_cap_over_two_key_columns(spark):
    df = spark.range(3000).select(F.concat(F.lit("f"), F.col("id") % 3).alias("file"), (F.col("id") / 3).cast("int").alias("row"))
    found = sampling.cap_rows(df, 1500, ["file", "row"]).collect()
    expected = sorted(((f"f{at % 3}", at // 3) for at in range(3000)), key=lambda row: (digest(f"{row[0]}|{row[1]}", "cap"), row))
    assert {tuple(row) for row in found} == set(expected[:1500])


def split_of(members, val, test):
    """Splits by the documented ladder, in rank order."""
    n = len(members)
    if n <= 2:
        return ["train", "val"][:n]
    if n <= 5:
        n_val, n_test = 1, 1
    else:
        n_val, n_test = max(1, round(n * val)), max(1, round(n * test))
        if n_val + n_test >= n:
            n_val = max(1, (n - 1) // 2)
            n_test = max(1, n - 1 - n_val)
    return ["val"] * n_val + ["test"] * n_test + ["train"] * (n - n_val - n_test)


@pytest.mark.parametrize("val,test", [(0.05, 0.05), (0.5, 0.5), (0.1, 0.25), (0.0, 0.9)])
def test_split_ladder(spark, val, test):
    df, rows = table(spark, {name: size for name, size in HOT.items() if name != " hot "})
    classes = defaultdict(list)
    for key, name in rows:
        if name is not None:
            classes[name].append((key,))
    expected = {}
    for members in classes.values():
        order = ranked(members, "split")
        expected |= {key: split for (key,), split in zip(order, split_of(order, val, test))}
    found = sampling.stratified_split(df, "class", "id", val, test).collect()
    assert len(found) == len(expected)
    assert {row["id"]: row["split"] for row in found} == expected


def subset_of(rows, n):
    if len(rows) <= n:
        return set(rows)
    classes = defaultdict(list)
    for key, name in rows:
        if name is not None:
            classes[name].append((key, name))
    kept = []
    for members in classes.values():
        share = max(1, round(len(members) / len(rows) * n))
        kept += ranked(members, "subset")[: min(share, len(members))]
    return set(ranked(kept, "trim")[:n])


@pytest.mark.parametrize("n", [10, 200, 1500, 4000, 10**6])
def test_proportional_subset(spark, n):
    df, rows = table(spark, HOT)
    found = sampling.proportional_subset(df, n, "id", "class").collect()
    assert {tuple(row) for row in found} == subset_of(rows, n)
    assert len(found) <= max(n, 0)


def test_subset_of_all_and_first_column(spark):
    df, rows = table(spark, {"a": 300, "b": 30})
    assert sampling.proportional_subset(df, None, "id", "class").count() == 330
    first = sampling.proportional_subset(df.select("class", "id"), 33, "id").collect()
    assert {(row["id"], row["class"]) for row in first} == subset_of(rows, 33)


def test_draws_are_independent(spark):
    """Capping after balancing must not favour the classes that were thinned."""
    df, _ = table(spark, {"hot": 20000, **{f"s{at}": 40 for at in range(50)}})
    balanced = sampling.balance_classes(df, "class", "id", 20, 2000)
    capped = sampling.cap_rows(balanced, 2000, "id").collect()
    hot = Counter(row["class"] for row in capped)["hot"]
    assert len(capped) == 2000
    assert 900 < hot < 1100


def test_first_rows_in_order(spark):
    df = sampling.with_shuffle_key(spark.range(4000), "id")
    wanted = ranked([(key,) for key in range(4000)], "shuffle")
    for n in (7, 1800):
        for range_rows in (100, 10**6):
            found = sampling.first_rows_in_order(df, n, "id", "shuffle_key", range_rows).collect()
            assert {row["id"] for row in found} == {key for key, in wanted[:n]}
    assert {row["id"] for row in sampling.first_rows_in_order(df, 3, "id").collect()} == {0, 1, 2}
    assert sampling.first_rows_in_order(df, 0, "id").count() == 4000


@pytest.mark.parametrize("made", ["id * 7919 % 4001 - 2000", "IF(id % 5 = 0, NULL, id % 3)", "concat('g', id % 97)", "id / 7D"])
def test_first_rows_by_any_column(spark, made):
    df = spark.range(4000).selectExpr("id", f"{made} AS place")
    order = sorted(df.collect(), key=lambda row: (row.place is not None, row.place, row.id) if row.place is not None else (False, 0, row.id))
    for n in (1, 1234, 3999, 5000):
        found = sampling.first_rows_in_order(df, n, "id", "place", 300)
        assert "TakeOrdered" not in found._jdf.queryExecution().executedPlan().toString()
        assert {row.id for row in found.collect()} == {row.id for row in order[:n]}


def test_total_cap():
    assert sampling.total_cap() == 222222
