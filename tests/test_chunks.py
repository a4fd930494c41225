import random
import re
import time
import uuid
from collections import Counter
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tablelift.operators import chunks
from tablelift.operators.chunks import (
    assign_chunks,
    chunk_plan,
    find_chunk_limits,
    key_index,
    page,
    page_by_row_number,
    page_sweep,
    slice_rows,
    union_chunks,
    with_row_index,
)
from tablelift.plans.ranges import KeyRanges, OrderKey, find_ranges


def index_of(df, order, **more):
    return {tuple(r)[:-1]: r["row_index"] for r in with_row_index(df, order, **more).collect()}


def test_plan_of_a_large_table(spark):
    plan = chunk_plan(spark.range(22_000_000), 80_000)
    found = plan.orderBy("chunk_number").collect()
    assert len(found) == 275
    assert [r.chunk_offset for r in found[:3]] == [0, 80_000, 160_000]
    assert sum(r.chunk_rows for r in found) == 22_000_000


def test_plan_of_nothing(spark):
    assert chunk_plan(spark.range(0), 10).count() == 0


def test_size_must_be_positive(spark):
    with pytest.raises(ValueError, match="at least 1"):
        assign_chunks(spark.range(5), ["id"], 0)


@pytest.mark.parametrize("size", [1, 99, 100, 101, 300])
def test_chunks_are_disjoint_and_complete(spark, size):
    frame = spark.range(100).select((F.col("id") * 7 % 100).alias("k"), F.lit("x").alias("v"))
    got = assign_chunks(frame, ["k"], size).collect()
    assert {r.k: r.chunk_number for r in got} == {k: k // size + 1 for k in range(100)}


def test_empty_table(spark):
    empty = spark.range(0)
    assert assign_chunks(empty, ["id"], 10).count() == 0
    assert with_row_index(empty, ["id"], ties="all_columns").count() == 0
    assert page(empty, ["id"], 20_000, 5).count() == 0
    assert page_by_row_number(empty, ["id"], 0, 5).count() == 0


ORDERED = {
    "bigint": [None, -5, 0, 3, 10**15],
    "string": [None, "", "A", "a", "z\ufffd", "á"],
    "double": [float("-inf"), -1.5, 0.0, 2.5, float("inf"), float("nan")],
    "timestamp": [None, datetime(1969, 12, 31), datetime(2024, 3, 31, 1, 30), datetime(2024, 3, 31, 1, 30, 0, 1)],
    "timestamp_ntz": [None, datetime(1969, 12, 31), datetime(2024, 3, 31, 2, 30), datetime(2024, 3, 31, 2, 30, 0, 1)],
    "date": [None, datetime(1900, 1, 1).date(), datetime(2024, 1, 1).date()],
    "decimal(12,2)": [None, Decimal("-1.10"), Decimal("0.00"), Decimal("7.25")],
    "binary": [None, b"", b"\x00", b"\x7f", b"\xff"],
    "boolean": [None, False, True],
}


@pytest.mark.parametrize("kind", ORDERED)
def test_keys_of_every_type(spark, kind):
    values = ORDERED[kind]
    shuffled = [(v, i) for i, v in enumerate(values)]
    random.Random(3).shuffle(shuffled)
    frame = spark.createDataFrame(shuffled, f"k {kind}, place int")
    assert all(r.row_index == r.place for r in with_row_index(frame, ["k"]).collect())
    numbers = assign_chunks(frame, ["k"], 2).collect()
    assert all(r.chunk_number == r.place // 2 + 1 for r in numbers)
    limits = find_chunk_limits(frame, ["k"], 2)
    for n in range(1, limits.chunks + 1):
        assert sorted(r.place // 2 + 1 for r in frame.filter(limits.within(n, n)).collect()) == [n] * len(
            values[2 * n - 2 : 2 * n]
        )


def test_composite_key_with_a_hot_first_column(spark):
    data = [(0 if i % 3 else i, None if i == 4 else i) for i in range(3000)]
    random.Random(1).shuffle(data)
    frame = spark.createDataFrame(data, "hot long, k long")
    order = sorted(data, key=lambda r: (r[0], r[1] is not None, r[1] or 0))
    assert index_of(frame, ["hot", "k"]) == {r: i for i, r in enumerate(order)}
    ranges = find_ranges(frame, ["hot", "k"])
    assert max(ranges.rows) < 1000  # the hot value alone has 2,000 rows
    assert ranges.total == 3000
    got = assign_chunks(frame, ["hot", "k"], 700).collect()
    assert {(r.hot, r.k): r.chunk_number for r in got} == {r: i // 700 + 1 for i, r in enumerate(order)}
    limits = find_chunk_limits(frame, ["hot", "k"], 700)
    for n in range(1, limits.chunks + 1):
        expected = order[(n - 1) * 700 : n * 700]
        assert Counter(map(tuple, frame.filter(limits.within(n, n)).collect())) == Counter(expected)


def test_equal_keys_are_an_error(spark):
    frame = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    with pytest.raises(Exception, match="not unique"):
        with_row_index(frame, ["k"]).collect()
    with pytest.raises(Exception, match="not unique"):
        assign_chunks(frame, ["k"], 1).collect()


def test_ties_are_broken_by_all_columns(spark):
    data = [(i % 4, i % 7) for i in range(1000)] + [(2, 2)] * 500
    frame = spark.createDataFrame(data, "a int, b int")
    order = sorted(data)
    got = sorted((r.row_index, (r.a, r.b)) for r in with_row_index(frame, ["a"], ties="all_columns").collect())
    assert got == list(enumerate(order))
    numbers = assign_chunks(frame, ["a"], 37, ties="all_columns")
    expected = Counter((row, i // 37 + 1) for i, row in enumerate(order))
    for _ in range(2):
        assert Counter(((r.a, r.b), r.chunk_number) for r in numbers.collect()) == expected


def test_many_copies_are_written_in_runs(spark, monkeypatch):
    monkeypatch.setattr(chunks, "COPIES_PER_RUN", 100)
    data = [(5,)] * 1050 + [(1,)] * 100 + [(9,)] * 101 + [(7,)]
    frame = spark.createDataFrame(data, "k int")
    got = sorted((r.row_index, r.k) for r in with_row_index(frame, ["k"], ties="all_columns").collect())
    assert got == list(enumerate(sorted(k for (k,) in data)))


@pytest.mark.parametrize("size", [1, 3, 10, 99, 1000])
def test_numbers_do_not_need_the_limits_on_the_driver(spark, size):
    frame = spark.range(100).selectExpr("id", "CASE WHEN id > 0 THEN id * 7 END AS k")
    expected = {i: i // size + 1 for i in range(100)}
    assert {r.id: r.chunk_number for r in assign_chunks(frame, ["k"], size).collect()} == expected
    limits = find_chunk_limits(frame, ["k"], size)
    assert {r.id: r.chunk_number for r in limits.number(frame).collect()} == expected


def test_filter_join_and_group_on_very_many_chunks(spark):
    frame = spark.range(100_000)
    for numbered in (assign_chunks(frame, ["id"], 2), find_chunk_limits(frame, ["id"], 2).number(frame)):
        start = time.perf_counter()
        assert sorted(r.id for r in numbered.filter("chunk_number = 40000").collect()) == [79998, 79999]
        assert numbered.groupBy("chunk_number").count().filter("count = 2").count() == 50_000
        wanted = spark.createDataFrame([(7,), (50_000,)], "chunk_number bigint")
        assert sorted(r.id for r in numbered.join(wanted, "chunk_number").collect()) == [12, 13, 99998, 99999]
        assert time.perf_counter() - start < 60


@pytest.mark.parametrize("offset", [0, 100, 12_000])
def test_equal_keys_are_an_error_on_any_page(spark, offset):
    frame = spark.range(15_000).selectExpr("id div 2 AS k")
    with pytest.raises(Exception, match="not unique"):
        page(frame, ["k"], offset, 50).collect()


@pytest.mark.parametrize("offset, limit", [(0, 0), (0, 10), (1490, 100), (1500, 5), (0, 3000)])
def test_pages(read, offset, limit):
    orders = read("orders")
    expected = sorted((tuple(r) for r in orders.collect()), key=lambda r: r[0])[offset : offset + limit]
    assert rows(page(orders, ["o_orderkey"], offset, limit)) == sorted(expected, key=repr)
    assert rows(page_by_row_number(orders, ["o_orderkey"], offset, offset + limit)) == sorted(expected, key=repr)
    sliced = slice_rows(orders, ["o_orderkey"], offset, limit).collect()
    assert {r.row_index for r in sliced} == set(range(offset, min(offset + limit, 1500)))


def test_late_page_reads_its_ranges_only(read):
    late = page_by_row_number(read("orders"), ["o_orderkey"], 1400, 1450)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(o_orderkey" in late
    assert "TakeOrdered" not in late


def test_sweep_and_union_give_the_table(read):
    orders = read("orders")
    assert rows(page_sweep(orders, ["o_orderkey"], 400).drop("page_number")) == rows(orders)
    limits = find_chunk_limits(orders, ["o_orderkey"], 400)
    parts = [orders.filter(limits.within(n, n)) for n in range(1, limits.chunks + 1)]
    assert [p.count() for p in parts] == [400, 400, 400, 300]
    assert rows(union_chunks(parts)) == rows(orders)


def test_chunk_numbers_need_no_shuffle_of_the_rows(read):
    """Only keys and chunk openers move while these are few enough for Spark to send them to the rows."""
    plan = assign_chunks(read("orders"), ["o_orderkey"], 100)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    for exchange in plan.split("Exchange")[1:]:
        assert "o_totalprice" not in exchange.split("Arguments")[0].split("[plan_id")[0]
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_zoned_timestamps_in_a_folding_hour(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Madrid")
    try:
        start = 1729987200  # 2024-10-27 00:00 UTC; the local hour from 2 to 3 occurs twice
        frame = spark.range(200).select(F.timestamp_seconds(F.lit(start) + F.col("id") * 60).alias("t"), "id")
        assert all(r.chunk_number == r.id // 7 + 1 for r in assign_chunks(frame, ["t"], 7).select("id", "chunk_number").collect())
        limits = find_chunk_limits(frame, ["t"], 50)
        assert [frame.filter(limits.within(n, n)).agg(F.min("id"), F.max("id")).first()[:] for n in (1, 2, 3, 4)] == [
            (0, 49), (50, 99), (100, 149), (150, 199),
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_order_needs_a_column(spark):
    with pytest.raises(ValueError, match="at least one column"):
        OrderKey(spark.range(1).schema, [])


def test_string_keys_with_quotes(spark):
    start = datetime(2024, 1, 1)
    data = [(f"it's {i:04d} \\ \"q\"", start + timedelta(days=i)) for i in range(500)]
    frame = spark.createDataFrame(data, "k string, d timestamp_ntz")
    limits = find_chunk_limits(frame, ["k", "d"], 120)
    assert [frame.filter(limits.within(n, n)).count() for n in range(1, 6)] == [120, 120, 120, 120, 20]


def jobs_of(spark, work):
    """What ``work`` gives, and how many jobs it took."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_a_stored_index_spares_the_passes(spark, read, tmp_path):
    place = f"{tmp_path}/orders"
    read("orders").repartitionByRange(8, "o_orderkey").write.parquet(place)
    orders, folder = spark.read.parquet(place), f"{tmp_path}/index"
    expected = [r.o_orderkey for r in orders.orderBy("o_orderkey").collect()]
    index, made = jobs_of(spark, lambda: key_index(orders, ["o_orderkey"], folder))
    assert made >= 3
    again, jobs = jobs_of(spark, lambda: key_index(orders, ["o_orderkey"], folder))
    assert jobs == 0 and (again.splits, again.rows, again.key.names) == (index.splits, index.rows, index.key.names)
    second = page(orders, ["o_orderkey"], 100, 50, again)
    found, jobs = jobs_of(spark, lambda: sorted(r.o_orderkey for r in second.collect()))
    assert found == expected[100:150] and jobs <= 3  # stages of one query: bounds, shuffle, result
    plan = second._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"DataFilters: \[.*o_orderkey#\d+L (>=|<) \d+", plan)
    assert page_by_row_number(orders, ["o_orderkey"], 100, 150, again).count() == 50
    assert slice_rows(orders, ["o_orderkey"], 1490, 50, again).count() == 10
    with pytest.raises(ValueError, match="the index is one of"):
        page(orders, ["o_custkey"], 0, 5, again)
    read("orders").limit(1).write.mode("append").parquet(place)
    changed, jobs = jobs_of(spark, lambda: key_index(spark.read.parquet(place), ["o_orderkey"], folder))
    assert jobs >= 3 and changed.total == 1501


@pytest.mark.parametrize("kind", ["date", "timestamp", "string", "decimal(9,2)", "double", "binary"])
def test_an_index_keeps_keys_of_all_types(spark, kind):
    key = {"date": "date_add(date'1990-01-01', cast(id as int))", "timestamp": "timestamp_seconds(id)", "binary": "cast(lpad(id, 9, '0') as binary)"}
    df = spark.range(500).selectExpr(f"{key.get(kind, f'cast(id as {kind})')} AS k", "id")
    ranges = find_ranges(df, ["k", "id"])
    back = KeyRanges.from_bytes(df.schema, ranges.as_bytes())
    assert (back.splits, back.rows) == (ranges.splits, ranges.rows) and len(back.splits) > 1


def test_rows_without_files_need_a_version(spark, tmp_path):
    with pytest.raises(ValueError, match="version"):
        key_index(spark.range(5), ["id"], str(tmp_path))
    assert key_index(spark.range(5), ["id"], str(tmp_path), version="1").total == 5


def test_split_points_are_short(spark):
    df = spark.range(2000).selectExpr("concat(repeat('x', 300 + id % 2), lpad(id, 6, '0')) AS k", "repeat('wide', 1000) AS w")
    ranges = find_ranges(df, ["k"])
    assert all(len(s[0]) <= 256 for s in ranges.splits) and ranges.total == 2000
    order = sorted(r.k for r in df.select("k").collect())
    assert [r.k for r in with_row_index(df.select("k"), ["k"]).orderBy("row_index").collect()] == order


@pytest.mark.parametrize("tied_rows", [10, 200_000])
def test_ties_are_cut_only_where_they_are(spark, monkeypatch, tied_rows):
    monkeypatch.setattr("tablelift.operators.chunks.TIED_ROWS", tied_rows)
    some = [(k, k % 3, f"t{k % 5}", [k % 2]) for k in range(300)]
    hot = [(150, k % 7, f"t{k % 11}", [k % 3]) for k in range(2000)] + [(150, 1, "same", [1])] * 500 + [(None, 2, "n", [0])] * 50
    df = spark.createDataFrame(some + hot, "k int, a int, t string, l array<int>").repartition(7)
    got = [tuple(r) for r in with_row_index(df, ["k"], ties="all_columns").orderBy("row_index").collect()]
    rows_in_order = sorted(some + hot, key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))
    assert [r[-1] for r in got] == list(range(len(rows_in_order)))
    assert [r[:-1] for r in got] == rows_in_order
