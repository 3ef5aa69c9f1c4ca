import math
from collections import Counter
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from vitalgrid.operators.numbering import number_rows
from vitalgrid.operators.split import stratified_split


def split(spark, rows, share=0.2, order=None):
    df = spark.createDataFrame(rows, "label int, id int").repartition(5)
    got = stratified_split(df, "label", "id", share, order)
    return [tuple(r) for r in got.select("label", "id", "part").collect()]


def check(rows, got, share):
    assert Counter((l, i) for l, i, _ in got) == Counter(rows)
    sizes, test = Counter(l for l, _ in rows), Counter(l for l, _, p in got if p == "test")
    for label, n in sizes.items():
        assert test[label] == math.ceil(n * Decimal(str(share)))


def test_unique_ids(spark):
    rows = [(i % 3 % 2, i) for i in range(2000)]
    got = split(spark, rows)
    check(rows, got, 0.2)
    assert sorted(got) == sorted(split(spark, rows))


def test_one_id_holds_a_third(spark):
    rows = [(0, 7)] * 1000 + [(i % 2, 100 + i) for i in range(2000)]
    for share in (0.2, 0.5, 0.8):
        check(rows, split(spark, rows, share), share)


def test_all_rows_are_copies(spark):
    rows = [(1, 5)] * 101
    check(rows, split(spark, rows), 0.2)


def test_null_ids_and_labels(spark):
    rows = [(0, None)] * 50 + [(None, i) for i in range(30)] + [(0, i) for i in range(20)]
    check(rows, split(spark, rows), 0.2)


def test_order_column_decides(spark):
    got = split(spark, [(0, i) for i in range(100)], order=F.lit(99) - F.col("id"))
    assert sorted(i for _, i, p in got if p == "test") == list(range(80, 100))


def test_no_test_share(spark):
    assert {p for _, _, p in split(spark, [(0, 1), (1, 2)], 0.0)} == {"train"}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    rows=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 6)), min_size=1, max_size=60),
    share=st.sampled_from([0.1, 0.2, 0.5, 1.0]),
)
def test_shares_hold_with_any_copies(spark, rows, share):
    check(rows, split(spark, rows, share), share)


@pytest.mark.parametrize("values", [range(1000), [3] * 700 + list(range(300)), []])
def test_number_rows(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(7)
    rows = number_rows(df, ["v"], "n", total="t").orderBy("n").collect()
    assert [r.n for r in rows] == list(range(1, len(values) + 1))
    assert [r.v for r in rows] == sorted(values)
    assert {r.t for r in rows} <= {len(values)}


def test_many_classes(spark):
    rows = [(i % 1500, i) for i in range(4500)]
    check(rows, split(spark, rows, 0.5), 0.5)


def test_one_order_value_for_all(spark):
    rows = [(i % 2, i) for i in range(1000)]
    got = split(spark, rows, order=F.lit(5))
    check(rows, got, 0.2)
    assert max(i for l, i, p in got if p == "test") == 199
