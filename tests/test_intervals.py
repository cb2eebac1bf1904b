"""Validity windows: the two ways to look one up give the same."""

import random
from datetime import date, timedelta

import pytest

from stardw.operators.intervals import window_at, window_carried
from stardw.plans import pricing
from stardw.queries import EARLY_LOAD, LATE_LOAD, client_history
from stardw.sources.retail_parquet import RetailParquet

FIRST = date(2000, 1, 1)


def same(one, other):
    assert one.columns == other.columns
    found = sorted(map(str, one.collect()))
    assert found == sorted(map(str, other.collect()))
    return found


@pytest.mark.parametrize("closed", [True, False])
def test_a_key_with_many_windows_spans_partitions(spark, closed):
    rng = random.Random(5)
    windows, at = [], FIRST
    for n in range(400):  # key 1 holds nearly all windows and rows
        length = rng.randint(1, 6)
        # Without the last day they may be empty; gaps come now and then.
        last = at + timedelta(days=length - 1 if closed else rng.choice([0, length]))
        windows.append((1, at, last, n))
        at = max(last, at) + timedelta(days=(1 if closed else 0) + rng.choice([0, 0, 3]))
    windows.append((1, at, None, 999))
    windows += [(k, FIRST + timedelta(days=k), None if k % 2 else FIRST + timedelta(days=400), k) for k in range(2, 9)]
    windows += [(None, FIRST, None, 7), (9, None, None, 8)]
    rows = [(i, 1 if i % 3 else rng.randint(1, 10), FIRST + timedelta(days=rng.randint(-5, 2500))) for i in range(3000)]
    rows += [(5000, None, FIRST), (5001, 1, None), (5002, 1, FIRST), (5002, 1, FIRST), (5003, 77, FIRST)]
    w = spark.createDataFrame(windows, "k int, a date, b date, v int")
    r = spark.createDataFrame(rows, "i int, k int, day date").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        carried = window_carried(r, w, "k", "day", start="a", end="b", values=["v", "a"], closed=closed)
        found = same(carried, window_at(r, w, "k", "day", start="a", end="b", first_by=["a", "v"],
                                        values=["v", "a"], spread=["i"], closed=closed))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(found) == len(rows) and sum("v=None" not in f for f in found) > 1000


def test_prices_and_versions_both_ways(spark):
    ops = RetailParquet(spark, "/root/testdata/sf0.001")
    assert len(same(pricing.price_at_date(ops), pricing.price_at_date(ops, carried=True))) > 5000
    history = client_history(ops, EARLY_LOAD, LATE_LOAD)
    assert len(same(pricing.client_version_at_date(ops["commande"], history),
                    pricing.client_version_at_date(ops["commande"], history, carried=True))) > 1000
