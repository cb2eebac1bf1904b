import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stardw.operators import ranking, skew
from stardw.operators.keys import extend_key_map
from stardw.session import local_rows


def test_rank_by_key_over_sparse_and_extreme_keys(spark):
    rng = random.Random(3)
    numbers = {0, 1, 2, -1, -5, 2**62, 2**62 + 1, -2**62, 2**20, 2**20 - 1, 2**40, 2**40 + 7}
    numbers |= {rng.randrange(-2**50, 2**50) for _ in range(200)} | set(range(5000, 5300))
    rows = local_rows(spark, [(n,) for n in numbers], "k bigint").repartition(5)
    got = {r.k: r.rang for r in ranking.rank_by_key(rows, "k", "rang").collect()}
    assert got == {n: i for i, n in enumerate(sorted(numbers), 1)}


def test_number_by_range_splits_one_large_group(spark):
    rows = (spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 2).alias("g"),
        (F.col("id") * 7919 % 10_007).alias("o"), F.col("id").alias("x")))
    numbered = ranking.number_by_range(rows, ["g"], ["o", "x"], "n")
    expected = {}
    groups = {}
    for r in sorted(rows.collect(), key=lambda r: (r.o, r.x)):
        groups[r.g] = groups.get(r.g, 0) + 1
        expected[r.x] = groups[r.g]
    assert {r.x: r.n for r in numbered.collect()} == expected


def test_ranks_in_groups_share_one_sort(spark):
    rows = [(i, "x" if i % 10 else None, i % 3, (i * 7919) % 200) for i in range(500)]
    df = spark.createDataFrame(rows, "i int, g string, h int, o int").repartition(7)
    found = ranking.ranks_in_groups(df, {"rg": "g", "rh": "h"}, [F.desc("o"), F.asc("i")])
    assert found.columns == ["i", "g", "h", "o", "rg", "rh"]
    for column, rank in (("g", "rg"), ("h", "rh")):
        wanted, seen = {}, {}
        for r in sorted(rows, key=lambda r: (-r[3], r[0])):
            value = r[1] if column == "g" else r[2]
            seen[value] = wanted[r[0]] = seen.get(value, 0) + 1
        assert {r.i: r[rank] for r in found.collect()} == wanted
    assert ranking.ranks_in_groups(df.limit(0), {"rg": "g"}, [F.asc("i")]).count() == 0


def test_number_by_range_of_identical_rows(spark):
    rows = spark.range(5000).select(F.lit(1).alias("g"), F.lit(2).alias("o"))
    numbers = [r.n for r in ranking.number_by_range(rows, ["g"], ["o"], "n").collect()]
    assert sorted(numbers) == list(range(1, 5001))


def test_hot_groups_are_numbered_like_the_others(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") < 1000, 7).otherwise(F.col("id") % 50).cast("long").alias("g"),
        (F.col("id") * 31 % 3001).alias("o"))
    plain = ranking.number_in_groups(rows, "g", ["o"], "n")
    split = ranking.number_in_groups(rows, "g", ["o"], "n", hot=[7])
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, split.collect()))


def test_hot_keys_finds_heavy_keys_only(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"))
    hot = skew.hot_keys(rows, "k", min_rows=1000)
    assert list(hot) == [5] and 9_000 <= hot[5] <= 11_000
    assert skew.hot_keys(rows, "k") == {}
    assert skew.hot_keys(rows.limit(0), "k", min_rows=1) == {}
    assert skew.hot_keys(spark.sql("select cast(null as bigint) k"), "k", min_rows=1) == {}
    mixed = rows.unionByName(spark.range(500).select(F.lit(None).cast("bigint").alias("k")))
    assert list(skew.hot_keys(mixed, "k", min_rows=1000)) == [5]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_is_exact(spark, how):
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 40).alias("k"),
        F.col("id").alias("x"))
    facts = facts.unionByName(spark.sql("select cast(null as bigint) k, 9999L x"))
    lookup = spark.range(30).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    plain = facts.join(lookup, "k", how)
    salted = skew.salted_join(facts, lookup, "k", how, {5: 7, 6: 2}, ["x"])
    assert Counter(map(tuple, plain.collect())) == Counter(
        map(tuple, salted.select(*plain.columns).collect()))


def test_lookup_join_salts_beyond_the_broadcast_limit(spark):
    facts = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 100).alias("k"),
        F.col("id").alias("x"))
    lookup = spark.range(100).select(F.col("id").alias("k"), F.col("id").alias("v"))
    expected = Counter(map(tuple, facts.join(lookup, "k").collect()))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not skew.fits_broadcast(lookup)
        found = []

        def hot():
            found.append(skew.hot_keys(facts, "k", min_rows=500))
            return found[0]

        joined = skew.lookup_join(facts, lookup, "k", spread=["x"], hot=hot)
        assert list(found[0]) == [1]
        assert "_salt" in joined._jdf.queryExecution().toString()
        assert Counter(map(tuple, joined.select("k", "x", "v").collect())) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_key_map_keeps_known_keys(spark):
    first = local_rows(spark, [(30,), (10,)], "id bigint")
    second = local_rows(spark, [(5,), (10,), (40,), (20,)], "id bigint")
    one = extend_key_map(None, first, "id", "cle")
    two = extend_key_map(one, second, "id", "cle")
    assert {r.id: r.cle for r in two.collect()} == {10: 1, 30: 2, 5: 3, 20: 4, 40: 5}
