import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from matchlake.operators import merging
from matchlake.operators.merging import MergeLimits

SMALL, LARGE = MergeLimits(), MergeLimits(broadcast_rows=0)
SCHEMA = "k long, v string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def expected_insert(target, source):
    known = {k for k, _ in target if k is not None}
    return sorted(target + [r for r in source if r[0] not in known], key=str)


keyed = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.sampled_from("ab")))


@settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(keyed, keyed)
def test_insert_equals_brute_force_on_both_plans(spark, target, source):
    t, s = spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SCHEMA)
    for limits in (SMALL, LARGE):
        merged = merging.merge_insert_new(t, s, "k", limits)
        assert rows(merged) == expected_insert(target, source)


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(keyed, st.dictionaries(st.integers(0, 6), st.sampled_from("ab")))
def test_upsert_equals_brute_force_on_both_plans(spark, target, source):
    t = spark.createDataFrame(target, SCHEMA)
    s = spark.createDataFrame(list(source.items()), SCHEMA)
    expected = sorted([r for r in target if r[0] not in source] + list(source.items()), key=str)
    for limits in (SMALL, LARGE):
        assert rows(merging.merge_upsert(t, s, "k", limits)) == expected


def test_upsert_refuses_a_repeated_key_but_not_repeated_nulls(spark):
    t = spark.createDataFrame([(1, "a")], SCHEMA)
    with pytest.raises(ValueError, match="repeats a key"):
        merging.merge_upsert(t, spark.createDataFrame([(2, "x"), (2, "y")], SCHEMA), "k")
    nulls = spark.createDataFrame([(None, "x"), (None, "y")], SCHEMA)
    assert merging.merge_upsert(t, nulls, "k").count() == 3


def test_several_keys_and_column_order(spark):
    t = spark.createDataFrame([("x", 1, "a")], "v string, k long, j string")
    s = spark.createDataFrame([("y", 1, "a"), ("z", 1, "b")], "v string, k long, j string")
    for limits in (SMALL, LARGE):
        got = merging.new_rows(t, s, ["k", "j"], limits)
        assert got.columns == ["v", "k", "j"]
        assert rows(got) == [("z", 1, "b")]


def test_conditions(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)
    s = spark.createDataFrame([(1, "z"), (2, "a"), (3, "c")], SCHEMA)
    got = merging.new_rows_where(t, s, "target.k = source.k and target.v >= source.v")
    assert rows(got) == [(1, "z"), (3, "c")]
    as_column = F.expr("target.k = source.k and target.v >= source.v")
    assert rows(merging.new_rows_where(t.withColumn("w", F.lit(1)), s, as_column)) == rows(got)
    with pytest.raises(ValueError, match="equality"):
        merging.new_rows_where(t, s, "target.k < source.k")


def test_equality_keys():
    keys = merging.equality_keys
    assert keys("target.fixture_id = source.fixture_id") == ["fixture_id"]
    assert keys("source.a=target.a AND target.b = source.b") == ["a", "b"]
    for other in (
        "target.a = source.b",
        "target.a = target.a",
        "target.a = source.a or target.b = source.b",
        "target.a = source.a and target.b > source.b",
        F.expr("target.a = source.a"),
    ):
        assert keys(other) == []


def test_one_per_key(spark):
    df = spark.createDataFrame(
        [(1, "a", 1), (1, "b", 2), (None, "c", 1), (None, "c", 1)], "k long, v string, at int"
    )
    expected = [(1, "b", 2), (None, "c", 1), (None, "c", 1)]
    assert rows(merging.one_per_key(df, "k", "at")) == expected
    assert rows(merging.one_per_key(df, "k")) == expected
    dotted = df.withColumnRenamed("v", "v.w")
    assert merging.one_per_key(dotted, "k").columns == ["k", "v.w", "at"]


def _skewed(spark):
    """A third of the rows share one key, a third have none."""
    kind = F.col("id") % 3
    key = F.when(kind == 0, F.lit(7)).when(kind == 2, F.col("id"))
    return spark.range(0, 90_000, 1, 16).select(key.alias("k"), F.col("id").alias("v"))


@pytest.mark.parametrize("stored_hot", [True, False])
def test_hot_keys_and_null_keys_spread_over_tasks(spark, stored_hot):
    source = _skewed(spark)
    stored = spark.range(0, 90_000, 2, 8).select(F.col("id").alias("k"))
    if stored_hot:
        stored = stored.union(spark.range(7, 8))
    keyset = merging.distinct_keys(source.join(stored, "k", "left_anti"), "k")
    settings_ = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k) for k in settings_}
    try:
        for k, v in settings_.items():
            spark.conf.set(k, v)
        got = merging.rows_by_keyset(source, keyset, "k", True, LARGE)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [k" in plan and "__spread" in plan
        sizes = [r[1] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 30_000 + (0 if stored_hot else 30_000) + 15_000
    assert max(sizes) < 2.5 * sum(sizes) / 8


def test_equated_columns():
    same = "target.id = source.id"
    assert merging.equated(f"{same} and source.day = target.date") == [("id", "id"), ("day", "date")]
    assert merging.equated(f"({same}) and target.x between 1 and 2 and source.k = target.k") == [("k", "k")]
    assert merging.equated(f"{same} and target.name = ' and source.b = target.b '") == [("id", "id")]
    assert merging.equated(f"{same} or source.b = target.b") == []
    assert merging.equated(f"{same} and (source.b = target.b or target.c > 1)") == [("id", "id")]
    assert merging.equated("target.id = target.other") == [] == merging.equated(F.col("source.id") == F.col("target.id"))


@pytest.mark.parametrize("hot_share", [1e-4, 0.9])
def test_free_conditions_equal_brute_force_and_spread_hot_keys(spark, hot_share):
    """A third of the rows has one key, a third none; the rest of the condition decides."""
    source = spark.range(0, 6000, 1, 8).selectExpr(
        "case when id % 3 = 0 then 7 when id % 3 = 1 then null else id % 500 end as k", "id % 90 as v", "id"
    )
    stored = spark.range(0, 400, 1, 4).selectExpr("id % 300 as key", "id % 60 as low", "id as other")
    condition = "target.key = source.k and source.v between target.low and target.low + 5"
    settings_ = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in settings_}
    try:
        for k, v in settings_.items():
            spark.conf.set(k, v)
        got = merging.new_rows_where(stored, source, condition, merging.MergeLimits(hot_share=hot_share))
        assert ("__spread" in got._jdf.queryExecution().executedPlan().toString()) == (hot_share < 0.1)
        found = sorted((tuple(r) for r in got.collect()), key=str)
        sizes = [r[1] for r in got.filter("k = 7").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    kept = [(r["key"], r["low"]) for r in stored.collect()]
    expected = [
        tuple(r) for r in source.collect() if not any(r["k"] == key and low <= r["v"] <= low + 5 for key, low in kept)
    ]
    assert found == sorted(expected, key=str)
    assert (len(sizes) > 3) == (hot_share < 0.1)


def test_small_batch_does_not_shuffle_the_table(spark):
    target = spark.range(0, 100_000, 1, 8).selectExpr("id as k", "'t' as v")
    source = spark.range(99_990, 100_010).selectExpr("id as k", "'s' as v")
    got = merging.new_rows(target, source, "k")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
    # The table is filtered by the batch's keys before anything of it is exchanged.
    assert plan.index("LeftSemi, BuildRight") > plan.index("BroadcastHashJoin")
    assert rows(got) == [(k, "s") for k in range(100_000, 100_010)]


def test_key_profile(spark):
    df = spark.createDataFrame([(1, "ab"), (1, "ab"), (2, "é"), (None, "x")], SCHEMA)
    profile = merging.profile_keys(merging.key_copies(df, ["k", "v"]), ["k", "v"])
    assert (profile.rows, profile.distinct, profile.max_copies) == (3, 2, 2)
    assert profile.bytes == 8 + 2 + 8 + 2
    assert profile.ranges == (("k", 1, 2), ("v", "ab", "é"))
    assert profile.fits(SMALL) and not profile.fits(MergeLimits(broadcast_bytes=10))


def test_batch_range_reaches_the_table_scan(spark, tmp_path):
    spark.range(0, 1000).selectExpr("id as k", "'t' as v").write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    source = spark.createDataFrame([(990, "s"), (1005, "s"), (None, "s")], SCHEMA)
    for limits in (SMALL, LARGE):
        got = merging.new_rows(target, source, "k", limits)
        assert rows(got) == [(1005, "s"), (None, "s")]
    got = merging.new_rows(target, source, "k")
    scan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,990), LessThanOrEqual(k,1005)" in scan
    assert "ReadSchema: struct<k:bigint>" in scan
