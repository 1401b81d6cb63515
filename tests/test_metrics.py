import statistics
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from matchlake.operators import enrich, metrics
from matchlake.plans.gold import refresh_counts, stored_metrics

SCHEMA = (
    "goals_home long, goals_away long, league_season int, fixture_status_elapsed long"
)


def played(spark, rows):
    return (
        spark.createDataFrame(rows, SCHEMA)
        .transform(enrich.match_winner)
        .transform(enrich.total_goals)
    )


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_empty_table(spark):
    df = played(spark, [])
    assert rows(metrics.row_count(df)) == [(0,)]
    assert rows(metrics.goals_sum(df)) == [(0,)]
    assert rows(metrics.goals_stats(df)) == [(None, None, None, None)]
    assert rows(metrics.goals_histogram(df)) == []
    assert rows(metrics.result_distribution(df)) == [
        (0, "Local", 0, None),
        (1, "Empate", 0, None),
        (2, "Visitante", 0, None),
    ]
    assert rows(metrics.goals_by_condition(df)) == [("Local", 0), ("Visitante", 0)]


def test_unplayed_matches_only(spark):
    df = played(spark, [(None, None, 2024, None)] * 3)
    assert rows(metrics.row_count(df)) == [(3,)]
    assert rows(metrics.goals_stats(df)) == [(None, None, None, None)]
    assert rows(metrics.results_by_season(df)) == [(2024, 0, 0, 0)]
    assert rows(metrics.distinct_values(df, "match_winner")) == [(None,)]
    assert rows(metrics.value_counts(df, "match_winner")) == []


def test_single_match_has_no_deviation(spark):
    df = played(spark, [(1, 2, 2024, 90)])
    assert rows(metrics.goals_stats(df)) == [(3.0, 3.0, 3, None)]


def test_mode_is_the_smallest_of_ties_and_median_interpolates(spark):
    df = played(spark, [(3, 0, 1, 1), (3, 0, 1, 1), (1, 0, 1, 1), (1, 0, 1, 1)])
    assert rows(metrics.goals_stats(df)) == [(2.0, 2.0, 1, 1.15)]


def test_histogram_keeps_empty_bins(spark):
    df = played(spark, [(0, 0, 1, 1), (2, 1, 1, 1), (3, 0, 1, 1), (None, 1, 1, 1)])
    assert sorted(rows(metrics.goals_histogram(df))) == [(0, 1), (1, 0), (2, 0), (3, 2)]


def test_value_counts_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "v string")
    assert rows(metrics.value_counts(df, "v")) == [("c", 2), ("a", 1), ("b", 1)]


def test_profiles(spark):
    df = spark.createDataFrame([(1, None), (1, "x")], "`a.b` int, c string")
    assert rows(metrics.null_counts(df)) == [("a.b", 0), ("c", 1)]
    assert rows(metrics.n_unique(df, ["a.b", "c"])) == [("a.b", 1), ("c", 1)]
    assert rows(metrics.n_unique(df, ["a.b"], approximate=True)) == [("a.b", 1)]
    assert rows(metrics.column_profile(df)) == [
        (0, "a.b", "int", 2),
        (1, "c", "string", 1),
    ]


def test_approximate_stats(spark):
    df = spark.range(1001).selectExpr("cast(id as double) as v")
    assert rows(metrics.approximate_stats(df, "v")) == [(500.0, 500.0, 289.11)]


@pytest.mark.parametrize("hot", ["none", "below", "middle", "above"])
@pytest.mark.parametrize("size", [4000, 4001])
def test_exact_median_of_many_values(spark, hot, size):
    """With a third of the rows on one value, and narrowing forced by a small ``few``."""
    at = {"below": -1.0, "middle": size * 0.5, "above": size * 2.0}
    values = [float((i * 7919) % size) for i in range(size)]
    if hot != "none":
        values += [at[hot]] * (size // 2)
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    assert metrics.exact_median(df, "v", few=20) == statistics.median(values)


def test_exact_median_of_nothing(spark):
    assert metrics.exact_median(spark.createDataFrame([(None,)], "v double"), "v") is None
    assert metrics.exact_median(spark.createDataFrame([(3,), (4,)], "v int"), "v") == 3.5


goal = st.one_of(st.none(), st.integers(0, 7))


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.tuples(goal, goal, st.integers(2019, 2022), goal), min_size=1, max_size=40))
def test_metrics_from_counts_equal_brute_force(spark, data):
    df = played(spark, data)
    got = {name: rows(frame) for name, frame in metrics.gold_metrics(df).items()}
    totals = [h + a for h, a, _, _ in data if h is not None and a is not None]
    outcome = [
        ("Local" if h > a else "Visitante" if h < a else "Empate", season)
        for h, a, season, _ in data
        if h is not None and a is not None
    ]
    assert got["row_count"] == [(len(data),)]
    assert got["goals_sum"] == [(sum(totals),)]
    seasons = sorted({s for _, _, s, _ in data})
    assert got["results_by_season"] == [
        (s, *[outcome.count((r, s)) for r in ("Local", "Empate", "Visitante")]) for s in seasons
    ]
    assert sum(n for _, n in got["goals_histogram"]) == len(totals)
    assert sorted(got["value_counts"]) == sorted(Counter(r for r, _ in outcome).items())
    assert got["elapsed_counts"] == sorted(
        Counter(e for *_, e in data if e is not None).items()
    )
    if totals:
        mean, median, mode, std = got["goals_stats"][0]
        assert mean == pytest.approx(statistics.mean(totals), abs=0.0051)
        assert median == statistics.median(totals)
        assert mode == min(statistics.multimode(totals))
        if len(totals) > 1:
            assert std == pytest.approx(statistics.stdev(totals), abs=0.0051)


def test_histogram_of_one_very_large_value(spark):
    df = spark.createDataFrame([(1,), (3_000_000,)], "total_goals long")
    bins = metrics.goals_histogram(df)
    assert bins.count() == 3_000_001
    assert rows(bins.filter("matches > 0").orderBy("goals")) == [(1, 1), (3_000_000, 1)]


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "total_goals double")
    assert rows(metrics.null_counts(df)) == [("total_goals", 2)]
    assert rows(metrics.n_unique(df, ["total_goals"])) == [("total_goals", 1)]
    assert rows(metrics.column_profile(df)) == [(0, "total_goals", "double", 1)]
    assert rows(metrics.goals_sum(df)) == [(1.0,)]
    assert rows(metrics.value_counts(df, "total_goals")) == [(1.0, 1)]
    assert rows(metrics.goals_stats(df)) == [(1.0, 1.0, 1.0, None)]


@pytest.mark.parametrize("few", [20, 100_000])
def test_medians_of_groups_with_many_values(spark, few):
    """A small group, one without values, and large ones with hot values; null is a group."""
    data = [("a", float(i * 7919 % 3001)) for i in range(3001)]
    data += [("b", float(i % 1500)) for i in range(3000)] + [("b", 7.0)] * 2000
    data += [("c", 1.0), ("c", 4.0), ("c", None), ("d", None), ("d", float("nan")), (None, 5.0)]
    data += [("e", float(i)) for i in range(100)] + [("e", 1e6)] * 100
    df = spark.createDataFrame(data, "`k.x` string, v double")
    values = {}
    for k, v in data:
        if v is not None and v == v:
            values.setdefault(k, []).append(v)
    found = {r["k.x"]: r for r in metrics.wide_stats(df, "v", ["k.x"], few).collect()}
    assert {k: r["median"] for k, r in found.items()} == {
        **{k: statistics.median(v) for k, v in values.items()}, "d": None,
    }
    assert found["b"]["mode"] == 7.0 and found["a"]["mode"] == 0.0 and found["c"]["mean"] == 2.5
    assert found["a"]["std"] == pytest.approx(statistics.stdev(values["a"]), abs=0.0051)


def test_sketches_of_days_unite(spark):
    df = spark.range(60_000).selectExpr(
        "id % 30 as day", "id % 20000 as key", "if(id % 7 = 0, null, id % 5) as few", "cast(null as string) as none"
    )
    columns = ["key", "few", "none"]
    sketches = metrics.unique_sketches(df, columns, ["day"])
    assert sketches.count() == 30
    found = dict(rows(metrics.n_unique_of_sketches(sketches, columns)))
    assert abs(found["key"] - 20_000) < 0.05 * 20_000 and found["few"] == 5 and found["none"] == 0
    exact = dict(rows(metrics.n_unique(df, columns)))
    assert exact == {"key": 20_000, "few": 5, "none": 0}


def test_stored_counts_equal_counts_over_all_rows(spark, tmp_path):
    data = [(h, a, 2020 + (h + a) % 3, 90 + h) for h in range(4) for a in range(5)] * 3 + [(None, 1, 2021, None)]
    df, path = played(spark, data), str(tmp_path / "counts")
    kept = lambda frames: {name: rows(f) for name, f in frames.items()}
    refresh_counts(df.filter("league_season < 2022"), path, [2020, 2021], "league_season")
    # A season that is counted again does not count twice, and one may lose all of its rows.
    for _ in range(2):
        refresh_counts(df.filter("league_season > 2020"), path, [2021, 2022], "league_season")
    assert kept(stored_metrics(spark, path)) == kept(metrics.gold_metrics(df))
    refresh_counts(df.limit(0), path, [2022], "league_season")
    assert kept(stored_metrics(spark, path)) == kept(metrics.gold_metrics(df.filter("league_season < 2022")))
