import datetime as dt
import math

import pytest
from pyspark.sql import functions as F, types as T

from matchlake import functions as fn
from matchlake.operators import calendar, enrich, filters, retype, shaping

NAN = float("nan")


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_winner_and_total_with_missing_goals(spark):
    df = spark.createDataFrame(
        [(2.0, 1.0), (0.0, 3.0), (1.0, 1.0), (None, 1.0), (NAN, NAN), (2.0, NAN)],
        "goals_home double, goals_away double",
    )
    got = df.transform(enrich.match_winner).transform(enrich.total_goals)
    assert [r[2:] for r in rows(got)] == [
        ("Home", 3.0),
        ("Away", 3.0),
        ("Draw", 2.0),
        (None, None),
        (None, None),
        (None, None),
    ]


def test_winner_flags_are_dropped_even_without_goals(spark):
    df = spark.createDataFrame(
        [(1, True, False)], "id int, teams_home_winner boolean, teams_away_winner boolean"
    )
    assert enrich.match_winner(df).columns == ["id"]
    assert enrich.total_goals(df).columns == df.columns


def test_winner_of_an_empty_frame(spark):
    df = spark.createDataFrame([], "goals_home long, goals_away long")
    got = df.transform(enrich.match_winner)
    assert got.columns[-1] == "match_winner" and rows(got) == []


def test_label_outside_the_dictionary_is_null(spark):
    df = spark.createDataFrame([("Home",), ("Other",), (None,)], "match_winner string")
    assert [r[1] for r in rows(enrich.label_map(df))] == ["Local", None, None]


def test_int_cast_keeps_missing_and_refuses_fractions(spark):
    df = spark.createDataFrame([(1.0,), (NAN,), (None,)], "total_goals double")
    got = retype.cast_int_if_exists(df)
    assert got.schema["total_goals"].dataType == T.LongType()
    assert rows(got) == [(1,), (None,), (None,)]
    for bad in (1.5, math.inf):
        with pytest.raises(Exception, match="not a whole number"):
            retype.cast_int_if_exists(
                spark.createDataFrame([(bad,)], "total_goals double")
            ).collect()


def test_casts_leave_absent_columns_alone(spark):
    df = spark.createDataFrame([(1,)], "id int")
    for cast in (
        retype.cast_float_if_exists,
        retype.cast_int_if_exists,
        retype.cast_string_if_exists,
        retype.cast_categorical,
    ):
        assert cast(df).dtypes == [("id", "int")]


def test_float_cast_of_an_all_null_void_column(spark):
    df = spark.range(1).select(F.lit(None).alias("score.penalty.home"))
    got = retype.cast_float_if_exists(df)
    assert got.dtypes == [("score.penalty.home", "double")]
    assert rows(got) == [(None,)]


def test_event_date_prefers_the_raw_name_and_is_utc(spark):
    df = spark.createDataFrame(
        [
            ("2025-09-01T23:59:59+00:00", "2001-01-01"),
            ("2025-09-01T23:30:00-03:00", "2001-01-01"),
            (None, "2001-01-01"),
        ],
        "`fixture.date` string, fixture_date string",
    )
    got = df.transform(calendar.event_date_derive)
    assert got.schema["fixture.date"].dataType == T.TimestampType()
    assert [r["event_date"] for r in got.collect()] == [
        dt.date(2025, 9, 1),
        dt.date(2025, 9, 2),
        None,
    ]
    other = spark.createDataFrame([("2025-09-01T10:00:00Z",)], "fixture_date string")
    assert calendar.event_date_derive(other).first()["event_date"] == dt.date(2025, 9, 1)
    neither = spark.createDataFrame([(1,)], "id int")
    assert calendar.event_date_derive(neither).columns == ["id"]


def test_unparseable_dates_raise_unless_lenient(spark):
    df = spark.createDataFrame([("yesterday",)], "fixture_date string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE"):
        calendar.parse_ts_minute(df).collect()
    assert rows(calendar.parse_ts_minute(df, lenient=True)) == [(None,)]


def test_epoch_seconds_to_minute(spark):
    df = spark.createDataFrame(
        [(1756751459, 1756751459.0), (None, NAN)],
        "fixture_periods_first long, fixture_periods_second double",
    )
    got = calendar.epoch_ts_minute(df).select(
        *[F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in df.columns]
    )
    assert rows(got) == [("2025-09-01 18:30:00",) * 2, (None, None)]


def test_run_day_takes_text_date_and_datetime(spark):
    one = spark.range(1)
    for as_of in ("2025-03-01", dt.date(2025, 3, 1), dt.datetime(2025, 3, 1, 5)):
        assert one.select(fn.run_day(as_of)).first()[0] == dt.date(2025, 2, 28)


def test_seasons(spark):
    schema = "seasons array<struct<year:int,current:boolean>>"
    df = spark.createDataFrame(
        [
            ([(2022, False), (2020, True), (2021, True)],),
            ([(2019, False)],),
            ([],),
            (None,),
            ([(2018, None), (2017, True)],),
        ],
        schema,
    )
    got = enrich.season_years(df).select("min_year", "max_year", "current_year")
    assert rows(got) == [
        (2020, 2022, 2020),
        (2019, 2019, None),
        (None, None, None),
        (None, None, None),
        (2017, 2018, 2017),
    ]


def test_pct_and_rounding(spark):
    one = spark.range(1)
    assert one.select(fn.pct_of_total(F.lit(1), F.lit(3))).first()[0] == 33.3
    assert one.select(fn.pct_of_total(F.lit(0), F.lit(0))).first()[0] is None
    assert one.select(fn.round2(F.lit(1.006))).first()[0] == 1.01


def test_flatten_is_recursive_and_leaves_lists(spark):
    df = spark.createDataFrame(
        [((1, ("x",)), [(1,)]), (None, None)],
        "a struct<b:int,`c.d`:struct<e:string>>, l array<struct<y:int>>",
    )
    got = shaping.flatten_nested(df)
    assert got.columns == ["a.b", "a.c.d.e", "l"]
    assert rows(got)[1] == (None, None, None)
    assert shaping.flatten_nested(df, sep="_").columns[0] == "a_b"


def test_names_and_collisions(spark):
    df = spark.createDataFrame([(1, 2)], "`A.b` int, C int")
    assert shaping.standardize_names(df).columns == ["a_b", "c"]
    with pytest.raises(ValueError, match="a_b"):
        shaping.standardize_names(spark.createDataFrame([(1, 2)], "`a.b` int, a_b int"))


def test_drops_selects_and_head(spark):
    df = spark.createDataFrame([(1, 2)], "fixture_id int, league_logo int")
    assert shaping.drop_if_exists(df).columns == ["fixture_id"]
    assert shaping.drop_column(df, "league_logo").columns == ["fixture_id"]
    with pytest.raises(ValueError):
        shaping.drop_column(df, "seasons")
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        shaping.select_curated(df)
    with pytest.raises(ValueError):
        shaping.head_n(df, 1)
    assert rows(shaping.rename_key(df)) == [(1, 2)]


def test_filters(spark):
    df = spark.createDataFrame(
        [(1, "2025-09-01", 1.0), (2, "2025-09-30", NAN), (3, "2025-10-01", None), (4, None, 2.0)],
        "id int, event_date string, current_year double",
    )

    def ids(frame):
        return [r["id"] for r in frame.collect()]

    for typed in (df, df.withColumn("event_date", F.to_date("event_date"))):
        assert ids(filters.date_range_filter(typed, "2025-09-01", "2025-09-30")) == [1, 2]
        assert ids(filters.partition_eq_filter(typed, dt.date(2025, 10, 1))) == [3]
    assert ids(filters.drop_null_rows(df, "current_year")) == [1, 4]
    assert ids(filters.select_null_rows(df, "current_year")) == [2, 3]
