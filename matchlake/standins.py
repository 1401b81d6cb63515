"""Match-shaped views over general test tables, used by the checked queries.

Each view takes every row of its table; the SQL checks build the same shapes on
their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _tag(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One finished, running or not yet started match per order."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS fixture_id",
        "o_orderdate AS fixture_date",
        "CAST(o_orderdate AS DATE) AS event_date",
        "o_custkey % 20 AS league_id",
        "o_orderpriority AS league_name",
        "YEAR(o_orderdate) AS league_season",
        "o_orderstatus AS fixture_status_short",
        """CASE o_orderstatus WHEN 'F' THEN 90L WHEN 'P' THEN o_orderkey % 90 END
           AS fixture_status_elapsed""",
        "'Team#' || (o_custkey % 50) AS teams_home_name",
        "'Team#' || (o_custkey % 47) AS teams_away_name",
        "IF(o_orderstatus != 'O', FLOOR(o_totalprice) % 6, NULL) AS goals_home",
        "IF(o_orderstatus != 'O', o_custkey % 5, NULL) AS goals_away",
    )


def fixture_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested match record per event: the shape of a landed ``fixtures`` record."""
    played = table(spark, sf_dir, "events").selectExpr(
        "*",
        "unix_seconds(cast(ts AS TIMESTAMP)) AS kickoff",
        "event_type != 'signup' AS played",
        "if(event_type != 'signup', floor(value) % 6, NULL) AS h",
        "if(event_type != 'signup', event_id % 5, NULL) AS a",
        "if(event_type = 'error', event_id % 3, NULL) AS ph",
        "if(event_type = 'error', user_id % 3, NULL) AS pa",
    )
    return played.selectExpr(
        """named_struct(
             'id', event_id,
             'date', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'"),
             'referee', 'Referee#' || (user_id % 9),
             'timezone', 'UTC',
             'timestamp', kickoff,
             'periods', named_struct(
               'first', if(played, kickoff, NULL), 'second', if(played, kickoff + 3600, NULL)),
             'venue', named_struct(
               'id', user_id, 'name', 'Venue#' || user_id, 'city', 'City#' || (user_id % 30)),
             'status', named_struct(
               'long', upper(event_type), 'short', event_type,
               'elapsed', if(event_type = 'view', 45L, if(played, 90L, NULL)),
               'extra', cast(NULL AS BIGINT))) AS fixture""",
        """named_struct(
             'id', user_id % 20,
             'name', 'League#' || (user_id % 20),
             'country', 'Country#' || (user_id % 7),
             'season', cast(2020 + event_id % 4 AS INT),
             'round', 'Round ' || dayofmonth(ts),
             'logo', 'logo/league',
             'flag', 'flag/league') AS league""",
        """named_struct(
             'home', named_struct(
               'name', 'Team#' || (user_id % 50), 'logo', 'logo/' || (user_id % 50),
               'winner', if(h != a, h > a, NULL)),
             'away', named_struct(
               'name', 'Team#' || (event_id % 47), 'logo', 'logo/' || (event_id % 47),
               'winner', if(h != a, a > h, NULL))) AS teams""",
        "named_struct('home', h, 'away', a) AS goals",
        """named_struct(
             'halftime', named_struct('home', h div 2, 'away', a div 2),
             'fulltime', named_struct('home', h, 'away', a),
             'extratime', named_struct('home', cast(NULL AS BIGINT), 'away', cast(NULL AS BIGINT)),
             'penalty', named_struct('home', ph, 'away', pa)) AS score""",
    )


def league_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One league per customer, with none to four seasons in no particular order."""
    c = table(spark, sf_dir, "customer")
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    numbers = F.filter(F.sequence(F.lit(1), F.lit(4)), lambda i: i <= key % 5)
    return c.select(
        F.struct(
            key.alias("id"),
            F.col("c_name").alias("name"),
            F.when(F.col("c_acctbal") < 0, "Cup").otherwise("League").alias("type"),
            F.col("c_mktsegment").alias("logo"),
        ).alias("league"),
        F.struct(
            _tag("Country#", nation).alias("name"),
            _tag("C", nation).alias("code"),
            F.when(nation != 0, _tag("flag/", nation)).alias("flag"),
        ).alias("country"),
        F.transform(
            numbers,
            lambda i: F.struct(
                (F.lit(2000) + nation + (i * 3) % 5).cast("int").alias("year"),
                ((key + i) % 3 == 0).alias("current"),
            ),
        ).alias("seasons"),
    )


def country_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One country per supplier."""
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_name").alias("name"),
        _tag("C", F.col("s_nationkey")).alias("code"),
        F.when(F.col("s_acctbal") > 0, _tag("flag/", F.col("s_suppkey"))).alias("flag"),
    )


def envelopes(records: DataFrame, *extra: Column) -> DataFrame:
    """Each record as the text of one landed document, one line each."""
    record = F.struct(*records.columns)
    return records.select(F.to_json(F.struct(F.array(record).alias("response"))).alias("value"), *extra)
