"""One query per operator over the stand-in views, each with the SQL it must equal."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from matchlake import functions as fn
from matchlake import standins
from matchlake.operators import calendar, enrich, filters, merging, metrics, retype, shaping
from matchlake.plans import bronze, flow, gold, silver
from matchlake.schemas import (
    FIXTURE_RECORD,
    GOLD_COLUMNS,
    LEAGUE_RECORD,
    SCORE_FLOAT_COLUMNS,
    SILVER_DROPPED_COLUMNS,
)
from matchlake.session import configure, scratch_dir
from matchlake.sources import (
    export_csv,
    export_parquet,
    json_envelope,
    merge_where,
    read_partition_day,
    read_table,
    save_new,
    save_upsert,
    save_upsert_where,
    write_table,
)
from matchlake.sources import files
from matchlake.sources.landing import undeclared_value
from matchlake.streaming import incremental_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# --- Stand-in shapes, written again for the SQL side --------------------------

M = """
  select o_orderkey as fixture_id, o_orderdate as fixture_date,
    cast(o_orderdate as date) as event_date, cast(o_custkey % 20 as bigint) as league_id,
    o_orderpriority as league_name, cast(year(o_orderdate) as integer) as league_season,
    o_orderstatus as fixture_status_short,
    case when o_orderstatus = 'F' then cast(90 as bigint)
         when o_orderstatus = 'P' then cast(o_orderkey % 90 as bigint) end as fixture_status_elapsed,
    concat('Team#', cast(o_custkey % 50 as varchar)) as teams_home_name,
    concat('Team#', cast(o_custkey % 47 as varchar)) as teams_away_name,
    case when o_orderstatus <> 'O' then cast(floor(o_totalprice) as bigint) % 6 end as goals_home,
    case when o_orderstatus <> 'O' then cast(o_custkey % 5 as bigint) end as goals_away
  from orders"""

MW = f"""
  select *, goals_home + goals_away as total_goals,
    case when goals_home > goals_away then 'Home' when goals_home < goals_away then 'Away'
         when goals_home = goals_away then 'Draw' end as match_winner,
    case when goals_home > goals_away then 'Local' when goals_home < goals_away then 'Visitante'
         when goals_home = goals_away then 'Empate' end as resultado
  from ({M})"""

# A later delivery: matches not final before, now with a result and another season.
LATE = f"""
  select * replace ('F' as fixture_status_short, cast(9 as bigint) as goals_home,
    cast(0 as bigint) as goals_away, cast(league_season + 1 as integer) as league_season)
  from ({M}) where fixture_status_short <> 'F'"""

_PLAYED = "event_type <> 'signup'"
_HOME = f"(case when {_PLAYED} then cast(floor(value) as bigint) % 6 end)"
_AWAY = f"(case when {_PLAYED} then event_id % 5 end)"

# Flattened match records. Names are dotted; here a double underscore stands for the dot.
FLAT = f"""
  select event_id as "fixture__id", strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') as "fixture__date",
    concat('Referee#', cast(user_id % 9 as varchar)) as "fixture__referee",
    'UTC' as "fixture__timezone", cast(floor(epoch(ts)) as bigint) as "fixture__timestamp",
    case when {_PLAYED} then cast(floor(epoch(ts)) as bigint) end as "fixture__periods__first",
    case when {_PLAYED} then cast(floor(epoch(ts)) as bigint) + 3600 end as "fixture__periods__second",
    user_id as "fixture__venue__id", concat('Venue#', cast(user_id as varchar)) as "fixture__venue__name",
    concat('City#', cast(user_id % 30 as varchar)) as "fixture__venue__city",
    upper(event_type) as "fixture__status__long", event_type as "fixture__status__short",
    cast(case when event_type = 'view' then 45 when {_PLAYED} then 90 end as bigint)
      as "fixture__status__elapsed",
    cast(null as bigint) as "fixture__status__extra",
    user_id % 20 as "league__id", concat('League#', cast(user_id % 20 as varchar)) as "league__name",
    concat('Country#', cast(user_id % 7 as varchar)) as "league__country",
    cast(2020 + event_id % 4 as integer) as "league__season",
    concat('Round ', cast(day(ts) as varchar)) as "league__round",
    'logo/league' as "league__logo", 'flag/league' as "league__flag",
    concat('Team#', cast(user_id % 50 as varchar)) as "teams__home__name",
    concat('logo/', cast(user_id % 50 as varchar)) as "teams__home__logo",
    case when {_HOME} <> {_AWAY} then {_HOME} > {_AWAY} end as "teams__home__winner",
    concat('Team#', cast(event_id % 47 as varchar)) as "teams__away__name",
    concat('logo/', cast(event_id % 47 as varchar)) as "teams__away__logo",
    case when {_HOME} <> {_AWAY} then {_AWAY} > {_HOME} end as "teams__away__winner",
    {_HOME} as "goals__home", {_AWAY} as "goals__away",
    {_HOME} // 2 as "score__halftime__home", {_AWAY} // 2 as "score__halftime__away",
    {_HOME} as "score__fulltime__home", {_AWAY} as "score__fulltime__away",
    cast(null as bigint) as "score__extratime__home", cast(null as bigint) as "score__extratime__away",
    case when event_type = 'error' then event_id % 3 end as "score__penalty__home",
    case when event_type = 'error' then user_id % 3 end as "score__penalty__away"
  from events"""

BRONZE = f"""
  select "fixture__id" as fixture_id, * exclude ("fixture__id")
    replace (cast("score__extratime__home" as double) as "score__extratime__home",
      cast("score__extratime__away" as double) as "score__extratime__away",
      cast("score__penalty__home" as double) as "score__penalty__home",
      cast("score__penalty__away" as double) as "score__penalty__away",
      make_timestamp("fixture__timestamp" * 1000000) as "fixture__date"),
    cast(make_timestamp("fixture__timestamp" * 1000000) as date) as event_date
  from ({FLAT})"""

SILVER = f"""
  select fixture_id, date_trunc('minute', "fixture__date") as fixture_date,
    date_trunc('minute', make_timestamp("fixture__periods__first" * 1000000)) as fixture_periods_first,
    "fixture__venue__id" as fixture_venue_id, "fixture__venue__name" as fixture_venue_name,
    "fixture__venue__city" as fixture_venue_city, "fixture__status__short" as fixture_status_short,
    "fixture__status__elapsed" as fixture_status_elapsed, "league__id" as league_id,
    "league__name" as league_name, "league__country" as league_country,
    "league__season" as league_season, "league__round" as league_round,
    "teams__home__name" as teams_home_name, "teams__away__name" as teams_away_name,
    "goals__home" as goals_home, "goals__away" as goals_away,
    "score__halftime__home" as score_halftime_home, "score__halftime__away" as score_halftime_away,
    "score__fulltime__home" as score_fulltime_home, "score__fulltime__away" as score_fulltime_away,
    cast("score__extratime__home" as bigint) as score_extratime_home,
    cast("score__extratime__away" as bigint) as score_extratime_away,
    cast("score__penalty__home" as bigint) as score_penalty_home,
    cast("score__penalty__away" as bigint) as score_penalty_away,
    "goals__home" + "goals__away" as total_goals,
    case when "goals__home" > "goals__away" then 'Home' when "goals__home" < "goals__away" then 'Away'
         when "goals__home" = "goals__away" then 'Draw' end as match_winner,
    strftime(event_date, '%Y-%m-%d') as event_date
  from ({BRONZE})"""

GOLD = f"select {', '.join(GOLD_COLUMNS)} from ({SILVER})"

_SEASON = "2000 + c_nationkey + (i * 3) % 5"
_SEASON_ROWS = "range(1, c_custkey % 5 + 1)"
LEAGUES = f"""
  select c_custkey as league_id, c_name as league_name,
    case when c_acctbal < 0 then 'Cup' else 'League' end as league_type,
    c_mktsegment as league_logo, concat('Country#', cast(c_nationkey as varchar)) as country_name,
    concat('C', cast(c_nationkey as varchar)) as country_code,
    case when c_nationkey <> 0 then concat('flag/', cast(c_nationkey as varchar)) end as country_flag,
    cast(list_min([{_SEASON} for i in {_SEASON_ROWS}]) as integer) as min_year,
    cast(list_max([{_SEASON} for i in {_SEASON_ROWS}]) as integer) as max_year,
    cast(([{_SEASON} for i in {_SEASON_ROWS} if (c_custkey + i) % 3 = 0])[1] as integer)
      as current_year,
    cast(([{_SEASON} for i in {_SEASON_ROWS}])[1] as integer) as first_year,
    ([(c_custkey + i) % 3 = 0 for i in {_SEASON_ROWS}])[1] as first_current,
    array_to_string([concat(cast({_SEASON} as varchar), ':',
      cast((c_custkey + i) % 3 = 0 as varchar)) for i in {_SEASON_ROWS}], ',') as season_text
  from customer"""


# --- Helpers ------------------------------------------------------------------


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _comparable(build(configure(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def _comparable(df: DataFrame) -> DataFrame:
    """The form the SQL side has: UTC instants without a zone, no dots in names."""
    instants = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    plain = df.withColumns({c: fn.quoted(c).cast("timestamp_ntz") for c in instants})
    return plain.toDF(*[c.replace(".", "__") for c in plain.columns])


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        standins.matches(spark, sf_dir)
        .transform(enrich.match_winner)
        .transform(enrich.total_goals)
    )


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outcomes(spark, sf_dir).transform(enrich.label_map)


def _flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standins.fixture_records(spark, sf_dir).transform(shaping.flatten_nested)


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(spark, sf_dir).transform(shaping.rename_key).transform(shaping.standardize_names)


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.bronze_fixtures(standins.fixture_records(spark, sf_dir))


def _leagues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        bronze.bronze_static(standins.league_records(spark, sf_dir))
        .transform(shaping.standardize_names)
        .transform(enrich.season_years)
    )


def _late(df: DataFrame) -> DataFrame:
    return df.filter(F.col("fixture_status_short") != "F").withColumns(
        {
            "fixture_status_short": F.lit("F"),
            "goals_home": F.lit(9).cast("long"),
            "goals_away": F.lit(0).cast("long"),
            "league_season": F.col("league_season") + 1,
        }
    )


def _land(records: DataFrame, path: str) -> None:
    standins.envelopes(records).write.text(path)


def _day_bounds(spark: SparkSession, sf_dir: str) -> tuple[dt.date, dt.date]:
    day = F.col("ts").cast("date")
    return tuple(standins.table(spark, sf_dir, "events").agg(F.min(day), F.max(day)).first())


def _stored_bronze(spark: SparkSession, sf_dir: str, name: str) -> str:
    path = scratch_dir(spark, name)
    write_table(_bronze(spark, sf_dir), path, partition_cols="event_date")
    return path


# --- Sources and sinks ---------------------------------------------------------

_FX_COLUMNS = [
    "fixture_id",
    "fixture_date",
    "fixture_venue_name",
    "fixture_status_short",
    "league_season",
    "goals_home",
    "score_halftime_away",
    "score_penalty_home",
    "teams_home_winner",
]
_FX_SQL = """
  "fixture__id" as fixture_id, "fixture__date" as fixture_date,
  "fixture__venue__name" as fixture_venue_name, "fixture__status__short" as fixture_status_short,
  "league__season" as league_season, "goals__home" as goals_home,
  "score__halftime__away" as score_halftime_away, "score__penalty__home" as score_penalty_home,
  "teams__home__winner" as teams_home_winner"""


@query("json_envelope", f"select {_FX_SQL} from ({FLAT})")
def _json_envelope(spark, sf_dir):
    landing = scratch_dir(spark, "landing")
    _land(standins.fixture_records(spark, sf_dir), landing)
    records = json_envelope(spark, landing, FIXTURE_RECORD, layout="lines").records
    flat = shaping.standardize_names(shaping.flatten_nested(records))
    return flat.select(*_FX_COLUMNS)


@query(
    "json_envelope_rejects",
    r"""select 'invalid document' as reason, count(*) as documents from documents
        where trim(regexp_replace(text, '\s+', ' ', 'g')) <> ''""",
)
def _json_envelope_rejects(spark, sf_dir):
    """Prose among the landed documents: none is JSON, so each must be set aside."""
    landing = scratch_dir(spark, "landing")
    _land(standins.fixture_records(spark, sf_dir), landing)
    prose = F.trim(F.regexp_replace("text", r"\s+", " "))
    standins.table(spark, sf_dir, "documents").select(prose).write.mode("append").text(landing)
    rejects = json_envelope(spark, landing, FIXTURE_RECORD, layout="lines").rejects
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("documents"))


@query(
    "json_envelope_documents",
    f"""select "fixture__id" as fixture_id, "goals__home" as goals_home,
          cast("fixture__id" * 10 as varchar) as attendance,
          case when "fixture__id" % 2 = 0 then concat('w', cast("fixture__id" % 3 as varchar)) end as weather,
          cast(null as varchar) as reason
        from ({FLAT}) where "fixture__id" % 97 <> 0
        union all
        select "fixture__id", null, null, null, 'invalid value' from ({FLAT}) where "fixture__id" % 97 = 0
        union all select null, null, null, null, 'no data field'""",
)
def _json_envelope_documents(spark, sf_dir):
    """Many records in a document, with keys no schema declares and with values that do not
    fit; beside them an empty envelope and a document that is none."""
    landing = scratch_dir(spark, "landing")
    number = F.col("fixture.id")
    fixture = F.col("fixture").withField("attendance", number * 10).alias("fixture")
    weather = F.when(number % 2 == 0, F.concat(F.lit("w"), (number % 3).cast("string"))).alias("weather")
    good = F.to_json(F.struct(fixture, "league", "teams", "goals", "score", weather))
    bad = F.to_json(F.struct(fixture, "league", F.struct(F.lit("x").alias("home")).alias("goals")))
    record = F.when(number % 97 == 0, bad).otherwise(good)
    documents = (
        standins.fixture_records(spark, sf_dir)
        .groupBy(F.floor(number / 50))
        .agg(F.concat(F.lit('{"response":['), F.array_join(F.collect_list(record), ","), F.lit("]}")).alias("value"))
        .select("value")
    )
    others = spark.createDataFrame([('{"response":[]}',), ('{"errors":[]}',)], "value string")
    documents.union(others).write.text(landing)
    records, rejects = json_envelope(spark, landing, FIXTURE_RECORD, layout="lines", undeclared=True)
    found = records.select(
        number.alias("fixture_id"),
        F.col("goals.home").alias("goals_home"),
        undeclared_value("fixture.attendance").alias("attendance"),
        undeclared_value("weather").alias("weather"),
        F.lit(None).cast("string").alias("reason"),
    )
    nothing = F.lit(None).cast("string")
    set_aside = rejects.select(
        F.get_json_object("document", "$.fixture.id").cast("long").alias("fixture_id"),
        F.lit(None).cast("long").alias("goals_home"),
        nothing.alias("attendance"),
        nothing.alias("weather"),
        "reason",
    )
    return found.unionByName(set_aside)


@query("read_table", f"select * from ({M})")
def _read_table(spark, sf_dir):
    path = scratch_dir(spark, "read_table")
    write_table(standins.matches(spark, sf_dir), path, partition_cols="league_season")
    return read_table(spark, path)


@query(
    "read_partition_day",
    f"""select * from ({BRONZE})
        where event_date = (select max(cast(ts as date)) from events) - 1""",
)
def _read_partition_day(spark, sf_dir):
    path = _stored_bronze(spark, sf_dir, "read_partition_day")
    return read_partition_day(spark, path, _day_bounds(spark, sf_dir)[1])


@query("write_overwrite", f"select * from ({M})")
def _write_overwrite(spark, sf_dir):
    path = scratch_dir(spark, "write_overwrite")
    df = standins.matches(spark, sf_dir)
    write_table(_late(df), path)
    write_table(df, path, "overwrite")
    return read_table(spark, path)


@query("write_append", f"select * from ({M}) union all select * from ({LATE})")
def _write_append(spark, sf_dir):
    path = scratch_dir(spark, "write_append")
    df = standins.matches(spark, sf_dir)
    write_table(df, path, "append")
    write_table(_late(df), path, "append")
    return read_table(spark, path)


@query("write_error", f"select *, true as refused from ({M})")
def _write_error(spark, sf_dir):
    path = scratch_dir(spark, "write_error")
    df = standins.matches(spark, sf_dir)
    write_table(df, path, "error")
    try:
        write_table(_late(df), path, "error")
        refused = False
    except FileExistsError:
        refused = True
    return read_table(spark, path).withColumn("refused", F.lit(refused))


@query("write_ignore", f"select * from ({M})")
def _write_ignore(spark, sf_dir):
    path = scratch_dir(spark, "write_ignore")
    df = standins.matches(spark, sf_dir)
    write_table(df, path, "ignore")
    write_table(_late(df), path, "ignore")
    return read_table(spark, path)


@query("write_partitioned", f"select * from ({M})")
def _write_partitioned(spark, sf_dir):
    path = scratch_dir(spark, "write_partitioned")
    write_table(
        standins.matches(spark, sf_dir),
        path,
        partition_cols=["league_season", "fixture_status_short"],
    )
    return read_table(spark, path)


_INSERTED = f"""
  select * from ({M}) where fixture_status_short <> 'P'
  union all
  select l.* from ({LATE}) l where l.fixture_id not in
    (select fixture_id from ({M}) where fixture_status_short <> 'P')"""


def _stored_matches(spark, sf_dir, name) -> tuple[str, DataFrame]:
    """Final and not yet started matches are stored; the running ones are not."""
    path = scratch_dir(spark, name)
    df = standins.matches(spark, sf_dir)
    write_table(
        df.filter(F.col("fixture_status_short") != "P"), path, partition_cols="league_season"
    )
    return path, df


@query("merge_insert_new", _INSERTED)
def _merge_insert_new(spark, sf_dir):
    path, df = _stored_matches(spark, sf_dir, "merge_insert_new")
    save_new(_late(df), path, "fixture_id")
    save_new(_late(df), path, "fixture_id")  # a rerun adds nothing
    return read_table(spark, path)


_LINES = "l_orderkey, l_linenumber, l_quantity, l_returnflag"


@query(
    "merge_insert_new_repeated_keys",
    f"""select {_LINES} from lineitem where l_returnflag = 'A'
        union all
        select {_LINES} from lineitem where l_orderkey not in
          (select l_orderkey from lineitem where l_returnflag = 'A')""",
)
def _merge_insert_new_repeated_keys(spark, sf_dir):
    """A key with several rows in batch and table, by the plan for large key sets."""
    df = standins.table(spark, sf_dir, "lineitem").select(*_LINES.split(", "))
    stored = df.filter(F.col("l_returnflag") == "A")
    return merging.merge_insert_new(
        stored, df, "l_orderkey", merging.MergeLimits(broadcast_rows=0)
    )


@query(
    "merge_upsert",
    f"""select * from ({M}) where fixture_status_short = 'F'
        union all select * from ({LATE})""",
)
def _merge_upsert(spark, sf_dir):
    path, df = _stored_matches(spark, sf_dir, "merge_upsert")
    save_upsert(_late(df), path, "fixture_id")
    return read_table(spark, path)


_SAME_AND_LATER = "fixture_id = l.fixture_id and t.teams_home_name >= l.teams_away_name"


@query(
    "merge_upsert_predicate",
    f"""select * from ({M}) t where t.fixture_status_short <> 'P' and not exists
          (select 1 from ({LATE}) l where t.{_SAME_AND_LATER})
        union all select * from ({LATE})""",
)
def _merge_upsert_predicate(spark, sf_dir):
    """Stored matches that a later one matches under a condition are replaced by it."""
    path, df = _stored_matches(spark, sf_dir, "merge_upsert_predicate")
    save_upsert_where(
        _late(df),
        path,
        "target.fixture_id = source.fixture_id and target.teams_home_name >= source.teams_away_name",
    )
    return read_table(spark, path)


@query(
    "merge_upsert_emptied_partition",
    f"""select * replace (case when league_season = (select min(league_season) from ({M})) then cast(league_season - 1 as integer)
          else league_season end as league_season), false as still_there
        from ({M})""",
)
def _merge_upsert_emptied_partition(spark, sf_dir):
    """All matches of the first season move to the one before, so its partition goes."""
    path = scratch_dir(spark, "merge_upsert_emptied")
    df = standins.matches(spark, sf_dir)
    write_table(df, path, partition_cols="league_season")
    first = df.agg(F.min("league_season")).first()[0]
    moved = df.filter(F.col("league_season") == first)
    moved = moved.withColumn("league_season", F.col("league_season") - 1)
    save_upsert(moved, path, "fixture_id", limits=merging.MergeLimits(broadcast_rows=0))
    still_there = files.exists(spark, f"{path}/league_season={first}")
    return read_table(spark, path).withColumn("still_there", F.lit(still_there))


@query("merge_predicate", _INSERTED)
def _merge_predicate(spark, sf_dir):
    path, df = _stored_matches(spark, sf_dir, "merge_predicate")
    merge_where(_late(df), path, "target.fixture_id = source.fixture_id")
    return read_table(spark, path)


@query(
    "merge_predicate_condition",
    f"""select * from ({M}) where fixture_status_short <> 'P'
        union all
        select l.* from ({LATE}) l where not exists
          (select 1 from ({M}) t where t.fixture_status_short <> 'P'
           and t.fixture_id = l.fixture_id and t.teams_home_name >= l.teams_away_name)""",
)
def _merge_predicate_condition(spark, sf_dir):
    """A condition that is more than equality of keys."""
    path, df = _stored_matches(spark, sf_dir, "merge_predicate_condition")
    merge_where(
        _late(df),
        path,
        "target.fixture_id = source.fixture_id"
        " and target.teams_home_name >= source.teams_away_name",
    )
    return read_table(spark, path)


@query("export_csv", GOLD)
def _export_csv(spark, sf_dir):
    path = scratch_dir(spark, "export_csv")
    curated = gold.gold_fixtures(silver.silver_fixtures(_bronze(spark, sf_dir))).curated
    export_csv(curated, path)
    return spark.read.schema(curated.schema).option("header", True).csv(path)


@query("export_parquet", GOLD)
def _export_parquet(spark, sf_dir):
    path = scratch_dir(spark, "export_parquet")
    curated = gold.gold_fixtures(silver.silver_fixtures(_bronze(spark, sf_dir))).curated
    export_parquet(curated, path)
    return spark.read.parquet(path)


# --- Shape and names -------------------------------------------------------------


@query("flatten_nested", FLAT)
def _flatten_nested(spark, sf_dir):
    return _flat(spark, sf_dir)


@query("rename_key", f'select "fixture__id" as fixture_id, * exclude ("fixture__id") from ({FLAT})')
def _rename_key(spark, sf_dir):
    return _flat(spark, sf_dir).transform(shaping.rename_key)


@query("standardize_names", f"select {_FX_SQL} from ({FLAT})")
def _standardize_names(spark, sf_dir):
    return _flat(spark, sf_dir).transform(shaping.standardize_names).select(*_FX_COLUMNS)


# In the dropped columns' names every underscore stands for a dot.
_DOTTED_DROPS = ", ".join('"' + c.replace("_", "__") + '"' for c in SILVER_DROPPED_COLUMNS)


@query("drop_if_exists", f"select * exclude ({_DOTTED_DROPS}) from ({FLAT})")
def _drop_if_exists(spark, sf_dir):
    df = _flat(spark, sf_dir)
    dotted = {c.replace(".", "_"): c for c in df.columns}
    return shaping.drop_if_exists(df, [dotted[c] for c in SILVER_DROPPED_COLUMNS] + ["absent"])


@query("drop_column", f"select * exclude (first_year, first_current, season_text) from ({LEAGUES})")
def _drop_column(spark, sf_dir):
    return _leagues(spark, sf_dir).transform(shaping.drop_column, "seasons")


@query("select_curated", f"select {', '.join(GOLD_COLUMNS)} from ({MW})")
def _select_curated(spark, sf_dir):
    return _outcomes(spark, sf_dir).transform(shaping.select_curated)


# --- Types -----------------------------------------------------------------------

_SCORES = ", ".join(
    f'cast("{c.replace(".", "__")}" as double) as {c.replace(".", "_")}'
    for c in SCORE_FLOAT_COLUMNS
)


@query("cast_float_if_exists", f'select "fixture__id" as fixture_id, {_SCORES} from ({FLAT})')
def _cast_float_if_exists(spark, sf_dir):
    df = _flat(spark, sf_dir).transform(retype.cast_float_if_exists)
    return shaping.standardize_names(
        shaping.rename_key(shaping.select_curated(df, ["fixture.id", *SCORE_FLOAT_COLUMNS]))
    )


@query(
    "cast_int_if_exists",
    f"select fixture_id, goals_home, goals_away, fixture_status_elapsed from ({M})",
)
def _cast_int_if_exists(spark, sf_dir):
    """From doubles in which NaN stands for a missing value."""
    names = ["goals_home", "goals_away", "fixture_status_elapsed"]
    df = standins.matches(spark, sf_dir).select("fixture_id", *names)
    with_nan = df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in names}
    )
    return with_nan.transform(retype.cast_int_if_exists)


@query(
    "cast_string_if_exists",
    f"""select fixture_id, cast(fixture_status_short as varchar) as fixture_status_short,
          cast(league_name as varchar) as league_name,
          cast(league_season as varchar) as league_round from ({M})""",
)
def _cast_string_if_exists(spark, sf_dir):
    df = standins.matches(spark, sf_dir).withColumn("league_round", F.col("league_season"))
    return df.transform(retype.cast_string_if_exists).select(
        "fixture_id", "fixture_status_short", "league_name", "league_round"
    )


@query("cast_categorical", f"select fixture_id, fixture_status_short, match_winner from ({MW})")
def _cast_categorical(spark, sf_dir):
    return (
        _outcomes(spark, sf_dir)
        .transform(retype.cast_categorical)
        .select("fixture_id", "fixture_status_short", "match_winner")
    )


@query(
    "cast_year_int",
    f"select league_id, current_year from ({LEAGUES}) where current_year is not null",
)
def _cast_year_int(spark, sf_dir):
    df = _leagues(spark, sf_dir).withColumn("current_year", F.col("current_year").cast("double"))
    return (
        df.transform(filters.drop_null_rows, "current_year")
        .transform(retype.cast_year_int)
        .select("league_id", "current_year")
    )


# --- Dates -----------------------------------------------------------------------


@query("event_date_derive", f'select fixture_id, "fixture__date" as kickoff, event_date from ({BRONZE})')
def _event_date_derive(spark, sf_dir):
    df = _flat(spark, sf_dir).transform(shaping.rename_key).transform(calendar.event_date_derive)
    return df.select("fixture_id", F.col("`fixture.date`").alias("kickoff"), "event_date")


@query(
    "parse_ts_minute",
    "select event_id as fixture_id, date_trunc('minute', ts) as fixture_date from events",
)
def _parse_ts_minute(spark, sf_dir):
    return (
        _clean(spark, sf_dir)
        .transform(calendar.parse_ts_minute)
        .select("fixture_id", "fixture_date")
    )


@query(
    "epoch_ts_minute",
    f"""select event_id as fixture_id,
          case when {_PLAYED} then date_trunc('minute', ts) end as fixture_periods_first,
          case when {_PLAYED} then date_trunc('minute', ts + interval 1 hour) end
            as fixture_periods_second
        from events""",
)
def _epoch_ts_minute(spark, sf_dir):
    return (
        _clean(spark, sf_dir)
        .transform(calendar.epoch_ts_minute)
        .select("fixture_id", "fixture_periods_first", "fixture_periods_second")
    )


@query("date_to_string", f"select fixture_id, strftime(event_date, '%Y-%m-%d') as event_date from ({M})")
def _date_to_string(spark, sf_dir):
    df = standins.matches(spark, sf_dir).select("fixture_id", "event_date")
    return df.transform(calendar.date_to_string)


@query("event_date_utc", f"select fixture_id, cast(event_date as timestamp) as event_date from ({M})")
def _event_date_utc(spark, sf_dir):
    df = standins.matches(spark, sf_dir).select("fixture_id", "event_date")
    return df.transform(calendar.date_to_string).transform(calendar.event_date_utc)


@query(
    "run_day_minus_one",
    f"select fixture_id, cast(event_date - interval 1 day as date) as run_day from ({M})",
)
def _run_day_minus_one(spark, sf_dir):
    df = standins.matches(spark, sf_dir)
    return df.transform(calendar.run_day_minus_one, "event_date").select("fixture_id", "run_day")


# --- Conditions, arithmetic, maps ------------------------------------------------


@query("match_winner", f"select fixture_id, goals_home, goals_away, match_winner from ({MW})")
def _match_winner(spark, sf_dir):
    return (
        standins.matches(spark, sf_dir)
        .transform(enrich.match_winner)
        .select("fixture_id", "goals_home", "goals_away", "match_winner")
    )


@query("total_goals", f"select fixture_id, total_goals from ({MW})")
def _total_goals(spark, sf_dir):
    return (
        standins.matches(spark, sf_dir)
        .transform(enrich.total_goals)
        .select("fixture_id", "total_goals")
    )


@query("label_map", f'select fixture_id, match_winner, resultado as "Resultado" from ({MW})')
def _label_map(spark, sf_dir):
    return _labelled(spark, sf_dir).select("fixture_id", "match_winner", "Resultado")


@query(
    "pct_of_total",
    f"""select fixture_status_short, count(*) as matches,
          round_even(100.0 * count(*) / (select count(*) from orders), 1) as pct
        from ({M}) group by fixture_status_short""",
)
def _pct_of_total(spark, sf_dir):
    df = standins.matches(spark, sf_dir)
    total = df.select(F.count(F.lit(1))).scalar()
    counts = df.groupBy("fixture_status_short").agg(F.count(F.lit(1)).alias("matches"))
    return counts.withColumn("pct", fn.pct_of_total(F.col("matches"), total))


@query("round2", "select o_orderkey, round_even(o_totalprice / 7, 2) as share from orders")
def _round2(spark, sf_dir):
    orders = standins.table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", fn.round2(F.col("o_totalprice") / 7).alias("share"))


@query("round2_ties", "select l_orderkey, l_linenumber, round_even(l_quantity / 8, 2) as share from lineitem")
def _round2_ties(spark, sf_dir):
    """Eighths, half of which lie between two hundredths."""
    items = standins.table(spark, sf_dir, "lineitem")
    return items.select("l_orderkey", "l_linenumber", fn.round2(F.col("l_quantity") / 8).alias("share"))


@query(
    "pct_label",
    "select l_quantity, printf('%.1f', round_even(100.0 * l_quantity / 16, 1)) || '%' as share from lineitem",
)
def _pct_label(spark, sf_dir):
    items = standins.table(spark, sf_dir, "lineitem")
    return items.select("l_quantity", fn.pct_label(F.col("l_quantity"), F.lit(16)).alias("share"))


# --- Seasons ---------------------------------------------------------------------


@query("season_min_year", f"select league_id, min_year from ({LEAGUES})")
def _season_min_year(spark, sf_dir):
    return _leagues(spark, sf_dir).select("league_id", "min_year")


@query("season_max_year", f"select league_id, max_year from ({LEAGUES})")
def _season_max_year(spark, sf_dir):
    return _leagues(spark, sf_dir).select("league_id", "max_year")


@query("season_current_year", f"select league_id, current_year from ({LEAGUES})")
def _season_current_year(spark, sf_dir):
    return _leagues(spark, sf_dir).select("league_id", "current_year")


@query("array_element", f"select league_id, first_year, first_current from ({LEAGUES})")
def _array_element(spark, sf_dir):
    first = fn.first_element(F.col("seasons"))
    return _leagues(spark, sf_dir).select(
        "league_id", first["year"].alias("first_year"), first["current"].alias("first_current")
    )


# --- Filters -----------------------------------------------------------------------


@query(
    "date_range_filter",
    f"select * from ({M}) where event_date between date '1996-09-01' and date '1997-09-30'",
)
def _date_range_filter(spark, sf_dir):
    return standins.matches(spark, sf_dir).transform(
        filters.date_range_filter, "1996-09-01", "1997-09-30"
    )


@query(
    "partition_eq_filter",
    f"select * from ({BRONZE}) where event_date = (select min(cast(ts as date)) from events)",
)
def _partition_eq_filter(spark, sf_dir):
    path = _stored_bronze(spark, sf_dir, "partition_eq_filter")
    first = _day_bounds(spark, sf_dir)[0]
    return read_table(spark, path).transform(filters.partition_eq_filter, first)


@query("drop_null_rows", f"select * from ({M}) where goals_home is not null")
def _drop_null_rows(spark, sf_dir):
    return standins.matches(spark, sf_dir).transform(filters.drop_null_rows, "goals_home")


@query("select_null_rows", f"select league_id, season_text from ({LEAGUES}) where current_year is null")
def _select_null_rows(spark, sf_dir):
    rejected = _leagues(spark, sf_dir).transform(filters.select_null_rows, "current_year")
    return rejected.select("league_id", _season_text())


def _season_text():
    return F.concat_ws(
        ",",
        F.transform(
            "seasons",
            lambda s: F.concat(s["year"].cast("string"), F.lit(":"), s["current"].cast("string")),
        ),
    ).alias("season_text")


# --- Metrics ---------------------------------------------------------------------


@query("row_count", 'select count(*) as "rows" from orders')
def _row_count(spark, sf_dir):
    return metrics.row_count(standins.matches(spark, sf_dir))


_MATCH_TYPES = {
    "fixture_id": "bigint",
    "fixture_date": "timestamp_ntz",
    "event_date": "date",
    "league_id": "bigint",
    "league_name": "string",
    "league_season": "int",
    "fixture_status_short": "string",
    "fixture_status_elapsed": "bigint",
    "teams_home_name": "string",
    "teams_away_name": "string",
    "goals_home": "bigint",
    "goals_away": "bigint",
}


@query(
    "null_counts",
    " union all ".join(
        f"select '{c}' as column_name, count(*) - count({c}) as nulls from ({M})"
        for c in _MATCH_TYPES
    ),
)
def _null_counts(spark, sf_dir):
    return metrics.null_counts(standins.matches(spark, sf_dir))


# Seven is no number of goals in the stand-ins: there it becomes NaN, which is missing.
MN = f"""select * replace (cast(nullif(total_goals, 7) as double) as total_goals) from ({MW})"""


def _with_nan(spark, sf_dir):
    goals = F.when(F.col("total_goals") == 7, F.lit("NaN").cast("double"))
    goals = goals.otherwise(F.col("total_goals").cast("double"))
    return _outcomes(spark, sf_dir).withColumn("total_goals", goals)


@query(
    "null_counts_nan",
    f"select 'total_goals' as column_name, count(*) - count(total_goals) as nulls from ({MN})",
)
def _null_counts_nan(spark, sf_dir):
    return metrics.null_counts(_with_nan(spark, sf_dir), ["total_goals"])


@query(
    "n_unique_nan",
    f"select 'total_goals' as column_name, count(distinct total_goals) as n_unique from ({MN})",
)
def _n_unique_nan(spark, sf_dir):
    return metrics.n_unique(_with_nan(spark, sf_dir), ["total_goals"])


@query(
    "column_profile_nan",
    f"""select cast(0 as integer) as position, 'total_goals' as column_name, 'double' as data_type,
          count(total_goals) as non_null from ({MN})""",
)
def _column_profile_nan(spark, sf_dir):
    return metrics.column_profile(_with_nan(spark, sf_dir).select("total_goals"))


@query(
    "value_counts_nan",
    f"select total_goals, count(*) as matches from ({MN}) where total_goals is not null group by 1",
)
def _value_counts_nan(spark, sf_dir):
    return metrics.value_counts(_with_nan(spark, sf_dir), "total_goals")


@query("goals_sum_nan", f"select coalesce(sum(total_goals), 0) as goals from ({MN})")
def _goals_sum_nan(spark, sf_dir):
    return metrics.goals_sum(_with_nan(spark, sf_dir))


@query(
    "goals_stats_nan",
    f"""select round_even(avg(total_goals), 2) as mean, round_even(median(total_goals), 2) as median,
          (select total_goals from ({MN}) where total_goals is not null
           group by total_goals order by count(*) desc, total_goals limit 1) as mode,
          round_even(stddev_samp(total_goals), 2) as std from ({MN})""",
)
def _goals_stats_nan(spark, sf_dir):
    return metrics.goals_stats(_with_nan(spark, sf_dir))


@query("distinct_values", f"select distinct match_winner from ({MW})")
def _distinct_values(spark, sf_dir):
    return metrics.distinct_values(_outcomes(spark, sf_dir), "match_winner")


_UNIQUE = [
    "fixture_status_short",
    "league_name",
    "teams_home_name",
    "teams_away_name",
    "match_winner",
    "total_goals",
]


@query(
    "n_unique",
    " union all ".join(
        f"select '{c}' as column_name, count(distinct {c}) as n_unique from ({MW})" for c in _UNIQUE
    ),
)
def _n_unique(spark, sf_dir):
    return metrics.n_unique(_outcomes(spark, sf_dir), _UNIQUE)


@query(
    "column_profile",
    " union all ".join(
        f"select cast({i} as integer) as position, '{c}' as column_name, '{t}' as data_type,"
        f" count({c}) as non_null from ({M})"
        for i, (c, t) in enumerate(_MATCH_TYPES.items())
    ),
)
def _column_profile(spark, sf_dir):
    return metrics.column_profile(standins.matches(spark, sf_dir))


@query(
    "value_counts",
    f"""select resultado as "Resultado", count(*) as matches from ({MW})
        where resultado is not null group by 1 order by 2 desc, 1""",
)
def _value_counts(spark, sf_dir):
    return metrics.value_counts(_labelled(spark, sf_dir), "Resultado")


@query(
    "result_distribution",
    f"""select cast(position as integer) as position, r as "Resultado",
          count(resultado) as matches,
          round_even(100.0 * count(resultado) / (select count(*) from orders), 1) as pct
        from (values (0, 'Local'), (1, 'Empate'), (2, 'Visitante')) v(position, r)
        left join ({MW}) m on m.resultado = v.r group by 1, 2""",
)
def _result_distribution(spark, sf_dir):
    return metrics.result_distribution(_outcomes(spark, sf_dir))


@query("goals_sum", f"select cast(coalesce(sum(total_goals), 0) as bigint) as goals from ({MW})")
def _goals_sum(spark, sf_dir):
    return metrics.goals_sum(_outcomes(spark, sf_dir))


def _stats_sql(column: str, names: str = "mean|median|mode|std") -> str:
    mean, median, mode, std = names.split("|")
    return f"""round_even(avg({column}), 2) as "{mean}", round_even(median({column}), 2) as "{median}",
      (select {column} from ({MW}) where {column} is not null
       group by {column} order by count(*) desc, {column} limit 1) as "{mode}",
      round_even(stddev_samp({column}), 2) as "{std}" """


@query("goals_stats", f"select {_stats_sql('total_goals')} from ({MW})")
def _goals_stats(spark, sf_dir):
    return metrics.goals_stats(_outcomes(spark, sf_dir))


@query(
    "stats_by_category",
    " union all ".join(
        f"""select '{label}' as "Categoría", {_stats_sql(c, 'Media|Mediana|Moda|Desvío estándar')}
            from ({MW})"""
        for label, c in (
            ("Goles totales", "total_goals"),
            ("Goles de local", "goals_home"),
            ("Goles de visitante", "goals_away"),
        )
    ),
)
def _stats_by_category(spark, sf_dir):
    return metrics.stats_by_category(_outcomes(spark, sf_dir))


@query(
    "goals_by_condition",
    f"""select 'Local' as "Condición", cast(sum(goals_home) as bigint) as "Goles" from ({M})
        union all select 'Visitante', cast(sum(goals_away) as bigint) from ({M})""",
)
def _goals_by_condition(spark, sf_dir):
    return metrics.goals_by_condition(standins.matches(spark, sf_dir))


@query(
    "goals_histogram",
    f"""select cast(b.goals as bigint) as goals, count(m.total_goals) as matches
        from range(0, (select max(total_goals) + 1 from ({MW}))) b(goals)
        left join ({MW}) m on m.total_goals = b.goals group by 1""",
)
def _goals_histogram(spark, sf_dir):
    return metrics.goals_histogram(_outcomes(spark, sf_dir))


@query(
    "elapsed_counts",
    f"""select fixture_status_elapsed, count(*) as matches from ({M})
        where fixture_status_elapsed is not null group by 1 order by 1""",
)
def _elapsed_counts(spark, sf_dir):
    return metrics.elapsed_counts(standins.matches(spark, sf_dir))


RESULTS_BY_SEASON_SQL = f"""
  select league_season, count(*) filter (where resultado = 'Local') as "Local",
    count(*) filter (where resultado = 'Empate') as "Empate",
    count(*) filter (where resultado = 'Visitante') as "Visitante"
  from ({MW}) group by 1 order by 1"""


@query("results_by_season", RESULTS_BY_SEASON_SQL)
def results_by_season(spark, sf_dir):
    return metrics.results_by_season(_outcomes(spark, sf_dir))


@query("sort_values", f"select distinct league_season from ({M}) order by 1")
def _sort_values(spark, sf_dir):
    return shaping.sort_values(standins.matches(spark, sf_dir), "league_season")


@query("head_n", f"select * from ({M}) order by fixture_date desc, fixture_id limit 3")
def _head_n(spark, sf_dir):
    return shaping.head_n(
        standins.matches(spark, sf_dir), 3, F.col("fixture_date").desc(), "fixture_id"
    )


# --- Table pipelines ----------------------------------------------------------------


@query(
    "bronze_static",
    f"""select league_id as "league__id", league_name as "league__name",
          league_type as "league__type", league_logo as "league__logo",
          country_name as "country__name", country_code as "country__code",
          country_flag as "country__flag", season_text from ({LEAGUES})""",
)
def _bronze_static(spark, sf_dir):
    landing, path = scratch_dir(spark, "landing"), scratch_dir(spark, "bronze_static")
    _land(standins.league_records(spark, sf_dir), landing)
    records = json_envelope(spark, landing, LEAGUE_RECORD, layout="lines").records
    bronze.load_static(records, path)
    stored = read_table(spark, path)
    return stored.select(*[fn.quoted(c) for c in stored.columns if c != "seasons"], _season_text())


@query(
    "bronze_static_countries",
    """select s_name as name, concat('C', cast(s_nationkey as varchar)) as code,
         case when s_acctbal > 0 then concat('flag/', cast(s_suppkey as varchar)) end as flag
       from supplier""",
)
def _bronze_static_countries(spark, sf_dir):
    path = scratch_dir(spark, "bronze_static_countries")
    bronze.load_static(standins.country_records(spark, sf_dir), path)
    return read_table(spark, path)


@query("bronze_fixtures", BRONZE)
def _bronze_fixtures(spark, sf_dir):
    path = scratch_dir(spark, "bronze_fixtures")
    records = standins.fixture_records(spark, sf_dir)
    bronze.load_fixtures(records, path)
    bronze.load_fixtures(records, path)
    return read_table(spark, path)


@query("silver_fixtures", SILVER)
def _silver_fixtures(spark, sf_dir):
    path = scratch_dir(spark, "silver_fixtures")
    bronze.store(silver.silver_fixtures(_bronze(spark, sf_dir)), path)
    return read_table(spark, path)


@query(
    "silver_leagues",
    f"""select * exclude (first_year, first_current, season_text) from ({LEAGUES})
        where current_year is not null""",
)
def _silver_leagues(spark, sf_dir):
    path = scratch_dir(spark, "silver_leagues")
    flat = bronze.bronze_static(standins.league_records(spark, sf_dir))
    write_table(silver.silver_leagues(flat), path)
    return read_table(spark, path)


@query("gold_fixtures", GOLD)
def _gold_fixtures(spark, sf_dir):
    path = scratch_dir(spark, "gold_fixtures")
    bronze.store(gold.gold_fixtures(silver.silver_fixtures(_bronze(spark, sf_dir))).curated, path)
    return read_table(spark, path)


@query(
    "gold_fixtures_full",
    f"select * replace (cast(cast(event_date as date) as timestamp) as event_date) from ({SILVER})",
)
def _gold_fixtures_full(spark, sf_dir):
    return gold.gold_fixtures(silver.silver_fixtures(_bronze(spark, sf_dir))).full


def _report(metric: str, item: str, measure: str, value: str, rest: str) -> str:
    return (
        f"select '{metric}' as metric, {item} as item, '{measure}' as measure,"
        f" cast({value} as double) as value {rest}"
    )


def _report_sql() -> str:
    mw = f"from ({MW})"
    parts = [
        _report("row_count", "''", "rows", "count(*)", mw),
        _report("goals_sum", "''", "goals", "sum(total_goals)", mw),
        _report(
            "value_counts", "resultado", "matches", "count(*)",
            f"{mw} where resultado is not null group by resultado",
        ),
    ]
    for measure, value in (
        ("matches", "count(*)"),
        ("pct", "round_even(100.0 * count(*) / (select count(*) from orders), 1)"),
    ):
        parts.append(
            _report(
                "result_distribution", "resultado", measure, value,
                f"{mw} where resultado is not null group by resultado",
            )
        )
    for metric, labels, names in (
        ("goals_stats", {"": "total_goals"}, "mean|median|mode|std"),
        (
            "stats_by_category",
            {
                "Goles totales": "total_goals",
                "Goles de local": "goals_home",
                "Goles de visitante": "goals_away",
            },
            "Media|Mediana|Moda|Desvío estándar",
        ),
    ):
        for label, column in labels.items():
            for name in names.split("|"):
                parts.append(
                    _report(
                        metric, f"'{label}'", name, f's."{name}"',
                        f"from (select {_stats_sql(column, names)} {mw}) s",
                    )
                )
    for side, column in (("Local", "goals_home"), ("Visitante", "goals_away")):
        parts.append(_report("goals_by_condition", f"'{side}'", "Goles", f"sum({column})", mw))
    parts.append(
        _report(
            "goals_histogram", "cast(b.goals as varchar)", "matches", "count(m.total_goals)",
            f"""from range(0, (select max(total_goals) + 1 {mw})) b(goals)
                left join ({MW}) m on m.total_goals = b.goals group by b.goals""",
        )
    )
    parts.append(
        _report(
            "elapsed_counts", "cast(fixture_status_elapsed as varchar)", "matches", "count(*)",
            f"{mw} where fixture_status_elapsed is not null group by fixture_status_elapsed",
        )
    )
    for result in ("Local", "Empate", "Visitante"):
        parts.append(
            _report(
                "results_by_season", "cast(league_season as varchar)", result,
                f"count(*) filter (where resultado = '{result}')", f"{mw} group by league_season",
            )
        )
    return " union all ".join(parts)


@query("gold_metrics", _report_sql())
def _gold_metrics(spark, sf_dir):
    return metrics.metrics_report(metrics.gold_metrics(_outcomes(spark, sf_dir)))


@query("gold_metrics_stored", _report_sql())
def _gold_metrics_stored(spark, sf_dir):
    """Counts kept by season: all of them first, then those of a season that was changed and
    of one that comes last are counted anew."""
    path = scratch_dir(spark, "gold_counts")
    df = _outcomes(spark, sf_dir)
    first, last = df.agg(F.min("league_season"), F.max("league_season")).first()
    late = F.col("league_season").isin(first, last)
    seasons = [r[0] for r in df.filter(~late).select("league_season").distinct().collect()]
    gold.refresh_counts(df.filter(~late), path, seasons, "league_season")
    gold.refresh_counts(df.filter(late).limit(0), path, [first], "league_season")
    gold.refresh_counts(df.filter(late), path, [first, last], "league_season")
    gold.refresh_counts(df.filter(late), path, [first, last], "league_season")
    return metrics.metrics_report(gold.stored_metrics(spark, path))


_WIDE = """select o_orderstatus as fixture_status_short, o_totalprice as price, count(*) as n
           from orders group by all"""


@query(
    "stats_of_wide_measure",
    f"""select fixture_status_short, round_even(avg_price, 2) as mean, round_even(median_price, 2) as median,
          mode, round_even(std_price, 2) as std
        from (select o_orderstatus as fixture_status_short, avg(o_totalprice) as avg_price,
                median(o_totalprice) as median_price, stddev_samp(o_totalprice) as std_price
              from orders group by all)
        join (select fixture_status_short, price as mode from ({_WIDE})
              qualify row_number() over (partition by fixture_status_short order by n desc, price) = 1)
          using (fixture_status_short)""",
)
def _stats_of_wide_measure(spark, sf_dir):
    """Statistics of prices by status, with the selection of medians forced to narrow."""
    orders = standins.table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("fixture_status_short"), F.col("o_totalprice").cast("double").alias("price")
    )
    return metrics.wide_stats(orders, "price", ["fixture_status_short"], few=500)


_SKETCHED = ["league_id", "fixture_status_short", "teams_home_name", "match_winner"]


@query(
    "n_unique_sketched",
    " union all ".join(
        f"select '{c}' as column_name, count(distinct {c}) as n_unique from ({MW})" for c in _SKETCHED
    ),
)
def _n_unique_sketched(spark, sf_dir):
    """Sketches stored for each season and united; with so few values they are exact."""
    path = scratch_dir(spark, "sketches")
    sketches = metrics.unique_sketches(_outcomes(spark, sf_dir), _SKETCHED, ["league_season"])
    write_table(sketches, path)
    return metrics.n_unique_of_sketches(read_table(spark, path), _SKETCHED)


@query("medallion_flow", GOLD)
def _medallion_flow(spark, sf_dir):
    """All landed days in one run: landing, Bronze, Silver, Gold."""
    base = scratch_dir(spark, "medallion_flow")
    records = standins.fixture_records(spark, sf_dir)
    day = F.substring(F.col("fixture.date"), 1, 10).alias("day")
    standins.envelopes(records, day).write.partitionBy("day").text(f"{base}/landing/fixtures")
    lake = flow.Lake(
        root=f"{base}/lake",
        landing=f"{base}/landing",
        layout="lines",
        day_folder="day={day}",
        export=False,
    )
    first, last = _day_bounds(spark, sf_dir)
    flow.run(spark, lake, last + dt.timedelta(days=1), since=first)
    return read_table(spark, lake.table("gold", "fixtures"))


@query("medallion_flow_daily", GOLD)
def _medallion_flow_daily(spark, sf_dir):
    """A backfill and then the last days one by one, each handing its day from layer to
    layer; what is exported in the end."""
    base = scratch_dir(spark, "medallion_flow_daily")
    records = standins.fixture_records(spark, sf_dir)
    day = F.substring(F.col("fixture.date"), 1, 10).alias("day")
    standins.envelopes(records, day).write.partitionBy("day").text(f"{base}/landing/fixtures")
    lake = flow.Lake(
        root=f"{base}/lake", landing=f"{base}/landing", layout="lines", day_folder="day={day}"
    )
    first, last = _day_bounds(spark, sf_dir)
    flow.run(spark, replace(lake, export=False), last - dt.timedelta(days=2), since=first)
    for days in (2, 1, 0):
        flow.run(spark, replace(lake, export=not days), last - dt.timedelta(days=days - 1))
    return spark.read.parquet(lake.table("exports", "fixtures_gold") + ".parquet")


# No record of the stand-ins has a key that its schema does not declare.
_STREAMED = f"select *, cast(null as varchar) as undeclared from ({BRONZE})"


@query("incremental_stream", _STREAMED)
def _incremental_stream(spark, sf_dir):
    base = scratch_dir(spark, "incremental_stream")
    _land(standins.fixture_records(spark, sf_dir), f"{base}/landing")
    incremental_stream(
        spark, f"{base}/landing", f"{base}/bronze", f"{base}/checkpoint", layout="lines"
    ).awaitTermination()
    return read_table(spark, f"{base}/bronze")


@query(
    "incremental_stream_replay",
    f"select * replace (case when fixture_id % 50 <> 0 then fixture_id end as fixture_id) from ({_STREAMED})",
)
def _incremental_stream_replay(spark, sf_dir):
    """A batch whose end the checkpoint has not noted comes again; some matches have no key."""
    base = scratch_dir(spark, "incremental_stream_replay")
    number = F.when(F.col("fixture.id") % 50 != 0, F.col("fixture.id"))
    records = standins.fixture_records(spark, sf_dir)
    _land(records.withColumn("fixture", F.col("fixture").withField("id", number)), f"{base}/landing")
    for _ in range(2):
        incremental_stream(
            spark, f"{base}/landing", f"{base}/bronze", f"{base}/checkpoint", layout="lines"
        ).awaitTermination()
        files.delete(spark, f"{base}/checkpoint/commits")
    return read_table(spark, f"{base}/bronze")
