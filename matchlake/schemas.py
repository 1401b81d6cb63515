"""Payload schemas, column lists and per-entity settings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

LAYERS = ("bronze", "silver", "gold", "exports", "rejects")
CORRUPT = "_corrupt_record"
SOURCE_FILE = "_source_file"
# Text that sorts documents by the time they landed, and those of one time by their file.
DELIVERED = "_delivered"
# Keys of a record that its schema does not declare, as the text of a JSON object.
UNDECLARED = "undeclared"


def _record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


TEXT, LONG, INT, FLAG = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType()

_SIDES = _record(home=LONG, away=LONG)
_TEAM = _record(name=TEXT, logo=TEXT, winner=FLAG)

FIXTURE_RECORD = _record(
    fixture=_record(
        id=LONG,
        date=TEXT,
        referee=TEXT,
        timezone=TEXT,
        timestamp=LONG,
        periods=_record(first=LONG, second=LONG),
        venue=_record(id=LONG, name=TEXT, city=TEXT),
        status=_record(long=TEXT, short=TEXT, elapsed=LONG, extra=LONG),
    ),
    league=_record(id=LONG, name=TEXT, country=TEXT, season=INT, round=TEXT, logo=TEXT, flag=TEXT),
    teams=_record(home=_TEAM, away=_TEAM),
    goals=_SIDES,
    score=_record(halftime=_SIDES, fulltime=_SIDES, extratime=_SIDES, penalty=_SIDES),
)

LEAGUE_RECORD = _record(
    league=_record(id=LONG, name=TEXT, type=TEXT, logo=TEXT),
    country=_record(name=TEXT, code=TEXT, flag=TEXT),
    seasons=T.ArrayType(_record(year=INT, current=FLAG)),
)

COUNTRY_RECORD = _record(name=TEXT, code=TEXT, flag=TEXT)

# --- Fixed values: column names that results must carry ---------------------
SCORE_FLOAT_COLUMNS = [
    "score.extratime.home",
    "score.extratime.away",
    "score.penalty.home",
    "score.penalty.away",
]

SILVER_DROPPED_COLUMNS = [
    "fixture_referee",
    "fixture_timezone",
    "fixture_timestamp",
    "fixture_periods_second",
    "fixture_status_long",
    "fixture_status_extra",
    "league_logo",
    "league_flag",
    "teams_home_logo",
    "teams_away_logo",
]

WINNER_FLAG_COLUMNS = ["teams_home_winner", "teams_away_winner"]

SILVER_INT_COLUMNS = [
    "fixture_venue_id",
    "fixture_status_elapsed",
    "goals_home",
    "goals_away",
    "score_halftime_home",
    "score_halftime_away",
    "score_fulltime_home",
    "score_fulltime_away",
    "score_extratime_home",
    "score_extratime_away",
    "score_penalty_home",
    "score_penalty_away",
    "total_goals",
]

SILVER_TEXT_COLUMNS = [
    "fixture_venue_name",
    "fixture_venue_city",
    "fixture_status_short",
    "league_name",
    "league_country",
    "league_round",
    "teams_home_name",
    "teams_away_name",
    "match_winner",
]

GOLD_CATEGORY_COLUMNS = ["fixture_status_short", "league_round", "match_winner"]

GOLD_COLUMNS = [
    "fixture_id",
    "event_date",
    "league_id",
    "league_name",
    "teams_home_name",
    "teams_away_name",
    "goals_home",
    "goals_away",
    "match_winner",
]

LEAGUE_TEXT_COLUMNS = [
    "league_name",
    "league_type",
    "league_logo",
    "country_name",
    "country_code",
    "country_flag",
]

# Result codes, their display labels and the display order.
RESULT_LABELS = {"Home": "Local", "Away": "Visitante", "Draw": "Empate"}
RESULT_ORDER = ["Local", "Empate", "Visitante"]

# Display labels of the three goal measures, and of the two sides.
GOAL_MEASURES = {
    "Goles totales": "total_goals",
    "Goles de local": "goals_home",
    "Goles de visitante": "goals_away",
}
SIDE_MEASURES = {"Local": "goals_home", "Visitante": "goals_away"}
# -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Entity:
    """How one kind of payload is read, keyed and laid out."""

    name: str
    record: T.StructType
    keys: tuple[str, ...] = ()
    partition: tuple[str, ...] = ()
    data_field: str = "response"
    # Fields without which a record has no place in the tables.
    required: tuple[str, ...] = ()


ENTITIES = {
    e.name: e
    for e in (
        Entity("countries", COUNTRY_RECORD),
        Entity("leagues", LEAGUE_RECORD),
        Entity(
            "fixtures",
            FIXTURE_RECORD,
            keys=("fixture_id",),
            partition=("event_date",),
            required=("fixture.date",),
        ),
    )
}
