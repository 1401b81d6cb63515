import datetime as dt
import json
from dataclasses import replace
from pathlib import Path

import pytest

from matchlake.__main__ import main
from matchlake.plans import bronze
from matchlake.operators import metrics
from matchlake.plans.flow import COUNTS, Lake, run
from matchlake.plans.gold import stored_metrics
from matchlake.sources import read_table, table_exists, write_table
from matchlake.sources.landing import undeclared_value
from matchlake.streaming import incremental_stream


def match(number, date, home=None, away=None, **fixture):
    return {
        "fixture": {
            "id": number,
            "date": date,
            "referee": "R",
            "timezone": "UTC",
            "status": {"long": "Full", "short": "FT", "elapsed": 90},
            **fixture,
        },
        "league": {"id": 39, "name": "L", "country": "C", "season": 2025, "round": "1"},
        "teams": {
            "home": {"name": "A", "logo": "a", "winner": None},
            "away": {"name": "B", "logo": "b", "winner": None},
        },
        "goals": {"home": home, "away": away},
        "score": {
            part: {"home": None, "away": None}
            for part in ("halftime", "fulltime", "extratime", "penalty")
        },
    }


DAYS = {
    "2025-09-01": {
        "a.json": {
            "response": [
                match(
                    1, "2025-09-01T15:00:30+00:00", 2, 1,
                    periods={"first": 1756738830, "second": None}, venue={"id": 5, "name": "V"},
                ),
                match(2, "2025-09-01T23:59:59+00:00", periods={"first": None, "second": None}),
                match(3, "2025-09-01T10:00:00+00:00", 0, 0),
                match(3, "2025-09-01T10:00:00+00:00", 0, 0),
            ]
        },
        "bad.json": '{"response": [',
        "empty.json": {"response": []},
    },
    "2025-09-02": {
        # 2 arrives again with its result, 3 moved to this day, 4 is in another zone.
        "a.json": {
            "response": [
                match(2, "2025-09-01T23:59:59+00:00", 0, 4),
                match(3, "2025-09-02T10:00:00+00:00", 1, 0),
                match(4, "2025-09-01T23:30:00-03:00", 3, 3),
            ]
        },
        "other.json": {"errors": []},
    },
    "2025-09-03": {"a.json": {"response": [match(5, "2025-09-03T12:00:00+00:00", 1, 5)]}},
}


@pytest.fixture
def lake(tmp_path):
    for day, documents in DAYS.items():
        folder = tmp_path / "landing" / "fixtures" / day
        folder.mkdir(parents=True)
        for name, body in documents.items():
            text = body if isinstance(body, str) else json.dumps(body)
            (folder / name).write_text(text)
    for name, records in {
        "countries": [{"name": "Chile", "code": "CL"}, {"name": "World", "code": None}],
        "leagues": [
            {"league": {"id": 1}, "seasons": [{"year": 2024, "current": True}, {"year": 2025, "current": False}]},
            {"league": {"id": 2}, "seasons": [{"year": 2020, "current": False}]},
            {"league": {"id": 3}, "seasons": []},
        ],
    }.items():
        folder = tmp_path / "landing" / name
        folder.mkdir(parents=True)
        (folder / "all.json").write_text(json.dumps({"response": records}))
    return Lake(root=str(tmp_path / "lake"), landing=str(tmp_path / "landing"))


GOLD = ["fixture_id", "event_date", "goals_home", "goals_away", "match_winner"]


def gold(spark, lake):
    df = read_table(spark, lake.table("gold", "fixtures"))
    return sorted((tuple(r) for r in df.select(*GOLD).collect()), key=str)


INSERTED = [
    (1, "2025-09-01", 2, 1, "Home"),
    (2, "2025-09-01", None, None, None),
    (3, "2025-09-01", 0, 0, "Draw"),
    (3, "2025-09-01", 0, 0, "Draw"),
    (4, "2025-09-02", 3, 3, "Draw"),
    (5, "2025-09-03", 1, 5, "Away"),
]


@pytest.mark.parametrize("reread", [True, False])
def test_daily_runs(spark, lake, reread):
    lake = replace(lake, gold_rereads_all=reread)
    for as_of in ("2025-09-02", "2025-09-03", "2025-09-04", "2025-09-04", "2025-09-05"):
        result = run(spark, lake, as_of)
    assert gold(spark, lake) == INSERTED
    assert dict(result.full.dtypes)["event_date"] == "timestamp"
    assert {"total_goals", "fixture_periods_first"} <= set(result.full.columns)
    silver = read_table(spark, lake.table("silver", "fixtures"))
    one = silver.filter("fixture_id = 1").first()
    assert one["fixture_date"] == dt.datetime(2025, 9, 1, 15, 0)
    assert one["fixture_periods_first"] == dt.datetime(2025, 9, 1, 15, 0)
    assert not {"fixture_referee", "teams_home_winner", "league_logo"} & set(silver.columns)
    rejects = read_table(spark, lake.table("rejects", "fixtures"))
    assert sorted(r["reason"] for r in rejects.collect()) == ["invalid document", "no data field"]
    exported = spark.read.option("header", True).csv(
        lake.table("exports", "fixtures_gold") + ".csv"
    )
    assert exported.count() == len(INSERTED)
    parquet = spark.read.parquet(lake.table("exports", "fixtures_gold") + ".parquet")
    assert sorted((tuple(r) for r in parquet.select(*GOLD).collect()), key=str) == INSERTED


def test_days_of_a_run_that_broke_off_are_offered_again(spark, lake, monkeypatch):
    """Whichever layer's merge fails, the next day's run makes up for it."""
    real = bronze.store
    for failing in (2, 3):
        own = replace(lake, root=f"{lake.root}-{failing}", export=False)
        calls = []

        def store(*args):
            calls.append(args[1])
            if len(calls) == failing:
                raise OSError("broken off")
            return real(*args)

        monkeypatch.setattr(bronze, "store", store)
        with pytest.raises(OSError, match="broken off"):
            run(spark, own, "2025-09-02")
        monkeypatch.undo()
        run(spark, own, "2025-09-03")
        run(spark, own, "2025-09-04")
        assert gold(spark, own) == INSERTED


def test_the_last_day_reads_one_partition_of_each_layer(spark, lake, monkeypatch):
    run(spark, replace(lake, export=False), "2025-09-03", since="2025-09-01")
    read, real = [], bronze.store

    def store(df, path, *args):
        read.append({f.split("event_date=")[1][:10] for f in df.inputFiles() if "event_date=" in f})
        return real(df, path, *args)

    monkeypatch.setattr(bronze, "store", store)
    run(spark, lake, "2025-09-04")
    assert read[1:] == [{"2025-09-03"}, {"2025-09-03"}]
    monkeypatch.undo()
    full = replace(lake, root=f"{lake.root}-full", gold_rereads_all=True)
    run(spark, full, "2025-09-04", since="2025-09-01")
    assert gold(spark, lake) == gold(spark, full) == INSERTED


def test_a_bad_record_and_one_without_a_day_are_set_aside_alone(spark, lake):
    day = Path(lake.landing, "fixtures", "2025-09-03")
    records = [match(6, "2025-09-03T12:00:00+00:00", 1, 1), match(7, None), match(8, "2025-09-03T13:00:00+00:00", "x")]
    records[0]["fixture"]["attendance"] = 31_000
    (day / "b.json").write_text(json.dumps({"response": records}))
    run(spark, lake, "2025-09-04")
    assert [r[0] for r in gold(spark, lake)] == [5, 6]
    rejects = read_table(spark, lake.table("rejects", "fixtures")).collect()
    assert sorted((r["reason"], json.loads(r["document"])["fixture"]["id"]) for r in rejects) == [
        ("invalid value", 8), ("no fixture.date", 7),
    ]
    for layer in ("bronze", "silver"):
        rest = read_table(spark, lake.table(layer, "fixtures")).select("fixture_id", undeclared_value("fixture.attendance"))
        assert sorted(tuple(r) for r in rest.collect()) == [(5, None), (6, "31000")]


def test_a_table_of_before_gets_the_column_of_undeclared_keys(spark, lake):
    run(spark, replace(lake, export=False), "2025-09-02")
    for layer in ("bronze", "silver"):
        path = lake.table(layer, "fixtures")
        write_table(read_table(spark, path).drop("undeclared"), path, partition_cols="event_date")
    run(spark, replace(lake, export=False), "2025-09-04", since="2025-09-02")
    assert gold(spark, lake) == INSERTED
    assert read_table(spark, lake.table("silver", "fixtures")).filter("undeclared is not null").count() == 0


@pytest.mark.parametrize("mode", ["insert", "upsert"])
def test_counts_of_changed_days_equal_counts_over_all(spark, lake, mode):
    """Also where an upsert moves a match away from a day the batch does not have."""
    lake = replace(lake, merge_mode=mode, dedup_source=True, count=True, export=False)
    for as_of in ("2025-09-02", "2025-09-03", "2025-09-04"):
        full = run(spark, lake, as_of).full
    found = stored_metrics(spark, lake.table("gold", COUNTS))
    expected = metrics.gold_metrics(full)
    for name in ("row_count", "goals_sum", "result_distribution", "goals_stats", "results_by_season"):
        assert found[name].collect() == expected[name].collect(), name


def test_one_run_over_all_days_gives_the_same_tables(spark, lake):
    # Within one run nothing is stored yet, so every delivered row is new.
    run(spark, lake, "2025-09-04", since="2025-09-03")
    assert gold(spark, lake) == INSERTED[-1:]
    run(spark, lake, "2025-09-03", since="2025-09-02")
    run(spark, replace(lake, export=False), "2025-09-04", since="2025-09-01")
    ids = [r[0] for r in gold(spark, lake)]
    assert sorted(set(ids)) == [1, 2, 3, 4, 5]
    once = replace(lake, root=f"{lake.root}-once", export=False)
    run(spark, once, "2025-09-05", since="2025-09-01")
    assert gold(spark, once) == INSERTED


def test_batches_of_any_size_store_the_same(spark, lake, tmp_path):
    found = []
    for size, mode in ((1, "insert"), (1000, "insert"), (1, "upsert"), (1000, "upsert")):
        table = str(tmp_path / f"{mode}-{size}")
        incremental_stream(
            spark, f"{lake.landing}/fixtures", table, f"{table}-checkpoint",
            files_per_batch=size, merge_mode=mode, dedup_source=True,
        ).awaitTermination()
        rows = read_table(spark, table).select("fixture_id", "event_date", "`goals.home`").collect()
        found.append(sorted((tuple(r) for r in rows), key=str))
    assert found[0] == found[1] and found[2] == found[3]


def test_an_unreadable_payload_leaves_a_static_table(spark, lake):
    run(spark, lake, "2025-09-02", entities=("leagues",))
    path = next(p for p in Path(lake.landing, "leagues").rglob("*.json"))
    path.write_text(path.read_text()[:-20])
    for _ in range(2):
        with pytest.raises(ValueError, match="unreadable"):
            run(spark, lake, "2025-09-02", entities=("leagues",))
    assert read_table(spark, lake.table("bronze", "leagues")).count() == 3
    assert read_table(spark, lake.table("rejects", "leagues")).count() == 1


def test_upsert_mode_takes_late_results_and_moves(spark, lake):
    lake = replace(lake, merge_mode="upsert")
    with pytest.raises(ValueError, match="repeats a key"):
        run(spark, replace(lake, root=lake.root + "-strict"), "2025-09-02", since="2025-09-01")
    lake = replace(lake, dedup_source=True)
    for as_of in ("2025-09-02", "2025-09-03", "2025-09-04", "2025-09-05", "2025-09-03"):
        run(spark, lake, as_of)
    assert gold(spark, lake) == [
        (1, "2025-09-01", 2, 1, "Home"),
        (2, "2025-09-01", 0, 4, "Away"),
        (3, "2025-09-02", 1, 0, "Home"),
        (4, "2025-09-02", 3, 3, "Draw"),
        (5, "2025-09-03", 1, 5, "Away"),
    ]


def test_static_entities(spark, lake):
    for _ in range(2):
        assert run(spark, lake, "2025-09-02", entities=("countries", "leagues")) is None
    assert read_table(spark, lake.table("bronze", "countries")).count() == 2
    assert read_table(spark, lake.table("bronze", "leagues")).count() == 3
    silver = read_table(spark, lake.table("silver", "leagues"))
    got = [tuple(r) for r in silver.select("league_id", "min_year", "max_year", "current_year").collect()]
    assert got == [(1, 2024, 2025, 2024)]
    assert "seasons" not in silver.columns
    assert dict(silver.dtypes)["current_year"] == "int"


def test_command_line(spark, lake):
    main(["--root", lake.root, "--landing", lake.landing, "--as-of", "2025-09-04",
          "--gold-new-days", "--no-export"])
    assert gold(spark, lake) == INSERTED[-1:]
    assert not table_exists(spark, lake.table("exports", "fixtures_gold") + ".parquet")


def test_unknown_merge_mode(spark, lake):
    with pytest.raises(ValueError, match="merge mode"):
        run(spark, replace(lake, merge_mode="replace"), "2025-09-02")


def test_stream_equals_daily_batches(spark, lake, tmp_path):
    table, rejects = str(tmp_path / "bronze"), str(tmp_path / "rejects")

    def drain():
        incremental_stream(
            spark, f"{lake.landing}/fixtures", table, str(tmp_path / "checkpoint"),
            rejects=rejects, files_per_batch=1,
        ).awaitTermination()
        return sorted(r["fixture_id"] for r in read_table(spark, table).collect())

    first = drain()
    assert sorted(set(first)) == [1, 2, 3, 4, 5]
    assert drain() == first  # nothing new
    folder = Path(lake.landing) / "fixtures" / "2025-09-04"
    folder.mkdir()
    late = [match(n, "2025-09-04T10:00:00+00:00") for n in (1, 9)]
    (folder / "a.json").write_text(json.dumps({"response": late}))
    assert drain() == sorted([*first, 9])
    assert read_table(spark, rejects).count() == 2
    assert table_exists(spark, table)
