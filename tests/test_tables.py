import pytest
from pyspark.sql import functions as F

from matchlake.sources import (
    export_csv,
    export_parquet,
    files,
    merge_where,
    read_partition_day,
    read_partition_days,
    read_table,
    save_new,
    save_upsert,
    save_upsert_where,
    table_exists,
    table_path,
    write_table,
)
from matchlake.sources.tables import add_columns

SCHEMA = "fixture_id long, event_date string, goals long"


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "lake with space" / "t")


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_table_path():
    assert table_path("/lake/", "silver", "api", "leagues") == "/lake/silver/api/leagues"
    with pytest.raises(ValueError):
        table_path("/lake", "copper", "api", "leagues")


def test_modes(spark, path):
    one, two = frame(spark, (1, "2025-09-01", 1)), frame(spark, (2, "2025-09-02", None))
    write_table(one, path, "error")
    with pytest.raises(FileExistsError):
        write_table(two, path, "error")
    write_table(two, path, "ignore")
    assert rows(read_table(spark, path)) == [(1, "2025-09-01", 1)]
    write_table(one, path, "append")
    assert read_table(spark, path).count() == 2
    write_table(two, path)
    assert rows(read_table(spark, path)) == [(2, "2025-09-02", None)]
    with pytest.raises(ValueError):
        write_table(one, path, "replace")


def test_overwrite_may_read_the_table_it_replaces(spark, path):
    write_table(frame(spark, (1, "a", 1), (2, "b", 2)), path, partition_cols="event_date")
    write_table(read_table(spark, path).filter("goals = 2"), path, partition_cols="event_date")
    assert rows(read_table(spark, path)) == [(2, "b", 2)]


def test_failed_overwrite_keeps_the_old_table(spark, path):
    write_table(frame(spark, (1, "a", 1)), path)
    broken = frame(spark, (2, "b", 2)).withColumn(
        "goals", F.raise_error(F.lit("broken")).cast("long")
    )
    with pytest.raises(Exception, match="broken"):
        write_table(broken, path)
    assert rows(read_table(spark, path)) == [(1, "a", 1)]


@pytest.mark.parametrize("failing", [0, 1])
def test_a_swap_that_breaks_off_loses_nothing(spark, path, monkeypatch, failing):
    write_table(frame(spark, (1, "a", 1)), path)
    real, calls = files.rename, []

    def rename(session, old, new):
        calls.append(new)
        if len(calls) == failing + 1:
            raise OSError("broken off")
        real(session, old, new)

    monkeypatch.setattr(files, "rename", rename)
    with pytest.raises(OSError, match="broken off"):
        write_table(frame(spark, (2, "b", 2)), path)
    monkeypatch.undo()
    save_new(frame(spark, (3, "c", 3)), path, "fixture_id")
    first = (2, "b", 2) if failing else (1, "a", 1)
    assert rows(read_table(spark, path)) == [first, (3, "c", 3)]


def test_partition_text_stays_text(spark, path):
    write_table(frame(spark, (1, "2025-09-01", 1)), path, partition_cols=["event_date"])
    got = read_table(spark, path)
    assert got.dtypes == [("fixture_id", "bigint"), ("event_date", "string"), ("goals", "bigint")]


def test_several_partition_columns_and_null_values(spark, path):
    data = [(1, "2025-09-01", 1), (2, None, 1), (3, "2025-09-01", None)]
    write_table(frame(spark, *data), path, partition_cols=["event_date", "goals"])
    write_table(frame(spark, (4, None, None)), path, "append")
    assert rows(read_table(spark, path)) == sorted([*data, (4, None, None)], key=str)
    assert files.exists(spark, f"{path}/event_date=2025-09-01/goals=1")


def test_existence(spark, tmp_path):
    bare = tmp_path / "bare"
    bare.mkdir()
    assert not table_exists(spark, str(bare))
    (bare / "_SUCCESS").write_text("")
    assert not table_exists(spark, str(bare))
    with pytest.raises(Exception):
        read_table(spark, str(tmp_path / "absent"))
    save_new(frame(spark), str(bare), "fixture_id", "event_date")
    assert table_exists(spark, str(bare))
    assert read_table(spark, str(bare)).count() == 0
    foreign = str(tmp_path / "foreign")
    spark.range(3).write.parquet(foreign)
    assert table_exists(spark, foreign) and read_table(spark, foreign).count() == 3


def test_read_partition_day(spark, path):
    data = [(1, "2025-08-31", 1), (2, "2025-09-01", 2), (3, "2025-09-02", 3)]
    for typed in (frame(spark, *data), frame(spark, *data).withColumn("event_date", F.to_date("event_date"))):
        write_table(typed, path, partition_cols="event_date")
        got = read_partition_day(spark, path, "2025-09-02")
        assert [r["fixture_id"] for r in got.collect()] == [2]
        scan = got._jdf.queryExecution().executedPlan().toString()
        pruned = scan[scan.index("PartitionFilters: [") :].split("]")[0]
        assert "event_date" in pruned and "cast" not in pruned
        assert read_partition_day(spark, path, "2024-01-01").count() == 0
        several = read_partition_days(spark, path, "2025-09-01", "2025-09-02")
        assert sorted(r["fixture_id"] for r in several.collect()) == [2, 3]
    with pytest.raises(RuntimeError, match="could not read"):
        read_partition_day(spark, path + "-absent", "2025-09-02")


def test_save_new_freezes_stored_rows(spark, path):
    first = [(1, "2025-09-01", None), (2, "2025-09-01", 2), (2, "2025-09-01", 3)]
    save_new(frame(spark, *first), path, "fixture_id", "event_date")
    assert rows(read_table(spark, path)) == sorted(first, key=str)  # the batch as it is
    batch = frame(spark, (1, "2025-09-02", 5), (3, "2025-09-02", 1), (None, "2025-09-02", 1))
    save_new(batch, path, "fixture_id")
    expected = [*first, (3, "2025-09-02", 1), (None, "2025-09-02", 1)]
    assert rows(read_table(spark, path)) == sorted(expected, key=str)
    save_new(batch, path, "fixture_id")  # only the row without a key comes again
    assert rows(read_table(spark, path)) == sorted(
        [*expected, (None, "2025-09-02", 1)], key=str
    )


def test_append_fits_columns_to_the_table(spark, path):
    save_new(frame(spark, (1, "2025-09-01", 1)), path, "fixture_id", "event_date")
    shuffled = spark.createDataFrame([(4, 2, "x")], "goals int, fixture_id int, event_date string")
    save_new(shuffled, path, "fixture_id")
    assert rows(read_table(spark, path)) == [(1, "2025-09-01", 1), (2, "x", 4)]
    with pytest.raises(ValueError, match="referee"):
        save_new(shuffled.withColumn("referee", F.lit("r")), path, "fixture_id")


def test_tables_of_other_writers(spark, path):
    frame(spark, (1, "a", 1)).write.partitionBy("event_date").parquet(path)
    save_new(frame(spark, (1, "b", 1), (2, "b", 2)), path, "fixture_id", "event_date")
    assert files.exists(spark, f"{path}/event_date=b")
    got = read_table(spark, path).select("fixture_id", "event_date", "goals")
    assert rows(got) == [(1, "a", 1), (2, "b", 2)]


def test_merge_where(spark, path):
    merge_where(frame(spark, (1, "a", 1)), path, "target.fixture_id = source.fixture_id", "event_date")
    merge_where(
        frame(spark, (1, "b", 1), (2, "b", 2)), path, "target.fixture_id = source.fixture_id"
    )
    assert rows(read_table(spark, path)) == [(1, "a", 1), (2, "b", 2)]
    changed = "target.fixture_id = source.fixture_id and target.goals >= source.goals"
    merge_where(frame(spark, (1, "c", 1), (2, "c", 3)), path, changed)
    assert rows(read_table(spark, path)) == [(1, "a", 1), (2, "b", 2), (2, "c", 3)]


@pytest.mark.parametrize("partition", [None, "event_date", ["event_date", "goals"]])
def test_save_upsert(spark, path, partition):
    stored = [
        (1, "2025-09-01", None),
        (2, "2025-09-01", 2),
        (3, "2025-09-02", 3),
        (4, None, 4),
        (5, "2025-09-05", 5),
        (None, "2025-09-02", 6),
    ]
    write_table(frame(spark, *stored), path, partition_cols=partition)
    # 1: late result; 3: moved to another day; 4: moved out of the partition without a
    # day, which is left empty; 6: new, on a day of its own.
    batch = [(1, "2025-09-01", 7), (3, "2025-09-04", 3), (4, "2025-09-04", 4), (6, "2025-09-06", 0)]
    expected = sorted([r for r in stored if r[0] not in (1, 3, 4)] + batch, key=str)
    for _ in range(2):  # a rerun changes nothing
        save_upsert(frame(spark, *batch), path, "fixture_id")
        assert rows(read_table(spark, path)) == expected
    with pytest.raises(ValueError, match="repeats a key"):
        save_upsert(frame(spark, batch[0], batch[0]), path, "fixture_id")
    assert rows(read_table(spark, path)) == expected


def test_upsert_leaves_untouched_partitions_alone(spark, path):
    write_table(
        frame(spark, (1, "2025-09-01", 1), (2, "2025-09-02", 2)), path, partition_cols="event_date"
    )

    def files_of(day):
        return sorted(f for f in read_table(spark, path).inputFiles() if day in f)

    before = files_of("2025-09-02"), files_of("2025-09-01")
    save_upsert(frame(spark, (1, "2025-09-01", 9)), path, "fixture_id")
    assert files_of("2025-09-02") == before[0]
    assert files_of("2025-09-01") != before[1]


@pytest.fixture
def quick(spark):
    """Many small jobs: one partition is enough for each."""
    keys = {"spark.sql.shuffle.partitions": "1", "spark.sql.leafNodeDefaultParallelism": "1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _break_off(monkeypatch, step):
    """Make the given step of all that change files fail; returns whether it came to it."""
    count = {"steps": 0}

    def counted(real):
        def run(*args):
            count["steps"] += 1
            if count["steps"] == step:
                raise OSError("broken off")
            return real(*args)

        return run

    for name in ("rename", "delete", "write_text", "make_parents"):
        monkeypatch.setattr(files, name, counted(getattr(files, name)))
    return count


def test_an_upsert_that_breaks_off_loses_nothing(quick, tmp_path, monkeypatch):
    spark = quick
    stored = [(i, f"2025-09-0{1 + i % 3}", i) for i in range(6)] + [(None, "2025-09-02", 7)]
    moved = [(0, "2025-09-05", 50), (3, "2025-09-05", 53), (4, "2025-09-02", 54), (9, "2025-09-06", 9)]
    new = sorted([r for r in stored if r[0] not in (0, 3, 4)] + moved, key=str)
    step, done = 0, False
    while not done:
        step += 1
        path = str(tmp_path / f"t{step}")
        write_table(frame(spark, *stored), path, partition_cols="event_date")
        count = _break_off(monkeypatch, step)
        try:
            save_upsert(frame(spark, *moved), path, "fixture_id")
        except OSError:
            pass
        done = count["steps"] < step
        monkeypatch.undo()
        # Whatever was left, the next writer finds the old rows or the new ones, and so a rerun works.
        write_table(frame(spark), path, "append")
        found = rows(read_table(spark, path))
        assert found in (new, sorted(stored, key=str)), step
        save_upsert(frame(spark, *moved), path, "fixture_id")
        assert rows(read_table(spark, path)) == new
        assert files.beginning_with(spark, path + "__parts_") == []
    assert step > 6 and found == new


def test_a_batch_that_comes_again_changes_nothing(quick, tmp_path, monkeypatch):
    """Rows without a key included, wherever its first coming broke off."""
    spark = quick
    batches = [[(1, "2025-09-01", 1), (None, "2025-09-01", 2)], [(1, "2025-09-02", 3), (None, "2025-09-02", 4), (2, "2025-09-02", 5)]]
    for save, steps in ((save_new, range(1, 99)), (save_upsert, (4, 99))):
        for step in steps:
            path = str(tmp_path / f"{save.__name__}{step}")
            save(frame(spark, *batches[0]), path, "fixture_id", "event_date", batch=("s", 0))
            count = _break_off(monkeypatch, step)
            try:
                save(frame(spark, *batches[1]), path, "fixture_id", batch=("s", 1))
            except OSError:
                pass
            monkeypatch.undo()
            for number in (1, 0):
                save(frame(spark, *batches[number]), path, "fixture_id", batch=("s", number))
            assert read_table(spark, path).count() == 4, step
            if count["steps"] < step:
                break
        # Another stream has numbers of its own.
        save(frame(spark, (None, "2025-09-03", 6)), path, "fixture_id", batch=("t", 0))
        assert read_table(spark, path).count() == 5


def test_upsert_rewrites_only_files_with_a_match(spark, path):
    for day in range(1, 5):
        write_table(frame(spark, (day, f"2025-09-0{day}", day), (day + 10, "x", 0)), path, "append")
    name = lambda f: f.rsplit("/", 1)[1]
    before = set(map(name, read_table(spark, path).inputFiles()))
    save_upsert(frame(spark, (2, "2025-09-09", 0), (99, "y", 0)), path, "fixture_id")
    held = {r[0]: name(r[1]) for r in read_table(spark, path).select("fixture_id", "_metadata.file_path").collect()}
    assert len(held) == 9
    assert {k for k, f in held.items() if f not in before} <= {2, 99, 12}
    assert held[2] not in before and held[99] not in before


def test_upsert_where(spark, path):
    stored = [(1, "a", 1), (1, "b", 5), (2, "a", 2), (3, "a", None), (None, "a", 4)]
    write_table(frame(spark, *stored), path, partition_cols="event_date")
    later = "target.fixture_id = source.fixture_id and target.goals < source.goals"
    # 1 replaces one of its two rows, 2 is not later and is added, 3 compares with null.
    batch = [(1, "c", 3), (2, "c", 2), (3, "c", 9), (None, "c", 9)]
    save_upsert_where(frame(spark, *batch), path, later)
    expected = [(1, "b", 5), (2, "a", 2), (3, "a", None), (None, "a", 4), *batch]
    assert rows(read_table(spark, path)) == sorted(expected, key=str)
    before = rows(read_table(spark, path)), sorted(read_table(spark, path).inputFiles())
    with pytest.raises(ValueError, match="match one stored row"):
        save_upsert_where(frame(spark, (2, "d", 8), (2, "e", 9)), path, later)
    with pytest.raises(ValueError, match="needs an equality"):
        save_upsert_where(frame(spark, (2, "d", 8)), path, "target.goals < source.goals")
    assert (rows(read_table(spark, path)), sorted(read_table(spark, path).inputFiles())) == before
    # One row may replace several, and repeated keys that meet no stored row are all added.
    save_upsert_where(frame(spark, (1, "z", 0), (7, "z", 0), (7, "z", 0)), path, "target.fixture_id = source.fixture_id")
    found = rows(read_table(spark, path))
    assert [r for r in found if r[0] in (1, 7)] == [(1, "z", 0), (1, "z", 0), (7, "z", 0), (7, "z", 0)]
    fresh = path + "-fresh"
    save_upsert_where(frame(spark, *stored), fresh, later, "event_date")
    assert rows(read_table(spark, fresh)) == sorted(stored, key=str)


def test_a_reader_leaves_a_running_overwrite_alone(spark, path, monkeypatch):
    write_table(frame(spark, (1, "a", 1)), path)
    real, seen = files.rename, []

    def rename(session, old, new):
        real(session, old, new)
        if not files.exists(session, path):
            seen.append(rows(read_table(session, path)))

    monkeypatch.setattr(files, "rename", rename)
    write_table(frame(spark, (2, "b", 2)), path)
    assert seen == [[(2, "b", 2)]] and rows(read_table(spark, path)) == [(2, "b", 2)]


def test_further_columns(spark, path):
    write_table(frame(spark, (1, "a", 1)), path, partition_cols="event_date")
    add_columns(spark, path, frame(spark).withColumn("more", F.lit("x")).schema.fields)
    save_new(frame(spark, (2, "b", 2)).withColumn("more", F.lit("x")), path, "fixture_id")
    assert rows(read_table(spark, path)) == [(1, "a", 1, None), (2, "b", 2, "x")]


def test_first_upsert_writes_unpartitioned(spark, path):
    save_upsert(frame(spark, (1, "2025-09-01", 1)), path, "fixture_id")
    assert not files.exists(spark, f"{path}/event_date=2025-09-01")


def test_a_day_with_most_rows_is_several_files(spark, path):
    """A hot day is cut by adaptive execution, not written by one task."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "64kb")
    try:
        day = F.when(F.col("id") % 3 > 0, "2025-09-01").otherwise(
            F.concat(F.lit("2025-10-"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0"))
        )
        df = spark.range(0, 200_000, 1, 16).select(
            F.col("id").alias("fixture_id"), day.alias("event_date"), F.xxhash64("id").alias("goals")
        )
        write_table(df, path, partition_cols="event_date")
    finally:
        spark.conf.set(key, old)
    names = read_table(spark, path).inputFiles()
    assert sum("2025-09-01" in f for f in names) > 3
    assert read_table(spark, path).count() == 200_000


def test_exports(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, 'say "a", b', None), (2, "", 3)], "id long, name string, goals long"
    )
    export_csv(df, str(tmp_path / "x.csv"), single_file=True)
    export_csv(df, str(tmp_path / "x.csv"), single_file=True)
    parts = list((tmp_path / "x.csv").glob("part-*.csv"))
    assert len(parts) == 1
    assert parts[0].read_text() == 'id,name,goals\n1,"say ""a"", b",\n2,,3\n'
    export_parquet(df, str(tmp_path / "x.parquet"))
    assert rows(spark.read.parquet(str(tmp_path / "x.parquet"))) == rows(df)
