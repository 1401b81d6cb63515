import json

import pytest

from matchlake.operators.shaping import flatten_nested
from matchlake.schemas import COUNTRY_RECORD, FIXTURE_RECORD, LEAGUE_RECORD
from matchlake.sources import files, json_envelope, split_documents
from matchlake.sources.landing import parse_documents, parsed_once, read_documents, undeclared_value


def put(folder, name, content):
    folder.mkdir(parents=True, exist_ok=True)
    text = content if isinstance(content, str) else json.dumps(content)
    (folder / name).write_text(text)


def match(number, **goals):
    return {"fixture": {"id": number, "date": "2025-09-01T18:00:00+00:00"}, "goals": goals}


def test_documents(spark, tmp_path):
    put(tmp_path, "a.json", json.dumps({"response": [match(1, home=1, away=0), match(2)]}, indent=1))
    put(tmp_path, "b.json", {"response": []})
    put(tmp_path, "c.json", {"errors": ["none"]})
    put(tmp_path, "d.json", '{"response": [{"fixture": {"id": 3}}')
    put(tmp_path, "e.json", {"response": None})
    got = json_envelope(spark, str(tmp_path), FIXTURE_RECORD)
    flat = flatten_nested(got.records).select("`fixture.id`", "`goals.home`", "`fixture.venue.id`")
    assert sorted(tuple(r) for r in flat.collect()) == [(1, 1, None), (2, None, None)]
    rejects = sorted(
        (r["source_file"].rsplit("/", 1)[1], r["reason"], r["document"] is not None)
        for r in got.rejects.collect()
    )
    assert rejects == [
        ("c.json", "no data field", False),
        ("d.json", "invalid document", True),
        ("e.json", "no data field", False),
    ]
    assert got.rejects.select("document").count() == 3


def test_value_of_another_type_rejects_its_record_alone(spark, tmp_path):
    records = [match(1), {"fixture": {"id": "one"}}, match(2, home=1.5), "text", None, [match(3)], match(4)]
    put(tmp_path, "a.json", {"response": records})
    got = json_envelope(spark, str(tmp_path), FIXTURE_RECORD)
    assert sorted(r["fixture"]["id"] for r in got.records.collect()) == [1, 4]
    rejects = sorted((r["reason"], r["document"] or "") for r in got.rejects.collect())
    assert rejects == [
        ("invalid record", ""),
        ("invalid record", json.dumps([match(3)], separators=(",", ":"))),
        ("invalid record", "text"),
        ("invalid value", '{"fixture":{"id":"one"}}'),
        ("invalid value", json.dumps(match(2, home=1.5), separators=(",", ":"))),
    ]


def test_undeclared_keys_are_kept(spark, tmp_path):
    seen = {**match(1), "odds": [1.5, {"x": "y"}], "weather": None}
    seen["fixture"] |= {"attendance": 40_000, "venue": {"id": 3, "surface": "grass \"A\""}}
    put(tmp_path, "a.json", {"response": [seen, match(2)]})
    # A key that an object repeats, and one that only looks like a path.
    put(tmp_path, "b.json", '{"response": [{"fixture": {"id": 3}, "new": 1, "new": 2, "fixture.id": 7}]}')
    found = json_envelope(spark, str(tmp_path), FIXTURE_RECORD, undeclared=True).records
    rest = {r["fixture"]["id"]: json.loads(r["undeclared"] or "{}") for r in found.collect()}
    assert rest == {
        1: {
            "odds": '[1.5,{"x":"y"}]', "fixture.attendance": "40000", "fixture.venue.surface": 'grass "A"',
            "weather": None,
        },
        2: {},
        3: {"new": "2", "fixture.id": "7"},
    }
    value = found.filter("fixture.id = 1").select(undeclared_value("fixture.attendance")).first()[0]
    assert value == "40000"


def test_undeclared_keys_of_list_elements(spark, tmp_path):
    league = {"league": {"id": 1}, "seasons": [{"year": 2020, "current": True}, {"year": 2021, "coverage": {"odds": True}}]}
    plain = {"league": {"id": 2}, "seasons": [{"year": 2020}]}
    put(tmp_path, "a.json", {"response": [league, plain]})
    found = json_envelope(spark, str(tmp_path), LEAGUE_RECORD, undeclared=True).records
    rest = {r["league"]["id"]: r["undeclared"] for r in found.collect()}
    assert rest[2] is None
    assert json.loads(json.loads(rest[1])["seasons"]) == league["seasons"]


def test_required_fields_and_lists_of_envelopes(spark, tmp_path):
    put(tmp_path, "a.json", [{"response": [match(1), {"fixture": {"id": 2}}]}, {"response": [match(3)]}])
    put(tmp_path, "b.json", "\ufeff  " + json.dumps({"response": [match(4)]}))
    put(tmp_path, "c.json", "")
    raw = read_documents(spark, str(tmp_path))
    got = split_documents(parse_documents(raw, FIXTURE_RECORD, required=("fixture.date",)))
    assert sorted(r["fixture"]["id"] for r in got.records.collect()) == [1, 3, 4]
    assert [(r["reason"], r["document"]) for r in got.rejects.collect()] == [("no fixture.date", '{"fixture":{"id":2}}')]


def test_parsed_once_leaves_nothing(spark, tmp_path):
    put(tmp_path / "in", "a.json", {"response": [match(1), {"fixture": {"id": "x"}}]})
    parsed = parse_documents(read_documents(spark, str(tmp_path / "in")), FIXTURE_RECORD)
    with parsed_once(parsed) as held:
        (folder,) = {f.rsplit("/", 1)[0] for f in held.inputFiles()}
        assert split_documents(held).records.count() == 1 == split_documents(held).rejects.count()
        assert "json" not in held._jdf.queryExecution().toString()
    assert not files.exists(spark, folder)


def test_lines(spark, tmp_path):
    lines = [json.dumps({"response": [match(n)]}) for n in range(5)]
    put(tmp_path, "a.json", "\n".join([*lines, "garbage", '{"other": 1}']))
    got = json_envelope(spark, str(tmp_path), FIXTURE_RECORD, layout="lines")
    assert got.records.count() == 5
    assert sorted(r["reason"] for r in got.rejects.collect()) == ["invalid document", "no data field"]
    with pytest.raises(ValueError):
        json_envelope(spark, str(tmp_path), FIXTURE_RECORD, layout="rows")


def test_without_a_data_field_the_document_is_the_record(spark, tmp_path):
    put(tmp_path, "a.json", [{"name": "Chile", "code": "CL"}, {"name": "World"}])
    put(tmp_path, "b.json", {"name": "Peru", "flag": "f"})
    put(tmp_path, "c.json", "{")
    got = json_envelope(spark, str(tmp_path), COUNTRY_RECORD, data_field=None)
    assert sorted(tuple(r) for r in got.records.collect()) == [
        ("Chile", "CL", None),
        ("Peru", None, "f"),
        ("World", None, None),
    ]
    assert [r["reason"] for r in got.rejects.collect()] == ["invalid document"]


def test_other_data_field_and_folders(spark, tmp_path):
    put(tmp_path / "x", "a.json", {"data": [{"league": {"id": 1}, "seasons": [{"year": 2020}]}]})
    got = json_envelope(spark, str(tmp_path), LEAGUE_RECORD, data_field="data", recursive=True)
    assert got.records.first()["seasons"][0]["year"] == 2020
