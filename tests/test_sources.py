"""Landing files: CSV edge rows, rejects, JSON documents, seed, sinks."""

import json

import pytest
from pyspark.sql import functions as F

from fixtures import csv_text, sample_rows, write_landing
from snapmart.schemas import OBSERVATION_HEADER
from snapmart.sources import categories, observations, seeds, sinks

BASE = 'v{},18.01.01,{},ch,10,2018-01-01T00:00:00.000Z,a|b,10,1,1,1,link,False,False,False,{}'


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    raw = tmp_path_factory.mktemp("messy")
    lines = [
        BASE.format(1, '"a, b"', "plain"),
        BASE.format(2, '"say ""hi"""', '"two\nlines"'),
        BASE.format(3, '""', ""),
        "v4,18.01.01,short,ch",
        BASE.format(5, "long", "kept") + ",extra",
        BASE.format(6, "longer", "kept") + ",,extra",
        BASE.format(7, "longest", "kept") + ",,",
        BASE.format(8, "fifteen", "x").rsplit(",", 1)[0],
        "v9",
    ]
    body = csv_text([], lines).encode() + BASE.format(10, "bad\\byte", "x").encode().replace(b"\\byte", b"\xff") + b"\n"
    (raw / "CAvideos.csv").write_bytes(body)
    (raw / "CAvideos-0001.csv").write_text(csv_text(sample_rows("CA")))
    (raw / "notes.csv").write_text("not,an,observation,file\n")
    return observations.read_observation_files(spark, str(raw))


def by_id(df):
    return {r.video_id: r for r in df.collect()}


def test_classes(landed):
    status = {i: r._parse_status for i, r in by_id(landed).items()}
    assert status == {
        "v1": "ok", "v2": "ok", "v3": "ok", "v4": "short", "v5": "truncated", "v6": "truncated", "v7": "truncated",
        "v8": "short", "v9": "short", "v10": "ok", "vCA00001": "ok", "vCA00002": "ok",
    }


def test_accepted_values(landed):
    rows = by_id(observations.accepted(landed))
    assert set(rows) == {"v1", "v2", "v3", "v5", "v6", "v7", "v10", "vCA00001", "vCA00002"}
    assert rows["v1"].title == "a, b"
    assert rows["v2"].title == 'say "hi"' and rows["v2"].description == "two\nlines"
    assert rows["v3"].title is None and rows["v3"].description is None
    assert rows["v5"].description == "kept"
    assert rows["v10"].title == "bad�"
    assert {r._source_region for r in rows.values()} == {"CA"}
    assert rows["vCA00001"]._source_file == "CAvideos-0001.csv" and rows["v1"]._loaded_at is not None


def test_classes_survive_column_pruning(landed):
    pruned = landed.select("video_id", observations.PARSE_STATUS)
    assert {r.video_id: r._parse_status for r in pruned.collect()} == {
        r.video_id: r._parse_status for r in landed.collect()
    }


def test_bad_bytes_are_flagged(landed):
    assert [r.video_id for r in landed.filter("_bad_bytes").collect()] == ["v10"]


def test_rejects_keep_the_text(landed):
    texts = [r._corrupt_record for r in observations.rejects(landed).collect()]
    assert len(texts) == 6 and any(t.startswith("v4,18.01.01,short,ch") for t in texts)


def test_parse_lines_agrees_with_the_file_scan(spark):
    lines = [BASE.format(1, '"a, b"', '"x\ny"'), "v4,short", BASE.format(5, "t", "d") + ",,"]
    parsed = observations.parse_lines(spark.createDataFrame([(x,) for x in lines], "line string"))
    got = [(r.video_id, r.title, r.description, r._parse_status) for r in parsed.collect()]
    assert got == [("v1", "a, b", "x\ny", "ok"), ("v4", None, None, "short"), ("v5", "t", "d", "truncated")]


def test_single_line_scan(spark, tmp_path):
    (tmp_path / "USvideos.csv").write_text(csv_text(sample_rows("US")))
    assert observations.read_observation_files(spark, str(tmp_path), multi_line=False).count() == 2


def test_category_documents(spark, tmp_path):
    item = {"id": "1", "snippet": {"title": "T", "assignable": True}}
    (tmp_path / "CA_category_id.json").write_text(json.dumps({"items": [item, {"id": 7, "snippet": {}}]}, indent=2))
    (tmp_path / "US_category_id.json").write_text(json.dumps({"items": []}))
    (tmp_path / "DE_category_id.json").write_text(json.dumps({"kind": "x"}))
    flat = categories.flatten_documents(categories.read_category_documents(spark, str(tmp_path))).collect()
    got = {(r._source_region, r.category_id, r.category_title, r.category_channel_id, r.assignable) for r in flat}
    assert got == {("CA", "1", "T", None, True), ("CA", "7", None, None, None)}


def test_broken_category_document_fails(spark, tmp_path):
    (tmp_path / "CA_category_id.json").write_text('{"items": [')
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        categories.read_category_documents(spark, str(tmp_path)).collect()


def test_seed(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text("region_code,region_name,locale,language_code\nCA,Canada,en_CA,en\n")
    assert seeds.read_region_seed(spark, str(path)).collect()[0].region_name == "Canada"
    assert seeds.read_region_seed(spark).count() == 10
    path.write_text("region_name,region_code,locale,language_code\nCanada,CA,en_CA,en\n")
    with pytest.raises(Exception, match="header"):
        seeds.read_region_seed(spark, str(path)).collect()


def test_rerun_does_not_add_rows(spark, tmp_path):
    df = spark.createDataFrame([("CA", 1), ("US", 2)], "_source_region string, n int")
    for _ in range(2):
        table = sinks.write_table(df, "rerun", ("_source_region",))
    assert table.count() == 2
    assert sinks.write_table(df.limit(1), "rerun", ("_source_region",)).count() == 1


def test_load_summary(spark, tmp_path):
    raw = write_landing(tmp_path, ["CA", "US"])
    summary = sinks.load_summary(observations.read_observation_files(spark, str(raw)))
    assert {r._source_region: r.n_rows for r in summary.collect()} == {"CA": 2, "US": 2, None: 4}


def test_json_report(spark, tmp_path):
    path = str(tmp_path / "report")
    for _ in range(2):
        sinks.write_json_report(spark.range(3), path)
    assert spark.read.json(path).count() == 3


def test_every_header_column_is_landed(landed):
    assert set(OBSERVATION_HEADER) <= set(landed.columns)
    assert landed.filter(F.col("_source_region") == "").count() == 0
