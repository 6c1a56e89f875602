"""Files read in splits give the rows the sequential reader gives."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from fixtures import csv_text, sample_rows
from snapmart.schemas import OBSERVATION_HEADER
from snapmart.sources import observations, split_records

TINY = {"spark.sql.files.maxPartitionBytes": "48", "spark.sql.files.openCostInBytes": "1",
        "spark.sql.files.minPartitionNum": "1"}


@pytest.fixture
def tiny_splits(spark):
    before = {k: spark.conf.get(k, None) for k in TINY}
    for k, v in TINY.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def rows(df):
    columns = [*OBSERVATION_HEADER, "_source_region", "_source_file", "_bad_bytes", "_parse_status"]
    # a quote still open at the end of a file takes the last line break along in the sequential reader only
    strip = lambda v: v.rstrip("\n") if isinstance(v, str) else v
    return collections.Counter(tuple(map(strip, r)) for r in df.select(*columns).collect())


def messy_field(rng):
    shape = rng.random()
    text = "".join(rng.choices(["a", "b ", ",", "\n", '""', "é"], k=rng.randint(0, 12)))
    if shape < 0.5:
        return "".join(c for c in text if c not in ',\n"')
    if shape < 0.9:
        return f'"{text}"'
    # quotes inside a bare field, text after a closing quote, lone quotes
    return rng.choice(["a\rb", '"c\r"', "end\r", 'a"b', 'x ""y""', f'"{text}"tail', ' "led by a blank"', 'end"', '"a" "b"'])


def test_agrees_with_the_sequential_reader(tiny_splits, tmp_path):
    rng = random.Random(7)
    for region in ("CA", "US", "DE", "FR"):
        for part in range(4):
            lines = [",".join(messy_field(rng) for _ in range(rng.choice([16] * 6 + [3, 18, 120]))) for _ in range(12)]
            text = csv_text([], lines).replace("\n", "\r\n" if part == 2 else "\n")
            (tmp_path / f"{region}videos-{part}.csv").write_bytes(text.encode())
    sequential = rows(observations.read_observation_files(tiny_splits, str(tmp_path)))
    parallel = rows(observations.read_landing(tiny_splits, str(tmp_path)))
    assert sum(sequential.values()) > 100
    assert parallel == sequential


def test_plain_sample(tiny_splits, tmp_path):
    (tmp_path / "CAvideos.csv").write_text(csv_text(sample_rows("CA")))
    (tmp_path / "USvideos.csv").write_bytes(csv_text(sample_rows("US")).replace("\n", "\r\n").encode())
    got = observations.read_landing(tiny_splits, str(tmp_path))
    assert rows(got) == rows(observations.read_observation_files(tiny_splits, str(tmp_path)))
    assert got.filter("_parse_status = 'ok'").count() == 4


def test_unclosed_record_is_kept_line_by_line(tiny_splits, tmp_path):
    lines = ['v1,"opened', *(f"line {i}" for i in range(300))]
    (tmp_path / "CAvideos.csv").write_text(csv_text(sample_rows("CA"), lines))
    (tmp_path / "USvideos.csv").write_text(csv_text(sample_rows("US"), ['v1,"closed', *(["x" * 30] * 50), 'at last"']))
    records = split_records.read_records(tiny_splits, str(tmp_path), "*videos*.csv", OBSERVATION_HEADER)
    loose = [r.line for r in records.filter("_unclosed").collect()]
    assert sorted(loose) == sorted(lines)
    # a record over many splits is whole if its quote closes
    assert sorted(r.line.count("x") for r in records.filter("NOT _unclosed").collect() if "closed" in r.line) == [1500]
    landed = observations.read_landing(tiny_splits, str(tmp_path))
    classes = collections.Counter((r._source_file, r._parse_status) for r in landed.collect())
    assert classes == {("CAvideos.csv", "unclosed"): 301, ("CAvideos.csv", "ok"): 2, ("USvideos.csv", "ok"): 2, ("USvideos.csv", "short"): 1}
    assert len(observations.accepted(landed).collect()) == 4
    assert all(r._corrupt_record for r in observations.rejects(landed).collect())


def test_more_splits_than_are_broadcast(tiny_splits, tmp_path):
    for region in ("CA", "US"):
        lines = [f'v{region},"opened', *(f"line {i}" for i in range(20)), 'end"', "v,plain"]
        (tmp_path / f"{region}videos.csv").write_text(csv_text(sample_rows(region), lines))
    broadcast = split_records.read_records(tiny_splits, str(tmp_path), "*videos*.csv", OBSERVATION_HEADER)
    got = collections.Counter(map(tuple, broadcast.collect()))
    threshold = tiny_splits.conf.get("spark.sql.autoBroadcastJoinThreshold")
    tiny_splits.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = split_records.read_records(tiny_splits, str(tmp_path), "*videos*.csv", OBSERVATION_HEADER, max_rows=1)
        plan = many._jdf.queryExecution().executedPlan().toString()
        shuffled = collections.Counter(map(tuple, many.collect()))
    finally:
        tiny_splits.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert shuffled == got and sum(got.values()) == 8
    # the lines of a split reach Python sorted by their number
    assert "BroadcastHashJoin" not in plan
    within = plan[plan.index("MapInArrow") :].split("\n")[1:4]
    assert any("Sort [" in line and "_number" in line for line in within)


def test_header_drift_fails(tiny_splits, tmp_path):
    (tmp_path / "CAvideos.csv").write_text(csv_text(sample_rows("CA")).replace("video_id,trending", "trending,video_id"))
    with pytest.raises(Exception, match="header drift: CAvideos.csv"):
        observations.read_landing(tiny_splits, str(tmp_path)).collect()


def test_both_readers_refuse_an_exchanged_header(tiny_splits, tmp_path):
    (tmp_path / "CAvideos.csv").write_text(csv_text(sample_rows("CA")).replace("views,likes", "likes,views"))
    for read in (observations.read_landing, observations.read_observation_files):
        with pytest.raises(Exception, match="(?i)header"):
            read(tiny_splits, str(tmp_path)).collect()


@pytest.mark.parametrize("surplus", [1, 47, 60, 100, 3000])
def test_any_surplus_is_truncated(spark, surplus):
    fields = spark.createDataFrame([(",".join(["1"] * 16) + "," * surplus,), (",".join(["1"] * 15),), ("1," * 12 + '"lost',)], "line string")
    got = [r._parse_status for r in observations.parse_lines(fields).collect()]
    assert got == ["truncated", "short", "short"]


def test_a_split_leaves_a_row_of_fixed_width(tiny_splits, tmp_path):
    # without quotes every split might lie inside a record, but none of its text leaves the first scan
    (tmp_path / "CAvideos.csv").write_text(csv_text([], ["x" * 40 + "," * 15 for _ in range(3000)]))
    lines = split_records._lines(tiny_splits, str(tmp_path), "*videos*.csv")
    effects = split_records._effects(lines)
    assert [f.dataType.simpleString() for f in effects.schema.fields] == ["string", "bigint", "string", "boolean", "boolean", "boolean"]
    found = effects.collect()
    assert len(found) > 1000 and [r._block for r in found if r._first is not None] == [0]
    assert all(not r._end_out and r._end_in and r._whole_in for r in found if r._block)
    placed = split_records._placed(effects)
    assert placed.filter("_crossed").count() == 0
    records = split_records.read_records(tiny_splits, str(tmp_path), "*videos*.csv", OBSERVATION_HEADER)
    assert records.count() == 3000 and records.filter("_unclosed").count() == 0


def test_bytes_that_are_not_utf8_are_marked(tiny_splits, tmp_path):
    (tmp_path / "CAvideos.csv").write_bytes(csv_text(sample_rows("CA")).encode() + b'v9,"caf\xe9\n' + b"x" * 100 + b'\xff",' + b"," * 13 + b"\n")
    got = observations.read_landing(tiny_splits, str(tmp_path))
    assert [(r.video_id, r.trending_date[:4]) for r in got.filter("_bad_bytes").collect()] == [("v9", "caf�")]
