"""Landing audit on files written for the test."""

import hashlib
import json

import pytest

from fixtures import write_landing
from snapmart.operators import audit
from snapmart.schemas import OBSERVATION_HEADER

REGIONS = ("CA", "US")


def verdicts(report):
    return {r.file: r.verdict for r in report.collect()}


def test_sound_directory(spark, tmp_path):
    raw = write_landing(tmp_path, REGIONS)
    report = audit.audit_report(spark, str(raw), REGIONS)
    rows = {r.file: r for r in report.collect()}
    assert set(verdicts(report).values()) == {"ok"} and len(rows) == 4
    content = (raw / "CAvideos.csv").read_bytes()
    ca = rows["CAvideos.csv"]
    assert (ca.size_bytes, ca.sha256) == (len(content), hashlib.sha256(content).hexdigest())
    assert (ca.encoding, ca.line_ending, ca.type) == ("utf-8", "LF", "csv")
    audit.require_sound(report)
    totals = {r.type: (r.n_files, r.total_bytes) for r in audit.audit_totals(report).collect()}
    assert totals["csv"] == (2, sum((raw / f"{r}videos.csv").stat().st_size for r in REGIONS))
    items = audit.json_items(spark, str(raw))
    assert items.count() == 63 and items.filter("title = 'Comedy'").count() == 4


def test_missing_and_extra(spark, tmp_path):
    raw = write_landing(tmp_path, REGIONS)
    report = audit.audit_report(spark, str(raw), ("CA", "DE"))
    assert verdicts(report) == {
        "CAvideos.csv": "ok", "CA_category_id.json": "ok", "DEvideos.csv": "fail", "DE_category_id.json": "fail",
        "USvideos.csv": "warn", "US_category_id.json": "warn",
    }
    with pytest.raises(audit.LandingError, match="DEvideos.csv: missing"):
        audit.require_sound(report)
    strict = verdicts(audit.audit_report(spark, str(raw), ("CA",), strict=True))
    assert strict["USvideos.csv"] == "fail"


@pytest.mark.parametrize(
    "header",
    [
        ",".join(reversed(OBSERVATION_HEADER)),
        ",".join(OBSERVATION_HEADER[:-1]),
        ",".join(OBSERVATION_HEADER) + ",",
        ",".join(OBSERVATION_HEADER) + ",more",
        "﻿" + ",".join(OBSERVATION_HEADER),
        "",
    ],
)
def test_header_drift(spark, tmp_path, header):
    (write_landing(tmp_path, ["CA"]) / "CAvideos.csv").write_text(header + "\nrow\n")
    row = audit.audit_report(spark, str(tmp_path), ["CA"]).filter("file = 'CAvideos.csv'").first()
    assert row.verdict == "fail" and row.problem.startswith("header drift")


@pytest.mark.parametrize("line_end, quote", [("\r\n", ""), ("\n", '"')])
def test_header_variants_that_pass(spark, tmp_path, line_end, quote):
    header = ",".join(f"{quote}{c}{quote}" for c in OBSERVATION_HEADER)
    (write_landing(tmp_path, ["CA"]) / "CAvideos.csv").write_bytes(f"{header}{line_end}x{line_end}".encode())
    row = audit.audit_report(spark, str(tmp_path), ["CA"]).filter("file = 'CAvideos.csv'").first()
    assert row.verdict == "ok" and row.line_ending == ("CRLF" if line_end == "\r\n" else "LF")


@pytest.mark.parametrize(
    "document, problem",
    [
        ({"kind": "x"}, "items: no list"),
        ({"items": "text"}, "items: no list"),
        ([], "items: no list"),
        ({"items": [1]}, "items: entry is no object"),
        ({"items": [None]}, "items: entry is no object"),
        ({"items": [{"id": "1"}]}, "items: entry lacks id or snippet"),
        ({"items": [{"id": None, "snippet": None}]}, None),
        ({"items": []}, None),
    ],
)
def test_json_shape(spark, tmp_path, document, problem):
    (write_landing(tmp_path, ["CA"]) / "CA_category_id.json").write_text(json.dumps(document))
    row = audit.audit_report(spark, str(tmp_path), ["CA"]).filter("file = 'CA_category_id.json'").first()
    assert row.problem == problem


def test_encoding_reads_the_whole_file(spark, tmp_path):
    raw = write_landing(tmp_path, ["CA"])
    with (raw / "CAvideos.csv").open("ab") as f:
        f.write(b"x" * 20000 + b"\xff\n")
    row = audit.audit_report(spark, str(raw), ["CA"]).filter("file = 'CAvideos.csv'").first()
    assert row.encoding == "latin-1" and row.verdict == "ok"


def test_size_changes_no_verdict(spark, tmp_path):
    raw = write_landing(tmp_path, ["CA"])
    small, large = ({r.file: r for r in audit.audit_report(spark, str(raw), ["CA"], hashed_bytes=n).collect()} for n in (1 << 30, 10))
    csv, want = large["CAvideos.csv"], small["CAvideos.csv"]
    assert csv.sha256 is None and want.sha256 and csv.verdict == want.verdict == "ok"
    assert (csv.encoding, csv.line_ending, csv.line_digest, csv.n_columns) == (want.encoding, want.line_ending, want.line_digest, 16)
    # a document that can't be parsed is no sound file
    assert large["CA_category_id.json"].verdict == "fail" and small["CA_category_id.json"].n_items == 31
    with pytest.raises(audit.LandingError, match="over 10 bytes"):
        audit.json_items(spark, str(raw), hashed_bytes=10)


@pytest.mark.parametrize("feeds", ["\r\n" * 3 + "\n" * 2, "\n" * 30 + "\r\n" * 40, "x\r", "\r\nx\r", "", "\n", "a\nb\r\n\r"])
def test_line_ends_of_the_whole_file(spark, tmp_path, feeds):
    header = ",".join(OBSERVATION_HEADER)
    content = f"{header}\n{'y' * 5000}{feeds}".encode()
    (tmp_path / "CAvideos.csv").write_bytes(content)
    row = audit.line_facts(spark, str(tmp_path), "*.csv").first()
    pairs = content.count(b"\r\n")
    assert row.line_ending == ("CRLF" if pairs and 2 * pairs >= content.count(b"\n") else "LF")


def test_numbered_parts_stand_for_their_file(spark, tmp_path):
    raw = write_landing(tmp_path, ["CA"])
    (raw / "CAvideos.csv").rename(raw / "CAvideos-1.csv")
    (raw / "CAvideos-2.csv").write_text("wrong header\n")
    (raw / "CAvideos_old.csv").write_text("x\n")
    report = audit.audit_report(spark, str(raw), ["CA"])
    assert verdicts(report) == {
        "CAvideos-1.csv": "ok", "CAvideos-2.csv": "fail", "CAvideos_old.csv": "warn", "CA_category_id.json": "ok",
    }


def test_manifest(spark, tmp_path):
    raw = write_landing(tmp_path / "raw", REGIONS)
    report = audit.audit_report(spark, str(raw), REGIONS)

    def entry(file, **changes):
        content = (raw / file).read_bytes()
        return {"name": file, "size_bytes": len(content), "sha256": hashlib.sha256(content).hexdigest(), **changes}

    manifest = {
        "files": [
            {"region": "CA", "csv": entry("CAvideos.csv"), "json": entry("CA_category_id.json", sha256="0")},
            {"region": "DE", "csv": entry("USvideos.csv", size_bytes=1), "json": entry("CAvideos.csv", name="gone")},
        ]
    }
    (tmp_path / "manifest.json").write_text(json.dumps(manifest, indent=1))
    listed = audit.read_manifest(spark, str(tmp_path / "manifest.json"))
    got = {r.file: r.result for r in audit.compare_manifest(report, listed).collect()}
    assert got == {
        "CAvideos.csv": "ok", "CA_category_id.json": "hash differs", "USvideos.csv": "size differs",
        "gone": "missing", "US_category_id.json": "unlisted",
    }
    unhashed = audit.audit_report(spark, str(raw), REGIONS, hashed_bytes=10)
    assert {r.result for r in audit.compare_manifest(unhashed, listed).filter("file like 'CA%'").collect()} == {"not hashed"}


def test_many_failures_are_counted(spark):
    report = spark.createDataFrame([(f"f{i:02}", "missing", None, "fail") for i in range(30)], "file string, status string, problem string, verdict string")
    with pytest.raises(audit.LandingError, match="30 files in all"):
        audit.require_sound(report)


def brute_tree(content: bytes, fan: int, levels: int = 2) -> str:
    lines = content.split(b"\n")
    digests = [hashlib.sha256(x).hexdigest() for x in (lines[:-1] if lines[-1] == b"" else lines)]
    for _ in range(levels):
        digests = [hashlib.sha256("".join(digests[i : i + fan]).encode()).hexdigest() for i in range(0, len(digests), fan)]
    return hashlib.sha256("".join(digests).encode()).hexdigest()


@pytest.mark.parametrize("split_bytes", ["64", "1000", "1g"])
def test_digest_trees_do_not_depend_on_splits(spark, tmp_path, split_bytes):
    contents = {
        "CAvideos.csv": "".join(f"row {i}, {'é' * (i % 37)}\r\n" for i in range(400)).encode(),
        "USvideos-1.csv": b"one line",
        "DEvideos.csv": b"\n\nx\xff\n" * 50 + b"open",
    }
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    (tmp_path / "GBvideos.csv").write_bytes(b"")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        lines = audit.numbered_lines(spark, str(tmp_path), "*.csv")
        got = {r.file: r.tree_sha256 for r in audit.digest_tree(lines, fan=4).collect()}
        whole = {r.file: r.tree_sha256 for r in audit.file_trees(spark, str(tmp_path)).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {n: brute_tree(c, 4) for n, c in contents.items()}  # a file without a line has no tree
    assert whole == {n: brute_tree(c, audit.FAN) for n, c in contents.items()}


def test_manifest_compares_trees(spark):
    report = spark.createDataFrame([("a", 1, None), ("b", 1, None), ("c", 1, None), ("d", 1, "x"), ("e", 2, None)], "file string, size_bytes long, sha256 string")
    trees = spark.createDataFrame([("a", "t"), ("b", "u"), ("d", "t"), ("e", "t")], "file string, tree_sha256 string")
    listed = spark.createDataFrame(
        [("a", 1, None, "t"), ("b", 1, None, "t"), ("c", 1, "x", "t"), ("d", 1, "x", None), ("e", 1, None, "t")],
        "file string, size_bytes long, sha256 string, tree_sha256 string",
    )
    got = {r.file: r.result for r in audit.compare_manifest(report, listed, trees).collect()}
    assert got == {"a": "ok", "b": "hash differs", "c": "not hashed", "d": "ok", "e": "size differs"}
