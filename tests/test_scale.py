"""Plans and memory of what is done to many rows."""

import datetime as dt
import itertools
import pathlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from snapmart.driver import adapter, registry
from snapmart.operators import quality, relational
from snapmart.plans import marts
from snapmart.schemas import OBSERVATION_HEADER
from snapmart.sources import files, observations, split_records
from snapmart.sources.files import Kept, parts_for, settled

SMALL = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_settled_rows_are_parquet(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, "b")], "n int, `a b` string, c string")
    kept = settled(df)
    assert all(f.endswith(".zstd.parquet") for f in kept.inputFiles()) and kept.inputFiles()
    assert sorted(kept.collect()) == sorted(df.collect()) and kept.columns == df.columns


@pytest.fixture
def folders(tmp_path, monkeypatch):
    """What is kept below a shared folder of the test's own: models and parts of models."""
    root = tmp_path / "shared"
    monkeypatch.setattr(files, "shared_root", lambda spark: str(root))
    return lambda: {str(f.parent.relative_to(root)) for f in root.rglob("*.parquet")}


def test_kept_models_go_part_by_part(spark, folders):
    df = spark.createDataFrame([(f"k{i % 50}" if i % 9 else None, i) for i in range(400)], "k string, n long")
    with Kept(spark, 4) as kept:
        rows = kept.split("a", df, "k")
        assert sorted(rows.collect(), key=repr) == sorted(df.collect(), key=repr)
        assert len({f.split("/")[-2] for f in rows.inputFiles()}) == 4
        seen = []

        def counted(part):
            seen.append({tuple(f.split("/")[1:]) for f in folders()})
            return part.groupBy("k").agg(F.count("*").alias("c"))

        counts = kept.made("a", rows, "b", counted, last=True)
        assert [len(s) for s in seen] == [4, 4, 4, 4] and ("a", "0") not in seen[1] and ("b", "0") in seen[1]
        assert sorted(counts.collect(), key=repr) == sorted(df.groupBy("k").agg(F.count("*")).collect(), key=repr)
        assert kept.made("b", counts, "c", lambda part: part).count() == counts.count() == 51
        kept.drop("c")
        assert {f.split("/")[1] for f in folders()} == {"b"}
    assert not folders()
    with pytest.raises(ZeroDivisionError), Kept(spark) as kept:
        assert kept.split("a", df, "k").count() == 400
        1 / 0  # noqa: B018
    assert not folders()


def test_parts_follow_the_input(spark, tmp_path, monkeypatch):
    spark.range(1000).repartition(3).write.parquet(f"{tmp_path}/t")
    size = sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    for part, most, want in ((size, 8, 1), (size - 1, 8, 2), (1, 8, 8), (1, 5, 5)):
        monkeypatch.setattr(files, "PART_BYTES", part)
        monkeypatch.setattr(files, "MOST_PARTS", most)
        assert parts_for(spark, f"{tmp_path}/t") == want


def order_tables(spark, folder):
    """A few order lines in the driver's shape: copies, repeated and missing keys, lines without a partner."""
    day = lambda n: dt.datetime(2019, 1, 1) + dt.timedelta(days=n)
    lines = [
        (i % 41, i % 13 if i % 31 else None, i % 4, i % 7 + 1, float(i % 50 + 1), 100.0 + i % 9, (i % 9) / 100, "ANR"[i % 3], "OF"[i % 2], day(i % 20 * 9))
        for i in range(900)
    ]
    rows = {
        "lineitem": lines + lines[:90],
        "orders": [(k, day(k)) for k in (*range(40), 3)] + [(None, day(1))],
        "part": [(k, f"part {k}", ("Brand#12", "Brand#25", "Brand#55", "Brand#31")[k % 4], f"TYPE {k % 3}", k % 20) for k in (*range(12), 5)],
        "supplier": [(k, f"supplier {k}", k % 3) for k in range(4)],
        "nation": [(k, k % 2) for k in range(3)],
        "region": [(0, "ASIA"), (1, "EUROPE")],
    }
    for name, values in rows.items():
        spark.createDataFrame(values, adapter._COLUMNS[name]).repartition(3).write.parquet(adapter.path(folder, name))


def test_the_full_report_keeps_few_models_at_once(spark, folders, tmp_path, monkeypatch):
    """In parts it is the report of all checks at once, while the disk has a model of the rows and a part of the next."""
    order_tables(spark, str(tmp_path))
    t = registry.Tables(spark, str(tmp_path))
    models = {
        "bronze_observations": t.landed, "bronze_categories": adapter.landed_categories(spark, str(tmp_path)),
        "region_seed": adapter.region_seed(spark, str(tmp_path)), "stg_observations": t.staged, "stg_categories": t.categories,
        "int_enriched": t.enriched, "int_lifecycle": t.lifecycle, "dim_region": t.dim_region, "dim_category": t.dim_category,
        "dim_video": t.dim_video, "fct_daily": t.fact, "mart_video_lifecycle": marts.mart_video_lifecycle(t.lifecycle),
        "mart_channel_performance": marts.mart_channel_performance(t.items),
        "mart_category_performance": marts.mart_category_performance(t.fact, t.dim_category),
        "mart_regional_trending": marts.mart_regional_trending(t.fact),
    }
    assert models.keys() == quality.DECLARED.keys()
    want = sorted(quality.check_all({n: settled(df) for n, df in models.items()}, adapter.REGION_NAMES).collect())
    assert sum(r.n_failures for r in want) > 0

    earlier, most, written = folders(), {}, set()
    keep = files.settled

    def watched(df, folder=None):
        kept = keep(df, folder)
        here = {f for f in folders() - earlier if "/" in f}
        written.update(f.split("/", 1)[1] for f in here)
        for name in ("bronze_observations stg_observations", "stg_observations int_enriched", "int_enriched fct_daily", "bronze_observations stg_observations int_enriched fct_daily"):
            most[name] = max(most.get(name, 0), sum(f.split("/")[1] in name.split() for f in here))
        return kept

    monkeypatch.setattr(files, "settled", watched)
    monkeypatch.setattr(files, "PART_BYTES", 1)
    monkeypatch.setattr(files, "MOST_PARTS", 3)
    report = registry.dq_full_report(registry.Tables(spark, str(tmp_path)))
    assert sorted(report.select("table_name", "check_name", "column_name", "n_failures").collect()) == want
    models_of_rows = ("bronze_observations", "stg_observations", "int_enriched", "fct_daily")
    assert {f"{n}/{k}" for n in models_of_rows for k in range(3)} <= written
    assert set(most.values()) == {4}  # three parts, and one of the next model
    assert len(folders() - earlier) == 1  # the report


def test_checks_of_tables_shuffle_only_keys_that_may_repeat(spark):
    rows = [(f"k{i}", i % 3) for i in range(500)] + [("k7", 1), ("k7", 1), ("k8", 2), (None, 5), (None, 5), (None, None), (None, None), ("k9", None)]
    df = spark.createDataFrame(rows, "k string, n long")
    for keys in (["k"], ["k", "n"], ["n"]):
        want = sorted(relational.duplicate_keys(df, keys, "c").collect(), key=repr)
        for bits in (1 << 26, 1 << 9, 1):  # from no chance hits to a filter that every row hits
            got = relational.duplicate_keys_of_table(df, keys, "c", bits)
            assert got.columns == [*keys, "c"] and sorted(got.collect(), key=repr) == want
    assert relational.duplicate_keys_of_table(df.limit(0), ["k"]).count() == 0
    assert sorted(map(tuple, quality.unique(df, "k", table=True).collect())) == [("k7", 3), ("k8", 2), ("k9", 2)]
    exchanges = [line for line in plan(relational.duplicate_keys_of_table(settled(df), ["k"])).split("\n") if "Exchange hashpartitioning(k" in line]
    assert len(exchanges) == 1  # of the rows the bitmap has; all others are counted by their hash


@pytest.mark.parametrize("name", ["fct_daily", "dim_video", "latest_row_pick", "dq_relationships"])
def test_rows_are_shuffled_before_their_texts_are_joined(spark, name):
    """Without small tables, too: dedup and what is done by item find their rows together."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffles = [line for line in plan(registry.queries()[name](spark, SMALL)).split("\n") if "Exchange hashpartitioning(" in line]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not [line for line in shuffles if "trending_date" in line.split("hashpartitioning(")[1]]


def test_a_filter_on_parsed_rows_does_not_parse_again(spark):
    lines = spark.createDataFrame([(",".join("x" * len(OBSERVATION_HEADER)),), ("a,b",), (None,)], "line string")
    joined = lines.join(F.broadcast(spark.range(2)), F.length("line") > F.col("id"), "left")
    kept = observations.parse_lines(joined).filter(F.col(observations.PARSE_STATUS).isin(*observations.ACCEPTED))
    assert plan(kept).count("columnNameOfCorruptRecord") == 1
    assert sorted(r.video_id or "" for r in kept.collect()) == ["", "x", "x"]


def test_a_split_is_read_without_being_held():
    taken = []

    def batches():
        for k in range(50):
            taken.append(k)
            yield pa.RecordBatch.from_pydict({
                "_path": ["p"] * 4, "_source_file": ["f"] * 4, "_block": [0] * 4, "_inside": [False] * 4, "_open": pa.array([None] * 4, pa.int64()),
                "_lost": pa.array([None] * 4, pa.int64()), "_header": ["h"] * 4, "value": ["h" if k == 0 else "a,b", '"c', 'd",e', ""],
            })

    found = split_records._within(batches())
    first = list(itertools.islice(found, 2))
    assert len(taken) <= 3
    assert first[0]["line"].to_pylist() == ['"c\nd",e'] and first[1]["line"].to_pylist() == ["a,b", '"c\nd",e']
    assert sum(b.num_rows for b in found) == 48 * 2
