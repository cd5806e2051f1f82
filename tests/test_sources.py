"""CSV dialect round trip, vector-free persist, metrics sink."""

from __future__ import annotations

import pytest
from pyspark.ml.feature import VectorAssembler

from riskloom.session import scratch_path
from riskloom.sources import files

from conftest import rows


def test_csv_round_trip_keeps_quotes_backslashes_spaces_and_nulls(spark):
    data = [("1", 'x "q" y', "a\\b"), ("2", "  padded  ", None), ("3", "line\nbreak", "")]
    df = spark.createDataFrame(data, "trans_num string, merchant string, job string")
    path = scratch_path(spark, "csv")
    files.save_table(df, path, fmt="csv")
    back = files.read_csv(spark, path, columns=["trans_num", "merchant", "job"], multi_line=True)
    got = sorted(rows(back))
    assert got[0] == ("1", 'x "q" y', "a\\b")
    assert got[1] == ("2", "  padded  ", None)
    assert got[2][1] == "line\nbreak"


def test_line_oriented_scan_pads_short_rows(spark):
    path = scratch_path(spark, "short")
    spark.sparkContext.parallelize(["a,b,c", "1,2", '3,"x ""y""",z']).coalesce(1).saveAsTextFile(path)
    back = files.read_csv(spark, path, columns=["a", "b", "c"])
    assert sorted(rows(back)) == [("1", "2", None), ("3", 'x "y"', "z")]


def test_drop_vector_columns_then_csv(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0)], "a double, b double, is_fraud int")
    v = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    kept = files.drop_vector_columns(v)
    assert kept.columns == ["a", "b", "is_fraud"]
    files.save_table(kept, scratch_path(spark, "k2"), fmt="csv")


def test_metrics_sink_one_file(spark):
    m = spark.createDataFrame([("A", 0.5), ("B", 0.7)], "model string, f1_score double")
    path = scratch_path(spark, "metrics")
    files.save_metrics(m, path)
    back = files.read_table(spark, path, fmt="csv", header="true", inferSchema="true")
    assert sorted(rows(back)) == [("A", 0.5), ("B", 0.7)]
    assert back.inputFiles() and len(back.inputFiles()) == 1


def test_materialize_cuts_lineage(spark):
    df = spark.range(100).selectExpr("id", "id * 2 as twice")
    m = files.materialize(df, "mat")
    assert "Scan parquet" in m._jdf.queryExecution().executedPlan().toString()
    assert m.count() == 100


def test_land_csv_as_parquet(spark):
    from riskloom.sources import fixtures

    from conftest import SF_SMALL

    raw = fixtures.raw_transactions(spark, SF_SMALL)
    csv_path = scratch_path(spark, "land-src")
    files.save_table(raw, csv_path, fmt="csv")
    landed = files.land_csv(spark, csv_path, scratch_path(spark, "landed"), columns=fixtures.RAW_COLUMNS, multi_line=True)
    assert "Scan parquet" in landed.select("amt")._jdf.queryExecution().executedPlan().toString()
    assert landed.exceptAll(raw).count() == 0 and raw.exceptAll(landed).count() == 0


def test_cluster_settings_for_100_tb():
    from riskloom.session import cluster_settings

    s = cluster_settings(100 * 1024**4, task_slots=8000)
    parts = int(s["spark.sql.shuffle.partitions"])
    assert parts % 8000 == 0  # whole waves
    assert 100 * 1024**4 * 1.3 / parts <= 256 * 1024**2
    assert s["spark.sql.adaptive.skewJoin.enabled"] == "true"
    small = cluster_settings(10 * 1024**3, task_slots=8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 8000  # one wave
    mid = cluster_settings(10 * 1024**4, task_slots=4000)
    assert 10 * 1024**4 * 1.3 / int(mid["spark.sql.shuffle.partitions"]) <= 256 * 1024**2


def test_no_machine_local_folder_outside_a_local_master():
    from types import SimpleNamespace

    import pytest

    from riskloom.session import ensure_checkpoint_dir

    conf = {"spark.master": "spark://host:7077"}
    cluster = SimpleNamespace(sparkContext=SimpleNamespace(getCheckpointDir=lambda: None), conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d)))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(cluster)


def test_typed_fill_leaves_dates_and_times(spark):
    from riskloom.operators.missing import impute

    df = spark.sql("SELECT CAST(NULL AS DATE) AS d, CAST(NULL AS TIMESTAMP) AS t, CAST(NULL AS INT) AS n, CAST(NULL AS STRING) AS s, CAST(NULL AS BOOLEAN) AS b")
    for by_type in (True, False):
        row = impute(df, by_type=by_type).first()
        assert row.d is None and row.t is None and row.n == 0 and row.b is False and row.s is not None


def test_rows_without_a_user_are_one_user(spark):
    from riskloom.operators.behavior import EPOCH, sequence_features, user_totals

    df = spark.createDataFrame([(None, "a", 0, 1.0), (None, "b", 3600, 3.0), ("u", "c", 10, 5.0)], "user_id string, trans_num string, epoch_seconds long, amt double")
    got = {r.trans_num: r for r in sequence_features(df, EPOCH).collect()}
    assert (got["b"].user_transaction_count, got["b"].user_avg_amt, got["b"].trans_count_last_24h, got["b"].hours_since_last_trans) == (2, 2.0, 2, 1.0)
    assert got["a"].user_id is None and got["c"].user_transaction_count == 1
    totals = {r.trans_num: r.user_transaction_count for r in user_totals(df).collect()}
    assert totals == {"a": 2, "b": 2, "c": 1}


def test_records_that_do_not_fit_are_kept_apart(spark):
    path = scratch_path(spark, "rejects")
    lines = ["a,b,c", "1,2", '3,"x ""y, z""",w', "4,5,6,7", "8,,9", '"q,1",2,3,"4,5"', ",,"]
    spark.sparkContext.parallelize(lines).coalesce(1).saveAsTextFile(path)
    fits, others = files.read_csv_checked(spark, path, ["a", "b", "c"])
    assert sorted(rows(fits), key=str) == sorted([("3", 'x "y, z"', "w"), ("8", None, "9"), (None, None, None)], key=str)
    assert others.columns == list(files.REJECT_COLUMNS)
    assert sorted(rows(others, "raw", "n_fields", "reason")) == [('"q,1",2,3,"4,5"', 4, "long"), ("1,2", 2, "short"), ("4,5,6,7", 4, "long")]
    assert all(r.file for r in others.collect())
    none, nothing = files.read_csv_checked(spark, path, ["only"])
    assert none.count() == 0 and nothing.count() == 6  # every record is too long, none is lost


def test_an_overwrite_of_touched_months(spark):
    from pathlib import Path

    path = scratch_path(spark, "months")
    table = lambda month, n: spark.range(n).selectExpr("id", f"'{month}' AS month")
    save = lambda df: files.save_table(df, path, fmt="parquet", partition_by=["month"], only_touched=True)
    held = lambda month: {f.name: f.read_bytes() for f in (Path(path.removeprefix("file:")) / f"month={month}").glob("*.parquet")}
    save(table("2019-01", 5))
    save(table("2019-02", 7))
    first = held("2019-01")
    save(table("2019-02", 3))  # a retry of the second month
    assert held("2019-01") == first and first
    assert dict(rows(files.read_table(spark, path).groupBy("month").count())) == {"2019-01": 5, "2019-02": 3}
    with pytest.raises(ValueError):
        files.save_table(table("x", 1), path, fmt="parquet", only_touched=True)
