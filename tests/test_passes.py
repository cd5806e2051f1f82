"""What a row costs before a model sees it: scans, hashes, copies of texts, stored columns."""

import contextlib
import io
import random
import re

from pyspark.sql import functions as F

from riskloom.functions import text
from riskloom.operators import modeling, sampling

from conftest import rows


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode="simple")
    return out.getvalue()


def labelled(spark, tmp_path):
    """Unlabelled rows, rows without a key and equal rows among them."""
    path = f"{tmp_path}/labelled"
    made = [(None if i % 50 == 0 else str(i // 2), None if i % 7 == 0 else int(i % 5 == 0), float(i // 2)) for i in range(400)]
    spark.createDataFrame(made, "trans_num string, is_fraud int, amt double").write.parquet(path)
    return spark.read.parquet(path)


def test_undersample_reads_and_hashes_each_row_once(spark, tmp_path):
    df = labelled(spark, tmp_path)
    out = sampling.undersample(df)
    assert plan(out).count("FileScan") == 1
    assert len(re.findall(r"md5\(", plan(out))) == 1
    n1, n0 = sampling.class_counts(df)
    minor = df.where("is_fraud = 1")
    expected = minor.unionByName(sampling.smallest_n(df.where("is_fraud = 0"), n1))
    assert n1 < n0
    assert out.columns == df.columns
    assert sorted(rows(out), key=repr) == sorted(rows(expected), key=repr)
    assert sampling.class_counts(out) == (n1, n1)


def test_smallest_of_some_rows(spark, tmp_path):
    df = sampling.with_hash(labelled(spark, tmp_path))
    some = F.col("amt") < 20
    for n in (1, 7, 39, 10_000):
        flagged = sampling.flag_smallest(df, n, among=some)
        assert flagged.count() == df.count()
        assert flagged.where("_sel AND NOT amt < 20").count() == 0
        assert flagged.where("_sel").count() == min(n, df.where(some).count())


def test_hash_replaces_a_column_of_its_name(spark):
    df = spark.createDataFrame([("1", 5)], "trans_num string, _h int")
    out = sampling.with_hash(df)
    assert sorted(out.columns) == ["_h", "trans_num"]
    assert out.first()["_h"] == int("c4ca4238", 16)


def test_only_the_columns_of_the_models_are_cached(spark, monkeypatch):
    seen = []

    class Recorder:
        def fit(self, data):
            seen.append((data.columns, data.is_cached))

    monkeypatch.setattr(modeling, "model_pipeline", lambda name, features: Recorder())
    train = spark.createDataFrame([(1, 2.0, "wide", None)], "is_fraud int, amt double, merchant string, hour int")
    modeling.train_all(train, names=["a", "b"], features=["amt", "hour"])
    assert seen == [(["is_fraud", "amt", "hour"], True)] * 2


def test_cleaning_searches_instead_of_copying(spark):
    rnd = random.Random(3)
    made = ["".join(rnd.choices('ab\\"\t\r\n \x0b\x0c\x1cé😀 ', k=rnd.randint(0, 9))) for _ in range(500)] + ["", None]
    df = spark.createDataFrame([(s,) for s in made], "s string")
    out = df.select("s", text.normalize_text(F.col("s")).alias("t"))
    assert "translate" not in plan(out).lower()
    for s, t in rows(out):
        kept = None if s is None else re.sub("[ \t\n\x0b\x0c\r]+", " ", s.replace("\\", "").replace('"', "")).strip(" ")
        assert t == kept
