"""A run is taken up after the last stage that was finished."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskloom.operators import behavior, modeling
from riskloom.plans import catalog, pipeline
from riskloom.session import scratch_path
from riskloom.sources.stages import Stages, input_digest

from conftest import SF_SMALL, rows


def test_a_finished_stage_is_read(spark):
    folder = scratch_path(spark, "stages")
    made = []

    def make():
        made.append(1)
        return spark.range(5)

    a = Stages(spark, folder, "x")
    assert a.keep("one", make).count() == 5 and a.computed == ["one"]
    b = Stages(spark, folder, "x")
    assert b.keep("one", make).count() == 5 and b.resumed == ["one"] and len(made) == 1
    assert Stages(spark, folder, "other").stored("one") is None  # other input
    b.clean()
    assert Stages(spark, folder, "x").stored("one") is None
    # a table without an entry is not finished
    spark.range(3).write.parquet(f"{folder}/two-x")
    assert a.stored("two") is None
    assert a.keep("two", make).count() == 5


def test_digest_tells_parameters_and_input_apart(spark):
    raw = catalog.raw(spark, SF_SMALL)
    assert input_digest(raw, clock="epoch") == input_digest(catalog.raw(spark, SF_SMALL), clock="epoch")
    assert input_digest(raw, clock="epoch") != input_digest(raw, clock="packed")
    assert input_digest(raw) != input_digest(raw.select("amt"))


def test_a_killed_run_resumes_without_the_windows(spark, monkeypatch):
    folder = scratch_path(spark, "resume")
    calls = {"windows": 0}
    windows = behavior.sequence_features

    def counted(*args, **kw):
        calls["windows"] += 1
        return windows(*args, **kw)

    def killed(*args, **kw):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(behavior, "sequence_features", counted)
    run = lambda: pipeline.run_pipeline(
        catalog.raw(spark, SF_SMALL), do_eda=False, model_names=["Logistic Regression"], resume_dir=folder
    )
    with monkeypatch.context() as m:
        m.setattr(modeling, "train_all", killed)
        with pytest.raises(RuntimeError):
            run()
    assert calls["windows"] == 1
    done = run()
    assert calls["windows"] == 1  # the feature table and the balanced part were read
    assert done.metrics.count() == 1
    assert "hashpartitioning(_user" not in done.features._jdf.queryExecution().executedPlan().toString()
    assert done.stages.resumed == ["features", "balanced-train"] and done.stages.computed == ["predictions"]
    again = run()
    assert again.stages.computed == []
    assert sorted(rows(again.metrics)) == sorted(rows(done.metrics))
    assert again.features.where(F.col("amt").isNull()).count() == done.features.where(F.col("amt").isNull()).count()
    again.stages.clean()
    assert Stages(spark, folder, again.stages.digest).stored("features") is None
