"""Shared scratch location: from the session, or a registered private folder."""

import os

import pytest

from urbanflow import session


def test_scratch_under_configured_checkpoint_dir(spark):
    root = session.configured_root(spark)
    assert root and spark.sparkContext.applicationId in session.scratch_path(spark, "x")
    assert session.scratch_path(spark, "x").startswith(root.rstrip("/"))


def test_fallback_when_no_checkpoint_dir(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(session, "configured_root", lambda s: None)
    monkeypatch.setattr(spark.sparkContext, "setCheckpointDir", lambda d: calls.append(d))
    root = session.shared_root(spark)
    assert os.path.isdir(root) and calls == [root]
    monkeypatch.setattr(spark, "conf", type("C", (), {"get": staticmethod(lambda k, d=None: "spark://host:7077")})())
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_root(spark)  # on a cluster a folder of one machine is no shared folder
    monkeypatch.undo()
    p1, p2 = session.scratch_path(spark, "q"), session.scratch_path(spark, "q")
    assert p1 != p2  # a fresh folder per call


def test_scratch_is_cleaned(spark):
    path = session.scratch_path(spark, "rows")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    session.clean_scratch(spark)
    assert not os.path.exists(path.removeprefix("file:"))
