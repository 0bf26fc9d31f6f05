"""Scratch data goes to the session's shared checkpoint folder."""

from __future__ import annotations

from hirescope.session import ensure_checkpoint_dir, scratch_path


def test_scratch_paths_live_under_the_checkpoint_dir(spark):
    root = ensure_checkpoint_dir(spark)
    assert root and root == spark.sparkContext.getCheckpointDir()
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root.rstrip("/") + "/hirescope/x-")


def test_session_settings(spark):
    conf = spark.conf
    assert conf.get("spark.sql.session.timeZone") == "UTC"
    assert conf.get("spark.sql.adaptive.enabled") == "true"
    assert conf.get("spark.ui.enabled") == "false"
