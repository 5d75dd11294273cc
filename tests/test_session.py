"""Scratch locations live under the session's checkpoint directory."""

from __future__ import annotations

from salesmart.session import checkpoint_root, scratch_uri


def test_scratch_is_under_the_checkpoint_dir(spark):
    root = checkpoint_root(spark)
    assert root == spark.sparkContext.getCheckpointDir().rstrip("/")
    a, b = scratch_uri(spark, "x"), scratch_uri(spark, "x")
    assert a != b and a.startswith(root + "/salesmart/x-") and b.startswith(root + "/salesmart/x-")
