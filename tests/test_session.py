"""Scratch output follows the session's spark.checkpoint.dir; sessions run in UTC."""

from strata.session import ensure_utc, scratch_path, shared_dir


def test_scratch_lives_under_the_configured_checkpoint_dir(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    root = shared_dir(spark)
    if configured:
        assert root == configured.rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root + "/") and b.startswith(root + "/")


def test_ensure_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    ensure_utc(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
