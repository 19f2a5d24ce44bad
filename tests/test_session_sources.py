"""Session options and input-scan helpers."""

from collectra.session import build_session
from collectra.sources.materialize import input_version, materialized

SF = "/root/testdata/sf0.001"


def test_explicit_shuffle_partitions_win(spark):
    s = build_session("local[*]", shuffle_partitions=8)
    assert s.conf.get("spark.sql.shuffle.partitions") == "8"
    assert s.conf.get("spark.sql.adaptive.enabled") == "true"
    assert s.conf.get("spark.sql.session.timeZone") == "UTC"


def test_views_follow_their_input(spark, tmp_path):
    """A view is rebuilt when its input has changed, in the same session."""
    path = str(tmp_path / "in")
    read = lambda: materialized(spark, "probe", path, lambda: spark.read.parquet(f"{path}/t.parquet"),
                                version=input_version(spark, path)).count()
    spark.range(5).write.parquet(f"{path}/t.parquet")
    assert read() == 5 and read() == 5
    spark.range(10).write.mode("overwrite").parquet(f"{path}/t.parquet")
    assert read() == 10


def test_a_cluster_without_shared_folder_is_an_error():
    from types import SimpleNamespace

    import pytest
    from collectra.session import shared_root
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(SimpleNamespace(conf={}, sparkContext=sc))
