"""Session helpers and sinks not covered by the bindings."""

from pyspark.sql import functions as F

import pytest

from rollsnap.session import scratch_path, scratch_scope, shared_dir, stage
from rollsnap.sources import sinks


class _Elsewhere:
    """A session whose master is a cluster without a shared folder."""

    class conf:  # noqa: N801
        @staticmethod
        def get(key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(_Elsewhere())


def test_staged_tables_end_with_their_job(spark):
    with scratch_scope(spark):
        kept = stage(spark.range(3), "scoped").inputFiles()[0].rsplit("/", 1)[0]
        assert spark.read.parquet(kept).count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(kept).count()


def test_split_rejects_to_quarantine(spark):
    df = spark.createDataFrame([("1", "A"), ("2", None), ("3", "B")], "id string, code string")
    q = scratch_path(spark, "quarantine")
    good, counts = sinks.split_rejects(df, F.col("code").isNotNull(), q)
    assert sorted(r.id for r in good.collect()) == ["1", "3"] and counts == {"good": 2, "rejected": 1}
    assert [r.id for r in spark.read.json(q).collect()] == ["2"]


def test_upsert_store_versions(spark):
    root = scratch_path(spark, "store")
    v1 = sinks.upsert_store(spark.createDataFrame([("k1", "a"), ("k2", "b")], "id string, v string"), root, ["id"], [])
    v2 = sinks.upsert_store(spark.createDataFrame([("k2", "c"), ("k3", "d")], "id string, v string"), root, ["id"], [])
    assert v1.count() == 2
    assert sorted(tuple(r) for r in v2.collect()) == [("k1", "a"), ("k2", "c"), ("k3", "d")]
    assert sorted(tuple(r) for r in spark.read.parquet(root + "/v000001").collect()) == [("k1", "a"), ("k2", "b")]


def test_a_broken_version_is_no_base(spark):
    import os

    root = scratch_path(spark, "store")
    sinks.upsert_store(spark.createDataFrame([("k1", "a", 1), ("k1", "b", 2), (None, "c", 3), (None, "d", 4)], "id string, v string, n int"), root, ["id"], ["n"])
    os.makedirs(f"{root}/v000002/_temporary")
    v2 = sinks.upsert_store(spark.createDataFrame([("k2", "e", 1)], "id string, v string, n int"), root, ["id"], ["n"])
    assert sorted((tuple(r) for r in v2.collect()), key=str) == [("k1", "b"), ("k2", "e"), (None, "c"), (None, "d")]
