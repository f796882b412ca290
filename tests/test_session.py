import os

import pytest

from pasarlens import session


class OtherMaster:
    """Stands for the session of a cluster without a named folder."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:
        master = "yarn"

        @staticmethod
        def getCheckpointDir():
            return None


def test_named_folder_is_used(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        assert session.shared_folder(spark) == named
    assert session.staging_path(spark, "x").startswith(session.staging_root(spark))


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        session.shared_folder(OtherMaster)


def test_stage_keeps_rows_and_schema(spark):
    df = spark.range(10).selectExpr("id", "cast(id as string) as name", "cast(null as int) as nothing")
    staged = session.stage(df, "t")
    assert staged.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(tuple, staged.collect())) == sorted(map(tuple, df.collect()))
    assert os.path.isdir(session.staging_root(spark).replace("file:", ""))
