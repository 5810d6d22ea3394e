import pytest

from trailkeep import session as S


def test_intermediate_tables_lie_in_the_configured_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert S.shared_folder(spark) == folder
    stored = S.written(spark.range(5).toDF("n"))
    assert all(folder in f for f in stored.inputFiles()) and stored.count() == 5
    assert S.checkpointed(spark.range(7).toDF("n")).count() == 7


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.shared_folder(Session())
