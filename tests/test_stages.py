from types import SimpleNamespace

import pytest

from corpuslake.stages import Stages, shared_folder


def session(master, folder=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: "/shared/warehouse" if "warehouse" in key else folder or default), sparkContext=SimpleNamespace(master=master)
    )


def test_folder_comes_from_the_session():
    assert shared_folder(session("yarn", "hdfs://x/stages/")) == "hdfs://x/stages"
    with pytest.raises(RuntimeError):
        shared_folder(session("yarn"))
    assert shared_folder(session("local[4]")) == "/shared/warehouse/stages"


def test_stages_are_kept_and_dropped(spark):
    stages = Stages(spark)
    kept = stages.keep(spark.range(3))
    assert kept.count() == 3
    (path,) = kept.inputFiles()[0].rsplit("/", 1)[:1]
    stages.drop()
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
