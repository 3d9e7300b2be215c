"""Checkpoint folder and shipping of the package."""
import types
import zipfile

import pytest

from hourcast import session


def fake(master, configured=None):
    sc = types.SimpleNamespace(master=master, dir=None, files=[], applicationId=f"app-{master}")
    sc.getCheckpointDir = lambda: sc.dir
    sc.setCheckpointDir = lambda d: setattr(sc, "dir", d)
    sc.addPyFile = lambda path: sc.files.append(zipfile.ZipFile(path).namelist())
    return types.SimpleNamespace(sparkContext=sc, conf=types.SimpleNamespace(get=lambda k, default: configured))


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[3,2,3000]", "k8s://https://host"])
def test_no_local_folder_on_a_cluster(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(fake(master))
    assert session.checkpoint_dir(fake(master, "hdfs://shared/ckpt")) == "hdfs://shared/ckpt"


def test_local_session_gets_one():
    spark = fake("local[4]")
    assert session.checkpoint_dir(spark) == session.checkpoint_dir(spark) == spark.sparkContext.dir


def test_package_is_shipped_once():
    spark = fake("yarn")
    session.ship(spark)
    session.ship(spark)
    names, = spark.sparkContext.files
    assert "hourcast/session.py" in names and all(n.endswith(".py") for n in names)
