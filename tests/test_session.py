"""Session settings: the shared folder and scratch tables."""

import glob
import os

import pytest

from ordermart import session


def test_configure_many_times_keeps_the_folder(spark):
    first = session.shared_dir(spark)
    for _ in range(300):
        session.configure(spark)
    assert session.shared_dir(spark) == first


def test_scratch_is_deleted(spark):
    df = session.cut_lineage(spark.range(10), "probe")
    assert df.count() == 10
    path = session._written[-1][1]
    local = path.removeprefix("file://")
    assert os.path.isdir(local)
    session.drop_scratch(spark)
    assert not glob.glob(local)


def test_cluster_without_shared_folder_is_refused(spark, monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master, applicationId = "spark://host:7077", "a"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.shared_dir(Session())


def test_one_scratch_table_is_deleted(spark):
    first, second = session.cut_lineage(spark.range(10), "probe"), session.cut_lineage(spark.range(5), "probe")
    paths = [p.removeprefix("file://") for _, p in session._written[-2:]]
    session.drop_cut(first)
    assert not os.path.isdir(paths[0]) and second.count() == 5
    session.drop_cut(second)
    assert not os.path.isdir(paths[1])
