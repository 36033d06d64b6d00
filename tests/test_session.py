import pytest

from pathlark import session


class Conf:
    def __init__(self, **values):
        self.values = {k.replace("_", "."): v for k, v in values.items()}

    def get(self, key, default=None):
        return self.values.get(key, default)


class Fake:
    def __init__(self, **values):
        self.conf = Conf(**values)


def test_named_folder_wins():
    assert session.shared_dir(Fake(spark_checkpoint_dir="hdfs:///jobs/", spark_master="yarn")) == "hdfs:///jobs"


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        session.shared_dir(Fake(spark_master="yarn"))


def test_local_folder_is_made_once():
    one = session.shared_dir(Fake(spark_master="local[2]"))
    assert one.startswith("/tmp/run-") and session.shared_dir(Fake(spark_master="local[2]")) == one


def test_stored_tables_are_removed(spark):
    from pathlark.operators.sinks import _folder
    from pathlark.session import clear_stored, stored

    rows = stored(spark.range(3), "some")
    path = rows.inputFiles()[0].rsplit("/", 1)[0]
    assert rows.count() == 3 and clear_stored(spark) >= 1
    where = _folder(spark, path)
    assert not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
