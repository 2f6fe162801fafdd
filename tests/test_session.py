import os

import pytest

from barloom import session


def test_cut_tables_are_read_back_and_discarded(spark):
    made = session.cut(spark.range(10).withColumnRenamed("id", "n"), "some")
    assert sorted(r.n for r in made.collect()) == list(range(10)) and os.path.isdir(made.cut_path)
    session.discard(made)
    assert not os.path.exists(made.cut_path)


def test_batches_are_bounded_where_the_session_leaves_them_open(spark):
    own = spark.newSession()
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    session.bound_batches(own)
    assert own.conf.get(key) == str(session.BATCH_ROWS)
    own.conf.set(key, "77")
    session.bound_batches(own)
    assert own.conf.get(key) == "77"


def test_a_cluster_without_a_shared_folder_is_told_so(monkeypatch):
    class Conf:
        get = staticmethod(lambda *a: None)

    class Cluster:
        conf = Conf()
        sparkContext = type("C", (), {"master": "yarn", "getConf": staticmethod(lambda: Conf())})()

    with pytest.raises(ValueError):
        session.shared_dir(Cluster())
