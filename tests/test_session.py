"""Where intermediates are written."""

import pytest

from tidemark import session


class Context:
    def __init__(self, master, known=None):
        self.master, self.known = master, known

    def getCheckpointDir(self):
        return self.known

    def setCheckpointDir(self, path):
        self.known = path


class Conf(dict):
    pass


class Session:
    def __init__(self, master, known=None, **conf):
        self.sparkContext, self.conf = Context(master, known), Conf(conf)


def test_the_configured_folder_wins():
    assert session.shared_dir(Session("yarn", "/known", **{"spark.checkpoint.dir": "s3://shared/x"})) == "s3://shared/x"


def test_a_folder_set_on_the_context_is_used():
    assert session.shared_dir(Session("yarn", "hdfs:///known")) == "hdfs:///known"


def test_a_cluster_without_a_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session("spark://host:7077"))


def test_a_local_session_gets_one_folder():
    local = Session("local[2]")
    assert session.shared_dir(local) == session.shared_dir(local)


def test_scratch_paths_differ(spark):
    first, second = (session.scratch_path(spark, "x") for _ in range(2))
    assert first != second and first.startswith(session.shared_dir(spark))


def test_group_limit_comes_from_the_session(spark, small_groups):
    assert session.max_group_rows(spark) == 7
