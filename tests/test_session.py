"""Where intermediate tables go, and that they go away."""

import os

import pytest

from stayloom import session


class Elsewhere:
    """A session that names no shared folder."""

    def __init__(self, master):
        self.conf = self
        self.sparkContext = self
        self.master = master

    def get(self, key, default=None):
        return default


def test_settled_tables_are_in_the_named_folder_and_deleted(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder))
    with pytest.raises(ZeroDivisionError), session.intermediate(spark):
        assert session.settle(spark.range(5)).count() == 5
        assert len(set(os.listdir(folder)) - before) == 1
        raise ZeroDivisionError
    assert set(os.listdir(folder)) == before


@pytest.mark.parametrize("master", ["local-cluster[2,1,1024]", "spark://host:7077", "yarn", "k8s://host"])
def test_a_cluster_must_name_its_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Elsewhere(master))
