import pytest

from cleanlane import session


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder, self.sparkContext, self.conf = master, None, self, self
        self.setting = folder

    def get(self, key, default=None):
        return self.setting or default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_local_sessions_have_a_folder(spark):
    assert session.checkpoint_dir(spark)
    assert session.cut_lineage(spark.range(3)).count() == 3


def test_clusters_must_name_theirs():
    with pytest.raises(RuntimeError):
        session.checkpoint_dir(Context("spark://host:7077"))
    with pytest.raises(RuntimeError):
        session.checkpoint_dir(Context("local-cluster[2,1,1024]"))
    there = Context("yarn", "hdfs://store/shared")
    assert session.checkpoint_dir(there) == "hdfs://store/shared" == there.folder
