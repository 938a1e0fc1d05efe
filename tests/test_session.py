import pytest

from talmir.session import CHECKPOINT_CONF, new_path, shared_folder


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    """Only what the folder is looked up in."""

    def __init__(self, master, conf=None, folder=None):
        self.sparkContext = Context(master, folder)
        self.conf = {CHECKPOINT_CONF: conf} if conf else {}


@pytest.mark.parametrize("master", ["yarn", "spark://a:7077", "local-cluster[2,1,1024]", "k8s://x"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(ValueError, match=CHECKPOINT_CONF):
        shared_folder(Session(master))
    assert shared_folder(Session(master, "hdfs:///shared")) == "hdfs:///shared"
    assert shared_folder(Session(master, folder="hdfs:///set")) == "hdfs:///set"


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]", "local[2,3]"])
def test_a_local_master_gets_a_temporary_folder(master):
    session = Session(master)
    assert shared_folder(session) == shared_folder(session)
    assert new_path(session, "x") != new_path(session, "x")
