"""Where intermediate tables go when the session names no folder."""

import pytest

from newsquake.llm.common import shared_folder


class Session:
    """A session of the given master that names no folder, or the one set since."""

    def __init__(self, master):
        self.master, self.folder = master, None
        self.sparkContext = self.conf = self

    def get(self, key, default):
        return default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_a_cluster_has_to_name_the_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session("spark://host:7077"))
    local = Session("local[2]")
    assert shared_folder(local) == shared_folder(local) == local.folder
