from types import SimpleNamespace

import pytest

from stumpline.session import shared_folder


def fake(master, named):
    conf = SimpleNamespace(get=lambda key, default=None: named)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"))


def test_a_cluster_needs_a_shared_folder():
    assert shared_folder(fake("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="share"):
            shared_folder(fake(master, None))


def test_a_local_master_gets_one_folder():
    session = fake("local[4]", None)
    assert shared_folder(session) == shared_folder(session)
