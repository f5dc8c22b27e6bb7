import pytest
from pyarrow import fs

from corpusmill import staging, storage


def test_local_paths():
    assert storage.local_path("/a/b c#d") == "/a/b c#d"
    assert storage.local_path("file:/a") == storage.local_path("file:///a") == "/a"
    for remote in ("hdfs:/x", "hdfs://h:1/x", "s3a://b/k"):
        assert storage.local_path(remote) is None


def test_paths_without_scheme_belong_to_the_default_file_system(spark, tmp_path):
    assert storage.qualified(spark, f"{tmp_path}/a b/") == f"file:{tmp_path}/a b"
    conf = spark._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    conf.set("fs.defaultFS", "viewfs://cluster/")
    conf.set("fs.viewfs.mounttable.cluster.link./data", f"file://{tmp_path}")
    try:
        assert storage.qualified(spark, "/data/x") == "viewfs://cluster/data/x"
        assert storage.qualified(spark, "file:/data/x") == "file:/data/x"
    finally:
        conf.set("fs.defaultFS", before or "file:///")


def test_one_client_for_each_storage(monkeypatch):
    opened = []

    class System:
        @staticmethod
        def from_uri(uri):
            opened.append(uri)
            return uri, "/"

    monkeypatch.setattr(fs, "FileSystem", System)
    clients = storage.Clients()
    assert clients.at("s3a://bucket/a/b?c#d") == ("s3://bucket/", "bucket/a/b?c#d")
    assert clients.at("s3://bucket/other")[1] == "bucket/other"
    assert clients.at("hdfs://name:8020/x%20y") == ("hdfs://name:8020/", "/x%20y")
    assert clients.at("hdfs:/z")[1] == "/z"
    assert opened == ["s3://bucket/", "hdfs://name:8020/", "hdfs:///"]
    clients.at("/tmp/x")
    assert len(opened) == 3


def test_rename_replaces(spark, tmp_path):
    for name in ("new", "old"):
        (tmp_path / name).mkdir()
        (tmp_path / name / name).write_text(name)
    storage.rename(spark, f"{tmp_path}/new", f"{tmp_path}/old")
    assert [p.name for p in (tmp_path / "old").iterdir()] == ["new"] and not (tmp_path / "new").exists()
    storage.delete(spark, f"{tmp_path}/old")
    storage.delete(spark, f"{tmp_path}/old")
    assert not (tmp_path / "old").exists()


def test_scopes_delete_what_was_staged(spark):
    with staging.scope(spark):
        path = staging.stage(spark.range(3), "kept-until-the-end").inputFiles()[0]
        assert spark.read.parquet(path).count() >= 0
    kept = staging.stage(spark.range(3), "kept")
    assert kept.count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_staging_folder(monkeypatch):
    class Context:
        master, folder = "local[4]", None

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

    class Session:
        def __init__(self, named=None):
            self.sparkContext = Context()
            self.conf = {staging.CHECKPOINT_CONF: named}

    assert staging.staging_root(Session("hdfs:/shared/")) == "hdfs:/shared"
    session = Session()
    assert staging.staging_root(session) == staging.staging_root(session)
    session = Session()
    session.sparkContext.master = "local-cluster[3,2,1024]"
    with pytest.raises(ValueError):
        staging.staging_root(session)


def test_scopes_of_threads_are_apart(spark):
    """A scope that ends in one thread deletes nothing that another thread has staged."""
    from concurrent.futures import ThreadPoolExecutor
    from threading import Barrier

    from corpusmill import staging
    from corpusmill.sources.state import path_exists

    meet = Barrier(2)

    def job(wait: bool) -> bool:
        with staging.scope(spark):
            kept = staging.stage(spark.range(3), "thread")
            path = kept.inputFiles()[0].rpartition("/")[0]
            meet.wait(60)
            if wait:
                meet.wait(60)
                return path_exists(spark, path)
        gone = not path_exists(spark, path)
        meet.wait(60)
        return gone

    with ThreadPoolExecutor(2) as pool:
        assert list(pool.map(job, [True, False])) == [True, True]
    assert not staging._SCOPES
