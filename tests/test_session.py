"""Checkpoint folder rules: the session's setting wins; only local mode may
fall back to a folder of its own; a cluster without the setting is an error."""

import pytest

from daybook.session import checkpoint_root


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, checkpoint=None, conf=None):
        self.master = master
        self._dir = checkpoint
        self._conf = _Conf(conf or {})

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, d):
        self._dir = f"{d}/app"

    def getConf(self):
        return self._conf


class _Session:
    def __init__(self, context, conf=None):
        self.sparkContext = context
        self.conf = _Conf(conf or {})


def test_existing_checkpoint_dir_is_used():
    assert checkpoint_root(_Session(_Context("yarn", "hdfs://shared/ckpt/app"))) == "hdfs://shared/ckpt/app"


def test_configured_dir_is_read_from_the_session():
    s = _Session(_Context("yarn"), {"spark.checkpoint.dir": "s3a://bucket-of-cluster/ckpt"})
    assert checkpoint_root(s) == "s3a://bucket-of-cluster/ckpt/app"


def test_cluster_without_setting_is_an_error():
    with pytest.raises(RuntimeError):
        checkpoint_root(_Session(_Context("yarn")))


def test_local_without_setting_gets_its_own_folder():
    assert checkpoint_root(_Session(_Context("local[2]"))).endswith("/app")


def test_the_test_session_uses_the_configured_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    root = checkpoint_root(spark)
    if configured:
        assert configured.rstrip("/").split("/")[-1] in root


class _ConnectSession:
    def __init__(self, conf):
        self.conf = _Conf(conf)

    @property
    def sparkContext(self):
        raise RuntimeError("no SparkContext in a Connect session")


def test_connect_session_reads_the_setting():
    assert checkpoint_root(_ConnectSession({"spark.checkpoint.dir": "/shared/ckpt"})) == "/shared/ckpt"
    with pytest.raises(RuntimeError):
        checkpoint_root(_ConnectSession({"spark.master": "sc://cluster"}))
