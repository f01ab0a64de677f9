"""Session helpers: cluster sizing, checkpoint folder, lineage cuts."""

from reverbkit.session import checkpoint_dir, cluster_conf, cut_lineage


def test_cluster_conf_sizes_partitions():
    conf = cluster_conf(shuffle_bytes=20 * 10**12)
    assert int(conf["spark.sql.shuffle.partitions"]) >= 20 * 10**12 // (200 << 20)
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(cluster_conf(0)["spark.sql.shuffle.partitions"]) == 200


def test_checkpoint_dir_must_be_named_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    import pytest

    def session(master, folder=None):
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, default=None: folder), sparkContext=sc)

    for master in ("yarn", "spark://host:7077", "k8s://host", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_dir(session(master))
        assert checkpoint_dir(session(master, "s3a://shared/ckpt")) == "s3a://shared/ckpt"
    assert checkpoint_dir(session("local[4]"))


def test_cut_lineage_uses_session_checkpoint_dir(spark):
    d = checkpoint_dir(spark)
    df = cut_lineage(spark.range(10).selectExpr("id * 2 AS x"), "t")
    assert df.count() == 10
    assert any(d.rstrip("/").split("://")[-1] in f for f in df.inputFiles())
