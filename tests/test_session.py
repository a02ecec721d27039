"""Session helpers: cluster sizing and the shared checkpoint folder."""

import os

import pytest

from ledgerloom import session
from ledgerloom.session import MB, cluster_conf, ensure_checkpoint_dir, reliable_checkpoint, scratch_path


def test_cluster_conf_sizes_partitions_from_shuffle_volume():
    conf = cluster_conf(100 * (1 << 40), executors=1000, cores_per_executor=8)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * (1 << 40) // (256 * MB)
    small = cluster_conf(1 << 30, executors=1000, cores_per_executor=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16000  # at least two waves
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_cluster_conf_applies_to_a_live_session(spark):
    conf = cluster_conf(1 << 30, executors=1, cores_per_executor=2)
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_checkpoint_dir_is_read_from_the_session(spark):
    current = spark.sparkContext.getCheckpointDir()
    assert current and ensure_checkpoint_dir(spark) == current
    assert scratch_path(spark, "x").startswith(current.rstrip("/") + "/x-")


def test_a_cluster_must_name_its_checkpoint_folder():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext, conf = Context(), {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_stored_frames_are_written_once_and_scratch_is_cleared(spark, monkeypatch):
    monkeypatch.setattr(session, "_scratch", [])
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        for b in rows:
            seen.add(b.num_rows)
            yield b

    kept = reliable_checkpoint(spark.range(10).mapInArrow(count, "id long"))
    assert kept.count() == 10 and kept.count() == 10 and seen.value == 10
    (path,) = session._scratch
    local = path.removeprefix("file:")
    assert os.path.isdir(local) and session.clear_scratch(spark) == 1 and not os.path.exists(local)


def test_buckets_follow_the_size():
    from ledgerloom.sources.io import buckets_for

    assert buckets_for(1000) == 16 and buckets_for(10**12) * (256 << 20) >= 64 * 10**12


def test_shuffle_files_go_with_their_job(spark, tmp_path):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    key, was = session.RELEASE_CONF, spark.conf.get(session.RELEASE_CONF, None)
    with pytest.raises(ValueError), session.released_shuffles(spark):
        before = blocks.getAllFiles().size()
        counted = reliable_checkpoint(spark.range(0, 1000, 1, 4).selectExpr("id % 100 AS k").groupBy("k").count())
        assert blocks.getAllFiles().size() <= before
        assert counted.count() == 100 and counted.selectExpr("sum(count)").first()[0] == 1000
        raise ValueError
    assert spark.conf.get(key, None) == was
