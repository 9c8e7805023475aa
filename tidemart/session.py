"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ADAPTIVE_STREAMS = "spark.sql.adaptive.streaming.stateless.enabled"

# Settings every operator relies on. They can all be changed on a running session.
ENGINE_CONF = {
    # Event times are written in UTC and read in the session time zone.
    "spark.sql.session.timeZone": "UTC",
    # Splits hot shuffle partitions, merges small ones and rebalances before writes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The same for streams without state.
    ADAPTIVE_STREAMS: "true",
}


def build_session(
    app_name: str,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create a session; `shuffle_partitions` stays at the cluster's own value unless given."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    conf = dict(ENGINE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators rely on to a session somebody else built."""
    for key, value in ENGINE_CONF.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below `spark.checkpoint.dir`, which every executor can reach.

    A folder of this machine is used only where the setting is missing and the
    session is local, as in tests.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return os.path.join(tempfile.mkdtemp(prefix="tidemart-"), purpose)


def checkpointed(frame: DataFrame) -> DataFrame:
    """Cut lineage with a checkpoint in the folder that all executors share."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(frame.sparkSession, "checkpoints"))
    return frame.checkpoint()
