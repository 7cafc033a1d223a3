"""Session set-up (R4, R5) and the shared scratch folder used to cut lineage.

Everything here is plain ``SparkSession.builder`` configuration. On a cluster
the submitter owns the session; :func:`tune` sets the few runtime SQL
settings the library relies on (:data:`REQUIRED_CONF`) and fills in other
unset ones, and :func:`checkpoint_dir` reads ``spark.checkpoint.dir`` from
the session and only creates a local folder when none is configured (tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every job in this library assumes. They are all defaults on
# Spark 4 except timezone, Arrow and the skew/coalesce knobs; we set them
# explicitly so a cluster with older defaults behaves the same.
RECOMMENDED_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Session windows: merge sessions inside each map partition before the
    # shuffle, so a hot key ships sessions, not raw events.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # Parquet footers carry min/max per row group; keep filter pushdown on.
    "spark.sql.parquet.filterPushdown": "true",
    # Streaming state (windows, sessions, dedup keys) in RocksDB on local
    # disk instead of the executor heap; only changes are checkpointed.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Broadcast only what is measured: no planner-estimate broadcasts (an
    # estimate from compressed file sizes is no bound); AQE converts a join
    # to broadcast when the *materialised* side is under 32 MB. Explicit
    # broadcasts are not used.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
}

# Settings the query suite relies on; applied to any session it runs in.
REQUIRED_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
}


def build(
    master: str | None = None,
    app_name: str = "tidepool",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or get) a session with :data:`RECOMMENDED_CONF` applied.

    ``master`` is only for local runs; on a cluster leave it ``None`` and let
    ``spark-submit`` decide. The Spark UI stays off: it is a web server.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    checkpoint_dir(spark)
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply :data:`REQUIRED_CONF` to a session built elsewhere (all are
    runtime SQL settings), and the other recommended ones that are unset."""
    for k, v in RECOMMENDED_CONF.items():
        try:
            if spark.conf.get(k, None) is None:
                spark.conf.set(k, v)
        except Exception:  # static conf on a shared session: leave it
            pass
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


_LOCAL_SCRATCH: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Order: the context's checkpoint dir, then ``spark.checkpoint.dir`` from
    the session; only when both are unset *and* the master is local (tests)
    a temp folder is made and registered, once per application. On a
    cluster an unset folder is an error, never a driver-local directory.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:
            configured = None
    if not configured:
        if not (sc.master or "").startswith("local"):
            # a folder on the driver's disk is invisible to executors
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a folder on shared "
                "storage (HDFS or an object store) that all executors can reach")
        app = sc.applicationId
        configured = _LOCAL_SCRATCH.get(app)
        if configured is None:
            configured = tempfile.mkdtemp(prefix="tidepool-ckpt-")
            _LOCAL_SCRATCH[app] = configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for one job's tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss).

    Never ``localCheckpoint``: its blocks live on executors and die with them.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


#: Units (rows, by default) that a partition of a settled table holds at least.
UNITS_A_PART = 20_000


def settled(df: DataFrame, units: str = "1") -> DataFrame:
    """``cut_lineage`` of one of many short tables: the shuffle files that led to it
    go at once (its checkpoint replaces them), and it comes in no more partitions than
    its measured ``units`` (an SQL expression per row) fill, so that each of the jobs
    over it does not write one set of files for every empty partition."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:  # the setting is read when a frame is made; frames of others keep theirs
        done = cut_lineage(df.select("*"))
        # no Observation: it leaves the session with a part that ML models cannot ship
        seen = done.agg(F.sum(F.expr(units)).alias("units")).first()
    finally:
        conf.unset(key) if before is None else conf.set(key, before)
    return done.coalesce(max(1, -(-(seen.units or 0) // UNITS_A_PART)))


def local_test_session(cores: int = 8) -> SparkSession:
    """Session used by tests and bench: local[cores], small shuffle count."""
    return build(
        master=f"local[{cores}]",
        app_name="tidepool-local",
        shuffle_partitions=cores,
        extra={
            "spark.driver.memory": os.environ.get("TIDEPOOL_DRIVER_MEM", "16g"),
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
        },
    )


def scale_conf(input_bytes: int, *, partition_bytes: int = 256 * 1024 * 1024,
               shuffle_ratio: float = 0.5) -> dict[str, str]:
    """Settings for a job over ``input_bytes`` of (compressed) input.

    * scans split into ~``partition_bytes`` tasks
      (``spark.sql.files.maxPartitionBytes``);
    * the first shuffle of each query starts with enough partitions that
      each holds about ``partition_bytes`` when a ``shuffle_ratio`` share of
      the input crosses it; AQE then coalesces small ones and splits skewed
      ones, aiming at the same advisory size.

    At 100 TB: 409,600 scan tasks of 256 MB and 204,800 initial shuffle
    partitions of the same size, coalesced by AQE after each stage.
    """
    shuffle_parts = max(1, int(input_bytes * shuffle_ratio // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle_parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle_parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes * 4),
    }
