"""Session factory and shared scratch folder.

Write-then-read steps (archive appends, JSON exports, streaming sinks) need a
folder every executor can see.  That is the folder the cluster names in
``spark.checkpoint.dir``; it is only invented here when the session has none,
which is the case for local tests and the bench.
"""

from __future__ import annotations

import tempfile
import uuid
import weakref

from pyspark.sql import SparkSession

_LOCAL_FALLBACK: str | None = None

# Per-session memo of logical plans (relations, fixture views); dropped with the session.
_PLAN_MEMO: "weakref.WeakKeyDictionary[SparkSession, dict]" = weakref.WeakKeyDictionary()


def plan_memo(spark: SparkSession, name: str) -> dict:
    """A named dictionary that lives as long as ``spark``.

    Holds logical plans only (DataFrame objects), never data.
    """
    return _PLAN_MEMO.setdefault(spark, {}).setdefault(name, {})


def forget_plans(spark: SparkSession) -> None:
    """Drop every memoised plan of ``spark`` (e.g. after its input files changed)."""
    _PLAN_MEMO.pop(spark, None)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "worklens") -> SparkSession:
    """A local session with the settings the tests and the bench assume."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_settings(input_bytes: int, total_cores: int,
                     target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Runtime SQL settings for a run over ``input_bytes`` on ``total_cores`` cores.

    Initial shuffle partitions are sized so that a lineitem-scale shuffle
    (the worklist keep-first) writes about ``target_partition_bytes`` per
    partition, never fewer than two waves of tasks; AQE then coalesces the
    small report stages and splits skewed join partitions.
    """
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    size = f"{target_partition_bytes >> 20}m"
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        # Streaming state (dedupe keys, open weeks) off the JVM heap, with
        # incremental checkpoints; must be set before a query's first run.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }


def apply_settings(spark: SparkSession, settings: dict[str, str]) -> None:
    for k, v in settings.items():
        spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder.

    Taken from ``spark.checkpoint.dir`` (or the context's checkpoint folder).
    Only a local-mode session without one gets a fresh temporary folder; on a
    cluster a missing setting is an error, never a machine-local fallback.
    """
    global _LOCAL_FALLBACK
    try:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # some deployments hide core settings from the SQL conf
        configured = None
    if configured:
        return configured
    try:
        sc = spark.sparkContext
    except Exception:  # no SparkContext reachable (e.g. a remote session)
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    try:
        master = spark.conf.get("spark.master", "")
    except Exception:
        master = ""
    if not master.startswith("local"):
        # Executors on other machines cannot see a driver-local temp folder.
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _LOCAL_FALLBACK is not None:
        return _LOCAL_FALLBACK
    _LOCAL_FALLBACK = tempfile.mkdtemp(prefix="worklens-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(_LOCAL_FALLBACK)
    return _LOCAL_FALLBACK


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    sep = "" if base.endswith("/") else "/"
    return f"{base}{sep}worklens/{name}-{uuid.uuid4().hex}"
