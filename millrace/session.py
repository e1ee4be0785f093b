"""Session set-up and the few settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

# Settings that change results or plans. Shuffle parallelism is left to the
# cluster; AQE coalesces small partitions and splits skewed ones.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Recording the Python line of every column call doubles planning time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def state_conf(memory_mb: int = 512) -> dict[str, str]:
    """RocksDB state store with bounded memory per executor; it spills to disk.

    ``memory_mb`` is shared by all stores of an executor and should grow with
    the executor. Changelog checkpoints upload only what a batch changed.
    """
    store = "spark.sql.streaming.stateStore"
    return {
        f"{store}.providerClass": ROCKSDB_PROVIDER,
        f"{store}.rocksdb.boundedMemoryUsage": "true",
        f"{store}.rocksdb.maxMemoryUsageMB": str(memory_mb),
        f"{store}.rocksdb.changelogCheckpointing.enabled": "true",
    }


def build_session(
    app_name: str,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    state_memory_mb: int = 512,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with UTC, AQE and the bounded RocksDB state store."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {**BASE_CONF, **state_conf(state_memory_mb), **(extra or {})}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def object_store_conf(
    access_key: str,
    secret_key: str,
    endpoint: str | None = None,
    region: str | None = None,
) -> dict[str, str]:
    """S3A options: path-style access without TLS when an endpoint is given."""
    conf = {
        "fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "fs.s3a.access.key": access_key,
        "fs.s3a.secret.key": secret_key,
    }
    if endpoint:
        conf["fs.s3a.endpoint"] = endpoint
        conf["fs.s3a.path.style.access"] = "true"
        conf["fs.s3a.connection.ssl.enabled"] = "false"
    else:
        conf["fs.s3a.path.style.access"] = "false"
        if region:
            conf["fs.s3a.endpoint.region"] = region
    return conf


def configure_object_store(spark: SparkSession, **options: str | None) -> None:
    """Apply :func:`object_store_conf` to a running session."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for key, value in object_store_conf(**options).items():
        hadoop.set(key, value)


@contextmanager
def session_conf(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Set SQL settings for one block and put the former values back."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


# Stand-in folders by application, used only where the cluster names none.
_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in
    ``spark.checkpoint.dir``.

    Where that is unset, one machine (a local master) gets a local folder; on a
    cluster that is an error, since executors would write to their own disks.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="millrace-")
    return _LOCAL_FOLDERS[context.applicationId]


def work_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder for one run of ``name``."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
