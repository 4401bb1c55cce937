"""Session factory and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings every job relies on. Shuffle width is left to adaptive execution: it
# starts from `initial_partitions` and merges small partitions up to the advisory size.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Row limits per key up to this size are applied before the shuffle as well.
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
    # Pages beyond this many rows are cut from a distributed sort, not from per-task heaps.
    "spark.sql.execution.topKSortFallbackThreshold": "100000",
}
DEFAULT_TIME_ZONE = "Asia/Ho_Chi_Minh"


def build_session(
    app_name: str = "tidemart",
    master: str | None = None,
    time_zone: str = DEFAULT_TIME_ZONE,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create or fetch a session; `conf` overrides the base settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**BASE_CONF, "spark.sql.session.timeZone": time_zone}
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in {**settings, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local session without the setting gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="tidemart-")
    return _local_dirs[context.applicationId]


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package, so that they need no installed copy (once a session)."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tidemart-code-"), "tidemart_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
