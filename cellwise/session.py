"""Session helpers: one place that knows how a session should be configured."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str = "local[8]", shuffle_partitions: int = 8,
              driver_memory: str = "16g", app: str = "cellwise") -> SparkSession:
    """Local session for tests and benches. On a cluster, build your own
    session; the library only relies on ``spark.checkpoint.dir``."""
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in _LOCAL_DEFAULTS.items():
        builder = builder.config(k, v)
    builder = (builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    The cluster's ``spark.checkpoint.dir`` wins.  Only in local mode, where
    driver and executors are one process, a private folder is made if nothing
    is set; on a cluster that raises, as executors could not see it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="cellwise-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder (never machine-local
    on a cluster), for tables a job writes and reads back."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    folder = f"{base}/cellwise-scratch/{uuid.uuid4().hex}"
    for made in _SCOPES:
        made.append(folder)
    return f"{folder}/{name}"


_SCOPES: list[list[str]] = []


@contextmanager
def scratch_scope() -> Iterator[list[str]]:
    """Collects the scratch folders made inside, for :func:`remove_folders`
    once the results that read them are written."""
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield made
    finally:
        _SCOPES[:] = [s for s in _SCOPES if s is not made]  # scopes may be nested and equal


def remove_folders(spark: SparkSession, folders: Iterable[str]) -> None:
    """Delete scratch folders from the file system that holds them."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for f in folders:
        path = jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(conf).delete(path, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the file system that holds ``path`` has it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package (Python functions of operators import
    it there), once per application, as ``spark-submit --py-files`` would."""
    sc = spark.sparkContext
    if getattr(sc, "_cellwise_shipped", False):
        return
    root = Path(__file__).resolve().parent
    # The driver serves this file to the executors as long as it runs.
    folder = tempfile.mkdtemp(prefix="cellwise-zip-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = Path(folder, "cellwise.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, Path("cellwise", p.relative_to(root)))
    sc.addPyFile(str(archive))
    sc._cellwise_shipped = True


def bound_batches(spark: SparkSession, size: str = "8m") -> None:
    """Bound what a Python worker holds at once: Arrow batches of ``size``
    instead of Spark's default, which long texts fill.  A value that the user
    has set is left alone."""
    key, default = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
    if spark.conf.get(key, default) == default:
        spark.conf.set(key, size)


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Shuffle and scan sizing for a cluster run over ``input_bytes``.

    Start with enough shuffle partitions that each holds about
    ``target_partition_bytes`` of the input (never fewer than 2 waves of
    cores) and let AQE coalesce small ones and split skewed ones at runtime.
    """
    parts = max(2 * total_cores, -(-int(input_bytes) // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(min(target_partition_bytes, 512 << 20)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


__all__ = ["get_spark", "ensure_checkpoint_dir", "ship_package", "bound_batches", "scratch_path", "scratch_scope", "remove_folders", "path_exists", "scale_conf"]
