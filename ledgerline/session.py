"""SparkSession settings the pipeline relies on.

Everything here is a plain Spark config: UTC session clock (timestamps in
the models are wall-clock values), ANSI mode (bad casts raise instead of
turning into NULL), AQE with partition coalescing and skew-join splitting,
and no web UI.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings applied to every session we build. On a cluster the same keys
# go into spark-defaults; shuffle partitions is sized by the caller.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # streaming state (dedup ids, open windows) kept on local disk in RocksDB
    # instead of the executor heap; applies to new checkpoints
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "ledgerline",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Set the SQL confs that can change on a live session (the driver
    hands us its own session, so we cannot rely on the builder)."""
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.adaptive.skewJoin.enabled"):
        spark.conf.set(k, BASE_CONF[k])


def work_dir(spark: SparkSession) -> str:
    """Shared scratch root for written tables, stream checkpoints and
    lineage cuts: the cluster's ``spark.checkpoint.dir``.

    Only a local session that has none (tests) gets one of its own; on a
    cluster a machine-local folder would be lost to the other machines.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
            root = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused directory under the shared work dir."""
    import uuid

    root = work_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the cluster's file system (any scheme)."""
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def list_partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the ``column=value`` sub-directories under ``path``."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(column + "="):
            out.append(name.split("=", 1)[1])
    return out


def first_file(spark: SparkSession, path: str) -> str:
    """A data file of the folder ``path``."""
    fs, p = _fs_path(spark, path)
    return min(str(st.getPath()) for st in fs.listStatus(p)
               if st.isFile() and st.getPath().getName()[0] not in "._")


def copy_file(spark: SparkSession, file: str, folder: str) -> None:
    """Copy a file into a folder, under a name of its own."""
    import uuid

    (fs, src), (to, dst) = _fs_path(spark, file), _fs_path(spark, f"{folder}/{uuid.uuid4().hex}-{file.rpartition('/')[2]}")
    spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy(
        fs, src, to, dst, False, spark.sparkContext._jsc.hadoopConfiguration())


def delete_files(spark: SparkSession, files: list[str]) -> None:
    for f in files:
        fs, p = _fs_path(spark, f)
        fs.delete(p, False)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())


def modified(spark: SparkSession, path: str) -> int:
    """Modification time of a file, in milliseconds."""
    fs, p = _fs_path(spark, path)
    return fs.getFileStatus(p).getModificationTime()


def swap_folder(spark: SparkSession, new: str, path: str) -> None:
    """Put the folder ``new`` in the place of ``path`` by renaming; what was
    there is removed afterwards, or put back if the renaming fails."""
    import uuid

    (fs, src), (_, dst) = _fs_path(spark, new), _fs_path(spark, path)
    _, old = _fs_path(spark, f"{path.rstrip('/')}-{uuid.uuid4().hex[:12]}")
    held = fs.exists(dst)
    if held and not fs.rename(dst, old):
        raise OSError(f"{path} could not be renamed")
    if not fs.exists(dst.getParent()):
        fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        if held:
            fs.rename(old, dst)
        raise OSError(f"{new} could not be renamed to {path}")
    if held:
        fs.delete(old, True)


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs_path(spark, path)
    fs.delete(p, True)


def local_path(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def is_local_dir(path: str) -> bool:
    return os.path.isdir(local_path(path))


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int) -> dict[str, str]:
    """Starting values for a large run: about 200 MB of shuffle input per
    task before AQE coalesces (capped at 200k partitions, beyond which the
    driver's map-output bookkeeping grows too large; AQE still splits skewed
    partitions), scan splits of 512 MB, and at least two tasks per core."""
    slots = executors * cores_per_executor
    parts = min(200_000, max(2 * slots, input_bytes // (200 * 1024 * 1024)))
    return {
        "spark.sql.shuffle.partitions": str(int(parts)),
        "spark.sql.files.maxPartitionBytes": str(512 * 1024 * 1024),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }
