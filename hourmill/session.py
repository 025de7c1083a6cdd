"""Session defaults and shared scratch locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this library assumes. UTC is required: `date`
# partitions, epoch seconds and `to_utc_timestamp` all depend on it.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Delete checkpoint files once their DataFrame is garbage-collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str = "local[8]",
    app: str = "hourmill",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session for tests and benchmarks; on a cluster pass your own."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session zone; every time computation here assumes UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster shares between executors.

    Taken from ``spark.checkpoint.dir`` (or the context's checkpoint
    directory). Only when neither is set, as in a bare local test
    session (another master raises), a private temporary directory is created and installed as
    the checkpoint directory, so later calls agree on it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if sc.master != "local" and not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="hourmill-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique directory path under the shared root (not created)."""
    root = shared_root(spark).rstrip("/")
    return f"{root}/hourmill/{label}-{uuid.uuid4().hex[:12]}"


def _fs_for(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when the path exists on the (shared) file system."""
    fs, hpath = _fs_for(spark, path)
    return bool(fs.exists(hpath))


def visible_children(spark: SparkSession, path: str) -> bool:
    """True when a folder holds anything but names starting with ``_`` or ``.``."""
    fs, hpath = _fs_for(spark, path)
    if not fs.exists(hpath):
        return False
    return any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(hpath))


def write_small_text(spark: SparkSession, path: str, text: str) -> None:
    """Write one small file on the (shared) file system, replacing it."""
    fs, hpath = _fs_for(spark, path)
    out = fs.create(hpath, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_small_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, None when it is absent."""
    if not path_exists(spark, path):
        return None
    fs, hpath = _fs_for(spark, path)
    source = fs.open(hpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def put_small_text(spark: SparkSession, path: str, text: str) -> None:
    """Write one small file that is there whole or not at all: under a hidden name, then renamed."""
    folder, name = path.rsplit("/", 1)
    hidden = f"{folder}/.{name}.{uuid.uuid4().hex[:8]}"
    write_small_text(spark, hidden, text)
    fs, source = _fs_for(spark, hidden)
    _, target = _fs_for(spark, path)
    if fs.exists(target):
        fs.delete(target, False)
    if not fs.rename(source, target):
        raise OSError(f"could not write {path}")


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, without those starting with ``_`` or ``.``; an absent folder has none."""
    fs, hpath = _fs_for(spark, path)
    if not fs.exists(hpath):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(hpath))
    return sorted(n for n in names if not n.startswith(("_", ".")))


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder this library wrote itself."""
    fs, hpath = _fs_for(spark, path)
    if fs.exists(hpath):
        fs.delete(hpath, True)
