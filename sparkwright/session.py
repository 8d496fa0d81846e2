"""Session set-up and the shared scratch location.

Every job reads its settings from the running session. Defaults are applied
only where the cluster has not named a value, so a production launch keeps
its own shuffle sizing, checkpoint folder and broadcast threshold.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults for settings the cluster did not name. AQE re-plans joins and
# coalesces / splits shuffle partitions at run time, which is what keeps one
# plan usable from sf0.01 up to very large inputs.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows can hold whole texts of many megabytes: bound a Python worker's
    # batch by rows and by bytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    # Streaming state (the hourly report keeps one row per account and hour)
    # lives in RocksDB on local disk instead of the executor heap, and each
    # micro-batch checkpoints only its changes.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "sparkwright",
                conf: dict[str, str] | None = None) -> SparkSession:
    """Return the active session, or build one with the defaults above.

    ``master`` is only used when no session exists yet (tests, bench).
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        apply_defaults(active, conf)
        return active
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark, conf)
    return spark


def apply_defaults(spark: SparkSession, conf: dict[str, str] | None = None) -> None:
    """Set runtime SQL defaults that are still unset; explicit ``conf`` wins."""
    for key, value in DEFAULTS.items():
        if key.startswith("spark.sql.") and spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    for key, value in (conf or {}).items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    ship_library(spark)


# Shuffle sizing. AQE coalesces small shuffle partitions after the fact but
# cannot split large ones (except in skewed joins), so the initial count must
# be sized for the biggest input: about SHUFFLE_TARGET_BYTES of shuffle data
# per partition, assuming shuffle rows take SHUFFLE_EXPANSION times their
# compressed columnar size. Never fewer partitions than cores.
SHUFFLE_TARGET_BYTES = 256 << 20
SHUFFLE_EXPANSION = 3.0
MAX_SHUFFLE_PARTITIONS = 100_000
_AUTO_MARK = "spark.sparkwright.shufflePartitions.auto"


def input_bytes(spark: SparkSession, path: str) -> int | None:
    """Total file bytes under ``path`` from file-system metadata (no data is
    read); None where the JVM gateway is unavailable."""
    try:
        jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
        return int(fs.getContentSummary(jpath).getLength())
    except Exception:  # noqa: BLE001 - e.g. Spark Connect, missing path
        return None


def _partitions_fixed(spark: SparkSession) -> bool:
    conf = spark.conf
    return conf.get("spark.sql.shuffle.partitions", None) is not None \
        and conf.get(_AUTO_MARK, "false") != "true"


def size_shuffle_partitions(spark: SparkSession, nbytes: int | None) -> int | None:
    """Set ``spark.sql.shuffle.partitions`` for an input of ``nbytes``.

    Left alone when the launch or the caller fixed it; a value set here
    earlier is re-sized for the new input. Returns the value in force.
    """
    conf = spark.conf
    if _partitions_fixed(spark) or nbytes is None:
        return int(conf.get("spark.sql.shuffle.partitions"))
    cores = spark.sparkContext.defaultParallelism
    wanted = int(nbytes * SHUFFLE_EXPANSION // SHUFFLE_TARGET_BYTES) + 1
    n = max(cores, min(MAX_SHUFFLE_PARTITIONS, wanted))
    conf.set("spark.sql.shuffle.partitions", str(n))
    conf.set(_AUTO_MARK, "true")
    return n


def size_shuffle_for_path(spark: SparkSession, path: str) -> int | None:
    """``size_shuffle_partitions`` for the input under ``path``; the folder is
    measured only when the value is not fixed (a listing of a large object
    store folder is not free)."""
    if _partitions_fixed(spark):
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    return size_shuffle_partitions(spark, input_bytes(spark, path))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the launch (a shared file system): a
    machine-local folder would leave each executor with its own files, so
    without it this raises. Only a local master gets a private folder.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="sparkwright-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


_SHIPPED: set[str] = set()


def ship_library(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per SparkContext.

    The package is zipped in memory, written through the Hadoop file system
    to the shared scratch folder and added with ``addPyFile``, which copies it
    to every executor (what ``--py-files`` does at submit time). Without it,
    a worker can import the package only if it happens to be installed there.
    """
    import io
    import os
    import zipfile

    try:
        sc = spark.sparkContext
        sc._jsc  # noqa: B018
    except Exception:  # noqa: BLE001 - no JVM gateway (e.g. Spark Connect): nothing to ship
        return
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg):
            for name in sorted(files):
                if name.endswith(".py"):
                    full = os.path.join(dirpath, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    target = f"{scratch_path(spark, 'pyfiles')}/sparkwright.zip"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(target)
    out = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).create(jpath, True)
    try:
        out.write(bytearray(buf.getvalue()))
    finally:
        out.close()
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder under the shared checkpoint root.

    Used for round trips, staging tables, stream checkpoints and sinks.
    Each call gets its own folder, so reruns never reuse half-written data.
    """
    root = ensure_checkpoint_dir(spark)
    own = f"{root.rstrip('/')}/sparkwright/{spark.sparkContext.applicationId}"
    if own not in _OWN_FOLDERS:
        _OWN_FOLDERS.add(own)
        atexit.register(_remove_folder, spark, own)
    return f"{own}/{purpose}-{uuid.uuid4().hex[:12]}"


_OWN_FOLDERS: set[str] = set()


def _remove_folder(spark: SparkSession, path: str) -> None:
    """Delete this application's scratch folder when the driver's Python ends.
    Results that are still read lie there, so it can't go earlier; if the
    session is gone by then the folder stays."""
    try:
        jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)
    except Exception:  # noqa: BLE001 - the JVM has ended
        pass
