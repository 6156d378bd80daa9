"""Session helpers: sane defaults and the shared scratch / checkpoint folder."""

from __future__ import annotations

import tempfile
import threading
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # checkpoints hold full-size frames (the split feature frame): compress them
    "spark.checkpoint.compress": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "tessera", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build or reuse a session. On a cluster pass no master: the launcher decides."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    scratch_dir(spark)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator and points at shared storage; without it this
    raises. Only a local session gets a folder under the local temp folder.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def new_scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared scratch folder (never reused, never cleared)."""
    base = scratch_dir(spark).rstrip("/")
    return f"{base}/tessera/{name}-{uuid.uuid4().hex}"


class persisted:
    """``with persisted(df) as d:`` keeps ``df`` materialised (memory, spilling to disk)
    for the passes inside the block — e.g. the several aggregations of a pipeline fit —
    and releases it afterwards. Lost blocks are recomputed from lineage."""

    def __init__(self, df, level=None):
        from pyspark import StorageLevel
        self.df = df
        self.level = level or StorageLevel.MEMORY_AND_DISK

    def __enter__(self):
        return self.df.persist(self.level)

    def __exit__(self, *exc):
        self.df.unpersist()
        return False


def checkpointed(df):
    """Reliable checkpoint into the session's shared checkpoint folder (cuts lineage,
    survives executor loss). Resolves the folder first, so it also works in a session
    built without one."""
    scratch_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# Small files of a shared folder ---------------------------------------------------------

_commits = threading.Lock()


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write ``text`` to ``path`` unless it exists; False if it does. The file appears whole: it is written aside and
    renamed without overwriting, which shared file systems do atomically; threads of one driver take turns besides."""
    target, fs = _file_system(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{uuid.uuid4().hex}")
    gateway, hadoop = spark.sparkContext._gateway, spark._jvm.org.apache.hadoop.fs
    with _commits:
        if fs.exists(target):
            return False
        out = fs.create(aside, False)
        out.write(bytearray(text.encode()))
        out.close()
        context = hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
        try:
            context.rename(aside, target, gateway.new_array(getattr(hadoop, "Options$Rename"), 0))
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in str(e.java_exception):
                raise
            fs.delete(aside, False)
            return False
    return True


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder, sorted, without those being written; none if there is no folder."""
    target, fs = _file_system(spark, path)
    if not fs.exists(target):
        return []
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(target)) if not n.startswith(("_", ".")))


def get_text(spark: SparkSession, path: str) -> str:
    target, fs = _file_system(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
