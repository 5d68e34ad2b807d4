"""Session helpers: a local session for tests/bench and the shared scratch dir."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Scratch paths of this process.
_SCRATCH: list[str] = []

_LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tokscope", driver_memory: str = "16g") -> SparkSession:
    """A local[N] session configured like the cluster profile (AQE on, UI off)."""
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.tokscope.scan.partitions", str(cpus if str(cpus).isdigit() else os.cpu_count() or 1))
         .config("spark.driver.memory", driver_memory))
    for k, v in _LOCAL_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint dir; set a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS/S3/...);
    we never override it. Only local runs (tests, bench) get a fresh dir; any
    other master without the setting raises, because a machine-local folder
    would not be shared by its executors.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="tokscope-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def input_key(spark: SparkSession, path: str) -> tuple:
    """Names what is read from ``path`` now: the application, and every input file with its size and modification time."""
    f = spark.read.parquet(path).select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    return spark.sparkContext.applicationId, tuple(sorted(tuple(map(str, r)) for r in f.collect()))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path under the shared checkpoint dir for written tables; see :func:`drop_scratch`."""
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
    _SCRATCH.append(path)
    return path


def scratch_mark() -> int:
    """How many scratch paths this process has handed out and not dropped."""
    return len(_SCRATCH)


def drop_scratch(spark: SparkSession, since: int = 0, keep: int = 0) -> int:
    """Remove the written tables that this process made under the shared folder after the mark ``since``, but the last ``keep`` of them,
    once no DataFrame over them is in use any more (a long session calls it between jobs). Returns how many paths went."""
    gone = _SCRATCH[since:len(_SCRATCH) - keep]
    _SCRATCH[since:len(_SCRATCH) - keep] = []
    for path in gone:
        remove(spark, path)
    return len(gone)


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def committed(spark: SparkSession, path: str) -> list[str]:
    """Sub-folders of ``path`` that hold a finished write, in any file system that Spark reads."""
    top, fs = _file_system(spark, path)
    if not fs.exists(top):
        return []
    found = [x.getPath() for x in fs.listStatus(top) if x.isDirectory()]
    return [p.toString() for p in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """A small file in the shared folder, there as a whole or not at all: written under another name and renamed. No Spark job."""
    there, fs = _file_system(spark, path)
    new = spark._jvm.org.apache.hadoop.fs.Path(there.getParent(), "_" + there.getName())
    out = fs.create(new, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    if fs.exists(there):
        fs.delete(there, False)
    fs.rename(new, there)


def files_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the finished files in ``path``."""
    top, fs = _file_system(spark, path)
    names = [x.getPath().getName() for x in fs.listStatus(top)] if fs.exists(top) else []
    return sorted(n for n in names if not n.startswith(("_", ".")))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote in the shared folder."""
    there, fs = _file_system(spark, path)
    fs.delete(there, True)


def materialised(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a Parquet table in the shared folder and read back: branches that share it read pruned columns
    instead of running its plan again, and a lost executor costs no recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
