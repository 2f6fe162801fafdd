"""Session factory and cluster plumbing shared by every part of the library."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parent.parent
#: Rows and bytes of an Arrow batch between Spark and Python: what a task holds of whole texts on either side.
BATCH_ROWS, BATCH_BYTES = 512, 4 << 20


def get_session(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A UTC session with AQE on; ``master`` and the partition count only where the cluster leaves them open."""
    builder = SparkSession.builder.appName("barloom").config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset, a temporary one on a local master, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="spark-barloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def cut(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage with files that every executor and the driver can reach, so a lost executor costs
    nothing that has been written, and later plans see true sizes.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/barloom/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.cut_path = path
    return out


def counted_cut(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``cut`` and the number of rows, observed while they are written: no job beside the write."""
    seen = Observation(name)
    out = cut(df.observe(seen, F.count(F.lit(1)).alias("n")), name)
    return out, seen.get["n"]


def discard(df: DataFrame) -> None:
    """Delete the files of a ``cut`` that nothing reads any more, as those of a round once the next one is written."""
    jvm = df.sparkSession._jvm
    path = jvm.org.apache.hadoop.fs.Path(df.cut_path)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def bound_batches(spark: SparkSession) -> None:
    """Small Arrow batches, where the session leaves their size open: long texts must not fill executors off the heap."""
    set_already = spark.conf.getAll
    for name, value in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        if (key := f"spark.sql.execution.arrow.{name}") not in set_already:
            spark.conf.set(key, str(value))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors unless their Python path or working folder has it already; bound batches."""
    bound_batches(spark)
    paths = os.environ.get("PYTHONPATH", "").split(os.pathsep) + [os.getcwd()]
    if any(p and Path(p).resolve() == ROOT for p in paths) or getattr(spark.sparkContext, "_barloom_shipped", False):
        return
    out = Path(tempfile.mkdtemp(prefix="spark-barloom-")) / "barloom_pkg.zip"
    with zipfile.ZipFile(out, "w") as z:
        for p in sorted((ROOT / "barloom").rglob("*.py")):
            z.write(p, p.relative_to(ROOT))
    spark.sparkContext.addPyFile(str(out))
    spark.sparkContext._barloom_shipped = True
