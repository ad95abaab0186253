"""The folder that the driver and all executors share, and tables written there to end a lineage."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. A local master without one (tests, a laptop) gets a temporary folder; a cluster raises."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="rillstone-")
        spark.conf.set("spark.checkpoint.dir", base)
        _made.append((spark, base))
    return base.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; removed when the driver ends."""
    path = f"{shared_dir(spark)}/rillstone/{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def materialize(df: DataFrame, name: str, instead: DataFrame | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: the lineage ends there.

    A lost executor costs a reread of files and never a second run of the plan above. ``instead``, an earlier result of
    this function that nothing but ``df`` needs, is removed afterwards.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._rillstone_folder = path
    if instead is not None:
        discard(instead)
    return out


#: A table of fewer bytes for each core, in fewer files than twice the cores, is dealt out anew by ``spread``.
SMALL_SHARE = 16 << 20


def spread(df: DataFrame) -> DataFrame:
    """``df``, dealt out over all cores if it is a small table in few files, which else few tasks would read.

    Larger tables are split by Spark itself and stay as they are: no row of theirs is shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) >= SMALL_SHARE * cores or len(df._jdf.inputFiles()) >= 2 * cores:
        return df
    return df.repartition(cores)


def discard(written: DataFrame) -> None:
    """Remove the files of a result of ``materialize``."""
    path = written._rillstone_folder
    remove(written.sparkSession, path)
    _made.remove((written.sparkSession, path))


def filesystem(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path for it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file systems."""
    fs, where = filesystem(spark, path)
    fs.delete(where, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file on any of Spark's file systems; None if there is none."""
    fs, where = filesystem(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """A small file on any of Spark's file systems, in place of an earlier one."""
    fs, where = filesystem(spark, path)
    stream = fs.create(where, True)
    try:
        stream.write(bytearray(data))
    finally:
        stream.close()


@atexit.register
def _clean() -> None:
    for spark, path in reversed(_made):
        try:
            if spark.sparkContext._jsc is not None:
                remove(spark, path)
        except Exception:  # noqa: BLE001  the JVM may be gone at exit; nothing is left to do then
            return
