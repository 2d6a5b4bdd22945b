"""Tables written to the shared folder and read back: a step that several others read is made once, and lost executors don't undo it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; on a local master without one, a temporary folder."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not _LOCAL:
        _LOCAL.append("file://" + tempfile.mkdtemp(prefix="tracewell-"))
    return _LOCAL[0]


#: Tables written by this session and not deleted yet, by the name of the application.
_STAGED: dict[str, list[str]] = {}


def staged(df: DataFrame, label: str) -> DataFrame:
    """df, written once under a name of its own and read back. It stays until ``discard`` or ``discard_all``."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tracewell/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, paths: list[str]) -> None:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that no later step reads."""
    for df in tables:
        held = _STAGED.get(df.sparkSession.sparkContext.applicationId, [])
        files = {f.rsplit("/", 1)[0].rsplit("/", 1)[-1] for f in df.inputFiles()}
        gone = [p for p in held if p.rsplit("/", 1)[-1] in files]
        _delete(df.sparkSession, gone)
        held[:] = [p for p in held if p not in gone]


def discard_all(spark: SparkSession) -> None:
    """Delete all tables that this session staged: when the results that read them are written."""
    _delete(spark, _STAGED.pop(spark.sparkContext.applicationId, []))
