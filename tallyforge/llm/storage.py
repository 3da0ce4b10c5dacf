"""Where operators cut lineage: tables in the shared folder named by ``spark.checkpoint.dir``."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster; only where a local session names none (tests) a folder of our own."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        named = f"file://{tempfile.mkdtemp(prefix='tallyforge-')}"
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; reruns and retries never meet an older run's files."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return the reread table."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df_or_path, spark: SparkSession | None = None) -> None:
    """Delete a table made by ``written`` that no later plan reads."""
    paths = [df_or_path] if isinstance(df_or_path, str) else sorted({f.rpartition("/")[0] for f in df_or_path.inputFiles()})
    session = spark or df_or_path.sparkSession
    jvm = session.sparkContext._jvm
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(session.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


#: Rows of an Arrow batch where texts go to Python; Spark's default of 10,000 holds tens of MB of text in every worker.
BATCH_ROWS = 1000


def bounded_batches(spark: SparkSession) -> None:
    """Set smaller Arrow batches for the session, unless it already asks for other than the default."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(BATCH_ROWS))
