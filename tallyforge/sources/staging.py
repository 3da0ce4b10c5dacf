"""Stage boundaries: a table written once to the shared folder and reread, so that later plans stay small and lost executors cost one stage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table below ``spark.checkpoint.dir``; where a local session names none (tests), below a folder of our own. On a cluster one must be named."""
    spark = df.sparkSession
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        base = f"file://{tempfile.mkdtemp(prefix='tallyforge-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
