"""An extension: new page files of words as a stream, with lines rebuilt for each batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyforge.operators import layout
from tallyforge.sources.tokens import TOKENS


def stream_words(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Words of the page files that appear below ``path``, as ``read_tokens`` gives them for a batch."""
    pages = spark.readStream.schema(TOKENS).option("multiLine", True).option("maxFilesPerTrigger", max_files).json(path)
    doc = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:_p[0-9]+)?(?:_[0-9]+dpi)?\.json$", 1)
    return pages.select(doc.alias("doc"), "page", "dpi", F.posexplode("tokens").alias("pos", "t")).select("doc", "page", "dpi", "pos", "t.*")


def lines_to(spark: SparkSession, path: str, out: str, checkpoint: str) -> StreamingQuery:
    """Append each new page's lines to the Parquet table ``out``; a page is one file, so a batch holds it whole."""

    def batch(words: DataFrame, epoch: int) -> None:
        layout.line_texts(layout.group_lines(words)).write.mode("overwrite").parquet(f"{out}/epoch={epoch}")  # a repeated epoch replaces itself

    return stream_words(spark, path).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
