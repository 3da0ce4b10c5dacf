"""Sources: positioned-word files, gold links, recorded second opinions and plain tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TOKENS = "page int, dpi int, tokens array<struct<text:string,conf:double,x0:double,y0:double,x1:double,y1:double>>"
LINKS = "array<struct<summary_row:string,col:string,note_row:string,relation:string>>"
DECISIONS = "decisions array<struct<row_id:string,relation:string,col:int,confidence:double,reason:string>>"
GOLD = "doc string, item_id string, note_row string, relation string"
ANSWERS = "doc string, item_id string, ord int, row_id string, relation string, col int, confidence double, reason string"
WORDS = "doc string, page int, dpi int, pos int, text string, conf double, x0 double, y0 double, x1 double, y1 double"


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row a word of all page files below ``path``; the document is the file name up to the page, ``pos`` the word's place in its file."""
    pages = spark.read.schema(TOKENS).option("multiLine", True).json(path)
    doc = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:_p[0-9]+)?(?:_[0-9]+dpi)?\.json$", 1)
    return pages.select(doc.alias("doc"), "page", "dpi", F.posexplode("tokens").alias("pos", "t")).select("doc", "page", "dpi", "pos", "t.*")


def from_polygons(df: DataFrame, polygon_col: str) -> DataFrame:
    """Axis-aligned boxes of word polygons (array of [x, y])."""
    side = lambda i, f: f(F.transform(polygon_col, lambda p: p[i].cast("double")))
    return df.withColumns({"x0": side(0, F.array_min), "y0": side(1, F.array_min), "x1": side(0, F.array_max), "y1": side(1, F.array_max)})


def read_gold_links(spark: SparkSession, path: str, note: int, doc: str) -> DataFrame:
    """Hand-labelled links of one note of the report ``doc``: (doc, item_id, note_row, relation); a missing file or note gives none. Other keys of the file may have any type."""
    empty = spark.createDataFrame([], GOLD)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return empty
    found = spark.read.schema(f"`{note}` {LINKS}").option("multiLine", True).json(path).select(F.explode(F.col(f"`{note}`")).alias("g"))
    return found.select(F.lit(doc).alias("doc"), F.concat_ws(":", "g.summary_row", "g.col").alias("item_id"), "g.note_row", "g.relation")


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """All recorded answers below ``path``: (key, decisions), one file a call, named by its key; files that hold no answer have null decisions, a missing folder has none."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(hadoop) or not len(files.listStatus(hadoop)):
        return spark.createDataFrame([], f"key string, {DECISIONS}")
    raw = spark.read.schema(DECISIONS).option("multiLine", True).json(path)
    return raw.select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.json$", 1).alias("key"), "decisions")


def decisions_of(asked: DataFrame, answers: DataFrame) -> DataFrame:
    """``asked(doc, item_id, key)`` with the recorded ``answers(key, decisions)``: (doc, item_id, ord, row_id, relation, col, confidence, reason). An item that was asked in vain has no row."""
    found = asked.select("doc", "item_id", "key").join(answers.where("decisions is not null"), "key")
    return found.select("doc", "item_id", F.posexplode_outer("decisions").alias("ord", "d")).select("doc", "item_id", "ord", "d.*")


def read_decisions(spark: SparkSession, path: str, items: dict[str, tuple[str, str]]) -> DataFrame:
    """Recorded answers whose files aren't named by a key of ours; ``items`` maps file names without suffix to (doc, item_id)."""
    asked = spark.createDataFrame([(doc, item, key) for key, (doc, item) in items.items()], "doc string, item_id string, key string")
    return decisions_of(asked, read_answers(spark, path))


def cache_key(*parts: Column | str) -> Column:
    """Content address of a call: 16 digits of the SHA-1 of its parts, one a line."""
    return F.left(F.sha1(F.concat_ws("\n", *parts)), F.lit(16))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
