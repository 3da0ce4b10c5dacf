"""Mixing sources to target weights by systematic sampling.

Within a source every document has the same expected number of copies, the source's target over its size. The
prefix sums of the expected copies, plus one random offset for the source, cross integers; a document is emitted once for each
integer crossed in its own step, so it's taken the floor or the ceiling of its expectation. Documents are summed up by falling
size, which keeps the words taken within the largest document's size of the target.

The prefix sum is taken in three levels, so that a source of any size is split: by source over its size classes, within a class over its salts, and within a salt row by row.
Size classes grow by 1/64 above 256 words, so a source has a few thousand at most; the number of salts follows the class's own rows (one for each CELL_ROWS),
so no task numbers many more rows than that. Weights and targets are found on the cluster, too: sources are ranked by a distributed sort, and each round of resharing is one
aggregate, of which the driver gets two numbers.

Random order and offsets come from MD5 of the seed with id and text, so any engine can recompute them.

Edge cases: a null text has size 0; documents of size 0 take nothing; a source of only such documents has target 0; a null source is a
source, last in order; repeated rows are sampled each on its own, null ids are kept; an empty table gives an empty result. Clashing column names are never
read: the columns in use are renamed first.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyforge.llm.storage import bounded_batches, written
from tallyforge.llm.words import slices, utf8

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2.0
SEED = 20240607
#: Rows of a size class that a salt is added for.
CELL_ROWS = 200_000
#: Most size classes, or salts, (about 60 bytes each) that are broadcast to the rows; beyond it the same join shuffles.
BROADCAST_ROWS = 500_000


def _sizes(column: pa.Array) -> np.ndarray:
    data, offsets = utf8(column)
    space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    starts = ~space
    starts[1:] &= space[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    starts[first] = ~space[first]  # a row begins anew
    total = np.concatenate([[0], np.cumsum(starts)])
    return total[offsets[1:]] - total[offsets[:-1]]


def with_size(df: DataFrame, text_col: str, keep_text: bool = True) -> DataFrame:
    """``df`` with ``size``, the number of runs of anything but ASCII white space in the text (null: 0); counted on bytes, a batch at a time."""
    bounded_batches(df.sparkSession)
    kept = [c for c in df.columns if keep_text or c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(text_col)
            sizes = [_sizes(text.slice(low, high - low)) for low, high in slices(text)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(np.concatenate(sizes) if sizes else [], pa.int64())], names=[*kept, "size"])

    return df.mapInArrow(run, StructType([df.schema[c] for c in kept]).add("size", "long"))


def _hash(*parts: Column) -> Column:
    """48 bits of the MD5 of the parts, joined by colons."""
    return F.conv(F.left(F.md5(F.concat_ws(":", *parts)), F.lit(12)), 16, 10).cast("long")


_RANGE = float(1 << 48)


def _same(*names: str) -> Column:
    """Joins on columns of which the right one has a leading __."""
    return reduce(lambda a, b: a & b, (F.col(n).eqNullSafe(F.col(f"__{n}")) for n in names))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST_COPIES) -> DataFrame:
    """``sizes(source, n)``, one row a source, to (source, source_size, target): shares of ``share`` times all sizes by repeating weights, at most ``most`` times a source's size; the excess is shared again by weight."""
    in_order = F.col("source").asc_nulls_last()
    ordered = written(sizes.orderBy(in_order).select("source", "n", F.spark_partition_id().alias("part")), "sources")
    parts = ordered.groupBy("part").agg(F.count("*").alias("rows"))
    before = parts.select(F.col("part").alias("__part"), (F.sum("rows").over(Window.orderBy("part")) - F.col("rows")).alias("before"))  # one row a partition of the sort
    rank = F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy(in_order)) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (rank % len(weights) + 1).cast("int"))
    plan = written(ordered.join(before, _same("part")).select("source", "n", weight.alias("weight"), (most * F.col("n")).alias("most")), "weighted")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0.0))
    now = plan.agg(total(share * F.col("n")).alias("left"), total("weight").alias("total")).first()
    everything, left, open_ = now["left"], now["left"], now["total"]
    while open_:  # ends: each round closes a source at least
        full = left * F.col("weight") / open_ > F.col("most")
        now = plan.agg(total(F.when(full, F.col("most"))).alias("taken"), total(F.when(~full, F.col("weight"))).alias("open")).first()
        if now["open"] == open_:
            break
        left, open_ = everything - now["taken"], now["open"]
    fair = left * F.col("weight") / (open_ or 1.0)
    return plan.select("source", F.col("n").alias("source_size"), F.least(fair, "most").alias("target"))


def sampled(sized: DataFrame, narrow: DataFrame, seed: int = SEED, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST_COPIES) -> DataFrame:
    """``sized`` (columns ``size``, ``source``, ``doc_id`` and ``u``, the random order of equal sizes) with source_size, target and copies added.

    ``narrow`` has these columns of the same rows; what is counted beforehand is counted on it.
    """
    size = F.col("size")
    octave = F.when(size > 0, F.floor(F.log2(size.cast("double")))).otherwise(0)
    size_class = F.when(size < 256, size).otherwise(256 + octave * 64 + F.floor((size / F.pow(F.lit(2.0), octave) - 1) * 64)).cast("long")
    classed = lambda df: df.withColumn("__cls", -size_class)
    classes = written(classed(narrow).groupBy("source", "__cls").agg(F.count("*").alias("rows"), F.sum("size").alias("n")), "size-classes")
    goal = targets(classes.groupBy("source").agg(F.sum("n").alias("n")), weights, share, most).withColumnRenamed("source", "__source")
    before = F.sum("rows").over(Window.partitionBy("source").orderBy("__cls")) - F.col("rows")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = _hash(F.lit(seed), F.lit("offset"), F.coalesce(F.concat(F.lit("="), "source"), F.lit("null"))) / F.lit(_RANGE)
    plan = classes.withColumns({"before": before, "salts": 1 + F.floor(F.col("rows") / CELL_ROWS)}).join(goal, _same("source"))
    plan = written(plan.select(F.col("source").alias("__source"), F.col("__cls").alias("____cls"), "before", "salts", "source_size", "target", expected.alias("expected"), offset.alias("offset")), "size-class-plan")
    small = lambda df: F.broadcast(df) if df.count() <= BROADCAST_ROWS else df
    salted = lambda df: df.join(near, _same("source", "__cls")).drop("__source", "____cls").withColumn("__salt", F.floor(F.col("u") / F.lit(_RANGE) * F.col("salts")))
    near = small(plan)
    # the salt is the upper part of the random order
    cells = salted(classed(narrow)).where("salts > 1").groupBy("source", "__cls", "__salt").agg(F.count("*").alias("rows"))
    above = F.sum("rows").over(Window.partitionBy("source", "__cls").orderBy("__salt")) - F.col("rows")
    cells = written(cells.select(F.col("source").alias("__source"), F.col("__cls").alias("____cls"), F.col("__salt").alias("____salt"), above.alias("above")), "salts")
    rows = salted(classed(sized))
    numbered = rows.withColumn("__n", F.row_number().over(Window.partitionBy("source", "__cls", "__salt").orderBy(F.desc("size"), "u", "doc_id")))
    joined = numbered.join(small(cells), _same("source", "__cls", "__salt"), "left")
    last = F.col("before") + F.coalesce("above", F.lit(0)) + F.col("__n")
    copies = F.floor(last * F.col("expected") + F.col("offset")) - F.floor((last - 1) * F.col("expected") + F.col("offset"))
    whole = F.when(F.col("expected") == F.floor("expected"), F.col("expected").cast("long")).otherwise(copies)  # exact where no sampling is needed
    return joined.withColumn("copies", F.when(size > 0, whole).otherwise(0).cast("long")).select(*sized.columns, "source_size", "target", "copies")


def _used(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> list[Column]:
    """The columns in use: doc_id, source, u and text."""
    text = F.col(text_col).cast("string")
    u = _hash(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit(""))))
    return [F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), u.alias("u"), text.alias("text")]


def _narrow(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """(doc_id, source, u, size), written once."""
    return written(with_size(docs.select(*_used(docs, id_col, text_col, source_col, seed)), "text", keep_text=False), "sizes")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) of every document; reruns on the same rows agree."""
    narrow = _narrow(docs, id_col, text_col, source_col, seed)
    return sampled(narrow, narrow, seed).withColumn("taken", F.col("copies") * F.col("size")).drop("u")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it's taken, with ``copy`` (from 1; another name if there is such a column) added."""
    copy = next(n for n in ("copy", "copy_no", "copy_of_mix", "__copy") if n not in docs.columns)
    narrow = _narrow(docs, id_col, text_col, source_col, seed)
    wide = docs.select(F.struct("*").alias("row"), *_used(docs, id_col, text_col, source_col, seed))
    taken = sampled(with_size(wide, "text", keep_text=False), narrow, seed).where("copies > 0")
    return taken.withColumn("__copy_no", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*", F.col("__copy_no").alias(copy))
