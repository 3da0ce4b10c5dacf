"""Geometry: words to lines, right edges to columns, words to cells.

A page is the unit of layout (at most a few hundred words), so the one order-dependent step, line building, is a
function of a whole page; the rest are windows and joins on the page key.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import median

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions import fixed, text

PAGE = ["doc", "page"]


def centre(prefix: str = "") -> Column:
    return (F.col(f"{prefix}y0") + F.col(f"{prefix}y1")) / 2


def _line_numbers(centres: list[float], tolerance: float) -> list[int]:
    """Line of each centre, taken in rising order: the nearest of the last three lines whose running median is close enough, else a new one."""
    lines: list[list[float]] = []
    out = []
    for c in centres:
        recent = [(abs(median(lines[n]) - c), n) for n in range(max(0, len(lines) - 3), len(lines))]
        best = min((r for r in recent if r[0] <= tolerance), default=None)
        if best is None:
            lines.append([c])
            out.append(len(lines) - 1)
        else:
            lines[best[1]].append(c)
            out.append(best[1])
    return out


def group_lines(words: DataFrame, tolerance: float = fixed.LINE_TOLERANCE, keys: list[str] | None = None) -> DataFrame:
    """``words`` (with pos, y0, y1) with ``line_no``; ties in height are taken in order of pos."""
    keys = keys or PAGE
    kinds = ", ".join(f"{k} {words.schema[k].dataType.simpleString()}" for k in keys)
    others = [c for c in words.columns if c not in keys]
    page = words.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(centre().alias("c"), "pos", F.struct(*others).alias("w")))).alias("__t"))  # a page's words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = [_line_numbers([w["c"] for w in t], tolerance) for t in batch.column("__t").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), batch.column("__t"), pa.array(numbers, pa.list_(pa.int32()))], names=[*keys, "__t", "__n"])

    numbered = page.mapInArrow(run, f"{kinds}, __t {page.schema['__t'].dataType.simpleString()}, __n array<int>")
    flat = numbered.select(*keys, F.explode(F.arrays_zip("__t", "__n")).alias("__x")).select(*keys, *(F.col(f"__x.__t.w.{c}").alias(c) for c in others), F.col("__x.__n").alias("line_no"))
    return flat.select(*words.columns, "line_no")


def line_texts(lined: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row a line: text in order of x0, first word's y0 and the extent."""
    keys = keys or PAGE
    word = F.struct("x0", "pos", "text", "y0")
    out = lined.groupBy(*keys, "line_no").agg(F.array_sort(F.collect_list(word)).alias("w"), F.min("y0").alias("top"), F.max("y1").alias("bottom"))
    return out.select(*keys, "line_no", F.array_join(F.transform("w", lambda w: w["text"]), " ").alias("text"), F.col("w")[0]["y0"].alias("first_y0"), "top", "bottom")


def gap_clusters(df: DataFrame, value: str, gap: float, keys: list[str], out: str = "cluster", order: list[str] | None = None) -> DataFrame:
    """Islands of a sorted value: a new one begins where the step from the one before exceeds ``gap``."""
    w = Window.partitionBy(*keys).orderBy(value, *(order or []))
    step = F.col(value) - F.lag(value).over(w)
    return df.withColumn("__new", F.when(step > gap, 1).otherwise(0)).withColumn(out, F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def value_columns(words: DataFrame, gap: float = fixed.COLUMN_GAP, keys: list[str] | None = None) -> DataFrame:
    """Columns of amounts from clusters of right edges: (keys, col_idx, col_id, x0, x1) at the 5th and 90th percentile."""
    keys = keys or PAGE
    amounts = gap_clusters(words.where(text.is_amount("text")), "x1", gap, keys, order=["pos"])
    cols = amounts.groupBy(*keys, "cluster").agg(F.count("*").alias("n"), F.percentile("x0", F.lit(0.05)).alias("x0"), F.percentile("x1", F.lit(0.9)).alias("x1")).where(F.col("n") >= fixed.MIN_COLUMN_WORDS)
    idx = F.row_number().over(Window.partitionBy(*keys).orderBy("cluster")) - 1
    return cols.withColumn("col_idx", idx).select(*keys, "col_idx", F.concat(F.lit("v"), "col_idx").alias("col_id"), "x0", "x1")


def note_column(words: DataFrame, cols: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The column of note references left of the amounts: (keys, nx0, nx1), for pages that have one."""
    keys = keys or PAGE
    first = cols.where("col_idx = 0").select(*keys, F.col("x0").alias("limit"))
    mid = (F.col("x0") + F.col("x1")) / 2
    header = words.where(text.tr_lower("text").startswith("dipnot")).groupBy(*keys).agg(F.min_by(mid, F.struct("line_no", "x0", "pos")).alias("head"))
    cands = words.join(first, keys).where(text.strip(F.col("text")).rlike(fixed.NOTE_TOKEN) & (F.col("x1") < F.col("limit"))).join(header, keys, "left")
    near = cands.where(F.col("head").isNull() | (F.abs(mid - F.col("head")) < fixed.NOTE_HEADER_REACH))
    found = near.groupBy(*keys).agg(F.count("*").alias("n"), F.median(mid).alias("c")).where(F.col("n") >= fixed.MIN_COLUMN_WORDS)
    return found.select(*keys, (F.col("c") - fixed.NOTE_HALF_WIDTH).alias("nx0"), (F.col("c") + fixed.NOTE_HALF_WIDTH).alias("nx1"))


def overlap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(a1, b1) - F.greatest(a0, b0))


def interval_assign(words: DataFrame, cols: DataFrame, keys: list[str], word_key: list[str]) -> DataFrame:
    """Each word with the column that it overlaps most (``best``, ``best_overlap``; ties: the first) and the one with the nearest right edge (``nearest``)."""
    c = cols.select(*keys, F.col("col_idx"), F.col("x0").alias("c0"), F.col("x1").alias("c1"))
    paired = words.join(c, keys).withColumn("ov", overlap(F.col("c0"), F.col("c1"), F.col("x0"), F.col("x1")))
    return paired.groupBy(*keys, *word_key).agg(
        F.max_by("col_idx", F.struct("ov", (-F.col("col_idx")).alias("i"))).alias("best"), F.max("ov").alias("best_overlap"),
        F.min_by("col_idx", F.struct(F.abs(F.col("c1") - F.col("x1")).alias("d"), F.col("col_idx"))).alias("nearest"),
    )


def indent_levels(rows: DataFrame, gap: float = fixed.INDENT_GAP, keys: list[str] | None = None) -> DataFrame:
    """``rows`` with ``indent``: the gap rank of the rounded label position among the page's distinct ones, -1 without a label."""
    keys = keys or PAGE
    x = F.bround("x0")
    levels = gap_clusters(rows.where("x0 is not null").select(*keys, x.alias("rx")).distinct(), "rx", gap, keys, "indent").withColumnRenamed("rx", "__rx")
    return rows.withColumn("__rx", x).join(levels, [*keys, "__rx"], "left").withColumn("indent", F.coalesce("indent", F.lit(-1)).cast("int")).drop("__rx")


def merge_wrapped(rows: DataFrame, gap: float = fixed.INDENT_GAP, keys: list[str] | None = None) -> DataFrame:
    """Joins a label line without amounts to the indented line below it.

    ``rows`` has line_no, label_raw, label_conf, x0, y0, note_raw, n_words, all_caps and flags. A run may chain, so it's a fold over the page's lines.
    """
    keys = keys or PAGE

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        kept: list[dict] = []
        for row in pdf.sort_values("line_no").to_dict("records"):
            above = kept[-1] if kept else None
            if above and pd.notna(above["x0"]) and pd.notna(row["x0"]) and not above["n_words"] and not above["note_raw"] and not above["all_caps"] and row["x0"] - above["x0"] >= gap:
                row |= {"label_raw": f"{above['label_raw']} {row['label_raw']}", "label_conf": (above["label_conf"] + row["label_conf"]) / 2, "x0": above["x0"], "y0": above["y0"], "flags": [*row["flags"], "wrapped_label_merged"]}
                letters = [c for c in row["label_raw"] if c.isalpha()]
                row["all_caps"] = len(letters) >= 3 and sum(c.isupper() for c in letters) > 0.8 * len(letters)
                kept[-1] = row
            else:
                kept.append(row)
        return pd.DataFrame(kept, columns=list(pdf.columns))

    return rows.groupBy(*keys).applyInPandas(run, rows.schema)
