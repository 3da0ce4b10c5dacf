"""Words of statement pages to verified tables: pages, columns, rows, cells and checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions import fixed, scoring, text
from tallyforge.operators import hierarchy, layout
from tallyforge.operators.layout import PAGE
from tallyforge.sources.staging import staged


@dataclass
class Statements:
    pages: DataFrame
    columns: DataFrame
    rows: DataFrame
    cells: DataFrame
    checks: DataFrame


def _page_heads(lines: DataFrame) -> DataFrame:
    """Company, title, unit text, currency and statement type from the lines up to the unit line."""
    unit = lines.groupBy(*PAGE).agg(F.coalesce(F.min(F.when(F.col("text").rlike(fixed.UNIT_LINE), F.col("line_no"))), F.lit(0)).alias("unit_line"))
    l = lines.join(unit, PAGE)
    title = F.array_join(F.transform(F.array_sort(F.collect_list(F.when((F.col("line_no") > 0) & (F.col("line_no") < F.col("unit_line")), F.struct("line_no", "text")))), lambda x: x["text"]), " ")
    heads = l.groupBy(*PAGE, "unit_line").agg(
        F.coalesce(F.max(F.when((F.col("line_no") == 0) & (F.col("unit_line") > 0), F.col("text"))), F.lit("")).alias("company"),
        title.alias("title"), F.max(F.when(F.col("line_no") == F.col("unit_line"), F.col("text"))).alias("unit_text"),
    )
    return heads.withColumn("c", text.currency("unit_text")).select("*", F.col("c.currency").alias("currency"), F.col("c.scale").alias("unit_scale"), text.statement_type("title").alias("statement_type")).drop("c")


def build(words: DataFrame, cell_evidence: DataFrame | None = None, rereads: DataFrame | None = None) -> Statements:
    """All statement pages in ``words``.

    ``cell_evidence(doc, page, row_idx, col_idx, state, conf)`` says what stands in a cell without words (empty, dash or unreadable; default empty, 0.95).
    ``rereads(doc, page, row_idx, col_idx, text, conf)`` are second readings of cells that didn't parse cleanly.
    """
    spark = words.sparkSession
    s = F.col("dpi") / 300
    lined = staged(layout.group_lines(words.withColumns({c: F.col(c) / s for c in ("x0", "y0", "x1", "y1")})), "lines")
    lines = layout.line_texts(lined)
    heads = staged(_page_heads(lines), "heads")
    below = lined.join(heads.select(*PAGE, "unit_line"), PAGE).where("line_no > unit_line")
    cols = staged(layout.value_columns(below), "columns")
    notes = layout.note_column(below, cols)
    limits = cols.where("col_idx = 0").join(notes, PAGE, "left").select(*PAGE, "nx0", "nx1", (F.coalesce("nx0", "x0") - fixed.LABEL_MARGIN).alias("label_limit"))
    w = below.join(limits, PAGE)
    body = w.groupBy(*PAGE).agg(F.min(F.when(F.col("x1") <= F.col("label_limit"), F.col("line_no"))).alias("body_start"))
    footer = lines.groupBy(*PAGE).agg(F.min(F.when(F.col("text").rlike(fixed.FOOTER_LINE), F.col("line_no"))).alias("footer"))

    # periods of columns, from the header words above the body
    head_words = w.join(body, PAGE).where(F.col("body_start").isNull() | (F.col("line_no") < F.col("body_start")))
    over = layout.overlap(F.col("c0"), F.col("c1"), F.col("x0"), F.col("x1")) > 0
    headed = head_words.join(cols.select(*PAGE, "col_idx", F.col("x0").alias("c0"), F.col("x1").alias("c1")), PAGE).where(over)
    per_col = [*PAGE, "col_idx"]
    relined = layout.group_lines(headed.select(*per_col, "pos", "text", "x0", "y0", "x1", "y1"), keys=per_col)
    header = layout.line_texts(relined, per_col).groupBy(*per_col).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda x: x["text"]), " ").alias("header"))
    columns = cols.join(header, per_col, "left").withColumn("period", text.parse_period(F.coalesce("header", F.lit(""))))
    newest = F.max("period.year").over(Window.partitionBy(*PAGE))
    columns = staged(columns.withColumn("role", F.when(F.col("period.year") == newest, "current").otherwise("prior")), "column-periods")

    # words to notes, cells and labels
    body_words = w.join(body, PAGE).join(footer, PAGE).where((F.col("line_no") >= F.col("body_start")) & (F.col("footer").isNull() | (F.col("line_no") < F.col("footer"))))
    placed = body_words.join(layout.interval_assign(body_words, cols, PAGE, ["pos"]), [*PAGE, "pos"])
    width, amount = F.col("x1") - F.col("x0"), text.is_amount("text")
    in_notes = F.coalesce(layout.overlap(F.col("nx0"), F.col("nx1"), F.col("x0"), F.col("x1")) > 0.5 * width, F.lit(False)) & F.col("nx0").isNotNull() & ~amount
    part = F.when(in_notes, "note").when(F.col("best_overlap") > 0.3 * width, "cell").when((F.col("x0") < F.col("label_limit")) | ~amount, "label").otherwise("stray")
    placed = placed.withColumn("part", part).withColumn("col_idx", F.when(F.col("part") == "cell", F.col("best")).when(F.col("part") == "stray", F.col("nearest")))
    placed = staged(placed, "placed")
    joined = lambda kind: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("part") == kind, F.struct("x0", "pos", "text")))), lambda x: x["text"]), " ")
    rows = placed.groupBy(*PAGE, "line_no").agg(
        joined("label").alias("label_raw"), F.coalesce(F.avg(F.when(F.col("part") == "label", F.col("conf"))), F.lit(0.0)).alias("label_conf"), F.min(F.when(F.col("part") == "label", F.col("x0"))).alias("x0"),
        F.min("y0").alias("y0"), F.max("y1").alias("y1"), joined("note").alias("note_raw"), F.count_if(F.col("col_idx").isNotNull()).cast("int").alias("n_words"),
    )
    rows = rows.withColumn("all_caps", F.coalesce(text.is_all_caps("label_raw"), F.lit(False))).withColumn("flags", F.array().cast("array<string>"))
    merged = layout.merge_wrapped(rows)
    refs = text.note_refs("note_raw")
    rows = merged.select(
        *PAGE, "line_no", (F.row_number().over(Window.partitionBy(*PAGE).orderBy("line_no")) - 1).alias("row_idx"), "label_raw", F.when(F.col("label_raw") == "", "").otherwise(text.clean_label("label_raw")).alias("label"),
        "label_conf", "x0", "y0", "y1", "note_raw", refs["refs"].alias("note_refs"), refs["repaired"].alias("note_repaired"), "flags",
    )
    rows = staged(layout.indent_levels(staged(rows, "rows")), "indented")

    # every row has a cell in every column
    texts = placed.where("col_idx is not null").groupBy(*PAGE, "line_no", "col_idx").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "pos", "text"))), lambda x: F.replace(x["text"], F.lit(" "), F.lit(""))), "").alias("cell_text"),
        F.avg("conf").alias("word_conf"), F.bool_or(F.col("text").rlike(fixed.DECIMAL_AMOUNT)).alias("fraction"),
    )
    key = [*PAGE, "row_idx", "col_idx"]
    grid = rows.select(*PAGE, "line_no", "row_idx").join(columns.select(*PAGE, "col_idx", "col_id", "period", "role"), PAGE).join(texts, [*PAGE, "line_no", "col_idx"], "left")
    grid = grid.withColumn("decimal_row", F.coalesce(F.bool_or("fraction").over(Window.partitionBy(*PAGE, "row_idx")), F.lit(False)))
    kinds = dict(words.dtypes)
    schema = f"doc {kinds['doc']}, page int, row_idx int, col_idx int"
    seen = cell_evidence if cell_evidence is not None else spark.createDataFrame([], f"{schema}, state string, conf double")
    again = rereads if rereads is not None else spark.createDataFrame([], f"{schema}, text string, conf double")
    grid = grid.join(seen.select(*key, "state", F.col("conf").alias("state_conf")), key, "left").join(again.select(*key, F.col("text").alias("again"), F.col("conf").alias("again_conf")), key, "left")
    blank, state = F.col("cell_text").isNull(), F.coalesce("state", F.lit("empty"))
    first = text.parse_amount(F.when(blank, F.when(state == "dash", "-").otherwise("")).otherwise(F.col("cell_text")), F.col("decimal_row"))
    second = text.parse_amount("again", F.col("decimal_row"))
    grid = grid.withColumns({"a1": first, "a2": second})
    bad = ~blank & text.severe(F.col("a1.kind"), F.col("a1.repairs"))
    use = bad & F.col("again").isNotNull() & F.col("a2.kind").isin("number", "zero") & ~text.severe(F.col("a2.kind"), F.col("a2.repairs"))
    ink = blank & (state == "unreadable")
    pick = lambda f: F.when(use, F.col(f"a2.{f}")).otherwise(F.col(f"a1.{f}"))
    cells = grid.select(
        *key, "col_id", "period", "role", "decimal_row", pick("raw").alias("raw"), F.when(ink, "unparseable").otherwise(pick("kind")).alias("kind"), F.when(ink, None).otherwise(pick("value")).alias("value"),
        F.when(ink, F.array(F.lit("unreadable_ink"))).when(use, F.concat(F.col("a2.repairs"), F.array(F.concat(F.lit("reread_replaced:"), F.col("cell_text"))))).otherwise(F.col("a1.repairs")).alias("repairs"),
        F.when(use, "reread").when(blank, "pixels").otherwise("page").alias("source"), F.when(use, F.col("again_conf")).when(blank, F.coalesce("state_conf", F.lit(0.95))).otherwise(F.col("word_conf")).alias("ocr_conf"),
    ).withColumn("num", text.numeric(F.col("kind"), F.col("value")))
    cells = staged(cells, "cells")

    by_col = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("col_idx", c))), lambda x: x[c])
    packed = cells.groupBy(*PAGE, "row_idx").agg(by_col("num").alias("nums"), by_col("kind").alias("kinds"), F.bool_or("decimal_row").alias("decimal"))
    solved = staged(hierarchy.solve_tables(rows.join(packed, [*PAGE, "row_idx"]).select(*PAGE, "row_idx", "label", "nums", "kinds", "indent", "decimal"), PAGE), "solved")
    checks = hierarchy.checks_of(solved, PAGE)
    proof = hierarchy.arithmetic_ok(checks, PAGE).withColumnRenamed("column", "col_idx")
    cells = cells.join(proof, key, "left").withColumn("confidence", scoring.value_confidence(F.col("ocr_conf"), F.col("repairs"), F.col("arithmetic_ok")))
    cells = cells.withColumn("low_confidence", (F.col("confidence") < fixed.LOW_CONFIDENCE) & (F.col("kind") != "empty"))
    means = cells.groupBy(*PAGE, "row_idx").agg(F.avg("confidence").alias("values_conf"))
    member = F.explode(F.concat(F.array("parent_row"), "component_rows"))
    sound = checks.select(*PAGE, "passed", member.alias("row_idx")).groupBy(*PAGE, "row_idx").agg(F.bool_and("passed").alias("sound"))
    rows = rows.join(solved.drop("checks"), [*PAGE, "row_idx"]).join(means, [*PAGE, "row_idx"], "left").join(sound, [*PAGE, "row_idx"], "left")
    label = F.when(F.col("label") == "", 0.6).otherwise(F.col("label_conf")) * F.when(F.col("note_repaired"), 0.9).otherwise(1.0)
    structure = F.when(F.col("sound").isNull(), 0.6).when(F.col("sound"), 1.0).otherwise(0.0)
    rows = rows.withColumn("confidence", scoring.row_confidence(label, F.col("values_conf"), structure)).withColumn("low_confidence", F.col("confidence") < fixed.LOW_CONFIDENCE)
    rows = rows.withColumn("row_id", F.format_string("p%d_r%02d", "page", "row_idx")).withColumn("flags", F.when(F.col("note_repaired"), F.array_append("flags", F.lit("note_ref_repaired"))).otherwise(F.col("flags")))
    tables = rows.groupBy(*PAGE).agg(F.avg("confidence").alias("rows_conf")).join(checks.groupBy(*PAGE).agg(F.avg(F.col("passed").cast("int")).alias("passed")), PAGE, "left")
    pages = heads.join(tables, PAGE).withColumn("confidence", F.round(0.6 * F.col("rows_conf") + 0.4 * F.coalesce("passed", F.lit(0.5)), 4)).withColumn("low_confidence", F.col("confidence") < fixed.LOW_CONFIDENCE)
    pages = pages.withColumn("table_id", F.concat_ws("_", F.concat(F.lit("p"), "page"), F.coalesce("statement_type", F.lit("None")))).drop("rows_conf", "passed")
    return Statements(staged(pages, "pages"), columns, staged(rows, "proven-rows"), staged(cells, "proven-cells"), checks)


def summary(st: Statements) -> DataFrame:
    """One row a document: counts, the newest period's end and what has low confidence."""
    doc = ["doc"]
    end = st.columns.where("role = 'current'").groupBy(*doc).agg(F.max("period.end").alias("period_end"))
    first = st.pages.groupBy(*doc).agg(F.min_by("company", "page").alias("company"), F.min_by("currency", "page").alias("currency"), F.count("*").alias("tables"))
    rows = st.rows.groupBy(*doc).agg(F.count("*").alias("rows"), F.array_sort(F.collect_list(F.when(F.col("low_confidence"), F.col("row_id")))).alias("low_confidence_rows"))
    values = st.cells.groupBy(*doc).agg(F.count("*").alias("values"), F.array_sort(F.collect_list(F.when(F.col("low_confidence"), F.concat_ws(":", F.format_string("p%d_r%02d", "page", "row_idx"), "col_id")))).alias("low_confidence_values"))
    checks = st.checks.groupBy(*doc).agg(F.count_if("passed").alias("checks_passed"), F.count("*").alias("checks_total"))
    out = first.join(end, doc, "left").join(rows, doc).join(values, doc).join(checks, doc, "left")
    return out.na.fill(0, ["checks_passed", "checks_total"])
