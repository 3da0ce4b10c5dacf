"""The five documents of a report, a nested struct each, one row a document: tables, note pages, note rows, links and the final output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.operators import matching
from tallyforge.operators.layout import PAGE
from tallyforge.plans import statements
from tallyforge.plans.pipeline import Config, Result

NAMES = ("summary_tables", "note_pages", "note_rows", "links", "final_output")


def _day(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def _listed(order: str | Column, *fields: str | Column) -> Column:
    """Structs of the fields, in order."""
    return F.transform(F.array_sort(F.collect_list(F.struct(order if isinstance(order, str) else order.alias("o"), F.struct(*fields).alias("s")))), lambda x: x["s"])


def _empty(c: str, like: Column | None = None) -> Column:
    return F.coalesce(c, F.array() if like is None else like)


def summary_tables(r: Result) -> DataFrame:
    """(doc, document, tables, summary)."""
    st = r.statements
    row_id = lambda i: F.format_string("p%d_r%02d", "page", i)
    value = ("col_id", _day("period.end").alias("period_end"), "raw", "kind", "value", "repairs", "source", "ocr_conf", "arithmetic_ok", "confidence", "low_confidence")
    values = st.cells.groupBy(*PAGE, "row_idx").agg(_listed("col_idx", *value).alias("values"))
    ids = F.transform("children", lambda k: F.format_string("p%d_r%02d", F.col("page"), k)).alias("children")
    row = ("row_id", "label", "label_raw", "row_type", "indent", F.when(F.col("parent").isNotNull(), row_id("parent")).alias("parent_id"), ids, "note_refs", "note_raw", "values", "confidence", "low_confidence", "flags")
    rows = st.rows.join(values, [*PAGE, "row_idx"], "left").groupBy(*PAGE).agg(_listed("row_idx", *row).alias("rows"))
    parts = F.transform("component_rows", lambda k: F.format_string("p%d_r%02d", F.col("page"), k)).alias("component_rows")
    check = ("relation", F.concat(F.lit("v"), "column").alias("column"), row_id("parent_row").alias("parent_row"), parts, "expected", "computed", "difference", "passed")
    checks = st.checks.groupBy(*PAGE).agg(_listed(F.struct("parent_row", "column", "relation", "component_rows"), *check).alias("checks"))
    period = F.struct("period.type", _day("period.start").alias("start"), _day("period.end").alias("end"), "period.year", "period.audited", "period.header", "role").alias("period")
    columns = st.columns.groupBy(*PAGE).agg(_listed("col_idx", "col_id", "x0", "x1", period).alias("columns"))
    table = ("table_id", "page", "statement_type", "company", "title", "currency", "unit_scale", "unit_text", "columns", "rows", "checks", "confidence", "low_confidence")
    pages = st.pages.join(columns, PAGE, "left").join(rows, PAGE, "left").join(checks, PAGE, "left")
    tables = pages.groupBy("doc").agg(_listed("page", *table).alias("tables"))
    s = statements.summary(st).withColumnRenamed("tables", "n_tables")
    out = tables.join(s, "doc")
    head = F.struct(F.col("doc").alias("file"), "company", _day("period_end").alias("period_end"), "currency")
    counts = F.struct(F.col("n_tables").alias("tables"), F.col("n_rows").alias("rows"), "values", "checks_total", "checks_passed", "low_confidence_rows", "low_confidence_values")
    return out.withColumnRenamed("rows", "n_rows").select("doc", head.alias("document"), "tables", counts.alias("summary"))


def note_rows(r: Result) -> DataFrame:
    """(doc, note_number, title, pages, blocks, rows)."""
    period = F.struct(_day("period.date").alias("date"), "period.year", "period.source").alias("period")
    values = r.note_values.groupBy("doc", "row_id").agg(_listed("col", "raw", "kind", "value", "range", "decimal", "repairs", "ocr_conf", "col", "header", period, "confidence").alias("values"))
    rows = r.note_rows.join(values, ["doc", "row_id"], "left").groupBy("doc").agg(_listed("row_no", "row_id", "block_id", "page", "label", "values", "confidence").alias("rows"))
    blocks = r.blocks.groupBy("doc").agg(_listed(F.struct("page", "block"), "block_id", "page", "year", "columns", "row_ids").alias("blocks"))
    return r.note.select("doc", "note_number", "title", "pages").join(blocks, "doc", "left").join(rows, "doc", "left")


def _period(c: str) -> Column:
    return F.struct(f"{c}.type", _day(f"{c}.start").alias("start"), _day(f"{c}.end").alias("end"), f"{c}.year").alias("period")


def links(r: Result) -> DataFrame:
    """(doc, note_number, items, candidates, method_a, method_b, comparison, evaluation)."""
    key = F.struct("item_id", "note_row")
    by = lambda df, order, name, *fields: df.groupBy("doc").agg(_listed(order, *fields).alias(name))
    items = by(r.items, "item_id", "items", "item_id", "summary_row", F.col("col_id").alias("col"), "label", "statement", _period("period"), "value")
    cands = by(r.candidates, key, "candidates", "item_id", "note_row", "col", "value_match", "period_match", "semantic", "score_a")
    link = ("item_id", "note_row", "col", "value", "relation", "score", "method")
    a = by(r.links_a, F.struct("seq", "item_id", "note_row"), "links_a", *link)
    b = by(r.links_b, F.struct("item_id", "seq", "note_row"), "links_b", *link, "reason")
    silent = r.unanswered.groupBy("doc").agg(F.array_sort(F.collect_list("item_id")).alias("silent"))
    name = F.concat_ws(" -> ", "item_id", "note_row")
    sides = ("both_same_relation", "both_different_relation", "only_a", "only_b")
    compared = r.comparison.groupBy("doc").agg(*(F.array_sort(F.collect_list(F.when(F.col("verdict") == v, name))).alias(v) for v in sides))
    out = r.note.select("doc", "note_number")
    for part in (items, cands, a, r.threshold, b, silent, compared):
        out = out.join(part, "doc", "left")
    for method, found in (("method_a", r.links_a), ("method_b", r.links_b)):
        wrong = matching.errors(found.join(r.gold.select("doc").distinct(), "doc", "left_semi"), r.gold).groupBy("doc").agg(*(F.array_sort(F.collect_list(F.when(F.col("error") == e, name))).alias(e) for e in ("false_positive", "missed")))
        score = matching.evaluate(found, r.gold, by=["doc"]).join(r.gold.select("doc").distinct(), "doc", "left_semi").join(wrong, "doc", "left")
        none = F.array().cast("array<string>")
        out = out.join(score.select("doc", F.struct("precision", "recall", "f1", "relation_accuracy", _empty("false_positive", none).alias("false_positives"), _empty("missed", none).alias("missed")).alias(method)), "doc", "left")
    evaluation = F.when(F.col("method_a").isNotNull() | F.col("method_b").isNotNull(), F.struct("method_a", "method_b"))
    method_a = F.struct("threshold", F.col("source").alias("threshold_source"), F.col("links_a").alias("links"))
    method_b = F.struct(F.col("links_b").alias("links"), F.col("silent").alias("unanswered"))
    return out.select("doc", "note_number", "items", "candidates", method_a.alias("a"), method_b.alias("b"), F.struct(*sides).alias("comparison"), evaluation.alias("evaluation")).withColumnsRenamed({"a": "method_a", "b": "method_b"})


def final_output(r: Result, tables: DataFrame, rows: DataFrame, linked: DataFrame) -> DataFrame:
    """(doc, document, summary_tables, note, links, rejected_links, method_comparison, validation, low_confidence)."""
    link = ("item_id", "summary_row", "summary_label", _day("period_end").alias("period_end"), "item_value", "note_row", "note_label", "note_column", "col", "value", "relation", "found_by", "relation_a", "relation_b", F.col("reason").alias("llm_reason"), "amount_ok", "period_match", "confidence", "status")
    at = F.struct("item_id", "note_row")
    kept = r.links.where("status <> 'rejected'").groupBy("doc").agg(_listed(at, *link).alias("links"))
    gone = r.links.where("status = 'rejected'").groupBy("doc").agg(_listed(at, *link).alias("rejected_links"))
    checks = r.checks.groupBy("doc").agg(_listed(F.struct("group", "check"), "group", "check", "passed", "detail", "items").alias("checks"), F.count_if("passed").alias("n_passed"), F.count_if(~F.col("passed")).alias("n_failed"), F.count_if(F.col("passed").isNull()).alias("n_open"))
    sums = r.sums.groupBy("doc").agg(_listed(F.struct("block_id", "parent_row", "column", "relation", "component_rows"), "block_id", "parent_row", "component_rows", "relation", "column", "difference", "passed").alias("sum_checks"))
    low = r.links.where("status = 'low_confidence'").groupBy("doc").agg(F.array_sort(F.collect_list(F.concat_ws(" -> ", "item_id", "note_row"))).alias("low_links"))
    note = r.note.select("doc", F.struct(*[c for c in r.note.columns if c not in ("doc", "title", "pages")]).alias("found")).join(rows.drop("note_number"), "doc", "left")
    compared = linked.select("doc", "comparison", "evaluation")
    out = tables.withColumnRenamed("summary", "counts").withColumnRenamed("tables", "every")
    for part in (note, sums, kept, gone, compared, checks, low):
        out = out.join(part, "doc", "left")
    return out.select(
        "doc", "document", F.struct(F.col("every").alias("tables"), F.col("counts").alias("summary")).alias("summary_tables"), F.struct("found.*", "title", "pages", "blocks", "rows", "sum_checks").alias("note"), "links", "rejected_links",
        F.struct("comparison", "evaluation").alias("method_comparison"), F.struct("checks", F.struct(F.col("n_passed").alias("passed"), F.col("n_failed").alias("failed"), F.col("n_open").alias("not_applicable")).alias("summary")).alias("validation"),
        F.struct(F.col("counts.low_confidence_rows").alias("rows"), F.col("counts.low_confidence_values").alias("values"), F.col("low_links").alias("links")).alias("low_confidence"),
    )


def documents(r: Result, config: Config | None = None) -> dict[str, DataFrame]:
    """All five by name; one row a document each."""
    tables, rows, linked = summary_tables(r), note_rows(r), links(r)
    return {"summary_tables": tables, "note_pages": r.note, "note_rows": rows, "links": linked, "final_output": final_output(r, tables, rows, linked)}
