"""Audit: checks of every stage, the balance identity, note sums, and final links with confidence and status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions import fixed, scoring, text
from tallyforge.operators import hierarchy, matching
from tallyforge.plans.statements import Statements
from tallyforge.sources.staging import staged

#: Levels of a forest beyond which it's taken to have a cycle.
MAX_DEPTH = 500
CHECK = "doc string, group string, check string, passed boolean, detail string, items array<string>"


def note_sums(rows: DataFrame, values: DataFrame) -> DataFrame:
    """Sum checks within the note's blocks, by the solver of the statements: (doc, block_id, parent_row, component_rows, relation, column, difference, passed)."""
    num = text.numeric(F.col("kind"), F.col("value"))
    listed = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("col", c))), lambda x: x[c])
    packed = values.withColumn("num", num).groupBy("doc", "block_id", "row_id").agg(listed("num").alias("nums"), listed("kind").alias("kinds"))
    table = rows.join(packed, ["doc", "block_id", "row_id"]).select("doc", "block_id", F.col("row_no").alias("row_idx"), "label", "nums", "kinds", F.lit(0).alias("indent"), F.lit(False).alias("decimal"))
    checks = hierarchy.checks_of(hierarchy.solve_tables(table, ["doc", "block_id"]), ["doc", "block_id"])
    names = rows.select("doc", F.col("row_no"), "row_id")
    numbered = staged(checks.withColumn("id", F.monotonically_increasing_id()), "numbered-checks")
    parts = numbered.select("doc", "id", F.posexplode("component_rows").alias("p", "row_no")).join(names, ["doc", "row_no"]).groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "row_id"))), lambda x: x["row_id"]).alias("parts"))
    out = numbered.join(parts, "id").join(names.withColumnsRenamed({"row_no": "parent_row", "row_id": "parent_id"}), ["doc", "parent_row"])
    return out.select("doc", "block_id", F.col("parent_id").alias("parent_row"), F.col("parts").alias("component_rows"), "relation", "column", "difference", "passed")


def subtree_sizes(edges: DataFrame) -> DataFrame:
    """``edges(doc, parent, child)`` of a forest to (doc, node, size): the node and all below it.

    Each round counts, for every node, the nodes one level further down, as a sum over its children; there are as many rounds as the forest is deep, and no tree is brought together.
    """
    edges = staged(edges.select("doc", "parent", "child"), "edges")
    down = edges.select("doc", F.col("parent").alias("node")).unionByName(edges.select("doc", F.col("child").alias("node"))).distinct().withColumn("n", F.lit(1).cast("long"))
    levels = [staged(down, "level")]
    while not levels[-1].isEmpty():
        if len(levels) > MAX_DEPTH:
            raise ValueError(f"the forest is deeper than {MAX_DEPTH}, or has a cycle")
        below = levels[-1].withColumnRenamed("node", "child").join(edges, ["doc", "child"]).groupBy("doc", F.col("parent").alias("node")).agg(F.sum("n").alias("n"))
        levels.append(staged(below, "level"))
    every = levels[0]
    for level in levels[1:]:
        every = every.unionByName(level)
    return every.groupBy("doc", "node").agg(F.sum("n").alias("size"))


def balance_identity(st: Statements) -> DataFrame:
    """Assets = liabilities + equity: the biggest totals of a document's two balance sheet tables agree in every column; null unless there are two."""
    sheets = st.pages.where("statement_type = 'balance_sheet'").select("doc", "page")
    edges = st.rows.join(sheets, ["doc", "page"]).where("parent is not null").select(F.concat_ws("#", "doc", "page").alias("doc"), F.col("parent").alias("parent"), F.col("row_idx").alias("child"))
    sizes = subtree_sizes(edges)
    tops = st.rows.join(sheets, ["doc", "page"]).where(F.col("row_type").isin("total", "parent")).withColumn("d", F.concat_ws("#", "doc", "page"))
    best = tops.join(sizes.select(F.col("doc").alias("d"), F.col("node").alias("row_idx"), "size"), ["d", "row_idx"]).groupBy("doc", "page").agg(F.max_by(F.struct("row_idx", "label"), F.struct("size", (-F.col("row_idx")).alias("o"))).alias("t"))
    vals = best.select("doc", "page", "t.row_idx", "t.label").join(st.cells, ["doc", "page", "row_idx"])
    a = vals.groupBy("doc", "col_idx").agg(F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"), F.count("value").alias("have"), F.count_distinct("period.end").alias("ends"))
    same = (F.col("n") == 2) & (F.col("have") == 2) & (F.col("hi") - F.col("lo") <= fixed.SUM_TOLERANCE) & (F.col("ends") == 1)
    found = a.where("n = 2").groupBy("doc").agg(F.bool_and(same).alias("ok"), F.array_join(F.array_sort(F.collect_list(F.format_string("%s vs %s", F.col("lo").cast("string"), F.col("hi").cast("string")))), "; ").alias("said"))
    two = sheets.groupBy("doc").agg(F.count("*").alias("tables"))
    docs = st.pages.select("doc").distinct().join(two, "doc", "left").join(found, "doc", "left")
    both = F.coalesce(F.col("tables") == 2, F.lit(False))
    return docs.select("doc", F.lit("financial").alias("group"), F.lit("assets_equal_liabilities_plus_equity").alias("check"), F.when(both, F.coalesce("ok", F.lit(True))).alias("passed"), F.when(both, F.col("said")).otherwise("no two-part balance sheet found").alias("detail"), F.array().cast("array<string>").alias("items"))


def final_links(items: DataFrame, a: DataFrame, b: DataFrame, values: DataFrame, sums: DataFrame, threshold: float = fixed.LOW_CONFIDENCE) -> DataFrame:
    """A and B merged (B first), with the total column reported, the amount proven, confidence and status."""
    key = matching.KEY
    la = matching.last_of(a).select(*key, F.struct("col", "relation", "score").alias("a"))
    lb = matching.last_of(b).select(*key, F.struct("col", "relation", "score", "reason").alias("b"))
    pick = lambda f: F.coalesce(f"b.{f}", f"a.{f}")
    merged = la.join(lb, key, "full").withColumns({"said_col": pick("col"), "relation": pick("relation"), "model": pick("score")})
    cell = values.select("doc", F.col("row_id").alias("note_row"), "col", "value", "header", F.col("label").alias("note_label"), "period", F.col("confidence").alias("cell_conf"))
    said = cell.select("doc", "note_row", F.col("col").alias("said_col"), F.col("value").alias("said_value"))
    m = merged.join(said, ["doc", "note_row", "said_col"], "left")
    moved = m.select(*key, "said_value").join(cell.where(F.lower("header").contains("toplam")), ["doc", "note_row"]).where(F.col("value").eqNullSafe(F.col("said_value"))).groupBy(*key).agg(F.max("col").alias("total_col"))
    m = m.join(moved, key, "left").withColumn("col", F.coalesce("total_col", "said_col")).join(cell, ["doc", "note_row", "col"], "left")
    i = items.select("doc", "item_id", "summary_row", F.col("label").alias("summary_label"), F.col("period").alias("item_period"), F.col("value").alias("item_value"), F.col("confidence").alias("item_conf"))
    m = m.join(i, ["doc", "item_id"])
    same = lambda x: F.coalesce(F.abs(F.abs(x) - F.abs("item_value")) <= fixed.SUM_TOLERANCE, F.lit(False))
    part = F.col("relation") == "breakdown_component"
    totals = m.where(~part & same(F.col("said_value"))).select("doc", "item_id", F.col("note_row").alias("parent_row"), F.col("said_col").alias("column"))
    proven = sums.where("passed").select("doc", "parent_row", "column", F.explode("component_rows").alias("note_row"))
    backed = totals.join(proven, ["doc", "parent_row", "column"]).select(*key).distinct().withColumn("backed", F.lit(True))
    m = m.join(backed, key, "left")
    end = F.col("item_period.end")
    dated = (F.col("item_period.type") != "instant") | F.coalesce(F.col("period.date") == end, F.lit(False))
    amount_ok = F.when(part, dated & F.coalesce("backed", F.lit(False))).otherwise(same(F.col("value")))
    m = m.withColumns({"amount_ok": amount_ok, "period_match": scoring.period_match(F.col("item_period.type"), end, F.col("period.date"), F.col("period.year"))})
    agreed = scoring.agreement(F.col("a.relation"), F.col("b.relation"))
    extraction = (F.coalesce("item_conf", F.lit(0.5)) + F.coalesce("cell_conf", F.lit(0.5))) / 2
    m = m.withColumn("c", scoring.link_confidence(F.col("model"), F.col("amount_ok"), F.col("period_match"), agreed, extraction))
    by = F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), "A+B").when(F.col("b").isNotNull(), "B").otherwise("A")
    return m.select(
        "doc", "item_id", "summary_row", "summary_label", end.alias("period_end"), "item_value", "note_row", "note_label", F.col("header").alias("note_column"), "col", "value", "relation", by.alias("found_by"),
        F.col("a.relation").alias("relation_a"), F.col("b.relation").alias("relation_b"), F.col("b.reason").alias("reason"), "amount_ok", "period_match", F.round("c", 4).alias("confidence"), scoring.status(F.col("amount_ok"), F.col("period_match"), F.col("c"), threshold).alias("status"),
    )


def _check(df: DataFrame, group: str, name: str, bad: Column, detail: Column, applies: Column | None = None, docs: DataFrame | None = None) -> DataFrame:
    """One row a document: passed if no row is ``bad`` (an item's name, or null); null where nothing applies."""
    agg = df.groupBy("doc").agg(F.array_sort(F.collect_list(bad)).alias("items"), F.count("*").alias("n"), detail.alias("detail"))
    if docs is not None:
        agg = docs.select("doc").distinct().join(agg, "doc", "left").withColumns({"items": F.coalesce("items", F.array().cast("array<string>")), "n": F.coalesce("n", F.lit(0)), "detail": F.coalesce("detail", F.lit("none"))})
    ok = F.size("items") == 0
    passed = ok if applies is None else F.when(applies, ok)
    return agg.select("doc", F.lit(group).alias("group"), F.lit(name).alias("check"), passed.alias("passed"), "detail", "items")


def validate(st: Statements, note: DataFrame, values: DataFrame, sums: DataFrame, links: DataFrame, summary_pages: list[int]) -> DataFrame:
    """The twelve checks, one row each and document; passed is null where a check doesn't apply."""
    docs, n = st.pages, F.col("n") > 0
    pages = st.pages.groupBy("doc").agg(F.array_sort(F.collect_list("page")).alias("p"), F.count_if(F.col("statement_type").isNull()).alias("unknown"))
    text_list = F.concat_ws(", ", F.transform("p", lambda x: x.cast("string")))
    c1 = pages.select("doc", F.lit("structural").alias("group"), F.lit("tables_on_configured_pages").alias("check"), ((F.col("p") == F.array(*map(F.lit, summary_pages)).cast("array<int>")) & (F.col("unknown") == 0)).alias("passed"), F.concat(F.lit("pages "), text_list).alias("detail"), F.array().cast("array<string>").alias("items"))
    cols = st.columns.groupBy("doc", "page").agg(F.count_if(F.col("period.end").isNull()).alias("none"), F.count_distinct("period.end").alias("ends"), F.count("*").alias("cols"), F.count_if(F.col("role") == "current").alias("now")).join(st.pages.select("doc", "page", "table_id"), ["doc", "page"])
    c2 = _check(cols, "structural", "period_columns_distinct", F.when((F.col("none") > 0) | (F.col("ends") != F.col("cols")) | (F.col("now") != 1), F.col("table_id")), F.lit("one current and distinct period ends a table"), docs=docs)
    hollow = st.cells.groupBy("doc", "page", "row_idx").agg(F.bool_and(F.col("kind") == "empty").alias("hollow"))
    c3 = _check(st.rows.join(hollow, ["doc", "page", "row_idx"]), "structural", "note_refs_on_value_rows", F.when((F.size("note_refs") > 0) & F.col("hollow"), F.col("row_id")), F.concat(F.count_if("note_repaired").cast("string"), F.lit(" repaired references")), docs=docs)
    c4 = _check(note, "structural", "note_pages_found", F.when(F.size("pages") == 0, F.lit("note")), F.concat(F.lit("pages "), F.max(F.concat_ws(", ", F.transform("pages", lambda x: x.cast("string"))))), docs=docs)
    name = F.concat_ws(" -> ", "item_id", "note_row")
    c5 = _check(links, "structural", "links_between_compatible_periods", F.when(F.col("period_match") == 0, name), F.lit("every link joins compatible periods"), n, docs)
    all_values = st.cells.select("doc", F.format_string("p%d_r%02d:%s", "page", "row_idx", "col_id").alias("at"), "kind", "repairs", (F.col("period.end").isNotNull()).alias("dated")).unionByName(values.select("doc", F.concat_ws(":", "row_id", "col").alias("at"), "kind", "repairs", F.col("period.year").isNotNull().alias("dated")))
    c6 = _check(all_values, "format", "numbers_parsed", F.when(text.severe(F.col("kind"), F.col("repairs")), F.col("at")), F.concat(F.count("*").cast("string"), F.lit(" values")), docs=docs)
    money = st.pages.groupBy("doc").agg(F.count_distinct("currency").alias("k"), F.count_if(F.col("currency").isNull()).alias("none"), F.array_join(F.array_sort(F.collect_set(F.coalesce("currency", F.lit("missing")))), ", ").alias("said"))
    c7 = money.select("doc", F.lit("format").alias("group"), F.lit("currency_present_and_consistent").alias("check"), ((F.col("k") == 1) & (F.col("none") == 0)).alias("passed"), F.col("said").alias("detail"), F.array().cast("array<string>").alias("items"))
    c8 = _check(all_values, "format", "periods_present", F.when(~F.col("dated"), F.col("at")), F.lit("every value has a period"), docs=docs)
    c9 = _check(st.checks, "financial", "summary_table_sums", F.when(~F.col("passed"), F.format_string("p%d_r%02d:%d", "page", "parent_row", "column")), F.format_string("%d/%d sum checks pass", F.count_if("passed"), F.count("*")), n, docs)
    c11 = _check(sums, "financial", "note_table_sums", F.when(~F.col("passed"), F.concat_ws(":", "parent_row", "column")), F.format_string("%d/%d sum checks pass", F.count_if("passed"), F.count("*")), n, docs)
    c12 = _check(links, "financial", "linked_amounts_agree", F.when(~F.col("amount_ok"), name), F.lit("linked amounts are equal or proven parts"), n, docs)
    out = c1
    for c in (c2, c3, c4, c5, c6, c7, c8, c9, balance_identity(st), c11, c12):
        out = out.unionByName(c)
    return out
