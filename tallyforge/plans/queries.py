"""Queries on the star-schema tables: each exercises one operator of the library on columns of like shape."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.functions import fixed, scoring, text
from tallyforge.operators import audit, hierarchy, layout, matching, notes
from tallyforge.sources.tokens import table

Query = Callable[[SparkSession, str], DataFrame]
_MONTH_NAMES = ("Ocak", "Şubat", "Mart", "Nisan", "Mayıs", "Haziran", "Temmuz", "Ağustos", "Eylül", "Ekim", "Kasım", "Aralık")
_LINE_ORDER = ["l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_shipdate"]


def _raw_amount() -> Column:
    """An amount as it might be printed or misread, by line number."""
    n = F.floor("l_extendedprice").cast("bigint")
    dotted = F.translate(F.format_number(n, 0), ",", ".")
    line = F.col("l_linenumber")
    return (
        F.when(line == 1, dotted).when(line == 2, F.concat(F.lit("("), dotted, F.lit(")"))).when(line == 3, F.format_number(n, 0)).when(line == 4, F.replace(dotted, F.lit("."), F.lit(",.")))
        .when(line == 5, F.translate(dotted, "01", "Ol")).when(line == 6, F.when(F.col("l_suppkey") % 3 == 0, "%10,5").when(F.col("l_suppkey") % 3 == 1, "-").otherwise("%2-%4")).otherwise(F.when(F.col("l_suppkey") % 2 == 0, "").otherwise(n.cast("string")))
    )


def parse_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", _raw_amount().alias("raw")).withColumn("a", text.parse_amount("raw"))
    return a.select("l_orderkey", "l_linenumber", "raw", F.col("a.kind").alias("kind"), F.col("a.value").alias("value"), F.array_join("a.repairs", "+").alias("repairs"))


def amount_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = F.filter(F.split("text", r"[ \n]+"), lambda t: t != "")
    d = table(spark, sf_dir, "documents").select("doc_id", tokens.alias("t"))
    return d.select("doc_id", F.size("t").cast("long").alias("n_tokens"), F.size(F.filter("t", text.is_amount)).cast("long").alias("n_amounts"))


def label_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.element_at(F.array(*map(F.lit, ("- ", "~", "__ ", ""))), (F.col("p_partkey") % 4 + 1).cast("int")), F.replace("p_name", F.lit(" "), F.lit("_ ")), F.lit(" .:"))
    return table(spark, sf_dir, "part").select("p_partkey", text.clean_label(raw).alias("label"))


def tr_casefold(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.concat_ws(" ", "p_name", "p_type", F.lit("ıİ"))
    return table(spark, sf_dir, "part").select("p_partkey", text.tr_upper(s).alias("up"), text.tr_lower(s).alias("low"))


def all_caps_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.split("text", "\n")
    return table(spark, sf_dir, "documents").select("doc_id", F.size(lines).cast("long").alias("n_lines"), F.size(F.filter(lines, lambda x: F.coalesce(text.is_all_caps(x), F.lit(False)))).cast("long").alias("n_caps"))


def note_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.concat_ws(" ", F.concat("l_linenumber", F.lit("I")), F.concat(F.col("l_suppkey") % 97, F.when(F.col("l_suppkey") % 2 == 0, "l").otherwise("")))
    l = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_linenumber", s.alias("s")).distinct().withColumn("r", text.note_refs("s"))
    return l.select("l_suppkey", "l_linenumber", F.array_join(F.transform("r.refs", lambda x: x.cast("string")), ",").alias("refs"), F.col("r.repaired").alias("repaired"))


def period_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("o_orderdate").cast("date")
    said = F.concat_ws(" ", F.dayofmonth(d), F.element_at(F.array(*map(F.lit, _MONTH_NAMES)), F.month(d)), F.year(d))
    k = F.col("o_orderkey") % 4
    header = F.when(k == 0, F.concat(F.lit("Bağımsız Denetimden Geçmiş 1 Ocak - "), said)).when(k == 1, said).when(k == 2, F.concat(F.lit("Denetimden Geçmemiş 31 Şubat "), F.year(d))).otherwise("Dipnot")
    o = table(spark, sf_dir, "orders").select("o_orderkey", text.parse_period(header).alias("p"))
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return o.select("o_orderkey", F.col("p.type").alias("type"), day("p.start").alias("start"), day("p.end").alias("end"), F.col("p.year").alias("year"), F.col("p.audited").alias("audited"))


def currency_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = ("Tutarlar TL olarak", "bin Türk Lirası", "milyon ABD Doları", "Avro", "atlı binek", "Tutarlar bin TL")
    p = table(spark, sf_dir, "part").select("p_partkey", F.element_at(F.array(*map(F.lit, said)), F.col("p_size") % 6 + 1).alias("s")).withColumn("c", text.currency("s"))
    return p.select("p_partkey", F.col("c.currency").alias("currency"), F.col("c.scale").alias("scale"))


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice", F.col("o_orderdate").cast("date").alias("odate"))
    return table(spark, sf_dir, "lineitem").withColumn("sdate", F.col("l_shipdate").cast("date")).join(o, F.col("l_orderkey") == F.col("o_orderkey"))


def _ladder() -> Column:
    date = F.when(F.col("l_linenumber") % 3 != 0, F.when(F.col("l_linenumber") % 2 == 0, F.date_add("odate", (F.col("l_suppkey") % 3).cast("int"))).otherwise(F.col("sdate")))
    year = F.when(F.col("l_linenumber") != 6, F.year("sdate"))
    return scoring.period_match(F.when(F.col("o_orderkey") % 2 == 0, "instant").otherwise("duration"), F.col("odate"), date, year)


def date_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_lines(spark, sf_dir).groupBy("o_orderpriority", _ladder().alias("period_match")).agg(F.count("*").alias("n"))


def value_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = layout.gap_clusters(table(spark, sf_dir, "events").select("user_id", "event_id", "value"), "value", 5.0, ["user_id"], order=["event_id"])
    g = e.groupBy("user_id", "cluster").agg(F.count("*").alias("n"), F.percentile("value", F.lit(0.05)).alias("x0"), F.percentile("value", F.lit(0.9)).alias("x1")).where(F.col("n") >= fixed.MIN_COLUMN_WORDS)
    return g.select("user_id", "cluster", "n", F.round("x0", 6).alias("x0"), F.round("x1", 6).alias("x1"))


def indent_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select(F.col("p_brand").alias("b"), F.col("p_partkey"), F.when(F.col("p_size") % 7 != 0, F.col("p_size") * 3.5).alias("x0"))
    return layout.indent_levels(p, 5, ["b"]).select("p_partkey", "indent")


def _bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    bands = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation"), "c_mktsegment").agg(F.min("c_acctbal").alias("x0"), F.percentile("c_acctbal", F.lit(0.4)).alias("x1"))
    cols = bands.withColumn("col_idx", F.row_number().over(Window.partitionBy("nation").orderBy("c_mktsegment")) - 1)
    words = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), "s_suppkey", (F.col("s_acctbal") - 500).alias("x0"), (F.col("s_acctbal") + 500).alias("x1"))
    return layout.interval_assign(words, cols, ["nation"], ["s_suppkey"])


def interval_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bands(spark, sf_dir).select("s_suppkey", "best", F.round("best_overlap", 6).alias("best_overlap"))


def nearest_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bands(spark, sf_dir).select("s_suppkey", "nearest")


def line_text_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda x: x["text"])
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("n"), F.sha2(F.array_join(parts, " "), 256).alias("sha"))


def page_offset_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = _order_lines(spark, sf_dir).select("o_orderpriority", F.unix_date("sdate").alias("page"), F.unix_date("odate").alias("folio"))
    return notes.page_offset(l, ["o_orderpriority"])


def _nation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    letters = F.translate("n_name", "0123456789_", "ABCDEFGHIJ ")
    k, no = F.col("n_nationkey") % 4, F.replace((F.col("n_nationkey") + 1).cast("string"), F.lit("1"), F.lit("l"))
    head = F.when(k == 0, F.concat(no, F.lit(". "), letters)).when(k == 1, F.concat(F.lit("NOT "), no, F.lit(" - "), letters, F.lit(" (devamı)"))).when(k == 2, F.concat(no, F.lit(" "), F.lower(letters))).otherwise(letters)
    toc = F.concat(F.lit("NOT "), no, F.lit("  "), letters, F.when(k == 3, "").otherwise(F.concat(F.lit(" .... "), F.col("n_regionkey") + 10, F.when(k == 1, F.concat(F.lit(" - "), F.col("n_nationkey") + 20)).otherwise(""))))
    return table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey", letters.alias("letters"), head.alias("head"), toc.alias("toc"))


def heading_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nation_lines(spark, sf_dir).withColumn("h", text.heading("head")).select("n_nationkey", F.col("h.note_no").alias("note_no"), F.col("h.title").alias("title"), F.col("h.continued").alias("continued"))


def toc_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nation_lines(spark, sf_dir).withColumn("t", text.toc_entry("toc")).select("n_nationkey", F.col("t.note_no").alias("note_no"), F.col("t.title").alias("title"), F.col("t.first").alias("first_page"), F.col("t.last").alias("last_page"))


def title_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _nation_lines(spark, sf_dir)
    a, b = n.select("n_regionkey", F.col("n_nationkey").alias("a"), F.col("letters").alias("x")), n.select("n_regionkey", F.col("n_nationkey").alias("b"), F.col("letters").alias("y"))
    return a.join(b, "n_regionkey").where("a < b").select("a", "b", F.round(text.title_similarity("x", "y"), 6).alias("similarity"))


def contiguous_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return notes.contiguous(c, ["conv_id"], "turn", (F.col("turn") < 4) & (F.col("role") != "assistant") | (F.col("turn") == 1)).select("conv_id", "turn", "role")


def trailing_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat_ws(" ", F.col("p_name"), F.col("p_size"), F.when(F.col("p_size") % 2 == 0, "adet").otherwise("-"), F.col("p_partkey") * 37, F.when(F.col("p_size") % 3 == 0, "%5").otherwise("0"))
    words = table(spark, sf_dir, "part").select("p_partkey", F.posexplode(F.split(line, " ")).alias("pos", "word"))
    t = notes.trailing_values(words, ["p_partkey"], ["pos"], text.is_value("word"))
    return t.groupBy("p_partkey").agg(F.count("*").alias("n_words"), F.count_if("is_trailing").alias("n_values"))


def row_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("turn") % 5 == 0, "header").when(F.col("role") == "assistant", "row").when(F.col("turn") % 3 == 1, "row").otherwise("text")
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", kind.alias("kind"))
    return notes.sessions(c, ["conv_id"], "turn").select("conv_id", "turn", "kind", "block", "header_run")


def sum_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), "o_totalprice")
    return hierarchy.sum_checks(o, table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "k"), ["k"], "o_totalprice", "l_extendedprice").withColumnRenamed("k", "o_orderkey")


def prefix_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shortest run of at least two lines, in order and within the bound, whose running sum is the order's target (the sum of its first 2 to 4 lines)."""
    w = Window.partitionBy("l_orderkey").orderBy(*_LINE_ORDER)
    l = table(spark, sf_dir, "lineitem").withColumns({"k": F.row_number().over(w), "running": F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).over(w.rowsBetween(Window.unboundedPreceding, 0))})
    target = F.max(F.when(F.col("k") <= 2 + F.col("l_orderkey") % 3, F.col("running"))).over(Window.partitionBy("l_orderkey"))
    hit = l.withColumn("target", target).where((F.col("k") >= 2) & (F.col("k") <= fixed.PREFIX_BOUND) & (F.abs(F.col("running") - F.col("target")) <= fixed.SUM_TOLERANCE))
    return hit.groupBy("l_orderkey").agg(F.min("k").alias("length"), F.min("target").cast("double").alias("target"))


def single_component(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy(*_LINE_ORDER)
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", F.row_number().over(w).alias("k"), "l_quantity", F.lead("l_quantity").over(w).alias("after"))
    return l.where(F.abs(F.col("l_quantity") - F.col("after")) <= fixed.SUM_TOLERANCE).select("l_orderkey", "k", "l_quantity")


def hierarchy_solver(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy(*_LINE_ORDER)
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", F.row_number().over(w).alias("row_idx"), F.concat(F.lit("line "), "l_linenumber").alias("label"), F.floor("l_extendedprice").cast("double").alias("v"), F.col("l_quantity").alias("q"))
    total = l.groupBy("l_orderkey").agg((F.max("row_idx") + 1).alias("row_idx"), F.sum("v").alias("v"), F.sum("q").alias("q")).select("l_orderkey", "row_idx", F.lit("total").alias("label"), "v", "q")
    rows = l.unionByName(total).select("l_orderkey", "row_idx", "label", F.array("v", "q").alias("nums"), F.array(F.lit("number"), F.lit("number")).alias("kinds"), F.lit(0).alias("indent"), F.lit(False).alias("decimal"))
    return hierarchy.checks_of(hierarchy.solve_tables(rows, ["l_orderkey"]), ["l_orderkey"])


def line_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.floor(F.col("l_orderkey") / 64).cast("int")  # at most 64 orders, whatever the table's size
    y = F.col("l_linenumber") * 40 + F.col("l_suppkey") % 17
    words = table(spark, sf_dir, "lineitem").select(F.lit("d").alias("doc"), page.alias("page"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("pos"), y.cast("double").alias("y0"), (y + 30).cast("double").alias("y1"))
    return layout.group_lines(words).groupBy("page", "line_no").agg(F.count("*").alias("n"))


def subtree_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, s = table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier")
    edges = n.select(F.concat(F.lit("r"), "n_regionkey").alias("parent"), F.concat(F.lit("n"), "n_nationkey").alias("child")).unionByName(s.select(F.concat(F.lit("n"), "s_nationkey").alias("parent"), F.concat(F.lit("s"), "s_suppkey").alias("child")))
    return audit.subtree_sizes(edges.select(F.lit("all").alias("doc"), "parent", "child")).select("node", "size")


def cell_row_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.array().cast("array<string>")
    repairs = F.when(F.col("l_linenumber") < 4, none).when(F.col("l_linenumber") < 6, F.array(F.lit("letter_as_digit"))).otherwise(F.array(F.lit("irregular_grouping")))
    proof = F.when(F.col("l_returnflag") == "A", True).when(F.col("l_returnflag") == "R", False)
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", scoring.value_confidence(1 - F.col("l_discount"), repairs, proof).alias("c"))
    g = l.groupBy("l_orderkey").agg(F.avg(F.col("c").cast("decimal(10,4)")).cast("double").alias("values_conf"), F.count_if(F.col("c") < fixed.LOW_CONFIDENCE).alias("n_low"))
    return g.select("l_orderkey", F.round("values_conf", 4).alias("values_conf"), "n_low")


def best_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = _order_lines(spark, sf_dir).withColumns({"vm": scoring.value_match(F.col("o_totalprice"), F.col("l_extendedprice")), "pm": _ladder()}).where("pm > 0")
    last = F.struct("vm", "pm", (F.col("l_returnflag") == "A").alias("t"), "l_linenumber", "l_partkey", "l_suppkey")
    return l.groupBy("o_orderkey").agg(F.max_by("l_linenumber", last).alias("best_line"), F.max("pm").alias("best_period"))


def _likeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector with the first vector of its own label and that of the next label: joins on the label, never all with all."""
    e = table(spark, sf_dir, "embeddings")
    first = e.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("head"), F.min("vec_id").alias("head_id")).withColumnRenamed("label", "head_label")
    paired = e.withColumn("head_label", F.explode(F.array("label", F.col("label") + 1))).join(first, "head_label")
    return paired.select("vec_id", "label", "head_label", "head_id", F.round(matching.dot(F.col("embedding"), F.col("head")), 4).alias("score"))


def embedding_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _likeness(spark, sf_dir).where("label = head_label").select("vec_id", "label", "score")


def fit_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _likeness(spark, sf_dir).select(F.lit("all").alias("doc"), F.col("vec_id").cast("string").alias("item_id"), F.col("head_id").cast("string").alias("note_row"), "score", (F.col("label") == F.col("head_label")).alias("same"))
    gold = s.where("same").select("doc", "item_id", "note_row", F.lit("equals_total").alias("relation"))
    return matching.fit_threshold(s.select("doc", "item_id", "note_row", F.col("score").alias("score_a")), gold).drop("doc")


def topk_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.lit("d").alias("doc"), F.col("o_custkey").alias("item_id"), F.col("o_orderkey").alias("note_row"), F.round(F.col("o_totalprice") / 100000, 0).alias("score_a"))
    return matching.top_candidates(o).select(F.col("item_id").alias("o_custkey"), F.col("note_row").alias("o_orderkey"), "rank")


def breakdown_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of orders of three or more whose amounts add up to the linked total; every second total is off by 5."""
    w = Window.partitionBy("l_orderkey").orderBy(*_LINE_ORDER)
    l = table(spark, sf_dir, "lineitem").select(F.lit("d").alias("doc"), F.col("l_orderkey").cast("string").alias("block_id"), F.row_number().over(w).alias("k"), F.floor("l_extendedprice").cast("double").alias("value"))
    top = l.groupBy("doc", "block_id").agg((F.max("k") + 1).alias("k"), F.sum("value").alias("value")).withColumn("value", F.col("value") + F.when(F.col("block_id").cast("long") % 2 == 0, 0).otherwise(5))
    period = F.struct(F.lit("2012-12-31").cast("date").alias("date"), F.lit(2012).alias("year"), F.lit("header").alias("source"))
    rows = l.unionByName(top).select("doc", "block_id", "k", F.concat_ws("_", "block_id", F.lpad(F.col("k").cast("string"), 3, "0")).alias("row_id"), F.lit(0).alias("col"), F.lit("number").alias("kind"), "value", period.alias("period"))
    blocks = rows.groupBy("doc", "block_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "row_id"))), lambda x: x["row_id"]).alias("row_ids"))
    links = top.select("doc", F.col("block_id").alias("item_id"), F.concat_ws("_", "block_id", F.lpad(F.col("k").cast("string"), 3, "0")).alias("note_row"), F.lit(0).alias("col"), "value", F.lit("equals_total").alias("relation"), F.lit(0.9).alias("score"), F.lit("A").alias("method"))
    return matching.breakdown_links(links, rows, blocks).select("item_id", "note_row", "value")


def _two_methods(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rule = table(spark, sf_dir, "documents").where("n_chars > 800").select("doc_id", F.when(F.col("n_chars") > 2500, "1").otherwise("0").alias("relation"), F.lit(0).alias("seq"))
    gold = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string").alias("relation"), F.lit(0).alias("seq"))
    return rule, gold


def compare_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _two_methods(spark, sf_dir)
    return matching.compare(a, b, ["doc_id"]).groupBy("verdict").agg(F.count("*").alias("n"))


def evaluate_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _two_methods(spark, sf_dir)
    return matching.evaluate(a, b, ["doc_id"])


def fallback_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, l = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    own = l.select("doc_id", "quality", F.lit("B").alias("method"))
    rest = d.join(l, "doc_id", "left_anti").select("doc_id", (F.col("n_chars") > 2500).cast("int").alias("quality"), F.lit("A_fallback").alias("method"))
    return own.unionByName(rest)


def _final(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_discount").alias("d"), F.max("l_tax").alias("t"), F.min("l_quantity").alias("q"), F.max("l_extendedprice").alias("v"))
    a = l.where("l_linenumber <= 5").select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") % 2 == 0, "equals_total").otherwise("equals_movement").alias("relation_a"), F.round(1 - F.col("d"), 4).alias("score_a"))
    b = l.where("l_linenumber >= 3").select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") % 3 == 0, "equals_total").otherwise("equals_movement").alias("relation_b"), F.round(1 - F.col("t"), 4).alias("score_b"))
    m = a.join(b, ["l_orderkey", "l_linenumber"], "full").join(l.select("l_orderkey", "l_linenumber", "q", "v"), ["l_orderkey", "l_linenumber"])
    m = m.withColumns({"amount_ok": F.col("q") > 10, "period_match": F.when(F.col("v") > 60000, 1.0).when(F.col("v") > 20000, 0.6).otherwise(0.0)})
    conf = scoring.link_confidence(F.coalesce("score_b", "score_a"), F.col("amount_ok"), F.col("period_match"), scoring.agreement(F.col("relation_a"), F.col("relation_b")), F.lit(0.8))
    return m.withColumn("confidence", F.round(conf, 4)).withColumn("status", scoring.status(F.col("amount_ok"), F.col("period_match"), F.col("confidence")))


def final_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _final(spark, sf_dir).select("l_orderkey", "l_linenumber", F.coalesce("relation_b", "relation_a").alias("relation"), "amount_ok", "period_match", "confidence", "status")


def validation_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve tri-state checks: true, false, or null where nothing applies. Every table is aggregated once; its counts then become rows."""
    bad = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    every = F.count("*")
    lines = table(spark, sf_dir, "lineitem").select("l_linenumber", "l_suppkey", "l_returnflag", "l_shipdate", text.parse_amount(_raw_amount()).alias("a"))
    orders = table(spark, sf_dir, "orders")
    checks = {
        "links": (_final(spark, sf_dir), {"links_between_compatible_periods": (bad(F.col("period_match") == 0), every), "linked_amounts_agree": (bad(~F.col("amount_ok")), every)}),
        "sums": (sum_checks(spark, sf_dir), {"summary_table_sums": (bad(~F.col("passed")), every), "note_table_sums": (bad(~F.col("passed") & (F.col("n_parts") >= 4)), F.count_if(F.col("n_parts") >= 4))}),
        "lines": (lines, {
            "tables_on_configured_pages": (bad(~F.col("l_linenumber").between(1, 7)), every), "note_refs_on_value_rows": (bad((F.col("l_suppkey") % 97 == 11) & (F.col("a.kind") == "empty")), F.count_if(F.col("l_suppkey") % 97 == 11)),
            "numbers_parsed": (bad(text.severe(F.col("a.kind"), F.col("a.repairs"))), every), "periods_present": (bad(F.col("l_shipdate").isNull()), every),
            "assets_equal_liabilities_plus_equity": (F.lit(0).cast("long"), F.when(F.count_distinct("l_returnflag") == 2, every).otherwise(0)),
        }),
        "orders": (orders, {"period_columns_distinct": (bad(F.col("o_orderdate").isNull()), every), "currency_present_and_consistent": (F.count_distinct("o_orderstatus") - 1, every), "note_pages_found": ((every == 0).cast("long"), F.lit(1).cast("long"))}),
    }
    out = None
    for df, found in checks.values():
        counts = F.array(*(F.struct(F.lit(name).alias("check"), n_bad.alias("n_bad"), n.alias("n")) for name, (n_bad, n) in found.items()))
        rows = df.agg(counts.alias("c")).select(F.explode("c").alias("c")).select("c.check", F.when(F.col("c.n") > 0, F.col("c.n_bad") == 0).alias("passed"), "c.n_bad", "c.n")
        out = rows if out is None else out.unionByName(rows)
    return out


def document_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"))).alias("lines"))
    o = table(spark, sf_dir, "orders").join(l, F.col("o_orderkey") == F.col("l_orderkey"))
    return o.select("o_orderkey", F.to_json(F.struct("o_orderkey", "o_orderstatus", F.struct("o_custkey", "o_totalprice").alias("order"), "lines")).alias("document"))


def reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Does every printed total equal the sum of its parts, and how sure is it? Printed amounts are parsed, summed and held against the order's total; every check is returned."""
    parsed = table(spark, sf_dir, "lineitem").select("l_orderkey", text.parse_amount(_raw_amount()).alias("a"), F.lit(None).cast("boolean").alias("none"), (1 - F.col("l_discount")).alias("ocr"))
    cell = parsed.select("l_orderkey", F.coalesce(text.numeric(F.col("a.kind"), F.col("a.value")), F.lit(0.0)).alias("num"), text.severe(F.col("a.kind"), F.col("a.repairs")).cast("int").alias("bad"), scoring.value_confidence(F.col("ocr"), F.col("a.repairs"), F.col("none")).alias("c"))
    sums = cell.groupBy("l_orderkey").agg(F.sum("num").alias("computed"), F.sum("bad").cast("long").alias("n_severe"), F.avg(F.col("c").cast("decimal(10,4)")).cast("double").alias("conf"))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.floor("o_totalprice").cast("double").alias("expected"))
    diff = F.col("expected") - F.col("computed")
    return o.join(sums, "l_orderkey").select(F.col("l_orderkey").alias("o_orderkey"), "expected", "computed", diff.alias("difference"), (F.abs(diff) <= fixed.SUM_TOLERANCE).alias("passed"), "n_severe", F.round("conf", 4).alias("confidence"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    reconciliation, parse_amounts, amount_tokens, label_clean, tr_casefold, all_caps_lines, note_refs, period_headers, currency_units, date_ladder, value_columns, indent_levels, interval_assign, nearest_edge, line_text_agg, page_offset_mode, heading_regex, toc_regex,
    title_similarity, contiguous_run, trailing_values, row_blocks, sum_checks, prefix_match, single_component, hierarchy_solver, line_grouping, subtree_size, cell_row_confidence, best_candidate, embedding_score, fit_threshold, topk_candidates, breakdown_expand,
    compare_methods, evaluate_links, fallback_union, final_links, validation_checks, document_json,
)}
