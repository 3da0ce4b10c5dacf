"""Linking summary amounts to note rows: candidates, weighted scores, a fitted cut, recorded second opinions and their comparison.

Candidates pair an item with the values of its own document whose period can match; items and note values meet on equal dates or years, never in a cross join of the corpus.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions import fixed, scoring
from tallyforge.sources.tokens import cache_key

KEY = ["doc", "item_id", "note_row"]


def items(rows: DataFrame, cells: DataFrame, pages: DataFrame, note: int) -> DataFrame:
    """Numeric cells of the rows that refer to a note: (doc, item_id, summary_row, col_id, label, statement, period, value, confidence)."""
    wanted = rows.where(F.array_contains("note_refs", note)).select("doc", "page", "row_idx", "row_id", "label")
    numeric = cells.where(F.col("kind").isin("number", "zero")).select("doc", "page", "row_idx", "col_id", "period", "value", "confidence")
    statement = pages.select("doc", "page", F.col("statement_type").alias("statement"))
    return wanted.join(numeric, ["doc", "page", "row_idx"]).join(statement, ["doc", "page"]).select("doc", F.concat_ws(":", "row_id", "col_id").alias("item_id"), F.col("row_id").alias("summary_row"), "col_id", "label", "statement", "period", "value", "confidence")


def candidates(items: DataFrame, values: DataFrame) -> DataFrame:
    """The best value of each note row for each item, among those whose period may match.

    Best: value match, then period match, then a total column, then the last column. The join keys are what each step of the period ladder compares.
    """
    v = values.where(F.col("kind").isin("number", "zero")).select("doc", F.col("row_id").alias("note_row"), "block_id", F.col("label").alias("note_label"), "col", "header", F.col("value").alias("note_value"), F.col("period").alias("note_period"))
    end, date, year = F.col("period.end"), F.col("note_period.date"), F.col("note_period.year")
    parts = [
        items.join(v.where(date.isNotNull()), (items["doc"] == v["doc"]) & (end == date)).drop(v["doc"]),
        items.where("period.type = 'instant'").join(v.where(date.isNotNull()), (items["doc"] == v["doc"]) & (F.date_add(end, 1) == date)).drop(v["doc"]),
        items.join(v.where(date.isNull() & year.isNotNull()), (items["doc"] == v["doc"]) & (F.year(end) == year)).drop(v["doc"]),
        items.join(v.where(date.isNull() & year.isNull()), "doc").select(*items.columns, *[c for c in v.columns if c != "doc"]),
    ]
    paired = parts[0]
    for p in parts[1:]:
        paired = paired.unionByName(p)
    paired = paired.withColumns({"value_match": scoring.value_match(F.col("value"), F.col("note_value")), "period_match": scoring.period_match(F.col("period.type"), end, date, year)})
    total = F.lower("header").contains("toplam")
    best = F.max_by(F.struct("col", "header", "note_value", "note_period", "value_match", "period_match"), F.struct("value_match", "period_match", total.alias("t"), "col")).alias("b")
    return paired.groupBy(*KEY, "block_id", "label", F.col("note_label")).agg(best).select(*KEY, "block_id", "label", "note_label", "b.*")


def hashed_encoder(dimensions: int = 256) -> Callable[[pd.Series], pd.Series]:
    """A deterministic stand-in for a sentence encoder: hashed character trigrams, unit length."""

    def encode(texts: pd.Series) -> pd.Series:
        import zlib

        import numpy as np

        def one(s: str) -> list[float]:
            v = np.zeros(dimensions)
            s = f" {s.lower()} "
            for i in range(len(s) - 2):
                v[zlib.crc32(s[i : i + 3].encode()) % dimensions] += 1
            n = np.linalg.norm(v)
            return (v / n if n else v).tolist()

        return texts.fillna("").map(one)

    return encode


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def score(cands: DataFrame, title: Column, encode: Callable[[pd.Series], pd.Series] | None = None) -> DataFrame:
    """``cands`` with semantic (similarity of texts, at least 0) and score_a."""
    from pyspark.sql.types import ArrayType, DoubleType

    embed = F.pandas_udf(encode or hashed_encoder(), ArrayType(DoubleType()))
    said = F.concat_ws(" - ", title, F.when(F.col("note_label") == "", "toplam").otherwise(F.col("note_label")), "header")
    out = cands.withColumns({"__a": embed(F.col("label")), "__b": embed(said)})
    out = out.withColumn("semantic", F.round(F.greatest(F.lit(0.0), dot(F.col("__a"), F.col("__b"))), 4)).drop("__a", "__b")
    return out.withColumn("score_a", scoring.score_a(F.col("semantic"), F.col("value_match"), F.col("period_match")))


def fit_threshold(scored: DataFrame, gold: DataFrame, default: float = fixed.LINK_THRESHOLD) -> DataFrame:
    """(doc, threshold, source), one row a document: the lowest midpoint between neighbouring distinct scores with the best F1 on the document's direct gold links, or the default if it has none.

    Counts are aggregated by distinct score first, so the ordered part has one row a score (of four decimals).
    """
    direct = gold.where("relation <> 'breakdown_component'").select(*KEY).distinct()
    marked = scored.select(*KEY, "score_a").join(direct.withColumn("hit", F.lit(1)), KEY, "left")
    by = marked.groupBy("doc", "score_a").agg(F.count("*").alias("n"), F.count("hit").alias("tp"))
    w = Window.partitionBy("doc")
    down = w.orderBy(F.desc("score_a")).rowsBetween(Window.unboundedPreceding, 0)
    cuts = by.select("doc", "score_a", F.lag("score_a").over(w.orderBy("score_a")).alias("lower"), F.sum("n").over(down).alias("pred"), F.sum("tp").over(down).alias("tp")).where("lower is not null")
    known = direct.groupBy("doc").agg(F.count("*").alias("gold"))
    f1 = 2 * F.col("tp") / (F.col("pred") + F.col("gold"))
    best = cuts.join(known, "doc").select("doc", ((F.col("score_a") + F.col("lower")) / 2).alias("t"), f1.alias("f1")).groupBy("doc").agg(F.min_by("t", F.struct((-F.col("f1")).alias("f"), F.col("t"))).alias("t"))
    out = scored.select("doc").distinct().join(known, "doc", "left").join(best, "doc", "left")
    has = F.col("gold").isNotNull()
    return out.select("doc", F.when(has, F.coalesce(F.round("t", 4), F.lit(default))).otherwise(default).alias("threshold"), F.when(has, "control_examples").otherwise("config_default").alias("source"))


def direct_links(scored: DataFrame, threshold: DataFrame) -> DataFrame:
    kept = scored.join(threshold.select("doc", "threshold"), "doc").where("score_a >= threshold")
    relation = scoring.rule_relation(F.col("period_match"), F.col("note_label"), F.col("note_period.source"))
    return kept.select(*KEY, "col", F.col("note_value").alias("value"), relation.alias("relation"), F.col("score_a").alias("score"), F.lit("A").alias("method"))


def breakdown_links(links: DataFrame, values: DataFrame, blocks: DataFrame) -> DataFrame:
    """The parts of linked totals: all rows above a block's last row, if they have amounts at the total's date that add up to it."""
    ids = blocks.where(F.size("row_ids") >= 3).select("doc", F.element_at("row_ids", -1).alias("note_row"), F.slice("row_ids", 1, F.size("row_ids") - 1).alias("parts"))
    cell = values.select("doc", F.col("row_id"), "col", F.col("period.date").alias("date"), F.when(F.col("kind").isin("number", "zero", "percent"), F.col("value")).alias("v"))
    total = cell.select("doc", F.col("row_id").alias("note_row"), "col", F.col("date").alias("total_date"))
    wide = links.where("relation = 'equals_total'").join(ids, ["doc", "note_row"]).join(total, ["doc", "note_row", "col"]).where("total_date is not null")
    wide = wide.select("doc", "item_id", F.col("note_row").alias("total_row"), "col", F.col("value").alias("total"), "score", "method", "total_date", F.explode("parts").alias("row_id")).join(cell, ["doc", "row_id", "col"], "left")
    group = Window.partitionBy("doc", "item_id", "total_row", "col", "method")
    amount = F.when(F.col("date") == F.col("total_date"), F.col("v"))
    wide = wide.withColumn("amount", amount).withColumns({"all_there": F.bool_and(F.col("amount").isNotNull()).over(group), "sum": F.sum("amount").over(group)})
    ok = wide.where(F.col("all_there") & (F.abs(F.col("sum") - F.col("total")) <= fixed.VALUE_TOLERANCE))
    return ok.select("doc", "item_id", F.col("row_id").alias("note_row"), "col", F.col("amount").alias("value"), F.lit("breakdown_component").alias("relation"), "score", "method")


def links_a(scored: DataFrame, threshold: DataFrame, values: DataFrame, blocks: DataFrame) -> DataFrame:
    direct = direct_links(scored, threshold)
    return direct.withColumn("seq", F.lit(0)).unionByName(breakdown_links(direct, values, blocks).withColumn("seq", F.lit(1)))


def top_candidates(scored: DataFrame, k: int = fixed.MAX_CANDIDATES) -> DataFrame:
    """The k best candidates of each item; equal scores in order of row. What a second opinion is asked about."""
    w = Window.partitionBy("doc", "item_id").orderBy(F.desc("score_a"), "note_row")
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def requests(scored: DataFrame, items: DataFrame, values: DataFrame, model: str, instructions: str, k: int = fixed.MAX_CANDIDATES) -> DataFrame:
    """What a second opinion is asked, one row an item: (doc, item_id, payload, key). The payload is JSON of the item and its best candidates with all their amounts; the key is the content address of the call."""
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    cell = F.struct("col", "header", "value", day("period.date").alias("date"), F.col("period.year").alias("year"))
    amounts = values.groupBy("doc", F.col("row_id").alias("note_row")).agg(F.first("label").alias("row_label"), F.array_sort(F.collect_list(cell)).alias("amounts"))
    rows = top_candidates(scored, k).select(*KEY, "rank").join(amounts, ["doc", "note_row"])
    listed = rows.groupBy("doc", "item_id").agg(F.array_sort(F.collect_list(F.struct("rank", F.struct(F.col("note_row").alias("row_id"), F.col("row_label").alias("label"), "amounts").alias("r")))).alias("rows"))
    item = F.struct("item_id", "label", "statement", "value", F.col("period.type").alias("period_type"), day("period.end").alias("period_end"))
    said = items.select("doc", "item_id", item.alias("item")).join(listed, ["doc", "item_id"])
    payload = F.to_json(F.struct("item", F.transform("rows", lambda r: r["r"]).alias("candidates")))
    return said.select("doc", "item_id", payload.alias("payload")).withColumn("key", cache_key(F.lit(model), F.lit(instructions), "payload"))


def links_b(scored: DataFrame, decisions: DataFrame, values: DataFrame, fallback: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(links, items without an answer). An item of a document without recorded decisions takes method A's links."""
    asked = top_candidates(scored).select(*KEY)
    d = decisions.where("row_id is not null and relation <> 'unrelated'").withColumnRenamed("row_id", "note_row").join(asked, KEY)
    width = values.groupBy("doc", F.col("row_id").alias("note_row")).agg(F.max("col").alias("last_col"))
    d = d.withColumnRenamed("col", "said").join(width, ["doc", "note_row"]).withColumn("col", F.when(F.col("said").between(0, F.col("last_col")), F.col("said")).otherwise(0))
    cell = values.select("doc", F.col("row_id").alias("note_row"), "col", "value")
    found = d.join(cell, ["doc", "note_row", "col"], "left").select(*KEY, "col", "value", "relation", F.round(F.least(F.greatest("confidence", F.lit(0.0)), F.lit(1.0)), 4).alias("score"), F.lit("B").alias("method"), "reason", F.col("ord").alias("seq"))
    answered = decisions.select("doc", "item_id").distinct()
    silent = asked.select("doc", "item_id").distinct().join(answered, ["doc", "item_id"], "left_anti")
    instead = fallback.join(silent, ["doc", "item_id"], "left_semi").select(*KEY, "col", "value", "relation", "score", F.lit("A_fallback").alias("method"), F.lit(None).cast("string").alias("reason"), "seq")
    return found.unionByName(instead), silent


def last_of(links: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One link a key: the last in order, as later links replace earlier ones."""
    keys = keys or KEY
    w = Window.partitionBy(*keys).orderBy(F.desc("seq"), F.desc("relation"))
    return links.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def compare(a: DataFrame, b: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(keys, relation_a, relation_b, verdict): both_same_relation, both_different_relation, only_a or only_b."""
    keys = keys or KEY
    both = last_of(a, keys).select(*keys, F.col("relation").alias("relation_a")).join(last_of(b, keys).select(*keys, F.col("relation").alias("relation_b")), keys, "full")
    verdict = F.when(F.col("relation_b").isNull(), "only_a").when(F.col("relation_a").isNull(), "only_b").when(F.col("relation_a") == F.col("relation_b"), "both_same_relation").otherwise("both_different_relation")
    return both.withColumn("verdict", verdict)


def _against(links: DataFrame, gold: DataFrame, keys: list[str]) -> DataFrame:
    p = links.groupBy(*keys).agg(F.max("relation").alias("p"))
    return p.join(gold.groupBy(*keys).agg(F.max("relation").alias("g")), keys, "full")


def errors(links: DataFrame, gold: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(keys, error): links that aren't gold (false_positive) and gold that isn't linked (missed), a row each."""
    keys = keys or KEY
    both = _against(links, gold, keys).where("p is null or g is null")
    return both.select(*keys, F.when(F.col("g").isNull(), "false_positive").otherwise("missed").alias("error"))


def evaluate(links: DataFrame, gold: DataFrame, keys: list[str] | None = None, by: list[str] | None = None) -> DataFrame:
    """precision, recall, f1, relation_accuracy and the counts n_false and n_missed, one row (or one of each ``by``); 0 where a denominator is empty."""
    by = by or []
    tp, n_p, n_g = F.count_if(F.col("p").isNotNull() & F.col("g").isNotNull()), F.count("p"), F.count("g")
    agg = _against(links, gold, keys or KEY).groupBy(*by).agg(tp.alias("tp"), n_p.alias("n_p"), n_g.alias("n_g"), F.count_if(F.col("p") == F.col("g")).alias("same"))
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    precision, recall = ratio("tp", "n_p"), ratio("tp", "n_g")
    f1 = F.when(F.col("tp") > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)
    return agg.select(*by, F.round(precision, 3).alias("precision"), F.round(recall, 3).alias("recall"), F.round(f1, 3).alias("f1"), F.round(ratio("same", "tp"), 3).alias("relation_accuracy"), (F.col("n_p") - F.col("tp")).alias("n_false"), (F.col("n_g") - F.col("tp")).alias("n_missed"))
