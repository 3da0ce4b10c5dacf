"""Match ladders, confidences and statuses as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyforge.functions import fixed


def value_match(a: Column, b: Column) -> Column:
    """1 for equal amounts (within the tolerance), 0.8 if only the sign differs, else 0."""
    near = lambda x, y: F.abs(x - y) <= fixed.VALUE_TOLERANCE
    return F.when(near(a, b), 1.0).when(near(F.abs(a), F.abs(b)), 0.8).otherwise(0.0)


def period_match(item_type: Column, item_end: Column, date: Column, year: Column) -> Column:
    """1 same date, 0.8 opening balance of the next day (instants only), 0.6 same year without a date, 0.3 no period, else 0."""
    dated = F.when(date == item_end, 1.0).when((item_type == "instant") & (date == F.date_add(item_end, 1)), 0.8).otherwise(0.0)
    return F.when(date.isNotNull(), dated).when(year.isNotNull(), F.when(year == F.year(item_end), 0.6).otherwise(0.0)).otherwise(0.3)


def score_a(semantic: Column, value: Column, period: Column) -> Column:
    w = fixed.SCORE_WEIGHTS
    return F.round(w["semantic"] * semantic + w["value"] * value + w["period"] * period, 4)


def rule_relation(period: Column, label: Column, source: Column) -> Column:
    opening = (period == 0.8) | F.lower(label).contains("açılış")
    return F.when(opening, "equals_opening_balance").when(source == "block", "equals_movement").otherwise("equals_total")


def format_score(repairs: Column) -> Column:
    bad = F.arrays_overlap(repairs, F.array(*map(F.lit, fixed.SEVERE)))
    return F.when(F.size(repairs) == 0, 1.0).when(bad, 0.0).otherwise(0.6)


def value_confidence(ocr: Column, repairs: Column, arithmetic_ok: Column) -> Column:
    proof = F.when(arithmetic_ok.isNull(), 0.5).when(arithmetic_ok, 1.0).otherwise(0.0)
    return F.round(0.4 * ocr + 0.2 * format_score(repairs) + 0.4 * proof, 4)


def row_confidence(label: Column, values: Column, structure: Column) -> Column:
    return F.round(0.3 * label + 0.4 * values + 0.3 * structure, 4)


def note_value_confidence(ocr: Column, kind: Column, repairs: Column) -> Column:
    clean = (F.size(repairs) == 0) & (kind != "unparseable")
    return F.round(0.6 * ocr + 0.4 * F.when(clean, 1.0).otherwise(0.5), 4)


def agreement(relation_a: Column, relation_b: Column) -> Column:
    return F.when(relation_a.isNull() | relation_b.isNull(), 0.3).when(relation_a == relation_b, 1.0).otherwise(0.6)


def link_confidence(model: Column, amount_ok: Column, period: Column, agreed: Column, extraction: Column) -> Column:
    w = fixed.LINK_WEIGHTS
    return w["model"] * model + w["amount"] * amount_ok.cast("int") + w["period"] * period + w["agreement"] * agreed + w["extraction"] * extraction


def status(amount_ok: Column, period: Column, confidence: Column, threshold: float = fixed.LOW_CONFIDENCE) -> Column:
    return F.when(~amount_ok | (period == 0), "rejected").when(confidence < threshold, "low_confidence").otherwise("accepted")
