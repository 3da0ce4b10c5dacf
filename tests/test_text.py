from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyforge.functions import text


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "s string").select(expr(F.col("s")).alias("r")).first()["r"]


CASES = [
    ("373.992.222", False, "number", 373992222, []),
    ("(49.167.330)", False, "number", -49167330, []),
    ("-", False, "dash", None, []),
    ("", False, "empty", None, []),
    (None, False, "empty", None, []),
    ("0", False, "zero", 0, []),
    ("8.874,602", False, "number", 8874602, ["comma_as_thousands_separator"]),
    ("7,.932.336", False, "number", 7932336, ["doubled_separator"]),
    ("227317822", False, "number", 227317822, ["missing_thousands_separator"]),
    ("(561.5989)", False, "number", -5615989, ["irregular_grouping"]),
    ("0,058", False, "number", 0.058, []),
    ("1,191", True, "number", 1.191, []),
    ("1,191", False, "number", 1191, ["comma_as_thousands_separator"]),
    ("%10,5", False, "percent", 10.5, []),
    ("%2-%4", False, "percent_range", None, []),
    ("-5", False, "number", 5, []),
    ("S", False, "number", 5, ["letter_as_digit"]),
    ("Il", False, "number", 11, ["letter_as_digit"]),
    ("(5", False, "number", -5, ["unbalanced_parenthesis"]),
    ("0,0", False, "number", 0.0, []),
    ("00", False, "zero", 0, []),
    ("abc", False, "unparseable", None, []),
    ("2011", False, "number", 2011, ["missing_thousands_separator"]),
    ("1 234", False, "number", 1234, ["missing_thousands_separator"]),
]


def test_amounts(spark):
    rows = [(i, raw, dec) for i, (raw, dec, *_) in enumerate(CASES)]
    got = {r["i"]: r["a"] for r in spark.createDataFrame(rows, "i int, s string, d boolean").select("i", text.parse_amount("s", F.col("d")).alias("a")).collect()}
    for i, (raw, _, kind, value, repairs) in enumerate(CASES):
        assert (got[i]["kind"], got[i]["value"], got[i]["repairs"]) == (kind, value, repairs), raw
    assert got[14]["range"] == [2.0, 4.0]


@pytest.mark.parametrize(("raw", "refs", "repaired"), [("11", [11], False), ("Il", [11], True), ("2011", [20, 11], False), ("00", [], False), ("3, 14", [3, 14], False)])
def test_note_refs(spark, raw, refs, repaired):
    r = one(spark, raw, text.note_refs)
    assert (r["refs"], r["repaired"]) == (refs, repaired)


def test_labels_and_case(spark):
    assert one(spark, "-Ilgili  alacak_lar .:", text.clean_label) == "Ilgili alacak lar"
    assert one(spark, "~ istanbul", text.clean_label) == "İstanbul"
    assert one(spark, "ılık iş", text.tr_upper) == "ILIK İŞ"
    assert one(spark, "ILIK İŞ", text.tr_lower) == "ılık iş"
    assert one(spark, "ABCDEf", text.is_all_caps) is True
    assert one(spark, "AB", text.is_all_caps) is False


def test_periods(spark):
    p = one(spark, "Bağımsız Denetimden Geçmiş 1 Ocak- 31 Aralık 2012", text.parse_period)
    assert (p["type"], p["start"], p["end"], p["audited"]) == ("duration", date(2012, 1, 1), date(2012, 12, 31), True)
    p = one(spark, "Denetimden Geçmemiş 31 Aralık 2011", text.parse_period)
    assert (p["type"], p["start"], p["end"], p["audited"]) == ("instant", None, date(2011, 12, 31), False)
    p = one(spark, "31 Şubat 2010", text.parse_period)
    assert (p["type"], p["end"]) == ("instant", date(2010, 12, 31))
    assert one(spark, "hiçbiri", text.parse_period)["type"] is None
    d = one(spark, "1 Mart 2009 ve 5 Mayıs 2010", text.find_dates)
    assert d["dates"] == [date(2010, 3, 1), date(2010, 5, 5)] and d["years"] == [2009, 2010]


def test_currency(spark):
    assert tuple(one(spark, "Tutarlar bin TL olarak", text.currency)) == ("TRY", 1000)
    assert tuple(one(spark, "milyon ABD Doları", text.currency)) == ("USD", 1_000_000)
    assert tuple(one(spark, "atlı", text.currency)) == (None, 1)


def test_headings_and_contents(spark):
    h = one(spark, "1l. DEPO BİNALARI (devamı)", text.heading)
    assert (h["note_no"], h["title"], h["continued"]) == (11, "DEPO BİNALARI", True)
    assert one(spark, "11. Depo binaları", text.heading) is None
    t = one(spark, "NOT 7  STOKLAR ....... 31-32", text.toc_entry)
    assert tuple(t) == (7, "STOKLAR", 31, 32)
    assert tuple(one(spark, "NOT 8 DİĞER 33", text.toc_entry))[2:] == (33, 33)


def test_similarity(spark):
    r = spark.createDataFrame([("DEPO BİNALARI", "Depo binaları"), ("ABC", "XYZ")], "a string, b string").select(text.title_similarity("a", "b").alias("r")).collect()
    assert r[0]["r"] == 1.0 and r[1]["r"] == 0.0


def test_is_amount(spark):
    assert [one(spark, s, text.is_amount) for s in ("12", "1.2", "123", "(0,5)", "0,05", "x1234")] == [False, True, True, True, True, True]
