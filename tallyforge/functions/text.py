"""Grammar of amounts, labels, references, periods and currencies as column expressions.

Everything here stays inside Catalyst. Patterns use explicit classes and ``\\z`` so that they mean the same in other engines.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tallyforge.functions import fixed

AMOUNT = "struct<raw:string,kind:string,value:double,range:array<double>,decimal:boolean,repairs:array<string>>"
_BLANK = " \t\n\r\f\x0b\xa0"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body refers to it; keeps expression trees small."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(c: Column, chars: str = _BLANK) -> Column:
    return F.btrim(c, F.lit(chars))


def tr_upper(c: Column | str) -> Column:
    """Turkish upper case: i and ı have partners of their own."""
    return F.upper(F.translate(_col(c), "iı", "İI"))


def tr_lower(c: Column | str) -> Column:
    return F.lower(F.translate(_col(c), "Iİ", "ıi"))


def is_all_caps(c: Column | str) -> Column:
    """At least three letters, over 80 % of them upper case."""
    letters = F.length(F.regexp_replace(_col(c), r"[^\p{L}]", ""))
    upper = F.length(F.regexp_replace(_col(c), r"[^\p{Lu}]", ""))
    return (letters >= 3) & (upper / F.nullif(letters, F.lit(0)) > 0.8)


def clean_label(c: Column | str) -> Column:
    bare = F.translate(F.regexp_replace(_col(c), r"^\s*[-~–—_]+\s*", ""), "_", " ")
    s = strip(F.regexp_replace(bare, r"\s+", " "), " .:;")
    return F.when(s.rlike(r"^\p{Ll}"), F.concat(tr_upper(F.substring(s, 1, 1)), F.substring(s, 2, 1 << 20))).otherwise(s)


def note_refs(c: Column | str) -> Column:
    """struct(refs, repaired): one or two digits at a time, after letters that look like digits are read as such."""
    s = strip(_col(c))
    read = F.translate(s, *fixed.REF_LIKE)
    found = F.transform(F.regexp_extract_all(read, F.lit("([0-9]{1,2})"), F.lit(1)), lambda x: x.cast("int"))
    return F.struct(F.filter(found, lambda n: n.between(1, 99)).alias("refs"), (read != s).alias("repaired"))


def currency(c: Column | str) -> Column:
    """struct(currency, scale); the scale is reported, amounts are never multiplied by it."""
    low = tr_lower(c)
    word = lambda w: low.rlike(rf"(^|[^\p{{L}}\p{{N}}_]){w}([^\p{{L}}\p{{N}}_]|\z)")
    code = F.when(low.contains("türk lirası") | word("tl"), "TRY").when(low.contains("abd doları"), "USD").when(low.contains("avro"), "EUR")
    scale = F.when(word("bin"), 1_000).when(low.contains("milyon"), 1_000_000).otherwise(1)
    return F.struct(code.alias("currency"), scale.alias("scale"))


def is_amount(c: Column | str) -> Column:
    s = F.replace(_col(c), F.lit(" "), F.lit(""))
    return s.rlike(r"[0-9][0-9.,]{2,}") | s.rlike(fixed.DECIMAL_AMOUNT)


def parse_amount(c: Column | str, decimal: Column | None = None) -> Column:
    """The amount grammar as one struct of type AMOUNT; a null text is empty.

    Kinds: empty, dash, percent, percent_range, unparseable, number, zero. A leading minus doesn't negate, parentheses do.
    """
    flag = F.lit(False) if decimal is None else F.coalesce(decimal, F.lit(False))
    raw = F.coalesce(_col(c), F.lit(""))
    one, two = r"^%\s*[0-9]+([.,][0-9]+)?\z", r"^%\s*([0-9]+(?:[.,][0-9]+)?)\s*-\s*%?\s*([0-9]+(?:[.,][0-9]+)?)\z"
    as_double = lambda x: F.translate(x, ",", ".").try_cast("double")

    def read(p: Column) -> Column:
        tight = F.replace(p["s"], F.lit(" "), F.lit(""))
        digits = F.translate(tight, *fixed.DIGIT_LIKE)
        return let(F.struct(p["raw"].alias("raw"), p["s"].alias("s"), p["flag"].alias("flag"), tight.alias("tight"), digits.alias("digits"), strip(digits, "()-").alias("bare")), collapse)

    def collapse(p: Column) -> Column:
        single = F.regexp_replace(p["bare"], r"[.,]{2,}", ".")
        names = ("raw", "s", "flag", "tight", "digits", "bare")
        return let(F.struct(*(p[n].alias(n) for n in names), single.alias("single"), (F.length(single) - F.length(F.translate(single, ".,", ""))).alias("seps")), judge)

    def judge(p: Column) -> Column:
        s, single, seps = p["s"], p["single"], p["seps"]
        plain, comma = single.rlike(r"^[0-9]+([.,][0-9]+)*\z"), single.contains(",")
        opens, closes = p["digits"].startswith("("), p["digits"].endswith(")")
        fraction = (seps == 1) & comma & (p["flag"] | single.startswith("0,"))
        sign = F.when(opens | closes, -1).otherwise(1)
        whole = F.translate(single, ".,", "").try_cast("double")
        grouping = (
            F.when(fraction, None)
            .when((seps == 0) & (F.length(single) > 3), "missing_thousands_separator")
            .when((seps > 0) & ~single.rlike(r"^[0-9]{1,3}([.,][0-9]{3})+\z"), "irregular_grouping")
            .when((seps > 0) & comma, "comma_as_thousands_separator")
        )
        early = [F.when(p["digits"] != p["tight"], "letter_as_digit"), F.when(opens != closes, "unbalanced_parenthesis"), F.when(single != p["bare"], "doubled_separator")]
        kind = (
            F.when(s == "", "empty").when(s.isin(*fixed.DASHES), "dash").when(s.rlike(one), "percent").when(s.rlike(two), "percent_range")
            .when(~plain, "unparseable").when(fraction | (whole != 0), "number").otherwise("zero")
        )
        value = F.when(fraction, as_double(single)).otherwise(whole) * sign
        return let(F.struct(p["raw"].alias("raw"), s.alias("s"), kind.alias("kind"), value.alias("value"), fraction.alias("fraction"), F.array_compact(F.array(*early, F.when(plain, grouping))).alias("repairs")), finish)

    def finish(p: Column) -> Column:
        kind, s = p["kind"], p["s"]
        value = F.when(kind == "percent", as_double(strip(F.substring(s, 2, 1 << 20)))).when(kind.isin("number", "zero"), p["value"])
        both = F.when(kind == "percent_range", F.array(as_double(F.regexp_extract(s, two, 1)), as_double(F.regexp_extract(s, two, 2))))
        early_kind = kind.isin("empty", "dash", "percent", "percent_range")
        return F.struct(
            p["raw"].alias("raw"), kind.alias("kind"), value.alias("value"), both.alias("range"), (kind.isin("percent", "percent_range") | ((kind == "number") & p["fraction"])).alias("decimal"),
            F.when(early_kind, F.array().cast("array<string>")).otherwise(p["repairs"]).alias("repairs"),
        )

    return let(F.struct(raw.alias("raw"), strip(raw).alias("s"), flag.alias("flag")), read)


def is_value(c: Column | str) -> Column:
    return parse_amount(c)["kind"].isin(*fixed.VALUE_KINDS)


def numeric(kind: Column, value: Column) -> Column:
    """What a cell adds to a sum: its value, 0 for a dash, else null."""
    return F.when(kind.isin("number", "zero"), value).when(kind == "dash", 0.0)


def severe(kind: Column, repairs: Column) -> Column:
    return (kind == "unparseable") | F.arrays_overlap(repairs, F.array(*map(F.lit, fixed.SEVERE)))


def years(low: Column) -> Column:
    return F.transform(F.regexp_extract_all(low, F.lit(f"({fixed.YEAR})"), F.lit(1)), lambda y: y.cast("int"))


def _dates(low: Column, year: Column) -> Column:
    """Day and month pairs of the text, all in its last year; impossible dates are left out."""
    pattern = F.lit(r"([0-9]{1,2})\s*(" + "|".join(fixed.MONTHS) + ")")
    months = F.array(*map(F.lit, fixed.MONTHS))
    made = F.zip_with(F.regexp_extract_all(low, pattern, F.lit(1)), F.regexp_extract_all(low, pattern, F.lit(2)), lambda d, m: F.concat_ws("-", year, F.lpad(F.array_position(months, m).cast("string"), 2, "0"), F.lpad(d, 2, "0")).try_cast("date"))
    return F.when(year.isNull(), F.array().cast("array<date>")).otherwise(F.array_compact(made))


def _read_dates(c: Column | str, body: Callable[[Column], Column]) -> Column:
    """``body`` of struct(raw, low, years, year, dates)."""
    dated = lambda p: let(F.struct(*(p[n].alias(n) for n in ("raw", "low", "years", "year")), _dates(p["low"], p["year"]).alias("dates")), body)
    last = lambda p: let(F.struct(p["raw"].alias("raw"), p["low"].alias("low"), p["years"].alias("years"), F.try_element_at(p["years"], F.lit(-1)).alias("year")), dated)
    return let(F.struct(_col(c).alias("raw"), tr_lower(c).alias("low"), years(tr_lower(c)).alias("years")), last)


def find_dates(c: Column | str) -> Column:
    """struct(dates, years)."""
    return _read_dates(c, lambda p: F.struct(p["dates"].alias("dates"), p["years"].alias("years")))


def parse_period(c: Column | str) -> Column:
    """struct(type, start, end, year, audited, header): two dates or more are a duration, else an instant (31 December if only a year is given)."""

    def body(p: Column) -> Column:
        year, dates, low = p["year"], p["dates"], p["low"]
        many = F.size(dates) >= 2
        end = F.coalesce(F.try_element_at(dates, F.when(many, -1).otherwise(1)), F.make_date(year, F.lit(12), F.lit(31)))
        return F.struct(
            F.when(year.isNull(), None).when(many, "duration").otherwise("instant").alias("type"), F.when(year.isNotNull() & many, F.try_element_at(dates, F.lit(1))).alias("start"),
            F.when(year.isNotNull(), end).alias("end"), year.alias("year"), (low.contains("denetim") & ~low.contains("denetimden geçmemiş")).alias("audited"), p["raw"].alias("header"),
        )

    return _read_dates(c, body)


def statement_type(title: Column | str) -> Column:
    up = tr_upper(title)
    chain = F.when(F.lit(False), "")
    for name, words in fixed.STATEMENTS.items():
        chain = chain.when(reduce(lambda a, b: a | b, (up.contains(w) for w in words)), name)
    return chain


def heading(c: Column | str) -> Column:
    """struct(note_no, title, continued), null if the line isn't a numbered all-caps heading."""
    s = strip(_col(c))
    raw = strip(F.regexp_extract(s, fixed.HEADING, 2))
    title = strip(F.regexp_replace(raw, r"(?i)\(devam.*\z", ""))
    refs = note_refs(F.regexp_extract(s, fixed.HEADING, 1))["refs"]
    ok = s.rlike(fixed.HEADING) & (F.size(refs) > 0) & is_all_caps(title)
    return F.when(ok, F.struct(F.element_at(refs, 1).alias("note_no"), title.alias("title"), raw.rlike(r"(?i)\(devam").alias("continued")))


def toc_entry(c: Column | str) -> Column:
    """struct(note_no, title, first, last) of a contents line with pages, else null."""
    s = strip(F.regexp_replace(_col(c), r"\s+", " "))
    part = lambda n: F.regexp_extract(s, fixed.TOC_ENTRY, n)
    refs = note_refs(part(1))["refs"]
    first = part(3).try_cast("int")
    return F.when(s.rlike(fixed.TOC_ENTRY) & (F.size(refs) > 0), F.struct(F.element_at(refs, 1).alias("note_no"), strip(part(2), " .-_").alias("title"), first.alias("first"), F.coalesce(F.nullif(part(4), F.lit("")).try_cast("int"), first).alias("last")))


def _letters(c: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(tr_upper(c), "[^A-ZÇĞİÖŞÜ ]", ""), " +", " "), " ")


@F.pandas_udf(DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    from difflib import SequenceMatcher

    return pd.Series([SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b, strict=True)])


def title_similarity(a: Column | str, b: Column | str) -> Column:
    """Ratcliff-Obershelp ratio of the upper-case letters of two titles; Arrow batches, after normalisation in Catalyst."""
    return _ratio(_letters(_col(a)), _letters(_col(b)))
