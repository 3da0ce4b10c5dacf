"""Secret scans by an incremental blob ledger, in DataFrame functions only.

Every version of every path is content-addressed by SHA-256. The ledger has one row for each blob and run, with the rule
versions applied and their findings. A scan holds addresses against the ledger first, fetches only blobs that lack a current rule version, applies only the
rules they lack, appends to the ledger, and findings are joined back to all paths by address. Equal contents are scanned once however
many paths and versions hold them; a changed rule gets a new version and so rescans everything for that rule alone.

The position of a match is found from the pieces between matches: their lengths and those of the matches before it add up, in one pass over the matches.

Edge cases: a null content counts as empty; empty blobs have no findings; contents of any length are scanned whole; null paths and
repeated rows are kept, a row each; empty tables give an empty result. Other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.arrays import bound, sums_before
from tallyforge.llm.storage import new_path, written


@dataclass(frozen=True)
class Rule:
    """A pattern (Java and RE2 alike); a match counts if its group has ``least`` characters or more. Raise ``version`` with any change."""

    kind: str
    pattern: str
    least: int
    group: int = 0
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


#: Fixed patterns. In ``hex`` and ``access`` a stretch that is too short can hold no longer one, so the length is part of the pattern.
RULES = (
    Rule("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]{16,}", 20),
    Rule("hex", r"[0-9a-f]{24,}", 24),
)
BASE = ("assign", "access", "hex")
#: What the method adds: key blocks and signed tokens.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 20),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 36),
)

#: Most addresses (about 100 bytes each) that are broadcast to pick blobs; beyond it the same join shuffles.
BROADCAST_ROWS = 500_000

FINDING = "array<struct<start:int,rank:int,kind:string,end:int,rule:string>>"


def matches(text: Column, rule: Rule, rank: int) -> Column:
    """Matches of a rule as (start, rank, kind, end, rule) in code points, leftmost and non-overlapping."""
    whole, pieces = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), F.split(text, rule.pattern, -1)
    group = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole

    zipped = F.arrays_zip(F.slice(pieces, 1, F.size(whole)).alias("before"), whole.alias("whole"), group.alias("group"))
    lengths = F.transform(zipped, lambda m: F.struct(F.length(m["before"]).alias("before"), F.length(m["whole"]).alias("whole"), F.length(m["group"]).alias("group")))

    def found(ms: Column) -> Column:
        def finding(m: Column, at: Column) -> Column:
            start = at + m["before"]
            hit = F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), (start + m["whole"]).alias("end"), F.lit(rule.name).alias("rule"))
            return F.when(m["group"] >= rule.least, hit)

        return F.array_compact(F.zip_with(ms, sums_before(F.transform(ms, lambda m: m["before"] + m["whole"])), finding))

    return bound(lengths, found)


def _findings(text: Column, rules: tuple[Rule, ...], missing: Column) -> Column:
    none = F.array().cast(FINDING)
    each = [F.when(F.array_contains(missing, r.name) & F.regexp_like(text, F.lit(r.pattern)), matches(text, r, i)).otherwise(none) for i, r in enumerate(rules)]
    return F.array_sort(F.concat(*each))


def addressed(versions: DataFrame, content_col: str) -> DataFrame:
    """``versions`` with ``sha`` (the content's address) and ``blob`` (its text)."""
    text = F.coalesce(F.col(content_col).cast("string"), F.lit(""))
    return versions.withColumns({"sha": F.unhex(F.sha2(text, 256)), "blob": text})


def extend_ledger(versions: DataFrame, ledger: DataFrame | None, ledger_path: str, content_col: str = "text", rules: tuple[Rule, ...] = RULES + MORE_RULES) -> DataFrame:
    """Scan the blob and rule-version pairs that ``ledger`` lacks, append them to ``ledger_path`` and return the new rows (sha, rules, findings)."""
    names = F.array(*(F.lit(r.name) for r in rules))
    contents = addressed(versions.select(content_col), content_col)
    if ledger is None:
        lacking = contents.groupBy("sha").agg(F.first("blob").alias("blob")).withColumn("missing", names)
    else:
        seen = ledger.groupBy("sha").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))  # a row for each run that added a rule
        missing = F.array_except(names, F.coalesce("seen", F.array().cast("array<string>")))
        wanted = written(contents.select("sha").distinct().join(seen, "sha", "left").select("sha", missing.alias("missing")).where(F.size("missing") > 0), "lacking")
        side = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
        lacking = contents.select("sha", "blob").join(side, "sha").groupBy("sha").agg(F.first("blob").alias("blob"), F.first("missing").alias("missing"))
    fresh = lacking.select("sha", F.col("missing").alias("rules"), _findings(F.col("blob"), rules, F.col("missing")).alias("findings"))
    run = f"{ledger_path}/run-{new_path(versions.sparkSession, 'x').rpartition('-')[2]}"
    fresh.write.parquet(run)
    return versions.sparkSession.read.schema(fresh.schema).parquet(run)


def by_path(versions: DataFrame, ledger: DataFrame, path_col: str, content_col: str = "text", rules: tuple[Rule, ...] = RULES + MORE_RULES) -> DataFrame:
    """(path, sha, findings) of every version: the ledger's findings under the current rule versions, by start and then rule."""
    current = [r.name for r in rules]
    valid = ledger.select("sha", F.filter("findings", lambda f: f["rule"].isin(current)).alias("findings")).where(F.size("findings") > 0)
    found = valid.groupBy("sha").agg(F.array_sort(F.flatten(F.collect_list("findings"))).alias("findings"))  # a row for each run that added a rule
    paths = addressed(versions.select(F.col(path_col).alias("path"), F.col(content_col).alias("content")), "content").select("path", "sha")
    return paths.join(found, "sha", "left").select("path", "sha", F.coalesce("findings", F.array().cast(FINDING)).alias("findings"))
