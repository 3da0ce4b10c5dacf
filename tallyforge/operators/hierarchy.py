"""Totals and their parts, found by arithmetic over all amount columns.

The solver is a state machine whose links take effect within the pass that finds them, so it runs as a function of one whole table; a
table is a page's rows, never the corpus. Its checks come out as rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions import fixed


@dataclass
class Row:
    label: str
    nums: list[float | None]
    kinds: list[str]
    indent: int = 0
    decimal: bool = False
    parent: int | None = None
    children: list[int] = field(default_factory=list)
    row_type: str = "item"
    repeated_only: bool = False

    @property
    def vector(self) -> list[float] | None:
        """Amounts by column; none if the row is decimal, or has no amount other than zero."""
        return None if self.decimal or not any(self.nums) else [n or 0 for n in self.nums]


@dataclass
class Check:
    relation: str
    column: int
    parent: int
    parts: list[int]
    expected: float
    computed: float

    @property
    def passed(self) -> bool:
        return abs(self.expected - self.computed) <= fixed.SUM_TOLERANCE


class Solver:
    """Rows of one table, in order. ``solve`` sets parents, children and row types and returns the checks."""

    def __init__(self, rows: list[Row]) -> None:
        self.rows, self.checks = rows, []
        self.vectors = [r.vector for r in rows]

    def solve(self) -> list[Check]:
        order = range(len(self.rows))
        for t in order:
            kids = self._below(t)
            if kids and self._equal(t, self._sum(kids)):
                self._link(t, kids, "parent", "sum_of_following")
        for t in order[:-1]:
            after = self.rows[t + 1]
            if self.vectors[t] and self.vectors[t + 1] and after.label and after.parent is None and not self.rows[t].children and self._equal(t, self.vectors[t + 1]):
                self._link(t, [t + 1], "parent", "single_component")
        self._totals()
        for t in order:
            kids = [k for k in self._below(t) if self.rows[k].parent is None] if not self.rows[t].children else []
            if kids:
                self._link(t, kids, "parent", "sum_of_following_unconfirmed")
        self._totals()
        for r in self.rows:
            if r.label and not r.decimal and all(k == "empty" for k in r.kinds):
                r.row_type = "section_header"
        return self.checks

    def _sum(self, parts: list[int]) -> list[float]:
        return [sum(c) for c in zip(*(self.vectors[p] for p in parts), strict=True)]

    def _equal(self, t: int, other: list[float]) -> bool:
        return all(abs(a - b) <= fixed.SUM_TOLERANCE for a, b in zip(self.vectors[t], other, strict=True))

    def _below(self, t: int) -> list[int]:
        """The least indented of the rows with amounts that stand indented under row t."""
        own = self.rows[t].indent
        if self.vectors[t] is None or own < 0:
            return []
        stop = next((k for k in range(t + 1, len(self.rows)) if 0 <= self.rows[k].indent <= own), len(self.rows))
        inside = [k for k in range(t + 1, stop) if self.vectors[k] is not None and self.rows[k].indent >= 0]
        top = min((self.rows[k].indent for k in inside), default=0)
        return [k for k in inside if self.rows[k].indent == top]

    def _prefix(self, t: int, order: range) -> list[int] | None:
        """The shortest run of two or more free rows, nearest first, that adds up to row t."""
        free = (i for i in order if self.vectors[i] is not None and self.rows[i].parent is None and self.rows[i].label != "")
        taken, running = [], [0.0] * len(self.vectors[t])
        for i in islice(free, fixed.PREFIX_BOUND):
            taken.append(i)
            running = [a + b for a, b in zip(running, self.vectors[i], strict=True)]
            if len(taken) > 1 and self._equal(t, running):
                return sorted(taken)
        return None

    def _totals(self) -> None:
        again = True
        while again:
            again = False
            for t, row in enumerate(self.rows):
                if self.vectors[t] is None or (row.children and not row.repeated_only):
                    continue
                before = self._prefix(t, range(t - 1, -1, -1))
                parts = before or self._prefix(t, range(t + 1, len(self.rows)))
                if parts:
                    self._link(t, parts, *(("total", "sum_of_preceding") if before else ("parent", "sum_of_following")))
                    again = True

    def _link(self, parent: int, parts: list[int], row_type: str, relation: str) -> None:
        top = self.rows[parent]
        top.row_type, top.repeated_only = row_type, relation == "single_component"
        top.children = [*top.children, *parts]
        for p in parts:
            self.rows[p].parent = parent
        self.checks += [Check(relation, c, parent, parts, e, s) for c, (e, s) in enumerate(zip(self.vectors[parent], self._sum(parts), strict=True))]


ROWS = "row_idx int, parent int, children array<int>, row_type string"
_SOLVED = pa.list_(pa.struct({
    "row_idx": pa.int32(), "parent": pa.int32(), "children": pa.list_(pa.int32()), "row_type": pa.string(),
    "checks": pa.list_(pa.struct({"relation": pa.string(), "column": pa.int32(), "parent_row": pa.int32(), "component_rows": pa.list_(pa.int32()), "expected": pa.float64(), "computed": pa.float64(), "difference": pa.float64(), "passed": pa.bool_()})),
}))
CHECKS = "relation string, column int, parent_row int, component_rows array<int>, expected double, computed double, difference double, passed boolean"


def solve_tables(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` (keys, row_idx, label, nums array<double>, kinds array<string>, indent, decimal) to one row a table row, with the checks of which it's the parent.

    All amounts of a table row are in column order; rows of a table may differ in length and count as empty beyond it. A table is gathered as one
    nested row (it's a printed table, so it's small) and tables are solved a batch at a time.
    """
    kinds = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)
    solved = f"array<struct<{ROWS.replace(' ', ':').replace(',:', ',')},checks:array<struct<{CHECKS.replace(' ', ':').replace(',:', ',')}>>>>"
    fields = ("row_idx", "label", "nums", "kinds", "indent", "decimal")
    packed = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("__table"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array([_solve(t) for t in batch.column("__table").to_pylist()], _SOLVED)], names=[*keys, "__solved"])

    return packed.mapInArrow(run, f"{kinds}, __solved {solved}").select(*keys, F.explode("__solved").alias("__s")).select(*keys, "__s.*")


def _solve(table: list[dict]) -> list[dict]:
    """A table's rows as solved, with each row's checks."""
    width = max((len(r["nums"]) for r in table), default=0)
    pad = lambda xs, fill: [*xs, *[fill] * (width - len(xs))]
    rows = [Row(r["label"] or "", pad(r["nums"], None), pad(r["kinds"], "empty"), r["indent"], bool(r["decimal"])) for r in table]
    idx = [r["row_idx"] for r in table]
    mine: dict[int, list[dict]] = {}
    for c in Solver(rows).solve():
        mine.setdefault(c.parent, []).append({"relation": c.relation, "column": c.column, "parent_row": idx[c.parent], "component_rows": [idx[p] for p in c.parts], "expected": c.expected, "computed": c.computed, "difference": c.expected - c.computed, "passed": c.passed})
    return [{"row_idx": i, "parent": None if r.parent is None else idx[r.parent], "children": [idx[c] for c in r.children], "row_type": r.row_type, "checks": mine.get(n, [])} for n, (i, r) in enumerate(zip(idx, rows, strict=True))]


def checks_of(solved: DataFrame, keys: list[str]) -> DataFrame:
    """The checks of ``solve_tables`` as rows."""
    return solved.select(*keys, F.explode("checks").alias("c")).select(*keys, "c.*")


def arithmetic_ok(checks: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, row_idx, column, arithmetic_ok): whether all checks that a cell takes part in pass."""
    member = F.explode(F.concat(F.array("parent_row"), "component_rows"))
    return checks.select(*keys, "column", "passed", member.alias("row_idx")).groupBy(*keys, "row_idx", "column").agg(F.bool_and("passed").alias("arithmetic_ok"))


def sum_checks(parents: DataFrame, parts: DataFrame, keys: list[str], expected: str, amount: str, tolerance: float = fixed.SUM_TOLERANCE) -> DataFrame:
    """Relational form for tables of any size: does each parent's amount equal the sum of its parts?"""
    total = parts.groupBy(*keys).agg(F.sum(F.col(amount).cast("decimal(18,2)")).cast("double").alias("computed"), F.count("*").alias("n_parts"))
    diff = F.round(F.col(expected) - F.col("computed"), 2)
    return parents.join(total, keys).select(*keys, F.col(expected).alias("expected"), "computed", "n_parts", diff.alias("difference"), (F.abs(diff) <= tolerance).alias("passed"))
