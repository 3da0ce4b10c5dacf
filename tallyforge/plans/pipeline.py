"""The whole reconciliation: words of reports to verified statements, note tables, links, checks and one final document."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions import fixed
from tallyforge.operators import audit, layout, matching, notes
from tallyforge.plans import statements
from tallyforge.sources.staging import staged
from tallyforge.sources.tokens import ANSWERS, GOLD, decisions_of


#: What a judge is told beside an item and its candidates; part of a call's key.
INSTRUCTIONS = "For each candidate row, say whether one of its amounts is the item's: its total, its opening balance, a movement in it, a part of it, or unrelated. Answer with row_id, relation, col, confidence from 0 to 1 and a short reason."


@dataclass(frozen=True)
class Config:
    """Parameters of a run. ``from_yaml`` reads a flat file of them; unknown keys are ignored."""

    summary_pages: list[int] = field(default_factory=lambda: [5, 6, 7])
    note_number: int = 11
    low_confidence_threshold: float = fixed.LOW_CONFIDENCE
    link_threshold: float = fixed.LINK_THRESHOLD
    dpi: int = 300
    pdf_path: str = ""
    ocr_cache_dir: str = "cache/ocr"
    output_dir: str = "outputs"
    control_links: str = ""
    llm_cache_dir: str = ""
    embedding_model: str = ""
    llm_model: str = ""

    @staticmethod
    def from_yaml(path: str) -> Config:
        out: dict = {}
        for line in Path(path).read_text(encoding="utf-8").splitlines():
            name, colon, value = line.partition(" #")[0].partition(":")
            name, value = name.strip(), value.strip().strip("\"'")
            if not colon or name.startswith("#") or name not in Config.__dataclass_fields__:
                continue
            kind = Config.__dataclass_fields__[name].type
            out[name] = [int(v) for v in value.strip("[]").split(",") if v.strip()] if kind.startswith("list") else {"int": int, "float": float, "str": str}[kind](value)
        return Config(**out)


@dataclass
class Result:
    statements: statements.Statements
    note: DataFrame
    blocks: DataFrame
    note_rows: DataFrame
    note_values: DataFrame
    items: DataFrame
    candidates: DataFrame
    gold: DataFrame
    requests: DataFrame
    threshold: DataFrame
    links_a: DataFrame
    links_b: DataFrame
    unanswered: DataFrame
    comparison: DataFrame
    sums: DataFrame
    links: DataFrame
    checks: DataFrame


def run(
    words: DataFrame, config: Config, gold: DataFrame | None = None, decisions: DataFrame | None = None, cell_evidence: DataFrame | None = None, rereads: DataFrame | None = None, note_evidence: DataFrame | None = None,
    n_pages: DataFrame | None = None, encode: Callable[[pd.Series], pd.Series] | None = None, answers: DataFrame | None = None, instructions: str = INSTRUCTIONS,
) -> Result:
    """All stages. Evidence that needs pixels (empty cells, second readings) and recorded answers come as tables; all are optional.

    Answers are given by item (``decisions``) or, as a cache has them, by the key of their call (``answers``); an item without one takes method A's links."""
    spark = words.sparkSession
    gold = gold if gold is not None else spark.createDataFrame([], GOLD)
    given = decisions if decisions is not None else spark.createDataFrame([], ANSWERS)
    st = statements.build(words.where(F.col("page").isin(*config.summary_pages)), cell_evidence, rereads)
    lines = staged(layout.line_texts(layout.group_lines(words)), "all-lines")
    note = staged(notes.note_pages(lines, config.note_number, n_pages), "note-pages")
    blocks, rows, values = notes.note_rows(words, note, note_evidence)
    items = staged(matching.items(st.rows, st.cells, st.pages, config.note_number), "items")
    cands = matching.candidates(items, values).join(note.select("doc", F.coalesce("title", F.lit("")).alias("note_title")), "doc")
    scored = staged(matching.score(staged(cands, "candidates"), F.col("note_title"), encode), "scored")
    threshold = staged(matching.fit_threshold(scored, gold, config.link_threshold), "threshold")
    a = staged(matching.links_a(scored, threshold, values, blocks), "links-a")
    asked = staged(matching.requests(scored, items, values, config.llm_model, instructions), "requests")
    if answers is not None:
        given = given.unionByName(decisions_of(asked, answers))
    b, silent = matching.links_b(scored, staged(given, "answers"), values, a)
    b = staged(b, "links-b")
    sums = staged(audit.note_sums(rows, values), "note-sums")
    links = staged(audit.final_links(items, a, b, values, sums, config.low_confidence_threshold), "final-links")
    checks = audit.validate(st, note, values, sums, links, config.summary_pages)
    return Result(st, note, blocks, rows, values, items, scored, gold, asked, threshold, a, b, silent, matching.compare(a, b), sums, links, checks)
