"""The numbers that are published for one real report, on its recorded words. TALLYFORGE_GOLDEN names a JSON file that says where they lie:
{"words": folder of page files, "gold": file, "answers": folder, "items": {answer file without suffix: item}, "rereads": [[page, row, column, text, conf], ...]}."""

import json
import os

import pytest

from tallyforge.operators import matching
from tallyforge.plans import pipeline, statements
from tallyforge.sources import tokens

WHERE = os.environ.get("TALLYFORGE_GOLDEN")


@pytest.mark.skipif(not WHERE, reason="TALLYFORGE_GOLDEN isn't set")
def test_published_numbers(spark):
    at = json.loads(open(WHERE).read())
    words = tokens.read_tokens(spark, at["words"])
    doc = words.first()["doc"]
    gold = tokens.read_gold_links(spark, at["gold"], 11, doc)
    answers = tokens.read_decisions(spark, at["answers"], {k: (doc, v) for k, v in at["items"].items()})
    rereads = spark.createDataFrame([(doc, *r) for r in at["rereads"]], "doc string, page int, row_idx int, col_idx int, text string, conf double")
    r = pipeline.run(words, pipeline.Config(), gold, answers, rereads=rereads)
    s = statements.summary(r.statements).first()
    assert (s["tables"], s["rows"], s["values"], s["checks_passed"], s["checks_total"]) == (3, 76, 152, 40, 40)
    n = r.note.first()
    assert (n["pages"], n["printed_pages"], n["page_offset"], n["start"]["y"], n["end"]["y"], n["confidence"]) == ([53, 54], [49, 50], 4, 463.0, None, 0.9897)
    assert (r.note_rows.count(), r.blocks.count(), r.sums.where("passed").count(), r.sums.count()) == (19, 4, 11, 11)
    assert sorted(c["count"] for c in r.candidates.groupBy("item_id").count().collect()) == [9, 10, 10, 10]
    a, b = matching.evaluate(r.links_a, gold).first(), matching.evaluate(r.links_b, gold).first()
    assert (a["precision"], a["recall"], b["precision"], b["recall"]) == (1.0, 1.0, 1.0, 0.75)
    assert {c["verdict"]: c["count"] for c in r.comparison.groupBy("verdict").count().collect()} == {"both_same_relation": 12, "only_a": 4}
    assert {c["status"]: c["count"] for c in r.links.groupBy("status").count().collect()} == {"accepted": 16}
    assert [c["passed"] for c in r.checks.collect()] == [True] * 12
