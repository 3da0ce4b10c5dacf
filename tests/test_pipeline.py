import json
from datetime import date

import pytest
from pyspark.sql import functions as F
from reports import Report, report

from tallyforge.operators import audit, layout, matching, notes
from tallyforge.__main__ import main
from tallyforge.plans import documents, pipeline, statements
from tallyforge.sources import sinks, tokens
from tallyforge.streaming import tokens as stream


@pytest.fixture(scope="module")
def result(spark):
    gold = spark.createDataFrame([("acme", "p2_r04:v0", "n11_p7_r03", "equals_total"), ("acme", "p2_r04:v1", "n11_p7_r01", "equals_opening_balance")], tokens.GOLD)
    answers = spark.createDataFrame([("acme", "p2_r04:v0", 0, "n11_p7_r03", "equals_total", 2, 0.95, "same"), ("acme", "p2_r04:v0", 1, "n11_p7_r02", "unrelated", -1, 0.9, "flow"), ("acme", "p2_r04:v0", 2, "n11_p7_r99", "equals_total", 0, 0.9, "unknown row")], tokens.ANSWERS)
    return pipeline.run(report().frame(spark), pipeline.Config(summary_pages=[2, 3], note_number=11), gold, answers), gold


def test_statements(result):
    st = result[0].statements
    pages = {r["page"]: r for r in st.pages.collect()}
    assert (pages[2]["statement_type"], pages[2]["currency"], pages[2]["unit_scale"], pages[2]["company"]) == ("balance_sheet", "TRY", 1, "ACME A.Ş.")
    cols = {(r["page"], r["col_id"]): r for r in st.columns.collect()}
    assert cols[2, "v0"]["period"]["end"] == date(2012, 12, 31) and cols[2, "v0"]["role"] == "current" and cols[2, "v1"]["role"] == "prior"
    rows = {(r["page"], r["row_idx"]): r for r in st.rows.collect()}
    assert rows[2, 4]["note_refs"] == [11] and rows[2, 4]["note_repaired"] and "note_ref_repaired" in rows[2, 4]["flags"]
    assert rows[3, 1]["label"] == "Uzun adı olan borçlar ve diğerleri" and "wrapped_label_merged" in rows[3, 1]["flags"]
    assert [rows[2, i]["indent"] for i in range(6)] == [0, 1, 1, 0, 1, 0]
    assert rows[2, 0]["children"] == [1, 2] and rows[2, 3]["children"] == [4]
    checks = st.checks.collect()
    assert len(checks) == 12 and all(c["passed"] for c in checks)
    s = statements.summary(st).first()
    assert (s["tables"], s["rows"], s["values"], s["checks_passed"], s["checks_total"]) == (2, 12, 24, 12, 12)


def test_note(result):
    n = result[0].note.first()
    assert (n["pages"], n["printed_pages"], n["page_offset"], n["flags"]) == ([7], [6], 1, [])
    assert n["title"] == "DEPO VE AMBAR BİNALARI" and n["confidence"] == 1.0
    assert [r["row_id"] for r in result[0].note_rows.orderBy("row_no").collect()] == ["n11_p7_r01", "n11_p7_r02", "n11_p7_r03"]
    v = {(r["row_id"][-2:], r["col"]): r for r in result[0].note_values.collect()}
    assert v["01", 2]["header"] == "Toplam" and v["01", 2]["period"]["date"] == date(2012, 1, 1)
    assert v["02", 0]["period"]["source"] == "block" and v["02", 0]["period"]["year"] == 2012


def test_links(result):
    r, gold = result
    assert r.items.count() == 2
    cands = {(c["item_id"], c["note_row"]): c for c in r.candidates.collect()}
    assert cands["p2_r04:v0", "n11_p7_r03"]["col"] == 2 and cands["p2_r04:v0", "n11_p7_r03"]["period_match"] == 1.0
    assert cands["p2_r04:v1", "n11_p7_r01"]["period_match"] == 0.8
    a = {(x["item_id"], x["note_row"]): x["relation"] for x in r.links_a.collect()}
    assert a == {("p2_r04:v0", "n11_p7_r03"): "equals_total", ("p2_r04:v1", "n11_p7_r01"): "equals_opening_balance"}
    b = {(x["item_id"], x["method"]) for x in r.links_b.collect()}
    assert b == {("p2_r04:v0", "B"), ("p2_r04:v1", "A_fallback")}
    e = matching.evaluate(r.links_a, gold, ["item_id", "note_row"]).first()
    assert (e["precision"], e["recall"], e["f1"], e["relation_accuracy"], e["n_missed"]) == (1.0, 1.0, 1.0, 1.0, 0)
    assert matching.errors(r.links_a, gold).count() == 0 and {x["error"] for x in matching.errors(r.links_a.where("item_id like '%v1'"), gold).collect()} == {"missed"}
    assert {x["status"] for x in r.links.collect()} == {"accepted"}
    assert {(x["found_by"]) for x in r.links.collect()} == {"A+B"}


def test_checks_and_document(result, tmp_path):
    checks = {c["check"]: c["passed"] for c in result[0].checks.collect()}
    assert len(checks) == 12 and all(v is True for v in checks.values()), checks
    path, all_ = tmp_path / "final.json", documents.documents(result[0])
    assert tuple(all_) == documents.NAMES
    document = sinks.write_document(all_["final_output"].drop("doc"), str(path))
    assert json.loads(path.read_text()) == document and len(document["validation"]["checks"]) == 12 and document["validation"]["summary"] == {"passed": 12, "failed": 0, "not_applicable": 0}
    assert set(document) == {"document", "summary_tables", "note", "links", "validation", "method_comparison", "low_confidence"}
    tables = document["summary_tables"]["tables"]
    assert [t["table_id"] for t in tables] == ["p2_balance_sheet", "p3_balance_sheet"] and tables[0]["rows"][1]["parent_id"] == "p2_r00" and tables[0]["rows"][0]["children"] == ["p2_r01", "p2_r02"]
    assert tables[0]["rows"][4]["values"][0]["value"] == 500000.0 and tables[0]["rows"][4]["note_refs"] == [11] and len(tables[0]["checks"]) + len(tables[1]["checks"]) == 12
    assert document["document"] == {"file": "acme", "company": "ACME A.Ş.", "period_end": "2012-12-31", "currency": "TRY"}
    assert [len(b["row_ids"]) for b in document["note"]["blocks"]] == [3] and len(document["note"]["rows"]) == 3 and document["note"]["rows"][0]["values"][2]["header"] == "Toplam"
    linked = sinks.write_document(all_["links"].drop("doc"), str(path))
    assert linked["evaluation"]["method_a"]["recall"] == 1.0 and linked["method_b"]["unanswered"] == ["p2_r04:v1"] and len(linked["candidates"]) == result[0].candidates.count()
    sums = {(tuple(s["component_rows"]), s["passed"]) for s in result[0].sums.collect()}
    assert sums == {(("n11_p7_r01", "n11_p7_r02"), True)}


def test_note_without_heading(spark):
    r = report()
    r.rows = [x for x in r.rows if x[1] != 7]
    found = notes.note_pages(layout.line_texts(layout.group_lines(r.frame(spark))), 11).first()
    assert (found["pages"], found["flags"], found["confidence"]) == ([7], ["heading_not_found", "pages_from_toc_only"], 0.3)
    none = notes.note_pages(layout.line_texts(layout.group_lines(r.frame(spark))), 29).first()
    assert (none["pages"], none["confidence"]) == ([], 0.0)


def test_lines(spark):
    r = Report()
    r.line(1, 100, (0, 10, "a"))
    r.line(1, 118, (20, 30, "b"))
    r.line(1, 200, (0, 10, "c"))
    assert [x["text"] for x in layout.line_texts(layout.group_lines(r.frame(spark))).orderBy("line_no").collect()] == ["a b", "c"]


def test_breakdown(spark):
    values = spark.createDataFrame([("d", f"r{i}", "b", 0, "number", v, (date(2012, 12, 31), 2012, "header")) for i, v in enumerate([10.0, 20.0, 30.0])], "doc string, row_id string, block_id string, col int, kind string, value double, period struct<date:date,year:int,source:string>")
    blocks = spark.createDataFrame([("d", "b", ["r0", "r1", "r2"])], "doc string, block_id string, row_ids array<string>")
    links = spark.createDataFrame([("d", "i", "r2", 0, 30.0, "equals_total", 0.9, "A")], "doc string, item_id string, note_row string, col int, value double, relation string, score double, method string")
    assert {(x["note_row"], x["relation"]) for x in matching.breakdown_links(links, values, blocks).collect()} == {("r0", "breakdown_component"), ("r1", "breakdown_component")}


def test_sources(spark, tmp_path):
    words = [{"text": "a", "conf": 0.5, "x0": 1, "y0": 2, "x1": 3, "y1": 4}, {"text": "b", "conf": 0.6, "x0": 5, "y0": 2, "x1": 7, "y1": 4}]
    (tmp_path / "abc_p001_300dpi.json").write_text(json.dumps({"page": 1, "dpi": 300, "tokens": words}, indent=1))
    got = tokens.read_tokens(spark, str(tmp_path)).orderBy("pos").collect()
    assert [(r["doc"], r["page"], r["pos"], r["text"]) for r in got] == [("abc", 1, 0, "a"), ("abc", 1, 1, "b")]
    assert tokens.read_gold_links(spark, str(tmp_path / "none.json"), 11, "d").count() == 0
    (tmp_path / "gold.json").write_text(json.dumps({"_comment": "x", "11": [{"summary_row": "p1_r01", "col": "v0", "note_row": "n", "relation": "equals_total"}]}))
    assert [tuple(r) for r in tokens.read_gold_links(spark, str(tmp_path / "gold.json"), 11, "d").collect()] == [("d", "p1_r01:v0", "n", "equals_total")]
    (tmp_path / "answers").mkdir()
    (tmp_path / "answers" / "k1.json").write_text(json.dumps({"decisions": [{"row_id": "r", "relation": "unrelated", "col": -1, "confidence": 0.1, "reason": ""}]}))
    assert tokens.read_decisions(spark, str(tmp_path / "answers"), {"k1": ("d", "item")}).first()["item_id"] == "item"
    assert tokens.read_answers(spark, str(tmp_path / "no such folder")).count() == 0
    box = tokens.from_polygons(spark.createDataFrame([([[1, 2], [3, 2], [3, 5], [1, 5]],)], "p array<array<int>>"), "p").first()
    assert (box["x0"], box["y0"], box["x1"], box["y1"]) == (1.0, 2.0, 3.0, 5.0)
    assert spark.range(1).select(tokens.cache_key(F.lit("m"), F.lit("q")).alias("k")).first()["k"].__len__() == 16
    (tmp_path / "c.yaml").write_text('note_number: 7 # x\nsummary_pages: [1, 2]\nlink_threshold: 0.5\nother: "y"\n')
    assert pipeline.Config.from_yaml(str(tmp_path / "c.yaml")) == pipeline.Config([1, 2], 7, 0.7, 0.5)
    (tmp_path / "d.yaml").write_text('# all of them\npdf_path: "a b.pdf"\ndpi: 200\nocr_cache_dir: o\noutput_dir: p\ncontrol_links: q\nllm_cache_dir: r\nembedding_model: s\nllm_model: t # u\nlow_confidence_threshold: 0.6\n')
    assert pipeline.Config.from_yaml(str(tmp_path / "d.yaml")) == pipeline.Config(low_confidence_threshold=0.6, dpi=200, pdf_path="a b.pdf", ocr_cache_dir="o", output_dir="p", control_links="q", llm_cache_dir="r", embedding_model="s", llm_model="t")


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "d_p001_300dpi.json").write_text(json.dumps({"page": 1, "dpi": 300, "tokens": [{"text": "a", "conf": 0.5, "x0": 1, "y0": 2, "x1": 3, "y1": 4}]}))
    q = stream.lines_to(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert [r["text"] for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["a"]


def two_reports(spark):
    """Equal reports but for the amounts of the second, which are one lower."""
    first, second = report("one"), report("two")
    lower = {"500.000": "499.999", "400.000": "399.999", "350.000": "349.999", "300.000": "299.999"}
    second.rows = [(*r[:4], lower.get(r[4], r[4]), *r[5:]) for r in second.rows]
    return first.frame(spark).unionByName(second.frame(spark))


def test_two_reports(spark):
    """Equal item ids of two reports have gold, thresholds, answers, fallbacks and links of their own."""
    gold = spark.createDataFrame([("one", "p2_r04:v0", "n11_p7_r03", "equals_total")], tokens.GOLD)
    answers = spark.createDataFrame([("one", "p2_r04:v0", 0, "n11_p7_r03", "equals_total", 2, 0.95, "same"), ("two", "p2_r04:v1", 0, "n11_p7_r01", "equals_opening_balance", 2, 0.9, "open")], tokens.ANSWERS)
    r = pipeline.run(two_reports(spark), pipeline.Config(summary_pages=[2, 3], note_number=11), gold, answers)
    assert {(t["doc"], t["source"]) for t in r.threshold.collect()} == {("one", "control_examples"), ("two", "config_default")}
    b = {(x["doc"], x["item_id"], x["method"], x["value"]) for x in r.links_b.collect()}
    assert {x for x in b if x[2] == "B"} == {("one", "p2_r04:v0", "B", 500000.0), ("two", "p2_r04:v1", "B", 399999.0)}
    assert {x[:2] for x in b if x[2] == "A_fallback"} <= {("one", "p2_r04:v1"), ("two", "p2_r04:v0")} and {(x["doc"], x["item_id"]) for x in r.unanswered.collect()} == {("one", "p2_r04:v1"), ("two", "p2_r04:v0")}
    assert {(x["doc"], x["value"]) for x in r.links.where("item_id = 'p2_r04:v0' and note_row like '%r03'").collect()} <= {("one", 500000.0), ("two", 499999.0)}
    assert matching.evaluate(r.links_b, gold, by=["doc"]).where("doc = 'one'").first()["recall"] == 1.0
    assert {d["doc"] for d in documents.documents(r)["final_output"].collect()} == {"one", "two"}


def test_command_line(spark, tmp_path, capsys):
    """Page files and gold in, five documents out; what has no answer is asked for, and an answer is found by the key of its call."""
    by_page = {}
    for doc, page, dpi, _pos, said, conf, x0, y0, x1, y1 in report().rows:
        by_page.setdefault(page, {"page": page, "dpi": dpi, "tokens": []})["tokens"].append({"text": said, "conf": conf, "x0": x0, "y0": y0, "x1": x1, "y1": y1})
    (tmp_path / "pages").mkdir()
    for page, data in by_page.items():
        (tmp_path / "pages" / f"acme_p{page:03d}_300dpi.json").write_text(json.dumps(data))
    (tmp_path / "gold.json").write_text(json.dumps({"11": [{"summary_row": "p2_r04", "col": "v0", "note_row": "n11_p7_r03", "relation": "equals_total"}]}))
    (tmp_path / "c.yaml").write_text("summary_pages: [2, 3]\nnote_number: 11\nocr_cache_dir: pages\noutput_dir: out\ncontrol_links: gold.json\nllm_cache_dir: answers\nllm_model: some-judge\n")
    written = main([str(tmp_path / "c.yaml")], spark)
    assert tuple(written) == documents.NAMES and "12 of 12 sum checks pass" in capsys.readouterr().out
    asked = {r["item_id"]: r for r in spark.read.json(str(tmp_path / "out" / "requests")).collect()}
    assert set(asked) == {"p2_r04:v0", "p2_r04:v1"}
    payload = json.loads(asked["p2_r04:v0"]["payload"])
    assert payload["item"]["value"] == 500000.0 and {c["row_id"] for c in payload["candidates"]} <= {"n11_p7_r01", "n11_p7_r02", "n11_p7_r03"} and payload["candidates"][0]["amounts"][2]["header"] == "Toplam"
    (tmp_path / "answers").mkdir()
    (tmp_path / "answers" / f"{asked['p2_r04:v0']['key']}.json").write_text(json.dumps({"decisions": [{"row_id": "n11_p7_r03", "relation": "equals_total", "col": 2, "confidence": 0.9, "reason": "same"}]}))
    found = tokens.decisions_of(spark.read.json(str(tmp_path / "out" / "requests")), tokens.read_answers(spark, str(tmp_path / "answers"))).collect()
    assert [(r["doc"], r["item_id"], r["row_id"], r["col"]) for r in found] == [("acme", "p2_r04:v0", "n11_p7_r03", 2)]


def test_contents(spark):
    """Entries over several lines, bare titles, repeated notes and lines of no note."""
    said = ["İÇİNDEKİLER", "NOT 1 NAKİT ..... 5", "NOT 2 UZUN ADI OLAN", "BAŞLIK VE", "DEVAMI ... 7-9", "9", "NOT 3 SAYFASIZ", "NOT 3 SAYFALI 11", "NOT 4 BAŞLIK", "NOTLAR", "NOT 1 SONRAKİ 12", "NOT 5 İLK", "NOT 5 İKİNCİ", "NOT 6 SON"]
    lines = spark.createDataFrame([("d", 1, i, t) for i, t in enumerate(said)], "doc string, page int, line_no int, text string")
    got = {r["note_no"]: (r["title"], r["first"], r["last"]) for r in notes.contents(lines).collect()}
    assert got == {1: ("SONRAKİ", 12, 12), 2: ("UZUN ADI OLAN BAŞLIK VE DEVAMI", 7, 9), 3: ("SAYFALI", 11, 11), 4: ("BAŞLIK", None, None), 5: ("İLK", None, None)}


def test_subtree_sizes(spark):
    """A deep chain, a wide tree and two documents with equal node names; a cycle is refused."""
    edges = [("a", i, i + 1) for i in range(12)] + [("b", 0, i) for i in range(1, 40)] + [("b", 1, 100)]
    got = {(r["doc"], r["node"]): r["size"] for r in audit.subtree_sizes(spark.createDataFrame(edges, "doc string, parent int, child int")).collect()}
    assert got["a", 0] == 13 and got["a", 12] == 1 and got["b", 0] == 41 and got["b", 1] == 2 and len(got) == 13 + 41
    audit.MAX_DEPTH, old = 4, audit.MAX_DEPTH
    with pytest.raises(ValueError, match="cycle"):
        audit.subtree_sizes(spark.createDataFrame([("a", 1, 2), ("a", 2, 1)], "doc string, parent int, child int"))
    audit.MAX_DEPTH = old
