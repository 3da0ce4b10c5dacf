"""``python -m tallyforge CONFIG``: a whole run, from page files of words to the five documents and a short report.

The configuration is a flat file of ``name: value``. Paths in it are relative to its folder. Page files of words lie in ``ocr_cache_dir``; recorded answers, named by the key of their call, in ``llm_cache_dir``. What the
run would ask a judge and finds no answer for is written to ``requests`` beside the documents; put the answers into the folder and run again.
"""

from __future__ import annotations

import argparse
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tallyforge.plans import documents, pipeline
from tallyforge.sources import sinks, tokens


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict[str, str]:
    """Names of the documents written, and where."""
    args = argparse.ArgumentParser(prog="tallyforge", description=__doc__.split("\n")[0])
    args.add_argument("config")
    args.add_argument("--output", help="folder of the documents; by default output_dir of the configuration")
    said = args.parse_args(argv)
    config = pipeline.Config.from_yaml(said.config)
    root = Path(said.config).resolve().parent
    spark = spark or SparkSession.builder.appName("tallyforge").getOrCreate()
    at = lambda p: p if "://" in p else str(root / p)
    words = tokens.read_tokens(spark, at(config.ocr_cache_dir)).where(F.col("dpi") == config.dpi)
    docs = [r["doc"] for r in words.select("doc").distinct().limit(2).collect()]
    if len(docs) != 1:
        raise SystemExit(f"a run is of one report, {at(config.ocr_cache_dir)} has {len(docs) or 'none'}" + (" or more" if len(docs) > 1 else ""))
    gold = tokens.read_gold_links(spark, at(config.control_links), config.note_number, docs[0]) if config.control_links else None
    answers = tokens.read_answers(spark, at(config.llm_cache_dir)) if config.llm_cache_dir else None
    result = pipeline.run(words, config, gold, answers=answers)
    out = Path(said.output or at(config.output_dir))
    out.mkdir(parents=True, exist_ok=True)
    written = {}
    for name, df in documents.documents(result).items():
        written[name] = str(out / f"{name}.json")
        whole = sinks.write_document(df.drop("doc"), written[name])
        if name == "summary_tables":
            s = whole["summary"]
            print(f"tables: {s['tables']} with {s['rows']} rows and {s['values']} values; {s['checks_passed']} of {s['checks_total']} sum checks pass")
        elif name == "note_pages":
            print(f"note {config.note_number}: pages {whole['pages']}, confidence {whole['confidence']}")
        elif name == "note_rows":
            print(f"note rows: {len(whole.get('rows') or [])} in {len(whole.get('blocks') or [])} blocks")
        elif name == "links":
            for method, e in (whole.get("evaluation") or {}).items():
                print(f"{method}: precision {e['precision']}, recall {e['recall']}")
        else:
            v = whole["validation"]["summary"]
            print(f"links: {len(whole.get('links') or [])} kept, {len(whole.get('rejected_links') or [])} rejected; checks: {v['passed']} passed, {v['failed']} failed, {v['not_applicable']} not applicable")
            for c in whole["validation"]["checks"]:
                if c.get("passed") is False:
                    print(f"  failed: {c['check']} ({c['detail']}) {', '.join(c['items'])}")
    if result.unanswered.count():
        sinks.write_json(result.requests.join(result.unanswered, ["doc", "item_id"], "left_semi"), str(out / "requests"))
    return written


if __name__ == "__main__":
    main()
