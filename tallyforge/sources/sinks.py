"""Sinks: JSON by Spark's writers, and one pretty document where a single file is asked for."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines, null fields kept, written in parallel."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_document(df: DataFrame, path: str) -> dict:
    """The only row of ``df`` as an indented UTF-8 document; meant for one report's result, not for data."""
    row = df.toJSON().take(2)
    if len(row) != 1:
        raise ValueError(f"a document is one row, not {len(row)}")
    document = json.loads(row[0])
    Path(path).write_text(json.dumps(document, ensure_ascii=False, indent=2), encoding="utf-8")
    return document
