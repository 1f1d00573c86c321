"""Command line: `python -m ashlar.cli GRAPH FUNCTION key=value ...` answers a catalogue query as JSON; `status PATH` lists artefacts.

Exit code 0 for success, 1 for an error."""

from __future__ import annotations

import json
import sys

from pyspark.sql import SparkSession

from .plans.catalog import GraphCatalog
from .sources import export
from .sources.graph import read_graph


def value(text: str):
    """true, false, none and whole numbers by their meaning, a comma list in brackets, else the text."""
    low = text.lower()
    if low in ("true", "false", "none"):
        return {"true": True, "false": False, "none": None}[low]
    if text.lstrip("-").isdigit():
        return int(text)
    if text.startswith("[") and text.endswith("]"):
        return [x.strip() for x in text[1:-1].split(",") if x.strip()]
    return text


def arguments(words: list[str]) -> dict:
    bad = [w for w in words if "=" not in w]
    if bad:
        raise ValueError(f"INVALID_PARAM: {bad[0]} is no key=value")
    return {k: value(v) for k, v in (w.split("=", 1) for w in words)}


def run(spark: SparkSession, words: list[str], out=print) -> int:
    if len(words) == 2 and words[0] == "status":
        for r in export.files(spark, words[1]).orderBy("path").toLocalIterator():
            out(f"{r['length']:>12} {r['path']}")
        return 0
    if len(words) < 2:
        out("usage: GRAPH FUNCTION [key=value ...] | GRAPH functions | status PATH")
        return 1
    catalogue = GraphCatalog(*read_graph(spark, words[0]))
    if words[1] == "functions":
        out("\n".join(catalogue.functions()))
        return 0
    plan = "--plan" in words  # a dry run: the plan of the query, without an action
    try:
        params = arguments([w for w in words[2:] if w != "--plan"])
    except ValueError as e:
        out(str(e))
        return 1
    if plan:
        getattr(catalogue, words[1])(**params).explain("formatted")
        return 0
    answer = catalogue.call(words[1], **params)
    out(json.dumps(answer, default=str, ensure_ascii=False, indent=2))
    return 0 if answer["success"] else 1


def main() -> int:
    spark = SparkSession.builder.appName("ashlar").getOrCreate()
    try:
        return run(spark, sys.argv[1:])
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
