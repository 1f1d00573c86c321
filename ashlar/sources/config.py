"""Configuration of a document family: YAML or JSON, read by Spark from any path, with defaults and required keys."""

from __future__ import annotations

import json
import os
import re
from typing import Any

from pyspark.sql import DataFrame, SparkSession

#: Keys that every configuration has, by section.
REQUIRED = ("spec", "node_types")


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, from whatever store Spark reads; None where there is no such file."""
    from pyspark.errors import AnalysisException

    try:
        row = spark.read.text(path, wholetext=True).first()
    except AnalysisException:
        return None
    return "" if row is None else row[0]


def load(spark: SparkSession, path: str, required: tuple[str, ...] = REQUIRED, defaults: dict | None = None) -> Config:
    """The configuration of a path: JSON by its ending, else YAML. A missing file has the defaults only, if there are any."""
    text = read_text(spark, path)
    if text is None:
        if defaults is None:
            raise FileNotFoundError(f"FILE_NOT_FOUND: {path}")
        return Config(dict(defaults))
    if path.endswith(".json"):
        data = json.loads(text or "{}")
    else:
        try:
            import yaml
        except ImportError as e:
            raise RuntimeError("YAML configurations need PyYAML; JSON ones don't") from e
        data = yaml.safe_load(text) or {}
    missing = [k for k in required if k not in data]
    if missing:
        raise ValueError(f"missing required keys: {', '.join(missing)}")
    return Config((defaults or {}) | data)


def env_value(spark: SparkSession, path: str, key: str) -> str | None:
    """A key's value: from the environment, else from a file of KEY=value lines; quotes about it go."""
    if key in os.environ:
        return os.environ[key]
    try:  # such files stay on the driver; Spark passes over names that begin with a dot
        with open(path) as f:
            text = f.read()
    except OSError:
        text = read_text(spark, path) or ""
    for line in text.splitlines():
        if (m := re.match(rf"\s*(?:export\s+)?{re.escape(key)}\s*=\s*(.*)$", line)) is not None:
            return m[1].strip().strip("\"'")
    return None


class Config:
    """Values by dotted path, and tables of those that operators join with."""

    def __init__(self, data: dict):
        self.data = data

    def get(self, path: str, default: Any = None) -> Any:
        at: Any = self.data
        for key in path.split("."):
            if not isinstance(at, dict) or key not in at:
                return default
            at = at[key]
        return at

    @property
    def page_offset(self) -> int:
        return int(self.get("spec.page_offset", 0))

    @property
    def chunk_words(self) -> int:
        return int(self.get("chunking.max_words", 250))

    def rules(self, node_type: str) -> list[tuple[str, str]]:
        """(pattern, type) of a node type's classification, in order."""
        return [(r["pattern"], r["type"]) for r in self.get(f"node_types.{node_type}.classification_rules", [])]

    def toc(self, kind: str) -> dict:
        """A contents list's pages, pattern and form of ids."""
        return self.get(f"toc.{kind}", {}) or {}

    def hint_list(self) -> list[dict]:
        return self.get("extraction.tables.hints", []) or []

    def hint(self, title: str) -> dict | None:
        """The first hint whose pattern is found in a title, without regard to case."""
        return next((h for h in self.hint_list() if h.get("match_title") and re.search(h["match_title"], title, re.IGNORECASE)), None)

    @staticmethod
    def _columns(hint: dict) -> dict[str, list[str]]:
        roles = {"bit_range": "bits", "field_name": "name"}
        return {roles.get(c["role"], c["role"]): list(c.get("names", [])) for c in hint.get("expected_columns", [])}

    def hint_columns(self, title: str) -> dict[str, list[str]]:
        """The words of each role's column in the title's hint."""
        return self._columns(self.hint(title) or {})

    def hints(self, spark: SparkSession) -> DataFrame:
        """(match_title, columns, ord): as hints_of_tables() takes them."""
        rows = [(h.get("match_title"), list(self._columns(h).items()), i) for i, h in enumerate(self.hint_list())]
        return spark.createDataFrame(rows, "match_title string, columns array<struct<role:string,names:array<string>>>, ord long")

    @property
    def exclude_tables(self) -> list[str]:
        return self.get("domain.registers.exclude_tables", []) or []

    def multi_page(self, what: str = "tables") -> dict:
        """Whether items go over several pages, and over how many before and after."""
        return {"enabled": False, "max_pages_before": 0, "max_pages_after": 0} | (self.get(f"extraction.{what}.multi_page", {}) or {})

    def enabled(self, node_type: str) -> bool:
        return bool(self.get(f"node_types.{node_type}.enabled", False))

    def validation_rules(self, what: str) -> dict[str, dict]:
        """The rules (check: its other settings) of what is checked; none where validation or this part of it is off. A severity that is not given is an error's
        where a rule has a limit, else a warning's."""
        part = self.get(f"validation.checks.{what}", {}) or {}
        if not (self.get("validation.enabled", False) and part.get("enabled", False)):
            return {}
        return {r["check"]: {"severity": "error" if "max_chars" in r else "warning"} | {k: v for k, v in r.items() if k != "check"} for r in part.get("rules", []) or []}

    def folder(self, name: str) -> str:
        """A folder below the configuration's root."""
        return os.path.join(str(self.get("paths.root", ".")), str(self.get(f"paths.{name}", name)))

    def _table(self, spark: SparkSession, rows: list[dict], fields: dict[str, str]) -> DataFrame:
        schema = ", ".join(f"{k} {v}" for k, v in fields.items()) + ", ord long"
        return spark.createDataFrame([(*(r.get(k) for k in fields), i) for i, r in enumerate(rows or [])], schema)

    def classes(self, spark: SparkSession) -> DataFrame:
        rows = self.get("domain.registers.classes", [])
        return self._table(spark, rows, {"id": "string", "name": "string", "address_start": "string", "address_end": "string", "table_1_1_name": "string"})

    def offsets(self, spark: SparkSession) -> DataFrame:
        """(offset, name, table_id, spec_section, ord) out of a map from offsets to what is known of their registers."""
        rows = [{"offset": k, "name": v.get("name"), "table_id": v.get("table"), "spec_section": v.get("section", "")} for k, v in (self.get("domain.registers.register_offsets", {}) or {}).items()]
        return self._table(spark, rows, {"offset": "string", "name": "string", "table_id": "string", "spec_section": "string"})

    def features(self, spark: SparkSession) -> DataFrame:
        lists = {k: "array<string>" for k in ("groups", "figures", "tables", "registers", "spec_sections")}
        rows = [r | {"parent_id": r.get("parent_id", r.get("parent"))} for r in self.get("domain.features.definitions", []) or []]
        return self._table(spark, rows, {"id": "string", "name": "string", "description": "string", "priority": "string", "parent_id": "string"} | lists)

    def sequences(self, spark: SparkSession) -> DataFrame:
        lists = {k: "array<string>" for k in ("groups", "figures", "tables", "spec_sections", "uses_features")}
        rows = self.get("domain.features.hd_sequences", [])
        return self._table(spark, rows, {"id": "string", "name": "string", "description": "string", "priority": "string", "parent_id": "string", "primary_section": "string"} | lists)
