"""Model responses to results: exact JSON semantics in Arrow-batched Python, the rest native."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quirework.functions import rules
from quirework.functions.text import override_platform, slug, strip_fence

GENERATED = "ok boolean, error string, decision string, kb_type string, kb_filename string, kb_content string, skip_reason string"
PROBLEM = "struct<category:string,claim:string,issue:string,severity:string>"
VERIFIED = f"ok boolean, error string, decision string, problems array<{PROBLEM}>"


def load_object(text: str) -> tuple[dict | None, str | None]:
    """The JSON object of a text without its fence; else of what lies between its outermost braces."""
    try:
        data = json.loads(text)
    except ValueError:
        inner = re.search(r"\{.*\}", text, re.DOTALL)
        if not inner:
            return None, rules.NO_OBJECT
        try:
            data = json.loads(inner[0])
        except ValueError as e:
            return None, f"{rules.BAD_JSON}{e}"
    return (data, None) if isinstance(data, dict) else (None, rules.NOT_AN_OBJECT)


def _text(x: object) -> str | None:
    return x if x is None or isinstance(x, str) else json.dumps(x)


def read_generated(text: str) -> dict:
    data, error = load_object(text)
    if data is not None:
        if "decision" not in data:
            error = rules.NO_DECISION
        elif data["decision"] not in ("generate", "skip"):
            error = f"{rules.BAD_DECISION}{data['decision']}"
        elif data["decision"] == "generate":
            error = next((f"Missing {k} for generate decision" for k in ("kb_filename", "kb_content") if not data.get(k)), None)
    if error:
        return {"ok": False, "error": error}
    return {"ok": True, "error": None} | {k: _text(data.get(k)) for k in ("decision", "kb_type", "kb_filename", "kb_content", "skip_reason")}


def read_problem(p: object) -> dict:
    """A problem as it is, with defaults; what isn't an object becomes one that says so."""
    if isinstance(p, dict):
        given = {"category": "unknown", "claim": "", "issue": "", "severity": "minor"} | p
        return {k: _text(given[k]) for k in ("category", "claim", "issue", "severity")}
    issue = p if isinstance(p, str) else f"{rules.BAD_PROBLEM}{type(p).__name__}"
    return {"category": rules.MALFORMED_CATEGORY, "claim": "", "issue": issue, "severity": "minor"}


def read_verified(text: str) -> dict:
    data, error = load_object(text)
    if data is not None:
        if "decision" not in data:
            error = rules.NO_DECISION
        elif data["decision"] not in ("PASS", "FLAG"):
            error = f"{rules.BAD_DECISION}{data['decision']}"
        elif not isinstance(data.get("problems") or [], list):
            error = "problems is not a list"
    if error:
        return {"ok": False, "error": error}
    return {"ok": True, "error": None, "decision": data["decision"], "problems": [read_problem(p) for p in data.get("problems") or []]}


def _parser(read: Callable[[str], dict], schema: str) -> Callable[[Column], Column]:
    names = re.findall(r"(?:^|, )(\w+) ", schema)

    @F.pandas_udf(schema)
    def parse(texts: pd.Series) -> pd.DataFrame:
        rows = [read(t) if t is not None else {"ok": False, "error": "no response"} for t in texts]
        return pd.DataFrame({n: [r.get(n) for r in rows] for n in names}, dtype="object")

    return lambda raw: parse(strip_fence(raw))


def parse_generated(raw: Column) -> Column:
    """Struct (ok, error, decision, kb_type, kb_filename, kb_content, skip_reason)."""
    return _parser(read_generated, GENERATED)(raw)


def parse_verified(raw: Column) -> Column:
    """Struct (ok, error, decision, problems)."""
    return _parser(read_verified, VERIFIED)(raw)


def resolve_type(given: Column, suggested: Column) -> Column:
    return F.when(given.isin(*rules.KB_TYPES), given).otherwise(suggested)


def generation_results(responses: DataFrame, platform: str | None = None) -> DataFrame:
    """Units with responses to results: decision generate, skip or error, the type, the
    content with the platform set."""
    r = responses.withColumn("p", parse_generated(F.when(F.col("success"), F.col("raw_text"))))
    ok = F.col("success") & F.col("p.ok")
    decision = F.when(ok, F.col("p.decision")).otherwise("error")
    r = r.withColumn("decision", decision).withColumn("error_message", F.when(~F.col("success"), F.col("error")).when(~F.col("p.ok"), F.concat(F.lit("Parse error: "), F.col("p.error"))))
    made = F.col("decision") == "generate"
    r = r.withColumn("kb_type", F.when(made, resolve_type(F.col("p.kb_type"), F.col("suggested_type"))))
    r = r.withColumn("kb_filename", F.when(made, F.col("p.kb_filename"))).withColumn("skip_reason", F.when(F.col("decision") == "skip", F.col("p.skip_reason")))
    return r.withColumn("kb_content", F.when(made, override_platform(F.col("p.kb_content"), platform))).drop("p", "success", "error")


def unique_names(names: DataFrame, group: str = "doc_id", order: str = "seq", name: str = "kb_filename") -> DataFrame:
    """Adds file_name: the slug, with -2, -3 ... where it is taken. As an earlier name may
    look like a numbered one, the names of a document are given out one after the other.

    A slug remembers the number it got to, as names are never given back: linear in the names.
    Null names count as empty ones.
    """

    def give(f: pd.DataFrame) -> pd.DataFrame:
        taken: set[str] = set()
        reached: dict[str, int] = {}
        out = []
        f = f.sort_values(order, kind="stable")
        for base in f["_slug"]:
            got, i = base, reached.get(base, 2)
            while got in taken:
                got, i = f"{base}-{i}", i + 1
            taken.add(got)
            reached[base] = i
            out.append(got)
        return f.assign(file_name=out).drop(columns="_slug")

    bare = F.regexp_replace(F.coalesce(name, F.lit("")), r"\.md\z", "")
    return names.withColumn("_slug", slug(bare)).groupBy(group).applyInPandas(give, StructType([*names.schema.fields, StructField("file_name", StringType())]))
