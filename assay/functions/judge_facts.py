"""Findings in the answers of a judging model: a table function, to be joined laterally to a table of answers.

    answers.lateralJoin(JudgeFindings(F.col("text").outer(), F.col("stop_reason").outer()))

An answer may wrap its array in prose or fences: the array reaches from the first ``[`` to the last ``]``. An answer that
was refused, has no array or holds one that is not JSON gives one WARN row. Elements that are no objects, or lack an area or
a severity, give none. Values that are no strings are given as JSON.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql.functions import udtf

FIELDS = ("dimension", "area", "severity", "title", "location", "detail", "fix", "layer")


def _warning(title: str, detail: str) -> tuple:
    return None, "tests", "WARN", title, None, detail, None, "semantic"


def judge_findings(text: str | None, stop_reason: str | None) -> Iterator[tuple]:
    if stop_reason == "refusal":
        yield _warning("judge-refused", "the judge declined this task")
        return
    first, last = (text or "").find("["), (text or "").rfind("]")
    if first < 0 or last < first:
        yield _warning("judge-unparsable", "no array")
        return
    try:
        found = json.loads(text[first : last + 1])
    except (ValueError, RecursionError):
        yield _warning("judge-unparsable", "not JSON")
        return
    for f in found:
        if isinstance(f, dict) and f.get("area") and f.get("severity"):
            f.setdefault("layer", "semantic")
            yield tuple(v if v is None or isinstance(v, str) else json.dumps(v) for v in map(f.get, FIELDS))


@udtf(returnType=", ".join(f"{n} string" for n in FIELDS))
class JudgeFindings:
    def eval(self, text: str, stop_reason: str):
        yield from judge_findings(text, stop_reason)
