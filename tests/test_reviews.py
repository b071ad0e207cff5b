"""Answers of judging models and verifier functions, on hand-written inputs."""

import base64
import re

import pytest

from assay.functions.judge_facts import judge_findings
from assay.operators import judges as J
from assay.operators import verifiers as V

ANSWER = "task string, role string, stop_reason string, text string"
FILE = "task string, rel_path string, text string"
GOOD = '{"area": "tests", "severity": "WARN", "title": "t"}'


@pytest.mark.parametrize(
    ("text", "stop", "titles"),
    [
        (f"[{GOOD}]", "refusal", ["judge-refused"]),
        (None, None, ["judge-unparsable"]),
        ("", "end_turn", ["judge-unparsable"]),
        ("] and [", "end_turn", ["judge-unparsable"]),
        (f"see [1]: [{GOOD}]", "end_turn", ["judge-unparsable"]),
        ("[" * 100000 + "]", "end_turn", ["judge-unparsable"]),
        ("[]", "end_turn", []),
        (f"```json\n[{GOOD},\n{GOOD}]\n```", None, ["t", "t"]),
        (f'[null, 3, "x", [{GOOD}], {{"area": "a"}}, {{"area": 0, "severity": "FAIL"}}, {GOOD}]', None, ["t"]),
    ],
)
def test_answers(text, stop, titles):
    assert [f[3] for f in judge_findings(text, stop)] == titles


def test_values_that_are_no_strings():
    ((dimension, area, severity, title, location, detail, fix, layer),) = judge_findings('[{"area": "a", "severity": "FAIL", "title": 7, "detail": {"x": [1]}, "location": null, "layer": "static", "task": "z"}]', None)
    assert (dimension, area, severity, title, location, detail, fix, layer) == (None, "a", "FAIL", "7", None, '{"x": [1]}', None, "static")


def by_hand(rows):
    """Gaps of each reviewed task, by loops."""
    out = set()
    for task in {t for t, role, *_ in rows if role == J.REVIEWER}:
        found = [f for t, role, stop, text in rows if t == task and role == J.REVIEWER for f in judge_findings(text, stop)]
        told = " ".join(f[5] or "" for f in found).lower()
        for d in J.DIMENSIONS:
            mine = [f for f in found if f[0] == d]
            if not any((f[5] or "").strip() or (f[4] or "").strip() for f in mine):
                out.add((task, "dimension-not-assessed", d, "asserted-without-evidence" if mine else "not-assessed"))
        out |= {(task, "mandatory-check-not-assessed", d, q) for q, (d, _) in J.CHECKS.items() if not re.search(rf"\b{q}\s*:", told, re.I)}
    return out


def test_gaps_by_hand(spark):
    full = ", ".join(f'{{"dimension": "{d}", "area": "tests", "severity": "PASS", "detail": "q{k % 4 + 1} : seen"}}' for k, d in enumerate(J.DIMENSIONS))
    rows = [
        ("all", "reviewer", "end_turn", f"[{full}]"),
        ("none", "reviewer", "end_turn", "[]"),
        ("refused", "reviewer", "refusal", None),
        ("blank", "reviewer", None, '[{"dimension": "coverage", "area": "x", "severity": "WARN", "detail": "\\n ", "location": "\\t"}, {"dimension": "style", "area": "x", "severity": "WARN", "detail": "aQ1: Q2:"}]'),
        ("twice", "reviewer", None, '[{"dimension": "coverage", "area": "x", "severity": "WARN"}]'),
        ("twice", "reviewer", None, '[{"dimension": "coverage", "area": "x", "severity": "WARN", "location": "a:1"}]'),
        ("other", "adversary", None, f"[{GOOD}]"),
    ]
    got = J.judged(spark.createDataFrame(rows, ANSWER)).collect()
    gaps = {(r["task"], r["title"], r["dimension"], r["detail"]) for r in got if r["title"] and r["title"].endswith("not-assessed")}
    assert gaps == by_hand(rows)
    assert not [g for g in gaps if g[0] in ("all", "other")] and len([g for g in gaps if g[0] == "none"]) == 13
    assert ("blank", "mandatory-check-not-assessed", "coverage", "Q1") in gaps and ("blank", "mandatory-check-not-assessed", "golden-patch", "Q2") not in gaps
    assert [r["title"] for r in got if r["task"] == "other"] == ["t"]
    assert J.judged(spark.createDataFrame([], ANSWER)).collect() == []


def verdicts(spark, files, failing=None):
    df = V.verifier_findings(spark.createDataFrame(files, FILE), None if failing is None else spark.createDataFrame(failing, "task string, check string"))
    return sorted((r["task"], r["location"].split("::")[1], r["title"], r["detail"]) for r in df.collect())


def test_functions_of_a_verifier(spark):
    coded = base64.b64encode(b"cmp -s /a /b").decode()
    source = f"""import hashlib
def test_diff():
    run("diff -q a b")
    def test_inner(): pass
def helper(): md5
def  test_coded ( ):
    exec(b64decode('{coded}'), b64decode("A"))
def test_calls():
    run("grade.py") == 'ALL_GOOD'
def test_folds():
    run("hash.sh")
def test_plain():
    assert x == "NOPE!"
def testless(): pass"""
    files = [
        ("a", V.TEST_PY, source),
        ("a", "tests/grade.py", "print(1)"),
        ("a", "tests/hash.sh", "sha1sum x"),
        ("a", "tests/test.sh", "diff -q a b"),
        ("a", "tests/sub/x.py", "md5"),
        ("a", "tests/none.py", None),
        ("b", V.TEST_PY, source),
        ("c", V.TEST_PY, None),
        ("d", V.TEST_PY, "md5\n"),
    ]
    cmp, hashed, opaque = V.MARKS["byte-exact-compare"][1], V.MARKS["hash-equality"][1], "delegates to graders that show nothing, and asks for their sentinel"
    brittle, lost = "brittle-verifier-pattern", "escalate-oracle"
    assert verdicts(spark, files) == [("a", "test_calls", brittle, opaque), ("a", "test_coded", brittle, cmp), ("a", "test_diff", brittle, f"{cmp}; {hashed}"), ("a", "test_folds", brittle, hashed), ("b", "test_coded", brittle, cmp), ("b", "test_diff", brittle, f"{cmp}; {hashed}")]
    failing = [("a", "tests/x.py::X::test_diff"), ("a", "test_diff"), ("a", "test_plain"), ("b", "t::test_calls"), ("b", "gone"), ("d", "test_diff"), (None, "test_diff")]
    nothing = "fails everywhere and shows no mark"
    assert verdicts(spark, files, failing) == [("a", "test_diff", brittle, f"{cmp}; {hashed}"), ("a", "test_plain", lost, nothing), ("b", "test_calls", lost, nothing)]
    assert verdicts(spark, []) == [] and verdicts(spark, files, []) == []


def test_long_sources(spark):
    long = "".join(f"def test_{k}():\n    assert {k}\n" for k in range(20000)) + "def test_last():\n    " + "x " * 500000 + "md5"
    assert verdicts(spark, [("a", V.TEST_PY, long)]) == [("a", "test_last", "brittle-verifier-pattern", V.MARKS["hash-equality"][1])]
