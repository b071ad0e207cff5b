"""Test functions of verifiers that compare with a fixed or hidden value, against the checks that fail in every attempt.

``files`` has task, rel_path and text, one row a file. Texts are cut into functions inside Spark; a function ends where the
next ``def test...`` of the first column begins. What a base64 literal decodes to counts as text of its function or file.
Null texts and files without test functions give nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.operators.sources import TEST_PY, finding

# Marks of a comparison, as pattern and as words for a reader.
MARKS = {
    "byte-exact-compare": (r"\bdiff\s+-q\b|\bdiff\s+/|\bcmp\s+(-s\s+)?/?\w", "byte-exact file compare (diff/cmp)"),
    "hash-equality": (r"\b(sha256sum|md5sum|sha1sum|hexdigest|hashlib|sha256|md5)\b", "hash equality (one byte differs -> fail)"),
    "hidden-oracle-truth": (r"/tests/\.truth|/\.truth/|expected_[\w]*\.(json|txt|csv)|truth_[\w]*\.|\.golden\b|golden_[\w]*", "compares to a hidden answer key (truth/expected/golden)"),
    "jq-deep-equal": (r"jq[^\n]*==[^\n]*|\$a\[0\]\s*==\s*\$b\[0\]", "jq structural deep-equal vs an oracle json"),
}
OPAQUE = "opaque-grader"
SENTINEL = r"==\s*['\"][A-Z][A-Z_]{4,}['\"]"
FUNCTION = r"def\s+(test\w+)\s*\("
HARNESS = ("tests/test_outputs.py", "tests/test.sh")


def decoded(text: Column) -> Column:
    """The text and, line by line, what its base64 literals say; literals that are not base64 say nothing."""
    blobs = F.regexp_extract_all(text, F.lit(r"b64decode\(\s*['\"]([A-Za-z0-9+/=]+)['\"]"), F.lit(1))
    said = F.array_compact(F.transform(blobs, lambda b: F.make_valid_utf8(F.try_to_binary(b, F.lit("base64")).cast("string"))))
    return F.concat_ws("\n", text, F.array_join(said, "\n"))


def marks(text: Column) -> Column:
    """Names of the marks that the text shows."""
    return F.array_compact(F.array(*[F.when(text.rlike(rx), F.lit(name)) for name, (rx, _) in MARKS.items()]))


def test_functions(files: DataFrame, path: str = TEST_PY) -> DataFrame:
    """(task, place, name, body): the test functions of each verifier in order; a name may come twice."""
    pieces = F.split(F.col("text"), rf"(?md)(?=^{FUNCTION})")
    cut = files.where(F.col("rel_path") == path).select("task", F.posexplode(pieces).alias("place", "body"))
    return cut.select("task", "place", F.regexp_extract("body", f"^{FUNCTION}", 1).alias("name"), "body").where("name <> ''")


def graders(files: DataFrame) -> DataFrame:
    """(task, file, marks) of the scripts directly in tests/ that are not the harness."""
    own = files.where(F.col("rel_path").rlike(r"^tests/[^/]+\.(py|sh)$") & ~F.col("rel_path").isin(*HARNESS) & F.col("text").isNotNull())
    return own.select("task", F.substring_index("rel_path", "/", -1).alias("file"), marks(decoded(F.col("text"))).alias("marks"))


def verifier_findings(files: DataFrame, failing: DataFrame | None = None) -> DataFrame:
    """``brittle-verifier-pattern`` for each test function with a mark of its own or of a grader that it names; one that
    names graders without any mark and asks for a sentinel is marked as opaque.

    With ``failing`` (task, check) only functions of those names count, a check's name being what follows its last ``::``,
    and those without a mark are ``escalate-oracle``. Texts are reduced to marks before they are shuffled, but for the
    functions of packages that have graders; Spark may split a package that is large.
    """
    found = test_functions(files)
    if failing is not None:
        names = failing.select("task", F.element_at(F.split("check", "::"), -1).alias("name")).distinct()
        found = found.join(names, ["task", "name"], "left_semi")
    text = decoded(F.col("body"))
    found = found.select("task", "place", "name", marks(text).alias("own"), text.rlike(SENTINEL).alias("asks"), text.alias("text"))
    named = found.select("task", "place", "text").join(graders(files), "task").where(F.contains("text", "file"))
    called = named.groupBy("task", "place").agg(F.array_sort(F.collect_set("file")).alias("calls"), F.array_distinct(F.flatten(F.collect_set("marks"))).alias("theirs"))
    none = F.array().cast("array<string>")
    both = found.select("task", "place", "name", "own", "asks").join(called, ["task", "place"], "left")
    hits = F.array_sort(F.array_union("own", F.coalesce("theirs", none)))
    both = both.withColumn("hits", F.when((F.size(hits) == 0) & F.col("asks") & F.col("calls").isNotNull(), F.array(F.lit(OPAQUE))).otherwise(hits))
    words = F.create_map(*[F.lit(x) for name, (_, said) in MARKS.items() for x in (name, said)], F.lit(OPAQUE), F.lit("delegates to graders that show nothing, and asks for their sentinel"))
    detail = F.array_join(F.transform("hits", lambda h: words[h]), "; ")
    place = F.concat(F.lit(f"{TEST_PY}::"), F.col("name"))
    brittle = both.where(F.size("hits") > 0).select(*finding("tests", "WARN", "brittle-verifier-pattern", place, detail))
    if failing is None:
        return brittle
    return brittle.unionByName(both.where(F.size("hits") == 0).select(*finding("tests", "WARN", "escalate-oracle", place, F.lit("fails everywhere and shows no mark"))))
