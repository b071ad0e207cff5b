"""Secret scans over an incremental blob ledger, in DataFrame functions alone.

Every version of a text is addressed by the SHA-256 of its content. The ledger holds, for each scan of a blob, the rules
and rule versions that it ran and the spans that they found. A scan takes one row of each distinct blob, drops the
(blob, rule version) pairs that the ledger has, runs the other rules where the texts lie and appends what it found; the
findings of all present rule versions are joined back to every path (document) with that content. Texts are shuffled only
where the rows to scan, or those to leave out, are too many to broadcast.

Spans are in code points, end exclusive. A rule's matches are leftmost and do not overlap; matches that fail the rule's
length test are dropped after they have taken their characters. Defined results: a null text counts as empty; equal
texts share one blob; null ids are returned as they are; an empty table gives an empty one and an empty ledger.
A column of ``docs`` named like the result is replaced by it, all others are kept.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm.store import Scratch

SPAN = "struct<start:int,rank:int,kind:string,stop:int>"
LEDGER = "blob string, rules array<struct<kind:string,version:int>>, spans array<struct<start:int,stop:int,kind:string,version:int>>"
#: Most rows of (blob, id) or (blob, spans) that are broadcast, at some 200 bytes each.
BROADCAST_ROWS = 200_000


@dataclass(frozen=True)
class Rule:
    kind: str
    version: int
    pattern: str
    #: group whose code points are counted, and how many it needs
    group: int = 0
    least: int = 1


# The base rules. A run of hex digits or an access key is maximal, so its least length can stand in the
# pattern; for assignments a short match still consumes its characters and is dropped afterwards.
ASSIGN = Rule("assign", 1, r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8)
ACCESS = Rule("access", 1, r"AKIA[A-Z0-9]{12,}")
HEX = Rule("hex", 1, r"[0-9a-f]{32,}")
BASE_RULES = (ASSIGN, ACCESS, HEX)
# Added by this scanner: public, well-known shapes of keys. A private key runs to its END line, over anything but another
# run of five dashes; without an END line over the header lines and base64 lines that follow, line ends escaped or not.
# Every repetition of a group is possessive, which the engine runs as a loop: others would take a stack frame a line. None
# has a bound, and none can be entered at each character of a run, so that time follows the text.
_EOL = r"(?:[\t\x20]*+\r?\n|\\r\\n|\\n|[\t\x20])[\t\x20]*+"
_PEM_END = r"[^-]*+(?:-{1,4}+[^-]++)*+-----END [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----"
_PEM_CUT_OFF = rf"(?:(?:{_EOL})++[A-Za-z]++-[A-Za-z]++: [^\r\n]*+)*+(?:(?:{_EOL})++[A-Za-z0-9+/=]{{16,}}+)*+(?:{_EOL}[A-Za-z0-9+/]*+={{1,2}}+)?"
_JWT = r"[A-Za-z0-9_-]"
MORE_RULES = (
    Rule("pem", 3, rf"-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----(?:{_PEM_END}|{_PEM_CUT_OFF})?"),
    # a run that is no token is taken whole, so that its inner starts are not tried, and then dropped
    Rule("jwt", 3, rf"(eyJ{_JWT}{{8,}}+\.eyJ{_JWT}{{8,}}+\.{_JWT}{{8,}}+)|eyJ{_JWT}*+", 1),
    Rule("url_login", 3, r"[a-z][a-z0-9+.-]{0,30}://[^/\x20\x09-\x0D:@]++:[^/\x20\x09-\x0D:@]{4,}+@"),
)
RULES = (*BASE_RULES, *MORE_RULES)


def plain_pattern(rule: Rule) -> str:
    """The pattern for engines that never backtrack and know no possessive repetition; it finds the same matches."""
    return re.sub(r"(?<=[*+?}])\+", "", rule.pattern)


def rule_spans(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of one rule in a text: the pieces between matches and the matches themselves give all positions."""
    pieces = F.split(text, rule.pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    parts = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    steps = F.zip_with(F.zip_with(F.slice(pieces, 1, F.size(whole)), whole, lambda p, m: F.struct(F.length(p).alias("gap"), F.length(m).alias("n"))), parts, lambda s, g: F.struct(s["gap"].alias("gap"), s["n"].alias("n"), (F.length(g) >= rule.least).alias("good")))
    seed = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), (start + x["n"]).alias("stop"))
        return F.struct((start + x["n"]).alias("at"), F.when(x["good"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(steps, seed, step, lambda acc: acc["spans"])


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def rule_ids(rules: tuple[Rule, ...]) -> Column:
    return F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])


def scan(rows: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Ledger rows of (blob, text): the rules that ran and their spans."""
    empty = F.array().cast(f"array<{SPAN}>")
    # a cheap search decides first; only texts with a match are cut up
    found = F.flatten(F.array(*[F.when(F.col("text").rlike(r.pattern), rule_spans(F.col("text"), r, k)).otherwise(empty) for k, r in enumerate(rules)]))
    versions = F.array(*[F.lit(r.version) for r in rules])
    spans = F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"), F.element_at(versions, s["rank"] + 1).alias("version")))
    return rows.select("blob", rule_ids(rules).alias("rules"), spans.alias("spans"))


def _few(df: DataFrame) -> bool:
    return df.count() <= BROADCAST_ROWS


class Ledger:
    """An append-only table of scans in a folder; new and empty where the folder does not exist."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        there = where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where)
        if there:
            return self.spark.read.schema(LEDGER).parquet(self.path)
        return self.spark.range(0).select(F.from_json(F.lit(None).cast("string"), LEDGER).alias("r")).select("r.*")

    def due(self, blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
        """``blobs`` (blob, ...) with ``due``, the rules that the ledger lacks for them; those that lack none are left out."""
        seen = self.read().groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
        due = F.array_except(rule_ids(rules), F.coalesce("seen", F.array().cast("array<struct<kind:string,version:int>>")))
        return blobs.join(seen, "blob", "left").withColumn("due", due).drop("seen").where(F.size("due") > 0)

    def update(self, docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", rules: tuple[Rule, ...] = RULES) -> int:
        """Scan what is unseen and append it; the number of (blob, rule version) pairs scanned."""
        scratch = Scratch(self.spark)
        rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("blob", blob_id(F.col("text")))
        # one row stands for a blob: ids and addresses alone are shuffled
        blobs = rows.groupBy("blob").agg(F.min("id").alias("id"))
        todo, pairs = scratch.keep(self.due(blobs, rules), "todo"), 0
        for due in sorted({tuple((r["kind"], r["version"]) for r in x["due"]) for x in todo.select("due").distinct().collect()}):  # sets of rules
            chosen = tuple(r for r in rules if (r.kind, r.version) in due)
            part = todo.where(F.col("due") == rule_ids(chosen)).select("blob", "id")
            # rows that repeat id and text are scanned each and count once
            new = scan(self._rows_of(rows, part, scratch), chosen).dropDuplicates(["blob"])
            new = scratch.keep(new, "new")
            pairs += new.count() * len(chosen)
            new.write.mode("append").option("compression", "zstd").parquet(self.path)
        scratch.drop_all()
        return pairs

    def _rows_of(self, rows: DataFrame, part: DataFrame, scratch: Scratch) -> DataFrame:
        """The rows named by (blob, id): by those to take or those to leave, whichever is few; beyond that by a shuffle."""

        def same(other: DataFrame) -> Column:
            return (rows["blob"] == other["blob_"]) & rows["id"].eqNullSafe(other["id_"])

        named = part.select(F.col("blob").alias("blob_"), F.col("id").alias("id_"))
        if _few(named):
            return rows.join(F.broadcast(named), same(named), "left_semi")
        rest = scratch.keep(rows.join(named, same(named), "left_anti").select(F.col("blob").alias("blob_"), F.col("id").alias("id_")).distinct(), "rest")
        if _few(rest):
            return rows.join(F.broadcast(rest), same(rest), "left_anti")
        return rows.join(named, same(named), "left_semi")

    def spans(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """(blob, spans): all spans of the rules' present versions, by start and then rule order; blobs without any are left out."""
        order = F.create_map(*[x for k, r in enumerate(rules) for x in (F.lit(f"{r.kind}:{r.version}"), F.lit(k))])
        one = self.read().where(F.size("spans") > 0).select("blob", F.explode("spans").alias("s")).withColumn("rank", order[F.concat_ws(":", "s.kind", "s.version")])
        one = one.where("rank is not null").select("blob", F.struct("s.start", "rank", "s.kind", "s.stop").alias("s"))
        return one.groupBy("blob").agg(F.array_sort(F.collect_set("s")).cast(f"array<{SPAN}>").alias("spans"))


def find_secrets(docs: DataFrame, ledger: Ledger, text_col: str = "text", id_col: str = "doc_id", rules: tuple[Rule, ...] = RULES, into: str = "spans") -> DataFrame:
    """``docs`` with the spans of each row's text in ``into`` (array of start, rank, kind, stop), one row for each input row."""
    ledger.update(docs, text_col, id_col, rules)
    found = Scratch(docs.sparkSession).keep(ledger.spans(rules).select(F.col("blob").alias("__blob"), F.col("spans").alias("__spans")), "found")
    out = docs.join(F.broadcast(found) if _few(found) else found, blob_id(docs[text_col]) == F.col("__blob"), "left")
    return out.withColumn(into, F.coalesce("__spans", F.array().cast(f"array<{SPAN}>"))).drop("__blob", "__spans")


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, overlapping ones as one, replaced by ``mark``."""
    seed = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        gap = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), F.when(fresh, F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"]).alias("out"))

    joined = F.aggregate(spans, seed, step)
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(joined["out"], F.substring(text, joined["at"] + 1, F.length(text))))
