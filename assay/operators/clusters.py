"""Clusters of tasks by a vocabulary: fingerprints, Jaccard pairs, components and their descriptions; name and seed words."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.session import with_checkpoints

# Technical words, operations (marked op:), seeds by precedence and set-ups.
TECH = (
    "sqlite", "parquet", "arrow", "hmac", "sha256", "sha1", "md5", "crc32c", "crc32", "crc", "jq", "locale", "tar", "gzip", "zstd", "zlib", "lz4",
    "protobuf", "msgpack", "base64", "hex", "fsync", "wal", "journal", "manifest", "quarantine", "replay", "offset", "binary", "daemon", "queue",
    "append-only", "atomic", "idempoten", "reconcil", "rename", "checkpoint", "ledger", "spool", "read-only", "air-gap", "airgap", "mmap", "struct",
    "varint", "little-endian", "big-endian", "watermark", "dedup", "backpressure", "rotation", "sidecar", "envelope", "segment",
)
OPS = (
    "parse", "verify", "reconcile", "validate", "recover", "replay", "dedup", "compact", "migrate", "rotate", "repair", "audit", "export", "ingest",
    "serialize", "checksum", "rebuild",
)
SEEDS = (
    "kiosk", "microgrid", "maritime", "vessel", "port", "exhibit", "telemetry", "spool", "biotelemetry", "coldchain", "broadcast", "calibration",
    "clinical", "hpc",
)
SETUP = ("air-gap", "airgap", "read-only", "no network", "pre-installed", "offline", "ephemeral")
DF_MAX = 0.35
#: Bits of a long that are used, and distinct sets of a block.
WORD, BAND = 62, 2048


def fingerprint(text: Column, tech: tuple[str, ...] = TECH, ops: tuple[str, ...] = OPS) -> Column:
    """The words of the vocabulary that the text contains."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.array_compact(F.array(*[F.when(low.contains(w), F.lit(w)) for w in tech], *[F.when(low.contains(w), F.lit(f"op:{w}")) for w in ops]))


def seed_signature(text: Column, seeds: tuple[str, ...] = SEEDS, setup: tuple[str, ...] = SETUP) -> Column:
    """(seed, setup): the first listed seed in the text, '?' without one, and its set-up words in order."""
    low = F.lower(F.coalesce(text, F.lit("")))
    first = F.coalesce(*[F.when(low.contains(s), F.lit(s)) for s in seeds], F.lit("?"))
    return F.struct(first.alias("seed"), F.array_sort(F.array_compact(F.array(*[F.when(low.contains(s), F.lit(s)) for s in setup]))).alias("setup"))


def name_tokens(name: Column, stop: tuple[str, ...] = ()) -> Column:
    """Distinct parts of a kebab name of three letters or more, without a hex id at its end and without stop words."""
    parts = F.split(F.regexp_replace(F.lower(name), r"(^|-)[0-9a-f]{6,}$", ""), "-")
    return F.array_distinct(F.filter(parts, lambda w: (F.length(w) >= 3) & ~w.isin(*stop)))


def distinctive(prints: DataFrame, key: str = "task", most: float = DF_MAX) -> DataFrame:
    """(key, token) of the tokens that less than ``most`` of all rows have."""
    long = prints.select(key, F.explode("tokens").alias("token"))
    total = prints.agg(F.count("*").alias("total"))
    rare = long.groupBy("token").agg(F.count("*").alias("df")).join(F.broadcast(total)).where(F.col("df") / F.col("total") < most)
    return long.join(F.broadcast(rare.select("token")), "token").select(key, "token")  # bounded: the vocabulary


def masks(tokens: DataFrame, vocabulary: tuple[str, ...], key: str = "task") -> DataFrame:
    """(key, words, n): each token set as bits of a few longs, by the token's place in the vocabulary; other tokens count for nothing."""
    place = F.create_map(*[F.lit(x) for k, token in enumerate(vocabulary) for x in (token, k)])[F.col("token")]
    n_words = max(1, -(-len(vocabulary) // WORD))
    bit = lambda k: F.when(F.floor(place / WORD) == k, F.expr("shiftleft(1L, cast(place % " + str(WORD) + " as int))"))
    marked = tokens.withColumn("place", place).where("place is not null")
    sets = marked.groupBy(key).agg(F.array(*[F.coalesce(F.bit_or(bit(k)), F.lit(0)).cast("long") for k in range(n_words)]).alias("words"))
    return sets.withColumn("n", F.aggregate("words", F.lit(0), lambda s, w: s + F.bit_count(w).cast("int")))


def spanning_links(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links over the rows of ``a``, then those of ``b``, that join just what all pairs of a row of ``a`` and a row of ``b``
    at the threshold join: each row that has a pair, and the first row that it reaches."""
    both = sum(np.bitwise_count(x[:, None] & y[None, :]).astype(np.int16) for x, y in zip(a.T, b.T, strict=True))
    sizes = [np.bitwise_count(m).sum(axis=1, dtype=np.int64) for m in (a, b)]
    near = both >= threshold * (sizes[0][:, None] + sizes[1][None, :] - both) - 1e-9
    last = np.int32(len(a) + len(b))
    left, right = np.arange(len(a), dtype=np.int32), np.arange(len(a), last, dtype=np.int32)
    while True:
        new_right = np.minimum(right, np.where(near, left[:, None], last).min(axis=0, initial=last))
        new_left = np.minimum(left, np.where(near, new_right[None, :], last).min(axis=1, initial=last))
        if (new_left == left).all() and (new_right == right).all():
            break
        left, right = new_left, new_right
    label, own = np.concatenate([left, right]), np.arange(last)
    return label[label != own], own[label != own]


def _upto(n: str) -> Column:
    return F.sequence(F.lit(0).cast("long"), (F.col(n) - 1).cast("long"))


def alike(tokens: DataFrame, threshold: float, vocabulary: tuple[str, ...], key: str = "task", least: int = 2) -> DataFrame:
    """Links (u, v) with the same components as all pairs of token sets, both of ``least`` tokens or more, whose Jaccard
    similarity reaches the threshold.

    Sets are bits of longs and one task stands for each distinct set; equal sets link in a star. Distinct sets lie in bands
    by their size, of up to ``BAND`` sets a block, and a block meets those of its own size up to size / threshold: no
    others can reach the threshold. A meeting gives out one link a set at most, whatever the number of pairs.
    """
    sets = masks(tokens, vocabulary, key).where(F.col("n") >= least)
    kinds = sets.groupBy("words", "n").agg(F.min(key).alias("rep"))
    star = sets.join(kinds, ["words", "n"]).where(F.col(key) != F.col("rep")).select(F.col("rep").alias("u"), F.col(key).alias("v"))
    bands = kinds.groupBy("n").agg(F.ceil(F.count("*") / BAND).cast("int").alias("blocks"))
    # a bounded table: a row for each size that the vocabulary allows
    partners = bands.select("n", "blocks", F.explode(F.sequence(F.col("n"), F.floor(F.col("n") / threshold + 1e-9).cast("int"))).alias("m"))
    grid = partners.join(bands.select(F.col("n").alias("m"), F.col("blocks").alias("others")), "m")
    dealt = kinds.withColumn("h", F.xxhash64("words"))
    left = dealt.join(F.broadcast(grid), "n").select("n", F.pmod("h", "blocks").alias("i"), "m", F.explode(_upto("others")).alias("j"), "rep", "words")
    fresh = dealt.select(F.col("n").alias("m"), F.col("h").alias("h"), F.col("rep").alias("rep"), F.col("words").alias("words"))
    right = fresh.join(F.broadcast(grid), "m").select(F.col("n").alias("n"), F.explode(_upto("blocks")).alias("i"), "m", F.pmod("h", "others").alias("j"), "rep", "words")

    def meet(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if x.empty or y.empty or (x["n"].iloc[0] == x["m"].iloc[0] and x["i"].iloc[0] > x["j"].iloc[0]):
            return pd.DataFrame({"u": [], "v": []})
        reps = np.concatenate([x["rep"], y["rep"]])
        u, v = spanning_links(*(np.stack(f["words"]).astype(np.uint64) for f in (x, y)), threshold)
        return pd.DataFrame({"u": reps[u], "v": reps[v]})

    kind = tokens.schema[key].dataType.simpleString()
    at = ("n", "i", "m", "j")
    near = left.groupBy(*at).cogroup(right.groupBy(*at)).applyInPandas(meet, f"u {kind}, v {kind}").where("u <> v")
    return near.unionByName(star)


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id with an edge: the smallest id that its links reach, by label steps and shortcuts.

    Each round is checkpointed; labels halve their paths, so rounds grow with the logarithm of the longest path.
    """
    with_checkpoints(edges.sparkSession)
    both = edges.where("u <> v").select("u", "v").unionByName(edges.where("u <> v").select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct().checkpoint()
    label = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("id"), F.least("u", "m").alias("component")).checkpoint()
    while True:
        seen = both.join(label, F.col("v") == F.col("id")).groupBy("u").agg(F.min("component").alias("m"))
        low = label.join(seen, F.col("id") == F.col("u")).select("id", F.least("component", "m").alias("component"), F.col("component").alias("old"))
        # shortcut: the label of the label
        up = low.select(F.col("id").alias("c"), F.col("component").alias("above"))
        nxt = low.join(up, F.col("component") == F.col("c"), "left").select("id", F.least("component", F.coalesce("above", "component")).alias("component"), "old").checkpoint()
        moved = not nxt.where("component <> old").isEmpty()
        label = nxt.select("id", "component")
        if not moved:
            return label


def described(tokens: DataFrame, labels: DataFrame, least: int, key: str = "task", share: float = 0.7, most: int = 8) -> DataFrame:
    """(component, size, common): components of ``least`` members or more and the first tokens that 70 % of them have."""
    member = labels.select(F.col("id").alias(key), "component")
    size = member.groupBy("component").agg(F.count("*").alias("size")).where(F.col("size") >= least)
    held = tokens.join(member, key).groupBy("component", "token").agg(F.count("*").alias("n"))
    common = held.join(size, "component").where(F.col("n") / F.col("size") >= share).groupBy("component").agg(F.array_sort(F.collect_list("token")).alias("t"))
    return size.join(common, "component", "left").select("component", "size", F.array_join(F.slice(F.coalesce("t", F.array().cast("array<string>")), 1, most), ", ").alias("common"))


def corpus(sources: DataFrame) -> DataFrame:
    """One row for each (source, name) of (source, name, text, place), the first by place, white space made one blank."""
    flat = sources.withColumn("text", F.trim(F.regexp_replace("text", r"\s+", " ")))
    return flat.groupBy("source", "name").agg(F.min_by("text", "place").alias("text"))
