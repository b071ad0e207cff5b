"""Centroid clusters, byte-level BPE and vector codes against brute force, the library and odd inputs."""

import base64
import hashlib
import math
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from assay.llm import byte_bpe, centroids, queries, vector_codes
from assay.llm.vectors import finite

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
VECTORS = "vec_id long, embedding array<float>, label int, cluster int, error string, n string"
NAN, INF = float("nan"), float("inf")


def vectors(n=300, dims=64, kinds=9, seed=3):
    """Clustered vectors with many copies, ties in the smallest ids and coarse components, so that distances tie."""
    rng = np.random.default_rng(seed)
    centre = rng.integers(-3, 4, (kinds, dims))
    out = []
    for i in range(n):
        x = (centre[i % kinds] + rng.integers(-1, 2, dims)) / 16 if i % 3 else centre[0] / 16
        out.append((i // 2 if i < 40 else i, [float(v) for v in x], None if i % 5 == 0 else i % 4, 7, "x", "y"))
    return out


def odd_vectors():
    good = [0.1] * 64
    return [(1, None, 1, 0, "", ""), (2, [], 1, 0, "", ""), (3, [*good[:63], None], 1, 0, "", ""), (4, [*good[:63], NAN], 1, 0, "", ""), (5, [*good[:63], INF], 1, 0, "", ""), (6, good[:63], 1, 0, "", ""), (None, good, None, 0, "", ""), (7, good, 1, 0, "", "")]


def whole(rows, scale):
    return [(i, [math.floor(scale * float(np.float32(v))) for v in x], lab) for i, x, lab, *_ in rows if x is not None and len(x) == 64 and all(v is not None and math.isfinite(v) for v in x)]


def near(q, centres):
    return min((sum((a - b) ** 2 for a, b in zip(q, c, strict=True)), k) for k, c in enumerate(centres))


def lloyd(points, centres, rounds):
    for _ in range(rounds):
        at = [near(q, centres)[1] for q in points]
        for k in set(at):
            mine = [q for q, c in zip(points, at, strict=True) if c == k]
            centres[k] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    return [near(q, centres) for q in points]


def brute_clusters(rows, k, rounds):
    kept = whole(rows, 64)
    first = sorted(kept, key=lambda r: ((1, "") if r[0] is None else (0, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest()), r[1]))
    centres = [list(q) for _, q, _ in first[:k]]
    found = lloyd([q for _, q, _ in kept], centres, rounds)
    total = [sum(d for d, c in found if c == j) for j in range(len(centres))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i if i is not None else -1, c, d, total[c], sum(total), digest[c]) for (i, _, _), (d, c) in zip(kept, found, strict=True)))


@pytest.mark.parametrize(("k", "pivots"), [(16, 12), (5, 1)])
def test_clusters_equal_brute_force(spark, k, pivots):
    rows = vectors() + odd_vectors()
    got = centroids.clusters(spark.createDataFrame(rows, VECTORS).repartition(3), k=k, pivots=pivots).collect()
    assert sorted((r["vec_id"] if r["vec_id"] is not None else -1, *r[1:]) for r in got) == brute_clusters(rows, k, 3)


def test_bounds_keep_every_nearest_centroid_and_leave_most_out():
    rng = np.random.default_rng(5)
    centre = rng.normal(0, 40, (16, 64))
    q = np.floor(centre[rng.integers(0, 16, 2000)] + rng.normal(0, 6, (2000, 64))).astype(np.int64)
    c = np.floor(centre).astype(np.int64)
    simplex = centroids.Simplex(c, 12)
    assert 8 <= len(simplex.pivots) <= 12
    d2 = centroids.squared(q, simplex.pivots)
    mask, exact = centroids.candidates(d2, c, simplex), centroids.squared(q, c)
    assert mask[exact == exact.min(axis=1, keepdims=True)].all()
    assert mask.sum(axis=1).mean() < 3
    # apexes give back the distances to the pivots, and bound all others
    apex = simplex.apex(d2.astype(float))
    base = np.hstack([simplex.base, np.zeros((len(simplex.base), 1))])
    assert np.allclose(((apex[:, None] - base[None]) ** 2).sum(axis=2), d2, rtol=1e-6)


def test_clusters_of_equal_few_and_no_vectors(spark):
    same = spark.createDataFrame([(i, [0.5] * 64, 1, 0, "", "") for i in range(40)], VECTORS)
    got = centroids.clusters(same).collect()
    assert len(got) == 40 and {(r["cluster"], r["distance"]) for r in got} == {(0, 0)}
    assert len(centroids.clusters(same.limit(3)).collect()) == 3
    assert centroids.clusters(same.limit(0)).collect() == []
    large = spark.createDataFrame([(1, [1e30] * 64, 1, 0, "", ""), (2, [0.0] * 64, 1, 0, "", "")], VECTORS)
    with pytest.raises(Exception, match="exact distances"):
        centroids.clusters(large).collect()


def brute_codes(rows, entries, rounds, n_parts=4):
    kept = whole(rows, 1024)
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    width = 64 // n_parts
    parts, books = [], []
    for p in range(n_parts):
        cut = slice(p * width, (p + 1) * width)
        centres = [list(q[cut]) for _, q, _ in first]
        parts.append(lloyd([q[cut] for _, q, _ in kept], centres, rounds))
        books += [x for c in centres for x in c]
    digest = hashlib.sha256(",".join(map(str, books)).encode()).hexdigest()
    errors = [sum(p[i][0] for p in parts) for i in range(len(kept))]
    by = {lab: sum(e for e, (_, _, x) in zip(errors, kept, strict=True) if x == lab) for _, _, lab in kept}
    return sorted((i if i is not None else -1, "".join(f"{p[n][1]:02x}" for p in parts), errors[n], by[lab], digest) for n, (i, _, lab) in enumerate(kept))


@pytest.mark.parametrize(("entries", "block", "label_bound"), [(40, 7, 200_000), (256, 2048, 0)])
def test_codes_equal_brute_force(spark, entries, block, label_bound, monkeypatch):
    monkeypatch.setattr(vector_codes, "BROADCAST_LABELS", label_bound)
    monkeypatch.setattr(vector_codes, "BLOCK", block)
    rows = vectors(160, seed=8) + odd_vectors()
    got = vector_codes.codes(spark.createDataFrame(rows, VECTORS).repartition(3), entries=entries, rounds=2).collect()
    assert sorted((r["vec_id"] if r["vec_id"] is not None else -1, *r[1:]) for r in got) == brute_codes(rows, entries, 2)


@pytest.mark.parametrize("block", [1, 2, 5, 64])
@pytest.mark.parametrize("peak", [3, 2**26])
def test_walk_equals_all_distances(block, peak, monkeypatch):
    """Sorted parts with long common prefixes, in blocks that cut open paths, with small and with large components."""
    monkeypatch.setattr(vector_codes, "BLOCK", block)
    rng = np.random.default_rng(block)
    for dims in (1, 2, 6):
        parts, _, _ = vector_codes._distinct(rng.integers(-2, 2, (90, dims)) * (peak // 3))
        entries = rng.integers(-3, 3, (11, dims)) * (peak // 3)
        want = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
        label, d = vector_codes.Walk(entries).all(parts)
        assert (label == want.argmin(axis=1)).all() and (d == want.min(axis=1)).all()


def test_codes_of_equal_few_and_no_vectors(spark):
    same = spark.createDataFrame([(i, [0.5] * 64, None, 0, "", "") for i in range(30)], VECTORS)
    got = vector_codes.codes(same).collect()
    assert len(got) == 30 and {(r["code"], r["error"], r["label_error"]) for r in got} == {("00000000", 0, 0)}
    assert vector_codes.codes(same.limit(0)).collect() == []
    assert vector_codes.codes(same.select("vec_id", F.slice("embedding", 1, 63).alias("embedding"), "label")).collect() == []


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_equals_the_library_on_odd_and_long_pieces(library):
    rng = random.Random(2)
    bpe = byte_bpe.ByteBpe(PATH, PATTERN)
    wide = [chr(c) for c in (*range(0x250), 0x85, 0x1680, 0x2028, 0x3000, 0x200B, 0x1C, 0x1F, 0x4E2D, 0x1F600, 0x1D7D8, 0x0660, 0x2160, 0x0301, 0xFEFF, 0xFFFD)]
    texts = ["".join(rng.choice(wide if rng.random() < 0.3 else "ab c'st'reé \n1") for _ in range(rng.randrange(1, 300))) for _ in range(800)]
    texts += ["", "a" * 5000, "x" * 256, "x" * 257, " " * 3000, "!?" * 900, "é" * 129, "".join(rng.choice("abcde") for _ in range(20000)), "<|endoftext|>"]
    texts += [f"a{chr(c)}b {chr(c)}1" for c in range(0, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    got = [np.frombuffer(x, "<u4").tolist() for x in bpe.encode(texts)]
    assert got == library.encode_ordinary_batch(texts)


def test_long_texts_are_cut_where_no_piece_crosses(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "SEGMENT", 50)
    rng = random.Random(4)
    bpe = byte_bpe.ByteBpe(PATH, PATTERN)
    texts = ["".join(rng.choice("ab c'st're  é\n1") for _ in range(3000)), "x" * 400, "don't stop me now " * 80]
    assert len(list(bpe.segments(texts[2]))) > 20 and all("".join(bpe.segments(t)) == t for t in texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in bpe.encode(texts)] == library.encode_ordinary_batch(texts)


def test_byte_bpe_tables_round_trip(spark, library):
    rows = [(1, None, "a", 1), (2, "", "b", 2), (3, "x " * 30000, "c", 3), (None, "naïve 😀 text", None, 4), (3, "same", "e", 5), (3, "same", "e", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, n_tokens int")
    full = byte_bpe.encode_documents(docs, PATH, PATTERN)
    got = full.collect()
    assert sorted(r["decoded"] for r in got) == sorted(t or "" for _, t, _, _ in rows)
    assert all(r["ids"] == library.encode_ordinary(r["decoded"]) and r["n_tokens"] == len(r["ids"]) for r in got)
    brief = byte_bpe.encode_documents(docs, PATH, PATTERN, digests=True).collect()
    want = sorted((hashlib.sha256(" ".join(map(str, r["ids"])).encode()).hexdigest(), hashlib.sha256(r["decoded"].encode()).hexdigest()) for r in got)
    assert sorted((r["ids_sha256"], r["decoded_sha256"]) for r in brief) == want
    back = byte_bpe.decode_ids(full.select("doc_id", "ids").unionByName(spark.createDataFrame([(9, None), (9, [1, None]), (9, [-1]), (9, [50256]), (9, [])], "doc_id long, ids array<int>")), PATH, PATTERN).collect()
    assert sorted(bytes(r["decoded"]) for r in back if r["doc_id"] != 9) == sorted(r["decoded"].encode() for r in got)
    assert sorted((r["decoded"] for r in back if r["doc_id"] == 9), key=str) == [None] * 4 + [b""]
    assert byte_bpe.encode_documents(docs.limit(0), PATH, PATTERN).collect() == []


def test_registered_queries_over_whole_tables(spark, library):
    data = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{data}/documents.parquet").collect()
    want = {r["doc_id"]: " ".join(map(str, library.encode_ordinary(r["text"] or ""))) for r in docs}
    got = queries.op12_byte_bpe(spark, data).collect()
    assert {r["doc_id"]: r["ids_sha256"] for r in got} == {i: hashlib.sha256(x.encode()).hexdigest() for i, x in want.items()}
    vecs = spark.read.parquet(f"{data}/embeddings.parquet")
    n = vecs.where(finite(F.col("embedding").cast("array<double>"))).count()
    assert queries.op11_centroids(spark, data).count() == queries.op13_vector_codes(spark, data).count() == n


def test_the_neighbours_sample_is_bounded_before_the_driver(spark, monkeypatch):
    """The rows of lowest hash, of which all but about twice their number stay in their tasks."""
    from pyspark.sql import functions as F

    from assay.llm import ann

    monkeypatch.setattr(ann, "SAMPLE", 50)
    rows = spark.range(0, 20000, 1, 40).select("id", F.lit(b"x").alias("vec"))
    want = [r["id"] for r in rows.orderBy(F.xxhash64("id"), "id").limit(50).collect()]
    assert [r["id"] for r in ann.sample(rows)] == want
    few = spark.range(30).select("id", F.lit(b"x").alias("vec"))
    assert len(ann.sample(few)) == 30 and ann.sample(few.limit(0)) == []
    seen = spark.sparkContext.accumulator(0)

    class Frame:
        def __getattr__(self, name):
            return getattr(rows, name)

        def where(self, when):
            seen.add(rows.where(when).count())
            return rows.where(when)

    ann.sample(Frame())
    assert 50 <= seen.value <= 200
