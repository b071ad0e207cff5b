"""The registered queries of the numbered operators, and SQL for those that SQL can express."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm import ann, bpe, byte_bpe, centroids, chat, images, lang_id, mixing, ngram_jaccard, quality, secrets, toxicity, vector_codes
from assay.llm.features import crc_part
from assay.llm.store import Scratch
from assay.session import ship, table

VOCABULARY = "word_bpe_49k.json"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.jaccard_groups(table(ship(spark), sf_dir, "documents"), width=3, threshold=Fraction(9, 10))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(ship(spark), sf_dir, "documents")
    held = F.coalesce(crc_part(F.col("doc_id"), 4) == 2, F.lit(False))
    model = lang_id.fit(docs, ~held & F.col("doc_id").isNotNull())
    out = lang_id.predict(docs.withColumn("held_out", held), model, ["doc_id", "held_out"])
    return out.select("doc_id", "held_out", "lang_pred", "score")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(ship(spark), sf_dir, "documents"), vocabulary_path(), digests=True)


def secret_ledger(spark: SparkSession) -> secrets.Ledger:
    """The ledger of the session's ``spark.assay.secrets.ledger``, kept from run to run; without it a new one."""
    return secrets.Ledger(spark, spark.conf.get("spark.assay.secrets.ledger", None) or f"{Scratch(spark).root}/ledger")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"), secret_ledger(spark))
    n_base = len(secrets.BASE_RULES)

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(r.kind) for r in secrets.BASE_RULES]
    base = F.sha2(secrets.span_text(F.filter("spans", lambda s: s["rank"] < n_base)).cast("binary"), 256)
    return found.select("doc_id", *counts, base.alias("base_sha256"), secrets.span_text(F.col("spans")).alias("spans"))


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(ship(spark), sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


PROBE_CHAT = "</s>[INST] ok [/INST]"


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE_CHAT).alias("text"))
    out = chat.format_chats(rows.unionByName(probe))
    turns = chat.read_back(F.col("formatted"))
    learnt = chat.masked_text(F.col("segments"))
    out = out.select("conv_id", "first_bad_turn", turns.alias("turns"), learnt.alias("learnt"), F.length("formatted").cast("long").alias("formatted_chars"))
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"), F.length("learnt").cast("long").alias("loss_chars"), F.sha2(F.col("learnt").cast("binary"), 256).alias("loss_sha256"), "formatted_chars", "first_bad_turn")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No driver table holds images: each row of ``embeddings`` gets the made-up image of its id."""
    return images.copy_groups(images.made_up_images(table(ship(spark), sf_dir, "embeddings"), "vec_id"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(ship(spark), sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(ship(spark), sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = F.coalesce(crc_part(F.col("doc_id"), 5) == 0, F.lit(False))
    model = quality.fit(docs, labels, crc_part(F.col("doc_id"), 5) != 0)
    out = quality.score(docs.withColumn("held_out", held), model, ["doc_id", "held_out"])
    return out.select("doc_id", "held_out", F.col("_score").alias("score"), (F.col("_score") >= 0.3).cast("int").alias("predicted"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(table(ship(spark), sf_dir, "embeddings"), k=16, rounds=3, dims=64, scale=64)


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.encode_documents(table(ship(spark), sf_dir, "documents"), path, public_tokenizers.PATTERN, digests=True)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.codes(table(ship(spark), sf_dir, "embeddings"), n_parts=4, entries=256, rounds=4, scale=1024)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_language": op2_language,
    "op3_bpe": op3_bpe,
    "op4_secrets": op4_secrets,
    "op5_neighbours": op5_neighbours,
    "op6_chat": op6_chat,
    "op7_mixing": op7_mixing,
    "op8_images": op8_images,
    "op9_toxicity": op9_toxicity,
    "op10_quality": op10_quality,
    "op11_centroids": op11_centroids,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_vector_codes": op13_vector_codes,
    "pipeline": pipeline,
}


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _secrets_sql() -> str:
    parts = []
    for rank, r in enumerate(secrets.RULES):
        p = _sql_text(secrets.plain_pattern(r))
        parts.append(
            f"SELECT doc_id, {rank} AS rank, '{r.kind}' AS kind, unnest(regexp_extract_all(t, {p})) AS m, unnest(regexp_extract_all(t, {p}, {r.group})) AS g, "
            f"unnest(list_slice(string_split_regex(t, {p}), 1, len(regexp_extract_all(t, {p})))) AS gap, unnest(range(len(regexp_extract_all(t, {p})))) AS k, {r.least} AS least "
            f"FROM d WHERE regexp_matches(t, {p})"
        )
    counts = ", ".join(f"CAST(count(*) FILTER (WHERE kind = '{r.kind}') AS BIGINT) AS n_{r.kind}" for r in secrets.BASE_RULES)
    named = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secrets.BASE_RULES)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
hits AS ({' UNION ALL '.join(parts)}),
placed AS (
  SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY k) AS stop FROM hits),
spans AS (
  SELECT doc_id, rank, kind, CAST(stop - length(m) AS BIGINT) AS start, kind || ':' || CAST(stop - length(m) AS BIGINT) || ':' || CAST(stop AS BIGINT) AS s
  FROM placed WHERE length(g) >= least),
per AS (
  SELECT doc_id, {counts}, string_agg(s, ',' ORDER BY start, rank) FILTER (WHERE rank < {len(secrets.BASE_RULES)}) AS base, string_agg(s, ',' ORDER BY start, rank) AS spans
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, {named}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN per USING (doc_id)"""


def _chat_sql() -> str:
    t = chat.LLAMA_LIKE
    codes = "".join(t.codes)
    escaped = " + ".join(f"(length({{x}}) - length(replace({{x}}, {_sql_text(c)}, '')))" for c in codes)
    width = "CASE role " + " ".join(f"WHEN '{r}' THEN {len(a) + len(b)} + length(text) + {escaped.format(x='text')}" for r, (a, b, _) in t.roles.items())
    width += f" ELSE {sum(map(len, t.other))} + length(role) + {escaped.format(x='role')} + length(text) + {escaped.format(x='text')} END"
    learnt = ", ".join(f"'{r}'" for r, (_, _, loss) in t.roles.items() if loss)
    allowed = " OR ".join(f"(prev = '{s}' AND role IN ({', '.join(map(repr, roles))}))" for s, roles in t.allowed.items())
    return f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', {_sql_text(PROBE_CHAT)} UNION ALL SELECT -1, 1, 'assistant', {_sql_text(PROBE_CHAT)}),
w AS (
  SELECT *, {width} AS width, coalesce(lag(role) OVER o, '{t.start}') AS prev, row_number() OVER o AS k
  FROM c WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
g AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role IN ({learnt})), '') AS learnt, CAST(sum(width) AS BIGINT) AS formatted_chars,
    CAST(min(k) FILTER (WHERE NOT ({allowed})) AS INT) AS first_bad_turn
  FROM w GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learnt) AS loss_chars, sha256(learnt) AS loss_sha256, formatted_chars, first_bad_turn FROM g"""


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), '') || CASE WHEN doc_id IS NULL THEN '|' || sha256(coalesce(text, '')) ELSE '' END) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight, CAST(source_size * 3 AS DOUBLE) AS cap FROM s),
r AS (SELECT *, cap / weight AS ratio, CAST(sum(source_size) OVER () AS DOUBLE) AS total, sum(weight) OVER () AS weights FROM w),
l AS (SELECT *, (total - coalesce(sum(cap) OVER f, 0)) / (weights - coalesce(sum(weight) OVER f, 0)) AS level
  FROM r WINDOW f AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goal AS (SELECT source, source_size, least(cap, coalesce((SELECT arg_min(level, ratio) FROM l WHERE ratio >= level) * weight, cap)) AS target FROM l),
q AS (SELECT d.*, source_size, target, sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) AS cum
  FROM d JOIN goal ON d.source IS NOT DISTINCT FROM goal.source),
t AS (SELECT doc_id, h, size, pass, CAST(pass * source_size + cum AS DOUBLE) / target AS t
  FROM q, (VALUES (0), (1), (2)) AS p(pass) WHERE size > 0 AND target > 0),
c AS (SELECT *, sum(size) OVER (ORDER BY t, h, pass ROWS UNBOUNDED PRECEDING) AS upto FROM t),
n AS (SELECT doc_id, h, count(*) AS passes FROM c WHERE upto <= (SELECT sum(source_size) FROM s) GROUP BY doc_id, h)
SELECT q.doc_id, size, source_size, target, CAST(coalesce(passes, 0) * size AS BIGINT) AS taken
FROM q LEFT JOIN n ON q.doc_id IS NOT DISTINCT FROM n.doc_id AND q.h = n.h"""

_FINITE = "len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _floor_div(s: str, n: str) -> str:
    return f"CAST(({s} - (({s} % {n}) + {n}) % {n}) // {n} AS BIGINT)"


def _whole_sql(scale: int) -> str:
    return f"list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT))"


_GAP = "CAST(list_sum(list_transform({a}, lambda x, i: (x - {b}[i]) * (x - {b}[i]))) AS BIGINT)"


def _centroids_sql(rounds: int = 3) -> str:
    steps = [
        f"v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, {_whole_sql(64)} AS q FROM embeddings WHERE len(embedding) = 64 AND {_FINITE})",
        "c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), q) - 1 AS c, q FROM v QUALIFY c < 16)",
    ]
    for k in range(rounds + 1):
        steps.append(f"a{k} AS MATERIALIZED (SELECT r, v.vec_id, v.q, c, {_GAP.format(a='v.q', b='c0.q')} AS d FROM v, c{k} AS c0 QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)")
        if k < rounds:
            steps.append(f"m{k} AS (SELECT c, i, sum(x) AS s, count(*) AS n FROM (SELECT c, unnest(q) AS x, generate_subscripts(q, 1) AS i FROM a{k}) GROUP BY c, i)")
            steps.append(f"n{k} AS (SELECT c, list({_floor_div('s', 'n')} ORDER BY i) AS q FROM m{k} GROUP BY c)")
            steps.append(f"c{k + 1} AS MATERIALIZED (SELECT c, coalesce(n{k}.q, c{k}.q) AS q FROM c{k} LEFT JOIN n{k} USING (c))")
    return f"""WITH {', '.join(steps)}
SELECT vec_id, CAST(c AS INT) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c{rounds}.q, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (c)"""


def _codes_sql(rounds: int = 4) -> str:
    steps = [
        f"v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, {_whole_sql(1024)} AS q FROM embeddings WHERE embedding IS NOT NULL AND {_FINITE})",
        "p AS MATERIALIZED (SELECT r, vec_id, pos, list_slice(q, len(q) // 4 * pos + 1, len(q) // 4 * (pos + 1)) AS q FROM v, (SELECT unnest([0, 1, 2, 3]) AS pos))",
        "e0 AS MATERIALIZED (SELECT pos, row_number() OVER (PARTITION BY pos ORDER BY vec_id, r) - 1 AS e, q FROM p QUALIFY e < 256)",
    ]
    for k in range(rounds + 1):
        gap = _GAP.format(a="p.q", b="e.q")
        steps.append(f"a{k} AS MATERIALIZED (SELECT r, p.pos, p.q, e.e, {gap} AS d FROM p JOIN e{k} AS e ON p.pos = e.pos QUALIFY row_number() OVER (PARTITION BY r, p.pos ORDER BY d, e.e) = 1)")
        if k < rounds:
            steps.append(f"m{k} AS (SELECT pos, e, i, sum(x) AS s, count(*) AS n FROM (SELECT pos, e, unnest(q) AS x, generate_subscripts(q, 1) AS i FROM a{k}) GROUP BY pos, e, i)")
            steps.append(f"n{k} AS (SELECT pos, e, list({_floor_div('s', 'n')} ORDER BY i) AS q FROM m{k} GROUP BY pos, e)")
            steps.append(f"e{k + 1} AS MATERIALIZED (SELECT pos, e, coalesce(n{k}.q, e{k}.q) AS q FROM e{k} LEFT JOIN n{k} USING (pos, e))")
    return f"""WITH {', '.join(steps)},
coded AS (SELECT r, string_agg(lower(printf('%02x', e)), '' ORDER BY pos) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(q, ','), ',' ORDER BY pos, e)) FROM e{rounds}) AS codebooks_sha256
FROM coded JOIN v USING (r)"""


ORACLES = {"op11_centroids": _centroids_sql(), "op13_vector_codes": _codes_sql(), "op4_secrets": _secrets_sql(), "op6_chat": _chat_sql(), "op7_mixing": MIX_SQL}
