"""Task packages with contents, made from the words of whole documents, and the queries over their files.

Every line of a document becomes a piece of each file: its length picks the kind of piece, its first lower-case word stands
in it. The SQL never sees the files; it says from the lines alone what must be found in them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.operators import leaks as L
from assay.operators import sources as S
from assay.plans.registry import query
from assay.session import ship, table

# Pieces by length of the line, modulo their number; {w} is the word, {n} the length, {i} the line's number.
DOCKER = (
    "RUN apt-get install -y {w}",
    "RUN pip install {w}",
    "RUN pip install {w}==1.0 {w}x",
    "RUN cat <<EOF > /app/{w}.py\nFROM {w}\nUSER {w}\nEOF",
    "RUN echo {w} \\\n  # note\n  && apt-get install -y {w}",
    "COPY {w}.txt src/{w}.csv /app/",
    "# FROM {w}",
    "RUN echo 1 > /tests/{w}.txt",
    "RUN rm -rf /tests/{w}.txt /app/{w}.csv",
    "RUN echo 1 > /opt/{w}_truth.txt && chmod 400 /opt/{w}_truth.txt",
    "RUN rm -rf /app",
    "USER {w}",
    "",
)
PYTHON = (
    'def test_{i}():\n    assert open("/app/{w}.csv").read().strip() == "{w}{n}"',
    "def test_{i}():\n    pass",
    'def test_{i}():\n    "about {w}"\n    assert True',
    'def test_{i}():\n    assert os.path.exists("/app/{w}")',
    'def test_{i}():\n    try:\n        assert work("{w}")\n    except Exception:\n        pass',
    'def test_{i}():\n    work("{w}")',
    'def test_{i}():\n    check("{w}")',
    'def test_{i}():\n    got = open("/opt/{w}_truth.txt").read()\n    assert got == {n}',
    '@pytest.mark.skip\ndef test_{i}():\n    assert work("{w}") != -{n}',
    '@pytest.mark.parametrize("x", [])\ndef test_{i}(x):\n    raise ValueError("{w}")',
    "# {w}",
)
SHELL = (
    "pytest /tests/{w}.py || true",
    "echo 1 > /logs/{w}_reward.txt",
    "if [ -f /tmp/{w} ]; then\n  echo 1 > /logs/verifier/reward.txt\nfi",
    "set -e",
    "set +e",
    "pytest -q {w}.txt",
    "cat <<EOF > /tmp/{w}\necho 1 > /logs/reward.txt\nset -e\nEOF",
    "RC=$?",
    "pip install {w}",
    "# echo 1 > /logs/reward.txt",
)
SOLVE = ("cat /opt/{w}_truth.txt", "echo x > /opt/{w}_truth.txt", "true", "python3 fix.py {w}")
BASES = ("FROM python", "FROM --platform=linux ubuntu:latest AS b", "FROM python:3.12@sha256:ab", "FROM reg.example/a/node:20", "")
HEAD = "import os\ndef check(x):\n    assert x"


def _lines():
    word = lambda line: F.concat(F.lit("w"), F.regexp_extract(line, "([a-z]+)", 1))
    return F.transform(F.split(F.coalesce("text", F.lit("")), "\n", -1), lambda x, i: F.struct(F.length(x).alias("n"), word(x).alias("w"), (i + 1).alias("i")))


def _written(pieces: tuple[str, ...], begin, end=None):
    def one(x):
        text = F.element_at(F.array(*map(F.lit, pieces)), x["n"] % len(pieces) + 1)
        for name in "wni":
            text = F.replace(text, F.lit(f"{{{name}}}"), x[name].cast("string"))
        return text

    return F.array_join(F.concat(F.array(begin), F.transform("lines", one), F.array() if end is None else end), "\n")


def files(spark: SparkSession, d: str) -> DataFrame:
    """(task, rel_path, text): six files for each document."""
    # a table may be one row group, which one task reads; files are written and read by as many as there are cores
    docs = table(ship(spark), d, "documents").select(F.col("doc_id").alias("task"), "text").repartition("task")
    docs = docs.select("task", F.length(F.coalesce("text", F.lit(""))).alias("size"), _lines().alias("lines"))
    base = F.element_at(F.array(*map(F.lit, BASES)), F.size("lines") % len(BASES) + 1)
    end = F.array_compact(F.array(F.when(F.col("size") % 5 == 0, F.lit("import solution")), F.when(F.col("size") % 7 == 0, F.lit("def broken(:"))))
    told = F.array_join(F.transform(F.filter("lines", lambda x: x["n"] % 2 == 0), lambda x: F.concat(F.lit("use "), x["w"])), "\n")
    made = {S.DOCKERFILE: _written(DOCKER, base), S.TEST_PY: _written(PYTHON, F.lit(HEAD), end), S.TEST_SH: _written(SHELL, F.lit("#!/bin/bash")), S.SOLVE: _written(SOLVE, F.lit("#!/bin/bash")), "instruction.md": told, "task.toml": F.concat(F.lit("[metadata]\nsize = "), F.col("size").cast("string"))}
    each = F.array(*[F.struct(F.lit(p).alias("rel_path"), t.alias("text")) for p, t in made.items()])
    return docs.select("task", F.explode(each).alias("f")).select("task", "f.rel_path", "f.text")


def delivered(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where(F.length(F.coalesce("text", F.lit(""))) % 2 == 0).select(F.col("doc_id").alias("task")).distinct()


_LN = """ln AS MATERIALIZED (
  SELECT task, size, i, length(l) AS n, 'w' || regexp_extract(l, '[a-z]+') AS w, length(l) % 13 AS dk, length(l) % 11 AS py, length(l) % 10 AS sh, length(l) % 4 AS so, count(*) OVER (PARTITION BY task) AS lines
  FROM (SELECT doc_id AS task, length(coalesce(text, '')) AS size, unnest(string_split(coalesce(text, ''), chr(10))) AS l, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents))"""


def _at(kind: str, pieces: tuple[str, ...], before: int) -> str:
    """First line of a piece: after ``before`` lines and all pieces above it."""
    sizes = f"[{', '.join(str(p.count(chr(10)) + 1) for p in pieces)}][{kind} + 1]"
    return f"CAST({before} + 1 + sum({sizes}) OVER (PARTITION BY task ORDER BY i) - {sizes} AS INT)"


DOCKER_SQL = f"""{_LN},
dk AS MATERIALIZED (SELECT *, {_at('dk', DOCKER, 1)} AS line FROM ln),
steps AS (
  SELECT task, 1 AS line, 'FROM' AS instr, ['python', '--platform=linux ubuntu:latest AS b', 'python:3.12@sha256:ab', 'reg.example/a/node:20'][max(lines) % 5 + 1] AS args, NULL AS body FROM dk WHERE lines % 5 < 4 GROUP BY task
  UNION ALL SELECT task, line, CASE dk WHEN 5 THEN 'COPY' WHEN 11 THEN 'USER' ELSE 'RUN' END,
    CASE dk WHEN 0 THEN 'apt-get install -y ' || w WHEN 1 THEN 'pip install ' || w WHEN 2 THEN 'pip install ' || w || '==1.0 ' || w || 'x' WHEN 3 THEN 'cat <<EOF > /app/' || w || '.py'
      WHEN 4 THEN 'echo ' || w || ' && apt-get install -y ' || w WHEN 5 THEN w || '.txt src/' || w || '.csv /app/' WHEN 7 THEN 'echo 1 > /tests/' || w || '.txt' WHEN 8 THEN 'rm -rf /tests/' || w || '.txt /app/' || w || '.csv'
      WHEN 9 THEN 'echo 1 > /opt/' || w || '_truth.txt && chmod 400 /opt/' || w || '_truth.txt' WHEN 10 THEN 'rm -rf /app' WHEN 11 THEN w END,
    CASE WHEN dk = 3 THEN 'FROM ' || w || chr(10) || 'USER ' || w END
  FROM dk WHERE dk NOT IN (6, 12))"""


@query(f"WITH {DOCKER_SQL} SELECT * FROM steps")
def docker_instructions(spark, d):
    return S.docker_instructions(files(spark, d)).select("task", "line", "instr", "args", "body")


@query(f"""WITH {DOCKER_SQL},
pip AS (SELECT task, string_agg(DISTINCT CASE WHEN dk = 2 THEN w || 'x' ELSE w END, ', ' ORDER BY CASE WHEN dk = 2 THEN w || 'x' ELSE w END) AS detail FROM dk WHERE dk IN (1, 2) GROUP BY task),
apt AS (SELECT task, count(*) AS n FROM dk WHERE dk IN (0, 4) GROUP BY task),
ref AS (SELECT DISTINCT task, lines % 5 AS k, size FROM dk),
found AS (
  SELECT task, 'FAIL' AS severity, 'unpinned-base-image' AS title, ['python', 'ubuntu:latest'][k + 1] AS detail FROM ref WHERE k < 2
  UNION ALL SELECT task, 'FAIL', 'base-image-not-digest-pinned', 'reg.example/a/node:20' FROM ref WHERE k = 3 AND size % 2 = 0
  UNION ALL SELECT task, 'FAIL', 'base-image-not-approved', ['python', 'ubuntu:latest', 'python:3.12@sha256:ab', 'reg.example/a/node:20'][k + 1] FROM ref WHERE k < 4 AND size % 2 = 0
  UNION ALL SELECT task, 'FAIL', 'apt-no-update', '' FROM apt
  UNION ALL SELECT task, 'WARN', 'apt-not-consolidated', CAST(n AS VARCHAR) FROM apt WHERE n > 1
  UNION ALL SELECT task, 'WARN', 'unpinned-pip', detail FROM pip
  UNION ALL SELECT task, 'FAIL', 'dockerfile-heredoc-source', CAST(min(line) AS VARCHAR) FROM dk WHERE dk = 3 GROUP BY task)
SELECT task, 'dockerfile' AS area, severity, title, 'environment/Dockerfile' AS location, detail FROM found""")
def docker_findings(spark, d):
    return S.docker_findings(files(spark, d), delivered(spark, d))


PYTHON_SQL = f"""{_LN},
py AS MATERIALIZED (SELECT *, {_at('py', PYTHON, 3)} AS head FROM ln),
whole AS (SELECT task, size, max(head + [{', '.join(str(p.count(chr(10)) + 1) for p in PYTHON)}][py + 1]) AS last FROM py GROUP BY task, size),
t AS (SELECT *, 'test_' || i AS function, CAST(head + CASE WHEN py IN (8, 9) THEN 1 ELSE 0 END AS INT) AS line FROM py WHERE size % 7 <> 0),
facts AS (
  SELECT task, NULL AS function, CAST(last + CASE WHEN size % 5 = 0 THEN 1 ELSE 0 END AS INT) AS line, 'syntax-error' AS kind, NULL AS path, NULL AS value FROM whole WHERE size % 7 = 0
  UNION ALL SELECT task, NULL, CAST(last AS INT), 'imports-solution', NULL, NULL FROM whole WHERE size % 7 <> 0 AND size % 5 = 0
  UNION ALL SELECT task, NULL, NULL, 'literal-only', NULL, NULL FROM t WHERE size % 5 <> 0 GROUP BY task HAVING bool_or(py IN (0, 7, 8)) AND NOT bool_or(py IN (2, 3, 4))
  UNION ALL SELECT task, function, line, 'test', NULL, NULL FROM t WHERE py < 10
  UNION ALL SELECT task, function, line, CASE WHEN py < 3 THEN 'vacuous' WHEN py = 3 THEN 'existence-only' WHEN py = 4 THEN 'swallowed' WHEN py = 5 THEN 'no-assertion' WHEN py = 8 THEN 'skipped' ELSE 'empty-parametrize' END, NULL, NULL FROM t WHERE py IN (1, 2, 3, 4, 5, 8, 9)
  UNION ALL SELECT task, function, CAST(line + CASE WHEN py = 7 THEN 2 ELSE 1 END AS INT), 'literal', NULL, CASE py WHEN 0 THEN '''' || w || n || '''' WHEN 7 THEN CAST(n AS VARCHAR) ELSE '-' || n END FROM t WHERE py IN (0, 7, 8)
  UNION ALL SELECT task, NULL, CAST(line + CASE WHEN py = 7 THEN 2 ELSE 1 END AS INT), 'literal-file', CASE py WHEN 0 THEN '/app/' || w || '.csv' ELSE '/opt/' || w || '_truth.txt' END, CASE py WHEN 0 THEN w || n ELSE CAST(n AS VARCHAR) END FROM t WHERE py IN (0, 7))"""


@query(f"WITH {PYTHON_SQL} SELECT * FROM facts")
def python_facts(spark, d):
    facts = S.python_facts(files(spark, d))
    return facts.select("task", "function", "line", "kind", "path", F.when(F.col("kind") != "syntax-error", F.col("value")).alias("value"))


@query(f"""WITH {PYTHON_SQL}, titled(kind, area, title) AS (VALUES {', '.join(str(x) for x in S.PYTHON_TITLES)})
SELECT area, title, count(*) AS n, count(DISTINCT task) AS tasks FROM facts JOIN titled USING (kind) GROUP BY area, title""")
def test_source_findings(spark, d):
    return S.test_findings(files(spark, d)).groupBy("area", "title").agg(F.count("*").alias("n"), F.count_distinct("task").alias("tasks"))


SHELL_SQL = f"""{_LN},
sh AS MATERIALIZED (SELECT *, {_at('sh', SHELL, 1)} AS line FROM ln),
cmd AS MATERIALIZED (
  SELECT task, size, i, line, sh, 0 AS part FROM sh WHERE sh < 9
  UNION ALL SELECT task, size, i, line + 1, sh, 1 FROM sh WHERE sh = 2 UNION ALL SELECT task, size, i, line + 2, sh, 2 FROM sh WHERE sh = 2),
state AS (SELECT *, bool_or((sh = 2 AND part = 0) OR sh = 7) OVER (PARTITION BY task ORDER BY line RANGE BETWEEN 6 PRECEDING AND CURRENT ROW) OR (sh = 2) AS guarded,
  coalesce(last_value(CASE sh WHEN 3 THEN true WHEN 4 THEN false END IGNORE NULLS) OVER (PARTITION BY task ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS stops FROM cmd),
per AS (
  SELECT task, any_value(size) AS size, min(line) FILTER (WHERE sh = 0) AS swallows, min(line) FILTER (WHERE sh = 1 AND NOT guarded) AS free, min(line) FILTER (WHERE sh = 5 AND stops) AS stopped, bool_or(sh = 7) AS branches,
    bool_or(sh = 1 OR sh = 2) AS rewards, min(line) FILTER (WHERE sh = 8) AS fetches, min(line) FILTER (WHERE sh = 1 OR (sh = 2 AND part = 1)) AS odd, bool_or(sh = 2) AS standard
  FROM state GROUP BY task),
found AS (
  SELECT task, 'test-sh-swallows-failure' AS title, swallows AS line FROM per WHERE swallows IS NOT NULL
  UNION ALL SELECT task, 'unconditional-reward', free FROM per WHERE free IS NOT NULL
  UNION ALL SELECT task, 'test-sh-set-e-reward-abort', stopped FROM per WHERE stopped IS NOT NULL AND branches AND rewards
  UNION ALL SELECT task, 'test-runtime-install', fetches FROM per WHERE fetches IS NOT NULL AND size % 2 = 0
  UNION ALL SELECT task, 'reward-path-nonstandard', odd FROM per WHERE odd IS NOT NULL AND NOT standard AND size % 2 = 0)"""


@query(f"WITH {SHELL_SQL} SELECT task, 'anti_cheat' AS area, 'FAIL' AS severity, title, 'tests/test.sh:' || line AS location, '' AS detail FROM found")
def verifier_findings(spark, d):
    return S.verifier_findings(files(spark, d), delivered(spark, d))


@query(f"""WITH {_LN},
tests AS (SELECT DISTINCT task, w, EXISTS (SELECT 1 FROM ln g WHERE g.task = ln.task AND g.dk = 8 AND g.w = ln.w) AS gone FROM ln WHERE dk = 7),
seen AS (SELECT task, string_agg(w || '.txt', ' ') AS txt FROM ln WHERE sh = 5 GROUP BY task),
told AS (SELECT task, string_agg('use ' || w, chr(10)) AS txt FROM ln WHERE n % 2 = 0 GROUP BY task),
cat AS (SELECT task, string_agg('/opt/' || w || '_truth.txt', ' ') AS txt FROM ln WHERE so = 0 GROUP BY task),
put AS (SELECT task, string_agg('/opt/' || w || '_truth.txt', ' ') AS txt FROM ln WHERE so = 1 GROUP BY task),
t1 AS (SELECT tests.task, bool_and(gone) AS all_gone, string_agg('/tests/' || w || '.txt', ', ' ORDER BY w) AS every, string_agg('/tests/' || w || '.txt', ', ' ORDER BY w) FILTER (WHERE NOT gone) AS rest,
  string_agg('/tests/' || w || '.txt', ', ' ORDER BY w) FILTER (WHERE NOT gone AND contains(coalesce(txt, ''), w || '.txt')) AS met FROM tests LEFT JOIN seen USING (task) GROUP BY tests.task),
baked AS (
  SELECT DISTINCT task, '/app/' || w || '.csv' AS path, w, 'csv' AS kind FROM ln WHERE dk = 5 AND NOT EXISTS (SELECT 1 FROM ln g WHERE g.task = ln.task AND ((g.dk = 8 AND g.w = ln.w) OR g.dk = 10))
  UNION ALL SELECT DISTINCT task, '/opt/' || w || '_truth.txt', w, 'truth' FROM ln WHERE dk = 9),
hit AS (SELECT baked.* FROM baked WHERE EXISTS (SELECT 1 FROM ln g WHERE g.task = baked.task AND g.w = baked.w AND g.py = CASE kind WHEN 'csv' THEN 0 ELSE 7 END)),
h1 AS (SELECT hit.task, string_agg(path, ', ' ORDER BY path) AS detail, bool_and(kind = 'csv' AND length(w) > 3 AND contains(coalesce(txt, ''), w)) AS told FROM hit LEFT JOIN told USING (task) GROUP BY hit.task),
b1 AS (SELECT task, string_agg(path, ', ' ORDER BY path) AS detail FROM baked WHERE kind = 'truth' AND task NOT IN (SELECT task FROM h1) GROUP BY task),
u1 AS (SELECT r.task, string_agg('/opt/' || w || '_truth.txt', ', ' ORDER BY '/opt/' || w || '_truth.txt') AS detail FROM (SELECT DISTINCT task, w FROM ln WHERE py = 7) r LEFT JOIN cat USING (task) LEFT JOIN put USING (task)
  WHERE (contains(coalesce(cat.txt, ''), w || '_truth.txt')) AND NOT contains(coalesce(put.txt, ''), w || '_truth.txt') GROUP BY r.task),
c1 AS (SELECT task, string_agg(DISTINCT '/opt/' || w || '_truth.txt', ', ' ORDER BY '/opt/' || w || '_truth.txt') AS detail FROM ln WHERE dk = 9 AND task NOT IN (SELECT task FROM ln WHERE dk = 11) GROUP BY task),
found AS (
  SELECT task, CASE WHEN all_gone THEN 'tests-bake-removed' WHEN met IS NOT NULL THEN 'tests-bake-verifier-reads' ELSE 'tests-bake-unread' END AS title, 'environment/Dockerfile' AS location, CASE WHEN all_gone THEN every WHEN met IS NOT NULL THEN met ELSE rest END AS detail FROM t1
  UNION ALL SELECT task, CASE WHEN told THEN 'verifier-reads-instruction-input' ELSE 'truth-baked-verifier-reads' END, 'environment/Dockerfile', detail FROM h1
  UNION ALL SELECT task, 'truth-named-baked', 'environment/Dockerfile', detail FROM b1
  UNION ALL SELECT task, 'reference-solve-reads-truth', 'solution/solve.sh', detail FROM u1
  UNION ALL SELECT task, 'chmod-not-a-guard', 'environment/Dockerfile', detail FROM c1)
SELECT task, 'anti_cheat' AS area, 'FAIL' AS severity, title, location, detail FROM found""")
def leak_findings(spark, d):
    return L.leak_findings(files(spark, d))
