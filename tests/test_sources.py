"""Table functions over sources, leak flow and the findings made of them, on hand-written files."""

import pytest

from assay.functions.docker_facts import docker_facts
from assay.functions.python_facts import python_facts
from assay.functions.shell_facts import shell_lines
from assay.operators import leaks as L
from assay.operators import sources as S

FILE = "task string, rel_path string, text string"
HEAD = "import os, pytest\ndef check(x):\n    assert x\n"


def kinds(source):
    return [(f, k) for f, _, k, *_ in python_facts(source) if k not in ("test", "literal", "literal-file")]


@pytest.mark.parametrize(
    ("body", "kind"),
    [
        ("pass", "vacuous"),
        ('"words"\n    return', "vacuous"),
        ("assert True", "vacuous"),
        ("assert 0", None),
        ("f()\n    return", "no-assertion"),
        ("check(1)", None),
        ("raise ValueError", None),
        ("self.assertEqual(a, b)", None),
        ("pytest.fail('x')", None),
        ("with pytest.raises(ValueError):\n        f()", None),
        ("try:\n        assert f()\n    except Exception:\n        pass", "swallowed"),
        ("try:\n        f()\n    except Exception:\n        pass\n    assert f()", None),
        ("try:\n        assert f()\n    except Exception:\n        raise", None),
        ("assert os.path.exists('/a')\n    assert Path('/b').is_file()", "existence-only"),
        ("assert os.path.exists('/a') and f()", None),
        ("for x in y:\n        assert x == z", None),
    ],
)
def test_one_verdict_a_function(body, kind):
    assert kinds(f"{HEAD}def test_x():\n    {body}\n    ") == ([] if kind is None else [("test_x", kind)])


def test_whole_files():
    literal = 'import json\ndef test_a():\n    g = open("/app/a.txt").read().strip()\n    assert g == "v" and -5 < h\ndef test_b():\n    assert int(open("/app/b").read()) == 7\n'
    assert (None, "literal-only") in kinds(literal)
    assert sorted((p, v) for _, _, k, p, v in python_facts(literal) if k == "literal-file") == [("/app/a.txt", "v"), ("/app/b", "7")]
    assert [v for *_, k, _, v in python_facts(literal) if k == "literal"] == ["'v'", "-5", "7"]
    for extra in ("import numpy", "x = sorted(y)", "subprocess.run(z)", "x = [y for y in z]", "hashlib.sha256(b)", "sys.path.insert(0, 'x')", "def test_c():\n    assert f()"):
        assert (None, "literal-only") not in kinds(f"{literal}{extra}\n")
    assert kinds("from solution.fix import f\n") == [(None, "imports-solution")]
    assert kinds("@pytest.mark.xfail\ndef test_a():\n    check()\n    assert f()\n@pytest.mark.parametrize('x', ())\nasync def test_b(x):\n    assert x\n") == [("test_a", "skipped"), ("test_b", "empty-parametrize")]
    two = 'def test_a():\n    g = open("/a").read()\n    assert g == "1"\ndef test_b():\n    g = open("/b").read()\n    assert g == "2"\n'
    assert sorted((p, v) for _, _, k, p, v in python_facts(two) if k == "literal-file") == [("/a", "1"), ("/b", "2")]


@pytest.mark.parametrize("source", ["def x(:", "a\0b", "(" * 5000, "-" * 100000 + "1", "x" + ".a" * 200000])
def test_a_source_that_cannot_be_read_is_a_row(source):
    found = list(python_facts(source))
    assert all(k == "syntax-error" for _, _, k, *_ in found) and len(found) <= 1


def test_empty_sources():
    assert not list(python_facts(None)) + list(python_facts(" \n")) + list(docker_facts(None)) + list(docker_facts("")) + list(shell_lines(None))


def test_docker_lexer():
    text = "# FROM no\nFROM a AS b\nRUN cat <<EOF > /x\nFROM evil\nUSER b\nEOF\nRUN echo a \\\n  # note\n\n  && echo b\nCOPY <<A <<-'B' /d/\nFROM one\nA\nUSER two\n\tB\nuser me\nFROM c\nRUN cat <<E\nFROM zzz"
    assert list(docker_facts(text)) == [
        (1, 2, "FROM", "a AS b", None),
        (1, 3, "RUN", "cat <<EOF > /x", "FROM evil\nUSER b"),
        (1, 7, "RUN", "echo a && echo b", None),
        (1, 11, "COPY", "<<A <<-'B' /d/", "FROM one\nUSER two"),
        (1, 16, "USER", "me", None),
        (2, 17, "FROM", "c", None),
        (2, 18, "RUN", "cat <<E", "FROM zzz"),
    ]
    assert len(list(docker_facts("# c\n" * 100000 + "FROM a\n" + "RUN x\n" * 50000))) == 50001


def test_shell_lines_carry_their_state():
    text = "#!/bin/bash\nset -euo pipefail\nif a; then\n  b\nfi\nset +e; cat <<EOF\nset -e\nEOF\nif x; then y; fi\nz"
    assert [x[1:] for x in shell_lines(text)] == [
        ("set -euo pipefail", 0, False, None),
        ("if a; then", 1, True, None),
        ("b", 1, True, None),
        ("fi", 1, True, None),
        ("set +e; cat <<EOF", 0, True, None),
        ("set -e", 0, False, "EOF"),
        ("if x; then y; fi", 1, False, None),
        ("z", 0, False, None),
    ]


def found(df):
    return sorted((r["task"], r["title"], r["detail"]) for r in df.collect())


def test_docker_findings(spark):
    texts = {
        "a": "FROM python\nRUN <<EOF\napt-get install -y x\npip install y z==1 -r req.txt ./w\nEOF\n",
        "b": "FROM scratch\nFROM $BASE\nFROM public.ecr.aws/docker/library/python:3.12@sha256:1\nRUN apt-get update && apt install x\n",
        "c": "FROM golang:1 AS g\nRUN go build\nFROM scratch\n",
        "d": "FROM golang:1\nRUN go build\nADD --chown=x https://a/b /c\nENTRYPOINT x\n",
        "e": "# nothing\n",
    }
    files = spark.createDataFrame([(t, S.DOCKERFILE, x) for t, x in texts.items()] + [("f", S.DOCKERFILE, None), ("a", "other", "FROM x")], FILE)
    assert found(S.docker_findings(files)) == [
        ("a", "apt-no-update", ""),
        ("a", "dockerfile-heredoc-source", "2"),
        ("a", "unpinned-base-image", "python"),
        ("a", "unpinned-pip", "y"),
        ("d", "add-remote-url", "3"),
        ("d", "dockerfile-entrypoint", "4"),
        ("d", "missing-multistage-build", ""),
    ]
    held = found(S.docker_findings(files, files.select("task").distinct()))
    assert ("c", "base-image-not-digest-pinned", "golang:1") in held and ("d", "base-image-not-approved", "golang:1") in held and not [x for x in held if x[0] == "b"]
    assert found(S.docker_findings(files.limit(0))) == []


def test_verifier_findings(spark):
    texts = {
        "a": "pytest -q || true\npip install pytest || true\n",
        "b": "x\necho 1 > /logs/reward.txt\n",
        "c": "pytest\nif [ $? -eq 0 ]; then\n" + ":\n" * 9 + "echo 1 > /logs/verifier/reward.txt\nfi\n",
        "d": "set -e\npytest -q\nRC=$?\necho $RC > /logs/verifier/reward.txt\n",
        "e": "set -e\nset +e\npytest -q\nRC=$?\necho $RC > /logs/verifier/reward.txt\n",
        "f": "cat <<EOF\necho 1 > /logs/reward.txt\nEOF\n",
        "g": "test_status=$?\n" + ":\n" * 5 + "echo 1 > /r/reward.txt\n",
        "h": "test_status=$?\n" + ":\n" * 6 + "echo 1 > /r/reward.txt\n",
    }
    files = spark.createDataFrame([(t, S.TEST_SH, x) for t, x in texts.items()], FILE)
    assert [x[:2] for x in found(S.verifier_findings(files))] == [("a", "test-sh-swallows-failure"), ("b", "unconditional-reward"), ("d", "test-sh-set-e-reward-abort"), ("h", "unconditional-reward")]
    assert [x[:2] for x in found(S.verifier_findings(files, files)) if x[1] in ("test-runtime-install", "reward-path-nonstandard")] == [("a", "test-runtime-install"), ("b", "reward-path-nonstandard"), ("g", "reward-path-nonstandard"), ("h", "reward-path-nonstandard")]


def test_leak_flow(spark):
    read = 'assert open("{}").read() == x\n'
    packages = {
        "bake": {S.DOCKERFILE: "FROM a\nRUN echo 1 > /tests/e.txt\n", S.TEST_PY: "f('e.txt')"},
        "unread": {S.DOCKERFILE: "FROM a\nRUN echo 1 > /tests/e.txt\n"},
        "gone": {S.DOCKERFILE: "FROM a\nRUN echo 1 > /tests/t/e.txt\nRUN rm -rf /tests/t /tmp/x\n"},
        "beside": {S.DOCKERFILE: "FROM a\nRUN echo 1 > /tests/tt/e.txt\nRUN rm -rf /tests/t\n"},
        "heredoc": {S.DOCKERFILE: "FROM a\nRUN cat <<EOF > /opt/truth.csv\n1\nEOF\n", S.TEST_PY: read.format("/opt/truth.csv")},
        "copied": {S.DOCKERFILE: "FROM a\nCOPY a/values.txt b.txt /opt/\n", S.TEST_PY: read.format("/x/values.txt")},
        "told": {S.DOCKERFILE: "FROM a\nCOPY values.txt /opt/values.txt\n", S.TEST_PY: read.format("/opt/values.txt"), "instruction.md": "Read the VALUES."},
        "spec": {S.DOCKERFILE: "FROM a\nCOPY want.json /opt/want.json\n", S.TEST_PY: read.format("/opt/want.json")},
        "input": {S.DOCKERFILE: "FROM a\nCOPY x.csv /opt/data/x.csv\n", S.TEST_PY: read.format("/opt/data/x.csv")},
        "rerun": {S.DOCKERFILE: "FROM a\nCOPY v.txt /opt/mutated_v.txt\n", S.TEST_PY: read.format("/opt/mutated_v.txt")},
        "named": {"environment/setup.sh": "cp a /srv/golden.bin\n"},
        "solve": {S.TEST_PY: read.format("/app/answer.txt"), S.SOLVE: "cat /app/answer.txt\n"},
        "made": {S.TEST_PY: read.format("/app/answer.txt"), S.SOLVE: "x > /app/answer.txt\ncat /app/answer.txt\n"},
        "opened": {S.TEST_PY: read.format("/app/answer.txt"), S.SOLVE: "open('/app/answer.txt', 'w').write(x)\n"},
        "guard": {S.DOCKERFILE: "FROM a\nRUN chmod 400 /opt/grader.py\n"},
        "dropped": {S.DOCKERFILE: "FROM a\nRUN chmod 400 /opt/grader.py\nUSER me\n"},
        "clean": {S.DOCKERFILE: "FROM a\nRUN echo 1 2>/dev/null > /tmp/truth\n", S.TEST_PY: None},
    }
    files = spark.createDataFrame([(t, p, x) for t, fs in packages.items() for p, x in fs.items()], FILE)
    assert found(L.leak_findings(files)) == sorted(
        [
            ("bake", "tests-bake-verifier-reads", "/tests/e.txt"),
            ("unread", "tests-bake-unread", "/tests/e.txt"),
            ("gone", "tests-bake-removed", "/tests/t/e.txt"),
            ("beside", "tests-bake-unread", "/tests/tt/e.txt"),
            ("heredoc", "truth-baked-verifier-reads", "/opt/truth.csv"),
            ("copied", "truth-baked-verifier-reads", "/opt/values.txt"),
            ("told", "verifier-reads-instruction-input", "/opt/values.txt"),
            ("spec", "verifier-reads-config-spec", "/opt/want.json"),
            ("named", "truth-named-baked", "/srv/golden.bin"),
            ("solve", "reference-solve-reads-truth", "/app/answer.txt"),
            ("guard", "chmod-not-a-guard", "/opt/grader.py"),
        ]
    )
    assert found(L.leak_findings(files.limit(0))) == []


def test_package_source_walks_prunes_and_reads(spark, tmp_path):
    from assay.sources.packages import register

    tree = {
        "b/one/task.toml": b"x = 1",
        "b/one/tests/test_outputs.py": b"assert 1",
        "b/one/inner/task.toml": b"no package of its own",
        "b/one/.git/config": b"pruned",
        "a/two/filesystem/task.toml": b"",
        "a/two/filesystem/instruction.md": b"caf\xe9",
        "c/one/task.toml": b"second of its name",
        "a/node_modules/three/task.toml": b"pruned",
        "a/loose.txt": b"no package",
    }
    for path, content in tree.items():
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_bytes(content)
    read = register(spark).read.format("task_packages")
    df = read.option("packagesPerPartition", 1).load(str(tmp_path))
    assert df.rdd.getNumPartitions() == 2
    assert {(r["task"], r["rel_path"], r["size"], r["text"]) for r in df.collect()} == {
        ("one", "task.toml", 5, "x = 1"),
        ("one", "tests/test_outputs.py", 8, "assert 1"),
        ("one", "inner/task.toml", 21, "no package of its own"),
        ("two", "task.toml", 0, ""),
        ("two", "instruction.md", 4, "caf�"),
    }
    assert read.load(f"file://{tmp_path}/c").select("task", "text").collect() == [("one", "second of its name")]
    assert read.load(f"{tmp_path}/none").count() == 0 == read.load(f"{tmp_path}/a/node_modules/none").count()


def test_findings_alone_equal_those_among_all_facts(spark, monkeypatch):
    source = "import solution\ndef test_a():\n    assert f() == 1\ndef test_b():\n    pass\n@pytest.mark.skip\ndef test_c():\n    try:\n        assert g(open('/x').read()) == 'y'\n    except Exception:\n        pass\n"
    for text in (source, source.replace("f()", "len(f())"), "def test_a():\n    assert f() == -1\n", "def broken(:"):
        every = [x for x in python_facts(text) if x[2] not in ("test", "literal", "literal-file")]
        assert list(python_facts(text, literals=False)) == every and every
    asked = []
    monkeypatch.setattr(S, "python_facts", lambda files, literals=True, f=S.python_facts: asked.append(literals) or f(files, literals))
    files = spark.createDataFrame([("t", S.TEST_PY, source)], "task string, rel_path string, text string")
    assert {r["title"] for r in S.test_findings(files).collect()} == {"vacuous-test", "skipped-scored-test", "swallowed-assertion", "test-imports-solution"} and asked == [False]
