"""Instructions of Dockerfiles: a table function, to be joined laterally to a table of files.

    files.lateralJoin(DockerFacts(F.col("text").outer()))

gives one row an instruction: stage (0 before the first FROM), line, instr in upper case, args with continuations folded
into blanks, and body (the lines of its heredocs, null without any). A
heredoc's lines are part of its instruction and never instructions themselves; one without its end takes the rest of the
file. Blank lines and comments are passed over, within a continued instruction too. A null or blank text has no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql.functions import udtf

HEREDOC = re.compile(r"<<[-~]?\s*[\"']?(\w+)[\"']?")


def docker_facts(text: str | None) -> Iterator[tuple[int, int, str, str, str | None]]:
    stage, start, held, body, marks = 0, 0, [], [], []
    continued = heredoc = False

    def taken() -> Iterator[tuple[int, int, str, str, str | None]]:
        nonlocal stage, held, body, heredoc
        whole = " ".join(x for x in held if x)
        name, _, args = whole.partition(" ")
        stage += name.upper() == "FROM"
        if name:
            yield stage, start, name.upper(), args.strip(), "\n".join(body) if heredoc else None
        held, body, heredoc = [], [], False

    for number, line in enumerate((text or "").splitlines(), 1):
        if marks:
            if line.strip() == marks[0]:
                marks.pop(0)
                if not marks and not continued:
                    yield from taken()
            else:
                body.append(line)
            continue
        bare = line.strip()
        if not bare or bare.startswith("#"):
            continue
        if not held:
            start = number
        continued = bare.endswith("\\")
        held.append(" ".join(bare[: -1 if continued else None].split()))
        marks = HEREDOC.findall(bare)
        heredoc = heredoc or bool(marks)
        if not marks and not continued:
            yield from taken()
    yield from taken()


@udtf(returnType="stage int, line int, instr string, args string, body string")
class DockerFacts:
    def eval(self, text: str):
        yield from docker_facts(text)
