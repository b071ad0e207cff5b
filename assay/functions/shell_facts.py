"""Lines of shell scripts with the state that they run in: a table function, to be joined laterally to a table of files.

    files.lateralJoin(ShellLines(F.col("text").outer()))

gives one row a line that is a command: line, command (trimmed), depth (open ``if`` and ``case``), stops (``set -e`` holds),
marker (the heredoc that the line belongs to, null for a command). Comments and blank lines have no rows. A null or blank
text has none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql.functions import udtf

HEREDOC = re.compile(r"<<[-~]?\s*[\"']?([A-Za-z_]\w*)[\"']?")
SET = re.compile(r"\bset\s+([-+])[A-Za-z]*e")
OPENS, CLOSES = re.compile(r"(?:^|[;&|]\s*)(?:if|case)\b"), re.compile(r"(?:^|[;&|]\s*)(?:fi|esac)\b")


def shell_lines(text: str | None) -> Iterator[tuple[int, str, int, bool, str | None]]:
    depth, stops, marks = 0, False, []
    for number, line in enumerate((text or "").splitlines(), 1):
        bare = line.strip()
        if marks:
            if bare == marks[0]:
                marks.pop(0)
            else:
                yield number, bare, depth, stops, marks[0]
            continue
        if not bare or bare.startswith("#"):
            continue
        depth += len(OPENS.findall(bare))
        yield number, bare, depth, stops, None
        depth = max(0, depth - len(CLOSES.findall(bare)))
        if found := SET.findall(bare):
            stops = found[-1] == "-"
        marks = HEREDOC.findall(bare)


@udtf(returnType="line int, command string, depth int, stops boolean, marker string")
class ShellLines:
    def eval(self, text: str):
        yield from shell_lines(text)
