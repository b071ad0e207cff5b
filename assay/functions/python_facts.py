"""Facts of Python test sources, read from their syntax trees: a table function, to be joined laterally to a table of files.

    files.lateralJoin(PythonFacts(F.col("text").outer()))

gives one row a fact: function, line, kind, path, value. Kinds of a test function: ``test`` (each one), ``skipped``,
``empty-parametrize``, and the first that fits of ``vacuous``, ``swallowed``, ``existence-only`` and ``no-assertion``. A
``literal`` is a constant that an assertion compares something with, ``literal-file`` one that is compared with what a
path holds. Kinds of a file: ``imports-solution``, ``literal-only`` (nothing is run, parsed or computed and every test
that asserts compares with constants) and ``syntax-error``. A null or blank text has no facts, one that does not parse, or
nests too deeply to be read, has its ``syntax-error`` alone.
"""

from __future__ import annotations

import ast
from collections.abc import Iterator

from pyspark.sql.functions import udtf

# What counts as running or reading something, as computing an expected value, and as a check of existence;
# the modules that a checker of constants may import.
RUNS = (
    "subprocess.run", "subprocess.Popen", "subprocess.check_output", "subprocess.check_call", "subprocess.call", "os.system", "os.popen",
    "requests.get", "requests.post", "requests.put", "requests.delete", "requests.head", "requests.patch", "requests.request",
    "httpx.get", "httpx.post", "httpx.request", "urlopen", "urllib.request.urlopen", "socket.create_connection", "socket.socket",
    "sqlite3.connect", "psycopg2.connect", "psycopg.connect", "pymysql.connect", "duckdb.connect", "redis.Redis", "redis.StrictRedis",
    "json.load", "json.loads", "yaml.load", "yaml.safe_load", "csv.reader", "csv.DictReader", "Image.open",
    "importlib.import_module", "importlib.util.spec_from_file_location", "runpy.run_path", "runpy.run_module", "__import__",
    "sys.path.append", "sys.path.insert",
)
RUNNING_METHODS = ("execute", "cursor", "exec_module", "read_csv", "read_json", "read_parquet", "read_excel", "read_table", "communicate")
COMPUTES = ("sum", "len", "sorted", "max", "min", "Counter", "any", "all", "round", "abs", "set")
COMPUTING_MODULES = ("hashlib", "hmac")
EXISTENCE = ("exists", "isfile", "isdir", "is_file", "is_dir", "lexists")
FAILS = ("fail", "skip", "xfail")
SKIPS = ("skip", "skipif", "xfail")
REFERENCE = ("solution", "solve")
PLAIN_MODULES = (
    "os", "sys", "re", "json", "pathlib", "subprocess", "math", "string", "collections", "base64", "hashlib", "hmac", "csv", "io", "time",
    "datetime", "glob", "shutil", "typing", "itertools", "functools", "pytest", "unittest", "textwrap", "decimal", "fractions", "statistics",
    "struct", "binascii", "difflib", "filecmp", "stat", "tempfile", "warnings", "contextlib", "pprint", "operator",
)

Fact = tuple[str | None, int | None, str, str | None, str | None]
FUNCTION = (ast.FunctionDef, ast.AsyncFunctionDef)
COMPREHENSION = (ast.ListComp, ast.SetComp, ast.DictComp, ast.GeneratorExp)


def name_of(node: ast.expr) -> str:
    """The dotted name of an expression, as far as it is one: what follows its last call or subscript."""
    if isinstance(node, ast.Name):
        return node.id
    if isinstance(node, ast.Attribute):
        left = name_of(node.value)
        return f"{left}.{node.attr}" if left else node.attr
    return ""


def short_name(node: ast.expr) -> str:
    return name_of(node).rpartition(".")[2]


def called(node: ast.AST) -> str:
    """The last name of what a call calls; empty for anything else."""
    return short_name(node.func) if isinstance(node, ast.Call) else ""


def constant(node: ast.expr) -> bool:
    """A constant, or a container or negative of constants."""
    try:
        ast.literal_eval(node)
    except (ValueError, TypeError, SyntaxError, MemoryError, RecursionError):
        return False
    return True


#: Fields that hold names or signs, no parts of interest.
_BARE = ("ctx", "op", "ops", "id", "attr", "kind", "type_comment")
_held: dict[type, tuple[str, ...]] = {ast.Constant: ()}


def below(node: ast.AST) -> list[ast.AST]:
    """A node and all below it by depth, as ``ast.walk`` gives them, without contexts and signs."""
    out = [node]
    for n in out:
        fields = _held.get(type(n))
        if fields is None:
            fields = _held[type(n)] = tuple(f for f in n._fields if f not in _BARE)
        for f in fields:
            v = getattr(n, f, None)
            if isinstance(v, list):
                out += [x for x in v if isinstance(x, ast.AST)]
            elif isinstance(v, ast.AST):
                out.append(v)
    return out


def can_fail(nodes: list[ast.AST]) -> bool:
    """Whether any of the nodes can make a test fail: an assertion, a raise, or a call or context that asserts."""
    for n in nodes:
        if isinstance(n, ast.Assert | ast.Raise):
            return True
        if (name := called(n)) in FAILS or name.startswith("assert"):
            return True
        if isinstance(n, ast.With) and any("raises" in name_of(x) for item in n.items for x in ast.walk(item.context_expr) if isinstance(x, ast.Name | ast.Attribute)):
            return True
    return False


def does_nothing(stmt: ast.stmt) -> bool:
    """A docstring, pass, return, or an assertion of a true constant."""
    if isinstance(stmt, ast.Expr):
        return isinstance(stmt.value, ast.Constant)
    if isinstance(stmt, ast.Assert):
        return isinstance(stmt.test, ast.Constant) and bool(stmt.test.value)
    return isinstance(stmt, ast.Pass | ast.Return)


def swallows(nodes: list[ast.AST]) -> bool:
    """Whether an assertion stands in a try with a handler that only passes."""
    for n in nodes:
        if isinstance(n, ast.Try) and any(all(isinstance(s, ast.Pass) for s in h.body) for h in n.handlers):
            inside = [*n.body, *n.orelse, *n.finalbody, *(s for h in n.handlers for s in h.body)]
            if any(isinstance(x, ast.Assert) for s in inside for x in ast.walk(s)):
                return True
    return False


def compared_constants(assertion: ast.Assert) -> Iterator[tuple[int, ast.expr]]:
    """(line, constant) of every comparison of a constant with something that is none."""
    for n in below(assertion):
        if isinstance(n, ast.Compare) and any(isinstance(o, ast.Eq | ast.NotEq | ast.Lt | ast.LtE | ast.Gt | ast.GtE) for o in n.ops):
            fixed = [constant(x) for x in (n.left, *n.comparators)]
            if not all(fixed):
                yield from ((n.lineno, x) for x, f in zip((n.left, *n.comparators), fixed, strict=True) if f)


def opened_path(node: ast.expr) -> str | None:
    """The path of ``open("path")`` below up to three calls around it, such as ``int(open("path").read().strip())``."""
    for _ in range(4):
        if not isinstance(node, ast.Call):
            return None
        first = node.args[0] if node.args else None
        if called(node) == "open" and isinstance(first, ast.Constant) and isinstance(first.value, str):
            return first.value
        node = first if first is not None else node.func.value if isinstance(node.func, ast.Attribute) else None
    return None


def verdict(fn: ast.FunctionDef, nodes: list[ast.AST], helpers: set[str]) -> str | None:
    """What is wrong with a test function as a whole; the first that fits."""
    if all(map(does_nothing, fn.body)):
        return "vacuous"
    if swallows(nodes):
        return "swallowed"
    asserts = [n for n in nodes if isinstance(n, ast.Assert)]
    if asserts and all(called(a.test) in EXISTENCE for a in asserts):
        return "existence-only"
    if not can_fail(nodes) and not any(called(n) in helpers for n in nodes):
        return "no-assertion"
    return None


def decoration(fn: ast.FunctionDef) -> Iterator[str]:
    for d in fn.decorator_list:
        name = short_name(d.func if isinstance(d, ast.Call) else d)
        if name in SKIPS:
            yield "skipped"
        elif name == "parametrize" and isinstance(d, ast.Call) and len(d.args) > 1 and isinstance(d.args[1], ast.List | ast.Tuple) and not d.args[1].elts:
            yield "empty-parametrize"


def works(nodes: list[ast.AST]) -> bool:
    """Whether a file runs, parses or computes anything, or imports what may."""
    for n in nodes:
        if isinstance(n, ast.Call):
            full, last = name_of(n.func), called(n)
            if full in RUNS or last in RUNNING_METHODS or full.partition(".")[0] in COMPUTING_MODULES or last in COMPUTES:
                return True
        elif isinstance(n, COMPREHENSION):
            return True
        elif isinstance(n, ast.Import):
            if any(a.name.partition(".")[0] not in PLAIN_MODULES for a in n.names):
                return True
        elif isinstance(n, ast.ImportFrom) and not n.level and (n.module or "").partition(".")[0] not in PLAIN_MODULES:
            return True
    return False


def imported(n: ast.AST) -> list[str]:
    if isinstance(n, ast.Import):
        return [a.name.partition(".")[0] for a in n.names]
    return [(n.module or "").partition(".")[0]] if isinstance(n, ast.ImportFrom) else []


def python_facts(text: str | None, literals: bool = True) -> Iterator[Fact]:
    """All facts of a file; without ``literals`` those that are findings, which takes no text of any constant."""
    if not text or not text.strip():
        return
    try:
        facts = list(_facts(ast.parse(text), literals))
    except SyntaxError as e:
        facts = [(None, e.lineno, "syntax-error", None, e.msg)]
    except (ValueError, RecursionError, MemoryError) as e:
        facts = [(None, None, "syntax-error", None, type(e).__name__)]
    yield from facts


def _facts(tree: ast.Module, literals: bool) -> Iterator[Fact]:
    nodes = below(tree)
    functions = [(n, below(n)) for n in nodes if isinstance(n, FUNCTION)]
    helpers = {f.name for f, held in functions if can_fail(held)}
    if (line := min((n.lineno for n in nodes if set(imported(n)) & set(REFERENCE)), default=None)) is not None:
        yield None, line, "imports-solution", None, None
    asserting: dict[str, bool] = {}
    for f, held in functions:
        if not f.name.startswith("test"):
            continue
        if literals:
            yield f.name, f.lineno, "test", None, None
        for kind in decoration(f):
            yield f.name, f.lineno, kind, None, None
        if kind := verdict(f, held, helpers):
            yield f.name, f.lineno, kind, None, None
        asserts = [n for n in held if isinstance(n, ast.Assert)]
        if literals:
            for line, x in (x for a in asserts for x in compared_constants(a)):
                yield f.name, line, "literal", None, ast.unparse(x)
        if asserts:
            asserting[f.name] = any(True for a in asserts for _ in compared_constants(a))
    if asserting and all(asserting.values()) and not works(nodes):
        yield None, None, "literal-only", None, None
    if literals:
        yield from _file_literals(tree, {})


def scope_nodes(scope: ast.AST) -> list[ast.AST]:
    """What stands in a module or function itself; functions inside are given, but not what they hold."""
    out, todo = [], list(ast.iter_child_nodes(scope))
    while todo:
        n = todo.pop()
        out.append(n)
        if not isinstance(n, FUNCTION):
            todo += ast.iter_child_nodes(n)
    return out


def _file_literals(scope: ast.AST, outer: dict[str, str]) -> Iterator[Fact]:
    """Constants that are equated with what a path holds, directly or through one variable of the same or an outer scope."""
    nodes = scope_nodes(scope)
    named = outer | {n.targets[0].id: p for n in nodes if isinstance(n, ast.Assign) and len(n.targets) == 1 and isinstance(n.targets[0], ast.Name) and (p := opened_path(n.value))}
    for n in nodes:
        if isinstance(n, ast.Compare) and any(isinstance(o, ast.Eq) for o in n.ops):
            sides = (n.left, *n.comparators)
            value = next((x.value for x in sides if isinstance(x, ast.Constant) and not isinstance(x.value, bool)), None)
            path = next((p for x in sides if (p := opened_path(x) or (named.get(x.id) if isinstance(x, ast.Name) else None))), None)
            if path and value is not None:
                yield None, n.lineno, "literal-file", path, str(value)
        elif isinstance(n, FUNCTION):
            yield from _file_literals(n, named)


@udtf(returnType="function string, line int, kind string, path string, value string")
class PythonFacts:
    def eval(self, text: str, literals: bool = True):
        yield from python_facts(text, literals)
