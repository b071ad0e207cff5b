"""The rule catalogue over task packages: one declarative condition for each title.

A package is one row: name, toml, dockerfile, instruction, solve, test_sh, test_py (texts, null where the file is absent)
and paths (all relative paths, one a line). Conditions are SQL texts, so that the plan is one projection and one explode
over the packages whatever the number of rules. A gate without a finding gives its PASS sentinel.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class PackageRule:
    gate: str
    area: str
    severity: str
    title: str
    #: SQL over ``FACTS`` and the package's columns; patterns are raw literals
    when: str


def _has(col: str, pattern: str) -> str:
    return f"regexp_like(coalesce({col}, ''), r'{pattern}')"


def _number(pattern: str) -> str:
    return f"try_cast(nullif(regexp_extract(coalesce(toml, ''), r'{pattern}', 1), '') AS DOUBLE)"


def _text(key: str) -> str:
    return f"lower(trim(regexp_extract(coalesce(toml, ''), r'(?m)^{key}\\s*=\\s*\"([^\"]*)\"', 1)))"


# Phrases that steer an agent, and characters that hide text.
INJECTION = r"(?i)(ignore\s+(all\s+|any\s+|the\s+)?(previous|prior|above|earlier)\s+instructions|disregard\s+(the\s+)?(above|previous|task|instructions)|ignore\s+the\s+(task|rules|tests?)|do\s+not\s+run\s+the\s+tests?|skip\s+the\s+(tests?|verifier)|reveal\s+(the\s+)?(answer|solution|secret|flag|password)|print\s+(the\s+)?(answer|flag|secret)|you\s+are\s+now\s+|the\s+(correct\s+)?answer\s+is\s*[:=]|to\s+pass(\s+the\s+tests?)?,?\s+(just|simply|only))"
HIDDEN = r"[\x{200B}-\x{200D}\x{2060}\x{FEFF}\x{202A}-\x{202E}\x{2066}-\x{2069}]"
GENERIC = ("programming", "general", "code", "task", "misc", "other")
ENCODED = r"(?i)\b\w*(truth|expected|golden|answer|reference|digest|checksum|payload)\w*\s*=\s*[rbf]?[\x27\"][A-Za-z0-9+/]{40,}={0,2}[\x27\"]"
#: Files that an agent sees.
SEEN = ("instruction", "dockerfile")
INSTALL = r"(?m)^[^#\n]*\b(pip3?|apt|apt-get)\s+install\b"
NETWORK = r"(https?://|\bcurl\b|\bwget\b)"
# Facts that several rules share, by name; a fact may use the columns alone.
FACTS = {
    "delivery": _has("toml", r"(?m)^(subcategory|task_objective|artifact_type|avg_at_8|model_tested|agent_tested)\s*=") + " OR " + _has("toml", r"(?m)^build_timeout_sec\s*="),
    "difficulty": _text("difficulty"),
    "category": _text("category"),
    "expert": "coalesce(" + _number(r"(?m)^expert_time_estimate_min\s*=\s*([0-9.+-]+)") + ", 60 * " + _number(r"(?m)^expert_time_estimate_hours\s*=\s*([0-9.+-]+)") + ")",
    "junior": _number(r"(?m)^junior_time_estimate_min\s*=\s*([0-9.+-]+)"),
    "avg": _number(r"(?m)^avg_at_8\s*=\s*([0-9.+-]+)"),
    "cpus": _number(r"(?m)^cpus\s*=\s*([0-9.+-]+)"),
    "memory": _number(r"(?m)^memory_mb\s*=\s*([0-9.+-]+)"),
    "build_timeout": _number(r"(?m)^build_timeout_sec\s*=\s*([0-9.+-]+)"),
    "verifier_timeout": "coalesce(nullif(" + _number(r"(?s)\[verifier\][^\[]*?timeout_sec\s*=\s*([0-9.+-]+)") + ", 0), " + _number(r"(?m)^verifier_timeout\s*=\s*([0-9.+-]+)") + ", " + _number(r"(?s)\[verifier\][^\[]*?timeout_sec\s*=\s*([0-9.+-]+)") + ")",
    "agent_timeout": "coalesce(nullif(" + _number(r"(?s)\[agent\][^\[]*?timeout_sec\s*=\s*([0-9.+-]+)") + ", 0), " + _number(r"(?m)^agent_timeout\s*=\s*([0-9.+-]+)") + ", " + _number(r"(?s)\[agent\][^\[]*?timeout_sec\s*=\s*([0-9.+-]+)") + ")",
    "visible": r"trim(regexp_replace(regexp_replace(coalesce(instruction, ''), r'(?s)```.*?```', '', 'g'), r'\s+', ' ', 'g'))",
}


def _rules(gate: str, area: str, rows: str, **conditions: str) -> list[PackageRule]:
    out = []
    for row in rows.split():
        severity, title = row.split(":")
        out.append(PackageRule(gate, area, severity, title, conditions[title.replace("-", "_").replace(".", "_")]))
    return out


RULES = (
    *_rules(
        "structure",
        "structure",
        "FAIL:missing-required-file FAIL:empty-required-file WARN:missing-recommended-file FAIL:dockerfile-no-base-image FAIL:dockerfile-trivial FAIL:task-name-not-kebab FAIL:task-name-too-long FAIL:unnecessary-files FAIL:crlf-line-endings FAIL:non-text-asset FAIL:test-sh-no-visible-checks",
        missing_required_file="toml IS NULL OR dockerfile IS NULL OR instruction IS NULL OR solve IS NULL OR test_sh IS NULL",
        empty_required_file="trim(toml) = '' OR trim(dockerfile) = '' OR trim(instruction) = '' OR trim(solve) = '' OR trim(test_sh) = ''",
        missing_recommended_file="test_py IS NULL",
        dockerfile_no_base_image=_has("dockerfile", r"(?m)^[ \t]*[^#\s]") + " AND NOT " + _has("dockerfile", r"(?mi)^[ \t]*FROM\s"),
        dockerfile_trivial=r"trim(dockerfile) <> '' AND regexp_count(dockerfile, r'(?m)^[ \t]*[^#\s]') < 2",
        task_name_not_kebab=f"NOT {_has('name', r'^[a-z0-9-]+$')} OR {_has('name', r'^-|--|-$')}",
        task_name_too_long="length(name) > 50",
        unnecessary_files=_has("paths", r"(?m)(^|/)(\.git|\.DS_Store|__MACOSX|node_modules|\.idea|\.vscode|Thumbs\.db)(/|$)"),
        crlf_line_endings=" OR ".join(f"position(chr(13) || chr(10) IN coalesce({c}, '')) > 0" for c in ("toml", "dockerfile", "instruction", "solve", "test_sh", "test_py")),
        non_text_asset=_has("paths", r"(?mi)^environment/.*\.(docx?|xlsx?|pptx?|pdf)$"),
        test_sh_no_visible_checks="trim(coalesce(test_sh, '')) <> '' AND NOT " + _has("test_sh", r"(pytest|unittest|assert|diff|grep|test_outputs)"),
    ),
    *_rules(
        "metadata",
        "metadata",
        "FAIL:task-toml-missing FAIL:missing-difficulty WARN:unknown-difficulty FAIL:missing-category WARN:generic-category WARN:missing-subcategory WARN:missing-task-objective WARN:missing-artifact-type FAIL:missing-tags FAIL:missing-expert-time FAIL:nonpositive-expert-time FAIL:missing-junior-time WARN:junior-lt-expert FAIL:avg-at-8-too-easy FAIL:avg-at-8-out-of-range FAIL:missing-avg-at-8 WARN:missing-model-tested WARN:missing-agent-tested FAIL:missing-verifier-timeout FAIL:nonpositive-verifier-timeout FAIL:missing-agent-timeout FAIL:nonpositive-agent-timeout FAIL:agent-timeout-lt-verifier FAIL:missing-build-timeout FAIL:nonpositive-build-timeout FAIL:no-env-resources FAIL:cpus-nonpositive FAIL:placeholder-zero-resource FAIL:cpus-above-client-cap FAIL:memory-above-client-cap FAIL:internet-flag-contradiction",
        task_toml_missing="toml IS NULL",
        missing_difficulty="toml IS NOT NULL AND NOT delivery AND difficulty = ''",
        unknown_difficulty="toml IS NOT NULL AND NOT delivery AND difficulty <> '' AND difficulty NOT IN ('easy', 'medium', 'hard')",
        missing_category="toml IS NOT NULL AND category = ''",
        generic_category=f"category IN {GENERIC}",
        missing_subcategory="delivery AND NOT " + _has("toml", r"(?m)^subcategory\s*=\s*\"[^\"]"),
        missing_task_objective="delivery AND NOT " + _has("toml", r"(?m)^task_objective\s*=\s*\[\s*\""),
        missing_artifact_type="delivery AND NOT " + _has("toml", r"(?m)^artifact_type\s*=\s*\[\s*\""),
        missing_tags="toml IS NOT NULL AND NOT delivery AND NOT " + _has("toml", r"(?m)^tags\s*=\s*\[\s*\""),
        missing_expert_time="toml IS NOT NULL AND expert IS NULL",
        nonpositive_expert_time="expert <= 0",
        missing_junior_time="toml IS NOT NULL AND NOT delivery AND junior IS NULL",
        junior_lt_expert="NOT delivery AND junior < expert",
        avg_at_8_too_easy="delivery AND avg > 0.5",
        avg_at_8_out_of_range="avg < 0 OR avg > 1",
        missing_avg_at_8="delivery AND avg IS NULL",
        missing_model_tested="delivery AND NOT " + _has("toml", r"(?m)^model_tested\s*=\s*\"[^\"]"),
        missing_agent_tested="delivery AND NOT " + _has("toml", r"(?m)^agent_tested\s*=\s*\"[^\"]"),
        missing_verifier_timeout="toml IS NOT NULL AND verifier_timeout IS NULL",
        nonpositive_verifier_timeout="verifier_timeout <= 0",
        missing_agent_timeout="toml IS NOT NULL AND agent_timeout IS NULL",
        nonpositive_agent_timeout="agent_timeout <= 0",
        agent_timeout_lt_verifier="agent_timeout <> 0 AND verifier_timeout <> 0 AND agent_timeout < verifier_timeout",
        missing_build_timeout="delivery AND build_timeout IS NULL",
        nonpositive_build_timeout="build_timeout <= 0",
        no_env_resources="toml IS NOT NULL AND cpus IS NULL AND memory IS NULL AND NOT " + _has("toml", r"(?m)^gpus\s*="),
        cpus_nonpositive="cpus <= 0",
        placeholder_zero_resource="memory <= 0",
        cpus_above_client_cap="cpus > 1",
        memory_above_client_cap="memory > 4096",
        internet_flag_contradiction=_has("toml", r"(?m)^allow_internet\s*=\s*false") + " AND " + _has("instruction", NETWORK),
    ),
    *_rules(
        "dockerfile",
        "dockerfile",
        "FAIL:unpinned-base-image FAIL:base-image-not-digest-pinned FAIL:apt-no-update WARN:apt-get-upgrade WARN:unpinned-pip FAIL:add-remote-url FAIL:curl-pipe-sh WARN:missing-multistage-build FAIL:broad-chmod FAIL:dockerfile-heredoc-source FAIL:archive-fixture-not-extracted FAIL:dockerfile-entrypoint FAIL:test-deps-in-image FAIL:missing-dockerignore FAIL:dockerfile-copies-solution FAIL:dockerfile-copies-tests FAIL:dockerfile-copies-hint-file",
        unpinned_base_image=_has("dockerfile", r"(?mi)^[ \t]*FROM\s+(?:[^\s:@$]+|[^\s@$]+:latest)(?:\s|$)") + " AND NOT " + _has("dockerfile", r"(?mi)^[ \t]*FROM\s+scratch(?:\s|$)"),
        base_image_not_digest_pinned="delivery AND " + _has("dockerfile", r"(?mi)^[ \t]*FROM\s+[^\s@$]+:[^\s@$]+(?:\s|$)"),
        apt_no_update=_has("dockerfile", r"\bapt(-get)?\s+(-y\s+)?install\b") + " AND NOT " + _has("dockerfile", r"\bapt(-get)?\s+update\b"),
        apt_get_upgrade=_has("dockerfile", r"\bapt(-get)?\s+(-y\s+)?(dist-)?upgrade\b"),
        unpinned_pip=_has("dockerfile", r"(?m)\bpip3?\s+install\s+(?:-\S+\s+)*+[A-Za-z][A-Za-z0-9_.\[\]-]*(?:\s|$)"),
        add_remote_url=_has("dockerfile", r"(?mi)^[ \t]*ADD\s+https?://"),
        curl_pipe_sh=_has("dockerfile", r"\b(curl|wget)\b[^\n|]{0,300}\|\s*(sudo\s+)?(ba)?sh\b"),
        missing_multistage_build=_has("dockerfile", r"\b(make|cargo build|go build|mvn|gcc|npm run build)\b") + " AND NOT " + _has("dockerfile", r"(?si)FROM\s.*\n[ \t]*FROM\s"),
        broad_chmod=_has("dockerfile", r"\bchmod\s+-R\b"),
        dockerfile_heredoc_source=_has("dockerfile", r"<<-?\s*[\x27\"]?[A-Za-z_]+[\x27\"]?\s*>|>\s*\S+\s*<<"),
        archive_fixture_not_extracted=_has("dockerfile", r"(?mi)^[ \t]*(COPY|ADD)\s+\S*\.(tar|tgz|tar\.gz|zip|gz)\b"),
        dockerfile_entrypoint=_has("dockerfile", r"(?mi)^[ \t]*ENTRYPOINT\b"),
        test_deps_in_image="NOT delivery AND " + _has("dockerfile", r"\bpip3?\s+install\b[^\n]{0,300}\bpytest\b"),
        missing_dockerignore=_has("dockerfile", r"(?mi)^[ \t]*COPY\s") + " AND " + _has("paths", r"(?m)^environment/[^/\n]+/") + " AND NOT " + _has("paths", r"(?m)^environment/\.dockerignore$"),
        dockerfile_copies_solution=_has("dockerfile", r"(?mi)^[ \t]*(COPY|ADD)\s+(--\S+\s+)*+\.?/?solution\b"),
        dockerfile_copies_tests=_has("dockerfile", r"(?mi)^[ \t]*(COPY|ADD)\s+(--\S+\s+)*+\.?/?tests\b"),
        dockerfile_copies_hint_file=_has("dockerfile", r"(?mi)^[ \t]*(COPY|ADD)\s+\S*(hint|answer|cheat)\S*\s"),
    ),
    *_rules(
        "instructions",
        "instructions",
        "FAIL:instruction-empty FAIL:instruction-placeholder WARN:instruction-too-short FAIL:instruction-relative-path",
        instruction_empty="trim(coalesce(instruction, '')) = ''",
        instruction_placeholder=_has("instruction", r"\b(TODO|FIXME|TBD|lorem ipsum|PLACEHOLDER)\b"),
        instruction_too_short="trim(coalesce(instruction, '')) <> '' AND length(visible) < 120",
        instruction_relative_path=_has("instruction", r"(?m)(^|[\s\x60(\"\x27])\.{1,2}/[A-Za-z0-9_.-]"),
    ),
    *_rules(
        "fairness",
        "anti_cheat",
        "FAIL:git-history-exposed FAIL:runtime-network FAIL:bakeable-runtime-install FAIL:test-runtime-install FAIL:reward-path-nonstandard FAIL:secret-baked-in-image FAIL:pycache-baked-in-image FAIL:reward-pre-created FAIL:test-imports-solution FAIL:skipped-scored-test FAIL:empty-parametrize FAIL:unconditional-reward FAIL:test-sh-set-e-reward-abort FAIL:prompt-injection FAIL:hidden-unicode FAIL:tests-bake-unread",
        git_history_exposed=_has("dockerfile", r"\bgit\s+clone\b") + " AND NOT " + _has("dockerfile", r"rm\s+-rf?\s+\S*\.git\b"),
        runtime_network=_has("test_sh", r"(?m)^[^#\n]*\b(curl|wget)\b") + " AND NOT " + _has("test_sh", r"(localhost|127\.0\.0\.1)"),
        bakeable_runtime_install="delivery AND (" + _has("test_sh", INSTALL) + " OR " + _has("solve", INSTALL) + ")",
        test_runtime_install="delivery AND " + _has("test_sh", INSTALL),
        reward_path_nonstandard="delivery AND " + _has("test_sh", r"/\S*reward\.(txt|json)") + " AND NOT " + _has("test_sh", r"/logs/(tests|verifier)/reward\.(txt|json)"),
        secret_baked_in_image=_has("dockerfile", r"(AKIA[0-9A-Z]{16}|-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----|ghp_[A-Za-z0-9]{36}|xox[bap]-[A-Za-z0-9-]{10,60})"),
        pycache_baked_in_image=_has("paths", r"(?m)^environment/(\S*/)?(__pycache__/|\S*\.pyc$)"),
        reward_pre_created=_has("paths", r"(?m)^environment/(\S*/)?reward\.(txt|json)$") + " OR " + _has("dockerfile", r">\s*\S*reward\.(txt|json)"),
        test_imports_solution=_has("test_py", r"(?m)^[ \t]*(from|import)\s+(solution|solve)\b"),
        skipped_scored_test=_has("test_py", r"(?m)^[ \t]*@pytest\.mark\.(skip|skipif|xfail)\b"),
        empty_parametrize=_has("test_py", r"parametrize\([^\n]{1,200},\s*\[\s*\]"),
        unconditional_reward=_has("test_sh", r"(?m)^[ \t]*echo\s+[\"\x27]?1[\"\x27]?\s*>\s*\S*reward") + " AND NOT " + _has("test_sh", r"\b(if|then|&&|\|\||\$\?)\b|\$\?"),
        test_sh_set_e_reward_abort=_has("test_sh", r"(?m)^[ \t]*set\s+-[a-z]*e") + " AND NOT " + _has("test_sh", r"set\s+\+e") + " AND " + _has("test_sh", r"\bpytest\b") + " AND " + _has("test_sh", r"\$\?") + " AND " + _has("test_sh", "reward"),
        prompt_injection=" OR ".join(_has(c, INJECTION) for c in SEEN),
        hidden_unicode=" OR ".join(_has(c, HIDDEN) for c in SEEN),
        tests_bake_unread=_has("dockerfile", r"(?m)^[ \t]*RUN\b[^\n]{0,300}>\s*/tests/") + " AND NOT " + _has("dockerfile", r"rm\s+-rf?\s+/tests"),
    ),
    *_rules(
        "portability",
        "solution",
        "FAIL:mixed-bash-python-solve FAIL:backgrounded-daemon-no-redirect FAIL:pip-no-break-system-packages WARN:oracle-runtime-install FAIL:redis-no-daemonize FAIL:broad-pkill FAIL:config-edit-no-restart FAIL:solve-too-long",
        mixed_bash_python_solve=_has("solve", r"^#![^\n]*python"),
        backgrounded_daemon_no_redirect=_has("solve", r"(?m)^[^#>\n]*[^&>\n]&\s*$") + " AND NOT " + _has("solve", r"(?m)^exec\s+[^\n]*>"),
        pip_no_break_system_packages=_has("solve", r"\bpip3?\s+install\b") + " AND NOT " + _has("solve", r"(--break-system-packages|\bvenv\b|\buv\s+pip\b)"),
        oracle_runtime_install=_has("solve", INSTALL),
        redis_no_daemonize=_has("solve", r"(?m)^[ \t]*redis-server\b[^\n&]*$") + " AND NOT " + _has("solve", "--daemonize"),
        broad_pkill=_has("solve", r"\bpkill\s+-f\b"),
        config_edit_no_restart=_has("solve", r"sed\s+-i\s[^\n]{0,200}\.(conf|cfg|ini)\b") + " AND NOT " + _has("solve", r"\b(restart|reload|HUP)\b"),
        solve_too_long="delivery AND length(solve) - length(replace(solve, chr(10), '')) + 1 >= 200",
    ),
    *_rules(
        "hygiene",
        "tests",
        "FAIL:verifier-unbounded-call FAIL:systemd-assumption FAIL:base64-wrapped-command FAIL:shell-wrapped-python FAIL:delegates-to-truth-verifier FAIL:llm-judge-in-verifier FAIL:unseeded-randomness-in-verifier FAIL:wall-clock-in-verifier WARN:encoded-ground-truth FAIL:generic-bootstrap-blocks",
        verifier_unbounded_call=_has("test_py", r"\b(requests\.(get|post)|urlopen|socket\.create_connection)\(") + " AND NOT " + _has("test_py", "timeout"),
        systemd_assumption=_has("test_sh", r"\b(systemctl|journalctl)\b") + " OR " + _has("test_py", r"\b(systemctl|journalctl)\b"),
        base64_wrapped_command=_has("test_py", r"b64decode\(\s*[\x27\"][A-Za-z0-9+/=]{8,}"),
        shell_wrapped_python=_has("test_py", r"subprocess\.\w+\([^\n]{0,200}python3?\s+-c"),
        delegates_to_truth_verifier=_has("test_py", r"(?m)^[^#\n]*\.truth/\S{0,200}\.py"),
        llm_judge_in_verifier=_has("test_py", r"(?m)^[ \t]*(import|from)\s+(openai|litellm|cohere)\b"),
        unseeded_randomness_in_verifier=_has("test_py", r"\brandom\.(random|randint|choice|shuffle|sample)\(") + " AND NOT " + _has("test_py", r"\bseed\("),
        wall_clock_in_verifier=_has("test_py", r"\b(datetime\.(now|utcnow|today)|date\.today)\("),
        encoded_ground_truth=" OR ".join(_has(c, ENCODED) for c in ("test_py", "test_sh", "solve")),
        generic_bootstrap_blocks=" + ".join(f"CAST({_has('test_sh', rf'\b{d}')} AS INT)" for d in ("redis-server", "postgres", "mysqld", "mongod")) + " >= 3",
    ),
)
GATES = tuple(dict.fromkeys((r.gate, r.area) for r in RULES))


def spark_sql(text: str) -> str:
    """The SQL of a condition or fact for Spark, whose regexp_replace has no flags and always replaces all matches."""
    return text.replace(", 'g')", ")")


def plain_sql(text: str) -> str:
    """The SQL of a condition for engines that never backtrack and know no possessive repetition; it means the same."""
    return text.replace(")*+", ")*")


def package_findings(packages: DataFrame, rules: tuple[PackageRule, ...] = RULES) -> DataFrame:
    """(task, area, severity, title) of each rule that a package meets, and a PASS for each gate that finds nothing."""
    facts = packages.select("*", *[F.expr(spark_sql(f)).alias(k) for k, f in FACTS.items()])

    def hit(r: PackageRule) -> Column:
        return F.when(F.expr(spark_sql(f"coalesce({r.when}, false)")), F.struct(F.lit(r.area).alias("area"), F.lit(r.severity).alias("severity"), F.lit(r.title).alias("title")))

    def clean(gate: str, area: str) -> Column:
        return F.array(F.struct(F.lit(area).alias("area"), F.lit("PASS").alias("severity"), F.lit(f"{gate}-ok").alias("title")))

    hits = facts.select("task", *[F.array_compact(F.array(*[hit(r) for r in rules if r.gate == g])).alias(f"of_{g}") for g, _ in GATES])
    found = F.concat(*[F.when(F.size(f"of_{g}") == 0, clean(g, a)).otherwise(F.col(f"of_{g}")) for g, a in GATES])
    return hits.select("task", F.explode(found).alias("f")).select("task", "f.*")
