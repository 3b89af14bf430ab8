"""Column builders for the text formats of agent conversations. All stay in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data format.
WARNING_PREAMBLE = r"(?s)\APrevious response had warnings:\n.*?\n\n(?=New Terminal Output:|Current terminal state:)"
FENCE_BLOCK = r"(?s)```(?:json|JSON)?\s*(\{.*?\})\s*```"
UUID = r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
DOCKER_HOST = r"(?<=@)[0-9a-f]{12}(?=[:\s])"
TRAILING_SCAFFOLDING = r"(?:\s*</?(?:parameter|function|tool_call)[^>]*>)+\s*\z"
FORMAT_ERROR_PREFIX = "Format error:"
CONTROL_LITERALS = (
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<think>", "</think>", "<tool_call>", "</tool_call>",
    "<tool_response>", "</tool_response>", "<function=", "<parameter=", "<parameter>",
)
INFRA_MARKERS = (
    "connection reset by peer", "could not resolve host", "docker daemon", "docker compose command failed", "error during connect", "failed to pull image",
    "name or service not known", "no space left on device", "temporary failure in name resolution", "unexpected eof while reading", "rate limit exceeded", "unable to locate package",
)
BUDGET_MARKERS = ("command too long", "timed out")
NUMBER = r"([0-9]*\.?[0-9]+(?:[eE][-+]?\d+)?)"
LOG_FIELDS = {
    "loss": rf"\b(?:lm[ _-]?loss|loss)\s*[:=]\s*{NUMBER}",
    "step": r"\b(?:iteration|step)\s*[:=]?\s*(\d+)",
    "grad_norm": rf"\bgrad[ _-]?norm\s*[:=]\s*{NUMBER}",
    "lr": rf"\b(?:learning[ _-]?rate|lr)\s*[:=]\s*{NUMBER}",
}
#: Characters that Python's str.strip removes.
_PY_SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"


def py_strip(c: Column) -> Column:
    """White space of all kinds cut off both ends; trim alone takes only blanks."""
    return F.regexp_replace(c, rf"\A{_PY_SPACE}+|{_PY_SPACE}+\z", "")


def group_key(c: Column) -> Column:
    """A task group however it is written: letters and digits in lower case, without a closing mark of @ or #."""
    return F.lower(F.regexp_replace(F.regexp_replace(c, r"[@#][^@#]*\z", ""), r"[^\p{L}\p{N}]", ""))


def model_key(c: Column) -> Column:
    """A model however it is written: letters and digits in lower case, without an owner in front of a slash."""
    return F.lower(F.regexp_replace(F.regexp_replace(c, r"(?s)^.*/", ""), r"[^\p{L}\p{N}]", ""))


def canonical_prompt(c: Column) -> Column:
    """A prompt with the marks of one run masked; for grouping only."""
    return F.regexp_replace(F.regexp_replace(c, UUID, "<UUID>"), DOCKER_HOST, "<HOST>")


def strip_warning_preamble(c: Column) -> Column:
    return F.regexp_replace(c, WARNING_PREAMBLE, "")


def fenced_objects(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(FENCE_BLOCK), F.lit(1))


def base_image(dockerfile: Column) -> Column:
    """Image of the first FROM line, "?" without one."""
    found = F.regexp_extract(F.coalesce(dockerfile, F.lit("")), r"(?im)^\s*FROM\s+(\S+)", 1)
    return F.when(found == "", F.lit("?")).otherwise(found)


def heredoc_count(dockerfile: Column) -> Column:
    """Lines of a Dockerfile that open a here-document."""
    return F.size(F.regexp_extract_all(F.coalesce(dockerfile, F.lit("")), F.lit(r"(?m)^\s*(?:RUN|COPY)\b[^\n]*<<-?\s*['\"]?\w+"), F.lit(0)))


def strip_scaffolding(c: Column) -> Column:
    """Closing tags of a tool call cut off the end."""
    return F.regexp_replace(c, TRAILING_SCAFFOLDING, "")


def has_any(c: Column, literals: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [c.contains(x) for x in literals])


def sanitize_reasoning(c: Column) -> Column:
    """Reasoning without scaffolding at its end; null if control literals remain."""
    cleaned = strip_scaffolding(c)
    return F.when(~has_any(cleaned, CONTROL_LITERALS), cleaned)


def repair_stray_think(c: Column) -> Column:
    """Content without one surplus closing tag at its end; null if there are several or text follows."""
    tags = F.size(F.split(c, "</think>")) - 1
    rest = py_strip(F.substring_index(c, "</think>", -1))
    return F.when(tags == 0, c).when((tags == 1) & (rest == ""), F.substring_index(c, "</think>", 1))


def strip_think(c: Column) -> Column:
    """(rest, state): what follows the last closed reasoning block; state none, closed or open."""
    closed, opened = c.contains("</think>"), c.contains("<think>")
    return F.struct(
        F.when(closed, F.substring_index(c, "</think>", -1)).otherwise(c).alias("rest"),
        F.when(closed, "closed").when(opened, "open").otherwise("none").alias("state"),
    )


def is_format_error(role: Column, content: Column) -> Column:
    return (role == "user") & content.startswith(FORMAT_ERROR_PREFIX)


def job_name(c: Column) -> Column:
    """A file-system safe name of 96 characters at most."""
    safe = F.substring(F.regexp_replace(c, r"[^A-Za-z0-9_.-]", "-"), 1, 96)
    return F.coalesce(F.nullif(F.regexp_replace(safe, r"\A-+", ""), F.lit("")), F.lit("job"))


def session_id(*candidates: Column) -> Column:
    """First candidate that isn't blank; else a hash of all."""
    named = [F.nullif(F.trim(c), F.lit("")) for c in candidates]
    return F.coalesce(*named, F.substring(F.sha2(F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in candidates]), 256), 1, 16))


def log_fields(line: Column) -> dict[str, Column]:
    """loss, step, grad_norm and lr of a log line, null where missing."""
    low = F.lower(line)
    found = {k: F.nullif(F.regexp_extract(low, p, 1), F.lit("")) for k, p in LOG_FIELDS.items()}
    return {k: c.try_cast("bigint" if k == "step" else "double") for k, c in found.items()}


def nan_warning(line: Column) -> Column:
    """The line, cut to 200 characters, if it tells of NaN in a loss or gradient."""
    low = F.lower(line)
    return F.when(low.contains("nan") & (low.contains("loss") | low.contains("grad")), F.substring(py_strip(line), 1, 200))


def memory_fields(line: Column) -> dict[str, Column]:
    """Sizes in an out-of-memory line, in GiB."""
    low = F.lower(line)

    def gib(pattern: str) -> Column:
        n = F.nullif(F.regexp_extract(low, pattern, 1), F.lit("")).try_cast("double")
        return F.when(F.regexp_extract(low, pattern, 2) == "mib", n / 1024).otherwise(n)

    return {"tried_gib": gib(r"tried to allocate ([0-9.]+) ([mg]ib)"), "free_gib": gib(r"([0-9.]+) ([mg]ib) is free"), "used_gib": gib(r"([0-9.]+) ([mg]ib) memory in use")}


def classify_outcome(text: Column) -> Column:
    """(kind, marker) of harness output: infrastructure before budget, in the order of the lists; nulls if clean."""
    low = F.lower(text)
    marker = kind = None
    for k, ms in (("harness_infra", INFRA_MARKERS), ("agent_budget", BUDGET_MARKERS)):
        for m in ms:
            marker = F.when(low.contains(m), m) if marker is None else marker.when(low.contains(m), m)
            kind = F.when(low.contains(m), k) if kind is None else kind.when(low.contains(m), k)
    return F.struct(kind.alias("kind"), marker.alias("marker"))


def chat_render(messages: Column, opener: bool = True) -> Column:
    """Turns between markers; the last turn, if an assistant's, opens with an empty reasoning block, unless opener is off
    because its content has one."""
    n = F.size(messages)
    turns = F.transform(
        messages,
        lambda m, i: F.concat(
            F.lit("<|im_start|>"), m["role"], F.lit("\n"),
            F.when((i == n - 1) & (m["role"] == "assistant") & F.lit(opener), F.lit("<think>\n\n</think>\n\n")).otherwise(F.lit("")),
            F.coalesce(m["content"], F.lit("")), F.lit("<|im_end|>\n"),
        ),
    )
    return F.array_join(turns, "")


def pre_render(messages: Column, system: Column) -> Column:
    """Native turns flattened to roles and contents: tool output as a wrapped user turn, reasoning before the answer."""

    def one(m: Column) -> Column:
        content = py_strip(F.coalesce(m["content"], F.lit("")))
        role = F.when(m["role"] == "tool", F.lit("user")).otherwise(m["role"])
        text = (
            F.when(m["role"] == "system", system)
            .when(m["role"] == "tool", F.concat(F.lit("<tool_response>\n"), content, F.lit("\n</tool_response>")))
            .when(m["role"] == "assistant", F.concat(F.lit("<think>\n\n</think>\n\n"), content))
            .otherwise(content)
        )
        return F.struct(role.alias("role"), text.alias("content"))

    return F.transform(messages, one)


def bake_system(rendered: Column) -> Column:
    """The system turn of a render without its header; null if the render opens otherwise."""
    header = "<|im_start|>system\n"
    return F.when(rendered.startswith(header), F.substring(F.substring_index(rendered, "<|im_end|>\n", 1), len(header) + 1, 2**31 - 1))


def tool_calls_text(calls: Column, content: Column) -> Column:
    """The block of tool calls after a content; calls is an array of (name, arguments array of (key, value))."""

    def one(call: Column, i: Column) -> Column:
        lead = F.when((i == 0) & (py_strip(content) != ""), F.lit("\n\n")).when(i == 0, F.lit("")).otherwise(F.lit("\n"))
        args = F.array_join(F.transform(call["arguments"], lambda a: F.concat(F.lit("<parameter="), a["key"], F.lit(">\n"), a["value"], F.lit("\n</parameter>\n"))), "")
        return F.concat(lead, F.lit("<tool_call>\n<function="), call["name"], F.lit(">\n"), args, F.lit("</function>\n</tool_call>"))

    return F.array_join(F.transform(calls, one), "")


def observation_text(results: Column) -> Column:
    """Contents of results that aren't empty, one a line; null without any."""
    parts = F.filter(F.transform(results, lambda r: r["content"]), lambda c: c.isNotNull() & (c != ""))
    return F.when(F.size(parts) > 0, F.array_join(parts, "\n"))


def long_options(help_text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(help_text, F.lit(r"--[a-z0-9][a-z0-9-]+"), F.lit(0)))


def forwarded_options(asked: Column, supported: Column) -> Column:
    """(forwarded, unsupported, note) of asked options."""
    missing = F.array_except(asked, supported)
    note = F.when(F.size(missing) > 0, F.concat(F.lit("NOT SET: "), F.array_join(missing, ", ")))
    return F.struct(F.array_intersect(asked, supported).alias("forwarded"), missing.alias("unsupported"), note.alias("note"))


def extend_list(current: Column, *extra: str) -> Column:
    """Comma list with more entries, each once, in order of first occurrence."""
    have = F.filter(F.split(F.coalesce(current, F.lit("")), ","), lambda x: x != "")
    return F.array_join(F.array_distinct(F.concat(have, F.array(*[F.lit(x) for x in extra]))), ",")


def proxy_policy(env: Column, local: bool, host: str) -> Column:
    """A map of settings without proxies for local runs, else with the host excepted from them."""
    keys = ("HTTP_PROXY", "HTTPS_PROXY", "http_proxy", "https_proxy")
    if local:
        return F.map_filter(env, lambda k, v: ~k.isin(*keys))
    none = ("NO_PROXY", "no_proxy")
    kept = F.map_filter(env, lambda k, v: ~k.isin(*none))
    extra = F.create_map(*[x for k in none for x in (F.lit(k), extend_list(F.try_element_at(env, F.lit(k)), host, "127.0.0.1", "localhost"))])
    used = F.exists(F.map_entries(env), lambda e: e["key"].isin(*keys) & (e["value"] != ""))
    return F.when(used, F.map_concat(kept, extra)).otherwise(env)


def escape_cell(c: Column) -> Column:
    return F.replace(c, F.lit("|"), F.lit("\\|"))


def collective_timeout(line: Column) -> dict[str, Column]:
    """Operation, size and rank of a collective timeout line."""
    return {
        "op": F.nullif(F.regexp_extract(line, r"OpType=(\w+)", 1), F.lit("")),
        "numel": F.nullif(F.regexp_extract(line, r"NumelIn=(\d+)", 1), F.lit("")).try_cast("bigint"),
        "rank": F.nullif(F.regexp_extract(line, r"\[Rank (\d+)\]", 1), F.lit("")).try_cast("bigint"),
    }
