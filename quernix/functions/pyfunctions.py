"""Functions that need Python: JSON of agents with exact acceptance rules, loss masks by spans. Arrow batches only."""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernix.functions.text import WARNING_PREAMBLE

REQUIRED_KEYS = ("analysis", "plan", "commands")
_NORMALIZED = T.StructType([T.StructField("canonical", T.StringType()), T.StructField("rewritten", T.BooleanType()), T.StructField("reason", T.StringType())])
_FENCED = re.compile(r"```(?:json|JSON)?\s*(\{.*?\})\s*```", re.DOTALL)
_QUOTED_OR_BRACE = re.compile(r'"(?:[^"\\]|\\.)*"?|[{}]', re.DOTALL)


def balanced_objects(text: str) -> list[str]:
    """Outermost brace-balanced pieces from left to right; braces inside quotes don't count once a piece has begun.
    An opening brace that is never closed ends the search.
    """
    found, at = [], 0
    while (start := text.find("{", at)) >= 0:
        depth = 0
        for m in _QUOTED_OR_BRACE.finditer(text, start):
            depth += {"{": 1, "}": -1}.get(m.group(), 0)
            if depth == 0:
                found.append(text[start : m.end()])
                at = m.end()
                break
        else:
            break
    return found


def _object(text: str) -> dict | None:
    """The JSON object that a text is, raw control characters allowed; null for anything else."""
    try:
        value = json.loads(text, strict=False)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _lack(value: dict) -> str | None:
    if not set(REQUIRED_KEYS) <= set(value):
        return "missing_required_keys"
    return None if isinstance(value["commands"], list) else "commands_not_list"


def normalize_response(raw: str | None) -> tuple[str | None, bool, str]:
    """(canonical JSON, rewritten, reason) of an agent's response. Of the objects in it (the whole text, else fenced ones,
    else balanced ones) the first holds that has all required keys and a list of commands. Without one, reason tells what
    the last object lacked.
    """
    raw = raw or ""
    whole = raw.strip()
    first = _object(whole)
    if first is not None and _lack(first) is None:
        objects = [first]
    else:
        objects = [x for x in (first, *map(_object, _FENCED.findall(raw)), *map(_object, balanced_objects(raw))) if x is not None]
    sound = next((x for x in objects if _lack(x) is None), None)
    if sound is None:
        return None, False, _lack(objects[-1]) if objects else "unparseable"
    canonical = json.dumps(sound, indent=2, ensure_ascii=False)
    return canonical, canonical != whole, "ok"


def keystrokes(canonical: str | None) -> list[str]:
    """Keystrokes of the commands of a response, in order."""
    try:
        value = json.loads(canonical or "")
    except ValueError:
        return []
    commands = value.get("commands") if isinstance(value, dict) else None
    return [str(c.get("keystrokes", "")) for c in commands or [] if isinstance(c, dict)]


@F.pandas_udf(_NORMALIZED)
def normalize_response_udf(raw: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([normalize_response(x) for x in raw], columns=["canonical", "rewritten", "reason"])


@F.pandas_udf(T.ArrayType(T.StringType()))
def keystrokes_udf(canonical: pd.Series) -> pd.Series:
    return canonical.map(keystrokes)


@F.pandas_udf(T.ArrayType(T.StringType()))
def balanced_objects_udf(text: pd.Series) -> pd.Series:
    return text.map(lambda x: balanced_objects(x or ""))


def content_hash(messages: list[dict] | None) -> str | None:
    """SHA-256 of the messages as JSON with sorted keys."""
    return None if messages is None else hashlib.sha256(json.dumps(messages, sort_keys=True, ensure_ascii=False).encode()).hexdigest()


@F.pandas_udf(T.StringType())
def content_hash_udf(messages: pd.Series) -> pd.Series:
    return messages.map(lambda ms: None if ms is None else content_hash([dict(m) for m in ms]))


_PREAMBLE = re.compile(WARNING_PREAMBLE)


def canonical_turns(roles: list[str | None], contents: list[str | None]) -> tuple[list[str | None], int, int, str, str | None]:
    """(contents, assistant turns, rewritten turns, command signature, first thing wrong) of a conversation whose
    answers are brought into canonical form. A user turn loses a warning preamble if the answer before it was rewritten.
    """
    out, answers, rewrites, typed, wrong, last_rewritten = [], 0, 0, [], None, False
    for role, content in zip(roles, contents, strict=True):
        reason = "nonstring_message" if content is None else None
        if role == "assistant":
            text, last_rewritten, how = normalize_response(content)
            answers, rewrites = answers + 1, rewrites + last_rewritten
            typed += keystrokes(text)
            reason = reason or (how if text is None else None)
        else:
            text = content
            if role == "user" and text is not None:
                reason = reason or ("empty_user_turn" if not text.strip() else None)
                text = _PREAMBLE.sub("", text) if last_rewritten else text
        wrong = wrong or reason
        out.append(text)
    return out, answers, rewrites, hashlib.sha256("\0".join(typed).encode("utf-8", "surrogatepass")).hexdigest(), wrong


ASSISTANT_HEADER, END_MARKER, THINK_OPENER = "<|im_start|>assistant\n", "<|im_end|>", "<think>\n"


def trained_spans(rendered: str, trained: list[bool]) -> list[tuple[int, int]]:
    """Character spans of a render that are trained; trained tells it for each assistant turn. A span reaches over the
    end marker and one line end; an opener of reasoning belongs to the prompt."""
    spans, at = [], 0
    for on in trained:
        head = rendered.find(ASSISTANT_HEADER, at)
        body = head + len(ASSISTANT_HEADER)
        end = rendered.find(END_MARKER, body) if head >= 0 else -1
        if end < 0:
            raise ValueError("render and turns don't agree")
        at = end + len(END_MARKER)
        at += rendered[at : at + 1] == "\n"
        if on:
            spans.append((body + (len(THINK_OPENER) if rendered.startswith(THINK_OPENER, body) else 0), at))
    return spans


def token_mask(length: int, spans: list[tuple[int, int]], offsets: list[tuple[int, int]]) -> list[int]:
    """1 for tokens that overlap a span."""
    inside = np.zeros(length + 1, dtype=np.int64)
    for s, e in spans:
        inside[s + 1 : e + 1] = 1
    upto = np.cumsum(inside)
    return [int(e > s and upto[e] > upto[s]) for s, e in offsets]


def trained_chars(messages: Column) -> Column:
    """Number of characters of a render that are in trained_spans, without a search: lengths of contents, markers and
    line ends of assistant turns."""
    n = F.size(messages)
    extra = len(END_MARKER) + 1

    def one(m: Column, i: Column) -> Column:
        opener = F.when(i == n - 1, F.lit(len("<think>\n\n</think>\n\n") - len(THINK_OPENER))).otherwise(F.lit(0))
        starts = F.when((i < n - 1) & F.coalesce(m["content"], F.lit("")).startswith(THINK_OPENER), F.lit(len(THINK_OPENER))).otherwise(F.lit(0))
        return F.when(m["role"] == "assistant", F.length(F.coalesce(m["content"], F.lit(""))) + extra + opener - starts).otherwise(0)

    return F.aggregate(F.transform(messages, one), F.lit(0).cast("bigint"), lambda a, b: a + b)
