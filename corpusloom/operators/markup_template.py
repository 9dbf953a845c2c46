"""The template with its own markup of tool calls: results of tools become parts of the next user turn, in the order of the calls;
thoughts of answers before the last question are dropped unless tools are in play; tasks have marks of their own.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

from corpusloom.functions.tokenizers import Tokenizer
from corpusloom.operators.templates import inferred_lengths
from corpusloom.operators.tool_formats import dumped

# Marks and texts of the format (fixed values).
BEGIN, END = "<｜begin▁of▁sentence｜>", "<｜end▁of▁sentence｜>"
USER, ASSISTANT, REMINDER = "<｜User｜>", "<｜Assistant｜>", "<｜latest_reminder｜>"
THINK, THOUGHT, MARKUP = "<think>", "</think>", "｜DSML｜"
TASKS = ("action", "query", "authority", "domain", "title", "read_url")
TOOLS = (
    "## Tools\n\nYou have access to a set of tools to help answer the user's question. You can invoke tools by writing a \"<{m}tool_calls>\" block like the following:\n\n"
    '<{m}tool_calls>\n<{m}invoke name="$TOOL_NAME">\n<{m}parameter name="$PARAMETER_NAME" string="true|false">$PARAMETER_VALUE</{m}parameter>\n...\n</{m}invoke>\n<{m}invoke name="$TOOL_NAME2">\n...\n</{m}invoke>\n</{m}tool_calls>\n\n'
    'String parameters should be specified as is and set `string="true"`. For all other types (numbers, booleans, arrays, objects), pass the value in JSON format and set `string="false"`.\n\n'
    "If thinking_mode is enabled (triggered by {a}), you MUST output your complete reasoning inside {a}...{b} BEFORE any tool calls or final response.\n\nOtherwise, output directly after {b} with tool calls or final response.\n\n"
    "### Available Tool Schemas\n\n{schemas}\n\nYou MUST strictly follow the above defined tool name and parameter schemas to invoke tool calls.\n"
)
GREATEST_EFFORT = (
    "Reasoning Effort: Absolute maximum with no shortcuts permitted.\nYou MUST be very thorough in your thinking and comprehensively decompose the problem to resolve the root cause, rigorously stress-testing your logic against all potential paths, edge cases, and adversarial scenarios.\n"
    "Explicitly write out your entire deliberation process, documenting every intermediate step, considered alternative, and rejected hypothesis to ensure absolutely no assumption is left unchecked.\n\n"
)
SCHEMA = "## Response Format:\n\nYou MUST strictly adhere to the following schema to reply:\n{schema}"


@dataclass
class Turn:
    """``parts`` are texts and, as (id, text), results of tools; ``calls`` are (id, name, arguments)."""

    role: str
    parts: list = field(default_factory=list)
    thought: str = ""
    calls: list[tuple[str, str, str]] = field(default_factory=list)
    tools: list[dict] = field(default_factory=list)
    task: str | None = None
    schema: object = None
    ended: bool = True

    @property
    def asks(self) -> bool:
        return self.role in ("user", "developer")


def parsed_tools(tools: str | None) -> list[dict]:
    """Tools in the one notation that is allowed; anything else is an error."""
    if not tools or not tools.strip():
        return []
    found = json.loads(tools)
    for t in found if isinstance(found, list) else []:
        if not isinstance(t, dict) or "function" not in t:
            raise ValueError(f"not a function tool: {t!r}")
    return found if isinstance(found, list) else []


def _assistant(m: dict) -> Turn:
    said, thought = m.get("content") or "", ""
    if "reasoning_content" in m and m["reasoning_content"] is not None:
        thought = m["reasoning_content"]
    elif inline := re.match(r"\s*<think>\s*(.*?)\s*</think>\s*", said, re.S):
        thought, said = inline.group(1), said[inline.end() :]
    calls = [(c.get("id") or c["function"].get("id") or "", c["function"]["name"], c["function"]["arguments"]) for c in m.get("tool_calls") or []]
    return Turn("assistant", [said], thought, calls, task=m.get("task"), ended=not m.get("wo_eos"))


def turns_of(messages: list[dict], system: str | None, tools: str | None) -> list[Turn]:
    """Turns with the system text and tools at their head and every tool's result in a user turn."""
    given, out, order = parsed_tools(tools), [], {}
    messages = list(messages)
    if messages and messages[0]["role"] in ("system", "developer"):
        first = dict(messages[0])
        if system:
            first["content"] = "\n\n".join(x for x in (system, first.get("content")) if x)
        if given:
            first.setdefault("tools", given)
        messages[0] = first
    elif system or given:
        messages.insert(0, {"role": "system", "content": system or "", "tools": given})
    for m in messages:
        role, text = m["role"], m.get("content") or ""
        if role == "assistant":
            out.append(_assistant(m))
            if out[-1].calls:
                order = {i: k for k, (i, *_) in enumerate(out[-1].calls) if i}
        elif role in ("tool", "function", "observation"):
            if not out or out[-1].role != "user":
                out.append(Turn("user"))
            out[-1].parts.append((m.get("tool_call_id") or "", text))
            _in_call_order(out[-1], order)
        elif role == "user":
            if out and out[-1].role == "user" and out[-1].task is None:
                out[-1].parts.append(text)
            else:
                out.append(Turn("user", [text], task=m.get("task"), ended=not m.get("wo_eos")))
        elif role in ("system", "developer", "latest_reminder"):
            out.append(Turn(role, [text], tools=m.get("tools") or [], schema=m.get("response_format"), task=m.get("task")))
        else:
            raise ValueError(f"unexpected role {role!r}")
    return out


def _in_call_order(t: Turn, order: dict[str, int]) -> None:
    at = [k for k, p in enumerate(t.parts) if isinstance(p, tuple)]
    if order:
        for k, p in zip(at, sorted((t.parts[k] for k in at), key=lambda p: order.get(p[0], 0)), strict=True):
            t.parts[k] = p


def _call(name: str, arguments: str) -> str:
    try:
        given = json.loads(arguments)
        given = given if isinstance(given, dict) else {"arguments": arguments}
    except (ValueError, TypeError):
        given = {"arguments": arguments}
    lines = [f'<{MARKUP}parameter name="{k}" string="{"true" if isinstance(v, str) else "false"}">{dumped(v)}</{MARKUP}parameter>' for k, v in given.items()]
    return f'<{MARKUP}invoke name="{name}">\n' + "\n".join(lines) + f"\n</{MARKUP}invoke>"


def _extras(t: Turn) -> str:
    out = ""
    if t.tools:
        out += "\n\n" + TOOLS.format(m=MARKUP, a=THINK, b=THOUGHT, schemas="\n".join(dumped(x["function"]) for x in t.tools))
    if t.schema:
        out += "\n\n" + SCHEMA.format(schema=dumped(t.schema))
    return out


def rendered(turns: list[Turn], thinking: bool = True, drop: bool = True, effort: str | None = None) -> list[str]:
    """The text of each turn, with the marks that lead over to the next one.

    ``drop`` leaves out the thoughts of answers before the last question, unless some turn has tools.
    """
    drop = drop and thinking and not any(t.tools for t in turns)
    last = max((i for i, t in enumerate(turns) if t.asks), default=-1)
    if drop:
        turns = [t for i, t in enumerate(turns) if i >= last or t.role != "developer"]
        last = max((i for i, t in enumerate(turns) if t.asks), default=-1)
    out = []
    for i, t in enumerate(turns):
        text = GREATEST_EFFORT if i == 0 and thinking and effort == "max" else ""
        if t.role == "system":
            text += t.parts[0] + _extras(t)
        elif t.role == "developer":
            text += USER + t.parts[0] + _extras(t)
        elif t.role == "latest_reminder":
            text += REMINDER + t.parts[0]
        elif t.role == "user":
            text += USER + "\n\n".join(f"<tool_result>{p[1]}</tool_result>" if isinstance(p, tuple) else p for p in t.parts)
        else:
            after_task = i > 0 and turns[i - 1].task is not None
            if thinking and not after_task and (not drop or i > last):
                text += t.thought + THOUGHT
            text += t.parts[0]
            if t.calls:
                text += f"\n\n<{MARKUP}tool_calls>\n" + "\n".join(_call(n, a) for _, n, a in t.calls) + f"\n</{MARKUP}tool_calls>"
            text += END if t.ended else ""
        following = turns[i + 1].role if i + 1 < len(turns) else None
        if following in (None, "assistant", "latest_reminder"):
            text += _lead(t, i, last, thinking, drop)
        out.append(text)
    return out


def _lead(t: Turn, i: int, last: int, thinking: bool, drop: bool) -> str:
    """What stands between a turn and the answer that follows it."""
    if t.task is not None:
        if t.task not in TASKS:
            raise ValueError(f"unknown task {t.task!r}")
        mark = f"<｜{t.task}｜>"
        return ASSISTANT + (THINK if thinking else THOUGHT) + mark if t.task == "action" else mark
    if not t.asks:
        return ""
    return ASSISTANT + (THINK if thinking and (not drop or i >= last) else THOUGHT)


def encoded_pairs(messages: list[dict], system: str | None, tools: str | None, tokenizer: Tokenizer, cutoff: int = 1_000_000, **how) -> list[tuple[list[int], list[int]]]:
    """(prompt ids, answer ids) of each answer, as many as fit; what follows the last answer is left out."""
    turns = turns_of(messages, system, tools)
    texts = rendered(turns, **how)
    kept = turns if len(texts) == len(turns) else [t for t in turns if t.role != "developer" or t is turns[-1]]
    out, asked, used = [], BEGIN, 0
    for t, text in zip(kept, texts, strict=False):
        if t.role != "assistant":
            asked += text
            continue
        if used >= cutoff - 1:
            break
        a, b = tokenizer.encode(asked), tokenizer.encode(text)
        n, m = inferred_lengths(len(a), len(b), cutoff - 1 - used)
        out.append((a[:n], b[:m]))
        used, asked = used + n + m, ""
    return out
