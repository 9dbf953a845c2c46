"""How tools and calls of them are written: descriptions for the system text, calls in answers, and calls read back."""

from __future__ import annotations

import json
import re

# Texts around descriptions of tools (fixed values of the public formats).
PLAIN = 'You have access to the following tools:\n{tools}Use the following format if using a tool:\n```\nAction: tool name (one of [{names}]).\nAction Input: the input to the tool, in a JSON format representing the kwargs (e.g. ```{{"input": "hello world", "num_beams": 5}}```).\n```\n'
TAGGED = (
    "# Tools\n\nYou may call one or more functions to assist with the user query.\n\nYou are provided with function signatures within <tools></tools> XML tags:\n<tools>{tools}\n</tools>\n\n"
    'For each function call, return a json object with function name and arguments within <tool_call></tool_call> XML tags:\n<tool_call>\n{{"name": <function-name>, "arguments": <args-json-object>}}\n</tool_call>'
)
NO_THINKING = "\ndetailed thinking off"


def dumped(value) -> str:
    """JSON with the spacing of Python's encoder; a text stays as it is."""
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def listed(tools: str | None) -> list[dict]:
    """The tools of a JSON text; none if it isn't one."""
    try:
        found = json.loads(tools or "[]")
    except ValueError:
        return []
    found = found if isinstance(found, list) else [found]
    return [t for t in found if isinstance(t, dict)]


def _argument(name: str, about: dict, required: list) -> str:
    choice = f", should be one of [{', '.join(map(str, about['enum']))}]" if about.get("enum") else ""
    each = f", where each item should be {about['items'].get('type', '')}" if about.get("items") else ""
    return f"  - {name} ({about.get('type', '')}{', required' if name in required else ''}): {about.get('description', '')}{choice}{each}\n"


def described(tools: str | None, style: str = "plain") -> str:
    """The text that follows the system message; nothing without tools."""
    found = listed(tools)
    if not found:
        return ""
    if style == "plain":
        parts, names = [], []
        for t in (t.get("function", t) for t in found):
            takes = t.get("parameters") or {}
            arguments = "".join(_argument(n, a, takes.get("required") or []) for n, a in (takes.get("properties") or {}).items())
            parts.append(f"> Tool Name: {t.get('name', '')}\nTool Description: {t.get('description', '')}\nTool Args:\n{arguments}\n")
            names.append(t.get("name", ""))
        return PLAIN.format(tools="".join(parts), names=", ".join(names))
    whole = "".join("\n" + dumped(t if t.get("type") == "function" else {"type": "function", "function": t}) for t in found)
    text = TAGGED.format(tools=whole)
    return text + NO_THINKING if style == "tagged_plain" else "\n\n" + text


def calls_of(content: str) -> list[tuple[str, str]]:
    """(name, arguments) of a function turn's JSON: one call or a list of them; none if it isn't such JSON."""
    try:
        found = json.loads(content)
    except ValueError:
        return []
    found = found if isinstance(found, list) else [found]
    return [(c["name"], dumped(c["arguments"])) for c in found if isinstance(c, dict) and "name" in c and "arguments" in c]


def written(content: str) -> str:
    """A function turn in tags, a thought before it kept; the content as it is if it holds no calls."""
    thought = re.search(r"<think>.*</think>", content, re.S)
    bare = content.replace(thought.group(0), "") if thought else content
    calls = calls_of(bare)
    if not calls:
        return content
    tags = "\n".join("<tool_call>\n" + json.dumps({"name": n, "arguments": json.loads(a)}, ensure_ascii=False) + "\n</tool_call>" for n, a in calls)
    return (thought.group(0) if thought else "") + tags


def extracted(text: str) -> list[tuple[str, str]] | str:
    """(name, arguments) of the calls in an answer, tagged or plain; the text itself if they can't be read."""
    marked = re.findall(r"<tool_call>(.+?)</tool_call>(?=\s*<tool_call>|\s*$)", text, re.S)
    if marked:
        try:
            read = [json.loads(m.strip()) for m in marked]
            return [(c["name"], json.dumps(c["arguments"], ensure_ascii=False)) for c in read]
        except (ValueError, KeyError, TypeError):
            return text
    plain = re.search(r"Action:\s*([a-zA-Z0-9_]+).*?Action Input:\s*(.*)", text, re.S)
    if not plain:
        return text
    try:
        return [(plain.group(1).strip(), json.dumps(json.loads(plain.group(2).strip().strip('"').strip("`")), ensure_ascii=False))]
    except ValueError:
        return text
