"""Chat and preference records of several layouts aligned to one schema, as column expressions.

The aligned schema is ``prompt`` and ``response`` (arrays of role and content), ``system`` and ``tools``. Records that
break their layout's rules come out with empty arrays; ``aligned`` drops them. All layouts take a ``Mapping`` of logical to
physical columns, of which those that are absent count as null.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

TURNS = "array<struct<role:string,content:string>>"
TOOL_TURNS = "array<struct<role:string,content:string,tool_calls:array<struct<id:string,type:string,function:struct<name:string,arguments:string>>>,tool_call_id:string,reasoning_content:string>>"
USER, ASSISTANT, OBSERVATION, FUNCTION, SYSTEM = "user", "assistant", "observation", "function", "system"


@dataclass(frozen=True)
class Mapping:
    """Physical names of logical columns, fields of a message and tags of roles; ``extra`` columns are carried through."""

    prompt: str = "instruction"
    query: str = "input"
    response: str = "output"
    history: str | None = None
    messages: str = "conversations"
    system: str | None = None
    tools: str | None = None
    chosen: str = "chosen"
    rejected: str = "rejected"
    kto_tag: str | None = None
    role: str = "from"
    content: str = "value"
    user: str = "human"
    assistant: str = "gpt"
    observation: str = "observation"
    function: str = "function_call"
    system_tag: str | None = "system"
    ranking: bool = False
    extra: tuple[str, ...] = field(default=())

    def renamed(self, **names: str) -> Mapping:
        """With other names; an unknown logical name is an error."""
        unknown = set(names) - set(self.__dataclass_fields__)
        if unknown:
            raise KeyError(f"unknown keys: {sorted(unknown)}")
        return replace(self, **names)

    def check(self, df: DataFrame, *needed: str) -> None:
        """An error if a column that a layout needs isn't there."""
        missing = [getattr(self, n) for n in needed if getattr(self, n) not in df.columns]
        if missing:
            raise KeyError(f"missing columns: {missing}")


OPENAI = Mapping(messages="messages", role="role", content="content", user="user", assistant="assistant", observation="tool", function="function_call", system_tag="system")


def _col(df: DataFrame, name: str | None, kind: str = "string") -> Column:
    return F.col(name).cast(kind) if name and name in df.columns else F.lit(None).cast(kind)


def turn(role: str | Column, content: Column) -> Column:
    return F.struct((F.lit(role) if isinstance(role, str) else role).alias("role"), content.cast("string").alias("content"))


def _none() -> Column:
    return F.array().cast(TURNS)


def _with_opposite(df: DataFrame, m: Mapping, response: Column) -> Column:
    """An answer with a tag of approval stands before an empty one if it was approved, else behind it; without a tag alone."""
    if not (m.kto_tag and m.kto_tag in df.columns):
        return response
    tag, empty = F.col(m.kto_tag).cast("boolean"), F.array(turn(ASSISTANT, F.lit("")))
    return F.when(tag, F.concat(response, empty)).when(~tag, F.concat(empty, response)).otherwise(response)


def _finish(df: DataFrame, m: Mapping, prompt: Column, response: Column, system: Column, good: Column) -> DataFrame:
    extra = [c for c in m.extra if c != "labels" and c in df.columns]
    tools = F.coalesce(_col(df, m.tools), F.lit(""))
    response = _with_opposite(df, m, response)
    return df.select(F.when(good, prompt).otherwise(_none()).alias("prompt"), F.when(good, response).otherwise(_none()).alias("response"), system.alias("system"), tools.alias("tools"), *extra)


def from_alpaca(df: DataFrame, m: Mapping = Mapping()) -> DataFrame:  # noqa: B008
    """Instruction, input, output and history pairs. A ranked record answers with chosen and rejected.

    Instruction and input are joined by a line feed, null and empty ones left out; an output that is a list gives a turn for
    each element; a null one gives none.
    """
    m.check(df, "prompt")
    kinds = dict(df.dtypes)
    past = _none()
    if m.history and m.history in df.columns:
        pairs = F.coalesce(F.col(m.history), F.array().cast(kinds[m.history]))
        past = F.flatten(F.transform(pairs, lambda h: F.array(turn(USER, F.get(h, F.lit(0))), turn(ASSISTANT, F.get(h, F.lit(1))))))
    asked = F.concat_ws("\n", F.nullif(_col(df, m.prompt), F.lit("")), F.nullif(_col(df, m.query), F.lit("")))

    def answers(name: str, at: int | None = None) -> Column:
        if name not in df.columns:
            return _none()
        if kinds[name].startswith("array"):
            return F.transform(F.coalesce(F.col(name), F.array().cast(kinds[name])), lambda x: turn(ASSISTANT, x)) if at is None else F.array(turn(ASSISTANT, F.get(F.col(name), F.lit(at))))
        return F.when(F.col(name).isNotNull(), F.array(turn(ASSISTANT, F.col(name)))).otherwise(_none())

    response = F.concat(answers(m.chosen, 0), answers(m.rejected, 0)) if m.ranking else answers(m.response)
    system = F.coalesce(_col(df, m.system), F.lit(""))
    return _finish(df, m, F.concat(past, F.array(turn(USER, asked))), response, system, F.lit(True))


def _mapped(role: Column, m: Mapping, otherwise: Column | None = None) -> Column:
    out = F.when(role == m.user, USER).when(role == m.assistant, ASSISTANT).when(role == m.observation, OBSERVATION).when(role == m.function, FUNCTION)
    out = out.when(role == m.system_tag, SYSTEM) if m.system_tag else out
    return out if otherwise is None else out.otherwise(otherwise)


def _peeled(df: DataFrame, m: Mapping) -> tuple[Column, Column]:
    """Messages without a leading system message, and the system text."""
    said = F.col(m.messages)
    leads = F.coalesce((F.size(said) > 0) & (F.get(said, F.lit(0))[m.role] == m.system_tag), F.lit(False)) if m.system_tag else F.lit(False)
    system = F.when(leads, F.get(said, F.lit(0))[m.content]).otherwise(F.coalesce(_col(df, m.system), F.lit("")))
    return F.when(leads, F.slice(said, F.lit(2), F.greatest(F.size(said) - 1, F.lit(0)))).otherwise(F.coalesce(said, F.array().cast(dict(df.dtypes)[m.messages]))), system


def alternates(messages: Column, m: Mapping) -> Column:
    """Whether roles take their turns: the user's side at even positions, the assistant's at odd ones."""
    fits = lambda x, i: F.when(i % 2 == 0, x[m.role].isin(m.user, m.observation)).otherwise(x[m.role].isin(m.assistant, m.function))
    return F.forall(F.transform(messages, lambda x, i: F.coalesce(fits(x, i), F.lit(False))), lambda ok: ok)


def _chosen_pair(df: DataFrame, m: Mapping) -> tuple[Column, Column]:
    """The chosen and the rejected answer as turns, and whether both are the assistant's side's."""
    pair = F.array(*[turn(F.coalesce(_mapped(F.col(c)[m.role], m), F.lit(ASSISTANT)), F.col(c)[m.content]) for c in (m.chosen, m.rejected)])
    return pair, F.col(m.chosen)[m.role].isin(m.assistant, m.function) & F.col(m.rejected)[m.role].isin(m.assistant, m.function)


def from_sharegpt(df: DataFrame, m: Mapping = Mapping(), keep_null: bool = False) -> DataFrame:  # noqa: B008
    """Lists of tagged messages: an optional system message, then roles in turn; the last message answers.

    Messages without content are left out after the roles are tested, unless ``keep_null``. An odd number of messages (even for ranked
    records, whose answers are chosen and rejected) breaks the record.
    """
    m.check(df, "messages")
    said, system = _peeled(df, m)
    kept = F.transform(said if keep_null else F.filter(said, lambda x: x[m.content].isNotNull()), lambda x: turn(_mapped(x[m.role], m, F.lit("unknown")), x[m.content]))
    n = F.size(kept)
    good = alternates(said, m) & (F.size(said) > 0)
    if m.ranking:
        pair, ok = _chosen_pair(df, m)
        return _finish(df, m, kept, pair, system, F.coalesce(good & (n % 2 == 1) & ok, F.lit(False)))
    return _finish(df, m, F.slice(kept, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(kept, F.greatest(n, F.lit(1)), F.lit(1)), system, F.coalesce(good & (n % 2 == 0) & (n > 0), F.lit(False)))


def from_tagged(df: DataFrame, m: Mapping = Mapping()) -> DataFrame:  # noqa: B008
    """As ``from_sharegpt`` in the second pipeline, which keeps messages without content and knows approval tags."""
    return from_sharegpt(df, m, keep_null=True)


def from_periodic(df: DataFrame, m: Mapping = Mapping()) -> DataFrame:  # noqa: B008
    """Messages whose roles recur every three turns: a system message, the user's side, the assistant's side.

    The first of three passes if its role is a part of the system tag's text. Messages without content are left out after that; their
    number must be a multiple of three, and must not be for ranked records. System messages stay in the prompt; the record's system text
    is empty. Null and empty lists, and roles that are null, break the record.
    """
    m.check(df, "messages")
    said = F.coalesce(F.col(m.messages), F.array().cast(dict(df.dtypes)[m.messages]))
    fits = lambda x, i: F.when(i % 3 == 0, F.contains(F.lit(m.system_tag or ""), x[m.role])).when(i % 3 == 1, x[m.role].isin(m.user, m.observation)).otherwise(x[m.role].isin(m.assistant, m.function))
    in_turn = F.forall(F.transform(said, lambda x, i: F.coalesce(fits(x, i), F.lit(False))), lambda ok: ok)
    kept = F.transform(F.filter(said, lambda x: x[m.content].isNotNull()), lambda x: turn(_mapped(x[m.role], m, F.lit("unknown")), x[m.content]))
    n = F.size(kept)
    good = in_turn & (F.size(said) > 0)
    prompt, response = F.slice(kept, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(kept, F.greatest(n, F.lit(1)), F.lit(1))
    if m.ranking:
        pair, ok = _chosen_pair(df, m)
        both = F.col(m.chosen).isNotNull() & F.col(m.rejected).isNotNull()
        prompt, response = F.when(both, kept).otherwise(prompt), F.when(both, pair).otherwise(response)
        good = good & (n % 3 != 0) & (~both | ok)
    else:
        good = good & (n % 3 == 0) & (n > 0)
    return _finish(df, m, prompt, response, F.lit(""), F.coalesce(good, F.lit(False)))


def from_openai(df: DataFrame, m: Mapping = OPENAI) -> DataFrame:
    """Messages with roles as such; fields of tool calls are kept where the messages have them.

    Any order is allowed, but unknown roles, a first message that is neither the user's nor the system's and a last one that isn't
    the assistant's break the record. Null contents are empty.
    """
    m.check(df, "messages")
    said, system = _peeled(df, m)
    fields = [f.name for f in df.schema[m.messages].dataType.elementType.fields]
    tool = [f for f in ("tool_calls", "tool_call_id", "reasoning_content") if f in fields]
    whole = F.transform(said, lambda x: F.struct(_mapped(x[m.role], m).alias("role"), F.coalesce(x[m.content], F.lit("")).alias("content"), *[x[f].alias(f) for f in tool]))
    n = F.size(whole)
    good = (n > 0) & F.forall(whole, lambda x: x["role"].isNotNull()) & F.get(whole, F.lit(0))["role"].isin(USER, SYSTEM) & (F.get(whole, n - 1)["role"] == ASSISTANT)
    good = F.coalesce(good, F.lit(False))
    none = F.filter(whole, lambda _: F.lit(False))
    extra = [c for c in m.extra if c != "labels" and c in df.columns]
    return df.select(
        F.when(good, F.slice(whole, F.lit(1), F.greatest(n - 1, F.lit(0)))).otherwise(none).alias("prompt"),
        F.when(good, F.slice(whole, F.greatest(n, F.lit(1)), F.lit(1))).otherwise(none).alias("response"),
        F.coalesce(system, F.lit("")).alias("system"),
        F.coalesce(_col(df, m.tools), F.lit("")).alias("tools"),
        *extra,
    )


#: What stands between the results of calls that come as one turn, and the note in system texts without tools (fixed values).
RESULTS_BETWEEN = "\n</tool_response>\n<tool_response>\n"
NO_THINKING = "detailed thinking off"
_THINKING = ("detailed thinking on", "detailed thinking off")


@F.arrow_udf(ArrayType(StringType()))
def calls_texts(calls: pa.Array) -> pa.Array:
    """For each message of an array its calls (name and arguments) as JSON text, null without calls."""
    one = lambda c: json.dumps(c, ensure_ascii=False) if c else None
    return pa.array([None if all_ is None else [one(c) for c in all_] for all_ in calls.to_pylist()], pa.list_(pa.string()))


def merged_tool_results(messages: Column) -> Column:
    """Consecutive observations joined into one turn; observations that nothing follows are left out."""
    none = F.array().cast(TURNS)
    held = F.array().cast("array<string>")

    def step(s: Column, x: Column) -> Column:
        observed = x["role"] == OBSERVATION
        before = F.when(F.size(s["held"]) > 0, F.array(turn(OBSERVATION, F.array_join(s["held"], RESULTS_BETWEEN)))).otherwise(none)
        more = F.struct(F.concat(s["out"], before, F.array(turn(x["role"], x["content"]))).alias("out"), held.alias("held"))
        return F.when(observed, F.struct(s["out"].alias("out"), F.concat(s["held"], F.array(F.coalesce(x["content"], F.lit("")))).alias("held"))).otherwise(more)

    return F.aggregate(messages, F.struct(none.alias("out"), held.alias("held")), step, lambda s: s["out"])


def system_with_note(system: Column, tools: Column) -> Column:
    """The system text with the note that switches thinking off where no tools are given and it says nothing of it; a line feed where tools follow."""
    system, tools = F.coalesce(system, F.lit("")), F.coalesce(tools, F.lit(""))
    says = F.contains(system, F.lit(_THINKING[0])) | F.contains(system, F.lit(_THINKING[1]))
    return (
        F.when((system == "") & (tools == ""), NO_THINKING)
        .when(system == "", system)
        .when(tools != "", F.concat(system, F.lit("\n")))
        .when(says, system)
        .otherwise(F.concat(system, F.lit("\n" + NO_THINKING)))
    )


def from_chat(df: DataFrame, m: Mapping = OPENAI) -> DataFrame:
    """Messages with roles as such in the second pipeline: calls become a function turn, results of calls one turn, roles take turns.

    A message of the assistant's side with calls has their JSON for content and the function role. Unknown roles, a wrong
    order and an odd number of turns (even for ranked records) break the record. A null list is an empty one, which breaks it too.
    """
    m.check(df, "messages")
    said, system = _peeled(df, m)
    fields = [f.name for f in df.schema[m.messages].dataType.elementType.fields]
    role = lambda x: F.coalesce(_mapped(x[m.role], m), F.lit("unknown"))
    own = lambda x: turn(role(x), x[m.content])
    if "tool_calls" not in fields:
        rows = df.withColumns({"__said": F.transform(said, own), "__system": system})
    else:
        rows = df.withColumns({"__said": said, "__system": system}).withColumn("__calls", calls_texts(F.transform("__said", lambda x: F.transform(x["tool_calls"], lambda c: c["function"]))))
        called = lambda x, i: role(x).isin(ASSISTANT, FUNCTION) & F.get("__calls", i).isNotNull()
        rows = rows.withColumn("__said", F.transform("__said", lambda x, i: F.when(called(x, i), turn(FUNCTION, F.get("__calls", i))).otherwise(own(x)))).drop("__calls")
    known = F.forall("__said", lambda x: x["role"] != "unknown")
    # a generated column is computed once: filters on it aren't pushed into what makes it
    rows = rows.withColumn("__good", known).withColumn("__merged", F.explode(F.array(merged_tool_results(F.col("__said"))))).drop("__said").withColumnRenamed("__merged", "__said")
    n = F.size("__said")
    fits = lambda x, i: F.when(i % 2 == 0, x["role"].isin(USER, OBSERVATION)).otherwise(x["role"].isin(ASSISTANT, FUNCTION))
    good = F.col("__good") & F.forall(F.transform("__said", fits), lambda ok: ok) & (n % 2 == (1 if m.ranking else 0)) & (n > 0)
    prompt, response = F.slice("__said", F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice("__said", F.greatest(n, F.lit(1)), F.lit(1))
    if m.ranking:
        response, ok = _chosen_pair(df, m)
        prompt, good = F.col("__said"), good & ok
    return _finish(rows, m, prompt, response, system_with_note(F.col("__system"), _col(df, m.tools)), F.coalesce(good, F.lit(False)))


CONVERTERS: dict[str, Callable[..., DataFrame]] = {"alpaca": from_alpaca, "sharegpt": from_sharegpt, "tagged": from_tagged, "periodic": from_periodic, "openai": from_openai, "chat": from_chat}


def register_converter(name: str, converter: Callable[..., DataFrame]) -> None:
    if name in CONVERTERS:
        raise ValueError(f"converter {name!r} exists")
    CONVERTERS[name] = converter


def aligned(df: DataFrame, layout: str, m: Mapping | None = None) -> DataFrame:
    """``df`` converted by its layout, without the records that broke its rules."""
    if layout not in CONVERTERS:
        raise KeyError(f"unknown layout {layout!r}")
    out = CONVERTERS[layout](df) if m is None else CONVERTERS[layout](df, m)
    return out.where((F.size("prompt") > 0) & (F.size("response") > 0))


def valid_pair(prompt: str = "prompt", response: str = "response") -> Column:
    """An odd number of prompt turns and one answer."""
    return F.coalesce((F.size(prompt) % 2 == 1) & (F.size(response) == 1), F.lit(False))


def dialogue(prompt: str = "prompt", response: str = "response") -> Column:
    """Prompt and response as one list of turns; an invalid pair is replaced by an empty question and answer."""
    empty = F.array(turn(USER, F.lit("")), turn(ASSISTANT, F.lit("")))
    bare = lambda c: F.transform(F.col(c), lambda x: turn(x["role"], F.coalesce(x["content"], F.lit(""))))
    return F.when(valid_pair(prompt, response), F.concat(bare(prompt), bare(response))).otherwise(empty)


def flattened_text(messages: Column, content: str = "content") -> Column:
    """The contents behind one another; a null content is an error."""
    whole = F.array_join(F.transform(messages, lambda x: x[content]), "")
    return F.when(F.exists(messages, lambda x: x[content].isNull()), F.raise_error(F.lit("a message has no content"))).otherwise(whole)


def recent_turns(messages: Column) -> Column:
    """The turns from the last one of the user on."""
    at = F.array_max(F.transform(messages, lambda x, i: F.when(x["role"] == USER, i).otherwise(-1)))
    return F.filter(messages, lambda x, i: i >= at)


def split_marked(c: Column, human: str = "Human:", assistant: str = "Assistant:") -> Column:
    """Turns of a text in which markers stand before what each side says; empty parts are left out."""
    from corpusloom.functions.text import strip

    parts = F.filter(F.split(c, human), lambda p: F.length(p) > 0)
    both = lambda p: F.array(turn(USER, strip(F.get(F.split(p, assistant), F.lit(0)))), turn(ASSISTANT, strip(F.get(F.split(p, assistant), F.lit(1)))))
    one = lambda p: F.array(turn(ASSISTANT, strip(p)))
    return F.flatten(F.transform(parts, lambda p: F.when(F.contains(p, F.lit(assistant)), both(p)).otherwise(one(p))))
