"""Records turned into token columns: one Arrow-batched function per handler, found by name.

A handler takes the row's fields and gives one token row or several; ``tokenized`` runs it over a DataFrame. Token rows have
``input_ids`` and, where the handler makes them, ``attention_mask`` and ``labels``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.tokenizers import ByteTokenizer, Tokenizer
from corpusloom.operators import markup_template
from corpusloom.operators import templates as T

IGNORE = -100
#: Name of the template with its own markup of calls.
MARKUP = "deepseek4"
#: Ids that open the turns of the two sides in one of the chat layouts (fixed values).
MOSS_USER, MOSS_ASSISTANT = 195, 196


@dataclass(frozen=True)
class Options:
    tokenizer: Tokenizer = field(default_factory=ByteTokenizer)
    template: str = "bytes"
    cutoff: int = 4096
    append_eod: bool = False
    train_on_inputs: bool = False
    mask_history: bool = False
    neat_pack: bool = False
    pad_to_multiple: int = 1
    drop_invalid: bool = False
    text_key: str = "text"
    labels_from_answer: bool = False
    split: Callable[[str], list[str]] | None = None


Row = dict
Tokens = dict[str, list[int]]


def _turns(messages) -> list[tuple[str, str]]:
    return [(m["role"], m["content"] or "") for m in (messages if messages is not None else [])]


def _dialogue(row: Row, o: Options) -> list[tuple[str, str]] | None:
    """Turns of a valid pair; of an invalid one an empty exchange, or nothing where such rows are dropped."""
    prompt, response = _turns(row.get("prompt")), _turns(row.get("response"))
    if len(prompt) % 2 == 1 and len(response) == 1:
        return prompt + response
    return None if o.drop_invalid else [(T.USER, ""), (T.ASSISTANT, "")]


def _pairs(row: Row, turns: list[tuple[str, str]], o: Options, cutoff: int = 1_000_000) -> tuple[bool, list[tuple[list[int], list[int]]]]:
    """Whether the template's end mark is implied, and the exchanges' ids; one template works on whole messages."""
    if o.template == MARKUP:
        valid = len(row.get("prompt") or []) % 2 == 1 and len(row.get("response") or []) == 1
        messages = [*row["prompt"], *row["response"]] if valid else [{"role": r, "content": c} for r, c in turns]
        return False, markup_template.encoded_pairs(messages, row.get("system"), row.get("tools"), o.tokenizer, cutoff)
    t = T.template(o.template)
    return t.efficient_eos, T.encoded_pairs(t, turns, row.get("system"), row.get("tools"), o.tokenizer, cutoff)


def _end(out: Tokens, o: Options) -> Tokens:
    if o.append_eod:
        for k, v in out.items():
            v.append(1 if k == "attention_mask" else o.tokenizer.eod)
    return out


def _plain(text: str, o: Options, pad: bool = True) -> list[Tokens]:
    parts = [p for p in (o.split(text) if o.split else [text]) if p]
    rows = [{"input_ids": o.tokenizer.encode(p)} for p in parts]
    if rows:
        last = rows[-1]["input_ids"]
        if pad and o.pad_to_multiple > 1:
            n = (len(last) // o.pad_to_multiple + 1) * o.pad_to_multiple - len(last) - (1 if o.append_eod else 0)
            last += [o.tokenizer.size] * n
        if o.append_eod:
            last.append(o.tokenizer.eod)
    return rows


def general_pretrain(row: Row, o: Options) -> list[Tokens]:
    """A text's tokens, sentence by sentence if there is a splitter; the last one padded and ended."""
    return _plain(row.get(o.text_key) or "", o)


def alpaca_pretrain(row: Row, o: Options) -> list[Tokens]:
    """Instruction, input and output in one long fixed form; without an input the word None stands in its place."""
    given = f" Input:\n{row['input']}" if row.get("input") else None
    head = "A chat between a curious user and an artificial intelligence assistant. The assistant gives helpful, detailed, and polite answers to the user's questions."
    text = f"{head}USER: Below is an instruction that describes a task. Write a response that appropriately completes the request.\n\n### Instruction:\n{row.get('instruction')}\n\n###{given}\n\n### Response: ASSISTANT: {row.get('output')}"
    return _plain(text, o, pad=False)


def sharegpt_pretrain(row: Row, o: Options) -> list[Tokens]:
    """The contents of all messages behind one another; one without content is an error."""
    said = []
    for m in row.get("messages") or []:
        value = m.get("value") if m.get("value") is not None else m.get("content")
        if value is None:
            raise ValueError("a message has neither value nor content")
        said.append(value)
    return _plain("".join(said), o, pad=False)


def forum_pretrain(row: Row, o: Options) -> list[Tokens]:
    """Title, question and answer of a forum thread, under the fixed headings."""
    return _plain(f"In python, {row.get('title')}\n### Question:\n{row.get('question_body')}\n### Response:\n{row.get('answer_body')}\n", o)


def instruction(row: Row, o: Options) -> list[Tokens]:
    """A dialogue with labels on the answers; later prompts of a template whose end mark is implied train on that mark."""
    turns = _dialogue(row, o)
    if turns is None:
        return []
    implied, pairs = _pairs(row, turns, o, o.cutoff)
    ids, labels = [], []
    for source, target in pairs:
        if o.train_on_inputs:
            mask = list(source)
        elif ids and implied:
            mask = [o.tokenizer.eos] + [IGNORE] * (len(source) - 1)
        else:
            mask = [IGNORE] * len(source)
        if o.neat_pack:
            a, b = T.inferred_lengths(len(source), len(target), o.cutoff - 1)
            source, mask, target = source[:a], mask[:a], target[:b]
        ids += source + target
        labels += mask + target
    if implied:
        ids.append(o.tokenizer.eos)
        labels.append(o.tokenizer.eos)
    return [_end({"input_ids": ids, "attention_mask": [1] * len(ids), "labels": labels}, o)]


def processed_sft(row: Row, o: Options) -> list[Tokens]:
    """The second pipeline's dialogue: invalid rows are dropped, lengths are cut after rendering, history may be masked.

    With masked history the last turns come first to the room, and only the last answer trains.
    """
    prompt, response = _turns(row.get("prompt")), _turns(row.get("response"))
    if len(prompt) % 2 != 1 or len(response) != 1:
        return []
    implied, pairs = _pairs(row, prompt + response, o)
    pairs = pairs[::-1] if o.mask_history else pairs
    ids: list[int] = []
    labels: list[int] = []
    used = 1 if implied else 0
    for k, (source, target) in enumerate(pairs):
        if used >= o.cutoff:
            break
        a, b = T.inferred_lengths(len(source), len(target), o.cutoff - used)
        source, target = source[:a], target[:b]
        used += a + b
        if o.train_on_inputs:
            mask = list(source)
        elif implied and k:
            mask = [o.tokenizer.eos] + [IGNORE] * (a - 1)
        else:
            mask = [IGNORE] * a
        answer = [IGNORE] * b if o.mask_history and k else list(target)
        if o.mask_history:
            ids, labels = source + target + ids, mask + answer + labels
        else:
            ids, labels = ids + source + target, labels + mask + answer
    if implied:
        ids.append(o.tokenizer.eos)
        labels.append(o.tokenizer.eos)
    return [{"input_ids": ids, "attention_mask": [1] * len(ids), "labels": labels}]


def marked_instruction(row: Row, o: Options) -> list[Tokens]:
    """Labels from the k-th answer's opening mark to the k-th end mark, cut to the length."""
    turns = _turns(row.get("prompt")) + _turns(row.get("response"))
    pieces = [p for part in T.elements(T.template(o.template), turns, row.get("system"), row.get("tools")) for p in part]
    ids = T.ids_of(pieces, o.tokenizer)
    begin, end = o.tokenizer.token("assistant"), o.tokenizer.eos
    labels = [IGNORE] * len(ids)
    for a, b in zip([i for i, x in enumerate(ids) if x == begin], [i for i, x in enumerate(ids) if x == end], strict=False):
        labels[a : b + 1] = ids[a : b + 1]
    ids, labels = ids[: o.cutoff], labels[: o.cutoff]
    return [_end({"input_ids": ids, "attention_mask": [int(i != o.tokenizer.pad) for i in ids], "labels": labels}, o)]


def pairwise(row: Row, o: Options) -> list[Tokens]:
    """A prompt with a chosen and a rejected answer, each with its labels."""
    prompt, both, t = _turns(row.get("prompt")), _turns(row.get("response")), T.template(o.template)
    if len(both) < 2:
        return []
    out: Tokens = {}
    for name, answer in zip(("chosen", "rejected"), both, strict=False):
        before, said = T.encoded_last(t, [*prompt, answer], row.get("system"), row.get("tools"), o.tokenizer)
        said = said + ([o.tokenizer.eos] if t.efficient_eos else [])
        out[f"{name}_input_ids"], out[f"{name}_labels"] = before + said, [IGNORE] * len(before) + said
    return [out]


def prompt_only(row: Row, o: Options) -> list[Tokens]:
    """The prompts' tokens of every turn, no answers."""
    turns = _dialogue(row, o)
    if turns is None:
        return []
    ids = [i for a, _ in _pairs(row, turns, o, o.cutoff)[1] for i in a]
    return [{"input_ids": ids, "attention_mask": [1] * len(ids)}]


def all_but_last_answer(row: Row, o: Options) -> list[Tokens]:
    """Everything but the last answer; that answer's tokens as labels if asked for."""
    turns = _dialogue(row, o)
    if turns is None:
        return []
    pairs = _pairs(row, turns, o, o.cutoff)[1]
    ids = [i for k, (a, b) in enumerate(pairs) for i in (a if k == len(pairs) - 1 else a + b)]
    out = {"input_ids": ids, "attention_mask": [1] * len(ids)}
    if o.labels_from_answer:
        answers = _turns(row.get("response"))
        out["labels"] = o.tokenizer.encode(answers[-1][1]) if answers else []
    return [out]


def _prompted(turns: list[tuple[str, str]], o: Options) -> Tokens:
    p = T.AlpacaPrompter()
    whole = p.prompt(turns)
    out = {"input_ids": o.tokenizer.encode(whole)}
    out["attention_mask"], out["labels"] = [1] * len(out["input_ids"]), list(out["input_ids"])
    out = _end(out, o)
    if not o.train_on_inputs:
        n = len(o.tokenizer.encode(p.question(whole)))
        out["labels"][:n] = [IGNORE] * n
    return out


def general_instruction(row: Row, o: Options) -> list[Tokens]:
    """Instruction and input as the question, output as the answer, under the plain prompt."""
    return [_prompted([(T.USER, f"{row.get('instruction') or ''}\n{row.get('input') or ''}"), (T.ASSISTANT, row.get("output") or "")], o)]


def marked_turns(row: Row, o: Options) -> list[Tokens]:
    """A dialogue written with ``Human:`` and ``Assistant:`` marks; its last answer is the output."""
    turns: list[tuple[str, str]] = []
    for part in (row.get("instruction") or "").split("Human:"):
        if part:
            asked, *said = part.split("Assistant:")
            turns += [(T.USER, asked.strip()), (T.ASSISTANT, said[0].strip())] if said else [(T.ASSISTANT, asked.strip())]
    return [_prompted([*turns[:-1], (T.ASSISTANT, (row.get("output") or "").strip())], o)]


def _moss(row: Row) -> list[tuple[str, str]]:
    out = []
    for turn in row.get("chat") or []:
        if turn:
            out.append((turn["Human"].replace("<eoh>", "").replace("<|Human|>: ", "").strip(), turn["MOSS"].replace("<|MOSS|>:", "").replace("<eom>", "").strip()))
    return out


def role_id_turns(row: Row, o: Options) -> list[Tokens]:
    """Turns opened by fixed role ids; the user's mark trains as an end token."""
    ids, labels = [], []
    for asked, said in _moss(row):
        a, b = o.tokenizer.encode(asked), o.tokenizer.encode(said)
        ids += [MOSS_USER, *a, MOSS_ASSISTANT, *b]
        labels += [o.tokenizer.eos, *[IGNORE] * (len(a) + 1), *b]
    ids.append(o.tokenizer.eos)
    labels.append(o.tokenizer.eos)
    return [{"input_ids": ids, "attention_mask": [1] * len(ids), "labels": labels}]


def every_prefix(row: Row, o: Options) -> list[Tokens]:
    """One token row for each prefix of the dialogue that ends with an answer."""
    turns, out = [], []
    for asked, said in _moss(row):
        turns += [(T.USER, asked), (T.ASSISTANT, said)]
        out.append(_prompted(turns, Options(tokenizer=o.tokenizer, train_on_inputs=o.train_on_inputs)))
    return out


def code_instruction(row: Row, o: Options) -> list[Tokens]:
    """A programming problem without its code as the question; code and explanation as the answer."""
    asked = (row.get("code_with_problem") or "").split("```", 1)[0].strip()
    return [_prompted([(T.USER, asked), (T.ASSISTANT, f"{row.get('code_only') or ''}\n{row.get('explanation_only') or ''}")], o)]


HANDLERS: dict[str, Callable[[Row, Options], list[Tokens]]] = {
    f.__name__: f
    for f in (general_pretrain, alpaca_pretrain, sharegpt_pretrain, forum_pretrain, instruction, processed_sft, marked_instruction, pairwise, prompt_only, all_but_last_answer, general_instruction, marked_turns, role_id_turns, every_prefix, code_instruction)
}


def handler(name: str) -> Callable[[Row, Options], list[Tokens]]:
    """The handler of a name; unknown names fall back to the plain text handler."""
    return HANDLERS.get(name, general_pretrain)


_FIELDS = {"pairwise": ("chosen_input_ids", "chosen_labels", "rejected_input_ids", "rejected_labels"), "prompt_only": ("input_ids", "attention_mask")} | dict.fromkeys(("general_pretrain", "alpaca_pretrain", "sharegpt_pretrain", "forum_pretrain"), ("input_ids",))


def tokenized(df: DataFrame, name: str, row_id: str, options: Options = Options()) -> DataFrame:  # noqa: B008
    """(row_id, seq, token columns): the rows of a handler, in order of ``seq`` for each row of ``df``."""
    make, fields = handler(name), _FIELDS.get(name, ("input_ids", "attention_mask", "labels"))
    if name == "all_but_last_answer" and not options.labels_from_answer:
        fields = ("input_ids", "attention_mask")
    kind = df.schema[row_id].dataType.simpleString()

    key = df.schema[row_id].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(key), pa.int32(), *[pa.list_(pa.int32()) for _ in fields]]
        for b in batches:
            out: list[list] = [[] for _ in types]
            for row in b.to_pylist():
                for k, tokens in enumerate(make(row, options)):
                    for column, value in zip(out, (row[row_id], k, *(tokens.get(f, []) for f in fields)), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=[row_id, "seq", *fields])

    return df.mapInArrow(run, f"`{row_id}` {kind}, seq int, " + ", ".join(f"{f} array<int>" for f in fields))


def without_long(df: DataFrame, keys: list[str], length: int, inclusive: bool = True) -> DataFrame:
    """Without the sequences of which any key has ``length`` tokens or more (more than ``length`` if not ``inclusive``)."""
    longest = F.greatest(*[F.size(k) for k in keys], F.lit(0))
    return df.where(longest < length if inclusive else longest <= length)


def pretrain_rows(df: DataFrame, row_id: str, text: str, cutoff: int, tokenizer: Tokenizer | None = None, add_bos: bool = False) -> DataFrame:
    """(row_id, input_ids): every text with its end token, cut to ``cutoff`` tokens; with ``add_bos`` behind a begin token, which counts."""
    t = tokenizer or ByteTokenizer()
    kind = df.schema[row_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = [t.bos] if add_bos and t.bos is not None else []
        for b in batches:
            ids = [(head + t.encode(x or "") + [t.eos])[:cutoff] for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=[row_id, "input_ids"])

    return df.select(row_id, text).mapInArrow(run, f"`{row_id}` {kind}, input_ids array<int>")


def pretrain_blocks(df: DataFrame, row_id: str, text: str, cutoff: int, batch: int = 1000, tokenizer: Tokenizer | None = None, add_bos: bool = False) -> DataFrame:
    """(batch, block, input_ids): the texts of every ``batch`` rows, in order of ``row_id``, with end tokens behind one another and cut into blocks.

    What doesn't fill a block is dropped, batch by batch. With ``add_bos`` the begin token takes the place of each block's first one. A batch is of a
    bounded number of rows and is put together in one task.
    """
    from corpusloom.operators.ordinals import with_prefix

    t = tokenizer or ByteTokenizer()
    rows = pretrain_rows(df, row_id, text, 1 << 31, tokenizer)
    numbered = with_prefix(rows, [row_id], name="_o").withColumn("batch", F.floor(F.col("_o") / batch))

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("_o")
        flat = group.column("input_ids").combine_chunks().flatten().to_numpy()
        n = len(flat) // cutoff
        cut = flat[: n * cutoff].reshape(n, cutoff).copy()
        if add_bos and n:
            cut[:, 0] = t.bos
        return pa.table({"batch": pa.array([group.column("batch")[0].as_py()] * n, pa.int64()), "block": pa.array(range(n), pa.int32()), "input_ids": pa.array(list(cut), pa.list_(pa.int32()))})

    return numbered.select("batch", "_o", "input_ids").groupBy("batch").applyInArrow(run, "batch bigint, block int, input_ids array<int>")


def skipped(df: DataFrame, keys: list[str], length: int) -> DataFrame:
    """(sequences, skipped): how many there are and how many ``without_long`` leaves out."""
    return df.agg(F.count("*").alias("sequences"), F.count_if(F.greatest(*[F.size(k) for k in keys], F.lit(0)) >= length).alias("skipped"))
