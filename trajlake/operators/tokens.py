"""Token counts of converted conversations with a pluggable tokenizer, and checks of what is trained on.

encoder is a function without arguments that gives an encode function (text to list of ids); it is called
once per task, so large vocabularies load there. A message is rendered by a template with {role} and
{content}; by default role and content between markers, as most chat templates have it.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TEMPLATE = "<|{role}|>\n{content}<|end|>\n"


def count_tokens(rows: DataFrame, key: str, encoder: Callable[[], Callable[[str], list[int]]], template: str = TEMPLATE) -> DataFrame:
    """key, input_tokens and supervised_tokens of rows with converted messages (role, content, loss) in `messages`.

    Supervised are the tokens of messages with loss; null messages count nothing.
    """

    def run(batches):
        encode = encoder()
        for batch in batches:
            total, trained = [], []
            for messages in batch.column("messages").to_pylist():
                sizes = [(len(encode(template.format(role=m["role"], content=m["content"]))), bool(m["loss"])) for m in messages or ()]
                total.append(sum(n for n, _ in sizes))
                trained.append(sum(n for n, loss in sizes if loss))
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(total, pa.int64()), pa.array(trained, pa.int64())], [key, "input_tokens", "supervised_tokens"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, "messages").mapInArrow(run, f"`{key}` {kind}, input_tokens bigint, supervised_tokens bigint")


def supervised_ratio() -> Column:
    """Share of supervised tokens, to six places, half-even; 0 without tokens."""
    return F.bround(F.coalesce(F.try_divide(F.col("supervised_tokens").cast("double"), F.col("input_tokens")), F.lit(0.0)), 6)


def training_problems(rows: DataFrame) -> DataFrame:
    """rows with problems: what is wrong with a training row's tools and supervision, empty if nothing.

    rows: tools (JSON text) and messages (role, content, loss).
    """
    m = F.col("messages")
    names = F.transform(F.from_json("tools", "array<struct<function:struct<name:string>>>"), lambda t: t["function"]["name"])
    some = lambda test: F.exists(m, test)
    trained = lambda x: F.coalesce(x["loss"], F.lit(False))
    checks = [
        (~F.coalesce(names == F.array(*map(F.lit, ("bash", "read", "write", "edit"))), F.lit(False)), "tools_contract"),
        (some(lambda x: (x["role"] == "tool_call") & ~trained(x)), "tool_call_not_supervised"),
        (some(lambda x: (x["role"] == "tool_response") & trained(x)), "tool_response_supervised"),
        (some(lambda x: x["role"].isin("system", "user") & trained(x)), "prompt_supervised"),
        (~some(trained), "nothing_supervised"),
        (some(lambda x: (x["role"] == "assistant") & x["content"].contains("<think>") & ~x["content"].contains("</think>")), "open_thinking"),
    ]
    return rows.withColumn("problems", F.array_compact(F.array(*(F.when(c, F.lit(n)) for c, n in checks))))


# --- whole rows as ids and labels ------------------------------------------------------------------

#: Label of a token that isn't trained on.
IGNORED = -100
# Fixed value: the pattern that splits text before the merges of byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class RankFile:
    """A public byte-level tokenizer in a rank file (base64 token and rank a line): encode and decode, loaded once a task."""

    def __init__(self, path: str, pattern: str = PATTERN):
        self.path, self.pattern = path, pattern

    def __call__(self):
        import base64

        import tiktoken

        with open(self.path, "rb") as lines:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
        return tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def chat_parts(tools: str | None, messages: list[dict]) -> list[tuple[str, bool]]:
    """A row as (text, trained on) in the usual chat markup: the tool contract follows the system text,
    calls and responses stand between their own marks, and only what has loss is trained on."""
    parts: list[tuple[str, bool]] = []
    contract = f"\n\n<tools>\n{tools}\n</tools>" if tools else ""
    if contract and not (messages and messages[0]["role"] == "system"):
        parts.append((f"<|im_start|>system{contract}<|im_end|>\n", False))
        contract = ""
    for m in messages:
        role, content, loss = m["role"], m["content"], bool(m["loss"])
        if role == "system":
            parts.append((f"<|im_start|>system\n{content}{contract}<|im_end|>\n", False))
            contract = ""
        elif role == "tool_response":
            parts.append((f"<|im_start|>user\n<tool_response>\n{content}\n</tool_response><|im_end|>\n", loss))
        elif role in ("assistant", "tool_call"):
            text = f"<tool_call>\n{content}\n</tool_call>" if role == "tool_call" else content
            parts += [("<|im_start|>assistant\n", False), (f"{text}<|im_end|>\n", loss)]
        else:
            parts.append((f"<|im_start|>{role}\n{content}<|im_end|>\n", loss))
    return parts


ENCODED = "ids array<int>, labels array<int>, problems array<string>"


def encode_rows(rows: DataFrame, keep: list[str], encoder: Callable[[], Callable[[str], list[int]]], parts=chat_parts) -> DataFrame:
    """keep, ids, labels (IGNORED where not trained on) and problems of rows with tools and messages.

    problems looks at the rendered text and at the part of it that is trained on: markers of calls,
    responses and thinking, the contract before the first user turn, and something to train on.
    Null messages are a row without any.
    """
    names = ("bash", "read", "write", "edit")

    def checks(text: str, trained: str, labels: list[int]) -> list[str]:
        prefix = text.split("<|im_start|>user", 1)[0]
        found = [
            ("<tool_call>" not in text or "<tool_response>" not in text or not ("<think>" in text and "</think>" in text), "markers_missing"),
            ("<tool_call>" not in trained, "tool_call_not_supervised"),
            ("<tool_response>" in trained, "tool_response_supervised"),
            (all(x == IGNORED for x in labels), "nothing_supervised"),
            ("<tools>" not in prefix or not all(n in prefix for n in names), "tools_not_in_system"),
        ]
        return [name for wrong, name in found if wrong]

    def run(batches):
        encode = encoder()
        for batch in batches:
            ids, labels, problems = [], [], []
            for tools, messages in zip(batch.column("tools").to_pylist(), batch.column("messages").to_pylist()):
                rendered = parts(tools, messages or [])
                encoded = [(encode(text), loss) for text, loss in rendered]
                ids.append([i for part, _ in encoded for i in part])
                labels.append([i if loss else IGNORED for part, loss in encoded for i in part])
                problems.append(checks("".join(t for t, _ in rendered), "".join(t for t, loss in rendered if loss), labels[-1]))
            columns = [*(batch.column(c) for c in keep), pa.array(ids, pa.list_(pa.int32())), pa.array(labels, pa.list_(pa.int32())), pa.array(problems, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "ids", "labels", "problems"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.select(*keep, "tools", "messages").mapInArrow(run, f"{kinds}, {ENCODED}" if keep else ENCODED)


def token_totals(encoded: DataFrame) -> DataFrame:
    """encoded with input_tokens and supervised_tokens instead of ids and labels."""
    trained = F.size(F.filter("labels", lambda x: x != IGNORED)).cast("bigint")
    return encoded.withColumns({"input_tokens": F.size("ids").cast("bigint"), "supervised_tokens": trained}).drop("ids", "labels")
