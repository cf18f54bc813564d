"""Conversion of tool-using conversations into flat training messages.

One projection with higher-order functions: output messages, statistics and the first error of a record
come from the record's own row, so nothing is shuffled. Positions decide which error is first: checks of
a message come before those of its calls, those of an earlier message before those of a later one, and
checks of the whole record last. Id look-ups within a record are quadratic in its number of calls, which
suits conversations of up to a few thousand calls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajlake.functions import calls as C

# Names of the error kinds.
CONTENT, ROLE, CALL_LIST, CALL_FUNCTION, CALL_NAME = "content must be a string", "unsupported role", "assistant tool_calls must be a list", "tool call must contain a function object", "tool call function.name must be a non-empty string"
ARGUMENTS_JSON, ARGUMENTS_OBJECT, TWICE_CALLED = "invalid tool arguments JSON", "tool arguments must be a JSON object", "duplicate tool call id"
UNKNOWN, TWICE_ANSWERED, UNANSWERED, NOTHING = "unknown call id", "duplicate tool response", "unanswered tool calls", "no trainable assistant output"
END = 2**31 - 1
OUT = "array<struct<role:string,content:string,loss:boolean>>"


def _error(message: Column, call: Column, order: int, condition: Column, name: str) -> Column:
    where = F.struct(message.cast("int").alias("message"), call.cast("int").alias("call"), F.lit(order).alias("check"), F.lit(name).alias("error"))
    return F.when(F.coalesce(condition, F.lit(False)), where)


def _said(m: Column) -> Column:
    """An assistant's content, trimmed, with its reasoning in front."""
    thought = C.stripped(C.text(m["reasoning_content"]))
    content = C.stripped(C.text(m["content"]))
    return F.when(thought != "", F.concat(F.lit("<think>\n"), thought, F.lit("\n</think>\n\n"), content)).otherwise(content)


def _call_text(c: Column) -> Column:
    """{"name":..., "arguments":...} without blanks; keys of the arguments are sorted."""
    arguments = F.coalesce(C.json_value(c["arguments"]), F.parse_json(F.lit("{}")))
    return F.to_json(F.struct(c["name"].alias("name"), arguments.alias("arguments")))


def _line(role: Column | str, content: Column, loss: bool | None) -> Column:
    return F.struct((F.lit(role) if isinstance(role, str) else role).alias("role"), content.alias("content"), F.lit(loss).cast("boolean").alias("loss"))


def _converted(m: Column, i: Column, calls: Column) -> Column:
    spoken = F.filter(F.array(_line("assistant", _said(m), True)), lambda x: x["content"] != "")
    called = F.transform(F.filter(calls, lambda c: c["message"] == i), lambda c: _line("tool_call", _call_text(c), True))
    return (
        F.when(m["role"].isin("system", "user"), F.array(_line(m["role"], m["content"], None)))
        .when(m["role"] == "assistant", F.concat(spoken, called))
        .when(m["role"] == "tool", F.array(_line("tool_response", m["content"], None)))
        .otherwise(F.array().cast(OUT))
    )


def _errors(messages: Column, calls: Column, reasoning_type: bool) -> Column:
    """All error candidates; each is right if nothing before it failed."""
    none = F.lit(-1)

    def of_message(m, i):
        wrong_reasoning = F.lit(False)
        if reasoning_type:
            wrong_reasoning = (m["role"] == "assistant") & ~F.coalesce(m["reasoning_type"].isin("string", "null", "missing"), F.lit(True))
        return F.array(
            _error(i, none, 0, m["content"].isNull(), CONTENT),
            _error(i, none, 1, ~F.coalesce(m["role"].isin("system", "user", "assistant", "tool"), F.lit(False)), ROLE),
            _error(i, none, 2, wrong_reasoning, CONTENT),
            _error(i, none, 3, C.no_call_list(m), CALL_LIST),
        )

    def of_call(c, k):
        earlier = F.slice(calls, F.lit(1), k)
        return C.let(
            C.json_value(c["arguments"]),
            lambda arguments: F.array(
                _error(c["message"], c["call"], 4, ~c["has_function"], CALL_FUNCTION),
                _error(c["message"], c["call"], 5, ~c["has_name"], CALL_NAME),
                _error(c["message"], c["call"], 6, c["arguments"].isNotNull() & arguments.isNull(), ARGUMENTS_JSON),
                _error(c["message"], c["call"], 7, c["null_arguments"] | ~F.schema_of_variant(arguments).startswith("OBJECT"), ARGUMENTS_OBJECT),
                _error(c["message"], c["call"], 8, c["id"].isNotNull() & F.exists(earlier, lambda e: e["id"] == c["id"]), TWICE_CALLED),
            ),
        )

    numbered = F.transform(messages, lambda m, i: F.struct(i.alias("at"), m["role"].alias("role"), m["tool_call_id"].alias("id")))
    responses = F.filter(numbered, lambda m: m["role"] == "tool")

    def of_response(r, k):
        known = F.exists(calls, lambda c: (c["id"] == r["id"]) & (c["message"] < r["at"]))
        before = F.slice(responses, F.lit(1), k)
        return F.array(
            _error(r["at"], none, 9, ~F.coalesce(known, F.lit(False)), UNKNOWN),
            _error(r["at"], none, 10, F.exists(before, lambda b: b["id"] == r["id"]), TWICE_ANSWERED),
        )

    ids = F.transform(F.filter(calls, lambda c: c["id"].isNotNull()), lambda c: c["id"])
    answered = F.transform(responses, lambda r: r["id"])
    spoke = F.exists(messages, lambda m: (m["role"] == "assistant") & (_said(m) != ""))
    at_end = F.array(
        _error(F.lit(END), none, 11, F.size(F.array_except(ids, answered)) > 0, UNANSWERED),
        _error(F.lit(END), none, 12, ~F.coalesce(spoke, F.lit(False)) & (F.size(calls) == 0), NOTHING),
    )
    return F.array_compact(F.concat(F.flatten(F.transform(messages, of_message)), F.flatten(F.transform(calls, of_call)), F.flatten(F.transform(responses, of_response)), at_end))


def convert(records: DataFrame, keep_calls: bool = False) -> DataFrame:
    """records with error (null if none), converted and conversion, its statistics (both null on error).

    Null messages convert like no messages: 'no trainable assistant output'. Where messages tell their
    reasoning_type, reasoning that is no string is an error like content that is none; tool_calls and
    reasoning that are null, false, zero or empty count as not given. Keys of arguments are sorted.
    keep_calls adds calls, the parsed tool calls.
    """
    kind = records.schema["messages"].dataType
    messages, reasoning_type = F.coalesce(F.col("messages"), F.array().cast(kind)), "reasoning_type" in kind.elementType.names
    rows = records.withColumn("messages", messages).withColumn("calls", C.tool_calls(F.col("messages")))
    rows = rows.withColumn("error", F.array_min(_errors(F.col("messages"), F.col("calls"), reasoning_type))["error"])
    lines = F.flatten(F.transform(F.col("messages"), lambda m, i: _converted(m, i, F.col("calls"))))
    rows = rows.withColumn("converted", F.when(F.col("error").isNull(), lines))
    count = lambda test: F.size(F.filter("converted", test))
    thinking = F.size(F.filter(C.of_role(F.col("messages"), "assistant"), lambda m: C.stripped(C.text(m["reasoning_content"])) != ""))
    conversion = F.struct(
        thinking.alias("reasoning_messages"),
        count(lambda x: x["role"] == "assistant").alias("assistant_content_messages"),
        count(lambda x: x["role"] == "tool_call").alias("tool_calls"),
        count(lambda x: x["role"] == "tool_response").alias("tool_responses"),
        F.size("converted").alias("output_messages"),
        C.total(F.transform("converted", lambda x: F.length(x["content"]))).alias("characters"),
    )
    rows = rows.withColumn("conversion", F.when(F.col("error").isNull(), conversion))
    return rows if keep_calls else rows.drop("calls")


def closed_round_trips(converted: DataFrame) -> DataFrame:
    """Records with at least one call and as many responses as calls."""
    return converted.filter((F.col("conversion.tool_calls") > 0) & (F.col("conversion.tool_calls") == F.col("conversion.tool_responses")))


# What the tool contract says of each tool and of its parameters.
TOOL_TEXTS = {
    "bash": "Execute a shell command in the current sandbox workspace.",
    "read": "Read text from a file in the sandbox workspace.",
    "write": "Create or overwrite a text file in the sandbox workspace.",
    "edit": "Edit a text file using either an edits array or one oldText/newText replacement.",
}
PARAMETERS = {
    "bash": {"command": ("string", "Shell command to execute."), "timeout": ("integer", "Optional timeout in seconds.", 1)},
    "read": {"path": ("string", "File path to read."), "offset": ("integer", "Optional zero-based line offset.", 0), "limit": ("integer", "Optional maximum number of lines to return.", 1)},
    "write": {"path": ("string", "File path to write."), "content": ("string", "Complete file content.")},
    "edit": {"path": ("string", "File path to edit."), "edits": ("array",), "oldText": ("string",), "newText": ("string",)},
}


def tool_schema() -> str:
    """The JSON text that tells the four canonical tools; a constant of every training row."""
    import json

    def shape(properties, required, **more):
        return {"type": "object", "properties": properties, "required": required} | more | {"additionalProperties": False}

    pair = {"oldText": {"type": "string"}, "newText": {"type": "string"}}

    def parameter(kind, text=None, least=None):
        extra = {"items": shape(pair, list(pair))} if kind == "array" else {}
        return {"type": kind} | ({} if text is None else {"description": text}) | ({} if least is None else {"minimum": least}) | extra

    tools = []
    for name in C.TOOLS:
        either = {"anyOf": [{"required": ["edits"]}, {"required": list(pair)}]} if name == "edit" else {}
        body = shape({k: parameter(*v) for k, v in PARAMETERS[name].items()}, list(C.REQUIRED[name]), **either)
        tools.append({"type": "function", "function": {"name": name, "description": TOOL_TEXTS[name], "parameters": body}})
    return json.dumps(tools, ensure_ascii=False, separators=(",", ":"))


def training_rows(converted: DataFrame, *keep: str) -> DataFrame:
    """keep, tools and messages of the records without error."""
    return converted.filter("error IS NULL").select(*keep, F.lit(tool_schema()).alias("tools"), F.col("converted").alias("messages"))
