"""Content audits of single records, and profiles of the messages of all records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajlake.functions import calls as C

#: Response lengths above which responses are counted.
RESPONSE_BOUNDS = (4096, 16384, 65536)


def latest_delivery(trajectories: DataFrame) -> DataFrame:
    """One row a record_id, the first that was ingested. Deliveries of a record are equal but for ingested_at."""
    rest = [c for c in trajectories.columns if c != "record_id"]
    rows = trajectories.groupBy("record_id").agg(F.min_by(F.struct(*rest), F.coalesce(F.col("ingested_at"), F.lit("9999-12-31").cast("timestamp_ntz"))).alias("r"))
    return rows.select("record_id", "r.*")


def record_metrics(messages: str | Column = "messages") -> dict[str, Column]:
    """The metrics of one record's messages, for withColumns after `calls` was added by with_calls.

    Null content counts as empty. Total characters are those of all contents and of the assistant's
    reasoning; arguments of calls count only for commands, paths and secrets.
    """
    m, calls = F.col(messages) if isinstance(messages, str) else messages, F.col("calls")
    length = lambda role: C.total(F.transform(C.of_role(m, role), lambda x: F.length(C.text(x["content"]))))
    assistant = C.of_role(m, "assistant")
    reasoning = F.transform(assistant, lambda x: C.text(x["reasoning_content"]))
    contents = F.transform(m, lambda x: C.text(x["content"]))
    arguments = F.transform(calls, lambda c: C.text(c["arguments"]))
    commands = F.transform(F.filter(calls, lambda c: c["name"] == "bash"), lambda c: C.text(c["arguments"]))
    responses = F.transform(C.of_role(m, "tool"), lambda x: C.text(x["content"]))
    sizes = F.transform(responses, lambda r: F.length(r))
    everything = F.concat(contents, reasoning, arguments)
    system = F.array_join(F.transform(C.of_role(m, "system"), lambda x: C.text(x["content"])), "\n")
    all_chars = C.total(F.transform(contents, lambda t: F.length(t))) + C.total(F.transform(reasoning, lambda t: F.length(t)))
    contract = F.lit(True)
    for tool in C.TOOLS:
        contract = contract & system.rlike(rf"(?i)\b{tool}\b")
    out = {
        "system_chars": length("system"),
        "system_fingerprint": F.sha2(system, 256),
        "system_tool_contract_present": contract,
        "total_chars": all_chars,
        "assistant_content_chars": length("assistant"),
        "reasoning_chars": C.total(F.transform(reasoning, lambda t: F.length(t))),
        "tool_response_chars": length("tool"),
        "tool_response_char_ratio": F.bround(F.coalesce(F.try_divide(length("tool").cast("double"), all_chars), F.lit(0.0)), 6),
        "tool_response_messages": F.size(responses),
        "tool_response_max_chars": F.coalesce(F.array_max(sizes), F.lit(0)),
    }
    for bound in RESPONSE_BOUNDS:
        out[f"tool_response_over_{bound}"] = C.count_where(sizes, lambda s, b=bound: s > b)
    return out | {
        "tool_error_messages": C.count_where(responses, lambda r: r.rlike(C.TOOL_ERROR)),
        "duplicate_tool_calls": C.repeats(C.signatures(calls)),
        "consecutive_duplicate_tool_calls": C.adjacent_repeats(C.signatures(calls)),
        "destructive_commands": C.count_where(commands, lambda a: a.rlike(C.DESTRUCTIVE)),
        "network_commands": C.count_where(commands, lambda a: a.rlike(C.NETWORK)),
        "nonportable_path_occurrences": C.total(F.transform(everything, lambda t: F.regexp_count(t, F.lit(C.LOCAL_PATH)))),
        "secret_pattern_hits": C.count_where(everything, C.has_secret),
        "final_assistant_chars": F.coalesce(F.length(C.text(F.try_element_at(assistant, F.lit(-1))["content"])), F.lit(0)),
    }


def is_list(column: str) -> Column:
    """Whether a text is a JSON array; null and text that isn't JSON are none."""
    return F.coalesce(F.schema_of_variant(F.try_parse_json(column)).startswith("ARRAY"), F.lit(False))


def with_calls(records: DataFrame) -> DataFrame:
    return records.withColumn("calls", C.tool_calls(F.col("messages")))


def audit(records: DataFrame) -> DataFrame:
    """records (with messages) and their metrics, without the message texts."""
    return with_calls(records).withColumns(record_metrics()).drop("messages", "calls")


def exploded_messages(records: DataFrame, *keep: str) -> DataFrame:
    return records.select(*keep, F.posexplode("messages").alias("position", "m")).select(*keep, "position", "m.*")


FIELDS = ("content", "reasoning_content", "tool_call_id", "tool_calls")


def message_fields(messages: Column) -> Column:
    """Of each message its role, which other fields it has, and the length of its content; no text."""
    return F.transform(messages, lambda m: F.struct(m["role"].alias("role"), *(m[f].isNotNull().alias(f) for f in FIELDS), F.length(m["content"]).alias("characters")))


def role_profile_of(rows: DataFrame) -> DataFrame:
    """Per role: messages, and how many have each of the other fields; rows have message_fields as `fields`."""
    each = rows.select(F.inline("fields"))
    return each.groupBy("role").agg(F.count(F.lit(1)).alias("messages"), *(F.count_if(f).alias(f"with_{f}") for f in FIELDS), F.coalesce(F.sum("characters"), F.lit(0)).alias("characters"))


def role_profile(records: DataFrame) -> DataFrame:
    return role_profile_of(records.select(message_fields(F.col("messages")).alias("fields")))


def keys_used(messages: str = "messages") -> Column:
    """Name and argument keys of each call; keys of arguments that are no object are one null."""
    keys = lambda c: F.coalesce(F.json_object_keys(c["arguments"]), F.array(F.lit(None).cast("string")))
    return F.transform(C.tool_calls(F.col(messages)), lambda c: F.struct(c["name"].alias("name"), keys(c).alias("keys")))


def argument_keys_of(rows: DataFrame) -> DataFrame:
    """How often each tool is called with each argument key; rows have keys_used as `used`."""
    return rows.select(F.inline("used")).select("name", F.explode_outer("keys").alias("key")).groupBy("name", "key").agg(F.count(F.lit(1)).alias("calls"))


def argument_keys(records: DataFrame) -> DataFrame:
    return argument_keys_of(records.select(keys_used().alias("used")))


def round_trips(records: DataFrame, *key: str) -> DataFrame:
    """Per record: calls, responses, responses to no earlier call of the record, second responses, calls never answered.

    A response answers the call whose id it names if that call stands in an earlier message. Calls
    without id can't be answered by id and aren't counted as unanswered.
    """
    m = F.col("messages")
    key = key or ("record_id",)
    rows = records.select(*key, F.transform(m, lambda x, i: F.struct(i.alias("at"), x["role"].alias("role"), x["tool_call_id"].alias("id"))).alias("m"), C.tool_calls(m).alias("calls"))
    known = F.map_from_entries(
        F.transform(F.array_distinct(F.transform(F.filter("calls", lambda c: c["id"].isNotNull()), lambda c: c["id"])), lambda i: F.struct(i, F.array_min(F.transform(F.filter("calls", lambda c: c["id"] == i), lambda c: c["message"]))))
    )
    rows = rows.withColumn("known", known).withColumn("r", F.filter("m", lambda x: x["role"] == "tool"))
    heard = F.filter("r", lambda x: F.coalesce(F.try_element_at("known", x["id"]) < x["at"], F.lit(False)))
    ids = F.transform(heard, lambda x: x["id"])
    return rows.select(
        *key,
        F.size("calls").alias("calls"),
        F.size("r").alias("responses"),
        (F.size("r") - F.size(heard)).alias("unknown"),
        C.repeats(ids).alias("repeated"),
        F.size(F.array_except(F.map_keys("known"), ids)).alias("unanswered"),
    )
