"""Tool calls and message texts inside a record, by higher-order functions: no explode, no shuffle.

messages is an array of structs with role, content, reasoning_content, tool_call_id and tool_calls, the
latter a JSON array as text. Arguments may be a JSON object or a string that holds one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What tool_calls() gives for each call.
CALLS = "array<struct<message:int,call:int,id:string,name:string,arguments:string,has_function:boolean,has_name:boolean,null_arguments:boolean>>"
# JSON texts that stand for nothing given, whatever the type that is wanted.
NOTHING = ("null", "false", "0", "0.0", "[]", "{}", '""')

# What counts as a failed response, a destructive or a networking command, a path that
# holds on one machine only, and a secret.
TOOL_ERROR = r"(?i)traceback|\berror\b|no such file|command not found|permission denied|timed? out|syntax error|exception|segmentation fault"
DESTRUCTIVE = r"(?i)\brm\s+-[^\n]*r[^\n]*f|\bmkfs\b|\bdd\s+if=|\bshutdown\b|\breboot\b|\bchmod\s+777\b|\bchown\s+-R\b|(?:curl|wget)[^\n|]*\|\s*(?:ba)?sh\b"
NETWORK = r"(?i)\b(?:curl|wget|git\s+clone|pip\s+install|apt(?:-get)?\s+install|yum\s+install)\b"
LOCAL_PATH = r"(?i)/(?:private/)?tmp/pi_sandbox_[^\s'\"`]+|/data/[^\s'\"`]+"
SECRETS = (
    r"AKIA[0-9A-Z]{16}",
    r"-----BEGIN (?:RSA |OPENSSH |EC )?PRIVATE KEY-----",
    r"(?i)\bBearer\s+[A-Za-z0-9._-]{20,}",
    r"\bhf_[A-Za-z0-9]{20,}\b",
    r"\bgh[pousr]_[A-Za-z0-9]{20,}\b",
)
# Fixed value: the names of the four tools.
TOOLS = ("bash", "read", "write", "edit")


def text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def of_role(messages: Column, role: str) -> Column:
    return F.filter(messages, lambda m: m["role"] == role)


def let(value: Column, then) -> Column:
    """then(value) with the value computed once; inside of lambdas Spark would compute it wherever it stands."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def json_value(c: Column) -> Column:
    """The one JSON value of a text as VARIANT; null for text that isn't JSON, or is more than one value.

    Values above the size limit of VARIANT, and objects that name a key twice, are null, too.
    """
    # a single value stands alone in an array as well; text after it would not
    alone = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), c, F.lit("]"))), "$", "array<variant>")
    return let(alone, lambda a: F.when(F.size(a) == 1, F.get(a, F.lit(0))))


def is_nothing(v: Column) -> Column:
    """Whether a VARIANT is missing, null, false, zero or empty."""
    return v.isNull() | F.coalesce(F.to_json(v).isin(*NOTHING), F.lit(False))


def variant_text(v: Column, path: str) -> Column:
    """The member if it is a string, else null."""
    member = F.try_variant_get(v, path, "variant")
    return F.when(F.schema_of_variant(member) == "STRING", F.try_variant_get(v, path, "string"))


def no_call_list(m: Column) -> Column:
    """Whether an assistant's tool_calls are given, but no JSON array."""
    given = (m["role"] == "assistant") & m["tool_calls"].isNotNull() & (F.trim(m["tool_calls"]) != "")
    is_list = lambda v: F.coalesce(F.schema_of_variant(v).startswith("ARRAY"), F.lit(False))
    wrong = let(F.try_parse_json(m["tool_calls"]), lambda v: ~is_list(v) & (v.isNull() | ~is_nothing(v)))
    return F.when(given, wrong).otherwise(F.lit(False))


def tool_calls(messages: Column) -> Column:
    """All calls of the assistant messages in order: message, call (positions), id, name, arguments (as text),
    has_function (an object), has_name (a string that isn't empty), null_arguments (given as null).

    tool_calls that are no JSON array give no call; an element without a function object is a call of no
    name and arguments. Ids that are no strings are null, names that are no strings their JSON text.
    Arguments that are no string are JSON text with sorted keys; missing and null ones are null.
    """

    def of(m, i):
        parsed = F.when(m["role"] == "assistant", F.try_variant_get(F.try_parse_json(m["tool_calls"]), "$", "array<variant>"))

        def one(c, j):
            def parts(f, a):
                is_null = F.coalesce(F.is_variant_null(a), F.lit(False))
                name = F.try_variant_get(f, "$.name", "string")
                return F.struct(
                    i.alias("message"),
                    j.alias("call"),
                    variant_text(c, "$.id").alias("id"),
                    name.alias("name"),
                    F.when(~is_null, F.when(F.schema_of_variant(a) == "STRING", F.try_variant_get(a, "$", "string")).otherwise(F.to_json(a))).alias("arguments"),
                    F.coalesce(F.schema_of_variant(f).startswith("OBJECT"), F.lit(False)).alias("has_function"),
                    F.coalesce((F.schema_of_variant(F.try_variant_get(f, "$.name", "variant")) == "STRING") & (name != ""), F.lit(False)).alias("has_name"),
                    is_null.alias("null_arguments"),
                )

            return let(F.try_variant_get(c, "$.function", "variant"), lambda f: let(F.try_variant_get(f, "$.arguments", "variant"), lambda a: parts(f, a)))

        return F.transform(F.coalesce(parsed, F.array().cast("array<variant>")), one)

    return F.flatten(F.transform(messages, of))


def canonical_json(c: Column) -> Column:
    """JSON text with keys sorted and blanks dropped; text that isn't JSON stays as it is."""
    return F.coalesce(F.to_json(json_value(c)), c)


def signatures(calls: Column) -> Column:
    """Name and canonical arguments of each call as one text; equal calls have equal signatures."""
    return F.transform(calls, lambda c: F.concat(text(c["name"]), F.lit("\1"), canonical_json(text(c["arguments"]))))


def repeats(values: Column) -> Column:
    """How many elements equal an earlier one."""
    return F.size(values) - F.size(F.array_distinct(values))


def adjacent_repeats(values: Column) -> Column:
    """How many elements equal the one before."""
    rest = F.slice(values, F.lit(2), F.greatest(F.lit(0), F.size(values) - 1))
    return F.size(F.filter(F.zip_with(values, rest, lambda a, b: F.coalesce(a == b, F.lit(False))), lambda x: x))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda acc, x: acc + x.cast("int"))


def has_secret(c: Column) -> Column:
    hit = c.rlike(SECRETS[0])
    for pattern in SECRETS[1:]:
        hit = hit | c.rlike(pattern)
    return hit


def count_where(values: Column, test) -> Column:
    return F.size(F.filter(values, lambda x: F.coalesce(test(x), F.lit(False))))


def stripped(c: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def first_user(messages: Column) -> Column:
    """The first non-null user content; null if there is none."""
    return F.try_element_at(F.filter(messages, lambda m: (m["role"] == "user") & m["content"].isNotNull()), F.lit(1))["content"]


def last_role(messages: Column) -> Column:
    return F.try_element_at(messages, F.lit(-1))["role"]


def final_answer(messages: Column) -> Column:
    """The last assistant content that isn't blank, trimmed; empty if there is none."""
    said = F.filter(of_role(messages, "assistant"), lambda m: stripped(text(m["content"])) != "")
    return text(stripped(F.try_element_at(said, F.lit(-1))["content"]))


def recorded_responses(messages: Column) -> Column:
    return F.array_join(F.transform(of_role(messages, "tool"), lambda m: text(m["content"])), "\n")


def recorded_calls(calls: Column) -> Column:
    """Names and arguments of all calls, a line each; calls without arguments have a name only."""
    lines = F.flatten(F.transform(calls, lambda c: F.array(text(c["name"]), c["arguments"])))
    return F.array_join(lines, "\n")


# --- canonical use of the four tools -------------------------------------------------------------

# The arguments that each tool may have, and those that it must have.
ALLOWED = {"bash": ("command", "timeout"), "read": ("path", "offset", "limit"), "write": ("path", "content"), "edit": ("path", "edits", "oldText", "newText")}
REQUIRED = {"bash": ("command",), "read": ("path",), "write": ("path", "content"), "edit": ("path",)}


def _member(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "variant")


def _kind(v: Column, name: str) -> Column:
    return F.schema_of_variant(_member(v, name))


def _is_text(v: Column, name: str) -> Column:
    return F.coalesce(_kind(v, name) == "STRING", F.lit(False))


def _whole_from(v: Column, name: str, least: int) -> Column:
    """Missing, null, or an integer (no boolean, no decimal) of at least `least`."""
    kind = _kind(v, name)
    number = F.when(kind == "BIGINT", F.try_variant_get(v, f"$.{name}", "bigint"))
    return F.coalesce(kind == "VOID", F.lit(True)) | F.coalesce(number >= least, F.lit(False))


def call_problem(name: Column, arguments: Column) -> Column:
    """Why a call isn't canonical, null if it is; arguments as JSON text."""
    of = lambda table: F.coalesce(*(F.when(name == t, F.array(*map(F.lit, table[t]))) for t in TOOLS))
    whole_edit = lambda e: _is_text(e, "oldText") & _is_text(e, "newText") & (F.size(F.json_object_keys(F.to_json(e))) == 2)
    batch = lambda v: let(F.try_variant_get(v, "$.edits", "array<variant>"), lambda e: F.coalesce((F.size(e) > 0) & F.forall(e, whole_edit), F.lit(False)))
    valid = lambda v: (
        F.when(name == "bash", _is_text(v, "command") & _whole_from(v, "timeout", 1))
        .when(name == "read", _is_text(v, "path") & _whole_from(v, "offset", 0) & _whole_from(v, "limit", 1))
        .when(name == "write", _is_text(v, "path") & _is_text(v, "content"))
        .otherwise(_is_text(v, "path") & ((_is_text(v, "oldText") & _is_text(v, "newText")) | batch(v)))
    )
    problem = lambda v, keys: (
        F.when(~F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False)), "non_object_arguments")
        .when(F.size(F.array_except(of(REQUIRED), keys)) > 0, "missing_required_argument")
        .when(F.size(F.array_except(keys, of(ALLOWED))) > 0, "noncanonical_argument_key")
        .when(~valid(v), "invalid_argument_value")
    )
    keys_of = lambda v: F.coalesce(F.json_object_keys(F.to_json(v)), F.array().cast("array<string>"))
    known = let(json_value(arguments), lambda v: let(keys_of(v), lambda keys: problem(v, keys)))
    return F.when(F.coalesce(name.isin(*TOOLS), F.lit(False)), known).otherwise("noncanonical_tool_name")


def tools_status(calls: Column) -> Column:
    """The problem of the first call that isn't canonical, 'no_tool_calls', or 'canonical'."""
    problems = F.filter(F.transform(calls, lambda c: call_problem(c["name"], c["arguments"])), lambda p: p.isNotNull())
    return F.when(F.size(calls) == 0, "no_tool_calls").otherwise(F.coalesce(F.try_element_at(problems, F.lit(1)), F.lit("canonical")))
