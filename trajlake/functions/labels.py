"""Labels derived from one row: families, tiers, buckets, phases, splits and routing groups.

All are built-in column expressions. Boundaries and names are parameters or the fixed values below.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bounds of the token buckets and of the ratio buckets.
TOKEN_BOUNDS = (2048, 4096, 8192, 16384, 32768, 65536, 131072, 262144)
RATIO_BOUNDS = (0.05, 0.10, 0.20, 0.40)
# Evidence tiers, best first.
TIERS = ("sql_result_verified", "judge_rule_only", "report_rule_only", "kb_rule_only")
LONG_PHASE = "long_32k_review"


def cases(pairs, otherwise=None) -> Column:
    """when(c1, v1).when(c2, v2)...otherwise(x), from a list of pairs; without otherwise, null."""
    out = None
    for condition, value in pairs:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out if otherwise is None else out.otherwise(otherwise)


def family_of_file(file_name: Column, prefixes: dict[str, str]) -> Column:
    """The family whose prefix the file name has, else 'unknown'; null name: 'unknown'."""
    return cases([(file_name.startswith(p), F.lit(f)) for p, f in prefixes.items()], F.lit("unknown"))


def evidence_tier(agent_sql_ok: Column, is_report: Column, type_: Column) -> Column:
    """The strongest evidence behind a verdict; null flags count as false."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    return cases([(yes(agent_sql_ok), "sql_result_verified"), (yes(is_report), "report_rule_only"), (F.coalesce(type_ == "kb", F.lit(False)), "kb_rule_only")], F.lit("judge_rule_only"))


def token_bucket(tokens: Column) -> Column:
    """Upper-inclusive bucket as 'low-high'; the first one takes all that is smaller, the last one is open. Null tokens: null."""
    lows = (0, *TOKEN_BOUNDS)
    named = [(tokens <= high, f"{low + 1}-{high}") for low, high in zip(lows, TOKEN_BOUNDS)]
    return cases([(tokens.isNull(), F.lit(None).cast("string")), *named], F.lit(f">{TOKEN_BOUNDS[-1]}"))


def ratio_bucket(ratio: Column) -> Column:
    """Upper-exclusive bucket of a share, in percent. Null: null."""
    lows = (0.0, *RATIO_BOUNDS)
    named = [(ratio < high, f"{low:.0%}-<{high:.0%}") for low, high in zip(lows, RATIO_BOUNDS)]
    return cases([(ratio.isNull(), F.lit(None).cast("string")), *named], F.lit(f">={RATIO_BOUNDS[-1]:.0%}"))


def phases(production_max: int = 16_384) -> list[tuple[str, int, int]]:
    """(name, exclusive lower, inclusive upper) of the length phases around the production limit."""
    if not 8_192 < production_max < 32_768:
        raise ValueError("the production limit must lie between 8192 and 32768")
    return [("core_8k", 0, 8_192), (f"extension_{production_max // 1024}k", 8_192, production_max), (LONG_PHASE, production_max, 32_768)]


def phase(tokens: Column, production_max: int = 16_384) -> Column:
    """The phase by length; null outside of all, and for null tokens."""
    return cases([((tokens > low) & (tokens <= high), name) for name, low, high in phases(production_max)])


def hashed_share(key: Column) -> Column:
    """A number in [0, 1) from the first 64 bits of the key's SHA-256."""
    bits = F.conv(F.substring(F.sha2(key, 256), 1, 16), 16, 10).cast("decimal(20,0)").cast("double")
    return bits / F.lit(2.0**64)


def stable_split(key: Column, train: float = 0.85, validation: float = 0.075) -> Column:
    """train, validation or test by the key alone, so related rows go together whatever else arrives."""
    if not (0 < train < 1 and 0 <= validation < 1 and train + validation <= 1):
        raise ValueError("shares must lie in (0, 1) and add up to at most 1")
    share = hashed_share(key)
    return cases([(key.isNull(), F.lit(None).cast("string")), (share < train, "train"), (share < train + validation, "validation")], F.lit("test"))


def output_group(phase_: Column, split: Column, tier: Column) -> Column:
    """Which output a plan row goes to; a phase of no known name raises when the row is computed."""
    known = phase_.rlike(r"^(core_8k|extension_\d+k|long_32k_review)$")
    return cases(
        [
            (~F.coalesce(known, F.lit(False)), F.raise_error(F.concat(F.lit("unknown phase: "), F.coalesce(phase_, F.lit("null")))).cast("string")),
            (phase_ == LONG_PHASE, F.lit(LONG_PHASE)),
            (F.coalesce(split != "train", F.lit(True)), F.lit("heldout")),
            (tier == TIERS[0], F.lit("train_strong_verified")),
        ],
        F.lit("train_review"),
    )


def shortened(text: Column, limit: int) -> Column:
    """Without NUL characters and at most `limit` characters, with an ellipsis where cut."""
    clean = F.replace(text, F.lit("\0"), F.lit(""))
    return F.when(F.length(clean) > limit, F.concat(F.left(clean, F.lit(limit)), F.lit("…"))).otherwise(clean)


def variant_type(v: Column) -> Column:
    """The JSON type of a VARIANT: null, boolean, integer, number, string, list or object; SQL null: missing."""
    kind = F.schema_of_variant(v)
    return cases(
        [
            (v.isNull(), "missing"),
            (kind == "VOID", "null"),
            (kind == "BOOLEAN", "boolean"),
            (kind == "BIGINT", "integer"),
            (kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), "number"),
            (kind == "STRING", "string"),
            (kind.startswith("ARRAY"), "list"),
            (kind.startswith("OBJECT"), "object"),
        ],
        F.lower(kind),
    )


def any_of(reasons: list[tuple[Column, str]]) -> Column:
    """The names of all conditions that hold, as an array in the given order; null conditions don't hold."""
    return F.array_compact(F.array(*(F.when(c, F.lit(name)) for c, name in reasons)))


def first_of(gates: list[tuple[Column, str]], passed: str) -> Column:
    """The name of the first gate that is not passed, else `passed`; a null gate isn't passed."""
    return cases([(~F.coalesce(ok, F.lit(False)), name) for ok, name in gates], F.lit(passed))
