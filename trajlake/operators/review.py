"""Ordered decision rules over evidence, and samples of what was decided."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajlake.functions import calls as C
from trajlake.functions.labels import cases, shortened
from trajlake.functions.text import evidence

from .planning import first_k


def gold_answer(c: Column) -> tuple[Column, Column]:
    """(text, answer type) of a gold answer in JSON: a string, or an object with text, value and answer_type.

    Text that is no JSON is the answer itself. The value of an object follows its text on a line of its own.
    """
    v = F.try_parse_json(c)
    member = lambda name: F.try_variant_get(v, f"$.{name}", "string")
    value = F.try_variant_get(v, "$.value", "variant")
    shown = F.when(~F.is_variant_null(value), F.to_json(value))
    is_object = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    text = F.when(is_object, F.concat_ws("\n", F.coalesce(member("text"), F.lit("")), shown)).otherwise(F.coalesce(F.try_variant_get(v, "$", "string"), c, F.lit("")))
    return text, F.when(is_object, F.coalesce(member("answer_type"), F.lit(""))).otherwise("")


def expected(single: Column | None, many: list[Column]) -> Column:
    """The distinct non-empty ids of one field and of arrays, in one array; null fields are empty."""
    parts = [F.coalesce(a, F.array().cast("array<string>")) for a in many]
    if single is not None:
        parts.insert(0, F.array(single))
    return F.array_distinct(F.filter(F.concat(*parts), lambda x: F.coalesce(x != "", F.lit(False))))


# The fields in which the rows of one task must agree.
FINGERPRINTED = ("citation", "expected_tables", "gold_answer", "instruction", "source_documents", "type")


def manifest_fingerprint() -> Column:
    """One text of FINGERPRINTED, equal for equal contents; gold_answer counts as JSON if it is, whatever its spelling."""
    others = F.struct(*(c for c in FINGERPRINTED if c != "gold_answer"))
    gold = F.coalesce(C.json_value(F.col("gold_answer")), F.to_variant_object(F.array("gold_answer")))
    return F.concat_ws("\1", F.to_json(others, {"ignoreNullFields": "false"}), F.to_json(gold))


def task_type(planned: Column, manifest: Column) -> Column:
    """The plan's type, else the manifest's, else empty; empty and 'unknown' count as none."""
    given = lambda c: F.when(~c.isin("", "unknown"), c)
    return F.coalesce(given(planned), given(manifest), F.lit(""))


def with_evidence(rows: DataFrame) -> DataFrame:
    """rows with answer and the struct evidence, plus tables_accessed; without messages.

    rows: messages, conflict, present and the manifest's gold, instruction, documents (array) and tables
    (array). A table counts as accessed if its lower-case name stands in the calls. Where the manifest is
    in conflict or missing there is nothing to hold the record against: evidence and tables_accessed are null.
    """
    m = F.col("messages")
    judged = F.col("present") & ~F.col("conflict")
    rows = rows.withColumn("answer", C.final_answer(m))
    open_ = rows.filter(judged).withColumn("calls", C.tool_calls(m))
    open_ = open_.withColumns({"responses": C.recorded_responses(m), "called": C.recorded_calls(F.col("calls"))}).drop("messages", "calls")
    open_ = open_.withColumn("evidence", evidence(F.col("answer"), F.col("responses"), F.col("called"), F.col("gold"), F.col("instruction"), F.col("documents")))
    lower = F.lower("called")
    open_ = open_.withColumn("tables_accessed", F.size(F.filter("tables", lambda t: lower.contains(F.lower(t))))).drop("responses", "called")
    settled = rows.filter(~judged).drop("messages").withColumns({"evidence": F.lit(None).cast(open_.schema["evidence"].dataType), "tables_accessed": F.lit(None).cast("int")})
    return open_.unionByName(settled)


def decide(rules: list[tuple[Column, str, str, str]], otherwise: tuple[str, str, str]) -> Column:
    """status, reason and confidence of the first rule whose condition holds; a null condition doesn't hold."""
    made = lambda x: F.struct(*(F.lit(v).alias(n) for v, n in zip(x, ("status", "reason", "confidence"))))
    return cases([(F.coalesce(c, F.lit(False)), made(x)) for c, *x in rules], made(otherwise))


def evidence_rules() -> tuple[list[tuple[Column, str, str, str]], tuple[str, str, str]]:
    """The rules of evidence review (thresholds and names are fixed values), for decide(); columns as with_evidence gives them, and conflict, present, quality_tier, type, answer_type."""
    e = lambda n: F.col(f"evidence.{n}")
    share = lambda part, whole: part / F.greatest(F.lit(1), F.size(whole))
    kb = F.col("type") == "kb"
    docs, tables = F.size("documents"), F.size("tables")
    doc_share, table_share = share(e("documents_accessed"), "documents"), share(F.col("tables_accessed"), "tables")
    support, matched, loose = e("support"), e("gold_numbers_match"), e("unsupported_numbers") > 0
    review, accept, refuse = "manual_review", "auto_pass", "auto_reject"
    rules = [
        (F.col("conflict"), review, "manifest_conflict", "high"),
        (~F.col("present"), review, "manifest_missing", "high"),
        (F.col("quality_tier") == "sql_result_verified", accept, "sql_result_verified", "high"),
        (F.col("answer") == "", refuse, "empty_final_answer", "high"),
        (kb & (docs > 0) & (doc_share == 0) & (support < 0.5), refuse, "expected_document_not_used", "high"),
        (kb & loose & (support < 0.7), review, "unsupported_numeric_claim", "medium"),
        (kb & (doc_share == 1) & (support >= 0.9) & matched, accept, "kb_grounded_in_expected_document", "high"),
        (kb & (doc_share == 1) & (support >= 0.8) & (e("gold_overlap") >= 0.65) & matched, accept, "kb_gold_and_document_supported", "medium"),
        (kb, review, "kb_semantic_scope_uncertain", "medium"),
        ((tables > 0) & (table_share < 1), refuse, "expected_table_missing", "high"),
        (loose & (support < 0.5), review, "unsupported_numeric_claim", "medium"),
        (F.col("answer_type").isin("numeric", "table") & (table_share == 1) & (support >= 0.85) & matched & ~loose, accept, "recorded_query_evidence_matches_gold", "medium"),
    ]
    return rules, (review, "execution_or_semantic_review_required", "medium")


def sample_per_reason(decisions: DataFrame, order: list[Column | str], k: int = 2, limit: int = 700, texts: tuple[str, ...] = ()) -> DataFrame:
    """The first k decisions of each reason, with the named texts cut to limit characters."""
    rows = first_k(decisions, ["reason"], [F.col(c) if isinstance(c, str) else c for c in order], k)
    return rows.withColumns({t: shortened(F.col(t), limit) for t in texts})


