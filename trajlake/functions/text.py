"""Normalised texts, numbers and evidence scores; the few functions that need Arrow UDFs.

Spark has no Unicode normalisation, so these run in Python, a column batch at a time. Filter before
applying them: UDFs inside a conditional run for every row.
"""

from __future__ import annotations

import re
import unicodedata
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Numbers outside identifiers; prefixes of list items; ends of claims.
NUMBER = re.compile(r"(?<![A-Za-z_])[-+]?\d+(?:,\d{3})*(?:\.\d+)?%?")
ITEM_PREFIX = re.compile(r"(?m)^\s*(?:[-*]>#]+|\d+[.)、])\s*")
CLAIM_END = re.compile(r"[。！？；\n]+")
#: Claims of fewer normalised characters say nothing.
LEAST_CLAIM = 8


_OTHER = re.compile(r"[\W_]+")


def folded(text: str | None) -> str:
    """NFKC, lower case, letters and digits only; null: empty."""
    return _OTHER.sub("", unicodedata.normalize("NFKC", text or "").lower())


def numbers_in(text: str | None) -> set[str]:
    """The numbers of a text in one spelling: no thousands separators or plus sign, twelve digits, % kept."""
    plain = ITEM_PREFIX.sub("", unicodedata.normalize("NFKC", text or ""))
    out = set()
    for found in NUMBER.findall(plain):
        percent = "%" if found.endswith("%") else ""
        out.add(format(float(found.rstrip("%").replace(",", "")), ".12g") + percent)
    return out


def coverage(claim: str, evidence: str) -> float:
    """Share of the claim's distinct bigrams (a single character stands for itself) that stand in the evidence,
    both folded: 1 if it is contained, 0 if either is empty."""
    if not claim or not evidence:
        return 0.0
    if claim in evidence:
        return 1.0
    # a claim is short: its bigrams are looked for, instead of listing those of the evidence
    pairs = {a + b for a, b in zip(claim, claim[1:])} or {claim}
    return round(sum(p in evidence for p in pairs) / len(pairs), 6)


def support(answer: str, known: str) -> float:
    """Coverage of the answer's claims by folded evidence, weighted by their length; of the whole answer if no claim is long enough."""
    claims = [c for c in map(folded, CLAIM_END.split(ITEM_PREFIX.sub("", answer))) if len(c) >= LEAST_CLAIM]
    if not claims:
        return coverage(folded(answer), known)
    # in whole millionths, so that the order of the claims can't change the last digit
    millionths = sum(round(coverage(c, known) * 1e6) * len(c) for c in claims)
    return round(Fraction(millionths, sum(map(len, claims)))) / 1e6


@F.pandas_udf(T.StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x).strip())


def nfkc(c: Column) -> Column:
    """NFKC and trimmed; null stays null."""
    return _nfkc(c)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _numbers(s: pd.Series) -> pd.Series:
    return s.map(lambda x: sorted(numbers_in(x)))


def numbers(c: Column) -> Column:
    """The distinct numbers of a text, sorted; null: empty."""
    return _numbers(c)


EVIDENCE = T.StructType(
    [T.StructField("support", T.DoubleType()), T.StructField("gold_overlap", T.DoubleType()), T.StructField("gold_numbers", T.IntegerType())]
    + [T.StructField("gold_numbers_match", T.BooleanType()), T.StructField("unsupported_numbers", T.IntegerType()), T.StructField("documents_accessed", T.IntegerType())]
)


@F.pandas_udf(EVIDENCE)
def _evidence(answer: pd.Series, responses: pd.Series, calls: pd.Series, gold: pd.Series, instruction: pd.Series, documents: pd.Series) -> pd.DataFrame:
    rows = []
    for a, r, c, g, i, d in zip(answer, responses, calls, gold, instruction, documents):
        a, r, c, g = a or "", r or "", c or "", g or ""
        wanted, given = numbers_in(g), numbers_in(a)
        heard = folded(r)
        seen = heard + folded(c) if d is not None and len(d) else ""
        rows.append((support(a, heard), coverage(folded(g), folded(a)), len(wanted), wanted <= given, len(given - numbers_in(f"{r}\n{c}\n{i or ''}")) if given else 0, sum(folded(x) in seen for x in (() if d is None else d))))
    return pd.DataFrame(rows, columns=EVIDENCE.names)


def evidence(answer: Column, responses: Column, calls: Column, gold: Column, instruction: Column, documents: Column) -> Column:
    """How far a record's own responses and calls bear out its answer, as a struct; nulls count as empty."""
    return _evidence(answer, responses, calls, gold, instruction, documents)


def bigram_coverage(claim: Column, evidence_: Column) -> Column:
    """coverage() of folded texts by built-in functions; texts that need no NFKC give the same as coverage()."""
    fold = lambda c: F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]", "")
    a, b = fold(claim), fold(evidence_)
    grams = lambda t: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(t) - 1)), lambda i: F.substring(t, i, F.lit(2))))
    part = F.bround(F.size(F.array_intersect(grams(a), grams(b))) / F.size(grams(a)), 6)
    return F.when((a == "") | (b == ""), 0.0).when(b.contains(a), 1.0).otherwise(part)
