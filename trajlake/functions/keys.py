"""Canonical forms of the keys that arrive in several spellings.

Every function maps Column to Column with built-in expressions only, so filters and joins on the
results stay inside whole-stage code generation. Null in gives null out unless stated otherwise.
The *_sql twins return the same expression as ANSI SQL text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The full-width forms of printable ASCII, and the ideographic space.
WIDE = "".join(chr(0xFF01 + i) for i in range(94)) + "　"
NARROW = "".join(chr(0x21 + i) for i in range(94)) + " "

# Fixed values of the data: family names, by their letters and digits; and by the first word of a file name.
FAMILIES = {"vorlan14b": "vorlan-14b", "quesselv3": "quessel-v3", "ondrei61": "ondrei-6.1", "tamrikmax": "tamrik-max"}
FAMILY_OF_FILE = {"vorlan14b": "vorlan-14b", "quessel": "quessel-v3", "ondrei61": "ondrei-6.1", "tamrikmax": "tamrik-max"}
SPLITS = {
    "train": ("train", "training"),
    "validation": ("validation", "val", "valid", "dev"),
    "test": ("test", "testing"),
}
LANGS = {"zh": ("zh", "cn"), "en": ("en", "eng"), "ja": ("ja", "jp"), "es": ("es",), "de": ("de",)}

TASK = r"^([a-z]+)[^a-z0-9]*0*([0-9]+)[^a-z0-9]*([a-z]?)$"
BLANK_ENDS = r"^\s+|\s+$"


def narrow(c: Column) -> Column:
    """Full-width letters, digits and signs as ASCII."""
    return F.translate(c, WIDE, NARROW)


def squeezed(c: Column) -> Column:
    """Lower-case ASCII letters and digits only."""
    return F.regexp_replace(F.lower(narrow(c)), "[^a-z0-9]", "")


def task_key(c: Column) -> Column:
    """Prefix word, number without leading zeros, letter after it; a tag after @ is dropped.

    An identifier of another shape keeps its trimmed lower-case text.
    """
    bare = F.regexp_replace(F.regexp_replace(F.lower(narrow(c)), "(?s)@.*", ""), BLANK_ENDS, "")
    return F.regexp_replace(bare, TASK, "$1_$2$3")


def _mapped(c: Column, names: dict[str, str]) -> Column:
    out = None
    for key, name in names.items():
        out = F.when(c == key, name) if out is None else out.when(c == key, name)
    return out


def family_key(family: Column, source_file: Column) -> Column:
    """The family by name, else by the first word of the file name, else 'unknown'; never null."""
    word = F.regexp_extract(F.lower(source_file), "^([a-z0-9]+)", 1)
    return F.coalesce(_mapped(squeezed(family), FAMILIES), _mapped(word, FAMILY_OF_FILE), F.lit("unknown"))


def split_key(c: Column) -> Column:
    """train, validation or test; null for null and for anything else."""
    bare = F.regexp_replace(F.lower(narrow(c)), BLANK_ENDS, "")
    out = None
    for name, spellings in SPLITS.items():
        hit = bare.isin(*spellings)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def tier_key(c: Column) -> Column:
    """Lower case, with one underscore for each separator or blank between words."""
    return F.regexp_replace(F.regexp_replace(F.lower(narrow(c)), r"^[\s_-]+|[\s_-]+$", ""), r"[\s_-]+", "_")


def label_key(c: Column) -> Column:
    """Trimmed lower case; 'unknown' for null or blank. For types and domains."""
    bare = F.regexp_replace(F.lower(narrow(c)), BLANK_ENDS, "")
    return F.when(bare.isNull() | (bare == ""), "unknown").otherwise(bare)


def source_key(c: Column) -> Column:
    """label_key with one underscore for each separator."""
    return F.regexp_replace(label_key(c), r"[\s_-]+", "_")


def lang_key(c: Column) -> Column:
    """Two-letter language of a tag such as 'en-US' or 'eng'; 'und' for null, blank and unknown tags."""
    first = F.regexp_extract(F.lower(c), r"^\s*([a-z]+)", 1)
    out = None
    for name, spellings in LANGS.items():
        hit = first.isin(*spellings)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("und")


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def narrow_sql(x: str) -> str:
    return f"translate({x}, {quoted(WIDE)}, {quoted(NARROW)})"


def squeezed_sql(x: str) -> str:
    return f"regexp_replace(lower({narrow_sql(x)}), '[^a-z0-9]', '', 'g')"


def task_sql(x: str) -> str:
    bare = rf"regexp_replace(regexp_replace(lower({narrow_sql(x)}), '(?s)@.*', ''), '{BLANK_ENDS}', '', 'g')"
    return rf"regexp_replace({bare}, '{TASK}', '\1_\2\3')"


def _mapped_sql(x: str, names: dict[str, str]) -> str:
    return f"CASE {x} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.items()) + " END"


def family_sql(family: str, source_file: str) -> str:
    word = f"regexp_extract(lower({source_file}), '^([a-z0-9]+)', 1)"
    return f"coalesce({_mapped_sql(squeezed_sql(family), FAMILIES)}, {_mapped_sql(word, FAMILY_OF_FILE)}, 'unknown')"


def split_sql(x: str) -> str:
    bare = rf"regexp_replace(lower({narrow_sql(x)}), '{BLANK_ENDS}', '', 'g')"
    cases = " ".join(f"WHEN {bare} IN ({', '.join(map(quoted, v))}) THEN '{k}'" for k, v in SPLITS.items())
    return f"CASE {cases} END"


def tier_sql(x: str) -> str:
    return rf"regexp_replace(regexp_replace(lower({narrow_sql(x)}), '^[\s_-]+|[\s_-]+$', '', 'g'), '[\s_-]+', '_', 'g')"


def label_sql(x: str) -> str:
    return rf"coalesce(nullif(regexp_replace(lower({narrow_sql(x)}), '{BLANK_ENDS}', '', 'g'), ''), 'unknown')"


def source_sql(x: str) -> str:
    return rf"regexp_replace({label_sql(x)}, '[\s_-]+', '_', 'g')"


def lang_sql(x: str) -> str:
    first = rf"regexp_extract(lower({x}), '^\s*([a-z]+)', 1)"
    cases = " ".join(f"WHEN {first} IN ({', '.join(map(quoted, v))}) THEN '{k}'" for k, v in LANGS.items())
    return f"CASE {cases} ELSE 'und' END"
