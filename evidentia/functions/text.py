"""Text functions as column expressions, and the few that need Python as Arrow UDFs."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

#: Marks that profile matching treats as blanks (fixed values).
SEPARATORS = "_-/;,|:()[]{}"
#: Marks that domain labels treat as blanks (fixed values).
LABEL_SEPARATORS = "_-/;,|"
#: Section names looked for in the head of a chunk, in order (fixed values).
SECTIONS = ("abstract", "methods", "results", "discussion", "references")
SECTION_WINDOW = 500


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once a row however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fold(c: Column) -> Column:
    """Lower case with sharp s spread out: equals full case folding on Latin text (see ``casefold`` for all)."""
    return F.replace(F.lower(c), F.lit("ß"), F.lit("ss"))


def collapse(c: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\A\s+|\s+\z", "")


def normalize(c: Column, separators: str = SEPARATORS) -> Column:
    """Folded, separators and white space runs as one blank: what signals are matched in."""
    return collapse(F.translate(fold(c), separators, " " * len(separators)))


def occurrences(text: Column, part: Column) -> Column:
    """Non-overlapping occurrences of ``part`` in ``text``; texts without any aren't rewritten to count them."""
    some = ((F.length(text) - F.length(F.replace(text, part, F.lit("")))) / F.length(part)).cast("int")
    return F.when(F.contains(text, part), some).otherwise(0)


def section_hint(text: Column) -> Column:
    head = fold(F.substring(text, 1, SECTION_WINDOW))
    hint = F.lit("page")
    for name in reversed(SECTIONS):
        hint = F.when(F.contains(head, F.lit(name)), name).otherwise(hint)
    return hint


def token_estimate(text: Column) -> Column:
    return F.greatest(F.lit(1), F.floor((F.length(text) + 3) / 4)).cast("int")


def safe_id(stem: Column) -> Column:
    """A file stem as an id: odd characters become dashes, none at the ends, ``paper`` if nothing is left."""
    dashed = F.regexp_replace(F.regexp_replace(stem, r"[^A-Za-z0-9._-]+", "-"), r"^[-._]+|[-._]+$", "")
    return F.coalesce(F.nullif(dashed, F.lit("")), F.lit("paper"))


def is_safe_id(c: Column) -> Column:
    return F.coalesce(c.rlike(r"\A[A-Za-z0-9][A-Za-z0-9._-]*\z"), F.lit(False))


def namespaced(paper_id: Column, horizon: Column) -> Column:
    """The id with ``_long`` or ``_short`` unless it ends so already."""
    suffix = F.concat(F.lit("_"), horizon)
    return F.when(F.endswith(paper_id, suffix), paper_id).otherwise(F.concat(paper_id, suffix))


def natural_key(c: Column, digits: int = 20) -> Column:
    """A string that sorts as ``c`` does when runs of digits count as numbers, after letters in the same place."""
    parts = F.regexp_extract_all(F.lower(c), F.lit(r"\d+|\D+"), F.lit(0))
    number = lambda p: F.concat(F.lit("￿"), F.lpad(F.regexp_replace(p, "^0+(?=.)", ""), digits, "0"))
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike(r"^\d"), number(p)).otherwise(p)), "\u0001")


def ratio4(n: Column, d: Column, empty: float = 1.0) -> Column:
    """n / d to 4 places, half to even; ``empty`` if d is 0."""
    return F.bround(F.when(d == 0, F.lit(empty)).otherwise(n.cast("double") / d), 4)


@F.pandas_udf(StringType())
def casefold(text: pd.Series) -> pd.Series:
    return text.map(str.casefold, na_action="ignore")


@F.pandas_udf(StringType())
def nfkc(text: pd.Series) -> pd.Series:
    return text.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


def _composed(x: object, name: str = "") -> object:
    if isinstance(x, str):
        return x if name.endswith(("_id", "_ids")) else unicodedata.normalize("NFKC", x)
    if isinstance(x, dict):
        return {k: _composed(v, k) for k, v in x.items()}
    return [_composed(v, name) for v in x] if isinstance(x, list) else x


@F.pandas_udf(StringType())
def _compose_json(text: pd.Series) -> pd.Series:
    return text.map(lambda x: json.dumps(_composed(json.loads(x)), ensure_ascii=False), na_action="ignore")


def composed(d: DataFrame, column: str) -> Column:
    """A nested column of ``d`` with its texts, but for ids, in compatibility composition; only rows that aren't ASCII go to Python."""
    text = F.to_json(column)
    odd = F.when(text.rlike(r"[^\x00-\x7F]"), text)
    return F.coalesce(F.from_json(_compose_json(odd), d.schema[column].dataType), F.col(column))


def json_text(value: object) -> str:
    """Compact JSON with sorted keys: what digests are taken of."""
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False)


@F.pandas_udf(StringType())
def canonical_json(text: pd.Series) -> pd.Series:
    """JSON text with sorted keys at every level and no blanks."""
    return text.map(lambda x: json_text(json.loads(x)), na_action="ignore")


@F.pandas_udf(ArrayType(StringType()))
def canonical_jsons(texts: pd.Series) -> pd.Series:
    """``canonical_json`` of each text of a list."""
    return texts.map(lambda xs: [x if x is None else json_text(json.loads(x)) for x in xs], na_action="ignore")


def decimal_text(value: str | float) -> str:
    """A number without exponent or trailing zeros."""
    number = Decimal(str(value))
    return "0" if number == 0 else format(number.normalize(), "f")


#: Dashes and a letter that scientific text writes in several ways (fixed values).
_VARIANTS = "‐‑‒–—−μ"
_PLAIN = "------u"


def scientific(c: Column, compose: bool = True) -> Column:
    """Scientific text without differences of spelling: composed, folded, one kind of dash, other marks as blanks.

    ``compose`` runs the compatibility composition, in Python, on texts that aren't ASCII;
    leave it out where the text is composed already.
    """
    form = F.coalesce(nfkc(F.when(c.rlike(r"[^\x00-\x7F]"), c)), c) if compose else c
    plain = F.translate(fold(form), _VARIANTS, _PLAIN)
    return collapse(F.regexp_replace(plain, r"(?U)[^\w.%<>=!+\-/]+", " "))


#: What a folded ASCII text has if its scientific form differs from it.
_UNLIKE = r"[^a-z0-9_.%<>=!+/\- ]|  |^ | $"


def scientific_short(c: Column) -> Column:
    """``scientific`` of a composed text; one that is in that form once folded isn't rewritten."""
    low = F.lower(c)
    return F.when(low.rlike(_UNLIKE), scientific(c, False)).otherwise(low)


def json_string(c: Column) -> Column:
    """A text as ``json_text`` writes it, null as ``null``."""
    out = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for x in ['"', *map(chr, range(32))]:
        out = F.replace(out, F.lit(x), F.lit(json.dumps(x)[1:-1]))
    return F.coalesce(F.concat(F.lit('"'), F.when(c.rlike(r'[\x00-\x1f"\\]'), out).otherwise(c), F.lit('"')), F.lit("null"))


def lower_escapes(c: Column) -> Column:
    """JSON text of ``to_json`` with escapes of control characters as ``json_text`` writes them: ``\\u001f``, not ``\\u001F``."""
    out = c
    for x in ("0B", "0E", "0F", "1A", "1B", "1C", "1D", "1E", "1F"):
        out = F.regexp_replace(out, rf"(?<!\\)((?:\\\\)*)\\u00{x}", rf"$1\\u00{x.lower()}")
    return F.when(F.contains(c, F.lit("\\u00")), out).otherwise(c)


def sorted_keys(c: Column, kind: DataType) -> Column:
    """A nested column with the fields of its structs in order of their names: ``to_json`` of it has sorted keys."""
    if isinstance(kind, StructType):
        parts = [sorted_keys(c[f.name], f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)]
        return F.when(c.isNotNull(), F.struct(*parts))
    return F.transform(c, lambda x: sorted_keys(x, kind.elementType)) if isinstance(kind, ArrayType) and not isinstance(kind.elementType, StringType) else c


#: What counts as a token of a normalised text (fixed value).
TOKEN = r"(?:e|p)\d+(?:\.\d+)?|[a-z][a-z0-9]*(?:-[a-z0-9]+)*|\d+(?:\.\d+)?|[%<>]=?|[=!+\-/]"


def tokens(normal: Column) -> Column:
    """Tokens of scientifically normalised text, in order."""
    return F.regexp_extract_all(normal, F.lit(TOKEN), F.lit(0))
