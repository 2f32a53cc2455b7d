"""Column helpers with the null, JSON and calendar rules of the job-posting models."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .patterns import java

#: White space that trim() takes off: Spark's own takes blanks only.
BLANKS = " \t\n\r\x0b\x0c\x85\xa0" + "".join(map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
KEY_NULL = "_dbt_utils_surrogate_key_null_"
LOCAL_ZONE = "America/Denver"


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def trim(x: Column | str) -> Column:
    return F.btrim(col(x), F.lit(BLANKS))


def filled(x: Column | str) -> Column:
    """Trimmed text, null if nothing is left."""
    return F.nullif(trim(x), F.lit(""))


def divide(a: Column | str, b: Column | str) -> Column:
    """Quotient as double; null for a zero divisor."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def within(x: Column, low: float, high: float) -> Column:
    """x held between bounds; null stays null, where least() and greatest() would skip it."""
    return F.when(x.isNotNull(), F.least(F.lit(high), F.greatest(F.lit(low), x)))


def week_start(d: Column | str) -> Column:
    """The Sunday on or before a date."""
    return F.date_sub(col(d), F.dayofweek(col(d)) - 1)


def month_start(d: Column | str) -> Column:
    return F.trunc(col(d), "month")


def local_time(ts: Column | str) -> Column:
    """Civil time in Denver, with daylight saving, of a UTC instant."""
    return F.convert_timezone(F.lit("UTC"), F.lit(LOCAL_ZONE), col(ts).cast("timestamp_ntz"))


def matches(x: Column | str, pattern: str) -> Column:
    return F.regexp_like(col(x), F.lit(java(pattern)))


def captured(x: Column | str, pattern: str, group: int = 1) -> Column:
    """The group of the first match; null without a match."""
    return F.when(matches(x, pattern), F.regexp_extract(col(x), java(pattern), group))


def without(x: Column | str, pattern: str) -> Column:
    return F.regexp_replace(col(x), java(pattern), "")


def ladder(cases: list[tuple[Column, object]], otherwise: object = None) -> Column:
    """CASE WHEN in the order given."""
    out = F.lit(otherwise)
    for test, value in reversed(cases):
        out = F.when(test, value if isinstance(value, Column) else F.lit(value)).otherwise(out)
    return out


def surrogate_key(*columns: Column | str) -> Column:
    """Hash of the fields as text, joined by hyphens; a null has a text of its own."""
    return F.md5(F.concat_ws("-", *(F.coalesce(col(c).cast("string"), F.lit(KEY_NULL)) for c in columns)))


# -- JSON ---------------------------------------------------------------------


def json_kind(v: Column | str) -> Column:
    return F.schema_of_variant(col(v))


def is_container(v: Column) -> Column:
    return json_kind(v).startswith("OBJECT") | json_kind(v).startswith("ARRAY")


def json_tree(v: Column | str, path: str) -> Column:
    return F.try_variant_get(col(v), path, "variant")


def json_text(v: Column | str, path: str) -> Column:
    """Text of a scalar; null for objects, arrays, nulls and missing paths."""
    return F.when(~is_container(json_tree(v, path)), F.try_variant_get(col(v), path, "string"))


def json_strings(v: Column | str, path: str) -> Column:
    """The strings of an array in order; other elements are left out, and anything but an array is empty."""
    items = F.coalesce(F.try_variant_get(col(v), path, "array<variant>"), F.array().cast("array<variant>"))
    return F.transform(F.filter(items, lambda x: json_kind(x) == "STRING"), lambda x: x.cast("string"))


# -- text ---------------------------------------------------------------------

# Marks that give way to their ASCII forms.
_QUOTES = "‘’‚‛“”„‟"
_DASHES = "‐‑‒–—―−"
_FROM, _TO = _QUOTES + _DASHES + "\xa0", "'" * 4 + '"' * 4 + "-" * 7 + " "


@F.pandas_udf(T.StringType())
def _nfkc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _nfkc_each(texts: pd.Series) -> pd.Series:
    return texts.map(lambda a: None if a is None else [None if x is None else unicodedata.normalize("NFKC", x) for x in a])


# Ranges of signs that stay as they are and join no neighbour under NFKC: ASCII, the letters and most marks of the languages
# of western and central Europe, general quotes and dashes, the euro.
STABLE = r"\x00-\x7F\u00A1-\u00A7\u00A9\u00AB-\u00AE\u00B0\u00B1\u00B6\u00B7\u00BB\u00BF-\u0131\u0134-\u013E\u0141-\u0148\u014A-\u017E\u2010\u2012-\u2015\u2018-\u2022\u20AC"


def _plain(x: Column) -> Column:
    """A quick check: whether NFKC leaves a text as it is, told from its signs alone."""
    return F.regexp_like(x, F.lit(f"^[{STABLE}]*+$"))


def _folded(x: Column) -> Column:
    return trim(F.regexp_replace(F.translate(F.lower(x), _FROM, _TO), r"[\s\p{Z}]+", " "))


def normalized(x: Column | str) -> Column:
    """Compatibility-composed lower case with plain quotes, dashes and single blanks. Null stays null.

    Only texts with signs beyond STABLE go to Python.
    """
    x = col(x)
    return _folded(F.coalesce(_nfkc(F.when(~_plain(x), x)), x))


def normalized_each(texts: Column) -> Column:
    """normalized() for each element of an array."""
    odd = F.exists(texts, lambda x: ~_plain(x))
    return F.transform(F.coalesce(_nfkc_each(F.when(odd, texts)), texts), _folded)
