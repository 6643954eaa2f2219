"""Scalar functions on payload values and names."""

from __future__ import annotations

import gzip
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

#: Exponents beyond this would make a text of as many zeros.
MAX_EXPONENT = 100_000


def plain_decimal(value: Column) -> Column:
    """A number's text without exponent and trailing zeros, exactly; null if it is no number or its exponent is beyond MAX_EXPONENT."""
    form = r"^\s*([+-]?)([0-9]*)\.?([0-9]*)(?:[eE]([+-]?[0-9]{1,9}))?\s*$"
    part = lambda k: F.regexp_extract(value, form, k)
    exponent = F.coalesce(F.nullif(part(4), F.lit("")).cast("int"), F.lit(0))
    digits, point = F.concat(part(2), part(3)), F.length(part(2)) + exponent
    padded = F.concat(F.repeat(F.lit("0"), F.greatest(-point, F.lit(0))), digits, F.repeat(F.lit("0"), F.greatest(point - F.length(digits), F.lit(0))))
    at = F.greatest(point, F.lit(0))
    whole = F.regexp_replace(padded.substr(F.lit(1), at), "^0+", "")
    rest = F.regexp_replace(padded.substr(at + 1, F.length(padded)), "0+$", "")
    text = F.concat(F.when(whole == "", "0").otherwise(whole), F.when(rest == "", "").otherwise(F.concat(F.lit("."), rest)))
    signed = F.when((part(1) == "-") & (text != "0"), F.concat(F.lit("-"), text)).otherwise(text)
    return F.when(value.rlike(form) & (digits != "") & (F.abs(exponent) <= MAX_EXPONENT), signed)


def canonical_json(value: Column) -> Column:
    """JSON text with sorted keys, for comparison; null if it is no JSON."""
    return F.to_json(F.try_parse_json(value))


#: A JSON text's tokens.
TOKEN = r'("(?:[^"\\]|\\.)*"|-?[0-9][0-9.eE+-]*|true|false|null|[\[\]{},:])'


def canonical_value(value: Column) -> Column:
    """JSON text in which equal values are equal texts: keys sorted, numbers exact and without exponent, as strings; null if it is no JSON."""
    tokens = F.regexp_extract_all(value, F.lit(TOKEN), 1)
    plain = F.transform(tokens, lambda t: F.when(t.rlike("^-?[0-9]"), F.concat(F.lit('"'), plain_decimal(t), F.lit('"'))).otherwise(t))
    return F.when(F.try_parse_json(value).isNotNull(), F.to_json(F.try_parse_json(F.array_join(plain, ""))))


def same_value(a: Column, b: Column) -> Column:
    """Whether two JSON texts hold the same value, at any depth: numbers equal their text, keys come in any order."""
    return F.equal_null(canonical_value(a), canonical_value(b)) & (a.isNull() == b.isNull())


#: What shorter values aren't worth compressing, and how a compressed one starts.
GZIP_OVER, GZIP_MAGIC = 1024, b"\x1f\x8b"


@pandas_udf(T.BinaryType())
def gzip_value(value: pd.Series) -> pd.Series:
    """Bytes compressed if they are long and that makes them shorter, without a time in them; others as they are."""

    def pack(raw: bytes | None) -> bytes | None:
        if raw is None or len(raw) <= GZIP_OVER:
            return raw
        small = gzip.compress(raw, mtime=0)
        return small if len(small) < len(raw) else raw

    return value.map(pack)


@pandas_udf(T.BinaryType())
def gunzip_value(value: pd.Series) -> pd.Series:
    """Bytes as they were before gzip_value; what doesn't start like compressed ones stays. Broken ones are an error."""
    return value.map(lambda raw: gzip.decompress(raw) if raw is not None and raw[:2] == GZIP_MAGIC else raw)


def same_scalar(a: Column, b: Column, a_type: Column, b_type: Column) -> Column:
    """Equality of values given as text with a JSON type: numbers equal their text, booleans only booleans, null only null."""
    loose = lambda t: t.isin("number", "string")
    return F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).otherwise((a == b) & ((a_type == b_type) | (loose(a_type) & loose(b_type))))


def hex_bytes(value: Column) -> Column:
    """Bytes of a `\\x..` text, null for any other."""
    return F.when(value.rlike(r"^\\x([0-9A-Fa-f]{2})*$"), F.unhex(F.substring(value, 3, 2**31 - 1)))


def bit_number(value: Column) -> Column:
    """The number that a text of bits stands for."""
    return F.conv(value, 2, 10).cast("long")


def uuid_bytes(value: Column) -> Column:
    return F.unhex(F.replace(value, F.lit("-"), F.lit("")))


def _or_error(fits: Column, value: Column, text: Column, kind: str) -> Column:
    """The value; null for a null text, an error for one of another form."""
    broken = F.raise_error(F.concat(F.lit(f"no {kind}: "), text))
    return F.when(text.isNull(), F.lit(None)).when(fits, value).otherwise(broken)


def typed_text(value: Column, kind: str) -> Column:
    """A text as a column type of a target database wants it, an error if its form is another: RAW(16) of a UUID, TIMESTAMP(n), with or without zone, DATE.

    Times keep microseconds. Other types leave the text as it is.
    """
    if kind == "RAW(16)":
        bare = F.regexp_replace(value, r"^(?:\\x|urn:uuid:|\{)|\}$", "")
        fits = bare.rlike("^(?:[0-9A-Fa-f]{32}|[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12})$")
        return _or_error(fits, F.unhex(F.replace(bare, F.lit("-"), F.lit(""))), value, "UUID")
    clock, zone = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]+)?", r"(?:Z|[+-][0-9]{2}:[0-9]{2})$"
    if re.fullmatch(r"TIMESTAMP\([0-9]+\) WITH TIME ZONE", kind):
        return _or_error(value.rlike(clock + zone), value.cast("timestamp"), value, "time with a zone")
    if re.fullmatch(r"TIMESTAMP\([0-9]+\)", kind):
        zoned = F.when(value.rlike(zone), value).otherwise(F.concat(value, F.lit("Z")))
        return _or_error(zoned.rlike(clock + zone), zoned.cast("timestamp"), value, "time")
    if kind == "DATE":
        return _or_error(value.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), value.cast("date"), value, "date")
    return value


def raw_parts(name: Column) -> Column:
    """Parts of a dotted name as they are written; double quotes enclose parts and double themselves."""
    parts = F.regexp_extract_all(name, F.lit(r'("(?:[^"]|"")*"|[^".]+)'), 1)
    return F.transform(parts, lambda p: F.when(p.startswith('"'), F.replace(F.regexp_replace(p, '^"|"$', ""), F.lit('""'), F.lit('"'))).otherwise(p))


def name_parts(name: Column) -> Column:
    """Parts of a dotted name, lower-cased for comparison."""
    return F.transform(raw_parts(name), F.lower)


def staging_name(name: Column) -> Column:
    """A table's staging name: its parts in lower case, joined by underscores."""
    return F.array_join(name_parts(name), "_")


def table_of_path(path: Column) -> Column:
    """The table in an object's file name, null if the name has another form."""
    found = F.regexp_extract(path, r"(?:^|/)(?:[^-/]+-){5}([^/]+)-[^-/]+\.ndjson$", 1)
    return F.when(found != "", found)
