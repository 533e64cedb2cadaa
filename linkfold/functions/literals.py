"""Literal URLs and tagged scalars, as Columns.

A scalar is a struct (kind, s, n, b) with kind 's', 'n' or 'b'; a null struct is no value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C
from ..schema import EVAL

#: Parts of a datatype's name by which it counts as numeric. Fixed values.
NUMERIC = ("integer", "decimal", "double", "float", "long", "int")


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def text_value(s) -> Column:
    s = _col(s)
    return F.when(s.isNotNull(), F.struct(F.lit("s").alias("kind"), s.alias("s"), F.lit(None).cast("double").alias("n"), F.lit(None).cast("boolean").alias("b")))


def number_value(n) -> Column:
    n = _col(n).cast("double")
    return F.when(n.isNotNull(), F.struct(F.lit("n").alias("kind"), F.lit(None).cast("string").alias("s"), n.alias("n"), F.lit(None).cast("boolean").alias("b")))


def flag_value(b) -> Column:
    b = _col(b)
    return F.when(b.isNotNull(), F.struct(F.lit("b").alias("kind"), F.lit(None).cast("string").alias("s"), F.lit(None).cast("double").alias("n"), b.alias("b")))


def no_value() -> Column:
    return F.lit(None).cast(EVAL)


def percent_encode(s) -> Column:
    """UTF-8 bytes but A-Z a-z 0-9 - _ . ~ as %XX."""
    e = F.replace(F.url_encode(_col(s)), F.lit("+"), F.lit("%20"))
    return F.replace(F.replace(e, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def percent_decode(s) -> Column:
    """The reverse; null for a broken escape."""
    return F.try_url_decode(F.replace(_col(s), F.lit("+"), F.lit("%2B")))


def number_text(n) -> Column:
    """A number as ECMAScript prints it: no point after whole numbers, exponents from 1e21 on and below 1e-6."""
    n = _col(n).cast("double")
    a = F.abs(n)
    text = n.cast("string")  # the shortest digits that give the number back, as d.ddE±x or plain
    digits = F.regexp_replace(F.regexp_extract(text, r"^-?([0-9.]+)", 1), r"\.0$", "")
    power = F.regexp_extract(text, r"E(-?[0-9]+)$", 1)
    sign = F.when(n < 0, F.lit("-")).otherwise(F.lit(""))
    mantissa = F.replace(digits, F.lit("."), F.lit(""))
    shift = power.cast("int")
    # small numbers with an exponent are written out: zeros, then the digits
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -shift - 1), mantissa)
    large = F.concat(sign, F.rpad(mantissa, F.greatest(shift + 1, F.length(mantissa)), "0"))
    broad = F.concat(sign, F.substring(mantissa, 1, 1), F.when(F.length(mantissa) > 1, F.concat(F.lit("."), mantissa.substr(F.lit(2), F.length(mantissa)))).otherwise(F.lit("")), F.lit("e"), F.when(shift > 0, F.lit("+")).otherwise(F.lit("")), power)
    mid = F.concat(sign, mantissa.substr(F.lit(1), shift + 1), F.lit("."), mantissa.substr(shift + 2, F.length(mantissa)))
    return (
        F.when(F.isnan(n), F.lit("NaN"))
        .when(a == float("inf"), F.concat(sign, F.lit("Infinity")))
        .when(n == 0, F.lit("0"))
        .when(power == "", F.concat(sign, digits))
        .when((a >= 1e21) | (a < 1e-6), broad)
        .when(shift < 0, small)
        .when(F.length(mantissa) > shift + 1, mid)
        .otherwise(large)
    )


def to_number(s) -> Column:
    """Text as a number the way ECMAScript's Number() reads it; null if it is none. Empty text is 0; 0x, 0o and 0b work."""
    t = F.regexp_replace(_col(s), r"^[\s\x{FEFF}\x{A0}]+|[\s\x{FEFF}\x{A0}]+$", "")
    radix = lambda p, b: F.conv(F.regexp_extract(t, p, 1), b, 10).try_cast("double")
    return (
        F.when(t == "", F.lit(0.0))
        .when(t.rlike(r"^[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?)$"), t.try_cast("double"))
        .when(t.rlike(r"^[+-]?Infinity$"), F.when(F.startswith(t, F.lit("-")), F.lit(float("-inf"))).otherwise(F.lit(float("inf"))))
        .when(t.rlike(r"^0[xX][0-9a-fA-F]+$"), radix(r"^0[xX](.*)$", 16))
        .when(t.rlike(r"^0[oO][0-7]+$"), radix(r"^0[oO](.*)$", 8))
        .when(t.rlike(r"^0[bB][01]+$"), radix(r"^0[bB](.*)$", 2))
    )


def parse_float(s) -> Column:
    """The number that a text starts with, NaN if it starts with none."""
    head = F.regexp_extract(_col(s), r"^\s*([+-]?(?:Infinity|(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?))", 1)
    return F.when(head == "", F.lit(float("nan"))).otherwise(F.coalesce(head.try_cast("double"), F.lit(float("nan"))))


def is_literal(u) -> Column:
    return F.startswith(_col(u), F.lit("literal:"))


def encode_text(s) -> Column:
    return F.concat(F.lit("literal:string:"), percent_encode(s))


def encode_number(n) -> Column:
    return F.concat(F.lit("literal:number:"), percent_encode(number_text(n)))


def encode_flag(b) -> Column:
    return F.concat(F.lit("literal:boolean:"), _col(b).cast("string"))


def encode_json(j) -> Column:
    """j is JSON text."""
    return F.concat(F.lit("literal:json:"), percent_encode(j))


def encode_value(v) -> Column:
    """A scalar as a literal URL."""
    v = _col(v)
    return F.when(v["kind"] == "s", encode_text(v["s"])).when(v["kind"] == "n", encode_number(v["n"])).when(v["kind"] == "b", encode_flag(v["b"]))


def _named(datatype, names) -> Column:
    d = F.lower(F.coalesce(_col(datatype), F.lit("")))
    hit = F.lit(False)
    for name in names:
        hit = hit | F.contains(d, F.lit(name))
    return hit


def typed(s, datatype) -> Column:
    """Text with a datatype as a scalar: a number or boolean if the datatype says so and the text is one, else text."""
    s = _col(s)
    n = to_number(s)
    return (
        F.when(_named(datatype, NUMERIC) & n.isNotNull(), number_value(n))
        .when(_named(datatype, ("boolean",)) & s.isin("true", "false"), flag_value(s == "true"))
        .otherwise(text_value(s))
    )


def encode_typed(v, datatype) -> Column:
    """A scalar as a literal URL; text goes by the datatype."""
    v = _col(v)
    return F.when(v["kind"] == "s", encode_value(typed(v["s"], datatype))).otherwise(encode_value(v))


def decode(u) -> Column:
    """A literal URL as a scalar. JSON comes as text; what is no literal URL, or of unknown kind, is text as it stands."""
    u = _col(u)
    body = F.regexp_replace(u, r"^literal:(//)?", "")
    part = lambda name: F.startswith(body, F.lit(name + ":"))
    rest = F.regexp_replace(body, r"^[a-z]+:", "")
    return (
        F.when(u.isNull(), no_value())
        .when(~is_literal(u), text_value(u))
        .when(part("string"), text_value(percent_decode(rest)))
        .when(part("number"), number_value(parse_float(rest)))
        .when(part("boolean"), flag_value(F.coalesce(percent_decode(rest) == "true", F.lit(False))))
        .when(part("json"), _json_value(percent_decode(rest)))
        .otherwise(text_value(u))
    )


def _json_value(j: Column) -> Column:
    """A JSON text: scalars by kind, null as no value, objects and arrays as their text."""
    t = F.trim(j)
    text = F.get_json_object(F.concat(F.lit('{"v":'), t, F.lit("}")), "$.v")
    return (
        F.when(t == "null", no_value())
        .when(t.isin("true", "false"), flag_value(t == "true"))
        .when(F.startswith(t, F.lit('"')), text_value(text))
        .when(t.rlike(r"^-?[0-9]"), number_value(t.try_cast("double")))
        .otherwise(text_value(text))
    )


def value_text(v) -> Column:
    """A scalar as text."""
    v = _col(v)
    return F.when(v["kind"] == "s", v["s"]).when(v["kind"] == "n", number_text(v["n"])).when(v["kind"] == "b", v["b"].cast("string"))


def value_is_uri(v) -> Column:
    """True for text that stands for a resource."""
    v = _col(v)
    return F.coalesce((v["kind"] == "s") & (v["s"].rlike(r"(?i)^[a-z][a-z0-9+.\-]*://") | F.startswith(v["s"], F.lit("did:"))), F.lit(False))


def value_datatype(v) -> Column:
    """The datatype that a scalar is written with; null for text."""
    v = _col(v)
    return F.when(v["kind"] == "n", F.when((v["n"] == F.floor(v["n"])) & (F.abs(v["n"]) < float("inf")), F.lit(C.XSD_INTEGER)).otherwise(F.lit(C.XSD_DECIMAL))).when(v["kind"] == "b", F.lit(C.XSD_BOOLEAN))


def decode_term(object="object", is_literal="object_is_literal", datatype="object_datatype") -> Column:
    """The object of a triple as a scalar."""
    return F.when(_col(is_literal), typed(object, datatype)).otherwise(text_value(object))
