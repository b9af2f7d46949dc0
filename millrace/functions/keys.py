"""Stable lookup keys and the attributes of the stand-in product source."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASH_CHARS = 16

# The two-character escapes JSON text uses for these characters.
SHORT_ESCAPES = {'"': '\\"', "\\": "\\\\", "\b": "\\b", "\t": "\\t", "\n": "\\n", "\f": "\\f", "\r": "\\r"}


def _escaped_char(char: Column) -> Column:
    units = F.lower(F.hex(F.encode(char, "UTF-16BE")))
    escaped = F.regexp_replace(units, "(.{4})", r"\\u$1")
    result = F.when(char.rlike(r"^[ -~]$"), char).otherwise(escaped)
    for raw, short in SHORT_ESCAPES.items():
        result = F.when(char == raw, F.lit(short)).otherwise(result)
    return result


def json_text(text: Column) -> Column:
    """``text`` as a JSON string in pure ASCII; other characters become lower-case \\u escapes."""
    plain = text.rlike(r"^[ !#-\[\]-~]*$")
    spelled = F.array_join(F.transform(F.split(text, ""), _escaped_char), "")
    return F.concat(F.lit('"'), F.when(plain, text).otherwise(spelled), F.lit('"'))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


SMALLEST_NORMAL = 2.0**-1022


def _shortest(size: Column) -> Column:
    """A positive number in exponent form with the fewest digits that give it back.

    Numbers that have fifteen digits or fewer show them when rounded to fifteen; only those below the
    normal ones can do with fewer than that shows.
    """

    def written(digits: int) -> Column:
        text = F.format_string(f"%.{digits - 1}e", size)
        return F.when(text.cast("double") == size, text)

    return F.coalesce(*[F.when(size < SMALLEST_NORMAL, written(n)) for n in range(1, 15)], written(15), written(16), F.format_string("%.16e", size))


def _written_out(digits: Column, exponent: Column) -> Column:
    """Digits d.ddd with an exponent, as Python writes them: plain from 1e-4 to below 1e16."""
    whole = F.rpad(digits, F.greatest(exponent + 1, F.length(digits)), "0")
    above = F.concat(F.substr(whole, F.lit(1), exponent + 1), F.lit("."), F.when(F.length(whole) > exponent + 1, F.substr(whole, exponent + 2)).otherwise("0"))
    below = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
    mantissa = F.concat(F.substr(digits, F.lit(1), F.lit(1)), F.when(F.length(digits) > 1, F.concat(F.lit("."), F.substr(digits, F.lit(2)))).otherwise(""))
    power = F.format_string("e%s%02d", F.when(exponent < 0, "-").otherwise("+"), F.abs(exponent))
    return F.when(exponent.between(0, 15), above).when(exponent.between(-4, -1), below).otherwise(F.concat(mantissa, power))


def float_text(value: Column) -> Column:
    """A double as Python prints it, ``NaN`` and ``Infinity`` included: the fewest digits that give it back."""

    def positive(text: Column) -> Column:
        parts = F.split(text, "e")
        digits = F.regexp_replace(F.translate(F.get(parts, F.lit(0)), ".", ""), "(?<=.)0+$", "")
        return _let(F.struct(digits.alias("digits"), F.get(parts, F.lit(1)).cast("int").alias("exponent")), lambda p: _written_out(p["digits"], p["exponent"]))

    def signed(x: Column) -> Column:
        # Minus zero shows its sign in its text only.
        sign = F.when(x.cast("string").startswith("-"), "-").otherwise("")
        size = F.abs(x)
        finite = F.when(size == 0, "0.0").otherwise(_let(_shortest(size), positive))
        return F.when(F.isnan(x), "NaN").otherwise(F.concat(sign, F.when(size == float("inf"), "Infinity").otherwise(finite)))

    return _let(value, signed)


def _time_text(value: Column, zoned: bool) -> Column:
    """A time as Python prints it: microseconds only where there are any, and the zone, which is UTC."""
    seconds = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
    micros = F.date_format(value, "SSSSSS")
    fraction = F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros))
    return F.concat(seconds, fraction, F.lit("+00:00" if zoned else ""))


def _joined(pieces: Column, opening: str, closing: str) -> Column:
    return F.concat(F.lit(opening), F.array_join(pieces, ","), F.lit(closing))


def _json_member(name: Column, value: Column) -> Column:
    return F.concat(json_text(name), F.lit(":"), value)


def _json_value(value: Column, data_type: T.DataType) -> Column:
    """A value as JSON by its type: structs and maps as objects with sorted names, arrays as lists."""
    if isinstance(data_type, T.StructType):
        fields = sorted(data_type.fields, key=lambda f: f.name)
        members = [_json_member(F.lit(f.name), _json_value(value.getField(f.name), f.dataType)) for f in fields]
        rendered = F.when(value.isNotNull(), _joined(F.array(*members) if members else F.array().cast("array<string>"), "{", "}"))
    elif isinstance(data_type, T.ArrayType):
        rendered = _joined(F.transform(value, lambda x: _json_value(x, data_type.elementType)), "[", "]")
    elif isinstance(data_type, T.MapType):
        if not isinstance(data_type.keyType, (T.StringType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            raise TypeError(f"the names of a lookup key's map are texts or whole numbers, not {data_type.keyType.simpleString()}")
        # Sorted as the keys are, numbers by their value, and written as text.
        entries = F.array_sort(F.transform(F.map_keys(value), lambda k: F.struct(k.alias("key"), F.element_at(value, k).alias("value"))))
        rendered = _joined(F.transform(entries, lambda e: _json_member(e["key"].cast("string"), _json_value(e["value"], data_type.valueType))), "{", "}")
    elif isinstance(data_type, T.StringType):
        rendered = json_text(value)
    elif isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        rendered = value.cast("string")
    elif isinstance(data_type, T.DoubleType):
        rendered = float_text(value)
    elif isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        rendered = json_text(_time_text(value, isinstance(data_type, T.TimestampType)))
    elif isinstance(data_type, (T.DateType, T.DecimalType)):
        rendered = json_text(value.cast("string"))
    elif isinstance(data_type, T.NullType):
        return F.lit("null")
    else:
        raise TypeError(f"a lookup key cannot hold {data_type.simpleString()}; cast it to double or text first")
    return F.coalesce(rendered, F.lit("null"))


def canonical_json(df: DataFrame, params: list[str]) -> Column:
    """Columns ``params`` of ``df`` as one JSON object: names sorted, no spaces, pure ASCII."""
    pieces = []
    for position, name in enumerate(sorted(params)):
        lead = "{" if position == 0 else ","
        pieces += [F.lit(lead), json_text(F.lit(name)), F.lit(":"), _json_value(F.col(name), df.schema[name].dataType)]
    return F.concat(*pieces, F.lit("}")) if pieces else F.lit("{}")


def lookup_key(df: DataFrame, prefix: str, name: str, params: list[str]) -> Column:
    """A key that is the same in every process: prefix, name and a hash of the parameters."""
    digest = F.substring(F.sha2(canonical_json(df, params), 256), 1, HASH_CHARS)
    return F.concat(F.lit(f"{prefix}{name}:"), digest)


def product_name(product_id: Column) -> Column:
    return F.concat(F.lit("product-"), product_id.cast("string"))


def product_price(product_id: Column) -> Column:
    """List price by formula: 10.99 plus seven times the id, modulo 90."""
    return F.round(F.lit(10) + F.pmod(product_id * 7, F.lit(90)) + F.lit(0.99), 2)
