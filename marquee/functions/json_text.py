"""JSON held as text: repair, structure, required keys, canonical form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_json(text: Column) -> Column:
    """One complete JSON value and nothing after it.

    Spark's parsers stop at the end of the first value, so the text is parsed as
    a field of an object that ends with a field of our own.
    """
    wrapped = F.concat(F.lit('{"_text":'), text, F.lit(',"_end_of_text":0}'))
    fields = F.array(F.lit("_text"), F.lit("_end_of_text"))
    whole = F.try_parse_json(wrapped).isNotNull() & (F.json_object_keys(wrapped) == fields)
    return F.coalesce(whole, F.lit(False))


def _count(text: Column, char: str) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(char), F.lit("")))


def repair_json(text: Column) -> Column:
    """Drop trailing commas, then close open braces and, after them, brackets."""
    tidy = F.replace(F.replace(text, F.lit(",}"), F.lit("}")), F.lit(",]"), F.lit("]"))
    braces = F.greatest(F.lit(0), _count(tidy, "{") - _count(tidy, "}"))
    brackets = F.greatest(F.lit(0), _count(tidy, "[") - _count(tidy, "]"))
    return F.concat(tidy, F.repeat(F.lit("}"), braces), F.repeat(F.lit("]"), brackets))


def json_kind(text: Column) -> Column:
    """object, array, string, number, boolean or null; SQL null if not JSON."""
    first = F.substring(F.ltrim(text), 1, 1)
    kind = (
        F.when(first == "{", "object").when(first == "[", "array")
        .when(first == '"', "string").when(first.isin("t", "f"), "boolean")
        .when(first == "n", "null").otherwise("number")
    )
    return F.when(is_json(text), kind)


def missing_keys(text: Column, required) -> Column:
    """Required top-level keys that the JSON object lacks; all of them when the
    text is not an object."""
    wanted = F.array(*[F.lit(key) for key in required])
    keys = F.when(json_kind(text) == "object", F.json_object_keys(text))
    return F.array_except(wanted, F.coalesce(keys, F.array().cast("array<string>")))


def canonical_json(value: Column) -> Column:
    """Key-sorted JSON text of JSON text; null if it does not parse."""
    return F.when(is_json(value), F.to_json(F.try_parse_json(value)))


def normalized(value: Column, dtype: T.DataType, digits: int = 4) -> Column:
    """Order-insensitive form of a nested value, built from its schema: texts
    trimmed, floats rounded, lists ordered by their JSON text, maps and struct
    fields ordered by key.  Of map keys that are equal in this form one stays, with
    the smallest value."""
    if isinstance(dtype, T.StringType):
        return F.trim(value, F.lit(" \t\r\n\f\v"))
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.bround(value, digits)
    if isinstance(dtype, T.ArrayType):
        items = F.transform(value, lambda item: normalized(item, dtype.elementType, digits))
        keyed = F.transform(items, lambda item: F.struct(
            F.to_json(F.struct(item.alias("v"))).alias("k"), item.alias("v")))
        return F.transform(F.array_sort(keyed), lambda pair: pair["v"])
    if isinstance(dtype, T.MapType):
        entries = F.transform(F.map_entries(value), lambda e: F.struct(
            normalized(e["key"], dtype.keyType, digits).alias("k"),
            normalized(e["value"], dtype.valueType, digits).alias("v")))

        def unlike(pairs: Column) -> Column:
            return F.filter(pairs, lambda e, i: (i == 0) | (e["k"] != F.get(pairs, i - 1)["k"]))

        # As the one item of an array the entries are ordered once.
        return F.transform(F.array(F.array_sort(entries)), lambda pairs: F.map_from_entries(unlike(pairs)))[0]
    if isinstance(dtype, T.StructType):
        fields = sorted(dtype.fields, key=lambda field: field.name)
        built = F.struct(*[
            normalized(value[f.name], f.dataType, digits).alias(f.name) for f in fields])
        return F.when(value.isNotNull(), built)
    return value
