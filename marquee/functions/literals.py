"""Nested columns stored as Python-literal text: ``[{'id': 1, 'name': "x"}]``.

Text that follows the flat grammar below means the same to a JSON reader after
two plain replacements (``None`` and ``\\xNN``), so it is parsed inside the JVM.
Anything else goes, as the only non-null input, to one Arrow UDF around
``ast.literal_eval``.  Parsed entries are ``map<string,string>``, which keeps a
missing key apart from a key whose value is null.
"""

from __future__ import annotations

import ast
import json
from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The grammar is tested after ``': None`` has become ``': null``.  A string that may
# have been changed by that does not match.  All quantifiers are possessive: no
# backtracking and no recursion on long text.
_ESCAPE = r"""\\(?:[\\nrtbf]|['"](?!: null)|x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4})"""


def _flat_list(other: str = "") -> str:
    """The grammar of a list; its strings hold none of the ``other`` characters."""
    plain = rf"""[^"'\\{other}]*+"""
    string = (
        rf"""(?:'(?!: null){plain}(?:(?:{_ESCAPE}|"(?!: null)){plain})*+'"""
        rf"""|"(?!: null){plain}(?:(?:{_ESCAPE}|'(?!: null)){plain})*+")"""
    )
    value = rf"(?:{string}|null|-?(?:0|[1-9][0-9]{{0,17}}))"
    pair = rf"{string}: {value}"
    entry = rf"\{{(?:{pair}(?:, {pair})*+)?+\}}"
    return rf"^\[(?:{entry}(?:, {entry})*+)?+\]$"


_FLAT_LIST = _flat_list()
# A piece ends at its first closing brace and holds no line break of any kind.
_PLAIN_LIST = _flat_list(r"}\x{85}\x{2028}\x{2029}")
_HEX_ESCAPE = r"(?<!\\)((?:\\\\)*+)\\x([0-9a-fA-F]{2})"

_JSON_OPTIONS = {
    "allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true",
    "allowUnquotedControlChars": "true",
}
_ENTRIES = T.ArrayType(T.MapType(T.StringType(), T.StringType()))


def _with_nulls(text: Column) -> Column:
    out = text
    for quote in "'\"":
        out = F.replace(out, F.lit(f"{quote}: None"), F.lit(f"{quote}: null"))
    # Replacing tries every place of a text; most texts have nothing to replace.
    return F.when(text.contains(": None"), out).otherwise(text)


def _is_flat(text: Column, replaced: Column, grammar: str = _FLAT_LIST) -> Column:
    """``text`` is the original, ``replaced`` the one with nulls."""
    odd = F.lit(False)
    for piece in ("': null", '": null', "\n", "\r", "\x00"):
        odd = odd | text.contains(piece)
    return ~odd & replaced.rlike(grammar)


def _as_json(replaced: Column) -> Column:
    return F.when(
        replaced.contains("\\x"), F.regexp_replace(replaced, _HEX_ESCAPE, r"$1\\u00$2")
    ).otherwise(replaced)


def _entry_value(key, value):
    if value is None or isinstance(value, str):
        return value
    if key == "id" and isinstance(value, (bool, float)):
        return str(int(value))
    if isinstance(value, (dict, list, tuple)):
        return json.dumps(value, default=str)
    return str(value)


def _dump(value) -> str | None:
    """JSON for a literal list of dicts; None for every other shape."""
    if not isinstance(value, (list, tuple, dict, str, bytes, set)):
        return None
    entries = list(value)
    if not all(isinstance(entry, dict) for entry in entries):
        return None
    return json.dumps([{str(k): _entry_value(k, v) for k, v in e.items()} for e in entries])


def _evaluate(text: str | None) -> str | None:
    if text is None:
        return None
    try:
        return _dump(ast.literal_eval(text.lstrip(" \t")))
    except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError, OverflowError):
        return None


def _evaluator(names: list[str], objects) -> Callable[[Column], Column]:
    """Column function: for each name its texts (null: nothing to do) -> one JSON list.

    A list or dict is one text, and null if it can't be read; ``objects`` are many texts, of
    which those that can't be read are left out.
    """
    lenient = [name in objects for name in names]

    def one(texts: list[str] | None, many: bool) -> str | None:
        if texts is None:
            return None
        read = [_evaluate(text) for text in texts]
        if not many:
            return read[0]
        return "[" + ", ".join(text[1:-1] for text in read if text and text != "[]") + "]"

    @F.arrow_udf("array<string>")
    def evaluate(rows: pa.Array) -> pa.Array:
        return pa.array([[one(*x) for x in zip(row, lenient)] if row else None
                         for row in rows.to_pylist()], pa.list_(pa.string()))

    return evaluate


def with_literals(df: DataFrame, lists=(), dicts=(), objects=()) -> DataFrame:
    """Adds ``_<name>``, an array of parsed entries, for each named text column.

    ``lists`` hold a list of dicts: empty text gives an empty array, unparsable
    text null.  ``dicts`` hold one dict and are read as a list of one.  Of
    ``objects`` every ``{...}`` piece is parsed on its own and bad pieces are left out; a text
    that is a list of such pieces and has no braces in its strings needn't be taken apart for that.

    The steps are separate projections so that Spark computes each text once; what the
    grammar doesn't cover goes to Python in one step for all columns, as an empty list for a row
    that has nothing of the kind.
    """
    names = [*lists, *dicts, *objects]
    whole = {c: F.coalesce(F.col(c), F.lit("")) for c in names}
    if objects:
        df = df.withColumns({f"_w_{c}": whole[c] for c in objects})
        df = df.withColumns({f"_m_{c}": _with_nulls(F.col(f"_w_{c}")) for c in objects})
        df = df.withColumns({
            f"_g_{c}": _is_flat(F.col(f"_w_{c}"), F.col(f"_m_{c}"), _PLAIN_LIST) for c in objects})
    texts = {  # what is read one by one
        **{c: F.array(F.when(whole[c] == "", "[]").otherwise(whole[c])) for c in lists},
        **{c: F.array(F.concat(F.lit("["), whole[c], F.lit("]"))) for c in dicts},
        **{c: F.when(F.col(f"_g_{c}"), F.array().cast("array<string>")).otherwise(
            F.regexp_extract_all(F.col(f"_w_{c}"), F.lit(r"(\{[^}\n\r\x{85}\x{2028}\x{2029}]*+\})"), F.lit(1)))
           for c in objects},
    }
    df = df.withColumns({f"_p_{c}": texts[c] for c in names})
    df = df.withColumns({
        f"_t_{c}": F.when(F.col(f"_g_{c}"), F.lit("")).otherwise(
            F.concat(F.lit("["), F.array_join(f"_p_{c}", ", "), F.lit("]"))) if c in objects
        else F.col(f"_p_{c}")[0] for c in names})
    df = df.withColumns({
        f"_n_{c}": F.when(F.col(f"_g_{c}"), F.col(f"_m_{c}")).otherwise(_with_nulls(F.col(f"_t_{c}"))) if c in objects
        else _with_nulls(F.col(f"_t_{c}")) for c in names})
    df = df.withColumns({
        f"_f_{c}": F.col(f"_g_{c}") | _is_flat(F.col(f"_t_{c}"), F.col(f"_n_{c}")) if c in objects
        else _is_flat(F.col(f"_t_{c}"), F.col(f"_n_{c}")) for c in names})
    pieces = F.array(*[F.when(~F.col(f"_f_{c}"), F.transform(
        f"_p_{c}", lambda p: F.concat(F.lit("["), p, F.lit("]"))) if c in objects else F.col(f"_p_{c}"))
        for c in names])
    flat = reduce(lambda a, b: a & b, [F.col(f"_f_{c}") for c in names])
    # Nothing is an empty list: with null ones Spark goes over all earlier rows of a batch to size it.
    df = df.withColumn("_e", _evaluator(names, objects)(F.when(flat, F.array()).otherwise(pieces)))
    df = df.withColumns({
        f"_j_{c}": F.when(F.col(f"_f_{c}"), _as_json(F.col(f"_n_{c}"))).otherwise(F.col("_e")[k])
        for k, c in enumerate(names)})
    df = df.withColumns({f"_{c}": F.from_json(f"_j_{c}", _ENTRIES, _JSON_OPTIONS) for c in names})
    return df.drop("_e", *[f"_{k}_{c}" for k in "wmgtpnfj" for c in names])


def entry_struct(entry: Column, schema: T.StructType) -> Column:
    """Typed struct from a parsed entry; values that do not fit become null."""
    return F.struct(*[
        entry[field.name].try_cast(field.dataType).alias(field.name) for field in schema
    ])


def has_keys(entry: Column, names) -> Column:
    present = F.lit(True)
    for name in names:
        present = present & F.map_contains_key(entry, name)
    return present


def has_exact_keys(entry: Column, names) -> Column:
    """These keys and no others.  Entries mostly have them in order, which one comparison tells."""
    in_order = F.map_keys(entry) == F.array(*[F.lit(name) for name in names])
    return in_order | ((F.size(entry) == len(names)) & has_keys(entry, names))
