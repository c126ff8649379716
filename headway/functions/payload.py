"""Navigation of JSON payloads as VARIANT: types and presence, parsed once.

``from_json`` cannot tell a missing key from a null, nor a number from quoted
text; providers' rules depend on both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_NUMBER = r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)"


def parse(text: Column) -> Column:
    """JSON text to VARIANT; NULL when it does not parse."""
    return F.try_parse_json(text)


def with_document(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a parsed value that is computed once per row.

    A plain column would be copied into every later filter that is pushed below
    it, and each copy would parse the text again; a generator is not copied.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def extract(df: DataFrame, keep: list[str], **fields: Column) -> DataFrame:
    """The ``keep`` columns and the given fields."""
    return df.select(*keep, *[c.alias(name) for name, c in fields.items()])


def at(value: Column, path: str) -> Column:
    """Sub-value at ``a.b.c``: SQL NULL when missing, a VARIANT null when null."""
    return F.try_variant_get(value, _path(path), "variant")


def _path(path: str) -> str:
    return "$" + "".join(
        f"['{part}']" for part in path.split(".") if part)


def kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def is_object(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>").isNotNull()


def is_array(value: Column) -> Column:
    return elements(value).isNotNull()


def is_number(value: Column) -> Column:
    return F.coalesce(kind(value).rlike(_NUMBER), F.lit(False))


def is_absent(value: Column) -> Column:
    """Missing or null."""
    return value.isNull() | F.is_variant_null(value)


def elements(value: Column) -> Column:
    """Array elements as ``array<variant>``; NULL when the value is no array."""
    return F.try_variant_get(value, "$", "array<variant>")


def text(value: Column, path: str) -> Column:
    return F.try_variant_get(value, _path(path), "string")


def number(value: Column, path: str) -> Column:
    """A JSON number as double; quoted numbers and other types give NULL."""
    return F.when(is_number(at(value, path)), F.try_variant_get(value, _path(path), "double"))


def number_or_text(value: Column, path: str) -> Column:
    """A number or numeric text as double."""
    return F.try_variant_get(value, _path(path), "double")


def whole(value: Column, path: str) -> Column:
    """A number (cut to an integer) or integer text as bigint."""
    return F.try_variant_get(value, _path(path), "bigint")


def first_problem(*rules: tuple[Column, str]) -> Column:
    """Text of the first rule that is violated, NULL if none is."""
    reason = F.when(rules[0][0], rules[0][1])
    for broken, why in rules[1:]:
        reason = reason.when(broken, why)
    return reason


def required_path(value: Column, path: str) -> Column:
    """Reason why a required path is not there, NULL when it is.

    A present null passes; a missing key or a parent that is no object does not.
    """
    rules, walked = [], []
    for part in path.split("."):
        parent = at(value, ".".join(walked)) if walked else value
        rules.append((~is_object(parent),
                      f"expected object at '{'.'.join(walked)}'"))
        walked.append(part)
        rules.append((at(value, ".".join(walked)).isNull(),
                      f"missing required field '{'.'.join(walked)}'"))
    return first_problem(*rules)
