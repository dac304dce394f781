"""Identifiers, names and JSON text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from loyalpulse.rules import TAX_ID_WIDTH


def pad_id(value: Column | str) -> Column:
    """Tax id as text, zero-padded (and cut) to its fixed width; NULL stays NULL."""
    value = F.col(value) if isinstance(value, str) else value
    return F.lpad(value.cast("string"), TAX_ID_WIDTH, "0")


def tax_id(value: Column | str, padded: bool) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return pad_id(value) if padded else value.cast("string")


def first_token(value: Column | str) -> Column:
    return F.split_part(value, F.lit(" "), F.lit(1))


def quoted(values: Iterable[object]) -> str:
    """Comma-separated SQL literals of texts or numbers."""
    return ", ".join(
        str(v) if isinstance(v, int) else "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values
    )


def greeting(name: str, default: str) -> Column:
    """Upper-case first name, or ``default`` for a missing or blank one."""
    blank = F.col(name).isNull() | (F.trim(name) == "")
    return F.when(blank, F.lit(default)).otherwise(F.upper(first_token(name)))


def json_scalar(text: str, key: str) -> Column:
    """Top-level scalar of a JSON text; objects, arrays and bad JSON give NULL.

    Only values that look like a container pay for the second, typed parse, which
    tells the string "[x]" from the array [x].
    """
    value = f"get_json_object({text}, '$.{key}')"
    container = f"(startswith({value}, '{{') OR startswith({value}, '['))"
    typed = f"try_variant_get(try_parse_json({text}), '$.{key}', 'variant')"
    is_text = f"schema_of_variant({typed}) = 'STRING'"
    return F.expr(f"CASE WHEN NOT {container} OR {is_text} THEN {value} END")


def as_integer(value: str, strict: bool) -> Column:
    return F.col(value).cast("bigint") if strict else F.col(value).try_cast("bigint")
