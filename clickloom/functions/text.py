"""Text helpers, all built from Spark's own expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def concat_long_string(number: Column, text: Column, sep: str = ":") -> Column:
    """``number + sep + text``; a missing part is printed as ``null``."""
    return F.concat(
        F.coalesce(number.cast("string"), F.lit("null")),
        F.lit(sep),
        F.coalesce(text, F.lit("null")),
    )


def json_field(doc: Column, field: str) -> Column:
    """Top-level field of a JSON text by its bare name; NULL on broken JSON."""
    return F.get_json_object(doc, f"$.{field}")


def random_prefix(value: Column, n: int = 10, seed: int = 9) -> Column:
    """Put one of ``n`` random number prefixes before a key: ``7_key``."""
    return F.concat(F.floor(F.rand(seed) * n).cast("string"), F.lit("_"), value.cast("string"))


def remove_random_prefix(value: Column) -> Column:
    """Undo :func:`random_prefix`; underscores inside the key stay."""
    return F.regexp_replace(value, "^[0-9]+_", "")


def is_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) == ""


def is_not_empty(text: Column) -> Column:
    return ~is_empty(text)


def trim_comma(text: Column) -> Column:
    """Take one comma off each end."""
    return F.regexp_replace(text, "^,|,$", "")


def pad_two(text: Column) -> Column:
    """Put a zero before any text that is not two characters long."""
    return F.when(F.length(text) == 2, text).otherwise(F.concat(F.lit("0"), text))


def _packed(text: Column) -> Column:
    """``k=v|k=v`` as an array of (k, v); pieces without exactly one value are left out. Empty
    parts at the end of a piece do not count."""
    pairs = F.transform(
        F.split(text, r"\|"), lambda piece: F.split(F.regexp_replace(piece, "=+$", ""), "=")
    )
    return F.filter(pairs, lambda p: (F.size(p) == 2) & (p[1] != ""))


def packed_field(text: Column, field: str) -> Column:
    """Value of a field in a ``k=v|k=v`` text, NULL when missing or empty."""
    hit = F.filter(_packed(text), lambda p: p[0] == field)
    return F.try_element_at(F.try_element_at(hit, F.lit(1)), F.lit(2))


def set_packed_field(text: Column, field: str, value: Column) -> Column:
    """Replace the value of the first piece with that name in a ``k=v|k=v`` text."""
    pieces = F.split(text, r"\|")
    first = F.array_position(F.transform(pieces, lambda p: F.split(p, "=")[0]), F.lit(field))
    replaced = F.transform(
        pieces,
        lambda p, i: F.when(i + 1 == first, F.concat(F.lit(field + "="), value)).otherwise(p),
    )
    return F.array_join(replaced, "|")


def group_concat_distinct(column: str) -> Column:
    """Distinct values of a group in order, joined by commas (an aggregate).

    The DISTINCT form makes Spark remove duplicates in a shuffle of its own, keyed by group and
    value, before anything is joined together, so a hot group is deduplicated by many tasks.
    """
    return F.expr(f"listagg(DISTINCT `{column}`, ',') WITHIN GROUP (ORDER BY `{column}`)")
