"""Checks of JSON documents against a schema document, as native expressions over VARIANT values.

The schema document is a JSON schema with ``type``, ``properties``, ``required``, ``enum``, ``minimum``, ``maximum``,
``items`` (their type) and ``format: date-time``. Every fault of a document gives a reason, in the order of the
schema, such as ``priority is missing`` or ``location.latitude is no number``. What stands below a value that is
missing or of the wrong type is not looked at. A document is parsed once, whatever the number of rules.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASONS = "reasons"


def _is(kind: Column, wanted: str) -> Column:
    """Whether the text that ``schema_of_variant`` gives for a type is one of the schema document's type ``wanted``."""
    if wanted in ("object", "array"):
        return kind.startswith(wanted.upper())
    if wanted in ("number", "integer"):
        return kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    return kind == {"string": "STRING", "boolean": "BOOLEAN"}[wanted]


def _fits(document: Column, path: str, kind: Column, wanted: str) -> Column:
    """Whether the value at ``path``, of the variant type ``kind``, is of the type ``wanted``."""
    matches = _is(kind, wanted)
    if wanted == "integer":  # 5.0 is an integer too
        number = F.try_variant_get(document, path, "double")
        matches = matches & (number == F.floor(number))
    return F.coalesce(matches, F.lit(False))


def _item_misfits(wanted: str, item: Column) -> Column:
    return ~_fits(item, "$", F.schema_of_variant(item), wanted)


def _apart(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that come out of a generator: the optimizer can't put their expressions in the
    place of their names, where each use would evaluate them again.

    A projection below the generator makes them, by generated code; a generator may interpret what it is given.
    """
    below = df.select("*", *[value.alias(f"_made {name}") for name, value in columns.items()])
    made = F.struct(*[F.col(f"`_made {name}`").alias(name) for name in columns])
    return below.select(*[F.col(f"`{name}`") for name in df.columns], F.inline(F.array(made)))


def _path(place: tuple[str, ...]) -> str:
    return "$" + "".join(f"['{part}']" for part in place)


def _places(schema: Mapping, path: tuple[str, ...] = ()) -> Iterator[tuple[str, ...]]:
    for name, rule in schema.get("properties", {}).items():
        yield (*path, name)
        yield from _places(rule, (*path, name))


def _rules(schema: Mapping, path: tuple[str, ...], fit: Column) -> Iterator[Column]:
    """Reason or null for each rule of the object at ``path``; ``fit`` tells whether it is an object."""
    required = set(schema.get("required", ()))
    for name, rule in schema.get("properties", {}).items():
        label = ".".join((*path, name))
        document, kind, wanted = F.col("_document"), F.col(f"`_kind {label}`"), rule.get("type")
        at = _path((*path, name))
        there = fit & kind.isNotNull()  # every value has a type, null too
        typed = there & _fits(document, at, kind, wanted) if wanted else there
        if name in required:
            yield F.when(fit & kind.isNull(), F.lit(f"{label} is missing"))
        if wanted:
            yield F.when(there & ~_fits(document, at, kind, wanted), F.lit(f"{label} is no {wanted}"))
        if "enum" in rule:
            known = F.coalesce(F.try_variant_get(document, at, "string").isin(list(rule["enum"])), F.lit(False))
            yield F.when(typed & ~known, F.lit(f"{label} has an unknown value"))
        if "minimum" in rule or "maximum" in rule:
            number, outside = F.try_variant_get(document, at, "double"), F.lit(False)
            if "minimum" in rule:
                outside = outside | (number < rule["minimum"])
            if "maximum" in rule:
                outside = outside | (number > rule["maximum"])
            yield F.when(typed & outside, F.lit(f"{label} is out of range"))
        if rule.get("format") == "date-time":
            yield F.when(typed & F.try_variant_get(document, at, "string").try_cast("timestamp").isNull(),
                         F.lit(f"{label} is no date-time"))
        if wanted == "array" and "type" in rule.get("items", {}):
            of, items = rule["items"]["type"], F.try_variant_get(document, at, "array<variant>")
            yield F.when(typed & F.exists(items, partial(_item_misfits, of)), F.lit(f"{label} has items that are no {of}"))
        if rule.get("properties"):
            yield from _rules(rule, (*path, name), typed)


def check_documents(df: DataFrame, schema: Mapping, column: str = "value") -> DataFrame:
    """``df`` with an array of ``reasons`` why the JSON text (or bytes) in ``column`` breaks the schema.

    It is empty for a document that keeps to it. Null, blank and unreadable texts have one reason.
    """
    given, text = df.columns, F.col(column).cast("string")
    read = _apart(df, _document=F.try_parse_json(text))
    # Values stay inside their document: only the names of their types are carried along.
    kinds = {f"_kind {'.'.join(place)}": F.schema_of_variant(F.try_variant_get("_document", _path(place), "variant"))
             for place in _places(schema)}
    # The type of a whole document lists all of its fields; an object is known by its first character.
    whole = F.when(F.ltrim(text).startswith("{"), F.lit("OBJECT")).otherwise(F.schema_of_variant("_document"))
    read = _apart(read, **kinds, _kind=F.when(F.col("_document").isNotNull(), whole))
    is_object = F.coalesce(_is(F.col("_kind"), "object"), F.lit(False))
    broken = F.when(F.col("_document").isNull(), F.lit("document is not JSON")).when(~is_object, F.lit("document is no object"))
    reasons = F.array_compact(F.array(broken, *_rules(schema, (), is_object)))
    return _apart(read, **{REASONS: reasons}).select(*given, REASONS)


def rejected_documents(df: DataFrame, schema: Mapping, column: str = "value") -> DataFrame:
    """(document, reasons) of the documents that break the schema; the other columns of ``df`` are kept."""
    checked = check_documents(df, schema, column).filter(F.size(REASONS) > 0)
    return checked.withColumn("document", F.coalesce(F.col(column).cast("string"), F.lit(""))).drop(column)


def accepted_documents(df: DataFrame, schema: Mapping, column: str = "value") -> DataFrame:
    """Rows of ``df`` whose document keeps to the schema."""
    return check_documents(df, schema, column).filter(F.size(REASONS) == 0).drop(REASONS)
