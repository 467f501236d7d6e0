"""Semi-structured JSON as VARIANT: tolerant coordinate parsing, payload shapes, canonical text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parsed(text: Column) -> Column:
    """VARIANT of a JSON text; null for null, empty or broken texts."""
    return F.try_parse_json(text)


def pairs(items: Column) -> Column:
    """[[x, y], …] of an array<variant>: elements that are arrays of two or more numbers (or texts of numbers), cut to two. [] for null.

    A flat point [x, y] and nested rings give no pairs, since their elements are no such arrays.
    """
    number = lambda v, k: F.try_variant_get(v, f"$[{k}]", "double")
    both = F.transform(F.coalesce(items, F.array().cast("array<variant>")), lambda v: F.array(number(v, 0), number(v, 1)))
    return F.filter(both, lambda p: p[0].isNotNull() & p[1].isNotNull())


def geometry(gdm: Column) -> tuple[Column, Column]:
    """(geometry type, pairs) of a GeoJSON-like VARIANT; ("", []) if it is no object."""
    is_object = F.coalesce(F.schema_of_variant(gdm).startswith("OBJECT"), F.lit(False))
    kind = F.when(is_object, F.coalesce(F.try_variant_get(gdm, "$.type", "string"), F.lit(""))).otherwise(F.lit(""))
    return kind, F.when(is_object, pairs(F.try_variant_get(gdm, "$.coordinates", "array<variant>"))).otherwise(pairs(F.lit(None).cast("array<variant>")))


def coordinates(text: Column) -> Column:
    """Pairs of a stored coordinate text; [] for null, empty, broken or other texts."""
    return pairs(F.try_variant_get(parsed(text), "$", "array<variant>"))


def primary_point(points: Column) -> tuple[Column, Column]:
    """(longitude, latitude) if there is exactly one pair, else nulls."""
    one = F.size(points) == 1
    return F.when(one, F.get(F.get(points, F.lit(0)), F.lit(0))), F.when(one, F.get(F.get(points, F.lit(0)), F.lit(1)))


def _list(payload: Column, path: str) -> Column:
    return F.try_variant_get(payload, path, "array<variant>")


def objects(items: Column) -> Column:
    """The elements that are JSON objects."""
    return F.filter(F.coalesce(items, F.array().cast("array<variant>")), lambda v: F.schema_of_variant(v).startswith("OBJECT"))


def _is(payload: Column, path: str, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(F.try_variant_get(payload, path, "variant")).startswith(kind), F.lit(False))


def rows_of(payload: Column) -> Column:
    """Row objects of a division payload: a list, a list under data, then data.records, data.rows, data.children; records and rows only without data of either kind."""
    nested = F.coalesce(_list(payload, "$.data.records"), _list(payload, "$.data.rows"), _list(payload, "$.data.children"))
    plain = F.coalesce(_list(payload, "$.records"), _list(payload, "$.rows"))
    of_object = F.when(_is(payload, "$.data", "ARRAY"), _list(payload, "$.data")).when(_is(payload, "$.data", "OBJECT"), nested).otherwise(plain)
    return objects(F.when(_is(payload, "$", "ARRAY"), _list(payload, "$")).otherwise(of_object))


def records_of(payload: Column) -> Column:
    """Record objects of a search payload: records, data.records, rows, data of an object; of a list, its first element's records or itself."""
    first = F.coalesce(_list(payload, "$.records"), _list(payload, "$.data.records"), _list(payload, "$.rows"), _list(payload, "$.data"))
    has = F.try_variant_get(payload, "$[0].records", "variant").isNotNull()
    of_list = F.when(has, _list(payload, "$[0].records")).otherwise(_list(payload, "$"))
    return objects(F.when(_is(payload, "$", "ARRAY"), of_list).otherwise(first))


def total_of(payload: Column, default: Column) -> Column:
    return F.coalesce(F.try_variant_get(payload, "$.total", "long"), F.try_variant_get(payload, "$.data.total", "long"), F.try_variant_get(payload, "$[0].total", "long"), default)


def canonical(payload: Column) -> Column:
    """JSON text with sorted keys and no spaces."""
    return F.to_json(payload)
