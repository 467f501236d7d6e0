"""Projections of raw records to typed rows, the routing by geometry, and rows read back from stores."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazetta import schemas
from gazetta.functions import scalar, variant


def place_rows(raw: DataFrame, now: Column, payload: str = "raw") -> DataFrame:
    """Place rows of raw JSON records with keyword, partition_code, source_url, match_mode and fetched_at_utc beside them.

    Records that are no objects, or have no id, are left out. Missing and null texts become "", but city
    and area fields null; longitude and latitude are set only for exactly one coordinate pair.
    """
    v = F.col("_v")
    text = lambda name: F.coalesce(F.try_variant_get(v, f"$.{name}", "string"), F.lit(""))
    maybe = lambda name: scalar.empty_to_null(F.try_variant_get(v, f"$.{name}", "string"))
    rows = raw.withColumn("_v", variant.parsed(F.col(payload))).where(F.schema_of_variant("_v").startswith("OBJECT") & F.try_variant_get(v, "$.id", "string").isNotNull())
    kind, points = variant.geometry(F.try_variant_get(v, "$.gdm", "variant"))
    rows = rows.withColumns({"_kind": kind, "_points": points})
    lon, lat = variant.primary_point(F.col("_points"))
    made = {"source_id": text("id")} | {n: text(n) for n in ("place_code", "standard_name", "place_type", "place_type_code", "province_name", "roman_alphabet_spelling", "ethnic_minorities_writing")}
    made |= {"city_name": maybe("city_name"), "area_name": maybe("area_name"), "area_code": maybe("area"), "longitude": lon, "latitude": lat}
    made |= {n: F.col(n) for n in ("keyword", "partition_code", "source_url", "match_mode", "fetched_at_utc")}
    made |= {"source_name": F.lit("places"), "raw_payload_json": variant.canonical(v), "captured_at": now, "updated_at": now, "geometry_type": F.col("_kind"), "coordinates_json": F.to_json("_points")}
    return rows.select(*[made[f.name].alias(f.name) for f in schemas.PLACE])


#: A geometry that is one of these counts as absent.
EMPTY = ("null", "{}", "[]", '""', "0", "0.0", "-0.0", "false")


def detail_rows(results: DataFrame, attempt: Column, worker: Column, now: Column) -> DataFrame:
    """Detail rows of fetch results. Without a geometry object coordinates_json is the text null, and gdm_json a null; error only where not ok."""
    v, gdm = F.col("_v"), F.col("_g")
    rows = results.withColumn("_v", variant.parsed(F.col("data")))
    rows = rows.withColumn("_g", F.try_variant_get(v, "$.gdm", "variant"))
    there = F.coalesce(~F.to_json(gdm).isin(*EMPTY), F.lit(False))
    is_object = ~there | F.schema_of_variant(gdm).startswith("OBJECT")
    plain = "place_code standard_name old_name place_type place_type_code province_name city_name area_name province city area roman_alphabet_spelling ethnic_minorities_writing place_origin place_meaning place_history government_history".split()
    made = {"id": F.col("id")} | {n: F.try_variant_get(v, f"$.{n}", "string") for n in plain}
    made |= {
        "geometry_type": F.when(there & is_object, F.try_variant_get(gdm, "$.type", "string")),
        "coordinates_json": F.when(is_object, F.coalesce(F.when(there, F.to_json(F.try_variant_get(gdm, "$.coordinates", "variant"))), F.lit("null"))),
        "gdm_json": F.when(there, F.to_json(gdm)),
        "raw_json": F.coalesce("raw_text", F.lit("")),
        "response_status_code": F.col("status_code"),
        "fetched_at": now,
        "worker_id": worker,
        "attempt": attempt.cast("int"),
        "error": F.when(~F.col("ok"), F.col("error")),
    }
    return rows.select(*[made[f.name].alias(f.name) for f in schemas.DETAIL])


class Routed(NamedTuple):
    single: DataFrame
    multi: DataFrame
    dropped_no_geometry: DataFrame


def single_rows(places: DataFrame) -> DataFrame:
    return places.select(*schemas.SINGLE_COLUMNS)


def multi_rows(places: DataFrame) -> DataFrame:
    return places.select(*schemas.MULTI_COLUMNS)


def has_single(points: Column) -> Column:
    return F.size(points) == 1


def has_multi(points: Column) -> Column:
    return F.size(points) > 1


def route(places: DataFrame, points: Column | None = None) -> Routed:
    """Rows with one pair, rows with more, and those with none, which the totals leave out."""
    points = variant.coordinates(F.col("coordinates_json")) if points is None else points
    return Routed(places.where(has_single(points)), places.where(has_multi(points)), places.where(F.size(points) == 0))


def place_from_store(rows: DataFrame) -> DataFrame:
    """Typed place rows from a stored table; columns added later take their defaults where the table lacks them, fetched_at_utc that of captured_at."""
    have = set(rows.columns)
    defaults = {"match_mode": F.lit("contain"), "geometry_type": F.lit(""), "coordinates_json": F.lit(""), "fetched_at_utc": F.col("captured_at")}
    optional = ("city_name", "area_name", "area_code")
    out = []
    for f in schemas.PLACE:
        c = F.col(f.name) if f.name in have else defaults.get(f.name, F.lit(""))
        out.append((scalar.empty_to_null(c) if f.name in optional else c.cast(f.dataType)).alias(f.name))
    return rows.select(*out)


def place_from_totals(rows: DataFrame, single: bool) -> DataFrame:
    """Place rows from a total table: run columns are blank, the geometry of single rows is a point."""
    have = {c: F.col(c) for c in rows.columns}
    if single:
        have |= {"geometry_type": F.lit("point"), "coordinates_json": F.when(F.col("longitude").isNotNull() & F.col("latitude").isNotNull(), F.to_json(F.array(F.array("longitude", "latitude")))).otherwise("")}
    return rows.select(*[have.get(f.name, F.lit(None) if f.dataType.simpleString() == "double" else F.lit("")).cast(f.dataType).alias(f.name) for f in schemas.PLACE])


def with_defaults(rows: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Adds the columns that a table of an older schema lacks, and fills their nulls."""
    return rows.withColumns({n: F.coalesce(F.col(n), d) if n in rows.columns else d for n, d in defaults.items()})
