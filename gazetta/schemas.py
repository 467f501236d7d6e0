"""Schemas of the tables the library reads and writes. Ids and codes are texts, so leading zeros stay."""

from __future__ import annotations

from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StringType, StructField, StructType

_TYPES = {"string": StringType(), "double": DoubleType(), "int": IntegerType(), "boolean": BooleanType()}


def _texts(names: str) -> str:
    return ", ".join(f"{n} string" for n in names.split())


def _struct(spec: str) -> StructType:
    """A schema of `name type` pairs, without a session."""
    return StructType([StructField(name, _TYPES[kind]) for name, kind in (pair.split() for pair in spec.split(","))])


PLACE = _struct(
    _texts("source_id place_code standard_name place_type place_type_code province_name city_name area_name area_code")
    + ", longitude double, latitude double, "
    + _texts("keyword partition_code source_url source_name roman_alphabet_spelling ethnic_minorities_writing raw_payload_json match_mode fetched_at_utc captured_at updated_at geometry_type coordinates_json")
)
_COMMON = "source_id place_code standard_name place_type place_type_code province_name city_name area_name area_code"
SINGLE_COLUMNS = [*_COMMON.split(), "longitude", "latitude", "captured_at", "updated_at"]
MULTI_COLUMNS = [*_COMMON.split(), "geometry_type", "coordinates_json", "captured_at", "updated_at"]
DIVISION = _struct(_texts("code name parent_code level source_name captured_at updated_at"))
REGION = _struct(
    _texts("code name full_name level parent_code province_code city_code district_code town_code") + ", longitude double, latitude double, " + _texts("source_name source_url version captured_at updated_at")
)
PAGE_DIVISION = _struct(_texts("code name short_code parent_code level level_text full_name status source_url captured_at"))
RUN = _struct(_texts("run_id source_name status") + ", item_count int, " + _texts("started_at finished_at error_message"))
FETCH_MARK = _struct(_texts("parent_code fetched_at"))
TASK = _struct(_texts("id status claimed_by claimed_at done_at") + ", attempts int, " + _texts("last_error updated_at"))
STATUSES = ("pending", "claimed", "done", "retry", "failed")
DETAIL = _struct(
    _texts(
        "id place_code standard_name old_name place_type place_type_code province_name city_name area_name province city area roman_alphabet_spelling ethnic_minorities_writing place_origin place_meaning place_history government_history geometry_type coordinates_json gdm_json raw_json"
    )
    + ", response_status_code int, fetched_at string, worker_id string, attempt int, error string"
)
MASTER = _struct(", ".join(f"{f.name} {f.dataType.simpleString()}" for f in DETAIL) + ", " + _texts("first_seen_at last_seen_at source_run_id source_worker_id merge_at"))
FETCH_RESULT = _struct("id string, ok boolean, status_code int, data string, raw_text string, error string, elapsed_ms double")
PROGRESS = _struct("keyword string, code string")
