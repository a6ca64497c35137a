"""Record layouts of the timetable, station and link files.

Fixed values of the published file formats: column, 1-based start, length, kind, allowed values.
Gaps between fields are spare.  See :mod:`railgrain.functions.decoders` for the kinds.
"""

from __future__ import annotations

from typing import NamedTuple


class Field(NamedTuple):
    name: str
    start: int
    length: int
    kind: str = "text"
    allowed: tuple[str, ...] = ()


def _flag(name: str, start: int, allowed: str) -> Field:
    return Field(name, start, 1, "flag", tuple(allowed))


TIMETABLE_WIDTH = 80
STATION_WIDTH = 82

HEADER = (
    Field("file_mainframe_identity", 3, 20),
    Field("date_of_extract", 23, 6, "ddmmyy"),
    Field("time_of_extract", 29, 4, "time"),
    Field("current_file_ref", 33, 7),
    Field("last_file_ref", 40, 7),
    _flag("bleed_off_update_ind", 47, "UF"),
    Field("version", 48, 1),
    Field("user_extract_start_date", 49, 6, "ddmmyy"),
    Field("user_extract_end_date", 55, 6, "ddmmyy"),
)

BASIC_SCHEDULE = (
    _flag("transaction_type", 3, "NDR"),
    Field("train_uid", 4, 6),
    Field("date_runs_from", 10, 6, "yymmdd"),
    Field("date_runs_to", 16, 6, "yymmdd"),
    Field("days_run", 22, 7, "days"),
    _flag("bank_holiday_running", 29, " XEG"),
    _flag("train_status", 30, " BFPST12345"),
    Field("train_category", 31, 2),
    Field("train_identity", 33, 4),
    Field("headcode", 37, 4),
    Field("train_service_code", 42, 8),
    _flag("portion_id", 50, " Z01248"),
    Field("power_type", 51, 3),
    Field("timing_load", 54, 4),
    Field("speed", 58, 3, "int?"),
    Field("operating_characteristics", 61, 6),
    _flag("train_class", 67, " BS"),
    _flag("sleepers", 68, " BFS"),
    _flag("reservations", 69, " AERS"),
    Field("catering_code", 71, 4),
    Field("service_branding", 75, 4),
    _flag("stp_indicator", 80, " CNOP"),
)

EXTRA_DETAILS = (
    Field("uic_code", 7, 5),
    Field("atoc_code", 12, 2),
    _flag("applicable_timetable_code", 14, "YN"),
    Field("rsid", 15, 8),
    _flag("data_source", 23, " T"),
)

ORIGIN_LOCATION = (
    Field("location", 3, 7),
    Field("location_suffix", 10, 1),
    Field("scheduled_departure", 11, 5, "timeh"),
    Field("public_departure", 16, 4, "time"),
    Field("platform", 20, 3),
    Field("line", 23, 3),
    Field("engineering_allowance", 26, 2),
    Field("pathing_allowance", 28, 2),
    Field("activity", 30, 12, "activity"),
    Field("performance_allowance", 42, 2),
)

INTERMEDIATE_LOCATION = (
    Field("location", 3, 7),
    Field("location_suffix", 10, 1),
    Field("scheduled_arrival", 11, 5, "timeh?"),
    Field("scheduled_departure", 16, 5, "timeh?"),
    Field("scheduled_pass", 21, 5, "timeh?"),
    Field("public_arrival", 26, 4, "time"),
    Field("public_departure", 30, 4, "time"),
    Field("platform", 34, 3),
    Field("line", 37, 3),
    Field("_path", 40, 3),
    Field("activity", 43, 12, "activity"),
    Field("engineering_allowance", 55, 2),
    Field("pathing_allowance", 57, 2),
    Field("performance_allowance", 59, 2),
)

CHANGES_EN_ROUTE = (
    Field("location", 3, 7),
    Field("location_suffix", 10, 1),
    Field("train_category", 11, 2),
    Field("train_identity", 13, 4),
    Field("headcode", 17, 4),
    Field("train_service_code", 22, 8),
    _flag("portion_id", 30, " Z01248"),
    Field("power_type", 31, 3),
    Field("timing_load", 34, 4),
    Field("speed", 38, 3, "int?"),
    Field("operating_characteristics", 41, 6),
    _flag("train_class", 47, " BS"),
    _flag("sleepers", 48, " BFS"),
    _flag("reservations", 49, " AERS"),
    Field("catering_code", 51, 4),
    Field("service_branding", 55, 4),
    Field("uic_code", 63, 5),
    Field("rsid", 68, 8),
)

TERMINATING_LOCATION = (
    Field("location", 3, 7),
    Field("location_suffix", 10, 1),
    Field("scheduled_arrival", 11, 5, "timeh"),
    Field("public_arrival", 16, 4, "time"),
    Field("platform", 20, 3),
    Field("_path", 23, 3),
    Field("activity", 26, 12, "activity"),
)

NOTE = (
    _flag("note_type", 3, " GW"),
    Field("note", 4, 77, "vartext"),
)

ASSOCIATIONS = (
    _flag("transaction_type", 3, "NDR"),
    Field("main_train_uid", 4, 6),
    Field("associated_train_uid", 10, 6),
    Field("association_start_date", 16, 6, "yymmdd"),
    Field("association_end_date", 22, 6, "yymmdd"),
    Field("association_days", 28, 7, "days"),
    Field("association_category", 35, 2),
    _flag("association_date_ind", 37, " SNP"),
    Field("association_location", 38, 7),
    Field("base_location_suffix", 45, 1),
    Field("assoc_location_suffix", 46, 1),
    _flag("association_type", 48, " PO"),
    _flag("stp_indicator", 80, " CNOP"),
)

TIPLOC_INSERT = (
    Field("tiploc_code", 3, 7),
    Field("capitals_identification", 10, 2),
    Field("nalco", 12, 6),
    Field("nlc_check_character", 18, 1),
    Field("tps_description", 19, 26),
    Field("stanox", 45, 5),
    Field("crs_code", 54, 3),
    Field("_16_character_description", 57, 16),
)

TIPLOC_AMEND = TIPLOC_INSERT + (Field("new_tiploc", 73, 7),)

TIPLOC_DELETE = (Field("tiploc_code", 3, 7),)

STATION_DETAIL = (
    Field("station_name", 6, 30),
    Field("cate_type", 36, 1, "int"),
    Field("tiploc_code", 37, 7),
    Field("subsidiary_3_alpha_code", 44, 3),
    Field("_3_alpha_code", 50, 3),
    Field("easting", 53, 5, "int"),
    _flag("estimated", 58, " E"),
    Field("northing", 59, 5, "int"),
    Field("change_time", 64, 2, "int"),
)

STATION_ALIAS = (
    Field("station_name", 6, 30),
    Field("alias_name", 37, 30),
)

ROUTEING_GROUPS = (
    Field("group_name", 6, 30),
    Field("station", 37, 40, "routeing"),
)

# The extra timetable file: dates count from 1956, the timetable code may be blank, the header is empty.
ZTRAIN_BASIC_SCHEDULE = tuple(
    f._replace(kind="yymmdd1956") if f.kind == "yymmdd" else f for f in BASIC_SCHEDULE)
ZTRAIN_EXTRA_DETAILS = tuple(
    f._replace(allowed=(" ",) + f.allowed) if f.name == "applicable_timetable_code" else f
    for f in EXTRA_DETAILS)

TRANSPORT_MODES = ("BUS", "TUBE", "WALK", "FERRY", "METRO", "TRAM", "TAXI", "TRANSFER")

# Fixed-link files: key, column, kind.
LINK_KEYS = (
    ("M", "mode", "choice"),
    ("O", "origin", "text"),
    ("D", "destination", "text"),
    ("T", "link_time", "int"),
    ("S", "start_time", "time"),
    ("E", "end_time", "time"),
    ("P", "priority", "int"),
    ("F", "start_date", "dd/mm/yyyy"),
    ("U", "end_date", "dd/mm/yyyy"),
    ("R", "days_of_week", "days"),
)

INTERCHANGE_COLUMNS = (
    ("station_code", "text"),
    ("arriving_train_toc", "text"),
    ("departing_train_toc", "text"),
    ("minimum_interchange_time", "int"),
    ("comments", "vartext"),
)

RAIL_REFERENCE_COLUMNS = (
    "atco", "tiploc", "crs", "stationname", "stationnamelang", "gridtype", "easting", "northing")
