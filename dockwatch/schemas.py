"""Field names, file formats and constants of the data model."""

from pyspark.sql import types as T


def _text_schema(names):
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# --- fixed values: formats of the incoming files -----------------------------------------

# status feed message, one per station and poll
STATUS_MESSAGE = T.StructType(
    [
        T.StructField("station_id", T.StringType()),
        T.StructField("stationCode", T.StringType()),
        T.StructField("date_collecte", T.StringType()),
        T.StructField("last_reported", T.StringType()),
        T.StructField("num_bikes_available", T.StringType()),
        T.StructField("num_bikes_available_types", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
        T.StructField("num_docks_available", T.StringType()),
        T.StructField("is_installed", T.StringType()),
        T.StructField("is_renting", T.StringType()),
        T.StructField("is_returning", T.StringType()),
    ]
)

# reference file of the stations, ';' separated, in file order
REFERENCE_CSV = {
    "stationcode": "station_code",
    "name": "station_name",
    "capacity": "capacity",
    "coordonnees_geo": "coordinates",
    "nom_arrondissement_communes": "town_name",
    "code_insee_commune": "town_code",
}
REFERENCE_CSV_SCHEMA = _text_schema(REFERENCE_CSV)

# aggregated zone, one JSON object per line: field in the file -> column in this package
AGGREGATED_FIELDS = {
    "station_id": "station_id",
    "station_code": "station_code",
    "date_collecte": "collected_at",
    "last_reported": "updated_at",
    "velos_mecaniques": "bikes_mechanical",
    "velos_electriques": "bikes_electric",
    "bornes_libres": "docks_free",
    "is_installed": "is_installed",
    "is_renting": "is_renting",
    "is_returning": "is_returning",
    "nom": "station_name",
    "capacite": "capacity",
    "coordonnees_geo": "coordinates",
    "commune": "town_name",
    "code_insee": "town_code",
}
AGGREGATED_SCHEMA = _text_schema(AGGREGATED_FIELDS)

# bike types: code, label
BIKE_TYPES = [(1, "mechanical", "Mechanical bike"), (2, "ebike", "Electric bike")]
MECHANICAL, ELECTRIC = "mechanical", "ebike"

# --- fixed values: limits used by the checks and repair rules ----------------------------

LATITUDE_RANGE = (48.1, 49.3)
LONGITUDE_RANGE = (1.4, 3.6)
DEPARTMENTS = ["75", "77", "78", "91", "92", "93", "94", "95"]
CLOCK_TOLERANCE_MINUTES = 5
SILENT_HOURS = 24
MIN_NAMED_ROWS = 1500
EARTH_RADIUS_M = 6371000.0
CENTRAL_TOWN = "Paris"

# check id, dimension, what is checked, criticality, target, planned action
CHECKS = [
    ("C1", "Completeness", "Station code present", "blocking", "0", "substitute from the station id"),
    ("C2", "Completeness", "Mechanical / electric split present", "major", "0", "impute from the neighbouring reading"),
    ("C3", "Completeness", "Station attributes present", "blocking", "0", "take the last valid reference version"),
    ("C4", "Completeness", "Collections present", "major", "< 5 %", "none, documented"),
    ("U1", "Uniqueness", "One reading per station and collection", "blocking", "0", "delete duplicates"),
    ("U2", "Uniqueness", "One station id per station code", "blocking", "0", "review case by case"),
    ("V1", "Validity", "Capacity above zero", "blocking", "0", "delete"),
    ("V2", "Validity", "Bike and dock counts not negative", "blocking", "0", "delete"),
    ("V3", "Validity", "Coordinates inside the region", "major", "0", "correct or delete"),
    ("V4", "Validity", "Town code of five digits in a known department", "blocking", "0", "correct"),
    ("V5", "Validity", "Station name without extra spaces", "minor", "0", "trim"),
    ("V6", "Validity", "Station update not after the collection", "major", "0", "correct the time"),
    ("K1", "Consistency", "Total bikes = mechanical + electric", "major", "0", "recompute"),
    ("K2", "Consistency", "Bikes + free docks <= capacity", "minor", "measure", "domain review"),
    ("K3", "Consistency", "Station reported within the last 24 h", "major", "0", "exclude frozen readings"),
    ("K4", "Consistency", "One town name per town code", "major", "0", "correct the name"),
    ("I1", "Integrity", "Station code known to the reference", "blocking", "0", "delete"),
    ("I2", "Integrity", "Reading attached to a station and a town", "blocking", "0", "delete after repair attempt"),
]
DIMENSION_ORDER = ["Completeness", "Uniqueness", "Validity", "Consistency", "Integrity"]

# --- target model ------------------------------------------------------------------------

# column: (type, constraints); CHAR/VARCHAR lengths and integer ranges are rules of the model
TARGET_MODEL = {
    "town": {
        "primary_key": ["town_code"],
        "unique": [],
        "not_null": ["town_code", "town_name", "dept_code"],
        "exact_length": {"town_code": 5, "dept_code": 2},
        "max_length": {"town_name": 100},
        "checks": {"population >= 0": "population >= 0", "area_ha > 0": "area_ha > 0"},
        "smallint": [],
        "foreign_keys": {},
    },
    "station": {
        "primary_key": ["station_id"],
        "unique": [["station_code"]],
        "not_null": ["station_id", "station_code", "station_name", "latitude", "longitude", "capacity", "town_code"],
        "exact_length": {"town_code": 5},
        "max_length": {"station_code": 10, "station_name": 150},
        "checks": {
            "latitude range": "latitude BETWEEN -90 AND 90",
            "longitude range": "longitude BETWEEN -180 AND 180",
            "capacity > 0": "capacity > 0",
        },
        "smallint": ["capacity"],
        "foreign_keys": {"town_code": ("town", "town_code")},
    },
    "bike_type": {
        "primary_key": ["bike_type_id"],
        "unique": [["type_code"]],
        "not_null": ["bike_type_id", "type_code", "type_label"],
        "exact_length": {},
        "max_length": {"type_code": 20, "type_label": 50},
        "checks": {},
        "smallint": [],
        "foreign_keys": {},
    },
    "reading": {
        "primary_key": ["reading_id"],
        "unique": [["station_id", "collected_at"]],
        "not_null": [
            "reading_id", "station_id", "collected_at", "updated_at", "docks_free",
            "is_installed", "is_renting", "is_returning",
        ],
        "exact_length": {},
        "max_length": {},
        "checks": {"docks_free >= 0": "docks_free >= 0"},
        "smallint": ["docks_free"],
        "foreign_keys": {"station_id": ("station", "station_id")},
    },
    "reading_bikes": {
        "primary_key": ["reading_id", "bike_type_id"],
        "unique": [],
        "not_null": ["reading_id", "bike_type_id", "bikes"],
        "exact_length": {},
        "max_length": {},
        "checks": {"bikes >= 0": "bikes >= 0"},
        "smallint": ["bikes"],
        "foreign_keys": {"reading_id": ("reading", "reading_id"), "bike_type_id": ("bike_type", "bike_type_id")},
    },
}

RUN_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("ended_at", T.TimestampType()),
        T.StructField("files", T.LongType()),
        T.StructField("rows_raw", T.LongType()),
        T.StructField("rows_rejected", T.LongType()),
        T.StructField("rows_duplicate", T.LongType()),
        T.StructField("rows_loaded", T.LongType()),
    ]
)
