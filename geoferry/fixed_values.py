"""Names, formats, limits and constants that results depend on."""

from __future__ import annotations

# --- Fixed values: layer field type -> Spark type name; anything else is a string ---
FIELD_TYPES = {
    "esriFieldTypeSmallInteger": "bigint",
    "esriFieldTypeInteger": "bigint",
    "esriFieldTypeSingle": "double",
    "esriFieldTypeDouble": "double",
    "esriFieldTypeString": "string",
    "esriFieldTypeDate": "date",
    "esriFieldTypeOID": "bigint",
    "esriFieldTypeGlobalID": "string",
    "esriFieldTypeGUID": "string",
    "esriFieldTypeBlob": "binary",
    "esriFieldTypeRaster": "binary",
    "esriFieldTypeGeometry": "binary",
    "esriFieldTypeXML": "string",
}

# --- Fixed values: sizes and delays ---
MAX_CHUNK_ROWS = 500_000
MAX_ATTEMPTS = 5
RETRY_DELAY_SECONDS = 30
TIMEOUT_MINUTES = 15
MAX_NAME_LENGTH = 255
MAX_TAGS = 50

# --- Fixed values: the columns of the two logs, in order ---
INGEST_LOG_COLUMNS = [
    "load_id",
    "layer_attempt_id",
    "item_id",
    "sublayer_id",
    "layer_url",
    "layer_name",
    "target_path",
    "timestamp",
    "status",
    "error_message",
]
BATCH_LOG_COLUMNS = [
    "batch",
    "target_svc_name",
    "target_server_url",
    "batch_by_column",
    "layer_id",
    "write_mode",
    "user",
    "load_timestamp",
    "status",
    "message",
    "retry_attempts",
]
BATCH_LOG_KEYS = ["batch", "target_svc_name"]
BATCH_LOG_UPDATED = ["load_timestamp", "status", "message", "retry_attempts"]
BATCH_STATUSES = ["Failed", "Success", "Timeout"]
BATCH_MESSAGE = "Batch Complete"

# --- Fixed values: layer states in the ingest log ---
PENDING = "Pending"
READ = "Read & Reprojected"
COMPLETE = "Complete"
FAILED = "Failed"

# --- Fixed values: texts and formats ---
SERVICE_TYPE = "Feature Service"
NO_SUBLAYER_ID = "N/A"
NEW_SERVICE_TAGS = ["automated_creation"]
WKT_COLUMN = "geometry_wkt"
MICROS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
SECONDS_FORMAT = "yyyy-MM-dd HH:mm:ss"
NAME_BREAKS = r"[^a-zA-Z0-9_]+"
TAG_BREAKS = r"[.,\-=/:]"
GEOGCS_NAME = r'GEOGCS\[\s*"([^"]+)"'
PARENT_HEADING = "--- Parent Item Description ---"
TABLE_NAME_LINE = "# Table Name : "
ITEM_ID_LINE = "- ArcGIS Online ID: "
DESCRIPTION_LINE = "- Description: "
SPATIAL_REFERENCE_LINE = "- Spatial Reference Properties:"
SPATIAL_REFERENCE_LABELS = {
    "geometry_column": "Geometry Column",
    "wkid": "Spatial Reference WKID",
    "wkt": "Spatial Reference WKT",
    "is_projected": "Spatial Reference is Projected",
    "units": "Spatial Reference Units",
    "name": "Spatial Reference Name",
}

# --- Fixed values: the ellipsoid, the projections and the spatial references known here ---
EARTH_RADIUS = 6378137.0
FLATTENING = 1 / 298.257223563
WGS84_SRID = 4326
MERCATOR_SRIDS = [3857, 102100]
UTM_NORTH = 32600
UTM_SOUTH = 32700
UTM_SCALE = 0.9996
UTM_EASTING = 500000.0
UTM_SOUTHERN_NORTHING = 10000000.0
WGS84_WKT = (
    'GEOGCS["GCS_WGS_1984",DATUM["D_WGS_1984",SPHEROID["WGS_1984",6378137.0,298.257223563]],'
    'PRIMEM["Greenwich",0.0],UNIT["Degree",0.0174532925199433]]'
)
MERCATOR_WKT = (
    f'PROJCS["WGS_1984_Web_Mercator_Auxiliary_Sphere",{WGS84_WKT},'
    'PROJECTION["Mercator_Auxiliary_Sphere"],PARAMETER["False_Easting",0.0],'
    'PARAMETER["False_Northing",0.0],PARAMETER["Central_Meridian",0.0],'
    'PARAMETER["Standard_Parallel_1",0.0],PARAMETER["Auxiliary_Sphere_Type",0.0],UNIT["Meter",1.0]]'
)


def utm_wkt(zone: int, south: bool) -> str:
    northing = UTM_SOUTHERN_NORTHING if south else 0.0
    return (
        f'PROJCS["WGS_1984_UTM_Zone_{zone}{"S" if south else "N"}",{WGS84_WKT},PROJECTION["Transverse_Mercator"],'
        f'PARAMETER["False_Easting",{UTM_EASTING}],PARAMETER["False_Northing",{northing}],'
        f'PARAMETER["Central_Meridian",{zone * 6 - 183}.0],PARAMETER["Scale_Factor",{UTM_SCALE}],'
        'PARAMETER["Latitude_Of_Origin",0.0],UNIT["Meter",1.0]]'
    )


SPATIAL_REFERENCES = [
    # srid, wkt, is_projected, unit
    (4326, WGS84_WKT, False, "Degree"),
    (3857, MERCATOR_WKT, True, "Meter"),
    (102100, MERCATOR_WKT, True, "Meter"),
    *[(UTM_NORTH + zone, utm_wkt(zone, False), True, "Meter") for zone in range(1, 61)],
    *[(UTM_SOUTH + zone, utm_wkt(zone, True), True, "Meter") for zone in range(1, 61)],
]
