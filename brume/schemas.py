"""Table schemas and fixed values of the forecast archives."""

from __future__ import annotations

MESSAGE_JSON = "_offset LONG, _length LONG, param STRING, levtype STRING, levelist STRING, step STRING, number STRING, date STRING, time STRING"
REFERENCES = "key STRING, kind STRING, uri STRING, offset LONG, length LONG, inline STRING, meta STRING"

# lat/lon boxes (inclusive), unit conversions, levels, members and thresholds of the archives.
REGIONS = {"global": (-90.0, 90.0, -180.0, 180.0), "east_africa": (-12.0, 23.0, 21.0, 53.0), "greater_horn": (-14.0, 25.0, 19.0, 55.0), "south_asia": (5.0, 40.0, 60.0, 100.0)}
UNITS = {"t2m": (1.0, -273.15), "tp": (1000.0, 0.0), "sp": (0.01, 0.0), "msl": (0.01, 0.0), "ssr": (1e-6, 0.0), "prate": (10800.0, 0.0)}
LEVEL_NAMES = {"sfc": "surface", "ml": "hybrid", "pl": "isobaricInhPa", "sol": "soil", "sea": "ocean"}
PRESSURE_LEVELS = [50, 100, 150, 200, 250, 300, 400, 500, 600, 700, 850, 925, 1000]
SOIL_LEVELS = [1, 2, 4]
ACCUMULATED = ["tp", "cp", "lsp"]
GRAVITY = 9.80665
THRESHOLDS_MM = [5.0, 25.0, 50.0, 75.0, 100.0, 125.0]
N_MEMBERS = 51
COORDINATES = ["valid_time", "time", "step", "latitude", "longitude"]
CHUNK_INDEX = [
    "varname", "typeOfLevel", "stepType", "name", "step_h", "level", "time", "valid_time", "uri", "offset", "length",
    "inline_value", "grib_crc32", "grib_updated_at", "idx_crc32", "idx_updated_at", "indexed_at",
]
