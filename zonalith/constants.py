"""Acceptance limits, class codes, weights and tiers of the measurement contract."""

from __future__ import annotations

EPS = 1e-6

# Search and acceptance.
LOOKBACK_DAYS, RADAR_LOOKBACK_DAYS, BACKFILL_DAYS = 20, 24, 120
SCENE_CLOUD_REJECT_ABOVE = 98.0
MAX_FIELD_CLOUD, MAX_FIELD_SHADOW, MAX_FIELD_SNOW = 0.30, 0.20, 0.10
MIN_VALID_PIXELS, MIN_VALID_FRACTION, MIN_QUALITY = 8, 0.50, 0.35
REFLECTANCE_MAX = 1.2

# Scene classification codes.
SCL_CROP, SCL_CLOUD, SCL_SHADOW, SCL_WATER = (4, 5), (8, 9, 10), (2, 3), (6,)
SCL_INVALID, SCL_SATURATED, SCL_SNOW, SCL_DARK = (0, 7), (1,), (11,), (2,)
SCL_NO_DATA, SCL_CLOUD_SHADOW = 0, (3,)

# Quality.
QW_COVERAGE, QW_SUPPORT, QW_CLEAR = 0.50, 0.20, 0.30
UNBUFFERED_FACTOR, EPC_SATURATION = 0.80, 50.0
MICRO_LAND_ACRES, MICRO_LAND_FACTOR = 0.25, 0.65
LOW_PURITY, LOW_PURITY_FACTOR = 0.60, 0.75
GEOMETRY_FACTOR = {"high": 1.0, "medium": 0.85, "low": 0.55}
TIER_CAP = {"medium": 0.74, "low": 0.54, "insufficient": 0.30}
EPC_STRONG, EPC_LIMITED, EPC_WEAK, MIN_EPC = 8.0, 5.0, 3.0, 3.0
CLEAN_PX_REAL, CLEAN_PX_MIN = 10.0, 3.0
TIERS = (
    ("OBSERVED_STRONG", "high"),
    ("OBSERVED_LIMITED", "medium"),
    ("OBSERVED_WEAK", "low"),
    ("INSUFFICIENT_SPATIAL_SUPPORT", "insufficient"),
)

# Geometry.
PIXEL_AREA_M2, INTERIOR_COVERAGE, MIN_CELL_COVERAGE = 100.0, 0.99, 0.005
MAX_COVERAGE_CELLS = 250_000
FIELD_BUFFER_M, MIN_BUFFERED_AREA_M2, ADAPTIVE_EROSION_MIN_AREA_M2 = -10.0, 400.0, 5000.0
BLOCK_SPAN_M, BLOCK_MAX_LANDS, SPATIAL_GROUP_CELL_M = 5000.0, 200, 100_000.0

# Neighbour context.
RING_GAP_M, RING_MAX_M, RING_STEP_M = 10.0, 150.0, 10.0
RING_PX_REAL, RING_PX_MIN = 20, 3

# Time.
TEMPORAL_MAX_DELTA, TEMPORAL_WINDOW_DAYS, TEMPORAL_LOOKBACK_DAYS = 0.35, 7, 45
HISTORY_ROWS, LAND_PAGE_SIZE = 30, 500
TREND_WINDOW_DAYS = 21
TREND_CUTS = ((-0.010, "sharp_decline"), (-0.003, "declining"), (0.003, "stable"), (0.010, "improving"))

# Forecast.
FORECAST_MIN_QUALITY, FORECAST_MIN_HISTORY, FORECAST_MAX_HISTORY = 0.55, 3, 12
FORECAST_MAX_GAP_DAYS, FORECAST_MAX_SPAN_DAYS, FORECAST_MAX_DAYS = 12, 180, 5

# Zones.
ZONE_MIN_INTERIOR, ZONE_MIN_QUARTER, ZONE_MIN_DELTA, ZONE_SE_MULTIPLE = 4, 2, 0.05, 2.0
QUARTERS = ("NE", "NW", "SE", "SW")

HISTOGRAM_BINS = 20

INDEX_BOUNDS = {
    "NDVI": (-1.0, 1.0),
    "SAVI": (-1.5, 1.5),
    "EVI": (-1.0, 2.5),
    "NDRE": (-1.0, 1.0),
    "MCARI": (-1.0, 5.0),
    "NDMI": (-1.0, 1.0),
    "NDWI": (-1.0, 1.0),
    "MNDWI": (-1.0, 1.0),
}

# The vegetation colour ramp.
COLOR_STOPS = (
    (-0.20, "#7C3F1C"),
    (0.00, "#B25C2C"),
    (0.10, "#D9B26E"),
    (0.20, "#E8C170"),
    (0.35, "#FFD166"),
    (0.50, "#C7E27A"),
    (0.65, "#5DBB63"),
    (0.80, "#2E8B3D"),
    (1.00, "#1B5E20"),
)
