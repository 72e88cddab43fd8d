"""Constants, code lists, name patterns and column lists."""

from __future__ import annotations

# --- fixed values: carrier frequencies (Hz), speed of light, earth and shell ---
GPS_L1_HZ = 1575.42e6
GPS_L2_HZ = 1227.60e6
GPS_L5_HZ = 1176.45e6
GALILEO_E1_HZ = 1575.42e6
GALILEO_E5A_HZ = 1176.45e6
GALILEO_E6_HZ = 1278.75e6
BEIDOU_B1_HZ = 1561.098e6
BEIDOU_B2_HZ = 1207.14e6
BEIDOU_B3_HZ = 1268.52e6
LIGHT_SPEED = 299792458.0
EARTH_RADIUS_KM = 6371.0
SHELL_HEIGHT_KM = 350.0
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
GPS_EPOCH = "1980-01-06"
EARTH_MU = 3.986005e14
EARTH_ROTATION = 7.2921151467e-5
STEC_K = 40.308e16
TECU_PER_METRE = (GPS_L1_HZ**2 * GPS_L2_HZ**2) / (40.3 * (GPS_L1_HZ**2 - GPS_L2_HZ**2)) / 1e16

# --- fixed values: (system, band) to carrier; anything else is L1 ---
CARRIERS = {
    ("G", "L1"): GPS_L1_HZ,
    ("G", "L1C"): GPS_L1_HZ,
    ("G", "L1P"): GPS_L1_HZ,
    ("G", "L2"): GPS_L2_HZ,
    ("G", "L2C"): GPS_L2_HZ,
    ("G", "L2P"): GPS_L2_HZ,
    ("G", "L5"): GPS_L5_HZ,
    ("E", "E1"): GALILEO_E1_HZ,
    ("E", "L1"): GALILEO_E1_HZ,
    ("E", "E5A"): GALILEO_E5A_HZ,
    ("E", "L5"): GALILEO_E5A_HZ,
    ("E", "E6"): GALILEO_E6_HZ,
    ("C", "B1"): BEIDOU_B1_HZ,
    ("C", "B2"): BEIDOU_B2_HZ,
    ("C", "B3"): BEIDOU_B3_HZ,
}

# --- fixed values: observable codes in order of preference ---
PHASE_FIRST = ("L1C", "L1W", "L1P", "L1X", "L1S", "L1L", "L1M", "L1", "L1N")
PHASE_SECOND = ("L2W", "L2P", "L2C", "L2X", "L2S", "L2L", "L2M", "L2", "L2N")
CODE_FIRST = ("C1C", "C1W", "C1P", "C1X", "C1S", "C1L", "C1M", "P1", "C1")
CODE_SECOND = ("C2W", "C2P", "C2C", "C2X", "C2S", "C2L", "C2M", "P2", "C2")

# --- fixed values: map bounds and processing defaults ---
BBOX = {"lat_min": -80.0, "lat_max": 80.0, "lon_min": -150.0, "lon_max": 10.0}
TARGET_INTERVAL_SEC = 30
MAX_EPHEMERIS_AGE_HOURS = 4.0
ELEVATION_MASK_DEG = 15.0
ARC_GAP_FACTOR = 3.0
ROTI_WINDOW_MINUTES = 5.0
MW_WINDOW = 10
MW_THRESHOLD_CYCLES = 4.0
GF_WINDOW = 10
GF_DEGREE = 2
GF_THRESHOLD_M = 0.12
GRID_STEP_DEG = 1.0
GRID_CADENCE_MIN = 15
PAIR_TOLERANCE_MIN = 5.0
MAX_EMISSION_ANGLE_DEG = 88.0
TARGET_NM = 135.6
OVERLAY_THRESHOLD = 1.0
OVERLAY_BIN_DEG = 0.5
OVERLAY_TOLERANCE_MIN = 15.0
DEFAULT_STEP_DEG = 0.5

# --- fixed values: sentinels of the index files ---
BZ_MISSING = 9999.99
DST_MISSING = 99999
KP_MISSING = 99

# --- fixed values: file-name patterns ---
OBS_LONG_NAME = r"(?i)^([A-Za-z0-9]{9})_R_\d{11}_01D_(\d{2,3})S_.*\.(?:crx|rnx)\.gz$"
OBS_SHORT_NAME = r"(?i)^([A-Za-z0-9]{4})\d{3}0\.\d{2}d(?:\.gz|\.Z)?$"
SWATH_NAME = r"GOLD_L1C_(CH[AB])_NI1_(\d{4})_(\d{3})_(\d{2})_(\d{2})_.*\.nc$"
OMNI_NAME = r"(?i)^(omni(?:_bz_1min|_dst_kp_hourly|_kp_3hour)?)_(\d{8})_(\d{8})\.csv$"

# --- fixed values: error texts after which a file may be fetched again ---
RETRY_MARKERS = (
    "Compressed file ended before the end-of-stream marker was reached",
    "could not find first valid header line",
    "unsupported compressed payload",
    "empty compressed payload",
    "Downloaded file is empty",
)

# --- fixed values: failure reasons of one satellite, in step order ---
SATELLITE_REASONS = (
    "insufficient_phase_samples",
    "missing_navigation_solution",
    "below_elevation_mask",
    "finalize_empty",
    "no_finite_vtec_or_roti",
)

# --- fixed values: column lists ---
LINK_COLUMNS = (
    "time", "event_id", "station_id", "station_code4", "sv", "az_deg", "elev_deg",
    "ipp_lat", "ipp_lon", "stec", "vtec", "roti", "arc_id",
)
GRID_COLUMNS = ("time", "lat", "lon", "vtec", "roti", "sample_count")
EPHEMERIS_ELEMENTS = (
    "GPSWeek", "Toe", "sqrtA", "Eccentricity", "DeltaN", "M0", "omega", "Cuc", "Cus",
    "Crc", "Crs", "Cic", "Cis", "Io", "IDOT", "Omega0", "OmegaDot",
)
# one satellite of one station on one day
TRACK_KEYS = ("event_id", "station_id", "observation_date", "sv")

# fixed values: reasons that rule a station-day out, with their texts
DAY_REASONS = {
    "out_of_window": "record does not overlap the event window",
    "empty_observations": "georinex returned no GPS observation rows",
    "empty_gps_rows": "no GPS rows remained after filtering",
    "missing_phase_pair": "no compatible dual-frequency phase pair",
    "missing_station_position": "station coordinates unavailable in manifest and RINEX header",
}
