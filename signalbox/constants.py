"""Fixed values and default parameters.

The values under "Fixed values" must stay exactly as written for results to
match the feed's conventions and the established report output.
"""

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------

# Feed message kinds (header.msg_type).
MSG_TYPE_CANCELLATION = "0002"
MSG_TYPE_MOVEMENT = "0003"

# Movement status label counted as "late" (compared case-insensitively in reports).
LATE_STATUS = "LATE"

# Label used for missing categorical values in distributions.
UNKNOWN_LABEL = "unknown"

# Anomaly detection thresholds.
DELAY_THRESHOLD_SECONDS = 30 * 60
Z_SCORE_THRESHOLD = 3.0
MIN_STATION_SAMPLES = 5
CANCELLATION_SPIKE_THRESHOLD = 5
CANCELLATION_SPIKE_WINDOW = "1 hour"

# Anomaly rows: source, type, explanation.
EVENT_SOURCE_MOVEMENT = "movement"
EVENT_SOURCE_CANCELLATION = "cancellation"
ANOMALY_LARGE_DELAY = "large_delay"
ANOMALY_STATION_OUTLIER = "station_delay_outlier"
ANOMALY_CANCELLATION_SPIKE = "cancellation_spike"
CANCELLATION_SPIKE_EVENT_TYPE = "CANCELLATION_SPIKE"
EXPLANATION_LARGE_DELAY = "Train delay is at least 30 minutes."
EXPLANATION_STATION_OUTLIER = (
    "Delay is unusually high compared with other delays at the same station."
)
EXPLANATION_CANCELLATION_SPIKE = (
    "Unusually many cancellations occurred at the same station within one hour."
)

# Display labels for anomaly types.
ANOMALY_TYPE_LABELS = {
    "large_delay": "Large Delay",
    "station_delay_outlier": "Station Delay Outlier",
    "cancellation_spike": "Cancellation Spike",
}

# Station map styling.
LARGE_DELAY_MINUTES = 30
MARKER_EVENT_CLIP = (1, 100)
MARKER_EVENT_SCALE = 1000
MARKER_ABNORMAL_CLIP = (1, 20)
MARKER_ABNORMAL_SCALE = 900
DELAY_COLOR_CLIP_MINUTES = 60
DELAY_COLOR_BASE = (80, 180, 80, 80)
DELAY_COLOR_RED_SPAN = 175
DELAY_COLOR_GREEN_SPAN = 140
ABNORMAL_COLOR = (255, 220, 0, 230)
NO_ABNORMAL_COLOR = (0, 0, 0, 0)
DEFAULT_ABNORMAL_MAP_MIN = 3

# Report sizes.
TOP_N = 10
STATISTICS_ROWS = 20
PREVIEW_ROWS = 100

# Window aggregate of the event stream.
STATION_WINDOW = "10 minutes"

# Streaming defaults.
MAX_FILES_PER_TRIGGER = 10
FEED_TRIGGER_INTERVAL = "30 seconds"
WINDOW_TRIGGER_INTERVAL = "5 seconds"

# ---------------------------------------------------------------------------
# Engine parameters (not part of the fixed values above)
# ---------------------------------------------------------------------------

# Upper bounds for a dimension or per-key statistics frame that may be
# broadcast: rows, and estimated bytes (rows x schema row width). Larger
# frames are joined with a shuffle join instead.
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024

# Time buckets offered by the time-series report.
TIME_BUCKETS = {"10min": "10 minutes", "1h": "1 hour", "1D": "1 day"}
