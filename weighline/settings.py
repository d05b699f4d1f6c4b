"""Fixed values of the weighing-telemetry domain.

Everything in this module must equal the values the factory already uses, so it is kept together as plain
constants.  Functions take them as default arguments; nothing reads environment variables.
"""

FACTORY_ZONE = "Europe/Madrid"
TOPIC_FILTER = "factory/#"

# --- fixed values: accepted source names per canonical column, in order of priority -----------------------------
ALIASES = {
    "net_weight": ["ActualNetWeightValue", "Peso", "Weight", "PesoNeto", "net_weight", "val_weight"],
    "printed_weight": ["PrintedNetWeightValue", "PesoImpreso", "PrintWeight"],
    "article_name": ["ArticleName", "Producto", "Product_ID", "Article", "article_name"],
    "article_number": ["ArticleNumber", "CodigoArticulo", "ItemCode", "ArtNum", "article_number"],
    "batch_code": ["BatchNumber", "Lote", "Batch", "Lot_ID", "batch_code", "batch"],
    "timestamp": ["Timestamp", "Fecha", "Date", "Time", "EventTime", "timestamp"],
    "serverTime": ["CreationDate"],
    "reject_flag": ["totalEnumerator", "TotalNumerator", "TotalNumerator1", "Reject", "Rechazo", "Error", "Status_Flag"],
    "operator_id": ["User", "Usuario", "Operator", "user_id"],
    "record_uuid": ["Id", "UUID", "RecordID", "uid"],
    "linea": ["DeviceName", "Line", "Source", "device_name"],
    "identity": ["Identity"],
    "active_workers": ["active_workers", "workers", "num_trabajadores", "operarios"],
}
# Names without an alias entry that are read as they stand.
PLAIN_COLUMNS = ["quality_status", "tare_g", "mqtt_topic", "CreationDateUtc", "device_id"]

# --- fixed values: output columns -------------------------------------------------------------------------------
HOT_COLUMNS = [
    "timestamp", "mqtt_topic", "linea", "batch_code", "article_number", "article_name", "number_refactor",
    "batch_instance_id", "batch_start_time", "batch_sequence", "net_weight", "clean_net_weight_g", "target_weight_g",
    "giveaway_g", "tare_g", "quality_status", "quality_mismatch", "reject_flag", "active_workers", "shift",
    "record_uuid", "identity",
]
HOT_NUMERIC = [
    "active_workers", "net_weight", "giveaway_g", "identity", "target_value", "clean_net_weight_g", "tare_g",
    "target_weight_g", "quality_mismatch", "reject_flag", "batch_sequence",
]
HOT_INTEGER = ["batch_sequence", "identity", "active_workers", "reject_flag", "quality_mismatch"]
HOT_TAGS = [
    "linea", "batch_instance_id", "article_name", "quality_status", "shift", "batch_code", "mqtt_topic",
    "article_number", "machine_name", "machine_id", "operator_id", "number_refactor",
]

# --- fixed values: thresholds -----------------------------------------------------------------------------------
DEFAULT_WORKERS = {"Linea_0202": 3, "Linea_0203": 4, "Linea_0204": 2, "Linea_0205": 3, "default": 1}
MAX_WORKERS_PER_LINE = 100
JITTER_MODULUS = 10_000_000
ROLLOVER_THRESHOLD = 1000
MAX_RETRIES = 3
MAX_GAP_SECONDS = 3600
STOP_THRESHOLD_SECONDS = 600
LAG_THRESHOLD_SECONDS = 900
HISTORY_CAP = 50
SHIFT_START = 6 * 3600
SHIFT_END = 19 * 3600 + 30 * 60
LUNCH_START = 13 * 3600 + 30 * 60
AFTERNOON_START = 15 * 3600
DURATION_BUCKETS = [0.1, 0.5, 1.0, 2.5, 5.0, 10.0]
MICRO_BATCH_ROWS = 100
MICRO_BATCH_SECONDS = 10
WATCHDOG_SECONDS = 60

# --- fixed values: patterns -------------------------------------------------------------------------------------
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
CLOCK_PATTERN = r"^\+?\d{1,2}:\+?\d{1,2}$"
WEIGHT_TEXT_PATTERN = r"(?i)([\d\s]+[.,]?\d*)\s*(k?g)"
LINE_NUMBER_PATTERN = r"[Ll][ií]nea[_\s]*(\d+)"
LINE_ID_PATTERN = r"^[a-zA-Z0-9_-]{1,50}$"
MISSING_TIMESTAMP_TEXT = ["", "nan", "NaN", "NAN", "nat", "NaT", "NAT", "None"]
UNKNOWN_ARTICLE = "UNKNOWN_PRODUCT"
UNKNOWN_REF = "UNKNOWN_REF"

# --- fixed values: alert wording --------------------------------------------------------------------------------
STOP_TYPE = "LINE STOP (>10min)"
RETURN_TYPE = "GLOBAL_RETURN"
STOP_LINE_TEXT = "UNEXPECTED STOP"
STOP_MESSAGE = "STOP DETECTED: %s has been inactive for %d minutes (last product: %s)"
RETURN_MESSAGE = "GLOBAL RETURN: %s — previously on %s (ended %s, gap %.1fh)"
SUBJECT = "ALERT: %s — %s"

# --- scale settings (ours) --------------------------------------------------------------------------------------
SLICE_SECONDS = 60               # width of the time slices a line's history is cut into
SLICE_TARGET_ROWS = 4_000_000    # slices above this are cut finer
BROADCAST_ROWS = 500_000         # a side is broadcast only when its counted rows stay below this
