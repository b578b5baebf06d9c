"""Word lists, lookup tables, limits and text formats that define results."""

from __future__ import annotations

# --- Fixed values: sizes and rates -----------------------------------------
KIB = 1024
MIB = 1024 * 1024
GIB = 1024 * 1024 * 1024
SIZE_UNITS = ["B", "KB", "MB", "GB", "TB"]
SMALL_BELOW = 1 * MIB
MEDIUM_BELOW = 50 * MIB
LARGE_FILE_ABOVE = 10 * MIB

GB_PER_HOUR = 10
STORAGE_COST_PER_GB = 0.023
ARCHIVE_COST_PER_GB = 0.002
ARCHIVE_AFTER_DAYS = 30
MAX_BATCH_SIZE = 1000
FILES_PER_SECOND_HOST_COPY = 50
TURBO_FILES_PER_SECOND = 25
PLAIN_FILES_PER_SECOND = 5

# average size limit in bytes -> batch size; larger averages use the last value
ADAPTIVE_BATCH = [(1_000_000, 100), (10_000_000, 50)]
ADAPTIVE_BATCH_OTHERWISE = 20

# age below this many seconds -> class
AGE_CLASSES = [(3600, "recent"), (86_400, "today"), (172_800, "yesterday")]
AGE_OTHERWISE = "older"

# rule, level, metric, lower bound (exclusive), upper bound (inclusive)
ALERT_RULES = [
    ("disk_low", "danger", "disk_usage_pct", 90.0, float("inf")),
    ("disk_filling", "warning", "disk_usage_pct", 80.0, 90.0),
    ("high_error_rate", "warning", "error_rate", 10.0, float("inf")),
    ("almost_complete", "success", "progress_pct", 95.0, float("inf")),
]

# --- Fixed values: target limits -------------------------------------------
MAX_FILE_BYTES = 100 * GIB
MAX_PATH_CHARS = 400
SPECIAL_CHARACTERS = r'[\x00-\x1f\x7f\\:*?"<>|]'

# --- Fixed values: file kinds ----------------------------------------------
TRANSFER_EXTENSIONS = [".pdf", ".xls", ".xlsx", ".msg", ".jpg", ".png"]
SKIPPED_FOLDERS = ["Forms", "_rels", "Private"]
NO_EXTENSION = "no_extension"
ROOT_DIRECTORY = "."

# name contains (lower case) -> type, first match wins
DOCUMENT_WORDS = [
    ("invoice", "Invoice"),
    ("receipt", "Receipt"),
    ("contract", "Contract"),
    ("statement", "Statement"),
]
# extension -> type, tried after the words
DOCUMENT_EXTENSIONS = [
    ([".pdf", ".doc", ".docx"], "Document"),
    ([".xls", ".xlsx", ".csv"], "Spreadsheet"),
    ([".jpg", ".jpeg", ".png", ".tiff"], "Image"),
]
DOCUMENT_OTHERWISE = "Other"

# --- Fixed values: failure classes -----------------------------------------
# (label, codes found in the raw text, words found in the lower-cased text)
ERROR_RULES = {
    "log": [
        ("Authentication", ["401"], ["unauthorized"]),
        ("File Not Found", ["404"], ["not found"]),
        ("Timeout", [], ["timeout"]),
        ("Connection", [], ["connection"]),
        ("Rate Limit", ["429"], []),
        ("Server Error", ["500", "503"], []),
    ],
    "monitor": [
        ("Authentication", ["401"], ["unauthorized"]),
        ("File Not Found", ["404"], ["not found"]),
        ("Timeout", [], ["timeout", "timed out"]),
        ("Connection", [], ["connection"]),
        ("Permission", [], ["permission", "access"]),
        ("Rate Limit", ["429"], ["rate limit"]),
        ("Server Error", ["500", "503", "502"], []),
    ],
    "insight": [
        ("Rate Limiting (429)", ["429"], []),
        ("Timeout", [], ["timeout"]),
        ("Connection Error", [], ["connection"]),
        ("File Not Found (404)", ["404"], []),
        ("Access Denied (403)", ["403"], []),
    ],
}
ERROR_OTHERWISE = {"log": "Other", "monitor": "Other", "insight": "Other Error"}
DETAIL_PREFIX_CHARS = 50
UNKNOWN_ERROR = "Unknown error"
NOT_DOWNLOADED = "Not found in downloaded files"
DOWNLOAD_FAILED = "Download failed"

# --- Fixed values: log line formats ----------------------------------------
LOG_TIMESTAMP = r"(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2},\d{3})"
LOG_LEVEL = r"- (INFO|WARNING|ERROR|DEBUG) -"
# (event type, pattern), tried in this order, first match names the event
LOG_EVENTS = [
    ("turbo_progress", r"🔥 TURBO Progress: (\d+)/(\d+) \((\d+\.?\d*)%\) - (\d+) new downloads"),
    ("speed", r"🚀 Speed: ([\d\.]+) files/sec"),
    ("eta", r"ETA: ([\d\.]+) hours"),
    ("download_success", r"✅ Downloaded: (.+)"),
    ("download_failed", r"❌ (.+) failed for (.+): (.+)"),
    ("auth_token", r"🔐 .*Authenticating"),
    ("folder_processing", r"📁 Processing folder: (.+)"),
    ("turbo_mode", r"🚀 TURBO MODE: Using (\d+) parallel workers"),
    ("resume", r"📂 TURBO: Resuming from file (\d+)/(\d+)"),
]
# plain text every match of the pattern holds: a cheap test before the pattern
LOG_EVENT_TEXT = {
    "turbo_progress": "TURBO Progress: ",
    "speed": " Speed: ",
    "eta": "ETA: ",
    "download_success": " Downloaded: ",
    "download_failed": " failed for ",
    "auth_token": "Authenticating",
    "folder_processing": " Processing folder: ",
    "turbo_mode": " TURBO MODE: Using ",
    "resume": " TURBO: Resuming from file ",
}
# corrected reading of failure lines: the file ends at the first ": "
LOG_FAILED_FIRST_COLON = r"❌ (.+?) failed for (.+?): (.+)"
MESSAGE_CHARS = 100
PATH_TAIL_CHARS = 50

# --- Fixed values: catalogue columns ---------------------------------------
CATALOG_COLUMNS = [
    ("file_id", "STRING"),
    ("file_name", "STRING"),
    ("file_path", "STRING"),
    ("target_path", "STRING"),
    ("file_size_bytes", "BIGINT"),
    ("file_extension", "STRING"),
    ("mime_type", "STRING"),
    ("created_date", "TIMESTAMP_NTZ"),
    ("modified_date", "TIMESTAMP_NTZ"),
    ("migration_date", "TIMESTAMP_NTZ"),
    ("migration_status", "STRING"),
    ("checksum", "STRING"),
    ("source_system", "STRING"),
    ("document_type", "STRING"),
    ("folder_structure", "STRING"),
]
