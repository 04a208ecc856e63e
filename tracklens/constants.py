"""They must be exactly these for results to be right."""

# --- Catalog filters -------------------------------------------------------
EXCLUDED_STYLE_IDS = [70203, 70204, 80201, 80401, 90102, 90106, 100103]
MIN_POP_SCORE = 0.2
VOCAL_ROLE = "VOCAL"
REPORT_GENRE_IDS = [19, 20, 22]

# --- Speech metrics --------------------------------------------------------
NO_SPEECH_LIMIT = 0.6
TIER_THRESHOLDS = [28, 20, 16, 13, 10]
VERDICT_UNIQUE_WORDS = 28
VERDICT_SPEECH_SECONDS = 20.0

METRIC_COLUMNS = [
    "track_id",
    "text_length",
    "all_seg_cnt",
    "total_duration",
    "speech_duration",
    "speech_ratio",
    "nsp06_seg_cnt",
    "nsp06_word_cnt",
    "nsp06_unique_word_cnt",
]
DOUBLE_METRICS = ["total_duration", "speech_duration", "speech_ratio"]
# The daily load names one of its double columns with this spelling, so under
# the original contract ``total_duration`` falls through to the integer cast.
DOUBLE_METRICS_AS_SPELLED = ["total_duaration", "speech_duration", "speech_ratio"]
DAY_COLUMN = "yyyymmdd"

# Words are parted by white space, meaning the Unicode set that Python's
# ``str.isspace`` knows and not the ASCII set of Java's \s.
SPACE_PATTERN = r"[\s\x1c-\x1f\x85\p{Z}]+"

# --- Audio excerpt ---------------------------------------------------------
SAMPLE_RATE = 16000
KEEP_WHOLE_BELOW_SECONDS = 90
SLICE_SECONDS = 30

# --- Run log ---------------------------------------------------------------
DETECTED_PHRASE = "Voice detected"
NOT_DETECTED_PHRASE = "Voice is not detected"
TIMING_PHRASE = "Total Processing Time"
ERROR_PREFIX = "ERROR:"

RUN_TIME_ZONE = "Asia/Seoul"
