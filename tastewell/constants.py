"""Results depend on them, so they are stated once, as plain text."""

# --- Fixed values -----------------------------------------------------------
NO_GENRES = "(no genres listed)"
UNKNOWN = "Unknown"
MISSING_DETAIL = "--"
NOT_AVAILABLE = "N/A"
LATEST_RUN = "LATEST_RUN"

RATING_BINS = [0.5, 1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 4.5, 5.0]
MIN_SCORE = 0.0
MAX_SCORE = 5.0

MODELS = ["als", "cbf", "hybrid"]

TEXT_DIMENSIONS = 512
TAGS_PER_MOVIE = 100
LIKE_THRESHOLD = 4.0
QUALITY_MIN_AVERAGE = 3.8
QUALITY_MIN_VOTES = 100
DEFAULT_RATING = 3.0
LIST_SIZE = 10

SIMILARITY_WEIGHT = 0.6
AVERAGE_WEIGHT = 0.4

ALS_RANK = 10
ALS_REGULARISATION = 0.1
ALS_WEIGHT = 0.7
CBF_WEIGHT = 0.3
HYBRID_MIN_VOTES = 10

TRAIN_FRACTION = 0.8
SPLIT_SEED = 42
CHART_LABEL_SHARE = 0.03
LISTING_USERS = 100
REPORT_GENRES = 3
# ----------------------------------------------------------------------------
