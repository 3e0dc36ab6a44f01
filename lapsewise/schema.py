"""Schemas and fixed value lists of the activity log."""

from pyspark.sql import types as T

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("userId", T.StringType()),
        T.StructField("sessionId", T.LongType()),
        T.StructField("ts", T.LongType()),
        T.StructField("registration", T.LongType()),
        T.StructField("page", T.StringType()),
        T.StructField("auth", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("level", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("firstName", T.StringType()),
        T.StructField("lastName", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("userAgent", T.StringType()),
        T.StructField("artist", T.StringType()),
        T.StructField("song", T.StringType()),
        T.StructField("length", T.DoubleType()),
    ]
)

# Fixed values of the log format: results depend on these exact names.
CHURN_PAGE = "Cancellation Confirmation"
DOWNGRADE_PAGE = "Submit Downgrade"
SONG_PAGE = "NextSong"

PAGES = [
    "About",
    "Add Friend",
    "Add to Playlist",
    "Cancel",
    "Cancellation Confirmation",
    "Downgrade",
    "Error",
    "Help",
    "Home",
    "Logout",
    "NextSong",
    "Roll Advert",
    "Save Settings",
    "Settings",
    "Submit Downgrade",
    "Submit Upgrade",
    "Thumbs Down",
    "Thumbs Up",
    "Upgrade",
]
# The cancellation pages would leak the label; song plays have features of their own.
UNRATED_PAGES = ["Cancel", "Cancellation Confirmation", "NextSong"]
RATED_PAGES = [p for p in PAGES if p not in UNRATED_PAGES]
# Pages shown as box plots per churn group.
BOXED_PAGES = [p for p in PAGES if p not in ("Cancel", "Cancellation Confirmation", "Upgrade")]

DEVICES = ["Windows", "Macintosh", "X11", "iPhone", "iPad", "compatible"]
BROWSERS = ["Firefox", "Gecko", "Safari", "Trident"]

USER_ATTRIBUTES = ["firstName", "lastName", "gender", "userAgent", "location", "registration"]


def page_slug(page: str) -> str:
    """Column name of a page: 'Thumbs Up' -> 'page_thumbs_up'."""
    return "page_" + page.replace(" ", "_").lower()


PAGE_RATE_FEATURES = [page_slug(p) + "_hourly" for p in RATED_PAGES]

# Order of the feature table; correlation pruning depends on it.
FEATURES = (
    ["gender", "level"]
    + DEVICES
    + BROWSERS
    + [
        "count_logs",
        "count_sessions",
        "count_distinct_artists",
        "count_songs",
        "count_distinct_songs",
        "sum_length_minutes",
        "days_since_registration",
        "avg_songs_per_session",
        "avg_session_length",
        "total_hours",
    ]
    + PAGE_RATE_FEATURES
    + ["session_interval"]
)
