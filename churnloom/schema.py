"""Column names, types and fixed values shared by all operators."""

from __future__ import annotations

from pyspark.sql import types as T

# Columns and types of the log.
LOG_SCHEMA = T.StructType(
    [
        T.StructField("userId", T.StringType()),
        T.StructField("firstName", T.StringType()),
        T.StructField("lastName", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("userAgent", T.StringType()),
        T.StructField("level", T.StringType()),
        T.StructField("registration", T.LongType()),
        T.StructField("artist", T.StringType()),
        T.StructField("song", T.StringType()),
        T.StructField("length", T.DoubleType()),
        T.StructField("auth", T.StringType()),
        T.StructField("itemInSession", T.LongType()),
        T.StructField("method", T.StringType()),
        T.StructField("page", T.StringType()),
        T.StructField("sessionId", T.LongType()),
        T.StructField("status", T.LongType()),
        T.StructField("ts", T.LongType()),
    ]
)

LOG_COLUMNS = LOG_SCHEMA.fieldNames()

# The page each per-user counter counts.
PAGE_COUNTERS = {
    "nr_songs": "NextSong",
    "nr_playlist": "Add to Playlist",
    "nr_friends": "Add Friend",
    "nr_likes": "Thumbs Up",
    "nr_dislikes": "Thumbs Down",
    "nr_downgrades": "Downgrade",
    "nr_upgrades": "Upgrade",
    "nr_home": "Home",
    "nr_settings": "Settings",
    "nr_error": "Error",
    "nr_ads": "Roll Advert",
}

CHURN_PAGE = "Cancellation Confirmation"

# The 20 numeric features, in table order; the flags gender, level, churn follow them.
NUMERIC_FEATURES = [
    *PAGE_COUNTERS,
    "nr_sessions",
    "n_acts",
    "avg_sess_h",
    "acts_per_session",
    "songs_per_session",
    "ads_per_session",
    "init_days_interv",
    "tenure_days_interv",
    "active_days",
]
FLAGS_V2 = ["gender", "level", "churn"]
FLAGS_V1 = ["gender", "level", "downgrade", "churn"]

# Columns removed after the relevance study (sample log / full log).
WEAK_COLUMNS_SAMPLE = ["nr_ads", "nr_upgrades", "nr_playlist", "nr_home", "nr_songs"]
WEAK_COLUMNS_FULL = ["gender", "avg_sess_h", "nr_playlist", "nr_home"]

# Model inputs of the two modelling generations.
BINARY_V2 = ["level"]
CONTINUOUS_V2 = [
    "nr_songs", "nr_likes", "nr_dislikes", "nr_friends", "nr_downgrades", "nr_upgrades",
    "nr_error", "nr_settings", "nr_ads", "nr_sessions", "n_acts", "acts_per_session",
    "songs_per_session", "ads_per_session", "init_days_interv", "tenure_days_interv",
    "active_days",
]
BINARY_V1 = ["gender", "level", "downgrade"]
CONTINUOUS_V1 = [
    "nr_songs", "nr_likes", "nr_dislikes", "nr_playlist", "nr_friends", "nr_downgrades",
    "nr_upgrades", "nr_home", "nr_error", "nr_settings", "nr_ads", "nr_sessions",
    "n_acts", "avg_sess_h", "acts_per_session", "songs_per_session", "ads_per_session",
    "init_days_interv", "tenure_days_interv", "active_days",
]

KEY = "userId"
SEED = 1234
