"""The event log as a view over the ``events`` table (and customer, nation, region).

The mapping is the one written down in FIXTURES.md. Only the lookups that the wanted columns
depend on become part of the plan, so a query over page and status never touches customers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnloom.schema import LOG_COLUMNS
from churnloom.session import pin_utc

_FROM_PAGE = {"page", "auth", "artist", "song", "length", "method", "status"}
_FROM_CUSTOMER = {"location", "firstName", "lastName"}

_MINUTE_US = 60_000_000
_DAY_US = 86_400_000_000


def activity_log(spark: SparkSession, sf_dir: str, columns: Sequence[str] = LOG_COLUMNS) -> DataFrame:
    """Event log with the wanted ``columns``, one row per row of ``events``."""
    pin_utc(spark)
    wanted = set(columns)
    events = (
        spark.read.parquet(f"{sf_dir}/events.parquet")
        .selectExpr(
            "event_id", "user_id", "event_type", "value",
            "unix_micros(CAST(ts AS TIMESTAMP)) AS us", "event_id % 31 = 0 AS blank",
        )
    )
    if wanted & _FROM_PAGE:
        events = _mark_last_event(events)
    if "itemInSession" in wanted:
        events = _number_items(events)
    if wanted & _FROM_CUSTOMER:
        events = events.join(_customer_places(spark, sf_dir), "user_id", "left")
    derived = events.withColumn("page", F.expr(_PAGE)) if wanted & _FROM_PAGE else events
    return derived.selectExpr(*[f"{_COLUMNS[c]} AS {c}" for c in columns])


def _mark_last_event(events: DataFrame) -> DataFrame:
    """Flag the last non-blank event of every fourth user (the cancelling ones).

    The newest event comes from a partial aggregation and is matched back on its own id, so a
    hot user is never gathered in one place.
    """
    # microseconds and event id in one fixed-width number of 38 digits: the largest is the latest event
    wide = 1 << 63
    newest = f"CAST(us AS DECIMAL(19,0)) * {wide}BD + event_id"
    last = (
        events.where("NOT blank AND user_id % 4 = 1")
        .groupBy("user_id")
        .agg(F.expr(f"max(CAST({newest} AS DECIMAL(38,0))) AS newest"))
        .selectExpr("user_id", f"CAST(pmod(newest, {wide}BD) AS BIGINT) AS event_id", "true AS cancels")
    )
    return events.join(last, ["user_id", "event_id"], "left")


def _number_items(events: DataFrame) -> DataFrame:
    """0-based position of an event among its user's events of the same day.

    Counted per minute first; the running count over the minutes of one day (1440 at most) gives
    each minute its offset, and only the events of one minute are ordered together.
    """
    timed = events.selectExpr("*", f"us div {_MINUTE_US} AS minute", f"us div {_DAY_US} AS day")
    offsets = (
        timed.groupBy("user_id", "day", "minute")
        .agg(F.expr("count(1) AS n"))
        .selectExpr(
            "user_id AS of_user",
            "minute AS of_minute",
            """coalesce(sum(n) OVER (PARTITION BY user_id, day ORDER BY minute
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier""",
        )
    )
    # an event without a user keeps its row, as one more user
    return timed.join(offsets, F.col("user_id").eqNullSafe(F.col("of_user")) & (F.col("minute") == F.col("of_minute"))).selectExpr(
        *events.columns,
        "earlier + row_number() OVER (PARTITION BY user_id, minute ORDER BY us, event_id) - 1 AS item",
    )


def _customer_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    nation, region = table("nation"), table("region")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select("n_nationkey", "n_name", "r_name")
    customer = table("customer").select("c_custkey", "c_name", "c_nationkey")
    return customer.join(places, customer.c_nationkey == places.n_nationkey, "left").select(
        F.col("c_custkey").alias("user_id"), "c_name", "n_name", "r_name"
    )


# The mapping of FIXTURES.md.
_PAGE = """
CASE WHEN cancels THEN 'Cancellation Confirmation'
     WHEN event_type = 'view' THEN 'NextSong'
     WHEN event_type = 'click' THEN elt(event_id % 4 + 1, 'Thumbs Up', 'Thumbs Down', 'Add to Playlist', 'Add Friend')
     WHEN event_type = 'purchase' THEN elt(event_id % 4 + 1, 'Upgrade', 'Downgrade', 'Roll Advert', 'Submit Upgrade')
     WHEN event_type = 'error' THEN elt(event_id % 4 + 1, 'Error', 'Help', 'Settings', 'Logout')
     WHEN event_type = 'signup' THEN elt(event_id % 4 + 1, 'Home', 'About', 'NextSong', 'Roll Advert')
END"""

_COLUMNS = {
    "userId": "CASE WHEN blank THEN '' ELSE CAST(user_id AS STRING) END",
    "firstName": "CASE WHEN NOT blank THEN 'Customer' END",
    "lastName": "CASE WHEN NOT blank THEN c_name END",
    "gender": "CASE WHEN NOT blank THEN CASE WHEN user_id % 3 = 0 THEN 'M' ELSE 'F' END END",
    "location": "CASE WHEN NOT blank THEN CASE WHEN user_id % 50 = 0 THEN n_name ELSE concat(n_name, ', ', r_name) END END",
    "userAgent": "CASE WHEN NOT blank THEN concat('Agent/', CAST(user_id % 7 AS STRING)) END",
    "level": "CASE WHEN value >= 50 THEN 'paid' ELSE 'free' END",
    "registration": "CASE WHEN NOT blank THEN 1701388800000 + (user_id % 30) * 86400000 + user_id * 1000 END",
    "artist": "CASE WHEN page = 'NextSong' THEN concat('artist-', CAST(event_id % 13 AS STRING)) END",
    "song": "CASE WHEN page = 'NextSong' THEN concat('song-', CAST(event_id % 97 AS STRING)) END",
    "length": "CASE WHEN page = 'NextSong' THEN value * 5D END",
    "auth": """CASE WHEN blank THEN CASE WHEN event_id % 62 = 0 THEN 'Guest' ELSE 'Logged Out' END
        WHEN page = 'Cancellation Confirmation' THEN 'Cancelled' ELSE 'Logged In' END""",
    "itemInSession": "item",
    "method": """CASE WHEN page IN ('NextSong', 'Thumbs Up', 'Thumbs Down', 'Add to Playlist', 'Add Friend', 'Logout')
        THEN 'PUT' ELSE 'GET' END""",
    "page": "page",
    # 2024-01-01 is day 19723 of the epoch
    "sessionId": f"(us div {_DAY_US} - 19723) * 3 + user_id % 3",
    "status": """CASE WHEN page = 'Error' THEN 404L WHEN page IN ('Logout', 'Submit Upgrade', 'Thumbs Up') THEN 307L
        ELSE 200L END""",
    "ts": "us div 1000",
}


# The same view in SQL, for side-by-side checks in another engine.
LOG_SQL = """
numbered AS (
  SELECT e.*, e.event_id % 31 = 0 AS blank, date_diff('day', DATE '2024-01-01', CAST(e.ts AS DATE)) AS day_no
  FROM events e
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, day_no ORDER BY ts, event_id) - 1 AS item_no,
         row_number() OVER (PARTITION BY user_id, blank ORDER BY ts DESC, event_id DESC) AS rn_desc
  FROM numbered
),
paged AS (
  SELECT r.*, c.c_name, n.n_name, g.r_name, c.c_custkey,
    CASE WHEN NOT blank AND user_id % 4 = 1 AND rn_desc = 1 THEN 'Cancellation Confirmation'
         WHEN event_type = 'view' THEN 'NextSong'
         WHEN event_type = 'click' THEN CASE event_id % 4 WHEN 0 THEN 'Thumbs Up' WHEN 1 THEN 'Thumbs Down'
                                             WHEN 2 THEN 'Add to Playlist' ELSE 'Add Friend' END
         WHEN event_type = 'purchase' THEN CASE event_id % 4 WHEN 0 THEN 'Upgrade' WHEN 1 THEN 'Downgrade'
                                             WHEN 2 THEN 'Roll Advert' ELSE 'Submit Upgrade' END
         WHEN event_type = 'error' THEN CASE event_id % 4 WHEN 0 THEN 'Error' WHEN 1 THEN 'Help'
                                             WHEN 2 THEN 'Settings' ELSE 'Logout' END
         WHEN event_type = 'signup' THEN CASE event_id % 4 WHEN 0 THEN 'Home' WHEN 1 THEN 'About'
                                             WHEN 2 THEN 'NextSong' ELSE 'Roll Advert' END
    END AS page
  FROM ranked r
  LEFT JOIN customer c ON c.c_custkey = r.user_id
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN region g ON g.r_regionkey = n.n_regionkey
),
log AS (
  SELECT
    CASE WHEN blank THEN '' ELSE CAST(user_id AS VARCHAR) END AS "userId",
    CASE WHEN NOT blank THEN 'Customer' END AS "firstName",
    CASE WHEN NOT blank THEN c_name END AS "lastName",
    CASE WHEN NOT blank THEN CASE WHEN user_id % 3 = 0 THEN 'M' ELSE 'F' END END AS gender,
    CASE WHEN NOT blank THEN CASE WHEN user_id % 50 = 0 THEN n_name ELSE n_name || ', ' || r_name END END AS location,
    CASE WHEN NOT blank THEN 'Agent/' || CAST(user_id % 7 AS VARCHAR) END AS "userAgent",
    CASE WHEN value >= 50 THEN 'paid' ELSE 'free' END AS level,
    CASE WHEN NOT blank THEN 1701388800000 + (user_id % 30) * 86400000 + user_id * 1000 END AS registration,
    CASE WHEN page = 'NextSong' THEN 'artist-' || CAST(event_id % 13 AS VARCHAR) END AS artist,
    CASE WHEN page = 'NextSong' THEN 'song-' || CAST(event_id % 97 AS VARCHAR) END AS song,
    CASE WHEN page = 'NextSong' THEN value * CAST(5 AS DOUBLE) END AS length,
    CASE WHEN blank THEN CASE WHEN event_id % 62 = 0 THEN 'Guest' ELSE 'Logged Out' END
         WHEN page = 'Cancellation Confirmation' THEN 'Cancelled' ELSE 'Logged In' END AS auth,
    CAST(item_no AS BIGINT) AS "itemInSession",
    CASE WHEN page IN ('NextSong', 'Thumbs Up', 'Thumbs Down', 'Add to Playlist', 'Add Friend', 'Logout')
         THEN 'PUT' ELSE 'GET' END AS method,
    page,
    CAST(day_no * 3 + user_id % 3 AS BIGINT) AS "sessionId",
    CAST(CASE WHEN page = 'Error' THEN 404 WHEN page IN ('Logout', 'Submit Upgrade', 'Thumbs Up') THEN 307
              ELSE 200 END AS BIGINT) AS status,
    epoch_us(ts) // 1000 AS ts
  FROM paged
)
"""
