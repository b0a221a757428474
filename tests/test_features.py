"""User features on hand-made logs, and against their definitions in plain Python."""

import pytest
from pyspark.sql import functions as F

from churnloom.operators.clean import clean_profile, clean_v1, clean_v2, cleaning_report
from churnloom.operators.features import features_v1, features_v2
from churnloom.operators.sessions import preprocess_v1, preprocess_v2
from churnloom.queries.common import V2_LOG
from churnloom.schema import FLAGS_V2, NUMERIC_FEATURES, PAGE_COUNTERS
from churnloom.session import cut_lineage
from churnloom.sources.activity_log import activity_log
from conftest import DATA

H = 3_600_000


def one(df, user="1"):
    return df.where(F.col("userId") == user).first()


def test_blank_and_null_users_go(make_log):
    log = make_log({"userId": ""}, {"userId": None}, {"userId": "7"})
    assert [r.userId for r in clean_v2(log).collect()] == ["7"]
    r = cleaning_report(log).first()
    assert (r.rows_before, r.rows_after, r.rows_removed) == (3, 1, 2)


def test_location_without_comma(make_log):
    log = make_log({"location": "Guam"}, {"location": None}, {"location": "A, B, C"})
    got = {(r.city, r.state) for r in clean_v1(log).collect()}
    assert got == {("Guam", None), (None, None), ("A", " B")}


def test_profile_flavour_columns(make_log):
    cols = clean_profile(make_log({})).columns
    assert "method" in cols and "status" in cols and "date_ts" in cols and "ts" not in cols


def test_one_event_session_has_no_length(make_log):
    assert one(features_v2(clean_v2(make_log({})))).avg_sess_h == 0.0


def test_session_mean_is_weighted_by_events(make_log):
    t = 1_700_086_400_000
    rows = [{"sessionId": 1, "ts": t}]
    rows += [{"sessionId": 2, "ts": t + 10 * H + k * H, "itemInSession": k} for k in range(9)]
    assert one(features_v2(clean_v2(make_log(*rows)))).avg_sess_h == pytest.approx((1 * 0 + 9 * 8) / 10)


def test_items_are_counted_by_value(make_log):
    rows = [{"sessionId": s, "itemInSession": k, "ts": 1_700_086_400_000 + s * H + k} for s in (1, 2) for k in range(3)]
    r = one(features_v2(clean_v2(make_log(*rows))))
    assert (r.n_acts, r.nr_sessions, r.acts_per_session) == (3, 2, 1.5)


def test_shared_session_is_kept_apart_by_user(make_log):
    t = 1_700_086_400_000
    log = make_log({"userId": "1", "ts": t}, {"userId": "1", "ts": t + H}, {"userId": "2", "ts": t + 9 * H})
    f = features_v2(clean_v2(log))
    assert one(f).avg_sess_h == 1.0 and one(f, "2").avg_sess_h == 0.0


def test_level_follows_time_then_item(make_log):
    t = 1_700_086_400_000
    log = make_log(
        {"ts": t, "itemInSession": 1, "level": "paid"},
        {"ts": t, "itemInSession": 0, "level": "free"},
        {"ts": t - 1, "itemInSession": 9, "level": "free", "sessionId": 99},
    )
    assert one(features_v2(clean_v2(log))).level == 1


def test_churn_in_a_small_session(make_log):
    t = 1_700_086_400_000
    log = make_log({"sessionId": 5, "ts": t}, {"sessionId": 2, "ts": t + H, "page": "Cancellation Confirmation"})
    f = features_v2(clean_v2(log))
    assert one(f).churn == 1
    assert f.select("userId", "churn").first().churn == 1  # the same when selected alone


def test_intervals_cut_to_seconds_first(make_log):
    r = one(features_v2(clean_v2(make_log({"registration": 1_700_000_000_999, "ts": 1_700_086_400_001}))))
    assert r.init_days_interv == 1.0


def test_missing_registration_drops_the_user(make_log):
    log = make_log({"registration": None}, {"userId": "2"})
    assert [r.userId for r in features_v2(clean_v2(log)).collect()] == ["2"]
    assert features_v2(clean_v2(log), drop_missing=False).count() == 2


def test_v1_counts_dates_and_midnights(make_log):
    day = 86_400_000
    base = 1_700_006_400_000  # midnight
    log = make_log(
        {"registration": base - 1, "ts": base},
        {"registration": base - 1, "ts": base + 1, "itemInSession": 1},
        {"registration": base - 1, "ts": base + 2 * day, "itemInSession": 2, "page": "Downgrade"},
    )
    r = one(features_v1(clean_v1(log)))
    assert (r.init_days_interv, r.tenure_days_interv, r.active_days, r.downgrade) == (1, 3, 2, 1)


def _by_hand(log):
    """Features from the definitions, user by user in plain Python. ``log``: raw rows, one per event."""
    out = {}
    for user in {e.userId for e in log}:
        mine = [e for e in log if e.userId == user]
        spans = {}
        for e in mine:
            low, high = spans.get(e.sessionId, (e.ts, e.ts))
            spans[e.sessionId] = min(low, e.ts), max(high, e.ts)
        hours = {s: (high - low) / H for s, (low, high) in spans.items()}
        pages = {c: sum(e.page == p for e in mine) for c, p in PAGE_COUNTERS.items()}
        items, sessions = len({e.itemInSession for e in mine}), len(spans)
        first, last, joined = (int(t / 1000) for t in (min(e.ts for e in mine), max(e.ts for e in mine), mine[0].registration))
        newest = max((e.ts, e.itemInSession) for e in mine)
        oldest = min((e.ts, e.itemInSession) for e in mine)
        at = lambda k: [e for e in mine if (e.ts, e.itemInSession) == k]  # noqa: B023, E731
        out[user] = pages | {
            "nr_sessions": sessions,
            "n_acts": items,
            "avg_sess_h": sum(hours[e.sessionId] for e in mine) / len(mine),
            "acts_per_session": items / sessions,
            "songs_per_session": pages["nr_songs"] / sessions,
            "ads_per_session": pages["nr_ads"] / sessions,
            "init_days_interv": (first - joined) / 86400,
            "tenure_days_interv": (last - joined) / 86400,
            "active_days": (last - first) / 86400,
            "gender": int(all(e.gender == "F" for e in at(oldest))),
            "level": int(any(e.level == "paid" for e in at(newest))),
            "churn": int(any(e.page == "Cancellation Confirmation" for e in mine)),
        }
    return out


def test_features_follow_their_definitions(spark):
    log = activity_log(spark, f"{DATA}/sf0.01", V2_LOG)
    got = {r.userId: r for r in features_v2(clean_v2(log)).collect()}
    want = _by_hand([e for e in log.collect() if e.userId])
    assert got.keys() == want.keys() and len(got) == 150
    for user, row in got.items():
        assert list(row[1:]) == pytest.approx([want[user][c] for c in (*NUMERIC_FEATURES, *FLAGS_V2)], abs=1e-9)


def test_items_above_twenty_bits_are_told_apart(make_log):
    rows = [{"itemInSession": 2**20 + 1, "level": "free"}, {"itemInSession": 2**20 + 5, "level": "paid"}]
    for order in (rows, rows[::-1]):
        assert one(features_v2(clean_v2(make_log(*order)))).level == 1
        assert one(features_v1(clean_v1(make_log(*order)))).level == 1


@pytest.mark.parametrize("session", [1, 2])
def test_flags_of_events_that_agree_in_time_and_item(make_log, session):
    rows = [{"level": "paid", "gender": "M", "page": "Downgrade"}, {"level": "free", "gender": "F", "sessionId": session}]
    for order in (rows, rows[::-1]):
        r = one(features_v1(clean_v1(make_log(*order))))
        assert (r.level, r.downgrade, r.gender) == (1, 1, 0)


def test_a_missing_session_keeps_its_marks(make_log):
    t = 1_700_086_400_000
    log = make_log({"sessionId": None, "ts": t}, {"sessionId": None, "ts": t + H, "itemInSession": 1}, {"sessionId": 4, "ts": t + 5 * H})
    for r in preprocess_v2(clean_v2(log)).collect():
        assert (r.firstevent_ts, r.lastevent_ts) == (t / 1000, (t + 5 * H) / 1000)
        assert r.session_h == (1.0 if r.sessionId is None else 0.0)
    v1 = preprocess_v1(clean_v1(log)).collect()
    assert {r.session_h for r in v1} == {0.0, 1.0} and all(r.firstevent_ts and r.active_days == 2 for r in v1)


@pytest.mark.parametrize("build", [lambda log: preprocess_v2(clean_v2(log)), lambda log: preprocess_v1(clean_v1(log))])
def test_session_marks_are_joined_once(spark, make_log, build):
    log = cut_lineage(make_log(*[{"userId": str(k % 5), "itemInSession": k, "sessionId": k % 7} for k in range(50)]))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = build(log)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # the log itself, and the stored sessions twice; the events are shuffled once, for the join
    assert plan.count("FileScan parquet") == 3 and plan.count("Exchange hashpartitioning") <= 7


def test_events_without_a_user_and_large_event_ids(spark, tmp_path):
    import shutil

    for name in ("customer", "nation", "region"):
        shutil.copy(f"{DATA}/sf0.001/{name}.parquet", tmp_path)
    big = 10**13
    rows = [(big + 31, None, "view", 1.0, "2024-01-03 10:00:00"), (big + 2, 5, "view", 1.0, "2024-01-03 10:00:01"), (3, 5, "view", 1.0, "2024-01-03 10:00:02")]
    events = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double, ts string").withColumn("ts", F.to_timestamp("ts"))
    events.write.parquet(str(tmp_path / "events.parquet"))
    log = activity_log(spark, str(tmp_path), ["userId", "page", "itemInSession", "ts"]).collect()
    assert len(log) == 3
    # user 5 cancels with the last event in time, whatever the ids
    assert [r.page for r in sorted(log, key=lambda r: r.ts)][1:] == ["NextSong", "Cancellation Confirmation"]


def test_feature_plan_stays_hash_aggregation(spark):
    clean = clean_v2(activity_log(spark, f"{DATA}/sf0.01", V2_LOG))
    plan = features_v2(clean)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_distinct_items_over_the_whole_range(make_log):
    items = [0, 63, 64, 65, -1, -64, -65, 2**31 + 5, 2**40, -(2**50), 63, 0, None, 2**40]
    log = make_log(*[{"itemInSession": x, "sessionId": k % 3, "ts": 1_700_086_400_000 + k * 1000} for k, x in enumerate(items)])
    assert features_v2(clean_v2(log)).first().n_acts == len({x for x in items if x is not None})
    assert features_v1(clean_v1(log)).first().n_acts == len({x for x in items if x is not None})
    nothing = make_log({"itemInSession": None}, {"itemInSession": None, "sessionId": 2})
    assert features_v2(clean_v2(nothing), drop_missing=False).first().n_acts == 0


@pytest.mark.parametrize("build", [lambda log: features_v2(clean_v2(log)), lambda log: features_v1(clean_v1(log))])
def test_features_read_the_log_once(make_log, build):
    log = cut_lineage(make_log(*[{"userId": str(k % 5), "itemInSession": k, "sessionId": k % 7} for k in range(50)]))
    plan = build(log)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Join" not in plan
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
