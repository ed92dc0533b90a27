"""Session numbering against a straightforward walk over each customer's events."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions.time import timestamp
from tidemark.operators import session_days, sessions
from tidemark.schemas import FACT_EVENTS, SESSION_DAYS

START = datetime(2026, 1, 1, 10, 0, 0)
def run_ts():
    return timestamp("2026-02-01 00:00:00")



def event(i, at, sk, session=None, name="page_view", device="mobile", product=None):
    return (f"e{i:05d}", at, at.date() if at else None, sk, session, name, device, product, START)


def frame(spark, rows):
    return spark.createDataFrame(rows, FACT_EVENTS)


def walk(rows):
    """Effective session and opening flag per event id."""
    out = {}
    for sk in {r[3] for r in rows}:
        previous, group = None, 0
        for r in sorted((r for r in rows if r[3] == sk), key=lambda r: (r[1], r[0])):
            minute = r[1].replace(second=0, microsecond=0)
            gap = previous is None or (minute - previous) > timedelta(minutes=30)
            opens = int(r[4] is None and gap)
            group += opens
            computed = None if sk is None else f"COMPUTED_{sk}_{group}"
            out[r[0]] = (r[4] or computed, opens)
            previous = minute
    return out


def actual(df):
    return {r.event_id: (r.effective_session_id, r.is_new_session) for r in df.collect()}


def test_random_events_match_a_walk(spark):
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        at = START + timedelta(seconds=rng.choice([0, 1, 59, 60]) + 60 * rng.randrange(0, 3000))
        sk = rng.choice([1, 1, 1, 1, 2, 3, None])  # one customer holds most events
        rows.append(event(i, at, sk, rng.choice([None, None, "S1", "S2"])))
    df = frame(spark, rows)
    expected = walk(rows)
    assert actual(sessions.computed_sessions(df)) == expected
    assert actual(sessions.computed_sessions(df.repartition(7, "event_id"))) == expected


def test_gap_counts_minute_boundaries(spark):
    """29:59, 30:00 and 30:59 elapsed stay together when 30 boundaries are crossed; 31 boundaries split."""
    at = [START]
    for gap in (timedelta(minutes=29, seconds=59), timedelta(minutes=30), timedelta(minutes=30, seconds=59), timedelta(minutes=31)):
        at.append(at[-1] + gap)
    rows = [event(i, t, 1) for i, t in enumerate(at)]
    found = actual(sessions.computed_sessions(frame(spark, rows)))
    assert found == walk(rows)
    # 10:00:00, 10:29:59, 10:59:59, 11:30:58 (31 boundaries), 12:01:58 (31 boundaries)
    assert [found[f"e{i:05d}"][1] for i in range(5)] == [1, 0, 0, 1, 1]


def test_tied_timestamps_open_one_session(spark):
    rows = [event(i, START, 1) for i in range(5)] + [event(9, START, 2, "S"), event(10, START, 2)]
    found = actual(sessions.computed_sessions(frame(spark, rows)))
    assert found == walk(rows)
    assert sum(opens for _, opens in found.values()) == 1


def test_events_without_time_are_kept_in_a_last_group(spark):
    rows = [event(1, START, 1), event(2, None, 1), event(3, None, 1), event(4, None, 5)]
    found = actual(sessions.computed_sessions(frame(spark, rows)))
    assert found["e00002"] == found["e00003"] == ("COMPUTED_1_1", 0)
    assert found["e00004"] == ("COMPUTED_5_1", 1)


def refresh(parts, every, batch):
    return session_days.redo_days(parts, every, session_days.touched_days(batch), run_ts())


def sorted_rows(df):
    return sorted(map(str, df.collect()))


def click(rng, i, span, sessions_of):
    session = rng.choice([None, None, None, *sessions_of])
    return event(
        i, START + timedelta(seconds=rng.randrange(span * 60)), rng.choice([*range(60), None]), session,
        rng.choice(sessions.STEPS), rng.choice(["mobile", "desktop", None]), rng.choice([None, "p1", "p2"]),
    )


def parts_frame(spark, parts):
    return spark.createDataFrame(parts.collect(), SESSION_DAYS)


@pytest.mark.parametrize("seed", [101, 102])
def test_redone_days_equal_a_rebuild(spark, seed):
    """Batches of mostly late clicks, some in long or interleaved sourced sessions, some without a time."""
    rng = random.Random(seed)
    batches, i = [], 0
    for n in range(3):
        size = rng.choice([300, 1200, 2500])
        batches.append([click(rng, i + k, rng.choice([600, 3000, 9000]), [f"A{seed}", f"B{n}"]) for k in range(size)])
        i += size
    batches[1].append(event(i, None, 3))
    batches[2] += [event(i + 1, None, 4, "A"), event(i + 2, None, 3)]
    parts = parts_frame(spark, session_days.day_parts(frame(spark, batches[0]), run_ts()))
    so_far = list(batches[0])
    for batch in batches[1:]:
        so_far += batch
        every = frame(spark, so_far)
        parts = parts_frame(spark, refresh(parts, every, frame(spark, batch)))
        assert sorted_rows(parts) == sorted_rows(session_days.day_parts(every, run_ts()))
        assert sorted_rows(session_days.fold_days(parts)) == sorted_rows(sessions.fact_sessions(every, run_ts()))


def test_a_late_event_renumbers_later_days_without_touching_them(spark):
    old = [event(i, START + timedelta(days=2 * i), 1) for i in range(20)]
    late = [event(90, START + timedelta(days=5), 1), event(91, START + timedelta(days=5, hours=1), 1)]
    parts = parts_frame(spark, session_days.day_parts(frame(spark, old), run_ts()))
    touched = session_days.touched_days(frame(spark, late))
    assert [(r.line, str(r.day)) for r in touched.collect()] == [("c1", "2026-01-06")]
    fresh = session_days.fresh_days(frame(spark, old + late), touched, run_ts())
    assert {str(r.day) for r in fresh.collect()} == {"2026-01-06"}
    kept = session_days.without_days(parts, touched)
    assert kept.count() == 20
    folded = session_days.fold_days(kept.unionByName(fresh))
    assert sorted_rows(folded) == sorted_rows(sessions.fact_sessions(frame(spark, old + late), run_ts()))
    assert {r.session_id for r in folded.collect()} == {f"COMPUTED_1_{n}" for n in range(1, 23)}


def test_sessions_that_run_over_days_and_sourced_ones(spark):
    old = [event(1, START, 1), event(2, START + timedelta(hours=9), 1, "S"), event(3, START, 2), event(4, None, 1)]
    night = [event(10 + k, START.replace(hour=23, minute=50) + timedelta(minutes=10 * k), 5, product=f"p{k % 2}") for k in range(9)]
    new = [event(30, START + timedelta(hours=9, minutes=5), 1), event(31, START + timedelta(hours=14), 5), event(32, None, 2)]
    new += [event(33, START, None, "V"), event(34, START + timedelta(days=3), None, "V")]
    parts = session_days.day_parts(frame(spark, old + night), run_ts())
    every = frame(spark, old + night + new)
    folded = session_days.fold_days(refresh(parts, every, frame(spark, new)))
    assert sorted_rows(folded) == sorted_rows(sessions.fact_sessions(every, run_ts()))
    assert {r.session_id: r.page_views for r in folded.filter("customer_sk = 5").collect()} == {"COMPUTED_5_1": 10}
    assert {r.session_id: r.session_duration_sec for r in folded.filter("customer_sk = 1").collect()} == {
        "COMPUTED_1_1": 9 * 3600 + 300, "S": 0}


def test_no_events_no_sessions(spark):
    assert session_days.fold_days(session_days.day_parts(frame(spark, []), run_ts())).count() == 0


def test_session_grain_is_unique(spark):
    rows = [event(1, START, 1, "A"), event(2, START, 1, "A", device="desktop"), event(3, START, 2, "A")]
    built = sessions.fact_sessions(frame(spark, rows), run_ts())
    assert built.count() == 3
    assert built.select("session_id", "customer_sk", "device_type").distinct().count() == 3


def test_funnel_rates_are_null_without_a_denominator(spark):
    rows = [event(1, START, 1, "A", "page_view"), event(2, START, 1, "A", "purchase")]
    row = sessions.conversion_funnel(sessions.session_steps(frame(spark, rows))).first()
    assert (row.pv_to_pdp_pct, row.pdp_to_atc_pct, row.checkout_to_purchase_pct, row.overall_conversion_pct) == (0.0, None, None, 100.0)


def test_sourced_funnel_keeps_sessionless_events(spark):
    rows = [event(1, START, 1, None), event(2, START + timedelta(hours=5), 1, None), event(3, START, 1, "A")]
    events = frame(spark, rows)
    assert sessions.session_steps(events, sourced_only=True).count() == 2
    assert sessions.session_steps(events).count() == 3


def test_rounding_is_half_up(spark):
    rows = [event(i, START, i, "A", "page_view" if i == 0 else "purchase") for i in range(2000)]
    kpis = sessions.session_kpis(sessions.fact_sessions(frame(spark, rows), run_ts())).first()
    assert kpis.avg_page_views == 0.0
    steps = sessions.session_steps(frame(spark, rows)).withColumn("hit_purchase", F.lit(0))
    one = steps.withColumn("hit_purchase", (F.col("customer_sk") == 1).cast("int"))
    assert sessions.conversion_funnel(one).first().overall_conversion_pct == 0.1  # 0.05 rounds up
