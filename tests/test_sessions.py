"""Sessions and repeat runs: range-wise form against a row-by-row scan."""

import datetime as dt
import random

import pytest

from playspan.operators.sessions import number_plays

SCHEMA = (
    "play_id string, user_id long, played_at timestamp, played_date date, track_id string, "
    "track_key long, data_source string"
)
START = dt.datetime(2024, 1, 1)


def make(spark, plays):
    rows = [
        (f"p{i:04d}", user, at, at.date(), track, None if track is None else ord(track), "api")
        for i, (user, at, track) in enumerate(plays)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def by_hand(rows, by_user, gap=30, split_days=True):
    """Plain scan in order; returns play_id -> expected values."""
    out, groups = {}, {}
    for r in rows:
        groups.setdefault(r.user_id if by_user else None, []).append(r)
    for group in groups.values():
        group.sort(key=lambda r: (r.played_at, r.play_id))
        prev, number, sequence = None, 0, 0
        for r in group:
            minutes = None if prev is None else (r.played_at - prev.played_at).total_seconds() / 60
            opens = prev is None or minutes > gap or (split_days and r.played_date != prev.played_date)
            number += opens
            if prev is None or prev.track_id is None:
                starts, repeat = True, False
            else:
                starts = r.track_id is not None and r.track_id != prev.track_id
                repeat = r.track_id is not None and r.track_id == prev.track_id
            sequence = 0 if starts else sequence + 1
            out[r.play_id] = (
                None if prev is None else prev.track_key,
                None if minutes is None else round(minutes, 6),
                int(opens),
                number,
                repeat,
                sequence,
            )
            prev = r
    return out


def result(df):
    return {
        r.play_id: (
            r.prev_track_key,
            None if r.minutes_since_prev_play is None else round(r.minutes_since_prev_play, 6),
            r.is_new_session,
            r.session_number,
            r.is_repeat,
            r.repeat_sequence,
        )
        for r in df.collect()
    }


def random_plays(seed, users=1, n=160, hot=False):
    rng, at, plays = random.Random(seed), {}, []
    track = "A"
    for _ in range(n):
        user = 0 if hot and rng.random() < 0.6 else rng.randrange(users)
        step = rng.choice([0, 0, 1, 5, 29, 30, 31, 300, 2000])
        at[user] = at.get(user, START) + dt.timedelta(minutes=step, microseconds=rng.choice([0, 1]))
        if rng.random() < 0.5:
            track = rng.choice(["A", "B", None])
        plays.append((user, at[user], track))
    return plays


@pytest.mark.parametrize("ranges", [1, 3, 12, 60])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_global_order(spark, seed, ranges):
    df = make(spark, random_plays(seed))
    got = result(number_plays(df, ties=["play_id"], carry=["track_key"], ranges=ranges))
    assert got == by_hand(df.collect(), by_user=False)


@pytest.mark.parametrize("ranges", [1, 7, 40])
@pytest.mark.parametrize("hot", [False, True])
def test_per_user(spark, hot, ranges):
    df = make(spark, random_plays(11, users=9, hot=hot))
    got = result(
        number_plays(df, by=["user_id"], ties=["play_id"], carry=["track_key"], ranges=ranges)
    )
    assert got == by_hand(df.collect(), by_user=True)


def test_other_gap_without_day_split(spark):
    df = make(spark, random_plays(5))
    got = result(
        number_plays(
            df, ties=["play_id"], carry=["track_key"], gap_minutes=5, split_days=False, ranges=9
        )
    )
    assert got == by_hand(df.collect(), by_user=False, gap=5, split_days=False)


def minutes(*offsets):
    return [START + dt.timedelta(minutes=m) for m in offsets]


def columns(spark, times, tracks):
    df = make(spark, list(zip([0] * len(times), times, tracks)))
    rows = number_plays(df, ties=["play_id"], carry=["track_key"], ranges=2).orderBy("play_id")
    return rows.collect()


def test_exactly_thirty_minutes_stays_in_session(spark):
    times = [*minutes(0, 30), START + dt.timedelta(minutes=60, microseconds=1)]
    rows = columns(spark, times, "ABC")
    assert [r.session_number for r in rows] == [1, 1, 2]


def test_midnight_opens_a_session_but_not_a_run(spark):
    rows = columns(spark, minutes(1438, 1441, 1450), "AAB")
    assert [r.session_number for r in rows] == [1, 2, 2]
    assert [r.is_repeat for r in rows] == [False, True, False]
    assert [r.repeat_sequence for r in rows] == [0, 1, 0]


def test_unknown_track_continues_a_run_without_repeating(spark):
    rows = columns(spark, minutes(0, 1, 2), ["A", None, "A"])
    assert [r.is_repeat for r in rows] == [False, False, False]
    assert [r.repeat_sequence for r in rows] == [0, 1, 0]


def test_empty(spark):
    df = make(spark, [(0, START, "A")]).filter("false")
    out = number_plays(df, ties=["play_id"], carry=["track_key"])
    assert out.count() == 0
    assert "session_number" in out.columns
