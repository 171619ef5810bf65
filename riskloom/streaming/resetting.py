"""A counter per key that starts anew a fixed time after its first message, with timers in the state."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

MILLI = 1000
SECOND = 1000 * MILLI
STATE = "keys array<{}>, start array<long>, n array<long>, waiting array<array<long>>, copies array<array<long>>"
BUCKETS = 256


def fold(start: int, n: int, times: list[int], counts: list[int], span: int) -> tuple[list[tuple[int, int]], int, int]:
    """(closed counters, start, n) after messages in order of time; start is -1 while no counter runs."""
    closed = []
    for time, count in zip(times, counts, strict=True):
        if start < 0 or time - start >= span:
            if start >= 0:
                closed.append((start, n))
            start, n = time, 0
        n += count
    return closed, start, n


def resetting_counts(stream: DataFrame, key: str, time: Column, late: str, seconds: int = 60, buckets: int = BUCKETS) -> DataFrame:
    """(key, counter_start, n): each counter begins with a message and takes all of its key in the next `seconds`.

    A counter is told once, when the watermark has passed its end, whether or not another message comes. Until
    then messages wait in the state, equal times as one, because earlier ones may still arrive; the state holds no
    more than what lies within `late` of the newest. Messages later than that are left out, as are those without
    key or time.

    A call of Python and a state cost milliseconds, so the keys of a hash bucket share them. `buckets` must stay the
    same as long as the checkpoint is used; with very many keys there should be more.
    """
    span = seconds * SECOND
    kind = stream.schema[key].dataType.simpleString()
    timed = stream.select(F.col(key).alias("key"), time.cast("timestamp").alias("time")).where("key IS NOT NULL AND time IS NOT NULL")

    def run(name: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # By key: start, n and the messages that wait; NaN, which is no key of a dict, as None.
        held = {_named(k): (s, n, dict(zip(w, c, strict=True))) for k, s, n, w, c in zip(*state.get, strict=True)} if state.exists else {}
        if not state.hasTimedOut:
            for frame in frames:
                for k, at in zip(frame["key"].tolist(), frame["at"].tolist(), strict=True):
                    pending = held.setdefault(_named(k), (-1, 0, {}))[2]
                    pending[at] = pending.get(at, 0) + 1
        mark = state.getCurrentWatermarkMs()
        seen = mark * MILLI
        told, kept, wake = [], [], []
        for k, (start, n, pending) in held.items():
            k = float("nan") if k is None else k
            times = sorted(pending)
            done = bisect_right(times, seen)
            closed, start, n = fold(start, n, times[:done], [pending[t] for t in times[:done]], span)
            if start >= 0 and start + span <= seen:
                closed.append((start, n))
                start, n = -1, 0
            told += [(k, *c) for c in closed]
            times = times[done:]
            if start >= 0 or times:
                kept.append((k, start, n, times, [pending[t] for t in times]))
                wake += [*([start + span] if start >= 0 else []), *times[:1]]
        if kept:
            state.update(tuple(map(list, zip(*kept, strict=True))))
            state.setTimeoutTimestamp(max(min(wake) // MILLI + 1, mark + 1))
        elif state.exists:
            state.remove()
        yield pd.DataFrame(told, columns=["key", "start", "n"])

    times = timed.withWatermark("time", late).withColumn("at", F.unix_micros("time"))
    dealt = times.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    found = dealt.groupBy("bucket").applyInPandasWithState(
        run, f"key {kind}, start long, n long", STATE.format(kind), "append", GroupStateTimeout.EventTimeTimeout
    )
    return found.select(F.col("key").alias(key), F.timestamp_micros("start").alias("counter_start"), "n")


def _named(key):
    return key if key == key else None
