"""Trip features kept up to date on a stream.

The state of a trip is its last row and running sums, and a list of the rows newer than the watermark, which may still
be joined by earlier ones; it does not grow with the trip. Each trigger appends the new rows to the list, adds those the
watermark has passed to the sums, in time order, and emits the trip's features so far, waiting rows included. Rows that
are in the sums stay in the list, known by their place, until they are half of it; so what a trigger writes follows
the rows it brings, not the rows that wait. A trip that stays silent is emitted once more as closed, by a timer. Its sums
stay (less than a kilobyte on local disk), so a trip that resumes goes on from them; with ``forget_ms`` they are
released after that much more silence, and a trip that resumes even later counts as a new one. Spark leaves out rows whose
event time the watermark has passed and reports their number in the query's progress; ``n_late`` counts
rows in time whose ``second`` lies before what the sums already hold. The source's per-trigger limit
bounds the rows of one trip that a trigger sorts.

Trips are kept together in ``buckets``, by a hash of their key: a call works on all trips of a bucket at once, as arrays, and
its state goes to the store and back as a few blocks of bytes. One call and one round trip per trip and reading would cost
milliseconds each. Sums of open trips are one block; closed trips beyond a bounded number have an entry each and are read when
they resume, so a trigger does not carry the trips of the past. The number of buckets bounds the tasks that can
share a trigger and stays the same as long as a stream's progress folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from odolytics import schema as S
from odolytics.streaming.jobs import EVENT_TIME

BUCKETS = 1024
MOST_CLOSED = 256       # closed trips that stay beside the open ones, if more than those; a trip takes half a kilobyte
BLOCK_ROWS = 20_000     # rows in one block of the list
LAST = ["second", "tie", "speed", *S.CHANNELS]
SPREAD = ["speed", "accel_mag", "gyro_mag"]
SUMMED = [
    "jerk_linear", "gyro_jerk_mag", "over_80", "cruising", "high_accel", "hard_turn", "hard_brake", "hard_accel",
    "zigzag", "smooth",
]
STATE = (
    [f"last_{c}" for c in LAST]
    + [f"{c}_{part}" for c in SPREAD for part in ("n", "mean", "m2", "max")]
    + [f"sum_{c}" for c in SUMMED]
    + ["first_second", "n_points", "smooth_since", "longest", "n_late", "closed"]
)
PLACE = ["passed_second", "passed_tie", "passed_seq"]       # the last row that is in the sums
# Listed rows numbered below ``born`` are no longer the trip's; ``deadline``: when it closes, or is forgotten.
KEPT = [*STATE, *PLACE, "born", "deadline"]
KEPT_AT = {c: i for i, c in enumerate(KEPT)}
WAITING = [*LAST, "at_ms", "seq"]       # a listed row: its readings, event time, and running number in the bucket
COLUMN = {c: i for i, c in enumerate(WAITING)}
COUNTS = ["n_points", "n_hard_accels", "n_hard_brakes", "n_hard_turns", "n_zigzag_events", "trip_duration_sec"]
BUCKET = "__bucket"
OUTPUT_SCHEMA = ", ".join(
    [f"{S.KEY} long"]
    + [f"{c} {'long' if c in COUNTS else 'double'}" for c in S.TRIP_FEATURES]
    + ["n_late long", "closed boolean"]
)


def _start(n: int, born: float) -> np.ndarray:
    """The state of ``n`` trips without rows."""
    state = np.full((n, len(KEPT)), np.nan)
    for c in STATE:
        if c.startswith("sum_") or c.endswith(("_n", "_mean", "_m2")) or c in ("n_points", "longest", "n_late", "closed"):
            state[:, KEPT_AT[c]] = 0.0
    state[:, [KEPT_AT[c] for c in PLACE]] = -np.inf
    state[:, KEPT_AT["born"]] = born
    return state


def _size(rows: np.ndarray, axes: list[str]) -> np.ndarray:
    return np.sqrt(sum(np.nan_to_num(rows[:, COLUMN[a]]) ** 2 for a in axes))


def _groups(trip: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last row of each trip; the rows of a trip lie together."""
    first = np.flatnonzero(np.concatenate(([True], trip[1:] != trip[:-1])))
    return first, np.concatenate((first[1:], [len(trip)])) - 1


def _fold(state: np.ndarray, rows: np.ndarray, trip: np.ndarray, t: S.Thresholds) -> None:
    """Add sorted new rows (columns as in WAITING) to their trips' states (columns as in KEPT, a row per trip)."""
    if not len(rows):
        return
    first, last = _groups(trip)
    which_trip = trip[first]
    had = state[which_trip]                     # a copy; written back at the end
    of = np.repeat(np.arange(len(first)), last - first + 1)
    begun = had[:, KEPT_AT["n_points"]] > 0
    now = rows[:, : len(LAST)]
    before = np.concatenate((now[:1], now[:-1]))
    before[first] = had[:, [KEPT_AT[f"last_{c}"] for c in LAST]]
    seconds, speed, second_before = now[:, COLUMN["second"]], now[:, COLUMN["speed"]], before[:, COLUMN["second"]]
    step = np.nan_to_num(seconds - second_before)
    any_step = np.where(step == 0, np.nan, step)

    def change(c: str) -> np.ndarray:
        return np.nan_to_num(now[:, COLUMN[c]] - before[:, COLUMN[c]])

    def jerk(axes: list[str]) -> np.ndarray:
        return np.sqrt(sum(np.nan_to_num(change(a) / any_step) ** 2 for a in axes))

    def sign(x: np.ndarray) -> np.ndarray:
        return np.where(x > t.zigzag_gyro, 1, np.where(x < -t.zigzag_gyro, -1, 0))

    def total(values: np.ndarray) -> np.ndarray:
        return np.bincount(of, values, len(first))

    accel, gyro = _size(now, S.ACCEL_AXES), _size(now, S.GYRO_AXES)
    rate = np.where((step > 0) & (step <= t.rate_gap), np.nan_to_num(change("speed") / any_step), 0.0)
    smooth = (accel < t.smooth_accel) & (gyro < t.smooth_gyro)
    was_smooth = (_size(before, S.ACCEL_AXES) < t.smooth_accel) & (_size(before, S.GYRO_AXES) < t.smooth_gyro)
    was_smooth[first[~begun]] = False
    starts = smooth & ~was_smooth
    # The time the block in force counts from: of the trip's last start up to each row, or of the state.
    which = np.maximum.accumulate(np.where(starts, np.arange(len(now)), -1))
    from_start = np.where(np.isnan(second_before), seconds, second_before)
    since = np.where(which >= first[of], from_start[which], had[of, KEPT_AT["smooth_since"]])
    held = seconds - since
    turn = COLUMN["gyro_y"]
    sums = {
        "jerk_linear": jerk(S.ACCEL_AXES), "gyro_jerk_mag": jerk(S.GYRO_AXES),
        "over_80": speed > t.speed_over_80, "cruising": (speed >= t.cruise_min) & (speed <= t.cruise_max),
        "high_accel": accel > t.accel_high, "hard_turn": gyro > t.gyro_high,
        "hard_brake": rate < t.hard_brake, "hard_accel": rate > t.hard_accel,
        "zigzag": (sign(now[:, turn]) * sign(before[:, turn]) == -1) & (step <= t.zigzag_gap), "smooth": smooth,
    }
    for name, values in sums.items():
        had[:, KEPT_AT[f"sum_{name}"]] += total(values)
    for name, values in {"speed": speed, "accel_mag": accel, "gyro_mag": gyro}.items():
        n, mean, m2, most = (had[:, KEPT_AT[f"{name}_{part}"]] for part in ("n", "mean", "m2", "max"))
        is_known = ~np.isnan(values)
        k, known = total(is_known), np.where(is_known, values, 0.0)
        own_mean = total(known) / np.maximum(k, 1)
        own_m2 = total(np.where(is_known, known - own_mean[of], 0.0) ** 2)
        gap, both = np.where(k > 0, own_mean - mean, 0.0), np.maximum(n + k, 1)
        had[:, KEPT_AT[f"{name}_m2"]] = m2 + own_m2 + gap * gap * n * k / both
        had[:, KEPT_AT[f"{name}_mean"]] = mean + gap * k / both
        had[:, KEPT_AT[f"{name}_max"]] = np.fmax(most, np.fmax.reduceat(values, first))
        had[:, KEPT_AT[f"{name}_n"]] = n + k
    had[~begun, KEPT_AT["first_second"]] = seconds[first[~begun]]
    had[:, KEPT_AT["n_points"]] += last - first + 1
    had[:, KEPT_AT["smooth_since"]] = since[last]
    had[:, KEPT_AT["longest"]] = np.fmax(had[:, KEPT_AT["longest"]], np.fmax.reduceat(held, first))
    had[:, [KEPT_AT[f"last_{c}"] for c in LAST]] = now[last]
    state[which_trip] = had


def _features(ids: np.ndarray, state: np.ndarray, closed: bool, t: S.Thresholds) -> pd.DataFrame:
    """One row per trip; NaN is no value."""

    def at(c: str) -> np.ndarray:
        return state[:, KEPT_AT[c]]

    def whole(values: np.ndarray) -> pd.Series:
        return pd.Series(values).round().astype("Int64")

    n = at("n_points")
    mean, top, std = {}, {}, {}
    for c in SPREAD:
        k = at(f"{c}_n")
        mean[c], top[c] = np.where(k > 0, at(f"{c}_mean"), np.nan), np.where(k > 0, at(f"{c}_max"), np.nan)
        std[c] = np.where(k > 1, np.sqrt(at(f"{c}_m2") / np.maximum(k - 1, 1)), np.nan)
    return pd.DataFrame({
        S.KEY: ids,
        "trip_duration_sec": whole(np.trunc(at("last_second") - at("first_second"))), "n_points": whole(n),
        "speed_max": top["speed"], "speed_mean": mean["speed"], "speed_std": std["speed"],
        "pct_time_speed_over_80": at("sum_over_80") / n, "pct_time_cruising": at("sum_cruising") / n,
        "accel_mag_max": top["accel_mag"], "accel_mag_mean": mean["accel_mag"], "accel_mag_std": std["accel_mag"],
        "jerk_linear_mean": at("sum_jerk_linear") / n,
        "n_hard_accels": whole(at("sum_hard_accel")), "n_hard_brakes": whole(at("sum_hard_brake")),
        "pct_time_high_accel": at("sum_high_accel") / n,
        "gyro_mag_max": top["gyro_mag"], "gyro_mag_mean": mean["gyro_mag"], "gyro_mag_std": std["gyro_mag"],
        "gyro_jerk_mag_mean": at("sum_gyro_jerk_mag") / n,
        "n_hard_turns": whole(at("sum_hard_turn")), "pct_time_high_gyro": at("sum_hard_turn") / n,
        "n_zigzag_events": whole(at("sum_zigzag")),
        "turn_sharpness_index": top["gyro_mag"] / (mean["speed"] + t.sharpness_eps),
        "longest_smooth_segment_sec": at("longest"), "pct_time_smooth": at("sum_smooth") / n,
        "n_late": whole(at("n_late")), "closed": closed,
    })


def _place(rows: np.ndarray) -> np.ndarray:
    """Second, tie-break and running number of rows, as they order a trip; a missing one comes last."""
    place = rows[:, [COLUMN["second"], COLUMN["tie"], COLUMN["seq"]]]
    return np.where(np.isnan(place), np.inf, place)


def _sorted(rows: np.ndarray, trip: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = _place(rows)
    order = np.lexsort((place[:, 2], place[:, 1], place[:, 0], trip))
    return rows[order], trip[order]


@dataclass
class Bucket:
    """Trips that are open, or closed and not put away, by ascending id; then what the list holds."""

    ids: np.ndarray
    sums: np.ndarray
    n_listed: int = 0
    seq: int = 0
    timer: float = np.nan
    put_away: bool = False          # whether closed trips have entries of their own

    def at(self, c: str) -> np.ndarray:
        return self.sums[:, KEPT_AT[c]]

    def add(self, ids: np.ndarray, sums: np.ndarray) -> None:
        every = np.concatenate((self.ids, ids))
        order = np.argsort(every)
        self.ids, self.sums = every[order], np.concatenate((self.sums, sums))[order]

    def keep(self, which: np.ndarray) -> None:
        self.ids, self.sums = self.ids[which], self.sums[which]

    def waits(self, ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Whether a listed row is still a trip's and not yet in its sums."""
        if not len(self.ids):
            return np.zeros(len(ids), dtype=bool)
        trip = np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)
        mine = (self.ids[trip] == ids) & (rows[:, COLUMN["seq"]] >= self.at("born")[trip])
        place, passed = _place(rows), self.sums[:, [KEPT_AT[c] for c in PLACE]][trip]
        later = place[:, 2] > passed[:, 2]
        for n in (1, 0):
            later = (place[:, n] > passed[:, n]) | ((place[:, n] == passed[:, n]) & later)
        return mine & later


class TripProcessor(StatefulProcessor):
    """The trips of one bucket, with an event-time timer for the first of them that closes or is forgotten."""

    def __init__(self, idle_ms: int, t: S.Thresholds, forget_ms: int | None):
        self.idle_ms, self.t, self.forget_ms = idle_ms, t, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.trips = handle.getValueState("trips", "ids binary, sums binary, n_listed long, seq long, timer double, put_away boolean")
        self.listed = handle.getListState("listed", "ids binary, rows binary")
        self.closed = handle.getMapState("closed", "trip long", "sums binary")

    def _bucket(self) -> Bucket:
        kept = self.trips.get() if self.trips.exists() else None
        if not kept:
            return Bucket(np.zeros(0, np.int64), _start(0, 0))
        ids, sums, *rest = kept
        return Bucket(np.frombuffer(ids, np.int64), np.frombuffer(sums).reshape(-1, len(KEPT)).copy(), *rest)

    def _keep(self, b: Bucket) -> None:
        away = np.flatnonzero(b.at("closed") > 0) if self.forget_ms is None else []
        if len(away) > max(MOST_CLOSED, len(b.ids) - len(away)):
            for n in away:
                self.closed.updateValue((int(b.ids[n]),), (b.sums[n].tobytes(),))
            b.put_away = True
            b.keep(b.at("closed") == 0)
        due = b.at("deadline")
        timer = float(np.nanmin(due)) if not np.isnan(due).all() else np.nan
        if not np.isnan(b.timer) and timer != b.timer:
            self.handle.deleteTimer(int(b.timer))
        if not np.isnan(timer) and timer != b.timer:
            self.handle.registerTimer(int(timer))
        b.timer = timer
        self.trips.update((b.ids.tobytes(), b.sums.tobytes(), int(b.n_listed), int(b.seq), timer, b.put_away))

    def _with(self, b: Bucket, touched: np.ndarray) -> None:
        """Bring in the trips that are not there: put away, or new."""
        absent = np.setdiff1d(touched, b.ids, assume_unique=True)
        found = _start(len(absent), b.seq)
        for n, trip in enumerate(absent if b.put_away else []):
            if self.closed.containsKey((int(trip),)):
                found[n] = np.frombuffer(self.closed.getValue((int(trip),))[0])
                self.closed.removeKey((int(trip),))
        b.add(absent, found)

    def _list(self, b: Bucket) -> tuple[np.ndarray, np.ndarray]:
        """Ids and rows that wait, of all trips of the bucket."""
        blocks = list(self.listed.get()) if b.n_listed else []
        ids = np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(i, np.int64) for i, _ in blocks]])
        rows = np.concatenate([np.zeros((0, len(WAITING))), *[np.frombuffer(r).reshape(-1, len(WAITING)) for _, r in blocks]])
        waits = b.waits(ids, rows)
        return ids[waits], rows[waits]

    def _append(self, ids: np.ndarray, rows: np.ndarray) -> None:
        for n in range(0, len(ids), BLOCK_ROWS):
            self.listed.appendValue((ids[n : n + BLOCK_ROWS].tobytes(), rows[n : n + BLOCK_ROWS].tobytes()))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        b, watermark = self._bucket(), timerValues.getCurrentWatermarkInMs()
        frames = list(rows)
        ids = np.concatenate([f[S.KEY].to_numpy(dtype=np.int64) for f in frames])
        new = np.concatenate([np.column_stack([
            *[f[c].to_numpy(dtype=float) for c in LAST], f[EVENT_TIME].to_numpy().astype("datetime64[ms]").astype(np.int64).astype(float)
        ]) for f in frames])
        touched, trip = np.unique(ids, return_inverse=True)
        self._with(b, touched)
        place = np.searchsorted(b.ids, touched)
        state = b.sums[place]
        newest = np.full(len(touched), -np.inf)
        np.maximum.at(newest, trip, new[:, COLUMN["at_ms"]])
        second, tie = new[:, COLUMN["second"]], new[:, COLUMN["tie"]]
        last_second, last_tie = (state[trip, KEPT_AT[f"last_{c}"]] for c in ("second", "tie"))
        late = (second < last_second) | ((second == last_second) & (tie < last_tie))     # never before a first row: NaN
        state[:, KEPT_AT["n_late"]] += np.bincount(trip, late, len(touched))
        new, ids = new[~late], ids[~late]
        new = np.column_stack([new, b.seq + np.arange(len(new))])
        b.seq += len(new)
        waiting_ids, waiting = self._list(b)
        is_touched = np.isin(waiting_ids, touched)
        others_ids, others = waiting_ids[~is_touched], waiting[~is_touched]
        waiting = np.concatenate((waiting[is_touched], new))
        waiting, trip = _sorted(waiting, np.searchsorted(touched, np.concatenate((waiting_ids[is_touched], ids))))
        # Rows of a trip up to its last one that the watermark has passed are complete.
        passed = np.full(len(touched), -1)
        n = np.flatnonzero(waiting[:, COLUMN["at_ms"]] <= watermark)
        np.maximum.at(passed, trip[n], n)
        ready = np.arange(len(waiting)) <= passed[trip]
        _fold(state, waiting[ready], trip[ready], self.t)
        summed = passed >= 0
        state[np.ix_(summed, [KEPT_AT[c] for c in PLACE])] = _place(waiting[passed[summed]])
        waiting, trip = waiting[~ready], trip[~ready]
        live = len(waiting) + len(others)
        if b.n_listed + len(new) > 2 * live:
            self.listed.clear()
            self._append(np.concatenate((others_ids, touched[trip])), np.concatenate((others, waiting)))
            b.n_listed = live
        else:
            self._append(ids, new)
            b.n_listed += len(new)
        state[:, KEPT_AT["closed"]] = 0.0
        state[:, KEPT_AT["deadline"]] = np.maximum(newest, watermark) + self.idle_ms
        b.sums[place] = state
        self._keep(b)
        _fold(state, waiting, trip, self.t)     # the features so far; not kept
        shown = state[:, KEPT_AT["n_points"]] > 0
        if shown.any():
            yield _features(touched[shown], state[shown], False, self.t)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        b, watermark = self._bucket(), timerValues.getCurrentWatermarkInMs()
        b.timer = np.nan         # this one
        due = (b.at("deadline") <= expiredTimerInfo.getExpiryTimeInMs()) | (b.at("deadline") < watermark)
        b.keep(~(due & (b.at("closed") > 0)))       # forgotten
        now = np.flatnonzero((b.at("closed") == 0) & ((b.at("deadline") <= expiredTimerInfo.getExpiryTimeInMs()) | (b.at("deadline") < watermark)))
        ids, state = b.ids[now], b.sums[now]
        waiting_ids, waiting = self._list(b)
        mine = np.isin(waiting_ids, ids)
        _fold(state, *_sorted(waiting[mine], np.searchsorted(ids, waiting_ids[mine])), self.t)
        if mine.all():
            self.listed.clear()
            b.n_listed = 0
        state[:, KEPT_AT["closed"]], state[:, KEPT_AT["born"]] = 1.0, b.seq
        state[:, KEPT_AT["deadline"]] = np.nan if self.forget_ms is None else watermark + self.forget_ms
        b.sums[now] = state
        self._keep(b)
        if len(ids):
            yield _features(ids, state, True, self.t)

    def close(self) -> None:
        pass


def trip_features_stream(
    stream: DataFrame, tiebreak: str | None = None, delay: str = "1 minute", idle_ms: int = 300_000,
    t: S.Thresholds = S.Thresholds(), forget_ms: int | None = None, buckets: int = BUCKETS,
) -> DataFrame:
    """Cleaned sensor stream -> features per trip after every trigger that touched it."""
    rows = stream.where(F.col(S.KEY).isNotNull()).withWatermark(EVENT_TIME, delay).select(
        F.pmod(F.xxhash64(F.col(S.KEY).cast("long")), F.lit(buckets)).alias(BUCKET),
        F.col(S.KEY).cast("long").alias(S.KEY), F.col("second").cast("double").alias("second"),
        (F.col(tiebreak) if tiebreak else F.lit(0)).cast("double").alias("tie"),
        "speed", *S.CHANNELS, EVENT_TIME,
    )
    return rows.groupBy(BUCKET).transformWithStateInPandas(TripProcessor(idle_ms, t, forget_ms), OUTPUT_SCHEMA, "append", "eventTime")


def latest(versions: DataFrame) -> DataFrame:
    """The newest version of each trip in the table the stream appended to."""
    newest = F.max_by(F.struct(*S.TRIP_FEATURES), F.struct("n_points", "n_late", "closed"))
    return versions.groupBy(S.KEY).agg(newest.alias("f")).select(S.KEY, "f.*")
