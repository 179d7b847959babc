"""Plain-Python trip features, row by row, to compare the Spark ones with."""

import math
import statistics

from odolytics import schema as S

AXES = {"accel": S.ACCEL_AXES, "gyro": S.GYRO_AXES}


def clean(rows):
    kept = []
    for r in rows:
        if r["bookingID"] is None or r["second"] is None or r["second"] > 21600:
            continue
        if r["accuracy"] is not None and r["accuracy"] > 50:
            continue
        r = dict(r)
        if r["speed"] is not None and r["speed"] < 0:
            r["speed"] = None
        for c, limit in S.CHANNEL_LIMITS.items():
            if r[c] is not None and abs(r[c]) > limit:
                r[c] = None
        kept.append(r)
    return kept


def size(row, axes):
    return math.sqrt(sum((row[a] or 0.0) ** 2 for a in axes))


def features(rows, tie):
    trips = {}
    for r in clean(rows):
        trips.setdefault(r["bookingID"], []).append(r)
    return {k: one_trip(sorted(v, key=lambda r: (r["second"], r[tie]))) for k, v in trips.items()}


def one_trip(rows):
    out = {"n_hard_accels": 0, "n_hard_brakes": 0, "n_hard_turns": 0, "n_zigzag_events": 0}
    cols = {k: [] for k in ("speed", "accel", "gyro", "jl", "jg", "over", "cruise", "high", "turn", "smooth")}
    block, blocks, was_smooth, previous = 0, {}, False, None
    for r in rows:
        step = 0 if previous is None else r["second"] - previous["second"]

        def change(c):
            if previous is None or r[c] is None or previous[c] is None:
                return 0.0
            return r[c] - previous[c]

        accel, gyro = size(r, S.ACCEL_AXES), size(r, S.GYRO_AXES)
        rate = change("speed") / step if 0 < step <= 10 else 0.0
        for name, axes in (("jl", S.ACCEL_AXES), ("jg", S.GYRO_AXES)):
            cols[name].append(math.sqrt(sum((change(a) / step) ** 2 for a in axes)) if step else 0.0)
        if r["speed"] is not None:
            cols["speed"].append(r["speed"])
        cols["accel"].append(accel)
        cols["gyro"].append(gyro)
        cols["over"].append(r["speed"] is not None and r["speed"] > 22.2)
        cols["cruise"].append(r["speed"] is not None and 8.33 <= r["speed"] <= 16.67)
        cols["high"].append(accel > 12)
        cols["turn"].append(gyro > 1)
        out["n_hard_turns"] += gyro > 1
        out["n_hard_brakes"] += rate < -5
        out["n_hard_accels"] += rate > 5

        def sign(x):
            return 0 if x is None or abs(x) <= 0.5 else (1 if x > 0 else -1)

        if previous is not None and sign(r["gyro_y"]) * sign(previous["gyro_y"]) == -1 and step <= 5:
            out["n_zigzag_events"] += 1
        smooth = accel < 2 and gyro < 0.5
        if smooth and not was_smooth:
            block += 1
        if block:
            blocks[block] = blocks.get(block, 0) + step
        cols["smooth"].append(smooth)
        was_smooth, previous = smooth, r

    def mean(x):
        return sum(x) / len(x) if x else None

    def std(x):
        return statistics.stdev(x) if len(x) > 1 else None

    out.update(
        trip_duration_sec=rows[-1]["second"] - rows[0]["second"], n_points=len(rows),
        speed_max=max(cols["speed"], default=None), speed_mean=mean(cols["speed"]), speed_std=std(cols["speed"]),
        pct_time_speed_over_80=mean(cols["over"]), pct_time_cruising=mean(cols["cruise"]),
        accel_mag_max=max(cols["accel"]), accel_mag_mean=mean(cols["accel"]), accel_mag_std=std(cols["accel"]),
        jerk_linear_mean=mean(cols["jl"]), pct_time_high_accel=mean(cols["high"]),
        gyro_mag_max=max(cols["gyro"]), gyro_mag_mean=mean(cols["gyro"]), gyro_mag_std=std(cols["gyro"]),
        gyro_jerk_mag_mean=mean(cols["jg"]), pct_time_high_gyro=mean(cols["turn"]),
        turn_sharpness_index=None if not cols["speed"] else max(cols["gyro"]) / (mean(cols["speed"]) + 0.001),
        longest_smooth_segment_sec=float(max(blocks.values(), default=0)), pct_time_smooth=mean(cols["smooth"]),
    )
    return out


def same(found, wanted, places=9):
    assert set(found) == set(wanted)
    for key, want in wanted.items():
        for name in S.TRIP_FEATURES:
            a, b = found[key][name], want[name]
            assert (a is None) == (b is None), (key, name, a, b)
            assert a is None or abs(a - b) <= 10 ** -places * max(1.0, abs(b)), (key, name, a, b)
