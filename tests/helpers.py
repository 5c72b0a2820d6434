"""Small series and brute-force twins of the ordered operators."""

import random
import statistics

HOUR = 3_600_000
START = 1_704_067_200_000  # 2024-01-01T00:00 UTC, a Monday


def series(region, n, seed=1, gap=0.0, start=START):
    """n hourly rows; with probability ``gap`` hours are skipped before a row."""
    rng = random.Random(f"{region}-{seed}")
    rows, ts = [], start
    for _ in range(n):
        while rng.random() < gap:
            ts += HOUR * rng.choice([1, 5, 40])
        rows.append((region, ts, rng.randint(100, 999)))
        ts += HOUR
    return rows


def demand_frame(spark, rows, shuffle=True):
    rows = list(rows)
    if shuffle:
        random.Random(3).shuffle(rows)
    return spark.createDataFrame(rows, "region string, timestamp_ms long, demand long")


def by_region(rows):
    out = {}
    for row in sorted(rows):
        out.setdefault(row[0], []).append(row)
    return out


def expected_rolling(rows):
    """{(region, ts): features} by direct slicing of the sorted series."""
    out = {}
    for region, part in by_region(rows).items():
        values = [v for _, _, v in part]
        for p, (_, ts, _) in enumerate(part):
            f = {}
            for n in (3, 24, 168):
                frame = values[p - n + 1 : p + 1] if p + 1 >= n else None
                f[f"mean_{n}"] = sum(frame) / n if frame else None
                f[f"median_{n}"] = float(statistics.median(frame)) if frame else None
            for n in (1, 24, 168):
                f[f"lag_{n}h"] = float(values[p - n]) if p >= n else None
            f["target"] = values[p + 1] if p + 1 < len(values) else None
            out[region, ts] = f
    return out


def close(a, b):
    if a is None or b is None:
        return a is None and b is None
    return abs(a - b) < 1e-9


def assert_features(rows, expected, names):
    assert len(rows) == len(expected)
    for row in rows:
        want = expected[row["region"], row["timestamp_ms"]]
        for name in names:
            assert close(row[name], want[name]), (row["region"], row["timestamp_ms"], name)
