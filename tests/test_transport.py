"""The per-split filter against moving rows one by one."""

import random
from datetime import datetime, timedelta

import pytest

from wattloom.operators.series import Series
from wattloom.operators.splits import NAMES, per_split_filter

S = Series(("u",), "ts", ("i",))


def one_by_one(rows, ranges):
    """(ts, i, split) in time order -> {i: split}: plain statement of the rules."""
    rows = sorted(rows)

    def inside(ts, s, kind):
        return any(a <= ts <= b for rs, rk, a, b in ranges if (rs, rk) == (s, kind))

    no = [{s: inside(ts, s, "exclude") for s in NAMES} for ts, _, _ in rows]
    pin = [next((s for s in NAMES if inside(ts, s, "include")), None) for ts, _, _ in rows]
    at = [pin[n] or rows[n][2] for n in range(len(rows))]
    at = ["lost" if all(no[n].values()) else "none" if no[n][at[n]] else at[n] for n in range(len(rows))]
    goal = {s: sum(r[2] == s for r in rows) for s in NAMES}

    def have(s):
        return at.count(s)

    def short():
        return next((s for s in NAMES if have(s) < goal[s]), None)

    for j in NAMES:
        while have(j) > goal[j]:
            k = short()
            n = next((n for n in range(len(rows)) if k and at[n] == j and pin[n] is None and not no[n][k]), None)
            if n is None:
                break
            at[n] = k
    while "none" in at:
        k = short()
        if k is None:
            break
        n = next((n for n in range(len(rows)) if at[n] == "none" and not no[n][k]), None)
        if n is not None:
            at[n] = k
            continue
        for j in NAMES:
            give = next((n for n in range(len(rows)) if j != k and have(j) <= goal[j] and at[n] == j and pin[n] is None and not no[n][k]), None)
            take = next((n for n in range(len(rows)) if at[n] == "none" and not no[n][j]), None)
            if give is not None and take is not None:
                at[give], at[take] = k, j
                break
        else:
            break
    return {rows[n][1]: at[n] for n in range(len(rows)) if at[n] in NAMES}


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("chunk_s", [None, 6 * 3600])
def test_equals_moving_one_by_one(spark, seed, chunk_s):
    rng, start = random.Random(seed), datetime(2026, 6, 1)
    rows, ranges, want = [], [], {}
    for u in range(12):
        n = rng.randint(1, 40)
        own = [(start + timedelta(hours=rng.randint(0, 60)), u * 100 + i, rng.choice(NAMES)) for i in range(n)]
        spans = []
        for _ in range(rng.randint(0, 5)):
            a = start + timedelta(hours=rng.randint(0, 55))
            spans.append((rng.choice(NAMES), rng.choice(["include", "exclude", "exclude"]), a, a + timedelta(hours=rng.randint(1, 30))))
        rows += [(f"u{u}", *r) for r in own]
        ranges += [(f"u{u}", *s) for s in spans]
        want |= one_by_one(own, spans)
    df = spark.createDataFrame(rows, "u string, ts timestamp_ntz, i int, split string")
    spans = spark.createDataFrame(ranges, "u string, split string, kind string, start timestamp_ntz, end timestamp_ntz")
    assert {r.i: r.split for r in per_split_filter(df, spans, S.renamed(chunk_s=chunk_s)).collect()} == want
