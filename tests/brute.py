"""Plain-Python transcriptions of the sequence semantics, one row at a time.

Used as the oracle for the chunk-parallel Spark operators on small inputs.
Each function takes rows already sorted in sequence order for one key.
"""

from __future__ import annotations

import math


def pair_average(rows, size=2):
    """rows: [(time, value)] -> [(time, int(sum/size))] per completed group."""
    out, n, total = [], 0, 0
    for t, v in rows:
        n, total = n + 1, total + v
        if n >= size:
            out.append((t, math.trunc(total / size)))
            n, total = 0, 0
    return out


def record_runs(rows):
    """rows: [(time, value)] -> [(time, value, run_length)] when a run beats the record."""
    out, prev, length, best = [], object(), 0, {}
    for t, v in rows:
        if v != prev:
            prev, length = v, 1
            continue
        length += 1
        if v not in best or length > best[v]:
            best[v] = length
            out.append((t, v, length))
    return out


def flag_runs(rows, emit_empty_first=True):
    """rows: [(time, flag)] -> [(run_length, end_time)] when a run of 1s ends."""
    out, prev, length = [], None, 0
    for t, f in rows:
        if f == 1:
            length = length + 1 if prev == 1 else 1
            prev = 1
        elif f == 0:
            if prev == 1 or (prev is None and emit_empty_first):
                out.append((length if prev == 1 else 0, t))
            prev, length = 0, 0
    return out


def running(rows, fn):
    acc, out = None, []
    for v in rows:
        acc = v if acc is None else fn(acc, v)
        out.append(acc)
    return out
