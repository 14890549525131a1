"""Keyed state machines for Structured Streaming (T1-T3, change streams), Arrow-batched
``transformWithStateInPandas``.

Each call gets one key's rows of a micro-batch as pandas frames; the state
machine runs over them vectorised with numpy (prefix sums, run positions),
not row by row. Within a micro-batch the rows of a key arrive in no
guaranteed order, so they are sorted by the order columns first; across
micro-batches the order is arrival order. Bound how much of one key a
micro-batch holds with ``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``.
State is typed and lives in the state store (RocksDB), so it survives
restarts from the query's checkpoint.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# The processors are shipped by value: the streaming runner that starts them
# (on the driver as well as on executors) then needs only pyspark installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def run_positions(values: np.ndarray, carry_value, carry_len: int) -> np.ndarray:
    """Position of each value within its run of equal values, continuing a run
    of ``carry_len`` rows of ``carry_value`` that ended the previous batch."""
    m = len(values)
    idx = np.arange(m)
    starts = np.ones(m, dtype=bool)
    starts[1:] = values[1:] != values[:-1]
    start_at = np.maximum.accumulate(np.where(starts, idx, 0))
    pos = idx - start_at + 1
    if carry_len and m and values[0] == carry_value:
        pos[start_at == 0] += carry_len
    return pos


class _Ordered(StatefulProcessor):
    def __init__(self, key_names: Sequence[str], order: Sequence[str], time_col: str):
        self.key_names = list(key_names)
        self.order = list(order)
        self.time_col = time_col

    def _batch(self, frames: Iterator[pd.DataFrame], col: str) -> pd.DataFrame:
        frames = list(frames)
        if not frames:
            return pd.DataFrame(columns=[col])
        pdf = pd.concat(frames, ignore_index=True)
        pdf = pdf[pdf[col].notna()]
        return pdf.sort_values(self.order, kind="stable").reset_index(drop=True)

    def _out(self, key, cols: dict) -> pd.DataFrame:
        n = len(next(iter(cols.values())))
        keys = {k: [v] * n for k, v in zip(self.key_names, key)}
        return pd.DataFrame({**keys, **cols})

    def close(self) -> None:
        pass


class PairAverageProcessor(_Ordered):
    """Average of each non-overlapping group of ``size`` consecutive values,
    truncated toward zero; an incomplete group waits in state."""

    def __init__(self, key_names, order, value: str, time_col: str, size: int = 2,
                 time_alias: str = "create_time", out: str = "average"):
        super().__init__(key_names, order, time_col)
        self.value, self.size, self.time_alias, self.out = value, size, time_alias, out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.acc = handle.getValueState("acc", "n int, total long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n0, total0 = self.acc.get() or (0, 0)  # get() is None when absent: one state call
        pdf = self._batch(rows, self.value)
        v = pdf[self.value].to_numpy(dtype=np.int64)
        m = len(v)
        prefix = np.concatenate([[0], np.cumsum(v)])
        ends = np.nonzero((n0 + np.arange(m) + 1) % self.size == 0)[0]
        if len(ends):
            starts = ends - self.size + 1
            sums = prefix[ends + 1] - prefix[np.maximum(starts, 0)] + np.where(starts < 0, total0, 0)
            yield self._out(key, {self.time_alias: pdf[self.time_col].to_numpy()[ends],
                                  self.out: np.trunc(sums / self.size).astype(np.int32)})
            n1, total1 = m - 1 - ends[-1], int(prefix[m] - prefix[ends[-1] + 1])
        else:
            n1, total1 = n0 + m, total0 + int(prefix[m])
        if n1:
            self.acc.update((int(n1), int(total1)))
        else:
            self.acc.clear()


class RecordRunProcessor(_Ordered):
    """Emit when a run of equal values beats the longest earlier run of
    that value (per key); the longest runs live in map state."""

    def __init__(self, key_names, order, value: str, time_col: str, value_type: str = "int",
                 time_alias: str = "create_time"):
        super().__init__(key_names, order, time_col)
        self.value, self.value_type, self.time_alias = value, value_type, time_alias

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.run = handle.getValueState("run", f"prev {self.value_type}, len int")
        self.best = handle.getMapState("best", f"v {self.value_type}", "len int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        prev, length = self.run.get() or (None, 0)
        pdf = self._batch(rows, self.value)
        if pdf.empty:
            return
        v = pdf[self.value].to_numpy()
        pdf["__n"] = run_positions(v, prev, length)
        # Longest earlier run per value: the stored record, then the running
        # maximum over this batch's earlier rows of the same value.
        base = {}
        for val in pd.unique(v):
            best = self.best.getValue((val.item() if hasattr(val, "item") else val,))
            base[val] = best[0] if best else 1
        earlier = pdf.groupby(self.value, sort=False)["__n"].cummax().groupby(pdf[self.value], sort=False).shift(1)
        bar = np.maximum(pdf[self.value].map(base).to_numpy(dtype=np.int64),
                         earlier.fillna(0).to_numpy(dtype=np.int64))
        rec = pdf[(pdf["__n"] >= 2) & (pdf["__n"].to_numpy() > bar)]
        for val, n in rec.groupby(self.value, sort=False)["__n"].max().items():
            self.best.updateValue((val.item() if hasattr(val, "item") else val,), (int(n),))
        if len(rec):
            yield self._out(key, {self.time_alias: rec[self.time_col].to_numpy(),
                                  "value": rec[self.value].to_numpy(),
                                  "run_length": rec["__n"].to_numpy(dtype=np.int32)})
        last = v[-1]
        self.run.update((last.item() if hasattr(last, "item") else last, int(pdf["__n"].iloc[-1])))


class FlagRunProcessor(_Ordered):
    """When the flag falls from 1 to 0, emit the finished run's length with
    the time of the 0 row (a first row of 0 emits 0 with ``emit_empty_first``)."""

    def __init__(self, key_names, order, flag: str, time_col: str, emit_empty_first: bool = True):
        super().__init__(key_names, order, time_col)
        self.flag, self.emit_empty_first = flag, emit_empty_first

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.run = handle.getValueState("run", "prev int, len int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state = self.run.get()
        has_prev = state is not None
        prev, length = state or (None, 0)
        pdf = self._batch(rows, self.flag)
        f = pdf[self.flag].to_numpy(dtype=np.int64)
        keep = (f == 0) | (f == 1)  # other flag values change nothing
        pdf, f = pdf[keep].reset_index(drop=True), f[keep]
        if not len(f):
            return
        pos = run_positions(f, prev, length if prev == 1 else 0)
        ones_len = np.where(f == 1, pos, 0)
        prev_flag = np.concatenate([[-1 if prev is None else prev], f[:-1]])
        prev_len = np.concatenate([[length if prev == 1 else 0], ones_len[:-1]])
        first_ever = np.zeros(len(f), dtype=bool)
        first_ever[0] = not has_prev and self.emit_empty_first
        emit = (f == 0) & ((prev_flag == 1) | first_ever)
        if emit.any():
            yield self._out(key, {"n_samples": np.where(prev_flag == 1, prev_len, 0)[emit].astype(np.int32),
                                  "end_time": pdf[self.time_col].to_numpy()[emit]})
        self.run.update((int(f[-1]), int(ones_len[-1])))


class SignalStateProcessor(FlagRunProcessor):
    """T3 and T4 from one state: the finished runs, and one row with the key's latest flag for each micro-batch.

    Rows: key..., kind (``run`` or ``current``), n_samples, end_time, flag, and the order
    columns of the latest flag. The flag is the last in arrival: micro-batch, then ``order``."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frames = list(rows)
        for runs in super().handleInputRows(key, iter(frames), timerValues):
            n = len(runs)
            yield self._out(key, {"kind": ["run"] * n, "n_samples": pd.array(runs["n_samples"], "Int32"), "end_time": runs["end_time"].to_numpy(),
                                  "flag": pd.array([None] * n, "Int32"), **{f"o{i}": [None] * n for i in range(len(self.order))}})
        pdf = self._batch(iter(frames), self.flag)
        if len(pdf):
            last = pdf.iloc[-1]
            yield self._out(key, {"kind": ["current"], "n_samples": pd.array([None], "Int32"), "end_time": [None],
                                  "flag": pd.array([int(last[self.flag])], "Int32"), **{f"o{i}": [last[c]] for i, c in enumerate(self.order)}})


#: Places of a key in one row of :class:`ChangeProcessor`'s result.
MOST_PLACES = 1 << 16


class ChangeProcessor(_Ordered):
    """A5: a keyed running count, in order: every row with its key's count, itself included (``n``).

    Grouped by a bucket of keys: many rare keys are numbered in one call. Their counts are map state by cell
    (column ``__cell``: a hash of the key), so the state store is asked once per cell, not per key. With ``places`` a row
    holds several rows of its key, the order columns as lists, and ``n`` is the count before the first of a result row's."""

    def __init__(self, key_names, key_ddl: str, order, whole: Sequence[str] = (), places: bool = False):
        super().__init__(key_names, order, order[0])
        self.key_ddl, self.places = key_ddl, places
        self.whole = list(whole)  # integer keys, which pandas makes floats when some are NULL

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getMapState("counts", "cell int", f"{self.key_ddl}, `__n` array<bigint>")

    def _count(self, pdf: pd.DataFrame, code: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The count of each key (by its code) before these rows; the state is moved on by ``size``."""
        first = pdf.iloc[np.unique(code, return_index=True)[1]]
        gaps = [first[k].isna().to_numpy() for k in self.key_names]
        names = list(zip(*([None if gap else x for x, gap in zip(first[k].tolist(), gone, strict=True)]
                           for k, gone in zip(self.key_names, gaps, strict=True)), strict=True))
        cell = first["__cell"].to_numpy()
        at = np.argsort(cell, kind="stable")
        base = np.zeros(len(names), np.int64)
        size = size.tolist()
        for some in np.split(at, np.flatnonzero(np.diff(cell[at])) + 1):
            key = (int(cell[some[0]]),)
            found = self.counts.getValue(key)
            known = dict(zip(zip(*found[:-1], strict=True), found[-1], strict=True)) if found else {}
            for i in some.tolist():
                before = known.get(names[i], 0)
                known[names[i]] = before + size[i]
                base[i] = before
            self.counts.updateValue(key, (*map(list, zip(*known, strict=True)), list(known.values())))
        return base

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # by position: Spark renames columns that begin with an underscore
        pdf = pd.concat(list(rows), ignore_index=True).set_axis([*self.key_names, *self.order, "__bucket", "__cell"], axis=1)
        pdf = pdf.astype({k: "Int64" for k in self.whole})
        code = pdf.groupby(self.key_names, sort=False, dropna=False).ngroup().to_numpy()
        row = np.repeat(np.arange(len(pdf)), [len(x) for x in pdf[self.order[0]]]) if self.places else np.arange(len(pdf))
        cols = {c: np.concatenate(pdf[c].to_numpy()) if self.places else pdf[c].to_numpy() for c in self.order}
        if all(x.dtype.kind in "iu" for x in cols.values()):
            at = np.lexsort((*reversed(cols.values()), code[row]))
        else:
            at = pd.DataFrame({"__code": code[row], **cols}).sort_values(["__code", *self.order], kind="stable").index.to_numpy()
        by = code[row][at]
        size = np.bincount(by)
        base, start = self._count(pdf, code, size), np.cumsum(size) - size
        index = np.arange(len(by)) - start[by]
        if not self.places:
            out = pdf.iloc[at].reset_index(drop=True)
            yield pd.DataFrame({**{k: out[k] for k in self.key_names}, "n": base[by] + index + 1, **{c: out[c] for c in self.order}})
            return
        cut = np.flatnonzero(index % MOST_PLACES == 0)
        out = pdf.iloc[row[at[cut]]].reset_index(drop=True)
        yield pd.DataFrame({**{k: out[k] for k in self.key_names}, "n": base[by[cut]] + index[cut],
                            **{c: self._parts(v[at], cut) for c, v in cols.items()}})

    @staticmethod
    def _parts(v: np.ndarray, cut: np.ndarray) -> pd.Series:
        ends = np.append(cut[1:], len(v)).tolist()
        return pd.Series([v[a:b] for a, b in zip(cut.tolist(), ends, strict=True)], dtype=object)


class _Bucketed(_Ordered):
    """A state machine over a bucket of keys: the keys of a micro-batch are handled in one call, vectorised over
    all of them, and the state of each is an entry of a map state."""

    def __init__(self, key_names, key_ddl: str, order, col: str, time_col: str, whole: Sequence[str] = ()):
        super().__init__(key_names, order, time_col)
        self.key_ddl, self.col = key_ddl, col
        self.whole = list(whole)  # integer keys, which pandas makes floats when some are NULL

    def _by_key(self, pdf: pd.DataFrame):
        """Rows key by key, each in its order; the number of each row's key, and the keys as state keys."""
        pdf = pdf.astype({k: "Int64" for k in self.whole})
        code = pdf.groupby(self.key_names, sort=False, dropna=False).ngroup().to_numpy()
        at = np.argsort(code, kind="stable")
        pdf, code = pdf.iloc[at].reset_index(drop=True), code[at]
        first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
        return pdf, code, first, self._plain(pdf.iloc[first], self.key_names)

    @staticmethod
    def _plain(rows: pd.DataFrame, cols: Sequence[str]) -> list[tuple]:
        lists = [[None if pd.isna(x) else getattr(x, "item", lambda x=x: x)() for x in rows[c]] for c in cols]
        return list(zip(*lists, strict=True))

    @staticmethod
    def _positions(v: np.ndarray, code: np.ndarray, first: np.ndarray, state: list) -> np.ndarray:
        """Position of each value in its run, which may go on from the key's last (value, length)."""
        starts = np.append(True, (v[1:] != v[:-1]) | (code[1:] != code[:-1]))
        at = np.flatnonzero(starts)
        carry = np.zeros(len(v), np.int64)
        for i, s in zip(first.tolist(), state, strict=True):
            if s is not None and v[i] == s[0]:
                carry[i] = s[1]
        run = np.cumsum(starts) - 1
        return np.arange(len(v)) - at[run] + 1 + carry[at][run]

    def _keyed(self, rows: pd.DataFrame, cols: dict) -> pd.DataFrame:
        return pd.DataFrame({**{k: rows[k].reset_index(drop=True) for k in self.key_names}, **cols})


class BucketRecordRuns(_Bucketed):
    """T2 for a bucket of keys: :class:`RecordRunProcessor`, with the longest runs by key and value."""

    def __init__(self, key_names, key_ddl, order, value: str, time_col: str, value_type: str, whole: Sequence[str] = ()):
        super().__init__(key_names, key_ddl, order, value, time_col, whole)
        self.value_type = value_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.run = handle.getMapState("run", self.key_ddl, f"prev {self.value_type}, len int")
        self.best = handle.getMapState("best", f"{self.key_ddl}, `__v` {self.value_type}", "len int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = self._batch(rows, self.col)
        if pdf.empty:
            return
        pdf, code, first, names = self._by_key(pdf)
        v = pdf[self.col].to_numpy()
        n = self._positions(v, code, first, [self.run.getValue(k) for k in names])
        # Only runs of two or more can be records: the rest need no look at the longest runs.
        pair = pd.DataFrame({"c": code, "v": v, "n": n})
        groups = pair.groupby(["c", "v"], sort=False)
        top = groups["n"].transform("max").to_numpy()
        earlier = groups["n"].cummax().groupby([pair["c"], pair["v"]], sort=False).shift(1).fillna(0).to_numpy(dtype=np.int64)
        pair["bar"] = np.maximum(earlier, 1)
        maybe = pair[(n > pair["bar"].to_numpy()) & (top >= 2)]
        known = {}
        for c, x in maybe[["c", "v"]].drop_duplicates().itertuples(index=False):
            at = (*names[c], x.item() if hasattr(x, "item") else x)
            found = self.best.getValue(at)
            known[c, x] = (at, found[0] if found else 1)
        keep = maybe["n"].to_numpy() > np.fromiter((known[c, x][1] for c, x in zip(maybe["c"], maybe["v"], strict=True)), np.int64, len(maybe))
        rec = maybe[keep]
        for (c, x), most in rec.groupby(["c", "v"], sort=False)["n"].max().items():
            self.best.updateValue(known[c, x][0], (int(most),))
        ends = np.append(first[1:], len(v)) - 1
        for k, i in zip(names, ends.tolist(), strict=True):
            self.run.updateValue(k, (v[i].item() if hasattr(v[i], "item") else v[i], int(n[i])))
        if len(rec):
            out = pdf.iloc[rec.index]
            yield self._keyed(out, {"create_time": out[self.time_col].to_numpy(), "value": out[self.col].to_numpy(),
                                    "run_length": rec["n"].to_numpy(dtype=np.int32)})


class BucketFlagRuns(_Bucketed):
    """T3 for a bucket of keys: :class:`FlagRunProcessor`; with ``latest`` also the latest flag of each key, in the
    rows of :class:`SignalStateProcessor`."""

    def __init__(self, key_names, key_ddl, order, flag: str, time_col: str, whole: Sequence[str] = (),
                 emit_empty_first: bool = True, latest: bool = False):
        super().__init__(key_names, key_ddl, order, flag, time_col, whole)
        self.emit_empty_first, self.latest = emit_empty_first, latest

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.run = handle.getMapState("run", self.key_ddl, "prev int, len int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = self._batch(rows, self.col)
        if pdf.empty:
            return
        pdf, code, first, names = self._by_key(pdf)
        f = pdf[self.col].to_numpy(dtype=np.int64)
        last = pdf.iloc[np.append(first[1:], len(f)) - 1]
        keep = (f == 0) | (f == 1)  # other flag values change nothing
        if keep.any():
            yield from self._runs(pdf[keep].reset_index(drop=True), f[keep], code[keep], names)
        if self.latest:
            n = len(last)
            yield self._keyed(last, {"kind": ["current"] * n, "n_samples": pd.array([None] * n, "Int32"), "end_time": [None] * n,
                                     "flag": pd.array(last[self.col].to_numpy(dtype=np.int32), "Int32"),
                                     **{f"o{i}": last[c].to_numpy() for i, c in enumerate(self.order)}})

    def _runs(self, pdf, f, code, names):
        first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
        names = [names[c] for c in code[first]]
        state = [self.run.getValue(k) for k in names]
        ones = np.where(f == 1, self._positions(f, code, first, state), 0)
        before, length = np.append(-1, f[:-1]), np.append(0, ones[:-1])
        before[first] = [-1 if s is None else s[0] for s in state]
        length[first] = [s[1] if s is not None and s[0] == 1 else 0 for s in state]
        new = np.zeros(len(f), bool)
        new[first] = [s is None and self.emit_empty_first for s in state]
        emit = (f == 0) & ((before == 1) | new)
        for k, i in zip(names, (np.append(first[1:], len(f)) - 1).tolist(), strict=True):
            self.run.updateValue(k, (int(f[i]), int(ones[i])))
        if not emit.any():
            return
        out, n = pdf[emit], np.where(before == 1, length, 0)[emit].astype(np.int32)
        if not self.latest:
            yield self._keyed(out, {"n_samples": n, "end_time": out[self.time_col].to_numpy()})
            return
        yield self._keyed(out, {"kind": ["run"] * len(n), "n_samples": pd.array(n, "Int32"), "end_time": out[self.time_col].to_numpy(),
                                "flag": pd.array([None] * len(n), "Int32"), **{f"o{i}": [None] * len(n) for i in range(len(self.order))}})
