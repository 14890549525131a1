"""Personal data: base patterns, and a character-level bidirectional LSTM with a CRF on top.

The base patterns (email, ip, card, phone) are found on the bytes of whole texts.
Their spans label the characters of a bounded sample of windows, from which the
tagger is trained in numpy: an LSTM in either direction reads a window of
characters, a linear layer scores a tag for each (outside, or begin / inside of a
kind), and learnt transitions tie neighbouring tags together. It then reads every text in
overlapping windows; each window is decoded by Viterbi and the spans of all
windows of a text are reconciled: pieces of one span that windows cut are joined, base spans win, then
the longer of two that overlap. A span must hold a digit or an ``@``, so windows without one need no decoding.

The tagger adds spans to the base; it never takes one away. It adds none over a match
that a base check turned down (digit count, Luhn, parts above 255): the checks know more than the characters show.

Memory: about 12 bytes a byte of the longest text of an Arrow batch.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import small_batches, text_slices, written

KINDS = ["email", "ip", "card", "phone"]
#: Documents (those with the smallest hash of their identifier) and windows that the tagger is trained on, at most.
SAMPLE_DOCS, SAMPLE_WINDOWS = 20_000, 6_000
#: Characters of a window that are its own, and those it sees on either side.
CORE, MARGIN = 40, 20
WIDTH = CORE + 2 * MARGIN
HIDDEN, STEPS, BATCH, RATE, SEED = 16, 240, 96, 0.05, 12
#: A span is added if each of its tags is at least so probable.
SURE = 0.8
#: Windows decoded at once.
DECODE = 2048
PAD, SYMBOLS = 256, 257
TAGS = 1 + 2 * len(KINDS)


def _members(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_DIGITS = "0123456789"
_ALNUM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" + _DIGITS
IS_DIGIT, IS_PHONE = _members(_DIGITS), _members(_DIGITS + " ().-")
IS_LOCAL, IS_HOST = _members(_ALNUM + "._%+-"), _members(_ALNUM + ".-")
_HOST = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")


def luhn(digits: np.ndarray) -> bool:
    """Whether ASCII digits pass the Luhn check."""
    d = digits[::-1].astype(int) - 48
    twice = 2 * d[1::2]
    return int(d[::2].sum() + (twice - 9 * (twice > 9)).sum()) % 10 == 0


# ------------------------------------------------------------------ base spans

def _digit_runs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(IS_DIGIT[data].astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def base_matches(data: np.ndarray) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, passed its check) of every base match, in byte positions.

    ``data``: texts one after the other with a zero byte between them, which no pattern takes."""
    out = []
    # email: each @ with what stands left of it, as far as no match before it reaches
    at = np.flatnonzero(data == 64)
    if len(at):
        stops = np.flatnonzero(~IS_LOCAL[data])
        left = np.searchsorted(stops, at)
        begins = np.where(left > 0, stops[np.maximum(left - 1, 0)] + 1, 0)
        outside = np.append(np.flatnonzero(~IS_HOST[data]), len(data))
        ends = outside[np.searchsorted(outside, at + 1)]
        done = 0
        for p, a, e in zip(at.tolist(), begins.tolist(), ends.tolist(), strict=True):
            a = max(a, done)
            found = _HOST.match(data[p + 1:e].tobytes()) if a < p else None
            if found:
                done = p + 1 + found.end()
                out.append((0, a, done, True))
    start, end = _digit_runs(data)
    if not len(start):
        return out
    gap = (start[1:] - end[:-1] == 1)
    between = data[end[:-1]] if len(start) > 1 else data[:0]
    dotted = gap & (between == 46)
    # ip: four runs with single dots between them
    taken = 0
    for i in np.flatnonzero(dotted[:-2] & dotted[1:-1] & dotted[2:]).tolist() if len(dotted) > 2 else []:
        if i >= taken:
            taken = i + 4
            parts = [data[start[k]:end[k]].tobytes().lstrip(b"0") for k in range(i, i + 4)]
            out.append((1, int(start[i]), int(end[i + 3]), all(len(x) < 4 and int(x or b"0") <= 255 for x in parts)))
    # card: runs chained by single blanks or hyphens
    chained = gap & ((between == 32) | (between == 45))
    first = np.flatnonzero(np.append(True, ~chained))
    last = np.append(first[1:] - 1, len(start) - 1)
    total = np.append(0, np.cumsum(end - start))
    digits = total[last + 1] - total[first]
    for i in np.flatnonzero(digits >= 14).tolist():  # fewer digits are no card and turn no span of the tagger down
        a, e = int(start[first[i]]), int(end[last[i]])
        part = data[a:e]
        out.append((2, a, e, digits[i] <= 19 and luhn(part[IS_DIGIT[part]])))
    # phone: from a plus and a digit to the last digit before another kind of character
    plus = np.flatnonzero(data == 43)
    plus = plus[plus + 1 < len(data)]
    plus = plus[IS_DIGIT[data[plus + 1]]]
    if len(plus):
        outside = np.append(np.flatnonzero(~IS_PHONE[data]), len(data))
        stop = outside[np.searchsorted(outside, plus + 2)]
        k = np.searchsorted(start, stop) - 1  # the last run that begins before the stop
        close = np.minimum(end[k], stop)
        begin_run = np.searchsorted(start, plus + 1)
        n = total[k + 1] - total[begin_run]
        for p, e, m in zip(plus.tolist(), close.tolist(), n.tolist(), strict=True):
            if e >= p + 4:
                out.append((3, p, e, 10 <= m <= 15))
    return out


# ------------------------------------------------------------------ windows

@dataclass
class Slice:
    """Characters of some texts: ``symbol`` of each (its first byte), ``first`` character of every text, and base matches."""

    symbol: np.ndarray
    first: np.ndarray
    matches: list[tuple[int, int, int, int, bool]]  # text, kind, start, end (characters of the text), passed

    @staticmethod
    def of(data: np.ndarray, offs: np.ndarray) -> Slice:
        joined = np.insert(data, offs[1:-1], 0) if len(offs) > 2 else data
        begin = offs[:-1] + np.arange(len(offs) - 1)  # of each text in ``joined``
        lead = (joined & 0xC0) != 0x80
        chars = np.zeros(len(joined) + 1, np.uint32)
        np.cumsum(lead, out=chars[1:])
        first = chars[begin].astype(np.int64)
        matches = []
        for kind, a, e, ok in base_matches(joined):
            row = int(np.searchsorted(begin, a, "right")) - 1
            matches.append((row, kind, int(chars[a]) - int(first[row]), int(chars[e]) - int(first[row]), bool(ok)))
        return Slice(joined[lead], np.append(first, chars[-1] + 1), matches)

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, first character of the window in its text, symbols) of each window that holds a digit or an @."""
        hot = np.flatnonzero(IS_DIGIT[self.symbol] | (self.symbol == 64))
        row = np.searchsorted(self.first, hot, "right") - 1
        at = hot - self.first[row]
        cores = [np.stack([row, (at + shift) // CORE], 1) for shift in (-MARGIN, 0, MARGIN)]
        grid = np.concatenate(cores)
        grid = grid[grid[:, 1] >= 0]
        length = (self.first[1:] - 1 - self.first[:-1])[grid[:, 0]]
        grid = np.unique(grid[grid[:, 1] * CORE < length], axis=0)
        row, start = grid[:, 0], grid[:, 1] * CORE - MARGIN
        pos = start[:, None] + np.arange(WIDTH)
        length = (self.first[1:] - 1 - self.first[:-1])[row]
        inside = (pos >= 0) & (pos < length[:, None])
        symbols = np.full(pos.shape, PAD, np.int16)
        symbols[inside] = self.symbol[(self.first[row][:, None] + pos)[inside]]
        return row, start, symbols

    def tags(self, row: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Tag of every character of those windows, from the base spans that passed."""
        out = np.zeros((len(row), WIDTH), np.int8)
        place = {}
        for w, (r, s) in enumerate(zip(row.tolist(), start.tolist(), strict=True)):
            place[r, (s + MARGIN) // CORE] = w
        for r, kind, a, e, ok in self.matches:
            if ok:
                for c in range(max(0, a - MARGIN) // CORE, (e + MARGIN) // CORE + 1):
                    w = place.get((r, c))
                    if w is not None:
                        lo, hi = a - start[w], e - start[w]
                        if hi > 0 and lo < WIDTH:
                            out[w, max(lo, 0):hi] = 2 + 2 * kind
                            out[w, max(lo, 0)] = 1 + 2 * kind  # a span that begins left of the window begins with it
        return out


# ------------------------------------------------------------------ the tagger

def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _allowed() -> np.ndarray:
    """Whether a tag may follow another: inside only after begin or inside of the same kind."""
    ok = np.ones((TAGS, TAGS), bool)
    for k in range(len(KINDS)):
        ok[:, 2 + 2 * k] = False
        ok[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = True
    return ok


ALLOWED = _allowed()
STARTS = np.array([t == 0 or t % 2 == 1 for t in range(TAGS)])


class Tagger:
    """Bidirectional LSTM and CRF over windows of symbols."""

    def __init__(self, hidden: int = HIDDEN, seed: int = SEED):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.standard_normal(shape) * 0.15).astype(np.float32)
        self.hidden = hidden
        self.p = {}
        for d in "fb":
            self.p |= {f"x{d}": draw(SYMBOLS, 4 * hidden), f"h{d}": draw(hidden, 4 * hidden), f"c{d}": np.zeros(4 * hidden, np.float32)}
            self.p[f"c{d}"][hidden:2 * hidden] = 1  # remember at first
        self.p |= {"out": draw(2 * hidden, TAGS), "bias": np.zeros(TAGS, np.float32), "move": np.zeros((TAGS, TAGS), np.float32)}

    def _lstm(self, symbols: np.ndarray, d: str, keep: bool):
        """Hidden states (time, window, unit); with ``keep`` also what the gradients need."""
        h_, steps = self.hidden, symbols.shape[1]
        times = range(steps) if d == "f" else range(steps - 1, -1, -1)
        kind = self.p["out"].dtype
        h = c = np.zeros((len(symbols), h_), kind)
        out, saved = np.zeros((steps, len(symbols), h_), kind), []
        table = self.p[f"x{d}"] + self.p[f"c{d}"]
        for t in times:
            z = table[symbols[:, t]] + h @ self.p[f"h{d}"]
            g = _sigmoid(z[:, :3 * h_])
            i, f, o, u = g[:, :h_], g[:, h_:2 * h_], g[:, 2 * h_:], np.tanh(z[:, 3 * h_:])
            before, c_before = h, c
            c = f * c + i * u
            tc = np.tanh(c)
            h = o * tc
            out[t] = h
            if keep:
                saved.append((t, i, f, o, u, tc, before, c_before))
        return out, saved

    def emissions(self, symbols: np.ndarray, keep: bool = False):
        """Scores (time, window, tag)."""
        (hf, sf), (hb, sb) = (self._lstm(symbols, d, keep) for d in "fb")
        h = np.concatenate([hf, hb], 2)
        return h @ self.p["out"] + self.p["bias"], h, sf, sb

    def _chain(self, e: np.ndarray):
        """Scaled forward and backward messages and the log of the partition function."""
        peak = e.max(2, keepdims=True)
        x = np.exp(e - peak)
        a = np.exp(self.p["move"]) * ALLOWED
        steps, n, _ = e.shape
        fwd, bwd, scale = np.zeros_like(x), np.ones_like(x), np.zeros((steps, n), x.dtype)
        m = x[0] * STARTS
        for t in range(steps):
            if t:
                m = (fwd[t - 1] @ a) * x[t]
            scale[t] = m.sum(1)
            fwd[t] = m / scale[t][:, None]
        for t in range(steps - 2, -1, -1):
            bwd[t] = ((bwd[t + 1] * x[t + 1]) @ a.T) / scale[t + 1][:, None]
        return fwd, bwd, scale, x, a, np.log(scale).sum(0) + peak[..., 0].sum(0)

    def marginals(self, symbols: np.ndarray) -> np.ndarray:
        """Probability of each tag (time, window, tag)."""
        fwd, bwd, *_ = self._chain(self.emissions(symbols)[0])
        p = fwd * bwd
        return p / p.sum(2, keepdims=True)

    def decode(self, symbols: np.ndarray) -> np.ndarray:
        """The best tags of each window (Viterbi)."""
        e = self.emissions(symbols)[0]
        move = np.where(ALLOWED, self.p["move"], -1e9).astype(np.float32)
        v = np.where(STARTS, e[0], -1e9)
        back = np.zeros(e.shape, np.int8)
        for t in range(1, len(e)):
            s = v[:, :, None] + move
            back[t] = s.argmax(1)
            v = s.max(1) + e[t]
        out = np.zeros(symbols.shape, np.int8)
        out[:, -1] = v.argmax(1)
        rows = np.arange(len(symbols))
        for t in range(len(e) - 1, 0, -1):
            out[:, t - 1] = back[t][rows, out[:, t]]
        return out

    def loss_and_gradients(self, symbols: np.ndarray, tags: np.ndarray):
        """Mean negative log-likelihood of ``tags``, and its gradient for every parameter."""
        e, h, sf, sb = self.emissions(symbols, True)
        fwd, bwd, scale, x, a, log_z = self._chain(e)
        steps, n, _ = e.shape
        y = tags.T.astype(int)
        t_, w_ = np.arange(steps)[:, None], np.arange(n)[None, :]
        gold = e[t_, w_, y].sum(0) + self.p["move"][y[:-1], y[1:]].sum(0)
        p = fwd * bwd
        de = p / p.sum(2, keepdims=True)
        de[t_, w_, y] -= 1
        de /= n
        follow = bwd[1:] * x[1:] / scale[1:][:, :, None]
        dmove = a * (fwd[:-1].reshape(-1, TAGS).T @ follow.reshape(-1, TAGS))
        np.subtract.at(dmove, (y[:-1].ravel(), y[1:].ravel()), 1)
        g = {"move": dmove / n * ALLOWED, "bias": de.sum((0, 1)), "out": h.reshape(-1, h.shape[2]).T @ de.reshape(-1, TAGS)}
        dh = de @ self.p["out"].T
        k = self.hidden
        for d, saved, part in (("f", sf, dh[:, :, :k]), ("b", sb, dh[:, :, k:])):
            gx, gh, gc = np.zeros_like(self.p[f"x{d}"]), np.zeros_like(self.p[f"h{d}"]), np.zeros_like(self.p[f"c{d}"])
            next_h = next_c = np.zeros((n, k), e.dtype)
            for t, i, f, o, u, tc, before, c_before in reversed(saved):
                hh = part[t] + next_h
                cc = next_c + hh * o * (1 - tc * tc)
                dz = np.concatenate([cc * u * i * (1 - i), cc * c_before * f * (1 - f), hh * tc * o * (1 - o), cc * i * (1 - u * u)], 1)
                next_c = cc * f
                next_h = dz @ self.p[f"h{d}"].T
                gh += before.T @ dz
                gc += dz.sum(0)
                np.add.at(gx, symbols[:, t], dz)
            g |= {f"x{d}": gx, f"h{d}": gh, f"c{d}": gc}
        return float((log_z - gold).mean()), g


def train(symbols: np.ndarray, tags: np.ndarray, steps: int = STEPS, seed: int = SEED, hidden: int = HIDDEN) -> Tagger:
    """Fit a tagger by Adam. Digits and letters are redrawn within their class in each
    batch, so that it learns forms and not the numbers at hand. Without windows it stays untrained."""
    model, rng = Tagger(hidden, seed), np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in model.p.items()}
    v = {k: np.zeros_like(x) for k, x in model.p.items()}
    for step in range(1, steps + 1 if len(symbols) else 1):
        pick = rng.integers(0, len(symbols), BATCH)
        s, y = symbols[pick].copy(), tags[pick]
        digit = (s >= 48) & (s <= 57)
        s[digit] = rng.integers(48, 58, int(digit.sum()))
        letter = (s >= 97) & (s <= 122) & (rng.random(s.shape) < 0.3)
        s[letter] = rng.integers(97, 123, int(letter.sum()))
        _, g = model.loss_and_gradients(s, y)
        norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
        rate = RATE * min(1, step / 10) * (1 - step / (steps + 1))
        for k, x in g.items():
            x = x * min(1, 5 / (norm + 1e-9))
            m[k] = 0.9 * m[k] + 0.1 * x
            v[k] = 0.99 * v[k] + 0.01 * x * x
            model.p[k] -= (rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return model


def spans_of(tags: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(window, kind, start, end) of the spans in rows of tags."""
    out = []
    for w, t in zip(*(x.tolist() for x in np.nonzero(tags % 2 == 1)), strict=True):
        kind, e = int(tags[w, t]) // 2, t + 1
        while e < tags.shape[1] and tags[w, e] == 2 + 2 * kind:
            e += 1
        out.append((w, kind, t, e))
    return out


def tagged_spans(model: Tagger, row: np.ndarray, start: np.ndarray, symbols: np.ndarray, sure: float = SURE) -> list[tuple[int, int, int, int]]:
    """(text, kind, start, end) that the tagger finds in windows, pieces that windows cut joined."""
    found = []
    for i in range(0, len(row), DECODE):
        s = symbols[i:i + DECODE]
        spans = spans_of(model.decode(s))
        spans = [x for x in spans if (IS_DIGIT[s[x[0], x[2]:x[3]] & 255] | (s[x[0], x[2]:x[3]] == 64)).any()]
        which = sorted({w for w, *_ in spans})
        p = dict(zip(which, model.marginals(s[which]).transpose(1, 0, 2), strict=True)) if which else {}
        for w, kind, a, e in spans:
            inside = np.arange(a, e)
            if p[w][inside, np.where(inside == a, 1 + 2 * kind, 2 + 2 * kind)].min() >= sure:
                at = int(start[i + w])
                found.append((int(row[i + w]), kind, at + a, at + e))
    joined: list[tuple[int, int, int, int]] = []
    for r, kind, a, e in sorted(found):
        if joined and joined[-1][:2] == (r, kind) and a < joined[-1][3]:
            joined[-1] = (r, kind, joined[-1][2], max(e, joined[-1][3]))
        else:
            joined.append((r, kind, a, e))
    return joined


def reconciled(found: list[tuple[int, int, int, int]], matches: list[tuple[int, int, int, int, bool]]) -> list[tuple[int, int, int, int]]:
    """The tagger's spans that stay beside the base: none over a base match, of two that overlap the longer."""
    held: dict[int, list[tuple[int, int]]] = {}
    for r, _, a, e, _ in matches:
        held.setdefault(r, []).append((a, e))
    out = []
    for r, kind, a, e in sorted(found, key=lambda x: (x[0], x[2] - x[3], x[2], x[1])):
        mine = held.setdefault(r, [])
        if not any(a < y and x < e for x, y in mine):
            mine.append((a, e))
            out.append((r, kind, a, e))
    return out


# ------------------------------------------------------------------ over a table

def labelled_windows(docs: DataFrame, id_col: str, text_col: str, n_docs: int, n_windows: int) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, tags) of at most ``n_windows`` windows of at most ``n_docs`` documents, on the driver."""
    small_batches(docs.sparkSession)
    named = docs.select(F.xxhash64(F.col(id_col)).alias("h"), F.col(text_col).cast("string").alias("text"))
    ids = written(named.select("h").distinct().orderBy("h").limit(n_docs), "pii-sample")

    def run(batches):
        for b in batches:
            for _, _, data, offs in text_slices(b.column(1)):
                part = Slice.of(data, offs)
                row, start, symbols = part.windows()
                tags = part.tags(row, start)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.tobytes() for x in symbols], pa.binary()), pa.array([x.tobytes() for x in tags], pa.binary())], names=["symbols", "tags"])

    rows = (named.join(ids, "h", "left_semi").mapInArrow(run, "symbols binary, tags binary")
            .withColumn("o", F.xxhash64("symbols")).orderBy("o", "symbols", "tags").limit(n_windows).collect())
    return (np.array([np.frombuffer(r[0], np.int16) for r in rows]).reshape(-1, WIDTH).astype(np.int64),
            np.array([np.frombuffer(r[1], np.int8) for r in rows]).reshape(-1, WIDTH))


def span_lists(docs: DataFrame, model: Tagger, id_col: str = "doc_id", text_col: str = "text", sure: float = SURE) -> DataFrame:
    """doc_id, base, added: for every row the base spans and the tagger's, as arrays of
    (kind, start, end) in characters, ordered by start and kind."""
    small_batches(docs.sparkSession)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches):
        for b in batches:
            base = [[] for _ in range(b.num_rows)]
            added = [[] for _ in range(b.num_rows)]
            matches, rows, starts, symbols = [], [], [], []
            for i, _, data, offs in text_slices(b.column(1)):
                part = Slice.of(data, offs)
                matches += [(i + r, *rest) for r, *rest in part.matches]
                row, start, s = part.windows()
                rows.append(row + i)
                starts.append(start)
                symbols.append(s)
            for r, kind, a, e, ok in matches:
                if ok:
                    base[r].append((a, kind, e))
            if rows:
                found = tagged_spans(model, np.concatenate(rows), np.concatenate(starts), np.concatenate(symbols).astype(np.int64), sure)
                for r, kind, a, e in reconciled(found, matches):
                    added[r].append((a, kind, e))
            lists = [pa.array([[{"kind": KINDS[k], "start": a, "end": e} for a, k, e in sorted(x)] for x in side], pa.list_(span)) for side in (base, added)]
            yield pa.RecordBatch.from_arrays([b.column(0), *lists], names=["doc_id", "base", "added"])

    spans = "array<struct<kind:string,start:long,end:long>>"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"doc_id long, base {spans}, added {spans}")


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_docs: int = SAMPLE_DOCS,
               n_windows: int = SAMPLE_WINDOWS, steps: int = STEPS, sure: float = SURE) -> DataFrame:
    """:func:`span_lists` with a tagger trained on a bounded sample of the same table."""
    symbols, tags = labelled_windows(docs, id_col, text_col, n_docs, n_windows)
    return span_lists(docs, train(symbols, tags, steps), id_col, text_col, sure)


def _joined(spans: str):
    order = "CASE x.kind " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(KINDS)) + " END"
    ranked = f"array_sort(transform({spans}, x -> struct(x.start AS a, {order} AS k, x.end AS e, x.kind AS n)))"
    return F.expr(f"array_join(transform({ranked}, x -> concat(x.n, ':', x.a, ':', x.e)), ',')")


def pii_table(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_added of every row.

    A null or empty text has no spans (the hash is that of the empty string); repeated rows
    have a result each; other columns are not read; an empty table gives an empty result."""
    found = find_spans(docs, **options)
    n = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *(n(k) for k in KINDS), F.sha2(_joined("base"), 256).alias("base_sha256"),
                        _joined("concat(base, added)").alias("spans"), F.size("added").cast("long").alias("n_added"))


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with every span replaced by its kind in angle brackets; of spans that overlap the first counts."""
    out, at = [], 0
    for kind, a, e in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]))):
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
            at = e
    return "".join(out) + text[at:]
