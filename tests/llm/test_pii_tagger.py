"""Base spans against the patterns, gradients against differences, the tagger on held-out texts."""

import hashlib
import random

import numpy as np
import pytest

from rillet.llm import pii_tagger as P
from tests.llm import brute as B

SCHEMA = "doc_id long, text string, base string, added int, spans string, kind string"


def luhn_tail(digits):
    for last in "0123456789":
        if P.luhn(np.frombuffer((digits + last).encode(), np.uint8)):
            return digits + last


def entity(rng):
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    return rng.choice([
        lambda: f"{rng.choice(['ann', 'bob.x', 'c_d+e'])}{d(2)}@mail{d(1)}.example.com",
        lambda: ".".join(str(rng.randint(0, 255)) for _ in range(4)),
        lambda: luhn_tail(d(15)),
        lambda: f"+1 ({d(3)}) 555-{d(4)}"])()


def text(rng, n):
    words = ["prose", "über", "été", "the", "of", "Year", "12", "7,5", "x-1", "code"]
    return " ".join(entity(rng) if rng.random() < 0.04 else rng.choice(words) for _ in range(n))


def rows():
    rng = random.Random(4)
    out = [(i, text(rng, rng.choice([3, 30, 200]))) for i in range(150)]
    alphabet = "0129.+-() @a%_é\n"
    out += [(1000 + i, "".join(rng.choice(alphabet) for _ in range(rng.choice([5, 60, 300])))) for i in range(150)]
    out += [(2000, None), (2001, ""), (2002, "no data"), (None, "bob@mail.example.com"), (2003, "1" * 30_000), (2004, "1.2.3.4." * 5_000),
            (2005, "a" * 300_000 + "@b.c d" * 3 + "é" * 300_000 + "@é"), (2006, "+1 (499) 555-6503" * 40), (2007, "256.1.1.1 0001.2.3.255 1.2.3"),
            (2008, "+12 3 " + "(" * 1000), (2009, "x@y x@y.z.@q.r"), (3000, "10.0.0.1"), (3000, "10.0.0.1")]
    return out


def digest(spans):
    return hashlib.sha256(",".join(f"{P.KINDS[k]}:{a}:{e}" for a, k, e in spans).encode()).hexdigest()


@pytest.fixture(scope="module")
def found(spark):
    df = spark.createDataFrame([(i, t, "b", 1, "s", "k") for i, t in rows()], SCHEMA).repartition(3)
    return P.pii_table(df, steps=60).collect()


def test_base_columns(found):
    want = {}
    for i, t in rows():
        spans = B.pii(t)
        want.setdefault(i, []).append((*(sum(k == x for _, k, _ in spans) for x in range(4)), digest(spans)))
    got = {}
    for r in found:
        got.setdefault(r["doc_id"], []).append((r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]))
    assert got == want


def test_base_spans_stay_and_added_ones_do_not_overlap(found):
    texts = {i: t for i, t in rows()}
    for r in found:
        spans = [(k, int(a), int(e)) for k, a, e in (x.split(":") for x in r["spans"].split(",") if x)]
        base = [(P.KINDS[k], a, e) for a, k, e in B.pii(texts[r["doc_id"]])]
        assert set(base) <= set(spans) and len(spans) == len(base) + r["n_added"]
        for k, a, e in set(spans) - set(base):
            assert any(c in "0123456789@" for c in texts[r["doc_id"]][a:e])
            assert not any(a < y and x < e for _, x, y in base)
        assert spans == sorted(spans, key=lambda x: (x[1], P.KINDS.index(x[0])))


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert P.pii_table(none, steps=2).collect() == []
    blank = spark.createDataFrame([(1, None, "b", 1, "s", "k"), (2, "words only", "b", 1, "s", "k")], SCHEMA)
    assert {(r["spans"], r["base_sha256"]) for r in P.pii_table(blank, steps=2).collect()} == {("", digest([]))}


def windows(texts):
    data = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    part = P.Slice.of(np.concatenate(data), np.append(0, np.cumsum([len(x) for x in data])))
    row, start, symbols = part.windows()
    return part, row, start, symbols.astype(np.int64)


def test_tagger_on_held_out_texts():
    """Trained on spans of some texts, it finds those of others from the characters alone."""
    rng = random.Random(9)
    part, row, start, symbols = windows([text(rng, 60) for _ in range(300)])
    model = P.train(symbols, part.tags(row, start))
    part, row, start, symbols = windows([text(rng, 60) for _ in range(80)])
    want = {(r, k, a, e) for r, k, a, e, ok in part.matches if ok}
    got = set(P.tagged_spans(model, row, start, symbols))
    hit = len(want & got)
    assert hit / len(want) > 0.75 and hit / len(got) > 0.85


def test_pieces_of_a_long_span_are_joined():
    """A span longer than a window is one span again, and decoding is the same wherever the text begins."""
    rng = random.Random(3)
    part, row, start, symbols = windows([text(rng, 60) for _ in range(200)])
    model = P.train(symbols, part.tags(row, start))
    long = ".".join(["part"] * 40) + "@mail1.example.com"
    part, row, start, symbols = windows([f"of the {long} over"])
    tags = part.tags(row, start)
    pieces = [(int(row[w]), k, int(start[w]) + a, int(start[w]) + e) for w, k, a, e in P.spans_of(tags)]
    assert min(a for *_, a, _ in pieces) <= 7 + len(long) - 19 and max(e for *_, e in pieces) == 7 + len(long)
    assert model.decode(symbols).shape == symbols.shape


def test_gradients():
    rng = np.random.default_rng(0)
    m = P.Tagger(4, 1)
    m.p = {k: v.astype(float) for k, v in m.p.items()}
    s = rng.integers(40, 60, (3, 9))
    y = np.array([[0, 1, 2, 2, 0, 3, 4, 0, 0], [1, 2, 2, 2, 2, 0, 0, 7, 8], [0] * 9])
    _, g = m.loss_and_gradients(s, y)
    for k in m.p:
        for _ in range(6):
            at = tuple(int(rng.integers(0, n)) for n in m.p[k].shape) if k[0] != "x" else (int(s[1, 2]), int(rng.integers(0, 16)))
            if k == "move" and not P.ALLOWED[at]:
                continue
            old, loss = m.p[k][at], []
            for d in (1e-5, -1e-5):
                m.p[k][at] = old + d
                loss.append(m.loss_and_gradients(s, y)[0])
            m.p[k][at] = old
            assert abs((loss[0] - loss[1]) / 2e-5 - g[k][at]) < 1e-6, (k, at)


def test_viterbi_and_marginals_against_all_paths():
    import itertools
    rng = np.random.default_rng(2)
    m = P.Tagger(3, 5)
    m.p["move"] = rng.standard_normal((P.TAGS, P.TAGS))
    m.p["out"] = rng.standard_normal((6, P.TAGS)) * 4
    s = rng.integers(40, 60, (2, 4))
    e = m.emissions(s)[0]
    best, prob = m.decode(s), m.marginals(s)
    for w in range(2):
        paths = [(sum(e[t, w, y] for t, y in enumerate(p)) + sum(m.p["move"][a, b] for a, b in zip(p, p[1:])), p)
                 for p in itertools.product(range(P.TAGS), repeat=4) if P.STARTS[p[0]] and all(P.ALLOWED[a, b] for a, b in zip(p, p[1:]))]
        assert tuple(best[w]) == max(paths)[1]
        z = sum(np.exp(x) for x, _ in paths)
        for t in range(4):
            for y in range(P.TAGS):
                assert abs(sum(np.exp(x) for x, p in paths if p[t] == y) / z - prob[t, w, y]) < 1e-4


def test_masked():
    assert P.masked("a b@c.d e 1.2.3.4", [("email", 2, 7), ("ip", 10, 17)]) == "a <email> e <ip>"
