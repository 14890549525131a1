"""Near words by composition against comparing all words; acceptors; hot groups; chains of forms."""

import itertools
import random
import zlib

import pytest

from rillet.llm import spelling_variants as V
from tests.llm import brute as B

SCHEMA = "doc_id long, text string, word string, n long, form string, a int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "y", 2) for i, t in rows], SCHEMA)


def corpus():
    rng = random.Random(11)
    words = ["aaaaaa", "aaaaaaa", "aaabaaa", "abcdef", "abcdeg", "abcdefg", "bcdefg", "Überall", "überall", "uberall", "einträge", "eintrage", "x×x÷xxx",
             "colour", "color", "colours", "banana", "bananna", "bannana", "abababab", "babababa", "short", "tiny"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 5, 40])))) for i in range(60)]
    rows += [(100 + i, "mississippi misissippi " * 3 + "1mississippi2 MISSISSIPPI") for i in range(6)]
    for k, w in enumerate(["chainword", "chainwordx", "chainwordxy"]):
        rows += [(200 + k, f"{w} " * 5 ** (k + 1))]
    rows += [(300, None), (301, ""), (302, "..."), (None, "abcdef " * 6), (303, "z" * 100_000), (5, "colours " * 7), (5, "colours " * 7)]
    # a document whose run loses a character, and one that spells it whole
    spoilt = next(i for i in itertools.count(1000) if zlib.crc32(f"{i}:frequentword".encode()) % 199 == 0)
    rows += [(spoilt, "FrequentWord " * 6), (spoilt + 1, "frequentword " * 40)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.mark.parametrize("group_words", [20_000, 3])
def test_variants(spark, rows, group_words):
    got = V.variant_table(frame(spark, rows).repartition(4), group_words=group_words).collect()
    want = B.variants(rows)
    assert len(got) == len(want)
    for r in got:
        assert (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) == want[r["word"]], r["word"]
    assert want["chainword"][1] == "chainwordxy"
    assert any(len(w) < len("frequentword") and f[0] == "frequentword" for w, f in want.items())


def test_empty(spark):
    assert V.variant_table(frame(spark, [])).collect() == []
    assert V.variant_table(frame(spark, [(1, None), (2, "few words only")])).collect() == []


def test_acceptor_is_minimal_and_exact():
    words = sorted({"".join(p) for p in itertools.product("ab", repeat=3)} | {"b", "abab", ""})
    a = V.Acceptor(words)

    def accepted(s):
        state = 0
        for c in s:
            state = a.arcs[state].get(c, -1)
            if state < 0:
                return False
        return a.final[state]

    for k in range(6):
        for s in map("".join, itertools.product("ab", repeat=k)):
            assert accepted(s) == (s in words)
    tail = V.Acceptor(sorted(x + "ing" for x in "abcdefgh"))
    reached, todo = set(), [0]
    while todo:
        s = todo.pop()
        if s not in reached:
            reached.add(s)
            todo += tail.arcs[s].values()
    assert len(reached) == 5  # one chain for the shared ending


def test_composition_finds_each_pair_once():
    rng = random.Random(2)
    for _ in range(60):
        alphabet = "ab" if rng.random() < .5 else "abc"
        short = sorted({"".join(rng.choice(alphabet) for _ in range(4)) for _ in range(rng.randint(0, 9))})
        long = sorted({"".join(rng.choice(alphabet) for _ in range(5)) for _ in range(rng.randint(0, 15))})
        got = list(V.composed(short, long, True))
        want = [(u, v) for u, v in itertools.combinations(short, 2) if sum(x != y for x, y in zip(u, v)) == 1]
        want += [(u, v) for u in short for v in long if any(v[:i] + v[i + 1:] == u for i in range(5))]
        assert sorted(tuple(sorted(p)) for p in got) == sorted(tuple(sorted(p)) for p in want)


def test_long_words_need_no_recursion():
    u = "q" * 50_000
    assert list(V.composed([u], [u + "r"], True)) == [(u, u + "r")]
    assert list(V.composed([u + "a" + u, u + "b" + u], [], True)) == [(u + "a" + u, u + "b" + u)]
