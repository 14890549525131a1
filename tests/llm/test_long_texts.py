"""Long texts: block by block the same numbers as at once, in memory that a small executor has."""

import random
import tracemalloc

import numpy as np
import pytest

from rillet.llm import common, minhash, quality_gam, quality_rules


def made(seed: int, n: int) -> bytes:
    rng = random.Random(seed)
    parts = ["the", "of", "é", "ÀBC", "#", "!!", "x" * 90, "日本語", "12.5", "a|b", " ", "  ", "\n", "\n\n", "\t", "end.\n", "the same line again\n"]
    return "".join(rng.choice(parts) + rng.choice([" ", "", "\n", " "]) for _ in range(n)).encode()


def numbers(raw: bytes) -> list[np.ndarray]:
    data, offs = np.frombuffer(raw, np.uint8), np.array([0, len(raw)])
    sets = minhash.shingle_sets(data, offs, 2) + minhash.shingle_sets(data, offs, 5)
    return [*quality_rules.text_stats(data, offs), *quality_gam.text_features(data, offs), *sets, minhash.fast_sketch(sets)]


@pytest.mark.parametrize("block", [1, 7, 64, 1000])
def test_blocks_change_nothing(monkeypatch, block):
    texts = [b"", b" \n ", b"word", b"x" * 300, b"x" * 300 + b" ", b"a b c d e a b c d e\na b c d e\n", *(made(s, 150) for s in range(6))]
    whole = [numbers(t) for t in texts]
    monkeypatch.setattr(common, "BLOCK_BYTES", block)
    monkeypatch.setattr(common, "SORTED_AT_ONCE", 5)
    monkeypatch.setattr(quality_rules, "WINDOWS", 3)
    monkeypatch.setattr(minhash, "HASHED", 3)
    for text, want in zip(texts, whole, strict=True):
        assert all(np.array_equal(a, b) for a, b in zip(numbers(text), want, strict=True))


def test_a_slice_of_many_texts_equals_its_texts(monkeypatch):
    texts = [made(s, 40) for s in range(8)] + [b"", b"one"]
    data, offs = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    together = [*quality_rules.text_stats(data, offs), *quality_gam.text_features(data, offs)]
    monkeypatch.setattr(common, "BLOCK_BYTES", 11)
    for i, text in enumerate(texts):
        assert np.allclose([x[i] for x in together], [x[0] for x in numbers(text)[:len(together)]], rtol=0, atol=0)


@pytest.mark.parametrize(("work", "allowed"), [("stats", 12), ("features", 16), ("shingles", 16)])
def test_memory_of_a_long_text(work, allowed):
    """Bytes held for each byte of a text of 24 MB in words of six characters."""
    words = np.random.default_rng(5).integers(97, 123, (24 << 20) // 7 * 7, dtype=np.uint8).reshape(-1, 7)
    words[:, 6] = 32
    words[::12, 6] = 10
    data = words.reshape(-1)
    offs = np.array([0, len(data)])
    run = {"stats": quality_rules.text_stats, "features": quality_gam.text_features,
           "shingles": lambda d, o: minhash.fast_sketch(minhash.shingle_sets(d, o, 5))}[work]
    tracemalloc.start()
    run(data, offs)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < allowed * len(data), peak / len(data)
