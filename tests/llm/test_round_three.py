"""Clashing column names in every stage, endless blanks for the tokenizer, draws that decide shards."""

import collections

import pytest
from pyspark.sql import functions as F

from rillet.llm import exact_dedup, minhash, mixing, packing, quality_rules, token_counts

NAMES = ["_size", "_row", "_row_name", "_n_words", "_gone", "_sha", "_id", "_part", "_kept", "_stratum", "_key", "_text", "_s", "_off", "_words",
         "_place", "_pass", "_from", "_to", "_base_failed", "_chunk", "_order", "_before", "given0__", "bucket", "batch", "n_words", "a.b"]


def stages(labels):
    return {"quality": lambda d: quality_rules.keep_good(d, labels), "exact": exact_dedup.dedup_exact, "near": minhash.dedup_near,
            "mix": mixing.mix, "pack": packing.pack_documents}


@pytest.mark.parametrize("stage", ["quality", "exact", "near", "mix", "pack"])
def test_clashing_names(spark, stage):
    """Columns named like an operator's own ones pass through with their values (packing replaces those it makes)."""
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(30)), "en", "src", 5) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.select("*", *(F.lit(77).alias(n) for n in NAMES))
    out = stages(labels)[stage](docs)
    made = set(packing.MADE) if stage == "pack" else set()
    assert set(docs.columns) <= set(out.columns) and (stage == "pack" or out.columns == docs.columns)
    got = out.collect()
    assert len(got) >= 15
    for r in got:
        assert all(r[n] == 77 for n in NAMES if n not in made)


@pytest.mark.parametrize("text", [" " * 2_000_000, "\n" * 2_000_000 + "x", "x" + " \n" * 1_000_000 + "y  ", "#" * 2_000_000, "é " * 10 + " " * 500_000 + "é"])
def test_endless_runs_have_a_token_count(text):
    assert token_counts.n_tokens(token_counts.encoder(token_counts.VOCABULARY), text) > 0


@pytest.mark.parametrize("blank", [" ", "\n", "\t ", "\r\n", " ", "  ", "\x1c "])
def test_long_blanks_count_as_short_ones_do(blank, monkeypatch):
    """With a small limit, texts that the pattern can take whole have the same counts cut at their runs of blanks."""
    import re
    encoding = token_counts.encoder(token_counts.VOCABULARY)
    monkeypatch.setattr(token_counts, "_BLANK_RUN", re.compile(token_counts._BLANK_RUN.pattern.replace("4096", "3")))
    for text in (f"a{blank * 9}b", f"{blank * 9}b", f"a{blank * 9}", blank * 9, f"word,{blank * 5}12{blank * 4}  x y{blank * 3}#!", f"a b{blank}c"):
        assert token_counts.n_tokens(encoding, text) == len(encoding.encode_ordinary(text))


def mixable(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(40 + i % 7)), "en", "abc"[i % 3], 5) for i in range(90)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_slots_hold_what_the_shards_drew(spark):
    """Each shard has exactly its draw of blocks from each source, slots are gapless, and another draw changes that shard alone."""
    docs, drawn = mixable(spark), []

    def draw(slots, shard_slots, seed):
        drawn.append(mixing.draw_shards(slots, 50, seed))
        return drawn[-1]

    def swapped(slots, shard_slots, seed):
        # the first two shards trade one slot between two sources
        rows = {(sh, s): c for sh, s, _, c in mixing.draw_shards(slots, 50, seed)}
        for sh, s, d in ((0, 0, 1), (0, 1, -1), (1, 0, -1), (1, 1, 1)):
            rows[sh, s] += d
        given, out = collections.Counter(), []
        for (sh, s), c in sorted(rows.items()):
            out.append((sh, s, given[s], c))
            given[s] += c
        drawn.append(out)
        return out

    def shards(how):
        rows = mixing.mix_slots(docs, block_words=16, draw=how).collect()
        by = collections.defaultdict(lambda: collections.defaultdict(set))
        for r in rows:
            by[r["shard"]][r["source"]].add(r["slot"])
        return {sh: {s: frozenset(x) for s, x in of.items()} for sh, of in by.items()}, rows

    first, rows = shards(draw)
    order = sorted({r["source"] for r in rows})
    for sh, of in first.items():
        assert {order.index(s): len(x) for s, x in of.items()} == {s: c for q, s, _, c in drawn[0] if q == sh}
        slots = sorted(x for s in of.values() for x in s)
        assert slots == list(range(len(slots)))
    second, _ = shards(swapped)
    count = lambda found, sh: {s: len(x) for s, x in found[sh].items()}
    assert all(count(first, sh) != count(second, sh) for sh in (0, 1))
    assert all(count(first, sh) == count(second, sh) for sh in first if sh > 1)


def test_table_agrees_with_slots(spark):
    docs = mixable(spark)
    table = {r["doc_id"]: r for r in mixing.mix_table(docs, block_words=16).collect()}
    taken, first, places = collections.Counter(), {}, collections.Counter()
    for r in mixing.mix_slots(docs, block_words=16).collect():
        taken[r["doc_id"]] += r["to_word"] - r["from_word"]
        places[r["doc_id"]] += 1
        first[r["doc_id"]] = min(first.get(r["doc_id"], (1 << 60, 0)), (r["shard"], r["slot"]))
    for i, r in table.items():
        assert (r["taken"], r["n_places"]) == (taken[i], places[i]) and (r["first_shard"], r["first_slot"]) == first.get(i, (None, None))
