"""corpus_pipeline.run() on a small table with labels, each stage against its brute-force version."""

import random
from math import comb

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rillet.llm import mixing, packing, quality_rules
from tests.llm import brute as B

DOCS, LABELS = "doc_id long, text string, lang string, source string, n_chars long", "doc_id long, quality int, toxic int"


def made():
    rng = random.Random(8)
    prose = lambda n: [rng.choice(["lorem", "ipsum", "dolor", "Amet"]) + str(rng.randint(0, 10 ** 5)) for _ in range(n)]
    good = [(i, " ".join(prose(rng.randint(25, 60)) + ["#"] * (i % 12 == 0)), "en", "abc"[i % 3]) for i in range(240)]
    bad = [(1000 + i, " ".join("##" + w for w in prose(30)), "en", "a") for i in range(8)]
    other = [(1100 + i, " ".join("##" + w for w in prose(30)), "de", "b") for i in range(3)]
    copies = [(2000 + i, good[5 * i][1].upper(), "en", "b") for i in range(15)]
    near = []
    for i in range(15):
        w = good[5 * i + 1][1].split(" ")
        w[0] = "changed"
        near.append((3000 + i, " ".join(w), "en", "c"))
    odd = [(4000, None, None, None), (4001, "", "en", "a"), (4002, "too short", "en", "a"), (4003, "so so " * 20, "en", "a")]
    rows = good + bad + other + copies + near + odd
    return rows, [(i, 1, 0) for i, *_ in good] + [(i, 0, 0) for i, *_ in bad + other]


def shares(text):
    n, chars, symbols, dup, repeat = B.base_stats(text)
    lines = sum(bool(B.WORD.search(x)) for x in (text or "").split("\n"))
    upper = sum("A" <= c <= "Z" for c in text or "")
    per = lambda a, b: a / max(b, 1)
    return {"symbols": per(symbols, n), "dup_lines": per(dup, lines), "repeats": per(repeat, n), "upper": per(upper, chars),
            "bangs": per((text or "").count("!"), n), "long_words": per(chars, n), "short_words": per(chars, n)}


def beyond(share, name, cut):
    return share[name] > cut if quality_rules.RULES[name][1] else share[name] < cut


def best_cuts(plan, test, strata):
    """The certified cutoff of each rule, by walking the path one step at a time."""
    steps = []
    for r, (name, (_, _, cuts)) in enumerate(quality_rules.RULES.items()):
        steps += [(sum(beyond(s, name, c) for s in plan), (i + 1) / len(cuts), r, i, name, c) for i, c in enumerate(cuts)]
    found, n = {}, len(test)
    for *_, name, cut in sorted(steps):
        tried = found | {name: cut}
        k = sum(any(beyond(s, m, c) for m, c in tried.items()) for s in test)
        if sum(comb(n, i) * .03 ** i * .97 ** (n - i) for i in range(k + 1)) > .05 / strata:
            break
        found = tried
    return found


def padding(lengths, buckets):
    """Least padding over every choice of at most ``buckets`` boundaries."""
    sizes = sorted(set(lengths))
    cost = lambda a, b: sum(sizes[b - 1] - x for x in lengths if sizes[a] <= x <= sizes[b - 1])
    best = [0] + [float("inf")] * len(sizes)
    costs = {(a, b): cost(a, b) for b in range(1, len(sizes) + 1) for a in range(b)}
    for _ in range(buckets):
        best = [0] + [min(best[b], *(best[a] + costs[a, b] for a in range(b))) for b in range(1, len(sizes) + 1)]
    return best[-1]


def recorded(spark, folder, rows, labels, monkeypatch):
    """Columns and rows of every stage of one run()."""
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{folder}/labels.parquet")
    stages, write = {}, corpus_pipeline.written

    def keep(df, name):
        out = write(df, name)
        stages[name.removeprefix("pipeline-")] = (out.columns, out.collect())
        return out

    monkeypatch.setattr(corpus_pipeline, "written", keep)
    return corpus_pipeline.run(spark, str(folder)), stages


def test_run_stage_by_stage(spark, tmp_path, monkeypatch):
    rows, labels = made()
    out, stages = recorded(spark, tmp_path, rows, labels, monkeypatch)
    assert list(stages) == [name for name, _ in corpus_pipeline.STAGES]
    kept = {name: sorted(r.doc_id for r in got) for name, (_, got) in stages.items()}
    text = {i: t for i, t, *_ in rows}

    # quality rules: only en has labelled good documents
    deal = F.pmod(F.xxhash64("doc_id", F.lit(quality_rules.SEED)), F.lit(quality_rules.PLAN_ONE_IN)) == 0
    plans = {r.doc_id: r.p for r in spark.range(240).select(F.col("id").alias("doc_id")).select("doc_id", deal.alias("p")).collect()}
    cuts = best_cuts([shares(text[i]) for i in plans if plans[i]], [shares(text[i]) for i in plans if not plans[i]], 1)
    want = [r for r in rows if not B.base_failed(r[1])
            and not (r[2] == "en" and any(beyond(shares(r[1]), m, c) for m, c in cuts.items()))]
    assert cuts and kept["quality_rules"] == sorted(r[0] for r in want)
    assert not any(1000 <= r[0] < 1008 for r in want) and sum(1100 <= r[0] < 1103 for r in want) == 3

    # exact copies: the largest doc_id
    keep = {k for k, _ in B.exact_groups([r[:2] for r in want]).values()}
    want = [r for r in want if r[0] in keep]
    assert kept["exact_dedup"] == sorted(keep)

    # near copies: the smallest doc_id of a component over five-word shingles
    monkeypatch.setattr(B, "shingles", lambda t: set(zip(*(B.words(B.low(t))[k:] for k in range(5)))))
    found = B.components([r[:2] for r in want])
    near = [r for r in want if found[r[0]][1] == r[0]]
    assert len(near) < len(want) and kept["near_dedup"] == sorted(r[0] for r in near)

    # mixing: each source near its target, documents cut and repeated but not changed
    mixed = stages["mixing"][1]
    source = {r[0]: r[3] for r in near}
    sizes = {s: sum(len(B.words(r[1])) for r in near if r[3] == s) for s in source.values()}
    for s, target in mixing.targets(sizes).items():
        assert abs(sum(len(B.words(r.text)) for r in mixed if r.source == s) - target) <= 2 * mixing.BLOCK_WORDS
    for r in mixed:
        whole = iter(B.words(text[r.doc_id]))
        assert r.source == source[r.doc_id] and r.n_chars == len(r.text) and all(w in whole for w in B.words(r.text))
    assert all(kept["mixing"].count(i) <= mixing.MAX_REPEAT for i in set(kept["mixing"]))

    # packing: the mixed documents, with the least padding
    packed = stages["packing"][1]
    row = lambda r: (r.doc_id, r.text, r.lang, r.source, r.n_chars)
    assert sorted(map(row, packed), key=repr) == sorted(map(row, mixed), key=repr)
    lengths = [len(B.words(r.text)) for r in mixed]
    assert sum(r.padding for r in packed) == padding(lengths, packing.BUCKETS)
    assert all(r.n_words == len(B.words(r.text)) and r.padding == r.padded_length - r.n_words >= 0 for r in packed)
    assert len({(r.bucket, r.batch, r.slot) for r in packed}) == len(packed)
    assert sorted(map(row, out.collect()), key=repr) == sorted(map(row, mixed), key=repr)


@pytest.mark.parametrize("labelled", [False, True])
def test_run_on_no_documents(spark, tmp_path, monkeypatch, labelled):
    out, stages = recorded(spark, tmp_path, [], [(1, 1, 0)] if labelled else [], monkeypatch)
    names = [c.split()[0] for c in DOCS.split(", ")]
    assert out.count() == 0 and set(names) <= set(out.columns)
    assert all(cols == names and not got for name, (cols, got) in stages.items() if name != "packing")
