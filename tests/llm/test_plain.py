"""Corpus operators against plain rewrites, and on repeated or missing ids and clashing names."""

import itertools
import math
import random

import numpy as np
import pytest

from parley.llm import ann, langid, license, media, packing, quality, resemblance, wordhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(n, rng, letters="abcdefghij"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(n))


def plain_site_scores(rows):
    """Priors and site scores of rows (host, path, p) by loops over the rows."""
    n = len(rows)
    mean = sum(p for *_, p in rows) / n
    hosts = {h: [p for a, _, p in rows if a == h] for h, *_ in rows}
    paths = {(h, x): [p for a, b, p in rows if (a, b) == (h, x)] for h, x, _ in rows}
    avg = lambda v: sum(v) / len(v)
    within = sum((p - avg(v)) ** 2 for v in paths.values() for p in v) / (n - len(paths))
    around = sum(len(v) * (avg(v) - avg(hosts[h])) ** 2 for (h, _), v in paths.items())
    share = sum(len(v) ** 2 / len(hosts[h]) for (h, _), v in paths.items())
    path = (around - (len(paths) - len(hosts)) * within) / (n - share)
    sizes = sum(len(v) ** 2 for v in paths.values()) / n
    across = sum(len(v) * (avg(v) - mean) ** 2 for v in hosts.values())
    host = (across - (len(hosts) - 1) * within - (share - sizes) * max(path, 0)) / (n - sum(len(v) ** 2 for v in hosts.values()) / n)
    weigh = lambda v: min(max(within / max(v, 1e-12), 1), 10_000)
    hw, pw = weigh(host), weigh(path)
    scores = []
    for h, x, p in rows:
        rate = (sum(hosts[h]) - p + hw * mean) / (len(hosts[h]) - 1 + hw)
        scores.append((sum(paths[h, x]) - p + pw * rate) / (len(paths[h, x]) - 1 + pw))
    return mean, hw, pw, scores


def test_quality_scores_equal_plain_loops(spark):
    rng = random.Random(4)
    rows = []
    for h in range(12):
        level = rng.random()
        for x in range(rng.choice([1, 1, 3, 5])):
            own = min(0.95, max(0.05, level + rng.uniform(-0.2, 0.2)))
            rows += [(f"h{h}", f"p{x}", min(0.99, max(0.01, own + rng.uniform(-0.3, 0.3)))) for _ in range(rng.choice([1, 2, 9]))]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i long, host string, path string, p double")
    sites, priors = quality.site_posteriors(df)
    mean, hw, pw, scores = plain_site_scores(rows)
    assert (priors.rate, priors.host_weight, priors.path_weight) == pytest.approx((mean, hw, pw))
    logit = lambda v: math.log(v / (1 - v))
    for r in quality.judged(df, sites, priors).collect():
        assert r["site_score"] == pytest.approx(scores[r["i"]])
        assert r["quality"] == pytest.approx(1 / (1 + math.exp(-(logit(r["p"]) + logit(scores[r["i"]]) - logit(mean)))))


def test_language_sets_reach_the_best_penalised_likelihood():
    """No set of languages has a likelihood that beats the chosen one's by more than rounding and EM's slack."""
    rng, gen = random.Random(2), np.random.default_rng(2)
    alphabets = ["abcdefgh", "ijklmnop", "qrstuvwx", "abijqryz", "zyxwvuts"]
    raw = np.stack([langid.trigram_counts([prose(3_000, rng, a)])[0] for a in alphabets]) + langid.SMOOTHING
    table = (raw / raw.sum(axis=1, keepdims=True)).astype(np.float32)
    model = langid.Model(tuple("abcde"), table)
    texts = [" ".join(prose(gen.integers(20, 120), rng, a) for a in rng.sample(alphabets, rng.choice([1, 1, 2, 3]))) for _ in range(25)]
    counts = langid.trigram_counts(texts)
    chosen, total = model.infer(counts)
    for c, shares, n in zip(counts.astype(float), chosen, total):
        def value(members, weights=None):
            w = np.full(len(members), 1 / len(members)) if weights is None else weights
            t = table[list(members)].astype(float)
            for _ in range(0 if weights is not None else 400):
                w = w * (t @ (c / (w @ t))) / c.sum()
            return float(c @ np.log(w @ t)) - (len(members) - 1) * math.log(n + 1)

        picked = tuple(np.flatnonzero(shares))
        best = max(value(m) for k in range(1, 6) for m in itertools.combinations(range(5), k))
        assert value(picked, shares[list(picked)].astype(float)) >= best - max(1.0, 0.002 * abs(best))


def test_language_on_clashing_names(spark):
    rows = [(i, "ab cd ef " * 20 if i % 2 else "xy zz wv " * 20, "en" if i % 2 else "fr", "s", i) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, row string, score long")
    kept = langid.keep_known(docs)
    assert kept.columns == docs.columns and kept.count() == 40


def test_licences_of_rows_that_share_an_id(spark):
    rows = [(1, "Released under the MIT License."), (1, "Licensed under CC BY 4.0."), (None, "All rights reserved."), (None, "Released under the MIT License."), (2, "no licence"), (2, None)]
    got = {(r["doc_id"], r["license"]): r["n_units"] for r in license.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, "MIT"): 1, (1, "CC-BY-4.0"): 1, (None, "proprietary"): 1, (None, "MIT"): 1}


def test_needed_words_are_in_every_match():
    known = []
    for name, text in (license.TEMPLATES | license.MORE_TEMPLATES).items():
        words = license._TOKEN.findall(text.lower())
        known.append((name, list(dict.fromkeys(license._pairs_of(words) or words))))
    needed = license.needed_words(known, license.THRESHOLD)
    for _, pairs in known:
        without = [p for p in pairs if not any(w in p for w in needed)]
        assert 2 * len(without) / (len(without) + len(pairs)) < license.THRESHOLD


def test_lost_packets_are_refused_and_repeated_ones_are_not():
    payload = random.Random(9).randbytes(40_000)
    raw = media.mux(payload)
    packets = [raw[i : i + media.PACKET] for i in range(0, len(raw), media.PACKET)]
    assert media.demux(b"".join([*packets[:6], packets[5], *packets[6:]])).payload == payload
    for lost in range(2, len(packets), 7):
        with pytest.raises(ValueError):
            media.demux(b"".join(packets[:lost] + packets[lost + 1 :]))
    assert media.demux(b"".join(packets[:100] + packets[101:]), strict=False).continuity_errors == 1


def test_shingle_hashes_name_shingles(monkeypatch):
    monkeypatch.setattr(wordhash, "CHUNK", 64)
    rng, seen = random.Random(3), {}
    for _ in range(60):
        texts = ["".join(rng.choice([" ", "\n", " \t"]) + rng.choice(["a", "Bc", "déf", "x" * 90]) for _ in range(rng.choice([0, 1, 4, 5, 30]))) for _ in range(4)]
        hashes, at = wordhash.of_texts([t.encode() for t in texts], 5)
        words = [t.encode().lower().split() for t in texts]
        plain = [[tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else [] for w in words]
        assert np.diff(at).tolist() == [len(p) for p in plain]
        for shingle, h in zip(itertools.chain(*plain), hashes.tolist()):
            assert seen.setdefault(shingle, h) == h
    assert len(set(seen.values())) == len(seen)


def test_one_of_each_with_repeated_and_missing_ids(spark):
    rng = random.Random(6)
    a, b, c = (prose(60, rng) for _ in range(3))
    near = " ".join(a.split()[:-1])
    rows = [(5, a), (5, b), (7, near), (None, near), (None, c), (None, c), (3, b), (5, a), (9, None), (8, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    kept = sorted(((r["doc_id"], r["text"]) for r in resemblance.one_of_each(docs).collect()), key=str)
    assert kept == sorted([(5, a), (3, b), (None, c), (8, "")], key=str)


def test_packing_over_several_ranges(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANGE_BYTES", 20_000)
    rng = random.Random(8)
    texts = [prose(rng.choice([5, 60, 400]), rng, rng.choice(["abcdef", "uvwxyz"])) for _ in range(150)] + ["the same text"] * 400
    docs = spark.createDataFrame([(i if i % 50 else None, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert len(packing.curve_cuts(docs)) > 3
    import public_tokenizers

    rows = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")).collect()
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in sequences.values():
        ends = list(itertools.accumulate(n for _, n in sorted(pieces)))
        assert [at for at, _ in sorted(pieces)] == [0, *ends[:-1]]
        assert ends[-1] <= 2048 and ends[-1] & (ends[-1] - 1) == 0
    whole = sum(r["length"] for r in rows)
    assert whole == sum(r["doc_tokens"] for r in rows if r["start"] == 0)


def test_neighbours_over_several_shards(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 600)
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((12, 24))
    x = np.concatenate([c + 0.2 * rng.standard_normal((170, 24)) for c in centres] + [rng.standard_normal((400, 24))]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for r in ann.nearest(df).collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    hits = 0
    for q in range(0, len(x), 100):
        d = ((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1)
        d[q] = np.inf
        hits += len(set(np.argsort(d, kind="stable")[:10].tolist()) & set(got[q]))
    assert hits >= 0.9 * 10 * len(got)
