"""The pipeline's near-duplicate stage against brute-force Jaccard similarity of five-word shingles."""

import random

import corpus_pipeline

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text, width=5):
    words = (text or "").lower().split()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def first_of_each(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    label = {i: i for i in texts}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in texts:
        for b in texts:
            if a < b and (sets[a] == sets[b] or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {root(i) for i in texts}


def stage(spark, texts):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts.items()], DOCS)
    return sorted(r["doc_id"] for r in corpus_pipeline.near_duplicate_stage(spark, docs, "").collect())


def test_near_duplicate_stage_equals_brute_force(spark, sf_dir):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    texts = {}
    for _ in range(30):
        base = [word() for _ in range(rng.choice([3, 6, 30, 60, 120, 400]))]
        for _ in range(6):
            copy = list(base)
            for at in rng.sample(range(len(copy)), min(len(copy), rng.randint(0, 1 + len(copy) // 40))):
                copy[at] = word()
            texts[len(texts)] = " ".join(copy)
    passage = " ".join(word() for _ in range(60))
    texts |= {len(texts) + k: t for k, t in enumerate([None, "", "?  ", "Two words", "two  WORDS", *(" ".join(word() for _ in range(40)) + " " + passage for _ in range(20))])}
    assert stage(spark, texts) == sorted(first_of_each(texts))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = sorted(r["doc_id"] for r in corpus_pipeline.near_duplicate_stage(spark, docs, sf_dir).collect())
    assert got == sorted(first_of_each(texts))
