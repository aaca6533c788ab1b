"""The corpus pipeline against plain versions of its stages on the smallest tables."""

from collections import Counter

import corpus_pipeline
from parley.llm import common

from .test_resemblance import first_of_each


def without_repeats(texts, window=200):
    """Bytes left of each text when those that a string starting twice covers are gone, whole characters kept."""
    starts = Counter(raw[i : i + window] for raw in texts.values() for i in range(len(raw) - window + 1))
    out = {}
    for k, raw in texts.items():
        cut = bytearray(len(raw))
        for i in range(len(raw) - window + 1):
            if starts[raw[i : i + window]] > 1:
                cut[i : i + window] = b"\1" * window
        for i, b in enumerate(raw):  # a character goes whole or not at all
            if b & 0xC0 != 0x80:
                end = i + 1
                while end < len(raw) and raw[end] & 0xC0 == 0x80:
                    end += 1
                if not all(cut[i:end]):
                    cut[i:end] = bytes(end - i)
        out[k] = bytes(b for b, gone in zip(raw, cut) if not gone)
    return out


def test_stages_equal_plain_versions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = common.stored(stage(spark, docs, sf_dir), "stage")
        rows = docs.collect()
        after = {r["doc_id"]: r for r in rows}
        if k < 4:
            assert docs.columns == columns and len(rows) == len(after)
        if k < 3:
            assert all(after[i] == before[i] for i in after)
        if k == 0:
            wrong = [i for i, q in labels.items() if (i in after) != bool(q)]
            assert len(wrong) <= 0.02 * len(labels)
        if k == 1:
            assert len(after) >= 0.98 * len([r for r in before.values() if any(map(str.isalpha, r["text"] or ""))])
        if k == 2:
            assert set(after) == first_of_each({i: r["text"] for i, r in before.items()})
        if k == 3:
            want = without_repeats({i: (r["text"] or "").encode() for i, r in before.items()})
            assert {i: (r["text"] or "").encode() for i, r in after.items()} == want
            assert all(r["n_chars"] == len(r["text"]) for i, r in after.items() if r["text"] != before[i]["text"])
        if k == 4:
            assert set(after) == set(before)
            held = Counter()
            for r in rows:
                held[r["doc_id"]] += r["length"]
            assert all(held[r["doc_id"]] == r["doc_tokens"] for r in rows)
