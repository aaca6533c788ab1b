"""Language identification as inference of a mixture of languages.

Each language is a distribution over hashed letter trigrams. A document's language shares
are estimated by expectation-maximisation over its trigram counts; the set of languages is
the one whose likelihood, less a penalty for each language beyond the first, is greatest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

BUCKETS = 4096
#: Labelled documents of a language that the model is fitted on: those with the smallest hashes.
FIT_DOCS = 3_000
#: Languages whose rows are thinned by hash before the window that takes the smallest ones; it only saves work.
COMMON_LANGUAGES = 64
EM_ROUNDS = 12
#: How often the rounds over all languages are repeated, at most, while the likelihood is far from its greatest.
EM_REPEATS = 25
SMOOTHING = 0.5
UNKNOWN = "und"

_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def trigram_counts(texts: list[str]) -> np.ndarray:
    """Counts of hashed trigrams of lower-cased letters, a row for each whole text.

    ASCII bytes that are no letters count as spaces; trigrams with two adjacent spaces are
    left out.
    """
    raws = [b" " + t.lower().encode("utf-8", "surrogatepass").translate(_LETTERS) + b" " for t in texts]
    lens = np.array([len(r) for r in raws], np.int64)
    data = np.frombuffer(b"".join(raws), np.uint8)
    if len(data) < 3:
        return np.zeros((len(texts), BUCKETS), np.float32)
    wide = data.astype(np.uint32)
    gram = wide[:-2] | wide[1:-1] << np.uint32(8) | wide[2:] << np.uint32(16)
    blank = data == 32
    owner = np.repeat(np.arange(len(texts)), lens)
    good = ~(blank[:-2] & blank[1:-1]) & ~(blank[1:-1] & blank[2:]) & (owner[:-2] == owner[2:])
    bucket = (gram * np.uint32(0x85EBCA6B)) >> np.uint32(32 - 12)
    counts = np.bincount(owner[:-2][good] * BUCKETS + bucket[good], minlength=len(texts) * BUCKETS)
    return counts.reshape(len(texts), BUCKETS).astype(np.float32)


@dataclass(frozen=True)
class Model:
    """Trigram distributions, a row for each language."""

    languages: tuple[str, ...]
    table: np.ndarray

    def infer(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row the chosen languages' shares (zero outside the set), and its total count.

        All languages take part. Sets grow by the languages' shares in the whole mixture until
        no larger set can gain more than its penalty, by an upper bound on any mixture's likelihood.
        """
        total = np.maximum(counts.sum(axis=1, keepdims=True), 1)
        penalty = np.log(total[:, 0] + 1)
        weights, bound = self._mixture(counts, total, penalty / 2)
        order = np.argsort(-weights, axis=1, kind="stable")
        single = counts @ np.log(self.table).T
        best = single.max(axis=1)
        chosen = np.zeros_like(weights)
        np.put_along_axis(chosen, single.argmax(axis=1)[:, None], np.float32(1), axis=1)
        present = (weights > 0).sum(axis=1)
        for k in range(2, weights.shape[1] + 1):
            at = np.flatnonzero((present >= k) & (bound - (k - 1) * penalty > best))
            if not len(at):
                break
            members, some = order[at, :k], np.zeros((len(at), weights.shape[1]), np.float32)
            np.put_along_axis(some, members, np.take_along_axis(weights[at], members, axis=1), axis=1)
            fitted = self._em(counts[at], some / np.maximum(some.sum(axis=1, keepdims=True), 1e-12), total[at])
            value = self._likelihood(counts[at], fitted) - (k - 1) * penalty[at]
            better = value > best[at]
            chosen[at[better]], best[at[better]] = fitted[better], value[better]
        return chosen, total[:, 0]

    def _mixture(self, counts, total, near) -> tuple[np.ndarray, np.ndarray]:
        """Shares of all languages, and a bound that no mixture's likelihood exceeds.

        No mixture is likelier by more than total * log(g), g being the greatest factor by
        which a further round would raise a share; rounds go on while that is above ``near``.
        """
        weights = np.full((len(counts), len(self.table)), np.float32(1 / len(self.table)))
        bound, at = np.empty(len(counts)), np.arange(len(counts))
        for _ in range(EM_REPEATS):
            some, size = counts[at], total[at]
            weights[at] = self._em(some, weights[at], size)
            mixed = np.maximum(weights[at] @ self.table, 1e-12)
            gain = ((some / mixed) @ self.table.T / size).max(axis=1)
            gap = size[:, 0] * np.log(np.maximum(gain, 1))
            bound[at] = self._likelihood(some, weights[at]) + gap
            at = at[gap > near[at]]
            if not len(at):
                break
        return weights, bound

    def _likelihood(self, counts, weights) -> np.ndarray:
        return np.einsum("ij,ij->i", counts, np.log(np.maximum(weights @ self.table, 1e-12)))

    def _em(self, counts, weights, total, rounds: int = EM_ROUNDS) -> np.ndarray:
        for _ in range(rounds):
            mixed = np.maximum(weights @ self.table, 1e-12)
            weights = weights * ((counts / mixed) @ self.table.T) / total
            weights = weights / np.maximum(weights.sum(axis=1, keepdims=True), 1e-12)
        return weights


def fit(docs: DataFrame, where: Column | None = None, fit_docs: int = FIT_DOCS) -> Model | None:
    """Trigram tables from text and lang of at most ``fit_docs`` documents of each language.

    Rows with a null text or lang, and rows outside ``where``, teach nothing; None if no row is left.
    """
    known = docs.where("text is not null and lang is not null")
    known = known.where(where) if where is not None else known
    known = known.select("lang", "text", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text").alias("hash"))
    # a language's share of hashes that holds twice as many of them as are taken: no window meets all of a common language
    counts = known.groupBy("lang").agg(F.approx_count_distinct("hash", 0.02).alias("n")).where(F.col("n") > 4 * fit_docs)
    common_ones = {r["lang"]: 2.0 * fit_docs / r["n"] for r in counts.orderBy(F.desc("n"), "lang").limit(COMMON_LANGUAGES).collect()}
    share = F.coalesce(*(F.when(F.col("lang") == k, F.lit(v)) for k, v in common_ones.items()), F.lit(1.0))
    low = known.where(F.col("hash") / float(1 << 64) + 0.5 <= share).dropDuplicates(["lang", "hash"])  # equal rows teach once
    order = Window.partitionBy("lang").orderBy("hash", "text")
    sample = low.select("lang", "text", F.row_number().over(order).alias("k")).where(F.col("k") <= fit_docs).select("lang", "text")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = np.array(batch.column(0).to_pylist(), object), common.texts_of(batch, "text")
            for i, j in common.small_parts(np.array([len(t) for t in texts], np.int64)):
                counts, own = trigram_counts(texts[i:j]), langs[i:j]
                for lang in set(own):
                    sums[lang] = sums.get(lang, 0) + counts[own == lang].sum(axis=0, dtype=np.float64)
        for lang, v in sums.items():
            at = np.flatnonzero(v)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(at), "bucket": pa.array(at, pa.int32()), "n": v[at]})

    rows = common.map_arrow(sample, "lang string, bucket int, n double", counted).groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    if rows.empty:
        return None
    languages = tuple(sorted(rows["lang"].unique()))
    table = np.full((len(languages), BUCKETS), SMOOTHING)
    table[rows["lang"].map(languages.index), rows["bucket"]] += rows["n"]
    return Model(languages, (table / table.sum(axis=1, keepdims=True)).astype(np.float32))


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def predict_batch(model: Model, texts: list[str]) -> list[tuple[str, float, list[tuple[str, float]]]]:
    """lang, score and the chosen languages with their shares, for each text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    parts = [model.infer(trigram_counts(texts[i:j]))[0] for i, j in common.small_parts(sizes)]
    shares = np.concatenate(parts) if parts else np.zeros((0, len(model.languages)), np.float32)
    out = []
    for text, row in zip(texts, shares):
        if not _has_letter(text):
            out.append((UNKNOWN, 0.0, []))
            continue
        at = [k for k in np.argsort(-row, kind="stable") if row[k] > 0] or [0]
        out.append((model.languages[at[0]], float(min(1.0, row[at[0]])), [(model.languages[k], float(row[k])) for k in at]))
    return out


def with_language(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """row (a struct of all columns), lang, score and languages; nulls and texts without letters are ``und``."""

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
        for batch in batches:
            got = predict_batch(model, common.texts_of(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()), pa.array([[{"lang": a, "share": b} for a, b in g[2]] for g in got], kind)],
                names=["row", "lang", "score", "languages"],
            )

    rows = docs.select(common.row_of(docs), F.col(f"`{text_col}`").alias("text"))
    return common.map_arrow(rows, common.schema_of(rows, ["row"], "lang string, score double, languages array<struct<lang:string,share:double>>"), predicted)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and languages (the set with shares), a row for each input row.

    Documents whose crc32 of the id's text form is 2 modulo 4 are held out of the fit.
    Without a labelled document every text is ``und``.
    """
    held = F.coalesce(common.crc32_text("doc_id") % 4 == 2, F.lit(False))
    model = fit(docs, ~held)
    base = docs.select("doc_id", held.alias("held_out"), "text")
    if model is None:
        empty = F.array().cast("array<struct<lang:string,share:double>>")
        return base.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), empty.alias("languages"))
    return with_language(base, model).select("row.doc_id", "row.held_out", F.col("lang").alias("lang_pred"), "score", "languages")


def keep_known(docs: DataFrame, least_share: float = 0.5) -> DataFrame:
    """Documents in which one known language holds at least ``least_share``, with their columns."""
    model = fit(docs)
    if model is None:
        return docs
    return with_language(docs, model).where((F.col("lang") != UNKNOWN) & (F.col("score") >= least_share)).select("row.*")
