"""Quality classification by hierarchical empirical Bayes.

A logistic classifier gives each document its own evidence. Grouped sums of that evidence
give each host, and each path below a host, a posterior rate of good documents: a path is
shrunk toward its host and a host toward the whole corpus, by prior strengths estimated from
how much the groups really differ. A document's verdict combines its own evidence with the
posterior of its path, from which its own share is taken out.

The ``documents`` table has no addresses: its callers take ``source`` for the host and ``lang``
for the path below it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Most labelled documents that the classifier is fitted on: those with the smallest hashes.
FIT_ROWS = 20_000
#: Documents at or above this probability are kept.
KEEP_FROM = 0.5

_CLASSES = (
    b"abcdefghijklmnopqrstuvwxyz",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b" ",
    b"\n\r",
    b".,;:'\"-()",
    b"!?",
    b"|",
    b"*$%&#@^~",
)
FEATURES = ("lower", "upper", "digit", "space", "line", "stop", "shout", "bar", "sign", "rest", "wide", "word_bytes", "distinct", "stutter", "repeat_lines", "size")


def _byte_class() -> np.ndarray:
    table = np.full(256, len(_CLASSES), np.int64)
    table[128:] = len(_CLASSES) + 1
    for k, members in enumerate(_CLASSES):
        table[list(members)] = k
    return table


_BYTE_CLASS = _byte_class()


def text_features(texts: list[str]) -> np.ndarray:
    """One row of ``FEATURES`` for each text, over its whole length."""
    out = np.zeros((len(texts), len(FEATURES)))
    kinds = len(_CLASSES) + 2
    for i, text in enumerate(texts):
        raw = text.encode("utf-8", "surrogatepass")
        out[i, :kinds] = np.bincount(_BYTE_CLASS[np.frombuffer(raw, np.uint8)], minlength=kinds) / max(1, len(raw))
        words, lines = text.split(), text.split("\n")
        n = len(words)
        out[i, kinds:] = (
            np.log1p(len(raw) / max(1, n)),
            len(set(words)) / max(1, n) * np.log1p(n),
            sum(map(str.__eq__, words, words[1:])) / max(1, n - 1),
            1 - len(set(lines)) / len(lines),
            np.log1p(n),
        )
    return out


@dataclass(frozen=True)
class Classifier:
    """A logistic model over standardised text features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 40) -> Classifier:
        """Ridge-penalised maximum likelihood by Newton steps. One class alone gives its rate."""
        mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
        w, penalty = np.zeros(z.shape[1]), np.full(z.shape[1], ridge)
        penalty[0] = 0.01
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            step = np.linalg.solve((z.T * (p * (1 - p))) @ z + np.diag(penalty), z.T @ (y - p) - penalty * w)
            w = w + step * min(1.0, 3 / max(1e-9, np.abs(step).max()))
            if np.abs(step).max() < 1e-6:
                break
        return Classifier(mean, scale, w)

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = self.weights[0] + ((x - self.mean) / self.scale) @ self.weights[1:]
        return 1 / (1 + np.exp(-np.clip(z, -12, 12)))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Classifier | None:
    """Fit on at most ``fit_rows`` labelled documents; None if there are none.

    Several labels of a document count as their mean, at least one half being good.
    """
    chosen = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("__id"))
        .agg((F.avg("quality") >= 0.5).alias("__good"))
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(fit_rows)
    )

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = text_features(common.texts_of(batch, "__text"))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(x))], names=["id", "good", "x"])

    some = docs.select(F.col("doc_id").cast("long").alias("__id"), F.col("text").alias("__text"))
    labelled = some.join(F.broadcast(chosen), "__id").select("__id", "__good", "__text")  # fit_rows bounds what is broadcast
    rows = common.map_arrow(labelled, "id long, good boolean, x array<double>", featured).dropDuplicates(["id"]).toPandas()
    if rows.empty:
        return None
    rows = rows.sort_values("id")
    return Classifier.fit(np.stack(rows["x"].to_numpy()), rows["good"].to_numpy(float))


def with_evidence(docs: DataFrame, model: Classifier, text_col: str = "text", out: str = "__p") -> DataFrame:
    """All columns and the classifier's probability that the document is good."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = model.probability(text_features(common.texts_of(batch, text_col)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], names=[*batch.schema.names, out])

    return common.map_arrow(docs, common.schema_of(docs, docs.columns, f"`{out}` double"), scored)


@dataclass(frozen=True)
class Priors:
    """The corpus rate, and how many documents' worth of evidence each level's prior weighs."""

    rate: float
    host_weight: float
    path_weight: float


#: Prior weights lie between these: at least one document's worth, and at most what makes levels alike.
LEAST_WEIGHT, MOST_WEIGHT = 1.0, 10_000.0


def prior_weights(sums: dict[str, float]) -> tuple[float, float]:
    """Host and path weights from nested sums of squares, by equating them with their expectations.

    ``within``, ``paths`` and ``hosts`` are the sums of squares of documents around their path,
    of paths around their host and of hosts around the corpus. A level's weight is the variance
    within paths over its own: the less sites differ, the more their prior weighs.
    """
    n, hosts, paths = sums["n"], sums["n_hosts"], sums["n_paths"]
    error = max(sums["within"] / (n - paths), 1e-9) if n > paths else 1e-9
    spread = n - sums["path_share"]  # n less the sum over hosts of squared path sizes by host size
    path = (sums["paths"] - (paths - hosts) * error) / spread if spread > 0 else 0.0
    spread = n - sums["host_share"]
    host = (sums["hosts"] - (hosts - 1) * error - (sums["path_share"] - sums["path_size"]) * max(path, 0.0)) / spread if spread > 0 else 0.0
    weigh = lambda v: float(np.clip(error / max(v, 1e-12), LEAST_WEIGHT, MOST_WEIGHT))
    return weigh(host), weigh(path)


def site_posteriors(evidence: DataFrame) -> tuple[DataFrame, Priors]:
    """Sums by host and path from rows of host, path and p, the hosts' posterior rates, and the priors.

    Documents are summed on the map side first, so a hot host costs one row a task. Sites of one
    document take part in the estimate like all others.
    """
    paths = evidence.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") * F.col("p")).alias("q"))
    paths = common.stored(paths, "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"), F.sum(F.col("n") * F.col("n")).alias("squares"), F.count("*").alias("n_paths"), F.sum("q").alias("q"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("path_squares"))
    hosts = common.stored(hosts, "hosts")
    n, s = F.col("host_n"), F.col("host_s")
    row = hosts.agg(
        F.sum(n).alias("n"),
        F.sum(s).alias("s"),
        F.count("*").alias("n_hosts"),
        F.sum("n_paths").alias("n_paths"),
        F.sum(F.col("q") - F.col("path_squares")).alias("within"),
        F.sum(F.col("path_squares") - s * s / n).alias("paths"),
        F.sum(s * s / n).alias("host_squares"),
        F.sum(F.col("squares") / n).alias("path_share"),
        F.sum("squares").alias("squares"),
        F.sum(n * n).alias("host_sizes"),
    ).first()
    sums = {k: float(v or 0.0) for k, v in row.asDict().items()}
    total = max(sums["n"], 1.0)
    mean = sums["s"] / total
    sums |= {"hosts": sums["host_squares"] - total * mean * mean, "path_size": sums["squares"] / total, "host_share": sums["host_sizes"] / total}
    rate = float(np.clip(mean, 1e-4, 1 - 1e-4))
    priors = Priors(rate, *prior_weights(sums))
    rates = hosts.select("host", "host_n", "host_s", ((s + priors.host_weight * rate) / (n + priors.host_weight)).alias("host_rate"))
    return common.stored(paths.select("host", "path", "n", "s").join(rates, "host"), "sites"), priors


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def judged(evidence: DataFrame, sites: DataFrame, priors: Priors) -> DataFrame:
    """Adds site_score and quality to rows of host, path and p.

    The document's own share is taken out of its path and of its host before both are shrunk.
    """
    p = F.col("p")
    host = (F.col("host_s") - p + priors.host_weight * priors.rate) / (F.col("host_n") - 1 + priors.host_weight)
    site = (F.col("s") - p + priors.path_weight * host) / (F.col("n") - 1 + priors.path_weight)
    site = F.least(F.greatest(site, F.lit(1e-4)), F.lit(1 - 1e-4))
    odds = _logit(p) + _logit(F.col("site_score")) - float(np.log(priors.rate / (1 - priors.rate)))
    return (
        evidence.join(sites, ["host", "path"], "left")
        .withColumn("site_score", F.coalesce(site, F.lit(priors.rate)))
        .withColumn("quality", 1 / (1 + F.exp(-odds)))
        .drop("n", "s", "host_n", "host_s", "host_rate")
    )


def _site(docs: DataFrame, host_col: str, path_col: str) -> tuple[Column, Column]:
    return F.coalesce(F.col(host_col).cast("string"), F.lit("")), F.coalesce(F.col(path_col).cast("string"), F.lit(""))


def classify(docs: DataFrame, labels: DataFrame, host_col: str = "source", path_col: str = "lang") -> DataFrame:
    """doc_id, text_score, site_score, quality and keep, one row for each input row.

    A null or empty text is judged by the same features, a null host or path is a site of its
    own. Without labels nothing can be learned: scores are null and every document is kept.
    """
    model = fit(docs, labels)
    if model is None:
        none = F.lit(None).cast("double")
        return docs.select("doc_id", none.alias("text_score"), none.alias("site_score"), none.alias("quality"), F.lit(True).alias("keep"))
    host, path = _site(docs, host_col, path_col)
    rows = with_evidence(docs.select("doc_id", "text", host.alias("host"), path.alias("path")), model, out="p").drop("text")
    evidence = common.stored(rows, "evidence")
    sites, priors = site_posteriors(evidence)
    return judged(evidence, sites, priors).select("doc_id", F.col("p").alias("text_score"), "site_score", "quality", (F.col("quality") >= KEEP_FROM).alias("keep"))


def keep_good(docs: DataFrame, labels: DataFrame, host_col: str = "source", path_col: str = "lang") -> DataFrame:
    """The documents that the classifier keeps, with the columns they came with.

    Texts are described twice, for the sites' sums and for the verdicts: that costs less than
    shuffling them to verdicts kept by id.
    """
    model = fit(docs, labels)
    if model is None:
        return docs
    host, path = _site(docs, host_col, path_col)
    plain = docs.select("text", host.alias("host"), path.alias("path"))
    sites, priors = site_posteriors(common.stored(with_evidence(plain, model, out="p").drop("text"), "evidence"))
    rows = docs.select(common.row_of(docs), host.alias("host"), path.alias("path"), F.col("text").alias("text"))
    return judged(with_evidence(rows, model, out="p").drop("text"), sites, priors).where(F.col("quality") >= KEEP_FROM).select("row.*")
