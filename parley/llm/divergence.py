"""Source divergence audit: how far the term shares of sources of one language lie apart.

Every (lang, source) group gives each of its language's kept terms a smoothed share in whole
billionths. Groups are dealt to group blocks and terms to term blocks; a cell is a pair of
group blocks and a term block, its task gets both blocks' slices of the term block and sums
the differences for all its pairs of groups, and the cells of a pair are added up along the
term axis. Slices go to as many cells as there are group blocks, so a task holds no more than
two blocks of groups times one of terms, however many sources or terms there are.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

LEAST_DOCS = 30
SCALE = 1_000_000_000
SMOOTHING = 5
TOP = 50
#: Groups and terms of a block, about: blocks are dealt by hash.
GROUP_BLOCK, TERM_BLOCK = 64, 4096
#: Distinct terms that a counting task holds before it hands its sums on, and documents whose terms a shard holds, about.
HELD_TERMS, SHARD_DOCS = 400_000, 4096

_TERM = re.compile(rb"[a-z\x80-\xff]+")


def _spread(texts: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """A task's terms by language and shard of the vocabulary: for each source its terms as one text, occurrences and documents as numbers.

    Sums are handed on when HELD_TERMS of them are held, so memory does not follow the vocabulary.
    """
    sums: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def handed_on() -> Iterator[pa.RecordBatch]:
        rows: dict[tuple[str, int], tuple[list, ...]] = {}
        for (lang, source), (n, docs) in sums.items():
            by_shard: dict[int, list[bytes]] = {}
            for term in docs:
                by_shard.setdefault(zlib.crc32(term) % shards, []).append(term)
            for shard, terms in by_shard.items():
                row = rows.setdefault((lang, shard), ([], [], [], []))
                for held_in, x in zip(row, (source, b" ".join(terms), np.array([n[t] for t in terms], "<i8").tobytes(), np.array([docs[t] for t in terms], "<i8").tobytes())):
                    held_in.append(x)
        keys = [pa.array([k[0] for k in rows], pa.string()), pa.array([k[1] for k in rows], pa.int32())]
        lists = [pa.array([r[i] for r in rows.values()], pa.list_(t)) for i, t in enumerate((pa.string(), pa.binary(), pa.binary(), pa.binary()))]
        yield pa.RecordBatch.from_arrays([*keys, *lists], names=["lang", "shard", "source", "terms", "n", "docs"])

    for batch in texts:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.large_binary())):
            n, docs = sums.setdefault((lang or "", source or ""), (Counter(), Counter()))
            terms, before = _TERM.findall((text.as_py() or b"").lower()), len(docs)
            n.update(terms)
            docs.update(set(terms))
            held += len(docs) - before
            if held > HELD_TERMS:
                yield from handed_on()
                sums, held = {}, 0
    yield from handed_on()


def _kept_of(shard: pa.Table, least_docs: int) -> pa.Table:
    """Terms of one language and shard in enough documents, with their occurrences in each source."""
    docs: Counter = Counter()
    counts: dict[str, Counter] = {}
    rows = zip(*(shard.column(c).to_pylist() for c in ("source", "terms", "n", "docs")))
    for source, terms, n, held in (part for row in rows for part in zip(*row)):
        own, words = counts.setdefault(source, Counter()), terms.split(b" ")
        for term, k, d in zip(words, np.frombuffer(n, "<i8").tolist(), np.frombuffer(held, "<i8").tolist()):
            own[term] += k
            docs[term] += d
    kept = {t for t, d in docs.items() if d >= least_docs}
    rows = [(source, t.decode("utf-8", "replace"), n) for source, own in counts.items() for t, n in own.items() if t in kept]
    lang = shard.column("lang")[0].as_py()
    return pa.table({"lang": pa.array([lang] * len(rows), pa.string()), "source": pa.array([r[0] for r in rows], pa.string()), "term": pa.array([r[1] for r in rows], pa.string()), "n": pa.array([r[2] for r in rows], pa.int64())})


def kept_counts(docs: DataFrame, least_docs: int) -> DataFrame:
    """lang, source, term and n (occurrences) of terms in at least ``least_docs`` documents of their language.

    A term lives in one shard of its language's vocabulary, so a task of the second step sees all
    of its documents; there are as many shards as make each hold what SHARD_DOCS documents say.
    Null text, lang and source read as empty ones.
    """
    shards = min(max(1, -(-docs.count() // SHARD_DOCS)), 1 << 24)
    spread = common.map_arrow(docs.select("lang", "source", "text"), "lang string, shard int, source array<string>, terms array<binary>, n array<binary>, docs array<binary>", lambda batches: _spread(batches, shards))
    return spread.groupBy("lang", "shard").applyInArrow(lambda rows: _kept_of(rows, least_docs), "lang string, source string, term string, n long")


def _share(n: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (n + 5) / (total + 5 * terms)) in whole numbers: products have room for 20 digits of n."""
    return F.expr(f"1 + ((CAST({SCALE} AS DECIMAL(10,0)) * CAST({n} + {SMOOTHING} AS DECIMAL(20,0))) div CAST({total} + {SMOOTHING} * {terms} AS DECIMAL(20,0)))")


def _blocks(of: str, key: str, size: int) -> Column:
    """Block of ``key`` among as many as hold about ``size`` of the ``of`` ones."""
    return F.pmod(F.xxhash64(key), F.greatest(F.lit(1), F.ceil(F.col(of) / size))).cast("int")


def _cell(table: pa.Table) -> pa.Table:
    """Differences of all pairs of groups in one cell; rows with slot -1 give a group's share of terms that it has not."""
    lang, lo, hi = (table.column(c)[0].as_py() for c in ("lang", "lo", "hi"))
    width = int(table.column("width").to_numpy().max())
    block, member, slot, p = (table.column(c).to_numpy() for c in ("block", "member", "slot", "p"))
    sides = []
    for of in (lo, hi) if lo < hi else (lo,):
        marks = (block == of) & (slot < 0)  # the share of terms that a group has not
        names = np.sort(member[marks])
        shares = np.repeat(p[marks][np.argsort(member[marks])][:, None], width, axis=1)
        own = (block == of) & (slot >= 0)
        shares[np.searchsorted(names, member[own]), slot[own]] = p[own]
        sides.append((names, shares))
    (left, a), (right, b) = sides[0], sides[-1]
    out = []
    for i, name in enumerate(left):
        others = slice(i + 1, None) if lo == hi else slice(None)
        out.append((np.full(len(right[others]), name), right[others], np.abs(b[others] - a[i]).sum(axis=1)))
    one, two, value = (np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.int64) for k in range(3))
    n = len(one)
    return pa.table({"lang": pa.array([lang] * n, pa.string()), "lo": pa.array([lo] * n, pa.int32()), "hi": pa.array([hi] * n, pa.int32()), "one": pa.array(one, pa.int32()), "two": pa.array(two, pa.int32()), "value": pa.array(value, pa.int64())})


def _slices(rows: DataFrame) -> DataFrame:
    """Each row once for each cell that needs its group's block."""
    k = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("k")
    out = rows.select("lang", "block", "member", "tblock", "slot", "p", "width", k)
    return out.select("lang", F.least("block", "k").alias("lo"), F.greatest("block", "k").alias("hi"), "tblock", "block", "member", "slot", "p", "width")


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, group_block: int = GROUP_BLOCK, term_block: int = TERM_BLOCK) -> DataFrame:
    """lang, source, part, item, value and rank: distances to each other source, and the terms used most above the language.

    Null text, lang and source read as empty; groups without terms take part with the smoothed
    share of every kept term, and languages without kept terms have distances of 0. Repeated
    rows are documents like others, long texts are read whole. An empty table gives no rows;
    other columns are not read.
    """
    own = common.stored(kept_counts(docs, least_docs), "terms")
    kept = common.stored(own.groupBy("lang", "term").agg(F.sum("n").alias("lang_n")), "kept")
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    totals = own.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    named = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    groups = named.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.na.fill(0, ["total", "terms", "lang_total"])
    groups = groups.join(groups.groupBy("lang").agg(F.count("*").alias("groups")), "lang").withColumn("block", _blocks("groups", "source", group_block))
    order = Window.partitionBy("lang", "block").orderBy("source")  # about group_block sources
    groups = groups.withColumn("member", F.row_number().over(order)).withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("groups") / group_block)).cast("int"))
    groups = common.stored(groups.withColumn("none", F.when(F.col("terms") > 0, _share("0", "total", "terms")).otherwise(0)), "groups")

    slots = Window.partitionBy("lang", "tblock").orderBy("term")  # about term_block terms
    placed = kept.join(langs, "lang").withColumn("tblock", _blocks("terms", "term", term_block))
    placed = placed.select("lang", "term", "lang_n", "tblock", (F.row_number().over(slots) - 1).alias("slot"))
    placed = common.stored(placed, "slots")
    widths = placed.groupBy("lang", "tblock").agg(F.count("*").cast("int").alias("width"))
    shared = own.join(placed, ["lang", "term"]).join(groups, ["lang", "source"])
    shared = shared.withColumn("p", _share("n", "total", "terms"))

    marks = groups.join(widths, "lang", "left").na.fill(0, ["tblock", "width"]).withColumn("slot", F.lit(-1)).withColumn("p", F.col("none"))
    cells = _slices(shared.withColumn("width", F.lit(0))).unionByName(_slices(marks))
    cells = cells.withColumn("width", F.col("width").cast("int"))
    parts = cells.groupBy("lang", "lo", "hi", "tblock").applyInArrow(_cell, "lang string, lo int, hi int, one int, two int, value long")
    summed = parts.groupBy("lang", "lo", "hi", "one", "two").agg(F.sum("value").alias("value"))
    names = groups.select("lang", "block", "member", "source")
    first = names.select("lang", F.col("block").alias("lo"), F.col("member").alias("one"), F.col("source").alias("a"))
    second = names.select("lang", F.col("block").alias("hi"), F.col("member").alias("two"), F.col("source").alias("b"))
    named = summed.join(first, ["lang", "lo", "one"]).join(second, ["lang", "hi", "two"])
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("s")
    pairs = named.select("lang", both, "value").select("lang", "s.source", F.lit("pair").alias("part"), "s.item", "value")

    above = shared.withColumn("q", _share("lang_n", "lang_total", "terms")).where("p > q and n > 0")
    above = above.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return pairs.withColumn("rank", rank).unionByName(above.withColumn("rank", rank).where(F.col("rank") <= top))


def oracle() -> str:
    """The same audit over table ``documents`` as DuckDB SQL."""
    share = "(1 + ({scale}::HUGEINT * ({n} + {five})) // ({total} + {five} * v))"

    def of(n: str, total: str) -> str:
        return share.format(scale=SCALE, five=SMOOTHING, n=n, total=total)

    return rf"""
    WITH d AS (
      SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
    ), grp AS (SELECT DISTINCT lang, source FROM d),
    t AS (SELECT row, lang, source, unnest(w) AS term FROM d),
    kept AS (SELECT lang, term, count(*) AS lang_n FROM t GROUP BY lang, term HAVING count(DISTINCT row) >= {LEAST_DOCS}),
    size AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
    own AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
    total AS (SELECT lang, source, sum(n) AS total FROM own GROUP BY ALL),
    p AS (
      SELECT lang, source, term, coalesce(n, 0) AS n, {of("coalesce(n, 0)", "coalesce(total, 0)")} AS p, {of("lang_n", "lang_total")} AS q
      FROM grp JOIN kept USING (lang) JOIN size USING (lang) LEFT JOIN own USING (lang, source, term) LEFT JOIN total USING (lang, source)
    ), pair AS (
      SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
    ), parts AS (
      SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
      FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
      UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q
    )
    SELECT lang, source, part, item, value, r::INTEGER AS rank
    FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM parts) WHERE part = 'pair' OR r <= {TOP}
    """
