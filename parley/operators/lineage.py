"""Lineage, state and table operators: lookups, counts, upserts, transitions, constraints."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.texts import safe_error

# Legal status changes of recordings, of their parts and of chunks.
RAW_TRANSITIONS = (
    ("pending", "splitting"),
    ("pending", "failed"),
    ("failed", "splitting"),
    ("splitting", "split_completed"),
    ("splitting", "failed"),
    ("split_completed", "failed"),
)
PART_TRANSITIONS = (
    ("pending", "diarizing"),
    ("failed", "diarizing"),
    ("diarizing", "diarized"),
    ("diarizing", "failed"),
    ("diarized", "filtering"),
    ("diarized", "failed"),
    ("failed", "filtering"),
    ("filtering", "completed"),
    ("filtering", "failed"),
)
CHUNK_TRANSITIONS = (
    ("pending", "separating"),
    ("failed", "separating"),
    ("separating", "separated"),
    ("separating", "rejected"),
    ("separating", "failed"),
    ("separated", "transcribing"),
    ("failed", "transcribing"),
    ("transcribing", "transcribed"),
    ("transcribing", "failed"),
    ("transcribed", "persona_generating"),
    ("failed", "persona_generating"),
    ("persona_generating", "persona_generated"),
    ("persona_generating", "failed"),
    ("persona_generated", "reconstructing"),
    ("persona_generated", "failed"),
    ("failed", "reconstructing"),
    ("reconstructing", "reconstructed"),
    ("reconstructing", "rejected"),
    ("reconstructing", "failed"),
    ("reconstructed", "extending"),
    ("reconstructed", "failed"),
    ("failed", "extending"),
    ("extending", "completed"),
    ("extending", "rejected"),
    ("extending", "failed"),
)
RAW_STATUSES, PART_STATUSES = (tuple(sorted({s for pair in t for s in pair})) for t in (RAW_TRANSITIONS, PART_TRANSITIONS))


def first_by_content(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row for each distinct content: its SHA-1, smallest id and number of rows."""
    return docs.groupBy(F.sha1(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("content_sha1")).agg(F.min(id_col).alias(id_col), F.count("*").alias("n_rows"))


def child_counts(parents: DataFrame, children: DataFrame, key: str, name: str) -> DataFrame:
    """Children of each parent, 0 where there is none; children are counted before the join."""
    counts = children.groupBy(key).agg(F.count("*").alias(name))
    return parents.join(counts, key, "left").withColumn(name, F.coalesce(name, F.lit(0).cast("long")))


def surviving(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Children whose parent remains, as a cascading delete leaves them."""
    return children.join(parents.select(key).distinct(), key, "left_semi")


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Each key's outcome: inserted, kept (equal values, nulls alike), conflict, or untouched."""
    a = existing.select(*keys, F.struct(*values).alias("·a"), F.lit(True).alias("·old"))
    b = incoming.select(*keys, F.struct(*values).alias("·b"), F.lit(True).alias("·new"))
    same = reduce(lambda x, y: x & y, (F.col(f"·a.{v}").eqNullSafe(F.col(f"·b.{v}")) for v in values))
    outcome = F.when(F.col("·new").isNull(), "untouched").when(F.col("·old").isNull(), "inserted").when(same, "kept").otherwise("conflict")
    return a.join(b, keys, "full_outer").select(*keys, outcome.alias("outcome"))


def insert_absent(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Existing rows and those incoming ones whose key is new; equal keys are not compared."""
    return existing.unionByName(incoming.join(existing.select(*keys), keys, "left_anti").dropDuplicates(keys))


def latest(events: DataFrame, keys: list[str], order: str, status: str) -> DataFrame:
    """Current status of each entity and how many events led there."""
    return events.groupBy(*keys).agg(F.max_by(status, order).alias(status), F.max(order).alias(order), F.count("*").alias("n_events"))


def illegal_transitions(events: DataFrame, keys: list[str], order: str, status: str, legal: Iterable[tuple[str, ...]], within: tuple[str, ...] = ()) -> DataFrame:
    """Status changes that the table of legal ones does not hold; an entity's first event is legal.

    Legal ones are pairs of statuses, behind the values of the keys ``within`` where tables differ by them.
    """
    spark = events.sparkSession
    w = Window.partitionBy(*keys).orderBy(order)
    steps = events.withColumn("from_status", F.lag(status).over(w)).where("from_status is not null")
    by = [*within, "from_status", status]
    table = spark.createDataFrame(list(legal), ", ".join(f"{c} string" for c in by))  # as many rows as the tables have
    return steps.join(F.broadcast(table), by, "left_anti")


def claim(current: DataFrame, ids: DataFrame, key: str, status: str, allowed: list[str], to: str, said: dict[str, str] | None = None, clear: tuple[str, ...] = ()) -> DataFrame:
    """Compare-and-set for many entities: their new status, or why the claim is refused.

    ``said`` names the dispositions of statuses that may not be claimed; others are called
    already_<status>. Columns to ``clear`` come along, and are null where the claim succeeds.
    """
    rows = ids.select(key).distinct().join(current.select(key, status, *clear), key, "left")
    ok = F.coalesce(F.col(status).isin(*allowed), F.lit(False))
    named = F.coalesce(*(F.when(F.col(status) == k, F.lit(v)) for k, v in (said or {}).items()), F.concat(F.lit("already_"), F.col(status)))
    disposition = F.when(F.col(status).isNull(), "missing").when(ok, "claimed").otherwise(named)
    return rows.select(key, F.when(ok, F.lit(to)).otherwise(F.col(status)).alias(status), *(F.when(~ok, F.col(c)).alias(c) for c in clear), disposition.alias("disposition"))


def claim_with_parent(current: DataFrame, parents: DataFrame, ids: DataFrame, key: str, parent_key: str, status: str, allowed: list[str], to: str, needed: list[str], carried: list[str]) -> DataFrame:
    """Compare-and-set of entities together with their parent: what the claim found, to be compared at completion.

    A claim succeeds for an entity in an allowed status whose parent exists and whose ``needed``
    columns are all there; its ``carried`` columns, of the entity or its parent, come along.
    Others are missing, orphan, invalid or already_<status>.
    """
    held = current.join(parents.select(parent_key, F.lit(True).alias("·parent"), *(c for c in carried if c not in current.columns)), parent_key, "left")
    rows = ids.select(key).distinct().join(held, key, "left")
    free = F.coalesce(F.col(status).isin(*allowed), F.lit(False))
    whole = reduce(lambda x, y: x & y, (F.col(c).isNotNull() for c in needed), F.lit(True))
    disposition = F.when(F.col(status).isNull(), "missing").when(~free, F.concat(F.lit("already_"), F.col(status))).when(F.col("·parent").isNull(), "orphan").when(~whole, "invalid").otherwise("claimed")
    rows = rows.withColumn("disposition", disposition)
    ok = F.col("disposition") == "claimed"
    return rows.select(key, F.when(ok, F.lit(to)).otherwise(F.col(status)).alias(status), *(F.when(ok, F.col(c)).alias(c) for c in carried), "disposition")


def complete(current: DataFrame, claims: DataFrame, key: str, status: str, expected: str, to: str, same: list[str]) -> DataFrame:
    """Optimistic completion: a claimed entity moves on only if it is as it was when it was claimed.

    Each claim's outcome is completed, conflict (another status, or one of the ``same`` columns
    differs, nulls alike) or missing, beside the status that follows.
    """
    then = claims.dropDuplicates([key]).select(key, F.struct(*same).alias("then"))
    now = current.select(key, status, F.struct(*same).alias("now"))
    rows = then.join(now, key, "left")
    unchanged = reduce(lambda x, y: x & y, (F.col(f"then.{c}").eqNullSafe(F.col(f"now.{c}")) for c in same), F.col(status) == expected)
    ok = F.coalesce(unchanged, F.lit(False))
    return rows.select(key, F.when(ok, F.lit(to)).otherwise(F.col(status)).alias(status), F.when(F.col("now").isNull(), "missing").when(ok, "completed").otherwise("conflict").alias("outcome"))


def complete_with_parent(current: DataFrame, parents: DataFrame, claims: DataFrame, key: str, parent_key: str, status: str, expected: str, to: str, same: list[str], parent_same: list[str]) -> DataFrame:
    """Optimistic completion of entities that hang on a parent: neither may have changed since the claim.

    ``claims`` hold the entity's ``same`` columns and, under their own names, the parent's
    ``parent_same`` ones. An entity whose parent is gone is missing.
    """
    now = current.select(key, parent_key, status, *same).join(parents.select(parent_key, *parent_same), parent_key)
    return complete(now, claims, key, status, expected, to, [*same, *parent_same])


def fail(current: DataFrame, failures: DataFrame, key: str, status: str, expected: str, code: str) -> DataFrame:
    """The fail step of a claim: entities that are still ``expected`` become failed with a safe error text.

    Of several failures of one entity the smallest code is kept. Outcomes are failed, ignored (it
    has moved on) and missing.
    """
    first = failures.groupBy(key).agg(F.min(code).alias("code"))
    rows = first.join(current.select(key, status, F.lit(True).alias("known")), key, "left")
    ok = F.coalesce(F.col(status) == expected, F.lit(False))
    outcome = F.when(F.col("known").isNull(), "missing").when(ok, "failed").otherwise("ignored")
    return rows.select(key, F.when(ok, "failed").otherwise(F.col(status)).alias(status), F.when(ok, safe_error(F.col("code"))).alias("error"), outcome.alias("outcome"))


def merged_namespace(results: Column, name: str, value: Column) -> Column:
    """A map of results with one more namespace; null where another value stands there already."""
    held = F.coalesce(results, F.create_map().cast("map<string,string>"))
    before = F.try_element_at(held, F.lit(name))
    added = F.map_concat(F.map_filter(held, lambda k, v: k != name), F.create_map(F.lit(name), value))
    return F.when(before.isNull() | before.eqNullSafe(value), added)


def table_checks(raw: DataFrame, parts: DataFrame, chunks: DataFrame) -> DataFrame:
    """entity, id and rule: what the three tables' rows break of their checks, unique keys and references.

    ``raw``: id, status, content_sha1. ``parts``: id, raw_audio_id, part_index, status,
    relative_start_ms, relative_end_ms. ``chunks``: id, audio_part_id, chunk_index, duration_ms,
    relative_start_ms, relative_end_ms. As in SQL, a check whose value is unknown holds, and nulls
    are no repeats.
    """

    def known(ok: Column) -> Column:
        return F.coalesce(ok, F.lit(True))

    def alone(rows: DataFrame, keys: list[str]) -> DataFrame:
        """Rows with ``alone``: no other row has their keys."""
        told = rows.where(" and ".join(f"{k} is not null" for k in keys)).groupBy(*keys).agg((F.count("*") == 1).alias("alone"))
        return rows.join(told, keys, "left")

    def held(rows: DataFrame, key: str, parents: DataFrame) -> DataFrame:
        return rows.join(parents.select(F.col("id").alias(key), F.lit(True).alias("held")).distinct(), key, "left")

    span = known(F.col("relative_end_ms") > F.col("relative_start_ms"))
    rules = {
        "raw_audios": (alone(raw, ["content_sha1"]), {"status": known(F.col("status").isin(*RAW_STATUSES)), "content_sha1": known(F.col("alone"))}),
        "audio_parts": (
            held(alone(parts, ["raw_audio_id", "part_index"]), "raw_audio_id", raw),
            {"status": known(F.col("status").isin(*PART_STATUSES)), "part_index": known(F.col("part_index") >= 0), "span": span, "unique": known(F.col("alone")), "raw_audio_id": F.col("held")},
        ),
        "chunks": (
            held(alone(chunks, ["audio_part_id", "chunk_index"]), "audio_part_id", parts),
            {
                "chunk_index": known(F.col("chunk_index") >= 0), "start": known(F.col("relative_start_ms") >= 0), "span": span, "duration": known(F.col("duration_ms") > 0),
                "length": known(F.col("duration_ms") == F.col("relative_end_ms") - F.col("relative_start_ms")), "unique": known(F.col("alone")), "audio_part_id": F.col("held"),
            },
        ),
    }
    found = [violations(rows, checks, ["id"]).select(F.lit(entity).alias("entity"), "id", "rule") for entity, (rows, checks) in rules.items()]
    return reduce(DataFrame.unionByName, found)


def violations(rows: DataFrame, rules: dict[str, Column], keys: list[str]) -> DataFrame:
    """Rows that break rules, one output row for each broken rule; a null verdict is a violation."""
    broken = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items())))
    return rows.select(*keys, F.explode(broken).alias("rule"))
