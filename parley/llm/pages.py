"""Main text of web pages by differencing each page with its nearest ones.

Pages of a host lie in the order of their URL paths, where the nearest share the longest
prefixes. The blocks that a page's structure leaves (see ``markup``) are aligned with those of
its nearest pages by longest common subsequence; blocks that such pages share are the site's,
not the article's.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.positions import numbered
from . import common
from .markup import article_blocks

#: Pages looked at on each side in the order of paths, and how many nearest ones of these count.
REACH, NEAREST = 4, 8
#: Pages of a chunk of the order; a task holds one, without texts.
CHUNK = 1000
#: A page that shares more than this share of its characters with a neighbour is its copy, and
#: says nothing about the site: in an article, and on pages without one.
COPY_ARTICLE, COPY_BARE = 0.5, 0.9
#: Sharing pages that a block must have to go: outside articles two (or the only one there is), and
#: half of them all for blocks of few characters; inside articles, where sentences recur by
#: chance, every one, of four at least.
LEAST_BARE, LEAST_ARTICLE, SHORT = 2, 4, 25
#: Bits of alignment rows held at once; longer pages are aligned in halves.
HELD_BITS = 1 << 28


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, url, inside (an article or main element was found) and blocks (tag, text) of each page."""
    ids = pages.schema["page_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("tag", pa.string()), ("text", pa.string())]))
        for batch in batches:
            found = [article_blocks(x or "") for x in batch.column(2).to_pylist()]
            blocks = [[{"tag": b.tag, "text": b.text.encode("utf-8", "replace").decode()} for b in f] for f in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([bool(f and f[0].level) for f in found]), pa.array(blocks, kind)], names=["page_id", "url", "inside", "blocks"])

    return common.map_arrow(pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string")), f"page_id {ids}, url string, inside boolean, blocks array<struct<tag:string,text:string>>", read)


def aligned(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``: rows of bits, one for each of a's members."""
    lo, hi = 0, 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    while hi < min(len(a), len(b)) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    ends = [*range(lo)], [*range(len(a) - hi, len(a))]
    known, held = set(b[lo : len(b) - hi]), set(a[lo : len(a) - hi])
    at = [i for i in range(lo, len(a) - hi) if a[i] in known]
    inner = _common([a[i] for i in at], [x for x in b[lo : len(b) - hi] if x in held])
    return [*ends[0], *(at[i] for i in inner), *ends[1]]


def _rows(a: list[int], b: list[int]) -> Iterator[int]:
    """After each member of ``a``: a bit for each place of ``b`` at which the common length does not grow."""
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    row = full = (1 << len(b)) - 1
    for x in a:
        hit = row & where.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
        yield row


def _lengths(a: list[int], b: list[int]) -> list[int]:
    """Common length of ``a`` with each prefix of ``b``."""
    *_, last = _rows(a, b)
    out = [0]
    for j in range(len(b)):
        out.append(out[-1] + (not last >> j & 1))
    return out


def _common(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence; beyond HELD_BITS, ``a`` is halved where both halves' lengths sum up highest."""
    if not a or not b:
        return []
    if len(a) > 1 and len(a) * len(b) > HELD_BITS:
        half = len(a) // 2
        front, back = _lengths(a[:half], b), _lengths(a[half:][::-1], b[::-1])[::-1]
        cut = max(range(len(b) + 1), key=lambda j: front[j] + back[j])
        return _common(a[:half], b[:cut]) + [half + i for i in _common(a[half:], b[cut:])]
    rows, out, i, j = list(_rows(a, b)), [], len(a) - 1, len(b) - 1
    while i >= 0 and j >= 0:
        seen = (1 << (j + 1)) - 1
        if a[i] == b[j]:
            out.append(i)
            i, j = i - 1, j - 1
        elif i and (rows[i - 1] & seen).bit_count() == (rows[i] & seen).bit_count():
            i -= 1
        elif not i and (rows[0] & seen).bit_count() == j + 1:
            break
        else:
            j -= 1
    return out[::-1]


def _same_start(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((k for k in range(n) if a[k] != b[k]), n)


def shared_blocks(pages: list[tuple[str, bool, list[int], list[int]]]) -> Iterator[tuple[int, list[int]]]:
    """For pages of one host in the order of paths, (path, inside, hashes and sizes of blocks): page and blocks that go."""
    pairs: dict[tuple[int, int], list[int]] = {}

    def common_blocks(i: int, j: int) -> list[int]:
        if (i, j) not in pairs:
            pairs[i, j] = aligned(pages[i][2], pages[j][2])
        return pairs[i, j]

    for i, (path, inside, hashes, sizes) in enumerate(pages):
        near = [j for j in range(max(0, i - REACH), min(len(pages), i + REACH + 1)) if j != i and pages[j][1] == inside]
        near.sort(key=lambda j: (-_same_start(path, pages[j][0]), abs(j - i), j))
        votes, seen = [0] * len(hashes), 0
        for j in near:
            if seen == NEAREST:
                break
            both = common_blocks(i, j)
            limit = COPY_ARTICLE if inside else COPY_BARE
            least = min(sum(sizes), sum(pages[j][3]))
            if sum(sizes[k] for k in both) > limit * least:
                continue
            seen += 1
            for k in both:
                votes[k] += 1
        few = min(LEAST_BARE, max(1, seen))
        needs = (max(seen, LEAST_ARTICLE) if inside else few if size >= SHORT else max(few, -(-seen // 2)) for size in sizes)
        gone = [k for k, (n, need) in enumerate(zip(votes, needs)) if n >= need]
        if gone:
            yield i, gone


def _differenced(rows: DataFrame) -> DataFrame:
    """row and the places of its blocks that go, from (row, host, path, inside, hashes, sizes, position)."""

    def of(table: pa.Table) -> pa.Table:
        held = table.sort_by("position")
        own = held.column("own").to_pylist()
        hosts, ids = held.column("host").to_pylist(), held.column("row").to_pylist()
        pages = list(zip(*(held.column(c).to_pylist() for c in ("path", "inside", "hashes", "sizes"))))
        out, begin = [], 0
        for end in range(1, len(hosts) + 1):
            if end == len(hosts) or hosts[end] != hosts[begin]:
                out += [(ids[begin + i], gone) for i, gone in shared_blocks(pages[begin:end]) if own[begin + i]]
                begin = end
        return pa.table({"row": pa.array([o[0] for o in out], pa.int64()), "gone": pa.array([o[1] for o in out], pa.list_(pa.int32()))})

    chunk = F.expr(f"position div {CHUNK}")
    edges = F.array(F.lit(0).cast("long"), F.when(F.col("position") % CHUNK < REACH, F.lit(-1).cast("long")), F.when(F.col("position") % CHUNK >= CHUNK - REACH, F.lit(1).cast("long")))
    dealt = rows.withColumn("side", F.explode(F.array_compact(edges))).withColumn("chunk", chunk + F.col("side")).withColumn("own", F.col("side") == 0)
    return dealt.groupBy("chunk").applyInArrow(of, "row long, gone array<int>")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text (blocks joined by line feeds) and n_chars (code points) of every row.

    Structure decides first: see ``markup``. Then blocks go that the nearest pages of the host
    share: on pages without an article element those that two of eight share (short ones: half of
    them), in articles only those that all share. Neighbours that are copies of the page do not count. Null and empty
    pages have an empty text; pages without a url keep what structure leaves; repeated rows
    and urls are pages like others. Long pages are read whole. An empty table gives no rows, and
    other columns are not read.
    """
    blocks = common.stored(parsed(pages).withColumn("row", F.monotonically_increasing_id()), "pages")
    address = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)([^?#]*)"
    host, path = F.lower(F.regexp_extract("url", address, 1)), F.regexp_extract("url", address, 2)
    light = blocks.where(F.col("url").rlike(address) & (F.size("blocks") > 0)).select(
        "row", host.alias("host"), path.alias("path"), "inside",
        F.transform("blocks", lambda b: F.xxhash64(b["tag"], b["text"])).alias("hashes"),
        F.transform("blocks", lambda b: F.length(b["text"])).alias("sizes"),
    )
    gone = common.stored(_differenced(numbered(light, [], ["host", "path", "row"])), "gone")  # so that Spark knows its size when it joins
    left = F.when(F.col("gone").isNull(), F.col("blocks")).otherwise(F.filter("blocks", lambda b, i: ~F.array_contains("gone", i)))
    text = F.array_join(F.transform(left, lambda b: b["text"]), "\n").alias("text")
    return blocks.join(gone, "row", "left").select("page_id", "url", text).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
