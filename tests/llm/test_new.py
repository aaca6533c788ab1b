"""Importance resampling, page differencing and the divergence audit against plain rewrites and odd inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from parley.llm import crcruns, divergence, markup, pages, target
from parley.llm.queries import ORACLE_SQL, QUERIES

DOCS = "doc_id long, text string, lang string, source string, `a-b` string, score string, row string, segment string"
LONG = "long words " * 9_000


def _docs(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], DOCS)


def _compared(spark, sf_dir, name):
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    got, want = QUERIES[name](spark, sf_dir), c.sql(ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(want.columns)
    assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, (got.sparkSession.createDataFrame(want.project(", ".join(columns)).fetchall(), got.select(columns).schema).collect())))


@pytest.mark.parametrize("name", ["op11_target", "op13_divergence"])
def test_new_queries_equal_sql(spark, sf_dir, name):
    _compared(spark, sf_dir, name)


# 11 importance resampling


def _plain_draw(docs, benchmark, percent, least):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))

    def buckets(t):
        w = words(t)
        return [zlib.crc32(" ".join(w[i : i + k]).encode()) % 10_000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]

    s, t = Counter(b for d in docs for b in buckets(d[1])), Counter(b for x in benchmark for b in buckets(x))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000)))) for b in range(10_000)]
    rows = []
    for n, d in enumerate(docs):
        own = buckets(d[1])
        weight = sum(gain[b] for b in own)
        h = int(hashlib.sha256(f"42:{'' if d[0] is None else d[0]}".encode()).hexdigest()[:8], 16)
        rows.append([d[0], len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(d[1])), n])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], math.inf if r[0] is None else r[0]))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in rows]


def test_draw_equals_plain_rewrite_on_odd_rows(spark):
    r = random.Random(2)
    vocabulary = ["Ab", "b9", "é", "日本", "x" * 70, "c", "dd", "e5"]
    rows = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randint(0, 60))), "en", "s") for i in range(300)]
    rows += [(400, None, None, None), (401, "", "en", "s"), (402, LONG, "en", "s"), (7, rows[7][1], "en", "s"), (None, "b9 " * 40, "en", "s"), (-5, "-- __ \x00", "en", "s")] + [(500, "dd c " * 15, "en", "s")] * 9
    bench = ["dd c b9 é", None, "c c c", ""]
    got = target.resample(_docs(spark, rows).repartition(5), spark.createDataFrame([(x,) for x in bench], "text string"), percent=40)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(_plain_draw(rows, bench, 40, 20), key=str)


def test_ranks_are_exact_over_many_segments_with_ties(spark, monkeypatch):
    monkeypatch.setattr(target, "SEGMENT_ROWS", 16)
    monkeypatch.setattr(target, "STEP", 4)
    r = random.Random(4)
    rows = [(r.choice([1, 1, 1, None, *range(50)]), r.choice([5, 5, 5, -7, r.randint(-99, 99)]), i) for i in range(1_000)]
    df = spark.createDataFrame(rows, "doc_id long, score long, row long").repartition(7)
    cut = target.splitters(df, len(rows))
    assert len(cut) > 40
    got = {q["row"]: q["rank"] for q in target.ranked(df, cut, 333).collect()}
    order = sorted(rows, key=lambda q: (-q[1], math.inf if q[0] is None else q[0], q[2]))
    assert got == {q[2]: k + 1 if k < 333 else None for k, q in enumerate(order)}
    sizes = Counter(np.searchsorted(cut, target._keys(__import__("pyarrow").RecordBatch.from_pydict({k: [q[j] for q in rows] for j, k in enumerate(("doc_id", "score", "row"))})), side="right").tolist())
    assert max(sizes.values()) <= 16 + 7 * 4  # regular samples bound every segment, however many rows tie


def test_empty_tables_are_drawn_from_too(spark):
    none, bench = _docs(spark, []), spark.createDataFrame([("a b",)], "text string")
    assert target.resample(none, bench).collect() == []
    one = target.resample(_docs(spark, [(1, "w " * 30, "en", "s")]), bench.where("false"), percent=100).collect()
    assert [(q["doc_id"], q["rank"]) for q in one] == [(1, 1)]


def test_crc_of_words_of_any_length():
    raw = b"x" * 3 + b"y" * 64 + b"z" * 65 + b"q" * 5_000
    begin, size = np.array([0, 3, 67, 132]), np.array([3, 64, 65, 5_000])
    runs = crcruns.run_crcs(np.frombuffer(raw, np.uint8), begin, size, np.zeros(4, np.int64), 3)
    parts = [raw[b : b + n] for b, n in zip(begin, size)]
    for k, (first, crc) in enumerate(runs, 1):
        assert crc.tolist() == [zlib.crc32(b" ".join(parts[i : i + k])) for i in first]


# 12 pages

SHELL = "<html><head><title>t</title><style>p{}</style></head><body><header>Site name</header><nav><ul><li>Home<li>News</ul></nav>{}<aside>Most read</aside><footer>&copy; us</footer></body></html>"


def _extracted(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, `a.b` string").repartition(3)
    return {r["page_id"]: (r["text"], r["n_chars"]) for r in pages.extract(df).collect()}


def test_structure_leaves_the_article(spark):
    html = (
        "<div class='cookie-notice'>We use cookies</div><article><header><h1>Ti&shy;tle &amp;c</h1><p>By me</p></header><p>One  <b>bo</b>ld &lt;word<p>Two<br>lines<script>var a='</p>'</script>"
        "<div class='share-bar'>Share</div><table><tr><td>a<td>b</table><form>Mail <input></form><ul><li>x<li>y</ul><blockquote>Q</blockquote><!-- no --><div id=comments><article>Nice</article></div></article>"
    )
    got = _extracted(spark, [(1, "http://h/a", SHELL.replace("{}", html)), (2, None, None), (3, "http://h/b", ""), (4, "u", "plain < text &bogus; x"), (5, "http://h/c", "<p>" + LONG), (6, "http://h/d", "<article"), (7, "http://g/d", "<div class=ad><article><p>Kept")])
    assert got[1][0] == "Ti\xadtle &c\nOne bold <word\nTwo lines\na b\nx\ny\nQ"
    assert got[2] == got[3] == ("", 0) and got[4][0] == "plain < text &bogus; x" and got[5] == (LONG.strip(), len(LONG.strip())) and got[7][0] == "Kept"


def test_pages_without_an_article_lose_what_their_neighbours_share(spark):
    r = random.Random(1)
    prose = lambda: " ".join(r.choice("alpha beta gamma delta omega".split()) + str(r.randint(0, 999)) for _ in range(12))
    own = {i: [prose() for _ in range(4)] for i in range(12)}
    rows = [(i, f"http://h/news/{i:03d}", f"<div>Menu of the site</div><div>{own[i][0]}</div><p>{own[i][1]}</p><div>Ad {i % 2}: buy the best of all our goods here</div><p>{own[i][2]}</p><p>{own[i][3]}</p><div>Imprint and more</div>") for i in own]
    rows += [(100, "http://alone/x", "<div>Menu of the site</div><p>Only page</p>")]
    got = _extracted(spark, rows)
    assert all(got[i][0] == "\n".join(own[i]) for i in own)
    assert got[100][0] == "Menu of the site\nOnly page"


def test_articles_keep_copies_and_short_sentences_but_lose_the_sites_lines(spark):
    rows = [(i, f"http://h/{i:03d}", f"<article><p>Share this story<p>Text number {i} of this house {'w' * 40}<p>{'Yes.' if i % 2 else 'No.'}<p>And the end of {i} {'v' * 30}</article>") for i in range(9)]
    rows += [(50 + i, f"http://copies/{i:03d}", "<article><p>The very same text<p>In every copy</article>") for i in range(9)]
    got = _extracted(spark, rows)
    assert all("Share this story" not in got[i][0] and ("Yes." if i % 2 else "No.") in got[i][0] for i in range(9))
    assert all(got[50 + i][0] == "The very same text\nIn every copy" for i in range(9))
    assert _extracted(spark, []) == {}


def test_chunks_do_not_change_what_goes(spark, monkeypatch):
    rows = [(i, f"http://h/{i % 40:03d}", f"<div>Menu</div><p>text {i} {'x' * (i % 7)}</p><div>Foot</div>") for i in range(120)]
    whole = _extracted(spark, rows)
    monkeypatch.setattr(pages, "CHUNK", 9)
    assert _extracted(spark, rows) == whole and whole[5][0] == "text 5 xxxxx"


def _slow_common(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    return best[0][0]


@pytest.mark.parametrize("bits", [1 << 28, 40])
def test_alignment_is_a_longest_common_subsequence(bits, monkeypatch):
    monkeypatch.setattr(pages, "HELD_BITS", bits)
    r = random.Random(bits)
    for _ in range(300):
        a, b = ([r.randint(0, r.choice([2, 9, 30])) for _ in range(r.randint(0, 25))] for _ in "ab")
        at = pages.aligned(a, b)
        assert at == sorted(set(at)) and len(at) == _slow_common(a, b)
        it = iter(b)
        assert all(x in it for x in (a[i] for i in at))


def test_whole_pages_of_the_table_keep_their_articles(spark, sf_dir):
    got = {r["page_id"]: r for r in QUERIES["op12_pages"](spark, sf_dir).collect()}
    table = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    assert len(got) == len(table)
    for r in table:
        assert got[r["page_id"]]["text"] == "\n".join(b.text for b in markup.article_blocks(r["html"])) != ""


# 13 divergence


def _plain_audit(docs, least, top):
    terms = [(d[2] or "", d[3] or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (d[1] or "").translate({c: c + 32 for c in range(65, 91)}))) for d in docs]
    groups, held, count = defaultdict(set), Counter(), Counter()
    for lang, source, w in terms:
        groups[lang].add(source)
        held.update((lang, t) for t in set(w))
        count.update((lang, source, t) for t in w)
    out = []
    for lang, sources in groups.items():
        kept = [t for (k, t), n in held.items() if k == lang and n >= least]
        share = lambda n, total: 1 + 1_000_000_000 * (n + 5) // (total + 5 * len(kept))
        total = {s: sum(count[lang, s, t] for t in kept) for s in sources}
        p = {s: {t: share(count[lang, s, t], total[s]) for t in kept} for s in sources}
        q = {t: share(sum(count[lang, s, t] for s in sources), sum(total.values())) for t in kept}
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources - {s}]
            above = [(p[s][t] - q[t], t) for t in kept if count[lang, s, t] and p[s][t] > q[t]]
            for part, rows, most in (("pair", pairs, len(pairs)), ("term", above, top)):
                out += [(lang, s, part, item, v, k + 1) for k, (v, item) in enumerate(sorted(rows, key=lambda x: (-x[0], x[1].encode()))[:most])]
    return out


@pytest.mark.parametrize(("groups", "terms"), [(64, 4096), (3, 5), (1, 1)])
def test_audit_equals_plain_rewrite_whatever_the_blocks(spark, groups, terms):
    r = random.Random(9)
    vocabulary = ["Ab", "ab", "é", "日", "zz", *(f"w{'x' * k}" for k in range(12))]
    rows = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randint(0, 12))), r.choice(["en", "en", "de", None]), r.choice(["s1", "s2", "s3", "", None, "ß", "Z"])) for i in range(400)]
    rows += [(1, None, "fr", "a"), (2, "", "fr", "b"), (3, "few words", "fr", "c"), (4, LONG, "en", "s1"), *[(5, "ab 1 ab", "en", "s2")] * 40, (6, "ab", "en", "lonely"), (7, "1 2", "en", "wordless"), (8, "x", "one", "group")]
    got = divergence.audit(_docs(spark, rows).repartition(4), least_docs=6, top=4, group_block=groups, term_block=terms)
    assert sorted(map(tuple, got.collect())) == sorted(_plain_audit(rows, 6, 4))


def test_audit_of_no_rows(spark):
    assert divergence.audit(_docs(spark, [])).collect() == []
