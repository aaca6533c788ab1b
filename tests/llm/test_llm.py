"""The corpus operators against brute force, round trips and odd inputs."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from parley.llm import ann, anchors, components, induced, langid, license, media, packing, quality, sentencepieces, simhash, suffix, tokenfile
from parley.llm.queries import ORACLE_SQL, QUERIES, tokenizer_path
from parley.llm.wordbpe import WordEncoder

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, key string, row string, p double"
LONG = "long words here " * 6_000
ODD = ["", None, "   \n\t ", "a", "?!", "héllo wörld", "x" * 5_000, LONG, "one two three four five six", "one two three four five six", "\x00 nul\x00", "  spaced  out \n\n text ", "日本語のテキスト 😀"]


def docs_of(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], t, "en", None if i % 3 == 0 else "s", None, "x", "k", "r", 0.5) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    return docs_of(spark, [*ODD, "no id", "twice", "twice"], [*range(len(ODD)), None, 77, 77])


@pytest.fixture(scope="module")
def none(spark):
    return docs_of(spark, [])


def prose(n, seed, letters="abcdefghij"):
    r = random.Random(seed)
    return " ".join("".join(r.choice(letters) for _ in range(r.randint(1, 6))) for _ in range(n))


# 1 quality


def test_quality_separates_and_shrinks(spark):
    good, bad = [prose(60, i) for i in range(60)], [prose(60, 100 + i).upper().replace(" ", "!! ") for i in range(60)]
    docs = docs_of(spark, good + bad)
    labels = spark.createDataFrame([(i, int(i < 60), 0) for i in range(0, 120, 2)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.classify(docs, labels).collect()}
    assert all(got[i]["keep"] == (i < 60) for i in range(120))
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == set(range(60))


def test_quality_posteriors_match_plain_sums(spark):
    rows = [("a", "x", 0.9)] * 20 + [("a", "y", 0.2)] + [("b", "x", 0.3)] * 10
    sites, priors = quality.site_posteriors(spark.createDataFrame(rows, "host string, path string, p double"))
    rate = sum(r[2] for r in rows) / len(rows)
    assert priors.rate == pytest.approx(rate)
    got = {(r["host"], r["path"]): r for r in sites.collect()}
    assert got["a", "y"]["host_rate"] == pytest.approx((18.2 + priors.host_weight * rate) / (21 + priors.host_weight))


def test_quality_on_odd_and_empty_input(spark, odd, none):
    labels = spark.createDataFrame([(8, 1, 0), (6, 0, 0), (8, 1, 0), (None, 1, 0), (5, None, 1)], "doc_id long, quality int, toxic int")
    assert quality.classify(odd, labels).count() == odd.count()
    assert quality.classify(odd, labels.limit(0)).where("keep").count() == odd.count()
    assert quality.keep_good(none, labels).count() == 0
    assert quality.classify(none, labels).count() == 0


# 2 language


def test_language_held_out_accuracy(spark):
    alphabets = {"aa": "abcdefgh", "bb": "ijklmnop", "cc": "qrstuvwx"}
    rows = [(i, prose(50, i, alphabets[k]), k) for i, k in enumerate(["aa", "bb", "cc"] * 40)]
    got = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    held = [r for r in got if r["held_out"]]
    assert held and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert sum(r["lang_pred"] == rows[r["doc_id"]][2] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_mixture_is_found():
    rng = np.random.default_rng(0)
    table = rng.dirichlet(np.full(langid.BUCKETS, 0.05), 3).astype(np.float32) + 1e-7
    model = langid.Model(("a", "b", "c"), table / table.sum(axis=1, keepdims=True))
    mixed = (rng.multinomial(600, table[0] / table[0].sum()) + rng.multinomial(400, table[1] / table[1].sum())).astype(np.float32)
    shares, _ = model.infer(np.stack([mixed, rng.multinomial(900, table[2] / table[2].sum()).astype(np.float32)]))
    assert shares[0] == pytest.approx([0.6, 0.4, 0], abs=0.08)
    assert shares[1] == pytest.approx([0, 0, 1], abs=1e-6)


def test_language_on_odd_and_empty_input(spark, odd, none):
    got = {(r["doc_id"], i): r for i, r in enumerate(langid.identify(odd).collect())}
    by_id = {k[0]: r for k, r in got.items()}
    assert len(got) == odd.count() and by_id[1]["lang_pred"] == by_id[0]["lang_pred"] == by_id[4]["lang_pred"] == "und"
    assert langid.identify(none).count() == 0
    assert {r["lang_pred"] for r in langid.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.keep_known(odd).columns == odd.columns


# 3 SimHash


def test_fingerprint_is_the_majority_of_shingle_hashes():
    import xxhash

    text = "The quick brown\tfox  JUMPS over the quick brown fox jumps"
    words = text.lower().split()
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]), 42) for i in range(len(words) - 3)]
    want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    assert simhash.fingerprint(text) == want
    assert simhash.fingerprint("Two words") == xxhash.xxh64_intdigest("two words", 42)
    assert simhash.fingerprint("  ") == 0


def test_links_reach_what_brute_force_reaches(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = sorted({b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 5))) for b in base for _ in range(12)})
    nodes = spark.createDataFrame([(i, int(np.uint64(f).astype(np.int64))) for i, f in enumerate(fps)], "rep long, fp long")
    found = {r["node"]: r["component"] for r in components.components(simhash.links(nodes)).collect()}
    label = list(range(len(fps)))
    for _ in fps:
        for i, a in enumerate(fps):
            for j in range(i):
                if (a ^ fps[j]).bit_count() <= 4:
                    label[i] = label[j] = min(label[i], label[j])
    again = None
    while again != label:
        again = list(label)
        label = [label[x] for x in label]
    assert [found.get(i, i) for i in range(len(fps))] == label


def test_simhash_on_odd_and_empty_input(spark, odd, none):
    rows = simhash.near_duplicates(odd).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == odd.count()
    assert got[0]["component_id"] == got[1]["component_id"] == got[2]["component_id"] == 0
    assert got[0]["fingerprint"] == "0" * 16 and got[9]["component_id"] == 8
    assert got[None]["component_id"] is None
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == sorted({r["component_id"] for r in rows} - {None})
    assert simhash.near_duplicates(none).count() == 0 and simhash.one_of_each(none).count() == 0


def test_components_of_a_hub_and_a_chain(spark):
    edges = [(0, i) for i in range(1, 60)] + [(100 + i, 101 + i) for i in range(40)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(60)) and all(got[100 + i] == 100 for i in range(41))


# 4 neighbours


def test_neighbours_recall_and_order(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((900, 16)).astype(np.float32)
    x[300:340] = x[5]
    rows = [(i, [float(v) for v in x[i]]) for i in range(900)] + [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [None] * 16), (5, [float(v) for v in x[5]])]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), query_every=50).collect()
    hit = 0
    for q in range(0, 900, 50):
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1))
        want = sorted((v, i) for i, v in enumerate(d) if i != q)[:10]
        assert [m[0] for m in mine] == list(range(1, 11))
        assert [(m[2], m[1]) for m in mine] == sorted((m[2], m[1]) for m in mine)
        hit += len({w[1] for w in want} & {m[1] for m in mine})
        assert all(abs(m[2] - d[m[1]]) < 1e-12 for m in mine)
    assert hit >= 0.9 * 180


def test_few_or_no_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0])], "vec_id long, embedding array<double>")
    assert [(r["query_id"], r["vec_id"]) for r in ann.nearest(df).collect()] == [(0, 1)]
    assert ann.nearest(df.limit(0)).count() == 0


# 5 repeated strings


@pytest.mark.parametrize("memory", [0, 1 << 20])
def test_induced_sort_finds_what_counting_finds(memory):
    rng = random.Random(7)
    for _ in range(40):
        depth, letters = rng.choice([1, 3, 8, 9, 20]), "abcd"[: rng.randint(1, 4)]
        base = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(4)]
        parts = ["".join(rng.choice(base) for _ in range(rng.randint(1, 3))).encode() for _ in range(8)]
        count = Counter(p[i : i + depth] for p in parts for i in range(len(p) - depth + 1))
        flags = induced.repeated_starts(np.frombuffer(b"\0".join(bytes(c + 1 for c in p) for p in parts) + b"\0", np.uint8), depth, memory)
        at = 0
        for p in parts:
            n = max(0, len(p) - depth + 1)
            assert flags[at : at + n].tolist() == [count[p[i : i + depth]] > 1 for i in range(n)]
            at += len(p) + 1


def test_sort_holds_a_small_multiple_of_its_text():
    import tracemalloc

    text = np.frombuffer(b"\0".join(prose(60, k).encode() for k in range(1_500)) + b"\0", np.uint8)
    tracemalloc.start()
    flags = induced.repeated_starts(text, 200)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(flags) == len(text) and peak < 36 * len(text)


def test_memory_is_handed_back():
    from parley.llm import common

    def held():
        return sum(int(line.split()[1]) << 10 for line in open("/proc/self/smaps_rollup") if line.startswith("Anonymous:"))

    before = held()
    blocks = [np.ones(10_000, np.uint8) for _ in range(6_000)]
    blocks = blocks[-1:]  # the last one keeps the others' space from being cut off at the end
    common.release()
    assert held() - before < 30_000_000 and blocks


def test_anchor_runs_cover_every_start_once(monkeypatch):
    monkeypatch.setattr(anchors, "CHUNK", 700)
    raw = np.frombuffer((prose(800, 2) + "ab" * 400).encode(), np.uint8)
    first, n, _ = anchors.anchor_runs(raw, 200)
    assert np.concatenate([np.arange(a, a + m) for a, m in zip(first, n)]).tolist() == list(range(len(raw) - 199))


def cut_by_counting(texts, window):
    raws = [(t or "").encode() for t in texts]
    count = Counter(r[i : i + window] for r in raws for i in range(len(r) - window + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - window + 1):
            if count[r[i : i + window]] > 1:
                gone[i : i + window] = True
        kept = np.frombuffer(r, np.uint8)[~gone].tobytes()
        out.append((len(r), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.view(np.int8)])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("wordings", [0, 50_000])
def test_repeats_equal_brute_force(spark, wordings, monkeypatch):
    monkeypatch.setattr(suffix, "WORDINGS", wordings)
    shared, other = prose(90, 50), prose(80, 51)
    texts = [f"{prose(40, i)} {shared} {prose(30, 60 + i)}" for i in range(6)] + [other + "é" + prose(50, 9), prose(20, 8) + other, "ab" * 300, None, "", prose(30, 77), prose(99, 78), prose(99, 78)]
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix.digest(docs_of(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == cut_by_counting(texts, 200)
    kept = suffix.without_repeats(docs_of(spark, texts))
    assert kept.columns == docs_of(spark, []).columns
    by_id = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert shared not in by_id[0] and by_id[9] is None and by_id[11] == texts[11]


def test_repeats_on_odd_and_empty_input(spark, odd, none):
    rows = suffix.digest(odd).collect()
    assert len(rows) == odd.count()
    assert {r["doc_id"]: r["n_removed"] for r in rows}[7] == len(LONG)
    assert suffix.digest(none).count() == 0


# 6 token files


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 31, 32])
def test_packed_ids_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 9_001).astype(np.uint64)
    assert (tokenfile.unpack(tokenfile.pack(ids, bits), bits, len(ids)) == ids).all()
    shard = tokenfile.Shard(tokenfile.encode_shard([4, None, 9], np.array([1, 1, 9_001]), ids, bits))
    assert (shard.ids(4_000, 8_300) == ids[4_000:8_300]).all() and shard.doc_ids.tolist() == [4, 0, 9]


def test_token_files_hold_the_librarys_ids(spark, odd, none, monkeypatch):
    from tokenizers import Tokenizer

    from parley.llm import common

    path = tokenizer_path()
    reference = Tokenizer.from_file(path)
    out = common.shared_dir(spark, "t")
    rows = tokenfile.read_tokens(tokenfile.write_tokens(odd, out, path, 2), out).collect()
    source = sorted(odd.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or ""))
    assert len(rows) == len(source)
    at = 0
    for r, s in zip(sorted(rows, key=lambda r: r["start"]), source):
        ids = np.array(reference.encode(s["text"] or "", add_special_tokens=False).ids + [2], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (s["doc_id"], at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    empty = common.shared_dir(spark, "t")
    assert tokenfile.read_tokens(tokenfile.write_tokens(none, empty, path, 2), empty).count() == 0


def test_word_cache_changes_no_ids():
    from tokenizers import Tokenizer

    path = tokenizer_path()
    texts = [t or "" for t in ODD] + ["it's  we'll'd don'tab", "a<|endoftext|> b", " \n x  y  z", "e\x1c d\x1c\x1d", "tail "]
    small = WordEncoder(path, cache_words=3)
    for t, e in zip(texts, Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(small.encode(t), "<u4").tolist() == e.ids


# 7 packing


def test_hilbert_curve_steps_to_neighbours():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = packing.hilbert_keys(grid, 3)
    assert sorted(keys.tolist()) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_pieces_hold_each_id_once(spark, odd, none):
    from tokenizers import Tokenizer

    path = tokenizer_path()
    reference = Tokenizer.from_file(path)
    texts = [*[t for t in ODD], *[prose(300, i) for i in range(30)]]
    rows = packing.pack(docs_of(spark, texts), path).collect()
    sequences, parts = {}, {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        parts.setdefault(r["doc_id"], []).append(r)
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at == 2048 or at & (at - 1) == 0
    for i, t in enumerate(texts):
        ids = np.array(reference.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted(parts[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : at].tobytes())
        assert at == len(ids)
    assert packing.pack(none, path).count() == 0 and packing.pack(odd, path).count() >= odd.count()


# 8 media


@pytest.mark.parametrize("n", [0, 1, 64, 150, 168, 170, 182, 184, 16_384, 16_385, 70_000])
def test_transport_stream_round_trip(n):
    payload = random.Random(n).randbytes(n)
    s = media.demux(media.mux(payload))
    assert s.payload == payload and s.continuity_errors == 0 and s.streams == {media.DATA_PID: media.PRIVATE_PES}
    assert s.timestamps == [i * media.TICKS for i in range(-(-n // media.UNIT))]
    assert s.access == [i % media.ACCESS_EVERY == 0 for i in range(len(s.timestamps))]


def test_damaged_streams_are_noticed():
    raw = bytearray(media.mux(random.Random(1).randbytes(3_000)))
    lost = bytes(raw[: 188 * 5] + raw[188 * 6 : 188 * 8])
    with pytest.raises(ValueError):
        media.demux(lost)  # the PES packet is cut off
    raw[188 + 20] ^= 1
    with pytest.raises(ValueError):
        media.demux(bytes(raw))  # the map's CRC
    assert media.demux(media.mux(b"x" * 64)).continuity_errors == 0


def test_media_on_odd_and_empty_input(spark, odd, none):
    rows = {r["doc_id"]: r for r in media.media_features(media.with_media(odd)).collect()}
    for i, t in enumerate(ODD):
        raw = (t or "").encode()
        want = media.aligned(raw)
        assert (rows[i]["n_bytes"], rows[i]["payload_bytes"], rows[i]["payload_sha256"], rows[i]["tail_crc32"]) == (len(raw), len(want), hashlib.sha256(want).hexdigest(), zlib.crc32(want[-64:]))
    assert rows[8]["media_sha256"] == rows[9]["media_sha256"] and rows[0]["feature"] == rows[1]["feature"]
    assert media.media_features(media.with_media(none)).count() == 0


# 9 licences


def test_licences_by_line_and_paragraph(spark, none):
    notice = license.TEMPLATES["BSD-text"]
    half = len(notice) // 2
    cut = notice.index(" ", half)
    texts = ["Some prose.\nReleased under the MIT License.\nMore.", notice[:cut] + "\n" + notice[cut + 1 :], "ALL RIGHTS RESERVED", "released under the bsd license", None, "", "all rights\n\nreserved", "All rights reserved.\nAll rights reserved!"]
    got = {(r["doc_id"], r["license"]): (r["dice"], r["n_units"]) for r in license.scan(docs_of(spark, texts)).collect()}
    assert got == {(0, "MIT"): (1.0, 1), (1, "BSD-text"): (1.0, 1), (2, "proprietary"): (1.0, 1), (7, "proprietary"): (1.0, 3)}  # two lines and their paragraph
    assert license.scan(none).count() == 0


def test_licences_equal_sql(spark, sf_dir):
    import duckdb

    c = duckdb.connect()
    c.sql(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    got = QUERIES["op9_license"](spark, sf_dir)
    want = c.sql(ORACLE_SQL["op9_license"])
    assert sorted(map(tuple, got.select(sorted(got.columns)).collect())) == sorted(tuple(r) for r in want.project(", ".join(sorted(want.columns))).fetchall())


# 10 pieces


def test_pieces_equal_the_library_and_round_trip(spark, odd, none):
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [t or "" for t in ODD] + ["aaaaaaaaaa bbbb", " lead", "tail ", "1234567890 ---- !!!!", "<s> </s> <0x41>", prose(300, 4)]
    codec = sentencepieces.PieceCodec(path)
    for t, raw in zip(texts, codec.encode(texts)):
        ids = np.frombuffer(raw, "<u4")
        assert ids.tolist() == lib.encode(t)
        assert codec.decode(ids) == t
    rows = {r["doc_id"]: r for r in sentencepieces.digest(odd, path).collect()}
    assert rows[5]["n_tokens"] == len(lib.encode(ODD[5])) and all(r["round_trip"] for r in rows.values())
    back = {r["doc_id"]: r["text"] for r in sentencepieces.decode(sentencepieces.encode(odd, path), path).collect()}
    assert back[7] == LONG and sentencepieces.digest(none, path).count() == 0


def test_unigram_states_are_shared_and_best():
    v = sentencepieces.Vocabulary.__new__(sentencepieces.Vocabulary)
    pieces = {"▁a": -1.0, "b": -2.0, "ab": -2.5, "▁": -3.0, "a": -2.0, "bb": -1.0}
    v.pieces, v.scores, v.kinds = list(pieces), list(pieces.values()), [1] * len(pieces)
    v.ids, v.bytes, v.unknown, v.merges, v.longest = {p: i for i, p in enumerate(pieces)}, {}, 0, False, 2
    got = dict(sentencepieces.TrieViterbi(v).segment(["▁ab", "▁abb"]))
    assert np.frombuffer(got["▁abb"], "<u4").tolist() == [v.ids["▁a"], v.ids["bb"]]
    assert np.frombuffer(got["▁ab"], "<u4").tolist() == [v.ids["▁a"], v.ids["b"]]
