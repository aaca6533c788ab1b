"""SentencePiece encoding and decoding by a Viterbi pass over a trie of distinct words.

A text becomes marked words: spaces are written as a mark, one mark is put before the text,
and the text is cut before each run of marks, where no piece of the vocabulary reaches
across. A batch's distinct words are sorted, which lays out their trie depth first; the pass
keeps a stack of forward states, one for each prefix, and a word starts from the states of
the prefix it shares with the word before.

The state of a prefix is the last piece of the prefix's segmentation and where it begins.
For a unigram model it is the piece that gives the best score sum. For a merge (BPE) model
the score of an extension is all or nothing: a piece may follow another exactly if merging
the two pieces' characters gives the two pieces back, and exactly one piece may end a prefix.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .wordbpe import Recent

MARK = "▁"
#: Bytes of text whose distinct words share one trie.
TRIE_BYTES = 4 << 20
_WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Vocabulary:
    """Pieces, scores and kinds of a model file (a protocol buffer), read without the library."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            data = f.read()
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        self.merges, self.prefix, self.squeeze = False, True, True
        for field, value in self._fields(data):
            if field == 1:
                own = dict(self._fields(value))
                self.pieces.append(own[1].decode())
                self.scores.append(float(np.frombuffer(own.get(2, b"\0\0\0\0"), "<f4")[0]))
                self.kinds.append(own.get(3, 1))
            elif field == 2:
                self.merges = dict(self._fields(value)).get(3, 1) == 2
            elif field == 3:
                own = dict(self._fields(value))
                self.prefix, self.squeeze = bool(own.get(3, 1)), bool(own.get(4, 1))
                if own.get(2):
                    raise ValueError("models with a normalisation table are not supported")
        self.ids = {p: i for i, p in enumerate(self.pieces) if self.kinds[i] in (1, 4)}
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if self.kinds[i] == 6}
        self.unknown = self.kinds.index(2) if 2 in self.kinds else 0
        self.longest = max(map(len, self.ids), default=1)
        inner = [p for p in self.ids if MARK in p.lstrip(MARK)]
        if inner:
            raise ValueError(f"pieces reach across a mark: {inner[:3]}")

    @staticmethod
    def _fields(data: bytes) -> Iterator[tuple[int, bytes | int]]:
        at, end = 0, len(data)

        def number() -> int:
            nonlocal at
            n = shift = 0
            while True:
                b = data[at]
                at += 1
                n |= (b & 127) << shift
                if b < 128:
                    return n
                shift += 7

        while at < end:
            field, kind = divmod(number(), 8)
            if kind == 0:
                yield field, number()
                continue
            size = {1: 8, 5: 4}.get(kind) or number()
            yield field, data[at : at + size]
            at += size


class TrieViterbi:
    """Segments sorted words, reusing the forward states of common prefixes."""

    def __init__(self, vocabulary: Vocabulary, pairs: int = 400_000) -> None:
        self.v, ids = vocabulary, vocabulary.ids
        self.code = {k: np.array([k], "<u4").tobytes() for k in ids.values()}
        self.least = min(vocabulary.scores, default=0.0) - 10
        self.fitting = Recent(pairs)
        # by a prefix's last two characters, the lengths of pieces that may end there, longest first
        sizes: dict[str, set[int]] = {}
        for p in ids:
            if len(p) > 1:
                sizes.setdefault(p[-2:], set()).add(len(p))
        self.sizes = {k: (*sorted(v, reverse=True), 1) for k, v in sizes.items()}

    def _merged(self, text: str) -> list[str]:
        """Merge neighbouring parts, best-scored piece first, leftmost on ties."""
        parts, ids, scores = list(text), self.v.ids, self.v.scores
        while len(parts) > 1:
            best, where = None, -1
            for i in range(len(parts) - 1):
                k = ids.get(parts[i] + parts[i + 1])
                if k is not None and (best is None or scores[k] > best):
                    best, where = scores[k], i
            if where < 0:
                break
            parts[where : where + 2] = [parts[where] + parts[where + 1]]
        return parts

    def _fits(self, pair: int) -> bool:
        """Whether merging keeps the boundary between two pieces; -1 stands for a word's or wall's edge."""
        fits = self.fitting.old.get(pair)
        if fits is None:
            before, k = divmod(pair, len(self.v.pieces))
            own = [self.v.pieces[k]] if before < 0 else [self.v.pieces[before], self.v.pieces[k]]
            fits = self._merged("".join(own)) == own
        self.fitting.put(pair, fits)
        return fits

    def _other(self, char: str) -> bytes:
        """Ids of a character that no piece holds."""
        v = self.v
        return np.array([v.bytes[b] for b in char.encode("utf-8", "surrogatepass")] if v.bytes else [v.unknown], "<u4").tobytes()

    def segment(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """Each of the sorted distinct words with its ids as little-endian unsigned 32-bit bytes."""
        step = self._merge_states if self.v.merges else self._best_states
        code, before = self.code, ""
        states: list[tuple[int, int, float]] = [(0, -1, 0.0)]  # where the last piece begins, its id or -1, score sum
        for word in words:
            same = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                same += 1
            del states[same + 1 :]
            step(word, same + 1, states)
            before, at, out = word, len(word), []
            while at:
                begin, k, _ = states[at]
                out.append(code[k] if k >= 0 else self._other(word[begin:at]))
                at = begin
            out.reverse()
            yield word, b"".join(out)

    def _merge_states(self, word: str, first: int, states: list) -> None:
        get, fitting, sizes, n = self.v.ids.get, self.fitting, self.sizes, len(self.v.pieces)
        for end in range(first, len(word) + 1):
            for size in sizes.get(word[end - 2 : end] if end > 1 else word[0], (1,)):
                begin = end - size
                if begin < 0:
                    continue
                k = get(word[begin:end])
                if k is None:
                    if size == 1:
                        states.append((begin, -1, 0.0))
                        break
                    continue
                pair = states[begin][1] * n + k
                fits = fitting.new.get(pair)
                if fits or fits is None and self._fits(pair):
                    states.append((begin, k, 0.0))
                    break
            else:  # merging the whole prefix decides
                last = self._merged(word[:end])[-1]
                states.append((end - len(last), get(last, -1), 0.0))

    def _best_states(self, word: str, first: int, states: list) -> None:
        ids, scores = self.v.ids, self.v.scores
        for end in range(first, len(word) + 1):
            best = None
            for size in self.sizes.get(word[end - 2 : end] if end > 1 else word[0], (1,)):
                begin = end - size
                k = ids.get(word[begin:end]) if begin >= 0 else None
                if begin < 0 or k is None and size > 1:
                    continue
                total = states[begin][2] + (self.least if k is None else scores[k])
                if best is None or total > best[2]:
                    best = (begin, -1 if k is None else k, total)
            states.append(best)


class PieceCodec:
    """Encodes batches of texts and decodes ids."""

    def __init__(self, path: str, keep_words: int = 300_000) -> None:
        self.v = Vocabulary(path)
        self.trie = TrieViterbi(self.v)
        self.keep, self.known, self.older = keep_words, {}, {}
        self.by_id = [bytes([int(p[3:5], 16)]) if k == 6 else b"" if k == 3 else p.replace(MARK, " ").encode() for p, k in zip(self.v.pieces, self.v.kinds)]

    def marked(self, text: str) -> str:
        if self.v.squeeze:
            text = " ".join(x for x in text.split(" ") if x)
        if not text:
            return ""
        return (MARK if self.v.prefix else "") + text.replace(" ", MARK)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit bytes."""
        known, older = self.known, self.older
        cut = [self._cut(t) for t in texts]
        fresh = set().union(*cut).difference(known)
        for word in [w for w in fresh if w in older]:
            known[word] = older[word]
            fresh.discard(word)
        known.update(self.trie.segment(sorted(fresh)))
        out = [b"".join([known[w] for w in words]) for words in cut]
        if len(known) > self.keep:
            self.known, self.older = {}, known
        return out

    def _cut(self, text: str) -> list[str]:
        """Marked words; texts whose marks stand alone are cut by plain splitting."""
        if self.v.squeeze or not self.v.prefix or not text or MARK in text or "  " in text or text[0] == " " or text[-1] == " ":
            return _WORDS.findall(self.marked(text))
        return (MARK + text.replace(" ", " " + MARK)).split(" ")

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; a mark that encoding put before the text is taken off."""
        table = self.by_id
        text = b"".join([table[i] for i in ids.tolist()]).decode("utf-8", "replace")
        return text[1:] if self.v.prefix and text[:1] == " " else text


_codecs: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    if path not in _codecs:
        _codecs[path] = PieceCodec(path)
    return _codecs[path]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of so many batches as share a trie."""
    ids, texts, size = [], [], 0
    for batch in batches:
        ids += batch.column(0).to_pylist()
        got = common.texts_of(batch, "text")
        texts += got
        size += sum(map(len, got))
        if size >= TRIE_BYTES:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def encode(docs: DataFrame, model: str, text_col: str = "text") -> DataFrame:
    """doc_id, text and ids (array<int>), a row for each input row; null text counts as empty, without ids."""

    def run(batches):
        for ids, texts in _groups(batches):
            rows = [np.frombuffer(b, "<u4").astype(np.int32) for b in codec(model).encode(texts)]
            for i in range(0, len(ids), common.BATCH_ROWS):
                j = i + common.BATCH_ROWS
                yield pa.RecordBatch.from_arrays([pa.array(ids[i:j], pa.int64()), pa.array(texts[i:j], pa.string()), pa.array(rows[i:j], pa.list_(pa.int32()))], names=["doc_id", "text", "ids"])

    return common.map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text_col).alias("text")), "doc_id long, text string, ids array<int>", run)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id and text from doc_id and ids."""

    def run(batches):
        for batch in batches:
            texts = [codec(model).decode(np.asarray(x if x is not None else [], np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return common.map_arrow(encoded.select("doc_id", "ids"), "doc_id long, text string", run)


def digest(docs: DataFrame, model: str, text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_crc32 and whether decoding the ids gives the whole text back."""

    def run(batches):
        own = codec(model)
        for ids, texts in _groups(batches):
            rows = own.encode(texts)
            back = [own.decode(np.frombuffer(b, "<u4")) == t for b, t in zip(rows, texts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(b) // 4 for b in rows], pa.int64()), pa.array([zlib.crc32(b) for b in rows], pa.int64()), pa.array(back, pa.bool_())],
                names=["doc_id", "n_tokens", "ids_crc32", "round_trip"],
            )

    return common.map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text_col).alias("text")), "doc_id long, n_tokens long, ids_crc32 long, round_trip boolean", run)
