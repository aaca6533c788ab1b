"""Byte-level BPE encoding by words, with the tokenizers library behind a bounded cache.

A byte-level BPE splits a text into pre-tokens before it merges anything, and no pre-token
reaches from a non-space character into white space that follows it. So a text may be cut
before each white-space run and the cuts' ids concatenated; frequent words are then encoded
once per task instead of once per occurrence. Line feeds that are pre-tokens of their own cut
a text likewise.
"""

from __future__ import annotations

import re

import numpy as np
from tokenizers import Tokenizer

#: White space other than spaces and line feeds.
_ODD = "\t\v-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WS = "\n " + _ODD
#: White space that does not fall apart into single characters: before a space, three in a row, or two that end a text.
_RUNS = re.compile(f"[{_WS}](?: |[{_WS}][{_WS}]|[{_WS}]\\Z)")
_ODD_SPACE = re.compile(f"[{_ODD}]")
#: Texts whose pre-tokens show that a line feed stands apart, alone or beside one other white space.
_FEEDS = ("a\nb", "a.\nb", "a\n.b", "a\n\nb", "a \nb", "1\n2", "é\nÉ")
#: A word whose pre-tokens are plain to see: letters, then marks other than an apostrophe.
_SIMPLE = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*)([!-&(-/:-@[-`{-~]*)")
_CHUNKS = re.compile(f"[{_WS}]*[^{_WS}]+|[{_WS}]+")


class Recent:
    """A cache of two generations: the older one is dropped when the younger is full."""

    def __init__(self, limit: int) -> None:
        self.limit, self.new, self.old = limit, {}, {}

    def put(self, key, value) -> None:
        if len(self.new) >= self.limit:
            self.old, self.new = self.new, {}
        self.new[key] = value


class WordEncoder:
    """Token ids of whole texts, as little-endian unsigned 32-bit bytes.

    ``cache_words`` bounds each generation of each cache; it changes speed only.
    """

    def __init__(self, path: str, cache_words: int = 250_000) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.model, self.pre = self.tokenizer.model, self.tokenizer.pre_tokenizer
        self.direct = self.tokenizer.normalizer is None and self.pre is not None
        self.easy = self.direct and not any(_SIMPLE.fullmatch(s) for s in self.specials)
        # how the pre-tokenizer writes each byte; a space before a word is part of its pre-token
        self.marks = {ord(c): self._mark(c) for c in map(chr, range(33, 256)) if c not in "\x7f\x80" and self.direct}
        self.space = self._mark(" .")[:-1] if self.direct else ""
        self.feed = self._feed() if self.direct else ""
        self.code = [k.to_bytes(4, "little") for k in range(self.tokenizer.get_vocab_size(with_added_tokens=True))]
        self.pieces, self.words, self.chunks = Recent(cache_words), Recent(cache_words), Recent(cache_words // 8)

    def _mark(self, text: str) -> str:
        return "".join(p for p, _ in self.pre.pre_tokenize_str(text))

    def _feed(self) -> str:
        """The line feed's own pre-token, or nothing where the pre-tokenizer joins it to what surrounds it."""
        feed = self._mark("\n")
        apart = all([p for p, _ in self.pre.pre_tokenize_str(t)].count(feed) == t.count("\n") for t in _FEEDS)
        return feed if apart else ""

    def _piece(self, piece: str) -> bytes:
        """Ids of one pre-token."""
        held = self.pieces
        ids = held.new.get(piece)
        if ids is None:
            ids = held.old.get(piece)
            if ids is None:
                code = self.code
                ids = b"".join([code[t.id] for t in self.model.tokenize(piece)])
            held.put(piece, ids)
        return ids

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a stretch of text that pre-tokenizing alone cuts up."""
        held = self.chunks
        ids = held.new.get(chunk)
        if ids is None:
            if not chunk:
                ids = b""
            elif not self.direct or any(s in chunk for s in self.specials):
                ids = np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()
            else:
                ids = b"".join([self._piece(p) for p, _ in self.pre.pre_tokenize_str(chunk)])
            held.put(chunk, ids)
        return ids

    def _word(self, word: str) -> bytes:
        """Ids of a word after a space, or of a line's first word after its line feed."""
        ids = self.words.old.get(word)
        if ids is not None:
            return ids
        head, before, space = b"", " ", self.space
        if word[:1] == "\n":
            head, before, space, word = self._piece(self.feed), "", "", word[1:]
            if not word:
                return head
        if not self.easy:
            return head + self._chunk(before + word)
        if word.isascii() and word.isalpha():
            return head + self._piece(space + word)
        m = _SIMPLE.fullmatch(word)
        if not m or not word:
            return head + self._chunk(before + word)
        letters, marks = m.groups()
        if not letters:
            return head + self._piece(space + marks)
        ids = self._piece(space + (letters if letters.isascii() else letters.translate(self.marks)))
        return head + ids + self._piece(marks) if marks else head + ids

    def _whole_runs(self, text: str) -> bool:
        """Whether white space must be encoded together with what surrounds it."""
        if any(map(text.__contains__, "\t\v\f\r")) if text.isascii() else _ODD_SPACE.search(text):
            return _RUNS.search(text) is not None
        return "  " in text or "\n " in text or "\n\n\n" in text or " \n\n" in text or text.endswith(("\n\n", " \n"))

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if self._whole_runs(text) or any(s in text for s in self.specials):
            return b"".join(map(self._chunk, _CHUNKS.findall(text)))
        words, held = (text.replace("\n", " \n") if self.feed else text).split(" "), self.words
        out = list(map(held.new.get, words))
        out[0] = self._chunk(words[0])  # the text's first word has no space before it
        if None in out:
            for i in [i for i, ids in enumerate(out) if ids is None]:
                word = words[i]
                ids = held.new.get(word)
                if ids is None:
                    ids = self._word(word)
                    held.put(word, ids)
                out[i] = ids
        return b"".join(out)


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per Python worker and vocabulary file."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def vocabulary_size(path: str) -> int:
    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)
