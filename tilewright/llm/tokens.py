"""Token ids of many texts with the tokenizers library, each distinct word encoded once per worker.

Both vocabularies split a text into words before merging, and merge inside a word only. So a text is
cut where the library would cut it, known words are looked up, and only new ones go through the
library's model. Texts with anything unusual (characters beyond Latin, control characters, spellings
of special tokens) are encoded by the library as a whole. Results are those of ``encode``.
"""

from __future__ import annotations

import re
from array import array

import public_tokenizers
from tokenizers import Tokenizer

#: Words a worker remembers per vocabulary; beyond it starts anew.
REMEMBERED = 800_000

# The word patterns of the two vocabularies, for characters up to U+024F.
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_NUMBER = "0-9²³¹¼-¾"
BYTE_WORDS = re.compile(
    rf"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^\s{_LETTER}{_NUMBER}]+|\s+(?!\S)|\s+"
)
LOWER_WORDS = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{_LETTER}]+|[{_NUMBER}]|[^\s{_LETTER}{_NUMBER}]+")
_PLAIN = {9: " ", 10: " ", 13: " "}
_UNUSUAL = re.compile("[^\t\n\r -~¡-įı-ɏ]|<\\|")


def _unusual(text: str) -> bool:
    if text.isascii():
        return "<|" in text or not text.translate(_PLAIN).isprintable()
    return _UNUSUAL.search(text) is not None


def _single_spaces(text: str) -> bool:
    """Every white space character is one space or line feed between two other characters."""
    ends = text[0] in " \n" or text[-1] in " \n"
    return not (ends or "  " in text or "\n\n" in text or " \n" in text or "\n " in text or "\t" in text or "\r" in text)


class Encoder:
    """``ids(text)``: the ids as uint32 bytes of the machine's (little-endian) order, without special tokens."""

    def __init__(self, vocabulary: str):
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self.lower = self.tokenizer.normalizer is not None
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.space = "" if self.lower else self.tokenizer.pre_tokenizer.pre_tokenize_str(" a")[0][0][:-1]
        self.letters: dict[int, str] = {} if self.lower else {ord(" "): self.space}

    def _written(self, word: str) -> str:
        """The word in the byte-level alphabet: printable ASCII is itself, the rest is asked from the library."""
        if word.isascii() and word.isprintable():
            return word.replace(" ", self.space)
        for c in word:
            if ord(c) not in self.letters:
                parts = self.tokenizer.pre_tokenizer.pre_tokenize_str(c)
                self.letters[ord(c)] = "".join(part for part, _ in parts)
        return word.translate(self.letters)

    def _word(self, word: str) -> bytes:
        known = self.words.get(word)
        if known is None:
            known = array("I", [t.id for t in self.tokenizer.model.tokenize(self._written(word))]).tobytes()
            if len(self.words) >= REMEMBERED:
                self.words.clear()
            self.words[word] = known
        return known

    def _chunk(self, chunk: str) -> bytes:
        """Ids of what stands between two spaces; for the byte-level vocabulary, with the space before it."""
        if self.lower:
            words = LOWER_WORDS.findall(chunk.lower())
        else:
            words = BYTE_WORDS.findall(chunk if chunk[0] == "\n" else " " + chunk)
        known = b"".join([self._word(w) for w in words])
        if len(self.chunks) >= REMEMBERED:
            self.chunks.clear()
        self.chunks[chunk] = known
        return known

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if _unusual(text):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        head = b""
        if self.lower:
            chunks = text.split()
        elif not _single_spaces(text):
            return b"".join([self._word(w) for w in BYTE_WORDS.findall(text)])
        else:
            # one space, or one line feed, between two other characters always begins a word
            chunks = text.replace("\n", " \n").split(" ")
            head = b"".join([self._word(w) for w in BYTE_WORDS.findall(chunks[0])])
            del chunks[0]
        get = self.chunks.get
        found = [get(c) for c in chunks]
        if None in found:
            found = [self._chunk(c) if f is None else f for c, f in zip(chunks, found)]
        return head + b"".join(found)


_encoders: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]
