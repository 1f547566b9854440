"""Vocabulary files of byte-level BPE, and texts cut into chunks that can be encoded one by one.

Both operators that use them split texts by the pattern of the byte-level vocabularies. No match
of it spans the place before a blank that follows a character other than white space and precedes
one, so a text may be cut at such blanks, each going with what follows. Chunks repeat far more
than texts, so each is encoded once and remembered for a while.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from array import array
from collections.abc import Callable

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer

# Fixed value: how byte-level vocabularies cut a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MEMORY = 150_000  # values of a generation that a task remembers; it keeps two
LARGE = 400_000  # of a task that is to remember much
WHOLE = 100_000  # characters of a text that the library's search takes at once; it fails on longer blanks
# White space before and after a blank, where a cut could change the matches.
_AWKWARD = re.compile(r"\s (?:\s|\Z)|\A (?:\s|\Z)")
_RARE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]


def compiled(pattern: str):
    """The pattern with white space as Unicode has it, which is how the libraries read it."""
    return regex.compile(
        pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
    )


def chunks(text: str) -> list[str] | None:
    """The chunks of a text without the blanks that begin all but the first, or None where it
    cannot be cut so."""
    cut = text.split(" ")
    doubtful = (
        "" in cut
        or any(line.endswith(" ") for line in text.split("\n"))
        or any(c in text for c in _RARE)
    )
    return None if doubtful and _AWKWARD.search(text) else cut


def words_of(chunk: str, find: Callable[[str], list[str]]) -> list[str]:
    """The pattern's matches in a chunk and the blank before it; plain cases without a search."""
    if chunk.isascii():
        if chunk.isalpha():
            return [" " + chunk]
        if chunk[-1:] in (".", ",") and chunk[:-1].isalpha():
            return [" " + chunk[:-1], chunk[-1]]
    return find(" " + chunk)


class Remembered(dict):
    """Values by key, computed when first asked for. When there are many, those not asked for again
    are forgotten."""

    def __init__(self, make: Callable[[str], object], most: int = MEMORY):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key: str):
        value = self.old.pop(key, None)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def _alphabet() -> dict[int, str]:
    """The character by which byte-level vocabularies write each byte: its own where that is a
    visible one of Latin-1, else the next from 256 on."""
    seen, other = {}, 256
    for byte in range(256):
        visible = byte > 32 and unicodedata.category(chr(byte)) not in ("Cc", "Cf", "Zs")
        seen[byte] = chr(byte if visible else other)
        other += not visible
    return seen


def _by_rank(form: dict, model):
    """The core of a library that merges by rank, several times faster than ``tokenizers``; None
    where a vocabulary's ids are not its ranks, or a token is not what its own bytes merge to."""
    model_form = form["model"]
    vocabulary, odd = model_form["vocab"], ("dropout", "continuing_subword_prefix", "end_of_word_suffix")
    byte_of = {c: b for b, c in _alphabet().items()}
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model_form["merges"]]
    tokens = [*byte_of, *map("".join, pairs)]
    ids = [vocabulary.get(t) for t in tokens]
    merged = ids[len(byte_of) :]
    if (
        any(model_form.get(name) for name in odd)
        or None in ids
        or any(a >= b for a, b in zip(merged, merged[1:]))
        or any(len(model.tokenize(t)) != 1 for t in tokens)
    ):
        return None
    ranks = {bytes(map(byte_of.__getitem__, t)): i for t, i in zip(tokens, ids)}
    encoding = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return encoding._core_bpe


class ChunkTokenizer:
    """Ids as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them, for byte-level files."""

    def __init__(self, path: str, most: int = MEMORY):
        self.tokenizer = Tokenizer.from_file(path)
        form = json.loads(self.tokenizer.to_str())
        cut = form["pre_tokenizer"] or {}
        if form["normalizer"] or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space"):
            raise ValueError(f"{path} is no plain byte-level vocabulary")
        self.special = [
            t.content for t in self.tokenizer.get_added_tokens_decoder().values()
        ]
        self.find, self.alphabet = compiled(PATTERN).findall, _alphabet()
        self.model = self.tokenizer.model
        self.core = _by_rank(form, self.model)
        self.by_rank = self.core and self.core.encode_single_piece
        self.words = Remembered(self._of_word, most)
        self.remembered = Remembered(self._of_chunk, most * 3 // 4)

    @staticmethod
    @functools.cache
    def of(path: str, most: int = MEMORY) -> ChunkTokenizer:
        """The one of this process, which keeps what it remembers from task to task."""
        return ChunkTokenizer(path, most)

    def forget(self) -> None:
        for remembered in (self.words, self.remembered):
            remembered.clear()
            remembered.old = {}

    def _of_word(self, word: str) -> bytes:
        if self.by_rank:
            return array("I", self.by_rank(word.encode())).tobytes()
        if word.isascii() and word[1:].isalpha() and word[0] == " ":
            plain = self.alphabet[32] + word[1:]
        else:
            plain = word.encode().decode("latin-1").translate(self.alphabet)
        return array("I", [t.id for t in self.model.tokenize(plain)]).tobytes()

    def _of_chunk(self, chunk: str) -> bytes:
        return b"".join(map(self.words.__getitem__, words_of(chunk, self.find)))

    def _matches(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.find(text)))

    def encode(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return np.array(ids, "<u4")
        cut = chunks(text)
        if cut is None:
            data = self._matches(text)
        else:
            data = self._matches(cut[0]) + b"".join(map(self.remembered.__getitem__, cut[1:]))
        return np.frombuffer(data, "<u4")

    def encode_at_once(self, text: str) -> np.ndarray:
        """As ``encode``; a text that is not too long goes through the library as a whole, which takes half
        the time where many words are rare, and remembers nothing."""
        if not self.core or len(text) > WHOLE or any(s in text for s in self.special):
            return self.encode(text)
        return np.array(self.core.encode_ordinary(text), "<u4")
