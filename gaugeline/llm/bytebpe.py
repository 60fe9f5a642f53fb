"""Byte-level BPE with a cache of encoded pieces.

The pre-tokeniser never joins text across a single space or line break between two other
characters, so the pieces between them are encoded once and joined as bytes. Texts with any
other white space are cut only before a space that a visible character follows.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache
from itertools import filterfalse

import numpy as np

CACHED = 150_000
_ODD = re.compile(
    r"\s\s|^\s|\s\Z|[\x00-\x09\x0b-\x1f\x7f-\xa0 ᠎ -‏ -  -⁯　﻿]")
_VISIBLE = re.compile(r" (?=[!-~À-ɏ])")

#: A Latin word and the marks after it: two pre-tokens, which many pieces share.
_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ɏ]+)([.,;:!?*%#$&|]*)\Z")


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _letters() -> list[tuple[str, str]]:
    """The letter that byte-level BPE writes for each byte but the line break: visible Latin-1 stands for itself, the others follow from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [(chr(b), chr(256 + n)) for n, b in enumerate(hidden) if b != 10]


class Known:
    """Ids of pieces in two generations: when the new one is full it becomes the old one, from which what is met again is taken over."""

    def __init__(self):
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def missing(self, wanted: set[str]) -> list[str]:
        """Pieces of `wanted` in neither generation; all others are in the new one afterwards."""
        absent = list(filterfalse(self.new.__contains__, wanted))
        if len(self.new) + len(absent) > CACHED:
            self.old, self.new, absent = self.new, {}, list(wanted)
        old, new, missing = self.old, self.new, []
        for piece in absent:
            ids = old.get(piece)
            if ids is None:
                missing.append(piece)
            else:
                new[piece] = ids
        return missing


class PieceEncoder:
    """Encodes texts to little-endian 16-bit ids, as bytes.

    With `special`, the strings of added tokens that occur in a text become their reserved ids, as the plain
    tokenizer does; without it they are encoded like any other text.
    """

    def __init__(self, path: str, special: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if special else []
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids must fit 16 bits")
        self.letters = _letters()
        self.marks: dict[str, bytes] = {"": b""}
        self.first, self.spaced = Known(), Known()
        self.line = self._ids(["\n"])[0]

    def _ids(self, pieces: list[str]) -> list[bytes]:
        made = []
        for at in range(0, len(pieces), 4000):  # encodings are far larger than their ids
            found = self.tokenizer.encode_batch_fast(pieces[at:at + 4000], add_special_tokens=False)
            made += [np.array(e.ids, "<u2").tobytes() for e in found]
        return made

    def _cut(self, text: str) -> list[list[str]]:
        flat = text.replace("\n", " ")  # first a quick test that most texts pass
        plain = flat.isprintable() and "  " not in flat and flat[:1] != " " and flat[-1:] != " "
        if not plain and _ODD.search(text):
            return [_VISIBLE.split(text)]
        return [line.split(" ") for line in text.split("\n")]

    def _word_ids(self, words: list[str]) -> list[bytes]:
        """Ids of words that are one pre-token each: the model's own step on their bytes, spelled as its letters."""
        spelled = "\n".join(words).encode("utf-8", "surrogatepass").decode("latin-1")
        for byte, letter in self.letters:
            spelled = spelled.replace(byte, letter)  # far quicker than `translate`
        step = self.tokenizer.model.tokenize
        return [array("H", [t.id for t in step(word)]).tobytes() for word in spelled.split("\n")] if words else []

    def _learn(self, known: Known, wanted: set[str], before: str) -> None:
        odd, parts = [], []
        for piece in known.missing(wanted):
            found = _WORD.match(piece)
            if found:
                parts.append((piece, *found.groups()))
            else:
                odd.append(piece)
        new = known.new
        new.update(zip(odd, self._ids([before + m for m in odd])))
        words = list({word for _, word, _ in parts if word not in new})
        new.update(zip(words, self._word_ids([before + w for w in words])))
        marks = list({tail for _, _, tail in parts if tail not in self.marks})
        self.marks.update(zip(marks, self._ids(marks)))
        for piece, word, tail in parts:
            new[piece] = new[word] + self.marks[tail]

    def encode(self, texts: list[str]) -> list[bytes]:
        if any(token in text for token in self.added for text in texts):
            whole = [any(token in text for token in self.added) for text in texts]
            plain = iter(self.encode([t for t, w in zip(texts, whole) if not w]))
            return [self._ids([t])[0] if w else next(plain) for t, w in zip(texts, whole)]
        cut = [self._cut(t) for t in texts]
        self._learn(self.first, {line[0] for lines in cut for line in lines}, "")
        wanted: set[str] = set()
        for lines in cut:
            for line in lines:
                wanted.update(line[1:])
        self._learn(self.spaced, wanted, " ")
        first, spaced = self.first.new, self.spaced.new.__getitem__
        return [self.line.join([first[line[0]] + b"".join(map(spaced, line[1:])) for line in lines]) for lines in cut]

    def decode(self, ids: np.ndarray) -> str:
        return self.tokenizer.decode(ids.tolist(), skip_special_tokens=False)


@lru_cache(maxsize=2)
def encoder(path: str, special: bool = False) -> PieceEncoder:
    """One per Python worker."""
    return PieceEncoder(path, special)
