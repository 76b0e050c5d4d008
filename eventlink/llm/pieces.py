"""Exact token ids of whole texts from cached pieces.

A text is cut at single spaces.  Where a byte-level vocabulary glues a space to
the word behind it, a cut is made only between two printable characters: no
pre-token of these vocabularies crosses such a place, so the ids of the whole
text are the ids of the pieces, one after the other.  Pieces next to any other
white space, control or format character stay together and go to the library as
they are.  The library encodes every piece that is not held: a word of plain
letters, which normalizer and pre-tokenizer leave in one part, by its model
alone, all else by the whole of it.  A worker holds pieces of up to 64 characters up to a
bound, the recent ones longest.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable
from functools import lru_cache

from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

HELD = 400_000
#: Longer pieces (unspaced scripts, packed code) are never held.
HELD_CHARS = 64
#: Letters that every Unicode version counts as such, and marks that form one
#: pre-token between letters.
LETTERS, MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", ".,;:!?"
PLAIN = re.compile(rf"([{LETTERS}]+)([{MARKS}]*)(?:(\n)([{LETTERS}]+)([{MARKS}]*))?")

LETTERS_ONLY = re.compile(rf"[{LETTERS}]+")


class Unsure(Exception):
    """A piece whose edges are no safe place to cut."""


class Held(dict):
    """``make(key)`` by key.  At the bound the younger generation becomes the
    older one, and what the older one held unused is forgotten; ``fixed``
    entries stay.  Long keys are made anew each time, so that the bound on
    entries is one on bytes; so is a key whose ``make`` sets ``once``."""

    def __init__(self, make: Callable, bound: int = HELD, fixed: dict | None = None):
        super().__init__(fixed or {})
        self.make, self.bound, self.fixed, self.old = make, bound + len(self), fixed or {}, {}
        self.once = False

    def __missing__(self, key):
        if isinstance(key, str) and len(key) > HELD_CHARS:
            return self.make(key)
        value = self.old.pop(key, None)
        if value is None:
            value = self.make(key)
            if self.once:
                self.once = False
                return value
        if len(self) >= self.bound:
            self.old = dict(self)
            self.clear()
            self.update(self.fixed)
        self[key] = value
        return value


def sure(piece: str) -> bool:
    return piece != "" and piece[0].isprintable() and piece[-1].isprintable()


class Pieces:
    """Ids (or counts of ids) by text.  ``glued``: the vocabulary keeps a space
    with the word behind it; otherwise it drops white space and lower-cases."""

    def __init__(self, path: str, glued: bool, counts: bool = False, fixed: dict | None = None):
        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        self.glued, self.counts, self.model = glued, counts, self.library.model
        self.none = 0 if counts else b""
        # how the model spells each letter's bytes, and the space before a word; a table
        # that lacks a letter of the word costs more than one that has it
        spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelled = {c: spell(chr(c))[0][0] for c in [*range(65, 91), *range(97, 123), *range(192, 256)]}
        self.space = spell(" ")[0][0] if glued else ""
        self.spaced = Held(self._spaced, fixed=fixed)
        self.bare = Held(self._bare)

    def encoded(self, text: str):
        ids = self.library.encode(text, add_special_tokens=False).ids
        return len(ids) if self.counts else array("I", ids).tobytes()

    def _spaced(self, piece: str):
        """A piece behind a space."""
        if piece.isascii() and piece.isalpha():  # most misses
            return self._word(piece, self.space)
        m = PLAIN.fullmatch(piece)
        if not m:
            if self.glued and not sure(piece):
                raise Unsure
            return self.encoded(" " + piece if self.glued else piece)
        if not m[2] and not m[3]:
            return self._word(piece, self.space)
        new = m[1] not in self.spaced
        value = self.spaced[m[1]] + (self.bare[m[2]] if m[2] else self.none)
        if m[3]:
            value += self.bare["\n"] + self.bare[m[4]] + (self.bare[m[5]] if m[5] else self.none)
        # around a word met for the first time, or a pair of words, the piece is likely as rare: its parts are held
        self.spaced.once = new or m[3] is not None
        return value

    def _bare(self, piece: str):
        """A piece that nothing is glued to."""
        return self._word(piece, "") if LETTERS_ONLY.fullmatch(piece) else self.encoded(piece)

    def _word(self, word: str, before: str):
        """Plain letters, by the model."""
        if not self.glued:
            word = word.lower()
        if not word.isascii():
            word = word.translate(self.spelled)
        ids = [t.id for t in self.model.tokenize(before + word)]
        return len(ids) if self.counts else array("I", ids).tobytes()

    def _joined(self, values):
        return sum(values) if self.counts else b"".join(values)

    def _merged(self, pieces: list[str]):
        """As :meth:`of`, with the pieces between unsafe cuts put together."""
        groups = [[pieces[0]]]
        for before, piece in zip(pieces, pieces[1:]):
            if sure(before) and sure(piece):
                groups.append([piece])
            else:
                groups[-1].append(piece)
        values = [self.encoded(" ".join(groups[0]))]
        for g in groups[1:]:
            values.append(self.spaced[g[0]] if len(g) == 1 else self.encoded(" " + " ".join(g)))
        return self._joined(values)

    def of(self, text: str):
        if not text:
            return self.none
        if not self.glued:
            if "<|" not in text:  # else lower-casing could make a special string
                text = text.encode().lower().decode()
            return self._joined(map(self.spaced.__getitem__, text.replace("\n", " ").split(" ")))
        pieces = text.split(" ")
        try:
            if not sure(pieces[0]):
                raise Unsure
            return self._joined([self.bare[pieces[0]], *map(self.spaced.__getitem__, pieces[1:])])
        except Unsure:
            return self._merged(pieces)


@lru_cache(maxsize=4)
def pieces(path: str, glued: bool, counts: bool = False) -> Pieces:
    """One per worker process and vocabulary."""
    return Pieces(path, glued, counts)
