"""Cutting a text into pieces that a byte-level BPE tokenizer encodes independently of each other, and remembering their codes.

A single space between two characters that are not white space always starts a new pre-token, so the encoding of a
text is the concatenation of the encodings of ``first, " second", " third", ...``. A single line feed between two such characters is a
pre-token of its own, so lines are independent too. Pieces are cut further into pre-tokens. Both repeat a great deal, which lets a
task encode each distinct pre-token about once. Strings of special tokens are cut out first.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable
from itertools import chain

import regex

# Fixed value: the pre-token pattern of byte-level vocabularies.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Marks that never join the letters before them in one pre-token.
_MARKS = frozenset(".,;:!?")
_PATTERN = regex.compile(PRE_TOKENS)
# White space other than spaces and line feeds; beside a space it makes the plain split wrong.
_RARE = re.compile(r"[^\S \n]")
_CUT = re.compile(r"(?<=\S) (?=\S)")


def byte_symbols() -> dict[int, str]:
    """The printable stand-in of every byte in byte-level vocabularies: printable Latin-1 bytes are themselves, the
    others follow from U+0100 on in order of their value."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def lines(text: str) -> list[list[str]]:
    """The pieces of a text without special tokens, line by line; all but the first of a line stand for themselves after one space.

    Line feeds beside other white space are left inside their pieces.
    """
    if not text:
        return []
    if " \n" in text or "\n " in text or "\n\n" in text or text[0] == "\n" or text[-1] == "\n" or _RARE.search(text):
        return [_CUT.split(text)]
    if "  " in text or text[0] == " " or text[-1] == " ":
        return [_CUT.split(line) for line in text.split("\n")]
    return [line.split(" ") for line in text.split("\n")]


def pre_tokens(string: str) -> list[str]:
    """Pre-tokens of a string; the common shapes (letters after at most one space, and a mark behind) need no pattern."""
    body = string[1:] if string[:1] == " " else string
    if body.isalpha():
        return [string]
    if body[-1:] in _MARKS and body[:-1].isalpha():
        return [string[:-1], string[-1]]
    return _PATTERN.findall(string)


def special_tokens(path: str) -> dict[str, int]:
    with open(path, encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f).get("added_tokens", [])}


class _Memory:
    """A bounded dictionary in two generations: when the young one is full it becomes the old one, and what is asked for
    again moves back, so frequent entries stay."""

    def __init__(self, limit: int):
        self.limit, self.young, self.old = limit, {}, {}

    def turn(self) -> None:
        if len(self.young) > self.limit:
            self.young, self.old = {}, self.young

    def unknown(self, asked: Iterable[str]) -> list[str]:
        """Those in neither generation; the others are young afterwards."""
        new, young, old = [], self.young, self.old
        for key in asked:
            if key in old:
                young[key] = old[key]
            else:
                new.append(key)
        return new


class PieceCache:
    """Per-task memory of encoded pieces. ``encode`` gets distinct unknown pre-tokens and returns their values; ``join`` makes one
    value of several.

    ``look(texts)`` returns, per text, the list of values of its pieces in order; ``special`` maps the tokenizer's
    special strings to their values. Each generation holds about ``limit`` pieces, so memory is bounded.
    """

    def __init__(self, encode: Callable[[list[str]], list], join: Callable[[list], object], special: dict[str, object], limit: int = 200_000):
        self.encode, self.join, self.special, self.limit = encode, join, special, limit
        self.cut = re.compile("(" + "|".join(re.escape(s) for s in sorted(special, key=len, reverse=True)) + ")") if special else None
        self.feed = self.encode(["\n"])[0]
        # Pieces behind a space, first pieces, and pre-tokens that are neither.
        self.rest, self.head, self.other = _Memory(limit), _Memory(limit), _Memory(limit)

    def _segments(self, text: str) -> list[tuple[object, list[list[str]]]]:
        """Values of special strings, and the lines between them."""
        if not any(s in text for s in self.special):
            return [(None, lines(text))]
        return [(self.special[s], []) if s in self.special else (None, lines(s)) for s in self.cut.split(text) if s]

    def _learn(self, memory: _Memory, keys: list[str], lead: str) -> None:
        """Encode the pieces ``keys`` (which stand behind ``lead``) into ``memory`` by way of their pre-tokens."""
        words = [key for key in keys if key.isalpha()]
        cuts = [(key, pre_tokens(lead + key)) for key in keys if not key.isalpha()]
        young = memory.young
        young.update(zip(words, self.encode([lead + w for w in words]), strict=True))
        # The parts of other pieces are looked up, as pieces where they are ones, or encoded.
        known, new = {}, []
        for token in set(chain.from_iterable(cut for _, cut in cuts)):
            word = token[:1] == " " and token[1:].isalpha()
            home, key = (self.rest, token[1:]) if word else (self.other, token)
            value = home.young.get(key)
            if value is None:
                value = home.old.get(key)
                if value is None:
                    new.append((token, home.young, key))
                    continue
                home.young[key] = value
            known[token] = value
        for (token, home, key), value in zip(new, self.encode([t for t, _, _ in new]), strict=True):
            home[key] = known[token] = value
        for key, cut in cuts:
            young[key] = self.join([known[t] for t in cut])

    def look(self, texts: list[str]) -> list[list]:
        for memory in (self.rest, self.head, self.other):
            memory.turn()
        known = self.rest.young.get
        heads, rests, out, gaps = set(), set(), [], []
        for text in texts:
            got: list = []
            for special, cut in self._segments(text):
                if special is not None:
                    got.append(special)
                for number, words in enumerate(cut):
                    if number:
                        got.append(self.feed)
                    at = len(got)
                    got.extend(map(known, words))
                    # The first piece has no space before it.
                    got[at] = None
                    missing = [i for i, v in enumerate(got[at:], at) if v is None]
                    asked = [words[i - at] for i in missing]
                    gaps.append((got, missing, asked))
                    heads.add(asked[0])
                    if len(asked) > 1:
                        rests.update(asked[1:])
            out.append(got)
        heads.difference_update(self.head.young)
        if heads:
            self._learn(self.head, self.head.unknown(heads), "")
        if rests:
            self._learn(self.rest, self.rest.unknown(rests), " ")
        head, rest = self.head.young, self.rest.young
        for got, missing, asked in gaps:
            got[missing[0]] = head[asked[0]]
            for i, word in zip(missing[1:], asked[1:], strict=True):
                got[i] = rest[word]
        return out


class _Filling(dict):
    """A memory that computes what it lacks; a full one is followed by an empty one, which takes over what is asked for again."""

    def __init__(self, make: Callable[[str], object], old: dict):
        self.make, self.old = make, old

    def __missing__(self, key: str):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


class EagerPieceCache(PieceCache):
    """A ``PieceCache`` for encoders that gain nothing from batches: a piece is encoded where it is first met, so that lookups of
    known pieces stay inside the interpreter's own loops."""

    def __init__(self, encode: Callable[[list[str]], list], join: Callable[[list], object], special: dict[str, object], limit: int = 200_000):
        super().__init__(encode, join, special, limit)
        self.ends = {mark: encode([mark])[0] for mark in _MARKS}
        self.rest, self.head = _Filling(lambda key: self._piece(self.rest, key, " "), {}), _Filling(lambda key: self._piece(self.head, key, ""), {})
        self.other = _Filling(lambda key: encode([key])[0], {})

    def _piece(self, memory: _Filling, key: str, lead: str):
        if key.isalpha():
            return self.encode([lead + key])[0]
        end = self.ends.get(key[-1:])
        if end is not None and key[:-1].isalpha():
            return self.join([memory[key[:-1]], end])
        return self.join([self.other[t] for t in pre_tokens(lead + key)])

    def look(self, texts: list[str]) -> list[list]:
        for name in ("rest", "head", "other"):
            memory = getattr(self, name)
            if len(memory) > self.limit:
                memory.old = {}
                setattr(self, name, _Filling(memory.make, dict(memory)))
        out, head, rest, feed = [], self.head.__getitem__, self.rest.__getitem__, self.feed
        for text in texts:
            got: list = []
            for special, cut in self._segments(text):
                if special is not None:
                    got.append(special)
                for number, words in enumerate(cut):
                    if number:
                        got.append(feed)
                    got.append(head(words[0]))
                    if len(words) > 1:
                        got.extend(map(rest, words[1:]))
            out.append(got)
        return out
