"""Ids of whole texts by a tokenizers file, with the pieces' ids kept per worker.

The tokenizers library splits a text into pieces and takes each piece by
itself. Texts of Latin letters, the bulk, are split here as the file's own
pattern does, many at a time: numpy finds where pieces begin, Arrow lists the
distinct ones, and only pieces not seen before go to the library's model. Every
other text goes to the library whole.
"""

from __future__ import annotations

import json
import re
import sys
import types
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Pieces whose ids one worker keeps; beyond that it forgets those that did not come again.
KEPT_PIECES = 400_000
#: Characters of the texts that are split at once; longer texts are taken in parts.
GROUP_CHARS = 2_000_000
# The pattern of the byte-level splitter, which the library does not put into the file (fixed value).
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Up to U+017F: letters, numbers and white space as the library's patterns see them.
LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ſ"
NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
SPACES = "\t-\r \x85\xa0"
OTHER_SCRIPT = re.compile("[^\x00-ſ]|İ")


# The pattern of the other kind of file: no leading space, digits one by one, white space belongs to no piece.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: A single space between other characters: no piece of either pattern reaches over it.
JOINT = re.compile(r"(?<=\S)(?= \S)")
OTHER, LETTER, NUMBER, SPACE, WHITE, BETWEEN = range(6)


def _kinds(space: int) -> np.ndarray:
    """The kind of each character up to U+017F."""
    kinds = np.full(0x180, OTHER, np.int8)
    for chars, kind in ((LETTERS, LETTER), (NUMBERS, NUMBER), (SPACES, WHITE)):
        kinds[[c for c in range(0x180) if re.match(f"[{chars}]", chr(c))]] = kind
    kinds[ord(" ")] = space
    return kinds


class TextIds:
    """Ids of texts as little-endian unsigned 32-bit integers: ``of_rows`` for many, ``of`` for one."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        with open(path) as file:
            spec = json.load(file)
        self.marks = [t["content"] for t in spec["added_tokens"]]
        self.split, self.lower = self._plan(spec)
        self.kinds = _kinds(SPACE if self.split == BYTE_LEVEL else WHITE)
        model = self.tokenizer.model
        bytes_as_chars = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        alphabet = {c: bytes_as_chars.pre_tokenize_str(chr(c))[0][0] for c in range(0x180)}
        space = alphabet[ord(" ")]
        # Ids of the kept pieces, one after the other, and how many there are up to each piece.
        flat, stops = self.flat, self.stops = array("I"), array("q", [0])
        self.uses = np.zeros(0, np.int64)  # by piece: how often it was looked up for a group of texts

        class Pieces(dict):
            def __missing__(self, piece):
                first = piece[0] == " "
                body = piece[1:] if first else piece
                if body.isascii() and body.isalpha():  # these letters stand for themselves
                    written = space + body if first else body
                else:
                    written = piece.translate(alphabet)
                flat.extend([t.id for t in model.tokenize(written)])
                stops.append(len(flat))
                self[piece] = number = len(stops) - 2
                return number

        self.pieces = Pieces()

    @staticmethod
    def _plan(spec: dict) -> tuple[str | None, bool]:
        """Pattern and lower-casing of the two kinds of files known here, else no pattern."""
        normal, cut = spec["normalizer"], spec["pre_tokenizer"]
        if normal is None and cut["type"] == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"]:
            return BYTE_LEVEL, False
        steps = [x["type"] for x in (normal or {}).get("normalizers", [])]
        parts = cut.get("pretokenizers", [])
        if (
            steps == ["NFC", "Replace", "Lowercase"]
            and [p["type"] for p in parts] == ["Split", "ByteLevel"]
            and parts[0]["behavior"] == "Removed" and parts[0]["invert"]
            and not parts[1]["use_regex"] and not parts[1]["add_prefix_space"]
        ):
            pattern = parts[0]["pattern"]["Regex"]
            return (WORDS, True) if pattern == WORDS else (None, False)
        return None, False

    def _starts(self, kinds: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """Whether a piece begins at each character; there are ``BETWEEN`` ones at both ends."""
        before, after = np.roll(kinds, 1), np.roll(kinds, -1)
        white, follows = kinds >= SPACE, after <= NUMBER
        # The last of several white spaces is a piece of its own or the leading space of what follows.
        starts = np.where(white, (before <= NUMBER) | (before == BETWEEN) | follows, (kinds != before) & (before != SPACE))
        starts |= kinds == BETWEEN
        if self.split == WORDS:
            starts |= kinds == NUMBER
        # Contractions; the characters between texts are no letters, so none reaches over an end.
        mark = np.flatnonzero((chars == ord("'")) & starts)
        one, two = chars[mark + 1], chars[np.minimum(mark + 2, len(chars) - 1)]
        pair = np.isin((one << 9) | two, [(ord(a) << 9) | ord(b) for a, b in ("re", "ve", "ll")])
        single = np.isin(one, [ord(c) for c in "stmd"])
        starts[mark[single | pair] + 1] = False
        starts[mark[single] + 2] = True
        starts[mark[pair] + 3] = True
        return starts

    def _forget(self) -> None:
        """Keep the pieces that came again after the texts they were first seen in, unless these are most."""
        kept = np.flatnonzero(self.uses > 1)
        kept = kept[: 0 if len(kept) > KEPT_PIECES // 2 else None].tolist()
        names, flat, stops = list(self.pieces), self.flat[:], self.stops[:]
        self.pieces.clear()
        del self.flat[:], self.stops[1:]
        for i in kept:
            self.pieces[names[i]] = len(self.stops) - 1
            self.flat.extend(flat[stops[i] : stops[i + 1]])
            self.stops.append(len(self.flat))
        self.uses = np.zeros(len(kept), np.int64)

    def _ids(self, texts: list[str]) -> list[bytes]:
        """Ids of texts that are known to hold characters of ``kinds`` only."""
        if len(self.pieces) >= KEPT_PIECES:
            self._forget()
        joined = "\n".join(["", *texts, ""])
        chars = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends = np.cumsum([0, *(len(x) + 1 for x in texts)])
        kinds = self.kinds[chars]
        kinds[ends] = BETWEEN
        first = np.flatnonzero(self._starts(kinds, chars))
        places = first if joined.isascii() else (np.cumsum(chars >= 0x80) - (chars >= 0x80))[first] + first
        data = joined.encode()
        offsets = np.append(places, len(data)).astype(np.int64)
        every = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(data))
        own = kinds[first] <= (WHITE if self.split == BYTE_LEVEL else NUMBER)
        listed = every.filter(pa.array(own)).dictionary_encode()
        words = listed.dictionary.to_numpy(zero_copy_only=False)
        numbers = np.fromiter(map(self.pieces.__getitem__, words), np.int64, len(words))
        self.uses = np.append(self.uses, np.zeros(len(self.pieces) - len(self.uses), np.int64))
        self.uses[numbers] += 1
        numbers = numbers[listed.indices.to_numpy()]
        stops, flat = np.frombuffer(self.stops, np.int64), np.frombuffer(self.flat, np.uint32)
        length = stops[numbers + 1] - stops[numbers]
        after = np.cumsum(length)
        ids = flat[np.repeat(stops[numbers] - (after - length), length) + np.arange(length.sum())].astype("<u4").tobytes()
        del stops, flat  # arrays that are looked at cannot grow
        at = np.append(0, after)[np.append(0, np.cumsum(own))[np.searchsorted(first, ends)]].tolist()
        return [ids[a * 4 : b * 4] for a, b in zip(at, at[1:], strict=False)]

    def _split_here(self, text: str) -> bool:
        if not self.split or any(m in text for m in self.marks):
            return False
        if not text.isascii() and OTHER_SCRIPT.search(text):
            return False
        return not (self.lower and any(m in text.lower() for m in self.marks))

    def _group(self, texts: list[str]) -> list[bytes]:
        here = [self._split_here(x) for x in texts]
        plain = [x.lower() if self.lower else x for x, y in zip(texts, here, strict=True) if y]
        found = iter(self._ids(plain) if plain else [])
        return [next(found) if y else self._library(x) for x, y in zip(texts, here, strict=True)]

    def _library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _long(self, text: str) -> bytes:
        if not self._split_here(text):
            return self._library(text)
        out, start = [], 0
        while start < len(text):
            cut = JOINT.search(text, start + GROUP_CHARS)
            stop = cut.start() if cut else len(text)
            part = text[start:stop]
            out += self._ids([part.lower() if self.lower else part])
            start = stop
        return b"".join(out)

    def of_rows(self, rows: Iterable[tuple]) -> Iterator[tuple]:
        """Rows of (key, text) as (key, the text's ids), in their order."""
        keys, texts, chars = [], [], 0
        for key, text in rows:
            if texts and chars + len(text) > GROUP_CHARS:
                yield from zip(keys, self._group(texts), strict=True)
                keys, texts, chars = [], [], 0
            if len(text) > GROUP_CHARS:
                yield key, self._long(text)
                continue
            keys.append(key)
            texts.append(text)
            chars += len(text)
        if texts:
            yield from zip(keys, self._group(texts), strict=True)

    def of(self, text: str) -> bytes:
        """One text's ids; for many texts ``of_rows`` is faster."""
        return next(self.of_rows([(None, text)]))[1]


def text_ids(path: str) -> TextIds:
    """One per file and Python worker; later tasks of a worker find the pieces there."""
    kept = sys.modules.setdefault("_estatelake_text_ids", types.ModuleType("_estatelake_text_ids")).__dict__
    if path not in kept:
        kept[path] = TextIds(path)
    return kept[path]
