"""Texts in units that byte-level and piece tokenizers encode independently, so that a worker encodes each unit once.

A unit is a space with what follows it up to the next such space: one that stands
after something other than a space and before something other than white space. The
tokenizers' pattern begins a match at every such space, and no piece of a vocabulary
of pieces has a space behind another character, so that no token reaches over it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from tokenizers import Tokenizer

BOUNDARY = re.compile(r"(?<! ) (?=\S)")
#: Characters of a unit that is remembered at most, units that a worker remembers, and bytes of texts handled at a time (a longer text is handled alone).
LONG, MOST, SLICE_BYTES = 64, 300_000, 2 << 20


class Units(dict):
    """The number of each unit, by its text without the space. ``new`` holds units, with their space, that got numbers since it was last emptied."""

    def __init__(self):
        super().__init__()
        self.n, self.new = 0, []

    def add(self, unit: str) -> int:
        self.new.append(unit)
        self.n += 1
        return self.n - 1

    def __missing__(self, part: str) -> int:
        found = -1 if not part or part[0].isspace() else self.add(" " + part)  # a space before white space begins no unit
        if len(part) <= LONG:
            self[part] = found
        return found

    def of(self, text: str) -> np.ndarray:
        """The units of a space and the text, in order."""
        parts = text.split(" ")
        found = np.fromiter(map(self.__getitem__, parts), np.int64, len(parts))
        if found.min() >= 0:
            return found
        head, *rest = BOUNDARY.split(" " + text)
        return np.array([*([self.add(head)] if head else []), *map(self.__getitem__, rest)], np.int64)


def plain(unit: str) -> bool:
    """Whether a unit may be encoded in a row with others."""
    return len(unit) <= LONG and not unit[-1].isspace()


def byte_level() -> dict[str, int]:
    """Characters of a byte-level vocabulary and the bytes they stand for: printable ones for themselves, the others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteTokenizer:
    """A byte-level tokenizer's file, for single texts as it is, and for many units in a row by the same merges as ranks."""

    def __init__(self, content: str, specials_are_text: bool = False):
        self.exact = Tokenizer.from_str(content)
        self.exact.encode_special_tokens = specials_are_text
        told, chars = json.loads(content), byte_level()
        vocabulary = told["model"]["vocab"]
        merges = [x.split(" ") if isinstance(x, str) else x for x in told["model"]["merges"]]
        merged = [vocabulary[a + b] for a, b in merges]
        self.specials = [] if specials_are_text else [x["content"] for x in told["added_tokens"]]
        self.bytes = {i: bytes([chars[c] for c in x]) for x, i in vocabulary.items() if all(c in chars for c in x)}
        self.fast = None
        if merged == sorted(merged) and not told["normalizer"]:  # ids rise in the order of merges, so that they are its ranks
            ranks = {self.bytes[i]: i for i in [*merged, *[vocabulary[c] for c in chars]]}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        return self.exact.encode(text, add_special_tokens=False).ids

    def together(self, text: str) -> np.ndarray | None:
        """Ids of plain units in a row, or None where ``encode`` has to take each."""
        if self.fast is None or any(x in text for x in self.specials):
            return None
        return self.fast.encode_to_numpy(text).astype(np.int64)


def sizes(units: list[str]) -> np.ndarray:
    return np.fromiter((len(x.encode()) for x in units), np.int64, len(units))


def slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Stretches of rows with about SLICE_BYTES of text."""
    lengths, at, size = [len(x.as_buffer()) if x.is_valid else 0 for x in column.cast(pa.binary())], 0, 0
    for i, n in enumerate(lengths):
        if i > at and size + n > SLICE_BYTES:
            yield at, i
            at, size = i, 0
        size += n
    if at < len(lengths):
        yield at, len(lengths)


def gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` that ``which`` names, one behind the other."""
    n = lengths[which]
    return flat[np.repeat(starts[which] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
