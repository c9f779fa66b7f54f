"""Token ids of whole texts by the tokenizers library, with a bounded memo.

The byte-level tokenizer splits a text before it merges, and a space that
follows a character other than white space always begins a new part.  So a text
may be cut there, and ids of parts that come again are remembered.
"""

from __future__ import annotations

import re
from array import array
from functools import cache

# Parts that one worker remembers before it forgets those not met again since the last time.
MEMO_PARTS = 450_000
# Letters below this code point are letters to every version of Unicode in use.
OLD_LETTERS = "ɐ"
END_ID = 2
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

_UNKNOWN = object()
_BEFORE_SPACE = re.compile(r"(?<=\S)(?= )")


def _byte_letters() -> dict[int, int]:
    """The byte-level alphabet: bytes without a visible Latin-1 sign get those from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in visible]
    return {byte: byte for byte in visible} | {b: 256 + i for i, b in enumerate(hidden)}


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, memo_parts: int = MEMO_PARTS):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.memo_parts = memo_parts
        self.tokenize = self.library.model.tokenize
        self.letters = _byte_letters()
        self.space = chr(self.letters[32])
        self.marks: dict[str, bytes] = {}
        self.line_end = self.whole("\n")
        self.spaced = _Parts(self, " ")
        self.bare = _Parts(self, "")

    def whole(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def part(self, chunk: str, before: str) -> bytes | None:
        """Ids of ``before`` and ``chunk``; None if the chunk does not stand alone."""
        if not chunk or chunk[-1].isspace():
            return None
        word = chunk.rstrip(MARKS)
        mark = chunk[len(word) :]
        if word.isalpha() and (word.isascii() or max(word) < OLD_LETTERS):
            # Letters only, and marks only, are parts that need no further splitting.
            spelled = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
            ids = array("I", [token.id for token in self.tokenize(self.space + spelled if before else spelled)])
            return ids.tobytes() + self.mark(mark) if mark else ids.tobytes()
        head, line_end, tail = chunk.partition("\n")
        if line_end and head and not head[-1].isspace() and not tail[0].isspace():
            # A single line end between other characters is a part of its own.
            return (self.spaced if before else self.bare)[head] + self.line_end + self.bare[tail]
        return self.whole(before + chunk)

    def mark(self, mark: str) -> bytes:
        ids = self.marks.get(mark)
        if ids is None:
            ids = self.whole(mark)
            if len(mark) < 8:
                self.marks[mark] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        first, *chunks = text.split(" ")
        if len(self.spaced) + len(self.bare) > self.memo_parts:
            self.spaced.grow_old()
            self.bare.grow_old()
        try:
            return self.bare[first] + b"".join(map(self.spaced.__getitem__, chunks))
        except TypeError:  # a None among the parts: white space beside the cut
            pass
        return b"".join(map(self.whole, _BEFORE_SPACE.split(text)))


class _Parts(dict):
    """Ids of chunks behind a space, or behind nothing."""

    def __init__(self, encoder: Encoder, before: str):
        super().__init__()
        self.encoder, self.before = encoder, before
        self.older: dict[str, bytes | None] = {}

    def __missing__(self, chunk: str) -> bytes | None:
        ids = self.older.get(chunk, _UNKNOWN)
        if ids is _UNKNOWN:
            ids = self.encoder.part(chunk, self.before)
        self[chunk] = ids
        return ids

    def grow_old(self) -> None:
        """Forget what was not asked for since the last time."""
        self.older = dict(self)
        self.clear()


@cache
def encoder(path: str) -> Encoder:
    """One encoder for each worker process."""
    return Encoder(path)
