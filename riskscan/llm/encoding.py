"""Token ids of whole texts, with the work on repeated words done once per worker.

A tokenizer that splits its input into pieces by context-free rules gives a text
the ids of its parts, one after the other, as long as no piece crosses a cut
between parts.  Texts are cut at plain spaces and line ends, where neither
tokenizer's pieces cross; a part's ids are kept in a bounded memo.  A text in
which white space stands in any other way is encoded as one whole.  Ids come as
little-endian unsigned 32-bit numbers.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Callable
from functools import lru_cache

#: White space beyond ASCII, and code points that Python and the tokenizers may class differently.
WIDE_SPACE = "".join(map(chr, [0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
ODD = "".join(map(chr, [*range(0x1C, 0x20), 0x85, 0x180E, 0x200B, 0x2060, 0xFEFF]))
#: White space other than single spaces and line ends between words, and the character used as cut mark.
UNUSUAL = re.compile(f"[\\x00\\t\\r\\x0b\\x0c{ODD}{WIDE_SPACE}]" + r"|  |\n\n| \n|\n |^[ \n]|[ \n]\Z")
ODD_SPACE = re.compile(f"[{ODD}]")
#: Letters with one code point and one lower case each, in Latin-1.
LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
#: Pieces of a part of such letters and printable ASCII: contractions, letters, digits, all else.
SPACED_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\s+")
WORD_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\s{LETTERS}0-9]+")
PLAIN = re.compile(rf"[\x20-\x7e{LETTERS}]*\Z")
MEMO_PARTS = 1_000_000


def kinds(spaces: bytes) -> bytes:
    """For each Latin-1 byte: a (letter or digit), ! (sign), itself (space, line end), X (none of these)."""
    table = bytearray(b"X" * 256)
    for code in range(256):
        ch = chr(code)
        if ch.isascii() and ch.isalnum() or re.match(f"[{LETTERS}]", ch):
            table[code] = ord("a")
        elif 0x21 <= code < 0x7F:
            table[code] = ord("!")
    for code in spaces:
        table[code] = code if code in b" \n" else ord(" ")
    return bytes(table)


SPACED_KINDS, WORD_KINDS = kinds(b" \n"), kinds(b" \n\t\r\x0b\x0c")


class Memo(dict):
    """Values made on demand; emptied when full."""

    def __init__(self, make: Callable[[str], bytes], limit: int):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key: str) -> bytes:
        value = self.make(key)
        if len(self) >= self.limit:
            self.clear()
        self[key] = value
        return value


def ids_bytes(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


class Encoder:
    """Encodes with one tokenizer file.  ``spaced``: a word's piece includes the space before it and line ends count.

    ``memo_parts``: how many parts are kept, about 200 bytes each.
    """

    def __init__(self, path: str, spaced: bool, memo_parts: int = MEMO_PARTS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer, self.spaced = Tokenizer.from_file(path), spaced
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.byte_level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.parts = Memo(self.part, memo_parts)

    def whole(self, text: str) -> bytes:
        return ids_bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def piece(self, piece: str) -> bytes:
        # printable ASCII stands for itself in byte-level form, but for the space
        form = piece.replace(" ", "\u0120") if piece.isascii() else self.byte_level.pre_tokenize_str(piece)[0][0]
        return ids_bytes([t.id for t in self.tokenizer.model.tokenize(form)])

    def part(self, part: str) -> bytes:
        word = part[1:] if self.spaced and part[:1] == " " else part
        if word.isascii() and word.isalpha():  # most are a single word, and so a single piece
            return self.piece(part if self.spaced else part.lower())
        if not PLAIN.match(part):
            return self.whole(part)
        found = SPACED_PIECES.findall(part) if self.spaced else WORD_PIECES.findall(part.lower())
        return self.piece(found[0]) if len(found) == 1 else b"".join(map(self.parts.__getitem__, found))

    def cut(self, text: str) -> list[str] | None:
        """Parts that no piece crosses; None if the text has to be encoded as one.

        Commas and full stops that stand alone after a word are parts too, so that
        the words before them are found in the memo.
        """
        try:
            data = text.encode("latin-1")
        except UnicodeEncodeError:
            data = b""
        form = data.translate(SPACED_KINDS if self.spaced else WORD_KINDS)
        known = bool(data) and b"X" not in form
        lone = known and b"!!" not in form and b"'" not in data
        if not self.spaced:
            if not known:
                return None if ODD_SPACE.search(text) else text.split()
            text = text.lower()
            return (text.replace(",", " , ").replace(".", " . ") if lone else text).split()
        if known:
            ends = form[:1] + form[-1:]
            if any(x in form for x in (b"  ", b"\n\n", b" \n", b"\n ")) or b" " in ends or b"\n" in ends:
                return None
        elif UNUSUAL.search(text):
            return None
        marked = text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00")
        if lone and data[:1] not in b",." and not any(x in data for x in (b" ,", b" .", b"\n,", b"\n.")):
            marked = marked.replace(",", "\x00,").replace(".", "\x00.")
        return marked.split("\x00")

    def encode(self, text: str) -> bytes:
        """The ids of the text, without special tokens."""
        parts = self.cut(text)
        return self.whole(text) if parts is None else b"".join(map(self.parts.__getitem__, parts))


@lru_cache(maxsize=4)
def encoder(path: str, spaced: bool, memo_parts: int = MEMO_PARTS) -> Encoder:
    """One per worker process."""
    return Encoder(path, spaced, memo_parts)
