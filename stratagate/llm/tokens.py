"""Token ids of whole texts by a public tokenizer file, one task at a time.

The ids are those of the ``tokenizers`` library for the given file. Its cost per
call is high, so texts are cut where the file's own splitting rule always cuts,
each piece is encoded once per worker, and repeated pieces are looked up.

A cut lies before a blank or a line feed that stands between two characters
which are not white space: no rule of the supported files joins characters
across it, and none looks further than the next character. Other white space
stays inside its piece and is left to the library. Plain words of Latin letters,
which the splitting rule never divides, go straight to the library's model.

The library stays at its default, by which a special token written in a text, such
as ``<|endoftext|>``, is one id. A special token may strip the white space beside it
or stand across a cut, so a text that holds one goes to the library whole.
"""

from __future__ import annotations

import json
import re
import sys
from array import array

from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

#: Pieces remembered by one Python worker, about 40 MB; later ones are encoded anew.
#: A piece is remembered when met again: most are met once. Slots that tell so, 4 MB.
REMEMBERED, MET = 200_000, 1 << 22
#: Plain words remembered beside them where case does not count, about 50 MB.
REMEMBERED_WORDS = 400_000

_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
_LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: ASCII marks that end a plain word. An apostrophe may start a token together with
#: letters, so it is none of them.
_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
_SPACES = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()]
#: In a text without these, every blank and line feed stands between two words.
_ODD = [c for c in _SPACES if c not in " \n"] + ["  ", " \n", "\n ", "\n\n"]


def _byte_letters() -> dict[int, str]:
    """Byte (as a Latin-1 character) to the letter that stands for it in a vocabulary."""
    rule = ByteLevel(add_prefix_space=False, use_regex=False)
    letters = {}
    for code in range(0x80):
        letters[code] = rule.pre_tokenize_str(chr(code))[0][0]
    # a character of two bytes shows the letters of its lead and its last byte
    for code in range(0x80, 0x800):
        shown = rule.pre_tokenize_str(chr(code))[0][0]
        letters.update(zip(chr(code).encode(), shown, strict=True))
    return letters


class _Marks(dict):
    """Ids of runs of ASCII marks that follow a word."""

    def __init__(self, whole):
        self.whole = whole

    def __missing__(self, marks: str) -> bytes:
        ids = self.whole(marks)
        if len(self) < REMEMBERED // 100:
            self[marks] = ids
        return ids


class _Words(dict):
    """Ids of plain words in lower case, shared by the pieces that hold them."""

    def __init__(self, ids):
        self.ids = ids

    def __missing__(self, word: str) -> bytes:
        ids = self.ids(word)
        if len(self) < REMEMBERED_WORDS and len(word) < 100:
            self[word] = ids
        return ids


class _Pieces(dict):
    """Ids of pieces; one that starts with a line feed keeps it, others lost a blank."""

    def __init__(self, library: Tokenizer, keeps_space: bool):
        self.library, self.tokenize = library, library.model.tokenize
        self.letters, self.lower = _byte_letters(), not keeps_space
        self.blank = " " if keeps_space else ""
        self.shown_blank = self.letters[32] if keeps_space else ""
        self.feed = self.whole("\n")
        self.marks = _Marks(self.whole)
        # where case counts, a word is a piece like any other
        self.words = _Words(self.plain_ids) if self.lower else self
        self.met = bytearray(MET)

    def _plain(self, word: str, fed: bool) -> str:
        """The piece that stands for a plain word; only a blank goes into its ids."""
        if self.lower:
            return word.lower()
        return "\n" + word if fed else word

    def plain_ids(self, plain: str) -> bytes:
        fed = plain[0] == "\n"
        word = plain[1:] if fed else plain
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        found = self.tokenize(word if fed else self.shown_blank + word)
        packed = array("I", [x.id for x in found]).tobytes()
        return self.feed + packed if fed else packed

    def whole(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def __missing__(self, piece: str) -> bytes:
        fed = piece[0] == "\n"
        told = piece[1:] if fed else piece
        word = told.rstrip(_MARKS)
        if not (word.isascii() and word.isalpha()) and not _LATIN.fullmatch(word):
            packed = self.feed + self.whole(told) if fed else self.whole(self.blank + told)
        elif (plain := self._plain(word, fed)) == piece and not self.lower:
            packed = self.plain_ids(plain)
        else:
            packed = self.words[plain]
            if fed and self.lower:
                packed = self.feed + packed
            if len(word) < len(told):
                packed += self.marks[told[len(word) :]]
        if len(self) < REMEMBERED and len(piece) < 100:
            slot = hash(piece) % len(self.met)
            if self.met[slot]:
                self[piece] = packed
            self.met[slot] = 1
        return packed


class PieceEncoder:
    """Encode texts to little-endian unsigned 32-bit ids, remembering pieces.

    Texts without white space beside white space take the fast cut; others are
    cut by a regular expression with the same rule. ``None`` gives no ids.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        # without a normalizer, white space belongs to the token that follows it
        keeps_space = described["normalizer"] is None
        self.pieces = _Pieces(self.library, keeps_space)
        self.added = self._added(described["added_tokens"])

    @staticmethod
    def _added(tokens: list[dict]) -> re.Pattern | None:
        """Finds any token the library takes out of a text before it splits the rest."""
        # those found after normalization may be written in another case
        flags = re.IGNORECASE if any(t["normalized"] for t in tokens) else 0
        literals = sorted((t["content"] for t in tokens), key=len, reverse=True)
        return re.compile("|".join(map(re.escape, literals)), flags) if literals else None

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.added and self.added.search(text):
            return self.pieces.whole(text)
        if text[0] in " \n" or text[-1] in " \n" or any(x in text for x in _ODD):
            return b"".join([self._apart(piece) for piece in _CUT.split(text)])
        first, *rest = text.replace("\n", " \n").split(" ")
        return self.pieces.whole(first) + b"".join(map(self.pieces.__getitem__, rest))

    def _apart(self, piece: str) -> bytes:
        """Ids of a piece that still has its leading blank."""
        if piece[0] == " " and len(piece) > 1 and not piece[1].isspace():
            return self.pieces[piece[1:]]
        if piece[0] == "\n" and len(piece) > 1 and not piece[1].isspace():
            return self.pieces[piece]
        return self.pieces.whole(piece)


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder of a file; it lives as long as the worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]
