"""Byte-level BPE ids of whole texts, through the tokenizers library.

The vocabulary's own splitting rule never lets a token span a single blank or line end between
two visible characters other than with the blank as its first character, and it cuts a run of
white space before its last character. So a text can be cut there, and each distinct piece is
encoded once and remembered by the Python worker, within a bound in bytes: the ids are those of the whole text. A piece of letters alone
is one unit of that rule and goes straight to the library's merge model. A vocabulary of another kind
encodes whole texts.
"""

from __future__ import annotations

import re
from array import array
from codecs import charmap_decode
from functools import lru_cache

from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
REMEMBERED = 96 << 20  # bytes kept per cache, and as many of the generation before
ENTRY = 190  # bytes of a remembered piece besides its characters and ids
LONGEST = 48  # longer pieces are encoded each time

# white space as the splitting rule sees it: Unicode's property, without the separators 1C to 1F
_SPACE = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
# a run of white space without its last character, or the whole run at the end
_RUN = re.compile(f"({_SPACE}+(?={_SPACE}(?!{_SPACE}|\\Z))|{_SPACE}{{2,}}\\Z)")
_TWO = re.compile(_SPACE * 2)


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Place of a public vocabulary file; a file on the executors' own path works as well."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def _load(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    return tokenizer


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves, the others for characters from 256 on, in order.
    """
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


_LETTERS = "".join(_byte_letters()[b] for b in range(256))
_ENDINGS = ".,!?;:"


def tokenizer_bytes(tokenizer: Tokenizer, text: str) -> bytes:
    ids = tokenizer.encode(text, add_special_tokens=False).ids if text else []
    return array("I", ids).tobytes()


class _Pieces(dict):
    """Ids of pieces as little-endian 32-bit integers; a missing piece is encoded."""

    def __init__(self, tokenizer: Tokenizer, before: str) -> None:
        super().__init__()
        self.tokenizer, self.model, self.before = tokenizer, tokenizer.model, before
        self.start = charmap_decode(before.encode(), "strict", _LETTERS)[0]
        self.ending = {e: tokenizer_bytes(tokenizer, e) for e in _ENDINGS}
        self.older: dict[str, bytes] = {}
        self.held = 0
        self.empty = tokenizer_bytes(tokenizer, before)

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self._new(piece)
        size = len(piece)
        if size <= LONGEST:
            self.held += ENTRY + size + len(ids)
            if self.held > REMEMBERED:
                self.older, self.held = dict(self), 0
                self.clear()
            self[piece] = ids
        return ids

    def _new(self, piece: str) -> bytes:
        if piece.isalpha():
            return self._letters(piece)
        ending = self.ending.get(piece[-1:])
        if ending is not None and piece[:-1].isalpha():
            return self[piece[:-1]] + ending
        return tokenizer_bytes(self.tokenizer, self.before + piece) if piece else self.empty

    def _letters(self, piece: str) -> bytes:
        """Letters alone are one unit of the splitting rule: they go straight to the model."""
        if piece.isascii():
            letters = piece
        elif max(piece) < "\u0250":
            letters = charmap_decode(piece.encode(), "strict", _LETTERS)[0]
        else:
            return tokenizer_bytes(self.tokenizer, self.before + piece)
        return array("I", [t.id for t in self.model.tokenize(self.start + letters)]).tobytes()


class Encoder:
    """Encode texts as the library would, as little-endian unsigned 32-bit integers.

    ``shared`` gives the worker's own, so that a task goes on with what those before it remembered; the
    bound on that is small enough for idle workers to keep.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = tokenizer = _load(path)
        self.vocabulary = tokenizer.get_vocab_size()
        rule = tokenizer.pre_tokenizer
        self.by_piece = (
            tokenizer.normalizer is None
            and isinstance(rule, ByteLevel)
            and rule.use_regex
            and not rule.add_prefix_space
        )
        self.first = _Pieces(tokenizer, "")
        self.spaced = _Pieces(tokenizer, " ")
        self.line_end = tokenizer_bytes(tokenizer, "\n")

    def _plain(self, text: str) -> bytes:
        """Ids of a text without two white-space characters in a row."""
        first, spaced = self.first.__getitem__, self.spaced.__getitem__
        lines = []
        for line in text.split("\n"):
            head, *rest = line.split(" ")
            lines.append(first(head) + b"".join(map(spaced, rest)))
        return self.line_end.join(lines)

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.by_piece:
            return tokenizer_bytes(self.tokenizer, text)
        if not _TWO.search(text):
            return self._plain(text)
        parts = _RUN.split(text)
        for i, part in enumerate(parts):
            parts[i] = self.first[part] if i % 2 else self._plain(part)
        return b"".join(parts)


@lru_cache(maxsize=1)
def shared(path: str) -> Encoder:
    """The encoder that all tasks of a Python worker use."""
    return Encoder(path)
