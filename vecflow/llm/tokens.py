"""Byte-level BPE of whole texts: the tokenizers library on each distinct word form, remembered for the rest."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable

import numpy as np


#: The pattern of the public byte-level vocabularies, for which latin_forms() is the same: a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Letters, numbers and white space below U+0250, and what lies beyond.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾", r"\t-\r \x85\xa0"
_BEYOND = re.compile("[^\x00-ɏ]").search
_LATIN = re.compile(rf" ?[{_L}]+| ?[{_N}]+|'(?:[sdmt]|ll|ve|re)| ?[^{_L}{_N}{_S}]+|[{_S}]+(?![^{_S}])|[{_S}]+").findall


def latin_forms(text: str) -> list[str] | None:
    """The word forms of a text of characters below U+0250, by plain character ranges; None for other texts."""
    return None if _BEYOND(text) else _LATIN(text)


class _Remembered(dict):
    """Word form (as the pattern cuts it) -> its ids as little-endian unsigned 32-bit bytes.

    Holds LIMIT forms at most and starts anew beyond them, so that memory is bounded whatever the corpus holds.
    """

    LIMIT = 400_000

    def __init__(self, model):
        super().__init__()
        self.model = model
        # the byte-level alphabet: printable bytes stand for themselves, the rest follow from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(plain)]
        self.letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.space = self.letters[32]

    def __missing__(self, form: str) -> bytes:
        if len(self) >= self.LIMIT:
            self.clear()
        if form.isascii() and form[1:].isalnum():  # only the first character can be a space
            spelt = self.space + form[1:] if form[0] == " " else form
        else:
            spelt = form.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters)
        # little-endian as all of Spark's platforms
        ids = self[form] = array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()
        return ids


class ByteBpe:
    """encode(text) gives the ids of the whole text. The file's own pattern cuts texts into word forms, and BPE never
    merges across forms, so ids of the text are the forms' ids in a row. With ``added``, texts are first cut at the strings
    of the file's added tokens, which give those tokens' ids, as Tokenizer.encode does; else they are ordinary text."""

    def __init__(self, path: str, added: bool = False):
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        self.any_forms = regex.compile(public_tokenizers.PATTERN).findall
        self.latin = public_tokenizers.PATTERN == PATTERN
        self.ids = _Remembered(self.tokenizer.model)
        own = {t.content: (i, t) for i, t in self.tokenizer.get_added_tokens_decoder().items()} if added else {}
        if any(t.single_word or t.lstrip or t.rstrip for _, t in own.values()):
            raise ValueError("added tokens that depend on their surroundings")
        self.added = {content: array("I", [i]).tobytes() for content, (i, _) in own.items()}
        longest = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest)) + ")").split if own else None

    def forms(self, text: str) -> list[str]:
        got = latin_forms(text) if self.latin else None
        return self.any_forms(text) if got is None else got

    def encode_bytes(self, text: str) -> bytes:
        if not any(content in text for content in self.added):
            return b"".join(map(self.ids.__getitem__, self.forms(text)))
        pieces = self.cut(text)  # every second one is an added token
        return b"".join(self.added[x] if i % 2 else b"".join(map(self.ids.__getitem__, self.forms(x))) for i, x in enumerate(pieces))

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode_bytes(text), "<u4")


_LOADED: dict[tuple[str, bool], ByteBpe] = {}


def encoder(path: str, added: bool = False) -> ByteBpe:
    """One encoder for each Python worker, file and reading of added tokens."""
    if (path, added) not in _LOADED:
        _LOADED[path, added] = ByteBpe(path, added)
    return _LOADED[path, added]


def texts(column) -> Iterable[str]:
    return (x or "" for x in column.to_pylist())
