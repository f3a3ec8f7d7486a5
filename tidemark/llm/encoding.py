"""Exact, cached use of the tokenizers library over whole texts.

A text is cut before single spaces between two characters that are no white space. No pre-token, merge, normalisation or special string
crosses such a place in the two supported tokenizer layouts, so the ids of the pieces, one after the other, are those of the text.
Each distinct piece is encoded once by a process, up to a bounded number of remembered pieces. Other layouts are encoded whole.
Where single spaces and single line ends are all the white space, a text is cut before line ends, too. `encode_many` cuts many such texts at once by Arrow.

Pieces of Latin-1 characters are cut into pre-tokens here; there the classes of letters, digits and white space are settled. Any piece with another
character goes to the library itself, whose Unicode tables are older than Python's.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
import regex

CACHED_PIECES = 1_000_000
BLOCK = 8_000_000
_STOPS = frozenset(",.")
_STARTS = ("\n", "\t")  # before a piece without a space before it: after a line's end, at the start of a text
_ODD_SPACES = tuple(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")  # all white space there is
_NOT_PLAIN = rf"\A[ \n]|[ \n]\z|[ \n][ \n]|[{''.join(_ODD_SPACES)}]"  # not _spaced or not _lined, for Arrow
_LINE_END = re.compile(r"\S+\n\S+").fullmatch  # no pre-token crosses a single line's end between characters that are no white space
_PUNCTUATED = re.compile(r"([A-Za-z]+)([!-&(-/:-@\[-`{-~]+)").fullmatch  # a word and other signs than an apostrophe: two pre-tokens
_SPLIT = re.compile(r"(?<=\S) (?=\S)")
# The pre-token pattern of byte-level BPE, as the tokenizers library has it.
_BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def tokenizer_path(name: str, folder: str | None = None) -> str:
    """Place of a vocabulary file: in the given folder, or where the installed package keeps it."""
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level BPE writes for each byte: itself if printable, else the next free code point from 256."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(256 + k) for k, b in enumerate(rest)}


def _spaced(text: str) -> bool:
    """Whether all white space but line ends is single spaces between characters that are none."""
    return not ("  " in text or " \n" in text or "\n " in text or text[0] == " " or text[-1] == " " or any([c in text for c in _ODD_SPACES]))


def _lined(text: str) -> bool:
    """Whether its line ends are single ones inside; of several, those before a special string are one pre-token."""
    return not ("\n\n" in text or text[0] == "\n" or text[-1] == "\n")


class Encoder(dict):
    """Maps a piece to its ids, as the bytes of native unsigned integers of `width` bytes."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.code = "H" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "I"
        self.width = array(self.code).itemsize
        import json

        with open(path, encoding="utf-8") as f:
            shape = json.load(f)
        pre, norm = shape.get("pre_tokenizer") or {}, shape.get("normalizer")
        self.added = [t["content"] for t in shape.get("added_tokens", [])]
        to_library = ["[^\0-\xff]", *map(re.escape, filter(None, self.added))]
        self.special = re.compile("|".join(to_library)).search  # what pieces are not cut into pre-tokens here
        self.simple = all(re.search("[^A-Za-z,.]", t) for t in self.added)  # no special string is a word, with or without a stop
        self.model_tokens = self.tokenizer.model.tokenize  # bound once: each look at `model` makes a new object
        self.heads: dict[str, bytes] = {}
        plain = shape["model"].get("type") == "BPE" and not shape["model"].get("dropout") and all(not t["lstrip"] and not t["rstrip"] and not t["single_word"] and not re.search(r"\s", t["content"]) for t in shape["added_tokens"])
        self.kind = "whole"
        if plain and pre.get("type") == "ByteLevel" and not norm and not pre["add_prefix_space"] and pre["use_regex"]:
            self.kind, self.pattern = "spaced", regex.compile(_BYTE_LEVEL)
        elif plain and pre.get("type") == "Sequence" and norm and [x.get("type") for x in norm.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]:
            split, level = pre["pretokenizers"]
            if split["type"] == "Split" and split["invert"] and split["behavior"] == "Removed" and level["type"] == "ByteLevel" and not level["add_prefix_space"] and not level["use_regex"]:
                self.kind, self.pattern = "spaceless", regex.compile(split["pattern"]["Regex"])
        self.letters = _byte_letters()
        self.parts: dict[str, bytes] = {}
        self.space = " " if self.kind == "spaced" else ""

    def _part(self, part: str) -> bytes:
        """Ids of one pre-token."""
        found = self.parts.get(part)
        if found is None:
            ids = [t.id for t in self.model_tokens(part.encode().decode("latin-1").translate(self.letters))]
            found = array(self.code, ids).tobytes()
            if len(part) < 8 and len(self.parts) < CACHED_PIECES // 4:
                self.parts[part] = found
        return found

    def __missing__(self, piece: str) -> bytes:
        if self.simple and piece.isascii():
            if piece.isalpha():
                found = self._letters(piece)
                if len(self) < CACHED_PIECES and len(piece) < 64:
                    self[piece] = found
                return found
            if piece[-1:] in _STOPS and piece[:-1].isalpha():
                return self._signed(piece, piece[:-1], piece[-1])
        if self.space and piece.startswith(_STARTS):  # of a text whose lines were parted
            return (self._part("\n") if piece[0] == "\n" else b"") + self._head(piece[1:])
        text = self.space + piece
        if self.special(text):
            found = self._library(text)
        elif piece.isalpha():
            found = self._letters(piece)
        elif piece[-1:] in _STOPS and piece[:-1].isalpha():
            return self._signed(piece, piece[:-1], piece[-1])
        elif self.space and (two := _PUNCTUATED(piece)):
            return self._signed(piece, *two.groups())
        elif self.space and _LINE_END(piece):
            left, right = piece.split("\n")
            found = self[left] + self._part("\n") + self._head(right)
        else:
            if not self.space:
                text = self.tokenizer.normalizer.normalize_str(text)
            found = b"".join([self._word(p) for p in self.pattern.findall(text)])
        if len(self) < CACHED_PIECES and len(piece) < 64:
            self[piece] = found
        return found

    def _signed(self, piece: str, word: str, signs: str) -> bytes:
        """Ids of a word, which is remembered by itself, and what follows it; late ones are put together again each time."""
        found = self[word] + self._part(signs)
        if len(self) < CACHED_PIECES // 2 and len(piece) < 64:
            self[piece] = found
        return found

    def _letters(self, word: str) -> bytes:
        """Ids of a word of Latin-1 letters: one pre-token, its composed form already, lower-cased letter by letter."""
        if not word.isascii():
            return self._part(" " + word if self.space else word.lower())
        ids = [t.id for t in self.model_tokens("\u0120" + word if self.space else word.lower())]
        return array(self.code, ids).tobytes()

    def _word(self, part: str) -> bytes:
        """A pre-token with its space that is itself a remembered piece needs no second encoding."""
        if self.space and part[0] == " " and len(part) > 1:
            found = self.get(part[1:])
            if found is not None:
                return found
        return self._part(part)

    def _library(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def pieces(self, text: str) -> tuple[bytes, list[str]]:
        """What goes first as it is, and the pieces that follow."""
        if self.kind == "spaceless":
            return b"", text.replace("\n", " ").split(" ")
        if not _spaced(text):
            cut = _SPLIT.split(text)
        else:
            cut = (text.replace("\n", " \n") if _lined(text) else text).split(" ")
        return self._head(cut[0]), cut[1:]

    def _head(self, piece: str) -> bytes:
        """The first piece, and what follows a line's end, has no space before it."""
        found = self.heads.get(piece)
        if found is None:
            if self.special(piece):
                found = self._library(piece)
            elif piece.isalpha():
                found = self._part(piece)
            elif piece[-1:] in _STOPS and piece[:-1].isalpha():
                found = self._part(piece[:-1]) + self._part(piece[-1])
            else:
                found = b"".join([self._part(p) for p in self.pattern.findall(piece)])
            if len(piece) < 64 and len(self.heads) < CACHED_PIECES // 4:
                self.heads[piece] = found
        return found

    def encode(self, text: str) -> bytes:
        """Ids of the whole text."""
        if not text:
            return b""
        if self.kind == "whole":
            return self._library(text)
        head, rest = self.pieces(text)
        return head + b"".join(map(self.__getitem__, rest))

    def encode_many(self, texts: Iterable[str]) -> Iterator[bytes]:
        """encode for each text; plain texts are cut together, so that each distinct piece of BLOCK characters is looked up once."""
        block, size = [], 0
        for text in texts:
            block.append(text)
            size += len(text)
            if size >= BLOCK:
                yield from self._block(block)
                block, size = [], 0
        yield from self._block(block)

    def _block(self, texts: list[str]) -> Iterator[bytes]:
        together = [self.kind == "spaced" and 0 < len(t) < BLOCK for t in texts]
        if any(together):
            odd = pc.match_substring_regex(pa.array(texts, pa.large_string()), _NOT_PLAIN).to_pylist()
            together = [own and not other for own, other in zip(together, odd, strict=True)]
        lines = ["\t" + t.replace("\n", " \n") for t, own in zip(texts, together, strict=True) if own]
        if lines:
            pieces = pc.split_pattern(pa.array([" ".join(lines)], pa.large_string()), " ").flatten().dictionary_encode()
            ids = pa.array(list(map(self.__getitem__, pieces.dictionary.to_numpy(zero_copy_only=False))), pa.large_binary()).take(pieces.indices)
            _, places, body = ids.buffers()
            places = memoryview(places).cast("q")
            body = memoryview(body or b"")
        at = start = 0
        for text, own in zip(texts, together, strict=True):
            if own:
                at += text.count(" ") + text.count("\n") + 1
                yield bytes(body[start : places[at]])
                start = places[at]
            else:
                yield self.encode(text)

    def count(self, text: str) -> int:
        return len(self.encode(text)) // self.width


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder for each process and vocabulary file."""
    return Encoder(path)
