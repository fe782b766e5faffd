"""Whole texts to token ids by way of a cache of space-separated chunks.

Splitting at single spaces never changes the ids here: both pre-tokenizers of the public vocabularies split before a space that stands
between two characters that aren't white space. Texts where that, the normalizer or an added token could matter take the whole text to the encoder.
Where white space and case are dropped, as in word_bpe, Words cuts finer and looks up each different chunk once for many texts.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from .common import worker_state

#: Characters whose class, case and normal form every Unicode version and library agrees on; white space is only " \t\n\r".
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡-įı-ňŊ-ž]*")
_SPACE = re.compile(r"[\t\n\r ]")
_SPACED = re.compile(r" [\t\n\r ]|[\t\n\r] ")

# The classes of _PLAIN's characters, as the public patterns divide them.
_L, _N = "a-zA-Zªµº\xc0-\xd6\xd8-\xf6\xf8-ž", "0-9²³¹¼-¾"
_SHORT = "'(?:s|t|re|ve|m|ll|d)"
#: For plain text the same pieces as the byte-level vocabularies' pattern, letters tried first, as most pieces are words.
BYTE_LEVEL = re.compile(rf" ?[{_L}]+|{_SHORT}| ?[{_N}]+| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+").findall
_WORD_LEVEL = re.compile(rf"[{_L}]+|{_SHORT}|[{_N}]|[^\s{_L}{_N}]+").findall

#: Bytes of text that Words looks up at once, at most a text's last chunk more.
BLOCK_BYTES = 1 << 23
_WHITE = b" \t\n\r"
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))
#: 0 for white space, 1 for ASCII letters and what is not ASCII, 2 for the rest of ASCII: a chunk of Words begins where this rises.
_KIND = bytes(0 if b in _WHITE else 1 if b in _LETTERS or b > 127 else 2 for b in range(256))
_LOWER = bytes(range(256)).lower()

#: Chunks, and pieces of them, that one worker remembers, some 180 bytes each; one beyond is encoded each time it comes.
REMEMBERED, REMEMBERED_PIECES = 900_000, 900_000
#: The same where an executor also holds what other stages left behind.
SHARED_MEMORY = (300_000, 150_000)


class Known(dict):
    """A bounded memory of what an encoder gave for a string; a string that is not in it is encoded when it is asked for."""

    def __init__(self, one: Callable[[str], bytes], most: int):
        super().__init__()
        self.one, self.most = one, most

    def __missing__(self, string: str) -> bytes:
        out = self.one(string)
        if len(self) < self.most:
            self[string] = out
        return out


def _is_ascii(text: str) -> bool:
    """Whether there are but line feeds and printable ASCII."""
    return text.isascii() and text.replace("\n", "").isprintable()


def is_plain(text: str) -> bool:
    """Whether the text can be split at its spaces."""
    if "  " in text or " \n" in text or "\n " in text:
        return False
    if _is_ascii(text):
        return True
    return _PLAIN.fullmatch(text) is not None and not _SPACED.search(text)


class Chunks:
    """encode(texts) gives each text's ids as little-endian unsigned 32-bit bytes.

    whole: the encoder of any strings; split and piece: for plain strings, their pieces and the encoder of one; ahead: told, before any is
    asked for, the strings of a batch that are not remembered, for encoders that do many at once; marks: texts that hold one of these go whole.
    """

    def __init__(self, whole: Callable[[list[str]], list[bytes]], split: Callable[[str], list[str]], piece: Callable[[str], bytes], ahead: Callable[[list[str]], None] | None = None, memory: tuple[int, int] | None = None, marks: tuple[str, ...] = ()):
        most, most_pieces = memory or (REMEMBERED, REMEMBERED_PIECES)
        self.whole, self.split, self.ahead, self.marks = whole, split, ahead, marks
        self.pieces = Known(piece, most_pieces)
        self.first, self.later = Known(self._joined, most_pieces), Known(lambda chunk: self._joined(" " + chunk), most)

    def clear(self) -> None:
        for known in (self.pieces, self.first, self.later):
            known.clear()

    def _joined(self, string: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.split(string)))

    def encode(self, texts: list[str]) -> list[bytes]:
        parts = [t.partition(" ") if is_plain(t) and not any(m in t for m in self.marks) else None for t in texts]
        if self.ahead:
            self.ahead([p[0] for p in parts if p and p[0] not in self.first] + [" " + c for p in parts if p and p[1] for c in p[2].split(" ") if c not in self.later])
        rest = iter(self.whole([t for t, p in zip(texts, parts, strict=True) if p is None]))
        first, later = self.first, self.later.__getitem__
        return [next(rest) if p is None else first[p[0]] + b"".join(map(later, p[2].split(" "))) if p[1] else first[p[0]] for p in parts]


def _cut(text: str, most: int) -> Iterator[str]:
    """The text in parts of most characters or more; each but the first begins with white space."""
    at = 0
    while len(text) - at > most and (space := _SPACE.search(text, at + most)):
        yield text[at : space.start()]
        at = space.start()
    yield text[at:] if at else text


class Words:
    """Chunks for encoders that drop white space and case: encode(texts) looks up each different chunk of a block of texts once.

    A plain text is cut at white space, and where an ASCII letter stands before ASCII that is no letter: a piece that has a letter ends there
    at the latest, and one without has none before it. Chunks are told apart and their ids put together in Arrow. Parameters as for Chunks.
    """

    def __init__(self, whole: Callable[[list[str]], list[bytes]], split: Callable[[str], list[str]], piece: Callable[[str], bytes], memory: tuple[int, int] | None = None, marks: tuple[str, ...] = ()):
        self.whole, self.split, self.piece, self.marks = whole, split, piece, marks
        self.known = Known(self._joined, memory[0] if memory else REMEMBERED)

    def clear(self) -> None:
        self.known.clear()

    def _joined(self, chunk: bytes) -> bytes:
        pieces = self.split(chunk.decode())
        return self.piece(pieces[0]) if len(pieces) == 1 else b"".join([self.known[p.encode()] for p in pieces])

    def _block(self, texts: list[bytes]) -> list[bytes]:
        raw = b"\n".join(texts)
        kind = np.frombuffer(raw.translate(_KIND), np.uint8)
        begins = np.empty(len(raw), bool)
        begins[:1] = kind[:1] > 0
        np.greater(kind[1:], kind[:-1], out=begins[1:])
        if not raw.isascii():  # whether a character that isn't ASCII is a letter is left to split
            begins[1:] &= np.frombuffer(raw, np.int8)[:-1] >= 0
        ends = np.cumsum([len(t) + 1 for t in texts])
        counts = [np.count_nonzero(begins[end - len(t) - 1 : end]) for t, end in zip(texts, ends.tolist(), strict=True)]
        letters = raw.translate(_LOWER, _WHITE)
        starts = np.flatnonzero(begins[kind > 0])
        chunks = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(letters)).astype(np.int32)), pa.py_buffer(letters)]).dictionary_encode()
        ids = pa.array(list(map(self.known.__getitem__, chunks.dictionary.to_numpy(zero_copy_only=False))), pa.binary()).take(chunks.indices)
        _, offsets, data = ids.buffers()
        at = np.frombuffer(offsets, np.int32, len(ids) + 1)[np.concatenate([[0], np.cumsum(counts)])].tolist()
        data = memoryview(data or b"")
        return [bytes(data[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        plain = [(_is_ascii(t) or _PLAIN.fullmatch(t) is not None) and not any(m in t for m in self.marks) for t in texts]
        rest = iter(self.whole([t for t, p in zip(texts, plain, strict=True) if not p]))
        out: list[list[bytes]] = [[] if p else [next(rest)] for p in plain]
        held, owners, size = [], [], 0
        for i, t in enumerate(texts):
            for part in _cut(t, BLOCK_BYTES) if plain[i] else ():
                held.append(part.encode())
                owners.append(i)
                size += len(held[-1])
                if size >= BLOCK_BYTES:
                    for owner, ids in zip(owners, self._block(held), strict=True):
                        out[owner].append(ids)
                    held, owners, size = [], [], 0
        if held:
            for owner, ids in zip(owners, self._block(held), strict=True):
                out[owner].append(ids)
        return [b"".join(parts) for parts in out]


def byte_letters() -> dict[int, str]:
    """The byte-level letter of each byte: printable bytes stand for themselves, the others follow from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in own)}


def opening(tokens: list[str]) -> tuple[str, ...]:
    """What any text that spells out one of these tokens holds, whatever its case: the first two characters if they have no case, else the empty string."""
    return tuple({t[:2] if t[:2].lower() == t[:2].upper() else "" for t in tokens})


def library(path: str, words: bool, memory: tuple[int, int] | None = None) -> Chunks | Words:
    """The tokenizers library over a vocabulary file, with add_special_tokens=False; one for each worker. words: lower case, white space dropped, as in word_bpe.

    An added token that a text spells out is that token, as the library has it.
    """

    def make() -> Chunks | Words:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        tok, letters = Tokenizer.from_file(path), byte_letters()
        model = tok.model.tokenize
        return (Words if words else Chunks)(
            lambda texts: [] if not texts else [array("I", e.ids).tobytes() for e in tok.encode_batch_fast(texts, add_special_tokens=False)],
            (lambda s: _WORD_LEVEL(s.lower())) if words else BYTE_LEVEL,
            lambda piece: array("I", [t.id for t in model(piece.encode().decode("latin-1").translate(letters))]).tobytes(),
            memory=memory,
            marks=opening([t.content for t in tok.get_added_tokens_decoder().values()]),
        )

    return worker_state(("tokenizers", path, words, memory), make)
