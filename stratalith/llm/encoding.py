"""Ids of texts by the tokenizers library, which is asked once for each distinct chunk of text.

A chunk is a stretch that the tokenizer treats alike alone and in its text; the library gives the
ids of every chunk, and the ids of a text are those of its chunks in order. A chunk that is one word of
letters is given to the library's model directly, as its first steps change nothing but the spelling.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import sys
import unicodedata
from array import array
from collections.abc import Callable, Iterator

import numpy as np

# Punctuation that ends many words and is a token of its own there.
_ENDS = frozenset(".,;:!?")
# A single blank between two other characters begins a new piece of a byte-level text.
_BLANK = re.compile(r"(?<=\S) (?=\S)")
# White space of ASCII but blanks and line ends.
_OTHER_SPACE = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f"
# Characters of a text that are cut to chunks at a time.
SPAN = 1 << 20


def byte_symbols() -> list[str]:
    """The character that stands for each byte: printable ones stand for themselves, the others follow from 256 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("\xa1"), ord("\xac") + 1), *range(ord("\xae"), 256)}
    others = iter(range(256, 512))
    return [chr(byte if byte in plain else next(others)) for byte in range(256)]


_SPELLED = dict(enumerate(byte_symbols()))


def byte_level_word(chunk: str) -> str | None:
    """The spelling of a chunk that is one word of letters, after a blank or not."""
    word = chunk[1:] if chunk[:1] == " " else chunk
    if not word.isalpha():
        return None
    if not word.isascii():
        word = word.encode().decode("latin-1").translate(_SPELLED)
    return _SPELLED[32] + word if chunk[0] == " " else word


def plain_word(chunk: str) -> str | None:
    """The same for a tokenizer that composes and lower-cases, letter by letter, and drops blanks."""
    if not chunk.isascii():
        chunk = "".join([x.lower() for x in unicodedata.normalize("NFC", chunk)])
    if not chunk.isalpha():
        return None
    return chunk.lower() if chunk.isascii() else chunk.encode().decode("latin-1").translate(_SPELLED)


def tidy(text: str) -> bool:
    """No two white-space characters in a row, and none but blanks and line ends."""
    if "\0" in text or any(pair in text for pair in ("  ", " \n", "\n ", "\n\n")):
        return False
    if text.isascii():
        return not any([x in text for x in _OTHER_SPACE])
    return len(text.split()) == text.count(" ") + text.count("\n") + 1 - (text[:1] in (" ", "\n")) - (text[1:] != "" and text[-1] in " \n")


def byte_level_chunks(text: str) -> list[str]:
    """A blank goes with the word that follows it."""
    if not tidy(text):
        first, *rest = _BLANK.split(text)
        return [first, *(" " + x for x in rest)]
    return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")


def word_chunks(text: str) -> list[str]:
    """White space belongs to no token, so any of it separates."""
    return text.replace("\n", " ").split(" ")


def whole(text: str) -> list[str]:
    return [text]


def chunker_of(model: dict) -> tuple[Callable[[str], list[str]], Callable[[str], str | None]]:
    """How texts may be cut for a tokenizer and words be spelled for its model; an unknown kind gets whole texts."""
    unknown = whole, lambda chunk: None
    normal, before = model.get("normalizer"), model.get("pre_tokenizer") or {}
    if any(re.search(r"\s", x["content"]) or x.get("lstrip") or x.get("rstrip") or x.get("single_word") for x in model.get("added_tokens", [])):
        return unknown
    if before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not normal:
        return byte_level_chunks, byte_level_word
    steps = before.get("pretokenizers", [])
    kinds = {x["type"] for x in (normal or {}).get("normalizers", [])}
    if len(steps) == 2 and kinds <= {"NFC", "Replace", "Lowercase"} and steps[0].get("behavior") == "Removed" and steps[0].get("invert") and not steps[1].get("use_regex"):
        if r"[^\s\p{L}\p{N}]+" in steps[0]["pattern"].get("Regex", ""):
            return word_chunks, plain_word
    return unknown


def spans(text: str) -> Iterator[str]:
    """Stretches of about SPAN characters, cut before a lone blank; one where there is none."""
    start = 0
    while len(text) - start > SPAN:
        cut = _BLANK.search(text, start + SPAN)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


class Encoder(dict):
    """``encode`` gives the ids of texts as little-endian unsigned numbers of ``dtype``.

    As a mapping it holds the packed ids of the chunks seen lately; a new chunk is looked up on access.
    When it is full it starts anew and what it held becomes the older memory, from which chunks that are met again come back, so
    frequent ones stay. This changes no ids.
    """

    LIMIT = 600_000

    def __init__(self, description: str, dtype: str = "<u4"):
        super().__init__()
        self.older: dict[str, bytes] = {}
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(description)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.chunks, self.spelled = chunker_of(json.loads(description))
        # The model's own memory is small and soon full; looking into it only costs time.
        self.model = self.tokenizer.model
        self.model._resize_cache(0)
        self.code = {2: "H", 4: "I"}[np.dtype(dtype).itemsize]
        self.ends = {x: self._asked(x) for x in _ENDS}

    def _packed(self, ids: list[int]) -> bytes:
        packed = array(self.code, ids)
        if sys.byteorder != "little":
            packed.byteswap()
        return packed.tobytes()

    def _asked(self, text: str) -> bytes:
        return self._packed(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids)

    def _word(self, spelled: str) -> bytes:
        return self._packed([x.id for x in self.model.tokenize(spelled)])

    def __missing__(self, chunk: str) -> bytes:
        if (ids := self.older.get(chunk)) is None:
            ids = self._looked_up(chunk)
        if len(self) >= self.LIMIT:
            self.older = dict(self)
            self.clear()
        self[chunk] = ids
        return ids

    def _looked_up(self, chunk: str) -> bytes:
        if (spelled := self.spelled(chunk)) is not None:
            return self._word(spelled)
        if chunk[-1:] in _ENDS and (spelled := self.spelled(chunk[:-1])) is not None:
            # What ends a word is a token of its own.
            return (self.get(chunk[:-1]) or self.older.get(chunk[:-1]) or self._word(spelled)) + self.ends[chunk[-1]]
        return self._asked(chunk)

    def encode(self, texts: list[str]) -> list[bytes]:
        """One after another; a long text is cut to chunks in stretches."""
        ids = self.__getitem__
        if self.chunks is whole:
            return [self._asked(text) for text in texts]
        return [b"".join([b"".join(map(ids, self.chunks(span))) for span in spans(text)]) for text in texts]


_encoders: dict[tuple[str, str], Encoder] = {}


def forget() -> None:
    """Give back what this process knows: tasks of other operators, which the same worker may run next, have no use for it."""
    _encoders.clear()


def encoder_for(description: str, dtype: str = "<u4") -> Encoder:
    """The encoder of this process: a worker that runs several tasks goes on with what it knows."""
    key = (hashlib.sha256(description.encode()).hexdigest(), dtype)
    if key not in _encoders:
        # One at a time, as a memory is large.
        _encoders.clear()
        _encoders[key] = Encoder(description, dtype)
    return _encoders[key]
