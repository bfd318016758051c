"""Token counts by whole tokens, and ids by words, equal to a tokenizer file's library.

The vocabulary is proved once on the driver: a string that its own merges bring back to one token is a
whole token. Tasks cut texts into the pre-tokens of the tokenizer and look them up; only pre-tokens that
are no whole token are merged, by the library's model, and remembered up to a bound.

Texts with characters outside the scripts whose classes are settled in every Unicode version (`UNSETTLED`)
go to the library whole: pattern engines disagree about newer characters.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache
from itertools import islice

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from contentgate.llm.common import map_texts

# The patterns that the two tokenizer files split texts with.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

UNSETTLED = regex.compile(
    r"[^\u0000-\u001b\u0020-\u052f\u1e00-\u1eff\u2010-\u2064\u20a0-\u20bf\u2100-\u218b\u2190-\u23ff\u3000-\u3096\u30a1-\u30ff"
    r"\u4e00-\u9fa5\uac00-\ud7a3\uff01-\uff5e\U0001f300-\U0001f64f]")
# White space never joins two pre-tokens but for one space before a word: texts are cut there first.
CHUNKS = re.compile(r" ?\S+|\s+(?!\S)|\s+")
WORDS = re.compile(r"\S+")
REMEMBERED = 250_000
SEEN = 1 << 22
LONG_TEXT = 2_000_000


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 characters stand
    for themselves, the other bytes take the characters from 256 on, in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def chunks(pattern: re.Pattern, text: str) -> Iterator[list[str]]:
    """All matches, in lists of bounded length."""
    if len(text) <= LONG_TEXT:
        yield pattern.findall(text)
        return
    matches = (m.group() for m in pattern.finditer(text))
    while some := list(islice(matches, 200_000)):
        yield some


def whole_tokens(file: str) -> list[str]:
    """The strings of a byte-level vocabulary file's content that encode, alone, as one token."""
    tok = Tokenizer.from_str(file)
    back = {c: b for b, c in byte_letters().items()}
    special = {t["content"] for t in json.loads(file)["added_tokens"]}
    found = []
    for token in tok.get_vocab():
        if token in special or any(c not in back for c in token) or len(tok.model.tokenize(token)) != 1:
            continue
        try:
            found.append(bytes(back[c] for c in token).decode())
        except UnicodeDecodeError:  # part of a character: no pre-token
            continue
    return found


class Remembered(dict):
    """Values of strings, up to a bound. Only a string that comes again takes a place: half of all distinct ones never do."""

    def __init__(self, known=()):
        super().__init__(known)
        self.seen = bytearray(SEEN)

    def remember(self, text: str, made):
        if len(text) < 64:
            place = hash(text) % SEEN
            if self.seen[place] and len(self) < REMEMBERED:
                self[text] = made
            self.seen[place] = 1
        return made


class Merged(Remembered):
    """Value of a pre-token; what is not known is merged by the library's model."""

    def __init__(self, known, model, value):
        super().__init__(known)
        letters = byte_letters()
        self.letters, self.merge, self.value = {b: letters[b] for b in range(256)}, model.tokenize, value

    def __missing__(self, piece: str):
        # read as Latin-1, a byte is the character of its number
        plain = piece if piece.isascii() and piece.isalnum() else piece.encode().decode("latin-1").translate(self.letters)
        return self.remember(piece, self.value(self.merge(plain)))


class Chunks(Remembered):
    """Value of a chunk without inner white space: the total of its pre-tokens."""

    def __init__(self, pattern: str, pieces: Merged, total):
        super().__init__()
        self.cut, self.piece, self.total = regex.compile(pattern).findall, pieces.__getitem__, total

    def __missing__(self, chunk: str):
        # letters alone are one pre-token by either pattern
        return self.remember(chunk, self.total((self.piece(chunk),) if chunk.isalpha() else map(self.piece, self.cut(chunk))))


def splitter(file: str) -> regex.Pattern | None:
    """The special strings of a file; the library takes them out of a text before anything else."""
    special = [t["content"] for t in json.loads(file)["added_tokens"]]
    return regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None


@cache
def token_counter(file: str, known: str):
    """A function from a list of texts to their numbers of tokens (byte-level files). `known`: the whole tokens,
    joined by line feeds, without those that hold one. Kept by a worker from task to task, with what it remembers."""
    tok = Tokenizer.from_str(file)
    count = Chunks(BYTE_PATTERN, Merged(dict.fromkeys(known.split("\n"), 1), tok.model, len), sum).__getitem__
    special = splitter(file)

    def one(text: str) -> int:
        if not text.isascii() and UNSETTLED.search(text):
            return len(tok.encode(text, add_special_tokens=False).ids)
        parts = special.split(text) if special and special.search(text) else [text]
        # split() returns text and special string in turn
        return len(parts) // 2 + sum(sum(map(count, some)) for part in parts[::2] for some in chunks(CHUNKS, part))

    return lambda texts: [one(t) for t in texts]


@cache
def word_encoder(file: str):
    """A function from a text to its ids as little-endian unsigned 32-bit bytes (lower-casing word files).
    Kept by a worker from task to task, with what it remembers."""
    tok = Tokenizer.from_str(file)
    pack = lambda tokens: b"".join(t.id.to_bytes(4, "little") for t in tokens)
    ids = Chunks(WORD_PATTERN, Merged({}, tok.model, pack), b"".join).__getitem__
    special = splitter(file)
    numbers = {t["content"]: t["id"].to_bytes(4, "little") for t in json.loads(file)["added_tokens"]}

    def one(text: str) -> bytes:
        if not text.isascii() and UNSETTLED.search(text):
            return b"".join(i.to_bytes(4, "little") for i in tok.encode(text, add_special_tokens=False).ids)
        parts = special.split(text) if special and special.search(text) else [text]
        out = []
        for k, part in enumerate(parts):
            if k % 2:
                out.append(numbers[part])
                continue
            # the library lowers letter by letter: no final sigma
            part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            # white space is dropped and joins nothing
            out += [b"".join(map(ids, some)) for some in ([part.split()] if len(part) <= LONG_TEXT else chunks(WORDS, part))]
        return b"".join(out)

    return one


def count_tokens(docs: DataFrame, file: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bytes and tokens of every whole text; `file` is the content of a byte-level tokenizer file.

    Returns id, n_bytes, n_tokens, over_limit (n_tokens > limit), one row per input row. Null and empty texts
    have 0 of both. Null and repeated ids are passed through. Special strings count as one token each.
    """
    known = "\n".join(t for t in whole_tokens(file) if "\n" not in t)

    def make():
        count = token_counter(file, known)

        def batch(texts):
            n = count(texts)
            return [len(t.encode()) for t in texts], n, [x > limit for x in n]

        return batch

    fields = [("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    return map_texts(docs.select(F.col(id_col), F.col(text_col)), text_col, [id_col], fields, make)
