"""Byte-level BPE: encoding and decoding of whole texts.

A text is cut at its special tokens, then into words by the vocabulary's pattern. The words of a
batch that a worker has not met yet are merged together: the symbols of all of them lie in one
flat array, each round finds every word's pair of lowest rank by binary search in the sorted
pair keys, and merges it wherever it stands in that word. Ids of words are kept for later
batches; the store is emptied when it is full, which changes no result.

Each row is on its own, so there is no shuffle, no group and no skew; a lost executor costs the
tasks it ran. Null text counts as empty, and an empty text has no ids. Repeated rows, further
columns and documents of any length need no special treatment.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.common import arrow

# Fixed value: the pattern that cuts text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for text of ASCII characters, where the classes are short; it takes half the time.
ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^ \t-\rA-Za-z0-9]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+"
#: Words that a worker keeps.
KEPT_WORDS = 200_000
#: Symbols that are merged at a time.
BATCH_SYMBOLS = 1_000_000
NEVER = np.iinfo(np.int32).max


def _byte_characters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


@functools.cache
def _not_letters() -> tuple[re.Pattern, dict[int, str]]:
    """Letters and digits of the regex module that the tokenizers library's Unicode version does
    not know yet, and a symbol for each to be read as. Both are asked about characters that
    are new since this Python's own Unicode version."""
    from tokenizers.pre_tokenizers import ByteLevel

    known = regex.compile(r"[\p{L}\p{N}]")
    split = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    new = [
        c for c in map(chr, range(0x530, 0x110000))
        if unicodedata.category(c) == "Cn" and known.match(c) and len(split("a" + c)) == 2 and len(split("1" + c)) == 2
    ]
    return re.compile("[" + "".join(new) + "]"), {ord(c): "¦" for c in new}


class Vocabulary:
    """Symbols, merges and special tokens of a tokenizers file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        as_byte = {c: b for b, c in enumerate(_byte_characters())}
        self.size = 1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
        self.bytes = [b""] * self.size
        for token, i in vocab.items():
            self.bytes[i] = bytes(as_byte[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.of_byte = np.array([vocab[c] for c in _byte_characters()], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)  # by rank
        self.text = [str(i) for i in range(self.size)]
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.split = regex.compile(PATTERN).findall
        self.split_ascii = re.compile(ASCII_PATTERN).findall
        self.known: dict[str, str] = {}  # a word's ids, joined by commas

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each word; no word is empty."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        done: list[np.ndarray] = [None] * len(words)
        while len(word):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            rank = np.full(len(word), NEVER, np.int32)
            keys = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = (self.keys[at] == keys) & (word[:-1] == word[1:])
            rank[:-1][hit] = self.ranks[at[hit]]
            lowest = np.minimum.reduceat(rank, starts)
            counts = np.diff(np.r_[starts, len(word)])
            over = lowest == NEVER
            if over.any():
                for i, a, n in zip(word[starts[over]], starts[over], counts[over], strict=True):
                    done[i] = symbols[a : a + n].copy()
                rest = ~np.repeat(over, counts)
                symbols, word, rank = symbols[rest], word[rest], rank[rest]
                lowest, counts = lowest[~over], counts[~over]
                if not len(word):
                    break
            found = np.flatnonzero(rank == np.repeat(lowest, counts))
            # of pairs that overlap, as in a run of one symbol, every second one stands
            run = np.cumsum(np.r_[True, np.diff(found) != 1])
            first = np.flatnonzero(np.r_[True, np.diff(run) != 0])
            found = found[(np.arange(len(found)) - first[run - 1]) % 2 == 0]
            symbols[found] = self.merged[rank[found]]
            keep = np.ones(len(word), bool)
            keep[found + 1] = False
            symbols, word = symbols[keep], word[keep]
        return done

    def words(self, text: str) -> list[str]:
        """The words of a text without special tokens; joined they are the text."""
        if text.isascii():
            return self.split_ascii(text)
        raw = text.encode()
        if np.frombuffer(raw, np.uint8).max() >= 0xD4:  # has a character from U+0500 on
            odd, read_as = _not_letters()
            if odd.search(text):
                at = np.cumsum([0, *map(len, self.split(text.translate(read_as)))])
                return [text[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        return self.split(text)

    def _learn(self, words: set[str]) -> None:
        batch, size = [], 0
        for w in [*words, None]:
            if w is None or size > BATCH_SYMBOLS:
                for v, ids in zip(batch, self.merge([x.encode() for x in batch]) if batch else [], strict=True):
                    self.known[v] = ",".join(map(self.text.__getitem__, ids.tolist()))
                batch, size = [], 0
            if w is not None:
                batch.append(w)
                size += len(w)

    def encode(self, texts: list[str | None]) -> list[str]:
        """The ids of each text, joined by commas."""
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        cut = []
        for text in texts:
            parts = self.at_special.split(text) if text else []
            cut.append([w for i, p in enumerate(parts) if p for w in ([p] if i % 2 else self.words(p))])
        self.known |= {token: str(i) for token, i in self.special.items()}
        self._learn(set().union(*cut) - self.known.keys())
        return [",".join(map(self.known.__getitem__, words)) for words in cut]

    def decode(self, ids: list[int]) -> str:
        """Bytes that are no UTF-8 become U+FFFD; ids out of range are nothing."""
        if ids and (min(ids) < 0 or max(ids) >= self.size):
            ids = [i for i in ids if 0 <= i < self.size]
        return b"".join(map(self.bytes.__getitem__, ids)).decode(errors="replace")


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    """One for each Python worker. The file comes with an installed package, or lies at the same
    path on all machines."""
    return Vocabulary(path)


def _in_parts(column: pa.Array, most: int = 4_000_000):
    """Values of a column, some MB at a time."""
    part, size = [], 0
    for x in column:
        x = x.as_py()
        part.append(x)
        size += len(x) if x else 0
        if size > most or len(part) >= 10_000:
            yield part
            part, size = [], 0
    yield part


def encode(text: Column, path: str) -> Column:
    """The ids of a text, as array<int>."""

    def ids(column: pa.Array) -> pa.Array:
        own = vocabulary(path)
        found = [s for part in _in_parts(column) for s in own.encode(part)]
        return pa.array([np.array(s.split(","), np.int32) if s else [] for s in found], pa.list_(pa.int32()))

    return arrow(ids, "array<int>")(text)


def decode(ids: Column, path: str) -> Column:
    """The text of ids; null ids count as none."""

    def text(column: pa.Array) -> pa.Array:
        own = vocabulary(path)
        return pa.array([own.decode(x) if x else "" for part in _in_parts(column) for x in part], pa.string())

    return arrow(text, "string")(ids)


def digests(text: Column, path: str) -> Column:
    """n_tokens, ids_sha256 and decoded_sha256 of a text that is encoded and decoded again."""
    kind = pa.struct([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def digest(column: pa.Array) -> pa.Array:
        own, rows = vocabulary(path), []
        for part in _in_parts(column):
            for joined in own.encode(part):
                ids = list(map(int, joined.split(","))) if joined else []
                back = own.decode(ids)
                rows.append((len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
        return pa.array([dict(zip(("n_tokens", "ids_sha256", "decoded_sha256"), r, strict=True)) for r in rows], kind)

    return arrow(digest, "n_tokens long, ids_sha256 string, decoded_sha256 string")(text)


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    """One row for each document: its id and the digests of its tokens."""
    return docs.select("doc_id", digests(F.col("text"), path).alias("d")).select("doc_id", "d.*")
