"""BPE encoding and decoding by forced-boundary splitting.

Two neighbouring bytes that stand together inside no vocabulary token can never be merged, so the text may
be cut between them: the fragments are encoded on their own and concatenated. White space stands inside no
token, which cuts a text into words; inside a word, `Splitter` cuts where the vocabulary forces it. Words and
fragments recur, so each is encoded once per worker (bounded, the store is emptied when full).

The pieces are normalised, split and merged by the tokenizer's own parts; only the cuts are ours.

Defined cases: a null or empty text has no ids and decodes to the empty text; the strings of special tokens
in a text are those tokens, as in the library; repeated rows are encoded alike; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from array import array
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

VOCABULARY = "word_bpe_49k.json"
#: Words, and fragments, a worker remembers: the last full store and the one being filled.
STORE = 150_000


class Memory(dict):
    """A bounded store: when full, it becomes the old store and a new one is begun."""

    def __init__(self, make):
        self.make, self.old = make, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= STORE:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def _classes() -> tuple[re.Pattern, re.Pattern]:
    """Visible characters below U+0250, and the tokenizer's pieces for words made of them."""
    kinds: dict[str, str] = {"L": "", "N": ""}
    for code in range(0x21, 0x250):
        kind = unicodedata.category(chr(code))[0]
        if kind in kinds:
            kinds[kind] += chr(code)
    letter, number = (f"[{kinds[k]}]" for k in "LN")
    return (re.compile("[\x21-\x7e\xa1-\u012f\u0131-\u024f]+"),
            re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|{letter}+|{number}|[^\\s{kinds['L']}{kinds['N']}]+"))


SIMPLE, PIECES = _classes()


class Splitter:
    """Encodes single words of a word-level BPE vocabulary file, cut at forced boundaries."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.tail = model["end_of_word_suffix"] or ""
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        # the same merges for fragments that do not end a word
        spec["model"] = {**model, "end_of_word_suffix": None}
        self.inner = Tokenizer.from_str(json.dumps(spec)).model
        self.final = self.whole.model
        names = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.special = names
        self.cut_special = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.text_of = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in names.items()}
        self.inside: set[tuple[str, str]] = set()
        for token in model["vocab"]:
            body = token.removesuffix(self.tail) if self.tail else token
            self.inside.update(zip(body, body[1:]))
        # the byte letters of the tokenizer: visible Latin-1 characters stand for themselves
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in plain]
        self.letters = {b: 256 + k for k, b in enumerate(others)}
        self.words = Memory(self.word)
        self.known = Memory(self._piece)

    def cut(self, piece: str) -> list[str]:
        """The fragments of one piece, given in the tokenizer's byte letters."""
        if self.inside.issuperset(zip(piece, piece[1:])):
            return [piece]
        found, start = [], 0
        for k, pair in enumerate(zip(piece, piece[1:]), 1):
            if pair not in self.inside:
                found.append(piece[start:k])
                start = k
        return [*found, piece[start:]]

    def _piece(self, piece: str) -> tuple[bytes, str]:
        *head, end = self.cut(piece)
        ids = [token.id for fragment in head for token in self.inner.tokenize(fragment)]
        return self._known(ids + [token.id for token in self.final.tokenize(end)])

    def _known(self, ids: list[int]) -> tuple[bytes, str]:
        codes = array("I", ids)
        if sys.byteorder == "big":
            codes.byteswap()
        return codes.tobytes(), " ".join([self.text_of[i] for i in ids])

    def pieces(self, text: str) -> list[str]:
        """The tokenizer's pieces in its byte letters. Short cut for words of visible characters below
        U+0250 (but U+0130), which normalisation only lower-cases."""
        if SIMPLE.fullmatch(text):
            found = PIECES.findall(text.lower())
            if text.isascii():
                return found
            return [x.encode().decode("latin-1").translate(self.letters) for x in found]
        return [x for x, _ in self.whole.pre_tokenizer.pre_tokenize_str(self.whole.normalizer.normalize_str(text))]

    def word(self, word: bytes) -> tuple[bytes, str]:
        """(ids as little-endian unsigned 32-bit integers, their decoded text)."""
        text, known = word.decode(), self.known
        if self.cut_special and "<|" in text:
            found = [self._known([self.special[part]]) if k % 2 else known[piece]
                     for k, part in enumerate(self.cut_special.split(text)) if part
                     for piece in ([part] if k % 2 else self.pieces(part))]
        else:
            found = [known[piece] for piece in self.pieces(text)]
        if len(found) == 1:
            return found[0]
        return b"".join([x for x, _ in found]), " ".join([y for _, y in found])

    def encode(self, text: str | None) -> tuple[bytes, str]:
        """(ids, decoded text) of a whole text."""
        words = self.words
        found = [words[word] for word in (text or "").encode().split()]
        return b"".join([x for x, _ in found]), " ".join([y for _, y in found if y])


@lru_cache(maxsize=2)
def splitter(path: str) -> Splitter:
    return Splitter(path)


def _run(docs: DataFrame, columns: list[str], kind: str, path: str | None, make) -> DataFrame:
    where = path or public_tokenizers.path(VOCABULARY)

    def run(batches):
        own = splitter(where)
        for batch in batches:
            for start in range(0, len(batch), 512):
                part = batch.slice(start, 512)
                yield make(part, [own.encode(t.as_py()) for t in part.column(part.num_columns - 1)])
    rest = [F.col(f"`{c}`") for c in columns]
    return docs.select(*rest, F.col("text").cast("string").alias("_text")).mapInArrow(run, kind)


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row."""
    def make(part, found):
        sha = lambda values: pa.array([hashlib.sha256(x).hexdigest() for x in values], pa.string())
        return pa.RecordBatch.from_arrays(
            [part.column(0), pa.array([len(x) // 4 for x, _ in found], pa.int64()),
             sha(x for x, _ in found), sha(y.encode() for _, y in found)],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    return _run(rows, ["doc_id"], "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
                path, make)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): ids as an array, and the text they decode to."""
    def make(part, found):
        lists = pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x, _ in found], pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays(
            [part.column(0), pa.array([len(x) // 4 for x, _ in found], pa.int64()), lists,
             pa.array([y for _, y in found], pa.string())], ["doc_id", "n_tokens", "ids", "decoded"])
    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    return _run(rows, ["doc_id"], "doc_id bigint, n_tokens bigint, ids array<int>, decoded string", path, make)
