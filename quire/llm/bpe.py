"""Exact byte-level BPE encoding in linear time, over a public vocabulary file.

Bytes are mapped to Latin-1 characters so that an Aho-Corasick automaton finds, in
one pass, the longest vocabulary entry at every position. A backtracking walk takes
longest matches and falls back to shorter prefixes; an adjacent pair of tokens is
kept only if merging by rank could have left exactly this pair, which is memoised.
The result equals applying the merges one by one.

Defined results: null and empty text give an empty list; marks that look like special
tokens are ordinary text; lone surrogates cannot occur in Spark strings.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import types as T

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Words kept in a worker's memo before it starts anew: a bound on memory, not on the data.
MEMO_WORDS = 400_000
#: Longer pieces are encoded without the memo.
MEMO_BYTES = 64
#: The pre-splitting pattern of the vocabulary (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same pattern for texts of printable ASCII and line ends, where plain classes are equal to it.
ASCII_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\s0-9A-Za-z]+|\s+(?!\S)|\s+"""


def _printable_bytes() -> dict[str, int]:
    """The vocabulary's alphabet: printable bytes stand for themselves, the others follow from 256 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder:
    """Encoder for one vocabulary file with ``model.vocab`` and ``model.merges``."""

    def __init__(self, path: str):
        import ahocorasick
        import re

        import regex

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        byte_of = _printable_bytes()
        latin = lambda s: "".join(chr(byte_of[c]) for c in s)
        vocab = {latin(k): v for k, v in model["vocab"].items() if all(c in byte_of for c in k)}
        self.size = max(vocab.values()) + 1
        self.text_of: list[str] = [""] * self.size
        for k, v in vocab.items():
            self.text_of[v] = k
        self.split: list[tuple[int, int]] = [(i, i) for i in range(self.size)]
        self.pair: dict[tuple[int, int], int] = {}
        for merge in model["merges"]:
            a, b = (latin(x) for x in (merge.split(" ") if isinstance(merge, str) else merge))
            left, right, made = vocab[a], vocab[b], vocab[a + b]
            self.split[made] = (left, right)
            self.pair[left, right] = made
        # Ranks of merges must rise with the ids, which the walk relies on.
        automaton = ahocorasick.Automaton()
        for k, v in vocab.items():
            automaton.add_word(k, (len(k), v))
        automaton.make_automaton()
        self.automaton = automaton
        self.prefix = [-1] * self.size  # the longest shorter entry that an entry starts with
        for k, v in vocab.items():
            for n in range(len(k) - 1, 0, -1):
                if (p := vocab.get(k[:n])) is not None:
                    self.prefix[v] = p
                    break
        self.fits: dict[tuple[int, int], bool] = {}
        self.memo: dict[str, array] = {}
        self.any_split = regex.compile(PATTERN).findall
        self.ascii_split = re.compile(ASCII_PATTERN, re.ASCII).findall
        self.plain = re.compile(r"[\t\n\r -~]*", re.ASCII).fullmatch

    def fit(self, a: int, b: int) -> bool:
        """Whether merging by rank can leave token ``a`` directly before token ``b``."""
        key = (a, b)
        known = self.fits.get(key)
        if known is not None:
            return known
        limit, good = self.size + 1, True
        while True:
            made = self.pair.get((a, b))
            if made is not None and made < limit:
                good = False
                break
            if a > b:
                limit, a = a, self.split[a][1]
                if a == limit:
                    limit, b = b + 1, self.split[b][0]
                    if b + 1 == limit:
                        break
            else:
                limit, b = b + 1, self.split[b][0]
                if b + 1 == limit:
                    limit, a = a, self.split[a][1]
                    if a == limit:
                        break
        if len(self.fits) >= 4 * MEMO_WORDS:
            self.fits.clear()
        self.fits[key] = good
        return good

    def piece(self, text: str) -> array:
        """Tokens of one pre-split piece."""
        s = text.encode("utf-8").decode("latin-1")
        size = len(s)
        longest, length = [-1] * size, [0] * size
        for end, (n, token) in self.automaton.iter(s):
            at = end - n + 1
            if n > length[at]:
                length[at], longest[at] = n, token
        if length[0] == size:
            return array("i", (longest[0],)) if self._whole(longest[0]) else self._walk(size, longest)
        return self._walk(size, longest)

    def _whole(self, token: int) -> bool:
        """A vocabulary entry made by merges (or a single byte) encodes as itself."""
        return self.split[token][0] != token or len(self.text_of[token]) == 1

    def _walk(self, size: int, longest: list[int]) -> array:
        out, starts, open_end = array("i"), [], bytearray(b"\1") * (size + 1)
        at, token = 0, longest[0]
        text_of, prefix, fit = self.text_of, self.prefix, self.fit
        while True:
            end = at + len(text_of[token])
            if open_end[end] and (not out or fit(out[-1], token)):
                out.append(token)
                starts.append(at)
                at = end
                if at == size:
                    return out
                token = longest[at]
                continue
            token = prefix[token]
            while token < 0:  # nothing shorter: this position is a dead end
                open_end[at] = 0
                last = out.pop()
                at = starts.pop()
                token = prefix[last]

    def encode(self, text: str | None) -> array:
        out = array("i")
        if not text:
            return out
        memo = self.memo
        for piece in self.ascii_split(text) if self.plain(text) else self.any_split(text):
            found = memo.get(piece)
            if found is None:
                found = self.piece(piece)
                if len(piece) <= MEMO_BYTES:
                    if len(memo) >= MEMO_WORDS:
                        memo.clear()
                    memo[piece] = found
            out.extend(found)
        return out


@lru_cache(maxsize=2)
def encoder(path: str = VOCABULARY) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(path)


def ship(df: DataFrame, path: str) -> None:
    """Sends the vocabulary file of the driver to all workers, so that it need not lie on their machines."""
    if os.path.exists(path):
        df.sparkSession.sparkContext.addFile(path)


def located(path: str) -> str:
    """In a worker: the shipped file, or else the path itself."""
    shipped = SparkFiles.get(os.path.basename(path))
    return shipped if os.path.exists(shipped) else path


def encode_column(df: DataFrame, key: str, text: str, out: str, path: str = VOCABULARY) -> DataFrame:
    """``key`` and the token ids of ``text`` as ``out`` (array of int, never null). Narrow, Arrow batches."""
    ship(df, path)
    schema = T.StructType([df.schema[key], T.StructField(out, T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(located(path))
        for batch in batches:
            ids = [enc.encode(t) for t in batch.column(1).to_pylist()]
            offsets = np.zeros(len(ids) + 1, dtype=np.int32)
            np.cumsum([len(x) for x in ids], out=offsets[1:])
            flat = array("i")
            for x in ids:
                flat.extend(x)
            values = pa.array(np.frombuffer(flat, dtype=np.int32)) if len(flat) else pa.array([], pa.int32())
            lists = pa.ListArray.from_arrays(pa.array(offsets), values)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=[key, out])

    return df.select(key, text).mapInArrow(run, schema)


def count_column(df: DataFrame, key: str, text: str, out: str, path: str = VOCABULARY) -> DataFrame:
    """``key`` and the number of tokens of ``text`` as ``out`` (0 for null and empty)."""
    ship(df, path)
    schema = T.StructType([df.schema[key], T.StructField(out, T.IntegerType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(located(path))
        for batch in batches:
            n = pa.array([len(enc.encode(t)) for t in batch.column(1).to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), n], names=[key, out])

    return df.select(key, text).mapInArrow(run, schema)
