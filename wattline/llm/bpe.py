"""Byte-level BPE by a local rank file: encode with tiktoken, decode from the raw bytes of the ranks.

Long texts are cut before encoding where the pre-splitting pattern always ends a match, so that no native call sees
more than about ``CHUNK`` characters of ordinary prose; what cannot be cut there (a single run of blanks or symbols)
is split with the pattern itself and merged piece by piece.
"""

from __future__ import annotations

import base64
import functools
import hashlib

import regex
import tiktoken
from pyspark.sql import DataFrame

from wattline.llm.common import annotated, schema

#: Characters that are encoded in one call.
CHUNK = 100_000

#: After a letter or digit, a match ends where the class changes: no alternative of the pattern spans that place and
#: none looks behind. A blank belongs to what follows it, hence the place before a single blank is covered too.
SAFE = regex.compile(r"(?<=\p{L})(?=\P{L})|(?<=\p{N})(?=\P{N})")


def chunks(text: str, size: int = CHUNK) -> list[str]:
    """Parts whose separate encodings, joined, are the encoding of ``text``; each as long as ``size`` allows."""
    out, at = [], 0
    while len(text) - at > size:
        cut = SAFE.search(text, at + size)
        if cut is None:
            break
        out.append(text[at : cut.start()])
        at = cut.start()
    return [*out, text[at:]]


class Codec:
    """Encoding and decoding with the ranks of one file and one pre-splitting pattern, without special tokens."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pieces = regex.compile(pattern)
        self.raw = {rank: token for token, rank in ranks.items()}
        self.digits = {rank: str(rank) for rank in self.raw}

    def encode(self, text: str, size: int = CHUNK) -> list[int]:
        if len(text) <= size:
            return self.encoding.encode_ordinary(text)
        ids: list[int] = []
        for part in chunks(text, size):
            if len(part) <= 2 * size:
                ids += self.encoding.encode_ordinary(part)
            else:  # no safe place for long: the engine's own backtracking could overflow
                for match in self.pieces.finditer(part):
                    ids += self.encoding._encode_single_piece(match.group().encode())
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.raw.__getitem__, ids))


@functools.lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    """One codec per worker process and file."""
    return Codec(path, pattern)


FIELDS = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def round_trip(docs: DataFrame, ranks: str, pattern: str, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` columns and, per row, the number of ids, the digest of the ids and the digest of the decoded bytes.

    Null is the empty text: no ids, digests of nothing. Every row of the input gives one row, repeated rows repeated
    ones. ``ranks`` must be readable on every worker.
    """

    def start():
        own = codec(ranks, pattern)

        def made(texts: list) -> list[list]:
            count, coded, plain = [], [], []
            for value in texts:
                ids = own.encode(value or "")
                count.append(len(ids))
                coded.append(hashlib.sha256(" ".join(map(own.digits.__getitem__, ids)).encode()).hexdigest())
                plain.append(hashlib.sha256(own.decode(ids)).hexdigest())
            return [count, coded, plain]

        return made

    return annotated(docs, text, list(carry), schema(FIELDS), start)


def encoded(docs: DataFrame, ranks: str, pattern: str, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` columns and the ids themselves as ``ids array<int>``; null is the empty text."""

    def start():
        own = codec(ranks, pattern)
        return lambda texts: [[own.encode(value or "") for value in texts]]

    return annotated(docs, text, list(carry), schema("ids array<int>"), start)


def decoded(tokens: DataFrame, ranks: str, pattern: str, ids: str = "ids", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` columns and the raw bytes of ``ids`` as ``decoded binary``; null ids are none, an unknown id raises."""

    def start():
        own = codec(ranks, pattern)
        return lambda lists: [[own.decode(value or []) for value in lists]]

    return annotated(tokens, ids, list(carry), schema("decoded binary"), start)
