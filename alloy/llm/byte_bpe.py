"""Byte-level BPE encoding and decoding with the tiktoken library.

The ranks come from a local file; its path is a parameter and the file is
read on the executors, once per Python worker.  Long texts are cut before a
blank that follows a non-blank.  GPT-2-like patterns always start a new match
there, so the pieces' ids joined are the whole text's ids.  A pattern whose
matches go on from a non-blank into a blank (punctuation with the line breaks
after it) needs another cut: pass such a pattern only for texts up to ``PIECE``.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from alloy.llm.common import map_arrow, pick

#: Characters of a piece at least; the cut is the first safe one after them.
PIECE = 1 << 16
_SAFE = re.compile(r"(?<=\S)(?=[ \t\n\r])")
BATCH = 256


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str):
    """The tiktoken encoding of a rank file (base64 token and rank per line), no special tokens."""
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """``text`` cut at safe boundaries into pieces of ``size`` characters or a little more."""
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def encode(enc, text: str, size: int = PIECE) -> list[int]:
    if len(text) <= size:
        return enc.encode_ordinary(text)
    ids: list[int] = []
    for piece in pieces(text, size):
        ids += enc.encode_ordinary(piece)
    return ids


def decode(enc, ids: list[int]) -> bytes:
    """The raw bytes of the ids; a cut inside a character is no error."""
    return enc.decode_bytes(ids)


def _tokenize(path: str, pattern: str, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path, pattern)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                ids = [encode(enc, t.as_py() or "") for t in batch.column(1)]
                n = pa.array([len(x) for x in ids], pa.int64())
                if not digests:
                    yield pa.record_batch([batch.column(0), n, pa.array(ids, pa.list_(pa.int32()))],
                                          ["doc_id", "n_tokens", "ids"])
                    continue
                said = [hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest() for x in ids]
                back = [hashlib.sha256(decode(enc, x)).hexdigest() for x in ids]
                yield pa.record_batch([batch.column(0), n, pa.array(said), pa.array(back)],
                                      ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def tokenize(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids (array of int).

    A NULL or empty text has no ids.  Rows are independent, so repeated rows
    repeat their result; other columns of ``docs`` are not read.  The rank
    file must be at ``path`` on every executor.
    """
    return map_arrow(pick(docs, "doc_id", "text"), _tokenize(path, pattern, False),
                     "doc_id long, n_tokens long, ids array<int>")


def token_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Like ``tokenize``, with digests in place of the ids.

    ids_sha256: of the decimal ids joined by one space; decoded_sha256: of
    the bytes that the ids decode to.
    """
    return map_arrow(pick(docs, "doc_id", "text"), _tokenize(path, pattern, True),
                     "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _detokenize(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path, pattern)
        for batch in batches:
            out = [None if x is None else decode(enc, x) for x in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "data"])
    return run


def detokenize(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per row of (doc_id, ids): doc_id and the decoded bytes ``data`` (NULL ids: NULL)."""
    return map_arrow(pick(tokens, "doc_id", "ids"), _detokenize(path, pattern), "doc_id long, data binary")
