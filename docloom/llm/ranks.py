"""Byte-level BPE by the tiktoken library with a local file of ranks, and raw-byte decoding.

A long text is cut before the library sees it, at places where no match of the pattern can go across and that no match looks
past: where white space follows something else, and where an ASCII digit follows an ASCII letter. The library's pattern engine
gives up on very long runs of white space, so such a run is cut as the pattern cuts it: all of it at the end of a text, else
all but its last character, which belongs to what follows; the run is then encoded as one match.

Ids come part by part and decode to the bytes of their tokens, in order; only a whole text is sure to be UTF-8.

Defined results: null text counts as empty and has no tokens; rows are independent, so rows that repeat an id or a text, or
have a null id, give a row each; an empty table gives an empty result; other columns don't matter, whatever their names. A
text of any length is cut into parts; only a run that the pattern takes as one match (letters, digits, signs) is one part.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.bpe import WHITE

#: Characters of a text that are handed to the library at once, roughly.
PART = 1 << 16
#: Rows of a batch that are handled together.
ROWS = 256

SAFE = re.compile(f"(?<=[^{WHITE}])(?=[{WHITE}])|(?<=[A-Za-z])(?=[0-9])")
WHITE_RUN = re.compile(f"[{WHITE}]{{{PART},}}")


def parts_of(text: str, part: int = PART, run: re.Pattern = WHITE_RUN) -> Iterator[tuple[str, bool]]:
    """(part, whether it is one match of the pattern) of a text, in order."""
    at = 0
    while len(text) - at > part:
        found = SAFE.search(text, at + part)
        end = found.start() if found else len(text)
        for white in run.finditer(text, at, end):
            if white.start() > at:
                yield text[at : white.start()], False
            at = white.end() if white.end() == len(text) else white.end() - 1
            yield text[white.start() : at], True
        if end > at:
            yield text[at:end], False
        at = end
    if at < len(text):
        yield text[at:], False


class RankCoder:
    """Encoder and decoder by a file of ranks: a token in base64 and its rank in each line."""

    def __init__(self, file: str, pattern: str):
        with open(file, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.library = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str | None) -> Iterator[list[int]]:
        for part, one in parts_of(text or ""):
            yield self.library._encode_single_piece(part) if one else self.library.encode_ordinary(part)

    def decode(self, ids: Iterator[list[int]]) -> Iterator[bytes]:
        for part in ids:
            yield self.library.decode_bytes(part)


@lru_cache(maxsize=4)
def rank_coder(file: str, pattern: str) -> RankCoder:
    return RankCoder(file, pattern)


def _per_row(docs: DataFrame, id_col: str, value_col: str, make, schema: str) -> DataFrame:
    """doc_id and what `make` gives for each value, as columns of `schema`; a slice of rows is held at a time."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                made = list(zip(*(make(v) for v in some.column(1).to_pylist())))
                yield pa.record_batch([some.column(0), *(pa.array(c) for c in made)], names=["doc_id", *names])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(value_col).alias("value"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {schema}")


def encoded(
    docs: DataFrame, file: str, pattern: str = public_tokenizers.PATTERN, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit numbers) of every row's text."""

    def make(text: str | None) -> tuple[bytes]:
        coder = rank_coder(file, pattern)
        return (b"".join(np.array(part, dtype="<u4").tobytes() for part in coder.encode(text)),)

    return _per_row(docs, id_col, text_col, make, "ids binary")


def decoded(tokens: DataFrame, file: str, pattern: str = public_tokenizers.PATTERN, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and data (the bytes of the tokens) of every row's ids, as `encoded` gives them; null counts as none."""

    def make(ids: bytes | None) -> tuple[bytes]:
        coder = rank_coder(file, pattern)
        numbers = np.frombuffer(ids or b"", dtype="<u4")
        parts = (numbers[at : at + PART].tolist() for at in range(0, len(numbers), PART))
        return (b"".join(coder.decode(parts)),)

    return _per_row(tokens, id_col, ids_col, make, "data binary")


def rank_digest(
    docs: DataFrame, file: str, pattern: str = public_tokenizers.PATTERN, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row; ids are decoded as they come."""

    def make(text: str | None) -> tuple[int, str, str]:
        coder, n = rank_coder(file, pattern), 0
        ids_hash, bytes_hash = hashlib.sha256(), hashlib.sha256()
        for part in coder.encode(text):
            n += len(part)
            ids_hash.update(np.array(part, dtype="<u4").tobytes())
            bytes_hash.update(coder.library.decode_bytes(part))
        return n, ids_hash.hexdigest(), bytes_hash.hexdigest()

    return _per_row(docs, id_col, text_col, make, "n_tokens bigint, ids_sha256 string, decoded_sha256 string")
