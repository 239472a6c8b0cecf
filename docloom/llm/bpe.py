"""Byte-level BPE as a bounded-lookahead streaming transducer, and an incremental decoder.

Merging by priority, whether any merge ever crosses a boundary depends on a bounded stretch to its right only: a merge (a, b)
is prevented by a merge (b, c) of higher priority, that one by (c, d) of still higher priority, and so on, and b itself may
depend on what follows it. The longest such chain is computed from the merge list. So a piece is merged in a window; what
ends at least that far before the window's end is stable and is emitted, and the window moves on. Memory stays constant
however long a piece is.

Pieces come from the pre-tokeniser's pattern, one after the other. Short ones are memoised in two generations of bounded size.
Decoding looks tokens up as bytes and feeds them to an incremental UTF-8 decoder.

Defined results: null text counts as empty and has no tokens; rows are independent, so repeated rows give equal results; an
empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StructField, StructType

from docloom.llm.common import let_go, slices

#: Pieces above are merged in a moving window and not memoised.
LONG = 64
#: Bytes, roughly, of a generation of memoised pieces.
MEMO = 24_000_000
#: Pieces handled at a time.
CHUNK = 1 << 14
#: Fixed: the code points with the Unicode property White_Space, as pattern.
WHITE = r"\t-\r\x20\x85\xa0  -     　"


def _class(kinds: str, last: int) -> str:
    """The characters up to `last` whose general category begins with one of the letters, as the inside of a class."""
    out, start = [], None
    for i in range(last + 2):
        inside = i <= last and unicodedata.category(chr(i))[0] in kinds
        if inside and start is None:
            start = i
        elif not inside and start is not None:
            out.append(f"\\U{start:08x}-\\U{i - 1:08x}" if i - 1 > start else f"\\U{start:08x}")
            start = None
    return "".join(out)


def piece_pattern(last: int = sys.maxunicode) -> re.Pattern:
    """The pre-tokeniser's pattern for texts without characters above `last`; a narrow one runs several times faster."""
    letter, number = _class("L", last), _class("N", last)
    return re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{WHITE}{letter}{number}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
    )


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies: itself, or the next free from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return {b: chr(b if b in plain else next(spare)) for b in range(256)}


class Transducer:
    """Encoder and decoder of a byte-level vocabulary file of the tokenizers library."""

    def __init__(self, file: str):
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec["pre_tokenizer"], spec["model"]
        if pre != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True} or spec["normalizer"]:
            raise ValueError("a byte-level vocabulary without normaliser or prefix space is asked for")
        to_byte = {c: b for b, c in byte_letters().items()}
        self.ids = {bytes(to_byte[c] for c in t): i for t, i in model["vocab"].items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = [b""] * (max([*self.ids.values(), *self.added.values()]) + 1)
        for t, i in chain(self.ids.items(), ((k.encode(), v) for k, v in self.added.items())):
            self.bytes_of[i] = t
        self.text_of = [str(i) for i in range(len(self.bytes_of))]
        pairs = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        encode = lambda t: bytes(to_byte[c] for c in t)
        merges = [(encode(a), encode(b)) for a, b in pairs]
        self.lookahead = sufficient_lookahead(merges)
        # tokens as numbers, bytes first; a pair as one number -> its rank, and rank -> the token made
        number_of = {bytes([b]): b for b in range(256)}
        for a, b in merges:
            number_of.setdefault(a + b, len(number_of))
        self.id_of = [self.ids[t] for t in number_of]
        self.made = [number_of[a + b] for a, b in merges]
        self.rank = {number_of[a] << 32 | number_of[b]: r for r, (a, b) in reversed(list(enumerate(merges)))}
        self.wide, self.narrow = piece_pattern(), piece_pattern(0xFF)
        self.special = re.compile("|".join(map(re.escape, self.added))) if self.added else None
        self.memo: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.memo_bytes = 0

    def merge(self, data: bytes) -> list[int]:
        """The ids of the bytes: the pair of highest priority is merged, the leftmost first, until none is left."""
        parts = list(data)
        rank, made = self.rank.get, self.made
        none = len(made)
        ranks = [rank(a << 32 | b, none) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            parts[i] = new = made[best]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank(parts[i - 1] << 32 | new, none)
            if i < len(ranks):
                ranks[i] = rank(new << 32 | parts[i + 1], none)
        return [self.id_of[p] for p in parts]

    def stream(self, data: bytes) -> Iterator[int]:
        """The ids of a piece of any length, from a window of bounded size."""
        step = max(256, self.lookahead)
        at = 0
        while len(data) - at > step + self.lookahead:
            stable = 0
            for token in self.merge(data[at : at + step + self.lookahead]):
                size = len(self.bytes_of[token])
                if stable + size > step:
                    break
                stable += size
                yield token
            at += stable
        yield from self.merge(data[at:])

    def _piece(self, piece: str) -> tuple[int, ...]:
        found = self.memo.get(piece) or self.older.get(piece)
        if found is None:
            data = piece.encode("utf-8", "replace")
            if len(data) > LONG:
                return tuple(self.stream(data))
            found = tuple(self.merge(data))
        if self.memo_bytes >= MEMO:
            self.memo, self.older, self.memo_bytes = {}, self.memo, 0
        self.memo_bytes += 200 + len(piece) + 8 * len(found)
        self.memo[piece] = found
        return found

    def _plain(self, text: str) -> Iterator[list[int]]:
        try:
            text.encode("latin-1")
            pattern = self.narrow
        except UnicodeEncodeError:
            pattern = self.wide
        pieces = (m[0] for m in pattern.finditer(text)) if len(text) > 1 << 20 else iter(pattern.findall(text))
        while part := list(islice(pieces, CHUNK)):
            memo = self.memo
            yield list(chain.from_iterable([memo.get(p) or self._piece(p) for p in part]))

    def encode(self, text: str) -> Iterator[list[int]]:
        """Lists of ids, as the text is read. Added tokens are found first; the pattern sees what lies between them."""
        at = 0
        for hit in self.special.finditer(text) if self.special else ():
            yield from self._plain(text[at : hit.start()])
            yield [self.added[hit[0]]]
            at = hit.end()
        yield from self._plain(text[at:] if at else text)

    def decode(self, ids: Iterator[list[int]]) -> Iterator[str]:
        """Text as the ids are read; bytes of an unfinished character wait for the next."""
        state = codecs.getincrementaldecoder("utf-8")("replace")
        table = self.bytes_of
        for part in ids:
            yield state.decode(b"".join([table[i] for i in part]))
        yield state.decode(b"", True)


def sufficient_lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes to the right of a boundary that decide whether a merge crosses it.

    far[t]: bytes to the right of token t that decide whether it is formed. reach[b]: the most that any merge (b, c) seen so
    far looks past b. In order of priority, a merge (a, b) looks past its end as far as b's own forming or a merge (b, c) of
    higher priority does.
    """
    far: dict[bytes, int] = {}
    reach: dict[bytes, int] = {}
    most = 0
    for a, b in merges:
        look = max(far.get(b, 0), reach.get(b, 0))
        most = max(most, len(b) + look)
        far[a + b] = max(far.get(a + b, 0), look)
        reach[a] = max(reach.get(a, 0), len(b) + look)
    return most


@lru_cache(maxsize=4)
def transducer(file: str) -> Transducer:
    """The transducer of this worker, with its memo."""
    return Transducer(file)


def round_trip(texts: list[str | None], file: str) -> pd.DataFrame:
    coder = transducer(file)
    name = coder.text_of
    out = []
    for text in texts:
        ids_hash, text_hash, n = hashlib.sha256(), hashlib.sha256(), 0

        def listed(parts: Iterator[list[int]]) -> Iterator[list[int]]:
            nonlocal n
            for part in parts:
                if part:
                    ids_hash.update((("," if n else "") + ",".join([name[i] for i in part])).encode())
                    n += len(part)
                yield part

        for part in coder.decode(listed(coder.encode(text or ""))):
            text_hash.update(part.encode())
        out.append((n, ids_hash.hexdigest(), text_hash.hexdigest()))
    return pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256"])


def encoded(docs: DataFrame, file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids, the tokens of every row's text."""

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        coder = transducer(file)
        return pd.Series([list(chain.from_iterable(coder.encode(t or ""))) for t in texts], dtype=object)

    return docs.select(F.col(id_col).alias("doc_id"), ids(F.col(text_col)).alias("ids"))


def encoded_rows(docs: DataFrame, file: str, text_col: str = "text") -> DataFrame:
    """`docs` with ids, the tokens of every row's text, and round_trip, whether they decode to it. Columns of `docs` with these
    names give way. A slice of rows is encoded at a time, and decoded as the ids come."""
    rest = [c for c in docs.columns if c.lower() not in ("ids", "round_trip")]
    rows = docs.select(*(F.col(f"`{c}`") for c in rest))
    place = rest.index(text_col)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        coder = transducer(file)
        for batch in batches:
            for some in slices(batch, place, rows=64, size=1 << 20):
                ids, ends, same = [np.empty(0, dtype=np.int32)], [0], []
                for text in some.column(place).to_pylist():
                    n = ends[-1]
                    at, whole, text = 0, True, text or ""

                    def kept(parts: Iterator[list[int]]) -> Iterator[list[int]]:
                        nonlocal n
                        for part in parts:
                            ids.append(np.array(part, dtype=np.int32))
                            n += len(part)
                            yield part

                    for part in coder.decode(kept(coder.encode(text))):
                        whole &= text.startswith(part, at)
                        at += len(part)
                    ends.append(n)
                    same.append(whole and at == len(text))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids)))
                yield pa.record_batch([*some.columns, lists, pa.array(same, pa.bool_())], names=[*rest, "ids", "round_trip"])

    schema = StructType([*rows.schema.fields, StructField("ids", ArrayType(IntegerType())), StructField("round_trip", BooleanType())])
    return rows.mapInArrow(code, schema)


def decoded(tokens: DataFrame, file: str) -> DataFrame:
    """doc_id and text of rows (doc_id, ids)."""

    @F.pandas_udf("string")
    def text(rows: pd.Series) -> pd.Series:
        coder = transducer(file)
        return pd.Series(["".join(coder.decode(iter([list(r)]))) for r in rows], dtype=object)

    return tokens.select("doc_id", text("ids").alias("text"))


def bpe_digest(docs: DataFrame, file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row."""

    @F.pandas_udf("n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    def digest(texts: pd.Series) -> pd.DataFrame:
        return round_trip(texts.tolist(), file)

    return docs.select(F.col(id_col).alias("doc_id"), digest(F.col(text_col)).alias("d")).select("doc_id", "d.*")
