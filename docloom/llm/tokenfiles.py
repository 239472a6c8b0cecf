"""Token-ID output: ids ranked by frequency in byte-aligned variable-length coding, read back by numpy table lookup.

1. Texts are encoded with the tokenizers library and the ids are written once under the shared folder.
2. The ids are counted, a row for each id at most, and ranked: the most frequent is 0 and takes one byte.
3. Documents are range-partitioned and sorted by id; each task streams its range into one file. The file's name is new for
   each attempt, and only files of committed tasks enter the manifest, which Spark writes: a lost executor costs its tasks.
4. Files are read back block by block from the manifest.

A file is a sequence of blocks: magic, counts, the documents' ids and lengths, then one control byte for every four ranks
(two bits each: data bytes less one), then the data bytes, little-endian. The folder also holds the rank table.

The library sees recent words once for each worker, many at a time. Words of Latin-1 texts are cut into pieces by the vocabulary's
own pattern. Other texts are cut at ASCII space only, which its pre-tokeniser, composition and lower-casing never cross.

Defined results: null text counts as empty and gives the end id alone; rows that repeat an id follow each other in any order,
and may lie in several files, as a number given to each row breaks the tie; a null id comes first; ids are cast to bigint, so
a text id that is no number raises; an empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.llm.bpe import WHITE, _class, byte_letters
from docloom.llm.common import discard, new_dir, slices, written

#: Words of a generation.
MEMO = 400_000
#: Characters of a text that are cut into pieces at once, roughly.
PART = 1 << 20
#: Ids gathered before a block is written.
BLOCK = 1 << 18
MAGIC = b"TKB1"
HEAD = struct.Struct("<4sIQQQ")
NO_ID = -(1 << 63)


# ---------------------------------------------------------------- encoding


class WordEncoder:
    """Ids of texts by a vocabulary file whose pre-tokeniser drops white space."""

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(file)
        self.library.no_truncation()
        self.library.no_padding()
        vocab = self.library.get_vocab()
        self.kind = np.dtype("<u2") if len(vocab) <= 1 << 16 else np.dtype("<u4")
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        # the same model for pieces in byte letters, which need neither composing nor cutting
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        bare = {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "post_processor": None, "decoder": None}
        self.bare = Tokenizer.from_str(json.dumps({**spec, **bare, "truncation": None, "padding": None, "added_tokens": []}))
        self.letters = {**byte_letters(), ord(" "): " "}
        letter, number = _class("L", 0xFF), _class("N", 0xFF)
        self.pattern = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{number}]|[^{WHITE}{letter}{number}]+")
        self.plain, self.words = Recent(self._plain_words), Recent(self._words)

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=self.kind) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _plain_words(self, words: list[str]) -> list[bytes]:
        """Ids of words in lower case without ASCII white space. Pieces of many are encoded as one text: each ends with a token
        that ends a word."""
        out, find = [], self.pattern.findall
        for at in range(0, len(words), 2048):
            found = [find(w) for w in words[at : at + 2048]]
            line = " ".join(chain.from_iterable(found)).encode().decode("latin-1").translate(self.letters)
            (encoding,) = self.bare.encode_batch_fast([line], add_special_tokens=False)
            ids = np.array(encoding.ids, dtype=self.kind)
            last = np.concatenate([[0], np.flatnonzero(self.ends[ids]) + 1])
            count = np.cumsum([0, *map(len, found)])
            if len(last) != count[-1] + 1 or last[-1] != len(ids):
                raise ValueError("a piece must end with a token that ends a word")
            data, bounds = ids.tobytes(), (last[count] * self.kind.itemsize).tolist()
            out += [data[i:j] for i, j in zip(bounds, bounds[1:])]
        return out

    def _words(self, words: list[str]) -> list[bytes]:
        ids = iter(self._library([w for w in words if not is_plain(w)]))
        return [self._together([w])[0] if is_plain(w) else next(ids).tobytes() for w in words]

    def _together(self, texts: list[str]) -> list[bytes]:
        """Ids of plain texts. Each distinct word of them all is looked up once, and Arrow puts the words' ids in place."""
        lower = pa.array([t.lower() for t in texts], pa.string())
        # a mark between a letter and a blank is a piece of its own, so words with and without it are one
        words = pc.ascii_split_whitespace(pc.replace_substring_regex(lower, r"([a-z])([,.;:!?]) ", r"\1 \2 "))
        found = words.values.dictionary_encode()
        known = pa.array(self.plain.get(found.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.binary())
        ids = known.take(found.indices)
        at = np.frombuffer(ids.buffers()[1], dtype="<i4")[words.offsets.to_numpy()].tolist()
        data = ids.buffers()[2]
        data = b"" if data is None else data.to_pybytes()
        return [data[i:j] for i, j in zip(at, at[1:])]

    def _long(self, text: str) -> Iterator[bytes]:
        for part in parts_of(text):
            if is_plain(part):
                yield from self._together([part])
            else:
                words = part.encode("utf-8", "replace").split()
                yield from self.words.get(words)

    def encode(self, texts: list[str | None], end: int | None) -> Iterator[bytes]:
        """The ids of each text, and the end id, as little-endian numbers."""
        last = b"" if end is None else np.array([end], dtype=self.kind).tobytes()
        texts = [text or "" for text in texts]
        plain = [len(text) <= PART and is_plain(text) for text in texts]
        together = iter(self._together([t for t, p in zip(texts, plain) if p]))
        for text, p in zip(texts, plain):
            yield (next(together) if p else b"".join(self._long(text))) + last


def is_plain(text: str) -> bool:
    """Whether all is Latin-1 and no special token can occur."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return "<|" not in text


class Recent:
    """Values of what was asked for lately, in two generations: the older one goes when the younger has grown."""

    def __init__(self, learn):
        self.learn, self.young, self.old = learn, {}, {}

    def get(self, keys: list) -> list[bytes]:
        if len(self.young) > MEMO:
            self.young, self.old = {}, self.young
        young = self.young
        values = list(map(young.get, keys))
        if lack := [i for i, value in enumerate(values) if value is None]:
            missing = list(dict.fromkeys(keys[i] for i in lack))
            known = list(map(self.old.get, missing))
            new = [key for key, value in zip(missing, known) if value is None]
            young.update((key, value) for key, value in zip(missing, known) if value is not None)
            texts = [k if isinstance(k, str) else k.decode("utf-8", "replace") for k in new]
            young.update(zip(new, self.learn(texts)))
            for i in lack:
                values[i] = young[keys[i]]
        return values


def parts_of(text: str) -> Iterator[str]:
    """A long text in parts that end before a blank."""
    at = 0
    while len(text) - at > PART:
        end = text.find(" ", at + PART)
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end
    yield text[at:]


@lru_cache(maxsize=4)
def word_encoder(file: str) -> WordEncoder:
    return WordEncoder(file)


# ---------------------------------------------------------------- coding


def _lengths() -> np.ndarray:
    """Control byte -> data bytes of its four ranks."""
    c = np.arange(256)
    return np.stack([(c >> (2 * i) & 3) + 1 for i in range(4)], axis=1).astype(np.int64)


LENGTHS = _lengths()


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of ranks below 2^32."""
    n = len(ranks)
    ranks = np.ascontiguousarray(ranks, dtype="<u4")
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-n // 4) * 4, dtype=np.uint8)
    codes[:n] = size - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    used = np.arange(4, dtype=np.uint8)[None, :] < size[:, None]
    return control.astype(np.uint8).tobytes(), ranks.view(np.uint8).reshape(-1, 4)[used].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n ranks, by looking up the control bytes' lengths."""
    size = LENGTHS[np.frombuffer(control, dtype=np.uint8)].ravel()[:n]
    start = np.cumsum(size) - size
    raw = np.frombuffer(data + b"\0\0\0", dtype=np.uint8)
    out = raw[start].astype(np.uint32)
    for k in range(1, 4):
        longer = np.flatnonzero(size > k)
        if not len(longer):
            break
        out[longer] |= raw[start[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def write_block(out, ids: list[int], counts: list[int], ranks: np.ndarray) -> None:
    control, data = pack(ranks)
    out.write(HEAD.pack(MAGIC, len(ids), len(ranks), len(control), len(data)))
    out.write(np.array(ids, dtype="<i8").tobytes() + np.array(counts, dtype="<u8").tobytes() + control + data)


def read_blocks(source) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document ids, their lengths, ranks) of each block."""
    while head := source.read(HEAD.size):
        magic, docs, n, n_control, n_data = HEAD.unpack(head)
        if magic != MAGIC:
            raise ValueError("not a token block")
        ids = np.frombuffer(source.read(8 * docs), dtype="<i8")
        counts = np.frombuffer(source.read(8 * docs), dtype="<u8").astype(np.int64)
        control = source.read(n_control)
        yield ids, counts, unpack(control, source.read(n_data), n)


# ---------------------------------------------------------------- files


@dataclass(frozen=True)
class TokenFiles:
    """A written folder: manifest (path, first_id, first_tie, n_docs, n_ids, n_bytes) and rank -> id."""

    manifest: DataFrame
    id_of_rank: np.ndarray
    n_files: int


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def write_tokens(docs: DataFrame, file: str, end: int | None = 1, id_col: str = "doc_id", text_col: str = "text") -> TokenFiles:
    """Write the tokens of all rows in ascending order of their ids."""
    spark = docs.sparkSession
    folder = new_dir(spark, "tokens")

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, tie = word_encoder(file), TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, 1, rows=1024):
                ids = list(coder.encode(part.column(1).to_pylist(), end))
                ties = np.arange(tie, tie := tie + part.num_rows)
                yield pa.record_batch([part.column(0), pa.array(ties), pa.array(ids, pa.binary())], names=["doc_id", "tie", "ids"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    tokens = written(rows.mapInArrow(tokenise, "doc_id bigint, tie bigint, ids binary"), "token-ids")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, total = word_encoder(file).kind, np.zeros(0, dtype=np.int64)
        for batch in batches:
            ids = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=kind)
            got = np.bincount(ids, minlength=len(total))
            got[: len(total)] += total
            total = got
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["id", "n"])

    counted = tokens.select("ids").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect()
    # at most as many rows as the vocabulary has ids
    id_of_rank = np.array([r["id"] for r in sorted(counted, key=lambda r: (-r["n"], r["id"]))], dtype=np.uint32)
    ranks = np.zeros(int(id_of_rank.max(initial=0)) + 1, dtype=np.uint32)
    ranks[id_of_rank] = np.arange(len(id_of_rank), dtype=np.uint32)
    shared = spark.sparkContext.broadcast(ranks)

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, rank_of = word_encoder(file).kind, shared.value
        name = f"{folder}/{uuid.uuid4().hex}.tok"
        n_docs = n_ids = 0
        first, out, ids, held, size = None, None, [], [], 0
        for batch in batches:
            for doc, tie, tokens in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if out is None:
                    system, path = _place(name)
                    system.create_dir(os.path.dirname(path))
                    out, first = system.open_output_stream(path), (NO_ID if doc is None else doc, tie)
                got = np.frombuffer(tokens.as_buffer(), dtype=kind)
                ids.append(NO_ID if doc is None else doc)
                held.append(rank_of[got])
                size += len(got)
                n_docs, n_ids = n_docs + 1, n_ids + len(got)
                if size >= BLOCK:
                    write_block(out, ids, [len(h) for h in held], np.concatenate(held))
                    ids, held, size = [], [], 0
        if out is None:
            return
        if ids:
            write_block(out, ids, [len(h) for h in held], np.concatenate(held))
        n_bytes = out.tell()
        out.close()
        row = ([name], [first[0]], [first[1]], [n_docs], [n_ids], [n_bytes])
        yield pa.record_batch([pa.array(x) for x in row], names=["path", "first_id", "first_tie", "n_docs", "n_ids", "n_bytes"])

    ordered = tokens.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    schema = "path string, first_id bigint, first_tie bigint, n_docs bigint, n_ids bigint, n_bytes bigint"
    manifest = written(ordered.mapInArrow(store, schema), "token-manifest")
    table = spark.createDataFrame([(i, int(x)) for i, x in enumerate(id_of_rank)], "rank bigint, id bigint")
    table.coalesce(1).write.parquet(f"{folder}/ranks")
    discard(tokens)
    return TokenFiles(manifest, id_of_rank, manifest.count())


def read_tokens(files: TokenFiles) -> DataFrame:
    """doc_id, start (ids before the document), ids (little-endian unsigned 32-bit numbers), from the files."""
    spark = files.manifest.sparkSession
    shared = spark.sparkContext.broadcast(files.id_of_rank)
    # one row for each file
    before = F.sum("n_ids").over(Window.orderBy("first_id", "first_tie").rowsBetween(Window.unboundedPreceding, -1))
    shards = files.manifest.select("path", F.coalesce(before, F.lit(0)).alias("start"))

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, place = _place(path)
                with system.open_input_stream(place) as source:
                    for docs, counts, ranks in read_blocks(source):
                        ids = shared.value[ranks].astype("<u4")
                        ends = np.cumsum(counts)
                        parts = [ids[e - c : e].tobytes() for c, e in zip(counts.tolist(), ends.tolist())]
                        doc_ids = pa.array(docs, pa.int64(), mask=docs == NO_ID)
                        columns = [doc_ids, pa.array(start + ends - counts), pa.array(parts, pa.binary())]
                        yield pa.record_batch(columns, names=["doc_id", "start", "ids"])
                        start += int(ends[-1])

    return shards.repartition(max(1, files.n_files)).mapInArrow(load, "doc_id bigint, start bigint, ids binary")


def token_digest(docs: DataFrame, file: str, end: int = 1) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every row, from files written and read back."""
    ids = F.col("ids")
    return read_tokens(write_tokens(docs, file, end)).select(
        "doc_id", "start", (F.octet_length(ids) / 4).cast("bigint").alias("n_tokens"), F.crc32(ids).alias("ids_crc32")
    )
