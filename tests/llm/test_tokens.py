"""BPE and token files against the tokenizers library."""

import hashlib
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given as example
from hypothesis import settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from docloom.llm import bpe, tokenfiles
from docloom.llm.bpe import bpe_digest, decoded, encoded, encoded_rows
from docloom.llm.tokenfiles import read_tokens, token_digest, write_tokens

from .conftest import prose, rows

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def library(file):
    t = Tokenizer.from_file(file)
    t.no_truncation()
    t.no_padding()
    return t


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


TEXTS = [
    "", " ", "  two  spaces ", "don't we'll I'M they've", "a\n\n\nb \r\n\tc", "x" * 1000, "ab" * 700, " " * 500 + "z", "é" * 300,
    "日本語テキスト 中文", "\U0001f600\U0001f468‍\U0001f469", "ﬁ ½ ² ⅷ 12345", "<|endoftext|>a <|endoftext|><|endoftext|>", "_under_score--!!??",
    "\x1c\x1d\x1e\x1f\x85\xa0  sep", "ǅ İ ß", "=" * 333 + "-" * 90, "0123456789" * 60, "\x00\x01 bell\x07",
]


@pytest.mark.parametrize("text", TEXTS)
def test_transducer_like_library(text):
    coder, lib = bpe.transducer(BYTES), library(BYTES)
    ids = [i for part in coder.encode(text) for i in part]
    assert ids == lib.encode(text, add_special_tokens=False).ids
    assert "".join(coder.decode(iter([[i] for i in ids]))) == lib.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@example(st.text(alphabet=st.characters(exclude_categories=("Cs",)), max_size=200))
def test_transducer_on_any_text(text):
    test_transducer_like_library(text)


@settings(max_examples=60, deadline=None)
@example(st.text(alphabet="abethnisr", min_size=1, max_size=3000))
def test_windows_agree_with_whole_piece(text):
    coder = bpe.transducer(BYTES)
    data = text.encode()
    assert list(coder.stream(data)) == coder.merge(data)


def test_lookahead_of_small_lists():
    assert bpe.sufficient_lookahead([]) == 0
    assert bpe.sufficient_lookahead([(b"a", b"b")]) == 1
    assert bpe.sufficient_lookahead([(b"b", b"c"), (b"a", b"b")]) == 2  # whether ab joins depends on the c behind it


def test_bpe_digest(odd, given):
    lib = library(BYTES)
    for docs in (odd, given):
        want = Counter()
        for r in docs.collect():
            ids = lib.encode(r["text"] or "", add_special_tokens=False).ids
            back = lib.decode(ids, skip_special_tokens=False)
            want[(r["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(back))] += 1
        assert Counter(tuple(r) for r in bpe_digest(docs, BYTES).collect()) == want


def test_encode_then_decode(odd, crowded, empty):
    back = Counter((r["doc_id"], r["text"]) for r in decoded(encoded(odd, BYTES), BYTES).collect())
    assert back == Counter((r["doc_id"], r["text"] or "") for r in odd.collect())
    got = encoded_rows(crowded, BYTES)
    assert got.columns == [*crowded.columns, "ids", "round_trip"]
    assert all(r["round_trip"] for r in got.collect())
    assert rows(bpe_digest(empty, BYTES)) == rows(encoded_rows(empty, BYTES)) == []


def file_brute(docs, key=lambda r: (r["doc_id"] is not None, r["doc_id"])):
    lib, at, out = library(WORDS), 0, []
    for r in sorted(docs, key=key):
        ids = [*lib.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        out.append((r["doc_id"], at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    return out


def test_token_files(given, odd):
    assert sorted(tuple(r) for r in token_digest(given, WORDS).collect()) == file_brute(given.collect())
    docs = odd.where("doc_id is not null")
    assert sorted(tuple(r) for r in token_digest(docs, WORDS).collect()) == file_brute(docs.collect())


def test_null_ids_come_first(odd):
    got = sorted((tuple(r) for r in token_digest(odd, WORDS).collect()), key=lambda r: r[1])
    assert [r[0] for r in got[:3]] == [None, None, 1]
    assert sum(r[2] for r in got) == got[-1][1] + got[-1][2]


@pytest.mark.parametrize("text", TEXTS)
def test_words_like_library(text):
    coder = tokenfiles.word_encoder(WORDS)
    (got,) = coder.encode([text], None)
    assert np.frombuffer(got, dtype=coder.kind).tolist() == library(WORDS).encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@example(st.text(alphabet=st.characters(exclude_categories=("Cs",)), max_size=200))
def test_words_of_any_text(text):
    test_words_like_library(text)


class Unscanned(dict):
    def keys(self):
        raise AssertionError("the whole memo is gone through")

    __iter__ = items = values = keys


def test_the_memo_is_never_gone_through():
    coder = tokenfiles.WordEncoder(WORDS)
    for recent in vars(coder).values():
        if isinstance(recent, tokenfiles.Recent):
            recent.young = Unscanned()
    texts = ["some words, (more), \x1cwords\x1d. It's x\xa0y\x85z 12,5", None, "Wörter: 中文 ß", "", "some other words."] * 2
    got = [np.frombuffer(x, dtype=coder.kind).tolist() for x in coder.encode(texts, None)]
    assert got == [library(WORDS).encode(text or "", add_special_tokens=False).ids for text in texts]


@settings(max_examples=100, deadline=None)
@example(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 70_000), st.integers(0, 2**32 - 1)), max_size=60))
def test_packing(ranks):
    control, data = tokenfiles.pack(np.array(ranks, dtype=np.uint32))
    assert len(control) == -(-len(ranks) // 4)
    assert tokenfiles.unpack(control, data, len(ranks)).tolist() == ranks


def test_frequent_ids_take_a_byte(spark):
    docs = spark.createDataFrame([(i, prose(i % 7, 50)) for i in range(80)], "doc_id bigint, text string")
    files = write_tokens(docs, WORDS)
    total = files.manifest.groupBy().sum("n_docs", "n_ids", "n_bytes").first()
    assert total[0] == 80
    assert total[2] < 2.2 * total[1] + 80 * 20 + 200 * files.n_files
    counts = Counter()
    for r in read_tokens(files).collect():
        counts.update(np.frombuffer(r["ids"], dtype="<u4").tolist())
    ranked = [counts[i] for i in files.id_of_rank.tolist()]
    assert ranked == sorted(ranked, reverse=True)


def test_no_documents(empty):
    assert rows(token_digest(empty, WORDS)) == []
