"""Byte-level BPE by ranks: against the library on whole texts, and against merging by hand."""

import base64
import hashlib
import re
import struct
from collections import Counter

import public_tokenizers
import pytest
import regex
from hypothesis import given as example
from hypothesis import settings
from hypothesis import strategies as st

from docloom.llm.bpe import WHITE
from docloom.llm.queries import op13_byte_bpe
from docloom.llm.ranks import decoded, encoded, parts_of, rank_coder, rank_digest

from .conftest import prose, rows

FILE, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
SHORT_RUN = re.compile(f"[{WHITE}]{{8,}}")


@pytest.fixture(scope="module")
def ranks():
    with open(FILE, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def by_hand(text, ranks):
    """Each match of the pattern on its own: the pair of least rank is merged until none has one."""
    ids = []
    for m in regex.finditer(PATTERN, text or ""):
        parts = [bytes([b]) for b in m[0].encode()]
        if m[0].encode() in ranks:
            parts = [m[0].encode()]
        while len(parts) > 1:
            found = [ranks.get(a + b, 1 << 40) for a, b in zip(parts, parts[1:])]
            if min(found) == 1 << 40:
                break
            i = found.index(min(found))
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        ids += [ranks[p] for p in parts]
    return ids


TEXTS = [
    "", " ", "  two  spaces ", "don't we'll I'M they've", "a\n\n\nb \r\n\tc", "é" * 30, "日本語テキスト 中文", "\U0001f600\U0001f468‍\U0001f469",
    "ﬁ ½ ² ⅷ 12345", "<|endoftext|>a <|endoftext|>", "=" * 33 + "-" * 9, "0123456789ab" * 9, "\x00\x01 bell\x07", "\x85\xa0  sep   ", "x1y2 " * 8,
]


@pytest.mark.parametrize("text", TEXTS)
def test_like_merging_by_hand(text, ranks):
    coder = rank_coder(FILE, PATTERN)
    ids = [i for part in coder.encode(text) for i in part]
    assert ids == by_hand(text, ranks)
    assert b"".join(coder.decode(coder.encode(text))) == text.encode()


@settings(max_examples=300, deadline=None)
@example(st.text(alphabet=" \t\n\xa0ab1!'sé日", max_size=120), st.integers(1, 9))
def test_parts_change_nothing(text, part):
    """Cut at every chance, and with short runs of white space taken as matches, the ids are those of the whole text."""
    library = rank_coder(FILE, PATTERN).library
    found = list(parts_of(text, part, SHORT_RUN))
    assert "".join(p for p, _ in found) == text
    ids = [i for p, one in found for i in (library._encode_single_piece(p) if one else library.encode_ordinary(p))]
    assert ids == library.encode_ordinary(text)


@pytest.mark.parametrize("tail", ["", "x", " x"])
@pytest.mark.parametrize("white", [" ", "\n"])
def test_runs_of_white_space_beyond_the_library(white, tail, ranks):
    """The library raises on a million blanks; the result is that of the pattern's matches."""
    text = "word" + white * 1_200_000 + tail
    coder = rank_coder(FILE, PATTERN)
    ids = [i for part in coder.encode(text) for i in part]
    assert b"".join(coder.decode(iter([ids]))) == text.encode()
    pieces = [m[0] for m in regex.finditer(PATTERN, text)]
    assert ids == [i for p in pieces for i in coder.library._encode_single_piece(p)]


def test_very_long_texts():
    coder = rank_coder(FILE, PATTERN)
    for text in ("x" * 3_000_000, "!" * 400_000, "ab1 " * 300_000, prose(3, 200_000)):
        assert b"".join(coder.decode(coder.encode(text))) == text.encode()
    text = prose(3, 60_000)
    assert [i for part in coder.encode(text) for i in part] == coder.library.encode_ordinary(text)


def test_digest(odd, given, ranks):
    for docs in (odd, given):
        want = Counter()
        for r in docs.collect():
            ids = by_hand(r["text"], ranks) if len(r["text"] or "") < 3000 else rank_coder(FILE, PATTERN).library.encode_ordinary(r["text"])
            sha = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
            want[(r["doc_id"], len(ids), sha, hashlib.sha256((r["text"] or "").encode()).hexdigest())] += 1
        assert Counter(tuple(r) for r in rank_digest(docs, FILE).collect()) == want


def test_round_trip_and_clashing_names(crowded, empty):
    tokens = encoded(crowded, FILE)
    assert tokens.columns == ["doc_id", "ids"]
    back = Counter((r["doc_id"], bytes(r["data"])) for r in decoded(tokens, FILE).collect())
    assert back == Counter((r["doc_id"], (r["text"] or "").encode()) for r in crowded.collect())
    assert rows(rank_digest(empty, FILE)) == rows(encoded(empty, FILE)) == []


def test_text_ids(odd):
    docs = odd.selectExpr("concat('d', doc_id) AS name", "text")
    assert {r["doc_id"] for r in encoded(docs, FILE, id_col="name").collect()} == {r["name"] for r in docs.collect()}


def test_query(spark, sf_dir, given):
    assert op13_byte_bpe(spark, sf_dir).count() == given.count()
