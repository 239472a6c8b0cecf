"""Collocations against counting by hand."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given as example
from hypothesis import settings
from hypothesis import strategies as st

from docloom.llm import phrases
from docloom.llm.phrases import bit_table, collocations, mixed_hashes, phrase_counts, phrases_of, pruned, word_hashes

from .conftest import prose, rows

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_counts(docs, longest=3):
    f = [defaultdict(Counter) for _ in range(longest + 1)]
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for m in range(1, longest + 1):
                f[m][lang or "und"].update(" ".join(words[i : i + m]) for i in range(len(words) - m + 1))
    return f


def brute(docs, longest=3, least=10, share=50, top=2000):
    f = brute_counts(docs, longest)
    out = []
    for lang in f[1]:
        n, found = sum(f[1][lang].values()), []
        cands = {p: a for m in range(2, longest + 1) for p, a in f[m][lang].items() if a >= least}
        for p, a in cands.items():
            w = p.split(" ")
            if any(f" {p} " in f" {q} " and 100 * b >= share * a for q, b in cands.items() if q.count(" ") > p.count(" ")):
                continue
            cuts = []
            for k in range(1, len(w)):
                left = f[k][lang][" ".join(w[:k])]
                right = f[len(w) - k][lang][" ".join(w[k:])]
                cuts.append((1_000_000 * a * a // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            found.append((-score, -a, p.encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@settings(max_examples=200, deadline=None)
@example(st.lists(st.integers(0, 4), min_size=1, max_size=80), st.integers(1, 5))
def test_intervals_are_counts(text, depth):
    text = np.array([0, *text, 0], dtype=np.int32)
    columns, n = phrases_of(text, 5, depth)
    want = Counter(tuple(text[i : i + depth].tolist()) for i in range(len(text) - depth + 1) if (text[i : i + depth] > 0).all())
    assert dict(zip(zip(*(c.tolist() for c in columns)), n.tolist())) == want


@settings(max_examples=200, deadline=None)
@example(st.lists(st.integers(0, 3), min_size=1, max_size=60), st.integers(1, 3), st.sets(st.integers(0, 63), max_size=40))
def test_pruning_keeps_what_can_be_frequent(text, depth, bad):
    """All phrases one longer, whose parts are in the table, are left, as often as before; no others."""
    text = np.array([0, *text, 0], dtype=np.int32)
    hashes = word_hashes([b".", b"a", b"b", b"c"], "en")
    grams = {tuple(text[i : i + depth].tolist()) for i in range(len(text) - depth + 1)}
    good = {g for i, g in enumerate(sorted(grams)) if i not in bad and 0 not in g}
    table = np.zeros(1 << (phrases.TABLE_BITS - 6), dtype=np.uint64)
    if good:
        slot = mixed_hashes([hashes[np.array(c)] for c in zip(*sorted(good))]) >> np.uint64(64 - phrases.TABLE_BITS)
        np.bitwise_or.at(table, (slot >> np.uint64(6)).astype(np.int64), np.uint64(1) << (slot & np.uint64(63)))

    def counts(t):
        found = (tuple(t[i : i + depth + 1].tolist()) for i in range(len(t) - depth))
        return Counter(g for g in found if g[:-1] in good and g[1:] in good)

    left = pruned(text, hashes, table, depth)
    assert counts(left) == counts(text)
    longer = {tuple(left[i : i + depth + 1].tolist()) for i in range(len(left) - depth)}
    assert all(g[:-1] in good and g[1:] in good for g in longer if 0 not in g)


@pytest.mark.parametrize("least,share", [(10, 50), (2, 80), (1, 50)])
def test_given_documents(given, least, share):
    docs = given.where("doc_id < 60") if least == 1 else given
    assert got(collocations(docs, least=least, share=share)) == brute(
        [(r["lang"], r["text"]) for r in docs.collect()], least=least, share=share
    )


def test_longer_phrases_and_few_ranks(given):
    want = brute([(r["lang"], r["text"]) for r in given.collect()], 5, 3, 50, 40)
    assert got(collocations(given, longest=5, least=3, top=40)) == want


def test_odd_rows(odd, crowded):
    texts = [(r["lang"], r["text"]) for r in odd.collect()]
    want = brute(texts, least=2)
    assert want and got(collocations(odd, least=2)) == want
    assert got(collocations(crowded, least=2)) == want


def test_clashing_names(odd):
    docs = odd.selectExpr("*", *(f"'{c}' as {c}" for c in ("phrase", "n", "a", "k", "l", "r", "w", "score", "rank", "first", "rest")))
    assert got(collocations(docs, least=2)) == got(collocations(odd, least=2))


def test_small_shards_and_chunks(given, monkeypatch):
    """Slices of long shards overlap by less than a phrase, texts are read in chunks."""
    texts = [(r["lang"], r["text"]) for r in given.collect()]
    f = brute_counts(texts)
    monkeypatch.setattr(phrases, "SHARD", 50)
    monkeypatch.setattr(phrases, "CHUNK", 40)
    for depth, table in enumerate(phrase_counts(given, least=8), 1):
        want = {(lang, p): n for lang, c in f[depth].items() for p, n in c.items() if n >= 8}
        assert {(r["lang"], r["phrase"]): r["n"] for r in table.where("phrase is not null").collect()} == want


def test_separators_and_overlaps(spark):
    text = "A b\tA\tb,a b a b; É é.b\na\rb\x0bc\x0cd a.a:b!x?y " * 4
    docs = spark.createDataFrame([(1, text, None), (1, text, None), (2, text, "en"), (3, "a a a a a", "en")], "doc_id int, text string, lang string")
    assert got(collocations(docs, least=3)) == brute([(None, text)] * 2 + [("en", text), ("en", "a a a a a")], least=3)


def test_products_beyond_64_bits(spark, monkeypatch):
    """Counts as a corpus of 10^13 words has them."""
    big = 4_000_000_000_007
    words = [("en", None, 5 * big), ("en", "x", 2 * big + 1), ("en", "y", big + 3)]
    tables = [spark.createDataFrame(r, "lang string, phrase string, n bigint") for r in (words, [("en", "x y", big)], [("en", "q", 1)])]
    monkeypatch.setattr(phrases, "phrase_counts", lambda *_: tables[:2])
    monkeypatch.setattr(phrases, "discard", lambda *_: None)
    want = ("en", 1, "x y", big, 2 * big + 1, big + 3, 5 * big, 1_000_000 * big * big // ((2 * big + 1) * (big + 3)))
    assert got(collocations(tables[0])) == [want]


def test_full_table_changes_nothing(given, monkeypatch):
    """A bit table that lets all through costs time only."""
    want = got(collocations(given, least=5))
    monkeypatch.setattr(phrases, "bit_table", lambda grams: np.full_like(bit_table(grams), np.uint64(2**64 - 1)))
    assert got(collocations(given, least=5)) == want


def test_no_documents(empty, spark):
    assert rows(collocations(empty)) == []
    blank = spark.createDataFrame([(1, None, "en"), (2, " ,. ", None)], "doc_id int, text string, lang string")
    assert rows(collocations(blank)) == []


def test_long_text(spark):
    text = prose(7, 20_000)
    docs = spark.createDataFrame([(1, text, "en"), (2, "x" * 300_000, "en")], "doc_id int, text string, lang string")
    assert got(collocations(docs, least=4)) == brute([("en", text), ("en", "x" * 300_000)], least=4)
