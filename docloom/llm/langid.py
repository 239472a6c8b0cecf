"""Language ID with language-bitmask n-gram filters.

Every language has a Bloom filter of its frequent letter n-grams. The filters share hash functions and are stored
bit-sliced: slot i of the table is a word whose bit l is bit i of language l's filter. One lookup per hash function, combined
by "and", so returns all languages that contain an n-gram. A text's n-grams are counted for each language, the counts are
corrected for the filters' false positives, and the language with most decides.

N-grams are three and four characters of a lower-cased word with a space on either side. Learning reads a bounded sample,
about `per_language` documents for each language, picked by a hash of the id; prediction reads every whole text. The table's
size is fixed by `slots_log2` and the number of languages, so its broadcast is bounded.

Defined results: `und` with score 0 for a null text, a text without a letter, or if there is nothing to learn from; ties go
to the language that sorts first; a null id is held out like the empty text; repeated rows are judged alike; an empty table
gives an empty result; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import fresh, let_go

#: Code points above have no letters.
LETTERS_END = 0x323B0
#: Characters handled at a time.
PIECE = 1 << 19
SIZES = (3, 4)
HASHES = 3
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


@dataclass(frozen=True)
class LangModel:
    languages: tuple[str, ...]
    table: np.ndarray  # (words, slots) of unsigned integers
    false_positives: np.ndarray  # for each language
    slots_log2: int


def held_out(id_col: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> lower-case letter, 0 if it is no letter."""
    out = np.zeros(LETTERS_END, dtype=np.uint32)
    for i in range(LETTERS_END):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def _pieces(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Batches of about PIECE characters: rows and their texts; a longer text comes in parts that end between words."""
    rows, held, size = [], [], 0
    for row, text in enumerate(texts):
        at = 0
        while True:
            end = min(len(text), at + PIECE)
            while end < len(text) and end - at < 2 * PIECE and text[end - 1].isalpha() and text[end].isalpha():
                end += 1
            rows.append(row)
            held.append(text[at:end])
            size += end - at + 1
            if size >= PIECE:
                yield rows, held
                rows, held, size = [], [], 0
            at = end
            if at >= len(text):
                break
    if rows:
        yield rows, held


def ngram_hashes(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each batch of pieces: hash and row of each n-gram, and the rows that have a letter."""
    letters = _letters()
    for rows, held in _pieces(texts):
        points = np.frombuffer((" " + " ".join(held) + " ").encode("utf-32-le", "replace"), dtype=np.uint32)
        row_of = np.repeat(np.array(rows, dtype=np.int32), [len(t) + 1 for t in held])
        row_of = np.concatenate([row_of[:1], row_of])
        c = np.where(points < LETTERS_END, letters[np.minimum(points, LETTERS_END - 1)], 0)
        near = c != 0
        near[:-1] |= c[1:] != 0
        near[1:] |= c[:-1] != 0
        c, row_of = c[near].astype(np.uint64), row_of[near]
        hashes, owners = [], []
        for n in SIZES:
            m = len(c) - n + 1
            if m <= 0:
                continue
            inner = c[1 : 1 + m] != 0
            for i in range(2, n - 1):
                inner &= c[i : i + m] != 0
            h = np.full(m, n, dtype=np.uint64)
            for i in range(n):
                h = (h ^ c[i : i + m]) * MULTIPLIERS[0]
                h ^= h >> np.uint64(29)
            hashes.append(h[inner])
            owners.append(row_of[1 : 1 + m][inner])
        lettered = np.unique(row_of[c != 0])
        if hashes:
            yield np.concatenate(hashes), np.concatenate(owners), lettered


def _slots(hashes: np.ndarray, k: int, slots_log2: int) -> np.ndarray:
    return ((hashes * MULTIPLIERS[k]) >> np.uint64(64 - slots_log2)).astype(np.int64)


def build_model(counts: dict[str, tuple[np.ndarray, np.ndarray]], slots_log2: int, least_share: float) -> LangModel:
    """From each language's n-gram hashes and their counts."""
    languages = tuple(sorted(counts))
    words = max(1, -(-len(languages) // 64))
    kind = np.uint8 if len(languages) <= 8 else np.uint64
    width = 8 if kind is np.uint8 else 64
    table = np.zeros((words, 1 << slots_log2), dtype=kind)
    fill = np.zeros(len(languages))
    for i, lang in enumerate(languages):
        hashes, n = counts[lang]
        frequent = hashes[n >= max(2.0, least_share * n.sum())]
        bit = kind(1 << (i % width))
        for k in range(HASHES):
            table[i // width, _slots(frequent, k, slots_log2)] |= bit
        fill[i] = np.count_nonzero(table[i // width] & bit) / table.shape[1]
    return LangModel(languages, table, fill**HASHES, slots_log2)


def predict(model: LangModel, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    n_langs = len(model.languages)
    width = model.table.dtype.itemsize * 8
    hits = np.zeros((n_langs, len(texts)))
    total = np.zeros(len(texts))
    lettered = np.zeros(len(texts), dtype=bool)
    for hashes, owners, with_letter in ngram_hashes([t or "" for t in texts]):
        lettered[with_letter] = True
        total += np.bincount(owners, minlength=len(texts))
        for w in range(model.table.shape[0]):
            mask = model.table[w, _slots(hashes, 0, model.slots_log2)]
            for k in range(1, HASHES):
                mask &= model.table[w, _slots(hashes, k, model.slots_log2)]
            for i in range(w * width, min(n_langs, (w + 1) * width)):
                bit = model.table.dtype.type(1 << (i - w * width))
                hits[i] += np.bincount(owners[(mask & bit) != 0], minlength=len(texts))
    if not n_langs:
        return ["und"] * len(texts), np.zeros(len(texts))
    fp = model.false_positives[:, None]
    true = np.maximum(0.0, (hits - fp * total) / np.maximum(1 - fp, 1e-9))
    best = true.argmax(axis=0)
    score = np.clip(true[best, np.arange(len(texts))] / np.maximum(total, 1), 0.0, 1.0)
    names = [model.languages[b] if ok else "und" for b, ok in zip(best.tolist(), lettered.tolist())]
    return names, np.where(lettered, score, 0.0)


def learn(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = 2000,
    slots_log2: int = 20,
    least_share: float = 2e-5,
) -> LangModel:
    """Learn from about `per_language` documents of each language that are not held out."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    # one row for each language
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return build_model({}, slots_log2, least_share)
    share = F.create_map(*(F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, per_language / n))))
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = rows.where(spot < share[F.col("lang")]).select("lang", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                for hashes, _, _ in ngram_hashes(texts.tolist()):
                    h, n = np.unique(hashes, return_counts=True)
                    yield pd.DataFrame({"lang": lang, "hash": h.view(np.int64), "n": n})
        let_go()

    found = sample.mapInPandas(count, "lang string, hash bigint, n bigint").groupBy("lang", "hash").agg(F.sum("n").alias("n"))
    found = found.where("n > 1").toPandas()  # bounded by the sample
    counts = {k: (g["hash"].to_numpy().view(np.uint64), g["n"].to_numpy(np.float64)) for k, g in found.groupby("lang")}
    return build_model(counts, slots_log2, least_share)


def languages_of(docs: DataFrame, model: LangModel, text_col: str = "text") -> Column:
    """Struct (lang_pred, score) of each text of `docs`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            names, score = predict(shared.value, texts.tolist())
            yield pd.DataFrame({"lang_pred": names, "score": score})
        let_go()

    return judge(F.col(text_col))


def identify(docs: DataFrame, model: LangModel | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; `docs` has doc_id, text and lang."""
    model = model or learn(docs)
    return docs.select("doc_id", held_out().alias("held_out"), languages_of(docs, model).alias("found")).select(
        "doc_id", "held_out", "found.lang_pred", "found.score"
    )


def drop_unidentified(docs: DataFrame, model: LangModel | None = None, least: float = 0.2, text_col: str = "text") -> DataFrame:
    """The rows of `docs` with a language and a score of `least` or more, with their columns. Fluent text scores above 0.9;
    what scores below 0.2 is mostly made of n-grams that no learnt language has. A text's language is judged, not its label."""
    model = model or learn(docs, text_col=text_col)
    (found,) = fresh(docs, "found")
    rows = docs.withColumn(found, languages_of(docs, model, text_col))
    return rows.where((F.col(f"{found}.lang_pred") != "und") & (F.col(f"{found}.score") >= least)).drop(found)
