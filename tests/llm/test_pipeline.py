"""Mixing, the registered queries, and the pipeline."""

import math
import re
from collections import Counter, defaultdict

import duckdb
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from check import normal
from docloom.llm import queries, simhash
from docloom.llm.langid import learn, predict
from docloom.llm.mixing import Mix, exponent, mixed, mixture
from docloom.llm.oracle import ORACLE

from .conftest import CLASHING, prose, rows

WORD = re.compile("[^\x20\x09-\x0d]+")
SPACE = re.compile("[\x20\x09-\x0d]+")


@pytest.mark.parametrize("name", ORACLE)
def test_queries_like_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = queries.QUERIES[name](spark, sf_dir)
    got = pd.DataFrame([tuple(r) for r in df.collect()], columns=df.columns, dtype=object)
    rel = con.sql(ORACLE[name])
    want = pd.DataFrame(rel.fetchall(), columns=rel.columns, dtype=object)
    assert len(got) and normal(got) == normal(want)


def test_every_operator_is_registered():
    assert {int(re.match(r"op(\d+)_", k)[1]) for k in entry.queries() if k.startswith("op")} == set(range(1, 11))
    assert "pipeline" in entry.queries()


# ---------------------------------------------------------------- mixing


def skewed(spark, sizes):
    docs = [(s * 10_000 + i, prose(s * 977 + i, 10 + i % 40), f"s{s}") for s, n in enumerate(sizes) for i in range(n)]
    return spark.createDataFrame(docs, "doc_id bigint, text string, source string")


def shares(docs):
    tokens = defaultdict(int)
    for r in docs.collect():
        tokens[r["source"]] += len(WORD.findall(r["text"] or ""))
    return {k: v for k, v in tokens.items() if v}


@pytest.mark.parametrize("mix", [Mix(), Mix(entropy_share=0.97, most_epochs=2.0), Mix(entropy_share=0.2), Mix(budget_share=0.5, blocks=7)])
def test_budgets_are_met(spark, mix):
    docs = skewed(spark, [300, 40, 12, 5])
    tokens = shares(docs)
    total = sum(tokens.values())
    frame = spark.createDataFrame([(k, v / total) for k, v in tokens.items()], "source string, share double")
    a = exponent(frame, mix)
    p = {k: v / total for k, v in tokens.items()}
    z = sum(x**a for x in p.values())
    weight = {k: x**a / z for k, x in p.items()}
    entropy = -sum(w * math.log(w) for w in weight.values())
    repeats = max(mix.budget_share * weight[k] / p[k] for k in p)
    assert repeats <= mix.most_epochs + 1e-4 or a > 1 - 1e-6
    assert a > 1 - 1e-6 or entropy >= mix.entropy_share * math.log(len(p)) - 1e-4 or repeats >= mix.most_epochs - 1e-2

    drawn = rows(mixture(docs, mix))
    got = defaultdict(int)
    for r in drawn:
        got[r["source"]] += r["n_tokens"]
    for k in tokens:
        budget = weight[k] * mix.budget_share * total
        assert budget - 60 <= got[k] <= budget + 1, k
    times = Counter((r["doc_id"], r["epoch"]) for r in drawn)
    assert set(times.values()) == {1}
    by_doc = Counter(r["doc_id"] for r in drawn)
    for k in tokens:
        n = [by_doc[r["doc_id"]] for r in docs.where(f"source = '{k}'").collect()]
        assert max(n) - min(n) <= 1


def test_epochs_are_permutations_of_blocks(spark):
    drawn = rows(mixture(skewed(spark, [200, 10]), Mix(most_epochs=5.0, blocks=8)))
    order = defaultdict(list)
    for r in sorted((r for r in drawn if r["source"] == "s1"), key=lambda r: (r["epoch"], r["place"])):
        if not order[r["epoch"]] or order[r["epoch"]][-1] != r["block"]:
            order[r["epoch"]].append(r["block"])
    full = [o for e, o in sorted(order.items())][:-1]
    assert len(full) >= 2
    assert all(len(o) == len(set(o)) for o in full)
    assert len({tuple(sorted(o)) for o in full}) == 1 and len(set(map(tuple, full))) > 1


def test_one_source_stays_as_it_is(spark):
    docs = skewed(spark, [30])
    assert Counter(r["doc_id"] for r in mixed(docs).collect()) == Counter(r["doc_id"] for r in docs.collect())


def test_odd_mixes(odd, crowded, empty):
    got = Counter(r["doc_id"] for r in mixture(odd).collect())
    assert got[1] == got[2] == got[3] == 1  # without tokens
    out = mixed(crowded)
    assert out.columns == crowded.columns
    assert all(r[c] == c for r in rows(out) for c in CLASHING)
    assert rows(mixture(empty)) == rows(mixed(empty)) == []


# ---------------------------------------------------------------- pipeline


def jaccard(a, b):
    def shingles(t):
        w = SPACE.sub(" ", t).lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y)


def test_stages_against_brute_force(spark, given, sf_dir):
    """Each stage on what its predecessor kept."""
    docs = given
    model = learn(given)
    for name, stage in corpus_pipeline.STAGES:
        before = rows(docs)
        out = stage(spark, docs, sf_dir)
        after = rows(out)
        if name != "bpe":
            assert out.columns == given.columns
        ids = Counter(r["doc_id"] for r in after)
        if name == "language_id":
            names, score = predict(model, [r["text"] for r in before])
            want = Counter(r["doc_id"] for r, n, s in zip(before, names, score) if n != "und" and s >= 0.2)
        elif name == "exact_dedup":
            first = {}
            for r in before:
                key = SPACE.sub(" ", r["text"] or "")
                first[key] = min(first.get(key, r["doc_id"]), r["doc_id"])
            want = Counter(first.values())
        elif name == "near_dedup":
            wide = {r["doc_id"]: simhash.wide_fingerprint(r["text"]) for r in before}
            least = {i: i for i in wide}
            for a in sorted(wide):
                for b in sorted(wide):
                    apart = simhash.np.bitwise_count(wide[a] ^ wide[b])
                    if a < b and apart[0] <= 10 and apart.sum() <= simhash.wide_bits(0.8):
                        old, new = least[b], least[a]
                        least = {k: min(old, new) if v in (old, new) else v for k, v in least.items()}
            want = Counter(i for i in wide if least[i] == i)
        elif name == "source_mix":
            con = duckdb.connect()
            frame = pd.DataFrame(before)  # noqa: F841
            from docloom.llm.oracle import op5

            want = Counter(x for (x,) in con.sql(f"SELECT doc_id FROM ({op5('frame')})").fetchall())
        else:
            lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
            text = {r["doc_id"]: r["text"] or "" for r in before}
            want = Counter(r["doc_id"] for r in before)
            for r in after:
                assert r["round_trip"] and r["ids"] == lib.encode(text[r["doc_id"]]).ids and r["n_tokens"] == len(r["ids"])
        assert ids == want, name
        docs = spark.createDataFrame(after, out.schema)


def test_near_copies_of_the_pipeline_are_near(spark, given):
    """What the near-dedup stage drops resembles a document that stays, and few of those that stay resemble each other."""
    docs = corpus_pipeline.exact_dedup(spark, given, "")
    text = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    kept = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()}
    for i in set(text) - kept:
        assert max(jaccard(text[i], text[k]) for k in kept) > 0.6
    missed = [(a, b) for a in kept for b in kept if a < b and jaccard(text[a], text[b]) >= 0.9 and len(text[a]) > 300]
    assert not missed


def test_odd_pipeline(spark, crowded, empty, tmp_path):
    for docs in (crowded, empty):
        path = f"{tmp_path}/{docs.count()}"
        docs.write.parquet(f"{path}/documents.parquet")
        out = corpus_pipeline.run(spark, path)
        assert out.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "round_trip"]
        assert all(r["round_trip"] for r in out.collect())
