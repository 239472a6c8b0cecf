"""What near-dedup holds on disk at a time grows with the input, not with its square."""

import random

import numpy as np
import pytest

from docloom.llm import setjoin, simhash
from docloom.llm.common import written

from .test_dedup import kept_ids, near_brute, slow_components

PROBING = simhash.Plan(tuple(tuple(range(i, 64, 6)) for i in range(6)), (0, 1, 1, 1, 1, 1))


def counted(monkeypatch, module, *names):
    """Name -> rows of each table of that name that the module writes."""
    found = {name: [] for name in names}

    def kept(df, name):
        out = written(df, name)
        if name in found:
            found[name].append(out.count())
        return out

    monkeypatch.setattr(module, "written", kept)
    return found


@pytest.mark.parametrize("plan,bucket", [(None, 16), (PROBING, 2), (PROBING, 1 << 14)])
def test_links_are_whole_in_rounds(spark, monkeypatch, plan, bucket):
    """A partition at a time; large buckets are dealt into chunks, and rows are not multiplied by a further pigeonhole."""
    monkeypatch.setattr(simhash, "ROUND", 1, raising=False)
    monkeypatch.setattr(simhash, "ROWS", 1, raising=False)
    if plan:
        monkeypatch.setattr(simhash, "make_plan", lambda *_: plan)
    rows = counted(monkeypatch, simhash, "buckets")
    rng = random.Random(bucket)
    fps = set()
    for centre in [rng.getrandbits(64) for _ in range(4)]:
        for _ in range(60):
            x = centre
            for at in rng.sample(range(64), rng.randrange(14)):
                x ^= 1 << at
            fps.add(x)
    fps = sorted(fps)
    nodes = spark.createDataFrame(list(enumerate(np.array(fps, dtype=np.uint64).view(np.int64).tolist())), "node bigint, fp bigint")
    found = simhash.components(simhash.links(nodes, 10, bucket))
    got = {i: i for i in range(len(fps))} | {r["node"]: r["root"] for r in found.collect()}
    assert got == slow_components(set(range(len(fps))), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 10)
    assert max(rows["buckets"]) <= 12 * len(fps) and (plan or max(rows["buckets"]) == len(fps))


def test_rounds_hold_few_rows():
    assert simhash._rounds(PROBING, 10**7) == [[0], [1], [2], [3], [4], [5]]
    assert simhash._rounds(PROBING, 1000) == [[0, 1, 2, 3, 4, 5]]


def test_long_texts_that_share_a_passage_are_not_read_again(spark, monkeypatch):
    """Signatures are as long as large sets need, so that only sets that can be near are hashed and moved."""
    none = np.zeros(0, dtype="<u8")
    monkeypatch.setattr(setjoin, "frequent_shingles", lambda *_: (none, none.astype(np.int64)))
    rows = counted(monkeypatch, setjoin, "sets", "pairs")
    passage = [f"p{i}" for i in range(60)]
    texts = [" ".join([f"w{n}.{i}" for i in range(2600 + 40 * n)] + passage) for n in range(10)]
    texts.append(texts[3] + " more")
    assert kept_ids(spark, list(enumerate(texts))) == sorted(enumerate(texts[:10]))
    assert max(rows["pairs"]) == 1 and max(rows["sets"]) == 2


def test_signatures_of_any_length_bound_the_difference():
    rng = np.random.default_rng(5)
    for n in (10, 1024, 1025, 3000, 9000):
        base = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        for part in (0.0, 0.05, 0.3, 1.0):
            m = int(n * part)
            other = np.unique(np.concatenate([base[m:], rng.integers(0, 2**64, m + n // 5, dtype=np.uint64)]))
            x, y = (np.frombuffer(setjoin.long_signature(s) or setjoin.signature(s), "<u8") for s in (base, other))
            differ = len(np.setxor1d(base, other))
            assert differ / 6 <= setjoin.apart(x, y) <= differ
            assert setjoin.apart(x, y) == setjoin.apart(y, x)
    assert setjoin.long_signature(base[:1024]) is None


def test_pairs_are_verified_in_slices(spark, monkeypatch):
    """With more pairs than are moved at a time the kept texts are the same, and only a slice's sets are held."""
    monkeypatch.setattr(setjoin, "SLICE", 1, raising=False)
    rows = counted(monkeypatch, setjoin, "sets", "links")
    rng = random.Random(3)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for _ in range(60):
        copy = list(base)
        for at in rng.sample(range(150), rng.randrange(1, 8)):
            copy[at] = f"c{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    least, _ = near_brute(texts)
    assert kept_ids(spark, list(enumerate(texts))) == sorted((i, texts[i]) for i in set(least.values()))
    assert len(rows["links"]) > 6 and max(rows["sets"]) < 40


def test_a_share_of_the_texts_is_sampled(spark, monkeypatch):
    """What is frequent is told from a share of the texts, not from a fixed number."""
    monkeypatch.setattr(setjoin, "SAMPLE", 1)
    texts = spark.range(4000).selectExpr("id as doc_id", "id as text_hash", "concat('a b c d e w', id, ' x y z') as text")
    keys, rank = setjoin.frequent_shingles(texts, 5)
    assert keys.tolist() == setjoin.shingle_set("a b c d e", 5).tolist() and rank.tolist() == [0]
    monkeypatch.setattr(setjoin, "FREQUENT", 0)
    assert len(setjoin.frequent_shingles(texts, 5)[0]) == 0


def test_pairs_that_meet_often_are_given_once(spark, monkeypatch):
    """A task gives a pair of sets once, not for each shingle that they share."""
    t = setjoin.fraction(0.8)
    none = np.zeros(0, dtype="<u8")
    base = [f"w{i}" for i in range(1000)]
    texts = [" ".join(base), " ".join(base[:-9] + ["other"])]
    df = spark.createDataFrame([(i, i, x) for i, x in enumerate(texts)], "doc_id bigint, text_hash bigint, text string")
    sets = written(simhash.set_rows(df, 5, t, (none, none.astype(np.int64))), "sets")
    keys = written(setjoin.bucket_rows(sets, t), "keys")
    given = []
    real = type(df).distinct
    monkeypatch.setattr(type(df), "distinct", lambda x: given.append(x.coalesce(1).count() if x.columns == ["a", "b"] else 0) or real(x))
    alone = spark.createDataFrame([], "node bigint, root bigint")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for held in (setjoin.HELD, 1):
        monkeypatch.setattr(setjoin, "HELD", held)
        assert setjoin.candidates(keys, sets.select("node", "signature"), alone, t, True).count() == 1
    assert keys.count() > 300 and given[0] <= parts
