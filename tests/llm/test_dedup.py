"""Exact, near and substring dedup against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from docloom.llm import simhash, substrings
from docloom.llm.common import written
from docloom.llm.exact import drop_exact_copies, exact_groups
from docloom.llm.simhash import components, drop_near_copies, links, near_digest, near_groups
from docloom.llm.substrings import substring_digest

from .conftest import CLASHING, prose, rows

WORD = re.compile("[^\x20\x09-\x0d]+")
SPACE = re.compile("[\x20\x09-\x0d]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------- exact


def exact_brute(docs):
    groups = defaultdict(list)
    for i, text in docs:
        groups[SPACE.sub(" ", text or "")].append(i)
    out = []
    for norm, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known, default=None)
        kept = False
        for i in sorted(ids, key=lambda i: (i is None, i or 0)):
            out.append((i, keep, len(ids), i == keep and not kept, sha(norm)))
            kept = True
    return Counter(out)


def test_exact(spark, odd, given):
    for docs in (odd, given):
        want = exact_brute([(r["doc_id"], r["text"]) for r in docs.collect()])
        got = Counter(tuple(r) for r in exact_groups(docs).collect())
        assert got == want


def test_exact_hot_text(spark):
    docs = [(i, "the same" if i % 3 else prose(i, 20)) for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(6)
    assert Counter(tuple(r) for r in exact_groups(df).collect()) == exact_brute(docs)


def test_exact_keeps_columns(crowded, empty):
    kept = drop_exact_copies(crowded)
    assert kept.columns == crowded.columns
    got = rows(kept)
    assert sorted(str(r["doc_id"]) for r in got) == sorted(map(str, [1, 3, 4, 5, 8, 9, 10, 11, 12, 13, 14, None]))
    assert all(r[c] == c for r in got for c in CLASHING)
    assert drop_exact_copies(empty).columns == empty.columns
    assert rows(exact_groups(empty)) == []


# ---------------------------------------------------------------- near


def slow_fingerprint(text, shingle=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    spans = [words[i : i + shingle] for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64(" ".join(s).encode(), seed=42).intdigest() for s in spans]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(nodes, linked):
    """node -> smallest node reachable."""
    least = {n: n for n in nodes}
    seen = set()
    for n in sorted(nodes):
        if n in seen:
            continue
        stack = [n]
        seen.add(n)
        while stack:
            a = stack.pop()
            least[a] = n
            for b in nodes:
                if b not in seen and linked(a, b):
                    seen.add(b)
                    stack.append(b)
    return least


def test_near_against_brute_force(given, odd):
    for docs in (given, odd.where("doc_id is not null")):
        table = [(r["doc_id"], slow_fingerprint(r["text"])) for r in docs.collect()]
        by_fp = defaultdict(list)
        for i, fp in table:
            by_fp[fp].append(i)
        node = {fp: min(ids) for fp, ids in by_fp.items()}
        fp_of = {n: fp for fp, n in node.items()}
        least = slow_components(set(fp_of), lambda a, b: (fp_of[a] ^ fp_of[b]).bit_count() <= 4)
        want = Counter((i, f"{fp:016x}", least[node[fp]]) for i, fp in table)
        assert Counter(tuple(r) for r in near_digest(docs).collect()) == want


def clustered(seed, n, flips):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(n // 6)]
    out = set()
    while len(out) < n:
        x = rng.choice(centres)
        for _ in range(rng.randrange(flips)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("bits,bucket", [(4, 2048), (4, 3), (7, 64), (1, 2)])
def test_links_are_whole(spark, bits, bucket):
    """Also where buckets must be split again and again."""
    fps = clustered(bits * 1000 + bucket, 300, 8)
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame(list(enumerate(signed)), "node bigint, fp bigint")
    found = components(links(nodes, bits, bucket))
    got = {i: i for i in range(len(fps))} | {r["node"]: r["root"] for r in found.collect()}
    assert got == slow_components(set(range(len(fps))), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= bits)


def test_one_value_buckets_split(spark):
    """Most fingerprints differ in few bits, so one partition's bucket holds nearly all."""
    fps = [(0xABCD << 48) | i for i in range(200)]
    nodes = spark.createDataFrame(list(enumerate(np.array(fps, dtype=np.uint64).view(np.int64).tolist())), "node bigint, fp bigint")
    assert {r["root"] for r in components(links(nodes, 4, 8)).collect()} == {0}


def test_plan_is_exact():
    """Thresholds plus one add up to bits + 1 over partitions that hold each bit at most once."""
    rng = np.random.default_rng(1)
    sample = rng.integers(0, 2**63, 500).astype(np.uint64)
    for bits in (0, 1, 4, 10):
        for n in (1, 1000, 10**9):
            plan = simhash.make_plan(sample, n, bits)
            assert sum(t + 1 for t in plan.thresholds) == bits + 1
            every = [b for p in plan.parts for b in p]
            assert len(every) == len(set(every))


def test_allocation_is_cheapest():
    cost = [[0.0, 5.0, 9.0], [0.0, 1.0, 50.0], [0.0, 4.0, 5.0]]
    assert simhash.allocate(cost, 2)[1] == (-1, 0, 1)


def test_path_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)], "a bigint, b bigint")
    assert {(r["node"], r["root"]) for r in components(edges).collect()} == {(i, 0) for i in range(1, 61)}


def test_wide_links_against_brute_force(given):
    texts = {r["doc_id"]: r["text"] for r in given.collect()}
    wide = {i: simhash.wide_fingerprint(t) for i, t in texts.items()}
    most = simhash.wide_bits(0.8)

    def linked(a, b):
        apart = np.bitwise_count(wide[a] ^ wide[b])
        return apart[0] <= 10 and apart.sum() <= most

    want = slow_components(set(texts), linked)
    got = {r["doc_id"]: r["component_id"] for r in near_groups(given, 5, 10, similarity=0.8).collect()}
    assert got == want


def test_near_copies_go(spark, crowded, empty):
    text = prose(99, 400).split()
    changed = text[:200] + ["changed"] + text[201:]
    half = text[:200] + prose(98, 200).split()
    docs = [(1, " ".join(text)), (2, " ".join(changed)), (3, " ".join(half)), (4, prose(97, 400)), (None, " ".join(text))]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert sorted(str(r["doc_id"]) for r in drop_near_copies(df).collect()) == ["1", "3", "4", "None"]
    kept = drop_near_copies(crowded)
    assert kept.columns == crowded.columns
    assert {r["doc_id"] for r in kept.collect()} >= {4, 5, 8, 9, 10, 11, 13, None}
    assert rows(drop_near_copies(empty)) == rows(near_digest(empty)) == []


# ---------------------------------------------------------------- substrings


def substring_brute(docs, window):
    words = [(i, WORD.findall(t or "")) for i, t in docs]
    count = Counter(tuple(w[s : s + window]) for _, w in words for s in range(len(w) - window + 1))
    out = []
    for i, w in words:
        gone = set()
        for s in range(len(w) - window + 1):
            if count[tuple(w[s : s + window])] > 1:
                gone.update(range(s, s + window))
        out.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return Counter(out)


def test_substrings_against_brute_force(given, odd):
    for docs in (given, odd):
        want = substring_brute([(r["doc_id"], r["text"]) for r in docs.collect()], 35)
        assert Counter(tuple(r) for r in substring_digest(docs).collect()) == want


@pytest.mark.parametrize("seed", range(4))
def test_substrings_of_patched_texts(spark, seed):
    """Few words, repeated passages, periods and copies with changes."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(rng.choice([2, 5, 400]))]
    parts = [[rng.choice(vocabulary) for _ in range(rng.randrange(5, 60))] for _ in range(12)]
    docs = []
    for i in range(60):
        words = []
        for _ in range(rng.randrange(0, 5)):
            piece = list(rng.choice(parts))
            if rng.random() < 0.4:
                piece[rng.randrange(len(piece))] = "patched"
            if rng.random() < 0.3:
                piece = [rng.choice(vocabulary) for _ in range(20)]
            if rng.random() < 0.1:
                piece = piece[:3] * 20
            words += piece
        docs.append((rng.choice([i, i, i, 3]), " ".join(words)))
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    for window in (substrings.BLOCK, 12, 35):
        assert Counter(tuple(r) for r in substring_digest(df, window).collect()) == substring_brute(docs, window), window


def test_substrings_empty(empty):
    assert rows(substring_digest(empty)) == []


# ---------------------------------------------------------------- near copies by exact similarity


def shingles_of(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def near_brute(texts):
    sets = [shingles_of(t) for t in texts]

    def near(a, b):
        common = len(sets[a] & sets[b])
        return 5 * common >= 4 * (len(sets[a]) + len(sets[b]) - common)

    return slow_components(set(range(len(texts))), near), sets


def close_texts(seed, n, words):
    """Pairs, each of a text and a copy with changed words, of similarities around 0.8."""
    rng = random.Random(seed)
    texts = []
    for i in range(n):
        base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
        copy = list(base)
        for at in rng.sample(range(words), max(1, rng.randrange(words // 75, words // 40 + 2))):
            copy[at] = f"c{rng.randrange(10**6)}"
        texts += [" ".join(base), " ".join(copy)]
    return texts


def kept_ids(spark, docs):
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    return sorted((r["doc_id"], r["text"]) for r in drop_near_copies(df).collect())


def test_near_copies_at_the_limit_all_go(spark):
    """Recall and precision 1 against exact similarity, for short and long texts, by no third text."""
    texts = close_texts(1, 60, 300) + close_texts(2, 40, 60) + close_texts(3, 20, 30)
    least, sets = near_brute(texts)
    pairs = [len(sets[i] & sets[i + 1]) / len(sets[i] | sets[i + 1]) for i in range(0, len(texts), 2)]
    assert sum(0.8 <= x < 0.85 for x in pairs) > 10 and sum(0.7 < x < 0.8 for x in pairs) > 10
    assert kept_ids(spark, list(enumerate(texts))) == sorted((i, texts[i]) for i in least if least[i] == i)


def test_only_true_near_copies_go(spark):
    """Not a family of template pages below the limit, nor two pages that repeat one line."""
    rng = random.Random(7)
    template = [f"t{i}" for i in range(240)]
    pages = [" ".join(template + [f"p{rng.randrange(10**6)}" for _ in range(50)]) for _ in range(60)]
    line = [f"line{i}" for i in range(20)]
    repeating = [" ".join(line * 50 + [f"own{rng.randrange(10**6)}" for _ in range(300)]) for _ in range(2)]
    texts = pages + repeating
    least, sets = near_brute(texts)
    assert all(i == k for i, k in least.items()) and len(sets[0] & sets[1]) / len(sets[0] | sets[1]) > 0.69
    assert kept_ids(spark, list(enumerate(texts))) == sorted(enumerate(texts))


@pytest.mark.parametrize("chunk", [1 << 14, 7])
def test_dense_groups_of_near_copies(spark, chunk, monkeypatch):
    """Many copies of one text with changes, so that some pairs are near and some are not; also in chunks."""
    from docloom.llm import setjoin

    monkeypatch.setattr(setjoin.candidates, "__defaults__", (chunk,))
    rng = random.Random(3)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for _ in range(80):
        copy = list(base)
        for at in rng.sample(range(150), rng.randrange(1, 8)):
            copy[at] = f"c{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    least, _ = near_brute(texts)
    assert 1 < len(set(least.values())) < 80
    assert kept_ids(spark, list(enumerate(texts))) == sorted((i, texts[i]) for i in set(least.values()))


def test_texts_that_share_a_passage_are_no_candidates(spark):
    """Pairs are made of texts whose signatures allow it, not of all that share a rare shingle; buckets of one component go."""
    from docloom.llm import setjoin

    passage = [f"p{i}" for i in range(20)]
    texts = [" ".join([f"w{n}.{i}" for i in range(60)] + passage) for n in range(50)]
    texts.append(texts[0] + " more")
    t = setjoin.fraction(0.8)
    none = np.zeros(0, dtype="<u8")
    df = spark.createDataFrame([(i, i, x) for i, x in enumerate(texts)], "doc_id bigint, text_hash bigint, text string")
    sets = written(simhash.set_rows(df, 5, t, (none, none.astype(np.int64))), "sets")
    found = {r["node"]: r["doc_id"] for r in sets.collect()}
    keys = written(setjoin.bucket_rows(sets, t), "keys")
    alone = spark.createDataFrame([], "node bigint, root bigint")
    left = setjoin.open_rows(keys, alone)
    per_bucket = Counter(r["bucket"] for r in left.collect())
    assert max(per_bucket.values()) > 40 and min(per_bucket.values()) > 1
    nodes = sets.select("node", "signature")
    for all_pairs in (False, True):
        pairs = setjoin.candidates(left, nodes, alone, t, all_pairs).collect()
        made = {tuple(sorted((found[r["a"]], found[r["b"]]))) for r in pairs}
        assert made <= {(0, 50)}
    assert made == {(0, 50)}
    joined = spark.createDataFrame([(n, 0) for n in found], "node bigint, root bigint")
    assert setjoin.open_rows(keys, joined).isEmpty()


def test_rows_that_repeat_an_id_are_judged_apart(spark):
    x, y, z = prose(71, 200).split(), prose(72, 200), prose(73, 200)
    near = " ".join(x[:100] + ["changed"] + x[101:])
    docs = [(1, " ".join(x)), (7, near), (7, y), (7, z), (7, z), (8, z + " more")]
    assert kept_ids(spark, docs) == sorted([(1, " ".join(x)), (7, y), (7, z)])


def test_substrings_of_texts_whose_hashes_share_31_bits(spark):
    """Two texts of one id whose 64-bit hashes agree in the low 31 bits, and others with the same passage."""
    passage = prose(81, 50)
    texts = spark.range(200_000).selectExpr("id", f"concat(if(id % 2 = 0, '{passage} ', ''), 'n', id, if(id % 2 = 0, '', ' {passage}')) as text")
    low = texts.selectExpr("*", "xxhash64(text) & 2147483647 as low")
    twins = low.groupBy("low").agg({"id": "count"}).where("`count(id)` > 1").select("low")
    found = [r["text"] for r in low.join(twins, "low").orderBy("low", "id").collect()]
    assert len(found) >= 2
    docs = [(7, t) for t in found] + [(None, t) for t in found] + [(8, "x " + passage)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    assert Counter(tuple(r) for r in substring_digest(df).collect()) == substring_brute(docs, 35)


def test_near_copies_without_ids_go(spark):
    """Rows without an id keep one of each group of near copies among them, and give way to no row with an id."""
    text, other = prose(99, 400).split(), prose(98, 300)
    changed = text[:200] + ["changed"] + text[201:]
    docs = [(1, " ".join(text)), (None, " ".join(text)), (None, " ".join(text)), (None, " ".join(changed)), (None, other), (None, None), (None, "")]
    kept = drop_near_copies(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert [r["text"] for r in kept if r["doc_id"] == 1] == [" ".join(text)]
    left = Counter("family" if (r["text"] or "").startswith(" ".join(text[:50])) else r["text"] or "" for r in kept if r["doc_id"] is None)
    assert left == {"family": 1, other: 1, "": 1}


def test_many_equal_rows(spark, monkeypatch):
    """Rows that are equal in id and text list their blocks once: what a task holds doesn't grow with their number."""
    lists = []

    def kept(df, name):
        out = written(df, name)
        if name == "shared-blocks":
            lists.extend(r[0] for r in out.select(F.size("found")).collect())
        return out

    monkeypatch.setattr(substrings, "written", kept)
    text = prose(5, 120)
    docs = spark.createDataFrame([(1, text)] * 10_000 + [(2, prose(6, 60)), (3, text + " tail")], "doc_id bigint, text string")
    want = substring_brute([(1, text)] * 2 + [(2, prose(6, 60)), (3, text + " tail")], 35)
    want[next(k for k in want if k[0] == 1)] = 10_000
    assert Counter(tuple(r) for r in substring_digest(docs).collect()) == want
    assert max(lists) < 60


def test_a_hot_block_is_split(spark, monkeypatch):
    """The join with a frequent block is a skew join: its sides are tables, whose sizes Spark knows."""
    line = prose(77, 38)  # too short for a factor, so its windows are compared in every document
    docs = spark.createDataFrame([(i, f"{prose(i, 40)} {line} {prose(i + 5000, 40)}") for i in range(3000)], "doc_id bigint, text string")
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "40",
        "spark.sql.files.maxPartitionBytes": "32k",  # several map tasks, as a split goes by what each wrote
        "spark.sql.files.openCostInBytes": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    plans = {}

    def kept(df, name):
        if name == "shared-blocks":
            df.collect()
            plans[name] = df._jdf.queryExecution().toString()
        return written(df, name)

    monkeypatch.setattr(substrings, "written", kept)
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got = rows(substring_digest(docs))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert all(r["n_removed"] >= 38 for r in got) and len(got) == 3000
    assert set(plans) == {"shared-blocks"}
    assert "skew=true" in plans["shared-blocks"]
