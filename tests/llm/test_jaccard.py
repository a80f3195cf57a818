"""The n-gram join and components against all pairs."""

import random
import re

import numpy as np
import pytest

from tessella.llm import jaccard_join as J
from tessella.llm.components import connected_components


def shingle_set(text, words=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[k : k + words]) for k in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else [])


def brute(rows, p, q, words=3):
    sets = [(i, shingle_set(t, words)) for i, t in rows]
    up = {i: i for i, _ in rows if i is not None}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if i is not None and j is not None and x and y and q * len(x & y) >= p * len(x | y):
                i2, j2 = find(i), find(j)
                up[max(i2, j2)] = min(i2, j2)
    return sorted((str(i), len(x), None if i is None else find(i)) for i, x in sets)


def near_copies(seed, n_bases, n_copies, length, edits):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(n_bases):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(*length))]
        for _ in range(rng.randint(1, n_copies)):
            x = list(base)
            for _ in range(rng.randint(0, edits)):
                at = rng.randrange(len(x))
                x[at : at + rng.randint(0, 1)] = [rng.choice(vocabulary)] * rng.randint(0, 2)
            rows.append(" ".join(x).upper() if rng.random() < 0.1 else " ".join(x))
    rng.shuffle(rows)
    return list(enumerate(rows, 7))


ODD = [(1, None), (2, ""), (3, "  \n"), (4, "One"), (5, "one"), (6, "a b"), (900, "A\tB"), (901, "a b c"), (902, "x " * 5000), (None, "a b"), (903, "é É"), (904, "É É"), (901, "a b c")]


@pytest.mark.parametrize("least, words", [((9, 10), 3), ((4, 5), 5)])
@pytest.mark.parametrize("chunk", [1 << 21, 700])
def test_join(spark, least, words, chunk):
    rows = near_copies(3, 25, 12, (4, 90), 5) + ODD
    df = spark.createDataFrame([(i, t, "n") for i, t in rows], "doc_id long, text string, N string").toDF("doc_id", "text", "Text")
    got = J.ngram_components(df, least, words, chunk)
    assert sorted((str(x.doc_id), x.n_shingles, x.component_id) for x in got.collect()) == brute(rows, *least, words)


def test_large_group(spark):
    """A group over many chunks whose copies hang together only through others."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows, x = [], list(base)
    for i in range(150):
        if i % 3 == 0:
            x[rng.randrange(120)] = f"v{i}"
        rows.append((i, " ".join(x)))
    rows += [(1000 + i, t) for i, t in near_copies(8, 5, 3, (50, 80), 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = J.ngram_components(df, chunk_tokens=2000)
    assert sorted((str(x.doc_id), x.n_shingles, x.component_id) for x in got.collect()) == brute(rows, 9, 10)


@pytest.mark.parametrize("chunk", [1 << 21, 700])
def test_all_links_are_counted(spark, chunk):
    rows = near_copies(3, 12, 16, (60, 90), 3) + ODD
    got = J.ngram_components(spark.createDataFrame(rows, "doc_id long, text string"), chunk_tokens=chunk)
    sets = [(i, shingle_set(t)) for i, t in rows]
    links = [None if i is None else sum(a != b and j is not None and bool(x) and bool(y) and 10 * len(x & y) >= 9 * len(x | y) for b, (j, y) in enumerate(sets)) for a, (i, x) in enumerate(sets)]
    assert sorted((str(x.doc_id), str(x.n_links)) for x in got.collect()) == sorted((str(i), str(n)) for (i, _), n in zip(rows, links))
    assert max(n or 0 for n in links) > 5


def every_link(sets, least):
    return np.array([[i != j and least[1] * (o := len(np.intersect1d(x, y))) >= least[0] * (len(x) + len(y) - o) for j, y in enumerate(sets)] for i, x in enumerate(sets)])


@pytest.mark.parametrize("least", [(9, 10), (4, 5)])
@pytest.mark.parametrize("block", [4, 256])
def test_tree_is_all_pairs(least, block, monkeypatch):
    """Counts and components by the tree, within one set of sets and between two, with any levels."""
    monkeypatch.setattr(J, "BLOCK_SETS", block)
    monkeypatch.setattr(J, "GATHERED", 1 << 10 if block == 4 else 1 << 23)
    rng = np.random.default_rng(4)
    levels = rng.integers(0, 5, 1 << J.COUNTER_BITS).astype(np.uint8)
    names = J.mixed(np.arange(200, dtype=np.uint64))
    linked = 0
    for _ in range(25):
        base = [rng.choice(200, rng.integers(1, 60), replace=False) for _ in range(4)]
        sets = {}
        for _ in range(40):
            x = set(base[rng.integers(4)].tolist())
            for _ in range(rng.integers(0, 4)):
                x.discard(int(rng.integers(200)))
                x.add(int(rng.integers(200)))
            sets[tuple(sorted(x))] = np.sort(names[list(x)])
        sets = list(sets.values())
        weights, sides = rng.integers(1, 4, len(sets)), rng.integers(0, 2, len(sets))
        for which in (None, sides, np.zeros(len(sets), int)):
            want = every_link(sets, least) & (True if which is None else which[:, None] != which)
            linked += want.sum()
            counts, root = J.tree_join(sets, weights, levels, which, least)
            assert counts.tolist() == (want @ weights).tolist()
            up = np.arange(len(sets))
            for _ in sets:
                up = np.array([min([up[i], *up[want[i]]]) for i in range(len(sets))])
            assert root.tolist() == up.tolist()
    assert linked > 1000


def test_null_id_ahead_of_its_copy(spark):
    """A row without doc_id doesn't take the signatures of an equal text behind it in the same partition."""
    words = [f"w{i}" for i in range(60)]
    rows = [(None, " ".join(words)), (5, " ".join(words)), (3, " ".join([*words, "more"]))]
    got = J.ngram_components(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    assert sorted((str(x.doc_id), x.n_shingles, x.component_id) for x in got.collect()) == brute(rows, 9, 10) == [("3", 59, 3), ("5", 58, 3), ("None", 58, None)]


def test_empty(spark):
    assert J.ngram_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("ways", [1, 3])
@pytest.mark.parametrize("least", [(9, 10), (4, 5)])
def test_parts_lose_no_link(least, ways, monkeypatch):
    """Sets that link have a part in common, also where parts are empty; with one way the empty parts must see to it."""
    monkeypatch.setattr(J, "WAYS", ways)
    rng = np.random.default_rng(2)
    levels = rng.integers(0, 9, 1 << J.COUNTER_BITS).astype(np.uint8)
    p, q = least
    linked = 0
    for _ in range(1500):
        n = int(rng.integers(2, 120))
        x = np.unique(J.mixed(rng.integers(0, 1 << 62, n).astype(np.uint64)))
        drop, add = rng.integers(0, 1 + n // 6, 2)
        y = np.unique(np.concatenate([rng.permutation(x)[drop:], J.mixed(rng.integers(0, 1 << 62, add).astype(np.uint64))]))
        both = len(np.intersect1d(x, y))
        if both < len(x) + len(y) - both and len(y) and q * both >= p * (len(x) + len(y) - both):
            linked += 1
            assert set(J.signatures(x, levels, least).tolist()) & set(J.signatures(y, levels, least).tolist())
    assert linked > 100


def test_levels_are_the_corpus_counts(spark):
    """Counters of several tasks add up; levels are those of the sums."""
    texts = [f"a b c d w{i % 7} x y z" for i in range(40)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    levels = np.frombuffer(J.frequency_levels(J.shingled(docs).where("slice is not null").select("slice", "counts")), np.uint8)
    want = np.zeros(1 << J.COUNTER_BITS)
    for t in texts:
        np.add.at(want, J.counter(J.shingles(t)), 1)
    assert levels.tolist() == np.round(8 * np.log2(1 + want)).astype(int).tolist()


@pytest.mark.parametrize("one_task", [0, 1 << 20])
def test_components(spark, one_task):
    """Both ways: by written steps and in one task."""
    edges = [(i, i + 1) for i in range(60)] + [(100, 103), (103, 101), (7, 7), (None, 4), (200, 201), (201, 200)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long").repartition(6), one_task=one_task).collect()
    assert len(found) == len({x.id for x in found})
    assert {x.id: x.component for x in found} == {i: 0 for i in range(61)} | {100: 100, 101: 100, 103: 100, 200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long"), one_task=one_task).collect() == []
