"""Links and link counts against all pairs."""
import itertools
import random
from collections import Counter

import numpy as np
import pytest

from clinloom.llm.jaccard_links import block_links, jaccard_links, link_counts
from clinloom.llm.ngram_join import Shingles
from test_ngram_join import SCHEMA, near_copies, shingle_set


def around_threshold():
    """A group whose pairs lie just below and just above the threshold, sizes far apart, copies."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    base = [word() for _ in range(104)]  # 100 shingles; an edit changes five
    rows = []
    for k in range(24):
        copy = list(base)
        for e in range(1 + k % 3):
            copy[10 + 20 * e + rng.randrange(5)] = word()
        rows.append((2 * k, " ".join(copy)))
    for k, extra in enumerate((20, 24, 25, 26, 30, 60, 125, 140)):
        rows.append((1001 + 2 * k, " ".join(base + [word() for _ in range(extra)])))
    return rows + [(i + 5000, t) for i, t in rows[::5]] + [(i + 7000, t) for i, t in rows[::5]]


def brute(rows):
    """Links between different sets by representatives with their counts, and n_links by document."""
    rows = [(i, frozenset(shingle_set(t or ""))) for i, t in rows if i is not None]
    rep = {}
    for i, s in rows:
        rep[s] = min(i, rep.get(s, i))
    links, pairs = Counter(), set()
    for (i, x), (j, y) in itertools.combinations(rows, 2):
        both = len(x & y)
        if x and y and 100 * both >= 80 * len(x | y):
            links[i] += 1
            links[j] += 1
            if x != y:
                pairs.add((*sorted((rep[x], rep[y])), both, len(x | y)))
    return pairs, {i: links[i] for i, _ in rows}


def test_all_links(spark):
    """Blocks of few classes, so that links cross blocks and levels of size."""
    rows = near_copies(3) + [(i + 20_001, t) for i, t in around_threshold()]
    docs = spark.createDataFrame([(i, t, 1, "clash", "clash") for i, t in rows], SCHEMA).repartition(4)
    pairs, counts = brute(rows)
    got = [tuple(r) for r in jaccard_links(docs, members=7, shingles=900).collect()]
    assert len(got) == len(set(got)) and set(got) == pairs
    counted = link_counts(docs, members=7, shingles=900).collect()
    assert len(counted) == len(rows)
    assert {r.doc_id: r.n_links for r in counted if r.doc_id is not None} == counts
    assert all(r.n_links == 0 and r.class_id is None for r in counted if r.doc_id is None)


@pytest.mark.parametrize("rows", [near_copies(4), around_threshold()], ids=["copies", "threshold"])
def test_block(rows):
    """One block with itself and two blocks, against all pairs."""
    sets = list({s.tobytes(): s for _, t in rows if len(s := Shingles(5)(t or ""))}.values())
    similar = {(i, j): len(both) for i, j in itertools.combinations(range(len(sets)), 2)
               if 100 * len(both := np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    every, half = np.arange(len(sets)), len(sets) // 2
    assert {(i, j): n for i, j, n in zip(*block_links(sets, every, every, 80, 4), strict=True)} == similar
    across = zip(*block_links(sets, every[:half], every[half:], 80, 4), strict=True)
    assert {(i, j): n for i, j, n in across} == {(i, j): n for (i, j), n in similar.items() if i < half <= j}


def test_empty_and_copies_only(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert link_counts(none).count() == 0 and jaccard_links(none).count() == 0
    same = spark.createDataFrame([(i, t, 1, "c", "r") for i, t in [(3, "a b c"), (3, "a b c"), (5, "A  b c"), (6, ""), (7, None)]], SCHEMA)
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in link_counts(same).collect()) == [(3, 3, 2), (3, 3, 2), (5, 3, 2), (6, 6, 0), (7, 7, 0)]
    assert jaccard_links(same).count() == 0
