import random

import pytest

from tests.llm import brute, data
from threadlens.llm.sketches import near_duplicates

COLS = ("doc_id", "n_shingles", "component_id", "kept")


@pytest.mark.parametrize("hot,stars", [(32, 2), (1, 0)])     # paired lists; prefix filter alone
def test_as_brute_force(spark, hot, stars):
    rs = data.rows(11, 200)
    df = data.frame(spark, [*rs, (None, "nobody at all")]).repartition(5)
    assert data.result(near_duplicates(df, hot=hot, stars=stars), *COLS) == brute.near_groups(rs)


def test_groups_chains_and_small_sets(spark):
    r = random.Random(5)
    words = [f"w{k}" for k in range(500)]
    rs, base = [], [r.choice(words) for _ in range(60)]
    for i in range(150):                                     # a chain of drifting copies, and short texts
        base[r.randrange(60)] = r.choice(words)
        rs.append((i, " ".join(base)))
    short = [f"a{k}" for k in range(7)]
    for i in range(60):
        t = list(short[:r.randint(1, 7)])
        if r.random() < .4:
            t[r.randrange(len(t))] = r.choice(words)
        rs.append((1000 + i, " ".join(t)))
    assert data.result(near_duplicates(data.frame(spark, rs)), *COLS) == brute.near_groups(rs)


def test_empty_and_repeated_rows(spark):
    assert near_duplicates(data.frame(spark, [])).collect() == []
    got = data.result(near_duplicates(data.frame(spark, [(5, "a b c"), (5, "a b c"), (2, None), (3, "")])), *COLS)
    assert got == [(2, 0, 2, True), (3, 0, 3, True), (5, 2, 5, True), (5, 2, 5, True)]
