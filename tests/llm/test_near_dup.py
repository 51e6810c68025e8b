import re

import pytest

from tests.llm.conftest import prose
from trawlnet.llm.components import components
from trawlnet.llm.near_dup import NearDup, near_duplicates


def shingles(text, k):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def brute(rows, k, percent=80):
    """Component of each row by comparing all pairs."""
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    lows = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            r = find(i)
            lows[r] = min(lows.get(r, doc_id), doc_id)
    return sorted(((d, len(sets[i]), lows.get(find(i))) for i, (d, _) in enumerate(rows)), key=repr)


def result(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("k", [2, 5])
def test_odd_cases_equal_brute_force(odd, odd_rows, k):
    got = near_duplicates(odd, NearDup(shingle=k))
    assert result(got) == brute([r[:2] for r in odd_rows], k)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got.collect())


def test_family_of_chained_copies_equals_brute_force(spark):
    """A chain whose ends differ, branches and strangers: hubs alone do not connect it."""
    base = prose(3, 150).split()
    rows = []
    for branch in range(4):
        words = list(base)
        for step in range(12):
            words[(branch * 37 + step * 9) % 150] = f"new{branch}x{step}"
            words[(branch * 37 + step * 9 + 4) % 150] = f"more{branch}x{step}"
            rows.append((1000 - len(rows), " ".join(words)))
    rows += [(i, prose(500 + i, 100)) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(near_duplicates(df, NearDup(shingle=2))) == brute(rows, 2)


def test_empty_table(empty):
    assert near_duplicates(empty).count() == 0


def test_pruning_bounds_follow_the_posterior():
    """Integrated numerically: at the bound the posterior still reaches ``miss``, one bit beyond it does not."""
    import numpy as np

    spec = NearDup()
    p = np.linspace(0.5, 1, 200_001)[:-1] + 1.25e-6
    for i, most in enumerate(spec.most_apart()):
        n = 64 * (i + 1)
        for apart, above in ((most, True), (most + 1, False)):
            log = (n - apart) * np.log(p) + apart * np.log1p(-p)
            weight = np.exp(log - log.max())
            assert (weight[p >= 0.9].sum() / weight.sum() >= spec.miss) == above


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100 + i, 100) for i in range(1, 60)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(60)} | {200: 200, 201: 200}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
