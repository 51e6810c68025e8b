import zlib
from collections import Counter, defaultdict

import pytest

from trawlnet.llm.ring import Ring, assign, place


def walk(ring, owners, arcs):
    """The rule key by key: home keys first, then round after round one node further."""
    home = Counter()
    for owner, keys in zip(owners, arcs, strict=True):
        home[owner] += len(keys)
    room = ring.capacities([home[s] for s in range(ring.shards)])
    out, waiting = defaultdict(list), [list(k) for k in arcs]
    while any(waiting):
        onward = [[] for _ in arcs]
        for node, queue in enumerate(waiting):
            for key in queue:
                shard = owners[node]
                if room[shard]:
                    room[shard] -= 1
                    out[shard].append(key)
                else:
                    onward[(node + 1) % len(arcs)].append(key)
        waiting = onward
    return out


@pytest.mark.parametrize("slack", [0.0, 0.1, 1.0])
def test_segments_equal_the_walk_key_by_key(slack):
    ring = Ring(shards=4, virtual_nodes=6, slack=slack)
    owners = [s for _, s in ring.nodes()]
    counts = [(i * 7919) % 23 for i in range(len(owners))]
    arcs = [[(a, r) for r in range(n)] for a, n in enumerate(counts)]
    got = defaultdict(list)
    for arc, low, high, shard, slot in place(ring, owners, counts):
        assert slot == len(got[shard])
        got[shard] += [(arc, r) for r in range(low, high)]
    assert got == walk(ring, owners, arcs)


@pytest.mark.parametrize("slack", [0.0, 0.25])
def test_odd_cases(odd, odd_rows, slack):
    rows = assign(odd, Ring(shards=4, virtual_nodes=16, slack=slack)).collect()
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _ in odd_rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[s]) for s in range(4)]
    assert max(sizes) - min(sizes) <= 1 if not slack else max(sizes) <= -(-len(rows) * 5 // 16)


def test_few_rows_move_when_a_shard_is_added(documents):
    before = {r["doc_id"]: r["shard"] for r in assign(documents, Ring(shards=8, slack=0.25)).collect()}
    after = {r["doc_id"]: r["shard"] for r in assign(documents, Ring(shards=9, slack=0.25)).collect()}
    assert sum(before[d] != after[d] for d in before) < 0.4 * len(before)


def test_the_layout_of_the_table_does_not_matter(documents):
    a = sorted(assign(documents.repartition(1)).collect())
    assert a == sorted(assign(documents.repartition(7)).collect())


def test_empty_table(empty):
    assert assign(empty).count() == 0
