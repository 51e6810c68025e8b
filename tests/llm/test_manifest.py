import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from trawlnet.llm.manifest import Manifest, checked, manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves, arity):
    """The root of some digests, and for each the left and right siblings of every level."""
    paths, place, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        runs = [level[i : i + arity] for i in range(0, len(level), arity)]
        for i, p in enumerate(place):
            run, slot = runs[p // arity], p % arity
            paths[i].append(("".join(run[:slot]), "".join(run[slot + 1 :])))
            place[i] = p // arity
        level = [sha("".join(r)) for r in runs]
    return level[0], paths


def brute(rows, arity, change):
    """``(doc_id, leaf, subroot, root, proof, folded root)`` of rows ``doc_id, source, lang, n_chars, text``."""
    sources = defaultdict(list)
    for r in rows:
        sources[r[1]].append((leaf(r), r))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        sources[s].sort(key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0]))
        trees.append(tree([x[0] for x in sources[s]], arity))
    root, tops = tree([t[0] for t in trees], arity)
    out = []
    for s, (subroot, paths), top in zip(order, trees, tops, strict=True):
        for (digest, r), path in zip(sources[s], paths, strict=True):
            seen = leaf((*r[:4], change(r)))
            for left, right in path + top:
                seen = sha(left + seen + right)
            out.append((r[0], digest, subroot, root, sha("".join(a + b for a, b in path + top)), seen))
    return sorted(out, key=repr)


@pytest.mark.parametrize("arity", [2, 3, 16])
def test_equals_brute_force(spark, odd_rows, odd, arity):
    rows = [(i, s, None if (i or 0) % 2 else "en", None if text is None else len(text), text) for i, text, s in odd_rows]
    rows += [(100 + i, "solo" + str(i), "é", i, "Ä b C") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string")
    df = df.selectExpr("*", *[f"'x' as {c}" for c in ("digest", "leaf", "tree", "place", "path", "slot", "n", "children", "named", "tie", "id")]).repartition(3)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def tamper(text):
        return F.when(F.col("doc_id") % 3 == 0, F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(text)

    def change(r):
        return r[4].translate(lower) if r[4] is not None and r[0] is not None and r[0] % 3 == 0 else r[4]

    got = checked(manifest(df, Manifest(arity=arity), tamper)).collect()
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"]
    assert sorted((tuple(r[c] for c in columns) for r in got), key=repr) == brute(rows, arity, change)
    assert all(r["verified"] == (r["folded_root"] == r["root"]) for r in got)
    assert {r["verified"] for r in got} == {True, False}


def test_order_of_rows_does_not_matter(spark, odd):
    spec = Manifest(fields=("doc_id", "source", "text"))
    roots = {r["root"] for n in (1, 4) for r in manifest(odd.repartition(n), spec).select("root").distinct().collect()}
    assert len(roots) == 1
    assert all(r["verified"] for r in checked(manifest(odd, spec)).collect())


def test_one_row_and_no_row(spark, empty):
    assert manifest(empty).collect() == []
    one = spark.createDataFrame([(7, "a", "s", "en", 1)], empty.schema)
    (row,) = checked(manifest(one)).collect()
    assert row["leaf"] == row["subroot"] == row["root"] == leaf((7, "s", "en", 1, "a"))
    assert row["proof_sha256"] == sha("") and row["verified"]


def test_a_long_text(spark, empty):
    rows = [(i, "Word " * n, "s", None, n) for i, n in enumerate([1, 400_000, 2])]
    got = checked(manifest(spark.createDataFrame(rows, empty.schema))).collect()
    assert {r["leaf"] for r in got} == {leaf((i, "s", None, n, t)) for i, t, _, _, n in rows}
