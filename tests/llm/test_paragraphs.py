import re
from collections import Counter, defaultdict

import numpy as np

from tests.llm.conftest import prose
from trawlnet.llm.paragraphs import Repeats, repeated_passages


def sentence(seed, n):
    return prose(seed, n).capitalize() + "."


def passage(seed, sentences=6, n=10):
    return " ".join(sentence(1000 * seed + i, n) for i in range(sentences))


def brute(rows, spec=Repeats()):
    """The result from all pairs of paragraphs, computed plainly."""
    places, times = [], Counter(rows)
    for d, t in times:
        raw, t, at = t, t or "", 0
        words = [(m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", t)]
        first = 0
        for i, (_, end) in enumerate(words):
            last = t[:end]
            stop = re.search(r"[.!?][\"')\]}]?$", last) or i + 1 == len(words) or "\n" in t[end : words[i + 1][0]]
            if stop:
                if i + 1 - first >= spec.shingle:
                    own = ["".join(c.lower() if "A" <= c <= "Z" else c for c in t[a:b]) for a, b in words[first : i + 1]]
                    grams = frozenset(tuple(own[j : j + spec.shingle]) for j in range(len(own) - spec.shingle + 1))
                    places.append(((d is None, d if d is not None else 0, t), at, words[first][0], end, i + 1 - first, grams, (d, raw)))
                    at += 1
                first = i + 1
    classes = list({p[5] for p in places})
    root = {c: c for c in classes}

    def find(c):
        while root[c] is not c:
            c = root[c]
        return c

    by_gram = defaultdict(list)
    for c in classes:
        for g in c:
            by_gram[g].append(c)
    linked = set()
    for own in by_gram.values():
        for a in own:
            for b in own:
                if a is not b and 100 * len(a & b) >= spec.percent * len(a | b):
                    linked |= {a, b}
                    root[find(a)] = find(b)
    found = Counter()
    for p in places:
        found[p[5]] += times[p[6]]
    kept = [p for p in places if found[p[5]] > 1 or p[5] in linked]
    texts = defaultdict(list)
    for p in kept:
        texts[p[0]].append(p)
    pairs = Counter()
    for own in texts.values():
        pairs.update((find(a[5]), find(b[5])) for a, b in zip(own, own[1:], strict=False) if b[1] == a[1] + 1)
    firsts = {}
    for p in kept:
        c = find(p[5])
        firsts[c] = min(firsts.get(c, p[:2]), p[:2])
    out = []
    for own in texts.values():
        runs = []
        for p in own:
            if runs and p[1] == runs[-1][-1][1] + 1 and pairs[find(runs[-1][-1][5]), find(p[5])] > 1:
                runs[-1].append(p)
            else:
                runs.append([p])
        for run in runs:
            if sum(p[4] for p in run) >= spec.least_words:
                for flag in (False, True):
                    part = [p for p in run if (firsts[find(p[5])] != p[:2]) == flag]
                    if part:
                        out.append((None if part[0][0][0] else part[0][0][1], part[0][2], part[-1][3], sum(p[4] for p in part), flag))
    return Counter(out)


def result(df):
    return Counter((r["doc_id"], r["start"], r["end"], r["n_words"], r["removed"]) for r in df.collect())


def rows_with_passages():
    shared, near = passage(1), passage(2)
    words = near.split()
    words[15] = "changed"
    line = sentence(5, 9)
    rows = [(i, f"{prose(i, 30)} {shared} {prose(i + 70, 12)}\n{line}") for i in range(5)]
    rows += [(10, f"{prose(31, 20)}. {near} tail of it"), (11, f"é 🙂 {prose(32, 20)} {' '.join(words)}")]
    rows += [(20 + i, f"{passage(40 + i)}\n{line}\n{passage(60 + i)}") for i in range(6)]
    return rows


def test_passages_inside_lines_equal_brute_force(spark):
    rows = rows_with_passages()
    got = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert result(got) == brute(rows)
    found = got.collect()
    assert {r["doc_id"] for r in found if r["removed"]} >= {1, 2, 3, 4, 11} and not any(r["doc_id"] >= 20 for r in found)


def test_odd_cases_equal_brute_force(odd, odd_rows):
    assert result(repeated_passages(odd)) == brute([r[:2] for r in odd_rows])


def test_given_table_equals_brute_force(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    got, want = result(repeated_passages(documents)), brute(rows)
    # ties between copies of one text are by hash there and by text here
    assert abs(sum(got.values()) - sum(want.values())) <= 0.02 * sum(want.values())
    assert {d for d, *_ in got} == {d for d, *_ in want}


def test_one_occurrence_of_each_paragraph_survives_cutting(spark):
    line, inner = sentence(5, 12), passage(7, 2, 20)
    rows = [(1, f"{line}\n{line}\n{line}")] + [(i, f"{line}\n{inner}\n{line}") for i in (2, 3, 4)]
    left = {d: t for d, t in rows}
    for r in sorted(repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect(), key=lambda r: -r["start"]):
        if r["removed"]:
            left[r["doc_id"]] = left[r["doc_id"]][: r["start"]] + left[r["doc_id"]][r["end"] :]
    assert inner in left[2] and not any(inner in left[i] for i in (3, 4))
    assert any(line in t for t in left.values())


def test_bands_miss_few_pairs_at_the_threshold():
    spec = Repeats()
    assert (1 - spec.percent / 100) ** spec.bands < 1e-4


def test_empty_table(empty):
    assert repeated_passages(empty).count() == 0


def test_classes_are_numbers_that_need_no_sort(spark, plan):
    from trawlnet.llm.paragraphs import _classes, _ids, _paragraphs, _sets
    from trawlnet.llm.words import MinHash

    texts = [passage(1), passage(1) + " " + passage(2), sentence(5, 8) + " " + sentence(5, 8), "short one.", "", None]
    spec = Repeats(bands=5)
    df = _classes(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3), spec)
    assert "SortAggregate" not in plan(df) and "Sort [" not in plan(df)
    want = {}
    for t in texts:
        raw = np.frombuffer((t or "").encode(), np.uint8)
        words, _, _, _, first, to = _paragraphs(raw, np.array([0, len(raw)]))
        _, values, bounds = _sets(words, first, to, spec.shingle)
        minima = MinHash(spec.bands, spec.seed)(values, bounds).tolist() if len(bounds) > 1 else []
        for own, n, keys in zip(_ids(values, bounds), np.diff(bounds).tolist(), minima, strict=True):
            found = want.get(own.tobytes(), (0,))[0]
            want[own.tobytes()] = (found + 1, n, [k | i << 32 for i, k in enumerate(keys)])
    rows = df.collect()
    assert len(rows) == len(want) and {bytes(r["set_id"]): (r["found"], r["n"], r["bands"]) for r in rows} == want
