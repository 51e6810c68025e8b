import numpy as np
import pytest

from tests.llm.conftest import prose
from trawlnet.llm.licenses import TEMPLATES, Licences, TemplateIndex, align, licence_matches, winnow
from trawlnet.llm.words import shingle_hashes


def found(spark, rows):
    return licence_matches(spark.createDataFrame(rows, "doc_id long, text string")).collect()


def test_every_template_is_found_where_it_stands(spark):
    rows = [(i, f"é {prose(i, 20)}\n{text} {prose(i + 50, 20)}") for i, (_, text) in enumerate(TEMPLATES)]
    got = found(spark, rows)
    for i, (name, text) in enumerate(TEMPLATES):
        own = [r for r in got if r["doc_id"] == i]
        assert [r["licence"] for r in own] == [name] and own[0]["coverage"] == 1
        assert rows[i][1][own[0]["start"] : own[0]["end"]] == text.rstrip('.:"')


def test_edits_within_the_band_are_aligned(spark):
    name, text = TEMPLATES[5]
    words = text.upper().split()
    words[10] = "something"
    words.insert(25, "inserted here")
    del words[30]
    got = found(spark, [(1, " ".join(words)), (2, " ".join(words[:20])), (3, f"{text}\n{prose(1, 30)}\n{text}")])
    assert [(r["doc_id"], r["licence"]) for r in got] == [(1, name), (3, name), (3, name)]
    assert 0.9 < got[0]["coverage"] < 1


def test_alignment_equals_the_full_table():
    rng = np.random.default_rng(3)
    for _ in range(50):
        a, b = rng.integers(0, 6, 12), rng.integers(0, 6, 14)
        table = np.zeros((13, 15), int)
        for i in range(12):
            for j in range(14):
                table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        matched, first, end = align(a, b, 0, 20)
        assert matched == table[-1, -1] and 0 <= first < end <= 14
        assert matched <= end - first


def test_winnowing_guarantee():
    rng = np.random.default_rng(4)
    spec = Licences()
    for _ in range(100):
        shared = rng.integers(0, 1 << 60, spec.gram + spec.window - 1).astype(np.uint64)
        sides = []
        for _ in range(2):
            text = np.concatenate([rng.integers(0, 1 << 60, 9).astype(np.uint64), shared, rng.integers(0, 1 << 60, 9).astype(np.uint64)])
            grams = shingle_hashes(text, spec.gram)
            sides.append(set(grams[winnow(grams, spec.window)].tolist()))
        assert sides[0] & sides[1]


def test_given_notices_are_all_found(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    want = {d for d, t in rows if any(n in t for n in ("License", "CC BY"))}
    assert {r["doc_id"] for r in found(spark, rows)} == want


def test_versions_and_variants_are_told_apart(spark):
    notice = "This work is licensed under the GNU {}General Public License, version {}."
    want = {1: "GPL-2.0", 2: "LGPL-3.0", 3: "AGPL-3.0", 4: "LGPL-2.1", 5: "CC-BY-NC-ND-4.0"}
    texts = [notice.format("", 2), notice.format("Lesser ", 3), notice.format("Affero ", 3), notice.format("Lesser ", "2.1"), "Licensed under CC BY-NC-ND 4.0."]
    rows = [(i + 1, f"{prose(i, 10)} {t} {prose(i + 9, 10)}") for i, t in enumerate(texts)] + [(9, notice.format("", 7))]
    assert {r["doc_id"]: r["licence"] for r in found(spark, rows)} == want


def test_whole_texts_are_measured_whole(spark):
    whole = {n: t for n, t in TEMPLATES if len(t.split()) > 100}
    assert whole.keys() >= {"MIT", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "CC0-1.0", "Zlib", "BSL-1.0"}
    words = whole["GPL-3.0"].split()
    rows = [(1, f"{prose(1, 30)} {' '.join(w for i, w in enumerate(words) if i % 20)} {prose(2, 30)}")]
    got = found(spark, rows)
    assert [r["licence"] for r in got] == ["GPL-3.0"] and 0.9 < got[0]["coverage"] < 1


def test_odd_cases(odd, empty):
    assert licence_matches(odd).count() == 0 and licence_matches(empty).count() == 0


def test_short_templates_are_refused_and_blank_ones_skipped():
    with pytest.raises(ValueError):
        TemplateIndex([("x", "two words")], Licences())
    assert TemplateIndex([("x", " .")], Licences()).names == []
