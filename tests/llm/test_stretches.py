import re
from collections import defaultdict
from pathlib import Path
from urllib.parse import urlparse

import pyarrow as pa

from tests.llm.conftest import prose
from trawlnet.llm.paragraphs import _paragraphs, _sets
from trawlnet.llm.stretches import WORDS, all_passages
from trawlnet.llm.words import buffers, shingle_hashes


def spans(text):
    return [(m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", text or "")]


def test_every_repeated_stretch_has_rows_and_one_copy_survives_cutting(spark, odd_rows):
    dotted = ". ".join(prose(3, 70).split())
    inside = prose(4, 70)
    rows = [r[:2] for r in odd_rows] + [(100 + i, f"{prose(200 + i, 9)} {dotted}\n{prose(300 + i, 8)} {inside} é {prose(400 + i, 9)}") for i in range(3)]
    rows.append((110, f"{prose(5, 60)} {prose(6, 30)} {prose(5, 60)}"))
    got = all_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    texts = {d: t for d, t in rows if d not in (40, 41, None)}
    covered, gone = defaultdict(set), defaultdict(set)
    for r in got:
        own = range(r["start"], r["end"])
        if r["doc_id"] in texts:
            assert not covered[r["doc_id"]] & set(own)
        covered[r["doc_id"]].update(own)
        gone[r["doc_id"]].update(own if r["removed"] else ())
    seen = defaultdict(list)
    for d, t in texts.items():
        words = spans(t)
        for i in range(len(words) - WORDS + 1):
            seen[" ".join(t[a:b].lower() for a, b in words[i : i + WORDS])].append((d, words[i : i + WORDS]))
    repeated = [places for places in seen.values() if len(places) > 1]
    assert len(repeated) > 60
    for places in repeated:
        assert all(covered[d].issuperset(range(a, b)) for d, words in places for a, b in words)
        assert any(not gone[d] & set(range(words[0][0], words[-1][1])) for d, words in places)


def test_empty_table(empty):
    assert all_passages(empty).count() == 0


def test_spent_tables_go_and_settings_stay(spark, odd):
    top = Path(urlparse(spark.conf.get("spark.checkpoint.dir")).path)
    before, setting = set(top.glob("*/*")), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(setting)
    got = all_passages(odd)
    left = {p.name.rsplit("-", 1)[0] for p in set(top.glob("*/*")) - before}
    assert left == {"passages", "stretch-pieces"}
    assert spark.conf.get(setting) == was
    assert got.count() == got.count() > 0


def test_sets_hold_each_shingle_once():
    texts = ["a b c d e f g a b c d e f g. a b c d e.", " ".join(["x"] * 40), prose(1, 90), "one two", "a b c d e f g"]
    words, _, _, _, first, to = _paragraphs(*buffers(pa.array(texts)))
    long, values, bounds = _sets(words, first, to, 5)
    every = shingle_hashes(words, 5)
    want = [set(every[a : b - 4].tolist()) for a, b in zip(first[long], to[long], strict=True)]
    assert [sorted(values[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [sorted(w) for w in want]


def test_stretches_of_a_batch_are_those_of_each_text():
    from trawlnet.llm.stretches import _grams, _windows

    whole = prose(1, 90)
    texts = [whole + " " + whole, "", prose(2, 70) + " " + whole, prose(3, 30), whole, None, prose(4, 200)]
    lows = [set(_windows(pa.array([t]))[3][_windows(pa.array([t]))[4]].view("int64").tolist()) for t in texts]
    lists = [sorted(x for x in own if sum(x in other for other in lows) > 1) for own in lows]
    batch = pa.record_batch([pa.array(range(10, 17)), pa.array(texts), pa.array(lists, pa.list_(pa.int64()))], names=["row", "text", "lows"])
    want = []
    for i, text in enumerate(texts):
        words, _, _, low, inside = _windows(pa.array([text]))
        full, seen = shingle_hashes(words, 50).view("int64").tolist(), set()
        for at in range(len(low)):
            if inside[at] and int(low.view("int64")[at]) in lists[i]:
                want.append((10 + i, 2 * at + (full[at] in seen), full[at]))
                seen.add(full[at])
    got = [tuple(r.values()) for b in _grams(iter([batch])) for r in b.to_pylist()]
    assert want and any(spot % 2 for _, spot, _ in want) and sorted(got) == sorted(want)


def test_neither_all_paragraphs_nor_all_stretches_leave_the_workers(spark, monkeypatch):
    """What is not repeated was shuffled with its shingles as soon as the repeated sets were too many to broadcast."""
    from trawlnet.llm import paragraphs, stretches

    tables = {}

    def counted(df, name, write=paragraphs.written):
        out = write(df, name)
        tables[name] = out.count()
        return out

    monkeypatch.setattr(paragraphs, "written", counted)
    monkeypatch.setattr(stretches, "written", counted)
    monkeypatch.setattr(paragraphs, "BROADCAST_ROWS", 0)
    single = [(i, ". ".join(prose(1_000 * i + j, 12) for j in range(40))) for i in range(60)]
    shared = ". ".join(prose(7 + j, 12) for j in range(6))
    rows = single + [(100, single[0][1] + ". " + shared), (101, shared)]
    seen = []
    monkeypatch.setattr(paragraphs, "_shingles", lambda *a, make=paragraphs._shingles: seen.append(a) or make(*a))
    got = all_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), id_col="doc_id")
    assert {r["doc_id"] for r in got.collect()} == {0, 100, 101}
    assert tables["paragraphs"] > 2_000 and tables["buckets"] < 200 and tables["needed-texts"] < 10
    ((_, wanted),) = seen
    assert wanted.value.bits.any()


def test_a_pair_that_the_masks_rule_out_is_not_similar():
    from trawlnet.llm.paragraphs import Repeats, _masks, _sets

    spec = Repeats()
    base = prose(1, 30).split()
    texts = [" ".join(base[:i] + ["other"] * k + base[i + k :]) for i in range(0, 28, 3) for k in (0, 1, 2, 6)] + [prose(i, 25) for i in range(9)]
    words, _, _, _, first, to = _paragraphs(*buffers(pa.array(texts)))
    _, values, bounds = _sets(words, first, to, spec.shingle)
    masks = _masks(values, bounds).view("uint64").tolist()
    sets = [set(values[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    passed = dropped = 0
    for a, m in zip(sets, masks, strict=True):
        for b, o in zip(sets, masks, strict=True):
            most = min(len(a) - (m & ~o).bit_count(), len(b) - (o & ~m).bit_count())
            likely = 180 * most >= 80 * (len(a) + len(b))
            assert likely or 100 * len(a & b) < 80 * len(a | b)
            passed, dropped = passed + likely, dropped + (not likely)
    assert passed and dropped > passed
