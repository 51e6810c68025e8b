import numpy as np
import pyarrow as pa
import pytest

from trawlnet.llm import packed
from trawlnet.llm.packed import Marks, dealt, marked, met, part_numbers, parts_of, unpacked
from trawlnet.llm.words import mix


@pytest.mark.parametrize("parts", [1, 8])
def test_values_come_back_part_by_part(parts, monkeypatch):
    monkeypatch.setattr(packed, "HELD_VALUES", 50)
    values = np.arange(400, dtype=np.uint64)
    blocks = [(mix(x), (x, x.astype(np.int32))) for x in np.array_split(values, 20)]
    batches = list(dealt(iter(blocks), parts, ["a", "b"]))
    assert len(batches) > 5
    for i in range(parts):
        own = [b.filter(pa.array(b.column(0).to_numpy() == i)) for b in batches]
        a, b = met(iter(own), {"a": np.uint64, "b": np.int32})
        assert sorted(a.tolist()) == values[part_numbers(mix(values), parts) == i].tolist() and a.tolist() == b.tolist()
    assert met(iter([]), {"a": np.uint64})[0].tolist() == []


def test_slices_of_packed_columns():
    (batch,) = dealt(iter([(mix(np.arange(90, dtype=np.uint64)), (np.arange(90),))]), 4, ["a"])
    assert np.concatenate([unpacked(batch.slice(i, 1).column(1), np.int64) for i in range(4)]).tolist() == unpacked(batch.column(1), np.int64).tolist()


@pytest.mark.parametrize("many, most", [(1, 28), (5_000_000, 28), (5_000_000, 10)])
@pytest.mark.parametrize("least", [1, 2])
def test_marks_have_no_misses_and_few_others(spark, monkeypatch, many, most, least):
    monkeypatch.setattr(packed, "MOST_BITS", most)
    lists = [[i, i + 1_000, i % 50] for i in range(300)] + [None, []]
    df = spark.createDataFrame([(x,) for x in lists], "v array<long>").repartition(4)
    marks = marked(df, lambda c: mix(c.flatten().to_numpy(zero_copy_only=False).astype(np.uint64)), many, least).value
    assert isinstance(marks, Marks) and marks.parts == parts_of(many) and marks.bits.nbytes <= 1 << max(most - 3, 0)
    values = [v for own in lists for v in own or ()]
    want = sorted({v for v in values if values.count(v) >= least})
    assert want and marks.have(mix(np.array(want, np.uint64))).all()
    others = marks.have(mix(np.arange(10_000, 30_000, dtype=np.uint64))).mean()
    assert others < (0.01 if most == 28 else 0.9)


def test_marks_of_nothing(spark):
    marks = marked(spark.createDataFrame([], "v array<long>"), lambda c: c.flatten().to_numpy().view(np.uint64), 0, 2).value
    assert not marks.have(np.arange(5, dtype=np.uint64)).any()
