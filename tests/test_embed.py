import math

import pytest
from pyspark.sql import functions as F

from trawlnet.operators import embed as E


def frame(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")


def vectors(df):
    return [r["embedding"] for r in df.orderBy("i").collect()]


def test_reply_shapes():
    assert E.unpack_reply([[1.0]], 1) == [[1.0]]
    assert E.unpack_reply({"embeddings": [[1.0], [2.0]]}, 2) == [[1.0], [2.0]]
    assert E.unpack_reply({"embedding": [3.0]}, 1) == [[3.0]]
    with pytest.raises(ValueError):
        E.unpack_reply({}, 1)
    with pytest.raises(ValueError):
        E.unpack_reply({"embedding": [3.0]}, 2)
    with pytest.raises(ValueError):
        E.unpack_reply([[1.0]], 2)


def test_function_embedder_keeps_order(spark):
    df = frame(spark, *[f"t{i}" * (i % 5) for i in range(300)]).repartition(3)
    lengths = E.function_embedder("len1", 1, lambda texts: {"embeddings": [[len(t)] for t in texts]})
    assert [v[0] for v in vectors(lengths.add(df))] == [len(f"t{i}" * (i % 5)) for i in range(300)]
    assert vectors(lengths.add(frame(spark).limit(0))) == []


@pytest.mark.parametrize("reply", [lambda texts: [[0.0, 1.0]] * (len(texts) + 1), lambda texts: [[0.0]] * len(texts), lambda texts: {}])
def test_broken_embedder_fails_the_job(spark, reply):
    with pytest.raises(Exception, match="embedder|reply"):
        vectors(E.function_embedder("bad", 2, reply).add(frame(spark, "a", "b")))


def test_hashing_matches_plain_python(spark):
    texts = ["a b A!", "", "...", None, "é_9 x x"]
    got = vectors(E.DEFAULT.add(frame(spark, *texts)))
    expected_words = [["a", "b", "a"], [], [], [], ["é", "9", "x", "x"]]
    for vector, words in zip(got, expected_words, strict=True):
        counts = [0.0] * 64
        for w in words:
            counts[E.token_bucket(w, 64)] += 1
        norm = math.sqrt(sum(c * c for c in counts))
        assert vector == pytest.approx([c / norm if norm else 0.0 for c in counts], abs=1e-7)


def test_dimension_check(spark):
    df = spark.createDataFrame([([1.0, 2.0],)], "embedding array<float>")
    assert E.check_dimension(df, 2).count() == 1
    with pytest.raises(Exception, match="expected 3 values, got 2"):
        E.check_dimension(df, 3).collect()


def test_registry():
    assert E.resolve() is E.DEFAULT and E.resolve("hash64") is E.DEFAULT
    with pytest.raises(KeyError):
        E.resolve("unknown")
    with pytest.raises(ValueError):
        E.register(E.Embedder("hash64", 3, F.col))


def test_embedding_adds_no_shuffle(spark, tiny, plan):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text")
    assert "Exchange" not in plan(E.DEFAULT.add(docs))
