import zlib

import numpy as np
import pytest

from trawlnet.llm.quality_cnn import Shape, Training, chunk_codes, chunk_starts, learn, probabilities, remainder, score, train

SMALL = Training(most_rows=400, epochs=4)


def test_gradients_equal_differences():
    from trawlnet.llm.quality_cnn import _gradients, start

    shape = Shape(embed=3, width=4, stride=2, filters=4, chunk=4, step=2, hidden=3)
    p = {k: v.astype(np.float64) for k, v in start(shape, 1).items()}
    texts = [chunk_codes(np.frombuffer(t, np.uint8), shape) for t in (b"some bytes here", b"", b"x" * 70)]
    labels = np.array([1.0, 0.0, 1.0])

    def loss():
        from trawlnet.llm.quality_cnn import _chunk_units

        out = 0
        for t, y in zip(texts, labels, strict=True):
            z = _chunk_units(t, p, shape)[3].max(axis=0) @ p["out"] + p["out_bias"][0]
            out += np.log1p(np.exp(-z if y else z))
        return out / len(texts)

    got = _gradients(texts, labels, p, shape)
    for k, at in (("out", (1,)), ("out_bias", (0,)), ("dense", (2, 1)), ("dense_bias", (0,)), ("conv", (5, 2)), ("conv_bias", (1,)), ("embed", (ord("x"), 1)), ("embed", (256, 0))):
        p[k][at] += 1e-5
        high = loss()
        p[k][at] -= 2e-5
        low = loss()
        p[k][at] += 1e-5
        assert got[k][at] == pytest.approx((high - low) / 2e-5, abs=1e-4), k


def test_chunks_cover_the_whole_text():
    shape = Shape()
    for n in (0, 1, shape.chunk_bytes - 1, shape.chunk_bytes, shape.chunk_bytes + 1, 5000):
        starts = chunk_starts(n, shape)
        assert starts[0] == 0 and starts[-1] + shape.chunk_bytes >= n
        assert all(b - a < shape.chunk_bytes for a, b in zip(starts, starts[1:], strict=False))


def test_the_end_of_a_long_text_counts_and_pieces_do_not_matter(monkeypatch):
    rng = np.random.default_rng(0)
    texts = [bytes(rng.integers(97, 123, 3000).astype(np.uint8)) for _ in range(40)]
    marked = [t + b" @@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@@" for t in texts]
    p = train(texts[:20] + marked[:20], np.array([1] * 20 + [0] * 20, np.float32), how=Training(epochs=20, batch=8))
    every = texts[20:] + marked[20:]
    raw, places = np.frombuffer(b"".join(every), np.uint8), np.cumsum([0] + [len(t) for t in every])
    got = probabilities(raw, places, p, Shape())
    assert got[:20].min() > got[20:].max()
    monkeypatch.setattr("trawlnet.llm.quality_cnn.GROUP_WINDOWS", 64)
    assert np.allclose(probabilities(raw, places, p, Shape()), got, atol=1e-5)


def test_held_out_labels_are_predicted(spark, tiny):
    folder = tiny.replace("sf0.001", "sf0.1")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    params = learn(docs, labels, how=Training(most_rows=1500, epochs=6))
    rows = score(docs.join(labels, "doc_id"), params).select("doc_id", "quality", "score").collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    good, bad = [r["score"] for r in held if r["quality"] == 1], [r["score"] for r in held if r["quality"] == 0]
    rank = np.mean([[(g > b) + (g == b) / 2 for b in bad] for g in good])
    assert rank > 0.97 and np.mean(np.array(good) >= 0.3) > 0.98


def test_odd_cases(spark, odd, odd_rows):
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)] + [(None, 1), (3, 0), (20, None)], "doc_id long, quality int")
    params = learn(odd, labels, how=SMALL)
    again = learn(odd.repartition(5), labels, how=SMALL)
    assert all((params[k] == again[k]).all() for k in params)
    rows = score(odd, params).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if not r["text"]}) == 1
    assert odd.select(remainder(odd["doc_id"]).alias("r")).where("r is null").count() == 2


def test_no_labels_and_empty_table(spark, empty, odd):
    none = spark.createDataFrame([], "doc_id long, quality int")
    params = learn(odd, none, how=SMALL)
    assert score(empty, params).count() == 0 and score(odd, params).first()["score"] == pytest.approx(0.5, abs=0.5)


def test_training_memory_does_not_follow_the_length_of_a_text():
    import tracemalloc

    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 123, n).astype(np.uint8)) for n in (600_000, 50, 0, 900)]
    tracemalloc.start()
    train(texts, np.array([1, 0, 1, 0], np.float32), how=Training(epochs=1))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # codes, means and units of 9,400 chunks and one group's windows; all windows at once are 230 MB
    assert peak < 40e6


def test_learned_from_whole_texts_of_any_characters(spark):
    rows = [(i, t) for i, t in enumerate(["é" * 90, "\U0001f30a wave " * 30, "plain text " * 40, "", None, "ß\n" * 70] * 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    fold = dict(docs.select("doc_id", remainder(docs["doc_id"])).collect())
    order = docs.selectExpr("doc_id", "xxhash64(5, doc_id) as at").orderBy("at").collect()
    own = [r["doc_id"] for r in order if fold[r["doc_id"]]]
    want = train([(rows[i][1] or "").encode() for i in own], np.array([i % 2 for i in own], np.float32), how=SMALL)
    got = learn(docs, labels, how=SMALL)
    assert all((got[k] == want[k]).all() for k in want)
