import re
from collections import Counter

from pyspark.sql import functions as F

from trawlnet.llm.weak_rules import RULES, judge, learn


def measures(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines, seen, dup = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)], set(), 0
    for line in lines:
        dup += line in seen
        seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
HARD = ["a b c a b c", "a a a a a", "x\nx\nx\n \n \n", "### || <b>\x0b\x0c tab\tend", "🙂 é \x1f x", "a b c d a b", "one two", "p q r p q r p q r s", "l\r\nl\r\nm"]


def check(rows, got):
    want = Counter((d, *measures(t)) for d, t in rows)
    assert Counter((r["doc_id"], *(r[n] for n in NAMES)) for r in got) == want
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"]) and 0 <= r["posterior"] <= 1


def test_measures_equal_brute_force(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()] + [(9000 + i, t) for i, t in enumerate(HARD)]
    check(rows, judge(spark.createDataFrame(rows, "doc_id long, text string")).collect())


def test_odd_cases(odd, odd_rows):
    check([r[:2] for r in odd_rows], judge(odd).collect())


def test_posterior_tells_labelled_texts_apart(spark, tiny):
    folder = tiny.replace("sf0.001", "sf0.1")
    got = judge(spark.read.parquet(f"{folder}/documents.parquet")).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    got = got.where("not base_failed").groupBy("quality", "kept").count().collect()
    n = {(r["quality"], r["kept"]): r["count"] for r in got}
    assert n[1, True] >= 0.995 * (n[1, True] + n.get((1, False), 0))
    assert n.get((0, False), 0) >= 0.9 * (n.get((0, True), 0) + n.get((0, False), 0))


def test_em_on_patterns_equals_plain_python(spark):
    """The same rounds over the texts one by one."""
    import math
    import random

    rng = random.Random(4)
    rules = RULES[:4]
    votes = []
    for _ in range(600):
        good = rng.random() < 0.8
        votes.append([rng.choice([None, None, 1 if rng.random() < (0.99 if good else 0.6) else -1]) for _ in rules])
    df = spark.createDataFrame([tuple(v) for v in votes], ", ".join(f"{r.name} int" for r in rules))
    got = learn(df, rules, rounds=5, close=0.0)
    prior, g, b = 0.8, [0.99] * 4, [0.6] * 4
    for _ in range(5):
        post = []
        for v in votes:
            odds = math.log(prior / (1 - prior))
            for i, x in enumerate(v):
                odds += {1: math.log(g[i] / b[i]), -1: math.log((1 - g[i]) / (1 - b[i])), None: 0}[x]
            post.append(1 / (1 + math.exp(-odds)))
        prior = (sum(post) + 1) / (len(votes) + 2)
        g = [min(max((sum(p for p, v in zip(post, votes, strict=True) if v[i] == 1) + 0.99) / (sum(p for p, v in zip(post, votes, strict=True) if v[i]) + 1), 0.98), 0.9995) for i in range(4)]
        b = [min(max((sum(1 - p for p, v in zip(post, votes, strict=True) if v[i] == 1) + 0.6) / (sum(1 - p for p, v in zip(post, votes, strict=True) if v[i]) + 1), 0.4), 0.95) for i in range(4)]
    assert abs(got.prior - prior) < 1e-9
    assert all(abs(x - y) < 1e-9 for x, y in zip((*got.good, *got.bad), (*g, *b), strict=True))


def test_empty_table(empty):
    got = judge(empty)
    assert got.count() == 0 and {"kept", "posterior", "base_failed"} <= set(got.columns)


def test_plan_has_no_python(documents, plan):
    text = plan(judge(documents).select(F.col("doc_id"), "kept"))
    assert "Python" not in text and "Arrow" not in text
