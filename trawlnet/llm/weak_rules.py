"""Quality rules as weak supervision: rules vote or abstain, EM weighs them, in DataFrame functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawlnet.llm.shared import as_text, written

#: What EM may conclude about a rule, or else it takes one large kind of bad text for the only one. A rule votes bad
#: on at most a 50th of good texts, for rules are written to be specific; and as texts are bad in many ways, a bad
#: one passes any single rule in two cases of five at least.
GOOD_PASS, BAD_PASS = (0.98, 0.9995), (0.4, 0.95)
SPLIT = "[\\x20\\x09-\\x0D]+"
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_distinct_words", "n_capitals", "n_stops", "n_letters",
)


@dataclass(frozen=True)
class Rule:
    """A vote from the measures: bad (-1) first, good (1) next, else none. Both are SQL conditions; null is no vote."""

    name: str
    bad: str
    good: str

    def vote(self) -> Column:
        return F.expr(f"cast(case when {self.bad} then -1 when {self.good} then 1 end as tinyint)").alias(self.name)


#: Votes on shares of words, characters and lines; a share of nothing is null and gives no vote.
RULES = (
    Rule("length", "n_words < 50", "n_words between 80 and 100000"),
    Rule("word_length", "try_divide(word_chars, n_words) not between 2.5 and 14", "try_divide(word_chars, n_words) between 3 and 10"),
    Rule("symbols", "try_divide(n_symbols, n_words) > 0.1", "try_divide(n_symbols, n_words) < 0.01"),
    Rule("symbol_chars", "try_divide(n_symbols, word_chars) > 0.02", "try_divide(n_symbols, word_chars) < 0.002"),
    Rule("letters", "try_divide(n_letters, word_chars) < 0.8", "try_divide(n_letters, word_chars) > 0.9"),
    Rule("lines", "try_divide(n_dup_lines, n_lines) > 0.5", "n_dup_lines = 0 and n_lines > 1"),
    Rule("phrases", "try_divide(n_repeat_words, n_words) > 0.3", "try_divide(n_repeat_words, n_words) < 0.1"),
    Rule("variety", "try_divide(n_distinct_words, n_words) < 0.2", "try_divide(n_distinct_words, n_words) > 0.35"),
    Rule("capitals", "try_divide(n_capitals, word_chars) > 0.3", "try_divide(n_capitals, word_chars) < 0.12"),
    Rule("sentences", "try_divide(n_stops, n_words) < 0.01 and n_words >= 50", "try_divide(n_stops, n_words) between 0.02 and 0.4"),
)


def measured(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` and the measures of each whole text; every step is one pass over the words inside its row."""
    text = as_text(F.col(text_col)).alias("_text")
    rows = docs.select(*keep, text)
    words = F.array_remove(F.split("_text", SPLIT), "")
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    rows = rows.select(
        *keep,
        words.alias("_words"),
        lines.alias("_lines"),
        F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("_text", F.lit("\\p{Lu}")).cast("long").alias("n_capitals"),
        (F.char_length("_text") - F.char_length(F.regexp_replace("_text", "\\p{L}+", ""))).cast("long").alias("n_letters"),
        F.regexp_count("_text", F.lit("[.!?…。！？](?=[\\s\"')\\]]|$)")).cast("long").alias("n_stops"),
    )
    base = [*keep, "n_symbols", "n_capitals", "n_stops", "n_letters"]
    n = F.size("_words")
    # the words of each window of three, hashed; slices of an array are copies, not searches
    windows = F.arrays_zip(
        F.slice("_words", F.lit(1), n - 2).alias("a"), F.slice("_words", F.lit(2), n - 2).alias("b"), F.slice("_words", F.lit(3), n - 2).alias("c")
    )
    hashes = F.transform(windows, lambda x: F.xxhash64(x["a"], x["b"], x["c"]))
    rows = rows.select(
        *base,
        n.cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.size(F.array_distinct("_words")).cast("long").alias("n_distinct_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= 3, hashes).otherwise(F.array().cast("array<bigint>")).alias("_hash"),
    )
    base = [*base, "n_words", "word_chars", "n_distinct_words", "n_lines", "n_dup_lines"]
    # a text whose windows all differ, as most do, is done here
    repeats = F.size(F.array_distinct("_hash")) < F.size("_hash")
    placed = F.arrays_zip("_hash", F.sequence(F.lit(0), F.size("_hash") - 1).alias("_at"))
    rows = rows.select(*base, F.when(repeats, F.sort_array(placed)).alias("_sorted"))
    rows = rows.select(*base, F.col("_sorted"), F.col("_sorted._hash").alias("_keys"))
    last = F.size("_keys") - 1
    none = F.array(F.lit(None).cast("bigint"))
    near = F.arrays_zip(
        F.col("_sorted._at").alias("at"),
        F.col("_keys").alias("key"),
        F.concat(none, F.slice("_keys", F.lit(1), last)).alias("before"),
        F.concat(F.slice("_keys", F.lit(2), last), none).alias("after"),
    )
    twice = F.filter(near, lambda x: (x["key"] == x["before"]) | (x["key"] == x["after"]))
    rows = rows.select(*base, F.when(F.col("_keys").isNotNull(), twice["at"]).alias("_twice"))
    covered = F.array_distinct(F.concat("_twice", F.transform("_twice", lambda i: i + 1), F.transform("_twice", lambda i: i + 2)))
    return rows.select(*keep, *[c for c in MEASURES if c != "n_repeat_words"], F.when(F.col("_twice").isNull(), 0).otherwise(F.size(covered)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Weights:
    """Prior of a good text, and for each rule how often it votes good on good and on bad texts, when it votes."""

    prior: float
    good: tuple[float, ...]
    bad: tuple[float, ...]

    def posterior(self, rules: tuple[Rule, ...]) -> Column:
        """Probability of a good text from its votes; without a vote it is the prior."""
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for rule, g, b in zip(rules, self.good, self.bad, strict=True):
            vote = F.col(rule.name)
            odds = odds + F.when(vote == 1, math.log(g / b)).when(vote == -1, math.log((1 - g) / (1 - b))).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def _within(value: float, bounds: tuple[float, float]) -> float:
    return min(max(value, bounds[0]), bounds[1])


def learn(votes: DataFrame, rules: tuple[Rule, ...], rounds: int = 30, close: float = 1e-4) -> Weights:
    """Expectation-maximisation over the distinct vote patterns (3 to the number of rules at most) and their counts.

    It starts from four good texts in five and the middle of what a rule may be (GOOD_PASS, BAD_PASS). Each round is one
    aggregation: posterior of each pattern, then the sums that give the next weights, smoothed by one text each.
    """
    patterns = votes.groupBy(*[r.name for r in rules]).agg(F.count(F.lit(1)).cast("double").alias("n"))
    patterns = written(patterns.coalesce(1), "vote-patterns")
    now = Weights(0.8, (0.99,) * len(rules), (0.6,) * len(rules))
    for _ in range(rounds):
        p = F.col("p")
        sums = [F.sum(F.col("n") * p).alias("g"), F.sum(F.col("n") * (1 - p)).alias("b")]
        for i, rule in enumerate(rules):
            for side, share in (("g", p), ("b", 1 - p)):
                for vote, name in ((1, "y"), (-1, "n")):
                    sums.append(F.sum(F.when(F.col(rule.name) == vote, F.col("n") * share).otherwise(0.0)).alias(f"{side}{i}{name}"))
        s = patterns.withColumn("p", now.posterior(rules)).agg(*sums).first()
        if s["g"] is None:
            return now
        each = range(len(rules))
        new = Weights(
            (s["g"] + 1) / (s["g"] + s["b"] + 2),
            tuple(_within((s[f"g{i}y"] + 0.99) / (s[f"g{i}y"] + s[f"g{i}n"] + 1), GOOD_PASS) for i in each),
            tuple(_within((s[f"b{i}y"] + 0.6) / (s[f"b{i}y"] + s[f"b{i}n"] + 1), BAD_PASS) for i in each),
        )
        moved = max(abs(a - b) for a, b in zip((now.prior, *now.good, *now.bad), (new.prior, *new.good, *new.bad), strict=True))
        now = new
        if moved < close:
            break
    return now


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """``doc_id``, the measures, the votes, ``base_failed``, ``posterior`` and ``kept`` for every row of ``docs``.

    A text is kept if it passes the base and its posterior quality probability is ``least`` or more; a rule that
    turns out to say little weighs little, and no single rule decides. The weights come from all rows.

    A null text counts as empty: no words, base failed, kept false. Null ids and repeated rows each give a row; other
    columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = measured(rows, ["doc_id"])
    rows = written(rows.select("*", *[r.vote() for r in rules]), "measures")
    weights = learn(rows, rules)
    rows = rows.withColumn("base_failed", base_failed()).withColumn("posterior", weights.posterior(rules))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= least))
