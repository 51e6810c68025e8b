"""Secret scans over every historical version of a tree, each content once per rule version, in DataFrame functions only."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trawlnet.llm.shared import as_text, digest, exists, spread_join, written

SPANS = "array<struct<start:int,end:int>>"
#: Unseen contents are broadcast by digest up to this many, 40 bytes each; beyond it they are shuffled.
UNSEEN_BROADCAST = 500_000


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of a Java ``pattern``; those count in which ``group`` has ``least`` characters.

    ``hint`` is a cheap pattern that every text with a match contains; other texts are not searched."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    hint: str = ""

    @property
    def version(self) -> str:
        parts = "\0".join(["spans-1", self.kind, self.pattern, str(self.least), str(self.group), self.hint])
        return hashlib.sha256(parts.encode()).hexdigest()

    def pieces(self, text: Column) -> Column:
        """For each match the characters before it since the last one, its own, and whether it counts.

        Cutting a text at its matches gives what lies between them; the last piece has no match behind it.
        """
        cuts = F.arrays_zip(
            F.split(text, self.pattern, -1).alias("gap"),
            F.regexp_extract_all(text, F.lit(self.pattern), F.lit(0)).alias("hit"),
            F.regexp_extract_all(text, F.lit(self.pattern), F.lit(self.group)).alias("part"),
        )
        pieces = F.transform(
            F.filter(cuts, lambda x: x["hit"].isNotNull()),
            lambda x: F.struct(
                F.char_length(x["gap"]).alias("gap"),
                F.char_length(x["hit"]).alias("hit"),
                (F.char_length(x["part"]) >= self.least).alias("counts"),
            ),
        )
        return F.when(text.rlike(self.hint or self.pattern), pieces)


#: The base kinds, in the order in which they are listed. The last two are whole runs of their
#: characters, so asking for their least length in the pattern leaves out the short runs and nothing else.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2, r"(?i:passw|secret|token|api_?key)"),
    Rule("access", r"AKIA[A-Z0-9]{12,}", 16, 0, r"AKIA"),
    Rule("hex", r"[0-9a-f]{32,}", 32, 0, r"[0-9a-f]{32}"),
)
#: Further kinds: key blocks, platform tokens, signed web tokens and passwords in addresses.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", hint=r"PRIVATE KEY-----"),
    Rule("platform_token", r"(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|glpat-[A-Za-z0-9_-]{20,})", hint=r"gh[pousr]_|xox[abprs]-|glpat-"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", hint=r"eyJ"),
    Rule("url_password", r"[a-z][a-z0-9+.-]{1,20}://[^\s:/@]{1,64}:[^\s:/@]{3,128}@", hint=r"://[^\s:/@]{1,64}:"),
)


def _ledger(spark, path: str, rules: tuple[Rule, ...]) -> DataFrame | None:
    """For each known blob the findings by rule version, of these rules only; entries written twice count once."""
    if not exists(spark, path):
        return None
    stored = spark.read.schema(f"blob binary, version string, spans {SPANS}").parquet(path)
    stored = stored.where(F.col("version").isin([r.version for r in rules]))
    return stored.groupBy("blob").agg(F.collect_set(F.struct("version", "spans")).alias("_entries"))


def _spans(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``blob, version, spans`` of the counted matches in ``texts(blob, content, missing)``, begin and end in characters.

    Places are running sums over the matches of one content and rule: a window, so many matches cost no more each.
    """
    due = [
        F.struct(F.lit(r.version).alias("version"), F.when(F.array_contains("missing", r.version), r.pieces(F.col("content"))).alias("pieces"))
        for r in rules
    ]
    rows = texts.select("blob", F.explode(F.filter(F.array(*due), lambda x: F.size(x["pieces"]) > 0)).alias("x"))
    rows = rows.select("blob", "x.version", F.posexplode("x.pieces").alias("at", "p")).select("blob", "version", "at", "p.*")
    so_far = Window.partitionBy("blob", "version").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("hit")).over(so_far).cast("int")).where("counts")
    span = F.struct((F.col("end") - F.col("hit")).alias("start"), F.col("end"))
    return rows.groupBy("blob", "version").agg(F.sort_array(F.collect_list(span)).alias("spans"))


def _of_rule(entries: Column, rank: int, rule: Rule) -> Column:
    """The spans of one rule with its rank and kind, ready to be ordered by start and rank."""
    spans = F.flatten(F.transform(F.filter(entries, lambda e: e["version"] == rule.version), lambda e: e["spans"]))
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rule"), s["end"].alias("end"), F.lit(rule.kind).alias("kind")))


def scan_versions(
    versions: DataFrame,
    ledger: str,
    rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES,
    text_col: str = "text",
) -> DataFrame:
    """The columns of ``versions`` but its text, with ``findings``: an array of ``kind, start, end`` by start.

    ``versions`` has a row for every path and historical version. Contents are addressed by SHA-256; ``ledger`` is a
    Parquet table of ``blob, version, spans``. Only blobs that lack an entry for some rule version are read, once each,
    and only for the missing rules; the findings are appended and joined back to every row with that content.
    Findings at one start come in the order of ``rules``; starts and ends count characters, the end exclusive.

    A null text is empty and has no findings; repeated rows each give a row; an empty table gives no rows. A column
    that bears a name of the result is left out. A job lost on the way leaves the ledger whole; entries that two jobs
    wrote at once are read as one.
    """
    spark = versions.sparkSession
    keep = [c for c in versions.columns if c not in (text_col, "findings", "blob")]
    content = as_text(F.col(text_col))
    keyed = written(versions.select(*keep, digest(content).alias("blob")), "blobs")
    blobs = keyed.select("blob").distinct()
    every = F.array(*[F.lit(r.version) for r in rules])
    known = _ledger(spark, ledger, rules)
    if known is None:
        unseen = blobs.withColumn("missing", every)
    else:
        unseen = blobs.join(known, "blob", "left").select("blob", F.array_except(every, F.coalesce(F.col("_entries.version"), F.array())).alias("missing"))
    unseen = written(unseen.where(F.size("missing") > 0), "unseen")
    n_unseen = unseen.count()
    if n_unseen:
        texts = versions.select(digest(content).alias("blob"), content.alias("content"))
        few = n_unseen <= UNSEEN_BROADCAST
        if known is not None and few:
            texts = texts.join(F.broadcast(unseen.select("blob")), "blob", "left_semi")
        # copies meet inside each task first, so a content that fills the table is one row per task here
        texts = texts.groupBy("blob").agg(F.any_value("content").alias("content"))
        if known is None:
            texts = texts.withColumn("missing", every)
        else:
            texts = texts.join(F.broadcast(unseen) if few else unseen, "blob")
        entries = unseen.select("blob", F.explode("missing").alias("version"))
        entries.join(_spans(texts, rules), ["blob", "version"], "left").write.mode("append").parquet(ledger)
        known = _ledger(spark, ledger, rules)
    if known is None:
        return keyed.select(*keep, F.array().cast("array<struct<kind:string,start:int,end:int>>").alias("findings"))
    # most blobs have no finding: only those with one are joined back
    known = known.select("blob", F.filter("_entries", lambda e: F.size(F.coalesce(e["spans"], F.array().cast(SPANS))) > 0).alias("_entries"))
    known = known.where(F.size("_entries") > 0)
    out = spread_join(keyed, known, "blob")
    ordered = F.array_sort(F.concat(*[_of_rule(F.col("_entries"), i, r) for i, r in enumerate(rules)]))
    findings = F.transform(ordered, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    empty = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return out.select(*keep, F.coalesce(findings, empty).alias("findings"))


def spans_text(findings: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """``kind:start:end`` of the findings, of some kinds only, joined by commas."""
    if kinds is not None:
        findings = F.filter(findings, lambda x: x["kind"].isin(*kinds))
    return F.array_join(F.transform(findings, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def count_kind(findings: Column, kind: str) -> Column:
    return F.size(F.filter(findings, lambda x: x["kind"] == kind)).cast("long")
