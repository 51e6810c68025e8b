"""The registered queries of the training-data operators, over whole tables, and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawlnet.llm.alignment import Alignment, align
from trawlnet.llm.decontaminate import Contamination, contaminated
from trawlnet.llm.licenses import licence_matches
from trawlnet.llm.manifest import Manifest, checked, manifest
from trawlnet.llm.mixing import Mix, mix_sources
from trawlnet.llm.near_dup import NearDup, near_duplicates
from trawlnet.llm.packing import Packing, pack
from trawlnet.llm.paragraphs import Repeats
from trawlnet.llm.quality_cnn import learn, remainder, score
from trawlnet.llm.ring import Ring, assign
from trawlnet.llm.secret_scan import BASE_RULES, count_kind, scan_versions, spans_text
from trawlnet.llm.stretches import all_passages
from trawlnet.llm.token_counts import Tokenizer, count_tokens
from trawlnet.llm.weak_rules import judge
from trawlnet.session import scratch_path, ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register ``fn(spark, folder)`` under its own name, with its DuckDB text when there is one."""

    def add(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, folder)

        QUERIES[fn.__name__] = run
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def store_path(spark: SparkSession, setting: str, name: str) -> str:
    """The folder that a session setting names for a lasting store; a new, empty one where it is unset."""
    return spark.conf.get(setting, None) or scratch_path(spark, name)


@query()
def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    tokenizer = Tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    cache = store_path(spark, "spark.trawlnet.tokenCache", "token-cache")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return count_tokens(docs, tokenizer, cache, limit=512)


@query()
def op2_quality_cnn(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    params = learn(docs, table(spark, folder, "labels").select("doc_id", "quality"))
    scored = score(docs, params)
    held_out = F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query()
def op3_hash_ring_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = assign(table(spark, folder, "documents"), Ring(shards=8, virtual_nodes=128, slack=0.0))
    law, grown = F.lit("rows").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


@query()
def op4_weak_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = judge(table(spark, folder, "documents").select("doc_id", "text"))
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior"]
    return judged.select("doc_id", *columns)


NEAR_DUP_SQL = r"""with recursive words as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents),
sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 2 then [w[1]]
    else list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) end as s from words),
classes as (select list_sort(s) as s, min(doc_id) as id, len(any_value(s)) as n from sets where len(s) > 0 group by all),
items as (select id, n, unnest(s) as x from classes),
shared as (
  select a.id as a, b.id as b, count(*) as shared_n, any_value(a.n) as na, any_value(b.n) as nb
  from items a join items b on a.x = b.x and a.id < b.id and 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n) group by 1, 2),
links as (select a, b from shared where 100 * shared_n >= 80 * (na + nb - shared_n)),
edges as (select a, b from links union select b, a from links),
reach as (select id as node, id as low from classes union select e.b, r.low from reach r join edges e on e.a = r.node),
named as (select node, min(low) as component_id from reach group by 1)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, coalesce(n.component_id, s.doc_id) as component_id,
  s.doc_id = coalesce(n.component_id, s.doc_id) as kept
from sets s left join classes c on c.s = list_sort(s.s) and len(s.s) > 0 left join named n on n.node = c.id"""


@query(NEAR_DUP_SQL)
def op5_minhash_near_dup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return near_duplicates(docs, NearDup(shingle=2, percent=80)).drop("group")


@query()
def op7_temperature_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    mixed = mix_sources(docs, Mix(evenness=0.9, most_copies=4.0, block_tokens=1_000_000))
    return mixed.select("doc_id", "source", "tokens", "copy", "block", "position")


@query()
def op8_secret_ledger(spark: SparkSession, folder: str) -> DataFrame:
    ledger = store_path(spark, "spark.trawlnet.secretLedger", "secret-ledger")
    versions = table(spark, folder, "documents").select("doc_id", "text")
    found = scan_versions(versions, ledger)
    base = tuple(r.kind for r in BASE_RULES)
    findings = F.col("findings")
    return found.select(
        "doc_id",
        *[count_kind(findings, k).alias(f"n_{k}") for k in base],
        F.sha2(spans_text(findings, base), 256).alias("base_sha256"),
        spans_text(findings).alias("spans"),
    )


@query()
def op9_license_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return licence_matches(table(spark, folder, "documents").select("doc_id", "text"))


@query()
def op10_simhash_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return contaminated(docs, table(spark, folder, "benchmark"), Contamination(shingle=5, percent=80))


@query()
def op6_paragraph_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return all_passages(table(spark, folder, "documents").select("doc_id", "text"), Repeats())


def merkle_sql(levels: int = 7, top_levels: int = 5, arity: int = 16) -> str:
    """The digest trees level by level, for up to ``arity ** levels`` rows of a source and ``arity ** top_levels`` sources."""

    def grown(of: str, name: str, keys: str, depth: int) -> list[str]:
        """Level tables ``<name>0..depth`` of nodes and, for all but the last, their siblings to the left and right."""
        out = []
        for i in range(depth):
            last = f"{name}{i}" if i else of
            run = f"partition by {keys}, p // {arity} order by p rows between"
            out.append(
                f"{name}s{i} as (select *, coalesce(string_agg(h, '') over ({run} unbounded preceding and 1 preceding), '') as l, "
                f"coalesce(string_agg(h, '') over ({run} 1 following and unbounded following), '') as r from {last})"
            )
            parent = f"case when any_value(n) = 1 then any_value(h) else sha256(string_agg(h, '' order by p)) end as h"
            out.append(f"{name}{i + 1} as (select {keys}, p // {arity} as p, (any_value(n) + {arity - 1}) // {arity} as n, {parent} from {last} group by {keys}, p // {arity})")
        return out

    def field(c: str) -> str:
        return f"case when {c} is null then '-' else strlen(cast({c} as varchar)) || ':' || cast({c} as varchar) end"

    def joins(name: str, start: str, place: str, depth: int) -> str:
        return " ".join(f"join {name}s{i} {name}t{i} on {start.format(t=f'{name}t{i}')} and {name}t{i}.p = {place} // {arity**i}" for i in range(depth))

    byte = "list_reduce(list_concat([xor(a, b)], range(8)), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)"
    digits = "list_transform(string_split(cast(doc_id as varchar), ''), lambda x: ascii(x))"
    crc = f"xor(list_reduce(list_concat([4294967295], {digits}), lambda a, b: {byte}), 4294967295)"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    row = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    fold, steps = "d.bad", [f"bt{i}" for i in range(levels)] + [f"tt{i}" for i in range(top_levels)]
    for t in steps:
        fold = f"case when {t}.n > 1 then sha256({t}.l || {fold} || {t}.r) else {fold} end"
    proof = " || ".join(f"case when {t}.n > 1 then {t}.l || {t}.r else '' end" for t in steps)
    return f"""with rows as (
  select doc_id, source, sha256({row} || {field('text')}) as leaf,
    sha256({row} || {field(f'(case when {crc} % 5 = 0 then {lowered} else text end)')}) as bad from documents),
placed as (
  select *, leaf as h, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as p, count(*) over (partition by source) as n,
    dense_rank() over (order by source nulls first) - 1 as g from rows),
{', '.join(grown('placed', 'b', 'g', levels))},
sub as (select 0 as z, g as p, h, count(*) over () as n from b{levels}),
{', '.join(grown('sub', 't', 'z', top_levels))},
folds as (
  select d.doc_id, d.leaf, sub.h as subroot, t{top_levels}.h as root, sha256({proof}) as proof_sha256, {fold} as folded_root
  from placed d join sub on sub.p = d.g {joins('b', '{t}.g = d.g', 'd.p', levels)} {joins('t', '{t}.z = 0', 'd.g', top_levels)} cross join t{top_levels})
select *, folded_root = root as verified from folds"""


@query(merkle_sql())
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    decimal = F.crc32(F.col("doc_id").cast("string").cast("binary"))

    def tampered(text):
        upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
        return F.when(decimal % 5 == 0, F.translate(text, upper, lower)).otherwise(text)

    rows = manifest(table(spark, folder, "documents"), Manifest(arity=16), tampered)
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return checked(rows).select(*columns)


@query()
def op13_differencing_packs(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    tokenizer = Tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    return pack(table(spark, folder, "documents").select("doc_id", "text"), tokenizer, Packing(capacity=2048, end_id=1))


@query()
def op12_arrow_alignment(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    a, b = (Tokenizer(public_tokenizers.path(name)) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    rows = align(table(spark, folder, "documents").select("doc_id", "text"), a, b, Alignment(groups="sha256"))
    return rows.withColumnRenamed("groups", "groups_sha256")
