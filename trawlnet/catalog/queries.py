"""Every registered query with its DuckDB counterpart, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trawlnet.catalog.tables import Tables, derived_sql
from trawlnet.functions import keys, text
from trawlnet.operators import chat, chunk, embed, ops, retrieve, runs, search, state
from trawlnet.plans import answer, ingest
from trawlnet.session import cut_lineage, scratch_path, ship_package
from trawlnet.sources import collection
from trawlnet.sources.logs import read_logs
from trawlnet.sources.tree import scan_tree, write_tree

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register ``fn(tables)`` under its own name, with its DuckDB text when there is one."""

    def add(fn: Callable[[Tables], DataFrame]):
        key = name or fn.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship_package(spark)
            return fn(Tables(spark, folder))

        QUERIES[key] = run
        if sql:
            ORACLES[key] = sql
        return fn

    return add


# --- DuckDB building blocks ------------------------------------------------------------------

TOKENS = r"'[^\p{L}\p{N}]+'"


def lines_sql(source: str, keep: str) -> str:
    """Lines of ``text``; the given tables hold no line end but the newline."""
    return f"""select {keep}, case when parts[-1] = '' then parts[:-2] else parts end as lines
  from (select {keep}, string_split(text, chr(10)) as parts from {source})"""


def chunks_sql(source: str, keep: str, size: int) -> str:
    return f"""select * from (
    select {keep}, array_to_string(lines[i + 1 : i + {size}], chr(10)) as text,
      cast(i + 1 as int) as start_line, cast(least(i + {size}, len(lines)) as int) as end_line
    from (select *, unnest(range(0, len(lines), {size})) as i from ({lines_sql(source, keep)}))
  ) where regexp_matches(text, '\\S')"""


def weights_sql(source: str, key: str, column: str = "text") -> str:
    """Hash-embedding weights in long form: key, bucket, w."""
    return f"""select {key}, bucket, cast(cast(n / sqrt(sum(n * n) over (partition by {key})) as float) as double) as w from (
    select {key}, cast('0x' || substr(md5(tok), 1, 8) as bigint) % 64 as bucket, cast(count(*) as double) as n from (
      select {key}, unnest(regexp_split_to_array(lower({column}), {TOKENS})) as tok from {source}
    ) where tok <> '' group by all)"""


def text_knn_sql(k: int, on: str = "true") -> str:
    """CTEs from ``q(qid, text)`` and ``x(id, text)`` to ``hits(qid, id, distance, rank)``."""
    return f"""qw as ({weights_sql("q", "qid")}),
xw as ({weights_sql("x", "id")}),
dots as (select qid, id, sum(qw.w * xw.w) as dot from qw join xw using (bucket) group by all),
qn as (select qid, coalesce(sum(w * w), 0) as n2 from q left join qw using (qid) group by qid),
xn as (select id, coalesce(sum(w * w), 0) as n2 from x left join xw using (id) group by id),
hits as (select * from (
  select *, cast(row_number() over (partition by qid order by distance, id) as int) as rank from (
    select qn.qid, xn.id, round(greatest(qn.n2 + xn.n2 - 2 * coalesce(dot, 0), 0), 6) as distance
    from q join x on {on} join qn on qn.qid = q.qid join xn on xn.id = x.id left join dots on dots.qid = qn.qid and dots.id = xn.id)
) where rank <= {k})"""


def vector_knn_sql(queries: str, k: int, on: str = "true") -> str:
    return f"""select * from (
  select *, cast(row_number() over (partition by query_id order by distance, id) as int) as rank from (
    select q.query_id, x.vec_id as id,
      round(list_sum(list_transform(list_zip(q.v, x.embedding), lambda p: pow(cast(p[1] as double) - cast(p[2] as double), 2))), 6) as distance
    from ({queries}) q join embeddings x on {on})
) where rank <= {k}"""


CENTROIDS = """select label as query_id, list(m order by pos) as v from (
    select label, pos, avg(cast(value as double)) as m
    from (select label, unnest(embedding) as value, unnest(range(len(embedding))) as pos from embeddings)
    group by label, pos) group by label"""
VECTORS = "select vec_id as query_id, label, embedding as v from embeddings"
DOC_CHUNKS = f"""select concat(doc_id, ':', start_line) as id, text from ({chunks_sql("documents", "doc_id", 50)})"""


# --- chunking --------------------------------------------------------------------------------


# Where each document lies in a tree with hidden, private and deep folders; one in five has another extension.
TREE_PATH = """case doc_id % 5 when 0 then concat('_doc_', doc_id, '.py') when 1 then concat('.hidden', doc_id % 3, '/doc_', doc_id, '.md')
  when 2 then concat('deep/', doc_id % 7, '/a/_b/c/doc_', doc_id, '.TS') when 3 then concat('src', doc_id % 11, '/doc_', doc_id, '.txt')
  else concat('src', doc_id % 11, '/', doc_id, '..js') end"""


def _tree(t: Tables) -> str:
    """The documents as files of a new tree in the shared folder."""
    root = scratch_path(t.spark, "tree") + "/docs"
    write_tree(t.spread("documents", "doc_id", "text").selectExpr(f"{TREE_PATH} as name", "cast(coalesce(text, '') as binary) as content"), root)
    return root


def _below(path: str, root: str) -> Column:
    """A path without its root."""
    return F.expr(f"substring_index({path}, '/{root.rsplit('/', 2)[-2]}/docs/', -1)")


@query(f"select {TREE_PATH} as path, coalesce(text, '') as text from documents where doc_id % 5 <> 3")
def tree_scan(t: Tables) -> DataFrame:
    root = _tree(t)
    return scan_tree(t.spark, root).select(_below("path", root).alias("path"), "text")


@query(
    f"""select path, start_line, end_line, text as document, concat('chunk_', row_number() over (order by path, start_line) - 1) as id,
  'code_docs' as collection_id from ({chunks_sql(f"(select {TREE_PATH} as path, text from documents where doc_id % 5 <> 3)", "path", 50)})"""
)
def ingest_tree(t: Tables) -> DataFrame:
    """A tree becomes the collection that its directory names."""
    root, store = _tree(t), collection.open_store(t.spark, scratch_path(t.spark, "tree-store"))
    ingest.ingest_project(t.spark, root, store)
    rows = store.read("code_docs")
    return rows.select(_below("path", root).alias("path"), "start_line", "end_line", "document", "id", "collection_id")


@query(
    """select doc_id, case doc_id % 4 when 0 then text when 1 then concat(text, chr(65533), 'x') when 2 then concat(chr(65533), 'x', text)
  else concat(text, chr(65533), ' ', chr(65533), chr(65533)) end as text from documents"""
)
def decode_text(t: Tables) -> DataFrame:
    """Bytes that are no UTF-8, alone or as cut characters, before and behind whole texts."""
    whole = F.col("text").cast("binary")
    damage = {1: (b"", b"\xffx"), 2: (b"\xe2\x82x", b""), 3: (b"", b"\xf0\x9f\x98 \xc0\xaf")}
    content = whole
    for kind, (before, after) in damage.items():
        content = F.when(F.col("doc_id") % 4 == kind, F.concat(F.lit(before), whole, F.lit(after))).otherwise(content)
    return t("documents").select("doc_id", text.decode_utf8(content).alias("text"))


@query(r"""select page_id, url from pages
where regexp_matches(regexp_extract(url, '^[a-z]+://[^/]*/([^?#]*)', 1), '(?is)^(.*/)?\.*[^./][^/]*\.(html|py|md|ts|js)$')""")
def ext_filter(t: Tables) -> DataFrame:
    path = F.regexp_extract("url", text.URL_PATH, 1)
    return t("pages").select("page_id", "url").where(text.has_extension(text.basename(path), (".html", ".py", ".md", ".ts", ".js")))


@query(f"select doc_id, cast(len(lines) as int) as n_lines from ({lines_sql('documents', 'doc_id')})")
def doc_lines(t: Tables) -> DataFrame:
    return chunk.line_counts(t.spread("documents", "doc_id", "text"), keep=["doc_id"])


@query(chunks_sql("documents", "doc_id", 50))
def chunk_lines_50(t: Tables) -> DataFrame:
    return chunk.chunk_lines(t.spread("documents", "doc_id", "text"), size=50, keep=["doc_id"])


@query(chunks_sql("documents", "doc_id", 10))
def chunk_lines_10(t: Tables) -> DataFrame:
    return chunk.chunk_lines(t.spread("documents", "doc_id", "text"), size=10, keep=["doc_id"])


@query(
    "select doc_id, trim(text, ' ' || chr(9) || chr(10) || chr(13)) as text, cast(null as int) as start_line, "
    r"cast(null as int) as end_line from documents where regexp_matches(text, '\S')"
)
def chunk_whole_doc(t: Tables) -> DataFrame:
    return chunk.chunk_lines(t.spread("documents", "doc_id", "text"), size=-1, keep=["doc_id"])


@query(
    f"""select path, start_line, concat('chunk_', row_number() over (order by path, start_line) - 1) as id from (
  {chunks_sql("(select concat('docs/', doc_id) as path, text from documents)", "path", 50)})"""
)
def chunk_ids(t: Tables) -> DataFrame:
    docs = t.spread("documents", "doc_id", "text").withColumn("path", F.concat(F.lit("docs/"), "doc_id"))
    numbered = keys.with_ordinal(chunk.chunk_lines(docs).select("path", "start_line"), ["path", "start_line"])
    return numbered.select("path", "start_line", keys.chunk_id(F.col("ordinal")).alias("id"))


@query(
    derived_sql("projects")
    + " select project_id, concat('code_', string_split(project_path, '/')[-1]) as collection_id from projects"
)
def collection_names(t: Tables) -> DataFrame:
    return t("projects").select("project_id", keys.collection_name(F.col("project_path")).alias("collection_id"))


@query(
    """select concat('code_', user_id) as collection_id, count(*) as n_paths, min(path) as first_path, max(path) as last_path
from (select distinct user_id, concat('/', event_type, '/', user_id) as path from events) group by user_id having count(*) > 1"""
)
def collection_collisions(t: Tables) -> DataFrame:
    return keys.name_collisions(t("events").select(F.concat(F.lit("/"), "event_type", F.lit("/"), "user_id").alias("project_path")))


@query(
    derived_sql("projects")
    + " select project_id, concat('ingest-', substr(sha256(project_path), 1, 8)) as job_id from projects"
)
def job_keys(t: Tables) -> DataFrame:
    return t("projects").select("project_id", keys.job_key(F.col("project_path")).alias("job_id"))


@query("""select event_id, coalesce(nullif(given, '') is not null, false) as kept,
  cast(case when nullif(given, '') is null then 16 else length(given) end as int) as n_chars, true as well_formed
from (""" + derived_sql("given_ids").replace("with given_ids as (", "", 1)[:-1] + ")")
def request_ids(t: Tables) -> DataFrame:
    # materialised once: the fresh ids are random, and several columns below read them
    ids = cut_lineage(t("given_ids").select("event_id", "given", keys.request_id(F.col("given")).alias("request_id")))
    return ids.select(
        "event_id",
        F.coalesce(F.col("given") == F.col("request_id"), F.lit(False)).alias("kept"),
        F.length("request_id").alias("n_chars"),
        F.col("request_id").rlike("^(r[0-9]+|[0-9a-f]{16})$").alias("well_formed"),
    )


# --- collections -----------------------------------------------------------------------------


def _stored(t: Tables, size: int, kind: str) -> DataFrame:
    docs = t.spread("documents", "doc_id", "source", "text")
    chunks = chunk.chunk_lines(docs, size=size, keep=["doc_id", "source"])
    return chunks.select(
        F.concat(F.lit("code_"), F.coalesce("source", F.lit(""))).alias("collection_id"),
        keys.content_key(F.col("doc_id").cast("string"), F.col("start_line")).alias("id"),
        F.col("text").alias("document"),
        F.lit(kind).alias("batch"),
    )


def _stored_sql(size: int, kind: str) -> str:
    return f"""select concat('code_', coalesce(source, '')) as collection_id, concat(doc_id, ':', start_line) as id, text as document,
  '{kind}' as batch from ({chunks_sql("documents", "doc_id, source", size)})"""


@query(
    f"""with old as ({_stored_sql(50, "old")}), new as ({_stored_sql(10, "new")})
select * from old union all select * from new where (collection_id, id) not in (select (collection_id, id) from old)"""
)
def collection_insert(t: Tables) -> DataFrame:
    return collection.insert_missing(_stored(t, 50, "old"), _stored(t, 10, "new"))


@query(
    f"""with old as ({_stored_sql(50, "old")}), new as ({_stored_sql(10, "new")})
select * from new union all select * from old where (collection_id, id) not in (select (collection_id, id) from new)"""
)
def collection_upsert(t: Tables) -> DataFrame:
    return collection.upsert(_stored(t, 50, "old"), _stored(t, 10, "new"))


@query(
    f"""with v as (select *, 1 as version from ({_stored_sql(50, "old")}) union all select *, 2 from ({_stored_sql(10, "new")}))
select collection_id, id, arg_max(document, version) as document from v group by collection_id, id"""
)
def collection_versions(t: Tables) -> DataFrame:
    """Two versions of an id in one write: the newer one is stored."""
    store = collection.open_store(t.spark, scratch_path(t.spark, "versions"))
    old, new = _stored(t, 50, "old").withColumn("version", F.lit(1)), _stored(t, 10, "new").withColumn("version", F.lit(2))
    store.upsert(new.unionByName(old).drop("batch"), newest_by="version")
    return store.read().select("collection_id", "id", "document")


# --- embedding -------------------------------------------------------------------------------


@query(
    f"""select id, cast(length(text) as float) as chars, cast(length(text) - length(replace(text, ' ', '')) as float) as spaces
from ({DOC_CHUNKS})"""
)
def embed_chunks(t: Tables) -> DataFrame:
    shape = embed.function_embedder("shape2", 2, lambda texts: [[float(len(x)), float(x.count(" "))] for x in texts])
    return shape.add(_doc_chunks(t)).select(
        "id", F.get("embedding", 0).alias("chars"), F.get("embedding", 1).alias("spaces")
    )


@query(f"select doc_id, cast(bucket as int) as bucket, round(w, 6) as weight from ({weights_sql('documents', 'doc_id')})")
def hash_embed(t: Tables) -> DataFrame:
    vectors = embed.resolve("hash64").add(t.spread("documents", "doc_id", "text"))
    return embed.bucket_weights(vectors, "doc_id")


# --- retrieval -------------------------------------------------------------------------------


def _doc_chunks(t: Tables, hits: DataFrame | None = None) -> DataFrame:
    """``id, text`` of all document chunks, or of those documents only that some hit is in."""
    docs = t.spread("documents", "doc_id", "text")
    if hits is not None:
        found = F.substring_index("id", ":", 1).cast(docs.schema["doc_id"].dataType)
        docs = docs.join(hits.select(found.alias("doc_id")).distinct(), "doc_id", "left_semi")
    chunks = chunk.chunk_lines(docs, keep=["doc_id"])
    return chunks.select(keys.content_key(F.col("doc_id").cast("string"), F.col("start_line")).alias("id"), "text")


def _items(t: Tables) -> DataFrame:
    return t("embeddings").withColumnRenamed("vec_id", "id")


def _vectors(t: Tables) -> DataFrame:
    return t("embeddings").withColumnRenamed("vec_id", "query_id")


def _centroids(t: Tables) -> DataFrame:
    """One query vector per label: the mean of its embeddings."""
    mean = F.array(*[F.avg(F.get("embedding", i).cast("double")) for i in range(embed.HASH_DIM)])
    return t("embeddings").groupBy(F.col("label").alias("query_id")).agg(mean.alias("embedding"))


@query(vector_knn_sql(CENTROIDS, 5))
def knn_top5(t: Tables) -> DataFrame:
    return retrieve.knn(_centroids(t), _items(t), 5)


@query(vector_knn_sql(CENTROIDS, 20))
def knn_top20(t: Tables) -> DataFrame:
    return retrieve.knn(_centroids(t), _items(t), 20)


@query(vector_knn_sql(VECTORS, 5))
def knn_multi(t: Tables) -> DataFrame:
    return retrieve.knn(_vectors(t), _items(t), 5)


@query(vector_knn_sql(VECTORS, 5, on="q.label = x.label"))
def knn_by_collection(t: Tables) -> DataFrame:
    return retrieve.knn(_vectors(t), _items(t), 5, scope="label").drop("label")


@query(vector_knn_sql(VECTORS, 5))
def knn_multi_large(t: Tables) -> DataFrame:
    """The way of a query set above the bound: several blocks."""
    return retrieve.knn(_vectors(t), _items(t), 5, broadcast_rows=200)


@query(vector_knn_sql(VECTORS, 5, on="q.label = x.label"))
def knn_scoped_large(t: Tables) -> DataFrame:
    return retrieve.knn(_vectors(t), _items(t), 5, scope="label", broadcast_rows=200).drop("label")


@query(
    f"""select query_id, cast(count(*) as int) as n_hits, string_agg(concat(rank, ':', id), ',' order by rank) as hits
from ({vector_knn_sql(CENTROIDS, 5)}) group by query_id"""
)
def knn_nested(t: Tables) -> DataFrame:
    hits = retrieve.knn(_centroids(t), _items(t), 5)
    nested = retrieve.nest_hits(hits, fields=("rank", "id", "distance"))
    line = F.transform("hits", lambda h: F.concat_ws(":", h["rank"], h["id"]))
    return nested.select("query_id", F.size("hits").alias("n_hits"), F.array_join(line, ",").alias("hits"))


@query()
def knn_lsh(t: Tables) -> DataFrame:
    return retrieve.knn_approximate(_vectors(t), _items(t), 5)


def _benchmark_hits(t: Tables) -> DataFrame:
    queries = t("benchmark").select(F.col("item_id").alias("query_id"), "text")
    return answer.search_chunks(queries, _doc_chunks(t), 5, document="text")


BENCHMARK_HITS = f"with q as (select item_id as qid, text from benchmark), x as ({DOC_CHUNKS}),\n{text_knn_sql(5)}\n"


@query(BENCHMARK_HITS + "select qid as query_id, rank, id, distance from hits")
def rag_search(t: Tables) -> DataFrame:
    return _benchmark_hits(t).select("query_id", "rank", "id", "distance")


def _with_documents(t: Tables, hits: DataFrame) -> DataFrame:
    hits = cut_lineage(hits)
    return retrieve.fetch(hits, _doc_chunks(t, hits).withColumnRenamed("text", "document"), "id")


@query(
    BENCHMARK_HITS
    + r"""select q.qid as query_id, coalesce(string_agg(x.text, chr(10) || chr(10) || '---' || chr(10) || chr(10) order by rank),
  'No results found.') as context
from q left join hits on hits.qid = q.qid left join x on x.id = hits.id group by q.qid"""
)
def rag_format(t: Tables) -> DataFrame:
    queries = t("benchmark").select(F.col("item_id").alias("query_id"))
    return retrieve.context_per_query(queries, _with_documents(t, _benchmark_hits(t)))


def _turn_requests(t: Tables) -> DataFrame:
    return t("chat_requests").select(F.concat_ws("-", "conv_id", "turn").alias("query_id"), "message")


def _turn_hits(t: Tables) -> DataFrame:
    return answer.search_chunks(_turn_requests(t), _doc_chunks(t), 5, query_text="message", document="text")


TURN_HITS = (
    derived_sql("chat_requests")
    + f""", q as (select concat(conv_id, '-', turn) as qid, message as text from chat_requests), x as ({DOC_CHUNKS}),
{text_knn_sql(5)}
"""
)


@query(
    TURN_HITS
    + """select qid as query_id, 'index' as origin, 1 as priority, rank, x.text as document from hits join x using (id)
union all select concat(conv_id, '-', turn - 1), 'attachment', 0, 1, text from conversations where role = 'assistant'"""
)
def hybrid_context(t: Tables) -> DataFrame:
    """Every user turn asks; the reply that followed it is what was attached."""
    hits = _with_documents(t, _turn_hits(t)).select("query_id", "rank", "document")
    attachments = t("conversations").where(F.col("role") == "assistant").select(
        F.concat_ws("-", "conv_id", F.col("turn") - 1).alias("query_id"), F.lit(1).alias("rank"), F.col("text").alias("document")
    )
    return retrieve.with_attachments(hits, attachments)


INGESTED = f"""with q as (select item_id as qid, text from benchmark),
c as (select path, start_line, end_line, text, concat('chunk_', row_number() over (order by path, start_line) - 1) as id from (
  {chunks_sql("(select concat('docs/', doc_id) as path, text from documents)", "path", 50)})),
x as (select id, text from c),
{text_knn_sql(5)}
"""


def _ingested(t: Tables):
    """Documents as one collection with ordinal ids, and the benchmark texts as its queries."""
    store = collection.open_store(t.spark, scratch_path(t.spark, "ingested"))
    texts = t.spread("documents", "doc_id", "text").select(F.concat(F.lit("docs/"), "doc_id").alias("path"), "text")
    ingest.ingest_texts(texts, "code_docs", store, unique_paths=True)
    return store, t("benchmark").select(F.col("item_id").alias("query_id"), "text")


@query(
    INGESTED
    + """select qid as query_id, rank, hits.id, path, start_line, end_line, distance, c.text as document from hits join c on c.id = hits.id"""
)
def ingest_pipeline(t: Tables) -> DataFrame:
    """Chunk, number, embed, store, and query what was stored."""
    store, queries = _ingested(t)
    hits = answer.query_collection(store, "code_docs", queries, 5)
    return hits.select("query_id", "rank", "id", "path", "start_line", "end_line", "distance", "document")


@query(
    INGESTED
    + r"""select q.qid as query_id, any_value(q.text) as text, coalesce(string_agg(c.text, chr(10) || chr(10) || '---' || chr(10) || chr(10) order by rank),
  'No results found.') as context
from q left join hits on hits.qid = q.qid left join c on c.id = hits.id group by q.qid"""
)
def rag_contexts(t: Tables) -> DataFrame:
    store, queries = _ingested(t)
    return answer.rag_contexts(store, "code_docs", queries)


STORED_CHUNKS = f"""select concat('code_', lang) as c, concat(doc_id, ':', start_line) as id, text, start_line, end_line
  from ({chunks_sql("documents", "doc_id, lang", 50)})"""


def _chunk_rows(t: Tables, size: int) -> DataFrame:
    """Document chunks as collection rows, one collection per language."""
    chunks = chunk.chunk_lines(t.spread("documents", "doc_id", "lang", "text"), size=size, keep=["doc_id", "lang"])
    return chunks.select(
        F.concat(F.lit("code_"), "lang").alias("collection_id"),
        keys.content_key(F.col("doc_id").cast("string"), F.col("start_line")).alias("id"),
        F.col("text").alias("document"),
        F.col("doc_id").cast("string").alias("path"),
        "start_line",
        "end_line",
    )


@query(
    derived_sql("chat_requests")
    + f""", q as (select concat(conv_id, '-', turn) as qid, message as text,
  case conv_id % 4 when 0 then 'code_en' when 1 then 'code_fr' when 2 then 'code_de' else 'code_es' end as c from chat_requests),
x as ({STORED_CHUNKS}),
{text_knn_sql(5, on="q.c = x.c")}
select qid as query_id, x.c as collection_id, rank, id, start_line, end_line, distance, x.text as document from hits join x using (id)"""
)
def rag_by_collection(t: Tables) -> DataFrame:
    """Embed, store, and answer queries that each name a collection, from the stored files."""
    store = collection.open_store(t.spark, scratch_path(t.spark, "collections"))
    store.insert_missing(ingest.embed_chunks(_chunk_rows(t, 50), text_col="document"), unique=True)
    asked = (
        F.when(F.col("conv_id") % 4 == 0, "code_en")
        .when(F.col("conv_id") % 4 == 1, "code_fr")
        .when(F.col("conv_id") % 4 == 2, "code_de")
        .otherwise("code_es")
    )
    queries = t("chat_requests").select(
        F.concat_ws("-", "conv_id", "turn").alias("query_id"), F.col("message").alias("text"), asked.alias("collection_id")
    )
    hits = answer.query_collections(store, queries, 5)
    return hits.select("query_id", "collection_id", "rank", "id", "start_line", "end_line", "distance", "document")


@query(
    f"""with old as ({STORED_CHUNKS}), new as (select concat('code_', lang) as c, concat(doc_id, ':', start_line) as id, text, start_line, end_line
  from ({chunks_sql("documents", "doc_id, lang", 10)}))
select c as collection_id, id, text as document, start_line, end_line from new
union all select c, id, text, start_line, end_line from old where (c, id) not in (select (c, id) from new)"""
)
def collection_store(t: Tables) -> DataFrame:
    """Two writes to a collection folder, a repeated one and an upsert, then what a reader sees."""
    store = collection.open_store(t.spark, scratch_path(t.spark, "collections"))
    store.insert_missing(_chunk_rows(t, 50))
    store.insert_missing(_chunk_rows(t, 50))
    store.upsert(_chunk_rows(t, 10))
    return store.read().select("collection_id", "id", "document", "start_line", "end_line")


# --- search ----------------------------------------------------------------------------------

PAYLOADS = derived_sql("search_hits") + """,
lines_a as (select query_id, string_agg(concat('- ', coalesce(title, ''), ': ', coalesce(link, ''), chr(10), '  ', coalesce(snippet, '')),
    chr(10) order by page_id) as a from search_hits group by query_id),
lines_b as (select query_id, string_agg(concat('- ', coalesce(title, ''), ': ', coalesce(link, ''), chr(10), '  ', coalesce(snippet, '')),
    chr(10) order by page_id) as b
  from (select *, row_number() over (partition by query_id order by page_id) as n from search_hits) where n <= 5 group by query_id),
texts as (select query_id,
    case when query_id % 4 <> 0 then a when query_id % 8 = 0 then concat('answer ', query_id) else 'No results found.' end as text_a,
    case when query_id % 6 <> 0 then b else 'No results found.' end as text_b
  from lines_a join lines_b using (query_id))
"""


def _payloads(t: Tables) -> DataFrame:
    """Stored responses of both providers per query: up to seven hits, some empty, some with an answer only."""

    def packed(title: str, link: str, body: str) -> Column:
        renamed = F.struct("page_id", F.col("title").alias(title), F.col("link").alias(link), F.col("snippet").alias(body))
        return F.transform(F.array_sort(F.collect_list(renamed)), lambda h: h.dropFields("page_id"))

    both = t("search_hits").groupBy("query_id").agg(
        packed("title", "url", "content").alias("results"), packed("title", "link", "snippet").alias("organic")
    )
    found_a, answered = F.col("query_id") % 4 != 0, F.col("query_id") % 8 == 0
    return both.select(
        "query_id",
        F.to_json(
            F.struct(
                F.when(found_a, F.col("results")).alias("results"),
                F.when(answered, F.concat(F.lit("answer "), "query_id")).alias("answer"),
            )
        ).alias("payload_a"),
        F.to_json(F.struct(F.when(F.col("query_id") % 6 != 0, F.col("organic")).alias("organic"))).alias("payload_b"),
    )


@query(PAYLOADS + "select query_id, text_a as result from texts")
def search_format_a(t: Tables) -> DataFrame:
    return _payloads(t).select("query_id", search.format_response_a(F.col("payload_a")).alias("result"))


@query(PAYLOADS + "select query_id, text_b as result from texts")
def search_format_b(t: Tables) -> DataFrame:
    return _payloads(t).select("query_id", search.format_response_b(F.col("payload_b")).alias("result"))


@query(
    PAYLOADS
    + """select query_id, case query_id % 5 when 0 then text_a when 1 then 'Tavily search failed: timed out' when 2 then text_b
  when 3 then 'Serper search failed: timed out'
  else 'Search result (no API key configured). Use TAVILY_API_KEY or SERPER_API_KEY for live search.' end as result from texts"""
)
def search_dispatch(t: Tables) -> DataFrame:
    case = F.col("query_id") % 5
    return _payloads(t).select(
        "query_id",
        search.search_text(
            F.when(case == 0, F.col("payload_a")),
            F.when(case == 1, F.lit("timed out")),
            F.when(case.isin(0, 1, 2), F.col("payload_b")),
            F.when(case == 3, F.lit("timed out")),
        ).alias("result"),
    )


PAGE_SEARCH = (
    f"""with words as (select page_id, unnest(regexp_split_to_array(lower(regexp_replace(html, '(?s)<[^>]*>', ' ', 'g')), {TOKENS})) as w from pages),
tf as (select page_id, w, count(*) as tf from words where w <> '' group by all),
idf as (select w, ln((select count(*) from pages) / count(*)) as idf from tf group by w),
q as (select distinct item_id as query_id, unnest(regexp_split_to_array(lower(text), {TOKENS})) as w from benchmark),
scores as (select query_id, page_id, round(sum(tf * idf), 6) as score from q join tf using (w) join idf using (w) group by all)
select s.query_id, s.page_id, score, rank, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) as title, url from (
  select *, cast(row_number() over (partition by query_id order by score desc, page_id) as int) as rank from scores where score > 0
) s join pages using (page_id) where rank <= 5"""
)


def _page_hits(t: Tables, **options) -> DataFrame:
    queries = t("benchmark").select(F.col("item_id").alias("query_id"), "text")
    hits = search.search_pages(t.spread("pages", "page_id", "html"), queries, 5, **options)
    found = retrieve.fetch(hits, t("pages"), "page_id")
    return found.select("query_id", "page_id", "score", "rank", search.page_title(F.col("html")).alias("title"), "url")


@query(PAGE_SEARCH)
def page_search(t: Tables) -> DataFrame:
    return _page_hits(t)


@query(PAGE_SEARCH)
def page_search_indexed(t: Tables) -> DataFrame:
    """The way of more queries than are sent to the pages: postings of the words asked, in an index built once."""
    return _page_hits(t, max_queries=10)


# --- chat ------------------------------------------------------------------------------------


@query(
    derived_sql("chat_requests")
    + """ select conv_id, turn, message, case when turn % 4 = 0 then concat('/workspace/c', conv_id) end as project_path,
  case when conv_id % 3 = 0 then 'owner/repo' end as pinned_repo,
  case when conv_id % 5 = 0 then concat('["note ', turn, '"]') end as attachments,
  cast(1 + (turn % 4 = 0)::int + (conv_id % 3 = 0)::int + (conv_id % 5 = 0)::int as int) as n_keys from chat_requests"""
)
def chat_inputs(t: Tables) -> DataFrame:
    note = F.when(F.col("conv_id") % 5 == 0, F.array(F.concat_ws(" ", F.lit("note"), "turn")))
    requests = t("chat_requests").withColumn("attachments", note)
    record = requests.select("conv_id", "turn", chat.inputs_record().alias("record"))
    return record.select(
        "conv_id",
        "turn",
        *[F.get_json_object("record", f"$.{k}").alias(k) for k in ("message", "project_path", "pinned_repo", "attachments")],
        F.size(F.json_object_keys("record")).alias("n_keys"),
    )


@query(
    derived_sql("chat_requests")
    + """ select conv_id, turn, ordinal, task, replace(template, '{message}', message) as prompt from chat_requests, (values
  (1, 'research', 'Research the topic or question: {message}. Use your search tool and summarize findings.'),
  (2, 'code', 'Based on the request ''{message}'', suggest or explain relevant code.'),
  (3, 'run', 'Run tests (using your run tool) and report whether they passed.')) tasks(ordinal, task, template)"""
)
def task_prompts(t: Tables) -> DataFrame:
    return chat.prompts(t("chat_requests"), keep=["conv_id", "turn"])


@query(
    derived_sql("task_outputs")
    + """ select r.request_id, tasks.task, cast(count(o.task) as int) as n_outputs,
  coalesce(string_agg(o.output, '|' order by o.turn), '') as context
from (select distinct request_id from task_outputs) r cross join (values ('research', 0), ('code', 1), ('run', 2)) tasks(task, n)
left join task_outputs o on o.request_id = r.request_id and o.turn % 3 < tasks.n group by r.request_id, tasks.task"""
)
def task_context(t: Tables) -> DataFrame:
    contexts = chat.task_contexts(t("task_outputs"))
    return contexts.select(
        "request_id", "task", F.size("context").alias("n_outputs"), F.array_join("context", "|").alias("context")
    )


@query(
    derived_sql("chat_outputs")
    + " select conv_id, turn, coalesce(nullif(raw, ''), final_output, '') as response, source as sources from chat_outputs"
)
def chat_response(t: Tables) -> DataFrame:
    listed = F.array_compact(F.array("source"))
    return t("chat_outputs").select(
        "conv_id",
        "turn",
        chat.response(F.col("raw"), F.col("final_output")).alias("response"),
        F.array_join(chat.sources_if_any(listed), ",").alias("sources"),
    )


@query(
    derived_sql("task_outputs")
    + """ select request_id, cast(count(step) as int) as n_steps, coalesce(string_agg(step, '|' order by turn), '') as steps
from (select request_id, turn, substr(coalesce(nullif(name, ''), description), 1, 200) as step from task_outputs) group by request_id"""
)
def step_names(t: Tables) -> DataFrame:
    tasks = F.array_sort(F.collect_list(F.struct("turn", "name", "description")))  # at most three per request
    steps = t("task_outputs").groupBy("request_id").agg(tasks.alias("tasks"))
    steps = steps.select("request_id", chat.step_names(F.col("tasks")).alias("steps"))
    return steps.select("request_id", F.size("steps").alias("n_steps"), F.array_join("steps", "|").alias("steps"))


@query(
    TURN_HITS
    + r"""select q.qid as query_id, any_value(replace('Based on the request ''{message}'', suggest or explain relevant code.', '{message}', q.text)) as code_prompt,
  coalesce(string_agg(x.text, chr(10) || chr(10) || '---' || chr(10) || chr(10) order by rank), 'No results found.') as context
from q left join hits on hits.qid = q.qid left join x on x.id = hits.id group by q.qid"""
)
def batch_rag_prompts(t: Tables) -> DataFrame:
    requests = _turn_requests(t)
    contexts = retrieve.context_per_query(requests.select("query_id"), _with_documents(t, _turn_hits(t)))
    prompts = answer.rag_prompts(requests, contexts)
    return prompts.select("query_id", F.get("prompts", 1)["prompt"].alias("code_prompt"), "context")


# --- runs ------------------------------------------------------------------------------------


def _requests(t: Tables) -> DataFrame:
    words = F.when(F.col("command_text") == "", F.array().cast("array<string>")).otherwise(F.split("command_text", " "))
    return t("run_requests").withColumn("command", words)


@query(
    derived_sql("run_requests")
    + r""" select request_id, error, case when error is not null then 'invalid_input' end as code from (
  select request_id, case when coalesce(command_text, '') = '' then 'command cannot be empty'
    when not regexp_matches(lower(string_split(string_split(command_text, ' ')[1], '/')[-1]), '^(pytest|npm|cargo|go|python|node)')
    then 'command executable not in allowlist' end as error from run_requests)"""
)
def command_audit(t: Tables) -> DataFrame:
    error = runs.command_error(F.col("command"))
    return _requests(t).select("request_id", error.alias("error"), runs.code_for(error).alias("code"))


def resolved_sql(path: str) -> str:
    """Lexical resolution: a fold over the components."""
    return f"""concat('/', array_to_string(list_reduce(list_prepend(cast([] as varchar[]),
    list_transform(list_filter(string_split({path}, '/'), lambda p: p <> '' and p <> '.'), lambda p: [p])),
    lambda acc, p: case when p[1] = '..' then acc[:len(acc) - 1] else list_concat(acc, p) end), '/'))"""


@query(
    derived_sql("run_requests")
    + f""" select request_id, resolved, case when resolved <> '/tmp' and not starts_with(resolved, '/tmp/')
  then 'project_path must be under ALLOWED_ROOT' end as error
from (select request_id, {resolved_sql('project_path')} as resolved from run_requests)"""
)
def path_audit(t: Tables) -> DataFrame:
    path = F.col("project_path")
    return t("run_requests").select(
        "request_id", runs.resolve_path(path).alias("resolved"), runs.path_error(path, "/tmp").alias("error")
    )


@query(
    derived_sql("run_requests")
    + f""" select request_id, coalesce(command_text, 'pytest') as command, workdir,
  cast(coalesce(timeout_seconds, 300) as int) as timeout_seconds, resolved <> '/tmp' and not starts_with(resolved, '/tmp/') as workdir_outside_root
from (select *, coalesce(cwd, project_path) as workdir, {resolved_sql('coalesce(cwd, project_path)')} as resolved from run_requests)
where coalesce(timeout_seconds, 300) >= 1"""
)
def run_defaults(t: Tables) -> DataFrame:
    out = runs.with_run_defaults(_requests(t), "/tmp")
    return out.select("request_id", F.array_join("command", " ").alias("command"), "workdir", "timeout_seconds", "workdir_outside_root")


SPACE = "' ' || chr(9) || chr(10) || chr(13)"


@query(
    derived_sql("run_results")
    + f""" select request_id, exit_code = 0 as success, coalesce(nullif(trim(stdout, {SPACE}), ''),
  case when exit_code = 0 then 'Tests passed' else concat('Exit code ', exit_code) end) as summary from run_results"""
)
def run_summary(t: Tables) -> DataFrame:
    code = F.col("exit_code")
    return t("run_results").select(
        "request_id", (code == 0).alias("success"), runs.api_summary(code, F.col("stdout")).alias("summary")
    )


@query(
    derived_sql("run_results")
    + f""" select request_id, case when exit_code = 0
  then concat('Exit code: 0. ', coalesce(nullif(trim(stdout, {SPACE}), ''), 'Tests passed.'), ' (duration: ', round(duration_raw, 3), 's)')
  else concat('Exit code: ', exit_code, '. stderr: ', coalesce(nullif(trim(stderr, {SPACE}), ''), nullif(trim(stdout, {SPACE}), ''), 'No output'),
    ' (duration: ', round(duration_raw, 3), 's)') end as summary from run_results"""
)
def run_tool_summary(t: Tables) -> DataFrame:
    duration = F.round("duration_raw", 3)
    return t("run_results").select(
        "request_id",
        runs.tool_summary(F.col("exit_code"), F.col("stdout"), F.col("stderr"), duration).alias("summary"),
    )


@query(
    derived_sql("run_results")
    + """ select request_id, case when timed_out then -1 else exit_code end as exit_code, stdout,
  case when timed_out then concat(stderr, ' (timeout)') else stderr end as stderr, round(duration_raw, 3) as duration_seconds from run_results"""
)
def run_timeouts(t: Tables) -> DataFrame:
    return runs.with_timeouts(t("run_results")).select("request_id", "exit_code", "stdout", "stderr", "duration_seconds")


@query(
    derived_sql("attempts")
    + """, used as (select *, outcome not in ('connect', 'timeout') and not starts_with(outcome, 'http_5') as settled from attempts where attempt <= 3),
final as (select request_id, coalesce(min(case when settled then attempt end), max(attempt)) as attempt from used group by request_id)
select request_id, attempt as attempts, outcome as final_outcome, case when outcome <> 'ok' then 'runner_unavailable' end as error
from final join used using (request_id, attempt)"""
)
def attempt_rollup(t: Tables) -> DataFrame:
    return runs.attempt_rollup(t("attempts"))


# --- index state -----------------------------------------------------------------------------

STATUS = """case when j.project_path is null then 'idle' when coalesce(succeeded, 0) >= 1 then 'ready'
  when coalesce(failed, 0) >= 1 then 'failed' else 'indexing' end"""
JOB_ID = "concat('ingest-', substr(sha256(p.project_path), 1, 8))"


@query(
    derived_sql("projects", "jobs")
    + f""" select p.project_id, {JOB_ID} as job_id, {STATUS} as index_status
from projects p left join jobs j on p.project_path = j.project_path"""
)
def index_status(t: Tables) -> DataFrame:
    return state.index_status(t("projects"), t("jobs")).select("project_id", "job_id", "index_status")


@query(
    derived_sql("projects", "jobs")
    + f""" select p.project_id, {JOB_ID} as job_id,
  case when j.project_path is null then 'create' when coalesce(active, 0) > 0 then 'conflict' else 'reuse' end as action
from projects p left join jobs j on p.project_path = j.project_path"""
)
def ingest_plan(t: Tables) -> DataFrame:
    return state.ingest_plan(t("projects"), t("jobs")).select("project_id", "job_id", "action")


@query(
    derived_sql("projects", "jobs")
    + f""" select p.project_path, {JOB_ID} as job_id from projects p where p.project_path not in (select project_path from jobs)"""
)
def ingest_todo(t: Tables) -> DataFrame:
    return state.ingest_todo(t("projects"), t("jobs")).select("project_path", "job_id")


@query(
    derived_sql("projects", "jobs")
    + f""" select p.project_id, old_status, case when old_status = 'indexing' then
  coalesce(case when p.project_id % 7 <> 0 then {STATUS} end, old_status) else old_status end as index_status
from projects p left join jobs j on p.project_path = j.project_path"""
)
def status_refresh(t: Tables) -> DataFrame:
    looked_up = state.index_status(t("projects"), t("jobs"))
    failed_lookup = F.col("project_id") % 7 == 0
    rows = looked_up.withColumn("new_status", F.when(~failed_lookup, F.col("index_status")))
    return state.refresh_status(rows).select("project_id", "old_status", "index_status")


# --- operations ------------------------------------------------------------------------------

PROBES = derived_sql("probes") + """,
rolled as (select target, check_name, case when check_name <> 'runner' and max(url) = '' then 'not_configured'
    when bool_or(status = 'ok') then 'ok' else arg_max(status, attempt) end as status
  from probes where attempt <= 3 group by target, check_name)
"""


@query(PROBES + "select * from rolled")
def probe_rollup(t: Tables) -> DataFrame:
    return ops.probe_rollup(t("probes"))


@query(
    PROBES
    + """, wide as (select target, max(case when check_name = 'runner' then status end) as runner,
    max(case when check_name = 'store' then status end) as store, max(case when check_name = 'llm' then status end) as llm from rolled group by target),
judged as (select *, coalesce(runner = 'ok' and store = 'ok' and llm = 'ok', false) as ready from wide)
select target, ready, runner, store, llm, case when ready then 200 else 503 end as status_code from judged"""
)
def readiness(t: Tables) -> DataFrame:
    return ops.readiness(ops.probe_rollup(t("probes")))


@query(
    derived_sql("http_requests")
    + """ select route, concat(cast(floor(status / 100) as int), 'xx') as status_class, count(*) as n, round(sum(latency_seconds), 4) as latency_sum,
  round(avg(latency_seconds), 6) as latency_avg, count(*) filter (where latency_seconds <= 0.1) as le_0_1,
  count(*) filter (where latency_seconds <= 0.5) as le_0_5, count(*) filter (where latency_seconds <= 1.0) as le_1_0
from http_requests where route is not null and route <> '/metrics' group by all"""
)
def route_metrics(t: Tables) -> DataFrame:
    requests = t("http_requests").withColumn("status_class", ops.status_class(F.col("status")))
    out = ops.route_metrics(requests, by=("route", "status_class"))
    return out.withColumns({"latency_sum": F.round("latency_sum", 4), "latency_avg": F.round("latency_avg", 6)})


@query(
    derived_sql("run_logs")
    + """ select outcome, count(*) as n, round(avg(duration_seconds), 6) as avg_seconds, max(duration_seconds) as max_seconds,
  round(avg(n_steps), 6) as avg_steps from run_logs where event = 'crew_run_summary' group by outcome"""
)
def run_outcomes(t: Tables) -> DataFrame:
    logs = t("run_logs").withColumn("steps", F.array_repeat(F.lit("step"), F.col("n_steps")))
    out = ops.run_outcomes(logs)
    return out.withColumns({"avg_seconds": F.round("avg_seconds", 6), "avg_steps": F.round("avg_steps", 6)})


@query(
    derived_sql("run_logs")
    + """ select outcome, count(*) as n, round(avg(duration_seconds), 6) as avg_seconds, max(duration_seconds) as max_seconds,
  round(avg(n_steps), 6) as avg_steps from run_logs where event = 'crew_run_summary' group by outcome"""
)
def log_scan(t: Tables) -> DataFrame:
    """The same rollup from JSON-lines files, one written record per event."""
    folder = scratch_path(t.spark, "logs")
    steps = F.array_repeat(F.lit("step"), F.col("n_steps"))
    t("run_logs").select("event", "outcome", "duration_seconds", steps.alias("steps")).write.json(folder)
    out = ops.run_outcomes(read_logs(t.spark, folder))
    return out.withColumns({"avg_seconds": F.round("avg_seconds", 6), "avg_steps": F.round("avg_steps", 6)})


@query(
    derived_sql("request_logs")
    + """ select request_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as at, event_id, service, event, outcome,
  row_number() over (partition by request_id order by ts, event_id) as position from request_logs"""
)
def request_trace(t: Tables) -> DataFrame:
    logs = t("request_logs")
    api, runner = (logs.where(F.col("service") == s) for s in ("api", "runner"))
    trace = ops.request_trace(api, runner)
    return trace.select(
        "request_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"), "event_id", "service", "event", "outcome", "position"
    )
