"""From query texts to ranked chunks, formatted context and prompts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawlnet.operators.chat import task_prompts
from trawlnet.operators.embed import Embedder, resolve
from trawlnet.operators.retrieve import DEFAULT_K, context_per_query, fetch, knn
from trawlnet.sources.collection import ParquetStore, ViewStore, check_embedder, check_record


def search_chunks(
    queries: DataFrame,
    chunks: DataFrame,
    k: int = DEFAULT_K,
    *,
    query_id: str = "query_id",
    query_text: str = "text",
    item_id: str = "id",
    document: str = "document",
    embedder: str | Embedder | None = None,
    scope: str | None = None,
) -> DataFrame:
    """Text in, ranked ids out: both sides embedded with one embedder, then the exact top-k join.

    ``chunks`` may already hold an ``embedding`` column, as stored collections do.
    """
    chosen = resolve(embedder)
    if "embedding" not in chunks.columns:
        chunks = chosen.add(chunks, document)
    return knn(chosen.add(queries, query_text), chunks, k, query_id=query_id, item_id=item_id, scope=scope)


HIT_COLUMNS = ("rank", "id", "document", "metadata", "path", "start_line", "end_line", "distance")


def query_collection(
    store: ParquetStore | ViewStore,
    collection_id: str,
    queries: DataFrame,
    k: int = DEFAULT_K,
    *,
    query_id: str = "query_id",
    embedder: str | Embedder | None = None,
) -> DataFrame:
    """``query_id`` and ``HIT_COLUMNS`` of every query's best chunks within one collection."""
    check_record(store.record(collection_id), resolve(embedder).name, resolve(embedder).dim)
    rows = store.read(collection_id)
    hits = search_chunks(queries, rows, k, query_id=query_id, embedder=embedder)
    # the top-k runs on ids and vectors; documents are fetched for the winners only
    return fetch(hits, rows.drop("embedding", "embedder", "collection_id"), "id").select(query_id, *HIT_COLUMNS)


def query_collections(
    store: ParquetStore | ViewStore,
    queries: DataFrame,
    k: int = DEFAULT_K,
    *,
    query_id: str = "query_id",
    embedder: str | Embedder | None = None,
) -> DataFrame:
    """Like ``query_collection`` for queries that each name their own ``collection_id``, in one job."""
    asked = queries.select("collection_id").distinct()
    check_embedder(store.records(asked), resolve(embedder).name)
    rows = store.read_many(asked)
    hits = search_chunks(queries, rows, k, query_id=query_id, embedder=embedder, scope="collection_id")
    return fetch(hits, rows.drop("embedding", "embedder"), ["collection_id", "id"]).select(
        query_id, "collection_id", *HIT_COLUMNS
    )


def rag_contexts(
    store: ParquetStore | ViewStore, collection_id: str, queries: DataFrame, k: int = DEFAULT_K, **options
) -> DataFrame:
    """Every query with the formatted text of its k best chunks."""
    key = options.get("query_id", "query_id")
    return context_per_query(queries, query_collection(store, collection_id, queries, k, **options), key)


def rag_prompts(requests: DataFrame, contexts: DataFrame, query_id: str = "query_id") -> DataFrame:
    """Each request once with its retrieved context and its task prompts."""
    return requests.join(contexts.select(query_id, "context"), query_id, "left").select(
        query_id, "context", task_prompts(F.col("message")).alias("prompts")
    )
