"""From a source tree or a table of texts to a stored collection."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trawlnet.functions.keys import chunk_id, content_key, with_ordinal
from trawlnet.operators.chunk import DEFAULT_CHUNK_LINES, chunk_lines
from trawlnet.operators.embed import Embedder, check_dimension, resolve
from trawlnet.session import cut_lineage
from trawlnet.sources.collection import ParquetStore, ViewStore, check_record
from trawlnet.sources.tree import EXTENSIONS, require_directory, scan_tree


def with_chunk_ids(rows: DataFrame, ids: str = "ordinal", order_by: Sequence[str] = ("path", "start_line")) -> DataFrame:
    """Add ``id``: ``chunk_<n>`` by place in the unique order ``order_by``, or a key that follows the
    content's place (``path:start_line``), which needs no sort and survives growth of other files."""
    if ids == "content":
        return rows.withColumn("id", content_key(F.col("path"), F.col("start_line")))
    if ids != "ordinal":
        raise ValueError(f"unknown id scheme {ids!r}")
    # only keys are sorted and checkpointed; texts meet their number in one join on a unique key
    numbered = with_ordinal(rows.select(*order_by), order_by)
    numbered = numbered.select(*[F.col(c).alias(f"_{c}") for c in order_by], chunk_id(F.col("ordinal")).alias("id"))
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in order_by])
    return rows.join(numbered, same).drop(*[f"_{c}" for c in order_by])


def embed_chunks(chunks: DataFrame, embedder: str | Embedder | None = None, text_col: str = "text") -> DataFrame:
    chosen = resolve(embedder)
    return check_dimension(chosen.add(chunks, text_col), chosen.dim).withColumn("embedder", F.lit(chosen.name))


def store_rows(
    rows: DataFrame,
    collection_id: str,
    store: ParquetStore | ViewStore,
    mode: str = "insert_missing",
    unique: bool = False,
    embedder: str | None = None,
) -> None:
    """``embedder`` names what made the vectors; a collection that holds another's is refused."""
    if mode not in ("insert_missing", "upsert"):
        raise ValueError(f"unknown write mode {mode!r}")
    if embedder is not None:
        check_record(store.record(collection_id), embedder)
    getattr(store, mode)(rows.withColumn("collection_id", F.lit(collection_id)), collection_id, unique)


def store_documents(
    documents: DataFrame,
    collection_id: str,
    store: ParquetStore | ViewStore,
    *,
    order_by: Sequence[str],
    embedder: str | Embedder | None = None,
    mode: str = "insert_missing",
) -> None:
    """Number, embed and store ready-made texts: ``document``, any order columns, optional ``metadata``."""
    rows = embed_chunks(with_chunk_ids(documents, order_by=order_by), embedder, "document")
    store_rows(rows, collection_id, store, mode, embedder=resolve(embedder).name)


def ingest_texts(
    texts: DataFrame,
    collection_id: str,
    store: ParquetStore | ViewStore,
    *,
    embedder: str | Embedder | None = None,
    size: int = DEFAULT_CHUNK_LINES,
    ids: str = "ordinal",
    mode: str = "insert_missing",
    unique_paths: bool = False,
) -> None:
    """Chunk, number, embed and store rows of ``path, text``. Nothing is written when no chunk is left.

    ``unique_paths`` says that no path comes twice, so ids cannot either.
    """
    chunks = chunk_lines(texts, size=size)
    if ids == "ordinal":
        # numbering and storing both read the chunks, and must see the same ones even if files change
        chunks = cut_lineage(chunks)
    if chunks.isEmpty():
        return
    rows = embed_chunks(with_chunk_ids(chunks, ids), embedder).withColumnRenamed("text", "document")
    store_rows(rows, collection_id, store, mode, unique_paths, resolve(embedder).name)


def ingest_project(
    spark: SparkSession,
    project_path: str,
    store: ParquetStore | ViewStore,
    *,
    collection_id: str | None = None,
    extensions: Sequence[str] = EXTENSIONS,
    **options,
) -> None:
    """Index a source tree as ``code_<directory name>`` unless another name is given."""
    root = require_directory(project_path)
    name = collection_id or f"code_{root.rstrip('/').rsplit('/', 1)[-1]}"
    ingest_texts(scan_tree(spark, root, extensions), name, store, unique_paths=True, **options)
