"""Formatting stored search responses, and a TF-IDF search over crawled pages."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from trawlnet.functions.text import TITLE, first_non_empty
from trawlnet.functions.words import coded_words, drop_tags, text_slices
from trawlnet.operators.retrieve import BROADCAST_BYTES, BROADCAST_ROWS, NO_RESULTS, rank_hits
from trawlnet.operators.topk import DECIMALS, RunningTopK
from trawlnet.session import cut_lineage

# Fixed values.
PROVIDER_A = "Tavily"
PROVIDER_B = "Serper"
NO_PROVIDER = "Search result (no API key configured). Use TAVILY_API_KEY or SERPER_API_KEY for live search."
PROVIDER_B_HITS = 5
MALFORMED = "malformed response"
SCHEMA_A = "results array<struct<title string, url string, content string>>, answer string"
SCHEMA_B = "organic array<struct<title string, link string, snippet string>>"


def _hit_lines(hits: Column, title: str, link: str, body: str) -> Column:
    def field(hit: Column, name: str) -> Column:
        return F.coalesce(hit[name], F.lit(""))

    return F.array_join(
        F.transform(
            hits,
            lambda h: F.concat(
                F.lit("- "), field(h, title), F.lit(": "), field(h, link), F.lit("\n  "), field(h, body)
            ),
        ),
        "\n",
    )


def format_response_a(payload: Column) -> Column:
    data = F.from_json(payload, SCHEMA_A)
    listed = F.when(F.size(data["results"]) > 0, _hit_lines(data["results"], "title", "url", "content"))
    return F.coalesce(listed, first_non_empty(data["answer"], NO_RESULTS))


def format_response_b(payload: Column) -> Column:
    organic = F.from_json(payload, SCHEMA_B)["organic"]
    first = F.slice(organic, 1, PROVIDER_B_HITS)
    return F.coalesce(F.when(F.size(organic) > 0, _hit_lines(first, "title", "link", "snippet")), F.lit(NO_RESULTS))


def search_text(payload_a: Column, error_a: Column, payload_b: Column, error_b: Column) -> Column:
    """Provider A's answer or failure if it was asked, else provider B's, else the fixed notice."""

    def asked(provider: str, error: Column, payload: Column, text: Column) -> Column:
        broken = F.when(payload.isNotNull() & F.try_parse_json(payload).isNull(), F.lit(MALFORMED))
        failure = F.concat(F.lit(f"{provider} search failed: "), F.coalesce(error, broken))
        return F.coalesce(failure, F.when(payload.isNotNull(), text))

    return F.coalesce(
        asked(PROVIDER_A, error_a, payload_a, format_response_a(payload_a)),
        asked(PROVIDER_B, error_b, payload_b, format_response_b(payload_b)),
        F.lit(NO_PROVIDER),
    )


def page_title(html: Column) -> Column:
    return F.regexp_extract(html, TITLE, 1)


def search_pages(
    pages: DataFrame,
    queries: DataFrame,
    k: int = 5,
    *,
    page_id: str = "page_id",
    html: str = "html",
    query_id: str = "query_id",
    query_text: str = "text",
    max_queries: int = BROADCAST_ROWS,
) -> DataFrame:
    """The k pages with the highest TF-IDF score per query: ``query_id, page_id, score, rank``.

    The score is the sum over the query's distinct words of ``tf * ln(pages / df)`` to 6 decimals;
    ties go to the lower page id and pages scoring zero are no hits. Rows that share a query id are one query with the
    words of all. Few queries go to the pages, which never move; more of them are answered from an index of the pages,
    so texts are cut into words once for any number of queries.
    """
    asked = queries.select(query_id, F.col(query_text).alias("_asked"))
    size = asked.agg(F.count("*").alias("n"), F.sum(F.octet_length("_asked")).alias("held")).first()
    if size["n"] > max_queries or (size["held"] or 0) > BROADCAST_BYTES:
        index = index_pages(pages, page_id=page_id, html=html)
        return search_index(index, queries, k, query_id=query_id, query_text=query_text)
    texts = pages.select(page_id, F.col(html).alias("_html"))
    hits = _score_block(texts, asked.toArrow(), asked.schema[query_id], pages.count(), k, page_id, query_id)
    return rank_hits(hits, k, query_id, page_id, cost="_cost").select(query_id, page_id, (-F.col("_cost")).alias("score"), "rank")


@dataclass(frozen=True)
class PageIndex:
    """An inverted index: ``postings(word, <page id>, tf)``, ``words(word, df, most)`` with the greatest tf of each
    word, and the number of pages."""

    postings: DataFrame
    words: DataFrame
    n_pages: int
    page_id: str


def index_pages(pages: DataFrame, *, page_id: str = "page_id", html: str = "html", path: str | None = None) -> PageIndex:
    """Cut every page into words once. ``path`` keeps the postings as a Parquet table; else they are checkpointed."""
    made = pages.select(page_id, F.col(html).alias("_html")).mapInArrow(
        _post(page_id), StructType([StructField("word", StringType()), pages.schema[page_id], StructField("tf", IntegerType())])
    )
    if path is None:
        postings = cut_lineage(made)
    else:
        made.write.parquet(path)
        postings = pages.sparkSession.read.schema(made.schema).parquet(path)
    words = cut_lineage(postings.groupBy("word").agg(F.count(F.lit(1)).alias("df"), F.max("tf").alias("most")))
    return PageIndex(postings, words, pages.count(), page_id)


def _text_batches(batches):
    """The same rows in batches of a few MB of text, as the words of a batch take many times its size."""
    for batch in batches:
        for some in text_slices(batch.column("_html")):
            yield batch.slice(some.start, some.stop - some.start)


def _post(page_id: str):
    def run(batches):
        for batch in _text_batches(batches):
            row, code, words = coded_words(drop_tags(batch.column("_html")))
            pairs, tf = np.unique(row * max(1, len(words)) + code, return_counts=True)
            row, code = np.divmod(pairs, max(1, len(words)))
            made = [pa.array(words, pa.string()).take(pa.array(code)), batch.column(page_id).take(pa.array(row)), pa.array(tf.astype("int32"))]
            yield pa.RecordBatch.from_arrays(made, names=["word", page_id, "tf"])

    return run


def _words_of(query_id: str):
    def run(batches):
        for batch in batches:
            row, code, words = coded_words(batch.column("_asked"))
            made = [batch.column(query_id).take(pa.array(row)), pa.array(words, pa.string()).take(pa.array(code))]
            yield pa.RecordBatch.from_arrays(made, names=[query_id, "word"])

    return run


# A word on more pages than this is dealt to so many tasks; sums may differ by so much from their bounds.
SLICE_ROWS, SLICES = 50_000, 32
_ROOM = 1e-6


def search_index(index: PageIndex, queries: DataFrame, k: int = 5, *, query_id: str = "query_id", query_text: str = "text") -> DataFrame:
    """``query_id, page_id, score, rank`` as ``search_pages`` gives them, from the postings of the words asked.

    Each word's score is bounded by its greatest tf. The k-th best page by single words is a floor for each query;
    words that together stay below it cannot lift a page into the best k on their own, so their postings, which are the
    long ones, are read only for pages that a query's other words have found. Frequent words are dealt to several tasks.
    """
    page_id, field = index.page_id, queries.schema[query_id]
    texts = queries.select(query_id, F.coalesce(query_text, F.lit("")).alias("_asked"))
    asked = texts.mapInArrow(_words_of(query_id), StructType([field, StructField("word", StringType())])).distinct()
    known = index.words.where(F.col("df") < index.n_pages)
    asked = asked.join(known, "word").withColumn("idf", F.log(F.lit(float(index.n_pages)) / F.col("df")))
    asked = cut_lineage(asked.withColumn("bound", F.col("most") * F.col("idf")))
    slices = F.when(F.col("df") > SLICE_ROWS, SLICES).otherwise(1)
    slot = F.pmod(F.xxhash64(page_id), slices).cast("int").alias("slot")
    own = index.postings.join(asked.select("word", "df").distinct(), "word")
    own = cut_lineage(own.select("word", page_id, "tf", slot))

    best = Window.partitionBy("word").orderBy(F.desc("tf"), page_id)
    heads = own.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k)
    single = asked.join(heads, "word").groupBy(query_id, page_id).agg(F.max(F.col("tf") * F.col("idf")).alias("gain"))
    last = Window.partitionBy(query_id).orderBy(F.desc("gain"), page_id)
    floors = single.withColumn("n", F.row_number().over(last)).where(F.col("n") == k).select(F.col(query_id).alias("_q"), F.col("gain").alias("floor"))
    rising = Window.partitionBy(query_id).orderBy("bound", "word").rowsBetween(Window.unboundedPreceding, 0)
    bounded = asked.join(floors, asked[query_id].eqNullSafe(floors["_q"]), "left").drop("_q").withColumn("floor", F.coalesce("floor", F.lit(0.0)))
    bounded = cut_lineage(bounded.withColumn("leads", F.sum("bound").over(rising) >= F.col("floor") - _ROOM))

    leading = bounded.where("leads").select(query_id, "word", "idf", F.explode(F.sequence(F.lit(0), slices - 1)).alias("slot"))
    found = leading.join(own, ["word", "slot"]).groupBy(query_id, page_id).agg(F.sum(F.col("tf") * F.col("idf")).alias("part"))
    rest = bounded.groupBy(F.col(query_id).alias("_q")).agg(F.max("floor").alias("floor"), F.sum(F.when(~F.col("leads"), F.col("bound")).otherwise(0.0)).alias("more"))
    found = found.join(rest, found[query_id].eqNullSafe(rest["_q"])).where(F.col("part") + F.col("more") >= F.col("floor") - _ROOM)
    found = cut_lineage(found.select(query_id, page_id, "part"))
    others = bounded.where("not leads").select(F.col(query_id).alias("_q"), "word", "idf")
    more = found.join(others, found[query_id].eqNullSafe(others["_q"])).join(own.drop("slot"), ["word", page_id])
    gains = found.unionByName(more.select(query_id, page_id, (F.col("tf") * F.col("idf")).alias("part")))
    scored = gains.groupBy(query_id, page_id).agg(F.round(F.sum("part"), DECIMALS).alias("score")).where("score > 0")
    return rank_hits(scored.withColumn("_cost", -F.col("score")), k, query_id, page_id, cost="_cost").select(query_id, page_id, "score", "rank")


def _score_block(pages, head: pa.Table, query_field, n_pages, k, page_id, query_id) -> DataFrame:
    spark = pages.sparkSession
    coded = head[query_id].combine_chunks().dictionary_encode(null_encoding="encode")
    ids = coded.dictionary
    owner, word_of, vocabulary = coded_words(head["_asked"].combine_chunks())
    owner = coded.indices.to_numpy()[owner]
    word_of, owner = np.unique(np.stack([word_of, owner]), axis=1).astype(np.int64)  # each word counts once per query
    postings = owner  # queries of word w sit at starts[w]:starts[w + 1]
    starts = np.r_[0, np.cumsum(np.bincount(word_of, minlength=len(vocabulary)))]

    # texts are tokenised once; what is kept of a page is its counts of the words asked for
    counted = cut_lineage(_count_words(pages, vocabulary, page_id))
    df = np.zeros(len(vocabulary))
    for r in counted.select(F.explode("word").alias("w")).groupBy("w").count().collect():  # at most the vocabulary
        df[r["w"]] = r["count"]
    idf = np.log(n_pages / np.maximum(df, 1))
    schema = StructType(
        [
            StructField(query_id, query_field.dataType),
            StructField(page_id, pages.schema[page_id].dataType),
            StructField("_cost", DoubleType()),
        ]
    )
    shared = spark.sparkContext.broadcast((ids, idf, starts, postings))

    def score(batches):
        q_ids, weight, first, queries_of = shared.value
        best = RunningTopK(len(q_ids), k, floor=-math.inf)
        item_type = None
        for batch in batches:
            item_type = batch.schema.field(page_id).type
            page_ids = batch.column(page_id).to_numpy(zero_copy_only=False)
            for rows, costs in _page_costs(batch.column("word"), batch.column("tf"), weight, first, queries_of, len(q_ids)):
                best.offer(lambda part, c=costs: c[part], len(rows), page_ids[rows])
        if best.ids is not None and len(best.rows):
            yield pa.RecordBatch.from_arrays(
                [q_ids.take(pa.array(best.rows)), pa.array(best.ids, type=item_type), pa.array(best.costs)],
                names=schema.names,
            )

    return counted.mapInArrow(score, schema)


def _count_words(pages: DataFrame, vocabulary: list[str], page_id: str) -> DataFrame:
    """``page_id, word, tf``: positions in the vocabulary and how often the page has each; no empty rows."""
    schema = StructType(
        [
            pages.schema[page_id],
            StructField("word", ArrayType(IntegerType())),
            StructField("tf", ArrayType(IntegerType())),
        ]
    )
    shared = pages.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches):
        lookup = pd.Index(shared.value, dtype=object)
        width = max(1, len(lookup))
        for batch in _text_batches(batches):
            row, code, words = coded_words(drop_tags(batch.column("_html")))
            if not len(row):
                continue
            word = lookup.get_indexer(pd.Index(words, dtype=object))[code]
            pairs, tf = np.unique(row[word >= 0] * width + word[word >= 0], return_counts=True)
            row, word = np.divmod(pairs, width)
            pages, sizes = np.unique(row, return_counts=True)
            offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype("int32"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(page_id).take(pa.array(pages)),
                    pa.ListArray.from_arrays(offsets, pa.array(word.astype("int32"))),
                    pa.ListArray.from_arrays(offsets, pa.array(tf.astype("int32"))),
                ],
                names=schema.names,
            )

    return pages.mapInArrow(count, schema)


_SLICE_CELLS = 1_000_000


def _page_costs(word_lists: pa.ListArray, tf_lists: pa.ListArray, idf, starts, postings, n_queries: int):
    """Negated rounded scores (query x page) of a few pages at a time; ``inf`` where nothing matches."""
    n = len(word_lists)
    word, tf = word_lists.flatten().to_numpy(), tf_lists.flatten().to_numpy()
    row = np.repeat(np.arange(n), word_lists.value_lengths().to_numpy())
    fan = (starts[1:] - starts[:-1])[word]  # queries that ask for each word
    work = np.cumsum(np.bincount(row, weights=fan.astype(float), minlength=n) + n_queries)
    group = (work // _SLICE_CELLS).astype(int)
    for g in np.unique(group):
        rows = np.flatnonzero(group == g)
        mine = (row >= rows[0]) & (row <= rows[-1])
        size = fan[mine]
        offset = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        query = postings[np.repeat(starts[word[mine]], size) + offset]
        page = np.repeat(row[mine] - rows[0], size)
        gain = np.repeat(tf[mine] * idf[word[mine]], size)
        total = np.bincount(query * len(rows) + page, weights=gain, minlength=n_queries * len(rows))
        score = np.round(total.reshape(n_queries, len(rows)), DECIMALS)
        yield rows, np.where(score > 0, -score, np.inf)
