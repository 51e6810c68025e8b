"""Line-block chunking with exact line spans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawlnet.functions import text as T

DEFAULT_CHUNK_LINES = 50


def chunk_lines(
    docs: DataFrame,
    *,
    size: int = DEFAULT_CHUNK_LINES,
    text_col: str = "text",
    keep: Sequence[str] = ("path",),
) -> DataFrame:
    """Cut each text into blocks of ``size`` lines; blank blocks vanish but still count lines.

    Returns ``keep`` plus ``text, start_line, end_line`` (1-based, inclusive). A negative size
    keeps each non-blank text whole, stripped, without a span. Map-only: no shuffle.
    """
    if size == 0:
        raise ValueError("chunk size must not be zero")
    if size < 0:
        return whole_text(docs, text_col=text_col, keep=keep)
    # `_raw` stays a projection of its own: it is read several times below, and inlining the
    # split into the lambda would redo it for every block. Only "" has no lines.
    raw = docs.where(F.col(text_col) != "").select(*keep, T.raw_lines(F.col(text_col)).alias("_raw"))
    raw = raw.select("*", T.n_lines(F.col("_raw")).alias("_n"))
    step = F.lit(size)
    blocks = F.transform(
        F.sequence(F.lit(0), F.col("_n") - 1, step),
        lambda i: F.struct(
            F.array_join(F.slice("_raw", i + 1, F.least(step, F.col("_n") - i)), "\n").alias("text"),
            (i + 1).alias("start_line"),
            F.least(i + step, F.col("_n")).alias("end_line"),
        ),
    )
    return raw.select(*keep, F.inline(blocks)).where(T.is_non_blank(F.col("text")))


def whole_text(docs: DataFrame, *, text_col: str = "text", keep: Sequence[str] = ("path",)) -> DataFrame:
    """One stripped chunk per non-blank text, with no line span."""
    unified = T.newline_ends(F.col(text_col), ("\r\n", "\r"))
    return docs.where(T.is_non_blank(F.col(text_col))).select(
        *keep,
        T.strip(unified).alias("text"),
        F.lit(None).cast("int").alias("start_line"),
        F.lit(None).cast("int").alias("end_line"),
    )


def line_counts(docs: DataFrame, *, text_col: str = "text", keep: Sequence[str] = ("path",)) -> DataFrame:
    raw = docs.select(*keep, T.raw_lines(F.col(text_col)).alias("_raw"))
    return raw.select(*keep, T.n_lines(F.col("_raw")).alias("n_lines"))
