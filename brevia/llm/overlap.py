"""Long texts in overlapping chunks that are spliced where their boundaries agree.

A splitter that reads from left to right and looks back at nothing is memoryless: what
follows a boundary depends on the text after it alone. Chunk ``k`` covers ``chunk``
characters and ``overlap`` more. A boundary that the chunk and its successor both have in
their common part is a boundary of the whole text as well, provided the first chunk is
in step and no match it relied on touched its end: from there on the successor is in
step. The first chunk begins the text, so by induction every cut is proven.

A pair without a common boundary fails its document, which is analysed again with a wider
overlap, and after the widest as a whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brevia.llm.common import row_key, text_of
from brevia.session import materialise

CHUNK = 32_768
OVERLAPS = (256, 4_096)
KEY = ["doc_id", "h1", "h2"]
CHUNK_ROWS = "doc_id bigint, h1 bigint, h2 bigint, chunk int, last boolean, begin bigint, text string"


def is_long(chunk: int = CHUNK):
    return F.length(text_of()) > chunk


def split_chunks(rows: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """Chunk rows of (key, text), dealt out so that a document's chunks run in parallel.

    Rows with one key are one document here; results are joined back to every row.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                text = row["text"]
                for k, begin in enumerate(range(0, len(text), chunk)):
                    last = begin + chunk >= len(text)
                    part = row | {"chunk": k, "last": last, "begin": begin}
                    part["text"] = text[begin : begin + chunk + overlap]
                    yield pa.RecordBatch.from_pylist([part], schema=schema)

    key = [pa.field(c, pa.int64()) for c in KEY]
    schema = pa.schema(
        [*key, ("chunk", pa.int32()), ("last", pa.bool_()), ("begin", pa.int64()), ("text", pa.string())]
    )
    chunks = rows.select(*KEY, "text").mapInArrow(split, CHUNK_ROWS)
    return chunks.dropDuplicates([*KEY, "chunk"])


def with_cuts(analysed: DataFrame) -> DataFrame:
    """Adds ``lo`` and ``hi``, the cuts of each chunk, and ``failed`` of its document.

    ``heads`` and ``tails`` are a chunk's boundaries in its parts shared with the chunk
    before and after, as positions in the document.
    """
    order = Window.partitionBy(*KEY).orderBy("chunk")
    common = F.array_min(F.array_intersect("tails", F.lead("heads").over(order)))
    marked = analysed.withColumn("hi", F.when(~F.col("last"), common))
    marked = marked.withColumn("lo", F.lag("hi").over(order))
    failed = F.max(~F.col("last") & F.col("hi").isNull()).over(Window.partitionBy(*KEY))
    return marked.withColumn("failed", failed)


def spliced(
    docs: DataFrame,
    analyse: Callable[[DataFrame, int, int], DataFrame],
    chunk: int = CHUNK,
    overlaps: tuple[int, ...] = OVERLAPS,
) -> tuple[list[DataFrame], DataFrame | None]:
    """Cut chunks of all documents that align, and the rest (key, text), if any."""
    todo, done = docs.select(*row_key(), text_of().alias("text")), []
    for overlap in overlaps:
        overlap = min(overlap, chunk // 2)
        cut = with_cuts(analyse(split_chunks(todo, chunk, overlap), chunk, overlap))
        cut = materialise(cut, f"spliced-{overlap}")
        done.append(cut.where(~F.col("failed")))
        failed = cut.where("failed").select(*KEY).distinct()
        if failed.isEmpty():
            return done, None
        keys = failed.toDF("_d", "_1", "_2")
        same = todo["doc_id"].eqNullSafe(keys["_d"]) & (todo["h1"] == keys["_1"]) & (todo["h2"] == keys["_2"])
        todo = todo.join(keys, same, "left_semi")
    return done, todo.dropDuplicates(KEY)


def join_back(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Every row of ``docs`` (by key, without its text) with what was found for its key."""
    rows = docs.select(*row_key())
    keys = found.withColumnsRenamed({"doc_id": "_d", "h1": "_1", "h2": "_2"})
    same = rows["doc_id"].eqNullSafe(keys["_d"]) & (rows["h1"] == keys["_1"]) & (rows["h2"] == keys["_2"])
    return rows.join(keys, same).drop(*KEY[1:], "_d", "_1", "_2")
