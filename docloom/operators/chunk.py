"""Chunking of line arrays at structural boundaries: sequential folds per document, parallel over documents.

The folds run inside one expression per document, so the only shuffle is the one that gathers a document's lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import patterns as P
from docloom.functions import text as T

TARGET = 15_000
MAXIMUM = 30_000
_SPANS = "array<struct<start:int,end:int>>"
_CHUNKS = "array<struct<start:int,end:int,tables:int>>"


def _marked(lines: Column, opening: str, closing: str) -> Column:
    return F.transform(lines, lambda x: F.struct(T.count_matches(x, opening).alias("o"), T.count_matches(x, closing).alias("c"), (F.length(x) + 1).alias("n")))


def _depth(s: Column, m: Column) -> tuple[Column, Column, Column, Column]:
    """(done, opened, depth, start) after a line: the span that is open, and whether it ends here."""
    opened = F.when((m.o > 0) & (s.depth == 0) & s.start.isNull(), s.i).otherwise(s.start)
    depth = s.depth + m.o - m.c
    done = (depth <= 0) & opened.isNotNull()
    return done, opened, F.when(done, 0).otherwise(depth), F.when(~done, opened)


def spans(lines: Column, opening: str = P.TABLE_OPEN, closing: str = P.TABLE_CLOSE) -> Column:
    """Zero-based (start, end) of each top-level span, by counting depth line by line.

    As in the source's rule, a stray closing mark leaves a negative depth behind that hides later spans.
    """
    start = F.struct(F.lit(0).alias("i"), F.lit(0).alias("depth"), F.lit(None).cast("int").alias("start"), F.array().cast(_SPANS).alias("spans"))

    def step(s: Column, m: Column) -> Column:
        done, opened, depth, begun = _depth(s, m)
        found = F.array(F.struct(opened.alias("start"), s.i.alias("end")))
        return F.struct((s.i + 1).alias("i"), depth.alias("depth"), begun.alias("start"), F.when(done, F.concat(s.spans, found)).otherwise(s.spans).alias("spans"))

    return F.aggregate(_marked(lines, opening, closing), start, step, lambda s: s.spans)


def greedy_cuts(lines: Column, target: int = TARGET, opening: str = P.TABLE_OPEN, closing: str = P.TABLE_CLOSE) -> Column:
    """(start, end, tables), zero-based: a chunk ends at the first span end at which it holds ``target``
    characters (each line with its line end); the rest is the last chunk. Spans and cuts come from one fold, so a line is looked at once."""
    start = F.struct(
        *(F.lit(0).alias(c) for c in ("i", "depth")), F.lit(None).cast("int").alias("start"), *(F.lit(0).alias(c) for c in ("first", "size", "tables")), F.array().cast(_CHUNKS).alias("chunks")
    )

    def step(s: Column, m: Column) -> Column:
        done, _, depth, begun = _depth(s, m)
        size, tables = s["size"] + m.n, s.tables + done.cast("int")
        cut = (size >= target) & done
        found = F.array(F.struct(s.first.alias("start"), s.i.alias("end"), tables.alias("tables")))
        return F.struct(
            (s.i + 1).alias("i"),
            depth.alias("depth"),
            begun.alias("start"),
            F.when(cut, s.i + 1).otherwise(s.first).alias("first"),
            F.when(cut, 0).otherwise(size).alias("size"),
            F.when(cut, 0).otherwise(tables).alias("tables"),
            F.when(cut, F.concat(s.chunks, found)).otherwise(s.chunks).alias("chunks"),
        )

    def finish(s: Column) -> Column:
        rest = F.array(F.struct(s.first.alias("start"), (s.i - 1).alias("end"), s.tables.alias("tables")))
        return F.when(s.first < s.i, F.concat(s.chunks, rest)).otherwise(s.chunks)

    return F.aggregate(_marked(lines, opening, closing), start, step, finish)


def chunk_documents(
    docs: DataFrame, key: str, lines: str, target: int = TARGET, maximum: int = MAXIMUM, opening: str = P.TABLE_OPEN, closing: str = P.TABLE_CLOSE, code: str = P.CODE
) -> DataFrame:
    """One row per chunk of each document (``key``, ``lines`` array): the chunk index. Blank chunks are left out before numbering."""
    cut = docs.select(key, lines, greedy_cuts(F.col(lines), target, opening, closing).alias("__cuts"))
    texts = F.transform("__cuts", lambda c: F.struct(c.start.alias("start"), c.end.alias("end"), c.tables.alias("tables"), F.array_join(F.slice(lines, c.start + 1, c.end - c.start + 1), "\n").alias("text")))
    kept = F.filter(texts, lambda c: T.strip(c.text) != "")
    rows = cut.select(key, F.posexplode(kept).alias("pos", "c"))
    return rows.select(
        F.format_string("%s_%03d", F.col(key).cast("string"), F.col("pos") + 1).alias("chunk_id"),
        F.col(key),
        (F.col("c.start") + 1).alias("start_line"),
        (F.col("c.end") + 1).alias("end_line"),
        F.length("c.text").alias("char_count"),
        F.col("c.tables").alias("table_count"),
        T.codes("c.text", code).alias("codes"),
        (F.length("c.text") > maximum).alias("oversized"),
        T.content_hash("c.text").alias("content_hash"),
        F.col("c.text").alias("text"),
    )


def lines_of(rows: DataFrame, key: str, number: str, line: str) -> DataFrame:
    """(key, lines): line rows gathered in order, one array per document."""
    gathered = F.sort_array(F.collect_list(F.struct(number, line)))
    return rows.groupBy(key).agg(F.transform(gathered, lambda s: s[line]).alias("lines"))


def all_codes(chunks: DataFrame, codes: str = "codes") -> DataFrame:
    """(code, chunks): the union of the chunks' codes, as a relation, with the number of chunks that hold each."""
    return chunks.select(F.explode(codes).alias("code")).groupBy("code").agg(F.count("*").alias("chunks"))


def chunk_stats(chunks: DataFrame, size: str = "char_count") -> DataFrame:
    """Count, least, greatest and floor of the mean size, tables, oversized chunks."""
    return chunks.agg(
        F.count("*").alias("chunks"),
        F.min(size).alias("min_chars"),
        F.max(size).alias("max_chars"),
        F.floor(F.sum(size) / F.count("*")).alias("avg_chars"),
        F.sum("table_count").alias("tables"),
        F.count_if("oversized").alias("oversized"),
    )


def largest(rows: DataFrame, size: str, tie: str, n: int = 5) -> DataFrame:
    return rows.orderBy(F.desc(size), tie).limit(n)
