"""Nearest neighbours by additive quantisation.

A vector is approximated by the sum of one codeword from each of ``BOOKS`` full-dimensional codebooks. The books are
fitted one after the other to what the earlier ones leave, on a bounded sample (``SAMPLE`` different vectors in the order of a hash).
Encoding keeps the ``BEAM`` best partial sums at every book. With the codes goes a stored norm: the ratio
of the vector's length to its approximation's. An inner product is then ``BOOKS`` table look-ups times that ratio.

1. Equal vectors are one entry, which carries its ``k`` + 1 smallest ids. Every entry is indexed: blocks of ``BLOCK_ROWS`` entries
   hold nothing but codes, norms and entry numbers.
2. Every block of queries meets every block of codes. Of each pair of blocks the ``depth`` best of every query come out, as (query, entry, approximate
   score); a window keeps the ``depth`` best of all of them.
3. The vectors of these entries alone are fetched and scored exactly, in double precision; of ties the smaller id comes first.

So a query block ships codes (``BOOKS`` bytes a row) and never vectors; exact work is ``depth`` rows a query however large the table is.
``depth`` is a parameter of the search (``RERANK``), not a cap on the answer: what stands behind it by the look-ups is not among the answers, as in any
search of this kind. Recall against brute force is measured in the tests and given in the README.

Rows: vectors that are null, zero or hold null or non-finite components take no part, nor do rows without an id or of another length
than the most frequent one; of rows that repeat an id the largest vector counts; of equal scores the smaller id comes first; other columns are left behind;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm._common import shared_dir, written

BOOKS = 16
WORDS = 256
BEAM = 4
SAMPLE = 8192
RERANK = 600
BLOCK_ROWS = 1 << 15
BLOCK_QUERIES = 1024
NEAREST = 20


def kmeans(x: np.ndarray, k: int, seed: int, rounds: int = 8) -> np.ndarray:
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = np.argmax(x @ c.T - 0.5 * (c**2).sum(1), 1)
        n = np.bincount(near, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], x[rng.integers(0, len(x), k)])
    return c


def fit_books(x: np.ndarray, books: int = BOOKS, words: int = WORDS) -> np.ndarray:
    """(books, words, dimensions) fitted to residuals in turn."""
    out, left = [], x.astype(np.float32)
    for b in range(books):
        c = kmeans(left, words, b)
        if len(c) < words:  # fewer vectors than codewords
            c = np.concatenate([c, np.zeros((words - len(c), x.shape[1]), np.float32)])
        out.append(c)
        left = left - c[np.argmax(left @ c.T - 0.5 * (c**2).sum(1), 1)]
    return np.stack(out)


def encode(x: np.ndarray, books: np.ndarray, beam: int = BEAM) -> np.ndarray:
    """Codes (rows, books) by beam search over partial sums."""
    n, k = len(x), books.shape[1]
    left = x.astype(np.float32)[:, None, :]
    codes = np.zeros((n, 1, 0), np.uint8)
    for c in books:
        gain = 2 * (left.reshape(-1, left.shape[2]) @ c.T) - (c**2).sum(1)
        error = (left**2).sum(2)[:, :, None] - gain.reshape(n, -1, k)
        flat = error.reshape(n, -1)
        width = min(beam, flat.shape[1])
        best = np.argpartition(flat, width - 1, 1)[:, :width]
        parent, word = best // k, best % k
        rows = np.arange(n)[:, None]
        left = left[rows, parent] - c[word]
        codes = np.concatenate([codes[rows, parent], word[:, :, None].astype(np.uint8)], 2)
    return codes[np.arange(n), np.argmin((left**2).sum(2), 1)]


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, v array<double>): the vectors that take part, one per id; -0.0 is 0.0."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull())
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))).where(F.exists("v", lambda x: x != 0))
    return rows.groupBy("id").agg(F.max("v").alias("v")).select("id", F.transform("v", lambda x: x + F.lit(0.0)).alias("v"))


def entries(rows: DataFrame, k: int) -> DataFrame:
    """(entry, ids, v): one row per different vector, named by its smallest id, with its ``k`` + 1 smallest ids in order."""
    nth = F.row_number().over(Window.partitionBy("v").orderBy("id"))  # the limit applies before the shuffle too, so many copies are no load
    few = rows.withColumn("nth", nth).where(F.col("nth") <= k + 1)
    return few.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")).select(F.col("ids")[0].alias("entry"), "ids", "v")


def index(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """Blocks (entries, codes, ratio) of the rows (entry, v)."""
    dims = books.shape[2]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def block():
            cells = [b"".join(h[c] for h in held) for c in range(3)]
            return pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in cells], ["entries", "codes", "ratio"])

        for part in parts:
            for a in range(0, part.num_rows, 1024):
                piece = part.slice(a, 1024)
                x = piece.column(1).flatten().to_numpy().reshape(-1, dims)
                codes = encode(x, books)
                approx = books[np.arange(len(books)), codes.astype(np.int64)].sum(1)
                length = np.sqrt((approx.astype(np.float64) ** 2).sum(1))
                ratio = (np.sqrt((x**2).sum(1)) / np.where(length > 0, length, 1)).astype(np.float32)
                held.append((piece.column(0).to_numpy().astype(np.int64).tobytes(), codes.tobytes(), ratio.tobytes()))
                size += piece.num_rows
                if size >= BLOCK_ROWS:
                    yield block()
                    held, size = [], 0
        if size:
            yield block()

    return rows.mapInArrow(run, "entries binary, codes binary, ratio binary")


def query_blocks(queries: DataFrame, dims: int) -> DataFrame:
    """(ids, vectors) per block of queries."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for a in range(0, part.num_rows, BLOCK_QUERIES):
                piece = part.slice(a, BLOCK_QUERIES)
                cells = [piece.column(0).to_numpy().astype(np.int64).tobytes(), piece.column(1).flatten().to_numpy().astype(np.float32).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in cells], ["query_ids", "query_vectors"])

    return queries.mapInArrow(run, "query_ids binary, query_vectors binary")


def best_of_block(q: np.ndarray, codes: np.ndarray, ratio: np.ndarray, books: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, approximate score) of the ``depth`` best rows of each query, by table look-ups."""
    tables = np.einsum("qd,bwd->bwq", q, books)  # a codeword's products with all queries stand together
    approx = np.zeros((len(codes), len(q)), np.float32)
    for b in range(len(books)):
        approx += tables[b][codes[:, b]]
    approx *= ratio[:, None]
    approx = np.ascontiguousarray(approx.T)
    keep = min(depth, approx.shape[1])
    rows = np.argpartition(approx, approx.shape[1] - keep, 1)[:, approx.shape[1] - keep :]
    return np.repeat(np.arange(len(q)), keep), rows.ravel(), np.take_along_axis(approx, rows, 1).ravel()


def search(vectors: DataFrame, queries: DataFrame, k: int = NEAREST, depth: int = RERANK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest by inner product, its own id left out."""
    spark = vectors.sparkSession
    at = shared_dir(spark)
    rows = usable(vectors)
    rows = written(rows, f"{at}/rows")
    length = rows.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if length is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims = length.dims
    known = written(entries(rows.where(F.size("v") == dims), k), f"{at}/entries")
    sample = known.orderBy(F.xxhash64("entry"), "entry").limit(SAMPLE).select("v").toArrow().column(0).combine_chunks()
    books = fit_books(sample.flatten().to_numpy().reshape(-1, dims))
    blocks = written(index(known.select("entry", "v"), books).withColumn("n", F.monotonically_increasing_id()), f"{at}/blocks")
    asked = usable(queries).where(F.size("v") == dims)
    # a dense number per block, from rows without codes
    numbers = blocks.select(F.col("n").alias("block")).withColumn("at", F.row_number().over(Window.orderBy("block")) - 1)
    numbers = written(numbers, f"{at}/numbers")
    spread = written(query_blocks(asked, dims), f"{at}/queries").withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(numbers.count() - 1))))
    pairs = spread.join(numbers, "at").join(blocks, F.col("block") == F.col("n")).select("query_ids", "query_vectors", "entries", "codes", "ratio")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for r in range(part.num_rows):
                cell = lambda name, kind: np.frombuffer(part.column(name)[r].as_buffer(), kind)  # noqa: B023, E731
                q_ids, q = cell("query_ids", np.int64), cell("query_vectors", np.float32).reshape(-1, dims)
                names, codes, ratio = cell("entries", np.int64), cell("codes", np.uint8).reshape(-1, len(books)), cell("ratio", np.float32)
                for a in range(0, len(q), 64):
                    of, row, approx = best_of_block(q[a : a + 64], codes, ratio, books, depth)
                    yield pa.RecordBatch.from_arrays([pa.array(q_ids[a + of]), pa.array(names[row]), pa.array(approx)], ["query_id", "entry", "approx"])

    found = pairs.mapInArrow(run, "query_id long, entry long, approx float")
    best = Window.partitionBy("query_id").orderBy(F.desc("approx"), "entry")
    found = found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= depth).select("query_id", "entry")
    exact = F.aggregate(F.zip_with("q", "v", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    scored = found.join(asked.select(F.col("id").alias("query_id"), F.col("v").alias("q")), "query_id").join(known, "entry")
    scored = scored.select("query_id", exact.alias("score"), "ids")
    top = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # an entry brings its smallest k + 1 ids, one of which may be the query's own
    listed = scored.select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    return listed.withColumn("rank", F.row_number().over(top).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
