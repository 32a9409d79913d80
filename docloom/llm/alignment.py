"""Alignment of two tokenizers over the bytes of each text, by products of sparse incidence matrices.

Each tokenizer gives a token-byte incidence matrix of the text (a space in front): row = token occurrence, column = byte. In row form
(``Csr``), Gustavson's product A x B-transposed goes through the rows of A and gathers the rows of B-transposed that a row's columns name:
its entries are the token pairs whose bytes overlap, its values the shared bytes. Bytes where tokens of both end cut the text into groups;
the product of the group incidences, counted row by row, gives the pairs that share a group.

1. Texts are encoded once, in blocks of about ``BLOCK_BYTES``. Per text the block keeps its own figures and its distinct linked id pairs
   as codes into the block's dictionary, per block each distinct pair with its number of texts.
2. The dictionaries are added up to corpus-wide counts per pair and the highest count per A id.
3. Each block gets the counts of its own pairs back and reads its texts' codes against them. What moves is a block's vocabulary and its codes;
   texts and token ids are not shuffled.

Rows: texts null, empty, or whose joined token bytes differ from space and text have no tokens: zeros and ''. Each row counts as a document of its
own, repeated or not. Very long texts are encoded in pieces cut where no token can reach over. Other columns are left behind, an empty table gives an
empty result, a null ``doc_id`` comes back as it is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm._common import by_bytes, shared_dir, text_buffer, written
from docloom.llm.tokens import Encoder, _byte_of_char

PIECES = "piece_bpe_32k.model"
BATCH_BYTES = 1 << 20
BLOCK_BYTES = 8 << 20
CACHED = 1 << 18  # units whose pieces a worker remembers
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_group_links"]


class Csr:
    """A zero-one matrix by rows: ``indices[indptr[i] : indptr[i + 1]]`` are the columns of row i, ascending."""

    def __init__(self, indptr: np.ndarray, indices: np.ndarray, width: int):
        self.indptr, self.indices, self.width = indptr, indices, width

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))


def row_counts(a: Csr, b: Csr) -> np.ndarray:
    """For each row of A the number of terms of A x B: its entries, where no two of A's columns lead to the same column."""
    sums = np.append(0, np.cumsum(np.diff(b.indptr)[a.indices]))
    return sums[a.indptr[1:]] - sums[a.indptr[:-1]]


def gustavson(a: Csr, b: Csr) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, value) of A x B, row by row: each column of a row of A calls up that row of B, and equal columns add up."""
    terms = np.diff(b.indptr)[a.indices]
    first = np.cumsum(terms) - terms
    column = b.indices[np.arange(int(terms.sum())) - np.repeat(first - b.indptr[a.indices], terms)]
    row = np.repeat(a.rows(), terms)
    back = np.flatnonzero((row[1:] == row[:-1]) & (column[1:] < column[:-1]))
    if len(back):  # rows whose terms do not come in order
        order = np.lexsort((column, row))
        row, column = row[order], column[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (column[1:] != column[:-1])
    at = np.flatnonzero(new)
    return row[at], column[at], np.diff(np.append(at, len(row)))


class PlainEncoder(Encoder):
    """Byte-level ids in which the strings of special tokens are plain text, and the bytes of each id."""

    def __init__(self, path: str):
        super().__init__(path)
        self.lib.encode_special_tokens = True
        byte = _byte_of_char()
        size = self.lib.get_vocab_size()
        self.bytes = [bytes(byte[c] for c in t) if all(c in byte for c in t) else t.encode() for t in (self.lib.id_to_token(i) or "" for i in range(size))]

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        if self.core:
            return [self.core.encode_to_numpy(t, allowed_special=set(), disallowed_special=()) for t in texts]
        return [np.asarray(e.ids, np.uint32) for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]


class PieceEncoder:
    """Ids of a sentencepiece model, and the bytes of each id.

    Where no piece has a space after another character and none has a line feed, pieces never reach over a cut in front of a run of spaces or
    on either side of a line feed; such units are encoded once and remembered. A self-test compares with the library; without it whole texts are encoded.
    """

    _UNIT = re.compile(r"\n| *[^ \n]+| +")
    _PROBE = ["It's  a test,\n\n of\tnumbers 12 345 and   \r\n we'll see\xa0 　x<s> été 日本語 🙂!  ", " lead", "\nline\n \n  two", "a", "tail \n", "one two one two"]

    def __init__(self, path: str):
        import sentencepiece

        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.lib.get_piece_size()
        names = [self.lib.id_to_piece(i) for i in range(n)]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.lib.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        self.known: dict[str, tuple[int, ...]] = {}
        self.by_unit = not any(re.search("[^▁]▁|\n", p) for p in names)
        if self.by_unit:
            self.lead = len(self.lib.encode("\n"))
            self.by_unit = all(self._units(t).tolist() == self.lib.encode(t) for t in self._PROBE)

    def _unit(self, unit: str) -> tuple[int, ...]:
        """A unit's ids: the library puts a space in front, which is the unit's own first one, or is kept off by a line feed and dropped."""
        found = tuple(self.lib.encode(unit[1:]) if unit[0] == " " and len(unit) > 1 else self.lib.encode("\n" + unit)[self.lead :])
        if len(self.known) < CACHED and len(unit) <= 64:
            self.known[unit] = found
        return found

    def _units(self, text: str) -> np.ndarray:
        known = self.known.get
        return np.fromiter(chain.from_iterable(known(u) or self._unit(u) for u in self._UNIT.findall(" " + text)), np.uint32)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        if self.by_unit:
            return [self._units(t) if t else np.zeros(0, np.uint32) for t in texts]
        return [np.asarray(x, np.uint32) for x in self.lib.encode(texts, num_threads=1)]


class Aligned:
    """The alignment of a batch of texts as one block-diagonal problem: token bytes never reach over a text's end."""

    def __init__(self, a_ids: list[np.ndarray], b_ids: list[np.ndarray], a_size: np.ndarray, b_size: np.ndarray):
        n = len(a_ids)
        joined = lambda x: np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)
        self.a, self.b = joined(a_ids), joined(b_ids)
        self.a_doc, self.b_doc = (np.repeat(np.arange(n), [len(x) for x in ids]) for ids in (a_ids, b_ids))
        a_end, b_end = np.cumsum(a_size[self.a]), np.cumsum(b_size[self.b])
        width = int(a_end[-1]) if len(a_end) else 0
        a = Csr(np.append(0, a_end), np.arange(width), width)
        b_turned = Csr(np.arange(width + 1), np.repeat(np.arange(len(self.b)), b_size[self.b]), len(self.b))
        self.left, self.right, _ = gustavson(a, b_turned)
        ends = np.intersect1d(a_end, b_end, assume_unique=True)
        self.a_group, self.b_group = np.searchsorted(ends, a_end), np.searchsorted(ends, b_end)
        turned = Csr(np.searchsorted(self.b_group, np.arange(len(ends) + 1)), np.arange(len(self.b)), len(self.b))
        in_group = row_counts(Csr(np.arange(len(self.a) + 1), self.a_group, len(ends)), turned)
        count = lambda doc, w=None: np.bincount(doc, w, minlength=n).astype(np.int64)
        group_doc = self.a_doc[np.searchsorted(self.a_group, np.arange(len(ends)))] if len(ends) else np.zeros(0, np.int64)
        self.figures = [count(self.a_doc), count(self.b_doc), count(group_doc), count(self.a_doc[self.left]), count(self.a_doc, in_group)]
        self.n, self.b_before = n, turned.indptr

    def listed_groups(self) -> list[str]:
        """Each text's groups as ``a1,a2|b1;a3|b2``."""
        a_before = np.searchsorted(self.a_group, np.arange(len(self.b_before)))
        order = np.empty(len(self.a) + len(self.b), np.int64)
        next_a, next_b = (np.append(g[1:] != g[:-1], True) if len(g) else np.zeros(0, bool) for g in (self.a_group, self.b_group))
        last_b = np.append(self.b_doc[1:] != self.b_doc[:-1], True) if len(self.b) else np.zeros(0, bool)
        order[np.arange(len(self.a)) + self.b_before[self.a_group]] = self.a * 4 + np.where(next_a, 1, 0)
        order[np.arange(len(self.b)) + a_before[self.b_group + 1]] = self.b * 4 + np.where(last_b, 3, np.where(next_b, 2, 0))
        ends = np.cumsum(self.figures[0] + self.figures[1]).tolist()
        words = list(map(_WORDS.__getitem__, order.tolist()))
        return ["".join(words[i:j]) for i, j in zip([0, *ends], ends)]

    def linked_pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair, links) of distinct id pairs in order; a pair is ``a << 32 | b``."""
        pair = self.a[self.left] << 32 | self.b[self.right]
        order = np.lexsort((pair, self.a_doc[self.left])) if self.n > 1 else np.argsort(pair, kind="stable")
        doc, pair = self.a_doc[self.left][order], pair[order]
        new = np.ones(len(pair), bool)
        new[1:] = (pair[1:] != pair[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(new)
        return doc[at], pair[at], np.diff(np.append(at, len(pair)))


class _Words(dict):
    """An id with the mark after it, by ``id * 4 + mark``."""

    def __missing__(self, key: int) -> str:
        word = self[key] = str(key >> 2) + (",", "|", ";", "")[key & 3]
        return word


_WORDS = _Words()


def packed(codes: np.ndarray, links: np.ndarray) -> bytes:
    """Ascending codes as steps, and links, byte plane by byte plane, compressed."""
    planes = np.stack([np.diff(codes, prepend=0), links]).astype("<u4").view(np.uint8).reshape(-1, 4).T
    return pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unpacked(data: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(pa.decompress(data, decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint8)
    steps, links = np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").reshape(2, n).astype(np.int64)
    return np.cumsum(steps), links


def encoded(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """Rows of two kinds: texts (block, doc_id, figures, groups_sha256, n_codes, codes), and block dictionaries (block, pair, docs)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    figures = ", ".join(f"{c} long" for c in COLUMNS)
    schema = f"block long, doc_id {kind}, {figures}, groups_sha256 string, n_codes int, codes binary, pair long, docs long"
    names = ["block", "doc_id", *COLUMNS, "groups_sha256", "n_codes", "codes", "pair", "docs"]
    id_type: list = []

    def batch_of(block: int, rows: list, pairs: list) -> Iterator[pa.RecordBatch]:
        doc_ids = pa.concat_arrays([r[0] for r in rows])
        n = len(doc_ids)
        per_doc = [p for r in pairs for p in r]
        found = np.concatenate([p for p, _ in per_doc]) if per_doc else np.zeros(0, np.int64)
        book, code, uses = np.unique(found, return_inverse=True, return_counts=True)
        cuts = np.cumsum([0, *(len(p) for p, _ in per_doc)])
        codes = [packed(code[i:j], links) for i, j, (_, links) in zip(cuts, cuts[1:], per_doc)]
        figures = [np.concatenate([r[1][k] for r in rows]) for k in range(len(COLUMNS))]
        empty = lambda m, t: pa.nulls(m, t)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, block)), doc_ids, *map(pa.array, figures), pa.array([s for r in rows for s in r[2]], pa.string()), pa.array(np.diff(cuts), pa.int32()), pa.array(codes, pa.binary()), empty(n, pa.int64()), empty(n, pa.int64())], names
        )
        m = len(book)
        if m:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(m, block)), empty(m, id_type[0]), *(empty(m, pa.int64()) for _ in COLUMNS), empty(m, pa.string()), empty(m, pa.int32()), empty(m, pa.binary()), pa.array(book), pa.array(uses, pa.int64())], names
            )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        a, b = PlainEncoder(byte_path), PieceEncoder(piece_path)
        a_size, b_size = (np.array([len(x) for x in e.bytes], np.int64) for e in (a, b))
        block, held, rows, pairs = TaskContext.get().partitionId() << 32, 0, [], []
        for part in parts:
            id_type[:] = [part.column(0).type]
            _, offsets = text_buffer(part.column(1))
            for i, j in by_bytes(offsets, BATCH_BYTES):
                texts = [t or "" for t in part.column(1).slice(i, j - i).to_pylist()]
                whole = [(" " + t).encode() if t else b"" for t in texts]
                a_ids = a.ids([" " + t if t else "" for t in texts])
                b_ids = b.ids(texts)
                for k, want in enumerate(whole):
                    if any(b"".join(map(e.bytes.__getitem__, ids[k].tolist())) != want for e, ids in ((a, a_ids), (b, b_ids))):
                        a_ids[k] = b_ids[k] = np.zeros(0, np.int64)
                found = Aligned(a_ids, b_ids, a_size, b_size)
                shown = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in found.listed_groups()]
                doc, pair, links = found.linked_pairs()
                at = np.searchsorted(doc, np.arange(j - i + 1))
                rows.append((part.column(0).slice(i, j - i), found.figures, shown))
                pairs.append([(pair[x:y], links[x:y]) for x, y in zip(at, at[1:])])
                held += int(offsets[j] - offsets[i])
                if held >= BLOCK_BYTES:
                    yield from batch_of(block, rows, pairs)
                    block, held, rows, pairs = block + 1, 0, [], []
        if rows:
            yield from batch_of(block, rows, pairs)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def pair_counts(dictionaries: DataFrame) -> DataFrame:
    """(pair, n, best): in how many documents an id pair is linked, and whether no pair of its A id is in more."""
    counts = dictionaries.groupBy("pair").agg(F.sum("docs").alias("n"))
    top = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("n").alias("top"))
    return counts.withColumn("a", F.shiftright("pair", 32)).join(top, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def alignment(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_group_links) per row."""
    at = shared_dir(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    both = written(encoded(docs, byte_path, piece_path), f"{at}/encoded")
    books = both.where("pair is not null").select("block", "pair", "docs")
    counts = written(pair_counts(books), f"{at}/counts")
    known = books.select(F.col("block").alias("of"), "pair").join(counts, "pair").select("of", "pair", "n", "best")
    texts = both.where("pair is null").drop("pair", "docs")
    names = ["doc_id", *COLUMNS, "n_best", "count_sum", "groups_sha256"]

    def read(texts: pa.Table, known: pa.Table) -> pa.Table:
        order = np.argsort(known.column("pair").to_numpy(), kind="stable")
        n, best = known.column("n").to_numpy()[order], known.column("best").to_numpy()[order].astype(np.int64)
        n_best, total = [], []
        for size, data in zip(texts.column("n_codes").to_pylist(), texts.column("codes").to_pylist()):
            code, links = unpacked(data, size) if size else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            n_best.append(int(links @ best[code]))
            total.append(int(links @ n[code]))
        out = texts.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(total, pa.int64()))
        return out.select(names)

    figures = ", ".join(f"{c} long" for c in [*COLUMNS, "n_best", "count_sum"])
    return texts.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(read, f"doc_id {kind}, {figures}, groups_sha256 string")
