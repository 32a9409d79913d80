"""Benchmark passages in documents, up to a number of word edits.

Words are runs of letters and digits with A-Z lower-cased. An item of n words matches a document if some
run of the document's words is within ``edits(n)`` insertions, deletions or replacements of it: 15 %, none for items of fewer than
``LEAST`` words, which are matched exactly.

1. Windows of item size start (and, read backwards, end) at every word of every document. Items are put into classes by size,
   a class for each half more, so a window serves all items of a class.
2. Each window is embedded by the CGK random walk, which turns edit distance into Hamming distance: at every step
   the current word is put out, and a random bit of (step, word) says whether to go on to the next word. Half of the walks read backwards.
3. Bit-sampling LSH: each of ``WALKS`` walks has ``TABLES`` tables per class, and each table's key is made of ``SAMPLES`` positions of the walk,
   early ones more often than late ones, as edits throw off what comes after them. Behind a sampled word the walk goes on with the next one, so
   that no word counts twice.
4. Windows and items with an equal key are candidates: keys are joined as Spark tables. Before that a sieve, a bit table of fixed size
   that knows the items' partial and whole keys, ends in the task the walks that cannot give an item's key. It never loses one; more items only
   make it let more through. It is the only thing that goes through the driver.
5. Candidates are verified by exact semi-global edit distance between the item's words and the window with its margins.

Recall at the full number of edits, by item size, is measured in the tests against brute force and given in the README; unchanged passages are always found.

Rows: null and empty texts match nothing, nor do items without words; repeated rows are matched each; a null ``doc_id`` is
kept as it is; an item row that repeats another counts once, and an item of the same text as another matches the same; very long texts are
searched whole, in blocks; other columns are left behind (``without_matches`` keeps them, whatever their names); empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm._common import NO_LETTER, Words, by_bytes, mix, shared_dir, text_buffer, written

RATE = 0.15
LEAST = 8
WALKS = 6
TABLES = 4
SAMPLES = 4
FIRST = 1 << 15  # bits of the sieve for each table's first word
SIEVE = 1 << 21  # bits of the sieve for longer keys
SALT = 16
BLOCK_BYTES = 2 << 20
_PAD = np.uint64(0x5851F42D4C957F2D)
_STEP = np.uint64(0x100000001B3)


def edits(n):
    """Allowed word edits for an item of n words."""
    n = np.asarray(n)
    return np.where(n < LEAST, 0, (RATE * n).astype(int))


def size_class(n: int) -> int:
    """The size of the windows that serve items of n words: at most n and more than two thirds of it."""
    c = LEAST
    while c * 3 // 2 <= n:
        c = c * 3 // 2
    return c


def positions(c: int, walk: int, table: int) -> list[int]:
    """The steps of the walk that a table samples, in order: two near the start, the others over the window."""
    r = np.random.default_rng([c, walk, table])
    first = int(r.integers(0, 4))
    second = first + 1 + int(r.integers(0, 4))
    late = second + 1 + ((2 * c - second - 1) * r.random(SAMPLES - 2) ** 4).astype(int)
    return [first, second, *sorted(late.tolist())]


class Walks:
    """CGK walks over the words of a block of texts, forwards or backwards."""

    def __init__(self, words: Words, backwards: bool):
        counts = words.counts()
        text = np.repeat(np.arange(len(counts)), counts)
        slot = np.arange(len(text)) + text  # an end mark stands behind each text
        self.word = np.full(len(text) + len(counts), _PAD, np.uint64)
        at = np.arange(len(text))
        if backwards:
            at = words.first[text] + words.first[text + 1] - 1 - at
        self.word[slot] = words.hash[at]
        self.slot, self.text, self.end = slot, text, words.first[text + 1] + text
        self.low = (self.word & np.uint64(FIRST - 1)).astype(np.int64)
        self._bits: dict[tuple[int, int], np.ndarray] = {}

    def _of(self, walk: int, part: int) -> np.ndarray:
        if (walk, part) not in self._bits:
            self._bits = {k: v for k, v in self._bits.items() if k[0] == walk}
            self._bits[walk, part] = mix(self.word ^ np.uint64(((walk + 1) * 0x9E3779B97F4A7C15 + part * 0xC2B2AE3D27D4EB4F) % (1 << 64)))
        return self._bits[walk, part]

    def go(self, at: np.ndarray, end: np.ndarray, walk: int, start: int, stop: int) -> np.ndarray:
        for t in range(start, stop):
            at = np.minimum(at + ((self._of(walk, t >> 6)[at] >> np.uint64(t & 63)) & np.uint64(1)).astype(np.int64), end)
        return at


def table_number(c: int, walk: int, table: int) -> int:
    return (c * WALKS + walk) * TABLES + table


def longer(key, word):
    return mix(key * _STEP + word + np.uint64(1))


def short_keys(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all runs of ``size`` words and the places where they lie within one text."""
    grams, whole = words.grams(size)
    return longer(grams, np.uint64(size)), np.flatnonzero(whole)


class Sieve:
    """Which first words each table's items have, and which longer keys there are at all."""

    def __init__(self, classes: list[int], sizes: list[int], slots: np.ndarray):
        self.classes, self.sizes = classes, sizes
        self.slots = slots
        self.first, self.keys = None, None

    def opened(self) -> Sieve:
        if self.keys is None:
            self.keys = np.zeros(SIEVE, bool)
            self.keys[self.slots[self.slots < SIEVE]] = True
            rest = self.slots[self.slots >= SIEVE] - SIEVE
            self.first = {}
            for number in {table_number(c, w, t) for c in self.classes for w in range(WALKS) for t in range(TABLES)}:
                self.first[number] = np.zeros(FIRST, bool)
            for number, bit in zip((rest // FIRST).tolist(), (rest % FIRST).tolist()):
                self.first[number][bit] = True
        return self

    def has(self, key: np.ndarray) -> np.ndarray:
        return self.keys[(key & np.uint64(SIEVE - 1)).astype(np.int64)]


def item_keys(words: Words) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
    """(item, class, size or 0, keys, sieve slots) of each text as an item."""
    ways = [Walks(words, False), Walks(words, True)]
    for i, n in enumerate(words.counts().tolist()):
        if n == 0:
            continue
        if n < LEAST:
            run = Words(words.raw[words.start[words.first[i]] : words.end[words.first[i + 1] - 1]], np.array([0, words.end[words.first[i + 1] - 1] - words.start[words.first[i]]]), separators=NO_LETTER)
            key = short_keys(run, n)[0][:1]
            yield i, 0, n, key, (key & np.uint64(SIEVE - 1)).astype(np.int64)
            continue
        c, keys, slots = size_class(n), [], []
        for walk in range(WALKS):
            way = ways[walk % 2]
            at, end = way.slot[words.first[i] : words.first[i] + 1], way.end[words.first[i] : words.first[i] + 1]
            for table in range(TABLES):
                number, key, t, here = table_number(c, walk, table), None, 0, at
                for k, p in enumerate(positions(c, walk, table)):
                    here, t = way.go(here if k == 0 else np.minimum(here + 1, end), end, walk, t, p), p
                    if k == 0:
                        key = np.full(1, number, np.uint64)
                        slots.append(SIEVE + number * FIRST + int(way.low[here][0]))
                    key = longer(key, way.word[here])
                    if k:
                        slots.append(int(key[0] & np.uint64(SIEVE - 1)))
                keys.append(key[0])
        yield i, c, 0, np.array(keys, np.uint64), np.array(slots, np.int64)


def window_keys(words: Words, sieve: Sieve) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text, first word, last word + 1, key) of the windows, with room for edits, whose key may be an item's; places count from the text's first word."""
    for size in sieve.sizes:
        keys, ok = short_keys(words, size)
        ok = ok[sieve.has(keys[ok])] if len(ok) else ok
        if len(ok):
            text = np.searchsorted(words.first, ok, "right") - 1
            at = ok - words.first[text]
            yield text, at, at + size, keys[ok]
    if not sieve.classes or not len(words.hash):
        return
    ways = [Walks(words, False), Walks(words, True)]
    n_words = words.counts()
    for walk in range(WALKS):
        way = ways[walk % 2]
        at, step, low = way.slot, 0, way.low[way.slot]
        tables = sorted((positions(c, walk, k), c, table_number(c, walk, k)) for c in sieve.classes for k in range(TABLES))
        for places, c, number in tables:
            if places[0] > step:
                at, step = way.go(at, way.end, walk, step, places[0]), places[0]
                low = way.low[at]
            rows = np.flatnonzero(np.take(sieve.first[number], low))
            here, key = at[rows], np.uint64(number)
            key = longer(np.full(len(rows), number, np.uint64), way.word[here])
            for t, p in zip(places, places[1:]):
                here = way.go(np.minimum(here + 1, way.end[rows]), way.end[rows], walk, t, p)
                key = longer(key, way.word[here])
                ok = np.flatnonzero(sieve.has(key))
                rows, here, key = rows[ok], here[ok], key[ok]
            if not len(rows):
                continue
            text, most = way.text[rows], c * 3 // 2
            room = int(RATE * most) + 1
            at_word = rows - words.first[text]
            if walk % 2:  # the window's last word
                last = n_words[text] - at_word
                yield text, np.maximum(last - most - room, 0), np.minimum(last + room, n_words[text]), key
            else:
                yield text, np.maximum(at_word - room, 0), np.minimum(at_word + most + room, n_words[text]), key


def semiglobal(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(edits, start, end) of the run of ``text`` nearest to the item: fewest edits, then the earliest end."""
    m = len(text)
    cost, start = np.zeros(m + 1, np.int64), np.arange(m + 1)
    k = np.arange(m + 1)
    for w in item:
        diagonal = cost[:-1] + (text != w)
        new, new_start = cost + 1, start.copy()
        better = diagonal < new[1:]
        new[1:] = np.where(better, diagonal, new[1:])
        new_start[1:] = np.where(better, start[:-1], start[1:])
        best = np.minimum.accumulate(new - k)  # words of the text left out
        source = np.maximum.accumulate(np.where(new - k == best, k, 0))
        cost, start = best + k, new_start[source]
    end = int(np.argmin(cost))
    return int(cost[end]), int(start[end]), end


def items_table(benchmark: DataFrame, at: str) -> DataFrame:
    """(item_id, item, n, class, size, words, keys, slots) of the items with words; ``item`` is unique."""
    kind = benchmark.schema["item_id"].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            raw, offsets = text_buffer(part.column(1))
            for i, j in by_bytes(offsets, BLOCK_BYTES):
                base = offsets[i]
                words = Words(raw[base : offsets[j]], offsets[i : j + 1] - base, lower=True, separators=NO_LETTER)
                found = list(item_keys(words))
                at = [f[0] for f in found]
                cells = [words.hash[words.first[k] : words.first[k + 1]].tobytes() for k in at]
                as_long = lambda x: x.view(np.int64).tolist()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(at, pa.int64())) if len(at) == 0 else part.column(0).take(pa.array(np.array(at) + i)), pa.array([len(c) // 8 for c in cells], pa.int32()), pa.array([f[1] for f in found], pa.int32()), pa.array([f[2] for f in found], pa.int32()),
                     pa.array(cells, pa.binary()), pa.array([as_long(f[3]) for f in found], pa.list_(pa.int64())), pa.array([f[4].tolist() for f in found], pa.list_(pa.int64()))],
                    ["item_id", "n", "class", "size", "words", "keys", "slots"],
                )

    known = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("text is not null").distinct()
    rows = known.mapInArrow(run, f"item_id {kind}, n int, class int, size int, words binary, keys array<long>, slots array<long>")
    return written(rows.withColumn("item", F.monotonically_increasing_id()), f"{at}/items")


def sieve_of(items: DataFrame) -> Sieve:
    """Collects at most as many numbers as the sieve has bits, however many items there are."""
    groups = items.select("class", "size").distinct().collect()  # a class for each half more
    slots = items.select(F.explode("slots").alias("slot")).distinct().toArrow().column(0).to_numpy()
    return Sieve(sorted({r["class"] for r in groups if r["class"]}), sorted({r["size"] for r in groups if r["size"]}), np.array(slots, np.int64))


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(row, doc_id, text_key, item_id, edits, item_words, first_word, n_words) per document row and item that matches."""
    at = shared_dir(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    items = items_table(benchmark, at)
    sieve = sieve_of(items)

    def windows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known, row = sieve.opened(), TaskContext.get().partitionId() << 40
        for part in parts:
            raw, offsets = text_buffer(part.column(2))
            for i, j in by_bytes(offsets, BLOCK_BYTES):
                base = offsets[i]
                words = Words(raw[base : offsets[j]], offsets[i : j + 1] - base, lower=True, separators=NO_LETTER)
                for text, a, b, key in window_keys(words, known):
                    first = words.first[text]
                    cells = [words.hash[x:y].tobytes() for x, y in zip((first + a).tolist(), (first + b).tolist())]
                    of = pa.array(text + i)
                    yield pa.RecordBatch.from_arrays([pa.array(row + i + text), part.column(0).take(of), part.column(1).take(of), pa.array(a.astype(np.int32)), pa.array(cells, pa.binary()), pa.array(key.view(np.int64))], ["row", "doc_id", "text_key", "start", "window", "key"])
            row += part.num_rows

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    hits = docs.select("doc_id", F.xxhash64(text).alias("text_key"), text.alias("text")).mapInArrow(windows, f"row long, doc_id {kind}, text_key long, start int, window binary, key long")
    hits = written(hits.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALT)).cast("int")), f"{at}/hits")
    # an item that very many documents hold is one key: it is met by SALT copies of the item
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt")
    keys = items.select("item", F.explode("keys").alias("key")).select("item", "key", salts)
    pairs = hits.select("row", "start", "key", "salt", F.octet_length("window").alias("bytes")).join(keys, ["key", "salt"])
    pairs = pairs.groupBy("row", "item", "start", "bytes", "salt").agg(F.count("*").alias("tables"))
    places = hits.groupBy("row", "start", F.octet_length("window").alias("bytes")).agg(F.first("window").alias("window"), F.first("doc_id").alias("doc_id"), F.first("text_key").alias("text_key"))
    sides = items.select("item", "item_id", "n", "words", salts)
    full = pairs.join(places, ["row", "start", "bytes"]).join(sides, ["item", "salt"])

    def verify(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            keep, out = [], []
            for r, (mine, window, start) in enumerate(zip(part.column("words"), part.column("window"), part.column("start").to_pylist())):
                item, own = np.frombuffer(mine.as_buffer(), np.uint64), np.frombuffer(window.as_buffer(), np.uint64)
                cost, x, y = semiglobal(item, own)
                if cost <= int(edits(len(item))):
                    keep.append(r)
                    out.append((cost, start + x, y - x))
            rows = pa.array(keep, pa.int64())
            cells = [pa.array([o[k] for o in out], pa.int32()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*(part.column(c).take(rows) for c in ("row", "doc_id", "text_key", "item", "item_id", "n")), *cells], ["row", "doc_id", "text_key", "item", "item_id", "item_words", "edits", "first_word", "n_words"])

    sure = full.select("row", "doc_id", "text_key", "item", "item_id", "n", "words", "window", "start").mapInArrow(
        verify, f"row long, doc_id {kind}, text_key long, item long, item_id {benchmark.schema['item_id'].dataType.simpleString()}, item_words int, edits int, first_word int, n_words int"
    )
    best = sure.groupBy("row", "item").agg(*(F.first(c).alias(c) for c in ("doc_id", "text_key", "item_id", "item_words")), F.min(F.struct("edits", "first_word", "n_words")).alias("best"))
    return best.select("row", "doc_id", "text_key", "item_id", F.col("best.edits").alias("edits"), "item_words", F.col("best.first_word").alias("first_word"), F.col("best.n_words").alias("n_words"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, edits, item_words, first_word, n_words) per document row and item that matches: the nearest run."""
    return matches(docs, benchmark).select("doc_id", "item_id", "edits", "item_words", "first_word", "n_words")


def without_matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all columns, that match no item."""
    bad = matches(docs, benchmark).select(F.col("doc_id").alias("id"), "text_key").distinct()
    rows = docs.select("doc_id", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("key"), F.struct(*docs.columns).alias("row"))
    return rows.join(bad, rows.doc_id.eqNullSafe(bad.id) & (rows.key == bad.text_key), "left_anti").select("row.*")
