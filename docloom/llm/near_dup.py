"""Near-duplicate documents by bottom-k sketches of one hash function, verified exactly.

* Each text becomes the set of hashes of its distinct five-word shingles; its sketch is the k
  smallest. Texts with equal sets form a class, which goes on as one member.
* Inverted lists of retained values: two sets of similarity t share about ``t * k`` values, surely (but
  for about three in a million at the threshold itself) ``OVERLAP`` of 32. So a class is listed under
  its ``k - OVERLAP + 1`` rarest values only, by their number of classes: similar classes still
  meet, while classes that merely share frequent passages do not.
* No list gives all its pairs. Each list compares its members with a few pivots; a list
  whose members are all in one component, or have all been compared, is done. Lists still open are
  joined up to families where that saves work, and compared in blocks: overlaps of retained values first, whole sets of those
  that may reach the similarity then; each pair of blocks gives a spanning forest of the links between different components.
* Candidates are filtered by the union sketch (the k smallest of both sets), then their whole
  sets are compared. Links are merged by star contraction on written tables.

The bounds on overlaps and estimates lie 4.6 and more standard deviations below what sets at the threshold have; the tests measure the share
of true links found against brute force.

Rows: null texts and texts without words have an empty set and link with nothing. Fewer than five
words make one shingle. Very long texts are hashed whole, in blocks. Rows that repeat a ``doc_id`` count as one document. A null ``doc_id`` never links
(component null, kept). Other columns are left behind. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm._common import Words, by_bytes, discard, mix, shared_dir, spread_join, text_buffer, written
from docloom.llm.components import components

SHINGLE = 5
PERCENT = 75
INDEX_K = 32  # retained values that are listed
SKETCH_K = 64  # retained values for the union-sketch estimate
OVERLAP = 12  # of INDEX_K: what similar sets share at least
ESTIMATE = 0.5  # least union-sketch estimate, 4.6 standard deviations below the threshold
PIVOTS = 2
BLOCK = 256
BLOCK_BYTES = 1 << 20


def shingle_sets(col: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Per text the sorted distinct shingle hashes (int64)."""
    raw, offsets = text_buffer(col)
    for i, j in by_bytes(offsets, BLOCK_BYTES):
        base = offsets[i]
        words = Words(raw[base : offsets[j]], offsets[i : j + 1] - base, lower=True)
        grams, _ = words.grams(size)
        first = words.first.tolist()
        for a, b in zip(first, first[1:]):
            n = b - a
            if n >= size:
                yield np.unique(grams[a : b - size + 1].view(np.int64))
            elif n:
                h = np.uint64(n)
                for w in words.hash[a:b]:
                    h = mix(np.array([h ^ w]))[0] * np.uint64(31)
                yield np.array([h]).view(np.int64)
            else:
                yield np.zeros(0, np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, sketch): set_a and set_b are 128 bits of the whole set."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            n, a, b, values, ends = [], [], [], [], [0]
            for s in shingle_sets(part.column(1)):
                u = s.view(np.uint64)
                n.append(len(s))
                a.append(int(mix(u).sum(dtype=np.uint64).astype(np.int64)))
                b.append(int(mix(u ^ np.uint64(0xD1B54A32D192ED03)).sum(dtype=np.uint64).astype(np.int64)))
                values.append(s[:SKETCH_K])
                ends.append(ends[-1] + len(values[-1]))
            sketch = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(values) if values else [], pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), sketch], ["doc_id", "n_shingles", "set_a", "set_b", "sketch"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, n_shingles long, set_a long, set_b long, sketch array<long>")


def required_overlap(n):
    """Values that a sketch of n listed values shares at least with that of a similar set."""
    return F.greatest(F.lit(1), F.least(F.lit(OVERLAP), F.floor(n / 2))).cast("int")


def inverted_lists(classes: DataFrame, at: str) -> DataFrame:
    """(value, node, n, members, rank): the lists with at least two classes, under each class's rarest values."""
    post = classes.select("node", "n", F.explode(F.slice("sketch", 1, INDEX_K)).alias("value"))
    shared = written(post.groupBy("value").agg(F.count("*").alias("c")).where("c > 1"), f"{at}/shared")
    listed = F.least(F.col("n"), F.lit(INDEX_K))
    per_node = (
        spread_join(post, shared.withColumn("w", F.col("c")), ["value"], "w", ["node"])
        .groupBy("node", "n")
        .agg(F.sort_array(F.collect_list(F.struct("c", "value"))).alias("values"))  # INDEX_K at most
        .withColumn("take", listed - required_overlap(listed) + 1 - (listed - F.size("values")))
        .where("take > 0")
    )
    rare = per_node.select("node", "n", F.explode(F.slice(F.col("values.value"), F.lit(1), F.col("take").cast("int"))).alias("value"))
    rare = written(rare, f"{at}/rare")
    counts = written(rare.groupBy("value").agg(F.count("*").alias("members")).where("members > 1"), f"{at}/counts")
    lists = written(spread_join(rare, counts, ["value"], "members", ["node"]), f"{at}/lists")
    discard(lists.sparkSession, f"{at}/shared", f"{at}/rare", f"{at}/counts")
    return lists


def pivots(lists: DataFrame, upto: int) -> DataFrame:
    """(value, pivot, pivot_n, rank) for the first ``upto`` members of each list in a hash order."""
    order = Window.partitionBy("value").orderBy(F.xxhash64("node"), "node")
    return lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= upto).select("value", F.col("node").alias("pivot"), F.col("n").alias("pivot_n"), "rank")


def size_fits(n, m):
    return F.least(n, m) * 100 >= F.greatest(n, m) * PERCENT


def estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose union-sketch estimate reaches ``ESTIMATE``."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ok = np.zeros(part.num_rows, bool)
            sides = []
            for name in ("sketch_a", "sketch_b"):
                col = part.column(name)
                offs = col.offsets.to_numpy()
                sides.append((col.values.to_numpy(zero_copy_only=False), offs))
            (va, oa), (vb, ob) = sides
            for i in range(part.num_rows):
                s, t = va[oa[i] : oa[i + 1]], vb[ob[i] : ob[i + 1]]
                both = np.sort(np.concatenate([s, t]))
                twice = np.flatnonzero(both[1:] == both[:-1])
                union = len(both) - len(twice)
                if len(s) < SKETCH_K and len(t) < SKETCH_K:  # whole sets
                    ok[i] = len(twice) * 100 >= PERCENT * union
                else:
                    k = min(SKETCH_K, union)
                    # the k-th smallest of the union: count how many of the smallest k are in both
                    distinct = np.delete(both, twice)
                    within = np.searchsorted(both[twice], distinct[k - 1], "right") if k else 0
                    ok[i] = within >= ESTIMATE * k
            keep = pa.array(ok)
            yield pa.RecordBatch.from_arrays([part.column("a").filter(keep), part.column("b").filter(keep)], ["a", "b"])

    sketches = classes.select("node", "sketch")
    joined = pairs.join(sketches.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a")), "a").join(
        sketches.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_b")), "b"
    )
    return joined.select("a", "b", "sketch_a", "sketch_b").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose whole sets reach the similarity."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ok = []
            for s, t in zip(part.column("set_a"), part.column("set_b")):
                s, t = np.frombuffer(s.as_buffer(), np.int64), np.frombuffer(t.as_buffer(), np.int64)
                inter = len(np.intersect1d(s, t, assume_unique=True))
                ok.append(100 * inter >= PERCENT * (len(s) + len(t) - inter) and inter > 0)
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([part.column("a").filter(keep), part.column("b").filter(keep)], ["a", "b"])

    joined = pairs.join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("set_b")), "b").join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("set_a")), "a")
    return joined.select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def whole_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, hashes) of the documents in ``nodes``; hashes are sorted 64-bit values as bytes."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([s.tobytes() for s in shingle_sets(part.column(1))], pa.binary())], ["node", "hashes"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string").alias("text")).join(nodes, "node", "left_semi")
    return chosen.mapInArrow(run, "node long, hashes binary")


def labelled(lists: DataFrame, labels: DataFrame, at: str) -> DataFrame:
    """Lists whose members are in several components, with each member's component."""
    comp = F.coalesce("component", "node")
    rows = written(lists.join(labels, "node", "left").select("value", "node", "n", comp.alias("component")), f"{at}/labelled")
    open_ = rows.groupBy("value").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.min("node").alias("hub"), F.count("*").alias("m")).where("x <> y").select("value", "hub", "m")
    return spread_join(rows, written(open_, f"{at}/open"), ["value"], "m", ["node"])


def groups(rows: DataFrame, at: str) -> DataFrame:
    """(group, node, component, members): open lists (rows with their list's least node ``hub`` and size ``m``), or what they join up to where that is less work.

    The lists of one family of near copies have nearly the same members, so comparing within the
    family once is cheaper than within each list; lists that only chain are left as they are.
    """
    family = components(rows.select(F.col("node").alias("a"), F.col("hub").alias("b")), f"{at}/families")
    family = written(family.select("node", F.col("component").alias("family")), f"{at}/family")
    lists = rows.select("value", "hub", "m").distinct().join(family.withColumnRenamed("node", "hub"), "hub").select("value", F.col("m").alias("size_of_list"), "family")
    lists = written(lists, f"{at}/of_family")
    by_list = lists.groupBy("family").agg(F.sum(F.col("size_of_list").cast("double") * F.col("size_of_list")).alias("work"), F.count("*").alias("lists"))
    size = family.groupBy("family").agg(F.count("*").alias("size"))
    whole = size.join(by_list, "family").select("family", "size", "lists", (F.col("size").cast("double") * F.col("size") <= F.col("work")).alias("whole"))
    known = spread_join(lists, written(whole, f"{at}/whole"), ["family"], "lists", ["value"])
    members = spread_join(rows.select("value", "node", "component", "m"), written(known, f"{at}/known"), ["value"], "size_of_list", ["node"])
    return members.select(
        F.when(F.col("whole"), F.struct(F.lit(0).alias("kind"), F.col("family").alias("id"))).otherwise(F.struct(F.lit(1).alias("kind"), F.col("value").alias("id"))).alias("group"),
        "node",
        "component",
        F.when(F.col("whole"), F.col("size")).otherwise(F.col("m")).alias("members"),
    ).distinct()


def common_counts(hashes: np.ndarray, owner: np.ndarray, n: int, width: int = 4096) -> np.ndarray:
    """How many hashes each two of ``n`` sets share, by products of incidence matrices ``width`` columns wide."""
    order = np.argsort(hashes, kind="stable")
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1
    owner, column = owner[shared], column[shared]
    if len(column):
        column = np.cumsum(np.append(True, column[1:] != column[:-1])) - 1
    out = np.zeros((n, n), np.float32)
    for a in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [a, a + width])
        has = np.zeros((n, width), np.float32)
        has[owner[lo:hi], column[lo:hi] - a] = 1
        out += has @ has.T
    return out


def block_links(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between different components within a group, verified on whole sets.

    A group is cut into blocks by hash and each pair of blocks is compared in one task of bounded size;
    of the links found there only a spanning forest comes out, never all pairs."""
    placed = (
        rows.withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
        .withColumn("mine", F.pmod(F.xxhash64(F.lit(7), "node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("group", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"), "mine", "node", "component")
        .join(sets, "node")
    )

    def compare(table: pa.Table) -> pa.Table:
        node, comp, mine = (table.column(c).to_numpy() for c in ("node", "component", "mine"))
        parts = [np.frombuffer(x.as_buffer(), np.int64) for x in table.column("hashes")]
        # overlaps of retained values say who may be linked at all; only these sets are compared whole
        kept = [np.sort(x)[:SKETCH_K] for x in parts]
        size, held, n = np.array([len(x) for x in parts]), np.array([len(x) for x in kept]), len(node)
        overlap = common_counts(np.concatenate(kept), np.repeat(np.arange(n), held), n)
        union = np.minimum(SKETCH_K, size[:, None] + size[None, :] - overlap)
        maybe = (overlap >= ESTIMATE * union) & (comp[:, None] != comp[None, :])
        if table.column("lo")[0] != table.column("hi")[0]:
            maybe &= mine[:, None] != mine[None, :]
        some = np.flatnonzero(maybe.any(1))
        if not len(some):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        node, size, maybe, n = node[some], size[some], maybe[np.ix_(some, some)], len(some)
        common = common_counts(np.concatenate([parts[i] for i in some]), np.repeat(np.arange(n), size), n)
        linked = maybe & (100 * common >= PERCENT * (size[:, None] + size[None, :] - common)) & (common > 0)
        a, b, seen = [], [], np.zeros(n, bool)
        for first in np.flatnonzero(linked.any(1)):
            todo = [] if seen[first] else [first]
            seen[first] = True
            while todo:
                i = todo.pop()
                new = np.flatnonzero(linked[i] & ~seen)
                seen[new] = True
                todo += new.tolist()
                a += [node[i]] * len(new)
                b += node[new].tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return placed.select("group", "lo", "hi", "mine", "node", "component", "hashes").groupBy("group", "lo", "hi").applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row."""
    spark = docs.sparkSession
    at = shared_dir(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    sig = written(signatures(docs), f"{at}/signatures")
    classes = written(
        sig.where("n_shingles > 0 and doc_id is not null")
        .groupBy("set_a", "set_b", F.col("n_shingles").alias("n"))
        .agg(F.min(F.col("doc_id").cast("long")).alias("node"), F.first("sketch").alias("sketch"), F.count("*").alias("copies")),
        f"{at}/classes",
    )
    lists = inverted_lists(classes, at)
    sets = written(whole_sets(docs, lists.select("node").distinct()), f"{at}/sets")
    chosen = pivots(lists, PIVOTS).groupBy("value").agg(F.collect_list(F.struct("pivot", "pivot_n")).alias("chosen"), F.count("*").alias("pivots"))  # PIVOTS at most
    sizes = lists.select("value", "members").distinct()
    met = spread_join(lists.select("value", "node", "n"), written(chosen.join(sizes, "value"), f"{at}/chosen"), ["value"], "members", ["node"])
    pairs = met.select("node", "n", F.explode("chosen").alias("p")).where((F.col("p.pivot") != F.col("node")) & size_fits(F.col("n"), F.col("p.pivot_n")))
    pairs = pairs.select(F.least("p.pivot", "node").alias("a"), F.greatest("p.pivot", "node").alias("b")).distinct()
    labels = _merged(spark.createDataFrame([], "node long, component long"), verified(estimated(pairs, classes), sets), f"{at}/pivots")
    # lists of at most one member more than pivots have been compared in full
    todo = written(labelled(lists.where(F.col("members") > PIVOTS + 1), labels, at), f"{at}/todo")
    if not todo.isEmpty():
        labels = _merged(labels, block_links(groups(todo, at), sets), f"{at}/blocks")
    rep = classes.join(labels, "node", "left").select("set_a", "set_b", F.col("n").alias("n_shingles"), "node", "component", "copies")
    rep = written(rep, f"{at}/rep")
    discard(spark, *(f"{at}/{x}" for x in ("lists", "sets", "chosen", "labelled", "open", "todo", "families", "family", "of_family", "whole", "known", "pivots", "blocks", "classes")))
    found = spread_join(sig.select("doc_id", "n_shingles", "set_a", "set_b"), rep, ["set_a", "set_b", "n_shingles"], "copies", ["doc_id"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", F.col("doc_id").cast("long"))).cast(kind)
    return found.select("doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept"))


def _merged(labels: DataFrame, links: DataFrame, at: str) -> DataFrame:
    """Labels (node, component) after further links."""
    side = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(f"{c}_component"))
    links = links.join(side("a"), "a", "left").join(side("b"), "b", "left")
    edges = links.select(F.coalesce("a_component", "a").alias("a"), F.coalesce("b_component", "b").alias("b"))
    new = components(edges, f"{at}/stars")
    moved = labels.join(new.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return written(moved.unionByName(new.join(labels, "node", "left_anti")).distinct(), f"{at}/labels")
