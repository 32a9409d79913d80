"""Exact Jaccard join of documents over word shingles with a token-group matrix.

* Each text becomes the set of hashes of its distinct shingles (tokens); texts with equal sets form a class, which goes on as one member.
* Where to look: two sets of sizes n and m that reach the similarity differ in at most (n + m)(100 - p) / (100 + p) tokens, D in a band
  of sizes. Tokens are dealt by hash into D + 1 + ``SPARE`` parts, so more than ``SPARE`` parts are equal in both. A member lists its parts
  under the scheme of its own band and of the next one (similar sets lie in the same or in adjacent bands); an empty part is listed
  only by members with more than ``SPARE`` of them, which misses nothing. A part is several tokens together, so a passage that many
  documents share lists them together only where all else in the part is shared as well.
* Each list compares its members with a few pivots first, then those outside its largest component with members of that, one a round; a list
  whose members are in one component is done. All this is linear in the lists.
* The token-group matrix serves all other lists: similar members form groups of about ``GROUP`` (those of one component, or of one family of
  lists), and of each group the union of its tokens is kept. A query meets the groups on its lists; the tokens that it shares with a
  group's union bound what it can share with any member, and only groups that reach the overlap which the similarity asks for are opened. An opened
  group's members are compared with its queries on whole sets, batch by batch. Queries are all members but those of a list's largest component.

Nothing here is statistical: every link between different sets is found, or its two ends are in one component already. Lists of one family cost
queries times groups, not pairs.

Rows: null texts and texts without words have an empty set and link with nothing; fewer words than a shingle make one token. Very long
texts are hashed whole, in blocks. Rows that repeat a ``doc_id`` count as one document. A null ``doc_id`` never links (component null). Other
columns are left behind. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm._common import discard, mix, shared_dir, spread_join, written
from docloom.llm.near_dup import _merged, common_counts, pivots, shingle_sets

SHINGLE = 3
PERCENT = 90
SPARE = 1
PIVOTS = 2
ROUNDS = 1
GROUP = 512
GROUP_TOKENS = 1 << 18
QUERIES = 256  # of one group in one task
QUERY_TOKENS = 1 << 20


def bands(percent: int, upto: int) -> np.ndarray:
    """First sizes of the bands: a set of one band is never similar to one beyond the next band."""
    out = [1, 2]
    while out[-2] <= upto:
        out.append(out[-1] * 100 // percent + 1)
    return np.array(out, np.int64)


def part_values(tokens: np.ndarray, band: int, starts: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The values under which a set (sorted distinct uint64) is listed by the scheme of a band; none where similar sets are equal."""
    most = 2 * (int(starts[band + 1]) - 1) * (100 - percent) // (100 + percent)
    if most == 0:
        return np.zeros(0, np.int64)
    parts = most + 1 + SPARE
    part = (mix(tokens ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    part = part[order]
    first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    sums, named = np.add.reduceat(mix(tokens)[order], first), part[first]
    if parts - len(first) > SPARE:
        named = np.append(named, np.setdiff1d(np.arange(parts), named, assume_unique=True))
        sums = np.append(sums, np.zeros(parts - len(first), np.uint64))
    place = named.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(band * 0x2545F4914F6CDD1D % (1 << 64))
    return mix(sums ^ mix(place + np.uint64(1))).view(np.int64)


def signatures(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, own, next): 128 bits of the whole set, and the values listed under its own and the next band."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = bands(percent, 1 << 20)
        for part in parts:
            n, a, b, lists = [], [], [], ([], [])
            for s in shingle_sets(part.column(1), size):
                u = s.view(np.uint64)
                n.append(len(s))
                a.append(int(mix(u).sum(dtype=np.uint64).astype(np.int64)))
                b.append(int(mix(u ^ np.uint64(0xD1B54A32D192ED03)).sum(dtype=np.uint64).astype(np.int64)))
                while len(s) > starts[-3]:
                    starts = np.append(starts, starts[-1] * 100 // percent + 1)
                band = int(np.searchsorted(starts, len(s), "right")) - 1
                for k, found in enumerate(lists):
                    found.append(part_values(u, band + k, starts, percent) if len(s) else np.zeros(0, np.int64))
            arrays = [pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, x)]), pa.int32()), pa.array(np.concatenate(x) if x else [], pa.int64())) for x in lists]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), *arrays], ["doc_id", "n_shingles", "set_a", "set_b", "own", "next"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, n_shingles long, set_a long, set_b long, own array<long>, next array<long>")


def part_lists(classes: DataFrame, at: str) -> DataFrame:
    """(value, node, n, members): lists of at least two members, one of them under its own band."""
    listed = F.concat(F.transform("own", lambda v: F.struct(v.alias("value"), F.lit(1).alias("own"))), F.transform("next", lambda v: F.struct(v.alias("value"), F.lit(0).alias("own"))))
    entries = classes.select("node", "n", F.explode(listed).alias("e")).select("e.value", "node", "n", "e.own")
    counts = written(entries.groupBy("value").agg(F.count("*").alias("members"), F.max("own").alias("any")).where("members > 1 and any = 1").drop("any"), f"{at}/counts")
    # most values have one member and drop out here; adaptive execution splits a long list's side, the other side is one row
    return written(entries.drop("own").join(counts, "value"), f"{at}/lists")


def whole_sets(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """(node, hashes) of the documents in ``nodes``; hashes are sorted 64-bit values as bytes."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([s.tobytes() for s in shingle_sets(part.column(1), size)], pa.binary())], ["node", "hashes"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string").alias("text")).join(nodes, "node", "left_semi")
    return chosen.mapInArrow(run, "node long, hashes binary")


def size_fits(n: Column, m: Column, percent: int) -> Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def _shared(s: bytes, t: bytes) -> tuple[int, int, int]:
    s, t = np.frombuffer(s.as_buffer(), np.int64), np.frombuffer(t.as_buffer(), np.int64)
    return len(np.intersect1d(s, t, assume_unique=True)), len(s), len(t)


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the similarity."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ok = []
            for s, t in zip(part.column("set_a"), part.column("set_b")):
                both, n, m = _shared(s, t)
                ok.append(both > 0 and 100 * both >= percent * (n + m - both))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([part.column("a").filter(keep), part.column("b").filter(keep)], ["a", "b"])

    side = lambda c: sets.select(F.col("node").alias(c), F.col("hashes").alias(f"set_{c}"))
    return pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def open_lists(lists: DataFrame, labels: DataFrame, at: str) -> DataFrame:
    """(value, node, n, component, largest, hub, members) of lists over several components, with the largest of these and the least member."""
    rows = written(lists.join(labels, "node", "left").select("value", "node", "n", F.coalesce("component", "node").alias("component")), f"{at}/labelled")
    counted = rows.groupBy("value", "component").agg(F.count("*").alias("m"), F.min("node").alias("least"))
    several = counted.groupBy("value").agg(F.count("*").alias("components"), F.sum("m").alias("members"), F.min("least").alias("hub"), F.max(F.struct("m", "component")).alias("top")).where("components > 1")
    facts = written(several.select("value", F.col("top.component").alias("largest"), "hub", "members"), f"{at}/several")
    return written(spread_join(rows, facts, ["value"], "members", ["node"]), f"{at}/open")


def star_pairs(rows: DataFrame, percent: int, seed: int) -> DataFrame:
    """(a, b): the members of open lists outside the largest component, each with one member of it, the same one wherever lists share it."""
    inside = F.col("component") == F.col("largest")
    chosen = rows.groupBy("value").agg(F.min(F.when(inside, F.struct(F.xxhash64(F.lit(seed), "node").alias("h"), "node", "n"))).alias("pivot"), F.first("members").alias("members"))
    pivot = chosen.select("value", F.col("pivot.node").alias("pivot"), F.col("pivot.n").alias("m"), F.col("members").alias("w"))
    outside = spread_join(rows.where(~inside).select("value", "node", "n"), pivot, ["value"], "w", ["node"])
    return outside.where(size_fits(F.col("n"), F.col("m"), percent)).select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()


def token_groups(rows: DataFrame, sets: DataFrame, at: str) -> tuple[DataFrame, DataFrame]:
    """(node, n, component, group) and (group, tokens, least, most): groups of similar members and their token unions.

    Components of at least half a group's size have groups of their own, smaller ones go by the least hub of their members' lists."""
    nodes = written(rows.groupBy("node", "n", "component").agg(F.min("hub").alias("hub")), f"{at}/nodes")
    sizes = written(nodes.groupBy("component").agg(F.count("*").alias("size")), f"{at}/sizes")
    own = F.col("size") * 2 >= GROUP
    placed = spread_join(nodes, sizes.withColumn("w", F.col("size")), ["component"], "w", ["node"])
    placed = written(placed.select("node", "n", "component", F.when(own, F.col("component")).otherwise(F.col("hub")).alias("of"), own.alias("whole")), f"{at}/placed")
    dealt = placed.groupBy("of", "whole").agg(F.count("*").alias("size"), F.greatest(F.ceil(F.count("*") / GROUP), F.ceil(F.sum("n") / GROUP_TOKENS)).alias("chunks"))
    members = spread_join(placed, written(dealt, f"{at}/dealt"), ["of", "whole"], "size", ["node"])
    group = F.struct("of", "whole", F.pmod(F.xxhash64(F.lit(3), "node"), "chunks").alias("chunk"))
    members = written(members.select("node", "n", "component", group.alias("group")), f"{at}/members")

    def union(table: pa.Table) -> pa.Table:
        tokens = np.unique(np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in table.column("hashes")]))
        n = table.column("n").to_numpy()
        return pa.table({"of": table.column("of")[:1], "whole": table.column("whole")[:1], "chunk": table.column("chunk")[:1], "tokens": pa.array([tokens.tobytes()], pa.binary()), "least": [int(n.min())], "most": [int(n.max())]})

    flat = members.select("group.*", "n", "node").join(sets, "node").select("of", "whole", "chunk", "n", "hashes")
    unions = flat.groupBy("of", "whole", "chunk").applyInArrow(union, "of long, whole boolean, chunk long, tokens binary, least long, most long")
    return members, written(unions.select(F.struct("of", "whole", "chunk").alias("group"), "tokens", "least", "most"), f"{at}/unions")


def matrix_links(rows: DataFrame, sets: DataFrame, percent: int, at: str) -> DataFrame:
    """Links (a, b) between different components of open lists, through the token-group matrix."""
    members, unions = token_groups(rows, sets, at)
    entries = written(rows.join(members.select("node", "group"), "node"), f"{at}/entries")
    matrix = entries.select("value", "group", F.when(F.col("group.whole"), F.col("component")).alias("all_of")).distinct()
    queries = entries.where("component <> largest").select("value", "node", "n", "component")
    met = queries.join(matrix, "value").where("all_of is null or all_of <> component").select("node", "n", "component", "group").distinct()
    fitting = met.join(unions, "group").where((F.col("least") * percent <= F.col("n") * 100) & (F.col("most") * 100 >= F.col("n") * percent))

    def bound(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ok = []
            for s, u, least in zip(part.column("hashes"), part.column("tokens"), part.column("least").to_pylist()):
                both, n, _ = _shared(s, u)
                smallest = max(least, -(-percent * n // 100))  # a partner's least size
                ok.append(both * (100 + percent) >= percent * (n + smallest))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([part.column(c).filter(keep) for c in ("node", "n", "component", "group")], ["node", "n", "component", "group"])

    names = "node long, n long, component long, group struct<of:bigint,whole:boolean,chunk:bigint>"
    opened = written(fitting.join(sets, "node").select("node", "n", "component", "group", "least", "tokens", "hashes").mapInArrow(bound, names), f"{at}/opened")
    return opened_links(opened, members, sets, percent, at)


def opened_links(opened: DataFrame, members: DataFrame, sets: DataFrame, percent: int, at: str) -> DataFrame:
    """Links (a, b) of queries with members of the groups they open; of a query's links with one component one comes out.

    A group's queries come in batches of bounded size, each to the whole group in one task; pairs never become rows."""
    load = written(opened.groupBy("group").agg(F.count("*").alias("asked"), F.greatest(F.ceil(F.count("*") / QUERIES), F.ceil(F.sum("n") / QUERY_TOKENS)).alias("batches")), f"{at}/load")
    batch = F.pmod(F.xxhash64(F.lit(9), "node"), "batches").cast("int").alias("batch")
    asking = spread_join(opened, load, ["group"], "asked", ["node"]).select("group.*", batch, "node", "component").join(sets, "node")
    asked = members.join(load, "group").select("group.*", F.explode(F.sequence(F.lit(0), F.col("batches").cast("int") - 1)).alias("batch"), "node", "component").join(sets, "node")
    asked = asked.select(*(F.col(c).alias(c) for c in asked.columns))  # columns of its own

    def compare(queries: pa.Table, group: pa.Table) -> pa.Table:
        both = pa.concat_tables([t.select(["node", "component", "hashes"]) for t in (queries, group)])
        node, theirs = both.column("node").to_numpy(), both.column("component").to_numpy()
        parts = [np.frombuffer(x.as_buffer(), np.int64) for c in both.column("hashes").chunks for x in c]
        k, n = len(queries), len(parts)
        size = np.array([len(x) for x in parts])
        common = common_counts(np.concatenate(parts), np.repeat(np.arange(n), size), n)[:k, k:]
        linked = (theirs[:k, None] != theirs[None, k:]) & (100 * common >= percent * (size[:k, None] + size[None, k:] - common)) & (common > 0)
        a, b = [], []
        for i in np.flatnonzero(linked.any(1)):
            found = np.flatnonzero(linked[i]) + k
            one = found[np.unique(theirs[found], return_index=True)[1]]
            a += [node[i]] * len(one)
            b += node[one].tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    keys = ("of", "whole", "chunk", "batch")
    return asking.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(lambda q, g: compare(q, g) if len(q) and len(g) else pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())}), "a long, b long")


def jaccard_join(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row."""
    spark = docs.sparkSession
    at = shared_dir(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    sig = written(signatures(docs, size, percent), f"{at}/signatures")
    keyed = sig.where("n_shingles > 0 and doc_id is not null").groupBy("set_a", "set_b", F.col("n_shingles").alias("n"))
    classes = written(keyed.agg(F.min(F.col("doc_id").cast("long")).alias("node"), F.first("own").alias("own"), F.first("next").alias("next"), F.count("*").alias("copies")), f"{at}/classes")
    lists = part_lists(classes, at)
    sets = written(whole_sets(docs, lists.select("node").distinct(), size), f"{at}/sets")
    chosen = pivots(lists, PIVOTS).groupBy("value").agg(F.collect_list(F.struct("pivot", "pivot_n")).alias("chosen"))  # PIVOTS at most
    met = spread_join(lists.select("value", "node", "n"), written(chosen.join(lists.select("value", "members").distinct(), "value"), f"{at}/chosen"), ["value"], "members", ["node"])
    pairs = met.select("node", "n", F.explode("chosen").alias("p")).where((F.col("p.pivot") != F.col("node")) & size_fits(F.col("n"), F.col("p.pivot_n"), percent))
    pairs = pairs.select(F.least("p.pivot", "node").alias("a"), F.greatest("p.pivot", "node").alias("b")).distinct()
    labels = _merged(spark.createDataFrame([], "node long, component long"), linked(pairs, sets, percent), f"{at}/pivots")
    # lists of at most one member more than pivots have been compared in full
    todo = open_lists(lists.where(F.col("members") > PIVOTS + 1).drop("members"), labels, at)
    for k in range(ROUNDS):
        if todo.isEmpty():
            break
        labels = _merged(labels, linked(star_pairs(todo, percent, k), sets, percent), f"{at}/round{k}")
        todo = open_lists(todo.select("value", "node", "n"), labels, f"{at}/round{k}")
    if not todo.isEmpty():
        labels = _merged(labels, matrix_links(todo, sets, percent, at), f"{at}/groups")
    rep = written(classes.join(labels, "node", "left").select("set_a", "set_b", F.col("n").alias("n_shingles"), "node", "component", "copies"), f"{at}/rep")
    done = ("counts", "lists", "sets", "chosen", "labelled", "several", "open", "nodes", "sizes", "placed", "dealt", "members", "unions", "entries", "opened", "load", "pivots", "groups", "classes", *(f"round{k}" for k in range(ROUNDS)))
    discard(spark, *(f"{at}/{x}" for x in done))
    found = spread_join(sig.select("doc_id", "n_shingles", "set_a", "set_b"), rep, ["set_a", "set_b", "n_shingles"], "copies", ["doc_id"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", F.col("doc_id").cast("long"))).cast(kind)
    return found.select("doc_id", "n_shingles", component.alias("component_id"))
