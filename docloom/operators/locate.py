"""Source pages of text by voting of sliding snippets.

Snippets meet pages by an equi-join on minimisers: of the ``GRAM``-character runs in the first ``SPAN`` characters of a snippet the one
with the least hash; a page lists the least of every such span, so a page that holds a snippet also lists its
minimiser. Only minimisers that some snippet may have leave a page's task. Candidates are verified by containment. The join grows with
the text, not with snippets times pages, and Catalyst broadcasts a side only if its measured size allows it.

The choice of column and width needs no hint (a vote is positive or absent), so only the carried page is sequential: a scan over parts of the
table rows, in ``carried``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.functions.batches import bounded
from docloom.operators.carried import CANDIDATES, REACH, carried, near_hints

WIDTHS = [50, 30, 18]
STEP = 8
SPAN = 18
GRAM = 10
ASKED = 1 << 20  # places of the table of asked minimisers, a power of two
MIN_CHARS = 8


def minimisers(text: str, span: int = SPAN, gram: int = GRAM) -> np.ndarray:
    """The distinct least run hashes of all spans; none for a text shorter than a span."""
    x = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = len(x) - gram + 1
    if len(x) < span:
        return np.zeros(0, np.int64)
    h = np.zeros(n, np.uint64)
    for k in range(gram):
        h = h * np.uint64(0x9E3779B97F4A7C15) + x[k : k + n] + np.uint64(1)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    size, wide = 1, span - gram + 1
    while 2 * size <= wide:  # h: the least of each ``size`` runs
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    if size < wide:
        h = np.minimum(h[: size - wide], h[wide - size :])
    return np.unique(h).view(np.int64)


def _listed(rows: DataFrame, keys: list[str], text: str, asked: np.ndarray | None = None) -> DataFrame:
    """(keys, minimiser) of texts; of those that ``asked`` lacks, none."""
    schema = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in bounded(parts, len(keys)):
            found = [minimisers(t.as_py() or "") for t in part.column(len(keys))]
            if asked is not None:
                found = [f[asked[f & (ASKED - 1)]] for f in found]
            row = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
            yield pa.RecordBatch.from_arrays([*(part.column(k).take(row) for k in range(len(keys))), pa.array(np.concatenate(found) if found else [], pa.int64())], [*keys, "minimiser"])

    return rows.select(*keys, F.col(text)).mapInArrow(run, f"{schema}, minimiser long")


def _asked(keyed: DataFrame) -> np.ndarray:
    """A table of ``ASKED`` places, by the minimisers' low bits: those at which a snippet has one. What a full table lets through the join drops."""
    places = keyed.select(F.col("minimiser").bitwiseAND(F.lit(ASKED - 1)).alias("place")).distinct().toArrow()  # at most ``ASKED`` numbers
    table = np.zeros(ASKED, bool)
    table[places.column("place").to_numpy()] = True
    return table


def snippet_hits(snips: DataFrame, pages: DataFrame, group: list[str]) -> DataFrame:
    """(all of ``snips``, page): the pages (``group``, page, text) that hold each ``snippet``; ``group`` columns must agree."""
    s = snips.withColumn("__first", F.substring("snippet", 1, SPAN))
    firsts = _listed(s.select("__first").distinct(), ["__first"], "__first")
    keyed = s.join(firsts, "__first")
    listed = _listed(pages, [*group, "page"], "text", _asked(firsts))
    pairs = listed.join(keyed, [*group, "minimiser"]).select(*group, "page", F.struct(*snips.columns).alias("s"))
    # a page's candidates meet its text once; they are fewer than the page has runs, times the snippets that share one
    asked = pairs.groupBy(*group, "page").agg(F.collect_set("s").alias("asked"))
    held = asked.join(pages.select(*group, "page", "text"), [*group, "page"]).select("page", F.explode(F.filter("asked", lambda s: F.contains(F.col("text"), s.snippet))).alias("s"))
    return held.select("s.*", "page")


def needle_snippets(needles: DataFrame, keys: list[str], text: str, widths: list[int] = WIDTHS, step: int = STEP) -> DataFrame:
    """(keys, tier, start, snippet) of normalised needles."""
    tiers = [needles.select(*keys, F.lit(t).alias("tier"), F.posexplode(T.snippets(text, w, step)).alias("start", "snippet")) for t, w in enumerate(widths)]
    out = tiers[0]
    for t in tiers[1:]:
        out = out.unionByName(t)
    return out


def votes(hits: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, page, hits, first_start)."""
    return hits.groupBy(*keys, "page").agg(F.count("*").alias("hits"), F.min("start").alias("first_start"))


def best_tier(voted: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The candidates of each key's first ``order`` (column, tier) that has any."""
    first = voted.groupBy(*keys).agg(F.min(F.struct(*order)).alias("__first"))
    return voted.join(first, keys).where(F.struct(*order) == F.col("__first")).drop("__first")


def nearest_hint(rows: DataFrame, group: list[str], order: list[str], parent: str, page: str, reach: int = REACH) -> Column:
    """The page of the nearest other row with one, rows of the same parent first, the earlier row first."""
    w = Window.partitionBy(*group).orderBy(*order)
    at = F.row_number().over(w)
    near = F.collect_list(F.struct("__at", F.col(parent).alias("parent"), F.col(page).alias("page"))).over(w.rowsBetween(-reach, reach))
    usable = F.filter(near, lambda x: x.page.isNotNull() & (x.page != 0) & (x["__at"] != F.col("__at")))
    ranked = F.transform(usable, lambda x: F.struct((~x.parent.eqNullSafe(F.col(parent))).alias("other"), F.abs(x["__at"] - F.col("__at")).alias("away"), (x["__at"] > F.col("__at")).alias("later"), x.page.alias("page")))
    return rows.withColumn("__at", at).withColumn("hint", F.array_min(ranked).page).drop("__at")


def assign_pages(table: DataFrame, pages: DataFrame, group: str, order: str, searched: list[str], source: str = "source", parent: str = "parent_code") -> DataFrame:
    """The table with its ``source`` column tagged and ``page_by`` (kept, text, hint, none): which rows were found by text.

    ``pages`` holds (group, page, text), the text as it stands; both sides are brought to the match key here.
    """
    own = T.strip(F.col(source))
    needles = F.array(*(F.struct(F.lit(k).alias("nth"), T.strip(F.coalesce(F.col(c), F.lit(""))).alias("raw")) for k, c in enumerate([*searched, source])))
    open_rows = table.where(~F.contains(own, F.lit("p.")))
    asked = open_rows.select(group, order, F.inline(needles)).where(F.length("raw") >= MIN_CHARS).select(group, order, "nth", T.match_key("raw").alias("text"))
    keyed = pages.select(group, "page", T.match_key("text").alias("text"))
    keys = [group, order, "nth", "tier"]
    voted = votes(snippet_hits(needle_snippets(asked, [group, order, "nth"], "text"), keyed, [group]), keys)
    best = best_tier(voted, [group, order], ["nth", "tier"]).groupBy(group, order).agg(F.collect_list(F.struct("page", "hits", "first_start")).alias("candidates"))
    numbered = table.withColumns({"has_page": F.contains(own, F.lit("p.")), "kept": T.page_marker(source), "__own": T.first_integer(T.after_last(source, "p. "))})
    hinted = near_hints(numbered.select(group, order, parent, "has_page", "kept", "__own"), group, [order], parent, "__own").join(best, [group, order], "left")
    rows = hinted.withColumn("candidates", F.coalesce(F.col("candidates").cast(CANDIDATES), F.array().cast(CANDIDATES)))
    placed = carried(rows, group, order).withColumnsRenamed({"page": "__page", "previous": "__previous", "by": "page_by"})
    tag = T.page_tag("__previous", "__page")
    tagged = table.join(placed, [group, order])
    new = F.when((F.col("page_by") == "kept") | F.col("__page").isNull(), F.col(source)).otherwise(T.with_tag(own, tag))
    return tagged.withColumn(source, new).select(*table.columns, "page_by")
