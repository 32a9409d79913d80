"""The page that goes from row to row of a manual, as a scan over parts, and hints from rows near by; one manual may hold most rows.

A row that names its page, or whose candidates are one page, sets the page whatever came before: such rows cut a manual into stretches. What stands before a part's
first row with candidates keeps a page or takes the first hint; that row's choice among its few candidates is the only place where the incoming page counts, and for each
of its outcomes it is known what the part's last page is.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.operators.scan import Rule, arrow, in_parts, prefix_states, rows_of, with_state
from docloom.sources.files import scratch, stored

NEAR, NEAR_WEIGHT = 8, 2.5
FAR, FAR_WEIGHT = 60, 0.15
REACH = 29
BIN = 1024  # rows that look for a hint together

CANDIDATES = "array<struct<page:bigint,hits:bigint,first_start:int>>"
_SUMMARY = f"struct<none:bigint,zero:bigint,candidates:{CANDIDATES},hint:bigint,outs:array<struct<page:bigint,to:bigint>>>"


def choose(candidates: list[dict], hint: int | None) -> int:
    """The best page: most votes, weighted by the distance to the hint, then nearest to the hint, then first seen."""

    def rank(c: dict) -> tuple:
        away = None if hint is None else abs(c["page"] - hint)
        weight = 1.0 if away is None else NEAR_WEIGHT if away <= NEAR else FAR_WEIGHT if away > FAR else 1.0
        return -c["hits"] * weight, abs(c["page"] - (hint or 0)), c["first_start"], c["page"]

    return min(candidates, key=rank)["page"]


def placed(carried: int | None, row: dict) -> tuple[int | None, str]:
    """(page, by) of a row that the carried page comes to."""
    if row["has"]:
        return row["kept"], "kept"
    hint = carried or row["hint"]
    if row["c"]:
        return choose(row["c"], hint), "text"
    return hint, "none" if hint is None else "hint"


def on(carried: int | None, row: dict) -> int | None:
    page, _ = placed(carried, row)
    return carried if page is None else page


def chooses(row: dict) -> bool:
    """Whether the row has a page of its own: one that it names, or candidates."""
    return row["kept"] is not None if row["has"] else bool(row["c"])


def page_effect(rows: list[dict]) -> dict:
    none, zero = None, 0
    at = 0
    while at < len(rows) and not chooses(rows[at]):
        none, zero = on(none, rows[at]), on(zero, rows[at])
        at += 1
    if at == len(rows):
        return {"none": none, "zero": zero, "candidates": [], "hint": None, "outs": []}
    first = rows[at]
    # a kept page is a choice of one
    options = [{"page": first["kept"], "hits": 1, "first_start": 0}] if first["has"] else first["c"]
    ends = {c["page"]: c["page"] for c in options}
    for row in rows[at + 1 :]:
        moved = {page: on(page, row) for page in set(ends.values())}
        ends = {page: moved[to] for page, to in ends.items()}
    if len({*ends.values()}) == 1:
        options = options[:1]
    return {"none": none, "zero": zero, "candidates": options, "hint": first["hint"], "outs": [{"page": p, "to": ends[p]} for p in sorted({c["page"] for c in options})]}


def after_part(state: dict, part: dict) -> dict:
    page = state["page"]
    page = page if page else part["none"] if page is None else part["zero"]
    if part["outs"]:
        chosen = choose(part["candidates"], page or part["hint"])
        page = next(o["to"] for o in part["outs"] if o["page"] == chosen)
    return {"page": page}


def both_parts(f: dict, g: dict) -> dict:
    then = lambda page: after_part({"page": page}, g)["page"]
    if f["outs"]:
        return f | {"outs": [{"page": o["page"], "to": then(o["to"])} for o in f["outs"]]}
    lead = lambda page: page if page else g["none"] if page is None else g["zero"]
    return g | {"none": lead(f["none"]), "zero": lead(f["zero"])}


PAGES = Rule(_SUMMARY, "struct<page:bigint>", {"page": None}, both_parts, after_part)


def carried(rows: DataFrame, group: str, order: str, candidates: str = "candidates", kept: str = "kept", hint: str = "hint", parts: int | None = None) -> DataFrame:
    """(group, order, page, previous, by) of every row, going through each group's rows by ``order``.

    A row that already names a page (``has_page``) keeps it (null if its number cannot be read) and passes it on; else its candidates decide, else the hint. ``by`` tells kept, text, hint and none apart.
    """
    at = scratch(rows.sparkSession)
    kinds = {c: rows.schema[c].dataType.simpleString() for c in (group, order)}
    items = rows.select(group, order, F.col("has_page").alias("has"), F.col(kept).cast("long").alias("kept"), F.col(hint).cast("long").alias("hint"), F.col(candidates).cast(CANDIDATES).alias("c"))
    dealt = stored(in_parts(items, group, [order], parts), f"{at}/rows")
    head = f"{group} {kinds[group]}, part long, summary {_SUMMARY}"
    head_types = arrow(head)

    def summed(table: pa.Table) -> pa.Table:
        listed = rows_of(table, [order]).to_pylist()
        return pa.Table.from_pylist([{group: listed[0][group], "part": listed[0]["part"], "summary": page_effect(listed)}], head_types)

    states = prefix_states(stored(dealt.groupBy(group, "part").applyInArrow(summed, head), f"{at}/sums"), group, PAGES, f"{at}/up")
    out = f"{group} {kinds[group]}, {order} {kinds[order]}, page long, previous long, by string"
    out_types = arrow(out)

    def walk(table: pa.Table) -> pa.Table:
        listed, found = rows_of(table, [order]).to_pylist(), []
        previous = listed[0]["state"]["page"]
        for row in listed:
            page, by = placed(previous, row)
            found.append({group: row[group], order: row[order], "page": page, "previous": previous, "by": by})
            previous = previous if page is None else page
        return pa.Table.from_pylist(found, out_types)

    return with_state(dealt, stored(states, f"{at}/states"), group).groupBy(group, "part").applyInArrow(walk, out)


def numbered(rows: DataFrame, group: str, order: list[str], at: str, name: str = "number", parts: int | None = None) -> DataFrame:
    """The rows with their number from 1 within the group by ``order``: sorted parts, and prefix sums over the parts' sizes."""
    dealt = stored(in_parts(rows, group, order, parts), f"{at}/dealt")
    sizes = dealt.groupBy(group, "part").agg(F.count("*").alias("size"))  # a row per part
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(F.col(group).alias("__group"), F.col("part").alias("__part"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("__base"))
    inside = dealt.withColumn("__nth", F.row_number().over(Window.partitionBy(group, "part").orderBy(*order)))
    joined = inside.join(bases, F.col(group).eqNullSafe(F.col("__group")) & (F.col("part") == F.col("__part")))
    return joined.select(*rows.columns, (F.col("__base") + F.col("__nth")).alias(name))


def summed_before(rows: DataFrame, group: str, order: list[str], at: str, weight: str, name: str = "before", parts: int | None = None) -> DataFrame:
    """The rows with the sum of a whole number over the rows before them in the group by ``order``: sorted parts, and prefix sums over the parts' sums."""
    dealt = stored(in_parts(rows, group, order, parts), f"{at}/dealt")
    sums = dealt.groupBy(group, "part").agg(F.sum(weight).alias("__sum"))  # a row per part
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(F.col(group).alias("__group"), F.col("part").alias("__part"), F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__base"))
    own = F.coalesce(F.sum(weight).over(Window.partitionBy(group, "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    joined = dealt.withColumn("__own", own).join(bases, F.col(group).eqNullSafe(F.col("__group")) & (F.col("part") == F.col("__part")))
    return joined.select(*rows.columns, (F.col("__base") + F.col("__own")).alias(name))


def near_hints(rows: DataFrame, group: str, order: list[str], parent: str, page: str, reach: int = REACH, parts: int | None = None) -> DataFrame:
    """The rows with ``hint``: the page of the nearest other row with one within ``reach``, rows of the same parent first, the earlier row first.

    Rows look around in bins of ``BIN`` successive rows; those near a border are also guests of the next bin."""
    at = scratch(rows.sparkSession)
    known = numbered(rows, group, order, at, "__at", parts)
    place = F.pmod("__at", F.lit(BIN))
    home = F.floor(F.col("__at") / BIN)
    guests = F.array_compact(F.array(home, F.when(place < reach, home - 1), F.when(place >= BIN - reach, home + 1)))
    dealt = known.withColumn("__home", home).withColumn("__bin", F.explode(guests))
    w = Window.partitionBy(group, "__bin").orderBy("__at").rowsBetween(-reach, reach)
    near = F.collect_list(F.struct("__at", F.col(parent).alias("parent"), F.col(page).alias("page"))).over(w)
    usable = F.filter(near, lambda x: x.page.isNotNull() & (x.page != 0) & (x["__at"] != F.col("__at")))
    ranked = F.transform(usable, lambda x: F.struct((~x.parent.eqNullSafe(F.col(parent))).alias("other"), F.abs(x["__at"] - F.col("__at")).alias("away"), (x["__at"] > F.col("__at")).alias("later"), x.page.alias("page")))
    return dealt.withColumn("hint", F.array_min(ranked).page).where(F.col("__bin") == F.col("__home")).select(*rows.columns, "hint")
