"""Spans and greedy cuts of documents given as line rows, however long a document is: the rules of ``chunk`` as scans over parts.

Spans. Before a line a document is in one of two states: closed at some depth (a span opens only at depth zero; a stray closing mark leaves a negative
depth), or open at some positive depth since some line. A part of lines changes states by its total change, but for depths from which a
span opens inside (closed) or the open span ends inside (open); for each of these it is known what comes out at the end. Such
tables of two neighbours make the table of both.

Cuts. From a cut at one span end the next cut is the first span end that is ``target`` characters away. Pointer doubling over a part's span
ends gives the last cut inside the part for every span end at which a cut may come in; neighbours with the same outcome are one entry.

Documents are (key, order columns, line) rows; rows that tie in order go by their line. A null line counts as an empty one, a null key is a document too.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions import patterns as P
from docloom.functions import text as T
from docloom.operators.chunk import TARGET
from docloom.operators.scan import Rule, arrow, in_parts, prefix_states, rows_of, with_state
from docloom.sources.files import discard, stored

_AFTER = "open:boolean,depth:bigint,start:bigint,spans:bigint"  # start: the open span's first line, from 1
_SUMMARY = f"struct<lines:bigint,chars:bigint,full:bigint,change:bigint,exact:array<struct<at:bigint,{_AFTER}>>,below:array<struct<at:bigint,{_AFTER}>>>"
_STATE = f"struct<lines:bigint,chars:bigint,full:bigint,{_AFTER}>"
_POINT = "chars:bigint,line:bigint,full:bigint,spans:bigint"  # after a cut: characters, lines, lines that are not blank, and spans so far


# --- spans --------------------------------------------------------------------------------------


def span_effect(opens: list[int], closes: list[int]) -> dict:
    """What lines with these numbers of marks do to any state; seen from the last line to the first."""
    n = len(opens)
    sums = [0]
    for o, c in zip(opens, closes):
        sums.append(sums[-1] + o - c)
    after = [None] * n + [(False, 0, None, 0)]  # from closed at depth 0 before line j: (open, depth, start, spans) at the end
    nearest: dict[int, int] = {}  # depth before a line -> the next line with that depth at which a span may open
    at: list[int] = []  # lines whose sums are lower than all earlier ones from here on, the nearest last
    low: list[int] = []
    ends: list[int | None] = [None] * n
    for j in range(n - 1, -1, -1):
        while low and low[-1] >= sums[j + 1]:
            low.pop()
            at.pop()
        low.append(sums[j + 1])
        at.append(j)
        before = sums[j]
        if opens[j] > 0:
            nearest[before] = j
            k = bisect_right(low, before) - 1
            ends[j] = at[k] if k >= 0 else None
        k = nearest.get(before)
        if k is None:
            after[j] = (False, sums[n] - before, None, 0)
        else:
            after[j] = _closed(after, ends[k]) or (True, sums[n] - before, k + 1, 0)
    row = lambda d, x: {"at": d, "open": x[0], "depth": x[1], "start": x[2], "spans": x[3]}
    exact = [row(-level, _closed(after, ends[k]) or (True, sums[n] - level, k + 1, 0)) for level, k in sorted(nearest.items(), reverse=True)]
    below = [row(-low[k], _closed(after, at[k])) for k in range(len(low) - 1, -1, -1) if low[k] < 0]
    return {"change": sums[n], "exact": exact, "below": _thinned(below)}


def _closed(after: list, end: int | None):
    """What comes of a span that ends at a line: one span more than from there on."""
    if end is None:
        return None
    opened, depth, start, spans = after[end + 1]
    return opened, depth, start, spans + 1


def _thinned(steps: list[dict]) -> list[dict]:
    """Steps with ascending bounds; of neighbours with one outcome the last stays."""
    return [s for s, later in zip(steps, [*steps[1:], None]) if later is None or {**s, "at": 0} != {**later, "at": 0}]


def after_part(state: dict, part: dict) -> dict:
    found = None
    if state["open"]:
        k = bisect_left(part["below"], state["depth"], key=lambda s: s["at"])
        found = part["below"][k] if k < len(part["below"]) else None
    else:
        k = bisect_left(part["exact"], state["depth"], key=lambda s: s["at"])
        found = part["exact"][k] if k < len(part["exact"]) and part["exact"][k]["at"] == state["depth"] else None
    out = {c: state[c] + part[c] for c in ("lines", "chars", "full")}
    if found is None:
        return out | {"open": state["open"], "depth": state["depth"] + part["change"], "start": state["start"], "spans": state["spans"]}
    return out | {"open": found["open"], "depth": found["depth"], "start": found["start"] + state["lines"] if found["open"] else None, "spans": state["spans"] + found["spans"]}


def both_parts(f: dict, g: dict) -> dict:
    sums = {c: f[c] for c in ("lines", "chars", "full")}
    then = lambda d, **state: {"at": d} | {c: v for c, v in after_part(sums | state, g).items() if c not in sums}
    move = lambda s: then(s["at"], open=s["open"], depth=s["depth"], start=s["start"], spans=s["spans"])
    exact = {s["at"]: move(s) for s in f["exact"]}
    for s in g["exact"]:
        if (d := s["at"] - f["change"]) not in exact:
            exact[d] = then(d, open=False, depth=s["at"], start=None, spans=0)
    below = [move(s) for s in f["below"]]
    most = f["below"][-1]["at"] if f["below"] else 0
    below += [then(s["at"] - f["change"], open=True, depth=s["at"], start=0, spans=0) for s in g["below"] if s["at"] - f["change"] > most]
    return {c: f[c] + g[c] for c in ("lines", "chars", "full", "change")} | {"exact": sorted(exact.values(), key=lambda s: s["at"]), "below": _thinned(below)}


SPANS = Rule(_SUMMARY, _STATE, {"lines": 0, "chars": 0, "full": 0, "open": False, "depth": 0, "start": None, "spans": 0}, both_parts, after_part)


def line_marks(lines: DataFrame, key: str, order: list[str], line: str, opening: str, closing: str) -> DataFrame:
    """(key, order, tie, o, c, n, full): the marks of each line, its characters with its line end, and whether it is not blank; texts stay behind."""
    x = F.coalesce(F.col(line), F.lit(""))
    return lines.select(
        F.col(key), *order, F.xxhash64(x).alias("tie"), T.count_matches(x, opening).alias("o"), T.count_matches(x, closing).alias("c"), (F.length(x) + 1).cast("long").alias("n"), (T.strip(x) != "").cast("int").alias("full")
    )


def span_ends(marks: DataFrame, key: str, order: list[str], at: str, parts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(key, part, first_line, line, chars, full, spans), one row per span with what lies before and in its last line; (key, lines, chars, full)."""
    kind = marks.schema[key].dataType.simpleString()
    by = [*order, "tie"]
    marks = stored(marks, f"{at}/lines")  # parts are cut by a sample, which would read the lines' texts once more
    rows = stored(in_parts(marks, key, by, parts), f"{at}/marks")
    head = f"{key} {kind}, part long, summary {_SUMMARY}"
    types = arrow(head)

    def summed(table: pa.Table) -> pa.Table:
        table = rows_of(table, by)
        sums = {"lines": len(table), "chars": int(table.column("n").to_numpy().sum()), "full": int(table.column("full").to_numpy().sum())}
        effect = span_effect(table.column("o").to_pylist(), table.column("c").to_pylist())
        return pa.Table.from_pylist([{key: table.column(key)[0].as_py(), "part": table.column("part")[0].as_py(), "summary": sums | effect}], types)

    sums = stored(rows.groupBy(key, "part").applyInArrow(summed, head), f"{at}/sums")
    states = stored(prefix_states(sums, key, SPANS, f"{at}/up"), f"{at}/states")
    schema = f"{key} {kind}, part long, first_line long, line long, chars long, full long, spans long"

    def found(table: pa.Table) -> pa.Table:
        table = rows_of(table, by)
        state = table.column("state")[0].as_py()
        opened, depth, start, spans, first = state["open"], state["depth"], state["start"], state["spans"], state["lines"]
        chars, full = (np.cumsum(table.column(c).to_numpy()) + state[s] for c, s in (("n", "chars"), ("full", "full")))
        starts, ends = [], []
        for i, (o, c) in enumerate(zip(table.column("o").to_pylist(), table.column("c").to_pylist())):
            if not opened and depth == 0 and o > 0:
                opened, start = True, first + i + 1
            depth += o - c
            if opened and depth <= 0:
                starts.append(start)
                ends.append(i)
                opened, depth = False, 0
        n, e = len(ends), np.array(ends, np.int64)
        columns = [pa.array([table.column(k)[0].as_py()] * n, table.column(k).type) for k in (key, "part")]
        return pa.table([*columns, pa.array(starts, pa.int64()), pa.array(e + first + 1), pa.array(chars[e]), pa.array(full[e].astype(np.int64)), pa.array(np.arange(n) + spans + 1)], [key, "part", "first_line", "line", "chars", "full", "spans"])

    ends = with_state(rows, states, key).groupBy(key, "part").applyInArrow(found, schema)
    totals = sums.groupBy(key).agg(*(F.sum(f"summary.{c}").alias(c) for c in ("lines", "chars", "full")))
    ends = stored(ends, f"{at}/ends")
    discard(marks.sparkSession, *(f"{at}/{x}" for x in ("lines", "marks", "up", "states")))
    return ends, totals


def long_spans(lines: DataFrame, key: str, order: list[str], line: str, at: str, opening: str = P.TABLE_OPEN, closing: str = P.TABLE_CLOSE, parts: int | None = None) -> DataFrame:
    """(key, first_line, last_line), from 1, of each document's top-level spans: those of ``chunk.spans``, over line rows. ``at``: a fresh folder."""
    ends, _ = span_ends(line_marks(lines, key, order, line, opening, closing), key, order, at, parts)
    return ends.select(key, "first_line", F.col("line").alias("last_line"))


# --- cuts ---------------------------------------------------------------------------------------


def last_cuts(chars: np.ndarray, target: int) -> np.ndarray:
    """For each span end the last cut that follows from a cut there, among these ends, by pointer doubling."""
    n = len(chars)
    jump = np.searchsorted(chars, chars + target)
    jump = np.where(jump < n, jump, np.arange(n))
    while True:
        further = jump[jump]
        if (further == jump).all():
            return jump
        jump = further


def cut_rule(target: int) -> Rule:
    def apply(state: dict, part: list[dict]) -> dict:
        k = bisect_left(part, state["chars"] + target, key=lambda s: s["upto"])
        return {c: part[k][c] for c in ("chars", "line", "full", "spans")} if k < len(part) else state

    def combine(f: list[dict], g: list[dict]) -> list[dict]:
        steps = [{"upto": s["upto"]} | apply(s, g) for s in f] + g
        return [s for s, later in zip(steps, [*steps[1:], None]) if later is None or s["line"] != later["line"]]

    return Rule(f"array<struct<upto:bigint,{_POINT}>>", f"struct<{_POINT}>", {"chars": 0, "line": 0, "full": 0, "spans": 0}, combine, apply)


def long_chunks(
    lines: DataFrame, key: str, order: list[str], line: str, at: str, target: int = TARGET, opening: str = P.TABLE_OPEN, closing: str = P.TABLE_CLOSE, parts: int | None = None
) -> DataFrame:
    """(key, start_line, end_line, char_count, table_count) of each document's chunks: those of ``chunk.chunk_documents``, over line rows.

    A chunk ends at the first span end at which it holds ``target`` characters, the rest is the last chunk; blank chunks are left out."""
    ends, totals = span_ends(line_marks(lines, key, order, line, opening, closing), key, order, at, parts)
    kind = ends.schema[key].dataType.simpleString()
    rule = cut_rule(target)
    fields = ["chars", "line", "full", "spans"]
    head = f"{key} {kind}, part long, summary {rule.summary}"
    head_types = arrow(head)

    def summed(table: pa.Table) -> pa.Table:
        table = rows_of(table, ["line"])
        chars, last = table.column("chars").to_numpy(), last_cuts(table.column("chars").to_numpy(), target)
        kept = np.flatnonzero(np.append(last[1:] != last[:-1], True))
        points = table.select(fields).take(pa.array(last[kept])).to_pylist()
        return pa.Table.from_pylist([{key: table.column(key)[0].as_py(), "part": table.column("part")[0].as_py(), "summary": [{"upto": int(chars[k])} | p for k, p in zip(kept, points)]}], head_types)

    sums = stored(ends.groupBy(key, "part").applyInArrow(summed, head), f"{at}/cuts")
    states = stored(prefix_states(sums, key, rule, f"{at}/cuts_up"), f"{at}/cut_states")
    schema = f"{key} {kind}, start_line long, end_line long, char_count long, table_count long, full long, chars long, spans long"
    types = arrow(schema)

    def cut(table: pa.Table) -> pa.Table:
        table = rows_of(table, ["line"])
        now, out = table.column("state")[0].as_py(), []
        chars, points = table.column("chars").to_numpy(), table.select(fields)
        name = table.column(key)[0].as_py()
        while (j := int(np.searchsorted(chars, now["chars"] + target))) < len(chars):
            p = points.slice(j, 1).to_pylist()[0]
            out.append({key: name, "start_line": now["line"] + 1, "end_line": p["line"], "char_count": p["chars"] - now["chars"] - 1, "table_count": p["spans"] - now["spans"], "full": p["full"] - now["full"], "chars": p["chars"], "spans": p["spans"]})
            now = p
        return pa.Table.from_pylist(out, types)

    cuts = stored(with_state(ends, states, key).groupBy(key, "part").applyInArrow(cut, schema), f"{at}/chunks")
    discard(ends.sparkSession, *(f"{at}/{x}" for x in ("cuts", "cuts_up", "cut_states")))
    # what follows the last cut
    last = cuts.groupBy(F.col(key).alias("__key")).agg(F.max(F.struct("end_line", "chars", "spans")).alias("last"), F.sum("full").alias("seen"))
    spans = ends.groupBy(F.col(key).alias("__of")).agg(F.count("*").alias("n_spans"))
    rest = totals.join(last, F.col(key).eqNullSafe(F.col("__key")), "left").join(spans, F.col(key).eqNullSafe(F.col("__of")), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    rest = rest.select(
        key, (zero("last.end_line") + 1).alias("start_line"), F.col("lines").alias("end_line"), (F.col("chars") - zero("last.chars") - 1).alias("char_count"), (zero("n_spans") - zero("last.spans")).alias("table_count"), (F.col("full") - zero("seen")).alias("full")
    ).where("start_line <= end_line")
    return cuts.select(*rest.columns).unionByName(rest).where("full > 0").drop("full")
