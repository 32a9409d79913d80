"""Fill-in-the-middle: each text is cut at two line ranks into prefix, middle and suffix, and put together in another order.

The lines of a text are the nodes of an indexable skip list: lane 0 links line to line, every higher lane skips ``FANOUT`` links of
the one below, and each link carries what it spans in units (lines), code points and bytes. A cut rank is reached by descending the
lanes while the units spanned do not pass it; the widths gathered on the way are the cut's place in code points and in bytes, so
neither text nor lines are scanned again.

Rows: null counts as an empty text, which stays plain, as do texts that hold a mark. A null ``doc_id`` is drawn as if it were the empty
string. Repeated rows are transformed each, alike; very long texts are cut whole; other columns are left behind; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm._common import by_bytes, text_buffer

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
RATE, SPM_RATE = 100, 50  # percent of texts transformed; percent of these in the suffix-first order
FANOUT = 4
BATCH_BYTES = 4 << 20


class SkipList:
    """Lanes of links over units; ``widths`` has a row per unit with what it spans besides one unit."""

    def __init__(self, widths: np.ndarray):
        lane = np.hstack([np.ones((len(widths), 1), np.int64), widths.astype(np.int64)])
        self.size = len(lane)
        self.kinds = lane.shape[1]
        self.lanes = [lane.tolist()]
        while len(lane) > FANOUT:
            lane = np.add.reduceat(lane, np.arange(0, len(lane), FANOUT), axis=0)
            self.lanes.append(lane.tolist())

    def reach(self, rank: int) -> tuple[int, ...]:
        """What the first ``rank`` units span, and the units themselves first."""
        gathered = [0] * self.kinds
        at = 0
        for lane in reversed(self.lanes):
            at *= FANOUT
            while at < len(lane) and gathered[0] + lane[at][0] <= rank:
                gathered = [g + w for g, w in zip(gathered, lane[at])]
                at += 1
        return tuple(gathered)


def line_widths(raw: np.ndarray) -> np.ndarray:
    """(code points, bytes) of each line of a UTF-8 text, line ends included."""
    if not len(raw):
        return np.zeros((0, 2), np.int64)
    ends = np.flatnonzero(raw == 10) + 1
    if not len(ends) or ends[-1] < len(raw):
        ends = np.append(ends, len(raw))
    starts = np.append(0, ends[:-1])
    points = np.add.reduceat(((raw & 0xC0) != 0x80).astype(np.int64), starts)
    return np.stack([points, ends - starts], 1)


def draws(doc_id, seed: int = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers from the SHA-256 of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            raw, offsets = text_buffer(part.column(1))
            h = [part.column(2 + k).to_pylist() for k in range(4)]
            for i, j in by_bytes(offsets, BATCH_BYTES):
                n, form, before, between, out = [], [], [], [], []
                for k in range(i, j):
                    mine = raw[offsets[k] : offsets[k + 1]]
                    text = mine.tobytes()
                    units = SkipList(line_widths(mine))
                    n.append(units.size)
                    if not text or any(m in text for m in marks) or h[2][k] % 100 >= rate:
                        form.append("plain")
                        before.append(None)
                        between.append(None)
                        out.append(text)
                        continue
                    lo, hi = sorted((h[0][k] % (units.size + 1), h[1][k] % (units.size + 1)))
                    (_, p, a), (_, q, b) = units.reach(lo), units.reach(hi)
                    before.append(p)
                    between.append(q - p)
                    prefix, middle, suffix = text[:a], text[a:b], text[b:]
                    if h[3][k] % 100 < spm_rate:
                        form.append("spm")
                        out.append(b"".join((marks[1], suffix, marks[0], prefix, marks[2], middle)))
                    else:
                        form.append("psm")
                        out.append(b"".join((marks[0], prefix, marks[1], suffix, marks[2], middle)))
                cols = [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(before, pa.int64()), pa.array(between, pa.int64()), pa.array(out, pa.binary()).view(pa.string())]
                yield pa.RecordBatch.from_arrays([part.column(0).slice(i, j - i), *cols], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    given = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *(c.alias(f"h{k}") for k, c in enumerate(draws("doc_id", seed))))
    return given.mapInArrow(run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: str = "output", form: str = "form") -> Column:
    """The exact text, from output and form alone: transformed texts hold each mark once."""
    parts = F.split(F.col(output), f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    whole = lambda *order: F.concat(*(parts[k] for k in order))
    return F.when(F.col(form) == "psm", whole(1, 3, 2)).when(F.col(form) == "spm", whole(2, 3, 1)).otherwise(F.col(output))


def digests(docs: DataFrame) -> DataFrame:
    """The transformation's report: texts as digests, and the digest of what is restored from each output."""
    made = fill_in_middle(docs)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"))


_LINES = "[^\n]*\n|[^\n]+"
SQL = f"""with d as (select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '{_LINES}') as l, sha256('{SEED}:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
  n as (select doc_id, t, l, len(l) as n, [cast('0x' || substr(h, k, 8) as bigint) for k in [1, 9, 17, 25]] as h from d),
  c as (select *, least(h[1] % (n + 1), h[2] % (n + 1)) as a, greatest(h[1] % (n + 1), h[2] % (n + 1)) as b,
    case when t = '' or contains(t, '{PREFIX}') or contains(t, '{SUFFIX}') or contains(t, '{MIDDLE}') or h[3] % 100 >= {RATE} then 'plain' when h[4] % 100 < {SPM_RATE} then 'spm' else 'psm' end as form from n),
  p as (select *, array_to_string(l[1 : a], '') as p, array_to_string(l[a + 1 : b], '') as m, array_to_string(l[b + 1 : n], '') as s from c)
  select doc_id, cast(n as bigint) as n, form, case when form <> 'plain' then len(p) end as prefix_chars, case when form <> 'plain' then len(m) end as middle_chars,
    sha256(case form when 'plain' then t when 'psm' then '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m else '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m end) as output_sha256, sha256(t) as restored_sha256 from p"""
