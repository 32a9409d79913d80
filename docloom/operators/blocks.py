"""Field blocks in text to rows: delimited chunk blocks, row sections, and "- name: value" fields.

Everything is a column expression; texts are never taken to Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import text as T

# --- fixed values: the block format ------------------------------------------------------------
OPEN = r"(?U)<!--\s*[^\s]+ v1 chunk:\s*([^\s]+)\s+hash:\s*([^\s]+)\s+lines:\s*(\d+)-(\d+)\s*-->"
CLOSE = r"(?U)<!--\s*end chunk:\s*([^\s]+)\s*-->"
ROW_HEADER = r"(?Umd)^###\s+row\s+.*$"
#: group 1: name; group 2: indented lines of "- name: |"; group 3: the value on the line
FIELD = r"(?Umd)^-\s+([a-z_]+):[^\S\n]*(?:\|[^\S\n]*\n((?:    [^\n]*\n|[^\S\n]*\n(?=    ))*+)|([^\n]*)\n)"
# --- end of fixed values ------------------------------------------------------------------------


def chunk_blocks(texts: DataFrame, key: str, text: str, opening: str = OPEN, closing: str = CLOSE) -> DataFrame:
    """(key, n, chunk_id, block_hash, start_line, end_line, body): what stands between an opening mark and the last
    closing mark of the same id, if that comes later. A text is split at its marks once, and bodies are put together from the pieces. Line numbers that
    are too long are null."""
    both = f"(?:{opening})|(?:{closing})"
    pieces = F.arrays_zip(F.split(F.col(text), both, -1).alias("piece"), T.extract_all(text, both).alias("mark"))

    def cut(z: Column) -> Column:
        opens = F.filter(F.transform(z.marks, lambda m, i: F.struct(m.alias("mark"), i.alias("at"))), lambda o: o.mark.rlike(opening))

        def one(o: Column, n: Column) -> Column:
            group = lambda k: F.regexp_extract(o.mark, opening, k)
            back = F.array_position(z.closed, group(1)).cast("int")  # from the last mark
            to = F.when(back > 0, F.size(z.marks) - back)
            body = F.when(to > o["at"], F.array_join(F.slice(z.parts, 2 * o["at"] + 3, 2 * (to - o["at"]) - 1), ""))
            return F.struct(n.alias("n"), group(1).alias("chunk_id"), group(2).alias("block_hash"), T.integer(group(3)).alias("start_line"), T.integer(group(4)).alias("end_line"), body.alias("body"))

        return F.filter(F.transform(opens, one), lambda b: b.body.isNotNull())

    known = lambda z: F.struct(
        F.flatten(F.transform(z, lambda x: F.array(x.piece, x.mark))).alias("parts"), F.filter(F.transform(z, lambda x: x.mark), lambda m: m.isNotNull()).alias("marks")
    )
    ends = lambda z: F.struct(z.parts.alias("parts"), z.marks.alias("marks"), F.reverse(F.transform(z.marks, lambda m: F.regexp_extract(m, closing, 1))).alias("closed"))
    once = F.transform(F.transform(F.transform(F.array(pieces), known), ends), cut)  # an array of one holds what is read more than once
    return texts.select(key, F.inline(F.flatten(once)))


def row_sections(blocks: DataFrame, body: str = "body", header: str = ROW_HEADER) -> DataFrame:
    """One row per section under a row header, numbered from 1 among those that are not blank."""
    parts = F.split(F.col(body), header, -1)
    kept = F.filter(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda x: T.strip(x) != "")
    others = [c for c in blocks.columns if c != body]
    return blocks.select(*others, F.posexplode(kept).alias("row_index", "section")).withColumn("row_index", F.col("row_index") + 1)


def fields(section, keep_blank: bool = True) -> Column:
    """The fields of a section as a map; the last value of a repeated name counts.

    ``keep_blank`` keeps a blank line between the indented lines of a value (the table builder's reading); without it
    blank lines go and both ends are stripped (the validator's reading).
    """
    if keep_blank:
        value = lambda v: T.rstrip(F.regexp_replace(v, r"(?Umd)^(?:    |[^\S\n]+$)", ""))
    else:
        value = lambda v: T.strip(F.regexp_replace(F.regexp_replace(v, r"(?Umd)^(?!    )[^\S\n]*\n", ""), r"(?md)^    ", ""))

    def entries(body: Column) -> Column:
        # the whole field is cut out once; its parts are read from that short piece
        def one(m: Column) -> Column:
            part = lambda k: F.regexp_extract(m, FIELD, k)
            opened = m.rlike(r"(?Umd)\A-\s+[a-z_]+:[^\S\n]*\|[^\S\n]*$")
            return F.struct(part(1).alias("k"), F.when(opened, value(part(2))).otherwise(T.strip(part(3))).alias("v"))

        return F.transform(T.extract_all(body, FIELD), one)

    def last_of_each(found: Column) -> Column:
        """Sorted by name and place, an entry counts where the next one has another name."""
        order = F.array_sort(F.transform(found, lambda e, i: F.struct(e.k.alias("k"), i.alias("i"), e.v.alias("v"))))
        return _once(order, lambda o: F.map_from_entries(F.transform(F.filter(o, lambda e, i: ~e.k.eqNullSafe(F.get(o, i + 1).k)), lambda e: F.struct(e.k.alias("k"), e.v.alias("v")))))

    body = F.concat(F.array_join(T.split_lines(section), "\n"), F.lit("\n"))
    return _once(body, lambda b: _once(entries(b), last_of_each))


def _once(value: Column, then) -> Column:
    """``then`` of a value that is worked out once, however often ``then`` reads it."""
    return F.transform(F.array(value), then)[0]


def rendered(rows: Column, mark: str = "docloom-normalize") -> Column:
    """Block text of an array of struct(chunk_id, hash, start, end, fields array<struct<name,value>>); the inverse of the parsers."""
    line = lambda f: F.when(f.value.contains("\n"), F.concat(F.lit("- "), f["name"], F.lit(": |\n    "), F.replace(f.value, F.lit("\n"), F.lit("\n    ")))).otherwise(F.concat(F.lit("- "), f["name"], F.lit(": "), f.value))
    one = lambda r: F.concat(
        F.format_string(f"<!-- {mark} v1 chunk: %s hash: %s lines: %d-%d -->\n### row 1\n", r.chunk_id, r.hash, r.start, r.end), F.array_join(F.transform(r.fields, line), "\n"), F.lit("\n<!-- end chunk: "), r.chunk_id, F.lit(" -->")
    )
    return F.array_join(F.transform(rows, one), "\n\n")
