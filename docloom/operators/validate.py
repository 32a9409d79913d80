"""Cross-checks of derived rows against their source text: an array of issues per row, totals and a histogram."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import patterns as P
from docloom.functions import text as T
from docloom.operators.intervals import range_texts

# --- fixed values: message texts and field names
UNKNOWN_CHUNK = "chunk_id not present in current index"
NO_OUTPUT = "no normalized output yet"
DOCUMENT_FIELDS = ["mandatory_documents", "common_documents", "other_documents"]
# --- end of fixed values


def listed(values: Column) -> Column:
    """A list as it is shown in messages: ['a', 'b']."""
    return F.concat(F.lit("["), F.array_join(F.transform(values, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "), F.lit("]"))


def invented(claimed: Column, source: Column) -> Column:
    """Claimed values that the source does not hold, sorted."""
    return F.array_sort(F.array_except(claimed, source))


def with_source(blocks: DataFrame, index: DataFrame, lines: DataFrame, key: str) -> DataFrame:
    """Blocks with their chunk's index entry (left) and source text, the lines (key, line_no, line) that the index names.

    Adds content_hash (null for an unknown chunk), hash_drift and source. Texts are put together once per chunk that a block cites."""
    known = index.select(key, "chunk_id", "content_hash", F.col("start_line").alias("__a"), F.col("end_line").alias("__b"))
    cited = known.join(blocks.select(key, "chunk_id").distinct(), [key, "chunk_id"], "left_semi")
    texts = range_texts(cited, lines, key, [key, "chunk_id"], "__a", "__b").select(key, "chunk_id", F.col("text").alias("source"))
    joined = blocks.join(known.drop("__a", "__b"), [key, "chunk_id"], "left").join(texts, [key, "chunk_id"], "left")
    return joined.withColumns({"hash_drift": ~F.col("content_hash").eqNullSafe(F.col("block_hash")), "source": F.coalesce("source", F.lit(""))})


def row_issues(fields: Column, source: Column, required: list[str] = P.REQUIRED_FIELDS, code: str = P.CODE, amount: str = P.AMOUNT, document: str = P.DOCUMENT) -> Column:
    """Issues of one row (a map of fields) against its source text, in a fixed order."""
    value = lambda name: T.strip(F.coalesce(F.try_element_at(fields, F.lit(name)), F.lit("")))
    missing = F.array_sort(F.array_except(F.array(*map(F.lit, required)), F.map_keys(fields)))
    claimed = T.first_non_empty(F.try_element_at(fields, F.lit("visa_code")), F.try_element_at(fields, F.lit("stay_status_code")))
    codes = T.codes(source, code)
    bad_code, bad_sub = invented(T.codes(claimed, code), codes), invented(T.codes(value("subtype_or_program"), code), codes)
    bad_amount = invented(T.amounts(value("fees"), amount), T.amounts(source, amount))
    say = lambda when, text, values: F.when(when, F.concat(F.lit(text), listed(values)))
    out = [
        say(F.size(missing) > 0, "missing required fields: ", missing),
        F.when(T.strip(claimed) == "", "visa_code/stay_status_code value empty").otherwise(say(F.size(bad_code) > 0, "visa code not in source: ", bad_code)),
        say(F.size(bad_sub) > 0, "subtype_or_program code not in source: ", bad_sub),
        say(F.size(bad_amount) > 0, "amount not in source: ", bad_amount),
    ]
    named = T.document_names(source, document)
    for name in DOCUMENT_FIELDS:
        mine = T.document_names(value(name), document)
        none = (F.size(mine) > 0) & (F.size(F.array_intersect(mine, named)) == 0)
        out.append(say(none, f"{name}: none of the cited documents found in source: ", F.slice(F.array_sort(mine), 1, 3)))
    return F.array_compact(F.array(*out))


def chunk_report(rows: DataFrame, key: str) -> DataFrame:
    """One row per chunk from rows (key, chunk_id, content_hash, block_hash, hash_drift, row_index, section_title, petition_type, subsection_type, issues); row_index null: a chunk without rows."""
    row = F.struct("row_index", "section_title", "petition_type", "subsection_type", "issues")
    drift = F.concat(F.lit("hash drift: index="), F.coalesce("content_hash", F.lit("")), F.lit(" vs block="), F.col("block_hash"))
    unknown = F.col("content_hash").isNull()
    return (
        rows.groupBy(key, "chunk_id", "content_hash", "block_hash", "hash_drift")
        .agg(F.count_if(F.col("row_index").isNotNull() & F.col("content_hash").isNotNull()).alias("row_count"), F.count_if((F.size("issues") > 0) & F.col("content_hash").isNotNull()).alias("rows_with_issues"), F.sort_array(F.collect_list(F.when(F.col("row_index").isNotNull() & F.col("content_hash").isNotNull(), row))).alias("rows"))
        .withColumn("chunk_level_issues", F.when(unknown, F.array(F.lit(UNKNOWN_CHUNK))).when(F.col("hash_drift"), F.array(drift)).otherwise(F.array().cast("array<string>")))
    )


def totals(report: DataFrame, key: str) -> DataFrame:
    dirty = (F.col("rows_with_issues") > 0) | F.col("hash_drift")
    return report.groupBy(key).agg(F.count("*").alias("normalized_chunks"), F.sum("row_count").alias("total_rows"), F.sum("rows_with_issues").alias("rows_with_issues"), F.count_if(dirty).alias("chunks_with_issues"))


def status(manuals: DataFrame, totals: DataFrame, key: str) -> DataFrame:
    """Every manual with its totals; one without any block gets a status instead, which is no error."""
    known = manuals.select(key).distinct().join(totals, key, "left")
    return known.withColumn("status", F.when(F.col("normalized_chunks").isNull(), NO_OUTPUT))


def require_sources(manuals: DataFrame, lines: DataFrame, key: str) -> None:
    """Fails if a manual has no source lines at all: without its raw text nothing about it can be checked. Names a few of them."""
    bare = manuals.select(key).distinct().join(lines.select(key).distinct(), key, "left_anti").limit(5).collect()
    if bare:
        raise ValueError(f"no raw text for {', '.join(sorted(str(r[0]) for r in bare))}")


def issue_histogram(rows: DataFrame, issues: str = "issues", order: list[str] | None = None) -> DataFrame:
    """(kind, n): issues by what stands before the first colon, most frequent first; kinds that tie by their first issue in ``order`` of the rows, or without one by name."""
    placed = rows.select(F.struct(*(order or [])).alias("__row") if order else F.lit(0).alias("__row"), F.posexplode(issues).alias("__at", "issue"))
    kinds = placed.groupBy(T.kind_before("issue").alias("kind")).agg(F.count("*").alias("n"), F.min(F.struct("__row", "__at")).alias("__first"))
    return kinds.orderBy(F.desc("n"), *(["__first"] if order else []), "kind").select("kind", "n")
