"""Parsed rows to the final table: one row per (code, petition) in the order of first appearance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions import patterns as P
from docloom.functions import text as T
from docloom.operators.carried import numbered
from docloom.operators.enrich import override_lookup
from docloom.operators.rollup import capped_lines, merge_groups, merged
from docloom.operators.rules import route_table, split_duration
from docloom.sources.files import scratch


def final_table(rows: DataFrame, subs: DataFrame, parents: DataFrame, key: str = "manual_key") -> DataFrame:
    """rows (key, chunk_no, row_index, fields map) -> (key, row_no, the 26 columns of ``patterns.COLUMNS``).

    ``subs`` and ``parents`` hold ``key`` and the four flow columns; a flow column replaces table text that was routed to it.
    """
    field = lambda n: F.coalesce(F.col("fields")[n], F.lit(""))  # noqa: E731  Spark replaces such a look-up in a map that the plan makes, in filters too
    names = sorted({*P.DIRECT, "duration_or_validity", *(f for _, f in P.DOCUMENT_SECTIONS), "table_summary", "table_rows", "section_title"})
    base = T.first_non_empty(field("visa_code"), field("stay_status_code"))
    flat = rows.select(
        F.col(key).alias("__key"), "chunk_no", "row_index", T.full_code(base, field("subtype_or_program")).alias("visa_code"), T.strip(field("petition_type")).alias("petition_type"),
        *(field(n).alias(f"f_{n}") for n in names), field("expected_questions").alias("f_expected_questions"),
    ).where("visa_code <> '' and petition_type <> ''")
    direct = {c: [f"f_{f}" for f, to in P.DIRECT.items() if to == c] for c in dict.fromkeys(P.DIRECT.values())}
    single = {f"m_{n}": [f"f_{n}"] for n in ("duration_or_validity", "table_summary", "table_rows", "section_title", *(f for _, f in P.DOCUMENT_SECTIONS))}
    merges = direct | single | {"m_questions": ["f_expected_questions"]}
    g = merge_groups(flat, ["__key", "visa_code", "petition_type"], ["chunk_no", "row_index"], merges, {c: "\n" if c == "m_questions" else "\n\n" for c in merges})
    g = g.withColumns(split_duration("m_duration_or_validity"))
    blob = F.concat_ws("\n\n", F.nullif("m_table_summary", F.lit("")), F.nullif("m_table_rows", F.lit("")))
    g = g.withColumns({"__blob": blob, "__to": F.when(blob != "", route_table(blob))})
    g = g.withColumns({c: F.when(F.col("__to") == c, merged(F.array(F.col(c), F.concat(F.lit(P.TABLE_LABEL + "\n"), "__blob")))).otherwise(F.col(c)) for c in ("eligibility", "score_table", "quota", "fees")})
    g = g.withColumns(
        {
            "parent_code": T.parent_of("visa_code"),
            "manual_kind": F.when(F.col("__key") == "visa", P.KINDS["visa"]).otherwise(P.KINDS["stay"]),
            "documents": T.labelled_sections([(label, F.col(f"m_{f}")) for label, f in P.DOCUMENT_SECTIONS]),
            "expected_questions": capped_lines("m_questions"),
            "source": F.col("m_section_title"),
            "__sub_code": T.sub_of("visa_code"),
        }
    )
    g = override_lookup(g, "__sub_code", "parent_code", subs, parents, P.FLOW)
    named = g.select("__key", "first_at", *(F.coalesce(F.col(c), F.lit("")).alias(c) for c in P.COLUMNS))
    placed = numbered(named, "__key", ["first_at"], scratch(rows.sparkSession), "row_no")  # prefix sums: there are few keys
    return placed.select(F.col("__key").alias(key), "row_no", *P.COLUMNS)
