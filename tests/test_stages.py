"""The composed stages against their SQL on the smallest tables."""

import os

import duckdb
import pytest

from docloom.plans import long, queries, stages  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages benchmark labels conversations".split()
NAMES = [
    "chunk_index", "codes_over_documents", "final_rows", "attached_pages", "page_markers", "validation_report", "validation_totals", "sub_code_and_document_issues", "schema_rules",
    "block_field_flavours", "file_round_trips", "submission_list", "catalogue_rows", "hint_weighted_vote", "enum_share", "source_spans", "source_chunks", "attached_pages_one", "carried_documents", "overlapping_ranges", "block_sources", "incremental_chunks", "submission_ranges", "source_blocks", "page_texts", "rule_routes", "chunk_summaries", "claims_against_pages", "catalogue_joins",
    "group_merge_distinct", "multi_field_merge", "block_roundtrip",
]


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        at = f"{SF}/{t}.parquet"
        c.execute(f"create view {t} as select * from '{at if os.path.isfile(at) else at + '/*.parquet'}'")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="the tables are not here")
@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(spark, db, name):
    found = queries.QUERIES[name](spark, SF)
    columns = sorted(found.columns)
    rows = db.execute(queries.SQL[name])
    places = {d[0]: i for i, d in enumerate(rows.description)}
    want = sorted((tuple(r[places[c]] for c in columns) for r in rows.fetchall()), key=str)
    got = sorted((tuple(r) for r in found.select(*columns).collect()), key=str)
    assert len(got) > 0 and got == want
