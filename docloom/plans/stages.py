"""Queries of the composed stages: the final table, page attachment, the validation report, files and submissions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions import patterns as P
from docloom.functions import text as T
from docloom.operators import blocks, chunk, locate, quality, validate
from docloom.plans.compile import final_table
from docloom.plans.queries import SPACES, _LINES_SQL, _hash_sql, document_chunks, joined, part_blocks, query
from docloom.sources import files, submissions

# --- chunk index --------------------------------------------------------------------------------

_CHUNKS_SQL = f"""{_LINES_SQL}, e as (select doc_id, unnest(range(len(l))) as i, unnest(l) as line from lines),
  c as (select doc_id, i, len(line) as n, cast(len(line) > 0 as bigint) as o, cast(regexp_matches(line, '\\.\\s*$') as bigint) as c from e),
  g as (select doc_id, cast(-1 as bigint) as i, cast(0 as bigint) as depth, false as open, false as closes, cast(0 as bigint) as size, cast(0 as bigint) as first, cast(0 as bigint) as tables, false as cut from documents
    union all select doc_id, i, case when done then 0 else d end, op and not done, done, sz, case when was_cut then i else first end, tb + cast(done as bigint), sz >= 2000 and done
    from (select c.doc_id, c.i, g.depth + c.o - c.c as d, g.open or (c.o > 0 and g.depth = 0) as op, g.depth + c.o - c.c <= 0 and (g.open or (c.o > 0 and g.depth = 0)) as done,
      case when g.cut then 0 else g.size end + c.n + 1 as sz, case when g.cut then 0 else g.tables end as tb, g.cut as was_cut, g.first from g join c on g.doc_id = c.doc_id and c.i = g.i + 1)),
  b as (select *, row_number() over (partition by doc_id order by i desc) as back from g where i >= 0),
  t as (select b.doc_id, b.first, b.i, b.tables, array_to_string(l[b.first + 1 : b.i + 1], chr(10)) as text from b join lines on b.doc_id = lines.doc_id where cut or back = 1),
  k as (select *, row_number() over (partition by doc_id order by first) as nth from t where regexp_replace(text, '{SPACES}', '', 'g') <> ''),
  m as (select doc_id, nth, regexp_extract_all(text, '[A-Z][a-z]+[0-9]+') as m from k), v as (select doc_id, nth, unnest(m) as v, unnest(range(len(m))) as p from m),
  w as (select doc_id, nth, v, min(p) as p from v group by 1, 2, 3), x as (select doc_id, nth, string_agg(v, '|' order by p) as codes from w group by 1, 2)"""

_CHUNK_ROWS = f"""select k.doc_id || '_' || case when k.nth < 1000 then lpad(cast(k.nth as varchar), 3, '0') else cast(k.nth as varchar) end as chunk_id, k.doc_id, k.first + 1 as start_line, k.i + 1 as end_line,
  len(text) as char_count, k.tables as table_count, coalesce(codes, '') as codes, len(text) > 4000 as oversized, {_hash_sql('text')} as content_hash from k left join x on k.doc_id = x.doc_id and k.nth = x.nth"""


@query(f"with recursive {_CHUNKS_SQL} {_CHUNK_ROWS}")
def chunk_index(t, spark):
    found = document_chunks(t("documents")).withColumn("codes", joined("codes")).drop("text")
    return found.withColumns({c: F.col(c).cast("long") for c in ("start_line", "end_line", "char_count", "table_count")})


@query("""with m as (select doc_id, unnest(list_distinct(regexp_extract_all(text, '[A-Z][a-z]+'))) as code from documents) select code, count(*) as chunks from m group by 1""")
def codes_over_documents(t, spark):
    return chunk.all_codes(t("documents").select(T.codes("text", "[A-Z][a-z]+").alias("codes")))


# --- the final table ----------------------------------------------------------------------------

_WORDS = {"0": "복수사증", "1": "체류기간 90일 이내", "2": "최장 2년", "3": "1년 이내"}
_TABLES = {"0": "배점 ", "1": "쿼터 ", "2": "동반가족 범위 ", "3": "수수료 표 ", "4": "기타 "}


def part_fields(t) -> DataFrame:
    """Parts as parsed rows (manual_key, chunk_no, row_index, fields): several parts share a brand, so groups merge."""
    size = F.col("p_size")
    case = lambda by, values: F.element_at(F.create_map(*(F.lit(x) for kv in values.items() for x in kv)), (size % by).cast("string"))
    when = lambda test, value: F.when(test, value).otherwise(F.lit(""))
    fields = {
        "visa_code": when(size % 11 != 0, F.col("p_brand")), "subtype_or_program": when(size % 3 == 0, F.col("p_type")), "petition_type": when(size % 7 != 0, F.concat(F.lit("P"), (size % 4).cast("string"))),
        "eligibility": F.col("p_type"), "requirements": F.concat(F.lit(" "), (size % 5).cast("string"), F.lit("\t")), "fees": F.concat((size % 6).cast("string"), F.lit("원")),
        "duration_or_validity": case(4, _WORDS), "common_documents": when(size % 2 == 0, F.lit("여권")), "other_documents": F.col("p_type"), "table_rows": when(size % 13 < 5, F.concat(case(5, _TABLES), (size % 13).cast("string"))),
        "expected_questions": F.concat_ws("\n", *(F.concat(F.lit(q), (size % 3).cast("string")) for q in ("a", "", "b", "c"))), "section_title": F.concat(F.lit("S"), (F.col("p_partkey") % 4).cast("string")),
    }
    key = F.when(size % 2 == 0, "visa").otherwise("stay")
    parts = t("part").select("p_partkey", "p_brand", "p_type", "p_size").repartition("p_partkey")  # some bytes a row in the file, hundreds in a task: one split may hold them all
    return parts.select(key.alias("manual_key"), F.floor(F.col("p_partkey") / 100).alias("chunk_no"), (F.col("p_partkey") % 100).alias("row_index"), F.create_map(*(x for n, c in fields.items() for x in (F.lit(n), c))).alias("fields"))


def _case(by: int, values: dict) -> str:
    return f"case p_size % {by} " + " ".join(f"when {k} then '{v}'" for k, v in values.items()) + " end"


_FINAL = f"""with r as (select case when p_size % 2 = 0 then 'visa' else 'stay' end as manual_key, p_partkey as pos, case when p_size % 11 = 0 then '' else p_brand end || case when p_size % 3 = 0 then ' (' || p_type || ')' else '' end as visa_code, 'P' || (p_size % 4) as petition_type,
    p_type as ty, cast(p_size % 5 as varchar) as rq, (p_size % 6) || '원' as fe, {_case(4, _WORDS)} as du, case when p_size % 2 = 0 then '여권' else '' end as cd, case when p_size % 13 < 5 then {_case(5, _TABLES)} || (p_size % 13) else '' end as tb,
    p_size % 3 as q, 'S' || (p_partkey % 4) as st from part where (p_size % 11 <> 0 or p_size % 3 = 0) and p_size % 7 <> 0),
  v as (select manual_key, visa_code, petition_type, 'el' as f, ty as v, pos * 2 as pos from r union all select manual_key, visa_code, petition_type, 'el', rq, pos * 2 + 1 from r union all select manual_key, visa_code, petition_type, 'fe', fe, pos from r
    union all select manual_key, visa_code, petition_type, 'du', du, pos from r union all select manual_key, visa_code, petition_type, 'cd', cd, pos from r union all select manual_key, visa_code, petition_type, 'od', ty, pos from r
    union all select manual_key, visa_code, petition_type, 'tb', trim(tb), pos from r union all select manual_key, visa_code, petition_type, 'st', st, pos from r),
  d as (select manual_key, visa_code, petition_type, f, v, min(pos) as pos from v where v <> '' group by 1, 2, 3, 4, 5),
  g as (select manual_key, visa_code, petition_type, coalesce(string_agg(v, chr(10) || chr(10) order by pos) filter (where f = 'el'), '') as el, coalesce(string_agg(v, chr(10) || chr(10) order by pos) filter (where f = 'fe'), '') as fe,
    coalesce(string_agg(v, chr(10) order by pos) filter (where f = 'du' and v = '복수사증'), '') as va, coalesce(string_agg(v, chr(10) order by pos) filter (where f = 'du' and v in ('체류기간 90일 이내', '1년 이내')), '') as si,
    coalesce(string_agg(v, chr(10) order by pos) filter (where f = 'du' and v = '최장 2년'), '') as tt, coalesce(string_agg(v, chr(10) || chr(10) order by pos) filter (where f = 'cd'), '') as cd,
    coalesce(string_agg(v, chr(10) || chr(10) order by pos) filter (where f = 'od'), '') as od, coalesce(string_agg(v, chr(10) || chr(10) order by pos) filter (where f = 'tb'), '') as tb, coalesce(string_agg(v, chr(10) || chr(10) order by pos) filter (where f = 'st'), '') as st
    from d group by 1, 2, 3),
  fa as (select manual_key, visa_code, petition_type, min(pos) as first_at from r group by 1, 2, 3),
  qs as (select manual_key, visa_code, petition_type, unnest(['a' || q, cast(q as varchar), 'b' || q, 'c' || q]) as line, unnest([0, 1, 2, 3]) as p, m from (select manual_key, visa_code, petition_type, q, min(pos) as m from r group by 1, 2, 3, 4)),
  ql as (select *, row_number() over (partition by manual_key, visa_code, petition_type order by m, p) as nth from qs), qq as (select manual_key, visa_code, petition_type, string_agg(line, chr(10) order by nth) as questions from ql where nth <= 4 group by 1, 2, 3),
  o as (select g.*, fa.first_at, qq.questions, split_part(visa_code, ' (', 1) as parent, case when tb = '' then '' when tb like '%배점%' then 'score' when tb like '%쿼터%' then 'quota' when tb like '%동반가족%' then 'companion' when tb like '%수수료 표%' then 'fees' else 'el' end as route,
    chr(10) || chr(10) || '[표]' || chr(10) || tb as more, '[표]' || chr(10) || tb as only_table from g join fa using (manual_key, visa_code, petition_type) join qq using (manual_key, visa_code, petition_type))
  select manual_key, row_number() over (partition by manual_key order by first_at) as row_no, visa_code, parent as parent_code, case when manual_key = 'visa' then '사증' else '체류' end as manual_kind, petition_type, '' as situation, '' as target,
    el || case when route = 'el' then more else '' end as eligibility, '' as procedure, fe || case when route = 'fees' then more else '' end as fees, va as visa_validity, si as single_stay, tt as total_stay, '' as restrictions, '' as exceptions, '' as obligations,
    case when route = 'score' then only_table else '' end as score_table, case when route = 'quota' then only_table else '' end as quota, '' as inviter, '' as recommendation,
    case when cd <> '' then '[공통서류]' || chr(10) || cd || chr(10) || chr(10) else '' end || '[기타서류]' || chr(10) || od as documents, questions as expected_questions, st as source, '' as prereq,
    case when visa_code like '%(SMALL)' then 'small next' when parent = 'Brand#1' then '' when parent in ('Brand#2', 'Brand#3') then 'next ' || parent else '' end as next_step,
    case when visa_code like '%(SMALL)' then '' when parent = 'Brand#1' then 'family' else '' end as companion, case when visa_code like '%(SMALL)' then '' when parent = 'Brand#1' then 'one' when parent in ('Brand#2', 'Brand#3') then 'few' else '' end as keywords from o"""


@query(_FINAL)
def final_rows(t, spark):
    """The 26 columns from parsed rows: keys, merges in order of first appearance, periods, routed table text, documents, flow lookups."""
    subs = spark.sql("select 'SMALL' as key, '' as prereq, 'small next' as next_step, '' as companion, '' as keywords")
    parents = spark.sql("select * from values ('Brand#1', '', '', 'family', 'one'), ('Brand#2', '', 'next Brand#2', '', 'few'), ('Brand#3', '', 'next Brand#3', '', 'few') as t(key, prereq, next_step, companion, keywords)")
    return final_table(part_fields(t), subs, parents).withColumn("row_no", F.col("row_no").cast("long"))


# --- page attachment ----------------------------------------------------------------------------

_NOISE = P.NOISE.replace("(?U)", "").replace(r"\s", SPACES[1:-1])
_ROWS_A_MANUAL = 20


def _best(hint: str) -> str:
    return f"""order by hits * (case when {hint} is null then 1.0 when abs(doc_id - {hint}) <= 8 then 2.5 when abs(doc_id - {hint}) > 60 then 0.15 else 1.0 end) desc, abs(doc_id - coalesce({hint}, 0)), first_start, doc_id limit 1"""


_SOURCE = "case item_id % 6 when 0 then 'see p. ' || (item_id * 7 % 50) when 1 then ' sec 3 ' when 2 then '' when 3 then 'p.x' when 4 then 'part' else 'Chapter ' || item_id end"
def attached_sql(rows_a_manual: int) -> str:
    return f"""with recursive t as (select item_id, item_id // {rows_a_manual} as manual, 'A' || (item_id % 3) as parent_code, text as eligibility, {_SOURCE} as source from benchmark),
  n as (select item_id, manual, 0 as nth, trim(eligibility) as raw from t union all select item_id, manual, 1, trim(source) from t),
  k as materialized (select n.item_id, n.manual, nth, regexp_replace(nfc_normalize(raw), '{_NOISE}', '', 'g') as k from n join t using (item_id) where len(raw) >= 8 and not contains(source, 'p.')),
  d as materialized (select doc_id, doc_id % (select max(item_id) // {rows_a_manual} + 1 from benchmark) as manual, regexp_replace(nfc_normalize(text), '{_NOISE}', '', 'g') as k from documents),
  s as (select item_id, manual, nth, tier, unnest(range(0, len(k) - width + 1, 8)) as pos, width, k from k join (values (0, 50), (1, 30), (2, 18)) w(tier, width) on len(k) >= width),
  sn as materialized (select item_id, manual, nth * 3 + tier as rank, pos, substr(k, pos + 1, width) as snippet from s),
  a as materialized (select item_id, rank, doc_id, count(*) as hits, min(pos) as first_start from sn join d on sn.manual = d.manual and contains(d.k, sn.snippet) group by 1, 2, 3),
  v as materialized (select * from a where rank = (select min(rank) from a b where b.item_id = a.item_id)),
  o as (select *, row_number() over (partition by manual order by item_id) as r, contains(trim(source), 'p.') as has, cast(nullif(regexp_extract(source, 'p\\.\\s*([0-9]+)', 1), '') as bigint) as kept,
    cast(nullif(regexp_extract(string_split(source, 'p. ')[-1], '[0-9]+'), '') as bigint) as own from t),
  h as (select item_id, own as hint from (select x.item_id, y.own, row_number() over (partition by x.item_id order by x.parent_code <> y.parent_code, abs(x.r - y.r), y.r > x.r) as nth from o x join o y on x.manual = y.manual and abs(x.r - y.r) between 1 and 29 and y.own <> 0) where nth = 1),
  z as materialized (select o.*, h.hint from o left join h using (item_id)),
  f as (select manual, cast(0 as bigint) as r, cast(null as bigint) as item_id, cast(null as bigint) as page, cast(null as bigint) as previous, cast(null as bigint) as carried, '' as page_by from (select distinct manual from t)
    union all select z.manual, z.r, z.item_id, case when z.has then z.kept else coalesce(b.p, nullif(f.carried, 0), z.hint) end, f.carried, coalesce(case when z.has then z.kept else coalesce(b.p, nullif(f.carried, 0), z.hint) end, f.carried),
      case when z.has then 'kept' when b.p is not null then 'text' when coalesce(nullif(f.carried, 0), z.hint) is not null then 'hint' else 'none' end
    from f join z on z.manual = f.manual and z.r = f.r + 1 left join lateral (select doc_id as p from v where v.item_id = z.item_id {_best('coalesce(nullif(f.carried, 0), z.hint)')}) b on true),
  g as (select f.*, case when previous <> 0 and previous <> page and abs(page - previous) <= 3 then 'p. ' || least(page, previous) || '~' || greatest(page, previous) else 'p. ' || page end as tag from f where item_id is not null)
  select g.item_id, case when page_by = 'kept' or page is null then source when trim(source) = '' then tag else trim(source) || ' (' || tag || ')' end as source, page_by from g join t using (item_id)"""


def benchmark_rows(t, rows_a_manual: int) -> tuple[DataFrame, DataFrame]:
    """Items as the rows of manuals of ``rows_a_manual`` items each, and documents as the manuals' pages."""
    kind = F.col("item_id") % 6
    source = F.when(kind == 0, F.concat(F.lit("see p. "), (F.col("item_id") * 7 % 50).cast("string"))).when(kind == 1, " sec 3 ").when(kind == 2, "").when(kind == 3, "p.x").when(kind == 4, "part").otherwise(F.concat(F.lit("Chapter "), F.col("item_id").cast("string")))
    rows = t("benchmark").select("item_id", F.floor(F.col("item_id") / rows_a_manual).alias("manual"), F.concat(F.lit("A"), (F.col("item_id") % 3).cast("string")).alias("parent_code"), F.col("text").alias("eligibility"), source.alias("source"))
    manuals = t("benchmark").agg((F.floor(F.max("item_id") / rows_a_manual) + 1).alias("manuals"))  # one row
    pages = t("documents").join(F.broadcast(manuals)).select((F.col("doc_id") % F.col("manuals")).alias("manual"), F.col("doc_id").alias("page"), "text")
    return rows, pages


@query(attached_sql(_ROWS_A_MANUAL))
def attached_pages(t, spark):
    """Rows of manuals of ``_ROWS_A_MANUAL`` items each get the pages on which their text or their source stands: three widths, columns in order, kept pages, hints, the carried page."""
    rows, pages = benchmark_rows(t, _ROWS_A_MANUAL)
    return locate.assign_pages(rows, pages, "manual", "item_id", ["eligibility"]).select("item_id", "source", "page_by")


@query(f"""with s as (select item_id, {_SOURCE} as source from benchmark) select item_id, contains(source, 'p.') as has_page, coalesce(cast(nullif(regexp_extract(source, 'p\\.\\s*([0-9]+)', 1), '') as bigint), -1) as page,
  string_split(source, 'p. ')[-1] as after from s""")
def page_markers(t, spark):
    kind = F.col("item_id") % 6
    source = F.when(kind == 0, F.concat(F.lit("see p. "), (F.col("item_id") * 7 % 50).cast("string"))).when(kind == 1, " sec 3 ").when(kind == 2, "").when(kind == 3, "p.x").when(kind == 4, "part").otherwise(F.concat(F.lit("Chapter "), F.col("item_id").cast("string")))
    return t("benchmark").select("item_id", F.contains(source, F.lit("p.")).alias("has_page"), F.coalesce(T.page_marker(source), F.lit(-1)).cast("long").alias("page"), T.after_last(source, "p. ").alias("after"))


# --- validation ---------------------------------------------------------------------------------


def _checked(t) -> DataFrame:
    """Blocks of parts against an index that lacks some chunks and has other hashes for some: one row per block row with its issues."""
    rows = blocks.row_sections(blocks.chunk_blocks(part_blocks(t), "p_brand", "text")).withColumn("fields", blocks.fields("section", False))
    size, name = F.col("p_size"), F.col("p_name")
    digest = F.substring(F.sha2(name, 256), 1, 16)
    index = t("part").where("p_size % 9 <> 0").select(F.format_string("part_%d", "p_partkey").alias("chunk_id"), F.when(size % 4 == 0, F.lit("0000000000000000")).otherwise(digest).alias("content_hash"), F.concat(F.lit("about "), "p_type").alias("source"))
    found = rows.join(index, "chunk_id", "left")
    field = lambda n: F.coalesce(F.try_element_at("fields", F.lit(n)), F.lit(""))
    claims = F.map_concat("fields", F.create_map(F.lit("visa_code"), F.substring_index(field("item_type"), "\n", 1), F.lit("fees"), F.concat(field("size"), F.lit("won")), F.lit("section_title"), field("item_name")))
    issues = validate.row_issues(claims, F.col("source"), ["item_type", "petition_type"], "[A-Z]{3,}", "[0-9]{2,}won", "[A-Z]+paper")
    return found.select(
        "p_brand", "chunk_id", "content_hash", "block_hash", (~F.col("content_hash").eqNullSafe(F.col("block_hash"))).alias("hash_drift"), "row_index", field("item_name").alias("section_title"), F.lit("").alias("petition_type"), F.lit("").alias("subsection_type"),
        F.when(F.col("content_hash").isNotNull(), issues).otherwise(F.array().cast("array<string>")).alias("issues"),
    )


_REPORT = """x as (select p_brand, 'part_' || p_partkey as chunk_id, substr(sha256(p_name), 1, 16) as block_hash, p_size % 9 <> 0 as known, case when p_size % 4 = 0 then '0000000000000000' else substr(sha256(p_name), 1, 16) end as h, p_size, p_name from part),
  y as (select *, not known or h <> block_hash as hash_drift, cast(known as bigint) as row_count,
    case when known then 'missing required fields: [''petition_type'']' || case when p_size >= 10 then '; amount not in source: [''' || p_size || 'won'']' else '' end else '' end as issues,
    case when not known then 'chunk_id not present in current index' when h <> block_hash then 'hash drift: index=' || h || ' vs block=' || block_hash else '' end as chunk_level_issues from x)"""


@query(f"""with {_REPORT} select p_brand, chunk_id, case when known then h else '' end as source_hash_index, block_hash as source_hash_block, hash_drift, row_count, row_count as rows_with_issues,
  case when known then p_name else '' end as section_title, issues, chunk_level_issues from y""")
def validation_report(t, spark):
    report = validate.chunk_report(_checked(t), "p_brand")
    each = lambda c, sep: F.array_join(F.transform("rows", lambda r: c(r)), sep)
    return report.select(
        "p_brand", "chunk_id", F.coalesce("content_hash", F.lit("")).alias("source_hash_index"), F.col("block_hash").alias("source_hash_block"), "hash_drift", "row_count", "rows_with_issues",
        each(lambda r: r.section_title, "|").alias("section_title"), each(lambda r: F.array_join(r.issues, "; "), "|").alias("issues"), F.array_join("chunk_level_issues", "; ").alias("chunk_level_issues"),
    )


@query(f"""with {_REPORT}, b as (select distinct p_brand from part union all select 'Brand#none'), s as (select p_brand, count(*) as n, sum(row_count)::bigint as r, sum(row_count)::bigint as w, count(*) filter (where row_count > 0 or hash_drift) as c from y group by 1)
  select b.p_brand, coalesce(n, -1) as normalized_chunks, coalesce(r, -1) as total_rows, coalesce(w, -1) as rows_with_issues, coalesce(c, -1) as chunks_with_issues, case when n is null then 'no normalized output yet' else '' end as status from b left join s on b.p_brand = s.p_brand""")
def validation_totals(t, spark):
    totals = validate.totals(validate.chunk_report(_checked(t), "p_brand"), "p_brand")
    brands = t("part").select("p_brand").unionByName(spark.sql("select 'Brand#none' as p_brand"))
    found = validate.status(brands, totals, "p_brand")
    return found.select("p_brand", *(F.coalesce(c, F.lit(-1)).cast("long").alias(c) for c in ("normalized_chunks", "total_rows", "rows_with_issues", "chunks_with_issues")), F.coalesce("status", F.lit("")).alias("status"))


@query(r"""with x as (select p_partkey, case when p_size % 3 = 0 then 'subtype_or_program code not in source: [''' || p_brand || 'X'']' end as a,
    case when p_size % 4 = 0 then 'mandatory_documents: none of the cited documents found in source: [''Apaper'', ''Bpaper'', ''Cpaper'']' end as b from part)
  select p_partkey, array_to_string(list_filter([a, b], lambda x: x is not null), '; ') as issues from x""")
def sub_code_and_document_issues(t, spark):
    """Rules on sub-codes and documents: documents count only if none of them is known, and three are shown, sorted."""
    size = F.col("p_size")
    sub = F.when(size % 3 == 0, F.concat("p_brand", F.lit("X"))).otherwise(F.col("p_brand"))
    papers = F.when(size % 4 == 0, "Dpaper Bpaper Apaper Cpaper").otherwise("Dpaper Bpaper")
    fields = F.create_map(F.lit("visa_code"), F.col("p_brand"), F.lit("subtype_or_program"), sub, F.lit("mandatory_documents"), papers)
    source = F.concat(F.lit("about "), "p_brand", F.when(size % 4 == 0, " Zpaper").otherwise(" Bpaper"))
    found = validate.row_issues(fields, source, [], "Brand#[0-9]+X?", "[0-9]+won", "[A-Z]paper")
    return t("part").select("p_partkey", F.array_join(found, "; ").alias("issues"))


@query("""select 'orders' as what, count(*) filter (where trim(o_orderstatus) = '') as missing, count(*) filter (where not regexp_matches(o_orderpriority, '^[1-5]-[A-Z]') and o_orderpriority not in ('0-NONE')) as odd, bool_and(o_orderstatus in ('F', 'O', 'P')) as within,
  bool_and(o_orderstatus not in ('X', 'Y')) as apart from orders""")
def schema_rules(t, spark):
    """Empty identity cells, codes that break their pattern, value sets that are within or apart from a list."""
    orders = t("orders")
    missing = quality.empty_cells(orders, ["o_orderstatus"]).select("missing")
    odd = quality.odd_parents(orders, "o_orderpriority", "^[1-5]-[A-Z]", ["0-NONE"]).agg(F.count("*").alias("odd"))
    values = orders.agg(F.collect_set("o_orderstatus").alias("v"))  # an enumeration's values
    sets = values.select(quality.within(F.col("v"), ["F", "O", "P"]).alias("within"), quality.apart(F.col("v"), F.array(F.lit("X"), F.lit("Y"))).alias("apart"))
    return missing.crossJoin(odd).crossJoin(sets).select(F.lit("orders").alias("what"), "missing", "odd", "within", "apart")  # one row each


# --- blocks, files, submissions -----------------------------------------------------------------


@query("""select p_partkey, 'a' || p_size || chr(10) || p_type as dense, 'a' || p_size || chr(10) || chr(10) || p_type as kept, p_name as last from part""")
def block_field_flavours(t, spark):
    """A value of indented lines with a blank line in it, by both readings; of a repeated name the last value."""
    section = F.concat(F.lit("\n- item: |\n    a"), F.col("p_size").cast("string"), F.lit("\n\n    "), "p_type", F.lit("\n- name: first\n- name: "), "p_name", F.lit("\n"))
    dense, kept = blocks.fields(section, False), blocks.fields(section, True)
    return t("part").select("p_partkey", dense["item"].alias("dense"), kept["item"].alias("kept"), kept["name"].alias("last"))


@query("""select 'csv' as kind, cast(p_partkey as varchar) as id, p_name || ', "' || p_type || '"' || chr(10) || 'x' as a, '' as b from part union all select 'jsonl', cast(event_id as varchar), event_type, props from events
  union all select 'report', cast(n_nationkey as varchar), n_name, '' from nation union all select 'lines', cast(r_regionkey as varchar), r_name, 'end' from region""")
def file_round_trips(t, spark):
    """Tables through each kind of file and back: CSV with a byte order mark and quoted line breaks, JSON lines, indented reports, text lines."""
    at = files.scratch(spark)
    cells = t("part").select(F.col("p_partkey").cast("string").alias("id"), F.concat("p_name", F.lit(', "'), "p_type", F.lit('"\nx')).alias("a"), F.lit("").alias("b"))
    files.write_csv(cells, f"{at}/csv", {"id": "번호", "a": "절차", "b": "출처"})
    csv = files.read_csv(spark, f"{at}/csv").toDF("id", "a", "b").select(F.lit("csv").alias("kind"), "id", "a", "b")
    events = t("events").select(F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("a"), F.col("props").alias("b"))
    files.write_jsonl(events, f"{at}/jsonl")
    jsonl = files.read_jsonl(spark, f"{at}/jsonl", "id string, a string, b string", "id").select(F.lit("jsonl").alias("kind"), "id", "a", "b")
    files.write_report(t("nation").select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("a"), F.lit("").alias("b")).coalesce(1), f"{at}/report")
    report = spark.read.text(f"{at}/report", wholetext=True).select(F.explode(F.split("value", r"(?m)(?<=^\})\n")).alias("v")).where("trim(v) <> ''").select(F.from_json("v", "id string, a string, b string").alias("r")).select(F.lit("report").alias("kind"), "r.*")
    t("region").select(F.concat_ws("\r\n", F.col("r_regionkey").cast("string"), "r_name", F.lit("end")).alias("value")).write.text(f"{at}/lines")
    return csv.unionByName(jsonl).unionByName(report).unionByName(_region_lines(spark, f"{at}/lines"))


def _region_lines(spark, path: str) -> DataFrame:
    """Each region is three lines; files hold whole regions in order."""
    per_file = files.read_lines(spark, path)
    groups = F.transform(F.sequence(F.lit(0), F.floor(F.size("lines") / 3).cast("int") - 1), lambda k: F.slice("lines", k * 3 + 1, 3))
    rows = per_file.where("size(lines) >= 3").select(F.explode(groups).alias("g"))
    return rows.select(F.lit("lines").alias("kind"), F.col("g")[0].alias("id"), F.col("g")[1].alias("a"), F.col("g")[2].alias("b"))


@query("""with x as (select conv_id, min(case when turn = 0 then text end) as first_text, list_sort(list_distinct(list(role))) as roles, max(turn) as turns from conversations group by 1),
  y as (select *, case when conv_id % 3 = 0 then '2026-02-01T00:00:00Z' else '2026-01-01T00:00:00.000Z' end as received from x)
  select conv_id, received, turns as seconds, array_to_string(roles, ', ') as who from y""")
def submission_list(t, spark):
    """Bodies are appended with the time of receipt, which a body of its own may replace, and read back, newest inserted first."""
    at = files.scratch(spark)
    said = t("conversations").groupBy("conv_id").agg(F.sort_array(F.collect_set("role")).alias("roles"), F.max("turn").alias("turns"))
    own = F.when(F.col("conv_id") % 3 == 0, F.lit("2026-02-01T00:00:00Z"))
    body = F.to_json(F.struct(F.col("conv_id").cast("string").alias("intervieweeName"), F.col("turns").alias("durationSeconds"), own.alias("receivedAt"), F.struct(F.col("roles").alias("who")).alias("answers")))
    submissions.append(said.select("conv_id", body.alias("body")), at, ["conv_id"], F.to_timestamp(F.lit("2026-01-01T00:00:00Z")))
    back = submissions.read_range(spark, at)
    return back.select(F.col("intervieweeName").cast("long").alias("conv_id"), F.col("receivedAt").alias("received"), F.col("durationSeconds").alias("seconds"), F.array_join(F.col("answers")["who"], ", ").alias("who"))


@query("""select * from (values ('a', 1, 'q1', 'single', 'First?', false, 'yes=Yes|no=No'), ('a', 2, 'q2', 'long', 'Why?', true, ''), ('b', 1, 'q3', 'multi', 'Which?', false, 'x=X')) v(section, place, id, kind, title, optional, options)""")
def catalogue_rows(t, spark):
    """A questionnaire's sections as one row per question."""
    option = lambda *pairs: [{"value": v, "label": lab} for v, lab in pairs]
    sections = [
        {"id": "a", "questions": [{"id": "q1", "kind": "single", "title": "First?", "options": option(("yes", "Yes"), ("no", "No"))}, {"id": "q2", "kind": "long", "title": "Why?", "optional": True}]},
        {"id": "b", "questions": [{"id": "q3", "kind": "multi", "title": "Which?", "options": option(("x", "X"))}]},
    ]
    return files.catalogue(spark, sections).withColumn("options", F.array_join(F.transform("options", lambda o: F.concat(o.value, F.lit("="), o.label)), "|"))
