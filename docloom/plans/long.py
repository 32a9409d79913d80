"""Queries over one long document, one large manual, overlapping ranges, a kept-up index and an ordered log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.operators import carried, claims, forms, intervals, line_blocks, locate, long_documents, rule_table, summaries, validate
from docloom.plans.queries import SPACES, _LINES_SQL, _hash_sql, document_chunks, joined, query
from docloom.plans.stages import _CHUNK_ROWS, _CHUNKS_SQL, attached_sql, benchmark_rows
from docloom.sources import chunk_index, files, page_cache, submissions

# --- all lines of a source as one document ------------------------------------------------------

_OPENING, _CLOSING, _TARGET = r"\A[A-M]", r"\A[N-Z]", 2000

_SOURCE_LINES = f"""{_LINES_SQL}, x as (select lines.doc_id, source, unnest(range(len(l))) as p, unnest(l) as line from lines join documents on lines.doc_id = documents.doc_id),
  e as (select source, row_number() over (partition by source order by doc_id, p) as i, len(line) + 1 as n, cast(regexp_matches(line, '^[A-M]') as bigint) as o, cast(regexp_matches(line, '^[N-Z]') as bigint) as c,
    cast(regexp_replace(line, '{SPACES}', '', 'g') <> '' as bigint) as f from x),
  s as (select source, cast(0 as bigint) as i, cast(0 as bigint) as depth, cast(null as bigint) as start, cast(null as bigint) as done from (select distinct source from e)
    union all select e.source, e.i,
      case when s.depth + e.o - e.c <= 0 and (s.start is not null or (e.o > 0 and s.depth = 0)) then 0 else s.depth + e.o - e.c end,
      case when s.depth + e.o - e.c <= 0 then case when s.start is not null or (e.o > 0 and s.depth = 0) then null else s.start end when e.o > 0 and s.depth = 0 and s.start is null then e.i else s.start end,
      case when s.depth + e.o - e.c <= 0 and (s.start is not null or (e.o > 0 and s.depth = 0)) then coalesce(s.start, e.i) end
    from s join e on s.source = e.source and e.i = s.i + 1)"""


def _source_lines(t) -> DataFrame:
    """Every line of every document, keyed by its source and ordered by document and place."""
    return t("documents").select("source", "doc_id", F.posexplode(T.split_lines("text")).alias("place", "line"))


@query(f"with recursive {_SOURCE_LINES} select source, done as first_line, i as last_line from s where done is not null")
def source_spans(t, spark):
    return long_documents.long_spans(_source_lines(t), "source", ["doc_id", "place"], "line", files.scratch(spark), _OPENING, _CLOSING)


@query(f"""with recursive {_SOURCE_LINES}, y as materialized (select e.*, s.done is not null as closes from e join s on e.source = s.source and e.i = s.i),
  g as (select source, cast(0 as bigint) as i, cast(0 as bigint) as size, cast(1 as bigint) as start, cast(0 as bigint) as tables, cast(0 as bigint) as f, false as cut from (select distinct source from e)
    union all select y.source, y.i, case when g.cut then 0 else g.size end + y.n, case when g.cut then y.i else g.start end, case when g.cut then 0 else g.tables end + cast(y.closes as bigint), case when g.cut then 0 else g.f end + y.f,
      case when g.cut then 0 else g.size end + y.n >= {_TARGET} and y.closes from g join y on g.source = y.source and y.i = g.i + 1),
  b as (select *, row_number() over (partition by source order by i desc) as back from g where i > 0)
  select source, start as start_line, i as end_line, size - 1 as char_count, tables as table_count from b where (cut or back = 1) and f > 0""")
def source_chunks(t, spark):
    return long_documents.long_chunks(_source_lines(t), "source", ["doc_id", "place"], "line", files.scratch(spark), _TARGET, _OPENING, _CLOSING)


# --- one manual that holds all rows -------------------------------------------------------------

_ONE = 10**9  # items in a manual


@query(attached_sql(_ONE))
def attached_pages_one(t, spark):
    """All benchmark items as one manual whose pages are all documents."""
    rows, pages = benchmark_rows(t, _ONE)
    return locate.assign_pages(rows, pages, "manual", "item_id", ["eligibility"]).select("item_id", "source", "page_by")


_CARRIED = f"""with recursive z as materialized (select doc_id, row_number() over (order by doc_id) as r, n_chars % 11 = 0 as has, case when n_chars % 3 <> 0 then n_chars % 97 end as kept, case when n_chars % 5 = 0 then n_chars % 50 end as hint, n_chars as n from documents),
  v as materialized (select doc_id, (n * (j + 3)) % 120 + 1 as page, (n * (j + 1)) % 5 + 1 as hits, (n // (j + 1)) % 30 as first_start from z join (values (0), (1), (2)) w(j) on j < n % 4),
  f as (select cast(0 as bigint) as r, cast(null as bigint) as doc_id, cast(null as bigint) as page, cast(null as bigint) as previous, cast(null as bigint) as carried, '' as page_by
    union all select z.r, z.doc_id, case when z.has then z.kept else coalesce(b.p, nullif(f.carried, 0), z.hint) end, f.carried, coalesce(case when z.has then z.kept else coalesce(b.p, nullif(f.carried, 0), z.hint) end, f.carried),
      case when z.has then 'kept' when b.p is not null then 'text' when coalesce(nullif(f.carried, 0), z.hint) is not null then 'hint' else 'none' end
    from f join z on z.r = f.r + 1 left join lateral (select page as p from v where v.doc_id = z.doc_id
      order by hits * (case when coalesce(nullif(f.carried, 0), z.hint) is null then 1.0 when abs(page - coalesce(nullif(f.carried, 0), z.hint)) <= 8 then 2.5 when abs(page - coalesce(nullif(f.carried, 0), z.hint)) > 60 then 0.15 else 1.0 end) desc,
        abs(page - coalesce(nullif(f.carried, 0), z.hint, 0)), first_start, page limit 1) b on true)
  select doc_id, coalesce(page, -1) as page, coalesce(previous, -1) as previous, page_by from f where doc_id is not null"""


@query(_CARRIED)
def carried_documents(t, spark):
    """The carried page through all documents as the rows of one manual; pages, hints and up to three candidates come from their lengths."""
    n = F.col("n_chars")
    candidates = F.filter(
        F.array(*(F.struct(F.lit(j).alias("j"), ((n * (j + 3)) % 120 + 1).alias("page"), ((n * (j + 1)) % 5 + 1).alias("hits"), (F.floor(n / (j + 1)) % 30).cast("int").alias("first_start")) for j in range(3))), lambda c: c.j < n % 4
    )
    rows = t("documents").select(
        "doc_id", F.lit(0).alias("manual"), (n % 11 == 0).alias("has_page"), F.when(n % 3 != 0, n % 97).alias("kept"), F.when(n % 5 == 0, n % 50).alias("hint"), F.transform(candidates, lambda c: F.struct(c.page, c.hits, c.first_start)).alias("candidates")
    )
    found = carried.carried(rows, "manual", "doc_id")
    return found.select("doc_id", F.coalesce("page", F.lit(-1)).alias("page"), F.coalesce("previous", F.lit(-1)).alias("previous"), F.col("by").alias("page_by"))


# --- line ranges --------------------------------------------------------------------------------

_STRIDE, _LENGTH = 15, 20


def _lines(t) -> DataFrame:
    return t("documents").select("doc_id", F.posexplode(T.split_lines("text")).alias("place", "line")).select("doc_id", (F.col("place") + 1).alias("line_no"), "line")


@query(f"""with {_LINES_SQL}, e as (select doc_id, unnest(range(1, len(l) + 1)) as line_no, unnest(l) as line from lines), r as (select doc_id, unnest(range(1, len(l) + 1, {_STRIDE})) as start_line from lines)
  select r.doc_id, r.start_line, count(*) as n_lines, md5(string_agg(line, chr(10) order by line_no)) as text_md5 from r join e on r.doc_id = e.doc_id and line_no between r.start_line and r.start_line + {_LENGTH - 1} group by 1, 2""")
def overlapping_ranges(t, spark):
    """Windows of lines, each overlapping the next one, over all documents."""
    lines = _lines(t)
    starts = lines.groupBy("doc_id").agg(F.max("line_no").alias("n")).select("doc_id", F.explode(F.sequence(F.lit(1), "n", F.lit(_STRIDE))).alias("start_line"))
    ranges = starts.withColumn("end_line", F.col("start_line") + _LENGTH - 1)
    found = intervals.range_texts(ranges, lines, "doc_id", ["doc_id", "start_line"], "start_line", "end_line")
    return found.select("doc_id", F.col("start_line").cast("long").alias("start_line"), "n_lines", F.md5("text").alias("text_md5"))


@query(f"""with recursive {_CHUNKS_SQL}, i as ({_CHUNK_ROWS}), y as (select i.chunk_id, i.doc_id, i.content_hash, k.text from i join k on i.doc_id = k.doc_id and i.start_line = k.first + 1),
  bk as (select chunk_id, doc_id, case when doc_id % 9 = 0 then 'gone' else chunk_id end as cited, case when doc_id % 4 = 0 then '0000000000000000' else content_hash end as block_hash from i)
  select bk.chunk_id, y.chunk_id is not null as known, y.content_hash is null or y.content_hash <> bk.block_hash as hash_drift, coalesce({_hash_sql('y.text')}, '') as source_hash,
    case when y.chunk_id is not null and list_contains(regexp_extract_all(y.text, '[A-Z][a-z]+'), 'The') then '' else 'visa code not in source: [''The'']' end as issues from bk left join y on bk.cited = y.chunk_id""")
def block_sources(t, spark):
    """Blocks that cite the chunk index by id, some of them wrongly, checked against the source lines of the range that the index names."""
    index = document_chunks(t("documents")).select("doc_id", "chunk_id", "content_hash", "start_line", "end_line")
    index = files.stored(index, f"{files.scratch(spark)}/index")
    cited = F.when(F.col("doc_id") % 9 == 0, F.concat(F.lit("gone_"), "chunk_id")).otherwise(F.col("chunk_id"))
    blocks = index.select("doc_id", F.col("chunk_id").alias("own"), cited.alias("chunk_id"), F.when(F.col("doc_id") % 4 == 0, "0000000000000000").otherwise(F.col("content_hash")).alias("block_hash"))
    found = validate.with_source(blocks, index, _lines(t), "doc_id")
    issues = validate.row_issues(F.create_map(F.lit("visa_code"), F.lit("The")), F.col("source"), [], "[A-Z][a-z]+", "[0-9]+won", "[A-Z]+paper")
    known = F.col("content_hash").isNotNull()
    return found.select(F.col("own").alias("chunk_id"), known.alias("known"), "hash_drift", F.when(known, T.content_hash("source")).otherwise("").alias("source_hash"), F.array_join(issues, "; ").alias("issues"))


# --- blocks over line rows ----------------------------------------------------------------------

_OPEN_SQL = "'<!-- x v1 chunk: ' || doc_id || ' hash: h' || doc_id || ' lines: ' || doc_id || '-' || (doc_id + 9) || ' -->'"
_MARKED = f"""{_LINES_SQL}, d as (select doc_id, source, lag(doc_id) over (partition by source order by doc_id) as before, l from lines join documents using (doc_id)),
  m as (select source, doc_id, -1 as p, {_OPEN_SQL} as line, doc_id as opens, null as closes from d union all select source, doc_id, p, line, null, null from (select source, doc_id, unnest(range(len(l))) as p, unnest(l) as line from d)
    union all select source, doc_id, 1000000000, '<!-- end chunk: ' || doc_id || ' -->', null, doc_id from d where doc_id % 4 <> 0
    union all select source, doc_id, 1000000001, '<!-- end chunk: ' || before || ' -->', null, before from d where before % 4 = 1),
  n as (select *, row_number() over (partition by source order by doc_id, p) as i from m), c as (select source, closes as id, max(i) as last_line from n where closes is not null group by 1, 2),
  b as (select n.source, opens as id, i as first_line, last_line from n join c on n.source = c.source and opens = c.id where last_line > i)"""


@query(f"""with {_MARKED} select b.source, cast(id as varchar) as chunk_id, 'h' || id as block_hash, id as start_line, id + 9 as end_line, first_line, last_line,
  md5(chr(10) || coalesce(string_agg(n.line, chr(10) order by n.i) || chr(10), '')) as body_md5 from b left join n on b.source = n.source and n.i > b.first_line and n.i < b.last_line group by 1, 2, 3, 4, 5, 6, 7""")
def source_blocks(t, spark):
    """All lines of a source as one text with a block around every document: some reach over the next document too, some are never closed."""
    at = files.scratch(spark)
    own = t("documents").select("source", "doc_id", F.coalesce(F.size(T.split_lines("text")).cast("long"), F.lit(0)).alias("n"), F.col("text").isNotNull().alias("held"))
    known = files.stored(carried.numbered(own, "source", ["doc_id"], f"{at}/docs", "nth"), f"{at}/known")
    earlier = known.select(F.col("source").alias("of"), (F.col("nth") + 1).alias("next"), F.col("doc_id").alias("before"))
    placed = known.join(earlier, (F.col("source") == F.col("of")) & (F.col("nth") == F.col("next")), "left").select("source", "doc_id", "before", "n", "held")
    closes = lambda when: F.coalesce(when.cast("long"), F.lit(0))
    size = F.when(F.col("held"), F.col("n") + 1 + closes(F.col("doc_id") % 4 != 0) + closes(F.col("before") % 4 == 1)).otherwise(0)
    # lines are numbered by their documents' numbers of lines: texts are not sorted
    based = carried.summed_before(placed.select("source", "doc_id", "before", size.alias("size")), "source", ["doc_id"], f"{at}/sizes", "size", "base")
    docs = t("documents").join(based.select("doc_id", "before", "base"), "doc_id").select("source", "doc_id", "before", "base", T.split_lines("text").alias("l"))
    name = F.col("doc_id").cast("string")
    opening = F.concat(F.lit("<!-- x v1 chunk: "), name, F.lit(" hash: h"), name, F.lit(" lines: "), name, F.lit("-"), (F.col("doc_id") + 9).cast("string"), F.lit(" -->"))
    closing = lambda c, when: F.when(when, F.concat(F.lit("<!-- end chunk: "), F.col(c).cast("string"), F.lit(" -->")))
    ends = F.array_compact(F.array(closing("doc_id", F.col("doc_id") % 4 != 0), closing("before", F.col("before") % 4 == 1)))
    lines = docs.select("source", "base", F.posexplode(F.concat(F.array(opening), "l", ends)).alias("place", "line"))
    numbered = files.stored(lines.select("source", (F.col("base") + F.col("place") + 1).alias("line_no"), "line"), f"{at}/numbered")
    found = line_blocks.line_blocks(numbered, "source")
    return found.select("source", "chunk_id", "block_hash", "start_line", "end_line", "first_line", "last_line", F.md5("body").alias("body_md5"))


# --- the index kept up by batches ---------------------------------------------------------------


@query(f"with recursive {_CHUNKS_SQL} select *, cast(case when doc_id % 5 = 0 or doc_id % 7 = 1 then 2 else 1 end as int) as made from ({_CHUNK_ROWS})")
def incremental_chunks(t, spark):
    """A first batch lacks some documents, has others in another wording and some that go away; the second brings all documents as they are. ``made``: the batch that a chunk was made in."""
    at = files.scratch(spark)
    docs = t("documents").select("doc_id", "text")
    was = F.when(F.col("doc_id") % 7 == 1, F.concat("text", F.lit(" was"))).otherwise(F.col("text"))
    first = docs.where("doc_id % 5 <> 0").select("doc_id", was.alias("text")).unionByName(docs.where("doc_id % 11 = 3").select((-F.col("doc_id") - 1).alias("doc_id"), "text"))
    build = lambda n: lambda rows: document_chunks(rows).drop("text").withColumn("made", F.lit(n))
    chunk_index.update_index(first, at, "doc_id", "text", build(1))
    chunk_index.update_index(docs, at, "doc_id", "text", build(2))
    found = chunk_index.read_index(spark, at).withColumn("codes", joined("codes"))
    return found.withColumns({c: F.col(c).cast("long") for c in ("start_line", "end_line", "char_count", "table_count")})


# --- submissions as a log -----------------------------------------------------------------------


@query("""with x as (select conv_id, list_sort(list_distinct(list(role))) as roles, max(turn) as turns from conversations group by 1),
  y as (select *, row_number() over (order by conv_id % 2, conv_id) as n, count(*) over () as total from x), z as (select *, total - n as place from y)
  select 'all' as part, place, conv_id, case conv_id % 3 when 0 then '2026-02-01T00:00:00Z' when 1 then '' else '2026-01-01T00:00:00.000Z' end as received, turns as seconds, array_to_string(roles, ', ') as who, case when conv_id % 2 = 0 then '[draft] ' || conv_id else 'plain' end as remark from z
  union all select 'range', place, conv_id, '', turns, '', '' from z where place between 3 and total - 5""")
def submission_ranges(t, spark):
    """Bodies in two batches, read newest inserted first: the whole log, and a range with an end counted from the oldest."""
    at = files.scratch(spark)
    said = t("conversations").groupBy("conv_id").agg(F.sort_array(F.collect_set("role")).alias("roles"), F.max("turn").alias("turns"))
    kind = F.col("conv_id") % 3
    own = F.when(kind == 0, F.lit(',"receivedAt":"2026-02-01T00:00:00Z"')).when(kind == 1, ',"receivedAt":null').otherwise("")
    remark = F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit("[draft] "), F.col("conv_id").cast("string"))).otherwise("plain")
    body = F.to_json(F.struct(F.col("conv_id").cast("string").alias("intervieweeName"), F.col("turns").alias("durationSeconds"), F.struct(F.col("roles").alias("who"), remark.alias("remark")).alias("answers")))
    bodies = files.stored(said.select("conv_id", F.concat(F.substring(body, F.lit(1), F.length(body) - 1), own, F.lit("}")).alias("body")), f"{at}/bodies")
    for rest in (0, 1):
        submissions.append(bodies.where(F.col("conv_id") % 2 == rest), f"{at}/log", ["conv_id"], F.to_timestamp(F.lit("2026-01-01T00:00:00Z")))
    name, seconds = F.col("intervieweeName").cast("long").alias("conv_id"), F.col("durationSeconds").alias("seconds")
    whole = submissions.read_range(spark, f"{at}/log").select(
        F.lit("all").alias("part"), "place", name, F.coalesce("receivedAt", F.lit("")).alias("received"), seconds, F.array_join(F.col("answers")["who"], ", ").alias("who"), F.col("answers")["remark"][0].alias("remark")
    )
    part = submissions.read_range(spark, f"{at}/log", 3, -5).select(F.lit("range").alias("part"), "place", name, F.lit("").alias("received"), seconds, F.lit("").alias("who"), F.lit("").alias("remark"))
    return whole.unionByName(part)


# --- page caches --------------------------------------------------------------------------------

_HOST = "regexp_extract(url, '://([^/?#]*)', 1)"


@query(f"""with p as (select {_HOST} as manual, row_number() over (partition by {_HOST} order by page_id) as page, html from pages)
  select 'all' as part, manual, page, len(html) as n_chars, md5(html) as text_md5 from p union all select 'range', manual, page, len(html), md5(html) from p where page between 2 and 3""")
def page_texts(t, spark):
    """Every host's pages as the pages of a manual: written as caches, read back whole and by a page range that chooses the files to open."""
    at = files.scratch(spark)
    pages = t("pages").select(F.regexp_extract("url", "://([^/?#]*)", 1).alias("manual"), "page_id", F.col("html").alias("text"))
    numbered = carried.numbered(pages, "manual", ["page_id"], f"{at}/number", "page").select("manual", "page", "text")
    page_cache.write_pages(numbered, f"{at}/caches", f"{at}/work")
    told = lambda name, rows: rows.select(F.lit(name).alias("part"), "manual", "page", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("text_md5"))
    return told("all", page_cache.read_pages(spark, f"{at}/caches")).unionByName(told("range", page_cache.read_pages(spark, f"{at}/caches", least=2, most=3)))


# --- rules as a table ---------------------------------------------------------------------------


@query(f"""with {_LINES_SQL}, e as (select doc_id, unnest(range(1, len(l) + 1)) as line_no, unnest(l) as line from lines), w as (select distinct unnest(regexp_extract_all(text, '[A-Za-z]+')) as w from benchmark),
  r as (select w, cast('0x' || substr(md5(w), 1, 8) as bigint) as rule, upper(substr(w, 1, 1)) as label from w where len(w) >= 4), k as (select distinct doc_id, line_no, unnest(regexp_extract_all(line, '[A-Za-z]+')) as w from e),
  h as (select doc_id, line_no, rule, label from k join r using (w)), f as (select doc_id, line_no, label, min(rule) as rule, count(*) as n from h group by 1, 2, 3),
  g as (select doc_id, line_no, min(rule) as first, string_agg(label, ',' order by rule) as labels, sum(n) as n from f group by 1, 2)
  select doc_id, count(*) as n_lines, cast(sum(n) as bigint) as n_hits, md5(string_agg(line_no || ':' || first || ':' || labels, ';' order by line_no)) as routes_md5 from g group by 1""")
def rule_routes(t, spark):
    """Every word of the benchmark of four letters or more is a rule with a priority by hash, labelled by its initial: first match and all labels of every line."""
    words = t("benchmark").select(F.explode(T.extract_all("text", "[A-Za-z]+")).alias("w")).where("length(w) >= 4").distinct()
    number = F.conv(F.substring(F.md5("w"), 1, 8), 16, 10).cast("long")
    pattern = F.concat(F.lit("(?<![A-Za-z])"), "w", F.lit("(?![A-Za-z])"))
    rules = words.select(number.alias("rule"), number.alias("priority"), F.upper(F.substring("w", 1, 1)).alias("label"), F.col("w").alias("literal"), pattern.alias("pattern"))
    lines = rule_table.routed_lines(_lines(t), rules, ["doc_id", "line_no"])
    route = F.concat(F.col("line_no").cast("string"), F.lit(":"), F.col("first").cast("string"), F.lit(":"), F.array_join("labels", ","))
    whole = F.md5(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", route.alias("r")))), lambda x: x.r), ";"))
    return lines.groupBy("doc_id").agg(F.count("*").alias("n_lines"), whole.alias("routes_md5"), F.sum("n_rules").alias("n_hits"))


# --- summaries ----------------------------------------------------------------------------------

_BY_SIZE = "order by char_count desc, start_line, chunk_id"


@query(f"""with recursive {_CHUNKS_SQL}, i as ({_CHUNK_ROWS}), z as (select lang, lang || ':' || chunk_id as chunk_id, start_line, char_count, table_count, oversized, case when codes = '' then [] else string_split(codes, '|') end as cs from i join documents on i.doc_id = documents.doc_id),
  s as (select lang, grouping(lang) = 1 as all_manuals, count(*) as chunks, count(*) filter (where oversized) as oversized, min(char_count) as min_char_count, max(char_count) as max_char_count, min(table_count) as min_table_count, max(table_count) as max_table_count,
    min(len(cs)) as min_codes, max(len(cs)) as max_codes, cast(floor(sum(char_count) / count(*)) as bigint) as avg_char_count, cast(floor(sum(table_count) / count(*)) as bigint) as avg_table_count, cast(floor(sum(len(cs)) / count(*)) as bigint) as avg_codes from z group by grouping sets ((lang), ())),
  r as (select *, chunk_id || '=' || char_count || '=' || array_to_string(cs[:6], ',') as told, row_number() over (partition by lang {_BY_SIZE}) as own, row_number() over ({_BY_SIZE}) as of_all from z where oversized),
  a as (select lang, false as all_manuals, string_agg(told, '|' order by own) as largest from r where own <= 5 group by 1 union all select null, true, string_agg(told, '|' order by of_all) from r where of_all <= 5)
  select coalesce(s.lang, '') as lang, s.* exclude (lang), coalesce(a.largest, '') as largest from s left join a on s.lang is not distinct from a.lang and s.all_manuals = a.all_manuals""")
def chunk_summaries(t, spark):
    """The chunk index summed up by language and in all, with the five largest oversized chunks and the first six codes of each."""
    keyed = t("documents").select(F.concat("lang", F.lit(":"), F.col("doc_id").cast("string")).alias("doc_id"), "text")
    chunks = document_chunks(keyed).withColumn("lang", F.substring_index("doc_id", ":", 1))
    found = summaries.summaries(chunks, "lang", "start_line")
    told = F.transform("largest", lambda x: F.concat(x.chunk_id, F.lit("="), x.char_count.cast("string"), F.lit("="), F.array_join(x.codes, ",")))
    return found.withColumns({"lang": F.coalesce("lang", F.lit("")), "largest": F.array_join(told, "|")})


# --- claims against a large source --------------------------------------------------------------


@query("""with b as (select distinct unnest(regexp_extract_all(html, '[A-Z][a-z]+')) as w from pages), c as (select doc_id, unnest(list_distinct(regexp_extract_all(text, '[A-Z][a-z]+'))) as w from documents)
  select doc_id, count(*) as n_claimed, count(*) filter (where b.w is null) as n_invented from c left join b on c.w = b.w group by 1""")
def claims_against_pages(t, spark):
    """The capitalised words of every document, and how many of them no page holds."""
    words = lambda c: F.explode(T.document_names(c, "[A-Z][a-z]+")).alias("w")
    found = claims.checked(t("documents").select("doc_id", words("text")), ["doc_id"], "w", t("pages").select(words("html")), "w", files.scratch(spark))
    return found.groupBy("doc_id").agg(F.count("*").alias("n_claimed"), F.count_if(~F.col("known")).alias("n_invented"))


# --- a catalogue and its answers as tables ------------------------------------------------------


@query("""with q as (select conv_id, turn, role, text, row_number() over (partition by conv_id, role order by turn) as place, case when role <> 'user' and turn > 0 then turn - 1 end as depends_on from conversations),
  a as (select conv_id, turn, role as value from conversations where len(text) % 3 <> 0)
  select q.conv_id, q.turn, q.role as section, q.place, q.depends_on is null or coalesce(d.value in ('user', 'system'), false) as visible, case o.value when 'user' then 'User' when 'assistant' then 'Model' else coalesce(o.value, '(no answer)') end as shown
  from q left join a d on q.conv_id = d.conv_id and q.depends_on = d.turn left join a o on q.conv_id = o.conv_id and q.turn = o.turn""")
def catalogue_joins(t, spark):
    """Conversations as nested catalogues, a section per role and a question per turn: flattened, joined with the answers their dependencies name, and with their options' labels."""
    labels = F.array(*(F.struct(F.lit(v).alias("value"), F.lit(lab).alias("label")) for v, lab in (("user", "User"), ("assistant", "Model"))))
    depends = F.when((F.col("role") != "user") & (F.col("turn") > 0), (F.col("turn") - 1).cast("string"))
    question = F.struct(F.col("turn").alias("at"), F.col("turn").cast("string").alias("id"), depends.alias("depends_on"), F.array(F.lit("user"), F.lit("system")).alias("values"), labels.alias("options"))
    sections = t("conversations").groupBy("conv_id", F.col("role").alias("section")).agg(F.sort_array(F.collect_list(question)).alias("questions"))
    catalogue = sections.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("section", "questions"))).alias("sections"))
    answers = t("conversations").where("length(text) % 3 <> 0").select("conv_id", F.col("turn").cast("string").alias("question"), F.lit(0).alias("nth"), F.col("role").alias("value"))
    questions = forms.questions_of(catalogue, ["conv_id"])
    shown = forms.shown_answers(questions, answers, ["conv_id"])
    found = forms.visible_questions(questions, answers, ["conv_id"]).join(shown, ["conv_id", "id"])
    return found.select("conv_id", F.col("at").alias("turn"), "section", F.col("place").cast("long").alias("place"), "visible", "shown")
