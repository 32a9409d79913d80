"""The registered queries of the document-table operators, bound to the driver's tables, each with its SQL counterpart.

Patterns use explicit classes, so that Java's and RE2's dialects agree; every ordered aggregate has a total order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.operators import blocks, chunk, enrich, forms, locate, quality, rollup, rules, validate
from docloom.sources import files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

SPACES = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NOISE = r"(?U)[\s,.:;()!?'\"-]+"
SQL_NOISE = NOISE.replace("(?U)", "").replace(r"\s", SPACES[1:-1]).replace("'", "''")
STRIP = rf"regexp_replace($, '^{SPACES}+|{SPACES}+$', '', 'g')"
LINES = r"regexp_split_to_array({}, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    """Registers a function of (t, spark), where t(name) is a table, under its name."""

    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: table(spark, sf_dir, name), spark)
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def joined(c) -> F.Column:
    return F.array_join(c, "|")


# --- lines, scalar functions --------------------------------------------------------------------

_LINES_SQL = f"""lines as (select doc_id, case when l[len(l)] = '' then l[:len(l)-1] else l end as l
  from (select doc_id, {LINES.format('text')} as l from documents))"""


@query(f"with {_LINES_SQL} select doc_id, unnest(range(1, len(l) + 1)) as line_no, unnest(l) as line from lines")
def lines_explode(t, spark):
    rows = t("documents").select("doc_id", F.posexplode(T.split_lines("text")).alias("pos", "line"))
    return rows.select("doc_id", (F.col("pos") + 1).cast("long").alias("line_no"), "line")


@query(f"with {_LINES_SQL} select doc_id, len(l) as n_lines, array_to_string(l[2:4], chr(10)) as part from lines where len(l) >= 2")
def range_slice(t, spark):
    lines = t("documents").select("doc_id", T.split_lines("text").alias("l")).where("size(l) >= 2")
    return lines.select("doc_id", F.size("l").cast("long").alias("n_lines"), F.array_join(F.slice("l", 2, 3), "\n").alias("part"))


@query("""with m as (select p_partkey, regexp_extract_all(p_brand || ' ' || p_name || ' ' || p_type || ' ' || p_brand, 'Brand ?#[0-9]+|[a-z]+') as m from part),
  v as (select p_partkey, unnest(m) as v, unnest(range(len(m))) as i from m), d as (select p_partkey, v, min(i) as i from v group by 1, 2)
  select p_partkey, string_agg(v, '|' order by i) as codes, count(*) as n from d group by 1""")
def extract_codes_ordered(t, spark):
    codes = T.codes(F.concat_ws(" ", "p_brand", "p_name", "p_type", "p_brand"), "Brand ?#[0-9]+|[a-z]+")
    return t("part").select("p_partkey", joined(codes).alias("codes"), F.size(codes).cast("long").alias("n"))


@query("""select doc_id, array_to_string(regexp_extract_all(text, '[0-9]+'), '|') as numbers, len(regexp_extract_all(text, '[0-9]+')) as n,
  case when len(regexp_extract(text, '[0-9]+')) between 1 and 18 then cast(regexp_extract(text, '[0-9]+') as bigint) else -1 end as first_number from documents""")
def extract_numbers(t, spark):
    found = T.extract_all("text", "[0-9]+")
    first = F.regexp_extract("text", "[0-9]+", 0)
    return t("documents").select("doc_id", joined(found).alias("numbers"), F.size(found).cast("long").alias("n"), F.when(F.length(first).between(1, 18), T.first_integer("text")).otherwise(-1).alias("first_number"))


@query("""with m as (select doc_id, regexp_extract_all(text, '[A-Za-z]+(?:tion|ness|ment|erst)') as m from documents),
  v as (select doc_id, unnest(m) as v, unnest(range(len(m))) as i from m), d as (select doc_id, v, min(i) as i from v group by 1, 2)
  select documents.doc_id, coalesce(string_agg(v, '|' order by i), '') as nouns from documents left join d on documents.doc_id = d.doc_id group by 1""")
def suffix_nouns(t, spark):
    return t("documents").select("doc_id", joined(T.document_names("text", "[A-Za-z]+(?:tion|ness|ment|erst)")).alias("nouns"))


def _hash_sql(c: str) -> str:
    return f"substr(sha256(trim(regexp_replace({c}, '{SPACES}+', ' ', 'g'))), 1, 16)"


@query(f"select 'd' || doc_id as id, {_hash_sql('text')} as hash from documents union all select 'p' || page_id, {_hash_sql('html')} from pages")
def content_hash16(t, spark):
    docs = t("documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), T.content_hash("text").alias("hash"))
    return docs.unionByName(t("pages").select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("id"), T.content_hash("html").alias("hash")))


_KEY = f"regexp_replace(nfc_normalize(text), '{SQL_NOISE}', '', 'g')"


@query(f"select doc_id, {_KEY} as match_text from documents")
def match_normalise(t, spark):
    return t("documents").select("doc_id", T.match_key("text", NOISE, None).alias("match_text"))


@query("""with c as (select doc_id, string_split(text, '') as c from documents)
  select doc_id, array_to_string(list_filter(c, lambda x, i: i = 1 or x <> c[i - 1] or x < 'a' or x > 'z' or len(x) <> 1), '') as collapsed from c""")
def repeat_collapse(t, spark):
    return t("documents").select("doc_id", T.collapse_repeats("text", "[a-z]").alias("collapsed"))


@query(f"""with k as (select item_id, {_KEY} as k from benchmark), s as (select item_id, k, unnest(range(0, len(k) - 49, 8)) as pos from k where len(k) >= 50)
  select item_id, pos, substr(k, pos + 1, 50) as snippet from s""")
def snippets_50_8(t, spark):
    keyed = t("benchmark").select("item_id", T.match_key("text", NOISE, None).alias("k"))
    return keyed.select("item_id", F.posexplode(T.snippets("k", 50, 8)).alias("pos", "snippet")).select("item_id", (F.col("pos") * 8).cast("long").alias("pos"), "snippet")


@query("""select p_partkey, p_brand || ' (' || p_type || ')' as code, p_brand as parent, p_type as sub,
  case when p_size > 25 then p_name || ' (' || p_type || ')' else p_type end as tagged, coalesce(nullif(case when p_size > 25 then p_name else '' end, ''), p_type) as label from part""")
def derived_key(t, spark):
    rows = t("part").withColumn("code", T.full_code("p_brand", "p_type"))
    name = F.when(F.col("p_size") > 25, F.col("p_name")).otherwise("")
    return rows.select("p_partkey", "code", T.parent_of("code").alias("parent"), T.sub_of("code").alias("sub"), T.with_tag(name, F.col("p_type")).alias("tagged"), T.first_non_empty(name, "p_type").alias("label"))


@query("""select s.doc_id, array_to_string(list_filter([case when lang <> '' then 'LANG' || chr(10) || lang end, case when source <> '' then 'SOURCE' || chr(10) || source end,
  case when coalesce(cast(l.quality as varchar), '') <> '' then 'QUALITY' || chr(10) || l.quality end], lambda x: x is not null), chr(10) || chr(10)) as sections
  from documents s left join labels l on s.doc_id = l.doc_id""")
def section_concat(t, spark):
    rows = t("documents").select("doc_id", "lang", "source").join(t("labels").select("doc_id", F.col("quality").cast("string").alias("q")), "doc_id", "left")
    return rows.select("doc_id", T.labelled_sections([("LANG", F.col("lang")), ("SOURCE", F.col("source")), ("QUALITY", F.col("q"))]).alias("sections"))


@query(f"""select doc_id, array_to_string(list_filter(string_split(text, chr(10)), lambda x: {STRIP.replace('$', 'x', 1)} <> '')[:4], chr(10)) as head from documents""")
def cap4_lines(t, spark):
    return t("documents").select("doc_id", rollup.capped_lines("text").alias("head"))


@query("""select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, event_type || ':' || coalesce(json_extract_string(props, '$.k'), '') as kind_text,
  event_type as kind from events""")
def json_parse_props(t, spark):
    k = F.get_json_object("props", "$.k")
    text = F.concat("event_type", F.lit(":"), F.coalesce(k, F.lit("")))
    return t("events").select("event_id", k.cast("long").alias("k"), text.alias("kind_text"), T.kind_before(text).alias("kind"))


# --- routing and classification -----------------------------------------------------------------


@query("""select doc_id, case when regexp_matches(text, '[0-9]{6,}') then 'numbers' when regexp_matches(text, '[Ll]icen[cs]e') then 'license'
  when regexp_matches(text, '[^ -~\\s]') then 'accents' else 'plain' end as route, count(*) over (partition by lang) as n_lang from documents""")
def first_match_route(t, spark):
    route = rules.first_match("text", [("numbers", "[0-9]{6,}"), ("license", "[Ll]icen[cs]e"), ("accents", r"[^ -~\s]")], "plain")
    counts = t("documents").groupBy("lang").agg(F.count("*").alias("n_lang")).withColumnRenamed("lang", "of")  # texts are not shuffled
    routed = t("documents").select("doc_id", "lang", route.alias("route"))
    return routed.join(counts, F.col("lang").eqNullSafe(F.col("of"))).select("doc_id", "route", "n_lang")


_FAMILY = """(select doc_id, coalesce(string_agg(s, chr(10) order by i), '') as v from (select doc_id, s, min(i) as i from hit where {} group by 1, 2) group by 1)"""


@query(rf"""with l as (select doc_id, string_split(text, chr(10)) as l from documents), e as (select doc_id, unnest(l) as s, unnest(range(len(l))) as i from l),
  st as (select doc_id, {STRIP.replace('$', 's', 1)} as s, i from e), hit as (select *, regexp_matches(s, '[0-9]') as a, regexp_matches(s, '[A-Z][A-Z]') as b, regexp_matches(s, '^[a-z ]+$') as p from st where s <> '')
  select d.doc_id, coalesce(x.v, '') as digits, coalesce(y.v, '') as capitals from documents d
  left join {_FAMILY.format('a or (not b and p)')} x on d.doc_id = x.doc_id left join {_FAMILY.format('b or (not a and not b and not p)')} y on d.doc_id = y.doc_id""".replace("(not b and p)", "(not a and not b and p)"))
def multi_label_lines(t, spark):
    cols = rules.lines_by_family("text", {"digits": "[0-9]", "capitals": "[A-Z][A-Z]"}, ("digits", r"^[a-z ]+$"), "capitals")
    return t("documents").select("doc_id", *(c.alias(n) for n, c in cols.items()))


# --- grouping in first-appearance order ---------------------------------------------------------

_ORDER = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate"
_LINE_ORDER = _ORDER.split(", ")


@query(f"""with v as (select l_orderkey, l_returnflag || l_linestatus as v, row_number() over (partition by l_orderkey order by {_ORDER}, l_returnflag, l_linestatus) as i from lineitem),
  d as (select l_orderkey, v, min(i) as i from v group by 1, 2) select l_orderkey, string_agg(v, ';' order by i) as merged from d group by 1""")
def group_merge_distinct(t, spark):
    rows = t("lineitem").withColumn("v", F.concat("l_returnflag", "l_linestatus"))
    return rollup.merge_groups(rows, ["l_orderkey"], [*_LINE_ORDER, "l_returnflag", "l_linestatus"], {"merged": ["v"]}, ";", few=True).select("l_orderkey", "merged")


@query(f"""with r as (select l_orderkey, l_returnflag, l_linestatus, row_number() over (partition by l_orderkey order by {_ORDER}, l_returnflag, l_linestatus) as i from lineitem),
  v as (select l_orderkey, l_returnflag as v, i * 2 as i from r union all select l_orderkey, l_linestatus, i * 2 + 1 from r), d as (select l_orderkey, v, min(i) as i from v group by 1, 2)
  select l_orderkey, string_agg(v, ';' order by i) as merged from d group by 1""")
def multi_field_merge(t, spark):
    return rollup.merge_groups(t("lineitem"), ["l_orderkey"], [*_LINE_ORDER, "l_returnflag", "l_linestatus"], {"merged": ["l_returnflag", "l_linestatus"]}, ";", few=True).select("l_orderkey", "merged")


@query("""with g as (select user_id, event_type, min(event_id) as first_event, count(*) as n from events group by 1, 2)
  select user_id, event_type, n, row_number() over (partition by user_id order by first_event) as place from g""")
def group_first_order(t, spark):
    g = t("events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("first_event"), F.count("*").alias("n"))
    return g.select("user_id", "event_type", "n", F.row_number().over(Window.partitionBy("user_id").orderBy("first_event")).cast("long").alias("place"))


@query("select user_id, event_id, event_type, value from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as k from events) where k = 1")
def latest_wins(t, spark):
    return enrich.latest(t("events").select("ts", "event_id", "user_id", "event_type", "value"), "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")


@query("""select p_partkey, case when p_type = 'SMALL' then 'small next' when p_brand = 'Brand#1' then '' when p_brand in ('Brand#2', 'Brand#3') then 'next ' || p_brand else '' end as next_step,
  case when p_type = 'SMALL' then '' when p_brand = 'Brand#1' then 'one' when p_brand in ('Brand#2', 'Brand#3') then 'few' else '' end as keywords from part""")
def flow_override(t, spark):
    subs = spark.sql("select 'SMALL' as key, 'small next' as next_step, '' as keywords")
    parents = spark.sql("select * from values ('Brand#1', '', 'one'), ('Brand#2', 'next Brand#2', 'few'), ('Brand#3', 'next Brand#3', 'few') as t(key, next_step, keywords)")
    return enrich.override_lookup(t("part"), "p_type", "p_brand", subs, parents, ["next_step", "keywords"]).select("p_partkey", "next_step", "keywords")


# --- chunks and spans ---------------------------------------------------------------------------

_PAGE_LINES = """pl as (select page_id, string_split(replace(html, '>', '>' || chr(1)), chr(1)) as l from pages),
  m as (select page_id, unnest(range(len(l))) as i, unnest(l) as line from pl),
  c as (select page_id, i, len(line) as n, len(regexp_extract_all(line, '<p\\b')) as o, len(regexp_extract_all(line, '</p\\s*>')) as c from m),
  s as (select page_id, cast(-1 as bigint) as i, cast(0 as bigint) as depth, cast(null as bigint) as start, cast(null as bigint) as done from pages
    union all select c.page_id, c.i,
      case when s.depth + c.o - c.c <= 0 and (s.start is not null or (c.o > 0 and s.depth = 0)) then 0 else s.depth + c.o - c.c end,
      case when s.depth + c.o - c.c <= 0 then case when s.start is not null or (c.o > 0 and s.depth = 0) then null else s.start end when c.o > 0 and s.depth = 0 and s.start is null then c.i else s.start end,
      case when s.depth + c.o - c.c <= 0 and (s.start is not null or (c.o > 0 and s.depth = 0)) then coalesce(s.start, c.i) end
    from s join c on s.page_id = c.page_id and c.i = s.i + 1)"""


def _page_lines(t) -> DataFrame:
    return t("pages").select("page_id", F.split(F.replace("html", F.lit(">"), F.lit(">\x01")), "\x01", -1).alias("lines"))


@query(f"with recursive {_PAGE_LINES} select page_id, done as first_line, i as last_line from s where done is not null")
def table_spans(t, spark):
    found = _page_lines(t).select("page_id", F.explode(chunk.spans(F.col("lines"), r"<p\b", r"</p\s*>")).alias("s"))
    return found.select("page_id", F.col("s.start").cast("long").alias("first_line"), F.col("s.end").cast("long").alias("last_line"))


@query(f"""with recursive {_PAGE_LINES}, x as (select c.page_id, c.i, c.n, s.done is not null as closes from c join s on c.page_id = s.page_id and c.i = s.i),
  g as (select page_id, cast(-1 as bigint) as i, cast(0 as bigint) as size, cast(0 as bigint) as start, cast(0 as bigint) as tables, false as cut from pages
    union all select x.page_id, x.i, case when g.cut then 0 else g.size end + x.n + 1, case when g.cut then x.i else g.start end, case when g.cut then 0 else g.tables end + cast(x.closes as bigint),
      case when g.cut then 0 else g.size end + x.n + 1 >= 2000 and x.closes from g join x on g.page_id = x.page_id and x.i = g.i + 1),
  e as (select *, row_number() over (partition by page_id order by i desc) as back from g where i >= 0)
  select page_id, start + 1 as start_line, i + 1 as end_line, tables as table_count from e where cut or back = 1""")
def greedy_chunks(t, spark):
    lines = _page_lines(t)
    cut = lines.select("page_id", F.explode(chunk.greedy_cuts(F.col("lines"), 2000, r"<p\b", r"</p\s*>")).alias("c"))
    return cut.select("page_id", (F.col("c.start") + 1).cast("long").alias("start_line"), (F.col("c.end") + 1).cast("long").alias("end_line"), F.col("c.tables").cast("long").alias("table_count"))


def document_chunks(docs: DataFrame, target: int = 2000) -> DataFrame:
    """Whole documents as chunks of lines; every line that ends a sentence may end a chunk."""
    lines = docs.select("doc_id", T.split_lines("text").alias("lines"))
    return chunk.chunk_documents(lines, "doc_id", "lines", target=target, maximum=2 * target, opening=r"\A.", closing=r"\.\s*\z", code="[A-Z][a-z]+[0-9]+")


@query("""select count(*) as chunks, min(n_chars) as min_chars, max(n_chars) as max_chars, cast(floor(sum(n_chars) / count(*)) as bigint) as avg_chars,
  sum(len(regexp_extract_all(text, chr(10)))) ::bigint as tables, count(*) filter (where n_chars > 15000) as oversized from documents""")
def chunk_stats(t, spark):
    rows = t("documents").select("n_chars", T.count_matches("text", "\n").cast("long").alias("table_count"), (F.col("n_chars") > 15000).alias("oversized"))
    return chunk.chunk_stats(rows, "n_chars")


@query("select doc_id, n_chars from documents where n_chars > 5000 order by n_chars desc, doc_id limit 5")
def oversized_top5(t, spark):
    return chunk.largest(t("documents").where("n_chars > 5000").select("doc_id", "n_chars"), "n_chars", "doc_id")


# --- page location ------------------------------------------------------------------------------

_HITS = f"""k as materialized (select item_id, {_KEY} as k from benchmark), d as materialized (select doc_id, {_KEY} as k from documents),
  s as (select item_id, k, unnest(range(0, len(k) - 49, 8)) as pos from k where len(k) >= 50), sn as materialized (select item_id, pos, substr(k, pos + 1, 50) as snippet from s),
  v as materialized (select item_id, doc_id, count(*) as hits, min(pos) as first_start from sn join d on contains(d.k, sn.snippet) group by 1, 2)"""


def _votes(t) -> DataFrame:
    needles = t("benchmark").select("item_id", T.match_key("text", NOISE, None).alias("k"))
    pages = t("documents").select(F.col("doc_id").alias("page"), T.match_key("text", NOISE, None).alias("text"))
    hits = locate.snippet_hits(locate.needle_snippets(needles, ["item_id"], "k", [50]), pages, [])
    return locate.votes(hits.withColumn("start", F.col("start") * locate.STEP), ["item_id"])


@query(f"with {_HITS} select item_id, doc_id, hits, first_start from v")
def snippet_vote(t, spark):
    return _votes(t).select("item_id", F.col("page").alias("doc_id"), "hits", F.col("first_start").cast("long").alias("first_start"))


@query(f"with {_HITS} select item_id, doc_id, hits from (select *, row_number() over (partition by item_id order by hits desc, doc_id, first_start) as r from v) where r = 1")
def locate_best(t, spark):
    best = _votes(t).groupBy("item_id").agg(F.min(F.struct((-F.col("hits")).alias("score"), F.col("page").alias("doc_id"), "first_start")).alias("b"))
    return best.select("item_id", "b.doc_id", (-F.col("b.score")).alias("hits"))


_TIER_HITS = f"""k as materialized (select item_id, {_KEY} as k from benchmark), d as materialized (select doc_id, {_KEY} as k from documents),
  w as (select * from (values (0, 50), (1, 30), (2, 18)) as w(tier, width)),
  s as (select item_id, k, tier, width, unnest(range(0, len(k) - width + 1, 8)) as pos from k join w on len(k) >= width),
  sn as materialized (select item_id, tier, pos, substr(k, pos + 1, width) as snippet from s),
  a as materialized (select item_id, tier, doc_id, count(*) as hits, min(pos) as first_start from sn join d on contains(d.k, sn.snippet) group by 1, 2, 3),
  v as materialized (select * from a where tier = (select min(tier) from a b where b.item_id = a.item_id))"""


def _tier_votes(t) -> DataFrame:
    """Votes of all widths; of each item only those of the first width with any."""
    needles = t("benchmark").select("item_id", T.match_key("text", NOISE, None).alias("k"))
    pages = t("documents").select(F.col("doc_id").alias("page"), T.match_key("text", NOISE, None).alias("text"))
    hits = locate.snippet_hits(locate.needle_snippets(needles, ["item_id"], "k"), pages, [])
    return locate.best_tier(locate.votes(hits.withColumn("start", F.col("start") * locate.STEP), ["item_id", "tier"]), ["item_id"], ["tier"])


@query(f"with {_TIER_HITS} select item_id, tier, doc_id, hits, first_start from v")
def snippet_vote_tiers(t, spark):
    return _tier_votes(t).select("item_id", "tier", F.col("page").alias("doc_id"), "hits", F.col("first_start").cast("long").alias("first_start"))


@query(f"with {_TIER_HITS} select item_id, tier, doc_id, hits from (select *, row_number() over (partition by item_id order by hits desc, doc_id, first_start) as r from v) where r = 1")
def locate_best_tiers(t, spark):
    best = _tier_votes(t).groupBy("item_id").agg(F.min(F.struct((-F.col("hits")).alias("score"), F.col("page").alias("doc_id"), "first_start", "tier")).alias("b"))
    return best.select("item_id", "b.tier", "b.doc_id", (-F.col("b.score")).alias("hits"))


ITEMS_A_MANUAL = 10


@query(f"""with recursive {_TIER_HITS}, o as (select item_id, item_id // {ITEMS_A_MANUAL} as manual, row_number() over (partition by item_id // {ITEMS_A_MANUAL} order by item_id) as r from benchmark),
  f as (select manual, cast(0 as bigint) as r, cast(null as bigint) as item_id, cast(null as bigint) as page, cast(null as bigint) as previous, cast(null as bigint) as carried from (select distinct manual from o)
    union all select o.manual, o.r, o.item_id, coalesce(b.p, f.carried), f.carried, coalesce(b.p, f.carried) from f join o on o.manual = f.manual and o.r = f.r + 1
    left join lateral (select doc_id as p from v where v.item_id = o.item_id order by
      hits * (case when f.carried <> 0 and abs(doc_id - f.carried) <= 8 then 2.5 when f.carried <> 0 and abs(doc_id - f.carried) > 60 then 0.15 else 1.0 end) desc, abs(doc_id - coalesce(f.carried, 0)), first_start, doc_id limit 1) b on true)
  select manual, item_id, page, case when previous <> 0 and previous <> page and abs(page - previous) <= 3 then 'p. ' || least(page, previous) || '~' || greatest(page, previous) else 'p. ' || page end as tag
  from f where item_id is not null and page is not null""")
def hint_weighted_vote(t, spark):
    """The carried page goes through manuals of ``ITEMS_A_MANUAL`` items each, so manuals grow in number and not in size; all three widths count."""
    manual = F.floor(F.col("item_id") / ITEMS_A_MANUAL)
    cands = _tier_votes(t).groupBy("item_id").agg(F.collect_list(F.struct(F.col("page").cast("long").alias("page"), "hits", F.col("first_start").cast("int").alias("first_start"))).alias("candidates"))
    empty = F.array().cast("array<struct<page:bigint,hits:bigint,first_start:int>>")
    rows = t("benchmark").select("item_id", manual.alias("manual")).join(cands, "item_id", "left").withColumns({"candidates": F.coalesce("candidates", empty), "has_page": F.lit(False), "kept": F.lit(None).cast("long"), "hint": F.lit(None).cast("long")})
    placed = locate.carried(rows, "manual", "item_id").where("page is not null")
    return placed.select("manual", "item_id", "page", T.page_tag("previous", "page").alias("tag"))


@query("""with x as (select event_id, user_id, cast(floor(value) as int) as page from events), y as (select *, lag(page) over (partition by user_id order by event_id) as previous from x)
  select event_id, case when previous is not null and previous <> 0 and previous <> page and abs(previous - page) <= 3 then 'p. ' || least(page, previous) || '~' || greatest(page, previous) else 'p. ' || page end as tag from y""")
def page_tag_range(t, spark):
    page = F.floor("value").cast("int")
    rows = t("events").withColumn("page", page).withColumn("previous", F.lag("page").over(Window.partitionBy("user_id").orderBy("event_id")))
    return rows.select("event_id", T.page_tag("previous", "page").alias("tag"))


@query("""with x as (select o_orderkey, o_custkey, o_orderstatus, case when o_orderpriority = '1-URGENT' then cast(floor(o_totalprice / 100) as bigint) end as page,
    row_number() over (partition by o_custkey order by o_orderkey) as at from orders),
  n as (select a.o_orderkey, b.page, row_number() over (partition by a.o_orderkey order by case when b.o_orderstatus = a.o_orderstatus then 0 else 1 end, abs(b.at - a.at), b.at > a.at) as r
    from x a join x b on a.o_custkey = b.o_custkey and abs(a.at - b.at) between 1 and 29 and b.page is not null and b.page <> 0)
  select x.o_orderkey, coalesce(n.page, -1) as hint from x left join n on x.o_orderkey = n.o_orderkey and n.r = 1""")
def nearest_hint(t, spark):
    rows = t("orders").withColumn("page", F.when(F.col("o_orderpriority") == "1-URGENT", F.floor(F.col("o_totalprice") / 100)))
    return locate.nearest_hint(rows, ["o_custkey"], ["o_orderkey"], "o_orderstatus", "page").select("o_orderkey", F.coalesce("hint", F.lit(-1)).cast("long").alias("hint"))


# --- blocks -------------------------------------------------------------------------------------

PARTS_A_TEXT = 100


def part_blocks(t) -> DataFrame:
    """Every brand's parts as texts of field blocks, each of at most ``PARTS_A_TEXT`` successive keys."""
    pair = lambda n, v: F.struct(F.lit(n).alias("name"), v.alias("value"))
    fields = F.array(pair("item_name", F.col("p_name")), pair("item_type", F.concat("p_type", F.lit("\n"), "p_name")), pair("size", F.col("p_size").cast("string")))
    one = F.struct(
        F.format_string("part_%d", "p_partkey").alias("chunk_id"), F.substring(F.sha2("p_name", 256), 1, 16).alias("hash"), F.col("p_partkey").cast("int").alias("start"), (F.col("p_partkey") + F.col("p_size")).cast("int").alias("end"), fields.alias("fields")
    )
    keys = F.floor(F.col("p_partkey") / PARTS_A_TEXT)
    return t("part").groupBy("p_brand", keys.alias("nth")).agg(F.sort_array(F.collect_list(one)).alias("rows")).select("p_brand", blocks.rendered(F.col("rows")).alias("text"))


@query("""select p_brand, 'part_' || p_partkey as chunk_id, substr(sha256(p_name), 1, 16) as block_hash, p_partkey as start_line, p_partkey + p_size as end_line,
  1 as row_index, p_name as item_name, p_type || chr(10) || p_name as item_type, cast(p_size as varchar) as size from part""")
def block_roundtrip(t, spark):
    rows = blocks.row_sections(blocks.chunk_blocks(part_blocks(t), "p_brand", "text")).withColumn("f", blocks.fields("section"))
    long = lambda c: F.col(c).cast("long").alias(c)
    return rows.select("p_brand", "chunk_id", "block_hash", long("start_line"), long("end_line"), "row_index", *(F.col("f")[n].alias(n) for n in ("item_name", "item_type", "size")))


# --- validation and quality ---------------------------------------------------------------------

_WORDS = "[A-Z][a-z]+"
_CLAIMS = f"""b as (select distinct unnest(regexp_extract_all(text, '{_WORDS}')) as w from benchmark), c as (select doc_id, unnest(list_distinct(regexp_extract_all(text, '{_WORDS}'))) as w from documents),
  g as (select doc_id, count(*) as n_claimed, count(*) filter (where b.w is null) as n_invented from c left join b on c.w = b.w group by 1)"""


def _claims(t) -> DataFrame:
    """Claimed words by document, and those that the benchmark does not hold; the source set stays a relation, so it may grow."""
    known = t("benchmark").select(F.explode(T.document_names("text", _WORDS)).alias("w")).distinct().withColumn("known", F.lit(True))
    claims = t("documents").select("doc_id", F.explode(T.document_names("text", _WORDS)).alias("w"))
    return claims.join(known, "w", "left").groupBy("doc_id").agg(F.count("*").alias("n_claimed"), F.count_if(F.col("known").isNull()).alias("n_invented"))


@query(f"with {_CLAIMS} select doc_id, n_claimed, n_invented from g where n_invented > 0")
def invented_values(t, spark):
    return _claims(t).where("n_invented > 0")


@query(f"with {_CLAIMS} select doc_id, n_claimed from g where n_invented = n_claimed")
def all_invented_only(t, spark):
    return _claims(t).where("n_invented = n_claimed").select("doc_id", "n_claimed")


@query(r"""with x as (select p_partkey, case when p_size % 3 = 0 then 'missing required fields: [''item_type'']' end as a, case when p_size % 5 = 0 then 'visa_code/stay_status_code value empty'
    when p_size % 7 = 0 then 'visa code not in source: [''' || p_brand || 'X'']' end as b, case when p_size % 2 = 0 then 'amount not in source: [''' || p_size || 'won'']' end as c from part)
  select p_partkey, array_to_string(list_filter([a, b, c], lambda x: x is not null), '; ') as issues from x""")
def row_issues(t, spark):
    pair = lambda n, v: F.struct(F.lit(n).alias("k"), v.alias("v"))
    code = F.when(F.col("p_size") % 5 == 0, "").when(F.col("p_size") % 7 == 0, F.concat("p_brand", F.lit("X"))).otherwise(F.col("p_brand"))
    made = F.array(pair("section_title", F.col("p_name")), pair("visa_code", code), pair("fees", F.concat(F.col("p_size").cast("string"), F.lit(" won"))))
    made = F.when(F.col("p_size") % 3 == 0, made).otherwise(F.concat(made, F.array(pair("item_type", F.col("p_type")))))
    source = F.concat(F.lit("about "), "p_brand", F.lit(" costs "), (F.col("p_size") + F.when(F.col("p_size") % 2 == 0, 1).otherwise(0)).cast("string"), F.lit("won"))
    found = validate.row_issues(F.map_from_entries(made), source, ["section_title", "item_type"], "Brand#[0-9]+X?", "[0-9]+ ?won", "[A-Z]+paper")
    return t("part").select("p_partkey", F.array_join(found, "; ").alias("issues"))


@query(r"""with x as (select doc_id, unnest(list_filter([case when n_chars < 500 then 'short: ' || n_chars end, case when regexp_matches(text, '[0-9]') then 'digits: yes' end,
  case when lang <> 'en' then 'language: ' || lang end, case when regexp_matches(text, '[A-Z]{3,}') then 'capitals' end], lambda x: x is not null)) as issue from documents)
  select split_part(issue, ':', 1) as kind, count(*) as n from x group by 1""")
def issue_histogram(t, spark):
    say = lambda when, text: F.when(when, text)
    issues = F.array_compact(F.array(say(F.col("n_chars") < 500, F.concat(F.lit("short: "), F.col("n_chars").cast("string"))), say(F.col("text").rlike("[0-9]"), F.lit("digits: yes")), say(F.col("lang") != "en", F.concat(F.lit("language: "), "lang")), say(F.col("text").rlike("[A-Z]{3,}"), F.lit("capitals"))))
    return validate.issue_histogram(t("documents").select(issues.alias("issues")))


@query(f"""with a as (select doc_id, {_hash_sql('text')} as h from documents), b as (select doc_id, {_hash_sql("case when lang = 'fr' then text || 'x' else text || '  ' end")} as h from documents)
  select doc_id, 'hash drift: index=' || a.h || ' vs block=' || b.h as issue from a join b using (doc_id) where a.h <> b.h""")
def hash_drift(t, spark):
    index = t("documents").select("doc_id", T.content_hash("text").alias("content_hash"))
    other = t("documents").select("doc_id", T.content_hash(F.concat("text", F.when(F.col("lang") == "fr", "x").otherwise("  "))).alias("block_hash"))
    return index.join(other, "doc_id").where("content_hash <> block_hash").select("doc_id", F.format_string("hash drift: index=%s vs block=%s", "content_hash", "block_hash").alias("issue"))


@query("select d.doc_id, l.doc_id is null as unlabelled, coalesce(l.quality, -1) as quality from documents d left join labels l on d.doc_id = l.doc_id")
def unknown_keys(t, spark):
    return t("documents").select("doc_id").join(t("labels").select("doc_id", "quality"), "doc_id", "left").select("doc_id", F.col("quality").isNull().alias("unlabelled"), F.coalesce("quality", F.lit(-1)).alias("quality"))


@query("""with x as (select d.*, l.quality, l.toxic from documents d left join labels l on d.doc_id = l.doc_id), n as (select count(*) as rows, count(quality) as q, count(toxic) as t,
  count(*) filter (where trim(lang) <> '') as a, count(*) filter (where trim(source) <> '') as s from x), u as (select 'quality' as "column", q as filled, rows from n union all select 'toxic', t, rows from n union all select 'lang', a, rows from n union all select 'source', s, rows from n)
  select "column", filled, rows, filled / rows as rate from u""")
def fill_rates(t, spark):
    rows = t("documents").join(t("labels"), "doc_id", "left").select("lang", "source", "quality", "toxic")
    return quality.fill_rates(rows, ["lang", "source", "quality", "toxic"])


@query("select lang as value, count(*) as n, count(*) / (select count(*) from documents) as share from documents group by 1")
def enum_share(t, spark):
    return quality.value_shares(t("documents").select("lang"), "lang")


@query("""select 'order without customer' as what, count(*) as n from orders where o_custkey not in (select c_custkey from customer) union all
  select 'line without part', count(*) from lineitem where l_partkey not in (select p_partkey from part) union all
  select 'customer without order', count(*) from customer where c_custkey not in (select o_custkey from orders)""")
def ri_check(t, spark):
    count = lambda what, rows: rows.agg(F.lit(what).alias("what"), F.count("*").alias("n"))
    a = count("order without customer", enrich.orphans(t("orders").select("o_custkey"), "o_custkey", t("customer"), "c_custkey"))
    b = count("line without part", enrich.orphans(t("lineitem").select("l_partkey"), "l_partkey", t("part"), "p_partkey"))
    return a.unionByName(b).unionByName(count("customer without order", enrich.orphans(t("customer").select("c_custkey"), "c_custkey", t("orders"), "o_custkey")))


@query("""select d.source, count(l.doc_id) as part, count(*) as whole, cast(case when count(*) = 0 then 0 else floor(count(l.doc_id) * 100 / count(*)) end as bigint) as percent
  from documents d left join labels l on d.doc_id = l.doc_id group by 1""")
def match_pct_floor(t, spark):
    rows = t("documents").select("doc_id", "source").join(t("labels").select("doc_id", F.lit(1).alias("hit")), "doc_id", "left")
    return rows.groupBy("source").agg(F.count("hit").alias("part"), F.count("*").alias("whole")).withColumn("percent", quality.floor_percent("part", "whole"))


@query(f"select c.doc_id, c.lang from documents c where {_hash_sql('c.text')} not in (select {_hash_sql('text')} from documents where n_chars % 4 = 0)")
def incremental_skip(t, spark):
    hashed = t("documents").withColumn("content_hash", T.content_hash("text"))
    return files.changed(hashed, hashed.where("n_chars % 4 = 0"), ["content_hash"]).select("doc_id", "lang")


# --- forms --------------------------------------------------------------------------------------


def _forms(t) -> DataFrame:
    """Conversations as forms: the roles that spoke are the answers, every turn is a question that shows if a user spoke."""
    said = t("conversations").groupBy("conv_id").agg(F.sort_array(F.collect_set("role")).alias("roles"))
    return t("conversations").join(said, "conv_id").withColumn("answers", F.create_map(F.lit("who"), F.col("roles"), F.lit("what"), F.array("text")))


_SAID = "c as (select conv_id, list_sort(list_distinct(list(role))) as roles from conversations group by 1)"


@query(f"""with {_SAID} select v.conv_id, v.turn, v.role = 'user' or list_contains(roles, 'system') as visible, v.role <> 'assistant' or trim(v.text) <> '' as answered,
  array_to_string(list_transform(roles, lambda x: case when x = 'user' then 'User' when x = 'assistant' then 'Model' else x end), ', ') as shown from conversations v join c on v.conv_id = c.conv_id""")
def form_visibility(t, spark):
    rows = _forms(t).withColumns({"dep": F.when(F.col("role") != "user", "who"), "labels": F.create_map(F.lit("user"), F.lit("User"), F.lit("assistant"), F.lit("Model")), "kind": F.when(F.col("role") == "assistant", "choice").otherwise("long")})
    return rows.select("conv_id", "turn", forms.visible("answers", "dep", F.array(F.lit("system"))).alias("visible"), forms.answered("answers", F.lit("what"), "kind", F.lit(False)).alias("answered"), forms.shown_answer("answers", F.lit("who"), "labels").alias("shown"))


@query(f"""with {_SAID}, q as (select v.conv_id, v.role = 'user' or list_contains(roles, 'system') as shown, len(v.text) > 200 as done from conversations v join c on v.conv_id = c.conv_id)
  select conv_id, bool_and(done or not shown) as complete, cast(case when count(*) filter (where shown) = 0 then 100 else round(100 * count(*) filter (where shown and done) / count(*) filter (where shown)) end as bigint) as percent from q group by 1""")
def completeness_pct(t, spark):
    shown = forms.visible("answers", "dep", F.array(F.lit("system")))
    rows = _forms(t).withColumn("dep", F.when(F.col("role") != "user", "who")).select("conv_id", shown.alias("shown"), (F.length("text") > 200).alias("done"))
    return rows.groupBy("conv_id").agg(forms.complete(F.col("done"), F.col("shown")).alias("complete"), forms.progress(F.col("done"), F.col("shown")).alias("percent"))


@query("""select user_id, cast(round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6) as bigint) as seconds, cast(round(round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6) / 60) as bigint) as minutes from events group by 1""")
def session_duration(t, spark):
    span = t("events").groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b")).withColumn("seconds", forms.seconds_between("a", "b"))
    return span.select("user_id", "seconds", F.round(F.col("seconds") / 60).cast("long").alias("minutes"))
