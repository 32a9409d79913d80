"""Text functions against Python's own, on Korean and odd samples."""

import hashlib
import re
import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docloom.functions import batches
from docloom.functions import patterns as P
from docloom.functions import text as T

SAMPLES = [
    "체류자격 E-7-4 및 F-2-R, A - 1 - 2 (D-10), 자격E-7",
    "수수료 6만원, 130,000원 또는 1,000 원과 3억원",
    "여권, 표준규격사진, 외국인등록증·통합신청서 및 결핵진단서",
    "７일 이내　E - 7",
    "a\r\nb\x0bc d\n\n",
    "",
    "   ",
    "각 가각 각 가가가",
    "p. 12 and p.  7",
    "tail  \x1c",
]


def rows(spark, **columns):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(SAMPLES)], "i int, s string")
    return [r.asDict() for r in df.select("s", *(c.alias(n) for n, c in columns.items())).orderBy("i").collect()]


def py_codes(s):
    found = [re.sub(r"\s", "", m) for m in re.findall(P.CODE.replace("(?U)", ""), s)]
    return list(dict.fromkeys(found))


def test_codes_amounts_documents(spark):
    for r in rows(spark, codes=T.codes("s"), amounts=T.amounts("s"), names=T.document_names("s")):
        assert r["codes"] == py_codes(r["s"])
        assert r["amounts"] == list(dict.fromkeys(re.sub(r"[,\s]", "", m) for m in re.findall(P.AMOUNT.replace("(?U)", ""), r["s"])))
        assert r["names"] == list(dict.fromkeys(re.findall(P.DOCUMENT, r["s"])))


def test_lines_strip_and_hash(spark):
    for r in rows(spark, lines=T.split_lines("s"), strip=T.strip("s"), rstrip=T.rstrip("s"), hash=T.content_hash("s")):
        assert r["lines"] == r["s"].splitlines()
        assert r["strip"] == r["s"].strip() and r["rstrip"] == r["s"].rstrip()
        assert r["hash"] == hashlib.sha256(re.sub(r"\s+", " ", r["s"]).strip().encode()).hexdigest()[:16]


def test_match_key(spark):
    noise = P.NOISE.replace("(?U)", "")
    for r in rows(spark, key=T.match_key("s"), nfc=T.nfc("s")):
        assert r["nfc"] == unicodedata.normalize("NFC", r["s"])
        plain = re.sub(noise, "", r["nfc"])
        assert re.sub("[\x1c-\x1f]", "", r["key"]) == re.sub("[\x1c-\x1f]", "", re.sub(r"([가-힣])\1+", r"\1", plain))


def test_composed_texts_stay_behind(spark):
    """What may compose goes to Python, other texts do not; pieces are bounded."""
    after = {ord(x) for cp in range(0x110000) if not 0xD800 <= cp < 0xE000 for x in unicodedata.normalize("NFD", chr(cp))[1:]}
    odd = [chr(cp) for cp in range(0x110000) if not 0xD800 <= cp < 0xE000 and (cp in after or unicodedata.combining(chr(cp)) or not unicodedata.is_normalized("NFC", chr(cp)))]
    plain = ["", "plain", "caf\u00e9 \u201cq\u201d \u2026", "\ud55c\uad6d\uc5b4", "\u6f22\u5b57\u3042", "\u0416"]
    texts = spark.createDataFrame([(x,) for x in [*odd, *plain]], "s string").select("s", F.col("s").rlike(T._OPEN).alias("open"))
    assert {r.s for r in texts.where("open").collect()} == set(odd)
    df = spark.createDataFrame([(x,) for x in (None, "e\u0301", "a\u0323\u0302", *plain)], "s string")
    assert [r.n for r in df.select(T.nfc("s").alias("n")).collect()] == [None, "\u00e9", "\u1ead", *plain]
    sizes = [len("x" * n) for n in (3, 3, 3, 9, 0, 1)]
    assert list(batches.pieces(pa.array(["x" * n for n in sizes] + [None]), 6)) == [(0, 2), (2, 1), (3, 1), (4, 3)]
    assert list(batches.pieces(pa.array([], pa.string()))) == []


def test_numbers_and_pages(spark):
    got = rows(spark, first=T.first_integer("s"), page=T.page_marker("s"), last=T.after_last("s", "p. "))
    for r in got:
        m, p = re.search(r"\d+", r["s"]), re.search(r"p\.\s*(\d+)", r["s"])
        assert r["first"] == (int(m.group()) if m else None)
        assert r["page"] == (int(p[1]) if p else None)
        assert r["last"] == r["s"].split("p. ")[-1]


def test_snippets_guard_short_texts(spark):
    df = spark.createDataFrame([("x" * n,) for n in (0, 17, 18, 19, 26, 40)], "s string").select("s", T.snippets("s", 18, 8).alias("w"))
    for r in df.collect():
        assert len(r.w) == len(range(0, len(r.s) - 18 + 1, 8))


@pytest.mark.parametrize(
    ("base", "sub", "want"), [("F-6", "F-6-1", "F-6 (F-6-1)"), ("F-6", " F-6 ", "F-6"), ("F-6", "", "F-6"), (None, "x", " (x)"), ("E-7", None, "E-7")]
)
def test_keys(spark, base, sub, want):
    row = spark.createDataFrame([(base, sub)], "b string, s string").select(T.full_code("b", "s").alias("code")).select("code", T.parent_of("code").alias("parent"), T.sub_of("code").alias("sub")).first()
    assert row.code == want
    assert row.parent == want.split(" (")[0].strip()
    assert row.sub == (want.split("(", 1)[1].rstrip(")").strip() if " (" in want else None)


@pytest.mark.parametrize(("previous", "page", "want"), [(None, 5, "p. 5"), (5, 5, "p. 5"), (5, 8, "p. 5~8"), (8, 5, "p. 5~8"), (5, 9, "p. 9"), (0, 2, "p. 2")])
def test_page_tags(spark, previous, page, want):
    row = spark.createDataFrame([(previous, page)], "a int, b int").select(T.page_tag("a", "b").alias("t"), T.with_tag(F.lit(""), T.page_tag("a", "b")).alias("u"), T.with_tag(F.lit("절"), T.page_tag("a", "b")).alias("v")).first()
    assert (row.t, row.u, row.v) == (want, want, f"절 ({want})")


def test_numbers_that_do_not_fit(spark):
    texts = ["p. ７", "p. 99999999999", "see p.12", "p. " + "9" * 30, "p. ٣", "no page", None]
    got = spark.createDataFrame([(t,) for t in texts], "s string").select(T.page_marker("s").alias("p"), T.first_integer("s").alias("n")).collect()
    assert [r.p for r in got] == [7, 99999999999, 12, None, 3, None, None] == [r.n for r in got]
