import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as p
from docloom.llm.decontamination import contaminated
from tests.llm.test_near_dup import brute_force as near
from tests.llm.test_substring_dedup import brute_force as repeats

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    r = random.Random(8)
    vocabulary = [a + b for a in "ka lo mi nu re sa".split() for b in "ba de fi go hu jo lam nep qui tor".split()]
    prose = lambda n: [r.choice(vocabulary) + r.choice(vocabulary) for _ in range(n)]
    shared, item = prose(90), prose(30)
    docs, labels = [], []
    for i in range(400):
        words = prose(r.randint(5, 150))
        if i % 8 == 0:
            words[1] = "zorkish"
        if i % 10 == 3:
            words += shared
        if i % 50 == 7:
            words += item
        if i % 6 == 5:
            words = docs[i - 5][1].split() + ["tail"]
        docs.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, 1, int("zorkish" in words)))
    docs += [(900, None, None, None, None), (901, "", "en", "s", 0), (902, docs[1][1], "en", "s", 0), (902, docs[1][1], "en", "s", 0), (None, "no id at all", "en", "s", 0)]
    at = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(docs, SCHEMA).repartition(4).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at


def test_stages_take_effect(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = [tuple(r) for r in docs.collect()]
    for k, (name, stage) in enumerate(p.STAGES[:-1]):
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        after = [tuple(r) for r in docs.collect()]
        texts = {(d, t) for d, t, *_ in before}
        if name == "toxicity":
            assert sorted(map(str, after)) == sorted(str(b) for b in before if "zorkish" not in (b[1] or "").split())
        elif name == "near_duplicates":
            kept = {d for d, _, _, k in near([b[:2] for b in before if b[0] is not None]) if k}
            assert sorted(a[0] for a in after if a[0] is not None) == sorted(kept) and sum(a[0] is None for a in after) == 1
            assert {a[:2] for a in after} <= texts and len(kept) < len(before) - 40
        elif name == "substring_dedup":
            want = {d: (t if not gone else kept) for (d, t), (_, _, gone, _, kept) in zip([b[:2] for b in before if b[0] is not None], repeats([b[:2] for b in before if b[0] is not None]))}
            assert {a[0]: a[1] for a in after if a[0] is not None} == want and sum(a[1] != b for a in after for b in [dict((x[0], x[1]) for x in before)[a[0]]]) > 20
        else:
            bad = {r.doc_id for r in contaminated(spark.createDataFrame(before, SCHEMA), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
            assert bad and sorted(map(str, after)) == sorted(str(b) for b in before if b[0] not in bad)
        before = after
    pieces = p.run(spark, sf_dir)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {b[0] for b in before}
    assert re.search("sequence_id", str(pieces.columns))


def test_empty_tables(spark, sf_dir, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").where(F.lit(False)).write.parquet(f"{tmp_path}/{t}.parquet")
    assert p.run(spark, str(tmp_path)).count() == 0


def test_columns_of_any_name(spark, sf_dir):
    """Each stage takes a table whose extra columns are named like the operators' own, and gives them back as they were."""
    names = ["toxic_score", "toxic_spans", "row", "id", "nth", "key", "__id", "__key", "__ranges", "ranges", "new_text", "component_id", "kept"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id is null or doc_id < 60 or doc_id >= 900")
    wide = docs.select("*", *(F.concat(F.lit(n), F.coalesce(F.col("doc_id"), F.lit(-1)).cast("string")).alias(n) for n in names))
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, wide, sf_dir)
        assert out.columns == wide.columns, name
        rows = out.collect()
        assert rows and all(r[n] == f"{n}{-1 if r.doc_id is None else r.doc_id}" for r in rows for n in names)
        assert {r.doc_id for r in rows} >= {None, 901}
    assert p.pack(spark, wide, sf_dir).select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
