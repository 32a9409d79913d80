import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docloom.llm.packing import pack
from docloom.llm.tokens import SPLIT_CHARS, Encoder, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
BITS = ["a", "'s", " ", "  ", "\n", "\t", "\r\n", "!", "'ll", "é", "1", "<|endoftext|>", "\xa0", "　", "x\x1c", "日本", "🙂", "​", "\x85", " "]


def random_texts(n):
    r = random.Random(7)
    return ["".join(r.choice(BITS) for _ in range(r.randint(0, 30))) for _ in range(n)]


def test_core_equals_library():
    encoder, lib = Encoder(PATH), Tokenizer.from_file(PATH)
    assert encoder.core is not None
    texts = random_texts(5000)
    assert [x.tolist() for x in encoder.ids(texts)] == [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]


def test_long_text_is_split_safely():
    encoder, lib = Encoder(PATH), Tokenizer.from_file(PATH)
    text = " ".join(random_texts(60_000))
    assert len(text) > 2 * SPLIT_CHARS and len(encoder._split(text)) > 1
    assert encoder.ids([text])[0].tolist() == lib.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en") for i, t in enumerate(random_texts(200))] + [(200, None, None), (201, "", "x"), (202, "word " * 9000, None), (202, "word " * 9000, None), (None, "a b", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").repartition(5)


def test_counts(docs):
    lib = Tokenizer.from_file(PATH)
    rows = token_counts(docs, PATH).collect()
    want = sorted((str(r.doc_id), len((r.text or "").encode()), n := len(lib.encode(r.text or "", add_special_tokens=False).ids), n > 1024) for r in docs.collect())
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in rows) == want


def test_packing_is_an_exact_cut(docs):
    lib = Tokenizer.from_file(PATH)
    rows = pack(docs.where("doc_id is not null").dropDuplicates(["doc_id"]), PATH).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4")) and len(r.ids) == r.length
    assert set(by_doc) == {d for d in texts if d is not None}
    for d, pieces in by_doc.items():
        pieces.sort(key=lambda r: r.start)
        ids = [*lib.encode(texts[d], add_special_tokens=False).ids, 1]
        assert [x for p in pieces for x in p.ids] == ids and {p.doc_tokens for p in pieces} == {len(ids)}
    last = max(by_seq)
    assert sorted(by_seq) == list(range(last + 1))
    for s, pieces in by_seq.items():
        pieces.sort(key=lambda r: r.offset)
        at = 0
        for p in pieces:
            assert p.offset == at
            at += p.length
        assert at == 2048 or s == last


def test_empty_table(docs):
    none = docs.where(F.lit(False))
    assert pack(none, PATH).count() == 0 and token_counts(none, PATH).count() == 0


def test_packing_of_null_repeated_ids_and_a_very_long_text(spark):
    """Every row's ids come out once each, also where rows share an id or have none; columns that clash with the operator's own are left behind."""
    lib = Tokenizer.from_file(PATH)
    long = " ".join(random_texts(60_000))
    assert len(long) > 2 * SPLIT_CHARS
    rows = [(None, "a b"), (None, "a b"), (7, "same"), (7, "same"), (7, "other text"), (8, None), (9, long), (10, "tail")]
    docs = spark.createDataFrame([(d, t, 1, 2, 3) for d, t in rows], "doc_id long, text string, part int, base int, width int").repartition(3)
    found = pack(docs, PATH)
    assert found.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    stream = sorted(((r.sequence_id * 2048 + r.offset, r.start, r.doc_tokens, r.doc_id, r.ids) for r in found.collect()))
    got, at = [], 0
    for place, start, total, doc, ids in stream:
        assert place == at and (start == 0 or got[-1][0] == doc)
        at += len(ids)
        got = [*got[:-1], (doc, got[-1][1] + ids)] if start else [*got, (doc, list(ids))]
        assert len(got[-1][1]) <= total
    want = [(d, [*lib.encode(t or "", add_special_tokens=False).ids, 1]) for d, t in rows]
    assert sorted(map(str, got)) == sorted(map(str, want))
