import hashlib
from collections import Counter

import numpy as np
import pytest

from docloom.llm.alignment import PIECES, Aligned, Csr, PieceEncoder, PlainEncoder, alignment, gustavson, packed, row_counts, unpacked
from docloom.llm.tokens import TOKENIZER

P = pytest.importorskip("public_tokenizers")
BYTE, PIECE = P.path(TOKENIZER), P.path(PIECES)

TEXTS = [
    "Hello world, hello   world!", "  two  spaces\n\n and\tlines \r\n", "été naïve 日本語 🙂🙂 ﬁ", "<s> <|endoftext|> </s>", "", None, "a", " ", "\n", "x" * 3000, "▁odd ▁", "Hello world, hello   world!",
    "mixed 12345 numbers 67 and words " * 40, "\x00\x01", "tail  ",
]


def brute(rows):
    from tokenizers import Tokenizer
    import sentencepiece

    t = Tokenizer.from_file(BYTE)
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    a_bytes, b_bytes = PlainEncoder(BYTE).bytes, PieceEncoder(PIECE).bytes
    made = []
    for doc, text in rows:
        want = (" " + text).encode() if text else b""
        a = t.encode(" " + text, add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        if b"".join(a_bytes[i] for i in a) != want or b"".join(b_bytes[i] for i in b) != want:
            a = b = []
        spans = []
        for ids, size in ((a, a_bytes), (b, b_bytes)):
            at, out = 0, []
            for i in ids:
                out.append((at, at + len(size[i])))
                at += len(size[i])
            spans.append(out)
        links = [(i, j) for i, (s, e) in enumerate(spans[0]) for j, (u, v) in enumerate(spans[1]) if s < v and u < e]
        ends = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, lo = [], 0
        for e in ends:
            groups.append(([i for i, (_, x) in zip(a, spans[0]) if lo < x <= e], [i for i, (_, x) in zip(b, spans[1]) if lo < x <= e]))
            lo = e
        made.append((doc, a, b, groups, [(a[i], b[j]) for i, j in links]))
    count = Counter(p for m in made for p in set(m[4]))
    top = Counter()
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    out = []
    for doc, a, b, groups, links in made:
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = hashlib.sha256(shown.encode()).hexdigest() if groups else ""
        out.append((doc, len(a), len(b), len(groups), len(links), sum(count[p] == top[p[0]] for p in links), sum(count[p] for p in links), digest, sum(len(x) * len(y) for x, y in groups)))
    return sorted(out, key=str)


def test_matches_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "a null id"), (3, "<s> <|endoftext|> </s>")]
    docs = spark.createDataFrame([(d, t, "x", 5) for d, t in rows], "doc_id long, text string, pair string, block int").repartition(3)
    got = alignment(docs, BYTE, PIECE).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_group_links")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)
    assert alignment(docs.where("doc_id = -1"), BYTE, PIECE).collect() == []


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(40)
    rows = [tuple(r) for r in docs.collect()]
    got = alignment(spark.createDataFrame(rows, "doc_id long, text string"), BYTE, PIECE).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_group_links")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_units_equal_the_library():
    e = PieceEncoder(PIECE)
    assert e.by_unit
    long = " ".join(f"w{i}\n" if i % 7 == 0 else f"wörd{i % 50}  " for i in range(60_000))
    for t in [*filter(None, TEXTS), long, "\n\n x", "a\n b"]:
        assert e.ids([t])[0].tolist() == e.lib.encode(t)


def test_products_equal_dense_ones():
    r = np.random.default_rng(5)
    for _ in range(20):
        x, y = (r.random((r.integers(1, 12), 9)) < 0.3), (r.random((9, r.integers(1, 12))) < 0.4)
        csr = lambda m: Csr(np.append(0, np.cumsum(m.sum(1))), np.nonzero(m)[1], m.shape[1])
        row, col, value = gustavson(csr(x), csr(y))
        dense = np.zeros((x.shape[0], y.shape[1]), int)
        dense[row, col] = value
        assert (dense == x.astype(int) @ y.astype(int)).all() and len(row) == np.count_nonzero(dense)
        assert (row_counts(csr(x), csr(y)) == (x.astype(int) @ y.astype(int)).sum(1)).all()


def test_codes_round_trip():
    codes, links = np.array([0, 3, 4, 70_000, 1 << 31]), np.array([1, 2, 300, 70_000, 1])
    back = unpacked(packed(codes, links), 5)
    assert (back[0] == codes).all() and (back[1] == links).all()


def test_no_texts():
    found = Aligned([], [], np.ones(3, np.int64), np.ones(3, np.int64))
    assert found.listed_groups() == [] and all(len(f) == 0 for f in found.figures)
