"""Token counts and token ids of whole texts, exactly as the ``tokenizers`` library gives them.

The tokenizer file (a byte-level BPE as ``tokenizers`` stores it) is read by that library. Where the
file is of the plain kind, with merges in the order of ids and no normalizer, the same vocabulary is
also put into ``tiktoken``'s BPE core, which gives the same ids several times faster; a self-test on
loading compares both, and any other kind of file is left to the library alone.

Arrow batches are cut into blocks of about equal bytes. Texts over ``SPLIT_CHARS`` are cut at safe
boundaries, between a character that is surely no white space and an ASCII space or line feed: the
pre-tokenizer always cuts there, and no special string contains white space.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm._common import by_bytes, text_buffer

TOKENIZER = "byte_bpe_50k.json"
BATCH_BYTES = 2 << 20
SPLIT_CHARS = 1 << 18
LIMIT = 1024

#: The byte-level pre-tokenizer's pattern (fixed by the vocabulary), with possessive repeats: the same cuts, less backtracking.
_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
_SAFE = re.compile(r"(?<=\S)(?=[ \n])")
_PROBE = ["It's  a test,\n\n of\tnumbers 12 345 and   \r\n we'll see\xa0 \u3000x<|endoftext|> été 日本語 🙂!  ", "", " ", "\x1c a\x85b"]


def _byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Whole texts to ids, or to numbers of ids; one per Python worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.width = np.uint16 if self.lib.get_vocab_size() <= 1 << 16 else np.uint32
        self.core, self.by_level = self._core(path)
        if self.core and any(self.core.encode(t, allowed_special="all") != self.lib.encode(t, add_special_tokens=False).ids for t in _PROBE):
            self.core = None

    @staticmethod
    def _core(path: str):
        """tiktoken's core with the same vocabulary, if the file is of the plain kind; and whether it is byte-level."""
        spec = json.load(open(path, encoding="utf-8"))  # noqa: SIM115
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        byte_level = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not spec.get("normalizer") and not spec.get("post_processor")
        special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        plain = byte_level and model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix"))
        plain = plain and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec.get("added_tokens") or [])
        vocab = {t: i for t, i in model["vocab"].items() if t not in special}
        joined = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model.get("merges", ())]
        if not plain or sorted(vocab.values()) != list(range(len(vocab))) or [vocab.get(t) for t in joined] != list(range(len(vocab) - len(joined), len(vocab))):
            return None, bool(byte_level)
        import tiktoken

        byte = _byte_of_char()
        ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items()}
        return tiktoken.Encoding(os.path.basename(path), pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens=special), True

    def _split(self, text: str) -> list[str]:
        if len(text) <= SPLIT_CHARS or not self.by_level:
            return [text]
        out, a = [], 0
        while len(text) - a > SPLIT_CHARS:
            m = _SAFE.search(text, a + SPLIT_CHARS // 2)
            if not m:
                break
            out.append(text[a : m.start()])
            a = m.start()
        return [*out, text[a:]]

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        if self.core:
            return [self.core.encode_to_numpy(t, allowed_special="all") for t in texts]
        return [np.asarray(e.ids, np.uint32) for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        split = [self._split(t) for t in texts]
        found = iter(self._whole([p for pieces in split for p in pieces]))
        return [next(found) if len(pieces) == 1 else np.concatenate([next(found) for _ in pieces]) for pieces in split]

    def lengths(self, texts: list[str]) -> list[int]:
        split = [self._split(t) for t in texts]
        found = iter(self._whole([p for pieces in split for p in pieces]))
        return [sum(len(next(found)) for _ in pieces) for pieces in split]


def batches(col: pa.Array, limit: int = BATCH_BYTES) -> Iterator[tuple[int, int, list[str]]]:
    """(from, to, texts) with at most ``limit`` bytes of text each, null as empty."""
    _, offsets = text_buffer(col)
    for i, j in by_bytes(offsets, limit):
        yield i, j, [t or "" for t in col.slice(i, j - i).to_pylist()]


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row; null and empty texts have no tokens,
    repeated rows come out as often as they came in, other columns are left behind."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def lengths(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for part in parts:
            n: list[int] = []
            for _, _, texts in batches(part.column(1)):
                n += encoder.lengths(texts)
            _, offsets = text_buffer(part.column(1))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(offsets), pa.int64()), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (
        docs.select("doc_id", text.alias("text"))
        .mapInArrow(lengths, f"doc_id {kind}, n_bytes long, n_tokens long")
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
