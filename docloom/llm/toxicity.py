"""Toxicity by a linear-chain conditional random field over the words of a text.

Training (on the driver, on whole texts of a bounded sample of labelled rows, ``SAMPLE`` of each class):

1. Features of a word are the word itself, its beginnings and its endings (4 to 8 letters). Those that
   stand in toxic documents beyond chance (a binomial bound corrected for the number of features tried)
   form the lexicon, ``MAX_FEATURES`` at most.
2. Words of toxic documents with a feature that mostly stands in such documents are the labelled toxic tokens; all others are clean.
   The field (two labels, lexicon and neighbour features, transitions) is fitted to passages of at most
   ``PASSAGE`` words, ``MAX_PASSAGES`` of the sample's, by gradient ascent on the penalised conditional likelihood.
3. A logistic layer maps what forward-backward gives for a document (the chance that any word
   is toxic and the expected number of toxic words, both beyond those of as many plain words, and the largest
   marginal) to its score.

Scoring is exact over whole texts: runs of words without features are passed by powers of one 2x2 matrix, so the
work lies in the words that matter. Spans are runs of words with a marginal of 0.5 or more.

Rows: null and empty texts are scored as texts without words; repeated rows are scored each; labels that
repeat a document count by their maximum, and where several rows have a labelled id the greatest text is trained on; null labels or ids
are not used. Columns of the input keep their names, also where they are those that scoring adds: see ``score``. Without both classes
to learn from, every score is the share of toxic labels (0 without labels). No sample's choice depends on
lang, source or text; neither they nor ids nor labels are inputs of a score.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE = 2000  # training rows of each class at most
MAX_FEATURES = 5000
SURE = 0.5  # share of toxic documents from which a feature labels a word
PASSAGE = 40
MAX_PASSAGES = 3000  # bound of the fit of the field: passages that it is fitted to, evenly spread over all passages of the sample
AFFIXES = range(4, 9)
RUN = 512

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """The words in lower case, in the places of ``_WORD``'s matches in the text as it is."""
    low = text.lower()
    return _WORD.findall(low) if len(low) == len(text) else [w.lower() for w in _WORD.findall(text)]


def word_features(word: str) -> list[str]:
    n = len(word)
    return ["=" + word, *("^" + word[:k] for k in AFFIXES if k < n), *(word[-k:] + "$" for k in AFFIXES if k < n)]


@dataclass
class Model:
    lexicon: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray | None = None  # per lexicon feature, then previous, next, bias
    trans: np.ndarray | None = None  # log potentials from label to label
    start: float = 0.0  # log potential of a toxic first word
    layer: np.ndarray | None = None  # logistic layer: bias and one weight per document feature
    share: float = 0.0


class Chain:
    """Forward-backward of one text, in which plain words form runs."""

    def __init__(self, model: Model):
        self.m = model
        self.cache: dict[str, tuple[int, ...]] = {}
        k = len(model.lexicon)
        self.prev, self.next, self.bias = model.weights[k : k + 3]
        step = np.exp(model.trans) * np.exp([0.0, self.bias])  # plain word: columns are its label
        self.step = step
        self.rate = max(abs(np.linalg.eigvals(step)))
        unit = step / self.rate
        # a word without a known beginning, ending or whole form has no features
        self.whole = {f[1:] for f in model.lexicon if f[0] == "="}
        self.head, self.tail = {f[1:5] for f in model.lexicon if f[0] == "^"}, {f[-5:-1] for f in model.lexicon if f[-1] == "$"}
        self.plain: dict[int, tuple] = {}
        self.power, self.count = [np.eye(2)], [np.zeros((2, 2))]
        for _ in range(RUN):  # count: sum over the run's words of paths on which that word is toxic
            self.count.append(self.count[-1] @ unit + self.power[-1] @ (unit * [0.0, 1.0]))
            self.power.append(self.power[-1] @ unit)

    def marked(self, words: list[str]) -> dict[int, tuple[int, ...]]:
        """The lexicon features of the words (in lower case) that have any, by position."""
        head, tail, whole, lexicon = self.head, self.tail, self.whole, self.m.lexicon
        kinds = {}
        for w in set(words):
            if w[:4] in head or w[-4:] in tail or w in whole:
                found = tuple(lexicon[f] for f in word_features(w) if f in lexicon)
                if found:
                    kinds[w] = found
        return {i: kinds[w] for i, w in enumerate(words) if w in kinds} if kinds else {}

    def run(self, n: int, marked: dict[int, tuple[int, ...]]) -> tuple[float, float, dict[int, float]]:
        """(log of the chance that no word is toxic, expected toxic words, marginals near marked words)."""
        if n == 0:
            return 0.0, 0.0, {}
        w = self.m.weights
        # words with own potentials: the first, marked ones and their neighbours
        own = sorted({0, *(j for i in marked for j in (i - 1, i, i + 1) if 0 <= j < n)})
        steps: list[tuple[str, int, np.ndarray]] = []
        at = 0
        for i in own:
            while at < i:
                length = min(i - at, RUN)
                steps.append(("run", length, self.power[length]))
                at += length
            e = self.bias + sum(w[f] for f in marked.get(i, ())) + (self.prev if i - 1 in marked else 0.0) + (self.next if i + 1 in marked else 0.0)
            # the first word has no predecessor: a start potential takes the transition's place
            potential = np.array([[1.0, math.exp(self.m.start + e)], [0.0, 0.0]]) if i == 0 else np.exp(self.m.trans) * np.exp([0.0, e])
            steps.append(("word", i, potential))
            at = i + 1
        while at < n:
            length = min(n - at, RUN)
            steps.append(("run", length, self.power[length]))
            at += length
        alphas, log_z = [np.array([1.0, 0.0])], 0.0
        for kind, size, p in steps:
            a = alphas[-1] @ p
            s = a.sum()
            log_z += math.log(s) + (size * math.log(self.rate) if kind == "run" else 0.0)
            alphas.append(a / s)
        beta, expected, near = np.ones(2), 0.0, {}
        for k in range(len(steps) - 1, -1, -1):
            kind, size, p = steps[k]
            z = alphas[k] @ p @ beta
            if kind == "run":
                expected += float(alphas[k] @ self.count[size] @ beta / z)
            else:
                near[size] = m = float((alphas[k] @ p)[1] * beta[1] / z)
                expected += m
            beta = p @ beta
            beta = beta / beta.sum()
        clean = (n - 1) * float(self.m.trans[0, 0]) - log_z
        return min(clean, 0.0), expected, near

    def document(self, words: list[str]) -> tuple[np.ndarray, dict[int, float]]:
        marked, n = self.marked(words), len(words)
        if not marked:
            return np.zeros(3), {}
        clean, expected, near = self.run(n, marked)
        if n not in self.plain:
            if len(self.plain) > 20_000:
                self.plain.clear()
            self.plain[n] = self.run(n, {})[:2]
        plain_clean, plain_expected = self.plain[n]
        return document_features(clean - plain_clean, expected - plain_expected, max(near[i] for i in marked)), near

    def score(self, x: np.ndarray) -> float:
        z = float(self.m.layer[0] + x @ self.m.layer[1:])
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))


def document_features(clean: float, expected: float, most: float) -> np.ndarray:
    """Both beyond what as many plain words give, so that length alone is no evidence."""
    return np.array([-math.expm1(min(clean, 0.0)), math.log1p(max(expected, 0.0)), most])


# --- training ---------------------------------------------------------------------------------


def lexicon_of(toxic: list[set[str]], clean: list[set[str]]) -> dict[str, float]:
    """From each document's distinct words: the features whose share of toxic documents is beyond chance, with that share."""
    features: dict[str, list[str]] = {}

    def counts(docs: list[set[str]], of) -> Counter:
        out: Counter = Counter()
        for words in docs:
            bag: set[str] = set()
            for w in words:
                if w not in features:
                    features[w] = of(w)
                bag.update(features[w])
            out.update(bag)
        return out

    seen = Counter({f: n for f, n in counts(toxic, word_features).items() if n > 3})
    features.clear()
    other = counts(clean, lambda w: [f for f in word_features(w) if f in seen])
    base = len(toxic) / (len(toxic) + len(clean))
    bound = math.log(max(len(seen), 2)) + 2
    good = []
    for f, n in seen.items():
        total = n + other[f]
        share = n / total
        if share < max(SURE, 2 * base):
            continue
        gain = n * math.log(share / base) + (other[f] * math.log((1 - share) / (1 - base)) if other[f] else 0.0)
        if gain > bound:
            good.append((-gain, -len(f), f, n, total))
    chosen: dict[str, float] = {}
    kept: dict[tuple[int, int], list[str]] = {}
    for _, _, f, n, total in sorted(good):  # of nested affixes in the same documents the longest says it all
        same = kept.setdefault((n, total), [])
        if len(chosen) < MAX_FEATURES and not any(g[: len(f)] == f if f[0] == "^" else f[-1] == "$" and g[-len(f) :] == f for g in same):
            same.append(f)
            chosen[f] = n / total
    return chosen


def fit_field(model: Model, passages: list[tuple[list[tuple[int, ...]], list[int]]], rounds: int = 120) -> None:
    """Gradient ascent (Adam) on the penalised conditional log likelihood of labelled passages."""
    k, b, t = len(model.lexicon), len(passages), PASSAGE
    mask, gold = np.zeros((b, t)), np.zeros((b, t), np.int64)
    cell, feat = [], []
    hot = np.zeros((b, t + 2))
    for i, (feats, labels) in enumerate(passages):
        mask[i, : len(labels)], gold[i, : len(labels)] = 1, labels
        for j, f in enumerate(feats):
            hot[i, j + 1] = bool(f)
            cell += [i * t + j] * len(f)
            feat += f
    cell, feat = np.array(cell, np.int64), np.array(feat, np.int64)
    before, after = hot[:, :-2] * mask, hot[:, 2:] * mask
    y = gold * mask
    both = mask[:, 1:]
    theta, m1, m2 = np.zeros(k + 3 + 5), np.zeros(k + 3 + 5), np.zeros(k + 3 + 5)
    pair_gold = np.array([[((gold[:, :-1] == p) & (gold[:, 1:] == q) & (both > 0)).sum() for q in (0, 1)] for p in (0, 1)])
    for step in range(1, rounds + 1):
        w, trans, start = theta[: k + 3], theta[k + 3 : k + 7].reshape(2, 2), theta[-1]
        e = np.bincount(cell, w[feat], b * t).reshape(b, t) + w[k] * before + w[k + 1] * after + w[k + 2]
        e = np.clip(e, -30, 30)
        pot = np.stack([np.ones_like(e), np.exp(e)], -1)
        pot[:, 0, 1] *= math.exp(start)
        tr = np.exp(trans)
        alpha, beta = np.zeros((b, t, 2)), np.ones((b, t, 2))
        a = pot[:, 0]
        alpha[:, 0] = a / a.sum(1, keepdims=True)
        for j in range(1, t):
            a = (alpha[:, j - 1] @ tr) * pot[:, j]
            a = a / a.sum(1, keepdims=True)
            alpha[:, j] = np.where(mask[:, j, None] > 0, a, alpha[:, j - 1])
        for j in range(t - 2, -1, -1):
            v = (beta[:, j + 1] * pot[:, j + 1]) @ tr.T
            v = v / v.sum(1, keepdims=True)
            beta[:, j] = np.where(mask[:, j + 1, None] > 0, v, 1.0)
        g = alpha * beta
        p1 = g[..., 1] / g.sum(-1) * mask
        pair = np.zeros((2, 2))
        for p in (0, 1):
            for q in (0, 1):
                pair[p, q] = (alpha[:, :-1, p] * tr[p, q] * pot[:, 1:, q] * beta[:, 1:, q] * both / np.maximum(_norm(alpha, tr, pot, beta), 1e-300)).sum()
        diff = (y - p1).ravel()
        grad = np.concatenate([np.bincount(feat, diff[cell], k) if k else [], [(diff.reshape(b, t) * before).sum(), (diff.reshape(b, t) * after).sum(), diff.sum()], (pair_gold - pair).ravel(), [(y[:, 0] - p1[:, 0]).sum()]])
        grad = grad / b - 1e-4 * theta
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad**2
        theta = theta + 0.15 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
    model.weights, model.trans, model.start = theta[: k + 3], theta[k + 3 : k + 7].reshape(2, 2), float(theta[-1])


def _norm(alpha, tr, pot, beta):
    return np.einsum("btp,pq,btq,btq->bt", alpha[:, :-1], tr, pot[:, 1:], beta[:, 1:])


def fit_layer(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression with a small ridge, by Newton steps."""
    x = np.hstack([np.ones((len(x), 1)), x])
    theta, ridge = np.zeros(x.shape[1]), np.diag([1e-3] + [0.3] * (x.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(h, x.T @ (weight * (y - p)) - ridge @ theta)
        theta = theta + step
        if abs(step).max() < 1e-8:
            break
    return theta


def without_copies(texts: list[tuple[list[str], int]]) -> list[tuple[list[str], int]]:
    """One of each group of like texts, or all words of a much-copied toxic text would look toxic: texts
    that share the three or the next three least word hashes count as copies."""
    seen: set[tuple] = set()
    out = []
    for words, y in texts:
        least = sorted({zlib.crc32(w.encode()) for w in words})[:6]
        keys = [(y, 0, *least[:3]), (y, 1, *least[3:])]
        if not any(k in seen for k in keys[: 1 + (len(least) > 3)]):
            out.append((words, y))
        seen.update(keys)
    return out


def fit(rows: Iterable[tuple[str, int]], share: float) -> Model:
    """rows (text, toxic), read once; share: of toxic labels among all training labels."""
    model = Model(share=share)
    pool: dict[str, str] = {}  # a word that many texts hold is one object
    texts = without_copies([([pool.setdefault(w, w) for w in words_of(t or "")], y) for t, y in rows])
    del rows, pool
    bags = {y: [set(ws) for ws, z in texts if z == y] for y in (0, 1)}
    if not bags[0] or not bags[1]:
        return model
    shares = lexicon_of(bags[1], bags[0])
    model.lexicon = {f: k for k, f in enumerate(shares)}
    sure = [share >= SURE for share in shares.values()]
    del bags
    if not model.lexicon:
        return model
    finder = lambda w: tuple(model.lexicon[f] for f in word_features(w) if f in model.lexicon)
    known: dict[str, tuple[int, ...]] = {}
    with_hits, without = [], []
    for ws, y in texts:
        for a in range(0, len(ws), PASSAGE):
            feats = []
            for w in ws[a : a + PASSAGE]:
                if w not in known:
                    known[w] = finder(w)
                feats.append(known[w])
            item = (feats, [int(y == 1 and any(sure[k] for k in f)) for f in feats])
            (with_hits if any(feats) else without).append(item)
    half = MAX_PASSAGES // 2
    pick = lambda xs: xs[:: max(1, -(-len(xs) // half))]
    fit_field(model, pick(with_hits) + pick(without))
    chain = Chain(model)
    x = np.array([chain.document(ws)[0] for ws, _ in texts])
    y = np.array([z for _, z in texts], float)
    weight = np.where(y == 1, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    model.layer = fit_layer(x, y, weight)
    return model


def fold(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[Iterator[tuple[str, int]], float]:
    """Up to ``sample`` labelled rows of each class outside the held-out fold, by the order of a hash."""
    known = labels.where("doc_id is not null and toxic is not null").where(fold(F.col("doc_id")) != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total, toxic = known.agg(F.count("*"), F.coalesce(F.sum((F.col("toxic") == 1).cast("long")), F.lit(0))).first()
    found = docs.where("doc_id is not null and text is not null").select("doc_id", "text")
    chosen = None
    for y in (0, 1):
        part = known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = found.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.max("text").alias("text"), F.first("toxic").alias("toxic"))  # 2 * sample small rows
    held = rows.orderBy("doc_id").select("text", F.col("toxic").cast("int").alias("toxic")).toArrow()
    return ((text.as_py(), y.as_py()) for text, y in zip(held.column(0), held.column(1))), (toxic / total if total else 0.0)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    return fit(*training_rows(docs, labels, sample))


def score(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """(row, toxic_score, toxic_spans): each row of ``docs`` whole as a struct, so that its columns may have any name; its score, and its
    spans as (start, length in characters, marginal)."""
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("marginal", pa.float64())]))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = Chain(model) if model.layer is not None else None
        for part in parts:
            scores, spans = [], []
            for text in part.column(1):
                text = text.as_py() or ""
                if chain is None:
                    scores.append(model.share)
                    spans.append([])
                    continue
                x, near = chain.document(words_of(text))
                scores.append(chain.score(x))
                spans.append(_spans(text, near, threshold) if near and max(near.values()) >= threshold else [])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64()), pa.array(spans, spans_type)], ["row", "toxic_score", "toxic_spans"])

    span = T.StructType().add("start", T.IntegerType()).add("length", T.IntegerType()).add("marginal", T.DoubleType())
    schema = T.StructType([T.StructField("row", docs.schema, False), T.StructField("toxic_score", T.DoubleType()), T.StructField("toxic_spans", T.ArrayType(span))])
    return docs.select(F.struct(*docs.columns).alias("row"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def _spans(text: str, near: dict[int, float], threshold: float) -> list[dict]:
    out, last = [], -2
    for i, m in enumerate(_WORD.finditer(text)):
        p = near.get(i, 0.0)
        if p < threshold:
            continue
        if last == i - 1:
            out[-1]["length"], out[-1]["marginal"] = m.end() - out[-1]["start"], max(p, out[-1]["marginal"])
        else:
            out.append({"start": m.start(), "length": m.end() - m.start(), "marginal": p})
        last = i
    return out


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_spans, toxic_spans) per row."""
    model = train(docs, labels)
    rows = score(docs.select("doc_id", F.col("text").cast("string").alias("text")), model)
    doc_id = F.col("row.doc_id")
    held = F.when(doc_id.isNull(), F.lit(False)).otherwise(fold(doc_id) == 0)
    return rows.select(
        doc_id.alias("doc_id"), held.alias("held_out"), F.col("toxic_score").alias("score"), (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"), F.size("toxic_spans").alias("n_spans"), "toxic_spans"
    )


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, with all columns, that score below 0.5."""
    return score(docs, model).where("toxic_score < 0.5").select("row.*")
