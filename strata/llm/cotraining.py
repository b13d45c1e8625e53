"""Quality classifier by co-training on two views of a document.

Text view: hashed words and word shapes.  Metadata view: source,
language, length and layout figures (lines, white space, symbols, digits, case,
repetition), each as a coarse class.  Both are naive Bayes models over hashed
features, so a model is a table of counts of fixed size that Spark adds up.

1. Labelled documents train both models; one fold of them is kept for calibration
   (scores in fixed bins against labels give Platt's line).
2. In each round both models score every document without a label.  Where one
   view's calibrated probability is at least ``CONFIDENT``, the document joins the
   other view's training set under that label; both are trained anew.
3. The calibrated views are added as log-odds, calibrated again, and score all
   documents.

Null text: no words, which is a class of its own in the metadata view.  Null
source or language: a class of its own.  A document with several labels counts
with their mean, ties as good.  Repeated rows train and are scored each; rows
without a ``doc_id`` have no label but get a score; without labels of both kinds
all scores are 0.5; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.words import ASCII_LOWER
from strata.session import materialize

TEXT_BITS = 16        # 2**16 text features
META_BITS = 10        # 2**10 metadata features
ROUNDS = 2
CONFIDENT = 0.95
FOLDS = 10            # fold 0 of the labelled documents calibrates, the others train
KEEP = 0.5            # quality score from which a document is kept
STRONGEST = 15        # features of a document that score it: those with the largest weights
LABELS = 200_000      # labelled documents used at most: their table is sent to the tasks
BINS = 200            # score bins of the calibration
BIN_WIDTH = 0.02
VIEWS = (("text", TEXT_BITS), ("meta", META_BITS))
_SYMBOLS = b"#*$%&|<>@{}[]_=+~^\\/"
_SHAPE = bytes(97 if chr(c).isalpha() or c >= 128 else 48 if 48 <= c <= 57 else c for c in range(256))
_MEMO: dict[bytes, tuple[int, int]] = {}


def _word_features(word: bytes) -> tuple[int, int]:
    """Hashed lower-case word and hashed shape (runs collapsed: letters a, digits 0, signs as they are)."""
    shape = bytearray()
    for c in word.translate(_SHAPE):
        if not shape or shape[-1] != c:
            shape.append(c)
    mask = (1 << TEXT_BITS) - 1
    return (xxhash.xxh3_64_intdigest(word.translate(ASCII_LOWER)) & mask,
            xxhash.xxh3_64_intdigest(bytes(shape), seed=1) & mask)


def text_features(raw: bytes | None) -> np.ndarray:
    """Words, shapes, how much of the text each frequent shape makes up, and the share of the commonest word."""
    words = Counter(raw.split() if raw else ())
    if len(_MEMO) > 400_000:
        _MEMO.clear()
    found, shapes, total = set(), Counter(), max(1, words.total())
    for w, n in words.items():
        pair = _MEMO.get(w)
        if pair is None:
            pair = _MEMO[w] = _word_features(w)
        found.update(pair)
        shapes[pair[1]] += n
    shares = [(shape, 20 * n // total) for shape, n in shapes.items() if 20 * n >= total]
    shares.append((-1, 10 * max(words.values(), default=0) // total if total >= 10 else -1))
    found.update(xxhash.xxh3_64_intdigest(f"{a}:{b}".encode(), seed=2) & ((1 << TEXT_BITS) - 1) for a, b in shares)
    return np.fromiter(found, dtype=np.uint16, count=len(found))


def meta_features(raw: bytes | None, source: str | None, lang: str | None) -> np.ndarray:
    raw = raw or b""
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    n, k = max(1, len(raw)), max(1, len(words))
    data = np.frombuffer(raw, dtype=np.uint8)
    upper = int(((data >= 65) & (data <= 90)).sum())
    digits = int(((data >= 48) & (data <= 57)).sum())
    symbols = sum(raw.count(bytes([b])) for b in _SYMBOLS)

    def level(x: float) -> int:  # coarse logarithmic class
        return 0 if x <= 0 else max(1, 12 + int(math.floor(math.log2(x))))

    classes = [source, lang, len(words).bit_length(), len(lines).bit_length(), level(symbols / k), level(digits / n),
               level(upper / k), level((len(lines) - len(set(lines))) / max(1, len(lines))),
               round(10 * len(set(words)) / k), round(sum(map(len, words)) / k), level(len(lines) / k),
               sum(x.rstrip().endswith((b".", b"!", b"?")) for x in lines) * 4 // max(1, len(lines))]
    return np.array([xxhash.xxh3_64_intdigest(f"{i}={c}".encode()) & ((1 << META_BITS) - 1) for i, c in enumerate(classes)],
                    dtype=np.uint16)


def _features(docs: DataFrame, source: str, lang: str) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            src, lng, raws = (batch.column(i).to_pylist() for i in (1, 2, 3))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([text_features(r).astype("<u2").tobytes() for r in raws], pa.binary()),
                 pa.array([meta_features(r, s, g).astype("<u2").tobytes() for r, s, g in zip(raws, src, lng, strict=True)],
                          pa.binary())], names=["doc_id", "text_view", "meta_view"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col(source).cast("string"), F.col(lang).cast("string"),
                       F.col("text").cast("binary"))
    return rows.mapInArrow(scan, "doc_id long, text_view binary, meta_view binary")


class _Model:
    """Naive Bayes over feature presence; ``weights`` are log-ratios, of which a document's strongest are added."""

    def __init__(self, counts: np.ndarray, docs: np.ndarray):
        # the same small rate is added to both classes, so what neither has seen says nothing
        share = counts / np.maximum(docs, 1)[:, None] + 1 / (docs.min() + 1.0)
        self.weights = np.log(share[1] / share[0])
        self.line = (1.0, 0.0)

    def raw(self, features: bytes) -> float:
        w = self.weights[np.frombuffer(features, dtype="<u2")]
        if len(w) > STRONGEST:
            w = w[np.argpartition(-np.abs(w), STRONGEST)[:STRONGEST]]
        return float(w.sum() / STRONGEST)

    def log_odds(self, features: bytes) -> float:
        return self.line[0] * self.raw(features) + self.line[1]


def _count(rows: DataFrame, models, confident: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per view (feature counts by class, documents by class): labelled rows, and the other view's confident ones."""
    limit = math.log(confident / (1 - confident))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = models.value if models is not None else None
        counts = [np.zeros((2, 1 << bits), dtype=np.int64) for _, bits in VIEWS]
        docs = [np.zeros(2, dtype=np.int64) for _ in VIEWS]

        def add(view: int, label: int, features: bytes):
            counts[view][label][np.frombuffer(features, dtype="<u2")] += 1  # features of a row are distinct or few
            docs[view][label] += 1

        for batch in batches:
            for label, *views in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if label is not None:
                    for v in (0, 1):
                        add(v, label, views[v])
                elif known is not None:
                    for v in (0, 1):
                        odds = known[v].log_odds(views[v])
                        if abs(odds) >= limit:
                            add(1 - v, int(odds > 0), views[1 - v])
        keys, parts = [], []
        for v, (_, bits) in enumerate(VIEWS):
            for label in (0, 1):
                for c, part in enumerate(counts[v][label].reshape(-1, 1 << 10)):
                    if part.any():
                        keys.append((v * 2 + label) * 1000 + c)
                        parts.append(part.astype("<i8").tobytes())
                keys.append(-1 - (v * 2 + label))
                parts.append(docs[v][label:label + 1].astype("<i8").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(parts, pa.binary())], names=["part", "counts"])

    def total(key: tuple[Any, ...], frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"part": [key[0]], "counts": [
            sum(np.frombuffer(c, dtype="<i8") for f in frames for c in f["counts"]).astype("<i8").tobytes()]})

    found = (rows.select("label", "text_view", "meta_view").mapInArrow(scan, "part int, counts binary")
             .groupBy("part").applyInPandas(total, "part int, counts binary").collect())  # of fixed size
    counts = [np.zeros((2, 1 << bits), dtype=np.int64) for _, bits in VIEWS]
    docs = [np.zeros(2, dtype=np.int64) for _ in VIEWS]
    for r in found:
        values = np.frombuffer(r.counts, dtype="<i8")
        if r.part < 0:
            docs[(-1 - r.part) // 2][(-1 - r.part) % 2] = values[0]
        else:
            v, label, c = r.part // 2000, r.part // 1000 % 2, r.part % 1000
            counts[v][label][c << 10:(c + 1) << 10] = values
    return list(zip(counts, docs, strict=True))


def platt(bins: np.ndarray, good: np.ndarray, bad: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the log-odds over bin centres, by Newton steps with a little damping."""
    if good.sum() == 0 or bad.sum() == 0:
        return 0.0, 0.0
    a, b = 0.0, math.log((good.sum() + 1) / (bad.sum() + 1))
    n = good + bad
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * bins + b, -30, 30)))
        g = np.array([((good - n * p) * bins).sum() - 1e-3 * a, (good - n * p).sum()])
        w = n * p * (1 - p)
        h = np.array([[(w * bins * bins).sum() + 1e-3, (w * bins).sum()], [(w * bins).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a + step[0], b + step[1]
        if abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def _binned(scored: DataFrame, column: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin centres, good, bad) of a score over labelled rows: at most 2 * BINS + 1 rows reach the driver."""
    at = F.least(F.greatest(F.round(F.col(column) / BIN_WIDTH), F.lit(-BINS)), F.lit(BINS)).cast("int").alias("at")
    rows = scored.groupBy(at).agg(F.sum("label").alias("good"), F.sum(1 - F.col("label")).alias("bad")).collect()
    return (np.array([r.at * BIN_WIDTH for r in rows], dtype=float), np.array([r.good for r in rows], dtype=float),
            np.array([r.bad for r in rows], dtype=float))


def _scored(rows: DataFrame, models, columns: list[str]) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = models.value
        for batch in batches:
            k = len(columns)
            scores = [[m.log_odds(f) for f in batch.column(k + v).to_pylist()] for v, m in enumerate(known)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:k], *[pa.array(s, pa.float64()) for s in scores]],
                                             names=[*columns, "text_odds", "meta_odds"])

    kinds = {"doc_id": "long", "label": "int"}
    return rows.select(*columns, "text_view", "meta_view").mapInArrow(
        scan, ", ".join(f"{c} {kinds[c]}" for c in columns) + ", text_odds double, meta_odds double")


def quality_scores(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS, confident: float = CONFIDENT,
                   hold_out: int | None = None, source: str = "source", lang: str = "lang",
                   label: str = "quality") -> DataFrame:
    """Per row: doc_id, text_score, meta_score, quality_score (probabilities of good quality).

    At most ``LABELS`` labels (by a hash of the id) are used; further ones count as unknown.
    ``hold_out``: a fold (1 to FOLDS - 1) of the labels that is not used, for measuring.
    """
    spark = docs.sparkSession
    truth = labels.filter(f"doc_id is not null and {label} is not null").groupBy(F.col("doc_id").cast("long").alias("of")) \
        .agg((F.avg(label) >= 0.5).cast("int").alias("label"))
    truth = truth.orderBy(F.xxhash64("of"), "of").limit(LABELS)
    rows = _features(docs, source, lang).join(F.broadcast(truth), F.col("doc_id") == F.col("of"), "left").drop("of")  # <= LABELS rows
    rows = rows.withColumn("fold", F.when(F.col("label").isNotNull(), F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int")))
    rows = materialize(rows, "views")
    unused = F.col("fold") == 0 if hold_out is None else F.col("fold").isin(0, hold_out)
    training = rows.filter("label is null").union(rows.filter(F.col("label").isNotNull() & ~unused))
    calibration = rows.filter("fold = 0")

    models, handle = None, None
    for _ in range(rounds + 1):  # the first training uses labels only
        models = [_Model(c, d) for c, d in _count(training, handle, confident)]
        handle = spark.sparkContext.broadcast(models)
        scored = materialize(_scored(calibration, handle, ["label"]), "calibration")
        for model, column in zip(models, ("text_odds", "meta_odds"), strict=True):
            model.line = platt(*_binned(scored, column))
        handle = spark.sparkContext.broadcast(models)  # two tables of fixed size
    scored = materialize(_scored(calibration, handle, ["label"]), "calibration")
    both = F.col("text_odds") + F.col("meta_odds")
    slope, offset = platt(*_binned(scored.withColumn("both", both), "both"))

    def probability(odds):
        return F.round(1 / (1 + F.exp(-odds)), 6)

    return _scored(rows, handle, ["doc_id"]).select(
        "doc_id", probability(F.col("text_odds")).alias("text_score"), probability(F.col("meta_odds")).alias("meta_score"),
        probability(slope * both + offset).alias("quality_score"))


def judged(scores: DataFrame, keep: float = KEEP) -> DataFrame:
    return scores.withColumn("kept", F.col("quality_score") >= keep)
