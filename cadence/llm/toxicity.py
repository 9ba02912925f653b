"""Toxicity: a linear classifier over character n-grams whose features are
scaled by naive Bayes log-count ratios (operator 1).

A text is lower-cased and its white space collapsed to single spaces (one more
at either end), so n-grams at word borders are features of their own. Features
are the distinct hashed n-grams of ``ORDERS`` code points, ``1 << HASH_BITS``
in all. A feature f weighs r_f = ln((1 + toxic rows with f) / (2 + toxic rows))
- ln((1 + other rows with f) / (2 + other rows)); logistic regression on the
values r_f (no further scaling) gives the score. Features seen in fewer than
``MIN_ROWS`` training rows, or with |r_f| below ``MIN_RATIO``, are left out.

The model is fitted on at most ``FIT_ROWS`` labelled rows, the first by a hash
of doc_id (the documented bound of the sample), so the sample's ids can be
broadcast and the texts are never shuffled. Scoring reads whole texts; labels,
lang, source and doc_id are never inputs of a score.

Defined cases: a NULL text counts as empty; an empty text gets the score of a
text without features; a NULL doc_id is scored but never trained on, and is not
held out; a doc_id labelled more than once is toxic if any label says so, NULL
labels are ignored; repeated rows get equal scores; without rows of both labels
the score is the smoothed share of toxic rows; an empty table gives an empty
result; other columns pass through ``with_scores``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import keyed_texts, scratch_table, ship_package, whole_text

ORDERS = (4, 5, 6)
HASH_BITS = 20
FIT_ROWS = 20_000
MIN_ROWS = 5
MIN_RATIO = 1.0
REGULARISATION = 1e-3
THRESHOLD = 0.3
FIT_PARTS = 4
CHUNK_CHARS = 1 << 18
SLICE = 512


def held_out(doc_id: Column) -> Column:
    """The fold whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _grams(codes: np.ndarray, n: int) -> np.ndarray:
    """Hashed n-gram at every position of ``codes``."""
    h = np.zeros(len(codes) - n + 1, np.uint32)
    for j in range(n):
        h *= np.uint32(0x01000193)
        h ^= codes[j:len(codes) - n + 1 + j]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x9E3779B1)
    return h >> np.uint32(32 - HASH_BITS)


def text_features(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, text number within the group, feature), pairs distinct and
    in order, for groups of consecutive texts of bounded size. A text longer
    than a group is read in overlapping parts."""
    group: list[str] = []
    first, size = 0, 0
    for i, text in enumerate(texts):
        plain = f" {' '.join(text.lower().split())} "
        if group and (size + len(plain) > CHUNK_CHARS or len(group) == 4096):
            yield (first, *_group_features(group))
            group, first, size = [], i, 0
        group.append(plain)
        size += len(plain)
    if group:
        yield (first, *_group_features(group))


def _group_features(group: list[str]) -> tuple[np.ndarray, np.ndarray]:
    if len(group) == 1 and len(group[0]) > 2 * CHUNK_CHARS:
        text, seen = group[0], np.zeros(1 << HASH_BITS, bool)
        for at in range(0, len(text), CHUNK_CHARS):
            seen[_group_features([text[at:at + CHUNK_CHARS + max(ORDERS) - 1]])[1]] = True
        found = np.flatnonzero(seen)
        return np.zeros(len(found), np.int64), found
    codes = np.frombuffer("".join(group).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) for t in group])
    owner = np.repeat(np.arange(len(group), dtype=np.uint32), np.diff(ends, prepend=0))
    keys = []
    for n in ORDERS:
        if len(codes) >= n:
            inside = owner[:len(codes) - n + 1] == owner[n - 1:]
            keys.append(((owner[:len(codes) - n + 1] << np.uint32(HASH_BITS)) | _grams(codes, n))[inside])
    key = np.sort(np.concatenate(keys)) if keys else np.empty(0, np.uint32)
    key = key[np.append(True, key[1:] != key[:-1])] if len(key) else key
    return (key >> np.uint32(HASH_BITS)).astype(np.int64), (key & np.uint32((1 << HASH_BITS) - 1)).astype(np.int64)


@dataclass
class ToxicityModel:
    """Weight of every hashed feature (ratio times coefficient), and a bias."""
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        total = np.full(len(texts), self.bias)
        for first, text, feature in text_features(texts):
            w = self.weights[feature]
            some = w != 0
            sums = np.bincount(text[some], weights=w[some])
            total[first:first + len(sums)] += sums
        return 1.0 / (1.0 + np.exp(-np.clip(total, -500, 500)))


def training_rows(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, toxic, text) of at most ``fit_rows`` labelled rows outside the
    held-out fold."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("bigint").alias("label_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("label_id"), "label_id").limit(fit_rows))
    return (keyed_texts(docs).join(F.broadcast(known), F.col("doc_id") == F.col("label_id"))
            .select("doc_id", "toxic", "text"))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """(1 for toxic or 0, text) of ``SLICE`` training rows at a time."""
    for whole in batches:
        for i in range(0, whole.num_rows, SLICE):
            toxic, text = whole.slice(i, SLICE).columns
            yield (toxic.to_numpy(zero_copy_only=False) > 0).astype(np.int64), text.to_pylist()


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> ToxicityModel:
    """Fit on ``labels`` (doc_id, toxic) and the texts of ``docs``."""
    spark = docs.sparkSession
    ship_package(spark)

    rows = scratch_table(training_rows(docs, labels, fit_rows).select("toxic", "text"), "toxicity-rows")
    totals = {r["toxic"]: r["n"] for r in rows.groupBy((F.col("toxic") > 0).cast("int").alias("toxic"))
              .agg(F.count(F.lit(1)).alias("n")).collect()}
    n_pos, n_neg = totals.get(1, 0), totals.get(0, 0)
    share = (n_pos + 1) / (n_pos + n_neg + 2)
    nothing = ToxicityModel(np.zeros(1 << HASH_BITS), float(np.log(share / (1 - share))))
    if not n_pos or not n_neg:
        return nothing

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(2 << HASH_BITS, np.int64)
        for toxic, texts in _slices(batches):
            for first, text, feature in text_features(texts):
                counts += np.bincount((toxic[first + text] << HASH_BITS) + feature, minlength=len(counts))
        counts = counts.reshape(2, -1)
        seen = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_pydict({"feature": seen.astype(np.int32), "neg": counts[0, seen], "pos": counts[1, seen]})

    ratio = F.log((F.col("pos") + 1) / F.lit(n_pos + 2.0)) - F.log((F.col("neg") + 1) / F.lit(n_neg + 2.0))
    chosen = (
        rows.mapInArrow(partial, "feature int, neg long, pos long")
        .groupBy("feature").agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos"))
        .where(F.col("neg") + F.col("pos") >= MIN_ROWS).withColumn("r", ratio)
        .where(F.abs("r") >= MIN_RATIO).select("feature", "r").toPandas().sort_values("feature"))
    if not len(chosen):
        return nothing
    index = np.full(1 << HASH_BITS, -1, np.int32)
    index[chosen["feature"]] = np.arange(len(chosen), dtype=np.int32)
    ratios = chosen["r"].to_numpy()
    shared = spark.sparkContext.broadcast((index, ratios))  # at most 1 << HASH_BITS features

    def chosen_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value[0]
        for toxic, texts in _slices(batches):
            owner, found = [np.empty(0, np.int64)], [np.empty(0, np.int32)]
            for first, text, feature in text_features(texts):
                at = index[feature]
                owner.append(first + text[at >= 0])
                found.append(at[at >= 0])
            cut = np.searchsorted(np.concatenate(owner), np.arange(len(texts) + 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(toxic, pa.float64()),
                 pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(np.concatenate(found), pa.int32()))],
                names=["label", "at"])

    from pyspark.ml.linalg import SparseVector, VectorUDT
    n_features = len(chosen)
    to_vector = F.udf(lambda at: SparseVector(n_features, at, shared.value[1][at]), VectorUDT())
    # Stored in between: a task then runs one Python worker at a time. Few
    # parts hold the bounded sample, so that the fit's sums need no shuffle.
    values = scratch_table(rows.mapInArrow(chosen_features, "label double, at array<int>"), "toxicity-values")
    data = values.coalesce(FIT_PARTS).select("label", to_vector("at").alias("features"))
    model = LogisticRegression(maxIter=40, regParam=REGULARISATION, standardization=False, tol=1e-6).fit(data)
    weights = np.zeros(1 << HASH_BITS)
    weights[chosen["feature"].to_numpy()] = np.asarray(model.coefficients) * ratios
    return ToxicityModel(weights, float(model.intercept))


def with_scores(docs: DataFrame, model: ToxicityModel, name: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` and the column ``name``: the probability of the label toxic."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(shared.value.scores(text.tolist()))

    return docs.withColumn(name, score(whole_text(text_col)))
