"""Document fingerprints by consistent weighted sampling (operator 7).

A text's terms are its five-word shingles as 64-bit hashes, weighted by how often
they occur. For sample k a term x has gamma(2, 1) variates r, c and a uniform b,
all functions of (x, k); with weight w it gets t = floor(ln w / r + b) and
ln a = ln c - r * (t + 1 - b). The term with the smallest a is the sample (x, t):
two texts agree on it with a probability equal to their generalised Jaccard
similarity, the sum of the smaller weights over the sum of the larger. 16 bits of
the hash of (x, t, k) are kept, so two different samples agree by chance once in
65536.

The variates come from three independent exponentials f, g, e: c = f + g,
r = ln(c / f) + e and b = e / r. Since f / c is uniform and independent of c,
r, c and b have the distributions above, and ln a = ln f - r * t. At weight one t
is 0 and a is f, which grows with the hash of (x, k): the least hash decides, and
only repeated terms need all variates.

``neighbours`` pairs each document with the next one in descending doc_id order
in one range shuffle: a task streams over its sorted rows and sets aside its
first and last row; the few set-aside rows (two a task) are paired afterwards.

Defined cases: a NULL text counts as empty; a text without words has the zero
fingerprint, equal to that of any other such text and unlike all others; NULL
doc_ids come last, ties are ordered by text; a single row is its own neighbour;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.common import keyed_texts, scratch_table, ship_package, shuffle_partitions, to_arrow
from cadence.llm.shingles import mix, numbered, shingle_lists

SAMPLES = 128
BLOCK = 1024
SLICE = 256


def _hashes(terms: np.ndarray, samples: int) -> np.ndarray:
    """The 64-bit hash of every (term, sample)."""
    return mix(terms[:, None] ^ numbered(samples, 21))


def _exponential(hashes: np.ndarray) -> np.ndarray:
    """An exponential variate that grows with the hash."""
    return -np.log1p(-((hashes >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53)


def variates(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r, ln f and b of every hash of a (term, sample); ln c = ln f + r * (1 - b)."""
    seeds = numbered(2, 22)
    f, g, e = _exponential(hashes), _exponential(mix(hashes ^ seeds[0])), _exponential(mix(hashes ^ seeds[1]))
    r = np.log1p(g / f) + e
    return r, np.log(f), e / r


def sample(shingles: np.ndarray, samples: int = SAMPLES) -> np.ndarray:
    """The 16-bit codes of a text's samples."""
    if not len(shingles):
        return np.zeros(samples, np.uint16)
    terms, weight = np.unique(shingles, return_counts=True)
    single, many, weight = terms[weight == 1], terms[weight > 1], weight[weight > 1]
    least, code = np.full(samples, np.inf), np.zeros(samples, np.uint64)
    if len(single):
        code = np.min([_hashes(single[i:i + BLOCK], samples).min(axis=0) for i in range(0, len(single), BLOCK)], axis=0)
        least = np.log(_exponential(code))
    column = np.arange(samples)
    for i in range(0, len(many), BLOCK):
        hashes = _hashes(many[i:i + BLOCK], samples)
        r, ln_f, b = variates(hashes)
        t = np.floor(np.log(weight[i:i + BLOCK])[:, None] / r + b)
        ln_a = ln_f - r * t
        at = ln_a.argmin(axis=0)
        lower = ln_a[at, column] < least
        named = hashes[at, column] + t[at, column].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        least, code = np.where(lower, ln_a[at, column], least), np.where(lower, named, code)
    return (mix(code + np.uint64(1)) >> np.uint64(48)).astype(np.uint16)


def fingerprints(texts: list[str], samples: int = SAMPLES) -> list[np.ndarray]:
    return [sample(s, samples) for s in shingle_lists(texts)]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def packed(codes: np.ndarray) -> bytes:
    return codes.astype(">u2").tobytes()


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by the start of ``following``."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


RESULT = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
          ("fingerprint", pa.binary()), ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()),
          ("near_next", pa.float64())]
RESULT_TYPE = ("doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
               "near_edited double, near_next double")


def _results(ids: list, texts: list[str], own: list[np.ndarray], following: list[str],
             following_own: list[np.ndarray], samples: int) -> dict[str, list]:
    changed = [edited(t, f) for t, f in zip(texts, following)]
    marks = fingerprints(changed, samples)
    return {"doc_id": ids, "n_chars": [len(t) for t in texts],
            "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
            "fingerprint": [packed(m) for m in own], "edited_fingerprint": [packed(m) for m in marks],
            "near_edited": [likeness(a, b) for a, b in zip(own, marks)],
            "near_next": [likeness(a, b) for a, b in zip(own, following_own)]}


def neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES,
               partitions: int | None = None) -> DataFrame:
    """One row per document: the columns of ``RESULT``; the edited text ends in
    the start of the next document in descending doc_id order (after the last:
    the first), and ``near_next`` compares with that document."""
    spark = docs.sparkSession
    ship_package(spark)
    schema = pa.schema([("part", pa.int32()), ("place", pa.string()), *RESULT, ("text", pa.string())])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def aside(place: str, doc_id, text: str) -> pa.RecordBatch:
            row = {n: [None] for n in schema.names}
            return to_arrow(row | {"part": [part], "place": [place], "doc_id": [doc_id], "text": [text]}, schema)

        held = None  # the row whose successor is not known yet: id, text, fingerprint
        for batch in batches:
            all_ids, all_texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i in range(0, len(all_ids), SLICE):
                ids, texts = all_ids[i:i + SLICE], all_texts[i:i + SLICE]
                own = fingerprints(texts, samples)
                if held is None:
                    yield aside("first", ids[0], texts[0])
                else:
                    ids, texts, own = [held[0], *ids], [held[1], *texts], [held[2], *own]
                if len(ids) > 1:
                    rows = _results(ids[:-1], texts[:-1], own[:-1], texts[1:], own[1:], samples)
                    n = len(ids) - 1
                    yield to_arrow({"part": [part] * n, "place": ["inner"] * n, **rows, "text": [None] * n}, schema)
                held = ids[-1], texts[-1], own[-1]
        if held is not None:
            yield aside("last", held[0], held[1])

    order = [F.col("doc_id").desc_nulls_last()]
    ranged = (keyed_texts(docs, id_col, text_col)
              .repartitionByRange(partitions or shuffle_partitions(spark), *order)
              .sortWithinPartitions(*order, "text"))
    done = scratch_table(ranged.mapInArrow(stream, f"part int, place string, {RESULT_TYPE}, text string"),
                         "fingerprints")
    # Two rows a task are left: each task's last row meets the next task's first.
    first = done.where("place = 'first'").select("part", F.col("text").alias("next_text"))
    parts = first.select("part")
    successor = parts.select("part", F.coalesce(
        F.lead("part").over(Window.orderBy("part")),
        F.first("part").over(Window.orderBy("part"))).alias("next_part"))
    last = (done.where("place = 'last'").select("part", "doc_id", "text").join(successor, "part")
            .join(first.withColumnRenamed("part", "next_part"), "next_part").select("doc_id", "text", "next_text"))

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, following = (c.to_pylist() for c in batch.columns)
            yield to_arrow(_results(ids, texts, fingerprints(texts, samples), following,
                                    fingerprints(following, samples), samples), pa.schema(RESULT))

    names = [n for n, _ in RESULT]
    found = done.where("place = 'inner'").select(*names).unionByName(last.mapInArrow(pair, RESULT_TYPE))
    return found.withColumns({n: F.lower(F.hex(n)) for n in ("fingerprint", "edited_fingerprint")})
