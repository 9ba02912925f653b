"""Spelling variants: words one edit apart, found by blocked Gram matrices.

Words are counted per task while texts stream through, then by a partially
aggregated sum. The frequent enough words are put into blocks of bounded size by
length and, within a length, by how many letters of a few groups they hold. One
edit adds a letter to one group, or takes it from one and gives it to another, so
a block meets only the blocks of its own and of such adjacent cells. Of such
a pair of blocks, one NumPy product of letter-count matrices gives all squared
distances ``|x|^2 + |y|^2 - 2 x.y``; pairs at one or two are kept, and verified
as exactly one inserted, deleted or replaced code point. Only verified pairs
become rows.

Forms point to a near word of at least ``ratio`` times the occurrences, so a
chain of forms is no longer than the logarithm of the largest count; roots follow
by pointer doubling.

NULL text holds no words, texts are read whole, copies count as often as they
stand there, words tie by code-point order, other columns are ignored, and an
empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import keyed_texts, scratch_table, ship_package

LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
#: One run in so many loses a letter (fixed by the contract).
DAMAGE = 199
BLOCK = 1024
SALTS = 16
_HELD_WORDS = 1 << 18
_SLICE = 1 << 20
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_RUN = re.compile("[a-zÀ-ÿ]+")
_LETTERS = 26 + 64
#: Groups of letters whose counts, with that of all other letters, make a cell.
_GROUPS = ("ae", "iou", "nm", "td")


def _runs(text: str) -> Counter:
    """How often each lower-cased run stands in ``text``, read slice by slice."""
    found: Counter = Counter()
    at = 0
    while at < len(text):
        stop = at + _SLICE
        while stop < len(text) and _RUN.match(text[stop].lower() if text[stop] < "\x80" else text[stop]):
            stop += 1
        part = text[at:stop].encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass")
        found.update(_RUN.findall(part))
        at = stop
    return found


def damaged(doc_id: str, run: str, every: int) -> str:
    """``run`` without one letter if its checksum says so."""
    h = zlib.crc32(f"{doc_id}:{run}".encode("utf-8", "surrogatepass"))
    return run[:h % len(run)] + run[h % len(run) + 1:] if h % every == 0 else run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                          names=["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            doc = "" if doc_id.as_py() is None else str(doc_id.as_py())
            head = zlib.crc32(f"{doc}:".encode())
            for run, n in _runs(text.as_py()).items():
                if zlib.crc32(run.encode("utf-8"), head) % DAMAGE == 0:
                    run = damaged(doc, run, DAMAGE)
                if len(run) >= LEAST_LENGTH:
                    held[run] += n
            if len(held) >= _HELD_WORDS:
                yield flush()
                held.clear()
    if held:
        yield flush()


def words(docs: DataFrame) -> DataFrame:
    """(word, n): the words of all texts, frequent enough."""
    return keyed_texts(docs).mapInArrow(_count, "word string, n long").groupBy("word").agg(
        F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _places(letters: np.ndarray) -> np.ndarray:
    """Code points a-z and U+00C0 to U+00FF as 0 to 89."""
    return np.where(letters < 0xC0, letters - ord("a"), letters - 0xC0 + 26)


def _counts(block: list[str]) -> np.ndarray:
    """Letter counts, one row a word."""
    length = np.fromiter(map(len, block), np.int64, len(block))
    letters = _places(np.frombuffer("".join(block).encode("utf-32-le"), "<u4").astype(np.int64))
    at = np.repeat(np.arange(len(block)), length) * _LETTERS + letters
    return np.bincount(at, minlength=len(block) * _LETTERS).reshape(len(block), _LETTERS).astype(np.float32)


def _codes(block: list[str], width: int) -> np.ndarray:
    """Code points, zero after a word's end."""
    return np.array(block, f"<U{width}").view("<u4").reshape(len(block), width)


def candidates(left: list[str], right: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs whose letter counts are one or two apart in squared distance."""
    x, y = _counts(left), _counts(right)
    distance = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
    return np.nonzero((distance > 0.5) & (distance < 2.5))


def one_edit(left: list[str], right: list[str], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs (left[i], right[j]) differ by exactly one edit."""
    width = max(max(map(len, left)), max(map(len, right)))
    a, b = _codes(left, width)[i], _codes(right, width)[j]
    n = np.fromiter(map(len, left), np.int64, len(left))[i]
    m = np.fromiter(map(len, right), np.int64, len(right))[j]
    ahead = np.where((a != b).any(1), (a != b).argmax(1), width)
    # b without its letter at the first difference, against a (a is the shorter word, or of equal length)
    swap = n > m
    short, long = np.where(swap[:, None], b, a), np.where(swap[:, None], a, b)
    place = np.arange(width)[None, :]
    cut = np.where(place < ahead[:, None], long, np.pad(long, ((0, 0), (0, 1)))[:, 1:])
    return np.where(n == m, (a != b).sum(1) == 1, (np.abs(n - m) == 1) & (cut == short).all(1))


_PAIR_STEP = 1 << 17


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs, both ways, of pairs of blocks."""
    names = ["word", "near", "near_n"]
    for batch in batches:
        for row in range(batch.num_rows):
            same = batch.column(0)[row].as_py()
            left, left_n, right, right_n = (batch.column(c)[row].as_py() for c in range(1, 5))
            i, j = candidates(left, right)
            if same:
                i, j = i[i < j], j[i < j]
            for at in range(0, len(i), _PAIR_STEP):
                a, b = i[at:at + _PAIR_STEP], j[at:at + _PAIR_STEP]
                ok = one_edit(left, right, a, b)
                a, b = a[ok].tolist(), b[ok].tolist()
                if a:
                    yield pa.RecordBatch.from_arrays([
                        pa.array([left[x] for x in a] + [right[y] for y in b], pa.string()),
                        pa.array([right[y] for y in b] + [left[x] for x in a], pa.string()),
                        pa.array([right_n[y] for y in b] + [left_n[x] for x in a], pa.int64())], names=names)


def _cell() -> Column:
    counts = [F.length(F.regexp_replace("word", f"[^{g}]", "")) for g in _GROUPS]
    return F.array(*counts, F.length(F.regexp_replace("word", f"[{''.join(_GROUPS)}]", "")))


def _steps() -> list[list[int]]:
    """Changes of a cell by one edit: each letter added, and each group's letter
    replaced by another group's, one of the two directions only."""
    bins = range(len(_GROUPS) + 1)
    unit = [[int(b == g) for b in bins] for g in bins]
    return ([[0 for _ in bins]] + unit
            + [[x - y for x, y in zip(unit[g], unit[h])] for g in bins for h in bins if g < h])


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """(word, near, near_n): all pairs one edit apart, both ways."""
    celled = vocabulary.select("word", "n", _cell().alias("cell"))
    sizes = celled.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    # the sizes are met by (cell, salt), so that a cell with many words is not one task
    salted = sizes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    blocks = (
        celled.withColumn("salt", F.pmod(F.hash("word"), F.lit(SALTS))).join(salted, ["cell", "salt"])
        .withColumn("block", F.pmod(F.xxhash64("word"), "blocks"))
        .groupBy("cell", "block").agg(F.sort_array(F.collect_list(F.struct("word", "n"))).alias("rows"))
        .select("cell", "block", F.col("rows.word").alias("words"), F.col("rows.n").alias("ns")))
    shifted = F.explode(F.array(*[
        F.array(*[F.get("cell", F.lit(b)) + d for b, d in enumerate(step)]) for step in _steps()])).alias("other")
    meets = (
        blocks.select("cell", "block", shifted).join(sizes.withColumnRenamed("cell", "other"), "other")
        .withColumn("other_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
        .where((F.col("cell") != F.col("other")) | (F.col("block") <= F.col("other_block"))).drop("blocks"))
    right = blocks.select(F.col("cell").alias("other"), F.col("block").alias("other_block"),
                          F.col("words").alias("right"), F.col("ns").alias("right_n"))
    return (
        meets.join(blocks, ["cell", "block"]).join(right, ["other", "other_block"])
        .select(((F.col("cell") == F.col("other")) & (F.col("block") == F.col("other_block"))).alias("same"),
                "words", "ns", "right", "right_n")
        .mapInArrow(_near, "word string, near string, near_n long"))


def variants(docs: DataFrame) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n."""
    ship_package(docs.sparkSession)
    vocabulary = scratch_table(words(docs), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near").alias("word")))
    near = near_pairs(vocabulary).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    joined = vocabulary.join(near, "word", "left")
    has_form = -F.col("best.rank") >= F.col("n") * RATIO
    formed = scratch_table(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(has_form, F.col("best.word")).alias("form"), F.when(has_form, -F.col("best.rank")).alias("form_n")), "forms")
    # each step doubles the part of the chain that is behind a word
    links = formed.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = scratch_table(links.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        links = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    return formed.join(links, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
