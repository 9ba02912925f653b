"""Substring dedup by paragraph MinHash banding (operator 4).

A text's paragraphs are its lines and the passages of every line: a line is cut
after sentence ends, unless one of the four words before ends a sentence too, and
a passage of over ``LONG`` words also after pairs of words chosen by their hash.
Cuts depend on the words next to them only, so that a passage planted into other
text is cut as it is elsewhere. Consecutive lines of one to four words, also with
lines without words in between, are one paragraph. What has fewer than five words
then has no shingle of five words and is none: lines of one to four words beside
longer ones, and such ends of lines.

Paragraphs are compared by their sets of five-word shingles. Equal sets are one
class. The MinHash of a set, of whatever size, is cut into bands tuned for
recall: with ``rows`` coordinates a band, ``tune_bands`` gives as many bands as keep
the chance of missing a pair at the threshold below ``miss``. Paragraphs whose sets
share a bucket are confirmed by the exact Jaccard
similarity of their sets (``linking``), linked paragraphs form components, and of
each component the first occurrence stays: whole lines come before passages of
lines, then the smallest doc_id, then the place in the text. Passages of a line
that goes are no occurrences, since they go with it.

Defined cases: a NULL text counts as empty and has no paragraph; NULL doc_ids come
after all others; rows sharing a doc_id are told apart by their texts, and repeated
rows are occurrences of their own, with equal results; an empty table gives an
empty result; other columns pass through ``drop_paragraphs``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.bloom import filter_bits, maybe_in, membership, position_bitmap
from cadence.llm.common import discard, fresh, give_back, keyed_texts, scratch_table, ship_package, slices, whole_text
from cadence.llm.linking import shared_components
from cadence.llm.shingles import LOWER, WORDS, key_terms, mix, numbered, rolled_hashes, set_key, shingle_sets, word_spans

LONG = 64
PERCENT = 80
ROWS = 3
MISS = 0.02
GROUP_BYTES = 1 << 18
BLOCK = 1 << 17


def tune_bands(percent: int = PERCENT, rows: int = ROWS, miss: float = MISS) -> int:
    """Bands that make the chance of missing a pair at the threshold at most
    ``miss``."""
    return math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** rows))


_END = re.compile(r"""[.!?…。！？]['")\]”’»」』.!?…]*$""")
_SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def _codes(marks: str) -> list[int]:
    return [int.from_bytes(c.encode(), "big") for c in marks]


def _sentence_ends(data: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Which words end a sentence, as ``_END`` has it."""
    last = data[stop - 1].astype(np.int64)
    pair = np.where(stop - first > 1, data[np.maximum(stop - 2, 0)], 0).astype(np.int64) << 8 | last
    three = np.where(stop - first > 2, data[np.maximum(stop - 3, 0)], 0).astype(np.int64) << 16 | pair
    ends = np.isin(last, _codes(".!?")) | np.isin(three, _codes("…。！？"))
    closed = np.isin(last, _codes("'\")]")) | np.isin(pair, _codes("»")) | np.isin(three, _codes("”’」』"))
    for i in np.flatnonzero(closed).tolist():  # a few words end with a quote or bracket
        ends[i] = _END.search(data[first[i]:stop[i]].tobytes().decode("utf-8", "surrogatepass")) is not None
    return ends


class Units:
    """The paragraphs of a group of texts: parallel arrays text (number in the
    group), paragraph (line number), start, stop (code points), passage, w0, w1
    (range of the group's words), n (distinct shingles), key_a, key_b; and the
    group's shingles ``rolled``, of which a paragraph has those from w0 to w1 - WORDS."""

    def __init__(self, group: list[bytes]):
        data = np.frombuffer(b"\n".join(group) + b"\n", np.uint8)
        begins = np.cumsum([0] + [len(g) + 1 for g in group])[:-1]
        first, stop, words = word_spans(data)
        breaks = np.flatnonzero(data == 10)
        line_text = np.searchsorted(begins, breaks, side="right") - 1
        line_begin = np.append(0, breaks[:-1] + 1)
        line_no = np.arange(len(breaks)) - np.searchsorted(breaks, begins)[line_text]
        line = np.searchsorted(breaks, first)
        count = np.bincount(line, minlength=len(breaks))
        w0 = np.cumsum(count) - count

        full = np.flatnonzero(count >= WORDS)
        parts, part_line = self._passages(data, first, stop, words, line, count, w0)
        run_first, run_last = self._runs(count, line_text, w0)

        # a paragraph as (line that names it, first byte, byte after the last, passage, words)
        named = np.concatenate([full, run_first, part_line])
        self.w0 = np.concatenate([w0[full], w0[run_first], parts[:, 0]])
        self.w1 = np.concatenate([w0[full] + count[full], w0[run_last] + count[run_last], parts[:, 1]])
        begin = np.concatenate([line_begin[full], line_begin[run_first], first[parts[:, 0]] if len(parts) else parts[:, 0]])
        end = np.concatenate([breaks[full], breaks[run_last], stop[parts[:, 1] - 1] if len(parts) else parts[:, 1]])
        self.text, self.paragraph = line_text[named], line_no[named]
        point = np.append(0, np.cumsum((data & 0xC0) != 0x80))
        self.start, self.stop = point[begin] - point[begins[self.text]], point[end] - point[begins[self.text]]
        self.passage = np.arange(len(named)) >= len(full) + len(run_first)
        self.rolled = rolled_hashes(words)
        self._keys()

    @staticmethod
    def _passages(data, first, stop, words, line, count, w0):
        """(w0, w1) and line of the passages, of lines that are cut."""
        n = len(first)
        if not n:
            return np.empty((0, 2), np.int64), np.empty(0, np.int64)
        ends = np.flatnonzero(_sentence_ends(data, first, stop))
        before = np.append(-1, ends[:-1])[:len(ends)]
        before = np.maximum(before, w0[line[ends]] - 1)
        cut = np.zeros(n, bool)
        cut[ends[ends - before >= WORDS]] = True
        cut[(w0 + count - 1)[count > 0]] = True
        last = np.flatnonzero(cut)
        begin = np.append(0, last[:-1] + 1)
        part = np.repeat(np.arange(len(last)), last - begin + 1)
        pair = np.append(np.uint64(1), mix(words[:-1] * _PAIR + words[1:])) % np.uint64(16)
        at = np.arange(n)
        cut |= (last - begin >= LONG)[part] & (at > begin[part]) & (at < last[part]) & (pair == 0)
        last = np.flatnonzero(cut)
        begin = np.append(0, last[:-1] + 1)
        kept = last - begin >= WORDS - 1
        last, begin = last[kept], begin[kept]
        own = line[last]
        several = np.bincount(own, minlength=len(count))[own] > 1
        shown = several | (last - begin + 1 < count[own])
        return np.stack([begin[shown], last[shown] + 1], 1), own[shown]

    @staticmethod
    def _runs(count, line_text, w0):
        """First and last lines of the runs of lines of fewer than WORDS words that
        have WORDS in all; lines without words do not end a run."""
        held = np.flatnonzero(count)
        short = count[held] < WORDS
        new = np.append(True, (line_text[held][1:] != line_text[held][:-1]) | ~short[1:] | ~short[:-1])[:len(held)]
        head = np.flatnonzero(new & short)
        tail = np.flatnonzero(np.append(new[1:], True)[:len(held)] & short)
        first, last = held[head], held[tail]
        enough = w0[last] + count[last] - w0[first] >= WORDS
        return first[enough], last[enough]

    def _keys(self):
        """Sizes and keys from running sums; paragraphs with a shingle that stands
        more than once in the group are counted one by one."""
        a, b = self.w0, self.w1 - WORDS + 1
        self.n = b - a
        keys = []
        for terms in key_terms(self.rolled):
            sums = np.append(np.uint64(0), np.cumsum(terms, dtype=np.uint64))
            keys.append((sums[b] - sums[a]).view(np.int64))
        ordered = np.sort(self.rolled)
        repeated = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if len(repeated):
            at = np.minimum(np.searchsorted(repeated, self.rolled), len(repeated) - 1)
            many = np.append(0, np.cumsum(repeated[at] == self.rolled))
            for i in np.flatnonzero(many[b] - many[a] > 1).tolist():
                one = np.unique(self.rolled[a[i]:b[i]])
                self.n[i] = len(one)
                keys[0][i], keys[1][i] = set_key(one)
        self.key_a, self.key_b = keys

    def bands(self, chosen: np.ndarray, bands: int, rows: int) -> np.ndarray:
        """(chosen, bands) bucket numbers: the MinHash of independent multiplicative
        hash functions, band by band."""
        out = np.empty((len(chosen), bands), np.int64)
        size = self.w1[chosen] - WORDS + 1 - self.w0[chosen]
        stops = np.cumsum(size)
        factor, shift = numbered(bands * rows, 41) | np.uint64(1), numbered(bands * rows, 42)
        join = numbered(rows, 13) | np.uint64(1)
        i = 0
        while i < len(chosen):
            j = max(i + 1, int(np.searchsorted(stops, (stops[i - 1] if i else 0) + BLOCK)))
            begin = np.cumsum(size[i:j]) - size[i:j]
            at = np.arange(int(size[i:j].sum())) - np.repeat(begin - self.w0[chosen[i:j]], size[i:j])
            values = self.rolled[at]
            for band in range(bands):
                total = np.zeros(j - i, np.uint64)
                for row in range(rows):
                    k = band * rows + row
                    total += mix(np.minimum.reduceat(values * factor[k] + shift[k], begin)) * join[row]
                out[i:j, band] = mix(total + np.uint64(band)).view(np.int64)
            i = j
        return out


_PAIR = numbered(1, 43)[0] | np.uint64(1)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, Units]]:
    """(doc_ids, text_hashes, units) of texts of a bounded number of bytes, or one."""
    for whole in batches:
        for part in slices(whole, 2, GROUP_BYTES):
            doc_ids, hashes, texts = (c.to_pylist() for c in part.columns)
            yield doc_ids, hashes, Units([t.encode("utf-8", "surrogatepass").translate(LOWER) for t in texts])


def _rid():
    """A number that nearly always names one paragraph."""
    place = F.shiftleft("start", 1).bitwiseOR(F.col("passage").cast("bigint"))
    return F.col("text_hash").bitwiseXOR(F.shiftleft(F.coalesce("doc_id", F.lit(0).cast("bigint")), 24)).bitwiseXOR(place)


def paragraph_rows(texts: DataFrame, bands: int, rows: int) -> DataFrame:
    """One row per paragraph of (doc_id, text_hash, text), with its buckets."""
    names = ["paragraph", "start", "stop", "passage", "n", "key_a", "key_b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for doc_ids, hashes, units in _groups(batches):
            own = pa.array(units.text)
            found = units.bands(np.arange(len(units.n)), bands, rows)
            offsets = pa.array(np.arange(0, found.size + 1, bands, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()).take(own), pa.array(hashes, pa.int64()).take(own),
                 *(pa.array(getattr(units, n)) for n in names), pa.ListArray.from_arrays(offsets, pa.array(found.ravel()))],
                names=["doc_id", "text_hash", *names, "bands"])

    return texts.mapInArrow(run, "doc_id long, text_hash long, paragraph long, start long, stop long, passage boolean, "
                                 "n long, key_a long, key_b long, bands array<long>")


def repeated_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
                        rows: int = ROWS, miss: float = MISS) -> DataFrame:
    """One row per paragraph that has a near copy elsewhere: doc_id, text_hash,
    paragraph (line number), start, stop (code points), first_doc_id,
    first_paragraph (of the occurrence that stays), occurrences, kept, passage
    (whether it is a part of its line), first_start (of the one that stays)."""
    ship_package(docs.sparkSession)
    bands = tune_bands(percent, rows, miss)
    texts = keyed_texts(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    listed = scratch_table(paragraph_rows(texts, bands, rows), "paragraphs")
    place = F.struct("passage", F.col("doc_id").isNull().alias("unknown"), "doc_id", "paragraph", "start", "stop",
                     "text_hash")
    # Paragraphs whose set nobody else has are classes of their own and are not shuffled.
    bits = filter_bits(listed.count())
    repeated = position_bitmap(listed.select("key_a"), bits, least=2)
    many = membership(docs.sparkSession, repeated, bits)
    grouped = scratch_table(
        listed.where(many("key_a")).groupBy("key_a", "key_b")
        .agg(F.count(F.lit(1)).alias("size"), F.first("n").alias("n"), F.min(place).alias("one")), "paragraph-classes")
    single = listed.where(~many("key_a")).select("key_a", "key_b", F.lit(1).cast("bigint").alias("size"), "n", place.alias("one"))

    # The buckets of one paragraph of every class (and of a few more).
    rids = scratch_table(grouped.select("one.*").select(_rid().alias("rid")), "rids")
    banded = listed.where((~many("key_a") | maybe_in(rids)(_rid())) & (F.col("n") * (100 - percent) >= percent))
    members = banded.select("key_a", "key_b", "n", F.explode("bands").alias("bucket"))
    # Only buckets with several members are joined; of the others not even the class is shuffled.
    full = scratch_table(members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("bucket"), "full")
    some = scratch_table(members.where(maybe_in(full)("bucket")).join(full, "bucket").distinct(), "bucket-members")
    near = maybe_in(some.select("key_a"))
    classes = scratch_table(
        grouped.where((F.col("size") > 1) | near("key_a")).unionByName(single.where(near("key_a")))
        .withColumn("vid", F.monotonically_increasing_id()), "live-classes")
    held = scratch_table(some.drop("n").join(classes.select("key_a", "key_b", "vid", "n"), ["key_a", "key_b"])
                         .select("vid", "n", "bucket"), "held")
    sizes = scratch_table(held.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "sizes")
    shared = scratch_table(held.join(sizes, "bucket"), "members")
    discard(rids, full, some, held, sizes, grouped)
    own_bands = scratch_table(shared.groupBy("vid").agg(F.sort_array(F.collect_list("bucket")).alias("bands")), "bands")

    def sets_of(vids: DataFrame) -> DataFrame:
        wanted = scratch_table(
            classes.join(vids, "vid")
            .groupBy(F.col("one.doc_id").alias("w_id"), F.col("one.text_hash").alias("w_hash"))
            .agg(F.collect_list(F.struct("vid", F.col("one.start").alias("start"), F.col("one.stop").alias("stop")))
                 .alias("wanted")), "wanted")
        holders = texts.where(maybe_in(wanted.select("w_hash"))("text_hash")).join(
            wanted, F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("text_hash") == F.col("w_hash")))
        # Rows repeated in the input hold the same sets.
        holders = holders.groupBy("w_id", "w_hash").agg(F.first("text").alias("text"), F.first("wanted").alias("wanted"))
        return unit_sets(holders.select("text", "wanted.vid", "wanted.start", "wanted.stop"))

    labels = shared_components(shared, own_bands, sets_of, percent)
    named = scratch_table(
        classes.select("vid", "key_a", "key_b", "size").join(labels, "vid", "left")
        .where(F.col("label").isNotNull() | (F.col("size") > 1))
        .select("key_a", "key_b", F.coalesce("label", "vid").alias("label")), "named")
    found = scratch_table(
        listed.drop("n", "bands").where(maybe_in(named.select("key_a"))("key_a")).join(named, ["key_a", "key_b"])
        .drop("key_a", "key_b"), "found")
    discard(listed, shared, own_bands, classes, named)
    lines = found.where("not passage")
    line_first = scratch_table(lines.groupBy("label").agg(F.min(place).alias("first")), "line-first")
    gone = scratch_table(
        lines.join(line_first, "label").where(place != F.col("first"))
        .select(F.col("doc_id").alias("g_id"), F.col("text_hash").alias("g_hash"), F.col("paragraph").alias("g_line"))
        .distinct(), "gone-lines")
    left = scratch_table(lines.unionByName(found.where("passage").join(
        gone, F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.col("text_hash") == F.col("g_hash"))
        & (F.col("paragraph") == F.col("g_line")), "left_anti")), "occurrences")
    first = scratch_table(
        left.groupBy("label").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("occurrences"))
        .where("occurrences > 1"), "first")
    return left.join(first, "label").select(
        "doc_id", "text_hash", "paragraph", "start", "stop", F.col("first.doc_id").alias("first_doc_id"),
        F.col("first.paragraph").alias("first_paragraph"), "occurrences",
        place.eqNullSafe(F.col("first")).alias("kept"), "passage", F.col("first.start").alias("first_start"))


def unit_sets(units: DataFrame) -> DataFrame:
    """(vid, items) of the parts of (text, vid, start, stop), the last three
    arrays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text, vids, starts, stops = (c[i].as_py() for c in batch.columns)
                sets = [s.view(np.int64) for s in shingle_sets([text[a:b] for a, b in zip(starts, stops)])]
                yield pa.RecordBatch.from_arrays([pa.array(vids, pa.int64()), pa.array(sets, pa.list_(pa.int64()))],
                                                 names=["vid", "items"])

    return units.mapInArrow(run, "vid long, items array<long>")


def cut_out(text: str, gone: list) -> str:
    """``text`` without the lines and passages (start, stop) in ``gone``; a line
    of which no word is left goes too."""
    spans, out, at, k = sorted((g[0], g[1]) for g in gone), [], 0, 0
    for line in text.split("\n"):
        stop, rest, begin, hit = at + len(line), "", at, False
        while k < len(spans) and spans[k][0] <= stop:
            rest += text[begin:max(begin, spans[k][0])]
            begin, hit = min(max(begin, spans[k][1]), stop), True
            if spans[k][1] > stop:
                break
            k += 1
        rest += text[begin:stop]
        if not hit or rest.strip(_SPACES):
            out.append(rest)
        at = stop + 1
    return "\n".join(out)


def drop_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the paragraphs that do not stay; all rows and columns
    are kept."""
    gone = scratch_table(
        repeated_paragraphs(docs, id_col, text_col, **options).where(~F.col("kept"))
        .groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "stop")).alias("gone")), "gone")
    th, g_id, g_hash, spans = fresh(docs, "th", "g_id", "g_hash", "spans")
    joined = docs.withColumn(th, F.xxhash64(whole_text(text_col))).join(
        gone.select(F.col("doc_id").alias(g_id), F.col("text_hash").alias(g_hash), F.col("gone").alias(spans)),
        F.col(f"`{id_col}`").cast("bigint").eqNullSafe(F.col(g_id)) & (F.col(th) == F.col(g_hash)), "left")
    left = F.udf(lambda text, gone: text if gone is None else cut_out(text, gone), "string")
    return joined.withColumn(text_col, F.when(F.col(spans).isNull(), F.col(f"`{text_col}`")).otherwise(
        left(whole_text(text_col), F.col(spans)))).select(*(f"`{c}`" for c in docs.columns))
