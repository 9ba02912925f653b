"""Hierarchical multi-length packing (operator 10).

Each task tokenizes its rows and packs them block by block, a block holding
about ``block_tokens`` tokens, so memory does not depend on the partition:

1. Route: full windows of the longest context are cut off a long document; what
   remains (or the whole document) goes to the shortest tier that holds it.
2. Pack each tier, longest first, into windows of that tier (best fit,
   longest pieces first, pieces whole).
3. Fill the gaps of its windows from shorter tiers, the longest piece that fits
   first; the last gap of a window is closed by cutting a piece.
4. When no piece is left to fill with, the emptiest windows are taken apart to
   fill the others. The tail of a block becomes windows of descending powers of
   two. Every window is then full: there is no padding inside a window whose
   length is a power of two.
5. Windows are dealt into step groups of nearly equal token counts (longest
   first, always to the lightest group).

There is no shuffle and nothing is shared between tasks; a retried task reads
the same rows in the same order and gives the same pieces. ``sequence_id``
carries the partition number in its upper bits.

Defined cases: a NULL or empty text is one piece holding the end id alone; a
NULL doc_id is kept as NULL; repeated rows are packed once each; texts of any
length are cut into pieces, never shortened; an empty table gives no piece;
other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from cadence.llm.common import give_back, keyed_texts, ship_package, to_arrow
from cadence.llm.tokens import encoder, vocabulary

TIERS = (512, 1024, 2048, 4096)
VOCABULARY = "word_bpe_49k.json"
END_ID = 2
STEP_TOKENS = 16 * 4096
#: Words whose ids a worker keeps.
CACHE_WORDS = 300_000
BLOCK_TOKENS = 1 << 21

Piece = tuple[int, int, int]  # length, document, start


class _Pool:
    """Pieces by length, with removal of the longest piece that fits."""

    def __init__(self, pieces: list[Piece]):
        self.pieces = sorted(pieces)

    def take(self, room: int) -> Piece | None:
        at = bisect_left(self.pieces, (room + 1,)) - 1
        return self.pieces.pop(at) if at >= 0 else None

    def cut(self, room: int) -> Piece | None:
        """The first ``room`` tokens of the shortest piece that is longer."""
        at = bisect_left(self.pieces, (room + 1,))
        if at == len(self.pieces):
            return None
        length, doc, start = self.pieces.pop(at)
        insort(self.pieces, (length - room, doc, start + room))
        return room, doc, start


def _best_fit(pieces: list[Piece], size: int) -> list[list]:
    """Windows [free, pieces] of ``size`` tokens, pieces whole, longest first,
    each into the fullest window that still holds it."""
    windows: list[list] = []
    free: list[tuple[int, int]] = []
    for piece in sorted(pieces, reverse=True):
        at = bisect_left(free, (piece[0], -1))
        if at < len(free):
            room, w = free.pop(at)
        else:
            room, w = size, len(windows)
            windows.append([size, []])
        windows[w][1].append(piece)
        windows[w][0] = room - piece[0]
        if windows[w][0]:
            insort(free, (windows[w][0], w))
    return windows


def _fill(window: list, pool: _Pool) -> None:
    while window[0] and (piece := pool.take(window[0])):
        window[1].append(piece)
        window[0] -= piece[0]
    if window[0] and (piece := pool.cut(window[0])):
        window[1].append(piece)
        window[0] = 0


def pack_lengths(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[Piece]]]:
    """Windows (size, pieces) that hold every token once and no padding."""
    tiers = tuple(sorted(tiers))
    longest = tiers[-1]
    done: list[tuple[int, list[Piece]]] = []
    routed: dict[int, list[Piece]] = {t: [] for t in tiers}
    for doc, n in enumerate(lengths):
        start = 0
        while n - start >= longest:
            done.append((longest, [(longest, doc, start)]))
            start += longest
        if n > start:
            routed[tiers[bisect_left(tiers, n - start)]].append((n - start, doc, start))
    pool = _Pool([p for t in tiers[:-1] for p in routed[t]])
    open_windows: list[tuple[int, int, list[Piece]]] = []
    for t in reversed(tiers):
        below = t // 2 if t != tiers[0] else 0
        if t == longest:
            mine = routed[t]
        else:  # what earlier windows have not used, cut rests included
            mine = [p for p in pool.pieces if p[0] > below]
            pool = _Pool([p for p in pool.pieces if p[0] <= below])
        windows = _best_fit(mine, t)
        for w in sorted(windows, key=lambda w: w[0]):
            _fill(w, pool)
            if w[0]:
                open_windows.append((t, w[0], w[1]))
            else:
                done.append((t, w[1]))
    # No whole piece or cut is left: the emptiest open windows fill the others.
    rest: list[Piece] = []
    open_windows.sort(key=lambda w: (w[0] - w[1], w[0]))
    while open_windows:
        size, room, held = open_windows.pop()
        while room:
            if not rest:
                if not open_windows:
                    break
                rest = sorted(open_windows.pop(0)[2])
            length, doc, start = rest.pop()
            use = min(length, room)
            held.append((use, doc, start))
            room -= use
            if use < length:
                rest.append((length - use, doc, start + use))
        if room:
            rest = held
            break
        done.append((size, held))
    # The tail: windows of descending powers of two.
    left = sum(p[0] for p in rest)
    while left:
        size = min(1 << (left.bit_length() - 1), longest)
        held, room = [], size
        while room:
            length, doc, start = rest.pop()
            use = min(length, room)
            held.append((use, doc, start))
            room -= use
            if use < length:
                rest.append((length - use, doc, start + use))
        done.append((size, held))
        left -= size
    return done


def step_groups(sizes: list[int], step_tokens: int) -> list[int]:
    """A group number per window; group totals are nearly equal and about
    ``step_tokens``."""
    groups = [(0, g) for g in range(max(1, round(sum(sizes) / step_tokens)))]
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        total, g = heapq.heappop(groups)
        out[i] = g
        heapq.heappush(groups, (total + sizes[i], g))
    return out


SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("tier", pa.int32()),
    ("step_group", pa.int64())])


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tiers: tuple[int, ...] = TIERS,
         vocab: str = VOCABULARY, end_id: int = END_ID, step_tokens: int = STEP_TOKENS,
         block_tokens: int = BLOCK_TOKENS, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, tier (the window's length), step_group; and the
    piece's ids when ``with_ids``."""
    ship_package(docs.sparkSession)
    path = vocabulary(vocab)
    schema = SCHEMA.append(pa.field("ids", pa.list_(pa.int32()))) if with_ids else SCHEMA

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        enc = encoder(path, "words", CACHE_WORDS)
        base = TaskContext.get().partitionId() << 40
        sequence, group = base, base
        ids: list[int | None] = []
        tokens: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal sequence, group
            windows = pack_lengths([len(t) for t in tokens], tiers)
            groups = step_groups([w[0] for w in windows], step_tokens)
            out: dict[str, list] = {n: [] for n in schema.names}
            for (size, pieces), g in zip(windows, groups):
                offset = 0
                for length, doc, start in pieces:
                    part = tokens[doc][start:start + length]
                    row = (ids[doc], start, length, zlib.crc32(part.astype("<u4").tobytes()), len(tokens[doc]),
                           sequence, offset, size, group + g)
                    for name, value in zip(SCHEMA.names, row):
                        out[name].append(value)
                    if with_ids:
                        out["ids"].append(part.astype(np.int32))
                    offset += length
                sequence += 1
            group += max(groups, default=-1) + 1
            return to_arrow(out, schema)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(doc_id)
                tokens.append(np.append(np.frombuffer(enc.encode(text), enc.dtype), np.array([end_id], enc.dtype)))
                held += len(tokens[-1])
                if held >= block_tokens:
                    yield flush()
                    ids, tokens, held = [], [], 0
        if tokens:
            yield flush()

    spark_type = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
                  "offset long, tier int, step_group long" + (", ids array<int>" if with_ids else ""))
    return keyed_texts(docs, id_col, text_col).mapInArrow(run, spark_type)
