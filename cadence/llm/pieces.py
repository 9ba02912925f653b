"""SentencePiece encoding with N-best segmentation, and decoding (operator 6).

A text is normalised as the model's vocabulary has it: a leading space, spaces
written as U+2581. All segmentations into vocabulary pieces form a lattice;
characters that no piece starts with fall back to byte pieces. A forward Viterbi
pass gives every position the score of its best prefix. A backward A* search from
the end then takes partial segmentations in the order of (score so far + best
prefix score): the prefix scores are exact, so complete segmentations come out
from the best to the N-th best.

A piece's score is its log probability, by how often the library's own encoder uses
it in all documents (the scores in the model file of a merge vocabulary are ranks,
which do not add up).

No piece holds a space mark after another character, nor (checked when the model is
read) a letter next to another kind of character, so the lattice is a chain of chunks
(a run of space marks and the letters, or other characters, after it). A chunk's N best
are kept in a bounded cache; the N best of a text differ from the best in the
few chunks whose second-best costs least, and are found by the same best-first
search over the chain.

Defined cases: a NULL text counts as empty; an empty text has no pieces and one
segmentation of score 0; ``decode`` gives the text back exactly, except that
U+2581 itself reads as a space; NULL doc_ids are kept; repeated rows get equal
results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import gc
import heapq
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import keyed_texts, ship_package, slices
from cadence.llm.tokens import vocabulary

VOCABULARY = "piece_bpe_32k.model"
N_BEST = 3
UNSEEN = 0.1
CACHE_CHUNKS = 400_000
LONGEST_CACHED = 48
SPACE = "▁"
_CHUNK = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
_CHUNK_OR_BREAK = re.compile(f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+")
_LETTERS = r"[^\W\d_²³¹⁰-₟¼-¾]"
_LETTER = re.compile(_LETTERS)
_KIND_OR_BREAK = re.compile(f"\n|{SPACE}*{_LETTERS}+|{SPACE}*(?:(?!{_LETTERS})[^{SPACE}\n])+|{SPACE}+")

Segmentation = tuple[float, bytes]


class PieceModel:
    """Pieces, their scores (of the model file, if none are given), and the byte
    pieces, read from a model file."""

    def __init__(self, path: str, scores: np.ndarray | None = None):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.scores: list[float] = []
        self.byte_ids = [-1] * 256
        self.raw: list[bytes] = []
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            self.scores.append(model.get_score(i) if scores is None else float(scores[i]))
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.raw.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                self.raw.append(b"")
            else:
                self.ids[piece] = i
                self.raw.append(piece.encode())
        self.trie: dict[str, list] = {}  # character -> [score or None, what follows]
        for piece, i in self.ids.items():
            below = self.trie
            for c in piece:
                node = below.setdefault(c, [None, {}])
                below = node[1]
            node[0] = self.scores[i]
        self.fallback = -10.0 * len(self.scores) if scores is None else min(self.scores) - 10.0
        self.packed = {piece: i.to_bytes(4, "little") for piece, i in self.ids.items()}
        # A line feed that no piece holds is a byte piece on its own, always.
        self.chunks = _CHUNK if any("\n" in p for p in self.ids) else _CHUNK_OR_BREAK
        if self.chunks is _CHUNK_OR_BREAK and not any(
                a != SPACE and bool(_LETTER.match(a)) != bool(_LETTER.match(b)) for p in self.ids for a, b in zip(p, p[1:])):
            self.chunks = _KIND_OR_BREAK
        # Two generations of CACHE_CHUNKS: what is met again moves on to the new one.
        self.cache: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}

    def lattice(self, chunk: str) -> tuple[list[list[tuple[float, int]]], list[float]]:
        """For every end position the pieces there as (score of the best prefix
        that ends with the piece, start), best first; and the best prefix scores
        (forward Viterbi)."""
        n, trie = len(chunk), self.trie
        ends: list[list[tuple[float, int]]] = [[] for _ in range(n + 1)]
        best = [0.0] * (n + 1)
        for start in range(n + 1):
            here, found = 0.0, ends[start]
            if start:
                if len(found) > 1:
                    found.sort(reverse=True)
                here = best[start] = found[0][0]
            below, stop = trie, start
            for c in chunk[start:]:
                node = below.get(c)
                if node is None:
                    break
                stop += 1
                score, below = node
                if score is not None:
                    ends[stop].append((here + score, start))
            if start < n and not (ends[start + 1] and ends[start + 1][-1][1] == start):
                ends[start + 1].append((here + self.fallback * len(chunk[start].encode("utf-8", "surrogatepass")), start))
        return ends, best

    def packed_ids(self, part: str) -> bytes:
        return self.packed.get(part) or b"".join(
            self.byte_ids[b].to_bytes(4, "little") for b in part.encode("utf-8", "surrogatepass"))

    def n_best(self, chunk: str, n: int) -> list[Segmentation]:
        """The ``n`` best segmentations of a chunk (fewer if there are fewer),
        best first, as (score, packed ids). A heap entry is a partial segmentation from
        the end, with the rank of the next piece to put before it; its key is
        the total score of the best segmentation that continues so. Taking an
        entry adds the entry of the next rank and the one that goes on."""
        ends, best = self.lattice(chunk)
        size = len(chunk)
        heap = [(-best[size], 0, size, 0, 0.0, None)]
        pushed, out, packed = 0, [], self.packed_ids
        while heap and len(out) < n:
            _, _, at, rank, tail, path = heapq.heappop(heap)
            while at:
                pieces = ends[at]
                if rank + 1 < len(pieces):
                    pushed += 1
                    heapq.heappush(heap, (-(pieces[rank + 1][0] + tail), pushed, at, rank + 1, tail, path))
                reach, start = pieces[rank]
                tail += reach - best[start]
                path, at, rank = (start, at, path), start, 0
            ids = []
            while path is not None:
                ids.append(packed(chunk[path[0]:path[1]]))
                path = path[2]
            out.append((tail, b"".join(ids)))
        return out

    def chunk(self, chunk: str, n: int) -> tuple:
        """(best ids packed, best score, cost of the second best, all scores, all
        ids packed)."""
        known = self.old.get(chunk)
        if known is None:
            found = self.n_best(chunk, n)
            cost = found[0][0] - found[1][0] if len(found) > 1 else float("inf")
            # Flat tuples of plain values: the garbage collector does not track them.
            packed = tuple(ids for _, ids in found)
            known = packed[0], found[0][0], cost, tuple(score for score, _ in found), packed
        if len(chunk) <= LONGEST_CACHED:
            if len(self.cache) >= CACHE_CHUNKS:
                self.old, self.cache = self.cache, {}
            self.cache[chunk] = known
        return known

    def encode(self, text: str, n: int = N_BEST) -> list[tuple[float, bytes]]:
        """The ``n`` best segmentations of a whole text, best first, as (score,
        ids packed as little-endian 32-bit integers)."""
        if not text:
            return [(0.0, b"")]
        get, chunk = self.cache.get, self.chunk
        parts = [get(c) or chunk(c, n) for c in self.chunks.findall(SPACE + text.replace(" ", SPACE))]
        packed, scores, costs, _, _ = zip(*parts)
        score = sum(scores)
        out = [(score, b"".join(packed))]
        if n == 1:
            return out
        # Only the n - 1 chunks whose second best costs least can change.
        cost = np.array(costs)
        most = np.partition(cost, n - 2)[n - 2] if len(cost) >= n else np.inf
        few = np.flatnonzero((cost <= most) & (cost < np.inf))
        open_chunks = sorted(few.tolist(), key=lambda k: (costs[k], k))[:n - 1]
        heap = [(0.0, (0,) * len(open_chunks))]
        seen = {heap[0][1]}
        while heap and len(out) < n:
            _, choice = heapq.heappop(heap)
            if any(choice):
                ids, total = list(packed), score
                for k, c in zip(open_chunks, choice):
                    ids[k] = parts[k][4][c]
                    total += parts[k][3][c] - parts[k][1]
                out.append((total, b"".join(ids)))
            for j, k in enumerate(open_chunks):
                c = choice[:j] + (choice[j] + 1,) + choice[j + 1:]
                if c[j] < len(parts[k][3]) and c not in seen:
                    seen.add(c)
                    cost = sum(parts[q][1] - parts[q][3][x] for q, x in zip(open_chunks, c))
                    heapq.heappush(heap, (cost, c))
        return out

    def decode(self, ids) -> str:
        """The text of a segmentation."""
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "surrogatepass").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=2)
def model(path: str, scores: bytes | None = None) -> PieceModel:
    """One model per worker. Its trie lives as long as the worker does, so it is
    taken out of the garbage collector's sight."""
    made = PieceModel(path, None if scores is None else np.frombuffer(scores, np.float64))
    gc.collect()
    gc.freeze()
    return made


@lru_cache(maxsize=1)
def _library(path: str):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=path)


def fit_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab: str = VOCABULARY) -> np.ndarray:
    """Log probabilities of the pieces: their counts in the library's encodings of
    every row, with ``UNSEEN`` added to each. Tasks count, Spark adds the counts up, and
    the driver reads one number a piece."""
    path = vocabulary(vocab)
    ship_package(docs.sparkSession)
    texts = keyed_texts(docs, id_col, text_col).select("text")
    size = _library(path).vocab_size()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                for ids in _library(path).encode(part.column(0).to_pylist(), num_threads=1):
                    total += np.bincount(ids, minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["piece", "n"])

    counts = np.full(size, UNSEEN)
    for r in texts.mapInArrow(count, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n")).collect():
        counts[r["piece"]] += r["n"]
    return np.log(counts / counts.sum())


def encode_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab: str = VOCABULARY,
                  n: int = N_BEST) -> DataFrame:
    """One row per document: doc_id, and ``segmentations``, an array of (score,
    ids) from the best to the n-th best, and ``round_trip``: whether the best
    decodes to the text."""
    return _run(docs, id_col, text_col, vocab, n, False)


def piece_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab: str = VOCABULARY,
                  n: int = N_BEST) -> DataFrame:
    """As ``encode_pieces``, with (score, n_pieces, ids_crc32) in the array."""
    return _run(docs, id_col, text_col, vocab, n, True)


def _run(docs: DataFrame, id_col: str, text_col: str, vocab: str, n: int, digest: bool) -> DataFrame:
    ship_package(docs.sparkSession)
    path = vocabulary(vocab)
    scores = docs.sparkSession.sparkContext.broadcast(fit_scores(docs, id_col, text_col, vocab).tobytes())
    item = ([("score", pa.float64()), ("n_pieces", pa.int64()), ("ids_crc32", pa.int64())] if digest
            else [("score", pa.float64()), ("ids", pa.list_(pa.int32()))])
    schema = pa.schema([("doc_id", pa.int64()), ("segmentations", pa.list_(pa.struct(item))), ("round_trip", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path, scores.value)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                ids, texts = (c.to_pylist() for c in batch.slice(i, 256).columns)
                found = [m.encode(t, n) for t in texts]
                same = [m.decode(np.frombuffer(f[0][1], "<u4").tolist()) == t.replace(SPACE, " ")
                        for f, t in zip(found, texts)]
                rows = [[{"score": s, "n_pieces": len(b) // 4, "ids_crc32": zlib.crc32(b)} if digest
                         else {"score": s, "ids": np.frombuffer(b, "<u4").tolist()} for s, b in f] for f in found]
                yield pa.RecordBatch.from_pydict({"doc_id": ids, "segmentations": rows, "round_trip": same}, schema=schema)

    kind = "score: double, n_pieces: long, ids_crc32: long" if digest else "score: double, ids: array<int>"
    return keyed_texts(docs, id_col, text_col).mapInArrow(
        run, f"doc_id long, segmentations array<struct<{kind}>>, round_trip boolean")
