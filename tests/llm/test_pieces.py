"""Piece segmentation: N best against an enumeration of its own, agreement with the
library, chunks against whole texts."""

import heapq

import numpy as np
import pytest

from cadence.llm import pieces, tokens

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def path():
    return tokens.vocabulary(pieces.VOCABULARY)


@pytest.fixture(scope="module")
def scores(spark):
    return pieces.fit_scores(spark.read.parquet(f"{SF}/documents.parquet"))


def test_scores_count_every_document(spark, path):
    import sentencepiece
    texts = [f"word {i} of {i % 7} rows" for i in range(6000)]
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    counts = np.full(library.vocab_size(), pieces.UNSEEN)
    for ids in library.encode(texts):
        counts += np.bincount(ids, minlength=len(counts))
    got = pieces.fit_scores(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert np.allclose(got, np.log(counts / counts.sum()), rtol=0, atol=1e-9)


def _every(text, model, library, scores):
    """(score, ids) of all segmentations of the normalised text."""
    full = "▁" + text.replace(" ", "▁")
    vocabulary = {library.id_to_piece(i): i for i in range(library.vocab_size())
                  if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i))}

    def go(at):
        if at == len(full):
            yield 0.0, ()
            return
        steps = [(vocabulary[full[at:stop]], stop) for stop in range(at + 1, len(full) + 1) if full[at:stop] in vocabulary]
        found = [(scores[i], (i,), stop) for i, stop in steps]
        if full[at] not in vocabulary:
            raw = full[at].encode()
            found.append((model.fallback * len(raw), tuple(model.byte_ids[b] for b in raw), at + 1))
        for score, ids, stop in found:
            for rest, more in go(stop):
                yield score + rest, ids + more

    return list(go(0))


def test_n_best_equals_an_enumeration(path, scores):
    model, library = pieces.model(path, scores.tobytes()), pieces._library(path)
    for text in ("the cat sat", "a b c", "xé世z q", "  two  ", "a\nb", "it's (ok).", "x1.2,y", "—‘q’"):
        found = model.encode(text, 6)
        want = heapq.nlargest(6, _every(text, model, library, scores))
        assert [s for s, _ in found] == pytest.approx([s for s, _ in want], abs=1e-9)
        every = {ids: s for s, ids in _every(text, model, library, scores)}
        for s, packed in found:
            assert every[tuple(np.frombuffer(packed, "<u4").tolist())] == pytest.approx(s, abs=1e-9)
        assert len({packed for _, packed in found}) == len(found)


def test_chunks_are_cut_where_no_piece_reaches(path, scores):
    model = pieces.model(path, scores.tobytes())
    assert np.exp(scores).sum() == pytest.approx(1.0)
    for text in ("a, b.c  d1é²x_y\n\n zß世界...", "▁▁", "", " ", "x" * 300):
        full = "▁" + text.replace(" ", "▁")
        assert "".join(model.chunks.findall(full)) == full


def test_agreement_with_the_library(spark, path, scores):
    model, library = pieces.model(path, scores.tobytes()), pieces._library(path)
    words = same = mine = theirs = 0
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect():
        got, want = np.frombuffer(model.encode(r.text or "", 1)[0][1], "<u4").tolist(), library.encode(r.text or "")
        mine, theirs = mine + len(got), theirs + len(want)
        split = []
        for ids in (got, want):
            parts = [[]]
            for i in ids:
                if model.raw[i].startswith(pieces.SPACE.encode()):
                    parts.append([])
                parts[-1].append(i)
            split.append(parts)
        assert len(split[0]) == len(split[1])
        words += len(split[1])
        same += sum(a == b for a, b in zip(*split))
    assert same / words > 0.8 and abs(mine / theirs - 1) < 0.02
