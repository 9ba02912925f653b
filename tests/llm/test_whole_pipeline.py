"""``corpus_pipeline.run`` against plain Python stages, and the queries' digest
columns against brute force."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from cadence.llm import near_dedup, packing, paragraphs, queries, secret_scan, tokens, toxicity
from cadence.llm.linking import band_components

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def rows():
    return [(r["doc_id"], r["text"] or "") for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()]


def _shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def _components(rows, percent):
    sets = [_shingles(t) for _, t in rows]
    holders = collections.defaultdict(list)
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, s in enumerate(sets):
        common = collections.Counter(j for x in s for j in holders[x])
        for j, both in common.items():
            if both * 100 >= (len(s) + len(sets[j]) - both) * percent:
                label[root(i)] = root(j)
        for x in s:
            holders[x].append(i)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return [least[root(i)] for i in range(len(rows))], [len(s) for s in sets]


def _redacted(text):
    spans = []
    for rule in secret_scan.RULES:
        for m in re.finditer(rule.pattern, text):
            if len(m[rule.group]) >= rule.least:
                spans.append(m.span())
    out, at = "", 0
    for start, stop in sorted(spans):
        out += text[at:start] + "[SECRET]" if start >= at else ""
        at = max(at, stop)
    return out + text[at:]


def _packed_documents(found):
    """doc_id -> tokens, after checking that pieces and sequences have no gap."""
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in found:
        by_doc[r.doc_id].append((r.start, r.length, r.doc_tokens))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for pieces in by_doc.values():
        at = 0
        for start, length, total in sorted(pieces):
            assert start == at and total == pieces[0][2]
            at += length
        assert at == pieces[0][2]
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096
    return {d: p[0][2] for d, p in by_doc.items()}


def test_run_equals_plain_stages(spark, rows):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = model.scores([t for _, t in rows])
    left = [r for r, s in zip(rows, scores) if s < toxicity.THRESHOLD]
    assert 0 < len(left) < len(rows)
    groups = collections.defaultdict(list)
    for i, t in left:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t)].append((-len(t), i, t))
    left = sorted((i, t) for _, i, t in map(min, groups.values()))
    names, _ = _components(left, corpus_pipeline.NEAR_PERCENT)
    left = [(i, _redacted(t)) for (i, t), name in zip(left, names) if i == name]
    encode = Tokenizer.from_file(tokens.vocabulary(packing.VOCABULARY)).encode
    want = {i: np.array(encode(t, add_special_tokens=False).ids + [2], "<u4") for i, t in left}
    found = corpus_pipeline.run(spark, SF).collect()
    assert _packed_documents(found) == {i: len(ids) for i, ids in want.items()}
    for r in found:
        assert r.ids_crc32 == zlib.crc32(want[r.doc_id][r.start:r.start + r.length].tobytes())


def test_stages_on_an_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, SF)
        assert out.count() == 0 and (name == "packing" or out.columns == empty.columns)
    assert near_dedup.drop_near_duplicates(empty).count() == 0
    assert paragraphs.drop_paragraphs(empty).count() == 0
    assert secret_scan.redact(empty).count() == 0
    items = spark.createDataFrame([], "vid long, n int, bands array<long>")
    assert band_components(items, lambda vids: spark.createDataFrame([], "vid long, items array<long>"), 80).count() == 0


def test_op1_scores_recounted(spark, rows):
    """The query's columns, and the log-count ratios of the model from plain counts."""
    found = {r.doc_id: r for r in queries.op1_toxicity(spark, SF).collect()}
    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    assert set(found) == {i for i, _ in rows}
    for i, r in found.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    train = {r.doc_id: r.toxic for r in toxicity.training_rows(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    assert train == {i: t for i, t in labels.items() if zlib.crc32(str(i).encode()) % 4 != 2 and i in dict(rows)}
    weights = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet")).weights
    counts = np.zeros((2, 1 << toxicity.HASH_BITS))
    for i, t in train.items():
        ((_, _, feature),) = list(toxicity.text_features([dict(rows)[i]]))
        counts[int(t > 0), feature] += 1
    totals = [sum(t == k for t in train.values()) for k in (0, 1)]
    ratio = np.log((counts[1] + 1) / (totals[1] + 2)) - np.log((counts[0] + 1) / (totals[0] + 2))
    chosen = (counts.sum(0) >= toxicity.MIN_ROWS) & (np.abs(ratio) >= toxicity.MIN_RATIO)
    assert not weights[~chosen].any() and np.count_nonzero(weights[chosen]) > 0.99 * chosen.sum()


def test_op2_digests(spark, rows):
    texts = {i: t.encode() for i, t in rows}
    seen = collections.Counter(t[k:k + 400] for t in texts.values() for k in range(len(t) - 399))
    for r in queries.op2_suffix_dedup(spark, SF).collect():
        t = texts[r.doc_id]
        gone = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - 399):
            if seen[t[k:k + 400]] > 1:
                gone[k:k + 400] = True
        runs = np.count_nonzero(gone[:-1] & ~np.append(False, gone[:-2])) if len(t) else 0
        kept = bytes(b for b, g in zip(t, gone) if not g)
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(t), int(gone.sum()), runs)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()
        assert r.removed_share == (r.n_removed / r.n_bytes if r.n_bytes else 0.0)


def test_op8_and_op10_queries(spark, rows):
    names, sizes = _components(rows, 85)
    assert {tuple(r) for r in queries.op8_circulant_minhash(spark, SF).collect()} == {
        (i, n, c, i == c) for (i, _), n, c in zip(rows, sizes, names)}
    encode = Tokenizer.from_file(tokens.vocabulary(packing.VOCABULARY)).encode
    want = {i: np.array(encode(t, add_special_tokens=False).ids + [2], "<u4") for i, t in rows}
    found = queries.op10_packing(spark, SF).collect()
    assert _packed_documents(found) == {i: len(ids) for i, ids in want.items()}
    assert all(r.ids_crc32 == zlib.crc32(want[r.doc_id][r.start:r.start + r.length].tobytes()) for r in found)
