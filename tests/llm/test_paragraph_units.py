"""Paragraphs cut by numpy against a plain cut, and the recall of the bands."""

import collections
import random
import re

import numpy as np
import pyarrow.parquet as pq

from cadence.llm import paragraphs
from cadence.llm.shingles import LOWER, WORDS, mix, set_key, shingle_sets, word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _cut_between(a, b):
    h = [word_hashes(np.frombuffer(w.encode("utf-8", "surrogatepass").translate(LOWER) + b" ", np.uint8))[1] for w in (a, b)]
    return int(mix(h[0] * paragraphs._PAIR + h[1])[0]) % 16 == 0


def _passages(line):
    words = [(m.start(), m.end(), m[0]) for m in WORD.finditer(line)]
    out, first, ended = [], 0, -1
    for i, (_, _, word) in enumerate(words):
        ends = paragraphs._END.search(word) is not None
        if i + 1 == len(words) or (ends and i - ended >= WORDS):
            cuts = [i]
            if i - first >= paragraphs.LONG:
                cuts = [j for j in range(first + 1, i) if _cut_between(words[j - 1][2], words[j][2])] + cuts
            for j in cuts:
                if j - first >= WORDS - 1:
                    out.append((words[first][0], words[j][1]))
                first = j + 1
        if ends:
            ended = i
    return len(words), out


def _units(text):
    out, at, run, held = [], 0, None, 0
    for number, line in enumerate(text.split("\n")):
        n, parts = _passages(line)
        stop = at + len(line)
        if 0 < n < WORDS:
            run, held = (*(run[:2] if run else (number, at)), stop, False), held + n
        elif n:
            if held >= WORDS:
                out.append(run)
            run, held = None, 0
            out.append((number, at, stop, False))
            if len(parts) > 1 or any(b - a < len(line.strip(paragraphs._SPACES)) for a, b in parts):
                out += [(number, at + a, at + b, True) for a, b in parts]
        at = stop + 1
    return out + ([run] if held >= WORDS else [])


def _group(texts):
    return paragraphs.Units([t.encode("utf-8", "surrogatepass").translate(LOWER) for t in texts])


def test_units_equal_a_plain_cut():
    rnd = random.Random(5)
    words = "the of a. river, 'stone.' (light) moving!) under” »every« second.» été世。 token？ x… “q” wo\U0001F600rd é A B. ”".split()
    for case in range(120):
        texts = ["".join(rnd.choice(words) + rnd.choice([" "] * 12 + ["\n", "\n", "  ", "\t", "\r\n", "\n \n"])
                         for _ in range(rnd.randint(0, 200))) for _ in range(rnd.randint(1, 6))]
        texts += ["", "   ", "\n\n", " ".join(rnd.choice(words) + str(rnd.randint(0, 99)) for _ in range(400))][:case % 5]
        u = _group(texts)
        got = zip(*(x.tolist() for x in (u.text, u.paragraph, u.start, u.stop, u.passage, u.n, u.key_a, u.key_b)))
        want = []
        for k, text in enumerate(texts):
            found = _units(text)
            want += [(k, *unit, len(s), *set_key(s)) for unit, s in zip(found, shingle_sets([text[a:b] for _, a, b, _ in found]))]
        assert sorted(got) == sorted(want)


def test_recall_of_the_bands_by_size():
    """Of all pairs of different sets at 0.8, nearly all share a bucket, whatever the size."""
    texts = [t or "" for t in pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()]
    rnd = random.Random(1)
    for n in list(range(8, 100)) * 6:  # edited copies of every size
        base = [f"{n}w{rnd.randint(0, 10 ** 6)}" for _ in range(n)]
        other = list(base)
        other[rnd.randrange(n) if n > 25 else 0] = "changed"
        texts += [" ".join(base), " ".join(other)]
    u = _group(texts)
    one = {}
    for i, key in enumerate(zip(u.key_a.tolist(), u.key_b.tolist())):
        one.setdefault(key, i)
    chosen = np.array(sorted(one.values()))
    sets = [set(u.rolled[u.w0[i]:u.w1[i] - WORDS + 1].tolist()) for i in chosen]
    buckets = [set(row) for row in u.bands(chosen, paragraphs.tune_bands(), paragraphs.ROWS).tolist()]
    holders, common = collections.defaultdict(list), collections.Counter()
    for i, s in enumerate(sets):
        for x in s:
            common.update((j, i) for j in holders[x])
            holders[x].append(i)
    found, every = collections.Counter(), collections.Counter()
    for (i, j), both in common.items():
        if both * 100 >= (len(sets[i]) + len(sets[j]) - both) * paragraphs.PERCENT:
            size = min(3, len(sets[j]) // 20)
            every[size] += 1
            found[size] += bool(buckets[i] & buckets[j])
    assert len(every) == 4 and min(every.values()) > 20
    assert all(found[size] >= 0.95 * every[size] for size in every), (found, every)
