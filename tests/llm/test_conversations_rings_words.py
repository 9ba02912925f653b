"""Brute-force checks of conversation repair, ring sharding and spelling variants."""

import collections
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from cadence.llm import conversation_repair, queries, ring_sharding, role_grammar, spelling

SF = "/root/testdata/sf0.001"
SPACE = r"[\x20\x09-\x0D]"
TURNS = "conv_id long, turn long, role string, text string, part string, audit long"
DOCS = "doc_id long, text string, at string, arc long, word string"


# --- conversations ---------------------------------------------------------

def _cheapest(tokens):
    """Least (cost, audit) by a table over the roles' finite automaton."""
    step = {("0", "s"): "S", ("0", "u"): "U", ("S", "u"): "U", ("U", "a"): "P", ("P", "u"): "U"}

    def put(level, state, found):
        if state not in level or found < level[state]:
            level[state] = found
            return True
        return False

    def inserted(level):
        while any([put(level, step[q, s], (c + 2, a + "I"))
                   for q, (c, a) in list(level.items()) for s in "ua" if (q, s) in step]):
            pass
        return level

    level = {"0": (0, "")}
    for initial, must_go, cut in tokens:
        after = {}
        for q, (c, a) in inserted(level).items():
            put(after, q, (c + 3, a + "D"))
            for s, cost, letter in () if must_go else ((initial, 0, "K"), ("u", 2, "R"), ("a", 2, "R")):
                if (q, s) in step:
                    put(after, step[q, s], (c + cost + cut, a + letter))
        level = after
    return min(found for q, found in inserted(level).items() if q in "0P")


def _repaired(rows, harm=True):
    """conv_id -> the contract's columns, and the repaired turns."""
    groups = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv]
        role, text = " " if role is None else role, " " if text is None else text
        pick = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if harm else 9
        text = "" if pick == 1 else re.sub("[.!?]", "", text) if pick == 2 else text
        groups[conv] += [(turn, "user" if pick == 4 else role, text)] * (0 if pick == 0 else 2 if pick == 3 else 1)
    out, turns = {}, {}
    for conv, group in groups.items():
        group.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        known = [r[0] for r in group if r[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        seen, counts, tokens = set(), collections.Counter(), []
        for _, role, text in group:
            letters = re.sub(SPACE, "", text)
            fault = "blank" if not letters else "duplicate" if (role, text) in seen else \
                "truncated" if letters[-1] not in ".!?" else ""
            seen.add((role, text))
            counts[fault] += 1
            tokens.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(group, group[1:]))
        cost, audit = _cheapest(tokens)
        lines, left = [], iter(group)
        for edit in audit:
            row = next(left) if edit != "I" else (None, None, "")
            role = "assistant" if lines and lines[-1][0][0] == "u" else "user"
            if edit != "D":
                lines.append((row[1] if edit == "K" else role, row[2]))
        joined = "\n".join(f"{r}:{t}" for r, t in lines)
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit,
                     hashlib.sha256(joined.encode()).hexdigest())
        turns[conv] = lines
    return out, turns


def _random_turns(n, convs, turns):
    rnd = random.Random(n)
    texts = ["ok.", "ok", "", " \n", None, "what?", "go! ", "é世.", "x" * 400 + ".", "no end "]
    roles = ["user", "assistant"] * 3 + ["system", None, "", "tool"]
    return [(rnd.choice([None, *range(convs)]), rnd.choice([None, *range(-2, turns)]), rnd.choice(roles),
             rnd.choice(texts) if rnd.random() < .5 else f"{rnd.randint(0, 99)}.", "x", 1) for _ in range(n)]


@pytest.mark.parametrize("case", ["short", "cut", "copies", "empty"])
def test_conversation_repair(spark, monkeypatch, case):
    if case == "cut":
        monkeypatch.setattr(conversation_repair, "PART_ROWS", 16)
    rows = {"short": lambda: _random_turns(1500, 60, 9), "cut": lambda: _random_turns(1500, 3, 300), "empty": list,
            "copies": lambda: [(1, 1, "user", "same.", "x", 1)] * 3000 + [(1, 2, "assistant", "y", "x", 1)] * 3}[case]()
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    decisions, turns = conversation_repair.repair(conversation_repair.damage(df), keep_turns=True)
    got = {r[0]: tuple(r)[1:] for r in conversation_repair.with_missing(df, decisions).collect()}
    want, lines = _repaired([r[:4] for r in rows])
    assert got == want
    found = collections.defaultdict(list)
    for r in sorted(turns.collect(), key=lambda r: (r.part, r.place)):
        found[r.conv_id].append((r.role, r.text))
    assert dict(found) == {c: t for c, t in lines.items() if t}


def test_conversation_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    result = queries.op11_conversation_repair(spark, SF)
    assert result.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                              "repaired_sha256"]
    assert {r[0]: tuple(r)[1:] for r in result.collect()} == _repaired(rows)[0]


def test_edits_against_all_sequences():
    """The parser against every edit sequence of short conversations."""
    rnd = random.Random(2)

    def every(rows, inserts):
        if inserts:
            for symbol in "ua":
                for out, cost, audit in every(rows, inserts - 1):
                    yield symbol + out, cost + 2, "I" + audit
        if not rows:
            yield "", 0, ""
            return
        (initial, must_go, cut), rest = rows[0], rows[1:]
        for out, cost, audit in every(rest, inserts):
            yield out, cost + 3, "D" + audit
            if not must_go:
                yield (initial or "?") + out, cost + cut, "K" + audit
                for symbol in "ua":
                    yield symbol + out, cost + 2 + cut, "R" + audit

    for _ in range(60):
        rows = [(rnd.choice(["s", "u", "a", ""]), rnd.random() < .2, rnd.random() < .2) for _ in range(rnd.randint(0, 4))]
        want = min((c, a) for out, c, a in every(rows, 3) if re.fullmatch("(s?(ua)+)?", out))
        level = role_grammar.transfer({role_grammar.PARSER.start: (0, "")}, rows)
        assert role_grammar.cheapest(level) == want
        cut = rnd.randint(0, len(rows))
        head = role_grammar.transfer({role_grammar.PARSER.start: (0, "")}, rows[:cut])
        tail = {top: role_grammar.transfer({top: (0, "")}, rows[cut:]) for top in role_grammar.PARSER.tops}
        assert role_grammar.cheapest(role_grammar.compose(head, tail)) == want


# --- ring ------------------------------------------------------------------

def _settled(arcs, ring, rows, room):
    """Row-by-row bounded loads: hop by hop, arcs in order, rows in order."""
    nodes = [shard for _, shard in sorted(ring)]
    left = collections.defaultdict(list)
    for row in rows:
        left[arcs[row]].append(row)
    ways = {arc: list(dict.fromkeys(nodes[arc:] + nodes[:arc])) for arc in left}
    held = collections.defaultdict(list)
    for hop in range(len(room)):
        for arc in sorted(left):
            shard = ways[arc][hop]
            while left[arc] and len(held[shard]) < room[shard]:
                held[shard].append(left[arc].pop(0))
    return {row: (shard, slot) for shard, own in held.items() for slot, row in enumerate(own)}


@pytest.mark.parametrize("slack", [0.0, 0.2])
def test_ring_against_rows(spark, slack):
    df = spark.createDataFrame([(i, "é" * (i % 7) if i % 5 else None, "x", 1, "y") for i in range(997)], DOCS).repartition(4)
    ring = [(r.at, r.shard) for r in ring_sharding._ring(spark, 16, 64).collect()]
    at = {r.doc_id: r.at for r in df.select("doc_id", F.xxhash64("doc_id").alias("at")).collect()}
    arcs = {d: sum(a < p for a, _ in ring) for d, p in at.items()}
    room = [-(-997 * 6 // 80)] * 16 if slack else [997 // 16 + (s < 997 % 16) for s in range(16)]
    want = _settled(arcs, ring, sorted(at, key=at.get), room)
    got = ring_sharding.assign(df, slack=slack).collect()
    assert {r.doc_id: (r.shard, r.slot) for r in got} == want and len(got) == 997
    assert {r.doc_id: (r.size, r.text_crc32) for r in got} == {
        i: (2 * (i % 7) + 1 if i % 5 else 1, zlib.crc32(("é" * (i % 7) if i % 5 else "").encode())) for i in range(997)}


def test_ring_balance_and_movement(spark):
    hot = spark.range(6001).select(F.when(F.col("id") % 3 != 0, F.col("id")).alias("doc_id"), F.lit("t").alias("text"))
    got = ring_sharding.assign(hot).collect()
    held = collections.defaultdict(list)
    for r in got:
        held[r.shard].append(r.slot)
    assert sorted(map(len, held.values())) == [375] * 15 + [376]
    assert all(sorted(slots) == list(range(len(slots))) for slots in held.values())
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("").alias("text"))
    for slack, most in ((0.0, 0.2), (0.25, 0.1)):
        before, after = ({r.doc_id: r.shard for r in ring_sharding.assign(docs, n, slack=slack).collect()} for n in (16, 17))
        assert sum(before[d] != after[d] for d in before) < most * len(before)
    assert ring_sharding.assign(docs.limit(0)).count() == 0


def test_ring_query_is_native(spark, capsys):
    result = queries.op12_ring_sharding(spark, SF)
    rows = result.collect()
    counts = collections.Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1 and set(counts) == set(range(16))
    assert {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}
    result.explain("formatted")
    assert not re.search("Python|Arrow|Pandas", capsys.readouterr().out)


# --- spelling --------------------------------------------------------------

def _is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def _variants(rows):
    n = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            n[run if h % 199 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    near, form = {w: [v for v in n if _is_near(w, v)] for w in n}, {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 5 * n[w]:
            form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return out


def _word_rows():
    rnd = random.Random(5)
    base = ["".join(rnd.choice("abcdeé÷ÀÿÜ") for _ in range(rnd.randint(5, 9))) for _ in range(60)]
    rows = []
    for i in range(400):
        words = []
        for w in rnd.choices(base, [3 ** (k % 6) for k in range(60)], k=60):
            at, kind = rnd.randrange(len(w)), rnd.random()
            words.append(w[:at] + w[at + 1:] if kind < .05 else w[:at] + "z" + w[at:] if kind < .1 else
                         w[:at] + "Q" + w[at + 1:] if kind < .15 else w)
        rows.append((i, rnd.choice([" ", "-", "1", "\n"]).join(words)))
    chain = [("abcdefgh", 1000), ("abcdefg", 150), ("abcdef", 20), ("abcdefx", 5), ("abcdxf", 5), ("abcxef", 5)]
    rows += [(1000 + k, " ".join([w] * c)) for k, (w, c) in enumerate(chain)]
    return rows + [(2000, None), (2001, ""), (2002, "a" * 3000 + " " + "é" * 20), (2003, "abcdefgh " * 200000)]


def test_spelling_variants(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 16)
    rows = _word_rows()
    df = spark.createDataFrame([(i, t, "x", 1, "w") for i, t in rows], DOCS).repartition(4)
    got = spelling.variants(df).collect()
    assert len(got) == len({r.word for r in got}) and {tuple(r) for r in got} == _variants(rows)
    assert any(r.form and r.form != r.root for r in got)
    assert spelling.variants(df.limit(0)).count() == 0


def test_spelling_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    result = queries.op13_spelling_variants(spark, SF)
    assert result.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in result.collect()} == _variants(rows)


def test_runs_of_long_texts():
    rnd = random.Random(1)
    text = "".join(rnd.choice("abcÉé×Z 1\n") for _ in range(100_000))
    want = collections.Counter(re.findall("[a-zÀ-ÿ]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)))
    kept, spelling._SLICE = spelling._SLICE, 997
    try:
        assert spelling._runs(text) == want
    finally:
        spelling._SLICE = kept
