"""Secret scans with a trigram inverted index, in DataFrame functions only
(operator 3).

1. ``trigram_query`` derives from a rule's regex a Boolean query over trigrams
   that every match must satisfy, as an OR of ANDs. A rule without a mandatory
   trigram gets no query and scans every text.
2. ``postings`` is the inverted index (trigram, doc_id), restricted to the
   trigrams the queries name; texts are lower-cased for it, so it serves rules
   of either case. It is written to the shared folder as a table.
3. ``candidates`` intersects the postings: the trigrams of a document are
   OR-ed into a bit mask by one aggregation on doc_id, and a rule's candidates
   are the documents whose mask satisfies its query. A common trigram is a
   long posting list, but never one task's work.
4. ``scan`` joins the masks back and runs a rule's regex only on its candidates
   (rules without a query: on all texts), so the index saves work and never
   decides a result.

Spans are in code points, end exclusive. ``split`` at the matches of a regex
gives the text between them, so running sums of lengths are the positions.

Defined cases: a NULL text counts as empty and has no span; NULL doc_ids are
matched with each other in the index join; repeated rows are scanned once each
and rows sharing a doc_id share a candidate mask (a superset, verified per
row); an empty table gives an empty result; other columns pass through ``scan``
and ``redact``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import fresh, scratch_table, whole_text


@dataclass(frozen=True)
class Rule:
    """``pattern`` is valid for Java and Python alike. Matches are leftmost and
    do not overlap; those whose ``group`` is shorter than ``least`` are dropped
    after matching."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The base rules come first; spans are ordered by start, then by this order.
RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("forge_token", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("bearer", r"(?i:bearer)\x20+[A-Za-z0-9._~+/-]{20,}"),
)
BASE = ("assign", "access", "hex")

MOST_STRINGS = 64
Query = tuple[frozenset[str], ...]


def trigram_query(pattern: str) -> Query | None:
    """The regex's mandatory trigrams as an OR of ANDs, lower-cased; None when
    there are none. The parsed pattern is walked from left to right with the
    set of exact strings read so far; where an item is not a small set of exact
    strings, that set's trigrams are noted and a new one begins."""
    from re import _parser as parser  # the regex library's own parse tree

    def exact(items) -> set[str] | None:
        """All strings the items can match, or None when there are too many."""
        out = {""}
        for op, arg in items:
            name = str(op)
            if name == "LITERAL":
                options = {chr(arg)}
            elif name == "IN" and all(str(o) == "LITERAL" for o, _ in arg):
                options = {chr(a) for _, a in arg}
            elif name == "SUBPATTERN":
                options = exact(arg[3])
            elif name == "BRANCH":
                parts = [exact(b) for b in arg[1]]
                options = None if None in parts else set().union(*parts)
            elif name in ("MAX_REPEAT", "MIN_REPEAT") and arg[1] == 1:
                once = exact(arg[2])
                options = None if once is None else once | ({""} if arg[0] == 0 else set())
            else:
                options = None
            if options is None or len(out) * len(options) > MOST_STRINGS:
                return None
            out = {(a + b).lower() for a, b in product(out, options)}
        return out

    def trigrams(strings: set[str]) -> Query | None:
        """None when some string has no trigram: nothing is mandatory then."""
        terms = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings}
        if frozenset() in terms:
            return None
        return tuple(sorted((t for t in terms if not any(u < t for u in terms)), key=sorted))

    found: list[Query] = []
    now = {""}

    def note():
        nonlocal now
        if (q := trigrams(now)) is not None:
            found.append(q)
        now = {""}

    def walk(items):
        nonlocal now
        for item in items:
            op, arg = str(item[0]), item[1]
            options = exact([item])
            if options is not None and len(now) * len(options) <= MOST_STRINGS:
                now = {a + b for a, b in product(now, options)}
                continue
            note()
            if op == "SUBPATTERN":
                walk(arg[3])
            elif op in ("MAX_REPEAT", "MIN_REPEAT") and arg[0] >= 1 and arg[1] > 1:
                walk(arg[2])
                note()
            elif options is not None:
                now = set(options)

    walk(parser.parse(pattern))
    note()
    # AND of the parts, kept as an OR of ANDs: the part with the fewest terms
    # is multiplied by the next while the result stays small.
    best: Query | None = None
    for q in sorted(found, key=len):
        joined = q if best is None else tuple({a | b for a, b in product(best, q)})
        if best is None or len(joined) <= MOST_STRINGS:
            best = joined
    return None if best is None else tuple(sorted(best, key=sorted))


def vocabulary(rules: tuple[Rule, ...]) -> list[str]:
    """The trigrams any rule's query names, sorted; the bits of the masks."""
    queries = [q for r in rules if (q := trigram_query(r.pattern)) is not None]
    return sorted({g for q in queries for term in q for g in term})


def postings(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The inverted index (trigram, doc_id), one row per pair and input row."""
    text, gram = F.lower(whole_text(text_col)), [F.lit(g) for g in vocabulary(rules)]
    if not gram:
        return docs.select(F.lit("").alias("trigram"), F.col(f"`{id_col}`").alias("doc_id")).limit(0)
    low = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("low"))
    return low.select(F.explode(F.array_compact(F.array(*(
        F.when(F.contains("low", g), g) for g in gram)))).alias("trigram"), "doc_id")


def _all_of(mask: list[Column], bits: int) -> Column:
    """Whether every bit of ``bits`` is set in the mask's 63-bit words."""
    tests = []
    for w, word in enumerate(mask):
        part = bits >> (63 * w) & ((1 << 63) - 1)
        if part:
            tests.append(word.bitwiseAND(F.lit(part).cast("bigint")) == F.lit(part).cast("bigint"))
    return reduce(lambda a, b: a & b, tests)


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, rules): the numbers of the rules whose query a document meets.
    Documents that meet none are left out."""
    grams = vocabulary(rules)
    if not grams:
        return index.select("doc_id", F.array().cast("array<int>").alias("rules")).limit(0)
    bit = {g: i for i, g in enumerate(grams)}
    number = F.element_at(F.create_map(*(F.lit(x) for g in grams for x in (g, bit[g]))), F.col("trigram"))
    words = -(-len(grams) // 63)
    masks = index.withColumn("bit", number).groupBy("doc_id").agg(*(
        F.bit_or(F.when(F.floor(F.col("bit") / 63) == w, F.expr("shiftleft(1L, bit % 63)"))
                 .otherwise(F.lit(0).cast("bigint"))).alias(f"w{w}") for w in range(words)))
    mask = [F.col(f"w{w}") for w in range(words)]
    met = []
    for number, rule in enumerate(rules):
        query = trigram_query(rule.pattern)
        if query is not None:
            test = reduce(lambda a, b: a | b, (_all_of(mask, sum(1 << bit[g] for g in term)) for term in query))
            met.append(F.when(test, F.lit(number)))
    return masks.select("doc_id", F.array_compact(F.array(*met)).alias("rules")).where(F.size("rules") > 0)


def _spans(text: Column, number: int, rule: Rule) -> Column:
    """Array of (start, rule, stop) of the rule's matches in ``text``."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    between = F.split(text, rule.pattern, -1)
    kept = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    lengths = F.arrays_zip(
        F.transform(whole, F.length).alias("own"),
        F.transform(between, F.length).alias("gap"), F.transform(kept, F.length).alias("kept"))
    empty = F.array().cast("array<struct<start:int,rule:int,stop:int>>")
    state = F.struct(F.lit(0).alias("at"), empty.alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        stop = start + F.coalesce(x["own"], F.lit(0))
        span = F.struct(start.alias("start"), F.lit(number).alias("rule"), stop.alias("stop"))
        passed = x["own"].isNotNull() & (x["kept"] >= rule.least)
        return F.struct(stop.alias("at"), F.when(passed, F.concat(acc["spans"], F.array(span)))
                        .otherwise(acc["spans"]).alias("spans"))

    return F.when(F.size(whole) > 0, F.aggregate(lengths, state, step)["spans"]).otherwise(empty)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text",
         name: str = "spans") -> DataFrame:
    """``docs`` and an array column ``name`` of (start, rule, stop): the spans
    of all rules by start, then rule number."""
    met = candidates(scratch_table(postings(docs, rules, id_col, text_col), "postings"), rules)
    key, numbers = fresh(docs, "met_id", "met_rules")
    met = met.select(F.col("doc_id").alias(key), F.col("rules").alias(numbers))
    joined = docs.join(met, F.col(f"`{id_col}`").eqNullSafe(F.col(key)), "left")
    text = whole_text(text_col)
    empty = F.array().cast("array<struct<start:int,rule:int,stop:int>>")
    found = []
    for number, rule in enumerate(rules):
        spans = _spans(text, number, rule)
        if trigram_query(rule.pattern) is not None:
            spans = F.when(F.array_contains(numbers, F.lit(number)), spans).otherwise(empty)
        found.append(spans)
    return joined.withColumn(name, F.array_sort(F.concat(*found))).drop(key, numbers)


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text",
           mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of every rule (overlapping spans as one)
    replaced by ``mark`` in the text; texts without a span stay as they are,
    NULL included."""
    (spans,) = fresh(docs, "secret_spans")
    scanned = scan(docs, rules, id_col, text_col, spans)
    text = whole_text(text_col)
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, x["start"] - acc["at"])
        return F.struct(
            F.greatest(acc["at"], x["stop"]).alias("at"),
            F.when(x["start"] < acc["at"], acc["out"])
            .otherwise(F.concat(acc["out"], gap, F.lit(mark))).alias("out"))

    done = F.aggregate(F.col(spans), state, step)
    clean = F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))
    return scanned.withColumn(
        text_col, F.when(F.size(spans) > 0, clean).otherwise(F.col(f"`{text_col}`"))).select(
        *(f"`{c}`" for c in docs.columns))


def span_list(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """kind:start:stop, comma-joined."""
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["rule"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")
