"""Repair of conversation structure: faults of rows, and the cheapest edits that
give roles the grammar of ``role_grammar`` accepts.

Rows are range-partitioned and sorted by conversation and turn (NULL turns
first; rows of one turn by role, then by the SHA-256 of the text), so a
conversation of any length spreads over tasks. A task repairs the conversations
that it holds whole, streaming. A conversation that crosses a task border, or is
longer than a part may be, is left as parts: repeated rows are found by an
aggregation on (conversation, role, text hash), each part's effect on the parser
is computed on its own, the effects are composed in order, and the edits go back
to the parts. Only the SHA-256 of a conversation's whole repaired text, which is
sequential by definition, reads the parts' texts one after the other, as a
stream.

Input: columns conv_id, turn, role, text; others are ignored. A NULL role or text
is one space; NULL conv_ids are one conversation. A row whose role is empty, or
whose first character is none of s, u, a, can be deleted or given another role,
not kept. Equal rows of one turn are interchangeable. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cadence.llm.common import scratch_table, ship_package
from cadence.llm.role_grammar import PARSER, apply_edits, cheapest, compose, transfer

PART_ROWS = 2048
PART_BYTES = 1 << 22
_BATCH = 512
_LEGAL = {"su", "ua", "au"}

_COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long"
_EDGES = ("first_turn long, last_turn long, n_turns long, blank long, duplicate long, truncated long, "
          "illegal long, first_initial string, last_initial string")


def damage(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) after the contract's damage: NULL reads
    as one space, crc32 of ``conv_id:turn`` modulo 20 picks what happens."""
    spaced = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    pick = F.pmod(F.crc32(F.concat(spaced[0], F.lit(":"), spaced[1])), F.lit(20))
    text = F.coalesce(F.col("text"), F.lit(" "))
    return conversations.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), pick.alias("_pick"),
        F.when(pick == 4, F.lit("user")).otherwise(F.coalesce(F.col("role"), F.lit(" "))).alias("role"),
        F.when(pick == 1, F.lit("")).when(pick == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(pick == 0, F.array().cast("array<int>")).when(pick == 3, F.array(F.lit(0), F.lit(1)))
                  .otherwise(F.array(F.lit(0)))).alias("_copy")).drop("_pick", "_copy")


def _ordered(conversations: DataFrame) -> DataFrame:
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    rows = conversations.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text")).select(
        "*", F.unhex(F.sha2("text", 256)).alias("key"), (last == "").alias("is_blank"),
        (~last.isin(".", "!", "?")).alias("cut_short"), F.monotonically_increasing_id().alias("spread"))
    order = ["conv_id", "turn", "role", "key"]
    return rows.repartitionByRange(*order, "spread").sortWithinPartitions(*order).drop("spread")


def _initial(role: str) -> str:
    return role[:1] if role[:1] in ("s", "u", "a") else ""


def _sha(lines: list[tuple[str, str]]) -> str:
    return hashlib.sha256(_joined(lines)).hexdigest()


def _joined(lines: list[tuple[str, str]]) -> bytes:
    return "\n".join(f"{role}:{text}" for role, text in lines).encode("utf-8", "surrogatepass")


def _summary(rows: list[tuple], first: list[bool]) -> tuple[dict, list[tuple[str, bool, bool]]]:
    """Counts of sorted ``rows`` (turn, role, blank, cut short) and the tokens of
    the parser; ``first`` tells whether no earlier row has the role and text."""
    turns = [r[0] for r in rows if r[0] is not None]
    tokens, counts = [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for (_, role, is_blank, cut_short), new in zip(rows, first):
        fault = "blank" if is_blank else "duplicate" if not new else "truncated" if cut_short else None
        if fault:
            counts[fault] += 1
        tokens.append((_initial(role), fault in ("blank", "duplicate"), fault == "truncated"))
    initials = [r[1][:1] for r in rows]
    return {
        "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None,
        "n_turns": len(set(turns)), **counts, "illegal": sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:])),
        "first_initial": initials[0], "last_initial": initials[-1]}, tokens


def _gaps(edges: dict) -> int:
    return 0 if edges["first_turn"] is None else edges["last_turn"] - edges["first_turn"] + 1 - edges["n_turns"]


def _record(names: list[str], rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], schema.field(n).type) for n in names],
                                      schema=schema)


def _batched(rows: Iterator[dict], schema: pa.Schema, weight=lambda r: 0) -> Iterator[pa.RecordBatch]:
    """Batches of a bounded number of rows and bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weight(row)
        if len(held) >= _BATCH or size >= PART_BYTES:
            yield _record(schema.names, held, schema)
            held, size = [], 0
    if held:
        yield _record(schema.names, held, schema)


def _arrow(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(StructType.fromDDL(ddl))


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, _BATCH):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, _BATCH).columns))


def _parts_ddl(conv_type: str) -> str:
    return (f"conv_id {conv_type}, part long, whole boolean, {_COUNTS}, cost long, audit string, repaired_sha256 string, "
            "rows array<struct<turn:long,role:string,key:binary,is_blank:boolean,cut_short:boolean>>, texts array<string>")


def _cut_parts(keep_texts: bool, ddl: str):
    """Sorted rows to whole conversations, repaired, and parts of others."""
    schema = _arrow(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number = TaskContext.get().partitionId() << 33, 0

        def part(conv, rows, texts, whole):
            nonlocal number
            out = {"conv_id": conv, "part": base | number, "whole": whole, "size": sum(map(len, texts))}
            number += 1
            if not whole:
                keys = [{"turn": t, "role": r, "key": k, "is_blank": b, "cut_short": c} for t, r, k, b, c in rows]
                return out | {"rows": keys, "texts": texts}
            seen, first = set(), []
            for _, role, key, _, _ in rows:
                first.append((role, key) not in seen)
                seen.add((role, key))
            edges, tokens = _summary([(r[0], r[1], r[3], r[4]) for r in rows], first)
            cost, audit = cheapest(transfer({PARSER.start: (0, "")}, tokens))
            lines, _ = apply_edits([(r[1], t) for r, t in zip(rows, texts)], audit, PARSER.start)
            out |= edges | {"gaps": _gaps(edges), "cost": cost, "audit": audit, "repaired_sha256": _sha(lines)}
            if keep_texts:
                out |= {"rows": [{"role": r} for r, _ in lines], "texts": [t for _, t in lines]}
            return out

        def parts():
            rows, texts, size, now, cut = [], [], 0, None, True
            started = False
            for conv, turn, role, text, key, is_blank, cut_short in _stream(batches):
                if started and conv != now:
                    yield part(now, rows, texts, not cut)
                    rows, texts, size, cut = [], [], 0, False
                elif rows and (len(rows) >= PART_ROWS or size >= PART_BYTES):
                    yield part(now, rows, texts, False)
                    rows, texts, size, cut = [], [], 0, True
                now, started = conv, True
                rows.append((turn, role, key, is_blank, cut_short))
                texts.append(text)
                size += len(text)
            if rows:
                yield part(now, rows, texts, False)

        yield from _batched(parts(), schema, lambda r: r["size"])
    return run


def _effects(ddl: str):
    """A part's counts and its transfer from every stack top."""
    schema = _arrow(ddl)

    def effects(batches):
        for conv, part, rows, new in _stream(batches):
            new = set(new or ())
            plain = [(r["turn"], r["role"], r["is_blank"], r["cut_short"]) for r in rows]
            edges, tokens = _summary(plain, [i in new for i in range(len(rows))])
            moves = [{"entry": top, "exit": node, "cost": cost, "audit": audit} for top in PARSER.tops
                     for node, (cost, audit) in transfer({top: (0, "")}, tokens).items()]
            initials = "".join(r[0] or " " for r in tokens)
            yield edges | {"conv_id": conv, "part": part, "initials": initials, "moves": moves}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(effects(batches), schema, lambda r: 16 * len(r["initials"]))
    return run


_EFFECTS = ("conv_id %s, part long, initials string, " + _EDGES +
            ", moves array<struct<entry:int,exit:int,cost:long,audit:string>>")
_FOLDED = "conv_id %s, part long, entry int, " + _COUNTS + ", cost long, audit string"


def _fold(ddl: str):
    """Parts of each conversation, in order, to one row (part NULL) of the whole
    and one row (entry, audit) a part."""
    schema = _arrow(ddl)
    names = ["conv_id", "part", "initials", *(f.name for f in StructType.fromDDL(_EDGES)), "moves"]

    def close(conv, level, edges, parts):
        cost, audit = cheapest(level)
        yield {"conv_id": conv, "gaps": _gaps(edges), "cost": cost, "audit": audit,
               **{n: edges[n] for n in ("blank", "duplicate", "truncated", "illegal")}}
        at, node = 0, PARSER.start
        for i, (part, initials) in enumerate(parts):
            stop, row, entry = at, 0, node
            while row < len(initials) or (i == len(parts) - 1 and stop < len(audit)):
                edit = audit[stop]
                if edit != "D":
                    symbol = initials[row] if edit == "K" else PARSER.next_role[node][0]
                    (node,) = PARSER.shift(node, symbol)
                row += edit != "I"
                stop += 1
            yield {"conv_id": conv, "part": part, "entry": entry, "audit": audit[at:stop]}
            at = stop

    def folded(batches):
        now, level, edges, parts, started = None, None, None, [], False
        for values in _stream(batches):
            row = dict(zip(names, values))
            if not started or row["conv_id"] != now:
                if started:
                    yield from close(now, level, edges, parts)
                now, started = row["conv_id"], True
                level, edges, parts = {PARSER.start: (0, "")}, None, []
            moves: dict[int, dict] = {}
            for m in row["moves"]:
                moves.setdefault(m["entry"], {})[m["exit"]] = (m["cost"], m["audit"])
            level = compose(level, moves)
            edges = row if edges is None else _merged(edges, row)
            parts.append((row["part"], row["initials"]))
        if started:
            yield from close(now, level, edges, parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(folded(batches), schema, lambda r: len(r["audit"]))
    return run


def _merged(a: dict, b: dict) -> dict:
    """Counts of two neighbouring parts."""
    out = {n: a[n] + b[n] for n in ("blank", "duplicate", "truncated", "illegal", "n_turns")}
    out["illegal"] += a["last_initial"] + b["first_initial"] not in _LEGAL
    if a["last_turn"] is not None and a["last_turn"] == b["first_turn"]:
        out["n_turns"] -= 1
    first = a["first_turn"] if a["first_turn"] is not None else b["first_turn"]
    return out | {"first_turn": first, "last_turn": b["last_turn"], "first_initial": a["first_initial"],
                  "last_initial": b["last_initial"]}


def _edited(ddl: str):
    """Parts with their edits to their repaired turns."""
    schema = _arrow(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            for conv, part, rows, texts, entry, audit in _stream(batches):
                lines, _ = apply_edits([(r["role"], t) for r, t in zip(rows, texts)], audit, entry)
                yield {"conv_id": conv, "part": part, "rows": [{"role": r} for r, _ in lines],
                       "texts": [t for _, t in lines], "joined": _joined(lines), "empty": not lines}
        yield from _batched(parts(), schema, lambda r: 2 * len(r["joined"]))
    return run


def _hashed(ddl: str):
    """The SHA-256 of each conversation's text, streamed over its sorted parts."""
    schema = _arrow(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def conversations():
            now, sha, begun, started = None, None, False, False
            for conv, _, joined, empty in _stream(batches):
                if not started or conv != now:
                    if started:
                        yield {"conv_id": now, "repaired_sha256": sha.hexdigest()}
                    now, sha, begun, started = conv, hashlib.sha256(), False, True
                if not empty:
                    sha.update(b"\n" + joined if begun else joined)
                    begun = True
            if started:
                yield {"conv_id": now, "repaired_sha256": sha.hexdigest()}
        yield from _batched(conversations(), schema)
    return run


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def repair(conversations: DataFrame, keep_turns: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """(decisions, turns). ``decisions``: one row per conversation with rows:
    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256. ``turns`` (if asked for): the repaired turns in order of
    (part, place): conv_id, part, place, role, text."""
    spark = conversations.sparkSession
    ship_package(spark)
    conv_type = conversations.schema["conv_id"].dataType.simpleString()
    parts_ddl = _parts_ddl(conv_type)
    parts = scratch_table(_ordered(conversations).mapInArrow(_cut_parts(keep_turns, parts_ddl), parts_ddl), "turns")
    result = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

    open_parts = parts.where(~F.col("whole"))
    heads = (
        open_parts.select("conv_id", "part", F.posexplode("rows").alias("at", "row")).where(~F.col("row.is_blank"))
        .groupBy("conv_id", "row.role", "row.key").agg(F.min(F.struct("part", "at")).alias("first"))
        .groupBy("first.part").agg(F.collect_list("first.at").alias("new")))  # at most PART_ROWS a part
    effects_ddl, folded_ddl = _EFFECTS % conv_type, _FOLDED % conv_type
    effects = (
        open_parts.select("conv_id", "part", "rows").join(heads, "part", "left").select("conv_id", "part", "rows", "new")
        .mapInArrow(_effects(effects_ddl), effects_ddl))
    folded = scratch_table(
        effects.repartition("conv_id").sortWithinPartitions("conv_id", "part")
        .mapInArrow(_fold(folded_ddl), folded_ddl), "fold")
    edits = folded.where(F.col("part").isNotNull()).select("part", "entry", "audit")
    lines_ddl = f"conv_id {conv_type}, part long, rows array<struct<role:string>>, texts array<string>, joined binary, empty boolean"
    edited = (
        open_parts.select("conv_id", "part", "rows", "texts").join(edits, "part")
        .select("conv_id", "part", "rows", "texts", "entry", "audit").mapInArrow(_edited(lines_ddl), lines_ddl))
    hash_ddl = f"conv_id {conv_type}, repaired_sha256 string"
    hashes = (
        edited.select("conv_id", "part", "joined", "empty").repartition("conv_id").sortWithinPartitions("conv_id", "part")
        .mapInArrow(_hashed(hash_ddl), hash_ddl).withColumnRenamed("conv_id", "_conv"))
    joined = folded.where(F.col("part").isNull()).join(hashes, _same("conv_id", "_conv"))
    decisions = parts.where("whole").select(*result).unionByName(joined.select(*result))
    if not keep_turns:
        return decisions, None
    pairs = F.arrays_zip(F.col("rows.role").alias("role"), F.col("texts").alias("text"))
    turns = (
        parts.where("whole").select("conv_id", "part", "rows", "texts").select("conv_id", "part", F.posexplode(pairs).alias("place", "turn"))
        .unionByName(edited.select("conv_id", "part", F.posexplode(pairs).alias("place", "turn"))))
    return decisions, turns.select("conv_id", "part", "place", F.col("turn.role").alias("role"), F.col("turn.text").alias("text"))


def with_missing(conversations: DataFrame, decisions: DataFrame) -> DataFrame:
    """``decisions`` for every conv_id of ``conversations``: zeros, an empty
    audit and the empty text's hash where no row was left."""
    found = decisions.withColumnRenamed("conv_id", "_conv")
    empty = hashlib.sha256(b"").hexdigest()
    return conversations.select("conv_id").distinct().join(found, _same("conv_id", "_conv"), "left").select(
        "conv_id", *(F.coalesce(n, F.lit(0).cast("bigint")).alias(n)
                     for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
