"""Conversation repair by weighted interval parsing.

The legal orders of roles, an optional system turn and then user and assistant by turns, are a regular language with four
states, so the grammar in Chomsky's form has one nonterminal for each pair of states: A(p,q) -> A(p,r) A(r,q), with a row's
edits and the insertions after it as terminals. A span's table holds, for each nonterminal, the least (cost, audit).

Tables are combined bottom-up by span length. Every split of a span gives the same table here (the intermediate state is
free, and of two audits of one span with equal cost none begins the other, so the least audits of the halves make the
least of the whole); one split a span is enough. Spans that end at a segment's border are combined across segments the same
way, so a conversation of any length is parsed in pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acervo.llm.common import arrow_schema, staged

SEGMENT_TURNS = 4096
BLANKS = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
START, OPENED, ASKED, ANSWERED = range(4)
#: State after a turn of the given initial; other pairs are illegal.
NEXT = {(START, "s"): OPENED, (START, "u"): ASKED, (OPENED, "u"): ASKED, (ASKED, "a"): ANSWERED, (ANSWERED, "u"): ASKED}
FINAL = (START, ANSWERED)
LEGAL = {"su", "ua", "au"}
ROLES = {"u": "user", "a": "assistant"}
TURNS = "array<struct<role:string,text:string>>"
CELLS = "array<struct<p:int,q:int,cost:bigint,audit:string>>"

#: least (cost, audit) by pair of states
Table = dict[tuple[int, int], tuple[int, str]]


def better(table: dict, pair: tuple[int, int], found: tuple) -> None:
    held = table.get(pair)
    if held is None or found[:2] < held[:2]:
        table[pair] = found


def joined(left: dict, right: dict) -> dict:
    """Table of two neighbouring spans; what follows cost and audit in a cell is concatenated."""
    out: dict = {}
    for (p, r), a in left.items():
        for q in range(4):
            b = right.get((r, q))
            if b is not None:
                held = out.get((p, q))
                if held is None or a[0] + b[0] <= held[0]:
                    better(out, (p, q), (a[0] + b[0], *(x + y for x, y in zip(a[1:], b[1:]))))
    return out


def _inserted() -> Table:
    """Closure of insertions: from each state along turns of user and assistant, until nothing cheaper is found."""
    table: Table = {(p, p): (0, "") for p in range(4)}
    for _ in range(4):
        for (p, r), (cost, audit) in list(table.items()):
            for role in ROLES:
                if (r, role) in NEXT:
                    better(table, (p, NEXT[r, role]), (cost + INSERT, audit + "I"))
    return table


INSERTED = _inserted()
_made: dict[tuple, Table] = {}


def row_table(initial: str, gone: bool, cut: bool, copies: int) -> Table:
    """Edits of a row and of its repetitions, which must go, and the insertions after them."""
    key = (initial, gone, cut, copies)
    if key not in _made:
        if len(_made) > 4096:
            _made.clear()
        _made[key] = _row_table(*key)
    return _made[key]


def _row_table(initial: str, gone: bool, cut: bool, copies: int) -> Table:
    deletions = copies if gone else copies - 1
    table: Table = {}
    for p in range(4):
        better(table, (p, p), (DELETE * copies, "D" * copies))
        if not gone:
            rest, tail = CUT * cut + DELETE * deletions, "D" * deletions
            if (p, initial) in NEXT:
                better(table, (p, NEXT[p, initial]), (KEEP + rest, "K" + tail))
            for role in ROLES:
                if (p, role) in NEXT:
                    better(table, (p, NEXT[p, role]), (REROLE + rest, "R" + tail))
    return joined(table, INSERTED)


def parsed(tables: list[dict], split: Callable[[int], int] | None = None) -> dict:
    """Table of the whole of neighbouring spans, by rising span length."""
    if split is not None and len(tables) > 1:
        at = split(len(tables))
        return joined(parsed(tables[:at], split), parsed(tables[at:], split))
    while len(tables) > 1:
        tables = [joined(*tables[i:i + 2]) if i + 1 < len(tables) else tables[i] for i in range(0, len(tables), 2)]
    return tables[0]


def judged(text: str, first: bool) -> tuple[bool, bool, bool]:
    """Blank, duplicate, truncated: the first of them that holds."""
    solid = text.rstrip(BLANKS)
    if not solid:
        return True, False, False
    return False, not first, first and solid[-1] not in ".!?"


def segment_report(rows: list[dict]) -> tuple:
    """Counts, borders and table of the rows of one segment, each with its number of repetitions."""
    blank = duplicate = truncated = illegal = 0
    before, tables, turns = None, [], set()
    for row in rows:
        n, initial = row["n"], row["role"][:1]
        is_blank, is_duplicate, is_cut = judged(row["text"], row["first"])
        blank += n * is_blank
        duplicate += n * is_duplicate + (n - 1) * (not is_blank and not is_duplicate)
        truncated += is_cut
        illegal += n - 1 + (before is not None and before + initial not in LEGAL)
        before = initial
        turns.add(row["turn"])
        tables.append(row_table(initial, is_blank or is_duplicate, is_cut, n))
    turns.discard(None)
    cells = [(p, q, cost, audit) for (p, q), (cost, audit) in parsed(tables).items()]
    return (min(turns, default=None), max(turns, default=None), len(turns), blank, duplicate, truncated, illegal,
            rows[0]["role"][:1], before, cells)


def conversation_report(segments: list[dict]) -> tuple:
    """Gaps, counts, cost, audit, and each segment's part of the audit with the state it begins in."""
    illegal = sum(s["illegal"] for s in segments) + sum(
        a["tail"] + b["head"] not in LEGAL for a, b in zip(segments, segments[1:]))
    low = min((s["least"] for s in segments if s["least"] is not None), default=None)
    high = max((s["most"] for s in segments if s["most"] is not None), default=None)
    gaps = 0 if low is None else high - low + 1 - sum(s["turns"] for s in segments)
    own = [{(c["p"], c["q"]): (c["cost"], c["audit"]) for c in s["cells"]} for s in segments]
    # a cell also remembers the state at every border
    tables = [{pair: (*cell, (pair[1],)) for pair, cell in table.items()} for table in [INSERTED, *own]]
    whole = parsed(tables)
    cost, audit, path = min(whole[START, q] for q in FINAL if (START, q) in whole)
    parts, at = [], START
    for n, (segment, table) in enumerate(zip(segments, own)):
        ahead = INSERTED[START, path[0]][1] if n == 0 else ""
        before = path[n]
        parts.append((segment["seg"], at, ahead + table[before, path[n + 1]][1]))
        at = path[n + 1]
    return (gaps, *(sum(s[k] for s in segments) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, parts)


def edited(rows: list[dict], state: int, audit: str) -> list[tuple[str, str]]:
    """Role and text of the turns that the edits leave or insert."""
    given = ((row["role"], row["text"]) for row in rows for _ in range(row["n"]))
    out = []
    for edit in audit:
        role, text = next(given) if edit != "I" else (None, "")
        if edit == "D":
            continue
        if edit != "K":
            role = ROLES["a" if state == ASKED else "u"]
        state = NEXT[state, role[:1]]
        out.append((role, text))
    return out


def _rowwise(df: DataFrame, fn: Callable[[dict], tuple], keep: list[str], fields: str) -> DataFrame:
    """Each row's own result, next to the columns of `keep`."""
    types = dict(df.dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in keep] + [fields])
    arrow = arrow_schema(df.sparkSession, schema)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [fn(row) for row in part.to_pylist()]
                columns = [part.column(part.schema.get_field_index(c)) for c in keep]
                for i in range(len(keep), len(arrow)):
                    kind = arrow.types[i]
                    values = [row[i - len(keep)] for row in found]
                    if pa.types.is_list(kind):
                        names = [kind.value_type.field(j).name for j in range(kind.value_type.num_fields)]
                        values = [[dict(zip(names, x)) for x in v] for v in values]
                    columns.append(pa.array(values, kind))
                yield pa.RecordBatch.from_arrays([c.cast(arrow.types[i]) for i, c in enumerate(columns)], schema=arrow)

    return df.mapInArrow(run, schema)


def segments_of(rows: DataFrame, segment_turns: int) -> DataFrame:
    """conv_id, seg, rows: the rows of a conversation in pieces of so many turns, in order; equal rows once, with their number."""
    plain = rows.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    counted = plain.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n")).withColumns({
        "key": F.sha2("text", 256), "at": F.struct(F.col("turn").isNotNull().alias("known"), "turn")})
    firsts = counted.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("key").alias("k")).agg(F.min("at").alias("earliest"))
    same: Column = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("key") == F.col("k"))
    # the order of struct fields is the order of rows: turns without a number first, then by turn, role and text
    item = F.struct("at", "turn", "role", "text", "n", F.col("at").eqNullSafe(F.col("earliest")).alias("first"))
    found = counted.join(firsts, same).groupBy("conv_id", F.floor(F.col("turn") / segment_turns).alias("seg")).agg(
        F.sort_array(F.collect_list(item)).alias("rows"))
    return found.withColumn("rows", F.transform("rows", lambda x: x.dropFields("at")))


def repaired(rows: DataFrame, segment_turns: int = SEGMENT_TURNS) -> tuple[DataFrame, DataFrame]:
    """Faults and cheapest repair of every conversation (conv_id, turn, role, text).

    Rows are taken by turn (unnumbered first), then role and text; a null role or text is one blank, a null conv_id is a
    conversation like any other. A row's first fault counts: blank, duplicate (role and text seen earlier), truncated.
    The repaired roles are an optional system turn and then user and assistant by turns; of the cheapest edits those
    whose initials come first in ASCII order are taken.

    Returns two tables. Report: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit. Turns: conv_id, seg
    and the repaired turns (role, text) of each segment, to be read by seg, null first. An empty table gives none; other
    columns play no part. Equal rows are counted before the shuffle, a conversation is cut into segments of
    `segment_turns` turn numbers, and only rows of one turn number must stay together in a task; what meets for a whole
    conversation are tables of a few costs and audits, which are as long as the audit that is to be returned.
    """
    segments = staged(segments_of(rows, segment_turns), "segments")
    counts = "blank bigint, duplicate bigint, truncated bigint, illegal bigint"
    reports = _rowwise(segments, lambda row: segment_report(row["rows"]), ["conv_id", "seg"],
                       f"least bigint, most bigint, turns bigint, {counts}, head string, tail string, cells {CELLS}")
    fields = [c for c in reports.columns if c != "conv_id"]
    whole = reports.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        F.col("seg").isNotNull().alias("known"), *fields))).alias("segments"))
    parts = "array<struct<seg:bigint,state:int,audit:string>>"
    found = staged(_rowwise(whole, lambda row: conversation_report(row["segments"]), ["conv_id"],
                            f"gaps bigint, {counts}, cost bigint, audit string, parts {parts}"), "repairs")
    cuts = found.select(F.col("conv_id").alias("c"), F.explode("parts").alias("part")).select("c", "part.*")
    meet = segments.join(cuts.withColumnRenamed("seg", "s"), F.col("conv_id").eqNullSafe(F.col("c")) & F.col("seg").eqNullSafe(F.col("s")))
    turns = _rowwise(meet.select("conv_id", "seg", "rows", "state", "audit"),
                     lambda row: (edited(row["rows"], row["state"], row["audit"]),), ["conv_id", "seg"], f"turns {TURNS}")
    return found.drop("parts"), turns


def digests(turns: DataFrame) -> DataFrame:
    """conv_id, sha256: of the lines `role:text` of a conversation, read segment by segment, one at a time."""
    kind = dict(turns.dtypes)["conv_id"]
    schema = f"conv_id {kind}, sha256 string"
    arrow = arrow_schema(turns.sparkSession, schema)

    def run(batches) -> Iterator[pa.RecordBatch]:
        key, digest, empty = None, None, True
        done: list[tuple] = []

        def out():
            found = pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], arrow.types[i]) for i in (0, 1)], schema=arrow)
            done.clear()
            return found

        for batch in batches:
            for conv, lines in zip(batch.column(0).to_pylist(), batch.column(1)):
                if digest is None or conv != key:
                    if digest is not None:
                        done.append((key, digest.hexdigest()))
                    key, digest, empty = conv, hashlib.sha256(), True
                for line in lines.as_py():
                    digest.update(("" if empty else "\n").encode() + f"{line['role']}:{line['text']}".encode())
                    empty = False
            if done:
                yield out()
        if digest is not None:
            done.append((key, digest.hexdigest()))
            yield out()

    order = [F.col("conv_id").asc_nulls_first(), F.col("seg").asc_nulls_first()]
    return turns.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "turns").mapInArrow(run, schema)
