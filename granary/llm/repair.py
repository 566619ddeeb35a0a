"""Repair of conversation structure by Wagner-Fischer alignment to the alternating grammar.

A repaired conversation reads ``(s?(ua)+)?`` in role initials. Its turns are aligned to the
grammar's string of each feasible length: one of them is the end of every longer one, so one
table, filled from the last turn backward, has the costs of all. A cheap greedy repair is the
incumbent; its cost bounds the band of lengths that can still be met from each turn (Ukkonen),
and cells outside it are not filled. Every length of least cost is traced back, by the smallest
letter at each step, and the audits are compared.

Rows are sorted over range partitions. A conversation that lies in one partition and has few
turns is aligned where it is read. Others are cut into segments: a table is filled for each
segment and state of the grammar, the segments' costs are added from the last to the first,
and then each segment is traced with what follows it known. So no task holds a whole long
conversation; only the digest of its repaired text is read through one task, row by row.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.shared import written
from granary.llm.turns import in_order

# Fixed values of the grammar and its edits.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}
NEXT = {"0": "u", "s": "u", "a": "u", "u": "a"}
LEGAL = {"su", "ua", "au"}
#: States of the grammar: nothing yet, or the initial written last.
STATES = "0sua"
#: Rows and characters of text of a segment.
ROWS, CHARS = 512, 1 << 19
SALTS = 32
_INF = np.int32(1 << 29)
_NONE = 1 << 40

# A row's code: "d" if it must go, else its role's initial ("x" for others than s, u, a), a
# capital one if its text is truncated.


def greedy(codes: str, state: str) -> int:
    """Cost of a repair made row by row; what may be missing at the end is not counted."""
    cost = 0
    for i, c in enumerate(codes):
        if not c.islower() or c == "d":
            cost += DELETE
        elif c == NEXT[state] or (c == "s" and state == "0"):
            state = c
        elif i + 1 < len(codes) and codes[i + 1] == NEXT[state]:
            cost += DELETE
        else:
            cost, state = cost + REROLE, NEXT[state]
    return cost


class Table:
    """Least costs of aligning ``codes[i:]`` to the last ``r`` initials of an alternating
    string that ends in ``end``, for all costs up to ``most``.

    Unless the segment is the conversation's last, nothing is inserted behind its last row:
    that belongs to the next segment.
    """

    def __init__(self, codes: str, end: str, last: bool, most: int):
        self.codes, self.end, self.last = codes, end, last
        n = len(codes)
        healthy = sum(c.islower() and c != "d" for c in codes)
        cut = sum(c.isupper() for c in codes)
        slack = most - DELETE * (n - healthy)
        h = t = 0
        width = self._high(healthy, cut, slack)
        odd = np.arange(width + 2) % 2 == 1
        r5 = INSERT * np.arange(width + 2, dtype=np.int32)
        row = np.where(np.arange(self._high(0, 0, slack) + 1) == 0, 0, r5[: self._high(0, 0, slack) + 1] if last else _INF).astype(np.int32)
        self.rows, self.lows = [row], [0]
        for c in reversed(codes):
            h, t = h + (c.islower() and c != "d"), t + c.isupper()
            low, high = max(0, h - slack // DELETE), self._high(h, t, slack)
            before, start = self.rows[-1], self.lows[-1]
            best = np.full(high - low + 1, _INF, dtype=np.int32)
            self._lay(best, low, before + DELETE, start)
            if c != "d":
                odd_cost = 0 if c.lower() == end else REROLE
                even_cost = 0 if c.lower() == ("u" if end == "a" else "a") else REROLE
                turn = np.where(odd[(start + 1) % 2 : (start + 1) % 2 + len(before)], odd_cost, even_cost)
                self._lay(best, low, before + turn + (TRUNCATED if c.isupper() else 0), start + 1)
            best = np.minimum.accumulate(best - r5[: len(best)]) + r5[: len(best)]
            self.rows.append(best)
            self.lows.append(low)
        self.rows.reverse()
        self.lows.reverse()

    @staticmethod
    def _high(h: int, t: int, slack: int) -> int:
        """Most initials that rows with ``h`` healthy and ``t`` truncated ones can give."""
        kept = TRUNCATED - DELETE
        return max(0, h + slack // kept if slack <= kept * t else h + t + (slack - kept * t) // INSERT)

    @staticmethod
    def _lay(best: np.ndarray, low: int, costs: np.ndarray, start: int) -> None:
        """``costs`` for lengths from ``start`` into ``best`` for lengths from ``low``, where smaller."""
        a, b = max(low, start), min(low + len(best), start + len(costs))
        if a < b:
            np.minimum(best[a - low : b - low], costs[a - start : b - start], out=best[a - low : b - low])

    def at(self, i: int, r: int) -> int:
        k = r - self.lows[i]
        return int(self.rows[i][k]) if 0 <= k < len(self.rows[i]) else _NONE

    def initial(self, r: int) -> str:
        return self.end if r % 2 else NEXT[self.end]

    def lengths(self, i: int, state: str, most: int) -> Iterator[tuple[int, int]]:
        """(cost, length) of the strings that can follow ``state``, up to a cost of ``most``."""
        low, row = self.lows[i], self.rows[i]
        first = 0 if state == self.end else 1 if NEXT[state] == self.end else 2
        begin = first if first >= low else low + (first - low) % 2
        costs = row[begin - low :: 2]
        for k in np.flatnonzero(costs <= min(most, _INF - 1, int(costs.min(initial=_INF)))):
            yield int(costs[k]), begin + 2 * int(k)

    def trace(self, i: int, r: int) -> str:
        """Least audit of the alignment of ``codes[i:]`` to the last ``r`` initials."""
        out, n = [], len(self.codes)
        while i < n or r:
            cost = self.at(i, r)
            if i < n and cost == DELETE + self.at(i + 1, r):
                out.append("D")
                i += 1
            elif r and (i < n or self.last) and cost == INSERT + self.at(i, r - 1):
                out.append("I")
                r -= 1
            else:
                out.append("K" if self.codes[i].lower() == self.initial(r) else "R")
                i, r = i + 1, r - 1
        return "".join(out)


def _tables(codes: str, last: bool, ends: str, starts: str) -> dict[str, Table]:
    n = len(codes)
    most = min(DELETE * n, max(greedy(codes, s) + DELETE for s in starts)) + 2 * INSERT
    return {e: Table(codes, e, last, most) for e in ends}


def _ways(codes: str, start: str, finals: dict[str, int], tables: dict[str, Table], best: int = _NONE) -> Iterator[tuple[int, str, str, int, int, int]]:
    """Repairs of ``codes`` from ``start``, each no dearer than those before: (cost with that of
    its end, end, letters so far, table's row, length of the rest)."""
    n = len(codes)
    if start in finals:  # nothing is written
        cost = DELETE * n + finals[start]
        if start in "0s" and cost <= best:
            best = cost
            yield cost, start, "D" * n, n, 0
    firsts = [i for i, c in enumerate(codes) if c in "sS"] if start == "0" else []
    for i in firsts if "s" in finals else ():
        cost = DELETE * (n - 1) + (TRUNCATED if codes[i] == "S" else 0) + finals["s"]
        if cost <= best:
            best = cost
            yield cost, "s", "D" * i + "K" + "D" * (n - i - 1), n, 0
    for end, table in tables.items():
        if end not in finals:
            continue
        for begun, i, state in [(0, 0, start)] + [(DELETE * i + (TRUNCATED if codes[i] == "S" else 0), i + 1, "s") for i in firsts]:
            letters = "D" * (i - 1) + "K" if i else ""
            for cost, r in table.lengths(i, state, best - finals[end] - begun):
                best = cost + begun + finals[end]
                yield best, end, letters, i, r


def align(codes: str, start: str = "0", finals: dict[str, int] | None = None, last: bool = True, tables: dict[str, Table] | None = None) -> tuple[int, str, str]:
    """Cheapest repair of ``codes`` from state ``start``: (cost, audit, state at its end).

    ``finals`` has the cost of what follows each state the repair may end in; ties go to the
    audit that is least in ASCII order.
    """
    finals = {"0": 0, "a": 0} if finals is None else finals
    tables = tables or _tables(codes, last, "".join(e for e in "ua" if e in finals), start)
    ways = list(_ways(codes, start, finals, tables))
    cost = min((w[0] for w in ways), default=_NONE)
    audits = (
        (letters + tables[end].trace(i, r) if end in tables else letters, end)
        for c, end, letters, i, r in ways if c == cost
    )
    audit, end = min(audits, default=("", start))
    return cost, audit, end


@functools.lru_cache(maxsize=1 << 15)
def _align_short(codes: str) -> tuple[int, str]:
    return align(codes)[:2]


def costs(codes: str, last: bool) -> list[int]:
    """Least cost between each two states, by start and end."""
    tables = _tables(codes, last, "a" if last else "ua", STATES)
    out = []
    for start in STATES:
        for end in STATES:
            mine = {end: tables[end]} if end in tables else {}
            out.append(min((w[0] for w in _ways(codes, start, {end: 0}, mine)), default=_NONE))
    return out


class Repaired:
    """SHA-256 over repaired ``role:text`` lines, fed segment by segment."""

    def __init__(self):
        self.digest, self.state, self.begun = hashlib.sha256(), "0", False

    def _line(self, role: str, text: str) -> None:
        self.digest.update((f"\n{role}:{text}" if self.begun else f"{role}:{text}").encode())
        self.begun = True

    def feed(self, audit: str, codes: str, roles: list[str], texts: list[str]) -> None:
        i = 0
        for letter in audit:
            if letter == "I":
                self.state = NEXT[self.state]
                self._line(ROLES[self.state], "")
                continue
            if letter == "K":
                self.state = codes[i].lower()
                self._line(roles[i], texts[i])
            elif letter == "R":
                self.state = NEXT[self.state]
                self._line(ROLES[self.state], texts[i])
            i += 1


class Segment:
    """Rows of one conversation in order, with their faults."""

    FACTS = ("blank", "duplicate", "truncated", "illegal", "turns", "first_turn", "last_turn", "min_turn", "max_turn", "first_role", "last_role")

    def __init__(self):
        self.codes, self.roles, self.texts, self.chars = [], [], [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = self.min_turn = self.max_turn = None
        self.first_role = self.last_role = None

    def add(self, turn: int | None, role: str, text: str, fault: str) -> None:
        first = role[:1]
        if self.codes:
            self.illegal += self.last_role + first not in LEGAL
        else:
            self.first_turn, self.first_role = turn, first
        if turn is not None and (not self.codes or turn != self.last_turn):
            self.turns += 1
            self.min_turn = turn if self.min_turn is None else self.min_turn
            self.max_turn = turn
        self.last_turn, self.last_role = turn, first
        code = first if first in ("s", "u", "a") else "x"
        if fault in ("blank", "duplicate"):
            code = "d"
        elif fault == "truncated":
            code = code.upper()
        if fault:
            setattr(self, fault, getattr(self, fault) + 1)
        self.codes.append(code)
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(text)


def gaps(low: int | None, high: int | None, turns: int) -> int:
    return high - low + 1 - turns if turns else 0


_FACTS = [
    ("blank", pa.int64(), "long"), ("duplicate", pa.int64(), "long"), ("truncated", pa.int64(), "long"), ("illegal", pa.int64(), "long"),
    ("turns", pa.int64(), "long"), ("first_turn", pa.int64(), "long"), ("last_turn", pa.int64(), "long"), ("min_turn", pa.int64(), "long"),
    ("max_turn", pa.int64(), "long"), ("first_role", pa.string(), "string"), ("last_role", pa.string(), "string"),
]
_RESULT = [
    ("conv_id", pa.int64(), "long"), ("gaps", pa.int64(), "long"), ("blank", pa.int64(), "long"), ("duplicate", pa.int64(), "long"),
    ("truncated", pa.int64(), "long"), ("illegal", pa.int64(), "long"), ("cost", pa.int64(), "long"), ("audit", pa.string(), "string"),
    ("repaired_sha256", pa.string(), "string"),
]
_SEGMENT = [
    ("conv_id", pa.int64(), "long"), ("part", pa.int32(), "int"), ("seg", pa.int64(), "long"), ("whole", pa.bool_(), "boolean"),
    ("gaps", pa.int64(), "long"), ("cost", pa.int64(), "long"), ("audit", pa.string(), "string"), ("repaired_sha256", pa.string(), "string"),
    ("codes", pa.string(), "string"), ("roles", pa.list_(pa.string()), "array<string>"), ("texts", pa.list_(pa.string()), "array<string>"),
    *_FACTS,
]


def _ddl(fields) -> str:
    return ", ".join(f"{n} {sql}" for n, _, sql in fields)


def _batch(rows: list[dict], fields) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], kind) for n, kind, _ in fields], names=[n for n, _, _ in fields])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of sorted rows; conversations that surely lie here whole, already repaired."""
    part, out, size = TaskContext.get().partitionId(), [], 0
    number = 0
    conv, segment, first, short, before = None, None, True, True, None

    def close(ends_here: bool) -> None:
        nonlocal number, size
        row = {"conv_id": conv, "part": part, "seg": number, "codes": "".join(segment.codes)} | {n: getattr(segment, n) for n in Segment.FACTS}
        number += 1
        if ends_here and short and not first:
            cost, audit = _align_short(row["codes"]) if len(segment.codes) <= 64 else align(row["codes"])[:2]
            mended = Repaired()
            mended.feed(audit, row["codes"], segment.roles, segment.texts)
            row |= {"whole": True, "cost": cost, "audit": audit, "repaired_sha256": mended.digest.hexdigest()}
            row["gaps"] = gaps(segment.min_turn, segment.max_turn, segment.turns)
        else:
            row |= {"whole": False, "roles": segment.roles, "texts": segment.texts}
            size += segment.chars
        out.append(row)

    for conv_id, turn, role, text, gone, fault, later in _rows(batches):
        if segment is None:
            conv, segment = conv_id, Segment()
        elif conv_id != conv:
            close(True)
            conv, segment, first, short, before = conv_id, Segment(), False, True, None
        elif len(segment.codes) >= ROWS or segment.chars >= CHARS:
            short = False
            close(False)
            segment = Segment()
        if not gone:
            now = (turn, role, text)
            # Of equal rows of one turn the first may be no duplicate; they stand together.
            segment.add(*now, fault if fault in ("blank", "duplicate") else "duplicate" if later and now == before else fault)
            before = now
        if len(out) >= 2000 or size >= 16 * CHARS:
            yield _batch(out, _SEGMENT)
            out, size = [], 0
    if segment is not None:
        short = False  # may go on in the next partition
        close(False)
    yield _batch(out, _SEGMENT)


def _segment_costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes = batch.column("codes").to_pylist()
        kept = ["conv_id", "part", "seg"]
        inner, final = ([costs(c, last) for c in codes] for last in (False, True))
        yield pa.RecordBatch.from_arrays(
            [batch.column(n) for n in kept] + [pa.array(x, pa.list_(pa.int64())) for x in (inner, final)], names=[*kept, "inner", "final"]
        )


_FOLLOWED = [("part", pa.int32(), "int"), ("seg", pa.int64(), "long"), ("last", pa.bool_(), "boolean"), ("finals", pa.list_(pa.int64()), "array<long>")]


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For segments from last to first: the cost of what follows each state at their end."""
    conv, ahead, out = None, None, []
    for conv_id, part, seg, inner, final in _rows(batches):
        last = ahead is None or conv_id != conv
        conv = conv_id
        after = [0 if s in "0a" else _NONE for s in STATES] if last else ahead
        out.append({"part": part, "seg": seg, "last": last, "finals": after})
        matrix = final if last else inner
        ahead = [min(_NONE, *(matrix[4 * p + e] + after[e] for e in range(4))) for p in range(4)]
        if len(out) >= 10_000:
            yield _batch(out, _FOLLOWED)
            out = []
    yield _batch(out, _FOLLOWED)


_TRACED = [("audits", pa.list_(pa.string()), "array<string>"), ("ends", pa.string(), "string"), ("steps", pa.list_(pa.int64()), "array<long>")]


def _traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audits of segments for each state they may begin in."""
    for batch in batches:
        out = []
        for codes, last, finals in zip(*(batch.column(c).to_pylist() for c in ("codes", "last", "finals")), strict=True):
            reachable = {s: c for s, c in zip(STATES, finals, strict=True) if c < _NONE}
            tables = _tables(codes, last, "".join(e for e in "ua" if e in reachable), STATES)
            ways = [align(codes, s, reachable, last, tables) for s in STATES]
            steps = [w[0] - reachable[w[2]] if w[0] < _NONE else _NONE for w in ways]
            out.append({"audits": [w[1] for w in ways], "ends": "".join(w[2] for w in ways), "steps": steps})
        names = [n for n in batch.schema.names if n not in ("last", "finals")]
        more = _batch(out, _TRACED)
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], *more.columns], names=[*names, *more.schema.names])


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of conversations whose segments come in order."""
    out, result, mended, state, seen = [], None, None, "0", None

    def close() -> None:
        if result is not None:
            low, high, turns = result.pop("low"), result.pop("high"), result.pop("turns")
            out.append(result | {"audit": "".join(result["audit"]), "gaps": gaps(low, high, turns), "repaired_sha256": mended.digest.hexdigest()})

    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
            if result is None or row["conv_id"] != result["conv_id"]:
                close()
                result = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost", "turns"), 0)
                result |= {"conv_id": row["conv_id"], "audit": [], "low": None, "high": None}
                mended, state, seen = Repaired(), "0", None
            k = STATES.index(state)
            result["cost"] += row["steps"][k]
            result["audit"].append(row["audits"][k])
            mended.feed(row["audits"][k], row["codes"], row["roles"], row["texts"])
            state = row["ends"][k]
            for n in ("blank", "duplicate", "truncated", "illegal", "turns"):
                result[n] += row[n]
            if row["codes"]:
                if seen is not None:
                    result["illegal"] += seen[1] + row["first_role"] not in LEGAL
                    result["turns"] -= row["first_turn"] is not None and row["first_turn"] == seen[0]
                seen = (row["last_turn"], row["last_role"])
            if row["min_turn"] is not None:
                result["low"] = row["min_turn"] if result["low"] is None else result["low"]
                result["high"] = row["max_turn"]
        if len(out) >= 1000:
            yield _batch(out, _RESULT)
            out.clear()
    close()
    yield _batch(out, _RESULT)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows of ``conversations`` with faults put in by crc32(``conv_id:turn``) % 20, nulls as one
    space: 0 drops a row (``gone``), 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4
    sets its role to user."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key) % 20
    return (
        conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind"))
        .select(
            "conv_id", F.col("turn").cast("long").alias("turn"),
            F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
            F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
            (F.col("kind") == 0).alias("gone"),
            F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"),
        )
        .drop("copy")
    )


def with_faults(rows: DataFrame) -> DataFrame:
    """``rows(conv_id, turn, role, text, gone)`` with ``fault``, the first of blank, duplicate and
    truncated or an empty string, and ``later``, set where equal rows of one turn exist.

    Rows are duplicates of others by SHA-256 of role and text; counts are merged under a
    salt first, so a turn repeated very often is no single task.
    """
    digest = F.sha2(F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.lit(":"), F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    salt = (F.monotonically_increasing_id() % SALTS).cast("int")
    keyed = written(rows.withColumns({"digest": F.unhex(F.when(~F.col("gone"), digest)), "salt": salt}), "repair-rows")
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))
    repeated = (
        keyed.filter("not gone").groupBy("digest", "salt").agg(F.min(place).alias("first"), F.count("*").alias("n"))
        .groupBy("digest").agg(F.min("first").alias("first"), F.sum("n").alias("n"), F.collect_list("salt").alias("salts"))
        .filter("n > 1").select("digest", "first", F.explode("salts").alias("salt"))
    )
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    ended = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    again = F.coalesce(F.col("first") < place, F.lit(False))
    fault = F.when(blank, "blank").when(again, "duplicate").when(~ended, "truncated").otherwise("")
    return keyed.join(repeated, ["digest", "salt"], "left").select(
        "conv_id", "turn", "role", "text", "gone", fault.alias("fault"), F.col("first").isNotNull().alias("later")
    )


def repaired(rows: DataFrame) -> DataFrame:
    """Structure of each conversation in ``rows(conv_id, turn, role, text, gone)`` and its
    cheapest repair.

    Returns one row a conv_id: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256``. Rows are taken by turn (null first), then role and text. ``gone``
    rows only keep their conversation in the result: without others it has zeros, an empty
    audit and the digest of nothing. Roles and texts are not null here (see ``damaged``). A
    null conv_id is a conversation like others, and repeated rows are duplicates. Other
    columns are ignored, whatever their names. An empty table gives no rows.
    """
    ordered = in_order(with_faults(rows)).select("conv_id", "turn", "role", "text", "gone", "fault", "later")
    segments = written(ordered.mapInArrow(_segments, _ddl(_SEGMENT)), "repair-segments")
    names = [n for n, _, _ in _RESULT]
    here = segments.filter("whole").select(*names)
    opened = segments.filter("not whole")

    priced = opened.select("conv_id", "part", "seg", "codes").mapInArrow(
        _segment_costs, "conv_id long, part int, seg long, inner array<long>, final array<long>"
    )
    backward = priced.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part"), F.desc("seg"))
    followed = backward.mapInArrow(_followed, _ddl(_FOLLOWED))
    facts = [n for n, _, _ in _FACTS]
    carried = ["conv_id", "part", "seg", "codes", "roles", "texts", *facts]
    known = opened.join(followed, ["part", "seg"]).select(*carried, "last", "finals")
    kinds = [f for f in _SEGMENT if f[0] in carried]
    traced = known.select(*[n for n, _, _ in kinds], "last", "finals").mapInArrow(_traced, _ddl([*kinds, *_TRACED]))
    forward = traced.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seg")
    return here.unionByName(forward.mapInArrow(_finished, _ddl(_RESULT)).select(*names))
