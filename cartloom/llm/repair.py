"""Repair of conversations whose turns don't alternate, by Wagner-Fischer alignment to the grammar `(s?(ua)+)?`.

A conversation's rows become their roles' initials. Each feasible target of the grammar (every length, with or without
a system turn in front) is aligned with the rows: a row is kept (0), given the role user or assistant (1) or deleted (2), an
empty turn is inserted (5); blank and duplicate rows have to go, and a truncated row that stays costs 5 more. Targets
end alike, so one table of rows by symbols still to come holds the alignments to all lengths. Only a Ukkonen band of it is
filled: a cheap repair that is easily found is the incumbent, and cells from which the rest alone would cost more than it leaves
are left out. The cheapest lengths are backtraced in step, and of their audits (initials of the edits) the least wins.

Only every nth row of the table is kept, the rows between are filled again while backtracing, so memory grows
with the band times the root of the conversation's length. One conversation is one task's work, as its repair is one value;
rows reach a task sorted and are read one conversation at a time.

Cases: null texts and roles are one space, which makes a blank row; rows are ordered by turn (null first), then role and text.
Repeated rows are duplicates. Rows of a null conversation id form one conversation. Only conv_id, turn, role and text are read.
An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Costs of the edits, and of a truncated row that is not deleted.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
NEVER = 1 << 40
# Rows of the table that are filled again together, at least.
STEP = 64
ROLES = {"u": "user", "a": "assistant"}

Row = tuple[str, str]


def faults(rows: list[Row]) -> list[str]:
    """Per (role, text) row its first fault: blank, duplicate, truncated, or an empty string."""
    seen: set[Row] = set()
    out = []
    for row in rows:
        body = row[1].strip("\x20\x09\x0a\x0b\x0c\x0d")
        out.append("blank" if not body else "duplicate" if row in seen else "" if body[-1] in ".!?" else "truncated")
        seen.add(row)
    return out


def illegal_pairs(rows: list[Row]) -> int:
    """Neighbours whose roles' initials may not follow each other."""
    initials = [role[:1] for role, _ in rows]
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def incumbent(initials: list[str], found: list[str]) -> int:
    """Cost of a simple repair: bad rows go, the others alternate from the first on."""
    good = [i for i, fault in zip(initials, found) if not fault]
    cost = DELETE * (len(initials) - len(good))
    rest = good[1:] if good[:1] == ["s"] and len(good) > 2 else good
    cost += DELETE * (len(rest) % 2)
    return cost + REROLE * sum(i != "ua"[n % 2] for n, i in enumerate(rest[: len(rest) // 2 * 2]))


class Alignment:
    """The table of one conversation, filled from its last row on.

    cell (i, k): least cost of turning rows i.. into the last k symbols of a target; `before` is the same with the system
    turn still to come in front of them.
    """

    def __init__(self, initials: list[str], found: list[str]) -> None:
        self.initials, self.found = initials, found
        self.size = len(initials)
        kept = np.array([TRUNCATED if f == "truncated" else 0 if not f else NEVER for f in found], dtype=np.int64)
        self.kept = kept
        good = (kept == 0).astype(np.int64)
        # Good rows from i on: with no drift the rest of a target has as many symbols.
        self.good = np.append(np.cumsum(good[::-1])[::-1], 0)
        slack = incumbent(initials, found) - DELETE * int(self.size - good.sum())
        # A symbol less costs a deletion, one more at least what a truncated row costs above its deletion;
        # one row may be the system turn, which isn't among the symbols.
        self.low = np.maximum(0, self.good - slack // DELETE - 1)
        self.high = self.good + slack // min(INSERT, TRUNCATED - DELETE)
        self.step = max(STEP, math.isqrt(self.size))
        self.marks = self._fill(self.size, 0, self._end(), lambda i: i % self.step == 0 or i == self.size)

    def _end(self) -> tuple[np.ndarray, np.ndarray]:
        symbols = np.arange(self.low[self.size], self.high[self.size] + 1)
        return INSERT * symbols, np.full(len(symbols), NEVER, dtype=np.int64)

    def place(self, i: int, symbol: str) -> int:
        """Cost of making row i the target's next symbol."""
        return int(self.kept[i]) + (0 if self.initials[i] == symbol else REROLE if symbol in ROLES else NEVER)

    def _fill(self, start: int, stop: int, row: tuple[np.ndarray, np.ndarray], wanted: Callable[[int], bool]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Rows start..stop (downwards) of the table, given row `start`; those that are wanted."""
        out = {start: row} if wanted(start) else {}
        after, before = row
        for i in range(start - 1, stop - 1, -1):
            low, high = int(self.low[i]), int(self.high[i])
            shift, width = low - int(self.low[i + 1]), high - low + 1
            # The row below, from one symbol under this row's band on.
            wide = np.full(width + 2, NEVER, dtype=np.int64)
            own = after[max(0, shift - 1) : shift + width]
            place = max(0, 1 - shift)
            wide[place : place + len(own)] = own
            symbols = np.arange(low, high + 1)
            user, assistant = self.place(i, "u"), self.place(i, "a")
            used = wide[:width] + np.where(symbols % 2 == 1, assistant, user)
            best = np.minimum(DELETE + wide[1 : width + 1], used)
            with_inserts = np.minimum.accumulate(best - INSERT * symbols) + INSERT * symbols
            deleted = np.full(width, NEVER, dtype=np.int64)
            ahead = before[shift : shift + width]
            deleted[: len(ahead)] = ahead + DELETE
            led = np.where(symbols >= 2, wide[1 : width + 1] + self.place(i, "s"), NEVER)
            after, before = np.minimum(with_inserts, NEVER), np.minimum(np.minimum(deleted, led), NEVER)
            if wanted(i):
                out[i] = (after, before)
        return out

    def _cheapest(self) -> tuple[int, list[tuple[bool, int]]]:
        """The least cost, and the targets (system turn in front, symbols after it) that have it."""
        after, before = self.marks[0]
        symbols = np.arange(self.low[0], self.high[0] + 1)
        even = symbols % 2 == 0
        cost = int(min(after[even].min(), before[even].min(initial=NEVER)))
        return cost, [(led, int(k)) for led, row in ((False, after), (True, before)) for k in symbols[even & (row == cost)]]

    def _next(self, i: int, k: int, led: bool, here, below) -> tuple[str, int, int, bool]:
        """The edit with the least initial among the cheapest: edit, next row, next symbols, system turn still to come."""

        def at(row, where: int, number: int) -> int:
            place = number - int(self.low[where])
            return int(row[place]) if 0 <= place < len(row) else NEVER

        cost = at(here[led], i, k)
        if i < self.size and DELETE + at(below[led], i + 1, k) == cost:
            return "D", i + 1, k, led
        if led:
            return "K", i + 1, k, False
        if k and INSERT + at(here[0], i, k - 1) == cost:
            return "I", i, k - 1, False
        return "K" if self.initials[i] == ("a" if k % 2 else "u") else "R", i + 1, k - 1, False

    def best(self) -> tuple[int, str, bool, int]:
        """Least cost, least audit, and its target."""
        cost, targets = self._cheapest()
        walks = [["", 0, k, led, (led, k)] for led, k in targets]
        for start in range(0, self.size + 1, self.step):
            stop = min(start + self.step, self.size)
            rows = self._fill(stop, start, self.marks[stop] if stop in self.marks else self._end(), lambda i: True)
            last = stop == self.size
            for walk in walks:
                edits, (i, k, led) = [], walk[1:4]
                while i < stop or (last and k):
                    edit, i, k, led = self._next(i, k, led, rows[i], rows.get(i + 1))
                    edits.append(edit)
                walk[:4] = [walk[0] + "".join(edits), i, k, led]
            least = min(w[0] for w in walks)
            # A walk that is not the start of the least one, nor started by it, has lost.
            walks = [w for w in walks if w[0] == least or w[0].startswith(least)]
            if last:
                break
        audit, _, _, _, (led, k) = min(walks, key=lambda w: w[0])
        return cost, audit, led, k


def repaired_rows(rows: list[Row], audit: str, led: bool, symbols: int) -> list[Row]:
    """The rows that an audit leaves, for a target of `symbols` symbols, after a system turn or not."""
    out: list[Row] = []
    at = 0
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        if led:
            led = False
            out.append(rows[at])
            at += 1
            continue
        role = ROLES["a" if symbols % 2 else "u"]
        symbols -= 1
        if edit == "I":
            out.append((role, ""))
            continue
        out.append(rows[at] if edit == "K" else (role, rows[at][1]))
        at += 1
    return out


def repair_rows(turns: list[int | None], rows: list[Row]) -> dict:
    """All results for one conversation's rows in order."""
    found = faults(rows)
    numbers = {t for t in turns if t is not None}
    cost, audit, led, symbols = Alignment([role[:1] for role, _ in rows], found).best()
    return {
        "gaps": max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
        "blank": found.count("blank"), "duplicate": found.count("duplicate"), "truncated": found.count("truncated"),
        "illegal": illegal_pairs(rows), "cost": cost, "audit": audit,
        "repaired": [{"role": r, "text": t} for r, t in repaired_rows(rows, audit, led, symbols)],
    }


_TURN = pa.struct([("role", pa.string()), ("text", pa.string())])
_RESULT = pa.schema([
    ("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
    ("audit", pa.string()), ("repaired", pa.list_(_TURN)),
])
RESULT = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired array<struct<role:string,text:string>>"
)
# Characters of results that are handed on together.
ENOUGH = 4 << 20


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of whole conversations to one row per conversation."""
    done: list[dict] = []
    size = 0
    current: object = _repair
    turns: list[int | None] = []
    rows: list[Row] = []

    def finish() -> None:
        nonlocal size
        if rows:
            done.append({"conv_id": current, **repair_rows(turns, rows)})
            size += sum(len(t) for _, t in rows) + 200

    for batch in batches:
        for conv, turn, role, text in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
            if conv != current:
                finish()
                current, turns, rows = conv, [], []
                if size > ENOUGH:
                    yield pa.RecordBatch.from_pylist(done, schema=_RESULT)
                    done, size = [], 0
            turns.append(turn)
            rows.append((role, text))
    finish()
    if done:
        yield pa.RecordBatch.from_pylist(done, schema=_RESULT)


def _plain(turns: DataFrame) -> DataFrame:
    """The four columns, null texts and roles as one space."""
    return turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
    )


def repair(turns: DataFrame) -> DataFrame:
    """One row per conversation: faults, cost, audit, and the repaired turns as an array of (role, text)."""
    sorted_rows = _plain(turns).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return sorted_rows.mapInArrow(_repair, RESULT)


def damage(turns: DataFrame) -> DataFrame:
    """Rows damaged by crc32(`conv_id:turn`) % 20: 0 drops, 1 empties, 2 takes `.!?` out, 3 repeats, 4 makes the role user."""
    rows = _plain(turns)
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    case = F.crc32(key.cast("binary")) % 20
    marked = rows.withColumn("case", case).filter("case <> 0")
    text = F.when(F.col("case") == 1, "").when(F.col("case") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("case") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(1), F.when(F.col("case") == 3, 2).otherwise(1)))
    return marked.withColumn("copy", copies).select("conv_id", "turn", role.alias("role"), text.alias("text"))


def report(turns: DataFrame) -> DataFrame:
    """The damaged conversations' faults and repairs as digests, with a row for every conversation of `turns`."""
    found = repair(damage(turns))
    lines = F.array_join(F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    digests = found.withColumn("digest", F.sha2(lines.cast("binary"), 256)).drop("repaired").withColumnRenamed("conv_id", "__conv")
    every = turns.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    joined = every.join(digests, F.col("conv_id").eqNullSafe(F.col("__conv")), "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select(
        "conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("digest", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
