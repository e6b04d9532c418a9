"""Conversations whose turns are missing, empty, repeated, cut off or out of order, repaired by
the cheapest edits.

A row is one of sixteen symbols: the initial of its role and its fault. Equal neighbours are
one run, and a run moves the costs of the four states of the grammar by one min-plus matrix,
whose binary powers are kept: a run of a million rows takes twenty steps. Choices are then
unrolled forwards, again by halves of runs.

Rows are dealt by ranges of (conversation, turn), so a conversation of any size is cut into
fragments that different tasks classify. What later steps pass from row to row are costs of
four states, a fragment at a time; texts are read again only to write or to hash the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeferry.scratch import written

#: Rows of a conversation that one fragment holds at most.
FRAGMENT_ROWS = 65_536
#: Rows that are unrolled with all their costs in memory.
UNROLLED_ROWS = 64
#: Characters of role and text that order rows of one turn before a hash of the whole does.
ORDER_CHARACTERS = 64

SPACE = " \t\n\x0b\x0c\r"
ROLES = ("system", "user", "assistant")
# What a row's first fault is, in the order in which they count.
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)

# What edits cost, and which initial leads from where to where. States: nothing
# yet, after the system's, the user's and the assistant's turn; the first and last may end it.
RETYPE, DELETE, INSERT, UNFINISHED = 1, 2, 5, 5
SYSTEM, USER, ASSISTANT, OTHER = range(4)
MOVES = ({SYSTEM: 1, USER: 2}, {USER: 2}, {ASSISTANT: 3}, {USER: 2})
ENDS = (0, 3)
STATES = range(4)
NEVER = 1 << 60

Costs = tuple[int, int, int, int]


def _inserted(state: int) -> tuple[int, int]:
    """(initial, state) of the turn that can be put in: never the system's."""
    return next((initial, after) for initial, after in MOVES[state].items() if initial != SYSTEM)


def _with_inserts(costs: list[int]) -> Costs:
    """Costs from each state when turns may be put in first. Two are enough: after them the
    grammar is where it was or where one of them led."""
    out = []
    for state in STATES:
        once = _inserted(state)[1]
        out.append(min(costs[state], INSERT + costs[once], 2 * INSERT + costs[_inserted(once)[1]]))
    return tuple(out)


def choices(symbol: int, state: int) -> Iterator[tuple[str, int, int, int]]:
    """(letter, cost, next state, initial) of what may be done with a row, letters ascending."""
    initial, fault = symbol >> 2, symbol & 3
    yield "D", DELETE, state, OTHER
    if fault in (BLANK, DUPLICATE):
        return
    unfinished = UNFINISHED if fault == TRUNCATED else 0
    if initial in MOVES[state]:
        yield "K", unfinished, MOVES[state][initial], initial
    for other, after in MOVES[state].items():
        if other not in (SYSTEM, initial):
            yield "R", unfinished + RETYPE, after, other


class Repairer:
    """Costs and choices over runs of symbols; keeps the powers of each symbol's matrix."""

    def __init__(self):
        self._powers: dict[tuple[int, int], tuple[Costs, ...]] = {}
        #: What is still to pay after the last row.
        self.end = _with_inserts([0 if state in ENDS else NEVER for state in STATES])

    def _power(self, symbol: int, k: int) -> tuple[Costs, ...]:
        """The matrix of 2**k rows of a symbol."""
        key = symbol, k
        if key not in self._powers:
            if k:
                half = self._power(symbol, k - 1)
                self._powers[key] = tuple(tuple(min(NEVER, *(a + half[m][q] for m, a in enumerate(row))) for q in STATES) for row in half)
            else:
                # Row by row of the transposed: what ends in one state, from each.
                rows = [[NEVER] * 4 for _ in STATES]
                for goal in STATES:
                    own = [min([cost for _, cost, after, _ in choices(symbol, q) if after == goal], default=NEVER) for q in STATES]
                    for q, cost in enumerate(_with_inserts(own)):
                        rows[q][goal] = cost
                self._powers[key] = tuple(map(tuple, rows))
        return self._powers[key]

    def before(self, symbol: int, count: int, after: Costs) -> Costs:
        """What is still to pay from each state before a run, by what is after it."""
        k = 0
        while count:
            if count & 1:
                after = tuple(min(a + b for a, b in zip(row, after, strict=True)) for row in self._power(symbol, k))
            count, k = count >> 1, k + 1
        return after

    @staticmethod
    def _one(symbol: int, state: int, here: Costs, after: Costs) -> tuple[str, int]:
        """The least letters for one row that cost what they must, and the state they lead to."""
        letters = ""
        while DELETE + after[state] != here[state]:
            put_in = _inserted(state)[1]
            if INSERT + here[put_in] != here[state]:
                return next((letters + letter, goal) for letter, cost, goal, _ in choices(symbol, state) if letter != "D" and cost + after[goal] == here[state])
            letters, state = letters + "I", put_in
        return letters + "D", state

    def unroll(self, symbol: int, count: int, state: int, after: Costs, out: list[str]) -> int:
        """Append the letters of a run to ``out``, one string for each row; the state after it."""
        if count > UNROLLED_ROWS:
            half = 1 << (count - 1).bit_length() - 1
            state = self.unroll(symbol, count - half, state, self.before(symbol, half, after), out)
            return self.unroll(symbol, half, state, after, out)
        costs = [after]
        for _ in range(count):
            costs.append(self.before(symbol, 1, costs[-1]))
        for left in range(count, 0, -1):
            letters, state = self._one(symbol, state, costs[left], costs[left - 1])
            out.append(letters)
        return state

    def walk(self, runs: list[tuple[int, int]], state: int, after: Costs) -> tuple[list[str], int]:
        """The letters of each row of the runs, and the state that they lead to."""
        costs = [after]
        for symbol, count in reversed(runs):
            costs.append(self.before(symbol, count, costs[-1]))
        out: list[str] = []
        for (symbol, count), behind in zip(runs, reversed(costs[:-1]), strict=True):
            state = self.unroll(symbol, count, state, behind, out)
        return out, state

    def before_all(self, runs: list[tuple[int, int]], after: Costs) -> Costs:
        for symbol, count in reversed(runs):
            after = self.before(symbol, count, after)
        return after

    def tail(self, state: int) -> str:
        """The letters after the last row."""
        return "I" * (self.end[state] // INSERT)


def letters_cost(symbols: list[int], letters: list[str]) -> int:
    total = 0
    for symbol, own in zip(symbols, letters, strict=True):
        total += INSERT * (len(own) - 1)
        total += DELETE if own[-1] == "D" else (UNFINISHED if symbol & 3 == TRUNCATED else 0) + (RETYPE if own[-1] == "R" else 0)
    return total


def _symbol(role: Column, text: Column) -> Column:
    """Initial and fault of a row by itself; whether it is a duplicate its conversation tells."""
    initial = F.left(role, F.lit(1))
    number = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER)
    end = F.right(F.rtrim(text, F.lit(SPACE)), F.lit(1))
    fault = F.when(end == "", BLANK).when(end.isin(".", "!", "?"), FINE).otherwise(TRUNCATED)
    return (number * 4 + fault).cast("byte")


FRAGMENTS = (
    "at long, n long, open boolean, symbols binary, counts array<int>, blank long, duplicate long, truncated long, illegal long, "
    "least long, greatest long, turns long"
)


def _ordered(rows: DataFrame) -> DataFrame:
    """A table of the rows with ``at``: consecutive inside a partition, ascending over all of
    them by conversation and turn."""
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("role", "text"))
    named = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    same = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    keyed = named.withColumns({"symbol": _symbol(F.col("role"), F.col("text")), "same": same, "number": F.monotonically_increasing_id()})
    order = [F.col("conv_id"), F.col("turn"), F.left("role", F.lit(ORDER_CHARACTERS)), F.left("text", F.lit(ORDER_CHARACTERS)), F.col("same"), F.col("number")]
    dealt = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(dealt.select(F.monotonically_increasing_id().alias("at"), "conv_id", "turn", "role", "text", "symbol", "same"), "turns")


def _fragments(ordered: DataFrame) -> DataFrame:
    """A row per conversation and partition of ``ordered``, more for long ones, with the runs
    of symbols. ``open``: the conversation may go on in another fragment."""
    spoken = ordered.where(F.col("symbol") % 4 != BLANK)
    firsts = spoken.groupBy("conv_id", "same").agg(F.min("at").alias("at"))
    null = lambda name: F.lit(None).cast(ordered.schema[name].dataType).alias(name)
    marked = ordered.select("at", F.lit(0).alias("mark"), "conv_id", "turn", "symbol").unionByName(
        firsts.select("at", F.lit(1).alias("mark"), null("conv_id"), null("turn"), null("symbol"))
    )
    part = F.shiftright("at", 33).cast("int")
    last = ordered.agg(F.max(part)).first()[0]
    dealt = marked.withColumn("part", part).repartitionById((last or 0) + 1, F.col("part")).sortWithinPartitions("at", "mark")

    def cut(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        schema = None
        names = [field.split()[0] for field in FRAGMENTS.split(", ")]

        def rows():
            """(at, conversation, turn, symbol), duplicates marked: those without a mark behind."""
            held = None
            for batch in batches:
                for at, mark, conv, turn, symbol, _ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if mark:
                        yield held
                        held = None
                        continue
                    if held:
                        yield (*held[:3], held[3] & ~3 | DUPLICATE) if held[3] & 3 != BLANK else held
                    held = at, conv, turn, symbol
            if held:
                yield (*held[:3], held[3] & ~3 | DUPLICATE) if held[3] & 3 != BLANK else held

        def fragment(own: list[tuple], opened: bool):
            symbols = [row[3] for row in own]
            runs = [(symbol, sum(1 for _ in same)) for symbol, same in groupby(symbols)]
            initials = np.array(symbols) >> 2
            pairs = initials[:-1] * 4 + initials[1:]
            legal = np.isin(pairs, [SYSTEM * 4 + USER, USER * 4 + ASSISTANT, ASSISTANT * 4 + USER])
            faults = np.bincount(np.array(symbols) & 3, minlength=4).tolist()
            turns = [row[2] for row in own if row[2] is not None]
            several = 1 + sum(a != b for a, b in zip(turns, turns[1:], strict=False)) if turns else 0
            least, greatest = (turns[0], turns[-1]) if turns else (None, None)
            values = (own[0][0], len(own), opened, bytes(s for s, _ in runs), [n for _, n in runs], faults[BLANK], faults[DUPLICATE],
                      faults[TRUNCATED], int((~legal).sum()), least, greatest, several)
            return own[0][1], values

        def emit(found):
            columns = [pa.array([conv for conv, _ in found], schema.field("conv_id").type)]
            columns += [pa.array(list(c), fields[name]) for name, c in zip(names, zip(*(v for _, v in found), strict=True), strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=["conv_id", *names])

        fields = dict.fromkeys(names, pa.int64()) | {"open": pa.bool_(), "symbols": pa.binary(), "counts": pa.list_(pa.int32())}

        def peeked():
            nonlocal schema, batches
            first = next(batches, None)
            if first is None:
                return
            schema = first.schema
            rest = batches
            batches = (b for part in ([first], rest) for b in part)
            yield from rows()

        found, own, first = [], [], True
        for row in peeked():
            if own and (row[1] != own[0][1] or len(own) >= FRAGMENT_ROWS):
                goes_on = row[1] == own[0][1]
                found.append(fragment(own, first or goes_on))
                first, own = goes_on, []
            own.append(row)
            if len(found) > 1000:
                yield emit(found)
                found = []
        if own:
            found.append(fragment(own, True))
        if found:
            yield emit(found)

    conv = ordered.select("conv_id").schema.fields[0].dataType.simpleString()
    return written(dealt.select("at", "mark", "conv_id", "turn", "symbol", "part").mapInArrow(cut, f"conv_id {conv}, {FRAGMENTS}"), "fragments")


EDITS = "at long, audit string, cost long, state int"


def _edit_rows(rows: list[tuple]):
    import pyarrow as pa

    kinds = pa.int64(), pa.string(), pa.int64(), pa.int32()
    columns = [pa.array(list(c), kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["at", "audit", "cost", "state"])


def _runs(symbols: bytes, counts: list[int]) -> list[tuple[int, int]]:
    return list(zip(symbols, counts, strict=True))


def _unrolled(repairer: Repairer, runs: list, state: int, after: Costs, is_last: bool) -> tuple[str, int, int]:
    letters, state = repairer.walk(runs, state, after)
    cost = letters_cost([s for s, n in runs for _ in range(n)], letters)
    tail = repairer.tail(state) if is_last else ""
    return "".join(letters) + tail, cost + INSERT * len(tail), state


def _closed_edits(fragments: DataFrame) -> DataFrame:
    """Edits of conversations that lie in one fragment, wherever that is."""

    def edit(batches: Iterator) -> Iterator:
        repairer = Repairer()
        for batch in batches:
            found = []
            for at, symbols, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                audit, cost, _ = _unrolled(repairer, _runs(symbols, counts), 0, repairer.end, True)
                found.append((at, audit, cost, 0))
            if found:
                yield _edit_rows(found)

    return fragments.where("NOT open").select("at", "symbols", "counts").mapInArrow(edit, EDITS)


def _open_edits(fragments: DataFrame) -> DataFrame:
    """Edits of conversations of several fragments: costs go backwards from fragment to
    fragment, then states go forwards. Fragments pass one by one; none is held."""
    some = fragments.where("open").select("conv_id", "at", "symbols", "counts")

    def backwards(batches: Iterator) -> Iterator:
        import pyarrow as pa

        repairer, last, after = Repairer(), None, None
        for batch in batches:
            for conv, at, symbols, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (conv,) != last:
                    last, after = (conv,), repairer.end
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([list(after)], pa.list_(pa.int64()))], names=["at", "after"])
                after = repairer.before_all(_runs(symbols, counts), after)

    costs = some.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("at")).mapInArrow(backwards, "at long, after array<long>")
    joined = some.join(written(costs, "costs"), "at").select("conv_id", "at", "symbols", "counts", "after")

    def forwards(batches: Iterator) -> Iterator:
        repairer, held, state = Repairer(), None, 0

        def edited(row, is_last):
            nonlocal state
            _, at, symbols, counts, after = row
            before = state
            audit, cost, state = _unrolled(repairer, _runs(symbols, counts), before, tuple(after), is_last)
            state = 0 if is_last else state
            return _edit_rows([(at, audit, cost, before)])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held:
                    yield edited(held, row[0] != held[0])
                held = row
        if held:
            yield edited(held, True)

    return joined.repartition("conv_id").sortWithinPartitions("conv_id", "at").mapInArrow(forwards, EDITS)


@dataclass(frozen=True)
class Repair:
    """Written tables of a repair: ``turns``, the rows in order, each with its place ``at``, and
    ``fragments`` of conversations with the letters of their edits (``audit``)."""

    turns: DataFrame
    fragments: DataFrame


def repair(rows: DataFrame) -> Repair:
    """The cheapest edits that give every conversation's roles the form system?, (user,
    assistant)*, of ``conv_id, turn, role, text``; other columns are not looked at.

    Rows count by turn, those without one first; rows of one turn by role and text. A null
    role or text is one space, so such a text is blank. A null ``conv_id`` is a conversation
    like any other. Rows that repeat are duplicates. A role's initial counts: what begins
    with another letter than s, u or a, or is empty, can only be changed or deleted. An empty
    table has no conversations. Texts of any length pass as they are; none is held beyond its
    own batch.
    """
    turns = _ordered(rows)
    fragments = _fragments(turns)
    edits = written(_closed_edits(fragments).unionByName(_open_edits(fragments)), "edits")
    return Repair(turns, written(fragments.join(edits, "at"), "repairs"))


def _stream(found: Repair, originals: DataFrame | None = None) -> DataFrame:
    """Fragments and rows in one table; a fragment (kind 1) goes before its rows (kind 2).
    ``originals``: conversations that shall have a row (kind 0) even without any other."""
    fragments = found.fragments.select("conv_id", "at", F.struct("audit", "cost", "state", "symbols", "blank", "duplicate", "truncated", "illegal", "least", "greatest", "turns").alias("fragment"))
    none = F.lit(None).cast(fragments.schema["fragment"].dataType).alias("fragment")
    blank = [F.lit(None).cast("string").alias(name) for name in ("role", "text")]
    both = fragments.select("conv_id", "at", F.lit(1).alias("kind"), *blank, "fragment").unionByName(
        found.turns.select("conv_id", "at", F.lit(2).alias("kind"), "role", "text", none)
    )
    if originals is not None:
        ids = originals.select("conv_id").distinct()
        both = both.unionByName(ids.select("conv_id", F.lit(-1).cast("long").alias("at"), F.lit(0).alias("kind"), *blank, none))
    return both


class Editor:
    """Lines of the repaired conversation, from letters and rows as they come."""

    def __init__(self):
        self.begin("", 0)

    def begin(self, letters: str, state: int) -> None:
        self.letters, self.state, self.place = letters, state, 0

    def inserts(self) -> Iterator[tuple[str, str, str]]:
        """The inserted turns up to the next letter of a row, or the end."""
        while self.place < len(self.letters) and self.letters[self.place] == "I":
            initial, self.state = _inserted(self.state)
            self.place += 1
            yield "I", ROLES[initial], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """(letter, role, text) of the turns that a row gives."""
        yield from self.inserts()
        letter = self.letters[self.place]
        self.place += 1
        if letter == "D":
            return
        if letter == "R":
            initial = _inserted(self.state)[0]
            role = ROLES[initial]
        else:
            initial = "sua".index(role[0])
        self.state = MOVES[self.state][initial]
        yield letter, role, text


def repaired_turns(found: Repair) -> DataFrame:
    """The repaired conversations as rows: ``conv_id, at, place, edit, role, text``, in order of
    ``at`` and ``place``. Each fragment is written by the task that has its range."""
    part = F.shiftright("at", 33).cast("int")
    last = found.turns.agg(F.max(part)).first()[0]
    dealt = _stream(found).withColumn("part", part).repartitionById((last or 0) + 1, F.col("part")).sortWithinPartitions("at", "kind")
    conv = found.turns.schema["conv_id"].dataType

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa

        editor = Editor()
        for batch in batches:
            out = []
            for conv_id, at, kind, role, text, fragment in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind == 1:
                    editor.begin(fragment["audit"], fragment["state"])
                    continue
                turns = list(editor.row(role, text))
                if not editor.letters[editor.place : editor.place + 3].strip("I"):  # two go before a row at most
                    turns += list(editor.inserts())
                out += [(conv_id, at, place, *turn) for place, turn in enumerate(turns)]
            if out:
                kinds = [batch.schema.field("conv_id").type, pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()]
                columns = [pa.array(list(c), kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "at", "place", "edit", "role", "text"])

    schema = f"conv_id {conv.simpleString()}, at long, place int, edit string, role string, text string"
    return dealt.select("conv_id", "at", "kind", "role", "text", "fragment").mapInArrow(write, schema)


SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def summaries(found: Repair, originals: DataFrame) -> DataFrame:
    """One row per conversation of ``originals``: what was wrong, what the repair costs, its
    letters and the SHA-256 of the repaired ``role:text`` lines.

    That hash and the letters are of a whole conversation, so its rows pass through one task,
    one after the other, and only the letters are held: SHA-256 cannot be put together from
    parts. All else about a conversation of any size is done by fragments.
    """
    stream = _stream(found, originals)
    dealt = stream.repartition("conv_id").sortWithinPartitions("conv_id", "at", "kind").select("conv_id", "kind", "role", "text", "fragment")

    def summarise(batches: Iterator) -> Iterator:
        import pyarrow as pa

        class Conversation:
            def __init__(self, conv):
                self.conv, self.editor, self.digest, self.lines = conv, Editor(), hashlib.sha256(), 0
                self.counts, self.letters = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0), []
                self.least = self.greatest = self.initial = None
                self.turns = 0

            def fragment(self, f):
                for name in self.counts:
                    self.counts[name] += f[name]
                first, last = f["symbols"][0] >> 2, f["symbols"][-1] >> 2
                legal = ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER))
                self.counts["illegal"] += self.initial is not None and (self.initial, first) not in legal
                self.initial = last
                if f["turns"]:
                    self.turns += f["turns"] - (f["least"] == self.greatest)
                    self.greatest = f["greatest"]
                    self.least = f["least"] if self.least is None else self.least
                self.letters.append(f["audit"])
                self.editor.begin(f["audit"], f["state"])

            def add(self, lines):
                for _, role, text in lines:
                    if self.lines:
                        self.digest.update(b"\n")
                    self.digest.update(role.encode() + b":")
                    self.digest.update(text.encode())
                    self.lines += 1

            def result(self):
                self.add(self.editor.inserts())
                gaps = self.greatest - self.least + 1 - self.turns if self.turns else 0
                return self.conv, gaps, *self.counts.values(), "".join(self.letters), self.digest.hexdigest()

        kinds = [pa.int64()] * 6 + [pa.string()] * 2

        def emit(results, conv_type):
            columns = [pa.array(list(c), kind) for c, kind in zip(zip(*results, strict=True), [conv_type, *kinds], strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=["conv_id", *(f.split()[0] for f in SUMMARY.split(", "))])

        own, results, conv_type = None, [], None
        for batch in batches:
            conv_type = batch.schema.field("conv_id").type
            for conv, kind, role, text, fragment in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own is None or own.conv != conv:
                    if own:
                        results.append(own.result())
                    own = Conversation(conv)
                if kind == 1:
                    own.fragment(fragment)
                elif kind == 2:
                    own.add(own.editor.row(role, text))
            if len(results) > 1000:
                yield emit(results, conv_type)
                results = []
        if own:
            results.append(own.result())
        if results:
            yield emit(results, conv_type)

    conv = found.turns.schema["conv_id"].dataType.simpleString()
    return dealt.mapInArrow(summarise, f"conv_id {conv}, {SUMMARY}")


# How rows are damaged, by the remainder of a hash.
DAMAGES, DROPPED, EMPTIED, UNSTOPPED, REPEATED, RETYPED = 20, 0, 1, 2, 3, 4


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with a twentieth of the rows each dropped, emptied, left
    without stops, repeated, or given to the user. Nulls count as one space."""
    part = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    key = F.concat(part("conv_id"), F.lit(":"), part("turn"))
    kept = rows.select("conv_id", "turn", part("role").alias("role"), part("text").alias("text"), (F.crc32(key) % DAMAGES).alias("kind")).where(F.col("kind") != DROPPED)
    text = F.when(F.col("kind") == EMPTIED, "").when(F.col("kind") == UNSTOPPED, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == RETYPED, "user").otherwise(F.col("role"))
    copies = F.array_repeat(F.lit(0), F.when(F.col("kind") == REPEATED, 2).otherwise(1))
    return kept.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """Damage all rows, repair them, and report on every conversation that there was."""
    return summaries(repair(damaged(conversations)), conversations)


ORACLE = """
WITH RECURSIVE bits AS (
  SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c
  FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i)),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(
      list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda s: CAST(unicode(s) AS BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS h
  FROM conversations, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END)) AS copy
  FROM keyed WHERE h <> 0),
placed AS (
  SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM damaged),
judged AS (
  SELECT *, left(role, 1) AS initial, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
faulty AS (
  SELECT *, CASE WHEN body = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM judged),
moves(q, c, q2) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
inserts(q, j, q2, added) AS (
  VALUES (0, 0, 0, []), (1, 0, 1, []), (2, 0, 2, []), (3, 0, 3, []),
         (0, 1, 2, ['user:']), (1, 1, 2, ['user:']), (2, 1, 3, ['assistant:']), (3, 1, 2, ['user:']),
         (0, 2, 3, ['user:', 'assistant:']), (1, 2, 3, ['user:', 'assistant:']), (2, 2, 2, ['assistant:', 'user:']), (3, 2, 3, ['user:', 'assistant:'])),
options AS (
  SELECT conv_id, i, q.q, q.q AS q2, 2 AS cost, 'D' AS letter, CAST([] AS VARCHAR[]) AS line FROM faulty, (VALUES (0), (1), (2), (3)) q(q)
  UNION ALL
  SELECT conv_id, i, q, q2, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END, 'K', [role || ':' || text]
  FROM faulty JOIN moves ON c = initial WHERE fault NOT IN ('blank', 'duplicate')
  UNION ALL
  SELECT conv_id, i, q, q2, CASE WHEN fault = 'truncated' THEN 6 ELSE 1 END, 'R', [CASE c WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text]
  FROM faulty JOIN moves ON c <> initial AND c <> 's' WHERE fault NOT IN ('blank', 'duplicate')),
paths AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS q, 0 AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS lines FROM (SELECT DISTINCT conv_id FROM placed)
  UNION ALL
  SELECT conv_id, i, q, cost, audit, lines FROM (
    SELECT p.conv_id, o.i, o.q2 AS q, p.cost + 5 * n.j + o.cost AS cost, p.audit || repeat('I', n.j) || o.letter AS audit,
           p.lines || n.added || o.line AS lines,
           row_number() OVER (PARTITION BY p.conv_id, o.q2 ORDER BY p.cost + 5 * n.j + o.cost, p.audit || repeat('I', n.j) || o.letter) AS best
    FROM paths p JOIN inserts n ON n.q = p.q JOIN options o ON o.conv_id IS NOT DISTINCT FROM p.conv_id AND o.i = p.i + 1 AND o.q = n.q2) WHERE best = 1),
ended AS (
  SELECT p.conv_id, p.cost + 5 * n.j AS cost, p.audit || repeat('I', n.j) AS audit, p.lines || n.added AS lines
  FROM paths p JOIN inserts n ON n.q = p.q JOIN (SELECT conv_id, max(i) AS n FROM placed GROUP BY conv_id) c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.n = p.i
  WHERE n.q2 IN (0, 3)
  QUALIFY row_number() OVER (PARTITION BY p.conv_id ORDER BY p.cost + 5 * n.j, p.audit || repeat('I', n.j)) = 1),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""
