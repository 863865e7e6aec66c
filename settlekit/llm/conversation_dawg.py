"""Conversation repair: the cheapest edits that give legal turns, found once per shared suffix.

A conversation is reduced to a signature, one letter a row for its role and
fault. Signatures are read from the end: sorted by their reverse, neighbours
share a stretch of suffix, so a task that streams them in that order holds the
suffix-shared automaton of all its conversations as one path and adds a node
only where a suffix is new. A node keeps, for each state of the grammar
``(s?(ua)+)?``, the cost-to-go and the first edit of the best audit; the rest of
that audit is the next node's, so nothing is computed twice for conversations
that end alike, and equal signatures share everything.

Edits: Keep 0, Rerole to user or assistant 1, Delete 2 (required for blank and
duplicate rows), Insert an empty user or assistant row 5; a truncated row that
stays adds 5. In a (node, state) the possible edits have different letters, so
the ASCII-least of the cheapest audits takes the least letter at each step.

Cases. Null role or text: one space. Null turns sort first and don't count for
gaps. Rows of one turn are ordered by role, then by the MD5 of role and text, so
repeated rows are adjacent. A null conv_id is a conversation of its own. A role
with another initial (also upper case, or an empty role) can't be kept, only
reroled or deleted. A conversation without rows has zeros, an empty audit and
the hash of nothing; an empty table gives no rows. Other columns are ignored.

Scale: three shuffles (digests, signatures, texts); equal texts of a
conversation are found by a grouped minimum, signatures are dealt by range, so
copies of one conversation are split over tasks. A conversation's texts stream
through one task, as its hash needs them in order, but are never held: a task
keeps a byte a turn (its signature, its audit).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settlekit.session import stage_table

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5   # costs of edits
START, SYSTEM, USER, ASSISTANT = range(4)                 # states of the grammar: what was last
_NEXT = (USER, USER, ASSISTANT, USER)                     # the state that an inserted or reroled row leads to
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
_FOREVER = 1 << 60
END = ((0, 2 * INSERT, INSERT, 0), (" ", "I", "I", " "))  # the node behind the last row
BLANKS = " \t\n\x0b\x0c\r"


def node(letter: str, after: tuple) -> tuple:
    """Costs to go and first edits of the four states at a row, given the node after it.

    ``letter``: X for a row that must go, else the role's initial (o for any
    other), upper case if the row is truncated.
    """
    to_go = after[0]
    base, first = [], []
    initial, extra = letter.lower(), TRUNCATED if letter.isupper() else 0
    for state in range(4):
        best, edit = DELETE + to_go[state], "D"
        if letter != "X":
            kept = _KEPT.get(initial, {}).get(state)
            if kept is not None and KEEP + extra + to_go[kept] < best:
                best, edit = KEEP + extra + to_go[kept], "K"
            if REROLE + extra + to_go[_NEXT[state]] < best:
                best, edit = REROLE + extra + to_go[_NEXT[state]], "R"
        base.append(best)
        first.append(edit)
    cost = [0] * 4
    cost[USER] = min(base[USER], INSERT + base[ASSISTANT])
    cost[ASSISTANT] = min(base[ASSISTANT], INSERT + base[USER])
    cost[START] = min(base[START], INSERT + cost[USER])
    cost[SYSTEM] = min(base[SYSTEM], INSERT + cost[USER])
    for state in range(4):   # on a tie Insert beats Keep and Rerole, Delete beats Insert
        if INSERT + cost[_NEXT[state]] == cost[state] and (base[state] > cost[state] or first[state] != "D"):
            first[state] = "I"
    return tuple(cost), tuple(first)


class SuffixAutomaton:
    """The nodes of the current signature's suffixes; signatures come sorted by their reverse."""

    def __init__(self):
        self.nodes, self.read, self.made = [END], "", 0
        self.last = (0, "")
        self.known = {}   # (letter, node after) -> node: nodes with the same future are one

    def solve(self, reverse: str) -> tuple[int, str]:
        """(cost, audit) of the signature whose reverse this is."""
        if reverse == self.read and self.made:
            return self.last
        n, top = 0, min(len(reverse), len(self.read))
        while n < top and reverse[n] == self.read[n]:
            n += 1
        del self.nodes[n + 1:]
        for letter in reverse[n:]:
            after = self.nodes[-1]
            made = self.known.get((letter, after))
            if made is None:
                made = node(letter, after)
                if len(self.known) < 1 << 16:
                    self.known[letter, after] = made
            self.nodes.append(made)
        self.made += 1
        self.read, self.last = reverse, (self.nodes[-1][0][START], self._audit(reverse))
        return self.last

    def _audit(self, reverse: str) -> str:
        out, at, state = [], len(reverse), START
        while True:
            edit = self.nodes[at][1][state]
            if edit == " ":
                return "".join(out)
            out.append(edit)
            if edit in "IR":
                state = _NEXT[state]
            elif edit == "K":
                state = _KEPT[reverse[at - 1].lower()][state]
            at -= edit != "I"


# -- rows ---------------------------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """The rows with the faults that crc32(``conv_id:turn``) % 20 asks for; ``copies`` 0 means dropped."""
    def shown(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    code = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"),
                                code.alias("code"))
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(F.col("code") == 0, 0).when(F.col("code") == 3, 2).otherwise(1).alias("copies"))


def _rows(rows: DataFrame) -> DataFrame:
    """Typed rows with the hash that orders and identifies them."""
    copies = F.col("copies") if "copies" in rows.columns else F.lit(1)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    out = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                      role.alias("role"), text.alias("text"), copies.cast("int").alias("copies"))
    return out.withColumn("same", F.unhex(F.md5(F.concat(
        F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))))


def _letter() -> Column:
    """X, or the initial's class, upper case where the last character is no end of a sentence."""
    end = F.substring(F.rtrim(F.col("text"), F.lit(BLANKS)), -1, 1)
    first = F.substring("role", 1, 1)
    of = F.when(first.isin("s", "u", "a"), first).otherwise("o")
    return F.when(end == "", "X").when(end.isin(".", "!", "?"), of).otherwise(F.upper(of))


def _in_order(df: DataFrame, *first: str) -> DataFrame:
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *first, "turn", "role", "same")


_SIGNATURE = "conv_id long, reverse string, gaps long, blank long, duplicate long, truncated long, illegal long"


def _schema(ddl: str) -> pa.Schema:
    types = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(n, types[t]) for n, t in (c.split() for c in ddl.split(", "))])


def _batches(rows: Iterator[tuple], schema: pa.Schema, limit: int = 4096, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0
    for r in rows:
        held.append(r)
        chars += sum(len(v) for v in r if type(v) is str)
        if len(held) >= limit or chars >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _stream(batches) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


class _Reading:
    """One conversation's signature and counts, row by row."""

    __slots__ = ("id", "letters", "low", "high", "turns", "faults", "illegal", "before")

    def __init__(self, conv_id):
        self.id, self.letters = conv_id, bytearray()
        self.low = self.high = self.before = None
        self.turns, self.illegal, self.faults = 0, 0, [0, 0, 0]

    def add(self, turn, letter, initial, seen) -> None:
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += 1
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        if letter == "X":
            self.faults[0] += 1
        elif seen:
            self.faults[1] += 1
            letter = "X"
        elif letter.isupper():
            self.faults[2] += 1
        self.letters += letter.encode()

    def row(self) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (self.id, self.letters[::-1].decode(), gaps, *self.faults, self.illegal)


def signatures(rows: DataFrame) -> DataFrame:
    """Reversed signature and fault counts of each conversation."""
    rows = _rows(rows)
    # the first turn of each text that a conversation says more than once
    first = (rows.filter("copies > 0").groupBy("conv_id", "same")
             .agg(F.min(F.struct(F.col("turn").isNotNull().alias("told"), "turn")).alias("first"),
                  F.sum("copies").alias("n"))
             .filter("n > 1").select(F.col("conv_id").alias("c"), F.col("same").alias("s"), "first"))
    now = F.struct(F.col("turn").isNotNull().alias("told"), "turn")
    small = rows.select("conv_id", "turn", "role", "same", "copies", _letter().alias("letter"))
    told = (small.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("same") == F.col("s")), "left")
            .select("conv_id", "turn", "role", "same", "copies", "letter",
                    F.substring("role", 1, 1).alias("initial"),
                    F.coalesce(F.col("first") < now, F.lit(False)).alias("later")))

    def task(batches):
        def found():
            conv, last = None, None
            for conv_id, turn, _, same, copies, letter, initial, later in _stream(batches):
                if conv is None or conv.id != conv_id:
                    if conv is not None:
                        yield conv.row()
                    conv, last = _Reading(conv_id), None
                for _ in range(copies):
                    conv.add(turn, letter, initial, later or same == last)
                    last = same
            if conv is not None:
                yield conv.row()
        return _batches(found(), _schema(_SIGNATURE))

    return _in_order(told).mapInArrow(task, _SIGNATURE)


_PLAN = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def plans(signed: DataFrame) -> DataFrame:
    """Counts, cost and audit of each conversation, from its signature."""
    signed = stage_table(signed, "signatures")

    def task(batches):
        automaton = SuffixAutomaton()
        return _batches(((conv_id, *counts, *automaton.solve(reverse))
                         for conv_id, reverse, *counts in _stream(batches)), _schema(_PLAN))

    return (signed.repartitionByRange("reverse", "conv_id").sortWithinPartitions("reverse", "conv_id")
            .mapInArrow(task, _PLAN))


def _edited(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(plan, None) for each conversation, then (plan, (turn, role, text, edit)) for each row that it has in the end."""
    plan, audit, at, state, last = None, "", 0, START, None

    def inserted():
        nonlocal at, state
        while audit[at:at + 1] == "I":
            at, state = at + 1, _NEXT[state]
            yield plan, (None, _ROLE[state], "", "I")

    for conv_id, kind, turn, role, same, text, copies, *of in rows:
        if kind == 0:
            if plan is not None:
                yield from inserted()
            plan, audit, at, state, last = (conv_id, *of), of[-1], 0, START, None
            yield plan, None
            continue
        for _ in range(copies):
            yield from inserted()
            edit = audit[at]
            at += 1
            if edit == "D":
                continue
            if edit == "R":
                state = _NEXT[state]
                role = _ROLE[state]
            else:
                state = _KEPT[role[0]][state]
            yield plan, (turn, role, text, edit)
    if plan is not None:
        yield from inserted()


def _with_plans(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """Texts behind their conversation's plan, in order, a conversation in one partition."""
    of = [c.split()[0] for c in _PLAN.split(", ")][1:]
    kinds = dict(c.split() for c in _PLAN.split(", "))
    texts = _rows(rows).filter("copies > 0").select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", "same", "text", "copies",
        *[F.lit(None).cast(kinds[c]).alias(c) for c in of])
    none = F.lit(None)
    heads = planned.select("conv_id", F.lit(0).alias("kind"), none.cast("long").alias("turn"),
                           none.cast("string").alias("role"), none.cast("binary").alias("same"),
                           none.cast("string").alias("text"), F.lit(1).alias("copies"), *of)
    return _in_order(heads.unionByName(texts), "kind")


_REPAIRED = "conv_id long, position long, turn long, role string, text string, edit string"


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired conversations: (conv_id, position, turn, role, text, edit), inserted rows without a turn."""
    both = _with_plans(rows, plans(signatures(rows)))

    def task(batches):
        def out():
            position = 0
            for plan, row in _edited(_stream(batches)):
                if row is None:
                    position = 0
                else:
                    yield (plan[0], position, *row)
                    position += 1
        return _batches(out(), _schema(_REPAIRED))

    return both.mapInArrow(task, _REPAIRED)


def report(rows: DataFrame) -> DataFrame:
    """Counts, cost, audit and the SHA-256 of the repaired rows (``role:text``, a line each) of every conversation."""
    both = _with_plans(rows, plans(signatures(rows)))
    ddl = _PLAN + ", repaired_sha256 string"

    def task(batches):
        def out():
            plan, sha, empty = None, None, True
            for now, row in _edited(_stream(batches)):
                if row is None:
                    if plan is not None:
                        yield (*plan, sha.hexdigest())
                    plan, sha, empty = now, hashlib.sha256(), True
                    continue
                if not empty:
                    sha.update(b"\n")
                empty = False
                sha.update(f"{row[1]}:{row[2]}".encode())
            if plan is not None:
                yield (*plan, sha.hexdigest())
        return _batches(out(), _schema(ddl))

    return both.mapInArrow(task, ddl)
