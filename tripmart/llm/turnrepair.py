"""Conversation structure repair by iterative-deepening A*.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``.  Edits go
through its rows in order: Keep a row (0), Rerole it to user or assistant (1), Delete it (2,
the only way with blank and repeated rows), Insert an empty user or assistant text before a
row or at the end (5); a truncated row that is not deleted costs 5 more.  What a Rerole or an
Insert gives follows from the state the initials are in, so a string of edit initials names
one repair.  The cheapest string is wanted, and of those the ASCII-least.

The search goes depth first through the edits in ASCII order (D, I, K, R) under a bound on
the cost, and raises the bound to the least cost at which something was cut off.  A table
keeps for each failed (row, state) the least cost that is still needed from there.  The
first string that is accepted is the answer.

Rows are ordered by a range sort over all partitions and cut into segments of ``SEGMENT``
rows wherever that falls; a task sees one segment at a time.  Conversations inside a segment
are searched whole.  One that is cut gives a piece in each of its segments: the cheapest,
ASCII-least string from each state to each state.  Pieces are chained ``FAN`` at a time, level
by level, and the choice is handed down again.  A string of a piece ends with the edit of
its last row, so no string of a piece begins another one, and the order of whole strings is that
of the first piece in which they differ.  So one conversation may hold any share of the rows.

Defined results: null text, role, conv_id and turn are one space where they are read as
text; a row whose role is empty or begins with another letter than s, u, a cannot be kept;
rows of equal turn are ordered by role, then by the hash of their text; a null conv_id is a
conversation of its own; a conversation whose rows are all gone has zeros, an empty audit and
the hash of the empty string; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import batches, held, positions

#: Rows that one search sees at most, and pieces that one task chains at once.
SEGMENT, FAN = 128, 256
#: Segments of a task as long as that takes at most so many tasks.
TASK_SEGMENTS, TASKS = 64, 10_000
SPACE = " \t\n\x0b\x0c\r"
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
#: States of the initials: nothing yet, after s, after u, after a.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEVER = 1 << 40
#: A row for the search: its initial (or a dash) and whether it is whole, truncated or has to go.
WHOLE, CUT, BAD = range(3)


def kept_state(state: int, initial: str) -> int | None:
    """The state after a row of this initial is kept, if it may be."""
    if initial == "s":
        return SYSTEM if state == NOTHING else None
    if initial == "u":
        return USER if state != USER else None
    if initial == "a":
        return ASSISTANT if state == USER else None
    return None


def given_state(state: int) -> int:
    """The state after a Rerole or an Insert."""
    return ASSISTANT if state == USER else USER


class Search:
    """Cheapest, ASCII-least edits of rows from a state to a state (or, ``goal`` None, to a whole conversation)."""

    def __init__(self, initials: str, kinds: list[int], goal: int | None):
        self.initials, self.kinds, self.goal, self.n = initials, kinds, goal, len(kinds)
        self.least = [0] * (self.n + 1)  # what the rows from here on cost in any case
        for i in range(self.n - 1, -1, -1):
            self.least[i] = self.least[i + 1] + (DELETE if kinds[i] != WHOLE else 0)
        self.needed: dict[tuple[int, int], int] = {}

    def best(self, state: int) -> tuple[int, str] | None:
        if not self._possible(state):
            return None
        bound = self.least[0]
        while True:
            self.path: list[str] = []
            short = self._descend(0, state, bound)
            if not short:
                return bound, "".join(self.path)
            bound += short

    def _possible(self, state: int) -> bool:
        if self.goal is None or self.goal in (USER, ASSISTANT):
            return True
        if self.goal == NOTHING or state == SYSTEM:
            return state == self.goal
        return state == NOTHING and any(c == "s" and k != BAD for c, k in zip(self.initials, self.kinds))

    def _descend(self, i: int, state: int, left: int) -> int:
        """0 if the rows from ``i`` on end well within ``left`` (then ``path`` holds the edits), else what is missing at least."""
        if i == self.n and (state in (NOTHING, ASSISTANT) if self.goal is None else state == self.goal):
            return 0
        need = self.needed.get((i, state), self.least[i])
        if need > left:
            return need - left
        short = NEVER
        for edit, cost, to_row, to_state in self._edits(i, state):
            self.path.append(edit)
            missing = self._descend(to_row, to_state, left - cost) if cost <= left else cost - left
            if not missing:
                return 0
            self.path.pop()
            short = min(short, missing)
        self.needed[i, state] = left + short
        return short

    def _edits(self, i: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        """Edits in ASCII order: (initial, cost, row, state)."""
        if i < self.n:
            yield "D", DELETE, i + 1, state
        if i < self.n or self.goal is None:
            yield "I", INSERT, i, given_state(state)
        if i < self.n and self.kinds[i] != BAD:
            extra = TRUNCATED if self.kinds[i] == CUT else 0
            to = kept_state(state, self.initials[i])
            if to is not None:
                yield "K", extra, i + 1, to
            yield "R", REROLE + extra, i + 1, given_state(state)


def script(state: int, edits: str, initials: str) -> Iterator[tuple[int, int, str, str | None]]:
    """(row, place, edit, role given) of a string of edits.

    A row's own edit has place 0; Inserts stand before the row, at the places below 0.
    """
    i, waiting = 0, 0
    for at, edit in enumerate(edits):
        if edit == "I":
            rest = edits[at:]
            waiting = waiting or len(rest.lstrip("I")) - len(rest)
        role = None
        if edit in "IR":
            state = given_state(state)
            role = "user" if state == USER else "assistant"
        elif edit == "K":
            state = kept_state(state, initials[i])
        yield i, waiting if edit == "I" else 0, edit, role
        waiting = waiting + 1 if edit == "I" else 0
        i += edit != "I"


# --- pieces of conversations that are cut -------------------------------------------------


def options(initials: str, kinds: list[int]) -> tuple[list[int], list[int], list[str]]:
    """For each of 16 (from, to): cost, rank among the strings from there, string; cost -1 where there is none."""
    searches = [Search(initials, kinds, b) for b in range(4)]  # their tables serve every start
    found = [[searches[b].best(a) for b in range(4)] for a in range(4)]
    cost, rank, path = [], [], []
    for row in found:
        order = sorted(range(4), key=lambda b: row[b][1] if row[b] else "")
        for b in range(4):
            cost.append(row[b][0] if row[b] else -1)
            rank.append(order.index(b))
            path.append(row[b][1] if row[b] else "")
    return cost, rank, path


def chain(pieces: list[tuple[list[int], list[int]]], start: int, end: int) -> tuple[int, list[int]] | None:
    """Cost and the states after each piece of the best way through (cost, rank) pieces."""
    togo = [[NEVER] * 4 for _ in range(len(pieces) + 1)]
    togo[-1][end] = 0
    for k in range(len(pieces) - 1, -1, -1):
        cost = pieces[k][0]
        for a in range(4):
            togo[k][a] = min((cost[4 * a + b] + togo[k + 1][b] for b in range(4) if cost[4 * a + b] >= 0), default=NEVER)
    if togo[0][start] >= NEVER:
        return None
    states, a = [], start
    for k, (cost, rank) in enumerate(pieces):
        a, _ = min(
            ((b, rank[4 * a + b]) for b in range(4) if cost[4 * a + b] >= 0 and cost[4 * a + b] + togo[k + 1][b] == togo[k][a]),
            key=lambda x: x[1],
        )
        states.append(a)
    return togo[0][start], states


def chained(pieces: list[tuple[list[int], list[int]]]) -> tuple[list[int], list[int]]:
    """Several pieces in a row as one."""
    cost, rank = [], []
    for a in range(4):
        ways = [chain(pieces, a, b) for b in range(4)]
        keys = []
        for way in ways:
            states = way[1] if way else []
            keys.append([pieces[k][1][4 * s + t] for k, (s, t) in enumerate(zip([a, *states], states))])
        order = sorted(range(4), key=lambda b: keys[b])
        cost += [way[0] if way else -1 for way in ways]
        rank += [order.index(b) for b in range(4)]
    return cost, rank


def ending(cost: list[int], rank: list[int]) -> tuple[int, str]:
    """State after the last row, and the Inserts that then end a whole conversation best."""
    more = {NOTHING: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
    best = min((b for b in range(4) if cost[b] >= 0), key=lambda b: (cost[b] + INSERT * more[b], rank[b]))
    return best, "I" * more[best]


# --- rows ---------------------------------------------------------------------------------


def text_or_space(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage that each row's checksum asks for."""
    fault = F.crc32(F.concat(text_or_space("conv_id"), F.lit(":"), text_or_space("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text_or_space("role").alias("role"), text_or_space("text").alias("text"), fault.alias("f"))
    rows = rows.where("f <> 0").select(
        "conv_id", "turn",
        F.when(F.col("f") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("f") == 1, "").when(F.col("f") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("f") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return rows.drop("copy")


def ordered(rows: DataFrame) -> DataFrame:
    """Rows with their place in all rows (``position``) and a hash of their text, in the shared folder."""
    hashed = rows.withColumn("same", F.unhex(F.md5("text")))
    return positions(hashed, F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "same")


def judged(rows: DataFrame) -> DataFrame:
    """Small rows (conv_id, turn, position, initial, kind, blank, duplicate, truncated) of ordered rows."""
    body = F.btrim(F.col("text"), F.lit(SPACE))
    first = F.substring("role", 1, 1)
    light = rows.select(
        "conv_id", "turn", "position", "role", "same",
        F.when(first.isin("s", "u", "a"), first).otherwise("-").alias("initial"),
        (body == "").alias("blank"), (~F.substring(body, -1, 1).isin(".", "!", "?")).alias("open"),
    )
    # only texts that occur again in their conversation; copies are combined before the shuffle
    again = (
        light.where("NOT blank").groupBy("conv_id", "role", "same")
        .agg(F.min("position").alias("first_at"), F.count(F.lit(1)).alias("times")).where("times > 1")
        .select(F.col("conv_id").alias("__c"), F.col("role").alias("__r"), F.col("same").alias("__s"), "first_at")
    )
    found = light.join(
        again, F.col("conv_id").eqNullSafe(F.col("__c")) & (F.col("role") == F.col("__r")) & (F.col("same") == F.col("__s")), "left"
    )
    duplicate = F.coalesce(~F.col("blank") & (F.col("position") > F.col("first_at")), F.lit(False))
    return found.select(
        "conv_id", "turn", "position", "initial", "blank", duplicate.alias("duplicate"),
        (~F.col("blank") & ~duplicate & F.col("open")).alias("truncated"),
    ).withColumn("kind", F.when(F.col("blank") | F.col("duplicate"), BAD).when(F.col("truncated"), CUT).otherwise(WHOLE))


def segments(light: DataFrame) -> DataFrame:
    """Rows by segment, each segment with the last row before it and the first one after it as ghosts."""
    at = (F.col("position") / SEGMENT).cast("long")
    cols = ["conv_id", "turn", "position", "initial", "kind", "blank", "duplicate", "truncated"]
    own = light.select(at.alias("segment"), *cols, F.lit(False).alias("ghost"))
    last = light.where((F.col("position") + 1) % SEGMENT == 0).select((at + 1).alias("segment"), *cols, F.lit(True).alias("ghost"))
    first = light.where(F.col("position") % SEGMENT == 0).select((at - 1).alias("segment"), *cols, F.lit(True).alias("ghost"))
    # a number of its own: rows are small and their search is not, so tasks merged by bytes would be few
    tasks = min(TASKS, 1 + light.count() // (SEGMENT * TASK_SEGMENTS))
    return own.unionByName(last).unionByName(first).repartition(tasks, "segment").sortWithinPartitions("segment", "position")


FOUND = (
    "kind string, conv_id bigint, segment bigint, position bigint, place int, edit string, role string, cost bigint, "
    "illegal bigint, initials string, costs array<bigint>, ranks array<int>, paths array<string>"
)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "array<bigint>": pa.list_(pa.int64()),
             "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in ddl.split(", ")])


def _edit_cost(edit: str, kind: int) -> int:
    own = {"D": DELETE, "I": INSERT, "K": 0, "R": REROLE}[edit]
    return own + (TRUNCATED if edit in "KR" and kind == CUT else 0)


def searched(rows: DataFrame) -> DataFrame:
    """What the segments give: ``edit`` rows of conversations searched whole, ``piece`` rows of
    those that are cut, and ``stat`` rows with the illegal neighbours of each conversation."""
    schema = _arrow(FOUND)
    legal = {"su", "ua", "au"}

    def row(**x):
        return tuple(x.get(name) for name in schema.names)

    def solve(segment, conv_id, own, before, after):
        """``own``: (position, initial, kind) rows; before, after: the neighbouring rows if they are of this conversation."""
        initials = "".join(r[1] for r in own)
        line = (before or "") + initials
        illegal = sum(line[i : i + 2] not in legal for i in range(len(line) - 1))
        if illegal:
            yield row(kind="stat", conv_id=conv_id, illegal=illegal)
        kinds = [r[2] for r in own]
        first = own[0][0]
        if before is None and not after:
            _, path = Search(initials, kinds, None).best(NOTHING)
            for i, place, edit, role in script(NOTHING, path, initials):
                yield row(kind="edit", conv_id=conv_id, position=first + i, place=place, edit=edit, role=role,
                          cost=_edit_cost(edit, kinds[i] if i < len(kinds) else WHOLE))
        else:
            costs, ranks, paths = options(initials, kinds)
            yield row(kind="piece", conv_id=conv_id, segment=segment, position=first, initials=initials,
                      edit="".join(map(str, kinds)), costs=costs, ranks=ranks, paths=paths)

    def run(batches_in):
        def conversations():
            """(segment, conv_id, rows, initial of the row before, whether rows follow) of each one in each segment."""
            key, own, before, after = None, [], None, False
            for batch in batches_in:
                for segment, conv_id, position, initial, kind, ghost in zip(*(c.to_pylist() for c in batch.columns)):
                    if (segment, conv_id) != key:
                        if own:
                            yield *key, own, before, after
                        key, own, before, after = (segment, conv_id), [], None, False
                    if not ghost:
                        own.append((position, initial, kind))
                    elif own:
                        after = True
                    else:
                        before = initial
            if own:
                yield *key, own, before, after

        yield from batches((r for c in conversations() for r in solve(*c)), schema, 2048)

    return rows.select("segment", "conv_id", "position", "initial", "kind", "ghost").mapInArrow(run, FOUND)


LEVEL = "conv_id bigint, at bigint, costs array<bigint>, ranks array<int>"


def _grouped(batches_in, keys: int):
    """(key, rows) of runs of rows that agree in their first columns."""
    key, own = None, []
    for batch in batches_in:
        for values in zip(*(c.to_pylist() for c in batch.columns)):
            if not own or values[:keys] != key:
                if own:
                    yield key, own
                key, own = values[:keys], []
            own.append(values[keys:])
    if own:
        yield key, own


def _up(level: DataFrame) -> DataFrame:
    """One level of chaining: FAN neighbouring pieces of a conversation become one."""
    schema = _arrow(LEVEL)

    def run(batches_in):
        def rows():
            for (conv_id, parent), own in _grouped(batches_in, 2):
                yield conv_id, parent, *chained([(c, r) for _, c, r in own])

        yield from batches(rows(), schema)

    return (
        level.withColumn("parent", (F.col("at") / FAN).cast("long")).repartition("conv_id", "parent")
        .sortWithinPartitions("conv_id", "parent", "at").select("conv_id", "parent", "at", "costs", "ranks").mapInArrow(run, LEVEL)
    )


CHOSEN = "conv_id bigint, at bigint, state int, goal int, tail string"


def _down(level: DataFrame, chosen: DataFrame) -> DataFrame:
    """The states between which each piece of a level goes, from those of its parents."""
    schema = _arrow(CHOSEN)

    def run(batches_in):
        def rows():
            for (conv_id, _), own in _grouped(batches_in, 2):
                start, end, tail = own[0][3:]
                _, states = chain([(r[1], r[2]) for r in own], start, end)
                for k, (r, a, b) in enumerate(zip(own, [start, *states], states)):
                    yield conv_id, r[0], a, b, tail if k == len(own) - 1 else ""

        yield from batches(rows(), schema)

    up = chosen.select(F.col("conv_id").alias("__c"), F.col("at").alias("__p"), "state", "goal", "tail")
    parent = (F.col("at") / FAN).cast("long")
    return (
        level.withColumn("parent", parent).join(up, F.col("conv_id").eqNullSafe(F.col("__c")) & (F.col("parent") == F.col("__p")))
        .repartition("conv_id", "parent").sortWithinPartitions("conv_id", "parent", "at")
        .select("conv_id", "parent", "at", "costs", "ranks", "state", "goal", "tail").mapInArrow(run, CHOSEN)
    )


def _settled(pieces: DataFrame) -> DataFrame:
    """``pieces`` of cut conversations with (state, goal, tail): the states each one goes between,
    and the Inserts after the last one."""
    starts = pieces.groupBy("conv_id").agg(F.min("segment").alias("__from")).withColumnRenamed("conv_id", "__c")
    placed = held(
        pieces.join(starts, F.col("conv_id").eqNullSafe(F.col("__c")))
        .withColumn("at", F.col("segment") - F.col("__from")).drop("__c", "__from")
    )
    levels = [placed.select("conv_id", "at", "costs", "ranks")]
    while (levels[-1].agg(F.max("at")).first()[0] or 0) > 0:  # one row
        levels.append(held(_up(levels[-1])))
    schema = _arrow(CHOSEN)

    def top(batches_in):
        def rows():
            for batch in batches_in:
                for conv_id, at, costs, ranks in zip(*(c.to_pylist() for c in batch.columns)):
                    goal, tail = ending(costs[:4], ranks[:4])
                    yield conv_id, at, NOTHING, goal, tail

        yield from batches(rows(), schema)

    chosen = levels[-1].mapInArrow(top, CHOSEN)
    for level in reversed(levels[:-1]):
        chosen = held(_down(level, chosen))
    named = chosen.select(F.col("conv_id").alias("__c"), F.col("at").alias("__at"), "state", "goal", "tail")
    return placed.join(named, F.col("conv_id").eqNullSafe(F.col("__c")) & (F.col("at") == F.col("__at")))


SCRIPT = "conv_id bigint, position bigint, place int, edit string, role string, cost bigint"


def scripts(found: DataFrame) -> DataFrame:
    """(conv_id, position, place, edit, role, cost): every edit of every conversation in order."""
    schema = _arrow(SCRIPT)

    def run(batches_in):
        def rows():
            for batch in batches_in:
                for conv_id, first, initials, kinds, paths, state, goal, tail in zip(*(c.to_pylist() for c in batch.columns)):
                    for i, place, edit, role in script(state, paths[4 * state + goal] + tail, initials):
                        kind = int(kinds[i]) if i < len(kinds) else WHOLE
                        yield conv_id, first + i, place, edit, role, _edit_cost(edit, kind)

        yield from batches(rows(), schema)

    whole = found.where("kind = 'edit'").select("conv_id", "position", "place", "edit", "role", "cost")
    pieces = found.where("kind = 'piece'").select("conv_id", "segment", "position", "initials", F.col("edit").alias("kinds"), "costs", "ranks", "paths")
    cut = _settled(pieces).select("conv_id", "position", "initials", "kinds", "paths", "state", "goal", "tail").mapInArrow(run, SCRIPT)
    return whole.unionByName(cut)


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edits, faults) of conversation rows ``conv_id, turn, role, text``.

    ``edits(conv_id, position, place, edit, cost, role, text)``: every edit in order of (position,
    place); role and text are those of the repaired row, null where it is deleted.
    ``faults(conv_id, gaps, blank, duplicate, truncated, illegal)``: one row for each conversation.
    """
    at = ordered(rows)
    light = held(judged(at))
    found = held(searched(segments(light)))
    edits = scripts(found)
    texts = at.select(F.col("position").alias("__at"), F.col("role").alias("__role"), F.col("text").alias("__text"))
    # an Insert has a place of its own beside its row's text, and none of it
    joined = edits.join(texts, (F.col("position") == F.col("__at")) & (F.col("place") == 0), "left")
    stays = F.col("edit") != "D"
    edits = joined.select(
        "conv_id", "position", "place", "edit", "cost",
        F.when(stays, F.coalesce("role", "__role")).alias("role"),
        F.when(stays, F.coalesce("__text", F.lit(""))).alias("text"),
    )
    turns = light.groupBy("conv_id", "turn").agg(
        F.count_if("blank").alias("blank"), F.count_if("duplicate").alias("duplicate"), F.count_if("truncated").alias("truncated")
    )
    counted = turns.groupBy("conv_id").agg(
        # null where a span is beyond a long
        F.coalesce(F.expr("try_add(try_subtract(max(turn), min(turn)), 1 - count(turn))"), F.lit(0)).alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
    )
    illegal = found.where("kind = 'stat'").groupBy(F.col("conv_id").alias("__c")).agg(F.sum("illegal").alias("illegal"))
    faults = counted.join(illegal, F.col("conv_id").eqNullSafe(F.col("__c")), "left").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", F.coalesce("illegal", F.lit(0)).alias("illegal")
    )
    return edits, faults


def digests(edits: DataFrame) -> DataFrame:
    """(conv_id, cost, audit, repaired_sha256): a conversation's edits go by one after the other and are not kept."""
    ddl = "conv_id bigint, cost bigint, audit string, repaired_sha256 string"
    schema = _arrow(ddl)

    def run(batches_in):
        def rows():
            key, state = None, None
            for batch in batches_in:
                for conv_id, edit, cost, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                    if state is None or conv_id != key:
                        if state:
                            yield key, state[0], "".join(state[1]), state[2].hexdigest()
                        key, state = conv_id, [0, [], hashlib.sha256(), False]
                    state[0] += cost
                    state[1].append(edit)
                    if edit != "D":
                        state[2].update((("\n" if state[3] else "") + role + ":" + text).encode())
                        state[3] = True
            if state:
                yield key, state[0], "".join(state[1]), state[2].hexdigest()

        yield from batches(rows(), schema)

    return (
        edits.repartition("conv_id").sortWithinPartitions("conv_id", "position", "place")
        .select("conv_id", "edit", "cost", "role", "text").mapInArrow(run, ddl)
    )


def report(conversations: DataFrame) -> DataFrame:
    """One row for each conv_id: faults after the damage, and the digest of its repair."""
    typed = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    edits, faults = repair(damaged(typed))
    repaired = digests(edits)
    ids = typed.select(F.col("conv_id").alias("__id")).distinct()
    both = faults.join(repaired.withColumnRenamed("conv_id", "__c"), F.col("conv_id").eqNullSafe(F.col("__c"))).drop("__c")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return ids.join(both, F.col("__id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("__id").alias("conv_id"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
