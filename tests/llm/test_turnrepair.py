import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SF_SMALL
from tripmart.llm import turnrepair
from tripmart.llm.turnrepair import BAD, CUT, WHOLE

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def cheapest(initials, kinds):
    """All strings of edits by cost, row by row: (cost, string) of the best one."""
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    best = {"": (0, "")}

    def put(to, state, cost, path):
        if state not in to or (cost, path) < to[state]:
            to[state] = (cost, path)

    def with_inserts(best):
        for _ in range(3):
            for state, (cost, path) in list(best.items()):
                for role in "ua":
                    if role in step[state]:
                        put(best, step[state][role], cost + 5, path + "I")
        return best

    for initial, kind in zip(initials, kinds):
        to = {}
        for state, (cost, path) in with_inserts(best).items():
            put(to, state, cost + 2, path + "D")
            if kind != BAD:
                extra = 5 * (kind == CUT)
                if initial in step[state]:
                    put(to, step[state][initial], cost + extra, path + "K")
                for role in "ua":
                    if role in step[state]:
                        put(to, step[state][role], cost + 1 + extra, path + "R")
        best = to
    ends = with_inserts(best)
    return min(ends[s] for s in ("", "a") if s in ends)


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            key = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
            role, text = " " if role is None else role, " " if text is None else text
            fault = zlib.crc32(key.encode()) % 20
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            own += [] if fault == 0 else [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        seen, faults, kinds = set(), Counter(), []
        for _, role, text in own:
            body = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            kinds.append({"": WHOLE, "truncated": CUT}.get(fault, BAD))
        initials = [r[1][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        turns = [r[0] for r in own if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit = cheapest([i or "-" for i in initials], kinds)
        left, lines, state = iter(own), [], ""
        for edit in audit:
            _, role, text = (None, "", "") if edit == "I" else next(left)
            if edit in "IR":
                role = "assistant" if state == "u" else "user"
            if edit != "D":
                state = role[:1]
                lines.append(f"{role}:{text}")
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
        out[conv] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def result(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


ROLES = ["user", "assistant", "user", "assistant", "system", "tool"]


def talk(rng, conv, n):
    return [(conv, t, rng.choice(ROLES), rng.choice(["Good.", "Good.", "No end", f"Text {rng.random()}.", " \n", "Why? ", f"t{t}"]))
            for t in range(n)]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("sua-"), st.sampled_from([WHOLE, WHOLE, CUT, BAD])), max_size=14))
def test_search_is_cheapest_and_least(rows):
    initials, kinds = "".join(r[0] for r in rows), [r[1] for r in rows]
    assert turnrepair.Search(initials, kinds, None).best(turnrepair.NOTHING) == cheapest(initials, kinds)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("sua-"), st.sampled_from([WHOLE, WHOLE, CUT, BAD])), min_size=2, max_size=16), st.data())
def test_pieces_give_what_the_whole_gives(rows, data):
    initials, kinds = "".join(r[0] for r in rows), [r[1] for r in rows]
    cuts = sorted(data.draw(st.sets(st.integers(1, len(rows) - 1), max_size=5)))
    pieces = [turnrepair.options(initials[a:b], kinds[a:b]) for a, b in zip([0, *cuts], [*cuts, len(rows)])]
    small = [(c, r) for c, r, _ in pieces]
    half = len(small) // 2
    top = turnrepair.chained([turnrepair.chained(small[:half]), turnrepair.chained(small[half:])] if half else small)
    goal, tail = turnrepair.ending(top[0][:4], top[1][:4])
    _, states = turnrepair.chain(small, 0, goal)
    edits = "".join(p[2][4 * a + b] for p, a, b in zip(pieces, [0, *states], states)) + tail
    assert (top[0][goal] + 5 * len(tail), edits) == cheapest(initials, kinds)


@pytest.mark.parametrize("segment,fan", [(128, 256), (4, 3)])
def test_equals_brute_force(spark, monkeypatch, segment, fan):
    monkeypatch.setattr(turnrepair, "SEGMENT", segment)
    monkeypatch.setattr(turnrepair, "FAN", fan)
    rng = random.Random(segment)
    rows = [r for c in range(60) for r in talk(rng, c, rng.choice([1, 2, 5, 9]))] + talk(rng, 77, 300 if segment == 4 else 600)
    assert result(turnrepair.report(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "A."), (None, None, "user", "A."), (None, 2, "assistant", "B."), (1, None, None, None), (1, None, "", "x"),
            (1, 5, "user", "Q?"), (1, 5, "user", "Q?"), (1, 5, "assistant", "A!"), (2, -3, "user", "y" * 200_000 + "."), (2, 9, "assistant", " \t"),
            (3, 2**62, "user", "Far."), (3, -5, "assistant", "日本."), (4, 0, "user", "")]
    # a conversation whose only row is dropped
    gone = next(c for c in range(100, 200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((gone, 0, "user", "Gone."))
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("position", "segment", "kind", "edit", "cost", "copy", "f", "same", "at", "state"):
        df = df.withColumn(c, df.text)
    got = result(turnrepair.report(df))
    assert got == brute(rows)
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert turnrepair.report(df.limit(0)).count() == 0
    span = spark.createDataFrame([(1, -(2**63), "user", "A."), (1, 2**63 - 1, "assistant", "B.")], SCHEMA)
    assert result(turnrepair.report(span))[1][0] == 0


def test_given_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    assert result(turnrepair.report(df)) == brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_edits_are_rows(spark):
    rows = [(1, 0, "user", "Hello."), (1, 1, "user", "Again."), (1, 2, "tool", "No end")]
    edits, _ = turnrepair.repair(spark.createDataFrame(rows, SCHEMA))
    got = [tuple(r) for r in edits.orderBy("position", "place").select("edit", "cost", "role", "text").collect()]
    assert "".join(r[0] for r in got) == cheapest("uu-", [WHOLE, WHOLE, CUT])[1]
    assert sum(r[1] for r in got) == cheapest("uu-", [WHOLE, WHOLE, CUT])[0]
