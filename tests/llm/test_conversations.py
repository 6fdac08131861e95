"""Repair plans and digests against an exhaustive cheapest-first search."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quotemill.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string, cost string, `a.b` int"


def search(codes):
    """Cheapest edits, ASCII-least first: states are (turn, roles so far by grammar place)."""
    heap, closed = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, place = heapq.heappop(heap)
        if (i, place) in closed:
            continue
        closed.add((i, place))
        if i == len(codes) and place in ("", "a"):
            return cost, audit
        nexts = {"": "u", "s": "u", "u": "a", "a": "u"}[place]
        heapq.heappush(heap, (cost + 3, audit + "I", i, nexts))
        if i < len(codes):
            c = codes[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, place))
            if c != "D":
                stays = 3 * c.isupper()
                if c.lower() == nexts or (c.lower() == "s" and place == ""):
                    heapq.heappush(heap, (cost + stays, audit + "K", i + 1, c.lower()))
                heapq.heappush(heap, (cost + stays + 3, audit + "R", i + 1, nexts))
    raise AssertionError


@settings(max_examples=1500, deadline=None)
@given(st.text("suaxSUAXD", max_size=11))
def test_plans_equal_search(codes):
    assert C.repair_plan(codes) == search(codes)


@settings(max_examples=1500, deadline=None)
@given(st.text("suaxSUAX", max_size=12))
def test_folded_columns_give_the_same(codes):
    assert C.align_folded(codes) == C.align(codes)


def test_long_plans():
    rng = random.Random(5)
    codes = "".join(rng.choice("uauauauaUAsxD") for _ in range(3000))
    cost, audit = C.repair_plan(codes)
    assert search(codes) == (cost, audit)


def brute(rows):
    """The contract, row by row."""
    groups = {}
    for conv, turn, role, text, *_ in rows:
        kept = groups.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        kept += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, kept in groups.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        codes, seen, counts = "", set(), dict.fromkeys("BDT", 0)
        for _, role, text in kept:
            solid = text.rstrip(C.BLANKS)
            fault = "B" if not solid else "D" if (role, text) in seen else "T" if solid[-1] not in ".!?" else ""
            seen.add((role, text))
            initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
            codes += "D" if fault in ("B", "D") and fault else initial.upper() if fault else initial
            if fault:
                counts[fault] += 1
        cost, audit = search(codes)
        repaired, i, want = [], 0, "u"
        for e in audit:
            role, text = ("", "") if e == "I" else kept[i][1:]
            i += e != "I"
            if e == "D":
                continue
            role = role if e == "K" else {"u": "user", "a": "assistant"}[want]
            want = "u" if role[0] == "s" else "a" if role[0] == "u" else "u"
            repaired.append(f"{role}:{text}")
        known = [t for t, *_ in kept if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        initials = [r[1][:1] for r in kept]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        sha = hashlib.sha256("\n".join(repaired).encode()).hexdigest()
        out.append((conv, gaps, counts["B"], counts["D"], counts["T"], illegal, cost, audit, sha))
    return sorted(out, key=repr)


def awkward_rows():
    rng = random.Random(1)
    texts = ["Good.", "Yes!", "Why", " ", "", None, "Wait\n", "End.\t\x0b", "Ä日本.", "x" * 50_000 + "?"]
    rows = []
    for conv in [None, *range(120)]:
        for turn in range(rng.randrange(1, 9)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", None, "tool", "", "s"])
            if rng.random() < 0.6:
                role = "ua"[turn % 2] == "u" and "user" or "assistant"
            row = (conv, None if rng.random() < 0.05 else turn, role, rng.choice(texts[:5] * 4 + texts), "c", 1)
            rows += [row] * (2 if rng.random() < 0.05 else 1)
    return rows + [(7000, 3, "user", "Tie.", None, None), (7000, 3, "assistant", "Tie.", None, None)]


def test_digests_equal_brute_force(spark):
    rows = awkward_rows()
    got = C.repair_digest(C.damaged(spark.createDataFrame(rows, SCHEMA).repartition(5)))
    assert sorted([tuple(r) for r in got.collect()], key=repr) == brute(rows)


def test_one_long_conversation(spark):
    rng = random.Random(3)
    rows = [(1 if i % 3 else i, i, rng.choice(["user", "assistant", "system"]), f"Text {i % 700}.", "", 0) for i in range(3000)]
    got = C.repair_digest(C.damaged(spark.createDataFrame(rows, SCHEMA)))
    assert sorted([tuple(r) for r in got.collect()], key=repr) == brute(rows)


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert C.repair_digest(C.damaged(none)).count() == 0
    assert C.repair(none).count() == 0


def test_repaired_turns_fit_the_grammar(spark):
    rows = C.repair(spark.createDataFrame(awkward_rows(), SCHEMA)).orderBy("conv_id", "at").collect()
    groups = {}
    for r in rows:
        groups.setdefault(r.conv_id, []).append(r.role[0])
    assert len(groups) > 50
    assert all(re.fullmatch("(s?(ua)+)?", "".join(g)) for g in groups.values())


@pytest.mark.parametrize("codes, wanted", [
    ("", (0, "")), ("u", (3, "KI")), ("a", (3, "IK")), ("ua", (0, "KK")), ("s", (4, "D")), ("sua", (0, "KKK")),
    ("uu", (3, "KR")), ("us", (3, "KR")), ("uDa", (4, "KDK")),
])
def test_known_plans(codes, wanted):
    assert C.repair_plan(codes) == wanted
