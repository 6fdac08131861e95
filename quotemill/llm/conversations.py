"""Conversation structure repair by Wagner-Fischer alignment with the alternating grammar.

Roles of a sound conversation give ``(s?(ua)+)?``: perhaps a system turn, then user and
assistant in turn. The turns of a conversation are aligned with each feasible length of
that string at once: cell (i, r) of the table is the least cost of turning the turns from i
on into the last r characters, so every length is one start cell of the same table. An
incumbent (roles mended in place) bounds the cost, and with it the cells (Ukkonen's band)
and the lengths worth a look. The audits of the cheapest lengths are backtraced and the
ASCII-least is taken.

Faults are found by column functions, and a window over equal turns marks repetitions. The
tasks then see a conversation's turns as a stream in order: first one character each for
the alignment, then, behind a header row with the audit, the texts. A conversation's audit
and codes (one byte a turn) are the most that is held. The table of a very long
conversation would grow with the square of its length; beyond ``LONG`` turns its columns
are folded by what the grammar allows next, which is the same minimum over all lengths.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import map_arrow

#: Costs of the edits, and of a truncated turn that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Turns above which the table's columns are folded.
LONG = 256
BLANKS = " \t\n\x0b\x0c\r"
NAMES = {"u": "user", "a": "assistant"}
_INF = 1 << 60


def gap_cost(rows: int, length: int) -> int:
    """The least cost that so many turns need to get to so many characters."""
    return DELETE * (rows - length) if rows > length else INSERT * (length - rows)


def _incumbent(codes: str) -> int:
    """Cost of one way: roles mended in place, an odd last turn deleted; or all deleted."""
    head = 1 if codes[:1] in ("s", "S") and len(codes) > 2 else 0
    body = codes[head:]
    even = len(body) & ~1
    cost = DELETE * (len(body) - even) + TRUNCATED * codes[:head].isupper()
    for k, c in enumerate(body[:even]):
        cost += REROLE * (c.lower() != "ua"[k & 1]) + TRUNCATED * c.isupper()
    return min(cost, DELETE * len(codes))


def _table(codes: str, bound: int) -> list[list[int]]:
    """Least cost of the turns from i on for the last r characters of ``...uaua``, in the band."""
    n = len(codes)
    width = n + bound // INSERT + 2
    below = [INSERT * r if INSERT * r <= bound else _INF for r in range(width)]
    rows = [below]
    for i in range(n - 1, -1, -1):
        code, left = codes[i], n - i
        stays = TRUNCATED * code.isupper()
        # An even rest starts with u, an odd one with a.
        match = [stays + REROLE * (code.lower() != c) for c in "ua"]
        row = [_INF] * width
        first = max(0, left - bound // DELETE)
        for r in range(first, min(width - 1, left + bound // INSERT) + 1):
            best = below[r] + DELETE
            if r:
                best = min(best, row[r - 1] + INSERT, below[r - 1] + match[r & 1])
            row[r] = best
        rows.append(row)
        below = row
    rows.reverse()
    return rows


def _backtrace(codes: str, rows: list[list[int]], i: int, r: int) -> str:
    """The ASCII-least of the cheapest edits from cell (i, r)."""
    out, n = [], len(codes)
    while i < n or r:
        cost = rows[i][r]
        if i < n and rows[i + 1][r] + DELETE == cost:
            out.append("D")
            i += 1
        elif r and rows[i][r - 1] + INSERT == cost:
            out.append("I")
            r -= 1
        else:
            out.append("K" if codes[i].lower() == "ua"[r & 1] else "R")
            i, r = i + 1, r - 1
    return "".join(out)


def align(codes: str) -> tuple[int, str]:
    """Cost and audit of the cheapest edits that make the turns fit the grammar.

    A turn's code is the initial of its role (``s``, ``u``, ``a``; ``x`` for any other), in
    capitals if the turn is truncated. The audit has one initial per edit: Delete, Insert,
    Keep, Rerole.
    """
    n = len(codes)
    bound = _incumbent(codes)
    rows = _table(codes, bound)
    starts = [(rows[0][m], 0, m) for m in range(0, len(rows[0]), 2) if gap_cost(n, m) <= bound]
    # A system turn is kept, never made; what stands before it has to go.
    for i, c in enumerate(codes):
        if c in "sS" and DELETE * i <= bound:
            before = DELETE * i + TRUNCATED * (c == "S")
            starts += [(before + rows[i + 1][m], i + 1, m) for m in range(2, len(rows[0]), 2)]
    cost = min(s[0] for s in starts)
    audits = (("D" * (i - 1) + "K" if i else "") + _backtrace(codes, rows, i, m) for c, i, m in starts if c == cost)
    return cost, min(audits)


def align_folded(codes: str) -> tuple[int, str]:
    """As ``align``, with one column per place in the grammar instead of one per length."""
    n = len(codes)
    # Places: 0 start, 1 behind the system turn, 2 assistant next, 3 user next or end.
    wants = ("u", "u", "a", "u")
    cost = [0, _INF, _INF, 0]
    letters = bytearray(4 * (n + 1))

    def relax(base: list[int], i: int, marks: list[str]) -> list[int]:
        full = list(base)
        for place, after in ((2, 3), (3, 2)):
            if base[after] + INSERT <= base[place] and not (base[after] + INSERT == base[place] and marks[place] == "D"):
                full[place], marks[place] = base[after] + INSERT, "I"
        for place in (0, 1):
            if full[2] + INSERT < base[place] or (full[2] + INSERT == base[place] and marks[place] in "KR"):
                full[place], marks[place] = full[2] + INSERT, "I"
        letters[4 * i : 4 * i + 4] = "".join(marks).encode()
        return full

    cost = relax(cost, n, ["-", "-", "-", "-"])
    for i in range(n - 1, -1, -1):
        code = codes[i]
        stays, role = TRUNCATED * code.isupper(), code.lower()
        base, marks = [], []
        for place in range(4):
            options = [(cost[place] + DELETE, "D")]
            after = 3 if place == 2 else 2
            same = role == wants[place]
            options.append((cost[after] + stays + (0 if same else REROLE), "K" if same else "R"))
            if place == 0 and role == "s":
                options.append((cost[1] + stays, "K"))
            least = min(options)
            base.append(least[0])
            marks.append(least[1])
        cost = relax(base, i, marks)
    out, i, place = [], 0, 0
    while i < n or place in (1, 2):
        letter = chr(letters[4 * i + place])
        out.append(letter)
        if letter == "D":
            i += 1
            continue
        if letter == "K" and place == 0 and codes[i].lower() == "s":
            place = 1
        else:
            place = 3 if place == 2 else 2
        i += letter != "I"
    return cost[0], "".join(out)


@lru_cache(maxsize=1 << 16)
def _align_short(codes: str) -> tuple[int, str]:
    return align(codes)


def repair_plan(codes: str) -> tuple[int, str]:
    """Cost and audit of a conversation; a turn coded ``D`` has to be deleted.

    Such turns take no part in the alignment. D is the least of the initials, so each is
    deleted as soon as it comes up.
    """
    kept = codes.replace("D", "")
    cost, letters = _align_short(kept) if len(kept) <= LONG else align_folded(kept)
    if len(kept) == len(codes):
        return cost, letters
    out, i = [], 0
    for letter in letters:
        while i < len(codes) and codes[i] == "D":
            out.append("D")
            i += 1
        out.append(letter)
        i += letter != "I"
    out.append("D" * (len(codes) - i))
    return cost + DELETE * (len(codes) - len(kept)), "".join(out)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after a damage fixed by ``crc32(conv_id:turn) % 20``; nulls count as one space.

    0 drops the row (``gone``, kept as a trace of its conversation), 1 empties the text, 2
    removes its end marks, 3 repeats the row, 4 makes the role user.
    """
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long").alias("turn"), shown("role").alias("role"), shown("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (F.col("kind") == 0).alias("gone"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def turns(conversations: DataFrame) -> DataFrame:
    """Undamaged rows in the form of ``damaged``."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long").alias("turn"), shown("role").alias("role"), shown("text").alias("text"), F.lit(False).alias("gone")
    )


def faults(rows: DataFrame) -> DataFrame:
    """Per row its place (``turn, role, mark``) and ``code``: what the alignment needs of it.

    ``mark`` is the MD5 of the text. The code's letter is the role's initial, a capital for
    a truncated turn; B is a blank turn, D a repetition of an earlier one, ``-`` a row that
    is gone.
    """
    solid = F.rtrim("text", F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    slim = rows.select(
        "conv_id", "turn", "role", "gone", F.unhex(F.md5(F.col("text").cast("binary"))).alias("mark"), (solid == "").alias("blank"),
        F.substring(solid, -1, 1).isin(".", "!", "?").alias("ended"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"),
        initial.alias("shown"),
    )
    same = Window.partitionBy("conv_id", "gone", "role", "mark").orderBy(F.col("turn").asc_nulls_first())
    code = (
        F.when(F.col("gone"), "-")
        .when(F.col("blank"), "B")
        .when(F.col("seen") > 1, "D")
        .when(F.col("ended"), F.col("initial"))
        .otherwise(F.upper("initial"))
    )
    return slim.withColumn("seen", F.row_number().over(same)).select("conv_id", "turn", "role", "mark", "shown", code.alias("code"))


def _streams(df: DataFrame, *first: str) -> DataFrame:
    """Each conversation in one partition, its rows in order of turn (nulls first), role and text."""
    return df.repartition("conv_id").sortWithinPartitions(
        "conv_id", *first, F.col("turn").asc_nulls_first(), "role", "mark"
    )


_PLAN = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def plans(rows: DataFrame) -> DataFrame:
    """Per conversation the counts of its faults, and cost and audit of its repair."""

    def close(conv, codes, shown, turns_seen):
        gaps = 0
        if turns_seen[0] is not None:
            least, most, distinct = turns_seen
            gaps = most - least + 1 - distinct
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(shown, shown[1:]))
        cost, audit = repair_plan("".join(codes).replace("B", "D"))
        return conv, gaps, codes.count("B"), codes.count("D"), sum(c in "SUAX" for c in codes), illegal, cost, audit

    def run(batches: Iterator[pa.RecordBatch]):
        now, started = None, False
        codes, shown, seen = [], [], [None, None, 0]
        for batch in batches:
            out = []
            columns = [batch[c].to_pylist() for c in ("conv_id", "turn", "shown", "code")]
            for conv, turn, initial, code in zip(*columns):
                if not started or conv != now:
                    if started:
                        out.append(close(now, codes, shown, seen))
                    now, started = conv, True
                    codes, shown, seen = [], [], [None, None, 0]
                if code == "-":
                    continue
                codes.append(code)
                shown.append(initial)
                if turn is not None and turn != seen[1]:
                    seen = [turn if seen[0] is None else seen[0], turn, seen[2] + 1]
            if out:
                yield list(zip(*out))
        if started:
            yield list(zip(close(now, codes, shown, seen)))

    slim = faults(rows).select("conv_id", "turn", "role", "mark", "shown", "code")
    return map_arrow(_streams(slim), run, _PLAN)


def _mended(batches: Iterator[pa.RecordBatch], fresh, step, done):
    """Walk the streams: ``fresh(header)`` opens a conversation, ``step(state, edit, role,
    text)`` takes its turns after repair and gives rows or None, ``done(state)`` closes it."""
    state, audit, at, want = None, "", 0, "u"

    def inserted():
        nonlocal at, want
        while at < len(audit) and audit[at] == "I":
            row = step(state, "I", NAMES[want], "")
            at, want = at + 1, "a" if want == "u" else "u"
            if row is not None:
                yield row

    for batch in batches:
        out = []
        columns = [batch[c] for c in batch.schema.names]
        headers = batch["audit"].to_pylist()
        for k, (role, text) in enumerate(zip(batch["role"].to_pylist(), batch["text"].to_pylist())):
            if headers[k] is not None:
                if state is not None:
                    out.extend(inserted())
                    last = done(state)
                    if last is not None:
                        out.append(last)
                state = fresh({c: v[k].as_py() for c, v in zip(batch.schema.names, columns)})
                audit, at, want = headers[k], 0, "u"
                continue
            out.extend(inserted())
            edit = audit[at]
            at += 1
            if edit == "D":
                continue
            if edit == "R":
                role = NAMES[want]
            if role[:1] != "s" or edit == "R":
                want = "a" if want == "u" else "u"
            row = step(state, edit, role, text)
            if row is not None:
                out.append(row)
        if out:
            yield list(zip(*out))
    if state is not None:
        out = list(inserted())
        last = done(state)
        out += [last] if last is not None else []
        if out:
            yield list(zip(*out))


def _with_audits(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """The rows that are there, each conversation behind a header row with its plan."""
    place = rows.where("NOT gone").select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", F.unhex(F.md5(F.col("text").cast("binary"))).alias("mark"), "text"
    )
    return _streams(place.unionByName(planned.withColumn("kind", F.lit(0)), allowMissingColumns=True), "kind")


def repair(conversations: DataFrame) -> DataFrame:
    """The repaired turns: ``conv_id, at, edit, role, text``, ``at`` counting from 0.

    Deleted turns are left out; conversations with none left give no rows. Null roles and
    texts count as one space (so such texts are blank), null turns come first, conversations
    without an id are one. Equal turns stand in order of role and text digest. Columns other
    than the four are ignored; an empty table gives no rows.
    """
    rows = turns(conversations)

    def step(state, edit, role, text):
        state["at"] += 1
        return state["conv_id"], state["at"] - 1, edit, role, text

    def run(batches):
        yield from _mended(batches, lambda header: header | {"at": 0}, step, lambda state: None)

    return map_arrow(_with_audits(rows, plans(rows)), run, "conv_id long, at long, edit string, role string, text string")


def repair_digest(rows: DataFrame) -> DataFrame:
    """Per conversation of ``rows`` (as ``damaged`` gives them) its plan and ``repaired_sha256``.

    The digest is over ``role:text`` of the repaired turns, joined by line feeds. It has one
    running state, so a conversation's texts pass one task as a stream and are not held.
    Conversations of which every row is gone have zeros, an empty audit and the digest of
    nothing. A turn with an empty role counts as one with an unknown initial.
    """

    def fresh(header):
        return header | {"sha": sha256(), "first": True}

    def step(state, edit, role, text):
        state["sha"].update(f"{'' if state['first'] else chr(10)}{role}:{text}".encode())
        state["first"] = False

    names = [c.split()[0] for c in _PLAN.split(", ")]

    def done(state):
        return *[state[c] for c in names], state["sha"].hexdigest()

    def run(batches):
        yield from _mended(batches, fresh, step, done)

    return map_arrow(_with_audits(rows, plans(rows)), run, f"{_PLAN}, repaired_sha256 string")
