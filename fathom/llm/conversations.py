"""Repair of conversation structure: the cheapest edits by depth-first branch-and-bound."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.llm.common import BLANKS, pick

#: Costs of the edits, and of a truncated row that stays.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
#: Rows of a conversation that are searched as one piece.
PIECE = 2000

#: What has been written so far: nothing, a system turn, up to a user turn, up to an assistant turn.
EMPTY, SYSTEM, USER, ASSISTANT = STATES = range(4)
_DONE = (EMPTY, ASSISTANT)
#: The turn of a conversation that may follow, besides a system turn at its beginning, and its role.
_NEXT = (USER, USER, ASSISTANT, USER)
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_INITIAL = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
_LEGAL = {"su", "ua", "au"}
_NEVER = 1 << 60

#: A row of the search: (initial of its role, truncated?), or a number of rows that must go.
Row = tuple[str, bool] | int


def _after(state: int, initial: str) -> int | None:
    """The state behind a kept row, or None where its role can't stand."""
    then = _INITIAL.get(initial)
    return then if then == _NEXT[state] or (then == SYSTEM and state == EMPTY) else None


def _bounds(rows: list[Row], goal: Iterable[int]) -> list[tuple[int, int, int, int]]:
    """For each suffix and state: no way to end in ``goal`` from there costs less.

    The two states of a conversation that has begun are looked through row by
    row.  One that hasn't, or has a system turn only, counts as complete so
    far: the same turns may follow, and it may also end there.
    """
    end = [0 if s in goal else _NEVER for s in STATES]
    user, assistant = min(end[USER], end[ASSISTANT] + INSERT), min(end[ASSISTANT], end[USER] + INSERT)
    # To delete all that is left, and to delete up to a system turn that stays.
    rest, begin = 0, _NEVER
    bounds = [(min(end[EMPTY], assistant), min(end[SYSTEM], assistant), user, assistant)]
    for row in reversed(rows):
        if isinstance(row, int):
            user, assistant, rest, begin = (x + DELETE * row for x in (user, assistant, rest, begin))
        else:
            initial, truncated = row
            left = TRUNCATED if truncated else 0
            begin = min(begin + DELETE, left + bounds[-1][SYSTEM] if initial == "s" else _NEVER)
            # Behind a user turn an assistant may stand, and the other way round.
            as_user = left + (0 if initial == "u" else REROLE) + user
            as_assistant = left + (0 if initial == "a" else REROLE) + assistant
            user, assistant, rest = min(user + DELETE, as_assistant), min(assistant + DELETE, as_user), rest + DELETE
        user, assistant = min(user, assistant + INSERT), min(assistant, user + INSERT)
        bounds.append((min(rest + end[EMPTY], begin, assistant), min(rest + end[SYSTEM], assistant), user, assistant))
    return bounds[::-1]


def search(rows: list[Row], enter: int = EMPTY, goal: Iterable[int] = _DONE) -> tuple[int, str] | None:
    """(cost, audit): the cheapest edits from state ``enter`` to one of ``goal``, of equals the least in ASCII.

    Depth first over (row, state) with a stack of its own.  A node is left
    when its cost and the suffix bound exceed the incumbent's cost, or equal
    it with edits that are greater already, and when the same row and state
    were reached with lower (cost, audit) before: two audits of one node and
    cost are never the beginning of each other, so what follows can't turn
    their order.  None where no edits lead there.
    """
    goal = tuple(goal)
    bounds = _bounds(rows, goal)
    reached: dict[tuple[int, int], tuple[int, str]] = {}
    best: tuple[int, str] | None = None
    stack = [(enter, 0, 0, "")]
    while stack:
        state, i, cost, audit = stack.pop()
        bound = cost + bounds[i][state]
        if bound >= _NEVER or (best and (bound, audit) > (best[0], best[1][: len(audit)])):
            continue
        if (i, state) in reached and reached[i, state] <= (cost, audit):
            continue
        reached[i, state] = (cost, audit)
        if i == len(rows) and state in goal and (best is None or (cost, audit) < best):
            best = (cost, audit)
        then = _NEXT[state]
        children = [(then, i, cost + INSERT, audit + "I")]
        if i < len(rows):
            row = rows[i]
            if isinstance(row, int):
                children.append((state, i + 1, cost + DELETE * row, audit + "D" * row))
            else:
                initial, truncated = row
                left = cost + (TRUNCATED if truncated else 0)
                children.append((state, i + 1, cost + DELETE, audit + "D"))
                children.append((then, i + 1, left + REROLE, audit + "R"))
                kept = _after(state, initial)
                if kept is not None:
                    children.append((kept, i + 1, left, audit + "K"))
        # The most promising one is on top.
        stack.extend(sorted(children, key=lambda c: (c[2] + bounds[c[1]][c[0]], c[3]), reverse=True))
    return best


def faults(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, h1, h2, n, blank, truncated, extra): different rows, without their texts.

    ``rows`` has conv_id, turn, role, text and n, how often the row stands
    there.  h1 and h2 tell (role, text) apart, and ``extra`` of the n rows
    are duplicates: role and text were seen before.
    """
    end = F.right(F.rtrim(F.col("text"), F.lit(BLANKS)), F.lit(1))
    h1, h2 = F.xxhash64("role", "text"), F.xxhash64(F.lit(7), "role", "text")
    light = rows.select(
        "conv_id", "turn", "role", h1.alias("h1"), h2.alias("h2"), "n",
        (end == "").alias("blank"), (~end.isin(".", "!", "?")).alias("truncated"),
    )
    keys = ["conv_id", "turn", "role", "h1", "h2", "blank", "truncated"]
    light = light.groupBy(*keys).agg(F.sum("n").cast("long").alias("n"))
    # The first turn of equal rows; joined back, so that a row of very many turns is no single task's work.
    at = F.struct(F.col("turn").isNotNull().alias("some"), F.col("turn"))
    first = light.groupBy(*[F.col(c).alias(f"_{c}") for c in ("conv_id", "h1", "h2")]).agg(F.min(at).alias("_first"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))
    extra = F.col("n") - F.when(at == F.col("_first"), 1).otherwise(0)
    return light.join(first, same).select("conv_id", "turn", "role", "h1", "h2", "n", "blank", "truncated", extra.alias("extra"))


_ORDER = ["conv_id", "turn", "role", "h1", "h2"]
_COUNTS = ["blank", "duplicate", "truncated", "illegal"]
_PIECE = pa.schema([
    ("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("h1", pa.int64()), ("h2", pa.int64()),
    ("whole", pa.bool_()), ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64()), ("last_turn", pa.int64()),
    ("first_initial", pa.string()), ("last_initial", pa.string()), *[(c, pa.int64()) for c in _COUNTS],
    ("paths", pa.list_(pa.struct([("enter", pa.int32()), ("leave", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))),
])
_PIECE_DDL = """conv_id long, turn long, role string, h1 long, h2 long, whole boolean, low long, high long, turns long,
    last_turn long, first_initial string, last_initial string, blank long, duplicate long, truncated long, illegal long,
    paths array<struct<enter: int, leave: int, cost: long, audit: string>>"""
_RESULT = pa.schema([
    ("conv_id", pa.int64()), ("gaps", pa.int64()), *[(c, pa.int64()) for c in _COUNTS], ("cost", pa.int64()), ("audit", pa.string()),
])
_RESULT_DDL = ", ".join(f"{f.name} {'string' if f.name == 'audit' else 'long'}" for f in _RESULT)


def _summary(held: list[dict], whole: bool) -> dict:
    """Counts of a piece's rows and its cheapest edits: of a whole conversation, or between all states."""
    rows: list[Row] = []
    count = dict.fromkeys(_COUNTS, 0)
    turns, before, last_turn = 0, None, None
    for r in held:
        if r["turn"] is not None and r["turn"] != last_turn:
            turns, last_turn = turns + 1, r["turn"]
        initial = r["role"][:1]
        count["illegal"] += r["n"] - 1 + (before is not None and before + initial not in _LEGAL)
        before = initial
        gone = r["n"] if r["blank"] else r["extra"]
        count["blank" if r["blank"] else "duplicate"] += gone
        if gone < r["n"]:
            count["truncated"] += r["truncated"]
            rows.append((initial, r["truncated"]))
        if gone and rows and isinstance(rows[-1], int):
            rows[-1] += gone
        elif gone:
            rows.append(gone)
    if whole:
        cost, audit = search(rows)
        paths = [{"enter": EMPTY, "leave": EMPTY, "cost": cost, "audit": audit}]
    else:
        ways = ((a, b, search(rows, a, (b,))) for a in STATES for b in STATES)
        paths = [{"enter": a, "leave": b, "cost": w[0], "audit": w[1]} for a, b, w in ways if w]
    known = [r["turn"] for r in held if r["turn"] is not None]
    return {
        **{c: held[0][c] for c in _ORDER}, "whole": whole, "low": min(known, default=None), "high": max(known, default=None),
        "turns": turns, "last_turn": held[-1]["turn"], "first_initial": held[0]["role"][:1], "last_initial": before,
        **count, "paths": paths,
    }


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of the conversations of a sorted partition, whose first and last one may go on elsewhere."""

    def pieces() -> Iterator[dict]:
        held: list[dict] = []
        cut = True  # the partition's first conversation may have begun before
        for batch in batches:
            for row in batch.to_pylist():
                if held and row["conv_id"] != held[0]["conv_id"]:
                    yield _summary(held, not cut)
                    held, cut = [], False
                elif len(held) >= PIECE:
                    yield _summary(held, False)
                    held, cut = [], True
                held.append(row)
        if held:
            yield _summary(held, False)

    out: list[dict] = []
    for piece in pieces():
        out.append(piece)
        if len(out) >= 256:
            yield pa.RecordBatch.from_pylist(out, schema=_PIECE)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=_PIECE)


class _Joined:
    """A conversation's pieces, taken in order: the cheapest way through all of them."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.best = conv_id, {EMPTY: (0, "")}
        self.count = dict.fromkeys(_COUNTS, 0)
        self.turns, self.low, self.high, self.before = 0, None, None, None

    def add(self, piece: dict) -> None:
        ways: dict[int, tuple[int, str]] = {}
        for path in piece["paths"]:
            if path["enter"] in self.best:
                cost, audit = self.best[path["enter"]]
                way = (cost + path["cost"], audit + path["audit"])
                ways[path["leave"]] = min(way, ways.get(path["leave"], way))
        self.best = ways
        for c in _COUNTS:
            self.count[c] += piece[c]
        self.turns += piece["turns"]
        if self.before:
            self.count["illegal"] += self.before["last_initial"] + piece["first_initial"] not in _LEGAL
            self.turns -= piece["turn"] is not None and piece["turn"] == self.before["last_turn"]
        if piece["low"] is not None:
            self.low, self.high = piece["low"] if self.low is None else self.low, piece["high"]
        self.before = {c: piece[c] for c in ("last_initial", "last_turn")}

    def row(self) -> dict:
        cost, audit = min(self.best[s] for s in _DONE if s in self.best)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"conv_id": self.conv_id, "gaps": gaps, **self.count, "cost": cost, "audit": audit}


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation of a partition whose pieces are in order."""
    now: _Joined | None = None
    out: list[dict] = []
    for batch in batches:
        for piece in batch.to_pylist():
            if now is None or piece["conv_id"] != now.conv_id:
                if now is not None:
                    out.append(now.row())
                now = _Joined(piece["conv_id"])
            now.add(piece)
        yield pa.RecordBatch.from_pylist(out, schema=_RESULT)
        out = []
    if now is not None:
        yield pa.RecordBatch.from_pylist([now.row()], schema=_RESULT)


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.

    ``rows`` has conv_id, turn, role and text, and n where a row stands more
    than once; null roles and texts count as one blank.  A conversation's
    rows stand by turn (nulls first), then role, then a hash of role and
    text; null conv_ids are one conversation.  The first fault of a row
    counts: blank, duplicate (role and text seen before), truncated (its last
    character that is no blank is none of ``.!?``).  ``illegal`` counts
    neighbours whose role initials are none of su, ua, au, and ``gaps`` the
    turns that are missing between the least and the greatest.

    ``audit`` has an initial per edit: (K)eep, (R)erole, (D)elete, which
    blank and duplicate rows need, and (I)nsert an empty turn.  They leave
    role initials ``(s?(ua)+)?`` at the least cost; of equals, the audit that
    is least in ASCII.

    Rows without their texts are sorted by range, so a long conversation lies
    in many tasks: its pieces of at most 2,000 different rows are searched from every
    state to every other, and one row per piece comes together.  A repeated
    row is one row with a number.  An empty table gives no rows; further
    columns are ignored.
    """
    light = faults(_filled(rows))
    sorted_rows = light.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
    pieces = sorted_rows.mapInArrow(_pieces, _PIECE_DDL)
    return pieces.repartition("conv_id").sortWithinPartitions(*_ORDER).mapInArrow(_conversations, _RESULT_DDL)


def _filled(rows: DataFrame) -> DataFrame:
    counted = "n" in rows.columns
    picked = pick(rows, conv_id="long", turn="long", role="string", text="string", **({"n": "long"} if counted else {}))
    filled = picked.withColumns({c: F.coalesce(c, F.lit(" ")) for c in ("role", "text")})
    return filled if counted else filled.withColumn("n", F.lit(1).cast("long"))


def _replay(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(audit row or None, edit, role, text) in order; each conversation's audit row comes first."""
    audit, at, state = "", 0, EMPTY
    open_row = None

    def inserted() -> Iterator[tuple]:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            state = _NEXT[state]
            at += 1
            yield None, "I", _ROLE[state], ""

    for batch in batches:
        for row in batch.to_pylist():
            if row["audit"] is not None:
                if open_row is not None:
                    yield from inserted()
                open_row, audit, at, state = row, row["audit"], 0, EMPTY
                yield row, "", "", ""
                continue
            for _ in range(row["n"]):
                yield from inserted()
                edit = audit[at]
                at += 1
                if edit == "K":
                    state = _INITIAL[row["role"][:1]]
                    yield None, edit, row["role"], row["text"]
                elif edit == "R":
                    state = _NEXT[state]
                    yield None, edit, _ROLE[state], row["text"]
    if open_row is not None:
        yield from inserted()


def _with_audits(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """Each conversation's audit, then its rows in order, in one task and never held together."""
    h1, h2 = F.xxhash64("role", "text"), F.xxhash64(F.lit(7), "role", "text")
    own = _filled(rows).select("conv_id", "turn", "role", h1.alias("h1"), h2.alias("h2"), "n", "text")
    both = own.unionByName(audits, allowMissingColumns=True).withColumn("is_row", F.col("audit").isNull())
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "is_row", "turn", "role", "h1", "h2")


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, position, edit, role, text): the rows that stand after ``repair``'s edits, in order."""
    schema = pa.schema([
        ("conv_id", pa.int64()), ("position", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string()),
    ])

    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_id, position, out = None, 0, []
        for head, edit, role, text in _replay(batches):
            if head is not None:
                conv_id, position = head["conv_id"], 0
                continue
            out.append({"conv_id": conv_id, "position": position, "edit": edit, "role": role, "text": text})
            position += 1
            if len(out) >= 1024:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    return _with_audits(rows, audits).mapInArrow(replay, "conv_id long, position long, edit string, role string, text string")


def digests(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """``audits`` with repaired_sha256: that of the repaired rows ``role:text``, joined by newlines.

    The hash runs over a conversation's rows in order, so they pass one task;
    they are read one by one and not held.
    """
    schema = _RESULT.append(pa.field("repaired_sha256", pa.string()))

    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        result, digest, first, out = None, None, True, []

        def close() -> None:
            if result is not None:
                out.append({**{f.name: result[f.name] for f in _RESULT}, "repaired_sha256": digest.hexdigest()})

        for head, _, role, text in _replay(batches):
            if head is not None:
                close()
                result, digest, first = head, hashlib.sha256(), True
                if len(out) >= 1024:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out = []
                continue
            digest.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
            first = False
        close()
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    return _with_audits(rows, audits).mapInArrow(replay, f"{_RESULT_DDL}, repaired_sha256 string")
