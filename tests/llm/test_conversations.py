"""Conversation repair against trying all edits."""

import hashlib
import random
import re
import zlib

import pytest

from fathom.llm import conversations, queries
from fathom.llm.conversations import search

SCHEMA = "conv_id long, turn long, role string, text string, ROLE string, n_turns long"


def table(spark, rows):
    """Rows (conv_id, turn, role, text) with further columns, one of a clashing name."""
    return spark.createDataFrame([(*r, "other", 1) for r in rows], SCHEMA).repartition(3)


def all_edits(rows):
    """(cost, audit) of every way to edit (initial, truncated, must go), with an insertion at most twice in a row."""

    def go(i, out, cost, audit, inserted):
        if re.fullmatch("(s?(ua)+)?", out) and i == len(rows):
            yield cost, audit
        if inserted < 2:
            for c in "ua":
                yield from go(i, out + c, cost + 3, audit + "I", inserted + 1)
        if i < len(rows):
            initial, truncated, gone = rows[i]
            yield from go(i + 1, out, cost + 4, audit + "D", 0)
            if not gone:
                left = cost + 3 * truncated
                yield from go(i + 1, out + initial, left, audit + "K", 0)
                for c in "ua":
                    yield from go(i + 1, out + c, left + 3, audit + "R", 0)

    return go(0, "", 0, "", 0)


def cheapest(rows):
    """The same by a table over rows and what was written so far, for conversations of any length."""
    ways = {"": (0, "")}
    state = lambda out: "" if not out else out[-1]
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}

    def step(ways, moves):
        new = {}
        for s, (cost, audit) in ways.items():
            for then, more, edit in moves(s):
                way = (cost + more, audit + edit)
                new[then] = min(way, new.get(then, way))
        return new

    def insert(ways):
        for _ in range(2):
            more = step(ways, lambda s: [(c, 3, "I") for c in follows[s] if c in "ua"])
            ways = {s: min(w[s] for w in (ways, more) if s in w) for s in {*ways, *more}}
        return ways

    def edit(row):
        initial, truncated, gone = row

        def moves(s):
            yield s, 4, "D"
            if not gone:
                for c in follows[s]:
                    if c == initial:
                        yield c, 3 * truncated, "K"
                    if c in "ua":
                        yield c, 3 * truncated + 3, "R"

        return moves

    ways = insert(ways)
    for row in rows:
        ways = insert(step(ways, edit(row)))
    return min(ways[s] for s in ("", "a") if s in ways)


def as_search(rows):
    out = []
    for initial, truncated, gone in rows:
        if gone and out and isinstance(out[-1], int):
            out[-1] += 1
        else:
            out.append(1 if gone else (initial, truncated))
    return out


def some_rows(rng, n, roles):
    return [(rng.choice(roles), rng.random() < 0.2, rng.random() < 0.15) for _ in range(n)]


def test_search_by_all_edits():
    rng = random.Random(1)
    for _ in range(40):
        rows = some_rows(rng, rng.randint(0, 3), rng.choice(["sua", "ua", "suax"]))
        assert search(as_search(rows)) == min(all_edits(rows)) == cheapest(rows)


@pytest.mark.parametrize("roles", ["sua", "ua", "u", "a", "s", "x", "suax"])
def test_search_of_longer_conversations(roles):
    rng = random.Random(roles)
    for n in (7, 12, 30, 400):
        for _ in range(20 if n < 100 else 1):
            rows = some_rows(rng, n, roles)
            assert search(as_search(rows)) == cheapest(rows)


def plain_repair(rows):
    """(gaps, ..., cost, audit, rows that stay) of one conversation's rows (turn, role, text) in order."""
    seen, marked, count = set(), [], [0, 0, 0]
    for _, role, text in rows:
        end = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        fault = 0 if not end else 1 if (role, text) in seen else 2 if end not in ".!?" else 3
        seen.add((role, text))
        if fault < 3:
            count[fault] += 1
        marked.append((role[:1], fault == 2, fault < 2))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit = cheapest(marked)
    out, i = [], 0
    for edit in audit:
        role, text = ("", "") if edit == "I" else rows[i][1:]
        i += edit != "I"
        if edit in "RI":
            role = "assistant" if out and out[-1][0][:1] == "u" else "user"
        if edit != "D":
            out.append((role, text))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, *count, illegal, cost, audit), out


ODD = [
    (1, 0, "user", "Hello."), (1, 1, "assistant", "Hi!"),
    (2, 0, "user", None), (2, 1, None, "What?"), (2, None, "system", "Be good."), (2, None, "system", "Be good."),
    (3, 5, "assistant", ""), (3, 9, "assistant", "\t"),
    (None, 1, "user", "No id."), (None, 2, "assistant", "no end"), (None, 2, "assistant", "no end"),
    (4, None, None, None), (5, 3, "tool", "x" * 100_000 + "."), (5, 4, "", "é. "),
    *[(6, t, "user", "Same.") for t in range(40)],
    *[(7, 1, "user", "Repeated row!")] * 30,
]


def by_conversation(rows):
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    held = {}
    for conv_id, *rest in rows:
        held.setdefault(conv_id, []).append((rest[0], *[" " if x is None else x for x in rest[1:]]))
    return {c: sorted(rs, key=order) for c, rs in held.items()}


@pytest.mark.parametrize("piece", [2000, 3])
def test_repair_by_brute_force(spark, monkeypatch, piece):
    monkeypatch.setattr(conversations, "PIECE", piece)
    rng = random.Random(5)
    rows = list(ODD)
    for c in range(10, 50):
        # One row a turn here: rows of a turn stand in the order of a hash, tested below.
        for t in range(rng.choice([1, 4, 9, 60])):
            rows.append((c, rng.choice([t, t, t, None]) if t == 0 else 2 * t, rng.choice(["user", "assistant", "system", "ant"]),
                         rng.choice(["Yes.", "no", "", "Who?", "Well. "])))
    docs = table(spark, rows)
    audits = conversations.repair(docs)
    got = {r.conv_id: tuple(r)[1:] for r in audits.collect()}
    held = by_conversation(rows)
    want = {c: plain_repair(rs) for c, rs in held.items()}
    assert got == {c: w[0] for c, w in want.items()}
    stay = {}
    for r in sorted(conversations.repaired(docs, audits).collect(), key=lambda r: r.position):
        assert r.position == len(stay.setdefault(r.conv_id, []))
        stay[r.conv_id].append((r.role, r.text))
    assert stay == {c: w[1] for c, w in want.items() if w[1]}


def test_a_long_conversation_in_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(conversations, "PIECE", 50)
    rng = random.Random(8)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"{t}" + rng.choice([".", "", "!"])) for t in range(3000)]
    rows += [(2, t, rng.choice(["user", "assistant"]), f"{t}.") for t in range(20)]
    got = {r.conv_id: tuple(r)[1:] for r in conversations.repair(table(spark, rows)).collect()}
    assert got == {c: plain_repair(rs)[0] for c, rs in by_conversation(rows).items()}


def test_rows_of_one_turn_and_numbers_of_rows(spark):
    rows = [(1, 1, "user", t) for t in ("A.", "B.", "C.")] + [(1, 1, "assistant", "D.")]
    once = conversations.repair(table(spark, rows)).first()
    assert tuple(once)[1:] == plain_repair([r[1:] for r in sorted(rows)])[0]
    thrice = [(1, 1, "user", "A.", 3), (1, 2, "assistant", "B.", 1)]
    told = conversations.repair(spark.createDataFrame(thrice, "conv_id long, turn long, role string, text string, n long"))
    assert tuple(told.first())[1:] == (0, 0, 2, 0, 2, 8, "KDDK")


def test_no_rows(spark):
    nothing = table(spark, [(1, 1, "user", "A.")]).limit(0)
    audits = conversations.repair(nothing)
    assert audits.count() == 0 and conversations.repaired(nothing, audits).count() == 0
    assert conversations.digests(nothing, audits).count() == 0


@pytest.mark.parametrize("source", ["sf0.001", "odd"])
def test_query_by_brute_force(spark, monkeypatch, source):
    sf = f"/root/testdata/{source}"
    if source == "odd":
        # Conversations without a row after the damage, too.
        odd = [r for r in ODD if r[0] not in (7,)] + [(c, 0, "user", "Gone?") for c in range(100, 160)]
        monkeypatch.setattr(queries, "_table", lambda *_: table(spark, odd))
        rows = odd
    else:
        rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    after = []
    for conv_id, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        after += [(conv_id, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    held = by_conversation(after)
    want = {}
    for conv_id in {r[0] for r in rows}:
        told, stay = plain_repair(held.get(conv_id, []))
        joined = "\n".join(f"{role}:{text}" for role, text in stay)
        want[conv_id] = (*told, hashlib.sha256(joined.encode()).hexdigest())
    got = {r.conv_id: tuple(r)[1:] for r in queries.op12_conversation_repair(spark, sf).collect()}
    assert got == want
    assert any(w[6] == "" for w in want.values()) or source != "odd"
