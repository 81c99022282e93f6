import hashlib
import itertools
import random
import re

import duckdb
import pytest
from llm_texts import _package_on_workers  # noqa: F401
from pyspark.sql import functions as F
from sql_check import compare

from wattloom.llm import conversation_repair as C
from wattloom.llm import queries

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
BLANK = re.compile(r"[\x20\x09-\x0D]*")


def faults(turns):
    seen, out = set(), []
    for role, text in turns:
        end = text.rstrip(" \t\n\x0b\x0c\r")
        out.append(("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else None))
        seen.add((role, text))
    return out


def plain(turns):
    """Cheapest edits with whole texts kept for every state: (cost, edits, repaired lines)."""
    goes = {"": ("u", "user"), "s": ("u", "user"), "u": ("a", "assistant"), "a": ("u", "user")}

    def inserted(states):
        for _ in range(3):
            for state, (cost, edits, lines) in list(states.items()):
                to, role = goes[state]
                option = (cost + 3, edits + "I", [*lines, f"{role}:"])
                states[to] = min(states.get(to, option), option)
        return states

    states = {"": (0, "", [])}
    for (role, text), fault in zip(turns, faults(turns)):
        after = {}

        def take(state, cost, edits, lines):
            after[state] = min(after.get(state, (cost, edits, lines)), (cost, edits, lines))

        for state, (cost, edits, lines) in inserted(states).items():
            take(state, cost + 4, edits + "D", lines)
            if fault in ("blank", "duplicate"):
                continue
            more = 3 if fault == "truncated" else 0
            to, name = goes[state]
            if state == "" and role[:1] == "s":
                take("s", cost + more, edits + "K", [*lines, f"{role}:{text}"])
            if role[:1] == to:
                take(to, cost + more, edits + "K", [*lines, f"{role}:{text}"])
            take(to, cost + 3 + more, edits + "R", [*lines, f"{name}:{text}"])
        states = after
    states = inserted(states)
    return min(states[s] for s in ("", "a") if s in states)


def conversation(rng, n):
    role = lambda: rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "sys", "unknown"])
    text = lambda: rng.choice(["Yes.", "", " \n", "cut off", "What? ", "no", f"t{rng.randint(0, 9)}!", "é.\n"])
    return [(role(), text()) for _ in range(n)]


def code(turns):
    fault = {None: 0, "truncated": 1, "blank": 2, "duplicate": 2}
    return bytes(3 * ("sua".find(r[:1]) if r[:1] and r[:1] in "sua" else 3) + fault[f] for (r, _), f in zip(turns, faults(turns)))


@pytest.mark.parametrize("n", range(0, 12))
def test_divide_and_conquer_equals_plain_table(n):
    rng = random.Random(n)
    for _ in range(300):
        turns = conversation(rng, n)
        cost, edits, lines = plain(turns)
        assert C.best_edits(code(turns)) == (edits, cost)
        got = [f"{role}:{text}" for edit, role, text in C.edited(iter(edits), iter(turns)) if edit != "D"]
        assert got == lines and re.fullmatch("(s?(ua)+)?", "".join(x[:1] for x in got))


def test_plain_table_equals_all_edits():
    rng = random.Random(5)
    for _ in range(60):
        turns = conversation(rng, rng.randint(0, 3))
        best = None
        for size in range(len(turns), len(turns) + 4):
            for edits in map("".join, itertools.product("DIKR", repeat=size)):
                if size - edits.count("I") != len(turns):
                    continue
                cost, at, roles, ok = 0, 0, "", True
                choices = [""]
                for e in edits:
                    if e == "I":
                        cost, choices = cost + 3, [c + r for c in choices for r in "ua"]
                        continue
                    fault, role = faults(turns)[at], turns[at][0]
                    at += 1
                    if e == "D":
                        cost += 4
                        continue
                    ok &= fault not in ("blank", "duplicate")
                    cost += (3 if e == "R" else 0) + (3 if fault == "truncated" else 0)
                    choices = [c + r for c in choices for r in ("ua" if e == "R" else [role[:1] or "?"])]
                if ok and any(re.fullmatch("(s?(ua)+)?", c) for c in choices) and (best is None or (cost, edits) < best):
                    best = (cost, edits)
        assert best == plain(turns)[:2]


def test_stretches_are_solved_as_the_whole():
    rng = random.Random(9)
    for _ in range(200):
        codes = code(conversation(rng, rng.randint(1, 40)))
        cuts = sorted(rng.sample(range(len(codes) + 1), min(len(codes), rng.randint(0, 5))))
        parts = [codes[a:b] for a, b in zip([0, *cuts], [*cuts, len(codes)])]
        edits, cost, state = "", 0, C.NOTHING
        for part, (enter, leave) in zip(parts, C.routes([C.summary(p) for p in parts])):
            assert enter == state
            more, extra, state = C.stretch_edits(part, enter, tuple(0 if s == leave else C.FAR for s in range(4)))
            edits, cost = edits + more, cost + extra
        assert (edits + C.END_EDITS[state], cost + C.END_COST[state]) == C.best_edits(codes)


def test_steps_known_are_few_in_long_conversations():
    rng = random.Random(2)
    whole = C.Repair(C.TURNS)
    items = bytes(rng.randrange(12) for _ in range(30_000))
    whole.solve(items, C.NOTHING, C.END_COST, lambda *_: None)
    assert len(whole.ahead) + len(whole.back) < 5000


def expected(rows, every=()):
    by, out = {c: [] for c in every}, {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((t, " " if role is None else role, " " if text is None else text))
    for c, turns in by.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, hashlib.md5(f"{len(t[1])}:{t[1]}:{t[2]}".encode()).digest()))
        numbers = {t for t, *_ in turns if t is not None}
        pairs = [(a[1][:1], b[1][:1]) for a, b in zip(turns, turns[1:])]
        found = faults([t[1:] for t in turns])
        cost, edits, lines = plain([t[1:] for t in turns])
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        illegal = sum(p not in {("s", "u"), ("u", "a"), ("a", "u")} for p in pairs)
        out[c] = (gaps, *(found.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def odd_turns():
    """One conversation with half of all rows, repeated rows and numbers, NULLs everywhere."""
    rng, rows = random.Random(1), []
    for c in range(40):
        rows += [(c, t, *x) for t, x in enumerate(conversation(rng, rng.randint(1, 9))) if rng.random() < 0.9]
    rows += [(77, rng.randint(0, 300), *x) for x in conversation(rng, 400)] + [(77, 5, "user", "Again.")] * 60
    rows += [(None, 1, "user", "Hi."), (None, None, None, None), (88, None, "user", "A."), (88, None, "assistant", "B."), (88, 3, None, "C."), (89, 2, "user", None)]
    return rows


def test_audit_and_turns_equal_plain_table(spark):
    rows = odd_turns()
    table = spark.createDataFrame(rows, SCHEMA).withColumn("edits", F.lit(1)).withColumn("conv", F.lit("x")).withColumn("kind", F.lit(7))
    every = spark.createDataFrame([(500,), (500,), (0,), (None,)], "conv_id bigint").unionByName(table.select("conv_id"))
    got = {r.conv: tuple(r)[1:] for r in C.audit(table, every).collect()}
    assert got == expected(rows, [500])
    turns = {}
    for r in sorted(C.repair(table).collect(), key=lambda r: r.position):
        turns.setdefault(r.conv, []).append(f"{r.role}:{r.text}")
    assert {c: hashlib.sha256("\n".join(x).encode()).hexdigest() for c, x in turns.items()} == {c: x[-1] for c, x in got.items() if set(x[-2]) - {"D"}}


def test_a_long_conversation_is_spread_over_tasks(spark):
    rows = odd_turns()
    cut = C.segments(C.coded(spark.createDataFrame(rows, SCHEMA).repartition(8)).repartition(8)).collect()
    assert sum(r.turns for r in cut) == len(rows)


def test_ids_may_be_text_and_tables_empty(spark):
    rows = [("a", 0, "user", "Hi."), ("a", 1, "assistant", "Yes."), ("b", 0, "system", "Go.")]
    got = {r.conv: (r.cost, r.audit) for r in C.audit(spark.createDataFrame(rows, SCHEMA.replace("conv_id bigint", "conv_id string"))).collect()}
    assert got == {"a": (0, "KK"), "b": (4, "D")}
    empty = spark.createDataFrame([], SCHEMA)
    assert C.audit(empty).count() == 0 and C.repair(empty).count() == 0


def test_query_equals_sql_on_odd_turns(spark, tmp_path):
    rows = [r for r in odd_turns() if r[0] != 77]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    assert compare(queries.QUERIES["op13_conversation_repair"](spark, str(tmp_path)), con, queries.SQL["op13_conversation_repair"]) is None
