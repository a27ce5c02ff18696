"""Conversation repair: costs, audits and repaired turns against brute force over all edits, chunk borders, odd rows."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from snapmart.llm import conversation_repair as cr


def shown(x):
    return " " if x is None else str(x)


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        fate = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        role, text = shown(role), shown(text)
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        out += [(conv, turn, role, text)] * (2 if fate == 3 else 1)
    return out


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        found = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("b" if not found else "d" if (role, text) in seen else "" if found[-1] in ".!?" else "t")
        seen.add((role, text))
    return out


def plain_repair(rows):
    """Least (cost, audit, turns) by dynamic programming over whole strings: every state keeps the least of all."""
    best = {"": (0, "", ())}  # state: initial of the last turn
    ok = {"": "su", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def closed(table):
        while True:
            new = dict(table)
            for last, (cost, audit, turns) in table.items():
                for to in ok[last].replace("s", ""):
                    put(new, to, (cost + 2, audit + "I", (*turns, f"{names[to]}:")))
            if new == table:
                return table
            table = new

    def put(table, key, value):
        if key not in table or value < table[key]:
            table[key] = value

    for (_, role, text), fault in zip(rows, faults_of(rows), strict=True):
        new = {}
        for last, (cost, audit, turns) in closed(best).items():
            put(new, last, (cost + 3, audit + "D", turns))
            if fault not in ("b", "d"):
                more = cost + (fault == "t")
                if role[:1] and role[:1] in ok[last]:
                    put(new, role[:1], (more, audit + "K", (*turns, f"{role}:{text}")))
                for to in ok[last].replace("s", ""):
                    put(new, to, (more + 2, audit + "R", (*turns, f"{names[to]}:{text}")))
        best = new
    return min(v for k, v in closed(best).items() if k in ("", "a"))


def plain_report(rows):
    out = []
    for conv in {r[0] for r in rows}:
        own = sorted(
            (r[1:] for r in plain_damage(rows) if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
        )
        turns = [r[0] for r in own if r[0] is not None]
        faults = faults_of(own)
        pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(own)]
        cost, audit, repaired = plain_repair(own)
        out.append(
            (
                conv,
                max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                *(faults.count(f) for f in "bdt"),
                sum(p not in ("su", "ua", "au") for p in pairs),
                cost,
                audit,
                hashlib.sha256("\n".join(repaired).encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def table_of(rng, conversations, most):
    rows = []
    texts = ["Yes.", "No", "ok?", " ", "", None, "a b c!", "Long text without end", "é…", "Yes. \n"]
    for conv in range(conversations):
        roles = rng.choice([["user", "assistant"], ["user"], ["tool", "user"], ["system", "user", "assistant", "tool", None, "", "User"]])
        for turn in range(rng.randint(1, most)):
            role = roles[turn % len(roles)] if rng.random() < 0.8 else rng.choice(roles)
            text = rng.choice(texts) if rng.random() < 0.4 else f"text {rng.random()}" + rng.choice([".", "", "!"])
            rows.append((conv if conv else None, None if rng.random() < 0.05 else turn * rng.choice([1, 1, 1, 2]), role, text))
    return rows


@pytest.mark.parametrize(("chunk", "passes", "most"), [(256, 2, 12), (3, 0, 40), (2, 1, 40), (4, 2, 60)])
def test_report_agrees_with_plain_one(spark, monkeypatch, chunk, passes, most):
    monkeypatch.setattr(cr, "CHUNK", chunk)
    monkeypatch.setattr(cr, "PASSES", passes)
    rows = table_of(random.Random(chunk), 40, most)
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, part int").repartition(5)
    got = cr.report(cr.damaged(df), df)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_report(rows)


@pytest.mark.parametrize("role", ["tool", "user", "assistant"])
def test_runs_of_one_role_do_not_converge_but_agree(spark, monkeypatch, role):
    monkeypatch.setattr(cr, "CHUNK", 5)
    rows = [(1, t, role, f"text {t}.") for t in range(83)] + [(1, 83, "user", "end.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    assert sorted((tuple(r) for r in cr.report(cr.damaged(df), df).collect()), key=repr) == plain_report(rows)


def test_fix_up_stops_where_vectors_differ_by_a_constant():
    end, other = cr._number()[cr.END], next(k for k, v in enumerate(cr.starts()) if v != cr.END)
    symbols = "ua" * 100
    first, _ = cr.run_back(symbols, end)
    again, ran = cr.run_back(symbols, other, first)
    assert ran < 6 and again == cr.run_back(symbols, other)[0]
    assert len(cr.starts()) < 256


def test_rows_of_the_repair(spark):
    rows = [(7, 0, "system", "Be kind."), (7, 1, "user", "Hi."), (7, 2, "user", "Hello?"), (7, 3, "assistant", "Yes"), (7, 4, "user", " ")]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    got = cr.repair(df).orderBy("part", "chunk", "step").collect()
    assert [(r.conv_id, r.edit, r.fault, r.turn, r.old_role, r.role, r.text) for r in got] == [
        (7, "keep", None, 0, "system", "system", "Be kind."),
        (7, "keep", None, 1, "user", "user", "Hi."),
        (7, "insert", None, None, None, "assistant", ""),
        (7, "keep", None, 2, "user", "user", "Hello?"),
        (7, "keep", "truncated", 3, "assistant", "assistant", "Yes"),
        (7, "delete", "blank", 4, "user", None, " "),
    ]


def test_one_large_conversation_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(cr, "CHUNK", 16)
    rows = [(1, t, ("user", "assistant")[t % 2 if t % 37 else 0], "same." if t % 5 == 0 else f"t{t}.") for t in range(1500)]
    rows += [(c, t, "user", "hello.") for c in range(2, 30) for t in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(8)
    assert sorted((tuple(r) for r in cr.report(cr.damaged(df), df).collect()), key=repr) == plain_report(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cr.report(cr.damaged(df), df).count() == 0 and cr.repair(df).count() == 0
