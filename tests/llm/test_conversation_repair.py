"""Conversation repair against a recursion over all edits and a plain rerun of the query."""

import random
import re
import zlib
from functools import lru_cache
from hashlib import sha256

import pytest

from importlens.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string"
INK = re.compile(r"[^\x20\x09-\x0D]")


def best_audit(rows):
    """Least (cost, audit) over every edit sequence; rows are (initial, must go, truncated)."""

    @lru_cache(None)
    def go(i, state, inserted):
        out = []
        if i == len(rows) and state in ("", "a"):
            out.append((0, ""))
        if inserted < 3:
            c, a = go(i, "u" if state in ("", "s", "a") else "a", inserted + 1)
            out.append((c + 5, "I" + a))
        if i < len(rows):
            initial, must, cut = rows[i]
            c, a = go(i + 1, state, 0)
            out.append((c + 2, "D" + a))
            if not must:
                for new in ("u", "a"):
                    if state + new in ("u", "su", "ua", "au"):
                        c, a = go(i + 1, new, 0)
                        out.append((c + 1 + 5 * cut, "R" + a))
                if initial and state + initial in ("s", "u", "su", "ua", "au"):
                    c, a = go(i + 1, initial, 0)
                    out.append((c + 5 * cut, "K" + a))
        return min(out) if out else (10 ** 9, "")

    return go(0, "", 0)


def apply(audit, rows):
    """Role and text of the repaired rows; every turn that is not kept is the one due."""
    out, rows = [], list(rows)
    for edit in audit:
        due = "assistant" if out and out[-1][0][:1] == "u" else "user"
        if edit == "I":
            out.append((due, ""))
        else:
            role, text = rows.pop(0)
            out += {"K": [(role, text)], "R": [(due, text)], "D": []}[edit]
    assert not rows and re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out))
    return out


def brute(rows):
    """The query's rows, from (conv_id, turn, role, text)."""
    convs, n = {}, 0
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        role = "user" if kind == 4 else role
        for _ in range({0: 0, 3: 2}.get(kind, 1)):
            convs.setdefault(conv, []).append((turn, role, text))
        convs.setdefault(conv, [])
    out = []
    for conv, found in convs.items():
        def key(r):
            shown = f"{'' if conv is None else conv}/{len(r[1].encode())}:{r[1]}{r[2]}"
            return (r[0] is not None, r[0] or 0, r[1].encode(), sha256(shown.encode()).digest())
        found = sorted(found, key=key)
        seen, marks, counts = set(), [], [0, 0, 0]
        for _, role, text in found:
            ink = INK.findall(text)
            fault = 0 if not ink else 1 if (role, text) in seen else 2 if ink[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            marks.append((role[:1], fault in (0, 1), fault == 2))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marks, marks[1:]))
        turns = [t for t, _, _ in found if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit = best_audit(tuple(marks))
        fixed = apply(audit, [r[1:] for r in found])
        digest = sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
        out.append((conv, gaps, *counts, illegal, cost, audit, digest))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(4))
def test_automaton_matches_recursion(seed):
    rng = random.Random(seed)
    rows = [[(rng.choice("ssuuuaaax"), f in (1, 2), f == 3) for f in rng.choices(range(6), k=rng.randrange(9))] for _ in range(300)]
    words = {"".join(cr.symbol(i, cr.GONE if m else cr.CUT if c else cr.FINE) for i, m, c in reversed(r)): best_audit(tuple(r)) for r in rows}
    automaton = cr.Automaton()
    assert {w: automaton.repair(w) for w in sorted(words)} == words
    # nodes are the distinct suffixes, each computed once
    assert automaton.computed == len({w[:i] for w in words for i in range(1, len(w) + 1)})


def _conversations(seed, n):
    rng = random.Random(seed)
    texts = [None, "", " \t", "Yes.", "Yes", "No! ", "Why?\n", "\x0b.\x0c", "é…", "Ünïcode."]
    rows = []
    for conv in [None] + list(range(n)):
        for turn in range(rng.randrange(9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", None, "", "tool", "User", "u"])
            text = rng.choice(texts) if rng.random() < 0.5 else f"Turn {rng.randrange(50)} says so."
            rows.append((conv, rng.choice([turn] * 8 + [None, 0, turn + 3]), role, text))
    return rows


def test_query_matches_brute_force(spark, tmp_dir):
    rows = _conversations(3, 150)
    rows += rows[:5]                                          # repeated rows
    rows += [(1000, t, "user" if t % 2 == 0 else "assistant", f"Line {t}." + "x" * 50) for t in range(120)]
    rows += [(1001, t, "user", "again.") for t in range(60)]
    rows += [(1002, 0, "user", "long " * 200_000)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as key", "2 as audit", "true as gone", "0 as part", "'x' as blank")
    df.repartition(4).write.parquet(f"{tmp_dir}/conversations.parquet")
    got = cr.op12_conversation_repair(spark, tmp_dir)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_repaired_rows(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "user", "Hi."), (1, 1, "user", "Hi."), (1, 4, "assistant", "cut off"), (2, 0, "system", "Be kind.")]
    out = cr.repaired(spark.createDataFrame(rows, SCHEMA)).collect()
    by = {c: [(r.role, r.text) for r in sorted((x for x in out if x.conv_id == c), key=lambda x: x.turn)] for c in {x.conv_id for x in out}}
    assert by[1][0] in [("user", "Hi."), ("user", "Hello.")] and [r for r, _ in by[1]] in (["user", "assistant"], ["user", "assistant"] * 2)
    assert all(re.fullmatch("s?(ua)+", "".join(r[0] for r, _ in v)) for v in by.values())
    assert 2 not in by                                       # deleting the only row is cheaper than two inserted turns


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert cr.repaired(empty).collect() == [] and cr.repair_report(cr.damaged(empty)).collect() == []
