"""Conversation repair: alignments against all edit sequences, edge cases, damage."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from kickstar.llm import conversation_repair as cr
from kickstar.llm import queries
from tests.conftest import SF_SMALL, rows

COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def brute_align(roles, faults):
    """Least (cost, audit) over an automaton of the grammar, from the end."""
    due, after = {0: "u", 1: "u", 2: "a", 3: "u"}, {0: 2, 1: 2, 2: 3, 3: 2}

    @lru_cache(None)
    def best(i, state, inserts):
        ways = [(0, "")] if i == len(roles) and state in (0, 3) else []
        if inserts < 3:
            c, a = best(i, after[state], inserts + 1)
            ways.append((c + 3, "I" + a))
        if i < len(roles):
            c, a = best(i + 1, state, 0)
            ways.append((c + 4, "D" + a))
            if faults[i] not in "bd":
                extra = 3 * (faults[i] == "t")
                c, a = best(i + 1, after[state], 0)
                ways.append((c + extra, "K" + a) if roles[i] == due[state] else (c + extra + 3, "R" + a))
                if state == 0 and roles[i] == "s":
                    c, a = best(i + 1, 1, 0)
                    ways.append((c + extra, "K" + a))
        return min(ways, default=(10**9, ""))
    return best(0, 0, 0)


def test_alignment_is_least():
    rnd = random.Random(1)
    for _ in range(3000):
        n = rnd.randrange(0, 11)
        roles = "".join(rnd.choice("suau?ua") for _ in range(n))
        faults = "".join(rnd.choice("bdtt-----") for _ in range(n))
        a = cr.Alignment(roles, faults)
        assert (a.cost, a.audit) == brute_align(roles, faults), (roles, faults)
        assert a.budget >= a.cost


def test_alignment_of_many_turns():
    rnd = random.Random(2)
    for n in (60, 300, 700):
        roles = "".join(rnd.choice("ua"[i % 2] * 8 + "us?") for i in range(n))
        faults = "".join(rnd.choice("bdt" + "-" * 30) for _ in range(n))
        a = cr.Alignment(roles, faults)
        import sys
        sys.setrecursionlimit(20_000)
        assert (a.cost, a.audit) == brute_align(roles, faults)
    for roles in ("u" * 400, "s" * 400, "?" * 300, "a" * 301):
        for fault in "-tbd":
            a = cr.Alignment(roles, fault * len(roles))
            assert (a.cost, a.audit) == brute_align(roles, fault * len(roles))


def brute_damage(data):
    out = []
    for conv, turn, role, text in data:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def brute_repair(data, convs):
    out = []
    for conv in set(convs):
        own = sorted((r[1:] for r in data if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), ""
        for _, role, text in own:
            shown = re.sub(r"[\x20\x09-\x0D]", "", text)
            faults += "b" if not shown else "d" if (role, text) in seen else "t" if shown[-1] not in ".!?" else "-"
            seen.add((role, text))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        first = [role[:1] for _, role, _ in own]
        illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(first, first[1:]))
        cost, audit = brute_align("".join(x or "?" for x in first), faults)
        lines, k, due = [], 0, "user"
        for e in audit:
            if e == "I":
                lines.append(due + ":")
            else:
                _, role, text = own[k]
                k += 1
                if e == "D":
                    continue
                lines.append((role if e == "K" else due) + ":" + text)
                if e == "K" and len(lines) == 1 and role[:1] == "s":
                    continue
            due = "assistant" if due == "user" else "user"
        out.append((conv, gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def made(seed):
    rnd = random.Random(seed)
    data = []
    for c in range(120):
        for t in range(rnd.randrange(1, 12)):
            data.append((c, t + (t > 4) * rnd.randrange(0, 3), rnd.choice(["user", "assistant"][t % 2:] + ["system", "assistant"] * (rnd.random() < 0.2)),
                         rnd.choice(["Hello there.", "Well", "yes!", " \t", "", "Again? \n", "fine. ", "so é?"]) + ("" if rnd.random() < 0.4 else f" {c % 7} {t}.")))
    data += [(500, None, "user", "No turn."), (500, None, None, None), (500, 3, "assistant", "x."), (None, 1, "user", "Lost."), (None, None, "", "y"),
             (501, 1, None, "?"), (502, 7, "user", None), (503, 1, "user", "A. " * 50_000), (503, 2, "assistant", "b " * 50_000), (503, 2, "assistant", "b " * 50_000)]
    data += [(600, t, "user" if t % 2 else "assistant", f"turn {t}.") for t in range(400)] + [(0, 1, "user", "dup."), (0, 1, "user", "dup.")]
    rnd.shuffle(data)
    return data


@pytest.mark.parametrize("seed", [1, 2])
def test_repair(spark, seed):
    data = made(seed)
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "1 AS known", "2 AS conv", "3 AS kind", "4 AS copy", "5 AS audit", "6 AS cost", "7 AS letter").repartition(6)
    harmed = cr.damaged(df)
    assert rows(harmed, "conv_id", "turn", "role", "text") == sorted(brute_damage(data), key=repr)
    assert rows(cr.repair(harmed, df), *COLUMNS) == brute_repair(brute_damage(data), [r[0] for r in data])
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in data]
    assert rows(cr.repair(df), *COLUMNS) == brute_repair(plain, [r[0] for r in data])


def test_repaired_rows():
    own = [("system", "s."), ("assistant", "a."), ("user", "x"), ("user", "u.")]
    assert list(cr.repaired_rows(iter(own), "KIKDKI")) == [("system", "s."), ("user", ""), ("assistant", "a."), ("user", "u."), ("assistant", "")]


def test_empty(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cr.repair(cr.damaged(none), none).count() == 0


def test_query(spark):
    data = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows(queries.op13_conversation_repair(spark, SF_SMALL), *COLUMNS) == brute_repair(brute_damage(data), [r[0] for r in data])
