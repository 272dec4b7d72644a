import hashlib
import random
import re
import sys
import zlib
from functools import cache

import pytest

from vitalgrid.llm import repair as R

sys.setrecursionlimit(20_000)
BLANKS = " \t\n\v\f\r"


def after_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        plain = [" " if x is None else str(x) for x in (conv, turn, role, text)]
        fate = zlib.crc32(f"{plain[0]}:{plain[1]}".encode()) % 20
        if fate:
            text = "" if fate == 1 else re.sub("[.!?]", "", plain[3]) if fate == 2 else plain[3]
            out += [(conv, turn, "user" if fate == 4 else plain[2], text)] * (2 if fate == 3 else 1)
    return out


def cheapest(rows):
    """Cost, edits and turns of the cheapest repair of (role, text, fault), by trying every way; least edits of equal cost."""
    ask, then = {"": "u", "s": "u", "u": "a", "a": "u"}, {"u": "u", "a": "a", "s": "s"}

    @cache
    def rest(i, state, inserted):
        ways = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        if inserted < 2:
            c, e, t = rest(i, ask[state], inserted + 1)
            ways.append((c + 2, "I" + e, ((ask[state], None),) + t))
        if i < len(rows):
            role, _, fault = rows[i]
            c, e, t = rest(i + 1, state, 0)
            ways.append((c + 3, "D" + e, t))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if role[:1] == ask[state] or role[:1] == "s" and state == "":
                    c, e, t = rest(i + 1, then[role[:1]], 0)
                    ways.append((c + extra, "K" + e, (("K", i),) + t))
                c, e, t = rest(i + 1, ask[state], 0)
                ways.append((c + 2 + extra, "R" + e, ((ask[state], i),) + t))
        return min(ways, key=lambda w: w[:2], default=(10**9, "", ()))

    cost, edits, turns = rest(0, "", 0)
    name = {"u": "user", "a": "assistant"}
    lines = [f"{rows[i][0] if r == 'K' else name[r]}:{rows[i][1] if i is not None else ''}" for r, i in turns]
    return cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def brute(rows):
    damaged, out = after_damage(rows), []
    for conv in {r[0] for r in rows}:
        own = sorted((r[1:] for r in damaged if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, told = set(), []
        for _, role, text in own:
            core = text.strip(BLANKS)
            told.append((role, text, "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else "none"))
            seen.add((role, text))
        turns = [r[0] for r in own if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults = [t[2] for t in told]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(told, told[1:]))
        out.append((conv, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, *cheapest(tuple(told))))
    return sorted(out, key=repr)


def frame(spark, rows):
    schema = "conv_id long, turn long, role string, text string, run string, fault long, copies string, symbols string"
    return spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], schema).repartition(3)


def got(spark, rows, chunk=R.CHUNK):
    return sorted((tuple(r) for r in R.repaired(frame(spark, rows), chunk=chunk).collect()), key=repr)


def conversations(seed, many=60, longest=14):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(many)]:
        for turn in range(rng.randrange(1, longest)):
            role = rng.choice(["user", "assistant"][turn % 2 : turn % 2 + 1] * 6 + ["system", "user", "assistant", "tool", "unknown", "", None])
            text = rng.choice(["Hello. ", "How are you?", "Cut of", "Fine!\n", f"No {turn}.", "Yes.", "  \t", "", None, "é 日本。", "a.b"])
            rows += [(conv, rng.choice([turn] * 9 + [None, turn + 5]), role, text)] * rng.choice([1] * 12 + [2])
    return rows


@pytest.mark.parametrize("seed, chunk", [(1, R.CHUNK), (2, 1), (3, 4)])
def test_against_every_way(spark, seed, chunk):
    """Chunks of any length give the result of the whole conversation."""
    rows = conversations(seed)
    want = brute(rows)
    assert got(spark, rows, chunk) == want
    assert {e for w in want for e in w[7]} == set("DIKR") and len({w[6] for w in want}) > 5


def test_long_conversation_with_copies(spark):
    """One conversation over many chunks and partitions, a turn that repeats hundreds of times, and a long text."""
    rng = random.Random(4)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", f"No {t}.", "", "open"])) for t in range(400)]
    rows += [(1, 50, "user", "again.")] * 300 + [(2, 1, "user", "long " * 100_000 + ".")] + [(3, 1, "assistant", "same?")] * 200
    assert got(spark, rows, 16) == got(spark, rows, 250) == brute(rows)


def test_edges(spark):
    assert got(spark, []) == []
    dropped = next(k for k in range(200) if zlib.crc32(f"{k}:1".encode()) % 20 == 0)
    rows = [(dropped, 1, "user", "Gone."), (None, None, None, None), (None, None, None, None)]
    result = got(spark, rows)
    assert result == brute(rows)
    empty = hashlib.sha256(b"").hexdigest()
    assert (dropped, 0, 0, 0, 0, 0, 0, "", empty) in result


@pytest.mark.parametrize("seed", range(8))
def test_prices_are_a_dual_solution(seed):
    """No arc is cheaper than the fall of the price along it, and the price of the origin is the cost."""
    rng = random.Random(seed)
    symbols = "".join(rng.choice("suaoSUAOx") for _ in range(rng.randrange(1, 12)))
    graph = R.arcs(symbols)
    for leave in (R.USER, R.ASSISTANT):
        goal = 4 * len(symbols) + leave
        good = R.reaching(graph, goal)
        pruned = [[a for a in own if good[a[2]]] for own in graph]
        price = [0] * len(graph)
        if good[R.START]:
            cost = R.auction(pruned, price, R.START, goal)
            assert all(price[n] <= c + price[h] for n, own in enumerate(pruned) for c, _, h in own)
            assert cost == R.solved(symbols)[R.START][leave][0]
