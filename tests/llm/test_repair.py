import hashlib
import heapq
import random
import zlib

from cartloom.llm import repair


def brute(rows):
    """Least cost and audit by a best-first search over edits, symbol by symbol."""
    found, seen = [], set()
    for role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        found.append("b" if not body else "d" if (role, text) in seen else "" if body[-1] in ".!?" else "t")
        seen.add((role, text))
    # Costs first, then audits: the first end that comes out is the least of both.
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, out = heapq.heappop(heap)
        if i == len(rows) and last in ("", "a"):
            return cost, audit, out
        if (i, last, audit) in done:
            continue
        done.add((i, last, audit))
        follows = {"": "su", "s": "u", "u": "a", "a": "u"}[last]
        for symbol in follows:
            if symbol != "s":
                role = {"u": "user", "a": "assistant"}[symbol]
                heapq.heappush(heap, (cost + 5, audit + "I", i, symbol, (*out, (role, ""))))
            if i < len(rows) and found[i] in ("", "t"):
                extra = 5 if found[i] else 0
                if rows[i][0][:1] == symbol:
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, symbol, (*out, rows[i])))
                if symbol != "s":
                    heapq.heappush(heap, (cost + extra + 1, audit + "R", i + 1, symbol, (*out, (role, rows[i][1]))))
        if i < len(rows):
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, last, out))


def conversation(draw, size, roles=("system", "user", "assistant", "user", "assistant", "tool", " ", "")):
    return [(draw.choice(roles), draw.choice(["Yes.", "No!", "cut", "Why?", " \t", "", "And so.", f"Text {n}.", f"half {n}", f"Open {n}?"])) for n in range(size)]


def test_equals_search():
    draw = random.Random(5)
    for trial in range(400):
        rows = conversation(draw, draw.randint(0, 8))
        got = repair.repair_rows(list(range(len(rows))), rows)
        cost, audit, out = brute(rows)
        assert (got["cost"], got["audit"]) == (cost, audit), rows
        assert [(t["role"], t["text"]) for t in got["repaired"]] == list(out), rows


def grammar_cost(rows):
    """Least cost by states of the grammar instead of symbols of a target."""
    found = repair.faults(rows)
    never = 10**9
    cost = {"": 0, "s": never, "u": never, "a": never}

    def inserted(c):
        c = dict(c)
        for _ in range(2):
            c["u"] = min(c["u"], 5 + min(c[""], c["s"], c["a"]))
            c["a"] = min(c["a"], 5 + c["u"])
        return c

    cost = inserted(cost)
    for (role, _), fault in zip(rows, found, strict=True):
        new = {k: v + 2 for k, v in cost.items()}
        if fault in ("", "truncated"):
            extra = 5 if fault else 0
            new["s"] = min(new["s"], cost[""] + extra + (0 if role[:1] == "s" else never))
            new["u"] = min(new["u"], min(cost[""], cost["s"], cost["a"]) + extra + (role[:1] != "u"))
            new["a"] = min(new["a"], cost["u"] + extra + (role[:1] != "a"))
        cost = inserted(new)
    return min(cost[""], cost["a"])


def test_long_conversations():
    draw = random.Random(6)
    for size in (150, 700, 3000):
        rows = [(role if draw.random() < 0.9 else "user", f"Line {n}" + ("." if draw.random() < 0.9 else "")) for n, role in enumerate(["user", "assistant"] * (size // 2))]
        rows = [r for r in rows if draw.random() < 0.95]
        got = repair.repair_rows([None] * len(rows), rows)
        assert got["cost"] == grammar_cost(rows)
        assert got["gaps"] == 0
        initials = "".join(t["role"][0] for t in got["repaired"])
        assert initials == "ua" * (len(initials) // 2)
        assert len(got["audit"]) - got["audit"].count("I") == len(rows)


def test_blocks_do_not_matter(monkeypatch):
    draw = random.Random(7)
    trials = [conversation(draw, 40, ("user", "assistant")) for _ in range(30)]
    whole = [repair.repair_rows(list(range(40)), rows) for rows in trials]
    monkeypatch.setattr(repair, "STEP", 7)
    assert [repair.repair_rows(list(range(40)), rows) for rows in trials] == whole


ROWS = "conv_id bigint, turn bigint, role string, text string, audit string, cost int"


def odd(spark):
    rows = [(1, None, None, None), (1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, 2, "assistant", "word " * 20000 + "end."), (None, 1, "user", "a."), (None, None, "user", None)]
    draw = random.Random(8)
    for conv in range(60):
        rows += [(100 + conv, t + (t > 3), draw.choice(["user", "assistant", "system", None]), draw.choice(["One.", "Two", "Three!", None, "", f"N {t}."])) for t in range(draw.randint(1, 9))]
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], ROWS)


def test_query_equals_brute_force(spark):
    frame = odd(spark)
    wanted = {}
    by_id = {}
    for r in frame.collect():
        by_id.setdefault(r["conv_id"], []).append(r)
    for conv, rows in by_id.items():
        kept = []
        for r in rows:
            key = f"{' ' if conv is None else conv}:{' ' if r['turn'] is None else r['turn']}"
            case = zlib.crc32(key.encode()) % 20
            role, text = (" " if v is None else v for v in (r["role"], r["text"]))
            text = "" if case == 1 else text.translate({ord(c): None for c in ".!?"}) if case == 2 else text
            kept += [(r["turn"], "user" if case == 4 else role, text)] * (0 if case == 0 else 2 if case == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        cost, audit, out = brute([r[1:] for r in kept])
        turns = {r[0] for r in kept} - {None}
        firsts = [r[1][:1] for r in kept]
        wanted[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:])),
            cost, audit, hashlib.sha256("\n".join(f"{a}:{b}" for a, b in out).encode()).hexdigest(),
        )
    got = {r["conv_id"]: (r["gaps"], r["illegal"], r["cost"], r["audit"], r["repaired_sha256"]) for r in repair.report(frame).collect()}
    assert got == wanted
    assert repair.report(frame.limit(0)).count() == 0
    assert repair.repair(frame).count() == len(by_id)


def test_all_rows_dropped(spark):
    turn = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    row = repair.report(spark.createDataFrame([(5, turn, "user", "Hi.", "", 0)], ROWS)).collect()
    assert [tuple(r) for r in row] == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
