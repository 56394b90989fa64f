import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from snapmart.llm import turnrepair as tr
from snapmart.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string, copies string"
SOUND = re.compile(r"(s?(ua)+)?\Z")


def by_table(codes, goals=(0, 3), start=0):
    """Least (cost, audit) by dynamic programming from the end."""
    best = {s: ((0, "") if s in goals else None) for s in range(4)}

    def with_inserts(best):
        for _ in range(4):
            for s in range(4):
                if best[tr.NEXT[s]]:
                    c, a = best[tr.NEXT[s]]
                    best[s] = min(x for x in (best[s], (c + 5, "I" + a)) if x)
        return best

    best = with_inserts(best)
    for initial, forced, cut in reversed(codes):
        now = {}
        for s in range(4):
            ways = [(best[s][0] + 2, "D" + best[s][1])] if best[s] else []
            if not forced:
                kept = tr.STEP.get((s, initial))
                if kept is not None and best[kept]:
                    ways.append((best[kept][0] + 5 * cut, "K" + best[kept][1]))
                if best[tr.NEXT[s]]:
                    c, a = best[tr.NEXT[s]]
                    ways.append((c + 1 + 5 * cut, "R" + a))
            now[s] = min(ways) if ways else None
        best = with_inserts(now)
    return best[start]


def random_codes(rng, n, initials="suauauat "):
    return [(rng.choice(initials), rng.random() < 0.15, rng.random() < 0.15) for _ in range(n)]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 9, 30])
def test_search_is_the_least_path(n):
    rng = random.Random(n)
    for _ in range(120):
        codes = random_codes(rng, n, rng.choice(["suauauat ", "ua", "u", "as", "tu "]))
        assert tr.search(codes) == by_table(codes)
        for start in range(4):
            for end in range(4):
                assert tr.search(codes, start, (end,)) == by_table(codes, (end,), start)


def test_estimate_never_exceeds_the_cost():
    rng = random.Random(5)
    for _ in range(400):
        codes = random_codes(rng, rng.randrange(12))
        user, assistant = tr._estimates(codes)
        for start in range(4):
            assert (assistant if start == 2 else user)[0] <= by_table(codes, (0, 1, 2, 3), start)[0]


def test_blocks_give_what_the_whole_gives(monkeypatch):
    rng = random.Random(7)
    monkeypatch.setattr(tr, "BLOCK", 4)
    for _ in range(60):
        codes = random_codes(rng, rng.randrange(5, 40))
        assert tr.solve(codes) == by_table(codes)


def test_a_long_conversation_is_searched_in_time():
    codes = random_codes(random.Random(1), 3000, "uauauauasu")
    assert tr.solve(codes) == by_table(codes)


def test_every_row_of_one_role():
    codes = [("u", False, False)] * 400
    assert tr.solve(codes) == by_table(codes)


def brute(rows):
    """The contract, row by row, over (conv_id, turn, role, text); rows as damaged come by turn, role, text."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        hit = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        role = "user" if hit == 4 else role
        convs[c] += [(turn, role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    return {c: expected(said) for c, said in convs.items()}


def expected(said):
    said = sorted(said, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    codes, faults = [], []
    for i, (_, role, text) in enumerate(said):
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = "blank" if not solid else "dup" if (role, text) in [r[1:] for r in said[:i]] else "cut" if solid[-1] not in ".!?" else ""
        faults.append(fault)
        codes.append((role[:1], fault in ("blank", "dup"), fault == "cut"))
    cost, audit = by_table(codes)
    out, left, state = [], list(said), ""
    for edit in audit:
        role, text = left.pop(0)[1:] if edit != "I" else (None, "")
        if edit == "D":
            continue
        if edit in "RI":
            role = "assistant" if state == "u" else "user"
        out.append((role, text))
        state = role[:1]
    assert SOUND.match("".join(r[:1] for r, _ in out)) and not left
    turns = {t for t, _, _ in said if t is not None}
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("dup"), faults.count("cut"), illegal, cost, audit, sha)


def collected(df):
    rows = df.select("conv_id", *tr.RESULT).collect()
    out = {r.conv_id: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert collected(QUERIES["op12_conversation_repair"](spark, SF)) == brute(rows)


ODD = [
    (1, None, None, None), (1, None, "user", "x."), (1, 0, "user", "x."), (1, 0, "user", "x."), (1, 0, "assistant", "y?"),
    (None, 1, "user", "a."), (None, 2, "assistant", "b!"), (2, 5, "tool", "t."), (2, 9, "", "u"), (3, None, "user", ""),
    *((4, t, "user" if t % 2 else "assistant", "long " * 20_000 + f"{t}.") for t in range(6)),
    *((5, 1, "user", "same.") for _ in range(50)),
    *((6, t, ("system", "user", "assistant", "user")[t % 4], f"{t % 7}{'.' if t % 5 else ' '}") for t in range(150)),
    *((c, t, "user", "gone.") for c in range(100, 160) for t in (0,)),
]


@pytest.mark.parametrize("limits", [{}, {"limit": 3, "block": 4, "fan": 2}, {"limit": 20, "block": 7, "fan": 3}, {"limit_bytes": 1000}])
def test_odd_rows_short_and_long(spark, limits):
    rows = spark.createDataFrame([(*r, "x") for r in ODD], SCHEMA)
    assert collected(tr.repaired(tr.damaged(rows), **limits)) == brute(ODD)


def test_conversation_of_which_all_rows_are_dropped(spark):
    lost = [c for c in range(500) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    rows = spark.createDataFrame([(c, 0, "user", "a.", "") for c in lost], SCHEMA)
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert collected(tr.repaired(tr.damaged(rows))) == {c: empty for c in lost}
    assert collected(tr.repaired(tr.damaged(rows), limit=0)) == {c: empty for c in lost}
    assert tr.repaired(tr.damaged(rows.limit(0))).count() == 0


def test_rows_that_need_no_damage(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a.", ""), (1, 1, "user", "b.", ""), (1, 2, "assistant", "c.", "")], SCHEMA)
    (got,) = tr.repaired(tr.undamaged(rows)).collect()
    assert (got.cost, got.audit) == (2, "DKK")
