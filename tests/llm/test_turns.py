import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from cadentia.llm import alignment as A
from cadentia.llm import turns as T


def _target(length):
    return ("s" if length % 2 else "") + "ua" * (length // 2)


def _cheapest(codes):
    """Every length of the grammar for itself, a full table of (cost, audit) from the end, no bands or blocks."""
    best = None
    for length in [0, *range(2, len(codes) + 4)]:
        target = _target(length)
        table = {}
        for i in range(len(codes), -1, -1):
            for j in range(length, -1, -1):
                ways = [(0, "")] if i == len(codes) and j == length else []
                if i < len(codes):
                    cost, rest = table[i + 1, j]
                    ways.append((cost + 2, "D" + rest))
                    if codes[i] != "x" and j < length:
                        cost, rest = table[i + 1, j + 1]
                        cost += 5 * codes[i].isupper()
                        if codes[i].lower() == target[j]:
                            ways.append((cost, "K" + rest))
                        if target[j] in "ua":
                            ways.append((cost + 1, "R" + rest))
                if j < length and target[j] in "ua":
                    cost, rest = table[i, j + 1]
                    ways.append((cost + 5, "I" + rest))
                table[i, j] = min(ways, default=(10**9, ""))
        best = table[0, 0] if best is None else min(best, table[0, 0])
    return best


def _by_blocks(codes, size):
    parts = [codes[i : i + size] for i in range(0, len(codes), size)] or [""]
    after = [list(A.END_COST)]
    for part in reversed(parts):
        after.insert(0, A.before(A.costs(part), after[0]))
    state, out = A.START, ""
    for part, rest in zip(parts, after[1:], strict=True):
        audit, state = A.audit(part, state, rest)
        out += audit
    return after[0][A.START], out + A.END_AUDIT[state]


@pytest.mark.parametrize("letters", ["ua", "suaoxSUAO", "xxua", "UAua", "oO", "sua", "xSs"])
def test_blocks_of_any_size_give_the_cheapest_least_audit(letters):
    r = random.Random(letters)
    for _ in range(150):
        codes = "".join(r.choices(letters, k=r.randint(0, 9)))
        want = _cheapest(codes)
        assert [_by_blocks(codes, size) for size in (1, 2, 3, 100)] == [want] * 4


def test_a_long_conversation_has_a_narrow_band():
    r = random.Random(7)
    codes = "".join(c for c in "ua" * 2000 if r.random() > 0.05)
    assert A.Block(codes).width < len(codes)
    assert _by_blocks(codes[:300], 512) == _by_blocks(codes[:300], 7) == _cheapest(codes[:300])
    whole = _by_blocks(codes, 512)
    assert whole == _by_blocks(codes, 100)


def _initial(role):
    return role[:1]


def _expected(rows, damage=True):
    """conv_id -> the contract's columns, row by row."""
    held = {}
    for conv, turn, role, text in rows:
        held.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        times = 1
        if damage:
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            kind = zlib.crc32(key.encode()) % 20
            times = {0: 0, 3: 2}.get(kind, 1)
            text = {1: "", 2: "".join(c for c in text if c not in ".!?")}.get(kind, text)
            role = "user" if kind == 4 else role
        held[conv] += [(turn, role, text)] * times
    return {conv: _repair(turns) for conv, turns in held.items()}


def _repair(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, codes, blank, duplicate, truncated = set(), "", 0, 0, 0
    for _, role, text in rows:
        solid = text.rstrip(" \t\n\x0b\x0c\r")
        copy = (role, text) in seen
        seen.add((role, text))
        kind = _initial(role) if _initial(role) in ("s", "u", "a") else "o"
        if not solid:
            blank, kind = blank + 1, "x"
        elif copy:
            duplicate, kind = duplicate + 1, "x"
        elif solid[-1] not in ".!?":
            truncated, kind = truncated + 1, kind.upper()
        codes += kind
    initials = [_initial(role) for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    numbers = [t for t, *_ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    cost, audit = _cheapest(codes)
    target, left, lines = _target(sum(e != "D" for e in audit)), list(rows), []
    for edit in audit:
        if edit != "I":
            _, role, text = left.pop(0)
        if edit != "D":
            to = {"u": "user", "a": "assistant", "s": "system"}[target[len(lines)]]
            lines.append(f"{to}:" if edit == "I" else f"{role if edit == 'K' else to}:{text}")
    return gaps, blank, duplicate, truncated, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


_SCHEMA = "conv_id long, turn long, role string, text string"
_COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _found(table):
    return {r.conv_id: tuple(r[c] for c in _COLUMNS) for r in table.collect()}


def _some(seed, conversations):
    r = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for turn in range(r.randint(1, 12)):
            role = r.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "usher"])
            text = r.choice(["Yes.", "No!", "no end", "", " \t\n", None, f"{turn} and more?", "é́ \U0001f600.", ". "])
            rows.append((conv, r.choice([turn, turn, turn, None, turn + 3]), role, text))
    rows += [(None, 0, "user", "a."), (None, 1, "assistant", "b."), (None, None, None, None)]
    return rows + rows[:20]


@pytest.mark.parametrize("size", [2, 512])
def test_query_matches_brute_force(spark, tmp_path, monkeypatch, size):
    monkeypatch.setattr(T, "ROWS", size)
    rows = _some(1, 60)
    spark.createDataFrame(rows, _SCHEMA).withColumns({c: F.lit(1) for c in ("n", "part", "copies", "kind")}).repartition(5).write.parquet(
        f"{tmp_path}/conversations.parquet"
    )
    found = T.op12_turn_repair(spark, str(tmp_path))
    assert found.columns[:9] == ["conv_id", *_COLUMNS[:5], "cost", "audit", "repaired_sha256"]
    assert _found(found) == _expected(rows)


def test_all_rows_dropped_and_no_rows(spark, tmp_path):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    table = spark.createDataFrame([(dropped, 0, "user", "Hi.")], _SCHEMA)
    table.write.parquet(f"{tmp_path}/a/conversations.parquet")
    table.limit(0).write.parquet(f"{tmp_path}/b/conversations.parquet")
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert _found(T.op12_turn_repair(spark, f"{tmp_path}/a")) == {dropped: nothing}
    assert T.op12_turn_repair(spark, f"{tmp_path}/b").collect() == []


def test_operator_on_rows_as_they_are(spark, monkeypatch):
    monkeypatch.setattr(T, "ROWS", 5)
    rows = [("b", 1, "system", "Be kind."), ("b", 2, "user", "Hello!"), ("b", 2, "user", "Hello!"), ("b", 3, "user", "cut off"), ("b", 9, "user", "Why?")]
    rows += [("a", t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(41)]
    found = T.settled(spark.createDataFrame(rows, _SCHEMA.replace("conv_id long", "conv_id string"))).cache()
    assert _found(T.conversations(found)) == _expected(rows, damage=False)
    turns = T.repaired_turns(found).orderBy("conv_id", "part", "nth", "at").collect()
    assert [(r.role, r.text) for r in turns if r.conv_id == "b"] == [("system", "Be kind."), ("user", "Hello!"), ("assistant", "Why?")]
    assert [r.text for r in turns if r.conv_id == "a"][:40] == [f"turn {t}." for t in range(40)]
    assert found.filter("conv = 'a'").count() > 8  # blocks, not one row


def test_a_hot_conversation_of_one_text_meets_its_copies_before_it_moves(spark):
    rows = spark.range(3000).selectExpr("7L AS conv_id", "id AS turn", "'user' AS role", "'Same.' AS text")
    found = _found(T.conversations(T.settled(rows)))
    assert found[7][:6] == (0, 0, 2999, 0, 2999, 2 * 2999 + 2)
    assert found[7][6] == "D" * 3000
