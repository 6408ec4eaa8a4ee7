"""Repaired conversations against a search over whole edit texts, also when everything spills."""

from __future__ import annotations

import collections
import hashlib
import random
import sys
import zlib
from functools import lru_cache

import pyarrow.parquet as pq
import pytest

from clickflow.llm import conversation_repair as repair

SMALL = "/root/testdata/sf0.01"
SPILLING = {"block_rows": 3, "blocks": 2, "text_bytes": 500, "seen_rows": 3}
BLANKS = " \t\n\x0b\x0c\r"
NEXT = {"": "user", "s": "user", "u": "assistant", "a": "user"}  # by the initial before


def brute_damage(rows):
    out = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        harm = zlib.crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if harm == 1:
            text = ""
        if harm == 2:
            text = "".join(c for c in text if c not in ".!?")
        if harm == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(harm, 1)
    return out


def brute_repair(rows):
    """Faults, cost, audit and repaired text of one conversation, by the least (cost, audit)."""
    sys.setrecursionlimit(20_000)
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults, seen = [], set()
    for _, role, text in rows:
        end = text.strip(BLANKS)[-1:]
        faults.append("blank" if not end else "duplicate" if (role, text) in seen else
                      "truncated" if end not in ".!?" else "")
        seen.add((role, text))

    @lru_cache(None)
    def best(k, last, inserted):
        """The least (cost, audit, rows) from row k on, after a turn with this initial."""
        ways = []
        if k == len(rows) and last in ("", "a"):
            ways.append((0, "", ()))
        if inserted < 2:
            cost, audit, kept = best(k, NEXT[last][0], inserted + 1)
            ways.append((cost + 2, "I" + audit, ((NEXT[last], ""), *kept)))
        if k < len(rows):
            _, role, text = rows[k]
            cost, audit, kept = best(k + 1, last, 0)
            ways.append((cost + 3, "D" + audit, kept))
            if faults[k] not in ("blank", "duplicate"):
                more = faults[k] == "truncated"
                if role and (last + role[0]) in {"s", "u", "su", "ua", "au"}:
                    cost, audit, kept = best(k + 1, role[0], 0)
                    ways.append((cost + more, "K" + audit, ((role, text), *kept)))
                for due in ("user", "assistant"):
                    if (last + due[0]) in {"u", "su", "ua", "au"}:
                        cost, audit, kept = best(k + 1, due[0], 0)
                        ways.append((cost + 2 + more, "R" + audit, ((due, text), *kept)))
        return min(ways, default=(10 ** 9, "", ()))

    cost, audit, kept = best(0, "", 0)
    turns = {t for t, _, _ in rows if t is not None}
    counts = collections.Counter(faults)
    illegal = sum((a[1][:1] + b[1][:1]) not in {"su", "ua", "au"} for a, b in zip(rows, rows[1:]))
    text = "\n".join(f"{role}:{said}" for role, said in kept)
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, counts["blank"], counts["duplicate"],
            counts["truncated"], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def assert_repaired(spark, rows, df, **limits):
    damaged = brute_damage(rows)
    got = {r[0]: tuple(r)[1:] for r in repair.audits(repair.damaged(df), **limits).collect()}
    assert got.keys() == {r[0] for r in rows}
    for conv in got:
        assert got[conv] == brute_repair(damaged[conv]), (conv, damaged[conv])
    return damaged


def random_rows(seed, conversations=300):
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "unknown"])
            text = rng.choice(["Hi.", "Yes!", "no end", "What? ", " \n", None, f"{turn}.", "Ünd　", "　", ""])
            rows.append((conv if conv % 50 else None, rng.choice([turn, turn, turn + 3, None, 10 ** 12]), role, text))
    return rows


TYPES = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize("limits", [{}, SPILLING])
def test_random_conversations_equal_brute_force(spark, limits):
    rows = random_rows(3)
    assert_repaired(spark, rows, spark.createDataFrame(rows, TYPES), **limits)


def test_whole_table_equals_brute_force(spark):
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in pq.read_table(
        f"{SMALL}/conversations.parquet").to_pylist()]
    found = repair.op12_conversation_repair(spark, SMALL).collect()
    damaged = brute_damage(rows)
    assert {tuple(r) for r in found} == {(conv, *brute_repair(damaged[conv])) for conv in {r[0] for r in rows}}


def test_long_conversation_spills_and_repairs(spark):
    rng = random.Random(5)
    rows = [(1, k, rng.choice(["user", "assistant"]), rng.choice([f"{k}.", f"{k}", "again.", "x" * 500])) for k in range(200)]
    rows += [(2, 0, "system", "s" * 200_000 + "."), (2, 1, "user", "u."), (2, 2, "assistant", "a.")]
    df = spark.createDataFrame(rows, TYPES)
    assert_repaired(spark, rows, df, **SPILLING)
    kept = collections.defaultdict(list)
    for r in sorted(repair.repaired(df, **SPILLING).collect()):
        kept[r.conv_id].append(r)
    assert [r.turn for r in kept[1]] == list(range(len(kept[1])))
    assert all(r.role == ("user", "assistant")[r.turn % 2] for r in kept[1]) and len(kept[1]) % 2 == 0
    digests = {r.conv_id: r.repaired_sha256 for r in repair.audits(df).collect()}
    for conv, said in kept.items():
        text = "\n".join(f"{r.role}:{r.text}" for r in said)
        assert hashlib.sha256(text.encode()).hexdigest() == digests[conv]


def test_edges(spark):
    empty = spark.createDataFrame([], TYPES)
    assert repair.audits(repair.damaged(empty)).count() == 0 and repair.repaired(empty).count() == 0
    named = spark.createDataFrame(
        [("c", 1, "user", "a.", "x", True)], "conv_id string, turn int, role string, text string, harm string, blank boolean")
    assert repair.audits(repair.damaged(named)).first()["audit"] == "KI"
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    row = repair.audits(repair.damaged(spark.createDataFrame([(gone, 0, "user", "a.")], TYPES))).first()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
