import hashlib
import random
import re
import sys
import zlib
from functools import lru_cache

import pytest

from tillsight.llm import conversation_repair as cr
from tillsight.llm import queries

sys.setrecursionlimit(100_000)
SCHEMA = "conv_id bigint, turn bigint, role string, text string, cost string, `key` int"


def damage(rows):
    out = []
    for c, t, r, x in rows:
        say = lambda v: " " if v is None else str(v)
        kind, r, x = zlib.crc32(f"{say(c)}:{say(t)}".encode()) % 20, say(r), say(x)
        if kind == 0:
            continue
        if kind == 1:
            x = ""
        if kind == 2:
            x = re.sub("[.!?]", "", x)
        if kind == 4:
            r = "user"
        out += [(c, t, r, x)] * (2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit, repaired rows) by trying every edit; rows: (role, text, fault)."""
    @lru_cache(None)
    def go(i, state, spare):
        found = []
        if i == len(rows) and state in (0, 3):
            found.append((0, "", ()))
        nxt = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}[state]
        if spare:
            c, a, r = go(i, nxt[1], spare - 1)
            found.append((c + 2, "I" + a, ((nxt[0], ""), *r)))
        if i < len(rows):
            role, text, fault = rows[i]
            c, a, r = go(i + 1, state, 3)
            found.append((c + 3, "D" + a, r))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                first = role[:1]
                after = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((first, state))
                if after is not None:
                    c, a, r = go(i + 1, after, 3)
                    found.append((c + more, "K" + a, ((role, text), *r)))
                c, a, r = go(i + 1, nxt[1], 3)
                found.append((c + more + 2, "R" + a, ((nxt[0], text), *r)))
        return min(found, key=lambda f: f[:2]) if found else (10 ** 9, "", ())
    return go(0, 0, 3)


def brute(original):
    out = {}
    for c in {r[0] for r in original}:
        rows = sorted((r for r in damage(original) if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen, judged = set(), []
        for _, _, role, text in rows:
            body = text.strip(" \t\n\x0b\f\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
            seen.add((role, text))
            judged.append((role, text, fault))
        turns = [r[1] for r in rows if r[1] is not None]
        count = lambda f: sum(j[2] == f for j in judged)
        cost, audit, left = cheapest(tuple(judged)) if judged else (0, "", ())
        pairs = zip(judged, judged[1:], strict=False)
        out[c] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, count("blank"), count("duplicate"), count("truncated"),
                  sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in pairs), cost, audit,
                  hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest())
    return out


def made(seed, convs, longest):
    rnd = random.Random(seed)
    rows = []
    for c in range(convs):
        turn = 0
        for _ in range(rnd.randint(0, longest)):
            turn += rnd.choice((0, 1, 1, 1, 3))
            rows.append((None if c == 5 else c, None if rnd.random() < 0.03 else turn,
                         rnd.choice(["user", "assistant", "assistant", "user", "system", "tool", None, "", "u", "Über"]),
                         rnd.choice(["Hi.", "Hello there!", "cut", "Right? \n", "", " \t", None, "ok", "Yes.", "No? ", "." , "a\x0b"]) if rnd.random() < 0.5
                         else f"say {rnd.randint(0, 10 ** 6)}."))
    return rows


def result(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def test_equals_brute_force(spark):
    rows = made(1, 150, 14)
    df = frame(spark, rows)
    got = cr.repair(cr.damaged(df), df)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert got.count() == len({r[0] for r in rows})
    assert result(got) == brute(rows)


@pytest.mark.parametrize("partitions", [1, 7])
def test_conversations_of_many_pieces(spark, monkeypatch, partitions):
    """Pieces of three rows and a range partitioning that cuts conversations give the same repair."""
    monkeypatch.setattr(cr, "PIECE_ROWS", 3)
    rows = made(2, 12, 60)
    df = frame(spark, rows)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        assert result(cr.repair(cr.damaged(df), df)) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_repeated_rows_and_one_hot_conversation(spark):
    """A third of all rows is one conversation, a third is one row over and over."""
    rows = [(1, t, "user" if t % 2 else "assistant", "fine." if t % 5 else f"turn {t}") for t in range(300)]
    rows += [(2, 7, "user", "again.")] * 300 + made(3, 60, 10)
    rows = [(100 + c if c and i >= 600 else c, *r) for i, (c, *r) in enumerate(rows)]
    df = frame(spark, rows)
    assert result(cr.repair(cr.damaged(df), df)) == brute(rows)


def test_tables_without_rows(spark):
    df = frame(spark, [])
    assert cr.repair(cr.damaged(df), df).count() == 0
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    df = frame(spark, [(gone, 1, "user", "Hi.")])
    assert result(cr.repair(cr.damaged(df), df)) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_long_text(spark):
    rows = [(1, 0, "user", "word " * 600_000 + "."), (1, 1, "assistant", "b " * 700_000), (1, 2, "user", "c.")]
    df = frame(spark, rows).select("conv_id", "turn", "role", "text")
    got = result(cr.repair(df))
    assert got[1][5:7] == (3, "KKKI")


def test_signatures_that_end_alike(spark):
    """Nodes taken over from the row before give each signature its own audit."""
    words = [("uaua", 1), ("saua", 2), ("aua", 1), ("Uaua", 1), ("xd", 1)]
    df = spark.createDataFrame([(list(cr.END), True, w, True, n) for w, n in words],
                               "behind array<bigint>, final boolean, signature string, whole boolean, n bigint")
    table = {r["signature"]: r for r in cr.automaton(df).collect()}
    assert table["uaua"]["audits"] == ["KKKK"] and table["uaua"]["costs"] == [0]
    assert table["Uaua"]["costs"] == [1] and table["aua"]["audits"] == ["IKKK"]


def test_every_conversation_of_the_table(spark):
    sf = "/root/testdata/sf0.001"
    got = result(queries.QUERIES["op13_conversation_repair"](spark, sf))
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got == brute(rows)
