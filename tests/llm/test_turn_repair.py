"""Conversation repair against a search over all edits, with conversations cut into few and many blocks."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from voltloom.llm import turn_repair as T

ROWS = "conv_id bigint, turn bigint, role string, text string, pos string, edit int"
LAWFUL = re.compile(r"(s?(ua)+)?$")


def cheapest(rows):
    """(cost, letters, lines) by a shortest-path search whose order is (cost, letters); rows are (role, text, fault)."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, made, lines = heapq.heappop(heap)
        tail = made[-1:] if made[-1:] != "s" or len(made) == 1 else "x"
        if i == len(rows) and LAWFUL.match(made):
            return cost, audit, list(lines)
        if (i, tail) in seen:
            continue
        seen.add((i, tail))

        def go(n, letter, j, role=None, text=""):
            now = made + ((role[:1] or "?") if role is not None else "")  # an empty role fits nowhere
            if any(LAWFUL.match(now + end) for end in ("", "a", "ua")):
                heapq.heappush(heap, (cost + n, audit + letter, j, now, lines + ((f"{role}:{text}",) if role is not None else ())))

        for role in ("user", "assistant"):
            go(2, "I", i, role)
        if i < len(rows):
            role, text, fault = rows[i]
            go(3, "D", i + 1)
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                go(extra, "K", i + 1, role, text)
                for to in ("user", "assistant"):
                    go(2 + extra, "R", i + 1, to, text)


def plain(rows):
    """Expected digest per conversation of rows (conv_id, turn, role, text)."""
    convs = {}
    for c, t, r, x, *_ in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, " " if r is None else r, " " if x is None else x))
    out = {}
    for c, said in convs.items():
        said.sort(key=lambda s: (s[0], s[1], s[2].encode(), s[3].encode()))
        turns = {t for known, t, _, _ in said if known}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        seen, faults = set(), []
        for _, _, r, x in said:
            body = x.strip("\x20\x09\x0a\x0b\x0c\x0d")
            faults.append("blank" if not body else "duplicate" if (r, x) in seen else "truncated" if body[-1] not in ".!?" else "")
            seen.add((r, x))
        illegal = sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
        cost, audit, lines = cheapest([(r, x, f) for (_, _, r, x), f in zip(said, faults)])
        out[c] = (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def digests(spark, rows):
    df = spark.createDataFrame(rows, ROWS)
    got = T.audited(df, df).collect()
    assert len(got) == len({r["conv_id"] for r in got})
    return {r["conv_id"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in got}


def made_up(rng, conv, n):
    roles = ["system", "user", "assistant", "tool", "user", "assistant", "", "aide", None]
    texts = ["Yes.", "no", "", " \n", "Why?", "é!", None, "cut off ", "Well. ", " "]
    return [(conv, rng.choice([None, *range(9)]), rng.choice(roles), rng.choice(texts) if rng.random() < .6 else f"t{rng.random()}.", None, 1) for _ in range(n)]


@pytest.mark.parametrize("bits", [12, 1, 0])
def test_repairs_match_a_full_search(spark, monkeypatch, bits):
    monkeypatch.setattr(T, "BLOCK_BITS", bits)
    rng = random.Random(bits)
    rows = [r for conv in [None, *range(60)] for r in made_up(rng, conv, rng.choice((1, 2, 3, 5, 9, 30)))]
    rows += [(100, i, "user", "x", None, 0) for i in range(5)] + [(101, 0, "system", "s.", None, 0), (102, 0, "assistant", "a.", None, 0)]
    rows.append((103, 0, "user", "long text " * 100_000 + ".", None, 0))
    assert digests(spark, rows) == plain(rows)


def test_one_long_conversation_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(T, "BLOCK_BITS", 5)
    rng = random.Random(8)
    rows = [(7, i // 2, rng.choice(("user", "assistant", "system", "x")), rng.choice(("a.", "b", f"{i}!", f"{i}?", f"{i}")), None, None) for i in range(1500)]
    rows += made_up(rng, 8, 40)
    assert digests(spark, rows) == plain(rows)


def test_lines_spell_the_repaired_conversation(spark):
    rows = [(1, 0, "user", "Hi.", "p", 1), (1, 0, "user", "Hi.", "p", 1), (1, 1, "user", "Hello.", "p", 1), (1, 3, "assistant", " ", "p", 1), (1, 4, "user", "Bye!", "p", 1)]
    counts, lines = T.repair(spark.createDataFrame(rows, ROWS))
    got = [(r["edit"], r["role"], r["text"]) for r in lines.orderBy("conv", "pos", "at").collect()]
    assert got == [("K", "user", "Hi."), ("D", "user", "Hi."), ("I", "assistant", ""), ("K", "user", "Hello."), ("D", "assistant", " "), ("R", "assistant", "Bye!")]
    assert counts.first().asDict() == {"conv": "1", "conv_id": 1, "gaps": 1, "blank": 1, "duplicate": 1, "truncated": 0, "illegal": 2, "cost": 3 + 2 + 3 + 2}


def test_empty_tables_and_lost_conversations(spark):
    empty = spark.createDataFrame([], ROWS)
    assert T.audited(empty, empty).count() == 0
    some = spark.createDataFrame([(1, 0, "user", "a.", None, 0), (None, 0, "user", "a.", None, 0)], ROWS)
    got = T.audited(some, empty).collect()
    assert sorted((r["conv_id"] is None, r["gaps"], r["cost"], r["audit"], r["repaired_sha256"]) for r in got) == [(b, 0, 0, "", hashlib.sha256(b"").hexdigest()) for b in (False, True)]


def test_damage(spark):
    rows = [(c, t, "assistant", "A. b! c? d", None, 1) for c in [None, *range(40)] for t in (None, 0, 1)] + [(5, 9, None, None, None, 1)]
    got = sorted(map(tuple, T.damage(spark.createDataFrame(rows, ROWS)).collect()), key=repr)
    want = []
    for c, t, r, x, *_ in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = r or " ", x or " "
        x = "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x
        want += [(c, t, "user" if k == 4 else r, x)] * (0 if k == 0 else 2 if k == 3 else 1)
    assert got == sorted(want, key=repr)


def test_checkpoints_are_few_and_exact():
    rng = random.Random(3)
    codes = bytes(rng.choice((0, 1, 2, 3, 5, 6, 9, 10, 11)) for _ in range(900))
    gap, marks = T.checkpoints(codes, T.END)
    assert gap == 30 and len(marks) == 30
    v, every = list(T.END), {}
    for i in range(899, -1, -1):
        v = every[i] = T.step_back(codes[i], v)
    assert [every[30 * k] for k in range(30)] == marks
    m = T.block_matrix(codes)
    assert [min(m[j][s] + T.END[j] for j in range(4)) for s in range(4)] == every[0]
