"""The conversation trie against brute force and SQL."""

import hashlib
import random
import re
import zlib

import duckdb
import pytest

from demandgrid.llm import convtrie, queries

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def told(role, text):
    role, text = role or "", text or ""
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


def plain_rebuilt(rows):
    own = {}
    for c, n, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((n is not None, n or 0), told(role, text), role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def plain_trie(convs):
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = set()
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        childless = [p for p in below if not any(len(x) == len(p) + 1 and x[: len(p)] == p for x in nodes)]
        saved = sum(
            (len(nodes[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in below if p
        )
        ends = sorted(c for c in members if len(convs[c]) == len(path))
        out.add(
            (
                min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members),
                sum(len(p) == len(path) + 1 for p in below), len(childless), saved,
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return out


def made(seed, convs, kinds):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for turn in range(rng.randrange(6)):
            text = " ".join(f"t{rng.randrange(kinds)}" for _ in range(rng.randrange(3)))
            rows.append((c * 3 % 89, turn + c, rng.choice(["user", "user", None]), text or None))
    return rows


@pytest.mark.parametrize("container", [1, 3, 10_000])
def test_trie_equals_brute_force(spark, container):
    rows = made(container, 80, 2)
    rows += [(200 + k, t, "user", f"same {t}") for k in range(30) for t in range(5)]
    rows += [(None, 0, "user", "lost"), (300, None, None, None), (300, None, "user", "x"), (300, 0, "", "")]
    rows += [(-7, 1, "user", "a"), (-20, 0, "user", "b"), (301, 4, "u", "tie"), (301, 4, "u", "tie")]
    turns = convtrie.turns_of(spark.createDataFrame(rows, SCHEMA).repartition(5))
    out = convtrie.trie(convtrie.with_shared_leads(turns), container).collect()
    want = plain_trie(plain_rebuilt(rows))
    assert len(out) == len(want) and {tuple(r) for r in out} == want


def test_more_rounds_than_allowed(spark, monkeypatch):
    monkeypatch.setattr(convtrie, "ROUNDS", 2)
    rows = [(c, t, "user", f"{t if t < 5 else c}") for c in range(25) for t in range(7)]
    turns = convtrie.turns_of(spark.createDataFrame(rows, SCHEMA))
    assert {tuple(r) for r in convtrie.trie(turns, 2).collect()} == plain_trie(
        {c: [("user", f"{t if t < 5 else c}") for t in range(7)] for c in range(25)}
    )


def test_copies_in_several_chunks(spark):
    rows = [(c, 0, "user", "hello there") for c in range(0, 3 << convtrie.CHUNK_BITS, 100)]
    out = convtrie.trie(convtrie.turns_of(spark.createDataFrame(rows, SCHEMA)), 2).collect()
    assert {tuple(r) for r in out} == plain_trie({c: [("user", "hello there")] for c, *_ in rows})


def test_empty_and_clashing(spark):
    none = spark.createDataFrame([], SCHEMA + ", depth int")
    assert convtrie.trie(convtrie.with_shared_leads(convtrie.turns_of(none))).count() == 0
    rows = [(0, 0, "u", "a", 9, b"x"), (0, 0, "u", "a", 9, b"x"), (20, 0, "u", "a " * 100_000, 9, None)]
    more = spark.createDataFrame(rows, SCHEMA + ", depth int, path binary")
    out = convtrie.trie(convtrie.with_shared_leads(convtrie.turns_of(more)))
    assert {tuple(r) for r in out.collect()} == plain_trie(plain_rebuilt([r[:4] for r in rows]))


def test_sql_on_shared_turns(spark):
    rows = made(9, 120, 1)
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    got = con.sql(queries.TRIE).select(*convtrie.NODE_COLUMNS).fetchall()
    assert set(got) == plain_trie(plain_rebuilt(rows))
