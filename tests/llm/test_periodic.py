"""Periodic runs against brute force."""

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from demandgrid.llm import periodic, queries

SMALL = "/root/testdata/sf0.001"


def plain_runs(words):
    """Start, length and period of every run, by trying all periods."""
    out, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            stretch = words[i : j + q]
            smaller = any(
                all(stretch[x] == stretch[x + p] for x in range(len(stretch) - p)) for p in range(1, q)
            )
            if len(stretch) >= max(6, 4 * q) and not smaller:
                out.append((i, len(stretch), q))
            i = j + 1
    return sorted(out)


def plain_rest(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    a, g = (h // 10) % n, h // 10
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def periodic_texts(rng, count):
    for _ in range(count):
        letters = rng.choice([1, 2, 3, 9, 40])
        words = [str(rng.randrange(letters)) for _ in range(rng.randrange(90))]
        for _ in range(rng.randrange(3)):
            unit = [str(rng.randrange(letters)) for _ in range(rng.randrange(1, 14))]
            at = rng.randrange(len(words) + 1)
            words[at:at] = (unit * 9)[: rng.randrange(1, 8 * len(unit) + 1)]
        yield rng.choice([" ", "\n", " \t "]).join(words)


def test_runs_equal_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        texts = list(periodic_texts(rng, rng.randrange(1, 9)))
        for text, runs, rest in zip(texts, *periodic._worked(texts), strict=True):
            want = plain_runs(text.split())
            assert [(r["start"], r["length"], r["period"]) for r in runs] == want
            assert rest == plain_rest(text.split(), want)


def test_long_and_uniform_texts():
    unit = [f"w{k}" for k in range(7001)]
    texts = ["a " * 50_000, " ".join(unit * 5 + unit[:17]), "a b " * 9000 + "c " + "b a " * 9000]
    runs, rest = periodic._worked(texts)
    found = [[(r["start"], r["length"], r["period"]) for r in rs] for rs in runs]
    assert found[0] == [(0, 50_000, 1)]
    assert found[1] == [(0, 5 * 7001 + 17, 7001)]
    assert found[2] == [(0, 18_000, 2), (18_001, 18_000, 2)]
    assert rest == ["a", " ".join(unit), "a b c b a"]


def test_odd_rows(spark):
    rows = [(None, None, 1), (1, "", 2), (2, " \n\t", 3), (3, "a a a a a a", 4), (3, "a a a a a a", 4), (4, "a\x85b", 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, runs int")
    out = periodic.with_runs(docs).collect()
    assert sorted((r.doc_id or 0, r.text or "", len(r.runs), r.collapsed) for r in out) == sorted(
        [(0, "", 0, ""), (1, "", 0, ""), (2, " \n\t", 0, ""), (3, rows[3][1], 1, "a"), (3, rows[3][1], 1, "a"), (4, "a\x85b", 0, "a\x85b")]
    )
    none = periodic.with_runs(docs.limit(0))
    assert none.columns == ["doc_id", "text", "runs", "collapsed"] and none.count() == 0
    assert periodic.with_planted_runs(docs.limit(0)).count() == 0
    # A null id and texts without words stay as they are.
    same = periodic.with_planted_runs(docs.filter("doc_id IS NULL OR doc_id < 3")).select("text")
    assert sorted(r.text or "" for r in same.collect()) == ["", "", " \n\t"]


def test_planting(spark):
    rng = random.Random(5)
    texts = [" ".join(str(rng.randrange(50)) for _ in range(rng.randrange(1, 60))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in periodic.with_planted_runs(docs).collect()}
    assert got == {i: " ".join(planted(i, t.split())) for i, t in enumerate(texts)}


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").filter(F.length("text") < 4000)
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = {r.doc_id: r for r in queries.op11_dyadic_runs(spark, SMALL).collect()}
    assert len(texts) > 150
    n_found = 0
    for i, text in texts.items():
        words = planted(i, (text or "").split())
        runs, r = plain_runs(words), rows[i]
        n_found += bool(runs)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert r.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(plain_rest(words, runs).encode()).hexdigest()
    assert n_found > 5
