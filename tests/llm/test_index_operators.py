"""SimHash, BPE, token files, HTML and sharding against plain Python and public libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from tokenizers import Tokenizer

from demandgrid.llm import bpe, htmlmodel, htmltree, sharding, simhash, tokenfiles
from demandgrid.llm.components import components

EXTRA = "doc_id bigint, text string, fp bigint, ids string, slot string, mask int"
TEXTS = [
    None,
    "",
    " ",
    "one",
    "Two  words",
    "A\x1cb  c d \t e\n\n f",
    "it's we'll 123 4567 ñandú straße 漢字かな 🙂🙂 <|endoftext|> <|startoftext|>",
    "x" * 5000,
    "word " * 3000,
    "trailing \n",
    "  leading",
    "é" * 50 + "́ ́a",
]


def rows_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)


def plain_fingerprint(text, shingle=3):
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    parts = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(values, most=3):
    label = list(range(len(values)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= most:
                a, b = top(i), top(j)
                label[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(values))]


def test_fingerprints(spark):
    texts = TEXTS + ["A b C", "a B c", "a b", "a b c d e f " * 20]
    assert [simhash.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]


def near_values(n, seed):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(4)]
    out = {0, (1 << 64) - 1, 7}
    while len(out) < n:
        v = rng.choice(centres)
        for _ in range(rng.randint(0, 7)):
            v ^= 1 << rng.randrange(64)
        out.add(v)
    return sorted(out)


@pytest.mark.parametrize("chunk", [simhash.CHUNK, 500])
def test_forest_finds_every_class(monkeypatch, chunk):
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    values = near_values(400, 1)
    gray = sorted(values, key=lambda v: (lambda g: g)(_rank(v)))
    fps = np.array(gray, np.uint64)
    label = simhash.forest(fps, np.zeros(len(fps), np.int64), 3)
    assert label.tolist() == plain_classes(gray)
    groups = np.arange(len(fps)) // 37
    label = simhash.forest(fps, groups, 3)
    for g in range(groups.max() + 1):
        at = np.flatnonzero(groups == g)
        assert (label[at] - at[0]).tolist() == plain_classes([gray[i] for i in at])


def _rank(v):
    for step in (1, 2, 4, 8, 16, 32):
        v ^= v >> step
    return v


@pytest.mark.parametrize("leaf", [simhash.LEAF, 20])
def test_links_and_components_equal_brute_force(spark, leaf):
    values = near_values(500, 2)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    links = simhash.links(spark.createDataFrame(signed, "fp bigint"), 3, leaf)
    got = {r.node: r.root for r in components(links).collect()}
    by_class = {}
    for v, c in zip([s[0] for s in signed], plain_classes(values), strict=True):
        by_class.setdefault(c, []).append(v)
    want = {v: min(vs) for vs in by_class.values() if len(vs) > 1 for v in vs}
    assert got == want


def test_near_duplicates_of_odd_rows(spark):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(5, base), (3, base), (9, base + " tail"), (None, base), (7, None), (8, ""), (1, "other text"), (1, "other text")]
    docs = spark.createDataFrame([(i, t, 1, "x", "y", 2) for i, t in rows], EXTRA)
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    classes = plain_classes([plain_fingerprint(t) for _, t in rows])
    least = {}
    for (i, _), c in zip(rows, classes, strict=True):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    want = [(i, f"{plain_fingerprint(t):016x}", least.get(c)) for (i, t), c in zip(rows, classes, strict=True)]
    assert got == sorted(want, key=str)
    left = simhash.representatives(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == sorted(i or 0 for i, _ in rows if i is None or i in least.values())
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_components_of_chains_stars_and_nothing(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    odd = [(5000, 5000), (None, 7), (2000, 2001), (2000, 2001)]
    links = spark.createDataFrame(chain + star + odd, "a bigint, b bigint").repartition(4)
    got = {r.node: r.root for r in components(links).collect()}
    want = {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(300)} | {2000: 2000, 2001: 2000}
    assert got == want
    assert components(links.limit(0)).count() == 0


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def encoding(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(spark, ranks, encoding):
    rng = random.Random(4)
    alphabet = list("aeiou rstln \n\té漢🙂'.,!0129") + ["  ", " the", "\r\n"]
    texts = TEXTS + ["".join(rng.choices(alphabet, k=rng.randint(0, 80))) for _ in range(300)]
    docs = rows_of(spark, texts)
    both = bpe.decoded(bpe.encoded(docs, ranks, public_tokenizers.PATTERN), ranks, public_tokenizers.PATTERN)
    for r in both.collect():
        want = encoding.encode_ordinary(texts[r.doc_id] or "")
        assert r.ids == want and bytes(r.octets) == (texts[r.doc_id] or "").encode()
    for r in bpe.round_trip(docs, ranks, public_tokenizers.PATTERN).collect():
        ids = encoding.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_bpe_small_caches_unknown_ids_and_empty_table(spark, ranks, encoding, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 3)
    monkeypatch.setattr(bpe, "LONG", 4)
    codec = bpe.Codec(ranks, public_tokenizers.PATTERN)
    for _ in range(3):
        for text in TEXTS:
            ids, ends = codec.encode([text, None, text])
            one = encoding.encode_ordinary(text or "")
            assert ids.tolist() == one * 2 and ends.tolist() == [0, len(one), len(one), 2 * len(one)]
    with pytest.raises(ValueError):
        codec.decode(np.array([60_000], np.int32), np.array([0, 1]))
    empty = rows_of(spark, ["x"]).limit(0)
    assert bpe.round_trip(empty, ranks, public_tokenizers.PATTERN).count() == 0


def test_levels_give_any_token():
    rng = np.random.default_rng(2)
    for ids in (np.empty(0, np.uint32), rng.integers(0, 200, 700), rng.integers(0, 2**32, 3000), np.array([0, 255, 256, 2**24])):
        levels = tokenfiles.Levels.of(ids.astype(np.uint32))
        places = rng.permutation(len(ids))
        assert (levels.at(places) == ids[places]).all() and (levels.all() == ids).all()
    with pytest.raises(IndexError):
        levels.at(np.array([4]))


@pytest.mark.parametrize("per_file", [tokenfiles.FILE_TOKENS, 50])
def test_token_files_equal_the_library(spark, tmp_path, per_file):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    rows = [(9 - i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (4, "the same id")]
    docs = spark.createDataFrame([(i, t, 1, "x", "y", 2) for i, t in rows], EXTRA).repartition(4)
    with open(path, encoding="utf-8") as file:
        files = tokenfiles.write_tokens(docs, f"file://{tmp_path}/t", file.read(), 2, file_tokens=per_file)
    got = sorted(tokenfiles.read_tokens(spark, f"file://{tmp_path}/t", files).collect(), key=lambda r: r.start)
    ids = {}
    for i, t in rows:
        own = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        ids.setdefault(i, []).append((len(own), zlib.crc32(own.tobytes())))
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    start = 0
    for r in got:
        assert r.start == start and (r.n_tokens, r.ids_crc32) in ids[r.doc_id]
        start += r.n_tokens
    one = sorted((tmp_path / "t").glob("*.dac"))[0]
    read = tokenfiles.TokenFile(one.read_bytes())
    whole = read.levels.all()
    assert [read.token(0, k) for k in range(int(read.starts[1]))] == whole[: read.starts[1]].tolist()
    with one.open("rb") as file:
        stored = tokenfiles.StoredTokens(file)
        assert stored.span(0) == (0, int(read.starts[1])) and stored.n == len(whole)
        for a in range(0, stored.n + 1, max(1, stored.n // 40)):
            for b in (a, min(a + 1, stored.n), min(a + 700, stored.n), stored.n):
                assert stored.ids(a, b).tolist() == whole[a:b].tolist()


def test_token_files_of_an_empty_table(spark, tmp_path):
    empty = rows_of(spark, ["x"]).limit(0)
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        files = tokenfiles.write_tokens(empty, f"file://{tmp_path}/t", file.read(), 2)
    assert tokenfiles.read_tokens(spark, f"file://{tmp_path}/t", files).count() == 0


@pytest.fixture(scope="module")
def pages_model():
    return htmlmodel.fit(htmlmodel.labelled_pages())


def test_marginals_equal_enumeration(pages_model):
    nodes = htmltree.parse('<body><div class="ad"><p>Buy now</p></div><p>Text here. And more.</p></body>')
    found, m = htmlmodel.features(nodes), pages_model
    n, weight, content = len(nodes), 0.0, [0.0] * len(nodes)
    for code in range(1 << n):
        y = [code >> i & 1 for i in range(n)]
        score = 0.0
        for i, node in enumerate(nodes):
            kind = "text" if node.tag == "#text" else "element"
            for name, value in found[i]:
                score += htmlmodel.EVIDENCE * (m.evidence.get((kind, name, value)) or m.unseen[kind, name])[y[i]]
            if i:
                up = node.parent
                score += m.tie(htmlmodel._place(nodes[up]), htmlmodel._kind(node), y[up])[y[i]]
        p = float(np.exp(score))
        weight += p
        content = [c + p * b for c, b in zip(content, y, strict=True)]
    assert htmlmodel.marginals(nodes, m) == pytest.approx([c / weight for c in content])


def test_pages_held_out(pages_model):
    right = total = 0
    for page in htmlmodel.labelled_pages(150, seed=31):
        nodes = htmltree.parse(page)
        sure = htmlmodel.marginals(nodes, pages_model)
        for node, label, p in zip(nodes, htmlmodel.labels_of(nodes), sure, strict=True):
            if node.tag == "#text":
                total += 1
                right += (p > 0.5) == bool(label)
    assert right >= 0.97 * total


def test_page_parts_and_odd_pages(spark, pages_model):
    page = (
        '<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body><nav><ul>'
        '<li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav><div class="cookie-notice">We use cookies.</div>'
        "<article><h1>Head&amp;line</h1><p><b>First\n  line.<br><p>Second &lt;line&gt; is here, long enough."
        '<script>no()</script><!-- no --></p><div class="ad"><p>Buy this.</p></div></article><aside class="sidebar">'
        '<a href="/x">Related</a></aside><section id="comments"><div class="comment"><p>I like it. A lot.</p></div>'
        "</section><form><label>Mail</label><input></form><footer>&copy; site</footer>"
    )
    want = "Head&line First line. Second <line> is here, long enough."
    rows = [(1, "u", page), (None, None, page), (2, "u", None), (3, "u", ""), (4, "u", "<"), (5, "u", "<!-- open"),
            (6, "u", "<div " * 2000), (7, "u", "<div>" * 3000 + "deep"), (7, "u", "<script>x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = htmlmodel.extracted(pages, pages_model).collect()
    assert len(got) == len(rows)
    assert [r.text for r in got if r.page_id in (1, None)] == [want] * 2
    assert all(r.n_chars == len(r.text) for r in got)
    assert [r.text for r in got if r.page_id in (2, 3, 5)] == [""] * 3
    assert htmlmodel.extracted(pages.limit(0), pages_model).count() == 0


def test_given_pages_give_their_article(spark, pages_model):
    def article(html):
        nodes = htmltree.parse(html)
        inside = [False] * len(nodes)
        for i, n in enumerate(nodes):
            inside[i] = n.tag == "article" or (n.parent >= 0 and inside[n.parent])
        return " ".join(n.text for n, i in zip(nodes, inside, strict=True) if i and n.tag == "#text")

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    for r in htmlmodel.extracted(pages, pages_model).collect():
        assert r.text == article(html[r.page_id])


def test_shards_are_even_gapless_and_move_little(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, "x" * int(rng.expovariate(1 / 300))) for i in range(3000)]
    rows += [(None, f"null id {i}") for i in range(800)] + [(5, None), (5, ""), (5, ""), (6, "é" * 2000)]
    docs = spark.createDataFrame([(i, t, 1, "x", "y", 2) for i, t in rows], EXTRA).drop("slot")
    slotted = sharding.with_virtual_slots(docs, slots=4096)
    first = sharding.new_map(sharding.slot_loads(slotted), 24, slots=4096)
    placed = sharding.assign(slotted, first).collect()
    assert len(placed) == len(rows)
    sizes = {}
    for r in placed:
        assert r["size"] == len((r.text or "").encode()) + 8
        sizes.setdefault(r.shard, []).append(r)
    assert sorted(sizes) == list(range(24))
    for own in sizes.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    totals = [sum(r["size"] for r in own) for own in sizes.values()]
    assert max(totals) - min(totals) <= 0.02 * sum(totals) / 24
    path = str(tmp_path / "maps")
    sharding.store_map(first, path)
    second = sharding.rebalanced(sharding.stored_map(spark, path), sharding.slot_loads(slotted), 25)
    sharding.store_map(second, path)
    assert sharding.stored_map(spark, path).first().version == 2
    assert sharding.stored_map(spark, path, 1).first().version == 1
    before = {r.virtual_slot: r.shard for r in first.collect()}
    after = {r.virtual_slot: r for r in second.collect()}
    moved = sum(r.slot_bytes for s, r in after.items() if r.shard != before[s])
    assert 0 < moved <= 1.2 * sum(totals) / 25
    assert all(r.shard == 24 for s, r in after.items() if r.shard != before[s])
    fewer = sharding.rebalanced(second, sharding.slot_loads(slotted), 20).collect()
    assert {r.shard for r in fewer} == set(range(20))


def test_sharding_an_empty_table(spark):
    empty = sharding.with_virtual_slots(rows_of(spark, ["x"]).limit(0), slots=16)
    empty_map = sharding.new_map(sharding.slot_loads(empty), 4, slots=16)
    assert sharding.assign(empty, empty_map).count() == 0
    assert {r.shard for r in empty_map.collect()} == {0, 1, 2, 3}
