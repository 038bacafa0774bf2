"""Lexical search, SimHash near-dedup and phrase mining against plain versions."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from filmloom.llm import collocations, lexical_search, simhash, words
from filmloom.llm.common import Scratch

A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_search(docs, items, k=10):
    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(A_TO_Z))

    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    total, length = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in counted:
            m = 25 + 75 * n * total // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms(text) if t in c
            )
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k])]
    return Counter(out)


@pytest.fixture(scope="module")
def questions(spark, odd_docs):
    texts = [r["text"] for r in odd_docs.where("doc_id in (16, 20, 30, 44, 50, 55)").collect()]
    rows = [(n, (t or "")[:300], "x") for n, t in enumerate(texts)]
    rows += [(90, None, ""), (91, "", ""), (92, "no such words qqqq", ""), (93, "the the THE of", ""), (93, "the the THE of", ""), (None, "É ü 日本 5", "")]
    return spark.createDataFrame(rows, "item_id long, text string, doc_id string")


@pytest.mark.parametrize("postings,first,most,chunk", [(500_000, 16, 200_000, 8 << 20), (60, 3, 0, 2000), (10, 16, 200_000, 500)])
def test_lexical_search(spark, odd_docs, no_docs, questions, monkeypatch, postings, first, most, chunk):
    for name, value in (("SHARD_POSTINGS", postings), ("FIRST_SHARDS", first), ("MOST_TERMS", most), ("CHUNK", chunk), ("QUERY_ROWS", 5)):
        monkeypatch.setattr(lexical_search, name, value)
    got = lexical_search.search(odd_docs, questions, Scratch(spark))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    got = [tuple(r) for r in got.collect()]
    expected = plain_search([(r["doc_id"], r["text"]) for r in odd_docs.collect()], [(r["item_id"], r["text"]) for r in questions.collect()])
    assert Counter(got) == expected and len(got) > 60
    if postings == 60:
        assert not lexical_search.search(no_docs, questions, Scratch(spark)).collect()
        assert not lexical_search.search(odd_docs, questions.limit(0), Scratch(spark)).collect()


def test_interval_search_is_exact():
    rng = np.random.default_rng(5)
    for _ in range(150):
        n = int(rng.integers(1, 90))
        hits = [(t * 3, d, int(rng.integers(1, 4))) for d in range(n) for t in range(6) if rng.random() < 0.5] or [(0, 0, 1)]
        index = lexical_search.ShardIndex(*(np.array(x) for x in zip(*hits)), n)
        asked, weights = rng.choice(20, 4, replace=False), rng.integers(0, 4, 4)
        weight = dict(zip(asked.tolist(), weights.tolist()))
        scores = Counter()
        for t, d, impact in hits:
            scores[d] += impact * weight.get(t, 0)
        for least in (1, 5):
            places, found = index.search(asked, weights, 5, least)
            expected = sorted((-s, d) for d, s in scores.items() if s >= least)[:5]
            assert list(zip((-found).tolist(), places.tolist())) == expected


def test_search_leaves_most_documents_unopened(monkeypatch):
    """Documents with a rare term are found without opening those that only share common ones."""
    n = 20_000
    common = [(0, d, 500 + d % 7) for d in range(n)]
    rare = [(1, d, 900) for d in range(0, n, 1000)]
    index = lexical_search.ShardIndex(*(np.array(x) for x in zip(*common, *rare)), n)
    opened = []
    real = index.best
    monkeypatch.setattr(index, "best", lambda low, high: opened.append(len(low)) or real(low, high))
    places, _ = index.search(np.array([0, 1]), np.array([1, 50]), 10, 1)
    assert len(places) == 10 and set(places % 1000) == {0}
    assert sum(opened) < 1000


def plain_fingerprint(text):
    tokens = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(A_TO_Z))
    shingles = [" ".join(tokens[i : i + 3]) for i in range(max(1, len(tokens) - 2))] if tokens else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_near(fps, radius=2):
    parent = {f: f for f in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in fps:
        for b in fps:
            if a < b and (a ^ b).bit_count() <= radius:
                parent[root(a)] = root(b)
    return {f: root(f) for f in fps}


def test_simhash_near_duplicates(spark, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(simhash, "COUNTED", 1000)
    got = [tuple(r) for r in simhash.near_duplicates(odd_docs, Scratch(spark)).collect()]
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in odd_docs.collect()]
    roots = plain_near({f for _, f in rows})
    names = defaultdict(set)
    for i, f in rows:
        names[roots[f]] |= {i} - {None}
    signed = {f: f - (1 << 64) if f >> 63 else f for _, f in rows}
    assert Counter(got) == Counter((i, signed[f], min(names[roots[f]])) for i, f in rows)
    assert simhash.near_duplicates(no_docs, Scratch(spark)).count() == 0
    nameless = odd_docs.selectExpr("cast(null as long) doc_id", "text").where("text = 'a b'")
    assert [r["component_id"] for r in simhash.near_duplicates(nameless, Scratch(spark)).collect()] == [None]


@pytest.mark.parametrize("group,most", [(1 << 20, 1 << 20), (16, 64), (4, 8)])
def test_near_links_through_hot_groups(spark, group, most):
    """Families around few centres, and a hot one whose members share most bits: divided, then dealt out in blocks."""
    rng = np.random.default_rng(9)

    def turned(x, n):
        for bit in rng.choice(64, n, replace=False):
            x ^= 1 << int(bit)
        return x

    centres = [int(c) for c in rng.integers(0, 2**63, 40)]
    values = {turned(c, int(rng.integers(0, 4))) for c in centres for _ in range(10)}
    values |= {centres[0] & ~0xFFF | int(x) for x in rng.integers(0, 4096, 300)}
    values = sorted(values)
    fps = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    links = simhash.near_links(fps, Scratch(spark), group=group, most=most).collect()
    parent = {v: v for v in values}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a % (1 << 64)), root(b % (1 << 64))
        parent[max(a, b)] = min(a, b)
    expected = plain_near(values)
    assert len({root(v) for v in values}) == len(set(expected.values()))
    assert len({(root(v), expected[v]) for v in values}) == len(set(expected.values()))


def test_bit_planes_find_every_near_pair():
    rng = np.random.default_rng(1)
    for n in (1, 2, 64, 65, 700):
        base = rng.integers(0, 2**63, max(1, n // 4)).astype(np.uint64)
        flips = np.uint64(1) << rng.integers(0, 64, (2, n)).astype(np.uint64)
        fps = np.unique(base[rng.integers(0, len(base), n)] ^ flips[0] ^ flips[1])
        apart = np.bitwise_count(fps[:, None] ^ fps[None, :])
        blocks = rng.integers(0, 2, len(fps))
        for radius in (0, 1, 2, 3, 5):
            near = {(a, b) for a, b in zip(*map(np.ndarray.tolist, np.nonzero(apart <= radius))) if a < b}
            got = {p for i, j in simhash.near_pairs(fps, radius) for p in zip(i.tolist(), j.tolist())}
            assert got == near
            got = {p for i, j in simhash.near_pairs(fps, radius, blocks) for p in zip(i.tolist(), j.tolist())}
            assert got == {(a, b) for a, b in near if blocks[a] != blocks[b]}


def plain_phrases(rows, least, absorbed, most):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(A_TO_Z)):
            tokens = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(tokens)
            f.update((lang, *tokens[i : i + m]) for m in (1, 2, 3, 4) for i in range(len(tokens) - m + 1))
    found = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    inside = defaultdict(int)
    for (lang, *p), a in found.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                inside[(lang, *p[i : i + m])] = max(inside[(lang, *p[i : i + m])], a)
    out = defaultdict(list)
    for (lang, *p), a in found.items():
        if 100 * inside[(lang, *p)] >= absorbed * a and inside[(lang, *p)]:
            continue
        cuts = [(2000000 * a // (f[(lang, *p[:k])] + f[(lang, *p[k:])]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(p).encode(), f[(lang, *p[:k])], f[(lang, *p[k:])]))
    return [
        (lang, r + 1, phrase.decode(), -a, left, right, n[lang], -score)
        for lang, rows in out.items() for r, (score, a, phrase, left, right) in enumerate(sorted(rows)[:most])
    ]


@pytest.mark.parametrize("least,most,chunk,bits", [(30, 2000, 8 << 20, 27), (3, 40, 3000, 5), (2, 100_000, 200, 16)])
def test_phrases(spark, odd_docs, no_docs, monkeypatch, least, most, chunk, bits):
    monkeypatch.setattr(collocations, "CHUNK", chunk)
    monkeypatch.setattr(collocations, "MOST_BITS", max(bits, 6))
    monkeypatch.setattr(collocations, "FEWEST_BITS", 6)
    extra = spark.createDataFrame(
        [("a b a b a b! A b\x01 c \x1f a b,c d e\ta b c d e f a a a a a a", "de"), ("b\x0bc\x0cd\re", "de"), ("a b c d " * 9, "zz"), ("!?;", "q")] * 12,
        "text string, lang string",
    )
    docs = odd_docs.select("text", "lang", "size").unionByName(extra, allowMissingColumns=True)
    got = [tuple(r) for r in collocations.mine(docs, Scratch(spark), least=least, most=most).collect()]
    expected = plain_phrases([(r["lang"], r["text"]) for r in docs.collect()], least, 80, most)
    assert sorted(got) == sorted(expected) and len(got) >= 10
    if least == 3:
        assert collocations.mine(no_docs, Scratch(spark)).count() == 0


def test_chunks_cut_long_texts_between_words():
    import pyarrow as pa

    texts = [None, "", "Ab cd", "é " * 300, "x" * 900, "tail end"]
    for size in (8, 100, 10_000):
        seen = defaultdict(list)
        for rows, ends, data in words.byte_chunks(iter([pa.record_batch({"n": list(range(6)), "text": texts})]), "text", words.lowered_classes(), size, 0x20):
            _, doc, found = words.words_of(data, data != 0x20, ends)
            for d, w in zip(doc.tolist(), found.to_pylist()):
                seen[rows.column("n")[d].as_py()].append(w.decode())
        assert dict(seen) == {2: ["ab", "cd"], 3: ["é"] * 300, 4: ["x" * 900], 5: ["tail", "end"]}
