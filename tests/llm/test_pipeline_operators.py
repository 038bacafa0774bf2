"""Encoding, quality rules, mixing, secrets and the Jaccard join against plain versions on whole fixtures."""

import base64
import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from filmloom.llm import bpe, mixing, quality, secrets, shingle_join
from filmloom.llm.common import WORD, Scratch
from filmloom.llm.queries import vocabulary

WORDS = re.compile(WORD)


def key_of(row):
    return (row["doc_id"] is None, row["doc_id"] or 0)


def test_encoding_equals_the_tokenizer_library(odd_docs, no_docs):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(vocabulary(), "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = bpe.decode(bpe.encode(odd_docs, vocabulary(), keep=["doc_id", "text", "ids"]), vocabulary()).collect()
    assert len(rows) == odd_docs.count()
    for row in rows:
        text = row["text"] or ""
        assert row["ids"] == own.encode_ordinary(text)
        assert bytes(row["decoded"]) == text.encode()
    assert bpe.decode(bpe.encode(no_docs, vocabulary()), vocabulary()).count() == 0


def test_long_pieces_merge_as_short_ones():
    merger = bpe.Merger(vocabulary())
    for piece in (b"thethethe" * 6, b"abc", bytes(range(48)), "éèê".encode() * 8):
        assert merger.merge(piece * 2) == merger.merge_short(piece * 2) or piece * 2 in merger.ranks


def plain_counts(text):
    words = WORDS.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 3)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": sum(x in lines[:i] for i, x in enumerate(lines)),
        "n_repeat_words": len(covered),
    }


def test_base_counts(odd_docs, no_docs):
    rows = quality.with_counts(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    for row in rows:
        expected = plain_counts(row["text"])
        assert {k: row[k] for k in expected} == expected
        n, repeated = expected["n_words"], expected["n_repeat_words"]
        assert row["base_failed"] == (n < 50 or 100 * repeated > 50 * n)
    assert quality.with_counts(no_docs).count() == 0


@pytest.mark.parametrize("n,k,rate", [(10, 0, 0.1), (200, 3, 0.01), (5000, 60, 0.01), (50, 50, 0.3), (400, 300, 0.5)])
def test_binomial_tail(n, k, rate):
    from math import comb

    exact = sum(comb(n, i) * rate**i * (1 - rate) ** (n - i) for i in range(k + 1))
    assert quality.binomial_tail(n, k, rate) == pytest.approx(exact, rel=1e-9, abs=1e-12)


def test_cutoffs_keep_good_documents_within_the_bound(spark):
    rng = np.random.default_rng(4)
    rows, marks = [], []
    for i in range(24000):
        good = i % 4 != 0
        ratio = float(rng.beta(1, 60) if good else rng.beta(6, 10))
        rows.append((i, "en" if i % 3 else None, False, ratio, 0.0, 0.0, float(rng.random())))
        marks.append((i, int(good)))
    schema = "doc_id long, lang string, base_failed boolean, " + ", ".join(f"{r} double" for r in quality.RULES)
    counted = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame(marks + [(5, 1), (None, 0), (7, None)], "doc_id long, quality int")
    cutoffs = quality.calibrate(counted, labels)
    rules = {(r["stratum"], r["rule"]) for r in cutoffs.collect()}
    assert rules == {("", "symbol_ratio"), ("en", "symbol_ratio")}  # the noise rule has no certified gain
    judged = {r["doc_id"]: r["kept"] for r in quality.apply_cutoffs(counted, cutoffs).collect()}
    good = [judged[i] for i in range(24000) if i % 4]
    bad = [judged[i] for i in range(24000) if not i % 4]
    assert 1 - np.mean(good) <= 0.02 and np.mean(bad) < 0.2
    none = quality.calibrate(counted, labels.where("false"))
    assert none.count() == 0
    assert quality.apply_cutoffs(counted, none).where("kept").count() == len(rows)


def test_mix_meets_targets(spark, odd_docs, no_docs):
    mixed = mixing.mix_documents(odd_docs, Scratch(spark))
    rows = mixed.collect()
    assert len(rows) == odd_docs.count()
    taken, target, own = Counter(), {}, {}
    for r in rows:
        assert r["size"] == len(WORDS.findall(r["text"] or "")) and 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]], own[r["source"]] = r["target"], r["source_size"]
    names = sorted((s for s in own if s is not None)) + [None]
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    expected, full, total = {}, set(), sum(own.values())
    while True:  # excess goes back by weight until nobody is above
        rest = total - sum(3 * own[s] for s in full)
        share = sum(weight[s] for s in names if s not in full)
        expected = {s: 3.0 * own[s] if s in full else rest * weight[s] / share for s in names}
        more = {s for s in names if s not in full and expected[s] > 3 * own[s]}
        if not more:
            break
        full |= more
    for s in names:
        assert target[s] == pytest.approx(expected[s]) and taken[s] == int(target[s] + 1e-9)
    again = mixing.mix_documents(odd_docs.repartition(3), Scratch(spark)).select("doc_id", "size", "taken").collect()
    assert Counter(map(tuple, again)) == Counter((r["doc_id"], r["size"], r["taken"]) for r in rows)
    out = mixing.written_out(mixed, ["doc_id", "text", "source", "n_chars"]).collect()
    words = Counter()
    for r in out:
        words[r["source"]] += len(WORDS.findall(r["text"]))
    assert words == Counter({s: n for s, n in taken.items() if n})
    assert mixing.mix_documents(no_docs, Scratch(spark)).count() == 0


def plain_spans(text):
    text = text or ""
    base, weak = [], []
    for m in re.finditer(secrets.ASSIGN, text):
        n = len(m[2])
        (base if n >= 12 else weak if n >= 6 else []).append((m.start(), 0 if n >= 12 else 4, m.end()))
    base += [(m.start(), 1, m.end()) for m in re.finditer(secrets.ACCESS, text) if m.end() - m.start() >= 18]
    base += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if m.end() - m.start() >= 16]
    weak += [(m.start(), 3, m.end()) for m in re.finditer(secrets.IDENT, text) if len(m[2]) >= 3]
    weak += [(m.start(), 5, m.end()) for m in re.finditer(secrets.ENDPOINT, text) if len(m[2]) >= 4]
    roles = [secrets.ROLE[k] for k in secrets.KINDS]
    added = [
        w
        for w in weak
        if all(
            any(roles[p[1]] == need and abs(p[0] - w[0]) <= secrets.SCOPE for p in base + weak)
            for need in secrets.NEEDS[secrets.KINDS[w[1]]]
        )
    ]

    def listed(spans):
        return ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))

    return [sum(b[1] == k for b in base) for k in range(3)], hashlib.sha256(listed(base).encode()).hexdigest(), listed(base + added)


def test_secret_spans(odd_docs, no_docs):
    rows = secrets.scan(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert ([r["n_assign"], r["n_access"], r["n_hex"]], r["base_sha256"], r["spans"]) == plain_spans(r["text"])
    assert any("ident" in r["spans"] for r in rows) and any("endpoint" in r["spans"] for r in rows)
    assert secrets.scan(no_docs).count() == 0


def test_many_secrets_in_one_text(spark):
    text = " ".join(f"token={i:012d} x é" for i in range(700))
    row = secrets.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row["n_assign"], row["spans"]) == (700, plain_spans(text)[2])


def test_redaction(odd_docs):
    before = {key_of(r): r for r in odd_docs.collect()}
    for r in secrets.redacted(odd_docs).collect():
        old = before[key_of(r)]
        spans = [tuple(map(int, s.split(":")[1:])) for s in plain_spans(old["text"])[2].split(",") if s]
        if not spans:
            assert tuple(r) == tuple(old)
            continue
        out, at = "", 0
        for start, end in spans:
            if start >= at:
                out += old["text"][at:start] + "[SECRET]"
            at = max(at, end)
        assert r["text"] == out + old["text"][at:] and r["n_chars"] == len(r["text"])


def plain_components(rows):
    sets = []
    for doc_id, text in rows:
        w = shingle_join.lowered(text or "")
        w = re.findall(shingle_join.WORD_BYTES, w)
        sets.append({tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 90 * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    names = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            names[root(i)] = min(names.get(root(i), doc_id), doc_id)
    return Counter((r[0], len(s), names.get(root(i), r[0])) for i, (r, s) in enumerate(zip(rows, sets)))


def test_jaccard_components(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = shingle_join.similar_classes(odd_docs, Scratch(spark)).select("_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == plain_components(rows)
    assert shingle_join.similar_classes(no_docs, Scratch(spark)).count() == 0


def test_jaccard_components_of_chained_copies_in_blocks(spark, monkeypatch):
    import random

    monkeypatch.setattr(shingle_join, "BLOCK", 7)
    monkeypatch.setattr(shingle_join, "PICKED", 0)  # whole texts are shuffled here
    rng = random.Random(8)
    rows = []
    for family in range(6):
        words = [f"w{family}x{i}" for i in range(rng.choice([9, 14, 25, 60, 150]))]
        for step in range(14):
            if step % 3:
                words = list(words)
                words[rng.randrange(len(words))] = f"e{step}"
            if step % 5 == 4:
                words = words[: -rng.randint(1, 3)]
            rows.append((len(rows) * 3 + 1, " ".join(words)))
    rng.shuffle(rows)
    rows.append((rows[0][0], "another text under a known id " + rows[3][1]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = shingle_join.similar_classes(docs, Scratch(spark)).select("_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == plain_components(rows)


def test_signatures_meet_for_every_pair_within_the_threshold():
    rng = np.random.default_rng(2)
    for size in (9, 10, 12, 19, 27, 40, 95, 200, 333):
        for _ in range(30):
            one = rng.integers(0, 2**63, size).astype(np.uint64)
            k = shingle_join.most_different(2 * size)
            swap = k // 2
            other = np.concatenate([one[swap:], rng.integers(0, 2**63, swap).astype(np.uint64)])
            if k % 2:
                other = other[:-1] if 10 * (size - swap - 1) >= 9 * (size + swap) else other
            x = shingle_join.signatures(one, shingle_join.band_limits(len(one)))
            y = shingle_join.signatures(other, shingle_join.band_limits(len(other)))
            if swap:
                assert np.intersect1d(x, y).size


def test_cutoffs_of_small_strata(spark):
    rows, marks = [], []
    for i in range(1600):  # about 267 good ones a half in "fr", 40 in "es"
        bad, lang = i % 4 == 0, "fr" if i % 9 else "es"
        rows.append((i, lang, False, 0.2 if bad else 0.0, 0.001 * (i % 7), 0.0, 0.01 * (i % 11)))
        marks.append((i, int(not bad)))
    schema = "doc_id long, lang string, base_failed boolean, " + ", ".join(f"{r} double" for r in quality.RULES)
    counted = spark.createDataFrame(rows[:900] + [r for r in rows[900:] if r[1] == "es" or r[0] % 3], schema)
    cutoffs = quality.calibrate(counted, spark.createDataFrame(marks, "doc_id long, quality int"))
    found = {(r["stratum"], r["rule"]): r for r in cutoffs.collect()}
    assert set(found) == {("fr", "symbol_ratio")}  # the other stratum is too small for any bound
    row = found["fr", "symbol_ratio"]
    assert 217 < row["n"] < 1300 and row["k"] == 0 and 0.98 ** row["n"] <= 0.05
    judged = quality.apply_cutoffs(counted, cutoffs).where("lang = 'fr'").collect()
    assert all(r["kept"] == (r["symbol_ratio"] == 0) for r in judged)


def test_pairs_are_verified_some_texts_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(shingle_join, "VERIFIED", 50)
    words = [f"w{i}" for i in range(24)]
    texts = {n: " ".join(words[: 24 - n] + [f"x{n}"] * n) for n in range(6)}
    rule = shingle_join.Rule(numerator=7)
    sets = {n: set(zip(*(t.split()[i:] for i in range(3)))) for n, t in texts.items()}
    pairs = [(a, b) for a in texts for b in texts if a < b]
    want = {(a, b) for a, b in pairs if 10 * len(sets[a] & sets[b]) >= 7 * len(sets[a] | sets[b])}
    rows = spark.createDataFrame([(n, len(sets[n]), t) for n, t in texts.items()], "class long, n_shingles long, text string")
    found = shingle_join.verify(spark.createDataFrame(pairs, "a long, b long"), rows, rule).collect()
    assert len(found) == len(want) and {(r["a"], r["b"]) for r in found} == want and 0 < len(want) < len(pairs)
