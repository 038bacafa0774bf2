"""License scan, top-k, training order and both removals of repeats against plain versions."""

import base64
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from filmloom.llm import license_scan, sentence_dedup, suffix_dedup, topk, training_order
from filmloom.llm.common import Scratch, numbered, opened, qualified
from filmloom.llm.queries import vocabulary


def plain_removed(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int(np.count_nonzero(gone[:-1] & ~np.concatenate([[False], gone[:-2]]))) if len(d) else 0
        out.append((len(d), int(gone.sum()), spans, bytes(b for b, g in zip(d, gone) if not g)))
    return out


def bytes_left(row):
    return bytes(row["kept"]) if row["kept"] is not None else (row["text"] or "").encode()


def saved(df, tmp_path, name="docs"):
    df.write.mode("overwrite").parquet(str(tmp_path / name))
    return df.sparkSession.read.parquet(str(tmp_path / name))


@pytest.mark.parametrize("most,part", [(2000, 1 << 20), (1, 300)])
def test_suffix_dedup(spark, odd_docs, no_docs, tmp_path, monkeypatch, most, part):
    monkeypatch.setattr(suffix_dedup, "MOST_RUNS", most)
    monkeypatch.setattr(suffix_dedup, "PART", part)
    docs = saved(odd_docs.where("doc_id is null or length(text) < 20000 or text is null"), tmp_path)
    rows = suffix_dedup.without_repeats(docs, Scratch(spark)).collect()
    expected = plain_removed([r["text"] for r in docs.collect()], 200)
    got = Counter((r["n_bytes"], r["n_removed"], r["n_spans"], bytes_left(r)) for r in rows)
    assert got == Counter(expected)
    assert suffix_dedup.without_repeats(saved(no_docs, tmp_path, "none"), Scratch(spark)).count() == 0


def test_common_prefixes_by_level():
    rng = np.random.default_rng(3)
    for _ in range(60):
        pieces = ["".join(rng.choice(list("ab"), rng.integers(5, 40))) for _ in range(5)]
        pieces.append(pieces[0][3:] + pieces[1])
        snippets = [p.encode() for p in dict.fromkeys(pieces) if len(p) >= 5]
        for length in (2, 5):
            every = Counter(s[i : i + length] for s in snippets for i in range(len(s) - length + 1))
            for s, hit in zip(snippets, suffix_dedup.repeated_windows(snippets, length)):
                assert hit.tolist() == [every[s[i : i + length]] > 1 for i in range(len(s) - length + 1)]


def plain_sentences(rows):
    seen = defaultdict(list)
    pattern = re.compile(sentence_dedup.BREAK)
    for key in rows:
        sentences, _ = sentence_dedup.cut(key[1] or "", pattern)
        for a in range(len(sentences)):
            for b in range(a + 1, len(sentences) + 1):
                if sum(len(s.split()) for s in sentences[a:b]) >= (20 if b - a > 1 else 50):
                    seen["\n".join(sentences[a:b])].append((key, a, b))
    return seen


def test_ends_of_repeated_runs_and_long_sentences(spark):
    def words(name, n):
        return " ".join(f"{name}{i}" for i in range(n)) + "."

    shared, lone = " ".join([words("a", 25), words("b", 10), words("c", 9)]), words("d", 60)
    texts = [f"{words('e', 9)} {shared} {words('f', 9)}", f"{words('g', 9)} {shared}", f"{lone} {words('h', 9)}", f"{words('i', 9)} {lone}", words("d", 49)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in sentence_dedup.without_repeats(docs).collect()}
    assert [rows[i]["n_removed"] for i in range(5)] == [0, 3, 0, 1, 0]
    assert rows[1]["text"].strip() == words("g", 9) and rows[3]["text"].strip() == words("i", 9)


def test_sentence_dedup(odd_docs, no_docs):
    rows = sentence_dedup.without_repeats(odd_docs.withColumnRenamed("text", "old").selectExpr("*", "old as text")).collect()
    assert len(rows) == odd_docs.count()
    keyed = {(r["doc_id"] if r["doc_id"] is not None else 2**63 - 1, r["old"]) for r in rows}
    gone = defaultdict(set)
    for spots in plain_sentences(keyed).values():
        first = min(spots, key=lambda s: (s[0][0], s[1]))
        for key, a, b in spots:
            if (key, a) != (first[0], first[1]):
                gone[key] |= set(range(a, b))
    assert sum(map(bool, gone.values())) > 10
    pattern = re.compile(sentence_dedup.BREAK)
    for r in rows:
        key = (r["doc_id"] if r["doc_id"] is not None else 2**63 - 1, r["old"])
        sentences, starts = sentence_dedup.cut(r["old"] or "", pattern)
        out = gone[key]
        assert r["n_sentences"] == len(sentences) and r["n_removed"] == len(out)
        assert r["n_spans"] == len([i for i in out if i - 1 not in out])
        assert (r["text"] or "") == "".join((r["old"] or "")[starts[i] : starts[i + 1]] for i in range(len(sentences)) if i not in out)
    assert sentence_dedup.without_repeats(no_docs).count() == 0


@pytest.mark.parametrize("width", ["1g", "2k"])
def test_numbers_follow_the_files(spark, tmp_path, width):
    docs = spark.range(0, 3000, 1, 7).selectExpr("id", "repeat('x', 40) as text", "named_struct('file_path', 'own') as _metadata")
    docs = saved(docs, tmp_path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", width)
        rows, size = numbered(docs.select("id", "_metadata"), Scratch(spark), "place")
        got = {r["id"]: r["place"] for r in rows.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert size == 3000 and sorted(got.values()) == list(range(3000))
    files = docs.select("id", docs.metadataColumn("_metadata").getField("file_path").alias("f")).orderBy("f", "id").collect()
    assert [r["id"] for r in files] == sorted(got, key=got.get)


def test_numbers_of_other_inputs(spark, tmp_path):
    docs = saved(spark.range(100), tmp_path)
    path = str(tmp_path / "docs")
    for df, n in ((spark.range(50).where("id % 3 > 0"), 33), (docs.where("id > 9"), 90), (spark.read.parquet(path, path), 200), (docs.limit(0), 0)):
        rows, size = numbered(df, Scratch(spark), "place")
        assert size == n and sorted(r["place"] for r in rows.collect()) == list(range(n)) and rows.count() == n


def test_addresses_of_the_shared_folder(spark, tmp_path):
    for form in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}"):
        files, root = opened(qualified(spark, form))
        assert root == str(tmp_path) and files.get_file_info(root).is_file is False
    with pytest.raises(Exception):
        opened("unheard://x/y")


def test_feistel_is_a_keyed_permutation():
    for size in (1, 2, 3, 5, 1000, 4097):
        one, other = (training_order.feistel(np.arange(size), size, k) for k in ("a", "b"))
        assert sorted(one) == sorted(other) == list(range(size))
        assert size < 100 or (one != other).any()


def test_training_order(spark, odd_docs, no_docs, tmp_path, monkeypatch):
    monkeypatch.setattr(training_order, "SHARD_SEQUENCES", 7)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(vocabulary(), "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = saved(odd_docs, tmp_path)
    places = training_order.materialise(docs, vocabulary()).collect()
    assert sorted(p["slot"] for p in places) == list(range(docs.count()))
    streams = {}
    for p in places:
        path = p["file"].removeprefix("file:")
        streams[p["shard"]] = np.fromfile(path, "<u2")
        assert streams[p["shard"]].nbytes % p["record_bytes"] == 0 and p["shard"] == p["slot"] // 7
    got = Counter()
    for p in places:
        ids = streams[p["shard"]][p["first_token"] :][: p["n_tokens"]].tolist()
        assert ids[-1] == training_order.END
        got[p["doc_id"], tuple(ids[:-1])] += 1
    assert got == Counter((r["doc_id"], tuple(own.encode_ordinary(r["text"] or ""))) for r in docs.collect())
    for shard in streams:
        spans = sorted((p["slot"], p["first_token"], p["n_tokens"]) for p in places if p["shard"] == shard)
        assert all(a[1] + a[2] == b[1] for a, b in zip(spans, spans[1:])) and spans[0][1] == 0
    again = training_order.materialise(docs, vocabulary()).collect()
    assert {(p["doc_id"], p["slot"]) for p in again} == {(p["doc_id"], p["slot"]) for p in places}
    stream = {}
    table = spark.createDataFrame(places)
    for r in training_order.read_records(table).collect():
        stream[r["shard"], r["record"]] = bytes(r["tokens"])
    for shard, ids in streams.items():
        n = ids.nbytes // (2 * training_order.RECORD_TOKENS)
        assert b"".join(stream[shard, i] for i in range(n)) == ids.tobytes() and (shard, n) not in stream
    assert len(stream) > len(streams) + 5
    at = sorted(stream)[len(stream) // 2]
    later = {(r["shard"], r["record"]): bytes(r["tokens"]) for r in training_order.read_records(table, *at).collect()}
    assert later == {k: v for k, v in stream.items() if k >= at}
    assert training_order.read_records(table, max(streams) + 1).count() == 0
    assert training_order.materialise(saved(no_docs, tmp_path, "none"), vocabulary()).count() == 0


@pytest.mark.parametrize("big", [False, True])
def test_top_k(spark, monkeypatch, big):
    monkeypatch.setattr(topk, "SHARD_ROWS", 300)
    monkeypatch.setattr(topk, "STEP", 64)
    monkeypatch.setattr(topk, "QUERY_ROWS", 10)
    rng = np.random.default_rng(6)
    m = rng.normal(size=(1200, 12)) * rng.choice([0.1, 1, 3], (1200, 1)) * (1e6 if big else 1)
    m[100:160] = m[50]
    rows = [(i, [float(x) for x in v], "x") for i, v in enumerate(m)]
    rows += [(2000, None, ""), (2050, [1.0, None], ""), (2100, [float("nan")] * 12, ""), (None, [1.0] * 12, ""), (2150, [2.0, 1.0], ""), (2151, [], "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = topk.exact_top_k(df, "vec_id", "embedding").collect()
    whole = {i: np.pad(np.floor(256 * np.array(v)), (0, 12 - len(v))).astype(np.int64).tolist() for i, v, _ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    expected = set()
    for q in (i for i in whole if i % 50 == 0):
        scored = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)[:5]
        expected |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)}
    assert {tuple(r) for r in got} == expected and len(got) == len(expected)
    assert topk.exact_top_k(df.where("false"), "vec_id", "embedding").count() == 0


def plain_licenses(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    words, places, base = re.findall(pattern, low), [], set()
    for phrase, label in license_scan.PHRASES:
        p = phrase.split()
        hits = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += hits
        base |= {label} if hits else set()
    best, labels = 0.0, set(base)
    for line in low.split("\n"):
        own = set(re.findall(pattern, line))
        for label, template in license_scan.TEMPLATES:
            tokens = set(template.split())
            share = len(own & tokens) / len(tokens)
            if 10 * len(own & tokens) >= 9 * len(tokens):
                labels.add(label)
                best = max(best, share)
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), best)


def test_license_scan(odd_docs, no_docs):
    rows = license_scan.scan(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert tuple(r[c] for c in list(license_scan.OUTPUT)[:7]) == plain_licenses(r["text"])
    assert any(r["score"] > 0 for r in rows) and any(r["n_base"] > 1 for r in rows)
    assert license_scan.scan(no_docs).count() == 0


def plain_windows(text):
    words, best, labels = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower()), 0.0, set()
    for label, template in license_scan.TEMPLATES:
        tokens, width = set(template.split()), -(-3 * len(template.split()) // 2)
        for i in range(len(words)):
            both = len(tokens.intersection(words[i : i + width]))
            if 10 * both >= 9 * len(tokens):
                labels.add(label)
                best = max(best, both / len(tokens))
    return labels, best


def test_license_notices_do_not_depend_on_line_breaks(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy\n * of this software and associated files"
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that"
    scattered = "released goods stay here and under that roof we find the books of mit students who need a license"
    rng = np.random.default_rng(1)
    mixed = []
    for _ in range(60):
        words = str(rng.choice([t for _, t in license_scan.TEMPLATES])).split()
        for _ in range(rng.integers(0, 12)):
            words.insert(int(rng.integers(0, len(words) + 1)), str(rng.choice(["x", "the", "license", "\n"])))
        mixed.append(" ".join(["start"] * int(rng.integers(0, 3)) + words * int(rng.integers(1, 3))))
    texts = [mit, bsd, scattered, "word\n" * 30 + mit + "\n" + "word " * 30 + mit, *mixed]
    rows = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    for r in rows:
        labels, best = plain_windows(r["text"])
        assert {b["label"] for b in r["blocks"]} == labels and r["score"] == best
    assert [r["labels"] for r in rows[:3]] == ["mit", "bsd", ""]
    assert [(b["first_word"], b["n_words"]) for b in rows[3]["blocks"]] == [(30, 16), (79, 16)]


def test_many_pieces_merge_as_each_alone():
    import random

    import numpy as np
    import pyarrow as pa

    from filmloom.llm import bpe
    from filmloom.llm.queries import vocabulary

    merger, draw = bpe.Merger(vocabulary()), random.Random(5)
    pieces = [bytes(draw.choices(b"abefhinorst \xc3\xa9\xff", k=draw.randint(1, 48))) for _ in range(400)] + [b"a" * 31, b"a"]
    assert merger.merge_many(pieces) == [merger.merge_short(p) for p in pieces] and merger.merge_many([]) == []
    # Texts that hold every separator, one after the other, and more pieces than a generation keeps.
    texts = ["plain words", "", "a\x1fb\x1e c\x1d\x1c\x01\x02 'll", "über \U0001f600 x" * 3, "퟿"]
    scanner, old = bpe.Scanner(), bpe.CACHE_PIECES
    try:
        bpe.CACHE_PIECES = 4
        ids, offsets, counts = bpe.encode_texts(texts, scanner, merger)
    finally:
        bpe.CACHE_PIECES = old
    lists = [bpe._lists(x, counts, pa.int32()) for x in (ids, offsets)]
    assert merger.decode_lists(*lists).to_pylist() == [t.encode() for t in texts]
    assert merger.decode_lists(*[x.slice(2, 2) for x in lists]).to_pylist() == [t.encode() for t in texts[2:4]]
    # A gap between tokens stays a gap, and a null list has no bytes.
    gap = [pa.array([[int(merger.ranks[b"a"]), int(merger.ranks[b"b"])], None], pa.list_(pa.int32())), pa.array([[0, 3], None], pa.list_(pa.int32()))]
    assert merger.decode_lists(*gap).to_pylist() == [b"a\0\0b", None]
    assert np.array_equal(np.asarray(lists[0].offsets)[-1:], [len(ids)])


def test_encoding_workers_stay_small(spark):
    import tracemalloc

    from filmloom.llm import bpe

    tracemalloc.start()
    try:
        bpe._classes()
        assert tracemalloc.get_traced_memory()[1] < 40 << 20
    finally:
        tracemalloc.stop()
    merger = bpe.Merger(vocabulary())
    one, two = merger.lookup(["zqxjzqxj", "zqxjzqxjzqxj"])
    assert all(any(x is y for y in two) for x in one if x in two)
    docs = spark.createDataFrame([(1, "a b"), (2, None), (None, "c")], "doc_id long, text string")
    rows = bpe.decode(bpe.encode(docs, vocabulary()), vocabulary(), keep=["doc_id"])
    assert rows.columns == ["doc_id", "decoded"]
    assert sorted(bytes(r["decoded"]) for r in rows.collect()) == [b"", b"a b", b"c"]


def test_covered_bytes_of_many_texts_at_once():
    import pyarrow as pa

    rng, length = np.random.default_rng(4), 5
    kind = pa.list_(pa.struct([("first", pa.int64()), ("n", pa.int32()), ("mask", pa.binary())]))
    sizes, lists, plain = [40, 5, 0, 23], [], []
    for size in sizes:
        items, gone, first = [], np.zeros(size, bool), 0
        while first + length <= size:
            n = int(min(rng.integers(1, 12), size - length + 1 - first))
            hit = rng.random(n) < 0.2
            mask = [np.packbits(hit).tobytes(), None, np.packbits(hit).tobytes()[:1]][rng.integers(3)]
            bits = np.ones(n, bool) if mask is None else np.unpackbits(np.frombuffer(mask, np.uint8))[:n]
            for w in np.flatnonzero(bits):
                gone[first + w : first + w + length] = True
            if rng.random() < 0.7 or mask is None:
                items.append({"first": first, "n": n, "mask": mask})
            else:
                items.append({"first": first, "n": n, "mask": b"\0"})
                gone[:] = False
                for x in items:
                    bits = np.ones(x["n"], bool) if x["mask"] is None else np.unpackbits(np.frombuffer(x["mask"], np.uint8))[: x["n"]]
                    for w in np.flatnonzero(bits):
                        gone[x["first"] + w : x["first"] + w + length] = True
            first += n
        lists.append(items)
        plain.append(gone)
    at = np.concatenate([[0], np.cumsum(sizes)])
    for low, high in ((0, 4), (1, 4), (2, 3)):
        found, owner = suffix_dedup.flat_lists(pa.array(lists, kind).slice(low, high - low))
        base = at[low:high][owner] - at[low]
        got = suffix_dedup.covered(found, base, at[high] - at[low], length)
        assert np.array_equal(got, np.concatenate(plain[low:high]))
