"""The pipeline's stages on one fixture, each held against what it must do to its own input."""

import base64
import random
import re

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from filmloom.llm import shingle_join
from filmloom.llm.common import Scratch
from filmloom.llm.queries import QUERIES, SQL, vocabulary
from filmloom.llm.secrets import redacted
from tests.compare import compare
from tests.llm.test_pipeline_operators import plain_counts

SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark, odd_docs, tmp_path):
    docs = odd_docs
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality_rules"](spark, docs, SF)
    assert kept.columns == docs.columns
    expected = [r for r in docs.collect() if (c := plain_counts(r["text"]))["n_words"] >= 50 and 2 * c["n_repeat_words"] <= c["n_words"]]
    assert {r["doc_id"] for r in kept.collect()} <= {r["doc_id"] for r in expected}
    assert kept.count() >= 0.8 * len(expected)

    single = stages["ngram_jaccard"](spark, docs, SF)
    assert single.columns == docs.columns
    assert sorted(map(str, (r["doc_id"] for r in single.collect()))) == sorted(map(str, plain_stay(docs.collect())))

    assert stages["secret_scan"](spark, docs, SF).count() == redacted(docs).count() == docs.count()
    mixed = stages["mix_sources"](spark, docs, SF)
    assert mixed.columns == docs.columns

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(vocabulary(), "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r["doc_id"]: r["text"] for r in single.collect()}
    for r in stages["byte_bpe"](spark, single, SF).collect():
        assert r["ids"] == own.encode_ordinary(texts[r["doc_id"]] or "")


def test_stages_on_an_empty_table(spark, no_docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, SF).count() == 0


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 100 and {"doc_id", "ids", "offsets"} <= set(out.columns)


def test_queries_with_sql(spark):
    for name, sql in SQL.items():
        ok, note = compare(spark, SF, name, QUERIES[name], sql)
        assert ok, (name, note)


def plain_near_copies(rows, width=5, share=(4, 5)):
    """Component of every (id, text) row by comparing all pairs; None for texts without words."""
    sets = []
    for _, text in rows:
        words = re.findall(shingle_join.WORD_BYTES, shingle_join.lowered(text or ""))
        n = min(width, len(words))
        sets.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set())
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and share[1] * both >= share[0] * (len(sets[i]) + len(sets[j]) - both):
                label = [label[j] if x == label[i] else x for x in label]
    return [x if s else None for x, s in zip(label, sets)]


def plain_stay(rows):
    """Ids of the rows that stay: of each component the smallest (id, text hash), null ids last; wordless texts all stay."""
    rows = list({(r["doc_id"], r["text"]): r for r in rows}.values())
    keys = [(r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in rows]
    parts, first = plain_near_copies([(r["doc_id"], r["text"]) for r in rows]), {}
    for key, part in zip(keys, parts):
        if part is not None:
            first[part] = min(key, first.get(part, key))
    return [r["doc_id"] for r, key, part in zip(rows, keys, parts) if part is None or first[part] == key]


def families(rng, n=30):
    """Texts with 0 to 25 single-word edits, so that pairs lie on both sides of the threshold."""
    texts = []
    for family in range(n):
        base = [f"w{family}x{i}" for i in range(rng.choice([6, 30, 45, 60, 90, 200, 400]))]
        for _ in range(4):
            words = list(base)
            for _ in range(rng.randint(0, 1 + len(base) // 16)):
                words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
            texts.append(" ".join(words[: len(words) - rng.choice([0, 0, 1, len(words) // 10])]))
    return texts


def test_near_copies_share_five_words_in_four_fifths(spark):
    rows = list(enumerate(families(random.Random(5))))
    random.Random(6).shuffle(rows)
    expected, first = plain_near_copies(rows), {}
    for (i, _), x in zip(rows, expected):
        first[x] = min(i, first.get(x, i))
    narrow = plain_near_copies(rows, 3, (9, 10))
    assert len(set(expected)) < len(set(narrow)) - 3  # the contract of operator 9 would leave near copies
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = [r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, SF).collect()]
    assert sorted(left) == sorted(first.values())


def test_prefixes_meet_for_every_pair_within_the_threshold():
    rng, rule = np.random.default_rng(2), corpus_pipeline.NEAR_COPIES
    for size in (4, 5, 6, 9, 10, 12, 19, 24, 25, 27, 40, 95, 200, 333):
        for _ in range(60):
            whole = rng.integers(0, 2**63, 2 * size).astype(np.uint64)
            more = int(rng.integers(0, size // 4 + 1))
            shared = -(-4 * (2 * size + more) // 9)  # the fewest that reach 4/5
            if shared > size:
                continue
            one, other = whole[:size], np.concatenate([whole[:shared], whole[size : 2 * size + more - shared]])
            assert 5 * shared >= 4 * (len(one) + len(other) - shared)
            x, y = (shingle_join.signatures(v, shingle_join.band_limits(len(v), rule), rule) for v in (one, other))
            assert np.intersect1d(x, y).size


def test_near_copies_under_repeated_and_null_ids(spark):
    one, two, three = (" ".join(f"{n}{i}" for i in range(60)) for n in "abc")
    rows = [(7, one), (7, one + " more"), (7, two), (8, two + " more"), (None, three), (None, three + " more"), (None, three), (9, ""), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = [tuple(r) for r in corpus_pipeline.drop_near_copies(spark, docs, SF).collect()]
    assert sorted((str(i), (t or "")[:1]) for i, t in left) == [("7", "a"), ("7", "b"), ("9", ""), ("9", ""), ("None", "c")]


def test_folded_sketches_are_sketches_of_fewer_slots():
    rng = np.random.default_rng(3)
    for n in (1, 300, 5000):
        values = rng.integers(0, 2**63, n).astype(np.uint64)
        wide, narrow = shingle_join.parity(values, 4096), shingle_join.parity(values, 512)
        assert (shingle_join.folded([wide, narrow])[0] == shingle_join.folded([narrow])[0]).all()
    rule = corpus_pipeline.NEAR_COPIES
    assert rule.bits(10) == 512 and rule.bits(20_000) == 32_768 and shingle_join.CONTRACT.bits(20_000) == 256


def test_candidates_grow_with_the_rows(spark, tmp_path):
    """Long unrelated texts that share a passage: five times the texts, at most six times the candidate pairs."""
    
    class Kept(Scratch):
        def save(self, df, name):
            out = super().save(df, name)
            if name.startswith("pairs-") and name[6:].isdigit():
                counts.append(out.count())
            return out

    rng, found = random.Random(8), []
    passage = " ".join(f"p{i}" for i in range(60))
    for n in (40, 200):
        texts = []
        for family in range(n):
            base = [f"w{family}x{rng.randrange(10**6)}" for _ in range(3000)]
            texts.append(" ".join([*base, passage]))
            if family % 4 == 0:
                texts.append(" ".join([*base[:2900], passage]))
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        counts = []
        rows = shingle_join.similar_classes(docs, Kept(spark), rule=corpus_pipeline.NEAR_COPIES).collect()
        assert len({r["component"] for r in rows}) == n
        found.append(sum(counts))
    assert 0 < found[0] and found[1] <= 6 * found[0]


def test_near_copies_meet_in_one_of_their_groups(spark, monkeypatch):
    """Copies share most of their groups; a pair must not leave each task that holds one of them."""
    classes = [(c, 100, bytes(32), 40, list(range(1, 9))) for c in range(30)]
    classes = spark.createDataFrame(classes, "class bigint, n_shingles bigint, sketch binary, score bigint, early array<bigint>")
    groups = spark.createDataFrame([(s, c) for s in range(1, 41) for c in range(30)], "signature bigint, class bigint")
    made, kind = [], type(groups)
    distinct = kind.distinct

    def kept(df):
        made.append(df)
        return distinct(df)

    monkeypatch.setattr(kind, "distinct", kept)
    for most, pairs in ((1, 29), (None, 435)):
        found = shingle_join.propose(groups, classes, None, most, shingle_join.CONTRACT)
        assert found.count() == made[-1].count() == pairs
