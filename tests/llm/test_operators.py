"""Corpus operators on small tables: brute force, round trips, and odd rows."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from pyspark.util import PythonEvalType
from tokenizers import Tokenizer

import corpus_pipeline
from tidegrid.llm import block_neighbours, byte_bpe, fm_quality, lm_score, poisson_mix, quality_rules, suffix_dedup, token_store, trie_join, url_filters
from tidegrid.llm.common import new_folder
from tidegrid.llm.components import components

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def vocabulary(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice("abcdeéßlmnorst") for _ in range(rng.randrange(2, 9))) for _ in range(n)]


def corpus(seed: int = 5) -> list[tuple]:
    """Families of near copies, exact copies, shared passages, and odd texts."""
    rng = random.Random(seed)
    words = vocabulary(rng, 400)
    texts: list[str | None] = [None, "", " \n\t", "one", "One TWO", "one two", "x" * 900, "ab" * 300, "ab" * 300]
    passage = " ".join(rng.choice(words) for _ in range(60))
    for _ in range(6):
        base = [rng.choice(words) for _ in range(rng.randrange(40, 160))]
        for edits in (0, 0, 1, 2, 3, 5, 9, 20):
            copy = list(base)
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    for _ in range(20):
        left, right = ([rng.choice(words) for _ in range(rng.randrange(3, 60))] for _ in range(2))
        texts.append(" ".join([*left, passage, *right]))
    texts.append(" ".join(rng.choice(words) for _ in range(9000)))
    rng.shuffle(texts)
    return [(i, t, rng.choice(["en", "fr", None]), rng.choice(["a", "b", "b", "b", None]), len(t or "")) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def rows() -> list[tuple]:
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def clashing(docs):
    """Extra columns with the names that operators might use."""
    extra = ("_set", "_text", "_family", "score", "copy", "rank", "stratum", "_key", "rule", "_source", "row", "content", "_block")
    return docs.select("*", *[F.lit("x").alias(c) for c in extra])


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def word_set(text: str | None, n: int) -> frozenset:
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < n:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + n]) for k in range(len(words) - n + 1))


def brute_links(rows, n: int, num: int):
    """component of each row and its number of links, by comparing all pairs."""
    sets = {i: word_set(t, n) for i, t, *_ in rows}
    root, degree = {i: i for i in sets}, collections.Counter()

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if j < i and both and 100 * both >= num * (len(sets[i]) + len(sets[j]) - both):
                degree[i] += 1
                degree[j] += 1
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return {i: (len(sets[i]), top(i), degree[i]) for i in sets}


@pytest.mark.parametrize(
    ("n", "num", "rare", "sets", "walkers"),
    [(3, 90, False, 800, 128), (5, 80, True, 800, 128), (3, 50, True, 4, 3), (5, 80, False, 4, 128)],
)
def test_trie_join_equals_all_pairs(spark, rows, clashing, monkeypatch, n, num, rare, sets, walkers):
    monkeypatch.setattr(trie_join, "BLOCK_SETS", sets)
    monkeypatch.setattr(trie_join, "WALKERS", walkers)
    out = trie_join.linked_documents(clashing, trie_join.Likeness(n, num, 100, rare)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in out} == brute_links(rows, n, num)
    assert len(out) == len(rows)


def test_trie_prunes_and_counts():
    rng = np.random.default_rng(3)
    like = trie_join.Likeness(3, 70, 100)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(90)]
    found = set(trie_join.linked(sets, sets[::-1], like))
    want = set()
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[::-1]):
            both = len(np.intersect1d(a, b))
            if 100 * both >= 70 * (len(a) + len(b) - both):
                want.add((i, j))
    assert found == want


@pytest.mark.parametrize(("num", "marked"), [(80, 0.0), (80, 0.4), (90, 0.25), (50, 0.6)])
def test_linked_sets_share_a_signature(num, marked):
    """Whatever is called frequent, and however few parts are filled."""
    rng = np.random.default_rng(num)
    like = trie_join.Likeness(5, num, 100)
    signer = trie_join.Signer(like, rng.random(1 << trie_join.BUCKET_BITS) < marked)
    tried = 0
    for _ in range(1500):
        size = int(rng.integers(1, 90))
        one = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        keep = one[rng.random(len(one)) > rng.uniform(0, 1 - num / 100)]
        two = np.unique(np.concatenate([keep, rng.integers(0, 1 << 63, int(rng.integers(0, 4)), dtype=np.uint64)]))
        both = len(np.intersect1d(one, two))
        if not len(two) or np.array_equal(one, two) or 100 * both < num * (len(one) + len(two) - both):
            continue
        tried += 1
        assert len(np.intersect1d(signer.sign(one), signer.sign(two)))
    assert tried > 100


@pytest.mark.parametrize(("like", "sizes"), [(trie_join.Likeness(3, 90, 100, False), (5500, 9500)), (trie_join.Likeness(5, 80, 100), (20, 60))])
def test_unlike_sets_share_no_signature(like, sizes):
    """Parts that two sets leave empty are no likeness: they would tie most sets into one family."""
    rng = np.random.default_rng(4)
    signer = trie_join.Signer(like)
    signs = [np.unique(signer.sign(np.unique(rng.integers(0, 1 << 63, int(rng.integers(*sizes)), dtype=np.uint64)))) for _ in range(200)]
    assert len(np.unique(np.concatenate(signs))) == sum(map(len, signs))


def test_large_families_are_joined_in_rounds(spark, rows, clashing, monkeypatch):
    """A round sends each set SENT times on average, and the rounds together find every link."""
    monkeypatch.setattr(trie_join, "BLOCK_SETS", 2)
    monkeypatch.setattr(trie_join, "SENT", 1)
    rounds, kept = [], trie_join.written
    monkeypatch.setattr(trie_join, "written", lambda df, name, *at: rounds.append(name) or kept(df, name, *at))
    out = trie_join.linked_documents(clashing, trie_join.Likeness(3, 50, 100)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in out} == brute_links(rows, 3, 50)
    assert rounds.count("tree-links") > 2


@pytest.mark.parametrize("marked", [0.0, 0.3, 1.0])
def test_linked_sets_share_enough_of_their_prefixes(marked):
    rng = np.random.default_rng(int(marked * 10))
    signer = trie_join.Signer(trie_join.Likeness(5, 80, 100), rng.random(1 << trie_join.BUCKET_BITS) < marked)
    tried = 0
    for _ in range(3000):
        one = np.unique(rng.integers(0, 1 << 63, int(rng.integers(1, 120)), dtype=np.uint64))
        keep = one[rng.random(len(one)) > rng.uniform(0, 0.2)]
        two = np.unique(np.concatenate([keep, rng.integers(0, 1 << 63, int(rng.integers(0, 5)), dtype=np.uint64)]))
        both = len(np.intersect1d(one, two))
        if not len(two) or np.array_equal(one, two) or 100 * both < 80 * (len(one) + len(two) - both):
            continue
        tried += 1
        (need, first), (other_need, other_first) = signer.prefix(one), signer.prefix(two)
        assert len(np.intersect1d(first, other_first)) >= max(need, other_need)
    assert tried > 300


def test_keep_one_judges_keys_with_unlike_texts_apart(spark):
    """Key 5 stands on a copy of key 1's text and on a text of its own, in either order."""
    near, other = " ".join(f"w{k}" for k in range(80)), " ".join(f"v{k}" for k in range(80))
    rows = [(5, near + " x"), (5, other), (1, near), (5, other), (7, ""), (7, None), (7, other + " y"), (None, near), (9, "lonely text")]
    wanted = sorted([(1, near), (5, other), (7, ""), (9, "lonely text"), (None, near)], key=repr)
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in order], DOCS)
        kept = [(r.doc_id, r.text or "") for r in trie_join.keep_one(docs).collect()]
        assert sorted(kept, key=repr) == wanted


def test_keep_one_takes_rows_whole(spark, clashing, rows):
    links = brute_links(rows, 5, 80)
    kept = trie_join.keep_one(clashing)
    assert kept.columns == clashing.columns
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == sorted((i, t or "") for i, t, *_ in rows if links[i][1] == i)


def test_trie_join_repeated_rows_nulls_and_empty(spark, nothing):
    some = [(1, "a b c d", None, None, 1), (1, "a b c d", None, None, 1), (None, "a b c d", None, None, 1), (None, None, None, None, None)]
    out = trie_join.linked_documents(spark.createDataFrame(some, DOCS), trie_join.Likeness(3, 90, 100)).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.n_links) for r in out) == [(0, 0, 0), (0, 1, 2), (1, 1, 2), (1, 1, 2)]
    assert trie_join.linked_documents(nothing, trie_join.Likeness()).count() == 0
    kept = trie_join.keep_one(spark.createDataFrame(some[:2], DOCS))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"] and kept.count() == 1


def test_components_of_chains_and_stars(spark):
    chain = [(k, k + 1) for k in range(0, 40)] + [(100, 200 + k) for k in range(30)]
    out = components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {r.node: r.root for r in out} == {k: 0 for k in range(41)} | {100: 100} | {200 + k: 100 for k in range(30)}


def brute_repeats(rows, length):
    seen = collections.Counter()
    for _, t, *_ in rows:
        b = (t or "").encode()
        seen.update(b[k : k + length] for k in range(len(b) - length + 1))
    out = {}
    for i, t, *_ in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize(("length", "anchor", "block_rows"), [(200, 50, 50_000), (200, 50, 2), (60, 20, 50_000), (31, 7, 5)])
def test_suffix_dedup_equals_counting_all_strings(rows, clashing, length, anchor, block_rows):
    out = suffix_dedup.digests(clashing, length=length, anchor=anchor, block_rows=block_rows).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out} == brute_repeats(rows, length)
    assert len(out) == len(rows)


def test_suffix_dedup_in_pieces_and_hot_anchors(monkeypatch, rows, docs):
    monkeypatch.setattr(suffix_dedup, "PIECE", 700)
    monkeypatch.setattr(suffix_dedup, "HOT_SHARE", 50)
    out = suffix_dedup.digests(docs, block_rows=3).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out} == brute_repeats(rows, 200)


def test_suffix_dedup_repeated_rows_and_empty(spark, nothing):
    long = " ".join(vocabulary(random.Random(1), 80))
    some = [(7, long, "en", "a", 1), (7, long, "en", "a", 1), (None, "short", None, None, None)]
    out = suffix_dedup.remove_repeats(spark.createDataFrame(some, DOCS)).collect()
    assert sorted(r.text for r in out) == ["", "", "short"]
    assert suffix_dedup.digests(nothing).count() == 0


def test_classifier_learns_held_out_rows(spark, nothing):
    rng = random.Random(2)
    words = vocabulary(rng, 300)
    rows, marks = [(0, None, "en", "a", None), (1, "", "en", "a", 0)], []
    for i in range(2, 900):
        good = rng.random() < 0.7
        text = [rng.choice(words) for _ in range(rng.randrange(30, 80))]
        text = " ".join(text) if good else " ".join(w.upper() + "!!" for w in text) if rng.random() < 0.5 else " | ".join(text)
        rows.append((i, text, "en", "a", len(text)))
        marks.append((i, int(good), 0))
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in fm_quality.classify(spark.createDataFrame(rows, DOCS), labels).collect()}
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in out.items())
    held = [out[i].predicted == q for i, q, _ in marks if out[i].held_out]
    assert len(held) > 200 and sum(held) / len(held) > 0.97
    assert fm_quality.classify(nothing, labels).count() == 0
    unlabelled = fm_quality.classify(spark.createDataFrame(rows[:5], DOCS), labels.where("false")).collect()
    assert {r.score for r in unlabelled} == {0.5}


def test_pairwise_term_equals_the_double_sum():
    machine = fm_quality.Machine.fresh()
    slots, values = np.array([3, 9, 40, 41]), np.array([0.5, 1, 2, 0.25], np.float32)
    raw = machine.sums(slots, values, np.array([0]))[0][0]
    want = sum(machine.factors[a] @ machine.factors[b] * x * y for k, (a, x) in enumerate(zip(slots, values)) for b, y in list(zip(slots, values))[:k])
    assert raw == pytest.approx(want, rel=1e-4)


def test_classifier_learns_from_one_row_of_a_key(spark, docs, monkeypatch):
    labels = docs.where("doc_id IS NOT NULL").selectExpr("doc_id", "cast(doc_id % 2 AS int) AS quality", "0 AS toxic")
    made = []
    into_one = type(docs).repartition

    def seen(frame, *how):
        made.append(frame)
        return into_one(frame, *how)

    monkeypatch.setattr(type(docs), "repartition", seen)
    monkeypatch.setattr(type(docs), "coalesce", lambda *_: pytest.fail("features made in the fitting task"))
    once = fm_quality.fit(docs, labels, "doc_id", "text", "n_chars")
    repeated = docs.union(docs).union(docs.where("doc_id = 3"))
    assert fm_quality.fit(repeated, labels, "doc_id", "text", "n_chars") == once
    assert made[0].count() == made[1].count() == labels.where(~fm_quality.held_out("doc_id")).count()


def test_url_filter_cases(spark):
    urls = [None, "", "example.com/en/", "HTTP://WWW.Example.COM/en/x?q#f", "https://a.b.example.com/en/", "http://example.com/english", "http://net/es/", "x://a.net/fr/1", "x://anet/fr/", "x://com", "x://com?/", "x://a.com//en/", "x://y#/://z"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    out = {r.page_id: r for r in url_filters.filter_urls(pages, "page_id", "url", url_filters.RULES).collect()}
    rules = [out[i].rule for i in range(len(urls))]
    assert rules == [None, None, None, "www.example.com/en/", "example.com/en/", "com/", "net/es/", "net/fr/", None, None, None, "com/", None]
    assert (out[3].host, out[3].path, out[3].verdict) == ("www.example.com", "/en/x", "allow")
    assert (out[12].host, out[12].path) == ("y", "") and out[4].verdict == "block" and out[0].verdict == "allow"


def test_url_filter_part_of_a_segment_and_contradictions():
    root = url_filters.build((url_filters.Rule("a.b", "/x/y", "block"), url_filters.Rule("b", "", "allow")))
    assert url_filters.longest_rule(root, "q.a.b", "/x/yz/1") == ("a.b/x/y", "block")
    assert url_filters.longest_rule(root, "q.a.b", "/x/z") == ("b", "allow")
    assert url_filters.longest_rule(root, "q.a.c", "/") is None
    with pytest.raises(ValueError):
        url_filters.build((url_filters.Rule("a", "/", "block"), url_filters.Rule("a", "/", "allow")))


def test_language_model_prefers_the_target(spark, nothing):
    rng = random.Random(4)
    one, two = vocabulary(rng, 60), vocabulary(rng, 60)
    rows = [(i, " ".join(rng.choice(one if i % 3 == 0 else two) for _ in range(50)), None, None, 1) for i in range(300)] + [(300, None, None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    models = lm_score.fit(docs, docs.where("doc_id % 3 = 0 AND doc_id < 150"), "doc_id", "text")
    out = {r.doc_id: r for r in lm_score.score(docs, models, "doc_id", "text").collect()}
    assert max(out[i].score for i in range(150, 300) if i % 3 == 0) < min(out[i].score for i in range(150, 300) if i % 3)
    assert out[300].n_words == 0 and out[300].score == 0
    # both models are distributions over the vocabulary after any word
    v = len(models.words) + 2
    for before in (lm_score.START, lm_score.UNKNOWN, 5):
        for side in range(2):
            loss = models.single[side, 1:] + models.leave[side, before]
            here = models.pairs // v == before
            loss[models.pairs[here] % v - 1] = models.losses[side, here]
            assert np.exp(-loss).sum() == pytest.approx(1)
    # without targets, and without rows
    lm_score.score(docs, lm_score.fit(docs, docs.where("false"), "doc_id", "text"), "doc_id", "text").collect()
    assert lm_score.score(nothing, lm_score.fit(nothing, nothing, "doc_id", "text"), "doc_id", "text").count() == 0


def test_language_model_counts_equal_brute_force(spark, rows, docs):
    models = lm_score.fit(docs, docs.where("doc_id % 2 = 0"), "doc_id", "text")
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), t or "") for _, t, *_ in rows]
    words = [WORDS.findall(t) for t in words]
    assert len(models.words) == len({w for d in words for w in d})
    assert len(models.pairs) == len({p for d in words for p in zip(["<s>", *d], d)})


def test_language_model_keeps_rare_words_and_pairs(spark, monkeypatch):
    """Far over 2^20 words in all, so that whatever occurs once or twice has a tiny share."""
    monkeypatch.setattr(lm_score, "BUCKET_BYTES", 1 << 16)
    rng = random.Random(5)
    some = vocabulary(rng, 300)
    given = [(0, "the " * 1_200_000)] + [(i, " ".join(["the", *(rng.choice(some[: 300 if i % 2 else 200]) for _ in range(30))])) for i in range(1, 61)]
    docs = spark.createDataFrame(given, "doc_id long, text string").repartition(4, "doc_id")
    models = lm_score.fit(docs, docs.where("doc_id % 2 = 0"), "doc_id", "text")
    sides = ([t.split() for _, t in given], [t.split() for i, t in given if i % 2 == 0])
    ones, firsts, twos = ([collections.Counter(x for d in side for x in f(d)) for side in sides] for f in (list, lambda d: ["<s>", *d[:-1]], lambda d: zip(["<s>", *d], d)))
    n, v = [sum(c.values()) for c in ones], len(ones[0])

    def loss(words, side):
        scale = (n[1] / n[0], 1.0)[side]
        total = 0.0
        for a, b in zip(["<s>", *words], words):
            share = (ones[side][b] * scale + 1) / (n[side] * scale + v + 1)
            total -= np.log((twos[side][a, b] * scale + lm_score.M * share) / (firsts[side][a] * scale + lm_score.M))
        return total / len(words)

    assert len(models.words) == v and len(models.pairs) == len(twos[0])
    unseen = [(100, "the never-seen " + some[250]), (101, some[0])]
    texts = dict(given + unseen)
    for asked in (docs, spark.createDataFrame(unseen, docs.schema)):
        for r in lm_score.score(asked, models, "doc_id", "text").collect():
            words = texts[r.doc_id].split()
            assert r.n_words == len(words)
            assert (r.loss_background, r.loss_target) == pytest.approx((loss(words, 0), loss(words, 1)), rel=1e-9)


def test_token_shards_hold_every_document(spark, rows, clashing, nothing):
    model = public_tokenizers.path("word_bpe_49k.json")
    key_type = clashing.schema["doc_id"].dataType
    folder = new_folder(spark, "test-shards")
    token_store.write_shards(clashing, folder, "doc_id", "text", model, shard_ids=3000)
    library = Tokenizer.from_file(model)
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 1] for i, t, *_ in rows}
    out = token_store.read_documents(spark, folder, "doc_id", key_type).orderBy("doc_id").collect()
    at = 0
    for r in out:
        want = ids[r.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(want), zlib.crc32(np.array(want, "<u4").tobytes()))
        at += len(want)
    assert len(out) == len(rows)
    asked = spark.createDataFrame([(3,), (40,), (9999,), (None,)], "doc_id long")
    got = token_store.read_keys(spark, folder, asked, "doc_id", key_type).collect()
    assert {r.doc_id: r.ids for r in got} == {3: ids[3], 40: ids[40]}
    empty = new_folder(spark, "test-shards")
    token_store.write_shards(nothing, empty, "doc_id", "text", model)
    assert token_store.read_documents(spark, empty, "doc_id", key_type).count() == 0


def test_token_shards_with_repeated_and_null_keys(spark):
    some = [(5, "b", None, None, 1), (5, "a", None, None, 1), (5, "a", None, None, 1), (None, "x y", None, None, 1), (None, None, None, None, 1)]
    docs = spark.createDataFrame(some, DOCS)
    folder = new_folder(spark, "test-shards")
    token_store.write_shards(docs, folder, "doc_id", "text", public_tokenizers.path("word_bpe_49k.json"))
    out = token_store.read_documents(spark, folder, "doc_id", docs.schema["doc_id"].dataType).collect()
    assert sorted(r.start for r in out) == sorted(np.cumsum([0] + [r.n_tokens for r in sorted(out, key=lambda r: r.start)])[:-1].tolist())
    assert [r.doc_id for r in sorted(out, key=lambda r: r.start)] == [None, None, 5, 5, 5]


def test_perfect_hash_is_minimal_and_rejects():
    keys = [b"=%d" % k for k in range(20_000)]
    function = token_store.PerfectHash.build(keys)
    slots, marks = function.slots(keys)
    assert sorted(slots.tolist()) == list(range(len(keys)))
    by_slot = np.zeros(len(keys), "<u4")
    by_slot[slots] = marks
    other, foreign = function.slots([b"=%d" % k for k in range(20_000, 40_000)])
    assert ((other >= 0) & (by_slot[other] == foreign)).sum() == 0


def test_piece_encoder_equals_the_library():
    model = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(model)
    with open(model, "rb") as file:
        encoder = token_store.PieceEncoder(file.read())
    rng = random.Random(1)
    texts = ["".join(rng.choice("  \n\t\x1c\x85\xa0'srtvemldLaéÉ٣12!?ñ中🙂ΣςİÅ<|endoftext|>") for _ in range(rng.randrange(30))) for _ in range(3000)]
    # the tokenizer's own strings are one id each, wherever they stand
    own = ["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|endof", "text|>"]
    texts += ["".join(rng.choice([*own, "a", " ", "B c", "\n", "é", "́", "'s", "7"]) for _ in range(rng.randrange(1, 12))) for _ in range(2000)]
    for text, got in zip(texts, encoder.encode([t.encode() for t in texts])):
        assert np.frombuffer(got, "<u2").tolist() == [*library.encode(text, add_special_tokens=False).ids, 1]


def test_neighbours_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(block_neighbours, "ROW_BLOCK", 150)
    monkeypatch.setattr(block_neighbours, "QUERY_BLOCK", 10)
    monkeypatch.setattr(block_neighbours, "TILE", 64)
    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(700, 12)).astype(np.float32)
    vectors[100:400] = vectors[40]
    rows = [(i, v.tolist(), "x") for i, v in enumerate(vectors)]
    rows += [(1000, None, "x"), (1020, [0.0] * 12, "x"), (1040, [float("nan")] * 12, "x"), (1060, [float("inf")] + [1.0] * 11, "x"), (1080, [None] + [1.0] * 11, "x"), (1100, [], "x"), (None, [1.0] * 12, "x"), (1120, [1.0, 2.0], "x"), (1121, [2.0, 0.0], "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    out = block_neighbours.neighbours(table, lambda name: name % 20 == 0, "vec_id", "embedding").collect()
    got = collections.defaultdict(list)
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append((r.vec_id, r.score))
    x = vectors.astype(np.float64)
    want = {1120: [(1121, 2.0)]}
    for q in range(0, 700, 20):
        score = np.zeros(700)
        for j in range(12):
            score += x[:, j] * x[q, j]
        score[q] = -np.inf
        want[q] = [(int(i), float(score[i])) for i in np.lexsort((np.arange(700), -score))[:20]]
    assert dict(got) == want
    assert block_neighbours.neighbours(table.where("false"), lambda name: name % 20 == 0, "vec_id", "embedding").count() == 0


def test_error_bound_holds():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(50, 33)) * rng.lognormal(size=(50, 1)), rng.normal(size=(60, 33)) ** 3
    a, s, e = block_neighbours.quantised(x)
    b, t, f = block_neighbours.quantised(y)
    near = block_neighbours.integer_products(a, b) * s[:, None] * t
    off = np.linalg.norm(x, axis=1)[:, None] * f + e[:, None] * np.linalg.norm(b * t[:, None], axis=1)
    assert (np.abs(near - x @ y.T) <= off + 1e-9).all()


def brute_counts(text):
    text = text or ""
    words, seen, dup = WORDS.findall(text), set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    windows = collections.Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    inside = {j for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for j in range(k, k + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


def test_quality_counts_and_thresholds(spark, rows, clashing, nothing):
    rng = random.Random(9)
    words = vocabulary(rng, 200)
    extra, marks = [], []
    for i in range(10_000, 12_600):
        good = i % 5 > 0
        text = " ".join(rng.choice(words) + ("" if good else "#*") for _ in range(40))
        extra.append((i, text, "en" if i % 100 else "xx", "s", len(text)))
        marks.append((i, int(good), 0))
    lines = [(9001, "a b\n \na b\na  b\n" + "p q r s t u v w " * 4, "en", "s", 1), (9002, "a é ñ\x0b#b\x1cc", None, None, 1)]
    docs = spark.createDataFrame([*rows, *lines, *extra], DOCS)
    labels = spark.createDataFrame([*marks, (None, 1, 0), (9001, None, 0)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in quality_rules.judge(docs, labels).collect()}
    for i, text, *_ in [*rows, *lines]:
        r = out[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_counts(text)
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert all(out[i].kept == bool(q) for i, q, _ in marks if i % 100)
    # the stratum with few labels proves nothing
    assert all(out[i].kept for i in range(10_000, 12_600, 100))
    assert quality_rules.judge(nothing, labels).count() == 0
    assert quality_rules.judge(clashing, labels.where("false")).where("kept = base_failed").count() == 0


def test_binomial_bound_is_exact():
    def below(k, n, p):
        import math

        return sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))

    for k, n, p, miss in ((0, 100, 0.03, 0.05), (0, 98, 0.03, 0.05), (3, 400, 0.02, 0.05), (2, 400, 0.02, 0.012), (50, 5000, 0.0125, 0.05)):
        assert quality_rules.proven(k, n, p, miss) == (below(k, n, p) <= miss)
    assert quality_rules.last_level([0, 9, 9, 9], 2000, 0.01, 0.05) == 4
    assert quality_rules.last_level([0, 0, 90, 0], 2000, 0.01, 0.05) == 2
    assert quality_rules.last_level([0, 0, 0, 3], 3, 0.01, 0.05) == 0
    # so few good rows suffice where none is dropped
    assert quality_rules.last_level([0], 86, 0.05, 0.05 / 4) == 1 and quality_rules.last_level([0], 85, 0.05, 0.05 / 4) == 0


STEPS_ROWS = "doc_id long, stratum string, _text long, steps array<int>, base_failed boolean"


def step_rows(rng, n, first, stratum):
    return [(first + i, stratum, first + i, [min(40, int(rng.expovariate(0.4))) for _ in quality_rules.RATIOS], False) for i in range(n)]


def brute_levels(unlabelled):
    """Level of (ratio, step), by the cutoffs of each level."""
    table = {}
    for r in range(len(quality_rules.RATIOS)):
        cuts = []
        for t in range(1, quality_rules.LEVELS + 1):
            allowed = t * quality_rules.WIDEST * len(unlabelled) / quality_rules.LEVELS
            reach = [sum(steps[r] >= s for steps in unlabelled) for s in range(1, 41)]
            cuts.append(next((s for s, k in enumerate(reach, 1) if k <= allowed + 1e-9), 41))
        for s in range(41):
            table[r, s] = next((t for t, cut in enumerate(cuts, 1) if s >= cut), quality_rules.LEVELS + 1)
    return table


def test_risk_controlled_levels_equal_brute_force(spark):
    rng = random.Random(3)
    rows, marks = [], []
    for k, (stratum, labelled) in enumerate((("a", 6000), ("b", 120), ("c", 40))):
        mine = step_rows(rng, labelled + 2000, 10_000 * k, stratum)
        rows += mine
        marks += [(r[0], int(rng.random() < 0.8), 0) for r in mine[:labelled]]
    # a labelled key on many rows, and copies of its text under other labelled keys
    rows += [(0, "a", 0, [40] * 5, False)] * 300 + [(50_000 + i, "a", 77, [0] * 5, False) for i in range(300)]
    marks += [(50_000 + i, 1, 0) for i in range(300)]
    marks[0] = (0, 1, 0)
    table, labels = spark.createDataFrame(rows, STEPS_ROWS), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    found = {r.stratum: r for r in quality_rules.cutoffs(table, labels, "doc_id").collect()}
    good, known = {k for k, q, _ in marks if q}, {k for k, *_ in marks}
    for stratum in "abc":
        levels = brute_levels([r[3] for r in rows if r[1] == stratum and r[0] not in known])
        assert {(r, s): found[stratum].levels[r][s - 1] for r in range(5) for s in range(1, 41)} == {k: v for k, v in levels.items() if k[1]}
        draws = {}
        for key, _, text, steps, _ in sorted((r for r in rows if r[1] == stratum and r[0] in good), key=lambda r: r[:4]):
            draws.setdefault(key, (text, steps))
        by_text = {}
        for text, steps in draws.values():
            by_text[text] = min(by_text.get(text, steps), steps)
        reached = [min(levels[r, s] for r, s in enumerate(steps)) for steps in by_text.values()]
        dropped = [sum(x <= t for x in reached) for t in range(1, quality_rules.LEVELS + 1)]
        assert found[stratum].chosen == quality_rules.last_level(dropped, len(reached), 0.05, 0.05 / 3)
    assert found["a"].chosen > 0 and found["c"].chosen == 0


def test_false_rejections_stay_below_the_rate():
    """Labelled samples of one distribution of levels: the chosen level's true rate exceeds
    ALPHA in at most DELTA of them."""
    rng = np.random.default_rng(5)
    share = np.cumsum(np.full(40, 0.004))
    over = 0
    for _ in range(2000):
        dropped = np.searchsorted(np.sort(rng.random(400)), share).tolist()
        level = quality_rules.last_level(dropped, 400, 0.05, 0.05)
        over += bool(level) and share[level - 1] > 0.05
    assert over <= 2000 * 0.05 + 3 * (2000 * 0.05 * 0.95) ** 0.5


def test_strata_that_pass_all_levels_give_up_their_share(spark):
    sure = [("a", 41, 5000), ("b", 41, 5000), ("c", 41, 5000)]
    # 60 good rows prove nothing at a quarter of delta, but do with all of it
    rows = spark.createDataFrame([*sure, ("d", 41, 60)], "stratum string, level int, count long")
    found = {r.stratum: r.chosen for r in quality_rules.risk_controlled(rows, 0.05, 0.05).collect()}
    assert found == {"a": 40, "b": 40, "c": 40, "d": 40}
    few = spark.createDataFrame([("a", 3, 5000), ("d", 41, 60)], "stratum string, level int, count long")
    assert {r.stratum: r.chosen for r in quality_rules.risk_controlled(few, 0.05, 0.05).collect()} == {"a": 2, "d": 0}


def test_poisson_mix_hits_its_means(spark, clashing, nothing):
    rows = [(i, "word" * (1 + i % 3), "en", "big" if i % 4 else "small", 1) for i in range(8000)]
    docs = spark.createDataFrame(rows, DOCS)
    out = poisson_mix.replicate(docs, weights={"big": 1.0, "small": 1.0}, epochs=2.0, numbered=True)
    chars = {r.source: r.n for r in out.groupBy("source").agg(F.sum(F.length("text")).alias("n")).collect()}
    total = sum(len(t) for _, t, *_ in rows)
    assert chars["big"] == pytest.approx(total, rel=0.05) and chars["small"] == pytest.approx(total, rel=0.05)
    times = [r["count"] for r in out.where("source = 'small'").groupBy("doc_id").count().collect()]
    times += [0] * (2000 - len(times))
    assert np.var(times) == pytest.approx(np.mean(times), rel=0.1)
    assert out.columns == [*docs.columns, "copy", "shuffle_key"]
    assert poisson_mix.replicate(nothing).count() == 0
    assert poisson_mix.replicate(clashing).columns == clashing.columns
    assert {r.source for r in poisson_mix.replicate(clashing, weights={None: 1.0}, epochs=3.0).collect()} == {None}
    first = [r.doc_id for r in poisson_mix.replicate(docs).limit(50).collect()]
    assert first != sorted(first)


@pytest.mark.parametrize("limit", [0, 100])
def test_poisson_mix_with_and_without_broadcast(spark, docs, monkeypatch, limit):
    want = sorted(map(str, poisson_mix.replicate(docs, numbered=True).collect()))
    monkeypatch.setattr(poisson_mix, "MAX_BROADCAST_SOURCES", limit)
    assert sorted(map(str, poisson_mix.replicate(docs, numbered=True).collect())) == want


def test_poisson_distribution(spark):
    import math

    for rate in (0.0, 0.3, 4.0, 900.0):
        sums = spark.range(1).select(poisson_mix.distribution(F.lit(rate)).alias("s")).first().s
        if not rate:
            assert sums == [1.0]
            continue
        assert sums[-1] == pytest.approx(1, abs=1e-9)
        k = int(rate)
        assert sums[k] - (sums[k - 1] if k else 0) == pytest.approx(math.exp(k * math.log(rate) - rate - math.lgamma(k + 1)), rel=1e-6)


@pytest.fixture(scope="module")
def ranks_file():
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_byte_bpe_equals_the_library(ranks_file):
    with open(ranks_file, "rb") as file:
        ranks = byte_bpe.read_ranks(file.read())
    library = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder, decoder = byte_bpe.Encoder(ranks), byte_bpe.Decoder(ranks)
    rng = random.Random(3)
    texts = ["".join(rng.choice("  \n\t\xa0\x1c'''srtvemldlLaé٣12!?ñ中🙂") for _ in range(rng.randrange(40))) for _ in range(5000)]
    texts += ["x" * 5000, " " * 3000 + "a", "'" * 200 + "s", "ab" * 3000, "", "'", "don't'll've 're'RE"]
    coded, begins = encoder.encode([t.encode() for t in texts])
    for text, ids, at in zip(texts, coded, begins):
        want = library.encode_ordinary(text)
        assert np.frombuffer(ids, "<u4").tolist() == want
        sizes = [len(library.decode_single_token_bytes(i)) for i in want]
        assert np.frombuffer(at, "<u4").tolist() == (np.cumsum(sizes) - sizes).tolist()
    for known in ((coded, begins), (coded,)):
        assert decoder.decode(*known) == [t.encode() for t in texts]
    assert decoder.decode([], []) == [] and encoder.encode([]) == ([], []) and encoder.encode([b""]) == ([b""], [b""])
    moved = np.frombuffer(begins[0] or begins[1], "<u4") + 1
    with pytest.raises(ValueError):
        decoder.decode([coded[0] or coded[1]], [moved.astype("<u4").tobytes()])


def test_scan_of_functions_is_associative():
    rng = np.random.default_rng(2)
    functions = byte_bpe.MOVES[rng.integers(0, 6, 3000)]
    state, want = byte_bpe.OPEN, []
    for f in functions.tolist():
        state = (f >> (2 * state)) & 3
        want.append(state)
    got = (byte_bpe.running(functions) >> np.uint8(2 * byte_bpe.OPEN)) & 3
    assert got.tolist() == want


def test_byte_bpe_frames(spark, rows, clashing, nothing, ranks_file):
    encoded = byte_bpe.encode_documents(clashing, "doc_id", "text", ranks_file)
    decoded = {r.doc_id: bytes(r.decoded) for r in byte_bpe.decode_documents(encoded, "doc_id", ranks_file).collect()}
    assert decoded == {i: (t or "").encode() for i, t, *_ in rows}
    for r in encoded.collect():
        offsets = np.frombuffer(r.token_offsets, "<u4")
        assert len(offsets) == r.n_tokens and (np.diff(offsets) > 0).all()
    assert byte_bpe.digests(nothing).count() == 0


def test_byte_bpe_goes_there_and_back_in_one_worker(spark, clashing, ranks_file):
    """Every Python node of a task is a worker of its own, which stays with its memory."""
    one = byte_bpe.there_and_back(clashing, "doc_id", "text", ranks_file)
    two = byte_bpe.decode_documents(byte_bpe.encode_documents(clashing, "doc_id", "text", ranks_file), "doc_id", ranks_file)
    assert one.schema == two.schema and sorted(one.collect()) == sorted(two.collect())
    assert plan_of(byte_bpe.digests(clashing)).count("MapInArrow") == 1


def test_byte_bpe_tables_take_little_memory(ranks_file, monkeypatch):
    tracemalloc.start()
    table = byte_bpe.class_table()
    assert tracemalloc.get_traced_memory()[1] < 8e6
    tracemalloc.stop()
    assert [int(table[ord(c)]) for c in " \u3000é٣\U0001f642'\U00020000"] == [byte_bpe.SPACE, byte_bpe.GAP, byte_bpe.LETTER, byte_bpe.NUMBER, byte_bpe.OTHER, byte_bpe.QUOTE, byte_bpe.LETTER]
    # more distinct slices than are remembered: the memory stays bounded, and so do the ids' values
    with open(ranks_file, "rb") as file:
        ranks = byte_bpe.read_ranks(file.read())
    encoder = byte_bpe.Encoder(ranks)
    text = "".join(f" {chr(97 + i % 26)}{i:x}z" for i in range(250_000)).encode()
    coded = encoder.encode([text])[0]
    assert len(encoder.merger) <= 200_000
    assert byte_bpe.Decoder(ranks).decode(coded) == [text]


def test_last_stage_sends_texts_in_small_batches(spark, docs, tmp_path):
    """Its result is written by the stage, so a caller's session cannot make the batches large."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    found = corpus_pipeline.encode(spark, docs, str(tmp_path))
    assert "MapInArrow" not in plan_of(found) and "FileScan parquet" in plan_of(found)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
    assert sorted(found.collect()) == sorted(byte_bpe.digests(docs).collect())


def test_classifier_keeps_what_it_scores(spark, docs, rows):
    """The filter takes Arrow arrays: pandas would hold each batch's texts once more."""
    labels = spark.createDataFrame([(i, i % 2) for i, *_ in rows], "doc_id long, quality int")
    kept = fm_quality.keep_good(docs, labels)
    assert re.search(r"ArrowEvalPython .*, (\d+)\n", plan_of(kept))[1] == str(PythonEvalType.SQL_SCALAR_ARROW_UDF)
    assert kept.columns == docs.columns
    good = fm_quality.classify(docs, labels).where("predicted = 1")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in good.collect())


def test_pipeline_stages_decide_as_their_operators(spark, tmp_path, rows):
    """The stages one after the other, against brute force on what each was given."""
    folder = str(tmp_path)
    docs = spark.createDataFrame(rows, DOCS)
    docs.coalesce(1).write.parquet(f"{folder}/documents.parquet")
    marks = [(i, 1 if len(t or "") > 100 else 0, 0) for i, t, *_ in rows]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{folder}/labels.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality classifier" and len(corpus_pipeline.STAGES) == 5
    given, seen = docs, []
    for _, stage in corpus_pipeline.STAGES:
        given = spark.createDataFrame(given.collect(), given.schema)
        seen.append(given)
        given = stage(spark, given, folder)
    good, single, cleaned, mixed = ([tuple(r) for r in s.collect()] for s in seen[1:])
    accepted = {r.doc_id for r in fm_quality.classify(docs, spark.read.parquet(f"{folder}/labels.parquet")).where("predicted = 1").collect()}
    assert {r[0] for r in good} == accepted
    links = brute_links(good, 5, 80)
    assert sorted(r[0] for r in single) == sorted(i for i, (_, root, _) in links.items() if i == root)
    left = brute_repeats(single, 200)
    for i, text, *_, n in cleaned:
        whole = next(t for j, t, *_ in single if i == j) or ""
        if left[i][1] == 0:
            assert text == whole
        assert n == len(text or "") and len((text or "").encode()) <= left[i][0] - left[i][1]
    assert {r[0] for r in mixed} <= {r[0] for r in cleaned}
    end = given.collect()
    texts = {i: t for i, t, *_ in cleaned}
    assert sorted(r.decoded_sha256 for r in end) == sorted(hashlib.sha256((texts[r[0]] or "").encode()).hexdigest() for r in mixed)
