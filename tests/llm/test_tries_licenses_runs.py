"""Prefix trie, license scan and periodic runs on small tables: brute force and odd rows."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tidegrid.llm import license_scan, periodic_runs, prefix_trie

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string"
TURNS = "conv_id long, turn long, role string, text string"


def with_clashes(df, names):
    return df.selectExpr("*", *[f"'x' AS `{n}`" for n in names])


# --- conversation prefix trie ------------------------------------------------------------


def conversations(seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    stems = [[(rng.choice(["user", None]), f"a{rng.randrange(3)} b") for _ in range(11)] for _ in range(4)]
    for c in [*range(-3, 90), 400, 1_000_000_007]:
        stem = rng.choice(stems)[: rng.randrange(0, 12)]
        turns = stem + [(rng.choice(["user", "assistant"]), rng.choice(["", None, "x y z", "w"])) for _ in range(rng.randrange(1, 5))]
        if c in (7, 20):
            turns = turns[:1]
        for k, (role, text) in enumerate(turns):
            rows.append((c, k if k else rng.choice([None, 0]), role, text))
    rows += [(41, 3, "user", "tie"), (41, 3, "user", "tie"), (41, 3, "user", "eit"), (None, 0, "user", "lost")]
    rows += [(62, 100 + k, "user", "on and on") for k in range(300)]
    rng.shuffle(rows)
    return rows


def brute_trie(rows: list[tuple], shared: bool) -> dict[tuple, tuple]:
    """(smallest member, depth) -> the other columns, from all prefixes of all conversations."""
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0), role, digest, text))
    own = {c: [(r, t) for _, r, _, t in sorted(turns)] for c, turns in own.items()}
    built = dict(own)
    if shared:
        for c in own:
            h = zlib.crc32(str(c).encode()) % 4
            base = c - (abs(c) % 20) * (1 if c > 0 else -1)
            built[c] = own.get(base, [])[:h] + own[c][h:]
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
        ends[tuple(built[c])].append(c)
    children, leaves, saved = collections.Counter(), collections.Counter(), collections.Counter()
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, convs in members.items():
        words = len(WORDS.findall(node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(convs) - 1) * words
            leaves[node[:d]] += not children[node]
    return {
        (convs[0], len(node)): (
            members[node[:-1]][0] if node else None, len(convs), children[node], leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest(),
        )
        for node, convs in members.items()
    }


def trie(df, **options) -> dict[tuple, tuple]:
    out = prefix_trie.prefix_trie(df, **options).collect()
    found = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in out}
    assert len(found) == len(out)
    return found


def test_trie_equals_all_prefixes(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    monkeypatch.setattr(prefix_trie, "IDS", 8)
    monkeypatch.setattr(prefix_trie, "HOT", 9)
    rows = conversations()
    df = with_clashes(spark.createDataFrame(rows, TURNS), ["_c", "x", "px", "block", "depth", "words"])
    assert trie(df, rebuild=prefix_trie.shared_heads) == brute_trie(rows, True)
    assert trie(df) == brute_trie(rows, False)


def test_trie_of_copies_nothing_and_empty_conversations(spark):
    copies = [(c, k, "user", f"t{k}") for c in range(3000) for k in range(2)]
    assert trie(spark.createDataFrame(copies, TURNS)) == brute_trie(copies, False)
    assert trie(spark.createDataFrame([], TURNS)) == {}
    # conversation 5 has fewer turns than it borrows, and nobody to borrow them from
    alone = [(5, 0, "user", "hello there")]
    assert zlib.crc32(b"5") % 4 >= 1
    assert trie(spark.createDataFrame(alone, TURNS), rebuild=prefix_trie.shared_heads) == brute_trie(alone, True)


# --- license scan ------------------------------------------------------------------------

NOTICE = {t.label: t.text for t in license_scan.TEMPLATES}


def scanned(df) -> dict:
    return {r.doc_id: r for r in license_scan.license_scan(df).collect()}


def test_license_labels_and_places(spark):
    filler = " ".join(f"word{k}" for k in range(40))
    mit = license_scan.TEMPLATES[1].text
    edited = mit.replace("without restriction", "without any kind of further restriction")
    rows = [
        (1, "Released under the MIT License."),
        (2, f"{filler} {mit.upper()} {filler}"),
        (3, f"{filler}\n{edited}"),
        (4, " ".join(w for w in mit.split() if w not in ("granted", "included"))),
        (5, f"{NOTICE['bsd']} {filler} {NOTICE['cc-by-nc']}"),
        (6, "Licensed under CC BY 4.0."),
        (7, NOTICE["lgpl"]),
        (8, "the Apache License; the apache license, and GENERAL PUBLIC LICENSE"),
        (9, None),
        (10, ""),
        (11, " \n--"),
        (12, "MIT Éoin license, mit license"),
        (13, "MIT LICENSE" * 3 + " x" * 200_000 + " mit license"),
        (14, "unliKely wordK use of the worK"),
        (None, "licensed under cc by sa 4.0"),
        (1, "Released under the MIT License."),
    ]
    df = with_clashes(spark.createDataFrame(rows, DOCS), ["_row", "hits", "phrases", "score", "_words"])
    out = scanned(df)
    assert (out[1].base_labels, out[1].labels, out[1].first_word, out[1].score, out[1].n_base) == ("mit", "mit", 3, 1.0, 1)
    assert out[2].labels == "mit" and out[2].base_labels == "" and out[2].score == 1.0
    assert out[3].labels == "mit" and out[3].score > 0.9
    assert out[4].labels == "" and out[4].score == 0.0
    assert out[5].labels == "bsd,cc-by-nc"
    assert out[6].labels == "cc-by"
    assert (out[7].base_labels, out[7].labels) == ("gpl", "gpl,lgpl")
    assert (out[8].base_labels, out[8].n_base, out[8].first_word, out[8].last_word, out[8].score) == ("apache,gpl", 3, 1, 7, 0.5)
    for k in (9, 10, 11):
        assert (out[k].n_words, out[k].n_base, out[k].first_word, out[k].labels, out[k].score) == (0, 0, None, "", 0.0)
    assert out[12].n_base == 0
    assert (out[13].n_base, out[13].first_word, out[13].last_word) == (1, 200_004, 200_004)
    assert out[14].n_words == 6 and out[14].labels == ""
    assert out[None].labels == "cc-by-sa"
    assert license_scan.license_scan(df).where("doc_id = 1").count() == 2
    assert scanned(spark.createDataFrame([], DOCS)) == {}


def test_license_weights_count_all_rows(spark):
    index = license_scan.Index(license_scan.TEMPLATES, license_scan.BASE)
    common, rare = index.words.index("software"), index.words.index("merge")
    weights = index.weights(100, {common: 100, rare: 1})
    assert weights[common] == 1 and weights[rare] == 1 + round(1000 * np.log(101 / 2))


# --- periodic runs -----------------------------------------------------------------------


def brute_runs(words: list) -> list[tuple[int, int, int]]:
    out, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            smaller = any(all(words[start + k] == words[start + k + r] for k in range(length - r)) for r in range(1, q))
            if length >= max(6, 4 * q) and not smaller:
                out.append((start, length, q))
    return sorted(out, key=lambda run: (run[0], run[2]))


def repetitive(rng: random.Random) -> list[int]:
    letters = rng.choice([1, 2, 2, 3, 5])
    words = [rng.randrange(letters) for _ in range(rng.randrange(70))]
    for _ in range(rng.randrange(4)):
        block = [rng.randrange(letters) for _ in range(rng.randrange(1, 8))]
        at = rng.randrange(len(words) + 1)
        words[at:at] = block * rng.randrange(2, 9) + block[: rng.randrange(len(block))]
    return words


@pytest.mark.parametrize("rounds", [0, 1, 8])
def test_runs_equal_brute_force(monkeypatch, rounds):
    monkeypatch.setattr(periodic_runs, "ROUNDS", rounds)
    rng = random.Random(rounds)
    for _ in range(700):
        words = repetitive(rng)
        hashes = np.array([w * 7919 + 13 for w in words], np.uint64)
        assert periodic_runs.runs_of(hashes) == brute_runs(words)


def test_runs_of_documents(spark, tmp_path):
    rng = random.Random(4)
    rows = [(k, rng.choice([" ", "\n", "\t "]).join(f"w{x}" for x in repetitive(rng))) for k in range(200)]
    rows += [(200, None), (201, ""), (202, " \n "), (203, "a"), (None, "b " * 9), (204, "a b " * 60_000), (0, rows[0][1])]
    df = with_clashes(spark.createDataFrame(rows, DOCS), ["_key", "runs", "n_words", "collapsed", "start"])
    df.write.parquet(f"{tmp_path}/documents.parquet")
    found = collections.Counter(map(tuple, periodic_runs.op13_periodic_runs(spark, str(tmp_path)).collect()))
    wanted = collections.Counter()
    for key, text in rows:
        words = WORDS.findall(text or "")
        n, h = len(words), 1 if key is None else zlib.crc32(str(key).encode())
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 1000:
            # the very long text: one run of period 2, or of the rewriting's even or odd period
            runs = periodic_runs.runs_of(np.array([len(w) + ord(w[0]) for w in words], np.uint64))
        else:
            runs = brute_runs(words)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        milli = 1000 * best[1] // best[2] if runs else None
        wanted[key, len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()] += 1
    assert found == wanted
    assert any(row[1] for row in wanted)


def test_runs_of_an_empty_table(spark):
    assert periodic_runs.periodic_runs(spark.createDataFrame([], DOCS)).count() == 0
