"""Exact, near and substring dedup against plain Python."""

from __future__ import annotations

import hashlib
import random
import tracemalloc
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegauge.llm import hashing, order_minhash, substring_chains, suffix_blocks
from tidegauge.llm.block_names import drop_exact_copies, exact_groups
from tidegauge.llm.common import ROW, Workspace, numbered
from tidegauge.llm.hashing import common_places, labelled, mixed, rising, sliding_min
from tidegauge.llm.order_minhash import components, drop_near_copies, near_groups
from tidegauge.llm.substring_chains import chains_of, fuzzy_passages
from tidegauge.llm.suffix_blocks import COVER, PERIOD, WINDOW, remove_repeats, repeat_report

WORDS = [f"w{i}" for i in range(400)]
LARGE = [f"w{i}" for i in range(20000)]


def prose(seed, n, words=WORDS):
    pick = random.Random(seed)
    return " ".join(pick.choice(words) for _ in range(n))


def edited(text, seed, n):
    pick = random.Random(seed)
    words = text.split()
    for _ in range(n):
        words[pick.randrange(len(words))] = f"x{pick.randrange(1000)}"
    return " ".join(words)


# exact -------------------------------------------------------------------------------------


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_exact_groups_are_those_of_plain_python(spark, documents):
    long = "Ünlong " * 3000
    rows = [(1, "Abc"), (2, "aBC"), (3, "abc "), (4, None), (5, ""), (6, "Ü"), (7, "ü"), (8, long), (9, long.replace("l", "L")),
            (10, long + "."), (None, "abc"), (11, "x" * 64), (12, "x" * 64), (12, "x" * 64), (13, "x" * 63), (14, "x" * 128)]
    groups = defaultdict(list)
    for doc, text in rows:
        groups[ascii_lower(text)].append(doc)
    got = exact_groups(spark, documents(rows), block=64).collect()
    assert len(got) == len(rows)
    want = sorted(
        (str(doc), max((d for d in groups[ascii_lower(text)] if d is not None), default=None),
         len(groups[ascii_lower(text)]), hashlib.sha256(ascii_lower(text).encode()).hexdigest())
        for doc, text in rows
    )
    assert sorted((str(r.doc_id), r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = defaultdict(int)
    for r in got:
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1}


def test_exact_copies_leave_all_columns(spark, documents):
    docs = documents([(1, "a"), (2, "A"), (2, "A"), (3, None)])
    left = drop_exact_copies(spark, docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [2, 3]


def test_nothing_comes_of_nothing(spark, documents):
    docs = documents([])
    assert exact_groups(spark, docs).count() == 0
    assert near_groups(spark, docs).count() == 0
    assert fuzzy_passages(spark, docs).count() == 0
    assert repeat_report(spark, docs).count() == 0


# near --------------------------------------------------------------------------------------


def shingle_sets(text):
    words = (text or "").lower().split()
    k = min(5, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def test_near_classes_are_those_of_all_pairs(spark, documents):
    rows = [(None, prose(99, 80)), (0, None), (1, ""), (2, "one two"), (3, "One  two"), (4, "one two three")]
    for base in range(12):
        text = prose(base, 60 + 40 * base)
        rows += [(100 * base + 10 + i, edited(text, 7 * i + base, i)) for i in range(8)]
    rows.append(rows[-1])
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    sets = [shingle_sets(t) for _, t in rows]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or a and b and len(a & b) >= 0.8 * len(a | b):
                top[find(i)] = find(j)
    want = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        want[find(i)].append(str(doc))
    got = defaultdict(list)
    kept = defaultdict(int)
    for i, r in enumerate(near_groups(spark, documents(rows)).collect()):
        key = r.class_id if r.class_id is not None else f"none {i}"
        got[key].append(str(r.doc_id))
        kept[key] += r.kept
        assert r.class_size >= 1
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
    assert set(kept.values()) == {1}


@pytest.mark.parametrize("block", [1000, 7])
def test_a_group_that_drifts_apart_loses_no_link(spark, documents, monkeypatch, block):
    """Texts that are like a member of a class, but not like the one that stands for it."""
    monkeypatch.setattr(order_minhash, "BLOCK", block)
    origin = prose(500, 90)
    texts = [edited(origin, 1000 + i, 1 + i % 4) for i in range(120)]
    texts += [edited(texts[i], 2000 + i, 2) for i in range(0, 120, 3)]
    labels = [order_minhash.labels_of(t).astype("<u4") for t in texts]
    bits = [order_minhash.parities(one) for one in labels]
    top = list(range(len(texts)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, a in enumerate(labels):
        for j, b in enumerate(labels[:i]):
            differ = int(np.bitwise_count((bits[i] ^ bits[j]).view(np.uint64)).sum())
            if order_minhash.similarity(a, b) >= 0.8:
                assert 9 * differ <= len(a) + len(b)
                top[find(i)] = find(j)
    got = {r.doc_id: r.class_id for r in near_groups(spark, documents(list(enumerate(texts)))).collect()}
    least = {}
    for i in range(len(texts)):
        least.setdefault(find(i), i)
    assert 5 < len(least) < len(texts) - 20
    assert got == {i: least[find(i)] for i in range(len(texts))}


def test_short_texts_lose_no_link(spark, documents):
    """Pairs of 4 to 20 shingles at 0.8 exactly or a little more, which few bands would tell."""
    rows, pairs = [], []
    for n in (8, 9, 12, 13, 16, 20, 24):
        least = -(-4 * (n - 4) // 5)
        for i in range(150):
            words = prose(f"{n} {i}", n, LARGE).split()
            cut = words[: least + 4]
            pairs.append((len(rows), len(rows) + 1))
            rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(cut))]
    got = {r.doc_id: r.class_id for r in near_groups(spark, documents(rows)).collect()}
    assert all(got[a] == got[b] == a for a, b in pairs)
    for n in range(1, 26):
        labels = mixed(np.arange(n, dtype=np.uint64))
        assert len(order_minhash.prefix(labels)) == n - -(-4 * n // 5) + 1
    assert not len(order_minhash.prefix(mixed(np.arange(26, dtype=np.uint64))))


@pytest.mark.parametrize("links", [1 << 18, 40])
def test_components_of_chains_stars_and_rings(spark, monkeypatch, links):
    monkeypatch.setattr(order_minhash, "LINKS", links)
    pick = random.Random(6)
    chain = [(i, i + 1) for i in range(400)]
    star = [(1000 + i, 1000) for i in range(1, 90)] * 2
    ring = [(2000 + i, 2000 + (i + 1) % 50) for i in range(50)]
    deep = [(3000 + i, 3000 + pick.randrange(i)) for i in range(1, 120)]
    pairs = chain + star + ring + deep
    pick.shuffle(pairs)
    found = components(Workspace(spark, "test"), spark.createDataFrame(pairs, "left long, right long")).collect()
    assert sorted(r.node for r in found) == sorted({n for p in pairs for n in p})
    tops = defaultdict(set)
    for r in found:
        tops[r.node // 1000].add(r.top)
    assert all(len(t) == 1 for t in tops.values()) and len(set.union(*tops.values())) == 4


def test_words_are_hashed_in_bulk_as_one_by_one():
    texts = ["", " ", "a", " A b\x0bc\x0c\rd\n", "é " * 10, "x" * (hashing.STRETCH + 5) + " y " + "z" * 3 * hashing.STRETCH, "w " * 200_000]
    texts += [prose(i, i % 90) for i in range(3000)] + ["a b", "b a"]
    names, words = {}, {}
    for text, hashes in zip(texts, hashing.hashed_words(texts), strict=True):
        own = text.lower().encode().split()
        assert len(own) == len(hashes)
        for word, name in zip(own, hashes.tolist()):
            assert names.setdefault(word, name) == name and words.setdefault(name, word) == word


def test_near_copies_leave_one_of_each_class(spark, documents):
    text = prose(1, 200)
    docs = documents([(5, text), (3, edited(text, 1, 2)), (9, prose(2, 200)), (4, text)])
    left = drop_near_copies(spark, docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [3, 9]


def test_order_counts():
    words = prose(3, 300).split()
    a = order_minhash.labels_of(" ".join(words)).astype("<u4")
    swapped = order_minhash.labels_of(" ".join(words[150:] + words[:150])).astype("<u4")
    assert order_minhash.similarity(a, a) == 1
    assert order_minhash.similarity(a, swapped) < 0.8
    assert len(set(labelled(np.zeros(50, np.uint64)).tolist())) == 50


def test_sequence_helpers():
    pick = random.Random(5)
    for _ in range(50):
        a, b = ([pick.randrange(6) for _ in range(pick.randrange(12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert len(common_places(a, b)) == table[-1][-1]
        best = [1] * len(a)
        for i in range(len(a)):
            best[i] = 1 + max((best[j] for j in range(i) if a[j] < a[i]), default=0)
        assert rising(a) == max(best, default=0)
        values = np.array([pick.randrange(99) for _ in range(20)], np.uint64)
        assert sliding_min(values, 6).tolist() == [min(values[i : i + 6].tolist()) for i in range(15)]


# suffixes ----------------------------------------------------------------------------------


def windows_removed(texts):
    """By a dictionary of all windows."""
    places = defaultdict(list)
    for i, t in enumerate(texts):
        for at in range(len(t) - WINDOW + 1):
            places[t[at : at + WINDOW]].append((i, at))
    gone = [bytearray(len(t)) for t in texts]
    for where in places.values():
        if len(where) > 1:
            for i, at in where:
                gone[i][at : at + WINDOW] = b"\1" * WINDOW
    return gone


@pytest.mark.parametrize("part", [suffix_blocks.PART, 3])
def test_repeats_are_those_of_all_windows(spark, documents, monkeypatch, part):
    monkeypatch.setattr(suffix_blocks, "PART", part)  # in the plan; tasks cut as usual
    monkeypatch.setattr(suffix_blocks, "STRETCH", 16 * suffix_blocks.RUN if part > 3 else 64)  # so a text is many parts
    shared = prose(50, 150)
    rows = [(i, prose(i, 60) + shared + prose(1000 + i, 50 + i)) for i in range(12)]
    rows += [(20, None), (21, ""), (22, "a" * 399), (23, "b" * 400), (24, "c" * 401), (25, "ab" * 900), (26, prose(3, 300))]
    rows += [(27, rows[0][1]), (27, rows[0][1]), (None, "é" * 500), (28, shared[:399]), (29, shared[7:407])]
    texts = [(t or "").encode() for _, t in rows]
    want = []
    for (doc, _), data, gone in zip(rows, texts, windows_removed(texts)):
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        want.append((str(doc), len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    got = repeat_report(spark, documents(rows)).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(want)


def test_monotonous_texts_are_dealt_by_their_bytes(spark, documents, monkeypatch):
    monkeypatch.setattr(suffix_blocks, "PART_BYTES", 60_000)
    monkeypatch.setattr(suffix_blocks, "STRETCH", suffix_blocks.RUN)
    texts = [b"a" * (3000 + 500 * i) for i in range(60)]
    docs = documents([(i, t.decode()) for i, t in enumerate(texts)])
    numbers = numbered(docs).select(F.col(ROW).alias("row"), F.encode("text", "UTF-8").alias("data"))
    runs = suffix_blocks.live_runs(Workspace(spark, "test"), numbers)
    parts = runs.groupBy("bucket", "part").agg(F.sum(F.octet_length("data")).alias("n")).collect()
    assert len(parts) > 9 and max(r.n for r in parts) < 4 * 60_000
    got = {r.doc_id: r.n_removed for r in repeat_report(spark, docs).collect()}
    assert got == dict(enumerate(map(len, texts)))


def peak_of(work):
    """Most bytes in use at once."""
    tracemalloc.start()
    try:
        return work(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_fingerprints_take_no_more_than_their_sums():
    data = np.random.default_rng(1).integers(0, 256, 3_000_000, np.uint8)
    prints, most = peak_of(lambda: suffix_blocks.Fingerprints(data, 0xABCDEF12345))
    assert most < 10 * len(data)
    places = np.array([0, 1, 65_535, 65_536, 131_000, 2_999_599])
    plain = [sum((int(c) + 1) * pow(0xABCDEF12345, i, 1 << 64) for i, c in enumerate(data[p : p + 400])) for p in places]
    assert prints.at(places, 400).tolist() == [x % (1 << 64) for x in plain] == prints.all(400)[places].tolist()


def test_runs_of_a_very_long_text_take_little_and_miss_no_window():
    data = np.random.default_rng(2).integers(97, 123, 2_000_000, np.uint8).tobytes()
    (bucket, first, count, _), most = peak_of(lambda: suffix_blocks.runs_of(data))
    assert most < 20 * len(data)
    assert first[0] == 0 and (first[1:] == first[:-1] + count[:-1]).all() and first[-1] + count[-1] == len(data) - WINDOW + 1
    near = suffix_blocks.PIECE - 300  # the same windows have the same buckets, whatever piece they are in
    own = dict(zip(*suffix_blocks.runs_of(data[near : near + 1000])[:2][::-1]))
    of = np.repeat(bucket, count)
    assert all(of[near + at] == b for at, b in own.items())


def test_removed_spans_and_kept_bytes_make_the_text(spark, documents):
    shared = prose(50, 150)
    rows = [(i, prose(i, 30) + shared + prose(99 + i, 30)) for i in range(3)]
    for r in remove_repeats(spark, documents(rows)).collect():
        data, (span,) = bytes(r.data), r.spans
        assert data[: span.start] + data[span.end :] == bytes(r.kept)


def test_the_cover_has_every_difference():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))
    steps = suffix_blocks.cover_step()
    assert steps.max() < PERIOD
    assert all((a + steps[a, b]) % PERIOD in COVER and (b + steps[a, b]) % PERIOD in COVER for a in range(64) for b in range(64))


def test_classes_of_a_block_with_long_ties():
    pick = random.Random(1)
    middle = [bytes(pick.choice(b"xy") for _ in range(40)) for _ in range(6)]
    texts = [b"h" * 200 + pick.choice(middle) + b"t" * 200 for _ in range(60)]
    starts = np.array([440 * i + d for i in range(60) for d in (0, 13, 40)])
    block = suffix_blocks.Block(texts)
    joined = b"".join(texts)
    names = block.classes(starts).tolist()
    by_bytes = defaultdict(set)
    for name, at in zip(names, starts):
        by_bytes[joined[at : at + WINDOW]].add(name)
    assert all(len(v) == 1 for v in by_bytes.values())
    assert len(by_bytes) == len(set(names))


# passages ----------------------------------------------------------------------------------


def test_fuzzy_passages_are_found_and_clean_texts_left(spark, documents):
    passage = prose(70, 60)
    rows = [(1, prose(1, 100) + " " + passage + " " + prose(2, 30)),
            (2, prose(3, 20) + " " + edited(passage, 4, 3) + " " + prose(4, 90)),
            (3, prose(5, 300)), (4, " ".join(prose(70, 60).split()[:30]) + " " + prose(6, 200)),
            (5, None), (6, ""), (7, "the " * 300), (8, "the " * 30 + prose(8, 90)), (None, passage)]
    got = fuzzy_passages(spark, documents(rows, files=1).coalesce(1)).collect()
    pairs = {frozenset((r.doc_id, r.other_doc_id)) for r in got}
    found = {d for p in pairs for d in p}
    assert {1, 2, None} <= found and not {3, 4, 5, 6, 7, 8} & found
    words = {d: (t or "").split() for d, t in rows}
    for r in got:
        a = words[r.doc_id][r.start : r.end]
        b = words[r.other_doc_id][r.other_start : r.other_end]
        assert len(common_places(a, b)) >= 0.8 * max(len(a), len(b)) >= 40
        assert r.passage_end - r.passage_start >= 50


@pytest.mark.parametrize("percent", [10, 15, 20])
def test_passages_of_many_edits_are_those_of_brute_force(spark, documents, percent):
    rows, planted = [], []
    for i in range(60):
        pick = random.Random(1000 * percent + i)
        words = prose(9000 + i, 100, LARGE).split()
        other = list(words)
        # half with every so many words replaced, half with words replaced at random
        for at in range(4, 100, 100 // percent) if i % 2 else pick.sample(range(100), percent):
            other[at] = f"x{pick.randrange(10**6)}"
        assert len(common_places(words, other)) >= 80  # brute force: the whole passage is alike
        planted.append((2 * i, 2 * i + 1))
        rows.append((2 * i, f"{prose(20000 + i, 40, LARGE)} {' '.join(words)} {prose(30000 + i, 40, LARGE)}"))
        rows.append((2 * i + 1, f"{prose(40000 + i, 60, LARGE)} {' '.join(other)}"))
    got = fuzzy_passages(spark, documents(rows, files=1).coalesce(1)).collect()
    assert {frozenset((r.doc_id, r.other_doc_id)) for r in got} == {frozenset(p) for p in planted}


def test_a_passage_that_comes_again_in_its_text_is_found(spark, documents):
    passage = prose(71, 80, LARGE)
    rows = [(1, f"{prose(1, 40, LARGE)} {passage} {prose(2, 40, LARGE)} {edited(passage, 3, 8)}"), (2, prose(5, 300, LARGE))]
    got = fuzzy_passages(spark, documents(rows)).collect()
    assert {(r.doc_id, r.other_doc_id) for r in got} == {(1, 1)}
    assert all(r.start >= 160 and 40 <= r.other_start < r.other_end <= 120 for r in got)


def test_passages_of_very_long_texts(spark, documents):
    """A text of 60,000 words against one that changes too much in most of its middle, and against its copy."""
    words, pick = prose(81, 60_000, LARGE).split(), random.Random(82)
    other = [w if not 15_000 <= i < 50_000 or pick.random() > 0.8 else f"x{i}" for i, w in enumerate(words)]
    assert len(other) > 16 * substring_chains.PART
    rows = [(1, " ".join(words)), (2, " ".join(other)), (3, " ".join(words)), (4, "la " * 50_000), (5, "la " * 40_000)]
    got = fuzzy_passages(spark, documents(rows, files=1).coalesce(1)).collect()
    spans = sorted((r.doc_id, r.other_doc_id, r.start, r.end) for r in got if r.doc_id in (2, 3))
    assert (3, 1, 0, 60_000) in spans
    parts = [s for s in spans if s[0] == 2]
    assert min(s[2] for s in parts) == 0 and max(s[3] for s in parts) == 60_000
    covered = np.zeros(60_000, bool)
    for _, _, start, end in parts:
        covered[start:end] = True
    assert covered[:14_990].all() and covered[50_010:].all() and not covered[30_000:34_000].any()
    assert {(r.doc_id, r.other_doc_id) for r in got if r.doc_id > 3} == {(5, 4)}


def test_chains_are_the_best_by_all_chains():
    pick = random.Random(2)
    for _ in range(30):
        matches = sorted({(pick.randrange(40), pick.randrange(40)) for _ in range(14)})
        value = {}
        for x, y in matches:
            before = [value[m] - 0.1 * (x - m[0] + y - m[1]) for m in value if m[0] < x and m[1] < y]
            value[x, y] = 8 + max([0, *before])
        first = chains_of(matches)[0]
        score = sum(8 - 0.1 * (b[0] - a[0] + b[1] - a[1]) for a, b in zip(first, first[1:])) + 8
        assert abs(score - max(value.values())) < 1e-9
        assert all(a[0] < b[0] and a[1] < b[1] for c in chains_of(matches) for a, b in zip(c, c[1:]))
        assert sorted(m for c in chains_of(matches) for m in c) == matches
