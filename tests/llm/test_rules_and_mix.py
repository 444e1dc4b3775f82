"""Quality rules, classifier, mixing, packing, sharding, pages and the pipeline on small tables."""

from __future__ import annotations

import html
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import __spark_entry__ as spark_entry
import corpus_pipeline
from oracle import connect, difference
from tidegauge.llm import gam, mixing, packing, page_diff
from tidegauge.llm.hashing import common_places
from tidegauge.llm.line_rules import Limits, apply_rules, base_counts, line_key, quality_report
from tidegauge.llm.mixing import Mix, mixed_rows
from tidegauge.llm.packing import best_fit, encoder, pack_documents
from tidegauge.llm.page_diff import blocks_of, main_texts
from tidegauge.llm.queries import ORACLES, QUERIES, RANKS, TOKENIZER
from tidegauge.llm.ring import Ring, ring_shards, seats, shard_documents

SF_DIR = "/root/testdata/sf0.001"


def prose(seed, n):
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(500)}" for _ in range(n))


# rules -------------------------------------------------------------------------------------

SPACE = "\x20\x09-\x0d"


def plain_counts(text):
    words = re.findall(f"[^{SPACE}]+", text)
    times = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if times[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    seen, doubled = set(), 0
    for line in text.split("\n"):
        if re.search(f"[^{SPACE}]", line):
            doubled += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), doubled, len(covered)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab# |é  \x0b\x1c\r\n\t", max_size=60))
def test_base_counts(text):
    assert base_counts(text) == plain_counts(text)


def test_frequent_lines_go_and_depleted_documents_too(spark, documents):
    line = prose(4242, 50)
    rows = [(i, f"{prose(i, 60)}\n{line}\n{prose(500 + i, 20)}", "a") for i in range(30)]
    rows += [(100 + i, f"{prose(900 + i, 10)}\n{line.upper()}  \n", "a") for i in range(3)]
    rows += [(200, f"{prose(1, 70)}\n{line}", "b"), (201, None, None), (202, "", "a"), (203, "dup word " * 60, "b")]
    rows += [(300, prose(77, 90), "c")] * 40  # one text, forty times
    limits = Limits(documents=10, share=0.05)
    docs = documents(rows)
    got = defaultdict(list)
    for r in quality_report(spark, docs, limits=limits).collect():
        got[r.doc_id].append(r)
    assert all(r.kept and r.n_removed_words == 50 for i in range(30) for r in got[i])
    assert not any(r.kept or r.base_failed for i in range(3) for r in got[100 + i])
    assert got[200][0].kept and got[200][0].n_removed_words == 0
    assert got[201][0].base_failed and got[202][0].base_failed and got[203][0].base_failed
    assert len(got[300]) == 40 and all(r.kept and not r.n_removed_words for r in got[300])
    for doc, text, *_ in rows:
        r = got[doc][0]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_counts(text or "")
    left = apply_rules(spark, docs, limits=limits)
    assert left.columns == docs.columns
    texts = {r.doc_id: r.text for r in left.collect()}
    assert set(texts) == {*range(30), 200, 300}
    assert texts[3] == f"{prose(3, 60)}\n{prose(503, 20)}" and line in texts[200]


def test_documents_with_all_lines_shared_but_one_count_each(spark, documents):
    block = [prose(6000 + i, 8) for i in range(5)]
    rows = [(i, "\n".join([block[0], prose(7000 + i, 90), *block[1:]]), "a") for i in range(60)]
    rows += [(100 + i, rows[0][1].upper().replace(" ", "  "), "a") for i in range(60)]  # copies count once
    rows += [(200, prose(1, 90), "a")]
    docs = documents(rows)
    got = {r.doc_id: r.n_removed_words for r in quality_report(spark, docs, limits=Limits(documents=59, share=0.0)).collect()}
    assert all(n == 40 for d, n in got.items() if d < 200) and got[200] == 0
    got = quality_report(spark, docs, limits=Limits(documents=60, share=0.0)).collect()
    assert not any(r.n_removed_words for r in got)


def test_a_line_that_a_host_shares_goes_whatever_its_size(spark, documents):
    line, rows = prose(4243, 12), []
    for size in (3, 10, 50, 700):
        rows += [(1000 * size + i, f"{prose(1000 * size + i, 70)}\n{line}", f"h{size}") for i in range(size)]
    rows += [(10**6 + i, prose(10**6 + i, 70) + f"\n{line}" * (i < 3), "few") for i in range(50)]
    got = quality_report(spark, documents(rows)).collect()
    assert all(r.kept for r in got)
    removed = {r.doc_id for r in got if r.n_removed_words == 12}
    assert removed == {d for d, _, host in rows if host in ("h10", "h50", "h700")}


def plain_verdicts(rows, limits):
    """(doc_id, kept, removed words) by counting all lines of all documents."""
    key = lambda t: " ".join(t.lower().split())
    lines = {i: [x for x in (t or "").split("\n") if x.split()] for i, (_, t, _) in enumerate(rows)}
    hosts, docs = defaultdict(set), defaultdict(set)
    for i, (_, t, host) in enumerate(rows):
        for x in lines[i]:
            hosts[host].add(key(t))
            docs[host, key(x)].add(key(t))
    frequent = {k: len(d) for k, d in docs.items() if len(d) > limits.documents and len(d) > limits.share * len(hosts[k[0]])}
    out, lost = {}, defaultdict(list)
    for i, (doc, t, host) in enumerate(rows):
        n, _, _, _, repeated = plain_counts(t or "")
        failed = n < 50 or 100 * repeated > 50 * n
        gone = sum(len(x.split()) for x in lines[i] if (host, key(x)) in frequent)
        out[i] = [doc, not failed and gone <= limits.depleted * n, gone]
        if not failed and not out[i][1]:
            rare = min((frequent[host, key(x)], line_key(x)) for x in lines[i] if (host, key(x)) in frequent)
            lost[host, rare].append((i, key(t)))
    for (host, (n, _)), group in lost.items():
        if 2 * len({c for _, c in group}) >= n:
            for i, (doc, t, of) in enumerate(rows):
                if of == host and key(t or "") == group[0][1]:
                    out[i] = [doc, True, 0]
    return sorted(map(tuple, out.values()))


@pytest.mark.parametrize("others", [0, 20, 100, 1500])
def test_of_near_copies_one_stays_whatever_the_host(spark, documents, others):
    rows = [(i, f"{prose(i, 70)}\nshared notice of the host {'x ' * 9}", "a") for i in range(others)]
    groups = {}
    for size in (4, 5, 12, 50):
        lines = [prose(f"{size} {i}", 15) for i in range(12)]
        groups[size] = range(len(rows), len(rows) + size)
        for i in range(size):
            own = list(lines)
            own[i % 12] = prose(f"own {size} {i}", 15)
            rows.append((len(rows), "\n".join([*own, f"shared notice of the host {'x ' * 9}"]), "a"))
    rows += [(9000 + i, rows[groups[5][0]][1].upper(), "a") for i in range(3)]  # copies of a near copy
    rows += [(9100 + i, f"{prose(8000 + i, 3)}\nshared notice of the host {'x ' * 9}\n" + "y z " * 5, "a") for i in range(2)]
    docs = spark.createDataFrame(documents(rows, files=1).coalesce(1).sort("doc_id").collect(), documents(rows).schema).coalesce(1)
    got = sorted((r.doc_id, r.kept, r.n_removed_words) for r in quality_report(spark, docs).collect())
    assert got == plain_verdicts(rows, Limits())
    kept = {d for d, k, _ in got if k}
    assert set(range(others)) <= kept
    for size, group in groups.items():
        assert 1 <= len(kept & set(group))
    left = {r.doc_id: r.text for r in apply_rules(spark, docs).collect()}
    assert set(left) == kept


# classifier --------------------------------------------------------------------------------


def test_model_learns_single_features_and_pairs():
    pick = np.random.default_rng(1)
    x = pick.normal(size=(4, 6000))
    p = 1 / (1 + np.exp(-(np.abs(x[0]) * 2 - 1.6 + 3 * np.sign(x[1] * x[2]))))
    y = (pick.random(6000) < p).astype(float)
    model = gam.fit(x[:, :4000], y[:4000])
    assert tuple(sorted(model.pairs[0])) == (1, 2)
    score, truth = model.score(x[:, 4000:]), y[4000:]
    rank = np.argsort(np.argsort(score)) + 1
    ones = truth.sum()
    auc = (rank[truth == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(truth) - ones))
    assert auc > 0.9


def test_model_of_few_or_one_sided_labels():
    x = np.zeros((3, 0))
    assert gam.fit(x, np.zeros(0)).score(np.ones((3, 2))).tolist() == [0.5, 0.5]
    one = gam.fit(np.ones((3, 9)), np.ones(9)).score(np.ones((3, 1)))
    assert one[0] > 0.9


def test_scores_cover_all_and_hold_out_a_third(spark, documents):
    rows = [(i, prose(i, 120) if i % 2 else "junk ### " * 40) for i in range(200)] + [(900, None), (None, "x"), (900, None)]
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(150)] + [(3, 1), (None, 1), (5, None)], "doc_id long, quality int"
    )
    got = gam.scored_documents(spark, documents(rows), labels).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 200]
    assert sum(r.predicted == r.doc_id % 2 for r in held) > 0.95 * len(held)
    none = gam.scored_documents(spark, documents(rows[:3]), labels.where("false")).collect()
    assert {r.score for r in none} == {0.5}
    assert gam.scored_documents(spark, documents([]), labels).count() == 0


# mixing ------------------------------------------------------------------------------------


def test_mixture_meets_its_limits_and_budgets(spark, documents):
    rows = [(i, prose(i, 10 + i % 40), "big") for i in range(300)]
    rows += [(1000 + i, prose(i, 30), s) for s, n in (("mid", 80), ("low", 30), (None, 20), ("", 5)) for i in range(n)]
    rows += [(5, None, "big"), (5, None, "big")]
    tokens = defaultdict(int)
    for _, text, source in rows:
        tokens[source] += len((text or "").split()) + 1
    docs = documents(rows)
    got = mixed_rows(spark, docs, Mix(repeats=2.0)).collect()
    shown, weight = defaultdict(int), {}
    for r in got:
        shown[r.source] += r.n_tokens
        weight[r.source] = r.weight
        assert 0 <= r.position < 1
    assert abs(sum(weight.values()) - 1) < 1e-9
    repeats = {s: weight[s] / tokens[s] for s in tokens}
    assert max(repeats.values()) / min(repeats.values()) == pytest.approx(2.0, abs=1e-6)
    least = min(repeats.values())
    for s in tokens:
        budget = max(tokens[s], math.floor(repeats[s] / least * tokens[s] * (1 + 1e-9)))
        assert budget - 60 < shown[s] <= budget + 1
    whole = Counter((r.doc_id, r.text) for r in got if r.epoch == 0)
    assert whole == Counter((d, t) for d, t, _ in rows)

    flat = mixed_rows(spark, docs, Mix(entropy=0.9, budget=20_000)).collect()
    weight = {r.source: r.weight for r in flat}
    entropy = -sum(w * math.log(w) for w in weight.values())
    assert entropy == pytest.approx(0.9 * math.log(len(tokens)), abs=1e-4)
    assert 20_000 - 60 * len(tokens) < sum(r.n_tokens for r in flat) <= 20_000
    late = [sum(r.source == "big" for r in flat if lo <= r.position < lo + 0.5) for lo in (0, 0.5)]
    assert min(late) > 0.6 * max(late)


@pytest.mark.parametrize("edge", [mixing.EDGE, 20, 1])
def test_partial_epochs_end_where_the_budget_does(spark, documents, monkeypatch, edge):
    """Shown documents against running sums over each source in plain Python; a small EDGE cuts blocks in blocks."""
    monkeypatch.setattr(mixing, "EDGE", edge)
    monkeypatch.setattr(mixing, "BLOCK_BITS", mixing.BLOCK_BITS if edge > 20 else 3)
    rows = [(i, prose(i, i % 40), "large" if i % 3 else f"s{i % 7}") for i in range(1500)] + [(1, None, None), (2, "", None)]
    docs, mix = documents(rows), Mix(budget=30_000)
    placed = mixing.numbered(docs).select("doc_id", "source", "text", mixing.ROW, mixing.last_place().alias("place"))
    plan = mixing.source_plan(mixing.Workspace(spark, "test"), mixing.numbered(docs), mix).collect()
    budgets = {r["__source"]: (r.budget, r.tokens) for r in plan}
    sources = defaultdict(list)
    for r in placed.collect():
        sources["" if r.source is None else f"={r.source}"].append((r.place, r[mixing.ROW], r.doc_id, len((r.text or "").split()) + 1))
    want = Counter()
    for source, held in sources.items():
        budget, tokens = budgets[source]
        assert tokens == sum(n for *_, n in held)
        upto = 0
        for _, _, doc, n in sorted(held):
            upto += n
            want[source, doc] += budget // tokens + (upto <= budget % tokens)
    got = Counter()
    for r in mixed_rows(spark, docs, mix).collect():
        got["" if r.source is None else f"={r.source}", r.doc_id] += 1
    assert +got == +want


def test_mixture_of_nothing(spark, documents):
    assert mixed_rows(spark, documents([])).count() == 0


# packing -----------------------------------------------------------------------------------

ODD = st.text(alphabet=st.sampled_from("ab Z'sé ß\u0085 \n\t\x1c19½²ªº_-—“”’€日本́🙂<|>endoftx"), max_size=80)


@settings(max_examples=300, deadline=None)
@given(ODD)
def test_ids_are_those_of_the_tokenizer_file(text):
    assert IDS(text) == EXACT.encode(text, add_special_tokens=False).ids


EXACT = Tokenizer.from_file(TOKENIZER)
IDS = encoder(TOKENIZER, RANKS)


def test_ids_of_special_tokens_and_of_every_plain_character():
    for text in ["a<|endoftext|>b", "".join(map(chr, range(0x250))), " ".join(map(chr, range(0x250)))]:
        assert IDS(text) == EXACT.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_fit_by_search(lengths):
    bins = best_fit(lengths, 50)
    plain = []
    for length in sorted(lengths, reverse=True):
        fits = [b for b in plain if sum(b) + length <= 50]
        if fits:
            max(fits, key=sum).append(length)
        else:
            plain.append([length])
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert len(bins) == len(plain) and all(sum(lengths[i] for i in b) <= 50 for b in bins)


@pytest.mark.parametrize("group", [packing.GROUP, 40])
def test_sequences_hold_every_id_once(spark, documents, group):
    rows = [(i, prose(i, random.Random(i).randrange(1, 900))) for i in range(150)]
    rows += [(500, None), (501, ""), (502, prose(9, 5000)), (502, prose(9, 5000)), (None, "x")]
    pieces = packing.token_pieces(documents(rows), TOKENIZER, RANKS)
    got = packing.pack_pieces(spark, pieces, group=group).collect()
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append(r)
    for members in bins.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    ids = {d: [*EXACT.encode(t or "", add_special_tokens=False).ids, 0] for d, t in rows}
    for r in got:
        own = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert len(own) == r.length and zlib.crc32(own.tobytes()) == r.ids_crc32
        assert r.length == 2048 or r.piece == 0
    lengths = Counter()
    for r in got:
        lengths[r.doc_id] += r.length
    assert lengths == Counter({d: len(ids[d]) * sum(x == d for x, _ in rows) for d in ids})
    assert len(bins) <= math.ceil(sum(lengths.values()) / 2048) * 1.05 + 1


def test_packing_of_nothing(spark, documents):
    assert pack_documents(spark, documents([]), TOKENIZER, RANKS).count() == 0


# sharding ----------------------------------------------------------------------------------


def test_shards_are_even_and_slots_gapless(spark, documents):
    rows = [(i, prose(i, i % 50)) for i in range(403)] + [(None, None)] * 30 + [(7, "again é")] * 20
    docs = documents(rows)
    got = shard_documents(spark, docs).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert set(by) == set(range(40))
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    want = sorted((str(d), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == want
    again = {(r.doc_id, r.slot): r.shard for r in shard_documents(spark, docs).collect()}
    assert again == {(r.doc_id, r.slot): r.shard for r in got}
    assert shard_documents(spark, documents([])).count() == 0
    kept = ring_shards(spark, docs, "doc_id")
    assert set(docs.columns) <= set(kept.columns) and kept.count() == len(rows)


def test_loads_are_bounded_and_few_rows_move():
    pick = random.Random(3)
    counts = {i: pick.randrange(20) for i in range(4096)}
    total = sum(counts.values())

    def placed(ring):
        where, load = {}, Counter()
        for piece, first, upto, shard, slot in seats(ring, counts):
            assert slot == load[shard]
            load[shard] += upto - first
            where.update({(piece, i): shard for i in range(first, upto)})
        assert len(where) == total and max(load.values()) <= math.ceil(ring.load * total / ring.shards)
        return where

    small, large = placed(Ring(40, load=1.25)), placed(Ring(41, load=1.25))
    assert sum(small[k] != large[k] for k in small) < 0.1 * total


# pages -------------------------------------------------------------------------------------


def page(main, nav="Home About", foot="All rights"):
    return f"<html><head><title>t</title><script>var a='<p>x</p>'</script></head><body><nav>{nav}</nav>{main}<footer>{foot}</footer>"


def texts_of(spark, tmp_path, rows, files=8):
    path = str(tmp_path / "pages.parquet")
    spark.createDataFrame(rows, "page_id long, url string, html string, row int, text int").coalesce(files).write.parquet(path)
    return {r.page_id: r.text for r in main_texts(spark, spark.read.parquet(path)).collect()}


def test_shared_lines_go_where_markup_is_silent(spark, tmp_path):
    def plain(i):
        return (f"<div>Site of the town</div><div>Menu one</div><div>{prose(i, 40)}</div><p>{prose(50 + i, 30)}</p>"
                "<div>Contact us</div>")  # fmt: skip

    rows = [(i, f"http://A.example/x/{i}", plain(i), 1, 1) for i in range(6)]
    rows += [(10, "http://b.example/1", page(f"<article><h1>T &amp; U</h1><p>{prose(1, 20)}<p>Shared end</article>"), 1, 1),
             (11, "http://b.example/2", page(f"<article><p>{prose(2, 20)}</p><p>Shared end</p></article>"), 1, 1),
             (12, "http://c.example/1", plain(3), 1, 1), (13, None, None, 1, 1), (14, "no url", "<p>a&nbsp;b &lt; c", 1, 1),
             (15, "http://[bad", "", 1, 1), (None, None, "<b>x</b>y", 1, 1)]
    got = texts_of(spark, tmp_path, rows)
    for i in range(6):
        assert got[i] == f"{prose(i, 40)} {prose(50 + i, 30)}"
    assert got[10] == f"T & U {prose(1, 20)} Shared end" and got[11] == f"{prose(2, 20)} Shared end"
    assert got[12].startswith("Site of the town")  # alone in its host
    assert got[13] == "" and got[14] == "a b < c" and got[15] == "" and got[None] == "xy"


def test_copies_of_a_page_keep_their_text(spark, tmp_path):
    same = f"<div>{prose(1, 50)}</div><div>{prose(2, 50)}</div>"
    got = texts_of(spark, tmp_path, [(i, "http://a.example/same", same, 1, 1) for i in range(40)])
    assert set(got.values()) == {f"{prose(1, 50)} {prose(2, 50)}"}


def test_a_large_template_goes_from_short_pages_and_their_copies(spark, tmp_path):
    template = "".join(f"<div>{prose(800 + i, 20)}</div>" for i in range(10))
    rows = [(10 * i + j, f"http://a.example/p{i}?v={j}", f"{template}<p>{prose(i, 25)}</p>{template}", 1, 1)
            for i in range(12) for j in range(4)]
    got = texts_of(spark, tmp_path, rows)
    assert got == {10 * i + j: prose(i, 25) for i in range(12) for j in range(4)}


def test_names_that_only_hold_a_furniture_word_keep_their_text(spark, tmp_path):
    """Such a name decides nothing alone; where the block also comes on the nearest page, it goes."""
    bodies = {
        0: '<div class="page-with-sidebar"><p>{}</p></div>',
        1: '<article class="post comments-open"><p>{}</p></article>',
        2: '<div class="product-notice-page"><p>{}</p></div>',
        3: '<article><section class="related-work"><p>{}</p></section><div class="skip-logic">{}</div></article>',
        4: '<div class="sidebar"><p>{}</p></div>',  # holds the whole page
        5: '<main><p>{}</p><div class="share-this">All share this</div></main>',
        6: '<main><p>{}</p><div class="share-this">All share this</div></main>',
        7: '<main><p>{}</p><p>All share this</p></main>',
        8: '<main><p>{}</p><p>All share this</p></main>',
        9: '<div class="site-footer">f</div><div class="cookie-notice">c</div><div id="nav_menu">n</div><div>{}</div>',
    }
    rows = [(i, f"http://h{i - i % 2 if i in (5, 6, 7, 8) else i}.example/p{i}", b.format(prose(i, 30), prose(90 + i, 30)), 1, 1)
            for i, b in bodies.items()]
    rows = [(i, "http://same.example/p%d" % i if i in (5, 6) else "http://other.example/p%d" % i if i in (7, 8) else u, h, 1, 1)
            for i, u, h, *_ in rows]
    got = texts_of(spark, tmp_path, rows)
    for i in (0, 1, 2, 4, 5, 6, 9):
        assert got[i] == prose(i, 30), i
    assert got[3] == f"{prose(3, 30)} {prose(93, 30)}"
    assert got[7] == f"{prose(7, 30)} All share this" and got[8] == f"{prose(8, 30)} All share this"


def test_a_long_run_waits_in_a_file(monkeypatch):
    monkeypatch.setattr(page_diff, "HELD", 100)
    run = page_diff.Held()
    pages = [{"row": i, "lines": [{"key": i, "text": "x" * i}]} for i in range(50)]
    for one in pages:
        run.add(one)
    assert run.file._rolled and list(run.pages()) == pages and run.file.closed


def test_pages_are_those_of_plain_neighbours(spark, tmp_path):
    """Texts against a loop over all pages in order, with buckets of any bounds, runs of copies and several hosts."""
    pick = random.Random(8)
    template = [prose(f"t{i}", 6) for i in range(8)]
    rows = []
    for i in range(160):
        host = pick.choice(["a", "a", "a", "b", "c"])
        own = prose(f"own {i}", 40)
        lines = [x for x in template if pick.random() < 0.7]
        at = pick.randrange(len(lines) + 1)
        rows.append((i, f"http://{host}.example/{pick.choice('xyz')}/{pick.randrange(12)}", "".join(f"<div>{x}</div>" for x in [*lines[:at], own, *lines[at:]]), 1, 1))
    rows += [(200 + i, "http://a.example/y/5", rows[3][2], 1, 1) for i in range(60)]  # a run over several buckets
    got = texts_of(spark, tmp_path, rows, files=1)
    order = sorted(range(len(rows)), key=lambda i: (page_diff.place_of(rows[i][1]), i))
    pages = []
    for i in order:
        texts, *_ = blocks_of(rows[i][2])
        pages.append((page_diff.place_of(rows[i][1]), rows[i][0], texts))
    key = lambda t: zlib.crc32(t.encode()) << 20 | len(t)
    run_of, runs = [], []
    for place, doc, texts in pages:
        keys = {key(t) for t in texts}
        if not (runs and runs[-1][0] == place[0] and page_diff.is_copy(keys, runs[-1][1])):
            runs.append((place[0], keys, []))
        runs[-1][2].append((place, doc, texts))
    for n, (host, _, members) in enumerate(runs):
        sides = [runs[m][2][e] for m, e in ((n - 1, -1), (n + 1, 0)) if 0 <= m < len(runs) and runs[m][0] == host]
        for place, doc, texts in members:
            near = max(sides, key=lambda s: page_diff.nearness(s[0][1], place[1]), default=None)
            gone = set(common_places(texts, near[2])) if near else set()
            assert got[doc] == " ".join(t for i, t in enumerate(texts) if i not in gone)


def visible(source):
    return [t for t, _, out in zip(*blocks_of(source), strict=True) if not out]


def test_blocks_of_odd_markup():
    assert visible("<p><b>Bold<br><p>next") == ["Bold", "next"]
    assert visible("a <span class='ad'>buy</span> b") == ["a", "b"]
    assert visible("<div class='sidebar'>s<div>t</div></div>u") == ["u"]
    assert visible("<body class='has-sidebar'><div class='has-sidebar main'>v</div>") == ["v"]
    assert visible("<!-- <p>c</p> -->x<style>p{}</style>y") == ["xy"] or visible("<!-- -->x<style>p{}</style>y") == ["x", "y"]
    assert visible("<div hidden>h</div><form><input>f</form><aside>a</aside>z") == ["z"]
    assert visible("<div class='ad'>open<article><p>main</p></article>") == ["main"]
    assert visible("<ul class='comments'><li>c</li></ul><a title=\"x>y\">l</a> 1 < 2") == ["l 1 < 2"]
    assert visible("<p title='open>still") == ["still"]


# queries -----------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, name):
    result = QUERIES[name](spark, SF_DIR).toPandas()
    con = connect(SF_DIR)
    assert difference(result, con.execute(ORACLES[name]).df()) is None


def test_page_query_gives_the_articles(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    for r in QUERIES["op10_html_extraction"](spark, SF_DIR).collect():
        inside = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        flat = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)\b[^>]*>", " ", inside))
        assert r.text == " ".join(html.unescape(flat).split()) and r.n_chars == len(r.text)


def test_the_entry_offers_all_queries():
    names = set(spark_entry.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}


def test_pipeline_stage_by_stage(spark):
    """Each stage against the operators' own reports over what it was given."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == columns, name
        before, after = ([(r.doc_id, r.text) for r in d.collect()] for d in (docs, out))
        if name == "quality_rules":
            words = {d: plain_counts(t or "") for d, t in before}
            good = {d for d, w in words.items() if not (w[0] < 50 or 100 * w[4] > 50 * w[0])}
            assert {d for d, _ in after} <= good and len(after) > 0.95 * len(good)
        elif name == "exact_dedup":
            last = {}
            for d, t in before:
                key = "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
                last[key] = max(d, last.get(key, -1))
            assert sorted(d for d, _ in after) == sorted(last.values())
        elif name == "near_dedup":
            assert set(after) <= set(before) and len(after) <= len(before)
        else:
            assert set(after) == set(before) and len(after) >= len(before)
        docs = spark.createDataFrame(out.collect(), docs.schema).coalesce(1)
        path = f"{corpus_pipeline.Workspace(spark, 'test').folder}/{name}"
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    whole = sum(len(EXACT.encode(r.text, add_special_tokens=False).ids) + 1 for r in docs.collect())
    assert sum(r.length for r in packed) == whole
    run = corpus_pipeline.run(spark, SF_DIR)
    assert run.select("length").groupBy().sum().first()[0] == whole


def test_tokenizer_files_stay_where_they_are():
    assert TOKENIZER == public_tokenizers.path("byte_bpe_50k.json")
