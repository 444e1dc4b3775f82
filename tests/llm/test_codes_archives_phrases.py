"""Vector codes, archives and phrases against plain Python, and what odd input gives."""

from __future__ import annotations

import hashlib
import math
import random
import re
import struct
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from tidegauge.llm import phrase_mining
from tidegauge.llm.phrase_mining import Mining, mine_phrases, ranked, tokens
from tidegauge.llm.value_tables import Codec, code_report, compressed
from tidegauge.llm.warc_bundles import archive_report, find_records, read_archives, read_index, seek_table, write_archives

# codes -------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, code string, error long, part int, entry int, n long"


def plain_codes(rows, codec):
    """Codes, errors and codebooks by loops over Python integers."""
    good = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    size = next((len(v) for _, v, _ in sorted(good, key=lambda r: (r[0] is None, r[0], r[1])) if v and not len(v) % codec.parts), 0)
    good = [(i, [math.floor(codec.scale * x) for x in v], label) for i, v, label in good if size and len(v) == size]
    good.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    width = size // codec.parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in good[: codec.entries]] for p in range(codec.parts)]

    def nearest(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), i) for i, e in enumerate(book))

    for _ in range(codec.rounds):
        for p, book in enumerate(books):
            members = defaultdict(list)
            for _, v, _ in good:
                members[nearest(cut(v, p), book)[1]].append(cut(v, p))
            books[p] = [[sum(c) // len(c) for c in zip(*members[i])] if members[i] else e for i, e in enumerate(book)]
    out, sums = [], Counter()
    for i, v, label in good:
        found = [nearest(cut(v, p), books[p]) for p in range(codec.parts)]
        out.append([i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), label])
        sums[label] += out[-1][2]
    numbers = ",".join(str(x) for book in books for e in book for x in e)
    return sorted(((i, c, e, sums[label], hashlib.sha256(numbers.encode()).hexdigest()) for i, c, e, label in out), key=str)


def vector_table(spark, rows):
    return spark.createDataFrame([(i, v, label, "c", 1, 2, 3, 4) for i, v, label in rows], VECTORS).repartition(3)


def codes_of(spark, rows, codec=Codec()):
    got = code_report(spark, vector_table(spark, rows), codec=codec).collect()
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in got), key=str)


def test_codes_are_those_of_plain_loops(spark):
    pick = random.Random(2)
    rows = [(i, [pick.gauss(0, 0.3) for _ in range(32)], pick.choice([0, 1, 1, 1, None])) for i in range(200)]
    rows = [(i, [struct.unpack("f", struct.pack("f", x))[0] for x in v], label) for i, v, label in rows]
    rows += [(rows[5][0], rows[5][1], 0), (7, rows[9][1], 1), (None, rows[3][1], 2), (-4, [-0.001] * 32, None)]  # ties, repeats
    rows += [(300, None, 1), (-9, [None] + [0.1] * 31, 1), (-8, [float("nan")] + [0.1] * 31, 1), (-7, [float("inf")] * 32, 1)]
    rows += [(301, [], 1), (302, [0.5] * 16, 1), (303, [0.5] * 33, 1)]  # not of the common length
    codec = Codec(entries=16)
    assert codes_of(spark, rows, codec) == plain_codes(rows, codec)


def test_codes_of_few_equal_and_no_vectors(spark):
    few = [(3, [0.25] * 16, None), (1, [0.5] * 16, None), (2, [0.5] * 16, 4)]
    assert codes_of(spark, few) == plain_codes(few, Codec())
    assert codes_of(spark, few)[0][1] == "00" * 16
    none = vector_table(spark, [(1, None, 1)])
    assert code_report(spark, none).count() == 0 and code_report(spark, none.limit(0)).count() == 0
    first_other = [(0, [0.5] * 17, 1), (1, [0.25] * 32, 1), (2, [0.5] * 16, 1), (3, [0.75] * 32, 1)]
    assert [r[0] for r in codes_of(spark, first_other)] == [1, 3]


def test_components_without_exact_distances_fail_the_job(spark):
    with pytest.raises(Exception, match="no exact 64-bit distance"):
        compressed(spark, vector_table(spark, [(1, [0.0] * 16, 1), (2, [3e30] * 16, 1)]))[0].collect()


# archives ----------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, row long, digest string, first string, size int, bundle string, frame int"


def page_table(spark, rows, files=3):
    return spark.createDataFrame([(*r, 1, "d", "f", 2, "b", 3) for r in rows], PAGES).repartition(files)


def test_archives_give_back_every_page(spark, tmp_path):
    same, huge = "<p>é " + "x" * 100, "y" * 3_000_000
    rows = [(i, f"http://h/{i}?a=b c&ü=%20", same) for i in range(5, 25)]
    rows += [(1, "http://h/1", "short"), (2, None, "short"), (3, "", None), (4, "u\r\nX: y", ""), (None, "http://h/n", same)]
    rows += [(26, "http://h/a", huge), (25, "http://h/b", huge), (30, "http://h/c", "z" * 100), (30, "http://h/c", "z" * 100)]
    rows += [(31, "http://h/d", "z" * 99), (32, "http://h/d", "z" * 99), (None, "x", "n" * 200), (None, "x", "n" * 200)]
    rows += [(40 + i, f"http://h/{i}", f"{i} " * 90_000) for i in range(30)]
    folder = str(tmp_path / "archives")
    index = write_archives(spark, page_table(spark, rows), folder)
    assert index.count() == len(rows) and index.select("record_id").distinct().count() == len(rows)
    got = read_archives(spark, folder).collect()
    payloads = {r.record_id: bytes(r.payload) for r in got if r.record_type == "response"}
    seen = []
    for r in got:
        whole = payloads[r.record_id if r.record_type == "response" else r.refers_to_record]
        assert (r.payload is None) == (r.record_type == "revisit")
        assert (r.payload_bytes, r.payload_digest) == (len(whole), hashlib.sha256(whole).hexdigest())
        seen.append((str(r.page_id), whole))
    assert sorted(seen) == sorted((str(p), (h or "").encode()) for p, _, h in rows)
    revisits = sorted((str(r.page_id), str(r.refers_to)) for r in got if r.record_type == "revisit")
    assert revisits == sorted([(str(i), "5") for i in range(6, 25)] + [("None", "5"), ("26", "25"), ("30", "30"), ("None", "None")])
    uris = {r.page_id: r.target_uri for r in got}
    assert (uris[2], uris[3], uris[4], uris[1]) == (None, None, "u%0D%0AX:%20y", "http://h/1")
    assert uris[5] == "http://h/5?a=b%20c&%C3%BC=%20"


def test_bundles_are_independent_frames_with_a_seek_table(spark, tmp_path):
    from pyarrow import fs

    rows = [(i, f"http://h/{i}", f"{i} " * 90_000) for i in range(12)]
    folder = str(tmp_path / "archives")
    write_archives(spark, page_table(spark, rows, files=1), folder)
    (path,) = Path(folder, "bundles").iterdir()
    data = path.read_bytes()
    table = seek_table(fs.LocalFileSystem().open_input_file(str(path)))
    assert len(table) > 1
    frames = [zstandard.ZstdDecompressor().decompress(data[at : at + packed], max_output_size=whole) for at, packed, whole in table]
    assert [len(f) for f in frames] == [whole for _, _, whole in table]
    with path.open("rb") as file:  # readers that know nothing of the table pass over it
        assert zstandard.ZstdDecompressor().stream_reader(file, read_across_frames=True).read() == b"".join(frames)
    for r in read_index(spark, folder).collect():
        own = frames[r.frame][r.offset : r.offset + r.length]
        assert own.startswith(b"WARC/1.1\r\n") and f"WARC-Record-ID: {r.record_id}\r\n".encode() in own
    few = find_records(spark, folder, F.col("record_id").startswith("<urn:tidegauge:page:7:")).collect()
    assert [bytes(r.payload).decode() for r in few] == [rows[7][2]]
    bad = table[1][0] + table[1][1] // 2
    path.write_bytes(data[:bad] + bytes([data[bad] ^ 1]) + data[bad + 1 :])
    with pytest.raises(Exception):
        read_archives(spark, folder).collect()


def test_what_a_lost_attempt_left_is_not_read(spark, tmp_path):
    folder = str(tmp_path / "archives")
    write_archives(spark, page_table(spark, [(1, "u", "page")]), folder)
    Path(folder, "bundles", "orphan.warc.zst").write_bytes(b"half a bund")
    assert [r.page_id for r in read_archives(spark, folder).collect()] == [1]
    assert archive_report(spark, page_table(spark, [])).count() == 0


# phrases -----------------------------------------------------------------------------------


def plain_phrases(rows, how):
    """Counts by slices of word lists, cuts and drops by their definitions."""
    counts, sizes = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in range(1, how.longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        frequent = {p: a for p, a in f.items() if a >= how.support and len(p) > 1}
        rows = []
        for p, a in frequent.items():
            inside = any(
                len(q) > len(p) and 100 * b >= how.absorb * a and any(q[i : i + len(p)] == p for i in range(len(q)))
                for q, b in frequent.items()
            )
            if not inside:
                score, k = min((how.scale * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), a, f[p[:k]], f[p[k:]]))
        for rank, (score, _, phrase, a, l, r) in enumerate(sorted(rows)[: how.top], 1):
            out.append((lang, rank, phrase.decode(), a, l, r, sizes[lang], -score))
    return sorted(out)


def phrase_rows(spark, path, rows, how):
    shape = "lang string, text string, name long, word string, n long, f long, phrase string, rank int"
    spark.createDataFrame([(lang, t, 1, "w", 2, 3, "p", 4) for lang, t in rows], shape).repartition(3).write.parquet(path)
    got = mine_phrases(spark, spark.read.parquet(path), how=how).collect()
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got)


@pytest.fixture(scope="module")
def chatter():
    pick = random.Random(4)
    words = ["the", "of", "New", "York", "city", "über", "à", "a-b", "日本", "\x1f", "''"] + [f"w{i}" for i in range(30)]
    weights = [30, 20, 6, 6, 6, 5, 5, 5, 4, 3, 3] + [1] * 30
    rows = []
    for i in range(60):
        text = ""
        for _ in range(pick.randrange(60)):
            text += pick.choice(["new YORK city", "ü ber alles", pick.choices(words, weights)[0], "the the the"])
            text += pick.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "?!", "\r\n", "\xa0", " \x1c "])
        rows.append((pick.choice(["en", "de", None, "und", ""]), text))
    return rows + [("en", None), ("en", ""), (None, None), ("fr", "....,, \n\t "), rows[0], rows[0], ("en", "the " * 400)]


@pytest.mark.parametrize("how", [Mining(support=4), Mining(support=3, longest=5, absorb=50, top=7), Mining(support=10**6)])
def test_phrases_are_those_of_plain_counts(spark, tmp_path, chatter, how):
    assert phrase_rows(spark, str(tmp_path / "docs"), chatter, how) == plain_phrases(chatter, how)


def test_phrases_whatever_the_map_and_the_names_let_pass(spark, tmp_path, chatter, monkeypatch):
    """A map that lets all rare words and phrases pass, and names of which the first lot collides."""
    monkeypatch.setattr(phrase_mining, "live_map", lambda spark, _: spark.sparkContext.broadcast(np.full(1, 255, np.uint8)))
    names = phrase_mining.word_name
    salts = []

    def colliding(salt, lang, word):
        salts.append(salt)
        return F.lit(5).cast("long") if len(salts) == 1 else names(salt, lang, word)

    monkeypatch.setattr(phrase_mining, "word_name", colliding)
    how = Mining(support=4)
    assert phrase_rows(spark, str(tmp_path / "docs"), chatter, how) == plain_phrases(chatter, how)
    assert len(salts) == 2


def test_pieces_of_a_very_long_text(spark, tmp_path):
    pick = random.Random(9)
    text = "".join(pick.choice(["a b", "c", "d e f", "a"]) + pick.choice([" ", " ", ". "]) for _ in range(90_000))
    rows = [("en", text), ("en", "a b c d " * 20_000)]
    how = Mining(support=500, top=100)
    assert phrase_rows(spark, str(tmp_path / "docs"), rows, how) == plain_phrases(rows, how)


def test_scores_beyond_64_bits_are_exact(spark):
    shape = "name long, lang string, phrase string, last string, f long, prefixes array<long>, suffixes array<long>"
    big = 9 * 10**18
    word = spark.createDataFrame([(1, "en", "a", "a", big, [big], [big])], shape)
    pair = (2, "en", "a a", "a", big - 1, [big, big - 1], [big, big - 1], 1, 1)
    triple = (3, "en", "a a a", "a", big // 2, [big, big - 1, 7], [big, big - 1, 7], 2, 2)
    levels = [word, *(spark.createDataFrame([r], f"{shape}, left long, right long") for r in (pair, triple))]
    got = ranked(levels, spark.createDataFrame([("en", big)], "lang string, n long"), Mining())
    want = [("a a", 2_000_000 * (big - 1) // (2 * big)), ("a a a", 2_000_000 * (big // 2) // (2 * big - 1))]
    assert [(r.phrase, r.score) for r in got.orderBy("rank").collect()] == want


def test_words_and_pieces():
    assert tokens("The Ü,b\tc\x1cd\n\xa0e".encode()) == [b"the", "Ü".encode(), b"\xff", b"b", b"c\x1cd", b"\xff", "\xa0e".encode()]


def test_phrases_of_nothing(spark, tmp_path):
    assert phrase_rows(spark, str(tmp_path / "docs"), [], Mining()) == []
