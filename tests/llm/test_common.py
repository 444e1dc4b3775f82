"""Row numbers, which everything that reads its input more than once relies on."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidegauge.llm.common import ROW, Workspace, file_numbers, numbered, plain_path
from tidegauge.llm.ring import Ring, heavy_cells, shard_documents
from tidegauge.llm.substring_chains import fuzzy_passages
from tidegauge.llm.suffix_blocks import repeat_report

CORES = "spark.sql.leafNodeDefaultParallelism"


def numbers(docs):
    return {(r.doc_id, r.n_chars): r[ROW] for r in numbered(docs).select("doc_id", "n_chars", ROW).collect()}


@pytest.fixture
def many_files(spark, tmp_path):
    path = str(tmp_path / "many files=x")
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), F.col("id").alias("n_chars"), F.lit("é").alias("text"))
    rows.repartition(24).write.parquet(path)
    return path


def test_numbers_are_the_same_for_any_number_of_cores(spark, many_files):
    found = []
    for cores in ("2", "8"):
        spark.conf.set(CORES, cores)
        docs = spark.read.parquet(many_files)
        found.append((docs.rdd.getNumPartitions(), numbers(docs)))
    spark.conf.unset(CORES)
    (tasks, few), (more_tasks, many) = found
    assert tasks != more_tasks
    assert few == many and len(set(few.values())) == 5000
    assert numbers(spark.read.parquet(many_files).where("doc_id % 7 = 0").select("doc_id", "n_chars")).items() <= few.items()


def test_rows_that_are_no_scan_are_stored_first(spark, many_files):
    docs = spark.read.parquet(many_files)
    for rows in (
        docs.groupBy("doc_id").agg(F.max("n_chars").alias("n_chars")),
        docs.withColumn("n_chars", F.explode(F.array("n_chars", F.lit(-1)))),
        docs.unionByName(docs.withColumn("n_chars", F.lit(-2))),
        docs.withColumn("n_chars", F.rand()),
        spark.createDataFrame([(1, 2), (None, 3)], "doc_id long, n_chars long"),
    ):
        first, second = numbers(rows), numbers(rows)
        assert first == second and len(set(first.values())) == rows.count()


def test_clashing_names_and_nothing(spark, many_files):
    docs = spark.read.parquet(many_files).withColumn("_metadata", F.lit("own")).withColumn("__row", F.lit(5))
    got = numbered(docs).select("_metadata", "__row", ROW)
    assert got.select(ROW).distinct().count() == 5000 and got.first()[:2] == ("own", 5)
    assert numbered(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_files_get_distinct_numbers(spark, many_files):
    docs = spark.read.parquet(many_files)
    paths = {r[0] for r in docs.select(docs.metadataColumn("_metadata")["file_path"]).distinct().collect()}
    assert {plain_path(f) for f in docs.inputFiles()} == paths
    assert plain_path("s3a://b/x%20y") == "s3a://b/x%20y" and plain_path("file:///a") == "file:/a"
    for n in (0, 1, 2, 5, 3000):
        bits, _ = file_numbers([f"s3a://b/{i}" for i in range(n)])
        assert bits <= 24


def test_operators_survive_another_number_of_cores_between_their_parts(spark, tmp_path, monkeypatch):
    """Each stored part is followed by another core count, as by a lost or added executor."""
    pick = random.Random(3)
    words = [f"w{i}" for i in range(900)]
    texts = [" ".join(pick.choice(words) for _ in range(pick.randrange(60, 200))) for _ in range(120)]
    texts += [texts[i][: len(texts[i]) // 2] + texts[i + 1][-700:] for i in range(40)]
    path = str(tmp_path / "docs")
    rows = [(i, t, "en", "s", i) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(24).write.parquet(path)

    def result(operator):
        return sorted(map(str, operator(spark, spark.read.parquet(path)).collect()))

    operators = (repeat_report, fuzzy_passages)
    before = [result(o) for o in operators]
    turns = iter(range(10_000))
    save = Workspace.save

    def shaken(space, rows):
        spark.conf.set(CORES, str(2 + next(turns) % 7))
        return save(space, rows)

    monkeypatch.setattr(Workspace, "save", shaken)
    try:
        assert [result(o) for o in operators] == before
    finally:
        spark.conf.unset(CORES)
    assert any("n_removed=0" not in r for r in before[0]) and before[1]


@pytest.mark.parametrize("load", [1.0, 1.25])
def test_rows_sit_where_a_walk_of_each_row_ends(spark, documents, load):
    """Rows walk clockwise one by one, all slices a node further each time, until a shard has room."""
    rows = [(i, "x") for i in range(900)] + [(7, "x")] * 400 + [(None, "y")] * 20
    ring = Ring(shards=7, nodes=5, slice_bits=6, load=load)
    docs = documents(rows)
    key = F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit("no key"), ROW)).otherwise(F.xxhash64("doc_id"))
    cell = F.xxhash64(F.lit("cell"), ROW)
    placed = numbered(docs).select("doc_id", ROW, key.alias("place"), cell.alias("cell")).collect()
    slices = defaultdict(list)
    for r in placed:
        slices[(r.place % 2**64) >> 58].append(r)
    lot = 4 * len(rows) // len(slices)
    for held in slices.values():
        cells = -(-len(held) // lot) if len(held) > lot else 1
        held.sort(key=lambda r: (r.cell % cells, r.place, r[ROW]))
    points = [
        (int.from_bytes(hashlib.sha256(f"{s}:{n}".encode()).digest()[:8], "big"), s) for s in range(7) for n in range(5)
    ]
    points = [(place >> 58, shard) for place, shard in sorted(points)]
    room = [-(-load * len(rows) // 7)] * 7 if load > 1 else [len(rows) // 7 + (s < len(rows) % 7) for s in range(7)]
    filled, want = [0] * 7, []
    waiting = []
    for piece in sorted(slices):
        node = next((i for i, (at, _) in enumerate(points) if at >= piece), 0)
        waiting += [(node, r) for r in slices[piece]]
    while waiting:
        onward = []
        for node, r in waiting:
            shard = points[node][1]
            if filled[shard] < room[shard]:
                want.append((str(r.doc_id), shard, filled[shard]))
                filled[shard] += 1
            else:
                onward.append(((node + 1) % len(points), r))
        waiting = onward
    got = [(str(r.doc_id), r.shard, r.slot) for r in shard_documents(spark, docs, ring).collect()]
    assert sorted(got) == sorted(want)


def test_a_key_of_a_third_of_all_rows_is_ranked_in_cells(spark, documents):
    rows = [(i, "x") for i in range(4000)] + [(7, "x")] * 2000
    docs = documents(rows)
    ring = Ring(slice_bits=8)
    got = shard_documents(spark, docs, ring).collect()
    by = Counter(r.shard for r in got)
    assert len(got) == 6000 and set(by.values()) == {150}
    for shard in by:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(150))
    cells = heavy_cells({0: 2000, **{i: 16 for i in range(1, 256)}})
    assert list(cells) == [0] and 2000 / cells[0] <= 4 * 6080 / 256
