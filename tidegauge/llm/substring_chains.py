"""Substring dedup by collinear chaining: shared seeds, chained in order, aligned word by word."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ROW, Workspace, numbered, tasks, whole_text
from .hashing import common_pairs, common_places, hashed_words, mixed, shingles, sliding_min

#: Words of a short seed. A window is one if the least of its word hashes is its first or its
#: last, as that of about every other window is, and of any SHORT windows in a row one at least.
SHORT = 4
#: Words of a long seed; of each SPREAD neighbouring windows the least one is a seed. They
#: tie a passage to its source where its short windows are common elsewhere. A chain covers
#: SEED words at least, so chance matches of single short windows are none.
SEED = 8
SPREAD = 16
#: Least words of a passage, and least share of them that must align.
PASSAGE = 50
IDENTITY = 0.8
#: Words between two seeds of a chain at most; words a passage can reach beyond its seeds.
GAP = 64
MARGIN = 40
#: Matches that follow one another word by word are thinned to one in so many.
THIN = 16
#: Seeds a task gathers before it deals them to buckets, and those of a bucket at most, but for
#: seeds that are very common, which a bucket takes in turn.
CHUNK = 1_000_000
BUCKET = 4_000_000
#: Row numbers of different files are further apart than this, or fall.
FAR = 1 << 20
#: Bytes of text per seed, about: to tell the number of buckets.
BYTES = 10
#: What a word between two seeds costs a chain, of the SEED a seed is worth.
COST = 0.1
#: Seeds of a chain of which the longest part is sought at once; a longer chain is halved, and what is
#: found in both halves is one passage where it touches.
PART = 1024
#: Words by which a part of a chain is prolonged at most; what lies further is the next part's.
REACH = 4096
#: Passages of one text that are on the way together at most.
REQUESTS = 256
#: Passages of a text this close are one.
NEAR = 8


def run_labelled(marks: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Marks joined with how often each just came before, at most SPREAD words earlier each time.

    In a monotonous stretch all seeds are alike; so joined, the n-th matches the n-th of
    another such stretch, and the two chain as far as the shorter one goes.
    """
    ordered = np.sort(marks)
    if (ordered[1:] != ordered[:-1]).all():
        return mixed(marks)
    order = np.argsort(marks, kind="stable")  # places rise
    ordered, at = marks[order], places[order]
    new = np.r_[True, (ordered[1:] != ordered[:-1]) | (np.diff(at) > SPREAD)]
    starts = np.flatnonzero(new)
    times = np.empty(len(marks), np.uint64)
    times[order] = np.arange(len(marks)) - np.repeat(starts, np.diff(np.r_[starts, len(marks)]))
    return mixed(marks + times * np.uint64(0xD6E8FEB86659FD93))


def seeds_of(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each seed of a text's words, and twice its place, odd for long seeds."""
    if len(hashes) < PASSAGE:
        return np.empty(0, np.uint64), np.empty(0, np.int32)
    least = sliding_min(hashes, SHORT)
    ends = np.flatnonzero((hashes[: 1 - SHORT] == least) | (hashes[SHORT - 1 :] == least))
    windows = shingles(hashes, SHORT)[ends]
    marks = shingles(hashes, SEED)
    least = sliding_min(marks, SPREAD)
    # a mark is chosen if it is least of one of its windows: the greatest minimum around it
    top = np.iinfo(np.uint64).max
    around = np.concatenate([np.full(SPREAD - 1, top), top - least, np.full(SPREAD - 1, top)])
    places = np.flatnonzero(top - sliding_min(around, SPREAD) == marks)
    chosen = np.concatenate([run_labelled(windows, ends), run_labelled(marks[places], places)])
    return chosen, np.concatenate([2 * ends, 2 * places + 1]).astype(np.int32)


def dealt(columns: list[np.ndarray], bucket: np.ndarray, first: int) -> pa.RecordBatch:
    """A row per bucket: the bucket's part of all columns, one after the other, as bytes."""
    bucket = bucket.astype(np.uint16 if bucket.max() < 1 << 16 else np.uint32)  # short ones are sorted by digits
    order = np.argsort(bucket, kind="stable")
    buckets, starts = np.unique(bucket[order], return_index=True)
    columns = [c[order] for c in columns]
    ends = np.r_[starts[1:], len(order)]
    data = [b"".join(c[i:j].tobytes() for c in columns) for i, j in zip(starts.tolist(), ends.tolist(), strict=True)]
    return pa.RecordBatch.from_arrays(
        [pa.array(buckets.astype(np.int32)), pa.array(np.full(len(buckets), first, np.int64)), pa.array(data, pa.binary())],
        names=["bucket", "first", "data"],
    )


def columns_of(data: bytes, kinds: tuple[str, ...]) -> list[np.ndarray]:
    """The columns that `dealt` put together."""
    n = len(data) // sum(np.dtype(k).itemsize for k in kinds)
    out, at = [], 0
    for kind in kinds:
        out.append(np.frombuffer(data, kind, n, at))
        at += out[-1].nbytes
    return out


DEALT = "bucket int, first long, data binary"
SEED_KINDS = ("<u8", "<i8", "<i4")
MATCH_KINDS = ("<i8", "<i8", "<i4", "<i4")


def seeded(buckets: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Seeds of the texts, packed by bucket of their hash: (mark, row, place) of about CHUNK of them at once.

    Rows rise within what is packed, and `first` is the first of them, so in order of `first`
    the seeds of a bucket are in order of rows.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, int, np.ndarray]] = []
        size, last = 0, -1

        def flush() -> pa.RecordBatch:
            marks, at = (np.concatenate([h[i] for h in held]) for i in (0, 2))
            rows = np.repeat([h[1] for h in held], [len(h[0]) for h in held])
            first = held[0][1]
            held.clear()
            return dealt([marks, rows, at], (marks >> np.uint64(32)) % np.uint64(buckets), first)

        for batch in batches:
            for row, hashes in zip(batch[0].to_pylist(), hashed_words(batch[1].to_pylist()), strict=True):
                if held and (size > CHUNK or not 0 < row - last < FAR):
                    yield flush()
                    size = 0
                marks, at = seeds_of(hashes)
                if len(marks):
                    held.append((marks, row, at))
                    size += len(marks)
                last = row
        if held:
            yield flush()

    return run


class Firsts:
    """The first seed of each hash of a bucket, whose seeds come in order of rows, a part at a time."""

    def __init__(self) -> None:
        self.marks = np.empty(0, np.uint64)
        self.rows, self.places = np.empty(0, np.int64), np.empty(0, np.int32)

    def matches(self, marks: np.ndarray, rows: np.ndarray, places: np.ndarray, more: bool) -> tuple[np.ndarray, ...]:
        """Row, place, and row and place of the first seed of the hash, for each seed that is not the first."""
        order = np.argsort(marks, kind="stable")
        marks, rows, places = marks[order], rows[order], places[order]
        new = np.r_[True, marks[1:] != marks[:-1]]
        starts = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        first_rows, first_places, names = rows[starts], places[starts], marks[starts]
        if len(self.marks):
            at = np.minimum(np.searchsorted(self.marks, names), len(self.marks) - 1)
            known = self.marks[at] == names
            first_rows, first_places = (
                np.where(known, old[at], own) for old, own in ((self.rows, first_rows), (self.places, first_places))
            )
            new[starts[known]] = False
        pair = np.flatnonzero(~new)
        if more:
            fresh = np.flatnonzero(new[starts])
            names = np.concatenate([self.marks, names[fresh]])
            order = np.argsort(names, kind="stable")
            self.marks = names[order]
            self.rows = np.concatenate([self.rows, first_rows[fresh]])[order]
            self.places = np.concatenate([self.places, first_places[fresh]])[order]
        return rows[pair], places[pair], first_rows[group[pair]], first_places[group[pair]]


def by_bucket(batches: Iterable[pa.RecordBatch], kinds: tuple[str, ...], most: float) -> Iterator[tuple[list[np.ndarray], bool]]:
    """Columns of each bucket, and whether more of the bucket follows; at most about `most` rows at once."""
    held: list[list[np.ndarray]] = []
    bucket, size = None, 0
    for batch in batches:
        for own, data in zip(batch["bucket"].to_pylist(), batch["data"], strict=True):
            if held and (own != bucket or size > most):
                yield [np.concatenate(c) for c in zip(*held, strict=True)], own == bucket
                held, size = [], 0
            held.append(columns_of(data.as_buffer(), kinds))
            bucket, size = own, size + len(held[-1][0])
    if held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)], False


def matched_first(buckets: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each seed and the first one of its hash, packed by bucket of its row.

    A long seed gives two matches, its first and its last SHORT words. Of a hash that is very
    common only the first seed is held, however many there are.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = Firsts()
        for columns, more in by_bucket(batches, SEED_KINDS, BUCKET):
            row, at, other, other_at = firsts.matches(*columns, more)
            if not more:
                firsts = Firsts()
            if not len(row):
                continue
            long = at & 1 == 1
            place, other_place = at >> 1, other_at >> 1
            row, other = np.concatenate([row, row[long]]), np.concatenate([other, other[long]])
            place = np.concatenate([place, place[long] + (SEED - SHORT)]).astype(np.int32)
            other_place = np.concatenate([other_place, other_place[long] + (SEED - SHORT)]).astype(np.int32)
            yield dealt([row, other, place, other_place], mixed(row.view(np.uint64)) % np.uint64(buckets), 0)

    return run


class Fenwick:
    """Greatest value, and who has it, among the first ranks."""

    def __init__(self, size: int) -> None:
        self.best = [(float("-inf"), -1)] * (size + 1)

    def add(self, rank: int, value: tuple[float, int]) -> None:
        rank += 1
        while rank < len(self.best):
            if value > self.best[rank]:
                self.best[rank] = value
            rank += rank & -rank

    def upto(self, rank: int) -> tuple[float, int]:
        """Over ranks below `rank`."""
        out = (float("-inf"), -1)
        while rank > 0:
            if self.best[rank] > out:
                out = self.best[rank]
            rank -= rank & -rank
        return out


def chains_of(matches: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Chains of (place, place in the other text), rising in both; cut at gaps over GAP.

    A chain is worth SEED per seed less COST per word passed in either text. The cost is a
    difference of sums of places, so the best predecessor is the greatest of value plus sum
    among the seeds before in both texts: by place in turn, by other place in the tree.
    """
    matches = sorted(set(matches))
    ranks = {y: r for r, y in enumerate(sorted({y for _, y in matches}))}
    tree = Fenwick(len(ranks))
    value, source = [0.0] * len(matches), [-1] * len(matches)
    at = 0
    for _, same in groupby(enumerate(matches), key=lambda m: m[1][0]):
        column = list(same)
        for i, (x, y) in column:
            before, j = tree.upto(ranks[y])
            gain = before - COST * (x + y)
            value[i], source[i] = (SEED + gain, j) if gain > 0 else (SEED, -1)
        for i, (x, y) in column:
            tree.add(ranks[y], (value[i] + COST * (x + y), i))
        at += len(column)
    used = [False] * len(matches)
    chains = []
    for i in sorted(range(len(matches)), key=lambda i: -value[i]):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(matches[i])
            i = source[i]
        chain.reverse()
        while chain:
            end = next(
                (n for n in range(1, len(chain)) if max(chain[n][s] - chain[n - 1][s] for s in (0, 1)) > GAP), len(chain)
            )
            chains.append(chain[:end])
            chain = chain[end:]
    return chains


def steps(row: np.ndarray, other: np.ndarray, place: np.ndarray, other_place: np.ndarray) -> tuple[np.ndarray, ...]:
    """Whether each match is of the same two texts as the one before, and its steps in both."""
    same = (np.diff(row) == 0) & (np.diff(other) == 0)
    return same, np.diff(place), np.diff(other_place)


def chainable(columns: list[np.ndarray]) -> list[np.ndarray]:
    """The matches to chain, by row, other row and places: each once, and with another one near it.

    Of a run, word by word in both texts, one in THIN will do, with both its ends: what is
    equal between two of a run is found again when they are aligned.
    """
    row, other, place, other_place = columns
    order = np.lexsort((place.astype(np.int64) << 32 | other_place, other, row))
    columns = [c[order] for c in columns]
    same, dx, dy = steps(*columns)
    again = np.r_[False, same & (dx == 0) & (dy == 0)]
    columns = [c[~again] for c in columns]
    same, dx, dy = steps(*columns)
    run = same & (dx == dy) & (dx <= SHORT)  # of windows in a row one at least is a seed
    inner = np.r_[False, run] & np.r_[run, False]
    turn = np.r_[False, columns[2][1:] // THIN != columns[2][:-1] // THIN]
    columns = [c[~inner | turn] for c in columns]
    same, dx, _ = steps(*columns)
    near = same & (dx <= GAP)
    return [c[np.r_[False, near] | np.r_[near, False]] for c in columns]


def covered(chain: list[tuple[int, int]]) -> int:
    """Words of a chain's seeds, with what is between two of a run."""
    out = SHORT
    for (x, y), (u, v) in zip(chain, chain[1:]):
        out += u - x if u - x == v - y and u - x <= THIN + SHORT else min(SHORT, u - x, v - y)
    return out


def chains_by_row(columns: list[np.ndarray]) -> Iterator[tuple[int, list[tuple[int, list[tuple[int, int]]]]]]:
    """(row, its chains with other texts). Matches that rise in both texts without a long gap are one chain."""
    columns = chainable(columns)
    if not len(columns[0]):
        return
    same, dx, dy = steps(*columns)
    rising = same & (dx > 0) & (dy > 0) & (dx <= GAP) & (dy <= GAP) & (COST * (dx + dy) < SEED)
    starts = np.flatnonzero(np.r_[True, ~same])
    ends = np.r_[starts[1:], len(columns[0])]
    broken = np.r_[0, np.cumsum(same & ~rising)]
    plain = broken[ends - 1] == broken[starts]
    row, other, place, other_place = (c.tolist() for c in columns)
    chains: list[tuple[int, list[tuple[int, int]]]] = []
    at = row[0]
    for i, j, whole in zip(starts.tolist(), ends.tolist(), plain.tolist(), strict=True):
        if row[i] != at:
            yield at, chains
            chains, at = [], row[i]
        pairs = list(zip(place[i:j], other_place[i:j], strict=True))
        chains += [(other[i], c) for c in ([pairs] if whole else chains_of(pairs)) if covered(c) >= SEED]
    yield at, chains


def promising(chains: list[tuple[int, list[tuple[int, int]]]]) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """The chains of a text that can be part of a passage, each as long as it may become."""
    reach = sorted((chain[0][0] - MARGIN, chain[-1][0] + SHORT + MARGIN, n) for n, (_, chain) in enumerate(chains))
    group: list[int] = []
    begin = end = None
    for low, high, n in [*reach, (float("inf"), 0, -1)]:
        if group and low > end:
            if end - begin >= PASSAGE:
                yield from (chains[i] for i in group)
            group = []
        if not group:
            begin, end = low, high
        group.append(n)
        end = max(end, high)


CHAINS = "row long, number int, other long, places array<int>, other_places array<int>"


def chained(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chains per text from its matches; a task holds the matches of one bucket of texts."""
    shape = pa.schema([("row", pa.int64()), ("number", pa.int32()), ("other", pa.int64()),
                       ("places", pa.list_(pa.int32())), ("other_places", pa.list_(pa.int32()))])
    for columns, _ in by_bucket(batches, MATCH_KINDS, float("inf")):
        out: list[dict] = []
        for row, chains in chains_by_row(columns):
            for number, (other, chain) in enumerate(promising(chains)):
                places, others = (list(c) for c in zip(*chain, strict=True))
                out.append({"row": row, "number": number, "other": other, "places": places, "other_places": others})
            if len(out) >= 2000:
                yield pa.RecordBatch.from_pylist(out, schema=shape)
                out = []
        yield pa.RecordBatch.from_pylist(out, schema=shape)


PIECES = "row long, number int, side int, low int, words array<int>"


def cut_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words (32 bits of their hashes) that passages asked for, from each text's words."""
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int32())]
    for batch in batches:
        rows = []
        hashes = hashed_words(batch["text"].to_pylist())
        for words, requests in zip(hashes, batch["requests"].to_pylist(), strict=True):
            words = words.astype(np.uint32).view(np.int32)
            for r in requests:
                low = max(0, r["low"])
                rows.append((r["row"], r["number"], r["side"], low, words[low : r["high"]]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [()] * 5, kinds, strict=True)],
            names=["row", "number", "side", "low", "words"],
        )


def extended(a: list[int], b: list[int]) -> tuple[int, int, int]:
    """Words to go on in both texts, and how many of them match, from an end of a chain.

    Equal words first; after a difference, the shortest way (a word more, less or other) to
    three equal words goes on, up to three words off the diagonal; then to two that stand on it.
    """
    i = j = matched = 0
    ways = sorted(((x, y) for x in range(4) for y in range(4) if x or y), key=lambda w: (max(w), sum(w)))
    ways = [(x, y, 3) for x, y in ways] + [(x, x, 2) for x in range(1, 4)]
    while True:
        while i < len(a) and j < len(b) and a[i] == b[j]:
            i, j, matched = i + 1, j + 1, matched + 1
        for x, y, n in ways:
            if len(a) - i - x >= n and a[i + x : i + x + n] == b[j + y : j + y + n]:
                i, j = i + x, j + y
                break
        else:
            return i, j, matched


def widened(a: list[int], b: list[int], span: tuple[int, int, int, int, int]) -> tuple[int, int, int, int, int]:
    """The longest span around this one of which IDENTITY aligns, with the words on both sides of it aligned.

    That finds what `extended` gives up: ends of a passage with many differences near one
    another. If not even the words the sides have in common make a passage, it stays as it is.
    """
    start, end, other_start, other_end, matched = span
    before, other_before = max(0, start - MARGIN), max(0, other_start - MARGIN)
    sides = (
        (a[before:start][::-1], b[other_before:other_start][::-1]),
        (a[end : end + MARGIN], b[other_end : other_end + MARGIN]),
    )
    if matched + sum(len(set(x).intersection(y)) for x, y in sides) < IDENTITY * PASSAGE:
        return span
    back, forth = (
        np.array([(0, 0, 0), *((i + 1, j + 1, n + 1) for n, (i, j) in enumerate(common_pairs(x, y)))]) for x, y in sides
    )
    more = back[:, None, :] + forth[None, :, :]
    size, other_size = more[..., 0] + (end - start), more[..., 1] + (other_end - other_start)
    fits = more[..., 2] + matched >= IDENTITY * np.maximum(size, other_size)
    i, j = divmod(int(np.argmax(np.where(fits, size, -1))), len(forth))
    if not fits[i, j]:
        return span
    (x, y, n), (u, v, m) = back[i].tolist(), forth[j].tolist()
    return start - x, end + u, other_start - y, other_end + v, matched + n + m


def steps_of(a: list[int], b: list[int], x: list[int], y: list[int]) -> np.ndarray:
    """Words aligned from the first seed of a chain up to each, by a longest common subsequence
    between two seeds; a gap is a band of GAP words at most."""
    out = [0]
    for i in range(1, len(x)):
        step_x, step_y = x[i] - x[i - 1], y[i] - y[i - 1]
        if step_x == step_y and a[x[i - 1] : x[i]] == b[y[i - 1] : y[i]]:
            out.append(step_x)
        elif min(step_x, step_y) <= SHORT:  # seeds overlap in one of the texts
            out.append(min(step_x, step_y))
        else:
            out.append(SHORT + len(common_places(a[x[i - 1] + SHORT : x[i]], b[y[i - 1] + SHORT : y[i]])))
    return np.cumsum(out)


def longest(x: np.ndarray, y: np.ndarray, upto: np.ndarray) -> tuple[int, int]:
    """First and last seed of the longest part of a chain of which IDENTITY aligns."""
    best, ends = -1, (0, 0)
    for i in range(len(x)):
        size = np.maximum(x[i:] - x[i], y[i:] - y[i]) + SHORT
        j = int(np.flatnonzero(upto[i:] - upto[i] + SHORT >= IDENTITY * size)[-1])
        if x[i + j] - x[i] > best:
            best, ends = x[i + j] - x[i], (i, i + j)
    return ends


def alike(
    a: list[int], low_a: int, b: list[int], low_b: int, places: list[int], others: list[int]
) -> Iterator[tuple[int, int, int, int, int]]:
    """Start and end in both texts and aligned words of the parts of a chain of which IDENTITY aligns.

    That is the whole chain with what goes on at its ends, or its longest part; what is left
    on either side of that, over NEAR words away, is tried in turn.
    """
    x, y = np.array(places) - low_a, np.array(others) - low_b
    upto = steps_of(a, b, x.tolist(), y.tolist())
    todo = [(0, len(x))]
    while todo:
        low, high = todo.pop()
        i, j = low, high - 1
        for part in ("whole", "longest"):
            if part == "longest" and high - low > PART:
                break
            if part == "longest":
                i, j = (low + n for n in longest(x[low:high], y[low:high], upto[low:high]))
            start, end, other_start, other_end = x[i], x[j] + SHORT, y[i], y[j] + SHORT
            matched = upto[j] - upto[i] + SHORT
            back = extended(a[max(0, start - REACH) : start][::-1], b[max(0, other_start - REACH) : other_start][::-1])
            forth = extended(a[end : end + REACH], b[other_end : other_end + REACH])
            longer = start - back[0], end + forth[0], other_start - back[1], other_end + forth[1], matched + back[2] + forth[2]
            spans = [longer, (start, end, other_start, other_end, matched)]
            found = next((s for s in spans if s[4] >= IDENTITY * max(s[1] - s[0], s[3] - s[2])), None)
            if found is None or found[1] - found[0] < PASSAGE:
                wider = widened(a, b, spans[1])
                if wider[1] - wider[0] >= PASSAGE:
                    found = wider
            if found is not None:
                break
        if found is None:
            middle = (low + high) // 2
            todo += [(low, middle), (middle, high)]
            continue
        yield tuple(int(v) for v in (found[0] + low_a, found[1] + low_a, found[2] + low_b, found[3] + low_b, found[4]))
        left = low + int(np.searchsorted(x[low:i], found[0] - NEAR - SHORT))
        right = j + 1 + int(np.searchsorted(x[j + 1 : high], found[1] + NEAR, side="right"))
        todo += [(p, q) for p, q in ((low, left), (right, high)) if q > p and x[q - 1] + SHORT - x[p] >= SEED]


SPANS = "row long, other long, start int, end int, other_start int, other_end int, matched int"


def aligned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["row", "other", "start", "end", "other_start", "other_end", "matched"]
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            found = alike(r["words"], r["low"], r["other_words"], r["other_low"], r["places"], r["other_places"])
            rows += [(r["row"], r["other"], *span) for span in found]
        kinds = [pa.int64()] * 2 + [pa.int32()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [()] * 7, kinds, strict=True)], names=names
        )


def fuzzy_passages(spark: SparkSession, docs: DataFrame, text: str = "text") -> DataFrame:
    """Passages that repeat, in words of the texts: `doc_id` [`start`, `end`) is like `other_doc_id` [...).

    Each seed is matched with the first place that has it (by row number), in another text or in the same, so
    matches grow with the texts, not with pairs of them, and a passage of a third of all texts
    is one match per seed and text.
    The spans of a text that touch are one `passage`, numbered per document, whichever texts
    they are like; it counts from PASSAGE words. One row per passage and other text: what
    of the passage is like it, and in how many `spans`. The first text with a passage is the
    one that others refer to.

    Null text has no words; texts under PASSAGE words have no passage; a text of any length
    is read whole, its seeds in parts; repeated rows are copies of the first; of equal
    choices the first by row number and place is taken; other columns play no part; an
    empty table gives no rows.
    """
    space = Workspace(spark, "chains")
    rows = numbered(docs)
    texts = rows.select(F.col(ROW).alias("row"), whole_text(text).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = tasks(spark)
    buckets = max(parts, size // (BYTES * BUCKET))
    part = F.col("bucket") % parts
    seeds = texts.mapInArrow(seeded(buckets), DEALT).repartitionById(parts, part).sortWithinPartitions("bucket", "first")
    found = space.save(seeds.mapInArrow(matched_first(buckets), DEALT))
    chains = space.save(found.repartitionById(parts, part).sortWithinPartitions("bucket").mapInArrow(chained, CHAINS))
    space.free(found)

    def request(target: str, places: str, side: int) -> DataFrame:
        return chains.select(
            F.col(target).alias("target"),
            F.struct(
                "row",
                "number",
                F.lit(side).alias("side"),
                (F.element_at(places, 1) - MARGIN).alias("low"),
                (F.element_at(places, -1) + SHORT + MARGIN).alias("high"),
            ).alias("request"),
        )

    requests = request("row", "places", 0).unionByName(request("other", "other_places", 1))
    often = requests.groupBy("target").agg(F.ceil(F.count("*") / REQUESTS).cast("int").alias("lots")).where("lots > 1")
    often = space.save(often)  # few, so Spark sees that it can be broadcast
    lots = F.coalesce("lots", F.lit(1))
    lot = F.pmod(F.xxhash64("request.row", "request.number"), lots).cast("int")
    grouped = (
        requests.join(often, "target", "left")
        .select(F.col("target").alias("row"), lot.alias("lot"), "request")
        .repartition("row", "lot")
        .groupBy("row", "lot")
        .agg(F.collect_list("request").alias("requests"))  # about REQUESTS of them
    )
    in_lots = (
        texts.join(often.withColumnRenamed("target", "row"), "row", "left")
        .withColumn("lot", F.explode(F.sequence(F.lit(0), lots - 1)))
        .select("row", "lot", "text")
    )
    pieces = space.save(in_lots.join(grouped, ["row", "lot"]).select("text", "requests").mapInArrow(cut_words, PIECES))
    own_words = pieces.where("side = 0").select("row", "number", "low", "words")
    other_words = pieces.where("side = 1").select(
        "row", "number", F.col("low").alias("other_low"), F.col("words").alias("other_words")
    )
    spans = space.save(
        chains.join(own_words, ["row", "number"]).join(other_words, ["row", "number"]).mapInArrow(aligned, SPANS)
    )
    space.free(pieces)
    in_order = Window.partitionBy("row").orderBy("start", "end", "other", "other_start")  # bounded by the text
    before = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce((F.col("start") > before + NEAR).cast("int"), F.lit(1))
    one = Window.partitionBy("row", "passage")
    passages = (
        spans.withColumn("new", new)
        .withColumn("passage", F.sum("new").over(in_order.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
        .groupBy("row", "passage", "other")
        .agg(
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.min("other_start").alias("other_start"),
            F.max("other_end").alias("other_end"),
            F.count("*").cast("int").alias("spans"),
        )
        .withColumn("passage_start", F.min("start").over(one))
        .withColumn("passage_end", F.max("end").over(one))
        .withColumn("others", F.sum(F.col("other_end") - F.col("other_start")).over(one))
        # both ways: a short run that a monotonous text repeats is no passage of the other
        .where((F.col("passage_end") - F.col("passage_start") >= PASSAGE) & (F.col("others") >= PASSAGE))
    )
    ids = rows.select(F.col(ROW).alias("row"), F.col("doc_id").cast("long"))
    others = ids.select(F.col("row").alias("other"), F.col("doc_id").alias("other_doc_id"))
    return passages.join(ids, "row").join(others, "other").select(
        "doc_id", "passage", "passage_start", "passage_end", "start", "end", "other_doc_id", "other_start", "other_end",
        "spans",
    )
