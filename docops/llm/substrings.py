"""Long repeated byte strings removed, by a distributed merge sort of suffixes.

Only suffixes at anchors are sorted: positions whose hash of the next ``GRAM`` bytes is the
smallest within some window of ``LENGTH`` bytes. Equal strings of that length have the same
anchors, so a repeated string meets its copies at one of them. Anchors whose hash is
alone are left out. Tasks sort their suffixes into front-coded runs, each string without
the prefix it shares with the one before, and exchange those; the runs of a range of
hashes are merged by a loser tree that compares only bytes beyond the known common
prefixes, which also gives the prefix lengths of neighbours. Among suffixes that share
enough, the text before the anchors is compared the same way from right to left.

An anchor that occurs very often would put its suffixes into one task. The bytes around
such anchors that hold all their strings, their windows, are compared whole first: where a
window repeats, so do all its strings, and one place speaks for all. The strings of
different windows are looked at in blocks of neighbours: a block whose common bytes are
alone has no repeat, one whose joined bytes repeat has nothing else, and only for the
blocks between the two, at the edges of repeats, single strings are compared by hash.
Groups of very many equal windows, blocks or strings are known to all tasks by broadcast,
so no task gathers their rows.

* ``cut_repeats`` gives the removed runs and the remaining bytes; the query's digests and text are derived from them.
* Null text counts as empty. A text shorter than ``LENGTH`` loses nothing but can have no copy.
* Texts that occur in several rows, with one id or several, are removed whole if long enough,
  and take part in the sorting once.
* An empty table gives an empty result. Other columns are ignored.
* Texts and strings are told apart by 128-bit hashes.
"""

from __future__ import annotations

import pickle
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docops.llm.common import stored, table
from docops.plans.skew import BROADCAST_ROWS, local_frame, partitions

LENGTH = 400
GRAM = 160
SIDE = LENGTH - GRAM
#: Bytes hashed at once; longer texts are taken in overlapping pieces.
PIECE = 1 << 20
#: Anchors with more equal ones than this are compared by hashes of what is around them; groups
#: of more equal rows than this are joined by broadcast.
HOT = 1000
#: Neighbouring strings of a block.
BLOCK = 16
#: Bytes of suffixes and text before them in one bucket, at most about.
BUCKET_BYTES = 64 << 20
#: Bytes of suffixes that a task sorts into one run.
RUN_BYTES = 32 << 20
#: Bytes of two hashes that stand for the gram in front of a suffix.
HEAD = 16
_KEY = ["t1", "t2"]


class Rolling:
    """Hashes of all substrings of one length, from prefix sums of a polynomial modulo 2**64."""

    def __init__(self, seed: int):
        random = np.random.default_rng(seed)
        self.values = random.integers(1, 1 << 63, 256, dtype=np.uint64)
        self.base = int(random.integers(1 << 62, 1 << 63)) | 1
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def hashes(self, data: np.ndarray, length: int) -> np.ndarray:
        if len(self.up) < len(data):
            inverse = pow(self.base, -1, 1 << 64)
            for name, base in (("up", self.base), ("down", inverse)):
                powers = np.full(len(data), base, dtype=np.uint64)
                powers[0] = 1
                setattr(self, name, np.cumprod(powers))
        terms = self.values[data] * self.up[: len(data)]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])
        found = (sums[length:] - sums[:-length]) * self.down[: len(data) - length + 1]
        found ^= found >> np.uint64(32)
        found *= np.uint64(0x9E3779B97F4A7C15)
        found ^= found >> np.uint64(29)
        return found | np.uint64(1)


def _extremes(values: np.ndarray, width: int, pick) -> np.ndarray:
    """The smallest or largest of every ``width`` values in a row, by doubling."""
    reach = 1
    while reach * 2 <= width:
        values = pick(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, ends: list[int], rolling: Rolling) -> tuple[np.ndarray, np.ndarray]:
    """Anchor positions in joined texts that end at ``ends``, with the hashes of their grams."""
    if len(data) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = rolling.hashes(data, GRAM)
    least = _extremes(grams, SIDE + 1, np.minimum)
    for end in ends[:-1]:  # windows that cross a border hold no string
        least[max(0, end - LENGTH + 1) : end] = 0
    none = np.zeros(SIDE, np.uint64)
    reached = _extremes(np.concatenate([none, least, none]), SIDE + 1, np.maximum)
    at = np.flatnonzero(reached == grams)
    return at, grams[at]


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rolling = Rolling(1)

    def flush(pieces):
        data = np.frombuffer(b"".join(p[3] for p in pieces), np.uint8)
        ends = np.cumsum([len(p[3]) for p in pieces])
        at, grams = anchors(data, ends.tolist(), rolling)
        piece = np.searchsorted(ends, at, side="right")
        starts = np.array([p[2] for p in pieces]) - (ends - np.array([len(p[3]) for p in pieces]))
        columns = [np.array([p[0] for p in pieces])[piece], np.array([p[1] for p in pieces])[piece]]
        columns += [at + starts[piece], grams.view(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["t1", "t2", "pos", "h"])

    pieces, size = [], 0
    for batch in batches:
        for t1, t2, text in zip(*(batch.column(i) for i in range(3))):
            data = text.as_py()
            for start in range(0, max(len(data) - LENGTH + 1, 0), PIECE):
                pieces.append((t1.as_py(), t2.as_py(), start, data[start : start + PIECE + LENGTH - 1]))
                size += len(pieces[-1][3])
                if size >= PIECE:
                    yield flush(pieces)
                    pieces, size = [], 0
    if pieces:
        yield flush(pieces)


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes need no comparison."""
    low, high = known, min(len(a), len(b))
    if a[low:high] == b[low:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def front_coded(entries: list[tuple]) -> bytes:
    """A sorted run of (string, ...) with each string cut by the prefix it shares with the last."""
    coded, last = [], b""
    for string, *rest in entries:
        known = common_prefix(last, string)
        coded.append((known, string[known:], *rest))
        last = string
    return pickle.dumps(coded, 5)


def _decoded(run: bytes) -> Iterator[tuple]:
    string = b""
    for known, tail, *rest in pickle.loads(run):
        string = string[:known] + tail
        yield known, string, rest


def merged(runs: list[bytes]) -> Iterator[tuple]:
    """Front-coded runs to one sorted sequence of (prefix shared with the last, string, rest).

    A loser tree: every node keeps the loser of its match and what that shares with the
    winner. Of two strings, the one that shares more with the last output is smaller, without
    a comparison; only equal shares are compared, from there on.
    """
    width = 1
    while width < len(runs):
        width *= 2
    sources = [_decoded(run) for run in runs]
    heads = [next(s, None) for s in sources] + [None] * (width - len(runs))
    shared = [0] * width

    def match(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's share becomes that with the winner."""
        if heads[a] is None or heads[b] is None:
            return (b, a) if heads[a] is None else (a, b)
        if shared[a] != shared[b]:
            return (a, b) if shared[a] > shared[b] else (b, a)
        x, y = heads[a][1], heads[b][1]
        known = common_prefix(x, y, shared[a])
        winner, loser = (a, b) if x[known:] <= y[known:] else (b, a)
        shared[loser] = known
        return winner, loser

    losers = [0] * width
    winners = [0] * width + list(range(width))
    for node in range(width - 1, 0, -1):
        winners[node], losers[node] = match(winners[2 * node], winners[2 * node + 1])
    best = winners[1] if width > 1 else 0
    while heads[best] is not None:
        _, string, rest = heads[best]
        yield shared[best], string, rest
        heads[best] = next(sources[best], None)
        shared[best] = heads[best][0] if heads[best] else 0
        node = (best + width) // 2
        while node:
            best, losers[node] = match(best, losers[node])
            node //= 2


def reaches(shares: list[int], lefts: list[bytes], sizes: list[int], rights: list[int]) -> list[tuple[int, int] | None]:
    """How far repeated strings reach left and right of each suffix, or None.

    Suffixes are in order; ``shares[i]`` is what suffix i shares with the one before, beyond
    the gram. Within each interval of suffixes that share at least x, left texts are sorted;
    neighbours have the longest common part, which with x must make up a whole string.
    """
    found: list[tuple[int, int] | None] = [
        (len(left), right) if size > 1 and len(left) + right >= SIDE else None
        for left, size, right in zip(lefts, sizes, rights)
    ]
    todo = [(0, len(lefts))]
    while todo:
        low, high = todo.pop()
        if high - low < 2:
            continue
        least = min(shares[low + 1 : high])
        order = sorted(range(low, high), key=lefts.__getitem__)
        near = [common_prefix(lefts[a], lefts[b]) for a, b in zip(order, order[1:])]
        for at, i in enumerate(order):
            best = max(near[at - 1] if at else 0, near[at] if at < len(near) else 0)
            if best + least >= SIDE:
                old = found[i] or (0, 0)
                found[i] = (max(best, old[0]), max(least, old[1]))
        start = low
        for i in range(low + 1, high + 1):
            if i == high or shares[i] == least:
                todo.append((start, i))
                start = i
    return found


def _runs(buckets: int):
    """Texts with their anchors to front-coded runs (bucket, run) of this task."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes: dict[int, dict[tuple, list]] = {}
        size = 0

        def flush():
            keys = sorted(classes)
            blobs = [
                front_coded([(key, left, members) for (key, left), members in sorted(classes[b].items())]) for b in keys
            ]
            classes.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(blobs, pa.binary())], ["bucket", "run"])

        for batch in batches:
            for row in range(batch.num_rows):
                t1, t2, text, places = (batch.column(i)[row].as_py() for i in range(4))
                for place in places:
                    if place["hot"]:
                        continue
                    pos, h = place["pos"], place["h"]
                    head = (h + (1 << 63)).to_bytes(8, "big") + xxhash.xxh3_64_digest(text[pos : pos + GRAM])
                    key = head + text[pos + GRAM : pos + LENGTH]
                    left = text[max(0, pos - SIDE) : pos][::-1]
                    group = classes.setdefault(h % buckets, {})
                    members = group.setdefault((key, left), [])
                    if (t1, t2, pos) not in members[-1:]:
                        members.append((t1, t2, pos))
                    size += len(key) + len(left) + 24
                if size >= RUN_BYTES:
                    yield flush()
                    size = 0
        if classes:
            yield flush()

    return runs


def _spans(frame: pd.DataFrame) -> pd.DataFrame:
    """All runs of a bucket to repeated spans (t1, t2, first, last) around anchors."""
    out = []
    group: list[tuple] = []

    def close():
        found = reaches(
            [g[0] for g in group], [g[2] for g in group], [len(g[3]) for g in group], [len(g[1]) - HEAD for g in group]
        )
        for (_, _, _, members), reach in zip(group, found):
            if reach:
                out.extend((t1, t2, pos - reach[0], pos + GRAM + reach[1]) for t1, t2, pos in members)

    lefts: dict[bytes, int] = {}  # entries of the string at hand, by the text on their left
    for shared, string, (left, members) in merged(list(frame["run"])):
        if group and shared < HEAD:
            close()
            group = []
        if not (group and shared == len(string) == len(group[-1][1])):
            lefts = {}
        if left in lefts:
            known = group[lefts[left]][3]
            known.extend(m for m in members if m not in known[-1:])
            continue
        lefts[left] = len(group)
        group.append((max(shared - HEAD, 0), string, left, list(members)))
    if group:
        close()
    return pd.DataFrame(out, columns=["t1", "t2", "first", "last"], dtype="int64")


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The bytes around places, some ``PIECE`` at once, and one column for each place.

    Columns hold the text's two hashes, what to add for a position in the text, where the
    text at hand begins and ends, the place, its gram and its block.
    """
    parts, columns, size = [], [], 0
    for batch in batches:
        for row in range(batch.num_rows):
            t1, t2, text, places = (batch.column(i)[row].as_py() for i in range(4))
            low = 0
            while low < len(places):
                begin, high = max(0, places[low]["pos"] - SIDE), low
                while high < len(places) and places[high]["pos"] < places[low]["pos"] + PIECE:
                    high += 1
                part = text[begin : places[high - 1]["pos"] + LENGTH]
                shift = begin - size
                columns += [(t1, t2, shift, size, size + len(part), p["pos"] - shift, p["h"], p["k"]) for p in places[low:high]]
                parts.append(part)
                size += len(part)
                low = high
                if size >= PIECE:
                    yield np.frombuffer(b"".join(parts), np.uint8), np.array(columns, np.int64).T
                    parts, columns, size = [], [], 0
    if parts:
        yield np.frombuffer(b"".join(parts), np.uint8), np.array(columns, np.int64).T


def _hashed(rolling: Rolling, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    out = np.zeros(len(starts), np.uint64)
    for length in np.unique(lengths):
        these = lengths == length
        out[these] = rolling.hashes(data, int(length))[starts[these]]
    return out.view(np.int64)


def _batch(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns.values()], list(columns))


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans with those that meet or overlap made one."""
    out: list[tuple[int, int]] = []
    for first, last in spans:
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


_SPANS = "array<struct<first: long, last: long>>"
_WINDOWS = f"t1 long, t2 long, pos long, h long, left long, w1 long, w2 long, times long, spans {_SPANS}"


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with their places to one row for each window that differs in its bytes or in its place in them.

    Rows have the first such place of the text, the hashes (w1, w2) of the window, how often the text
    has it, and the spans it covers.
    """
    kinds = [pa.int64()] * 8 + [pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))]
    for batch in batches:
        out: tuple[list, ...] = tuple([] for _ in kinds)
        for row in range(batch.num_rows):
            t1, t2, text, places = (batch.column(i)[row].as_py() for i in range(4))
            windows: dict[tuple, tuple[int, list]] = {}
            for place in places:
                first = max(0, place["pos"] - SIDE)
                window = text[first : place["pos"] + LENGTH]
                key = (place["pos"] - first, *struct.unpack("<qq", xxhash.xxh3_128_digest(window)))
                windows.setdefault(key, (place["h"], []))[1].append((first, first + len(window)))
            for (left, w1, w2), (h, spans) in windows.items():
                merged_spans = [{"first": a, "last": b} for a, b in united(spans)]
                values = (t1, t2, spans[0][0] + left, h, left, w1, w2, len(spans), merged_spans)
                for column, value in zip(out, values):
                    column.append(value)
        names = ["t1", "t2", "pos", "h", "left", "w1", "w2", "times", "spans"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)


_BLOCKS = "h long, k long, c1 long, c2 long, u1 long, u2 long, t1 long, t2 long, pos long"


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of what the strings of each block share (c1, c2) and of all their bytes (u1, u2).

    Block k of an anchor holds the strings that begin k * BLOCK and up to BLOCK - 1 more
    bytes before it. Equal strings meet in one block of one gram.
    """
    one, two = Rolling(2), Rolling(3)
    low = np.arange(0, SIDE + 1, BLOCK)
    high = np.minimum(low + BLOCK - 1, SIDE)
    for data, (t1, t2, shift, begin, end, at, h, _) in _gathered(batches):
        place, text, rest = at[:, None], begin[:, None], end[:, None]
        any_string = np.maximum(low, place + LENGTH - rest) <= np.minimum(high, place - text)
        i, k = np.nonzero(any_string)
        width = (high - low)[k]
        core = at[i] - low[k]
        whole = (at[i] - high[k] >= begin[i]) & (core + LENGTH <= end[i])
        columns = {"h": h[i], "k": k, "c1": _hashed(one, data, core, LENGTH - width), "c2": _hashed(two, data, core, LENGTH - width)}
        for name, rolling in (("u1", one), ("u2", two)):
            found = np.ma.masked_all(len(i), np.int64)
            found[whole] = _hashed(rolling, data, (core - width)[whole], (LENGTH + width)[whole])
            columns[name] = found
        columns |= {"t1": t1[i], "t2": t2[i], "pos": (at + shift)[i]}
        yield _batch(columns)


_STRINGS = "h long, k long, w1 long, w2 long, t1 long, t2 long, pos long"


def _string_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes (w1, w2) of every string of the given blocks; k is now the distance to the anchor."""
    one, two = Rolling(2), Rolling(3)
    for data, (t1, t2, shift, begin, end, at, h, block) in _gathered(batches):
        before = block[:, None] * BLOCK + np.arange(BLOCK)
        start = at[:, None] - before
        i, j = np.nonzero((before <= SIDE) & (start >= begin[:, None]) & (start + LENGTH <= end[:, None]))
        start = start[i, j]
        lengths = np.full(len(start), LENGTH)
        columns = {"h": h[i], "k": before[i, j], "w1": _hashed(one, data, start, lengths), "w2": _hashed(two, data, start, lengths)}
        yield _batch(columns | {"t1": t1[i], "t2": t2[i], "pos": start + shift[i]})


def _grouped(rows: DataFrame, groups: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Stored ``rows`` with the columns of their group, ``groups`` being stored with one row a key and its size ``n``.

    Groups of more rows than ``HOT`` are few enough for a broadcast, or else the larger of them.
    """
    most = max(HOT, rows.count() // BROADCAST_ROWS)
    large = groups.where(F.col("n") > most)
    large = F.broadcast(local_frame(rows.sparkSession, large.collect(), large.schema))
    rest = rows.join(large.select(*keys), keys, "left_anti").join(groups.where(F.col("n") <= most).hint("merge"), keys, how)
    return rows.join(large, keys).unionByName(rest)


def _frequent(some: DataFrame) -> DataFrame:
    """Repeated spans (t1, t2, first, last) around hot anchors of texts with their places.

    One place speaks for all with its window. Of the blocks whose joined bytes repeat one speaks
    for all, and only if blocks with the same common bytes differ beyond them.
    """

    def texts_of(places: DataFrame) -> DataFrame:
        listed = places.groupBy(*_KEY).agg(F.sort_array(F.collect_set(F.struct("pos", "h", "k"))).alias("places"))
        return some.select(*_KEY, "text").join(listed.hint("merge"), _KEY).select(*_KEY, "text", "places")

    hot = some.select(*_KEY, "text", F.filter("places", lambda p: p["hot"]).alias("places")).where(F.size("places") > 0)
    # A place is known by its hash, so that rows that repeat a text count once.
    place = F.xxhash64(*_KEY, "pos")
    ends = [F.min(place).alias("_least"), F.max(place).alias("_most"), F.count("*").alias("n")]
    windows = stored(hot.mapInArrow(_window_rows, _WINDOWS), "substrings-windows")
    keys = ["left", "w1", "w2"]
    one = F.min(F.struct(place.alias("place"), *_KEY, "pos", "h")).alias("_one")
    again = (F.max(place) != F.min(place)) | (F.max("times") > 1)
    classes = stored(windows.groupBy(*keys).agg(one, again.alias("_again"), F.count("*").alias("n")), "substrings-classes")
    same = _grouped(windows, classes.where("_again").select(*keys, "n"), keys)
    same = same.select(*_KEY, F.explode("spans").alias("s")).select(*_KEY, "s.first", "s.last")
    speakers = classes.select("_one.t1", "_one.t2", "_one.pos", "_one.h", F.lit(0).alias("k"))
    blocks = stored(texts_of(speakers).mapInArrow(_block_rows, _BLOCKS), "substrings-blocks")
    shared, joined = ["h", "k", "c1", "c2"], ["h", "k", "u1", "u2"]
    differ = (F.count("u1") < F.count("*")) | (F.min("u1") != F.max("u1")) | (F.min("u2") != F.max("u2"))
    cores = blocks.groupBy(*shared).agg(*ends, differ.alias("_differ")).where("_least != _most").drop("_least", "_most")
    whole = blocks.where("u1 IS NOT NULL").groupBy(*joined).agg(*ends).where("_least != _most").drop("_most")
    found = stored(_grouped(blocks, stored(cores, "substrings-cores"), shared).drop("n"), "substrings-shared")
    found = _grouped(found, stored(whole, "substrings-whole"), joined, "left")
    speaks = F.col("_differ") & F.coalesce(F.col("_least") == place, F.lit(True))
    found = found.select(*_KEY, "pos", "h", "k", F.col("_least").isNotNull().alias("whole"), speaks.alias("speaks"))
    found = stored(found, "substrings-found")
    first = F.col("pos") - F.least(F.col("k") * BLOCK + BLOCK - 1, F.lit(SIDE))
    inner = found.where("whole").select(*_KEY, first.alias("first"), (F.col("pos") - F.col("k") * BLOCK + LENGTH).alias("last"))
    edges = texts_of(found.where("speaks"))
    strings = stored(edges.mapInArrow(_string_rows, _STRINGS), "substrings-strings")
    keys = ["h", "k", "w1", "w2"]
    twice = strings.groupBy(*keys).agg(*ends).where("_least != _most").select(*keys, "n")
    outer = _grouped(strings, stored(twice, "substrings-twice"), keys)
    outer = outer.select(*_KEY, F.col("pos").alias("first"), (F.col("pos") + LENGTH).alias("last"))
    return same.unionByName(inner).unionByName(outer)


def _united_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spans of each text (t1, t2, spans) in order, with those that meet or overlap made one."""
    for batch in batches:
        spans = [
            [{"first": a, "last": b} for a, b in united(sorted((s["first"], s["last"]) for s in row.as_py()))]
            for row in batch.column(2)
        ]
        kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, kind)], ["t1", "t2", "spans"])


def _outside(text: Column, spans: Column) -> Column:
    """The bytes of ``text`` between ``spans``, joined. As strings they are joined byte by byte, whole characters or not."""
    begin = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans, lambda s: s["last"]))
    end = F.concat(F.transform(spans, lambda s: s["first"]), F.array(F.octet_length(text).cast("long")))
    piece = lambda a, b: F.substring(text, (a + 1).cast("int"), (b - a).cast("int")).cast("string")
    return F.array_join(F.zip_with(begin, end, piece), "").cast("binary")


def cut_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) for every row of ``docs``.

    ``spans`` are the maximal removed runs of bytes, from first up to but without last, and ``kept`` holds the
    remaining bytes; a cut may lie inside a character.
    """
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    keyed = docs.select(
        "doc_id",
        F.xxhash64(text).alias("t1"),
        F.xxhash64(F.lit(1), text).alias("t2"),
        text.alias("text"),
    )
    rows = stored(keyed.select("doc_id", *_KEY), "substrings-rows")
    texts = rows.groupBy(*_KEY).agg(F.count("*").alias("n"), F.min("doc_id").alias("_one"))
    places = stored(keyed.select(*_KEY, "text").mapInArrow(_anchor_rows, "t1 long, t2 long, pos long, h long"), "substrings-anchors")
    counts = places.groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    # Merge joins at every size but for large groups: none of these sides is bounded.
    repeated = _grouped(places, stored(counts, "substrings-counts"), ["h"]).select(*_KEY, F.struct("pos", "h", (F.col("n") > HOT).alias("hot")).alias("place"))
    # Rows that repeat a text give its anchors more than once.
    repeated = repeated.groupBy(*_KEY).agg(F.collect_set("place").alias("places"))
    one = texts.join(repeated, _KEY).select(*_KEY, "_one", F.sort_array("places").alias("places"))
    k, o = keyed.alias("k"), one.alias("o")
    on = (F.col("k.t1") == F.col("o.t1")) & (F.col("k.t2") == F.col("o.t2")) & F.col("k.doc_id").eqNullSafe(F.col("o._one"))
    some = stored(k.join(o.hint("merge"), on).select("k.t1", "k.t2", "text", "places"), "substrings-texts")
    cold = F.size(F.filter("places", lambda p: ~p["hot"]))
    suffixes = some.agg(F.sum(cold)).first()[0] or 0
    buckets = max(2 * partitions(docs), suffixes * (LENGTH + SIDE) // BUCKET_BYTES)
    runs = some.mapInArrow(_runs(buckets), "bucket int, run binary")
    spans = runs.groupBy("bucket").applyInPandas(_spans, "t1 long, t2 long, first long, last long")
    spans = spans.unionByName(_frequent(some)).groupBy(*_KEY).agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    # The spans of a text that occurs once; one that occurs again is removed whole or too short.
    spans = spans.mapInArrow(_united_rows, f"t1 long, t2 long, spans {_SPANS}")
    known = texts.select(*_KEY, "n").join(spans.hint("merge"), _KEY, "left").where("n > 1 OR spans IS NOT NULL")
    found = _grouped(keyed, stored(known, "substrings-known"), _KEY, "left")
    size = F.octet_length("text").cast("long")
    whole = (F.col("n") > 1) & (size >= LENGTH)
    none = F.array().cast(_SPANS)
    all_of_it = F.array(F.struct(F.lit(0).cast("long").alias("first"), size.alias("last")))
    spans = F.when(whole, all_of_it).when(F.col("n") == 1, F.col("spans")).otherwise(none)
    found = found.select("doc_id", size.alias("n_bytes"), spans.alias("spans"), "text")
    kept = F.when(F.size("spans") == 0, F.col("text")).otherwise(_outside(F.col("text"), F.col("spans")))
    return found.select("doc_id", "n_bytes", "spans", kept.alias("kept"))


def digests(cut: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, text) of documents that ``cut_repeats`` has cut.

    ``text`` is what remains, with the characters that a cut broke replaced by U+FFFD; the other columns are of its bytes.
    """
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of ``docs``."""
    return digests(cut_repeats(docs)).drop("text")


def op9_substrings(spark, directory: str) -> DataFrame:
    return digests(cut_repeats(table(spark, directory, "documents").select("doc_id", "text")))


QUERIES = {"op9_substrings": op9_substrings}
SQL: dict[str, str] = {}
