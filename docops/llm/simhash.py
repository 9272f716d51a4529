"""Near-duplicates by SimHash, found in a hierarchical index over Gray-ordered fingerprints.

A fingerprint bit is the majority of that bit over the hashes of all word shingles.
Distinct fingerprints are looked at in several rotations; two that differ in at most
``distance`` bits agree in the leading bits of at least one of them, which are the leading
bits of the Gray rank too. Each such segment is sorted by Gray rank and indexed: runs of
neighbours share masked bit patterns, upper nodes hold what all their runs share, and
differences are added up on the way down, so that whole groups are left as soon as the sum
passes the distance.

* Null text counts as empty. Texts without a word have fingerprint 0, linked like any other.
* Texts shorter than a shingle are one shingle. Only A-Z are lower-cased.
* A component is named by its smallest id; rows without id get their group's, if it has one.
* Repeated rows are each returned; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docops.llm.common import set_aside, stored, table
from docops.llm.graph import components

SHINGLE = 4
DISTANCE = 4
SEED = 42
#: Fingerprints that a task compares at once; larger segments are cut and compared pair by pair.
CHUNK = 1024
#: Segments above this are first divided by a second block of bits.
LARGE = 16 * CHUNK
LEAF, NODE = 16, 256


def shingles(text: bytes | None, shingle: int) -> list[bytes]:
    """All word shingles of one text in order; a shorter text is one shingle."""
    found = (text or b"").lower().split()
    if not found:
        return []
    joined = b" ".join(found)
    if len(found) < shingle:
        return [joined]
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    first = starts[: len(found) - shingle + 1]
    last = starts[shingle:] - 1
    return [joined[a:b] for a, b in zip(first.tolist(), last.tolist())]


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of one text as a signed integer."""
    parts = shingles(text, shingle)
    if not parts:
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(parts), 1 << 15):  # bounded memory for very long texts
        some = parts[at : at + (1 << 15)]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, some, repeat(SEED)), np.uint64, len(some))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(parts), bitorder="little").view(np.int64)[0])


def _fingerprints(shingle: int):
    def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t, shingle) for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), batch.column(2), pa.array(values, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "fp"])

    return fingerprints


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Positions of 64-bit codes in the reflected Gray order."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _shared(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For runs of ``size`` codes: their starts, the mask of bits all share, and those bits."""
    starts = np.arange(0, len(codes), size)
    ones = np.bitwise_and.reduceat(codes, starts)
    zeros = np.bitwise_and.reduceat(~codes, starts)
    return starts, ones | zeros, ones


class GrayIndex:
    """Nodes over leaves over Gray-sorted codes; a leaf holds only bits its node does not."""

    def __init__(self, codes: np.ndarray):
        self.order = np.argsort(gray_rank(codes), kind="stable")
        self.codes = codes[self.order]
        self.starts, mask, self.pattern = _shared(self.codes, LEAF)
        _, self.node_mask, self.node_pattern = _shared(self.codes, NODE)
        above = self.node_mask[np.arange(len(mask)) // (NODE // LEAF)]
        self.own_mask, self.rest_mask = mask & ~above, ~mask

    def within(self, queries: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, code) of positions that differ in at most ``distance`` bits."""
        far = np.bitwise_count((queries[:, None] ^ self.node_pattern) & self.node_mask)
        query, node = np.nonzero(far <= distance)
        sums = far[query, node].astype(np.int64)
        query, leaf, sums = self._down(query, node, sums, NODE // LEAF, len(self.starts))
        sums = sums + np.bitwise_count((queries[query] ^ self.pattern[leaf]) & self.own_mask[leaf])
        near = sums <= distance
        query, leaf, sums = query[near], leaf[near], sums[near]
        query, code, sums = self._down(query, leaf, sums, LEAF, len(self.codes))
        sums = sums + np.bitwise_count((queries[query] ^ self.codes[code]) & self.rest_mask[code // LEAF])
        near = sums <= distance
        return query[near], self.order[code[near]]

    @staticmethod
    def _down(query, parent, sums, fan, count):
        child = (parent[:, None] * fan + np.arange(fan)).ravel()
        inside = child < count
        return np.repeat(query, fan)[inside], child[inside], np.repeat(sums, fan)[inside]


def spanning_links(codes: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewer links with the same components: a tree over the members of each, 32 to a parent."""
    label = np.arange(len(codes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    order = np.lexsort((codes, label))
    sizes = np.unique(label[order], return_index=True)[1]
    begin = np.repeat(sizes, np.diff(np.append(sizes, len(codes))))
    place = np.arange(len(codes)) - begin
    parent = begin + (place - 1) // 32
    child = place > 0
    return codes[order][child], codes[order][parent[child]]


def _link(distance: int):
    """Sorted rows (segment, i, j, side, code) to links between codes of each group."""

    def groups(batches):
        """One array of codes and sides for each run of equal keys, across batches."""
        key, codes, sides = None, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns[:3]], axis=0)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                this = tuple(int(c[a]) for c in columns[:3])
                if this != key:
                    if key is not None:
                        yield np.concatenate(codes), np.concatenate(sides)
                    key, codes, sides = this, [], []
                codes.append(columns[4][a:b].astype(np.int64))
                sides.append(columns[3][a:b])
        if key is not None:
            yield np.concatenate(codes), np.concatenate(sides)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes, sides in groups(batches):
            if len(codes) < 2:
                continue
            unsigned = codes.view(np.uint64)
            asked, stored_at = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
            if not len(stored_at):
                stored_at = asked
            # Few queries at a time keep the pairs of a dense group within memory.
            found = [(np.zeros(0, np.int64),) * 2]
            index = GrayIndex(unsigned[stored_at])
            for at in range(0, len(asked), 128):
                some = asked[at : at + 128]
                query, code = index.within(unsigned[some], distance)
                found.append((some[query], stored_at[code]))
            left, right = (np.concatenate(c) for c in zip(*found))
            a, b = spanning_links(codes, left, right)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return link


def _blocks(bits: int, distance: int) -> list[tuple[int, int]]:
    """``distance`` + 1 blocks (shift, width) that cover ``bits`` bits."""
    edges = [round(i * bits / (distance + 1)) for i in range(distance + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _bits(code: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(code, shift).bitwiseAND(F.lit((1 << width) - 1))


def near_links(codes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links (a, b) whose components are those of all pairs within ``distance`` bits.

    ``codes`` has one distinct fingerprint ``fp`` in a row.
    """
    code = F.col("code")
    views = []
    for shift, width in _blocks(64, distance):
        # Rotated so that the block leads: equal blocks are one range of Gray ranks.
        turn = shift + width
        turned = F.shiftleft("fp", 64 - turn).bitwiseOR(F.shiftrightunsigned("fp", turn)) if turn < 64 else F.col("fp")
        views.append(F.struct(turned.alias("code"), F.lit(turn).alias("turn"), F.lit(width).alias("width")))
    rows = codes.select(F.explode(F.array(*views)).alias("v")).select("v.*")
    lead = F.expr("shiftrightunsigned(code, 64 - width)")
    rows = rows.withColumn("segment", F.xxhash64("turn", lead))
    sizes = rows.groupBy("segment").agg(F.count("*").alias("n")).where(F.col("n") > CHUNK)
    sizes = stored(sizes, "simhash-segments")
    rows = rows.join(sizes, "segment", "left")
    # A large segment is divided once more, by blocks of the bits behind the leading one.
    inner = [F.xxhash64("segment", F.lit(s), _bits(code, s, w)) for s, w in _blocks(51, distance)]
    plain = rows.where(F.coalesce("n", F.lit(0)) <= LARGE)
    divided = rows.where(F.col("n") > LARGE).drop("n").withColumn("segment", F.explode(F.array(*inner)))
    counts = divided.groupBy("segment").agg(F.count("*").alias("n"))
    rows = plain.select("segment", "code", "turn", "n").unionByName(
        divided.join(counts, "segment").select("segment", "code", "turn", "n")
    )
    chunks = F.ceil(F.coalesce("n", F.lit(1)) / CHUNK)
    back = F.when(F.col("turn") == 64, code).otherwise(
        F.expr("shiftleft(code, turn) | shiftrightunsigned(code, 64 - turn)")
    )
    rows = rows.select("segment", back.alias("fp"), chunks.alias("chunks"))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("fp"), F.col("chunks")))
    # Chunk c meets every chunk: as the queries of pairs (c, j) and in the index of pairs (i, c).
    pairs = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1),
        lambda other: F.struct(
            F.least("chunk", other).alias("i"),
            F.greatest("chunk", other).alias("j"),
            (other < F.col("chunk")).cast("int").alias("side"),
        ),
    )
    rows = rows.select("segment", "fp", F.explode(pairs).alias("p")).select("segment", "p.*", "fp")
    keys = ["segment", "i", "j"]
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys, "side", "fp")
    return dealt.mapInArrow(_link(distance), "a long, b long")


def _grouped(docs: DataFrame, shingle: int, distance: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_hash, fp) of every row, and (fp, root, component_id) of every fingerprint."""
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"), F.xxhash64("text").alias("text_hash"))
    kind = dict(docs.dtypes)["doc_id"]
    found = texts.mapInArrow(_fingerprints(shingle), f"doc_id {kind}, text_hash long, fp long")
    prints = stored(found, "simhash-prints")
    first = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    roots = components(near_links(first.select("fp"), distance))
    rooted = first.join(roots, first["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return prints, stored(rooted.join(names, "root").select("fp", "root", "component_id"), "simhash-components")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``."""
    prints, named = _grouped(docs, shingle, distance)
    return prints.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of each component: that of the smallest id, and of a repeated id one text.

    Rows without id come last, so they are kept only where a whole component has none. Of
    rows that repeat id and text, one is kept.
    """
    prints, named = _grouped(docs.select("doc_id", "text"), shingle, distance)
    return keep_one(docs, prints, named, "fp")


def keep_one(docs: DataFrame, prints: DataFrame, named: DataFrame, key: str) -> DataFrame:
    """The rows of ``one_of_each`` for groups ``root`` of the ``key`` of each (doc_id, text_hash)."""
    chosen = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("one")
    kept = prints.join(named, key).groupBy("root").agg(chosen).select("one.doc_id", "one.text_hash")
    copies = prints.groupBy("doc_id", "text_hash").agg(F.count("*").alias("_n"))
    on = F.col("o.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("o.text_hash") == F.col("c.text_hash"))
    kept = kept.alias("o").join(copies.alias("c"), on).select("c.*")
    kept = stored(kept, "simhash-kept").alias("k")
    # Always a merge join: the side that grows with the corpus is never broadcast.
    docs, back = set_aside(docs, ("doc_id", "text"))
    same = F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.xxhash64("d.text") == F.col("k.text_hash"))
    rows = docs.alias("d").join(kept.hint("merge"), same).select("d.*", "_n")
    single = rows.where("_n = 1").drop("_n")
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    least = rows.where("_n > 1").groupBy("doc_id", "text").agg(F.min(F.struct(F.lit(0), *others)).alias("_row"))
    least = least.select("doc_id", "text", *[F.col("_row")[c].alias(c) for c in others])
    return single.unionByName(least).select(*back)


def op7_simhash(spark, directory: str) -> DataFrame:
    return near_duplicates(table(spark, directory, "documents"))


QUERIES = {"op7_simhash": op7_simhash}
SQL: dict[str, str] = {}
