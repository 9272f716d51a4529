"""Packing against brute force, mixing against its contract."""

from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from docops.llm import mixing, packing
from tests.llm.helpers import awkward_rows, frame, words


def padding_of(lengths, widths):
    return sum(min(w for w in widths if w >= n) - n for n in lengths)


@pytest.mark.parametrize("seed", range(5))
def test_widths_are_optimal(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(0, 25, 60)
    widths, counts = np.unique(lengths, return_counts=True)
    for buckets in (1, 2, 3, 4):
        chosen = packing.best_widths(widths, counts, widths * counts, buckets)
        best = min(
            padding_of(lengths, [*c, widths[-1]]) for c in combinations(widths[:-1], min(buckets, len(widths)) - 1)
        )
        assert len(chosen) == min(buckets, len(widths)) and padding_of(lengths, chosen) == best


def test_every_row_has_a_place(spark):
    rows = awkward_rows()
    out = packing.pack(frame(spark, rows), buckets=4, budget=300).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in out) == Counter((r[0], len(words(r[1]))) for r in rows)
    batches = defaultdict(list)
    for r in out:
        assert 0 <= r.padding == r.width - r.n_tokens
        batches[r.bucket, r.batch].append(r)
    for (bucket, batch), members in batches.items():
        assert sorted(r.slot for r in members) == list(range(len(members)))
        assert len(members) == 1 or len(members) * members[0].width <= 300 or members[0].width == 0
        full = max(1, 300 // max(1, members[0].width))
        assert len(members) == full or batch == max(b for k, b in batches if k == bucket)


def test_long_lengths_are_binned_upwards(spark):
    frame_ = spark.createDataFrame([(i, n) for i, n in enumerate([8191, 8192, 8193, 1_000_003])], "doc_id long, n_tokens long")
    assert all(r.padding >= 0 for r in packing.pack_lengths(frame_, 3).collect())


def test_empty_table(spark):
    empty = frame(spark, [])
    assert packing.pack(empty).count() == 0
    assert mixing.mix(empty).count() == 0


def test_mix_meets_its_targets(spark):
    rows = awkward_rows(count=400)
    df = frame(spark, rows)
    out = mixing.mix(df).collect()
    assert len(out) == len(rows)
    assert sorted(map(repr, out)) == sorted(map(repr, mixing.mix(df.repartition(3)).collect()))
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    weight = dict(zip(sorted(filter(None, sizes)) + [None], [5, 2, 1, 5]))
    level, capped = None, set()
    while True:  # the plain rule: share by weight, cap, share the excess again
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in capped)
        level = left / sum(w for s, w in weight.items() if s not in capped)
        over = {s for s in sizes if s not in capped and level * weight[s] >= 2 * sizes[s]}
        if not over:
            break
        capped |= over
    taken = defaultdict(int)
    for r in out:
        expected = 2 * sizes[r.source] if r.source in capped else level * weight[r.source]
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(expected)
        assert r.size == len(words(r.text)) and r.taken == r.copies * r.size and 0 <= r.copies <= 2
        taken[r.source] += r.taken
    longest = max(len(words(r[1])) for r in rows)
    for source in sizes:
        target = next(r.target for r in out if r.source == source)
        assert abs(taken[source] - target) <= longest / 2 + 1


def test_chances_follow_size(spark):
    rows = [(i, "w " * (4 if i % 2 else 400), "en", "a", 0, 0, 0.0, 0, 0) for i in range(2000)]
    out = mixing.mix(frame(spark, rows), weights=(1,), percent=60).collect()
    short = sum(r.copies for r in out if r.size == 4)
    long = sum(r.copies for r in out if r.size == 400)
    assert 0 < short < long / 4  # expectations are in the ratio of 8 / 72 and 512 / 576
