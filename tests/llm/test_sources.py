"""Source audit: all terms of all pairs counted one by one."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docops.llm import sources
from tests.llm.helpers import awkward_rows, frame, sentence

WORDS = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, top):
    counts, groups, documents = defaultdict(Counter), set(), defaultdict(Counter)
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        found = WORDS.findall((text or "").translate(LOWER))
        groups.add((lang, source))
        counts[lang, source].update(found)
        documents[lang].update(set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in documents[lang].items() if n >= least]
        names = [s for g, s in groups if g == lang]
        both = sum((counts[lang, s] for s in names), Counter())

        def shares(counter):
            total = sum(counter[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (counter[t] + 5) // total for t in kept}

        p, q = {s: shares(counts[lang, s]) for s in names}, shares(both)
        for s in names:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in names if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)]
    return sorted(out)


def found(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r.rank) for r in df.collect())


def letters(n):
    return "".join(chr(97 + int(d)) for d in str(n))


def corpus(seed=2, count=90):
    """Words without digits, a source with a third of all rows, one-sided and absent words."""
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        words = [letters(int(rng.paretovariate(0.7)) % 300) for _ in range(rng.randrange(0, 60))]
        source = "hot" if i % 3 == 0 else f"s{rng.randrange(6)}"
        rows.append((i, " ".join(words).title() + " Über ÜBER", rng.choice(["en", "de"]), source, 1, 7, 0.5, 1, 2))
    rows += [(500, "", "en", "empty", 1, 7, 0.5, 1, 2), (501, "123 456", "fr", "a", 1, 7, 0.5, 1, 2), rows[0], rows[0]]
    return rows + [(502, "x", "fr", "b", 1, 7, 0.5, 1, 2), (503, None, "it", None, 1, 7, 0.5, 1, 2)]


@pytest.mark.parametrize("range_size", [1 << 16, 7])
def test_equals_counting(spark, monkeypatch, range_size):
    monkeypatch.setattr(sources, "RANGE", range_size)
    rows = corpus()
    assert found(sources.audit_sources(frame(spark, rows), 3, 6)) == plain(rows, 3, 6)


def test_awkward_rows(spark):
    rows = awkward_rows()
    docs = frame(spark, rows).selectExpr("*", "1 AS id", "2 AS total", "3 AS _w", "4 AS term", "5 AS a", "6 AS kept")
    assert found(sources.audit_sources(docs, 2, 50)) == plain(rows, 2, 50)
    alone = [(1, "one", "en", "a", 1, 7, 0.5, 1, 2)]
    assert sources.audit_sources(frame(spark, alone)).count() == 0
    assert sources.audit_sources(frame(spark, [])).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 400)), st.sets(st.integers(0, 400)), st.integers(1, 9))
def test_galloping_finds_every_place(short, long, stripe):
    before, sources.STRIPE = sources.STRIPE, stripe
    try:
        a, b = (np.array(sorted(x), dtype=np.int64) for x in (short, long))
        assert sources._gallop(a, b).tolist() == np.searchsorted(b, a).tolist()
    finally:
        sources.STRIPE = before


def test_shares_are_exact_beyond_64_bits(spark):
    cases = [(0, 5), (10**13, 3 * 10**13), (2 * 10**15, 9 * 10**15), (7, 10**15), (95, 100)]
    want = [1 + 10**9 * (n + 5) // total for n, total in cases]
    assert [int(sources._share(np.int64(n), np.int64(total))) for n, total in cases] == want
    df = spark.createDataFrame(cases, "n long, total long").select(sources._share_column("n", "total").alias("p"))
    assert sorted(r.p for r in df.collect()) == sorted(want)


def test_sentence_helper_has_no_words_of_digits():
    assert WORDS.findall(sentence(random.Random(1), 2)) == ["w", "w"]
