"""Repeated runs of few lines and many words, against brute force."""

import random
from collections import Counter, defaultdict

import pytest

import corpus_pipeline as pipeline
from docops.llm import linedup
from tests.llm.helpers import awkward_rows, frame, sentence, words


def slow_cut(texts, depth, least):
    """What is left of each (id, text), and how many of its lines go."""
    numbered, gone = {}, defaultdict(set)
    for doc, text in texts:
        numbered[doc, text] = [(i, l) for i, l in enumerate(text.split("\n")) if words(l)]
    for size in range(1, depth + 1):
        windows = defaultdict(list)
        for (doc, text), lines in numbered.items():
            for at in range(len(lines) - size + 1):
                run = tuple(l for _, l in lines[at : at + size])
                if size == depth or sum(len(words(l)) for l in run) > least:
                    windows[run].append((doc is not None, doc or 0, at, text, doc))
        for places in windows.values():
            for _, _, at, text, doc in sorted(places)[1:]:
                gone[doc, text] |= {numbered[doc, text][at + j][0] for j in range(size)}
    kept = {k: "\n".join(l for i, l in enumerate(k[1].split("\n")) if i not in gone[k]) for k in numbered}
    return {k: (kept[k], len(numbered[k]), len(gone[k])) for k in numbered}


def long_lines():
    """Runs of one and two lines around the bound of fifty words, between lines of their own."""
    rng = random.Random(8)
    rows, own = [], lambda: sentence(rng, 9, 10**6)
    for i, sizes in enumerate([(51,), (50,), (26, 25), (25, 25), (49, 2), (60, 60), (20, 20, 20), (10, 10)]):
        run = [sentence(rng, n, 10**6) for n in sizes]
        rows += [(2000 + 10 * i, "\n".join([own(), *run, own()])), (2001 + 10 * i, "\n".join([*run, own()]))]
        rows += [(2002 + 10 * i, "\n".join(run)), (2003 + 10 * i, "\n \n".join(run))]
    return [(*r, *[None] * 7) for r in rows]


@pytest.mark.parametrize("depth", [1, 3, 5])
def test_words_and_lines_equal_brute_force(spark, depth):
    rows = [r for r in awkward_rows() if r[0] != 3] + long_lines()  # ids with two texts are ordered by a hash
    out = linedup.delete_repeats(frame(spark, rows), depth, 50).collect()
    cut = slow_cut({(r[0], r[1]) for r in rows if r[1] is not None}, depth, 50)
    expected = Counter((r[0], *(cut[r[0], r[1]] if r[1] is not None else (None, 0, 0))) for r in rows)
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_removed) for r in out) == expected


def test_stage_drops_long_passages_of_one_and_two_lines(spark):
    rows = [r[:5] for r in long_lines()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = {r.doc_id: r.text for r in pipeline.line_dedup(spark, docs, "").collect()}
    cut = slow_cut({(r[0], r[1]) for r in rows}, 3, 50)
    assert out == {k[0]: kept for k, (kept, lines, gone) in cut.items() if gone < lines or not gone}
    assert 2002 not in out and 2022 not in out and 2012 in out and 2032 in out
