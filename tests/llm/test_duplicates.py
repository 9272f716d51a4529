"""SimHash, line runs and repeated strings against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from docops.llm import graph, linedup, simhash, substrings
from tests.llm.helpers import awkward_rows, frame


def slow_print(text):
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(found[i : i + 4]), 42) for i in range(max(1, len(found) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(prints, distance=4):
    groups = list(range(len(prints)))

    def find(i):
        while groups[i] != i:
            i = groups[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                groups[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_simhash_equals_brute_force(spark):
    rows = awkward_rows()
    out = simhash.near_duplicates(frame(spark, rows)).collect()
    prints = [slow_print(r[1]) for r in rows]
    group = slow_groups(prints)
    least = defaultdict(lambda: None)
    for g, r in zip(group, rows):
        if r[0] is not None:
            least[g] = r[0] if least[g] is None else min(least[g], r[0])
    expected = Counter((r[0], f"{p:016x}", least[g]) for r, p, g in zip(rows, prints, group))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in out) == expected


def test_one_document_of_each_group_stays(spark):
    rows = awkward_rows() + [(None, "another text without an id", *[None] * 7)]
    out = simhash.one_of_each(frame(spark, rows)).collect()
    group = dict(zip(((r[0], r[1]) for r in rows), slow_groups([slow_print(r[1]) for r in rows])))
    kept = Counter(group[r.doc_id, r.text] for r in out)
    assert set(kept) == set(group.values()) and set(kept.values()) == {1}
    least = {}
    for (doc, _), g in group.items():
        if doc is not None:
            least[g] = min(least.get(g, doc), doc)
    assert all(r.doc_id == least.get(group[r.doc_id, r.text]) for r in out)


@pytest.mark.parametrize("chunk", [4, 1024])
def test_links_in_large_segments(spark, monkeypatch, chunk):
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    monkeypatch.setattr(simhash, "LARGE", 16 * chunk)
    rng = np.random.default_rng(1)
    codes = {int(c) for c in rng.integers(0, 1 << 63, 40)}
    for center in list(codes)[:6]:
        for _ in range(60):
            flips = rng.choice(64, rng.integers(1, 6), replace=False)
            codes.add(center ^ sum(1 << int(f) for f in flips))
    codes = sorted(codes)
    signed = [c - (1 << 64) if c >= 1 << 63 else c for c in codes]
    links = simhash.near_links(spark.createDataFrame([(c,) for c in signed], "fp long"))
    roots = dict(map(tuple, graph.components(links).collect()))
    expected = slow_groups(codes)
    found = [roots.get(c, c) for c in signed]
    assert len(set(zip(expected, found))) == len(set(expected)) == len(set(found))


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 560)] + [(7, 7)]
    out = dict(map(tuple, graph.components(spark.createDataFrame(chain + star, "a long, b long")).collect()))
    assert out == {**{i: 100 for i in range(101, 161)}, **{i: 500 for i in range(501, 560)}}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("depth", [1, 2, 3, 5])
def test_lines_equal_brute_force(spark, depth):
    rows = [r for r in awkward_rows() if r[0] != 3]  # ids with two texts are ordered by a hash
    out = linedup.delete_repeats(frame(spark, rows), depth).collect()
    texts = {(r[0], r[1]) for r in rows if r[1] is not None}
    numbered = {}
    windows = defaultdict(list)
    for doc, text in texts:
        lines = [(i, l) for i, l in enumerate(text.split("\n")) if l.strip(" \t\n\x0b\x0c\r")]
        numbered[doc, text] = lines
        for at in range(len(lines) - depth + 1):
            key = tuple(l for _, l in lines[at : at + depth])
            windows[key].append((doc is not None, doc or 0, at, text, doc))
    gone = defaultdict(set)
    for places in windows.values():
        for _, _, at, text, doc in sorted(places)[1:]:
            gone[doc, text] |= {numbered[doc, text][at + j][0] for j in range(depth)}
    expected = Counter()
    for r in rows:
        if r[1] is None:
            expected[r[0], None, 0, 0] += 1
            continue
        key = (r[0], r[1])
        kept = "\n".join(l for i, l in enumerate(r[1].split("\n")) if i not in gone[key])
        expected[r[0], kept, len(numbered[key]), len(gone[key])] += 1
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_removed) for r in out) == expected


def test_lines_of_an_empty_table_and_one_id_with_two_texts(spark):
    assert linedup.delete_repeats(frame(spark, [])).count() == 0
    rows = [(3, "a\nb\nc\nd", *[None] * 7), (3, "x\na\nb\nc", *[None] * 7)]
    out = {r.text for r in linedup.delete_repeats(frame(spark, rows), 3).collect()}
    assert out in ({"d", "x\na\nb\nc"}, {"a\nb\nc\nd", "x"})


def slow_strings(rows, length=substrings.LENGTH):
    texts = [(r[1] or "").encode() for r in rows]
    seen = Counter()
    for t in texts:
        seen.update(t[i : i + length] for i in range(len(t) - length + 1))
    for t in texts:
        spans = []
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + length
                else:
                    spans.append([i, i + length])
        kept, at = b"", 0
        for a, b in spans:
            kept, at = kept + t[at:a], b
        kept += t[at:]
        yield len(t), len(t) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("hot", [1, 1000])
def test_strings_equal_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(substrings, "HOT", hot)
    rows = [r for r in awkward_rows() if r[0] != 905]
    out = substrings.remove_repeats(frame(spark, rows)).collect()
    expected = Counter((r[0], *x) for r, x in zip(rows, slow_strings(rows)))
    assert Counter(tuple(r) for r in out) == expected


@pytest.mark.parametrize("hot", [1, 3, 1000])
def test_passages_of_any_length_at_any_place(spark, monkeypatch, hot):
    """Cut passages around the length: blocks that repeat whole, at their edges, and not at all."""
    monkeypatch.setattr(substrings, "HOT", hot)
    rng = np.random.default_rng(hot)
    letters = lambda n: "".join(chr(97 + int(x)) for x in rng.integers(0, 26, n))
    passages = [letters(1200), "ab" * 500]
    rows = []
    for i in range(60):
        passage = passages[i % 5 == 0]
        low = int(rng.integers(0, 500))
        part = passage[low : low + int(rng.integers(380, 700))]
        rows.append((i, letters(int(rng.integers(0, 300))) + part + letters(int(rng.integers(0, 300))), *[None] * 7))
    out = substrings.remove_repeats(frame(spark, rows)).collect()
    assert Counter(tuple(r) for r in out) == Counter((r[0], *x) for r, x in zip(rows, slow_strings(rows)))


def test_strings_of_an_empty_table(spark):
    assert substrings.remove_repeats(frame(spark, [])).count() == 0


def test_merge_of_front_coded_runs():
    rng = np.random.default_rng(2)
    strings = [bytes(rng.integers(97, 99, rng.integers(0, 12)).astype(np.uint8)) for _ in range(300)]
    for count in (1, 2, 5, 8):
        runs = [substrings.front_coded([(s, i) for i, s in enumerate(sorted(strings[k::count]))]) for k in range(count)]
        out = list(substrings.merged(runs))
        assert [s for _, s, _ in out] == sorted(strings)
        last = b""
        for shared, string, _ in out:
            assert shared == substrings.common_prefix(last, string)
            last = string


def test_long_texts_are_hashed_in_pieces(spark, monkeypatch):
    rng = np.random.default_rng(3)
    block = "".join(chr(97 + int(x)) for x in rng.integers(0, 26, 1500))
    noise = ["".join(chr(97 + int(x)) for x in rng.integers(0, 26, 2000)) for _ in range(4)]
    rows = [(1, noise[0] + block + noise[1]), (2, noise[2] + block[:700] + noise[3])]
    rows = [(*r, *[None] * 7) for r in rows]
    monkeypatch.setattr(substrings, "PIECE", 500)
    out = substrings.remove_repeats(frame(spark, rows)).collect()
    assert Counter(tuple(r) for r in out) == Counter((r[0], *x) for r, x in zip(rows, slow_strings(rows)))


def test_equal_windows_are_compared_once(spark, monkeypatch):
    """What repeats around frequent anchors: rows follow the windows that differ, not the places."""
    rng = np.random.default_rng(6)
    letters = lambda n: "".join(chr(97 + int(x)) for x in rng.integers(0, 26, n))
    passage = letters(4000)
    rows = [(i, letters(50) + passage + letters(50), *[None] * 7) for i in range(40)]
    rows += [(100 + i, "ab" * (600 + i), *[None] * 7) for i in range(5)]
    kept = {}

    def spy(df, name, real=substrings.stored):
        kept[name] = real(df, name)
        return kept[name]

    monkeypatch.setattr(substrings, "HOT", 10)
    monkeypatch.setattr(substrings, "stored", spy)
    out = substrings.remove_repeats(frame(spark, rows)).collect()
    assert Counter(tuple(r) for r in out) == Counter((r[0], *x) for r, x in zip(rows, slow_strings(rows)))
    places = kept["substrings-anchors"].count()
    assert places > 2000
    assert all(kept[name].count() < 2 * places for name in ("substrings-windows", "substrings-blocks", "substrings-found"))


@pytest.mark.parametrize("hot", [2, 100])
def test_rows_of_large_groups_are_joined_once(spark, monkeypatch, hot):
    """Groups above and below the bound of the broadcast, groups that are missing, and keys that are null."""
    monkeypatch.setattr(substrings, "HOT", hot)
    values = [(1, i) for i in range(9)] + [(2, 20), (2, 21), (3, 30), (None, 40)]
    rows = spark.createDataFrame(values, "h long, pos long")
    groups = rows.where("h < 3").groupBy("h").agg(F.count("*").alias("n"))
    sizes = {1: 9, 2: 2}
    for how in ("inner", "left"):
        out = substrings._grouped(rows, groups, ["h"], how).collect()
        expected = Counter((h, p, sizes.get(h)) for h, p in values if how == "left" or h in sizes)
        assert Counter((r.h, r.pos, r.n) for r in out) == expected
    calls, real = [], substrings._grouped
    monkeypatch.setattr(substrings, "_grouped", lambda rows, groups, keys, *how: calls.append(keys) or real(rows, groups, keys, *how))
    substrings.remove_repeats(frame(spark, [(i, "ab" * 300, *[None] * 7) for i in range(3)]))
    assert ["h"] in calls  # the anchors of one gram too


def slow_cuts(rows, length=substrings.LENGTH):
    """(spans, remaining bytes) of every row."""
    texts = [(r[1] or "").encode() for r in rows]
    seen = Counter()
    for t in texts:
        seen.update(t[i : i + length] for i in range(len(t) - length + 1))
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"x" * length
        spans = [m.span() for m in re.finditer(rb"x+", gone)]
        yield tuple(spans), bytes(b for b, g in zip(t, gone) if not g)


def passage_rows():
    """Passages of over 50 words in several documents, cut inside characters, beside copies and clean documents."""
    rng = np.random.default_rng(8)
    letters = lambda n: "".join(chr(97 + int(x)) for x in rng.integers(0, 26, n))
    words = lambda n: " ".join(letters(8) for _ in range(n))
    passage, wide = words(60), "".join(chr(0x4E00 + int(x)) for x in rng.integers(0, 5000, 300))
    rows = [(i, f"{words(20)} {passage} {words(20 + i)}") for i in range(6)]
    # The characters before the passage differ in their first byte only: the cut begins inside them.
    rows += [(10, "a\u4e01" + wide + "z"), (11, "b\u5e01" + wide + "y")]
    rows += [(20 + i, words(70)) for i in range(6)] + [(30, words(70) + "\u6f22" * 5)]
    rows += [(40 + i, "x" + passage[:380]) for i in range(3)]  # copies below the length
    rows += [(50 + i % 2, f"{passage} {wide}") for i in range(4)] + [(60, None), (61, ""), (None, passage), (None, None)]
    return [(*r, *[None] * 7) for r in rows], passage


@pytest.mark.parametrize("hot", [1, 3, 1000])
def test_texts_and_spans_left_by_the_cut(spark, monkeypatch, hot):
    monkeypatch.setattr(substrings, "HOT", hot)
    for rows in (passage_rows()[0], [r for r in awkward_rows() if r[0] != 905]):
        out = substrings.cut_repeats(frame(spark, rows)).collect()
        found = Counter((r.doc_id, r.n_bytes, tuple(tuple(s) for s in r.spans), bytes(r.kept)) for r in out)
        assert found == Counter((r[0], len((r[1] or "").encode()), *x) for r, x in zip(rows, slow_cuts(rows)))


def test_planted_passages_are_gone_from_the_query(spark, tmp_path):
    """The remaining text itself shows which passages went and which documents were left alone."""
    rows, passage = passage_rows()
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    out = substrings.op9_substrings(spark, str(tmp_path))
    assert out.columns[:5] == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    out = out.collect()
    kept = [x[1] for x in slow_cuts(rows)]
    # Broken characters are replaced in the text only; the digest is of the bytes.
    assert any("\ufffd" in r.text for r in out)
    assert Counter((r.doc_id, r.text, r.kept_sha256) for r in out) == Counter(
        (r[0], k.decode(errors="replace"), hashlib.sha256(k).hexdigest()) for r, k in zip(rows, kept)
    )
    assert not any(passage in r.text for r in out)
    clean = {r[0]: r[1] for r in rows if r[0] is not None and 20 <= r[0] < 50}
    assert {r.doc_id: r.text for r in out if r.doc_id in clean} == clean
