"""License scans: places and labels against a plain scan, edited notices, awkward rows."""

import random
import re

import pytest

from docops.llm import licenses
from tests.llm.helpers import awkward_rows, frame, sentence

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
NOTICE = {label: text for label, text in licenses.STATEMENTS if label in ("mit", "apache-2.0", "isc", "gpl")}
SHORT = [s for s in licenses.STATEMENTS if len(licenses.template_words(s[1])) < licenses.LONG]


def words(text):
    return WORDS.findall((text or "").translate(LOWER))


def places(text, phrase):
    have, want = words(text), words(phrase)
    return [i for i in range(len(have) - len(want) + 1) if have[i : i + len(want)] == want]


def plain(text, extra=()):
    """(n_words, n_base, first, last, base labels, labels) by looking for every template at every word."""
    found = {phrase: places(text, phrase) for phrase in licenses.PHRASES}
    starts = sorted(i for at in found.values() for i in at)
    base = sorted({licenses.PHRASES[p] for p, at in found.items() if at})
    labels = sorted({*base, *extra, *(label for label, s in SHORT if places(text, s))})
    first, last = (starts[0], starts[-1]) if starts else (None, None)
    return len(words(text)), len(starts), first, last, ",".join(base), ",".join(labels)


def found(df):
    names = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def statements():
    rng = random.Random(5)
    rows = awkward_rows()
    texts = [
        "CC BY cc-by, CC  BY!",
        "cc cc by by",
        "ALL rights reserved. All Rights Reserved all rights",
        "general public license general public general public license",
        "Éall rights reserved",
        "all rights reservedé",
        "cc by",
        "cc2by cc by4",
        "this is under the gnu lesser general public license",
    ]
    texts += [f"{sentence(rng, 9)} {s} {sentence(rng, 9)}. {s}" for _, s in SHORT]
    rows += [(1000 + i, t, "en", "a", 1, 7, 0.5, 1, 2) for i, t in enumerate(texts)]
    return rows + rows[-3:]


def test_places_and_statements_equal_a_plain_scan(spark):
    rows = statements()
    out = licenses.scan_licenses(frame(spark, rows))
    assert found(out) == sorted(((r[0], *plain(r[1])) for r in rows), key=repr)
    assert all(0 <= r.score <= 1 and (r.score > 0) == (r.labels != "") for r in out.collect())


@pytest.mark.parametrize("label", sorted(NOTICE))
def test_edited_notices_are_found(spark, label):
    rng = random.Random(7)
    body = words(NOTICE[label])
    edited = list(body)
    for at in (len(body) // 4, len(body) // 2):
        edited[at] = "changed"
    left_out = body[: len(body) // 3] + body[len(body) // 3 + 2 :]
    put_in = body[: len(body) // 3] + ["two", "more"] + body[len(body) // 3 :]
    half = body[: len(body) // 2]
    shuffled = rng.sample(body, len(body))
    around = [sentence(rng, 50), sentence(rng, 50)]
    texts = [" ".join([around[0], *t, around[1]]) for t in (body, edited, left_out, put_in, half, shuffled)]
    out = licenses.scan_licenses(frame(spark, [(i, t, "en", "a", 1, 7, 0.5, 1, 2) for i, t in enumerate(texts)]))
    rows = {r.doc_id: r for r in out.collect()}
    assert all(label in rows[i].labels.split(",") for i in range(4))
    # The first half of two notices holds a phrase or a short statement of the same label.
    without = (5,) if label in ("gpl", "apache-2.0") else (4, 5)
    assert not any(label in rows[i].labels.split(",") for i in without)
    assert rows[0].score > 0.99 and rows[0].score >= rows[1].score >= licenses.MIN_SHARE * 0.99


def test_spans_say_where(spark):
    rng = random.Random(8)
    text = f"{sentence(rng, 30)} {NOTICE['mit']} {sentence(rng, 40)} {NOTICE['mit']} {sentence(rng, 3)}"
    spans = licenses.license_spans(frame(spark, [(1, text, "en", "a", 1, 7, 0.5, 1, 2)])).where("label = 'mit'").collect()
    size = len(words(NOTICE["mit"]))
    assert sorted((s.start, s.n_words, s.n_covered) for s in spans) == [(30, size, size), (70 + size, size, size)]


def test_own_templates_nulls_and_names(spark):
    docs = frame(spark, awkward_rows()).selectExpr("*", "1 AS labels", "2 AS _w", "'x' AS _doc", "3 AS n_words", "4 AS _h")
    assert licenses.scan_licenses(docs).count() == docs.count()
    one = spark.createDataFrame([(1, "a b"), (None, "b a b"), (2, None)], "doc_id long, text string")
    out = licenses.scan_licenses(one, {"a b": "x"}, [("y", "B"), ("z", "...")])
    assert found(out) == sorted([(1, 2, 1, 0, 0, "x", "x,y"), (None, 3, 1, 1, 1, "x", "x,y"), (2, 0, 0, None, None, "", "")], key=repr)
    none = licenses.scan_licenses(one, {}, [])
    assert [r.labels for r in none.collect()] == [""] * 3
    assert licenses.scan_licenses(one.limit(0)).count() == 0
