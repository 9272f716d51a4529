"""Small documents with every awkward case, and plain versions of what operators share."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, score double, h long, n long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def awkward_rows(seed=3, count=120):
    """Nulls, empty and long texts, repeated rows and ids, shared lines, copies and near copies."""
    rng = random.Random(seed)
    shared = [sentence(rng, 12) for _ in range(6)]
    passage = sentence(rng, 120)
    rows = []
    for i in range(count):
        lines = [sentence(rng, rng.randrange(1, 40)) for _ in range(rng.randrange(1, 6))]
        if i % 5 == 0:
            lines[1:1] = shared[:4]
        if i % 7 == 0:
            lines.append(f"{sentence(rng, 3)} {passage} {sentence(rng, 3)}")
        rows.append((i, "\n".join(lines), ["en", "de", None][i % 3], ["a", "b", None, "a", "a"][i % 5]))
    rows += [(200 + i, rows[i][1], "en", "a") for i in range(0, 40, 4)]  # exact copies
    rows += [(300 + i, rows[i][1] + " w1", "en", "b") for i in range(0, 40, 4)]  # near copies
    rows += [rows[0], rows[0], (3, "another text with the same id", "en", "a")]
    rows += [(None, "no id here", None, None), (None, None, None, None), (900, None, "en", "a"), (901, "", "en", "a")]
    rows += [(902, " \n\t ", "xx", "b"), (903, "ab " * 4000, "en", "a"), (904, "Ünïcödé 漢字 🙂 " * 60, "en", "c")]
    rows += [(905, "\n".join(sentence(rng, 9) for _ in range(3000)), "en", "a")]
    rows += [(906, "one\ntwo\nthree\none\ntwo\nthree\none\ntwo\nthree", "en", "a")]
    return [(*r, len(r[1]) if r[1] else None, 7, 0.5, 1, 2) for r in rows]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)
