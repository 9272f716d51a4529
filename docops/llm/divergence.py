"""Quality rules: how far a document's histograms lie from those of its language.

Base rules count words, symbols, repeated lines and repeated three-word windows. A
document that passes them is kept unless the Jensen-Shannon distance of its characters
by class, or of its common words, from the reference of its language is too large. The
reference of a language is the sum over all its documents that pass the base rules; it is
then summed once more without those that lie too far from the first sum, so that junk does
not shape what it is judged by.

Only DataFrame functions are used, and the texts are read once.

* Null text counts as empty; a text without words fails the base rules.
* Short documents are guarded: each distance is judged only from a least length on.
* A null language is a language of its own. Languages without a word list are judged by
  their characters only.
* Repeated rows are each judged; an empty table gives an empty result. Other columns are
  ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docops.llm.common import WORD, stored, table, words
from docops.plans.skew import checked_broadcast

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
MOST_REPEATED_PERCENT = 50
#: Character classes; what is in none of them is a class too.
CLASSES = (r"\p{Ll}", r"\p{Lu}", r"\p{Nd}", SPACE, r"[.,;:!?'\"()-]")
#: The commonest words of each language.
COMMON = {
    "en": "the of and to in a is that for it was on with as be at by are this from".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "fr": "de la le et les des en un du une que est pour qui dans au par plus pas sur".split(),
    "es": "de la que el en y a los del se las por un para con no una su al lo".split(),
}
#: Largest Jensen-Shannon distances, and the least characters and words for a verdict.
MOST_CHARS, MOST_WORDS = 0.2, 0.45
LEAST_CHARS, LEAST_WORDS = 200, 100


def _without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, f"(?:{pattern})+", ""))


def repeated_words(found: Column) -> Column:
    """Words inside three-word windows that occur more than once, from an array of words.

    Windows are compared by a 64-bit hash within the document and sorted, not paired.
    """

    def windows(w: Column) -> Column:
        hashed = F.transform(
            F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
            lambda x, i: F.struct(F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")),
        )
        return F.sort_array(hashed)

    def again(s: Column) -> Column:
        twice = F.filter(
            s,
            lambda x, i: F.coalesce(x["h"] == F.get(s, i + 1)["h"], F.lit(False))
            | F.coalesce(x["h"] == F.get(s, i - 1)["h"], F.lit(False)),
        )
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        return F.aggregate(
            F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))),
            F.lit(0),
            lambda total, n: total + n,
        )

    # Each step is bound in a one-element array, so that it is computed once.
    step = F.transform(F.array(found), windows)
    return F.transform(F.transform(step, again), covered)[0]


def _histogram(known: Column):
    """A function of an array of words: how many equal each known word, and how many none."""

    def counted(s: Column) -> Column:
        by_word = F.transform(known, lambda k: F.size(F.filter(s["hits"], lambda x: x == k)).cast("long"))
        return F.concat(by_word, F.array((s["n"] - F.size(s["hits"])).cast("long")))

    def histogram(w: Column) -> Column:
        hits = F.filter(w, lambda x: F.array_contains(known, x))
        return F.transform(F.array(F.struct(hits.alias("hits"), F.size(w).alias("n"))), counted)[0]

    return histogram


def _counts(text: Column, lang: Column) -> Column:
    """How often each common word of the language occurs, and all other words; else null."""
    letters = F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))
    case = None
    for code, common in COMMON.items():
        value = F.transform(F.array(letters), _histogram(F.array(*[F.lit(w) for w in common])))[0]
        case = F.when(lang == code, value) if case is None else case.when(lang == code, value)
    return case


def js_distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance in bits of two count arrays of one length; null if one is all zero."""

    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)

    def term(p: Column, m: Column) -> Column:
        return F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)

    n, r = total(counts), total(reference)

    def part(x: Column, y: Column) -> Column:
        p, q = x / n, y / r
        return (term(p, (p + q) / 2) + term(q, (p + q) / 2)) / 2

    divergence = total(F.zip_with(counts, reference, part))
    return F.when((n > 0) & (r > 0), F.sqrt(F.greatest(divergence, F.lit(0.0))))


def judge(docs: DataFrame) -> DataFrame:
    """(doc_id, counts, base_failed, char_distance, word_distance, kept) for every row."""
    text, lang = F.coalesce("text", F.lit("")), F.col("lang")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    size = F.length(text)
    by_class = [(size - _without(text, c)).cast("long") for c in CLASSES]
    chars = F.transform(
        F.array(F.array(*by_class)),
        lambda c: F.concat(c, F.array(size - F.aggregate(c, F.lit(0).cast("long"), lambda s, x: s + x))),
    )[0]
    rows = docs.select(
        "doc_id",
        "lang",
        F.transform(
            F.array(words(text)),
            lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).cast("long").alias("n_repeat_words")),
        )[0].alias("w"),
        _without(text, SPACE).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.transform(F.array(lines), lambda a: F.size(a) - F.size(F.array_distinct(a)))[0].cast("long").alias("n_dup_lines"),
        chars.alias("chars"),
        _counts(text, lang).alias("common"),
    ).select("doc_id", "lang", "w.n_words", "word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words", "chars", "common")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    rows = stored(rows.withColumn("base_failed", failed), "divergence-counts")

    first = _verdicts(rows, rows.where("NOT base_failed"))
    second = stored(first.where("kept").groupBy("lang").agg(*_sums()), "divergence-references")
    return _verdicts(rows, second, summed=True).drop("chars", "common")


def _sums() -> list[Column]:
    def summed(column: str, length: int) -> Column:
        return F.array(*[F.coalesce(F.sum(F.col(column)[i]), F.lit(0)) for i in range(length)])

    size = len(next(iter(COMMON.values()))) + 1
    return [summed("chars", len(CLASSES) + 1).alias("all_chars"), summed("common", size).alias("all_common")]


def _verdicts(rows: DataFrame, reference: DataFrame, summed: bool = False) -> DataFrame:
    """``rows`` with both distances from the sums over ``reference`` by language, and kept."""
    sums = reference if summed else reference.groupBy("lang").agg(*_sums())
    sums = checked_broadcast(sums.withColumnRenamed("lang", "_lang"))
    rows = rows.join(sums, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    rows = rows.withColumn("char_distance", js_distance(F.col("chars"), F.col("all_chars")))
    rows = rows.withColumn("word_distance", js_distance(F.col("common"), F.col("all_common")))
    odd_chars = (F.col("word_chars") >= LEAST_CHARS) & (F.col("char_distance") > MOST_CHARS)
    odd_words = (F.col("n_words") >= LEAST_WORDS) & (F.col("word_distance") > MOST_WORDS)
    odd = F.coalesce(odd_chars, F.lit(False)) | F.coalesce(odd_words, F.lit(False))
    return rows.withColumn("kept", ~F.col("base_failed") & ~odd).drop("all_chars", "all_common", "_lang")


def op6_divergence(spark, directory: str) -> DataFrame:
    rows = judge(table(spark, directory, "documents").select("doc_id", "text", "lang"))
    return rows.drop("lang", "char_distance", "word_distance")


def _sql() -> str:
    classes = [c.replace("'", "''") for c in CLASSES]
    by_class = ", ".join(f"length(t) - length(regexp_replace(t, '(?:{c})+', '', 'g'))" for c in classes)
    case = " ".join(
        f"WHEN lang = '{k}' THEN list_transform([{', '.join(repr(w) for w in v)}], lambda k: len(list_filter(letters, lambda x: x = k)))"
        for k, v in COMMON.items()
    )
    known = " ".join(f"WHEN lang = '{k}' THEN [{', '.join(repr(w) for w in v)}]" for k, v in COMMON.items())

    def reference(column: str, length: int) -> str:
        return "[" + ", ".join(f"coalesce(sum({column}[{i}]), 0)" for i in range(1, length + 1)) + "]"

    def distance(a: str, b: str) -> str:
        p, q = f"{a}[i] / list_sum({a})", f"{b}[i] / list_sum({b})"
        m = f"(({p} + {q}) / 2)"
        term = "CASE WHEN {0} > 0 THEN {0} * log2({0} / {1}) ELSE 0 END"
        return (
            f"CASE WHEN list_sum({a}) > 0 AND list_sum({b}) > 0 THEN sqrt(greatest(0, list_sum(list_transform(range(1, len({a}) + 1), "
            f"lambda i: ({term.format(p, m)} + {term.format(q, m)}) / 2)))) END"
        )

    def sums(rows: str) -> str:
        size = len(next(iter(COMMON.values()))) + 1
        return (
            f"SELECT lang AS rlang, {reference('chars', len(CLASSES) + 1)} AS all_chars, "
            f"{reference('common', size)} AS all_common FROM {rows} GROUP BY lang"
        )

    def far(references: str) -> str:
        return (
            f"SELECT c.*, {distance('chars', 'all_chars')} AS cd, {distance('common', 'all_common')} AS wd "
            f"FROM counted c LEFT JOIN {references} ON c.lang IS NOT DISTINCT FROM rlang"
        )

    kept = (
        f"(NOT base_failed AND NOT coalesce(word_chars >= {LEAST_CHARS} AND cd > {MOST_CHARS}, false) "
        f"AND NOT coalesce(n_words >= {LEAST_WORDS} AND wd > {MOST_WORDS}, false))"
    )
    return f"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, lang, t, regexp_extract_all(t, '{WORD}') AS w, regexp_extract_all(lower(t), '\\p{{L}}+') AS letters,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l FROM d),
grams AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w,
    unnest(range(1, len(w) - 1)) AS i FROM w)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
again AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, range(3) r(j) GROUP BY doc_id),
base AS (SELECT w.doc_id, lang, CAST(len(w) AS BIGINT) AS n_words, length(regexp_replace(t, '{SPACE}+', '', 'g')) AS word_chars,
    CAST(len(regexp_extract_all(t, '{SYMBOLS}')) AS BIGINT) AS n_symbols,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(again.n, 0) AS n_repeat_words,
    length(t) AS size, [{by_class}] AS c, letters, CASE {case} END AS hits, CASE {known} END AS known
    FROM w LEFT JOIN again ON again.doc_id = w.doc_id),
counted AS (SELECT * EXCLUDE (c, hits, letters), list_append(c, size - list_sum(c)) AS chars,
    list_append(hits, len(letters) - list_sum(hits)) AS common,
    n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words AS base_failed FROM base),
refs AS ({sums("counted WHERE NOT base_failed")}),
first AS ({far("refs")}),
again2 AS ({sums(f"first WHERE {kept}")}),
far AS ({far("again2")})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, {kept} AS kept FROM far"""


QUERIES = {"op6_divergence": op6_divergence}
SQL = {"op6_divergence": _sql()}
