"""Secrets in texts: candidates by pattern, false positives removed by a random forest.

A candidate is a maximal run of at least ``MIN_LENGTH`` letters, digits and ``+/_-``. The
forest judges its length, the transitions between its characters (kinds of characters, and
how likely its pairs of letters are in the words of the corpus), how much of it the
commonest words cover, the path of its document and the words around it.

It learns from labelled findings. The query labels those of its corpus that have a known
form, and puts a bounded sample of the secrets among them, and values derived from these, where the
verdict is another one: behind the name of a digest, beside the word "example", below a path of tests, bare
in prose, as an identifier of common words. So no form alone decides. All else is left to the forest.

Only DataFrame functions and Spark's own forest are used.

* Null and empty texts have no candidate. Texts of any length are searched to their end.
* A null path counts as an empty one. Rows without id are searched, but nothing is learned
  from them. Repeated rows give their findings each.
* Without a finding of a known secret form there is no forest: every candidate is kept, with
  probability 1. An empty table gives an empty result. Other columns are ignored.
* Secrets are not copied: a finding has its place and the SHA-256 of its characters.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docops.llm.common import sample_by_hash, stored, table

MIN_LENGTH = 16
CANDIDATE = rf"[A-Za-z0-9+/_-]{{{MIN_LENGTH},}}"
#: Characters on either side in which neighbouring words are looked for.
AROUND = 40
#: Candidates of one text whose places are summed at a time.
BLOCK = 1000
#: Commonest words of the corpus that count as its dictionary, and their least length.
DICTIONARY = 2_000
DICTIONARY_LENGTH = 3
#: Labelled findings of each kind that the forest learns from, its size and its threshold.
SAMPLE = 5_000
#: Known secrets that are put into other surroundings to learn from.
SEEDS = 1_000
TREES, DEPTH, SEED = 40, 9, 7
CUT = 0.5
#: Words that tell of a secret, of a digest, and of an example.
TELLING = "password|passwd|pwd|secret|token|credential|api.?key|access.?key|private.?key|auth|bearer"
DIGESTS = "sha[0-9]*|md5|checksum|digest|commit|etag|uuid|guid"
EXAMPLES = "example|sample|dummy|placeholder|changeme|test|fixture|mock"
#: Surroundings of findings whose verdict is known, and parts of made values.
TOLD_BY = ["password = ", 'api_key="', "token: '", "secret=", 'auth_token = "', "the credential: "]
DIGEST_OF = ["sha256:", "md5 = ", "checksum: ", "at commit ", 'etag: "', "digest=", "sha1 "]
EXAMPLE_OF = ["example ", "a sample ", "dummy ", "placeholder ", "test "]
EXAMPLE_PATHS = ["tests/fixture/keys.json", "examples/config.yml", "docs/sample.md", "mock/data.txt"]
NAMED_BY = ["id = ", "request ", "uuid: ", "see "]
IN_PROSE = ["the ", "and ", "of ", ", ", ""]
FILLERS = ["x", "0", "X", "_"]

#: The features by what they look at.
FAMILIES = {
    "length": ["length"],
    "transitions": (
        "upper lower digit lower_digit upper_digit case_change same distinct hexadecimal transition".split()
    ),
    "dictionary": ["dictionary"],
    "path": ["path_example"],
    "words": "told assigned digest example".split(),
}
FEATURES = [name for family in FAMILIES.values() for name in family]
LETTERS = 26


def _starts(lengths: Column) -> Column:
    """Sums of all earlier elements of an array of ints, in blocks so that long arrays stay cheap."""
    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all"))

    def running(values: Column) -> Column:
        return F.aggregate(
            values,
            none,
            lambda s, x: F.struct((s["at"] + x).alias("at"), F.concat(s["all"], F.array(s["at"])).alias("all")),
        )

    def cut(v: Column) -> Column:
        count = F.floor((F.size(v) - 1) / BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), count), lambda b: running(F.slice(v, b * BLOCK + 1, F.lit(BLOCK))))

    def joined(blocks: Column) -> Column:
        offsets = running(F.transform(blocks, lambda b: b["at"]))["all"]
        return F.flatten(F.zip_with(blocks, offsets, lambda b, o: F.transform(b["all"], lambda x: x + o)))

    return F.transform(F.transform(F.array(lengths), cut), joined)[0]


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, path, start, candidate, before, after) for every candidate of every row.

    ``start`` counts characters from 0. The text between candidates comes from one split, so
    places are sums of lengths and no text is searched twice.
    """
    text = F.coalesce("text", F.lit(""))
    pieces = F.struct(
        F.split(text, CANDIDATE).alias("between"), F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("found")
    )

    def pairs(s: Column) -> Column:
        return F.zip_with(s["between"], s["found"], lambda b, c: F.struct(b.alias("b"), c.alias("c")))

    rows = docs.select(
        "doc_id", F.coalesce("path", F.lit("")).alias("path"), F.transform(F.array(pieces), pairs)[0].alias("pairs")
    ).where(F.size("pairs") > 1)
    lengths = F.transform("pairs", lambda x: F.length(x["b"]) + F.coalesce(F.length(x["c"]), F.lit(0)))
    found = F.transform(
        F.array(F.struct(F.col("pairs").alias("p"), _starts(lengths).alias("at"))),
        lambda s: F.transform(
            s["p"],
            lambda x, i: F.struct(
                (s["at"][i] + F.length(x["b"])).alias("start"),
                x["c"].alias("candidate"),
                F.right(x["b"], F.lit(AROUND)).alias("before"),
                F.left(F.get(s["p"], i + 1)["b"], F.lit(AROUND)).alias("after"),
            ),
        ),
    )[0]
    return (
        rows.select("doc_id", "path", F.explode(found).alias("f"))
        .select("doc_id", "path", "f.*")
        .where("candidate IS NOT NULL")
    )


def vocabulary(docs: DataFrame) -> DataFrame:
    """(w, count) for every word of letters in any text, lower-cased; one row a word, written once."""
    pattern = rf"\b[a-z]{{{DICTIONARY_LENGTH},{MIN_LENGTH // 2}}}\b"
    letters = F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(pattern), F.lit(0))
    return stored(docs.select(F.explode(letters).alias("w")).groupBy("w").count(), "secrets-words")


def dictionary(words: DataFrame) -> list[str]:
    """The commonest words of all texts; their number is the bound ``DICTIONARY``."""
    return sorted(r["w"] for r in words.orderBy(F.col("count").desc(), "w").limit(DICTIONARY).collect())


def transitions(words: DataFrame) -> list[float]:
    """How likely one letter follows another in the words, as logarithms; ``LETTERS`` times ``LETTERS`` of them."""
    pairs = F.transform(F.sequence(F.lit(1), F.length("w") - 1), lambda i: F.substr("w", i, F.lit(2)))
    counted = words.select("count", F.explode(pairs).alias("p")).groupBy("p").agg(F.sum("count").alias("n")).collect()
    counts = [[1.0] * LETTERS for _ in range(LETTERS)]
    for row in counted:
        first, second = (ord(letter) - ord("a") for letter in row["p"])
        counts[first][second] += row["n"]
    return [math.log(n / sum(line)) for line in counts for n in line]


def _likelihood(candidate: Column, likely: list[float]) -> Column:
    """Mean of ``likely`` over neighbouring characters; a pair with anything but letters counts as the least likely."""
    table, least = F.lit(likely), F.lit(min(likely))
    size = F.length(candidate)
    codes = F.transform(F.sequence(F.lit(1), size), lambda i: F.ascii(F.substr(F.lower(candidate), i, F.lit(1))) - ord("a"))

    def pair(a: Column, b: Column) -> Column:
        letters = a.between(0, LETTERS - 1) & b.between(0, LETTERS - 1)
        return F.when(letters, F.get(table, a * LETTERS + b)).otherwise(least)

    # Bound in a one-element array, so that the characters are taken apart once.
    total = F.transform(
        F.array(codes),
        lambda v: F.aggregate(F.sequence(F.lit(1), F.size(v) - 1), F.lit(0.0), lambda t, i: t + pair(v[i - 1], v[i])),
    )[0]
    return total / (size - 1)


def _any_word(known: list[str]) -> str:
    """A pattern of all words, longest first among those with one first letter."""
    by_letter: dict[str, list[str]] = {}
    for word in sorted(known, key=lambda w: (-len(w), w)):
        by_letter.setdefault(word[0], []).append(word[1:])
    return "|".join(f"{letter}(?:{'|'.join(rest)})" for letter, rest in sorted(by_letter.items()))


def with_features(found: DataFrame, known: list[str], likely: list[float]) -> DataFrame:
    """``found`` with the columns ``FEATURES``, by the words and the transitions of the corpus."""
    c, size = F.col("candidate"), F.length("candidate").cast("double")

    def share(pattern: str) -> Column:
        return F.regexp_count(c, F.lit(pattern)) / size

    def near(words: str, *columns: str) -> Column:
        hit = F.lit(False)
        for column in columns:
            hit = hit | F.coalesce(F.lower(column).rlike(words), F.lit(False))
        return hit.cast("double")

    covered = F.lit(0.0)
    if known:
        covered = 1 - F.length(F.regexp_replace(F.lower(c), _any_word(known), "")) / size
    columns = {
        "length": size,
        "upper": share("[A-Z]"),
        "lower": share("[a-z]"),
        "digit": share("[0-9]"),
        "lower_digit": share("[a-z](?=[0-9])|[0-9](?=[a-z])"),
        "upper_digit": share("[A-Z](?=[0-9])|[0-9](?=[A-Z])"),
        "case_change": share("[a-z](?=[A-Z])|[A-Z](?=[a-z])"),
        "same": share(r"(.)(?=\1)"),
        "distinct": F.size(F.array_distinct(F.split(c, ""))) / size,
        "dictionary": covered,
        "told": near(rf"({TELLING})\W{{0,6}}$", "before"),
        "assigned": near(r"[=:]\s*[\"']?$", "before"),
        "digest": near(rf"\b({DIGESTS})\W{{0,6}}$", "before"),
        "example": near(rf"\b({EXAMPLES})\b", "before", "after"),
        "path_example": near(EXAMPLES, "path"),
        "hexadecimal": c.rlike("^[0-9a-f]+$").cast("double"),
        "transition": _likelihood(c, likely),
    }
    return found.select("*", *[value.cast("double").alias(name) for name, value in columns.items()])


def learn(labelled: DataFrame) -> RandomForestClassificationModel | None:
    """A forest from rows of ``FEATURES``, label (0 or 1) and candidate: a sample of each kind by hash."""
    labelled = labelled.withColumn("sha", F.sha2("candidate", 256))
    counts = {r["label"]: r["count"] for r in labelled.where("label IN (0, 1)").groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    samples = [
        sample_by_hash(
            labelled.where(F.col("label") == label).select(*FEATURES, "label", "sha"), ["sha", *FEATURES], SAMPLE, counts[label]
        )
        for label in (0, 1)
    ]
    # Both samples are bounded; one sorted partition makes the fit repeatable.
    sample = stored(samples[0].unionByName(samples[1]).orderBy("label", *FEATURES).coalesce(1), "secrets-sample")
    sample = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample.coalesce(1))
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="features", numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt"
    )
    return forest.fit(sample.withColumn("label", F.col("label").cast("double")))


def judged(found: DataFrame, model: RandomForestClassificationModel | None) -> DataFrame:
    """(doc_id, start, length, sha256, probability, secret) for rows with ``FEATURES``."""
    if model is None:
        scored = found.withColumn("p", F.lit(1.0))
    else:
        vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)
        scored = model.transform(vectors).withColumn("p", vector_to_array("probability")[1])
    return scored.select(
        "doc_id",
        "start",
        F.length("candidate").alias("length"),
        F.sha2("candidate", 256).alias("sha256"),
        F.round("p", 6).alias("probability"),
        (F.col("p") >= CUT).alias("secret"),
    )


def known_forms(found: DataFrame) -> Column:
    """1 for findings whose form proves a secret, 0 for words, null for all that is left to the forest."""
    key = F.col("candidate").rlike("^(AKIA|ASIA)[A-Z2-7]{16}$")
    told = (F.col("told") == 1.0) & (F.col("assigned") == 1.0)
    mocked = (F.col("example") == 1.0) | (F.col("path_example") == 1.0)
    value = F.col("candidate").rlike("^[0-9a-f]{18,}$") & told
    word = F.col("candidate").rlike("^[A-Za-z]?[a-z]+$|^[A-Z]+$|^(.)\\1+$") & ~key
    return F.when((key | value) & ~mocked, 1).when(word, 0)


def taught() -> Column:
    """Held-out documents teach nothing, nor do rows without id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 != 2, F.lit(False))


def surrounded(seeds: DataFrame, known: list[str]) -> DataFrame:
    """(candidate, path, before, after, label): each known secret of ``seeds``, and values made from it, in
    surroundings that prove them secret (1) or not (0)."""

    def number(salt: str, below: int) -> Column:
        return F.pmod(F.xxhash64("candidate", F.lit(salt)), F.lit(below)).cast("int")

    def one_of(values: list[str], salt: str) -> Column:
        return F.get(F.lit(values), number(salt, len(values)))

    value, path, before = F.col("candidate"), F.col("path"), F.col("before")
    digest = F.sha2("candidate", 256)
    hexadecimal = F.left(digest, number("hex", 25) + 18)
    mixed = F.left(F.base64(F.unhex(digest)), number("mixed", 21) + 20)
    key = F.concat(F.lit("AKIA"), F.translate(F.upper(F.left(digest, F.lit(16))), "0189", "WXYZ"))
    uuid = F.concat_ws("-", *[F.substr(digest, F.lit(at), F.lit(n)) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    letters = F.translate(F.left(digest, number("letters", 20) + 18), "0123456789", "ghijklmnop")
    words = [one_of(known or ["value"], f"word {i}") for i in range(5)]
    named, joined = F.concat(F.lit("getThe"), *[F.initcap(w) for w in words]), F.concat(F.lit("the"), *words)
    filler = F.repeat(one_of(FILLERS, "filler"), number("fill", 25) + MIN_LENGTH)
    told, named_digest = one_of(TOLD_BY, "told"), one_of(DIGEST_OF, "digest")
    example = F.concat(one_of(EXAMPLE_OF, "example"), told)
    mocked, prose = one_of(EXAMPLE_PATHS, "path"), one_of(IN_PROSE, "prose")
    spoken = F.concat(*[F.left(one_of(known or ["value"], f"part {i}"), F.lit(3)) for i in range(7)])
    blob = F.concat(*[F.left(F.base64(F.unhex(F.sha2(F.concat("candidate", F.lit(f"{i}")), 256))), F.lit(43)) for i in range(4)])
    cases = [
        (value, path, before, 1),
        (hexadecimal, path, told, 1),
        (mixed, path, told, 1),
        (key, path, told, 1),
        (key, path, prose, 1),
        (hexadecimal, path, named_digest, 0),
        (mixed, path, named_digest, 0),
        (hexadecimal, path, prose, 0),
        (uuid, path, one_of(NAMED_BY, "named"), 0),
        (hexadecimal, path, example, 0),
        (mixed, path, example, 0),
        (key, path, example, 0),
        (value, mocked, before, 0),
        (mixed, mocked, told, 0),
        (key, mocked, told, 0),
        (letters, path, told, 1),
        (spoken, path, told, 1),
        (blob, path, told, 0),
        (named, path, told, 0),
        (joined, path, told, 0),
        (joined, path, prose, 0),
        (filler, path, told, 0),
    ]
    rows = [
        F.struct(c.alias("candidate"), p.alias("path"), b.alias("before"), F.col("after").alias("after"), F.lit(label).alias("label"))
        for c, p, b, label in cases
    ]
    return seeds.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def lessons(labelled: DataFrame, known: list[str], likely: list[float]) -> DataFrame | None:
    """Labelled findings to learn from: a sample of the words, and of the secrets in all surroundings."""
    counts = {r["label"]: r["count"] for r in labelled.where("label IN (0, 1)").groupBy("label").count().collect()}
    if 1 not in counts:
        return None
    plain = labelled.select("candidate", "path", "before", "after", "label")
    keys = ["candidate", "path", "before", "after"]
    seeds = sample_by_hash(plain.where("label = 1"), keys, SEEDS, counts[1])
    others = sample_by_hash(plain.where("label = 0"), keys, SAMPLE, counts.get(0, 0))
    return with_features(surrounded(seeds, known).unionByName(others), known, likely)


def scan(docs: DataFrame) -> DataFrame:
    """Findings of ``docs`` (doc_id, path, text), with a forest learned from those of known form."""
    words = vocabulary(docs)
    known, likely = dictionary(words), transitions(words)
    found = stored(with_features(candidates(docs), known, likely), "secrets-candidates")
    teaching = lessons(found.withColumn("label", F.when(taught(), known_forms(found))), known, likely)
    return judged(found, None if teaching is None else learn(stored(teaching, "secrets-lessons")))


def op2_secrets(spark, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents")
    return scan(docs.select("doc_id", F.col("source").alias("path"), "text"))


QUERIES = {"op2_secrets": op2_secrets}
SQL: dict[str, str] = {}
