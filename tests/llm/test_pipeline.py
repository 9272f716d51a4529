"""The stages of the corpus pipeline, each on its own input and all in a row."""

from collections import Counter, defaultdict

import corpus_pipeline as pipeline
from docops.llm.common import stored, table
from docops.llm.linedup import delete_repeats
from docops.llm.mixing import mix
from docops.llm.quality import good_documents
from docops.llm.simhash import one_of_each
from tests.llm.helpers import awkward_rows, words
from tests.llm.test_duplicates import slow_groups, slow_print

DIRECTORY = "/root/testdata/sf0.001"


def test_stages_hold_what_they_promise(spark):
    docs = table(spark, DIRECTORY, "documents")
    columns, seen = docs.columns, []
    for name, stage in pipeline.STAGES:
        seen.append(docs.collect())
        docs = stored(stage(spark, docs, DIRECTORY), "test-stage")
        if name != "packing":
            assert docs.columns == columns
    packed = docs.collect()
    start, good, cut, single, mixed = seen
    labels = {r.doc_id: r.quality for r in table(spark, DIRECTORY, "labels").collect()}
    kept = {r.doc_id for r in good}
    assert all((r.doc_id in kept) == (labels[r.doc_id] == 1) for r in start if r.doc_id in labels)
    before = {r.doc_id: r.text for r in good}
    for r in cut:  # lines only go, in order; the length follows
        rest = iter(before[r.doc_id].split("\n"))
        assert all(line in rest for line in r.text.split("\n")) and r.n_chars == len(r.text)
    groups = slow_groups([slow_print(r.text) for r in cut])
    least = defaultdict(lambda: 1 << 60)
    for g, r in zip(groups, cut):
        least[g] = min(least[g], r.doc_id)
    assert sorted(r.doc_id for r in single) == sorted(least.values())
    copies = Counter(r.doc_id for r in mixed)
    assert max(copies.values()) <= 2 and set(copies) <= {r.doc_id for r in single}
    share = sum(len(words(r.text)) for r in mixed) / sum(len(words(r.text)) for r in single)
    assert 1.2 < share < 1.8
    assert Counter(r.doc_id for r in packed) == copies


def test_run_equals_its_stages_and_awkward_rows_pass(spark, tmp_path):
    rows = [r[:5] for r in awkward_rows()]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(i % 9 != 0), 0) for i in range(100)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = pipeline.run(spark, str(tmp_path)).collect()
    assert out and sorted(map(tuple, out), key=repr) == sorted(map(tuple, pipeline.run(spark, str(tmp_path)).collect()), key=repr)
    empty = spark.createDataFrame([], schema)
    for name, stage in pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_columns_of_any_name_pass_every_stage(spark, tmp_path):
    names = ["_f", "_u", "_class", "_n", "_doc", "_text", "_pos", "_gone", "expected", "size", "copies", "target", "n_lines"]
    names += ["n_removed", "source_size", "taken", "score", "root", "fp", "text_hash", "aside0", "a.b", "h", "item"]
    rows = [r[:5] for r in awkward_rows() if r[0] is not None and r[0] < 110]
    rows = [(*r, *[f"{r[0]} {n}" for n in names]) for r in dict.fromkeys(rows) if r[0] != 3]
    schema = "doc_id long, text string, lang string, source string, n_chars long, "
    docs = spark.createDataFrame(rows, schema + ", ".join(f"`{n}` string" for n in names))
    labels = [(i, int(i % 9 != 0), 0) for i in range(100)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    columns = docs.columns
    for name, stage in pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, str(tmp_path)), "test-names")
        assert docs.columns == columns
        kept = docs.collect()
        assert kept and all(list(r[5:]) == [f"{r.doc_id} {n}" for n in names] for r in kept), name
    for rows_of in (mix(docs), delete_repeats(docs), one_of_each(docs), good_documents(docs, table(spark, str(tmp_path), "labels"))):
        given = {r.doc_id: r for r in kept}
        for r in rows_of.select("doc_id", "`_f`", "`_u`", "`expected`", "`_n`", "`a.b`").collect():
            assert list(r[1:]) == [f"{r.doc_id} {n}" for n in ("_f", "_u", "expected", "_n", "a.b")] and r.doc_id in given
    assert stage_rows(spark, docs, tmp_path) == Counter(r.doc_id for r in kept)


def stage_rows(spark, docs, directory):
    return Counter(r.doc_id for r in pipeline.STAGES[-1][1](spark, docs, str(directory)).collect())
