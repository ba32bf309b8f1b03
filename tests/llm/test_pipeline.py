import pytest

import corpus_pipeline
from shelfcast.llm import simhash
from tests.llm.helpers import prose
from tests.llm.test_classifiers import toxic_rows
from tests.llm.test_decontaminate import brute as brute_hits
from tests.llm.test_lines import brute as brute_lines
from tests.llm.test_simhash import plain_fingerprint, roots

pytest.importorskip("public_tokenizers")
SHARED = "a line that many of the documents share"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    clean, bad = toxic_rows()
    passage = prose(77, 40, 10_000)
    rows = [(d, t + ("\n" + SHARED if d % 3 == 0 else "")) for d, t in clean] + bad
    rows += [(600 + i, clean[5 + i][1]) for i in range(10)] + [(700, passage), (701, prose(8, 2000, 9000) + " " + passage), (702, None), (703, "")]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(d, 1, 0) for d, _ in clean[:120]] + [(d, 1, 1) for d, _ in bad[:50]], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, {d for d, _ in bad}, passage


def test_stages_equal_brute_force(spark, corpus):
    folder, bad, passage = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names, states = docs.columns, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        docs = corpus_pipeline.written(stage(spark, docs, folder), name)
        if k < 4:
            assert docs.columns == names
        states.append((before, docs.collect()))
    toxic, lines, near, clean, packed = states
    assert {r["doc_id"] for r in toxic[1]} == {d for d, _ in toxic[0]} - bad
    assert sorted((r["doc_id"], r["text"]) for r in lines[1]) == sorted((d, kept) for d, _, _, kept in brute_lines(lines[0]))
    assert all(r["n_chars"] == len(r["text"]) for r in lines[1])
    prints = {d: plain_fingerprint(t) for d, t in near[0]}
    linked = roots(prints, [(a, b) for a in prints for b in prints if a > b and (prints[a] ^ prints[b]).bit_count() <= 2])
    assert sorted(r["doc_id"] for r in near[1]) == sorted(set(linked.values()))
    hit = {d for d, n, h, _ in brute_hits(clean[0], [(1, passage)], 13) if h and 20 * h >= n}
    assert hit == {700} and {r["doc_id"] for r in clean[1]} == {d for d, _ in clean[0]} - hit
    assert {r["doc_id"] for r in packed[1]} == {d for d, _ in packed[0]}
    total = {}
    for r in packed[1]:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
    assert all(total[r["doc_id"]] == r["doc_tokens"] for r in packed[1])
    again = corpus_pipeline.run(spark, folder).collect()
    assert sorted(tuple(r) for r in again) == sorted(tuple(r) for r in packed[1])


def test_one_of_each_group_with_nulls_and_copies(spark):
    rows = [(1, "a b c d", 1), (1, "a b c d", 1), (2, "a b c d", 2), (None, "a b c d", 3), (None, "x y z", 4), (5, "q r s t", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = sorted((tuple(r) for r in simhash.one_of_each_group(docs).collect()), key=repr)
    assert got == sorted([(1, "a b c d", 1), (None, "a b c d", 3), (None, "x y z", 4), (5, "q r s t", 5)], key=repr)
