"""The registered queries over the smallest tables, and the pipeline against plain Python."""

import brute
import pytest
from compare import connect, differences
from samples import ODD, prose

import __spark_entry__ as contract
import corpus_pipeline
from reliq.llm import oracle, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.fixture(scope="module")
def texts(con):
    return con.execute("select doc_id, text from documents").fetchall()


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_queries_equal_their_sql(spark, con, name):
    assert differences(queries.QUERIES[name](spark, SF), con, oracle.oracle_sql()[name]) == []


def test_all_queries_are_registered():
    names = contract.queries()
    for n in range(1, 14):
        assert len([name for name in names if name.startswith(f"op{n}_")]) == 1
    assert names["pipeline"] is corpus_pipeline.run


def test_secret_digests(spark, texts):
    got = {r["doc_id"]: r for r in queries.QUERIES["op8_secret_scans"](spark, SF).collect()}
    for doc_id, text in texts:
        spans = brute.secrets(text)
        written = ",".join(f"{brute.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        row = got[doc_id]
        assert row["base_sha256"] == brute.sha(written)
        assert (row["n_assign"], row["n_access"], row["n_hex"]) == tuple(sum(k == kind for _, k, _ in spans) for kind in range(3))


def test_coding_digests(spark, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.vocabulary_path())
    got = {r["doc_id"]: r for r in queries.QUERIES["op5_bpe_coding"](spark, SF).collect()}
    for doc_id, text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert got[doc_id][1:] == (len(ids), brute.sha(",".join(map(str, ids))), brute.sha(text))


def test_components(spark, texts):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.QUERIES["op7_ngram_jaccard_join"](spark, SF).collect()}
    assert got == brute.components(texts)


def piped(rows, items):
    """The pipeline's documents and texts in plain Python; the policy's own rules do not fire here."""
    kept = [row for row in rows if not brute.ledger(row[1])["base_failed"]]
    kept = [(row[0], text) for row, (_, _, text) in zip(kept, brute.line_dedup(kept))]
    groups = brute.components(kept)
    kept = [row for row in kept if groups[row[0]][1] == row[0]]
    return {row[0]: row[1] for row in kept if not brute.contamination(row[1], items)[1]}


def test_the_pipeline_equals_plain_python(spark, make, tmp_path):
    from tokenizers import Tokenizer

    boiler = "All of these pages carry this very line"
    item = prose(70, 12)
    rows = [(i, f"{prose(i, 60)}\n{boiler}\nown line number {i} of all") for i in range(1, 9)]
    rows += [(20, prose(1, 60) + f"\n{boiler}\nown line number 1 of all")]
    rows += [(21, f"{prose(31, 60)}\n{item}"), (22, "too few words"), (23, "again and " * 60), (24, None)]
    make(rows).write.parquet(str(tmp_path / "documents.parquet"))
    items = [(1, item), (2, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    want = piped(rows, items)
    assert set(want) == set(range(1, 9))
    library = Tokenizer.from_file(queries.vocabulary_path())
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) == set(want)
    for doc_id, text in want.items():
        assert got[doc_id]["ids"] == library.encode(text, add_special_tokens=False).ids
        assert got[doc_id]["decoded_sha256"] == brute.sha(text)


def test_stages_keep_the_columns_of_documents(spark, make):
    docs = make([*ODD, *[(i, prose(i, 60)) for i in range(4)]])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        assert kept.columns == docs.columns
        assert {r["doc_id"] for r in kept.collect()} >= set(range(4))


def test_stages_take_empty_tables_and_clashing_names(spark, empty, clashing):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, empty, SF).collect() == []
        assert stage(spark, clashing, SF).columns == clashing.columns
    assert corpus_pipeline.bpe_coding(spark, empty, SF).collect() == []


def test_the_coding_stage_takes_odd_rows(spark, make):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.vocabulary_path())
    rows = [*ODD, ODD[0]]
    got = corpus_pipeline.bpe_coding(spark, make(rows), SF).collect()
    have = sorted((str(r["doc_id"]), r["n_tokens"], r["decoded_sha256"]) for r in got)
    texts = [(row[0], row[1] or "") for row in rows]
    want = [(str(i), len(library.encode(text, add_special_tokens=False).ids), brute.sha(text)) for i, text in texts]
    assert have == sorted(want)


def test_token_counts_of_the_whole_table_equal_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.vocabulary_path())
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = {r["doc_id"]: r for r in queries.QUERIES["op4_token_counts"](spark, SF).collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        n = len(text)
        third, middle = n // 3, n // 2
        text = text[:third] + " [revised] " + text[third:]
        edited = text[:middle] + text[middle + 20 :]
        end = min(max(n - 5, 0), len(edited))
        edited = edited[:end] + "!" + edited[n + 20 :]
        assert got[i]["n_tokens"] == len(library.encode(texts[i], add_special_tokens=False).ids)
        assert got[i]["n_tokens_edited"] == len(library.encode(edited, add_special_tokens=False).ids)
        assert got[i]["edited_sha256"] == brute.sha(edited)
