"""BPE coding and token counts that follow edits."""

import random

import numpy as np
import pytest
from samples import ODD, prose

from reliq.llm import bpe, edits
from reliq.llm.lexicon import Lexicon, compile_lexicon
from reliq.llm.queries import vocabulary_path
from pyspark.sql import functions as F

TEXTS = [
    "",
    "a<|endoftext|> b<|endoftext|><|endoftext|>",
    "x" * 3000,
    "ab" * 500 + " " * 50 + "\n\n \t x",
    "it's we'll 'l 'll ' don't_ __x",
    "日本語テキスト ጽሑፍ ಕನ್ನಡ \U0001f600\U0001f9ff ²½ x\x1cy",
    prose(1, 200),
    prose(2, 30).upper() + " 12345 6,789.01",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path())


@pytest.fixture(scope="module")
def vocab():
    return bpe.vocabulary(vocabulary_path())


def ids_of(library, text):
    return library.encode(text, add_special_tokens=False).ids


def test_cuts_agree_with_the_library_for_every_character(library, vocab):
    characters = [*range(0xD800), *range(0xE000, 0x30000, 7), *range(0x30000, 0x110000, 997)]
    for code in characters:
        c = chr(code)
        text = f"a{c}1{c}{c} {c}  {c}!{c}'s{c}_"
        assert vocab.cut(text) == [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)], hex(code)


def test_ids_and_texts_equal_the_library(library, vocab):
    rng = random.Random(1)
    texts = [*TEXTS, *["".join(rng.choice("abcdehinorst 'é日\n") for _ in range(300)) for _ in range(60)]]
    coder = bpe.Encoder(vocab)
    packed = [coder.encode(text) for text in texts]
    for text, ids in zip(texts, packed):
        assert np.frombuffer(ids, np.int32).tolist() == ids_of(library, text)
    ends = np.cumsum([len(ids) // 4 for ids in packed])
    assert coder.decode(np.frombuffer(b"".join(packed), np.int32), ends) == texts
    torn = np.array(ids_of(library, "é日")[:1], np.int32)
    assert coder.decode(torn, np.array([1])) == [library.decode(torn.tolist(), skip_special_tokens=False)]


def test_short_and_long_merges_agree(vocab, monkeypatch):
    rng = random.Random(5)
    words = ["".join(rng.choice("theraningdsou ") for _ in range(rng.randrange(1, 24))).encode() for _ in range(500)]
    short = [vocab.merge(word) for word in words]
    monkeypatch.setattr(bpe, "SHORT", 0)
    assert [vocab.merge(word) for word in words] == short


def test_the_lexicon_is_exact_and_minimal():
    entries = {word.encode(): [i, i + 1] for i, word in enumerate("tap taps top tops stop stops a ab é 日本".split())}
    found = Lexicon(compile_lexicon(entries))
    assert {word: found.get(word) for word in entries} == entries
    assert [found.get(word) for word in (b"", b"t", b"tapss", b"zz", "日".encode())] == [None] * 5
    # tap(s), top(s) and stop(s) share their ends.
    shared = Lexicon(compile_lexicon({w.encode(): [1] for w in "tap taps top tops".split()}))
    assert len(shared.finals) == 5
    assert Lexicon(compile_lexicon({})).get(b"a") is None


def test_coding_of_a_table(make, library, empty, clashing):
    rows = [*[(i, text) for i, text in enumerate(TEXTS)], *ODD]
    got = bpe.encode(make(rows), vocabulary_path()).select("row.doc_id", "ids", "decoded").collect()
    assert sorted((str(r[0]), r[1], r[2]) for r in got) == sorted(
        (str(row[0]), ids_of(library, row[1] or ""), row[1] or "") for row in rows
    )
    assert bpe.encode(empty, vocabulary_path()).collect() == []
    assert bpe.encode(clashing, vocabulary_path()).select("row.*").columns == [c for c in clashing.columns if c != "text"]


def test_edits_keep_the_tree_as_if_cut_anew(vocab):
    sizes = bpe.Remembered(lambda word: len(vocab.merge(word.encode())))
    rng = random.Random(3)
    parts = ["a", "b", " ", "  ", "\n", "'", "l", "'ll", "1", "22", "!", "é", "日本", " word", "'s", ""]
    for text in [*TEXTS, "   ", "\n\n\n   x"]:
        text = text.replace("<|endoftext|>", "<end>")[:800]
        tree = edits.SegmentTree(vocab.cut(text), vocab.cut, sizes.__getitem__)
        for _ in range(60):
            start = rng.randrange(-2, len(text) + 3)
            stop = start + rng.choice([0, 0, 1, 2, 5, 30, -1])
            insert = "".join(rng.choice(parts) for _ in range(rng.randrange(4)))
            a = max(0, min(start, len(text)))
            b = max(a, min(stop, len(text)))
            tree.edit(start, stop, insert)
            text = text[:a] + insert + text[b:]
            words = vocab.cut(text)
            assert [word for leaf in tree.leaves for word in leaf] == words
            assert (tree.n_chars, tree.n_tokens) == (len(text), sum(sizes[word] for word in words))


def test_an_edit_reads_a_small_part_only(vocab):
    words = vocab.cut(prose(1, 5000))
    tree = edits.SegmentTree(words, vocab.cut, lambda word: len(vocab.merge(word.encode())))
    tree.edit(tree.n_chars // 2, tree.n_chars // 2 + 4, "changed")
    assert tree.encoded < 60


def test_edited_counts_of_a_table(make, vocab, empty):
    rows = [*[(i, text) for i, text in enumerate(TEXTS) if "<|" not in text], *ODD]
    docs = make(rows).select("doc_id", "text")
    odd_edits = "array(null, named_struct('start', null, 'stop', null, 'insert', null), named_struct('start', 1L, 'stop', 2L, 'insert', 'zz'))"
    count = lambda text: sum(len(vocab.merge(word.encode())) for word in vocab.cut(text))
    for made in (edits.standard_edits(F.coalesce("text", F.lit(""))), F.expr(odd_edits), F.lit(None)):
        for row in edits.edited_counts(docs.withColumn("edits", made), vocabulary_path()).collect():
            text = next(r[1] for r in rows if r[0] == row["row"]["doc_id"]) or ""
            assert (row["n_tokens"], row["n_pretokens"]) == (count(text), len(vocab.cut(text)))
            assert row["n_tokens_edited"] == count(row["edited"])
    assert edits.edited_counts(empty.withColumn("edits", F.lit(None)), vocabulary_path()).collect() == []


def test_special_tokens_are_made_and_broken_by_edits(vocab, library):
    rules = edits.tree_rules(vocab)
    rng = random.Random(9)
    parts = ["<|endoftext|>", "<|endo", "ftext|>", "<", "|>", " ", "   ", "a", "end", "\n"]
    for _ in range(40):
        text = "".join(rng.choice(parts) for _ in range(40))
        tree = edits.SegmentTree(rules[0](text), *rules)
        for _ in range(20):
            start = rng.randrange(len(text) + 1)
            stop, insert = min(len(text), start + rng.choice([0, 1, 7, 40])), "".join(rng.choice(parts) for _ in range(rng.randrange(3)))
            tree.edit(start, stop, insert)
            text = text[:start] + insert + text[stop:]
            assert (tree.text, tree.n_tokens) == (text, len(ids_of(library, text)))


def test_long_insertions_get_leaves_of_their_own(vocab):
    rules = edits.tree_rules(vocab)
    tree = edits.SegmentTree(rules[0](prose(1, 50)), *rules)
    tree.edit(20, 20, prose(2, 5000))
    assert max(map(len, tree.leaves)) <= 2 * edits.LEAF
    before = tree.encoded
    tree.edit(10_000, 10_004, "changed")
    assert tree.encoded - before < 100 and tree.n_tokens == sum(map(rules[1], rules[0](tree.text)))


def test_later_edits_start_from_written_trees(make, library, empty, clashing):
    path = vocabulary_path()
    rows = [*[(i, text) for i, text in enumerate(TEXTS)], *ODD]
    trees = edits.write_trees(make(rows), path)
    texts = sorted((str(row[0]), row[1] or "") for row in rows)
    second = F.expr("array(named_struct('start', 3L, 'stop', 40L, 'insert', ' <|endoftext|>it''s '), named_struct('start', 90L, 'stop', 91L, 'insert', null))")
    for made in (edits.standard_edits(F.col("text")), second, F.lit(None)):
        done = edits._written(edits.edit_trees(trees, made, path))
        got = sorted((str(r["row"]["doc_id"]), r["n_tokens"], r["n_tokens_edited"], r["text"]) for r in done.collect())
        assert sorted((r[0], r[1]) for r in got) == sorted((i, len(ids_of(library, text))) for i, text in texts)
        assert all(r[2] == len(ids_of(library, r[3])) for r in got)
        trees, texts = done, sorted((r[0], r[3]) for r in got)
    long = edits.edit_trees(edits.write_trees(make([(1, prose(1, 5000))]), path), edits.standard_edits(F.col("text")), path).first()
    assert long["n_pretokens"] > 5000 and long["n_reencoded"] < 250
    assert edits.edit_trees(edits.write_trees(empty, path), second, path).collect() == []
    assert edits.write_trees(clashing, path).select("row.*").columns == [c for c in clashing.columns if c != "text"]
