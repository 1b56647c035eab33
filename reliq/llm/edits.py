"""Token counts that follow edits: a segment tree of pre-tokens per document.

A leaf holds a few pre-tokens, a node the characters and tokens below it. An edit finds its leaves
by descending through the character sums, cuts and encodes the text of those leaves and some
context anew until a boundary meets one from before, and updates the sums on the way up; the rest
of the document is not cut or encoded again. Trees are written beside their documents, so that the next
edits start from them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reliq.llm.arrow import pieces, texts_of
from reliq.llm.bpe import Remembered, Vocabulary, vocabulary
from reliq.llm.sharing import share_file, ship_package
from reliq.llm.text import whole_text
from reliq.session import fresh_dir

#: Pre-tokens of a new leaf.
LEAF = 8
#: Characters beyond its end that can change where a pre-token ends.
LOOK_AHEAD = 3
EDIT = T.StructType(
    [T.StructField("start", T.LongType()), T.StructField("stop", T.LongType()), T.StructField("insert", T.StringType())]
)


class SegmentTree:
    """The pre-tokens of a text with sums of their characters and tokens."""

    def __init__(self, words: list[str], cut: Callable[[str], list[str]], tokens: Callable[[str], int], look: int = LOOK_AHEAD):
        self.cut, self.tokens, self.look, self.encoded = cut, tokens, look, 0
        self._build(*self._leaves_of(words))

    @classmethod
    def restored(cls, text: str, lengths: np.ndarray, sizes: np.ndarray, counts: np.ndarray, *rules) -> SegmentTree:
        """The tree of which ``stored`` gave the lengths of pre-tokens, and their number and tokens by leaf."""
        tree = cls([], *rules)
        ends = np.cumsum(lengths)
        places = ends.tolist()
        words = [text[i:j] for i, j in zip([0, *places], places)]
        cuts = np.cumsum(sizes)
        reached = np.concatenate(([0], ends))[cuts]
        level = np.stack([np.diff(reached, prepend=0), counts], 1)
        stops = cuts.tolist()
        tree._build([words[i:j] for i, j in zip([0, *stops], stops)], level)
        return tree

    def stored(self) -> tuple[list[int], list[int], np.ndarray]:
        """Lengths of the pre-tokens, and by leaf their number and their tokens."""
        lengths = [len(word) for leaf in self.leaves for word in leaf]
        return lengths, [len(leaf) for leaf in self.leaves], self._level()[:, 1]

    def _leaves_of(self, words: list[str]) -> tuple[list[list[str]], np.ndarray]:
        """New leaves with their characters and tokens."""
        if not words:
            return [[]], np.zeros((1, 2), np.int64)
        starts = np.arange(0, len(words), LEAF)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        counts = np.fromiter(map(self.tokens, words), np.int64, len(words))
        level = np.stack([np.add.reduceat(lengths, starts), np.add.reduceat(counts, starts)], 1)
        return [words[i : i + LEAF] for i in range(0, len(words), LEAF)], level

    def _build(self, leaves: list[list[str]], level: np.ndarray) -> None:
        """Sums of characters and tokens over leaves; node i has the children 2 i and 2 i + 1."""
        self.leaves = leaves
        self.size = 1 << (len(leaves) - 1).bit_length()
        self.sums = np.zeros((2 * self.size, 2), np.int64)
        self.sums[self.size : self.size + len(leaves)] = level
        at = self.size
        while at > 1:
            at //= 2
            self.sums[at : 2 * at] = self.sums[2 * at : 4 * at : 2] + self.sums[2 * at + 1 : 4 * at : 2]

    def _level(self) -> np.ndarray:
        return self.sums[self.size : self.size + len(self.leaves)]

    @property
    def n_chars(self) -> int:
        return int(self.sums[1, 0])

    @property
    def n_tokens(self) -> int:
        return int(self.sums[1, 1])

    @property
    def text(self) -> str:
        return "".join(word for leaf in self.leaves for word in leaf)

    def find(self, place: int) -> tuple[int, int]:
        """The leaf with a character, and where the leaf begins; the last leaf with text beyond the end."""
        node, begin = 1, 0
        place = min(place, self.n_chars - 1)
        while node < self.size:
            node *= 2
            if begin + self.sums[node, 0] <= place:
                begin += int(self.sums[node, 0])
                node += 1
        return node - self.size, begin

    def _set(self, leaf: int, words: list[str]) -> None:
        self.leaves[leaf] = words
        node = self.size + leaf
        self.sums[node] = sum(map(len, words)), sum(map(self.tokens, words))
        while node > 1:
            node //= 2
            self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]

    def edit(self, start: int, stop: int, insert: str) -> None:
        """Put ``insert`` in place of the characters from ``start`` up to ``stop``, clipped to the text."""
        start = max(0, min(start, self.n_chars))
        stop = max(start, min(stop, self.n_chars))
        if not self.n_chars:
            self._replace(0, len(self.leaves) - 1, self.cut(insert))
            return
        first, begin = self.find(max(0, start - self.look))
        last, _ = self.find(stop)
        shift = len(insert) - (stop - start)
        ahead = 1
        while True:
            end = min(last + ahead, len(self.leaves) - 1)
            old = [word for leaf in self.leaves[first : end + 1] for word in leaf]
            before = "".join(old)
            text = before[: start - begin] + insert + before[stop - begin :]
            whole = end == len(self.leaves) - 1
            words = self.cut(text)
            if whole:
                self._replace(first, end, words)
                return
            # Ends of old leaves behind the edit, where they are now.
            ends, place = {}, begin
            for leaf in range(first, end + 1):
                place += int(self.sums[self.size + leaf, 0])
                if place >= stop:
                    ends[place - begin + shift] = leaf
            at = 0
            for i, word in enumerate(words):
                at += len(word)
                if at in ends and at >= start - begin + len(insert) and at + self.look <= len(text):
                    self._replace(first, ends[at], words[: i + 1])
                    return
            ahead *= 2

    def _replace(self, first: int, last: int, words: list[str]) -> None:
        """Spread new pre-tokens over the leaves from ``first`` to ``last``, or over new leaves if they are many."""
        self.encoded += len(words)
        if len(words) > 2 * LEAF * (last - first + 1):
            leaves, level = self._leaves_of(words)
            old = self._level()
            self._build([*self.leaves[:first], *leaves, *self.leaves[last + 1 :]], np.concatenate((old[:first], level, old[last + 1 :])))
            return
        each = -(-len(words) // (last - first + 1)) or 1
        for i, leaf in enumerate(range(first, last + 1)):
            self._set(leaf, words[i * each : (i + 1) * each])


def standard_edits(text: Column) -> Column:
    """Three edits of every text: an insertion after a third, a deletion in the middle, a new end."""
    n = F.length(text).cast("bigint")

    def edit(start: Column, stop: Column, insert: str) -> Column:
        return F.struct(start.alias("start"), stop.alias("stop"), F.lit(insert).alias("insert"))

    third, middle = F.floor(n / 3), F.floor(n / 2)
    return F.array(
        edit(third, third, " [revised] "),
        edit(middle, middle + 20, ""),
        edit(F.greatest(n - 5, F.lit(0)), n + 20, "!"),
    )


def tree_rules(vocab: Vocabulary) -> tuple[Callable[[str], list[str]], Callable[[str], int], int]:
    """How to cut a text, count the tokens of a pre-token, and how far an edit can reach.

    A special token is a pre-token of one token; an edit can make or break one that begins before it.
    """

    def cut(text: str) -> list[str]:
        return [word for special, part in vocab.segments(text) for word in ([part] if special else vocab.cut(part))]

    sizes = Remembered(lambda word: 1 if word in vocab.special else len(vocab.merge(word.encode())))
    return cut, sizes.__getitem__, LOOK_AHEAD + max(map(len, vocab.special), default=0)


#: What is written of a tree beside its text.
TREE = ("lengths", "sizes", "tokens")


def _lists(parts: list) -> pa.ListArray:
    """Lists of 32-bit integers."""
    offsets = np.cumsum([0, *map(len, parts)])
    flat = np.concatenate([np.asarray(part, np.int32) for part in parts]) if parts else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))


def _arrays(column: pa.ListArray) -> list[np.ndarray]:
    ends = np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False))
    return np.split(column.flatten().to_numpy(zero_copy_only=False), ends[:-1]) if len(column) else []


def _written(df: DataFrame) -> DataFrame:
    path = fresh_dir(df.sparkSession, "trees")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_trees(docs: DataFrame, vocab_path: str) -> DataFrame:
    """The written trees of all documents: ``row`` (the columns of ``docs`` but ``text``), ``text``,
    ``lengths`` (code points of each pre-token), ``sizes`` and ``tokens`` (pre-tokens and tokens of each leaf).

    A null text is empty; repeated rows have a tree each.
    """
    vocab_file = share_file(ship_package(docs.sparkSession), vocab_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = tree_rules(vocabulary(SparkFiles.get(vocab_file)))
        for piece in pieces(batches):
            trees = [SegmentTree(rules[0](text), *rules).stored() for text in texts_of(piece)]
            lists = [_lists([tree[i] for tree in trees]) for i in range(3)]
            yield pa.RecordBatch.from_arrays([piece.column("row"), piece.column("text"), *lists], ["row", "text", *TREE])

    rest = [docs[name] for name in docs.columns if name != "text"]
    given = docs.select(F.struct(*rest).alias("row"), whole_text(docs).alias("text"))
    schema = T.StructType(list(given.schema.fields))
    for name in TREE:
        schema = schema.add(name, T.ArrayType(T.IntegerType()))
    return _written(given.mapInArrow(run, schema))


def edit_trees(trees: DataFrame, edits: Column, vocab_path: str, keep_trees: bool = True) -> DataFrame:
    """Edits applied to written trees: ``row``, the new ``text``, ``n_tokens`` and ``n_pretokens`` before,
    ``n_tokens_edited``, ``n_reencoded`` (pre-tokens cut and encoded for the edits), and the new tree.

    ``edits`` is an array of ``start``, ``stop`` and ``insert`` in code points, applied in order,
    each to the text as it is by then; places outside the text are moved to its ends. Null
    edits and inserts count as empty; a null start is 0, a null stop is the start.
    """
    vocab_file = share_file(ship_package(trees.sparkSession), vocab_path)
    counted = ["n_tokens", "n_pretokens", "n_tokens_edited", "n_reencoded"]
    kept = list(TREE) if keep_trees else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = tree_rules(vocabulary(SparkFiles.get(vocab_file)))
        for piece in pieces(batches):
            counts, texts, after = [], [], []
            held = zip(texts_of(piece), *[_arrays(piece.column(name)) for name in TREE])
            for (text, lengths, sizes, tokens), edits in zip(held, piece.column("edits").to_pylist()):
                tree = SegmentTree.restored(text, lengths, sizes, tokens, *rules)
                before = tree.n_tokens
                for edit in edits or []:
                    if edit is not None:
                        start = edit["start"] or 0
                        tree.edit(start, start if edit["stop"] is None else edit["stop"], edit["insert"] or "")
                counts.append((before, len(lengths), tree.n_tokens, tree.encoded))
                texts.append(tree.text)
                if kept:
                    after.append(tree.stored())
            columns = [pa.array([row[i] for row in counts], pa.int64()) for i in range(4)]
            lists = [_lists([tree[i] for tree in after]) for i in range(len(kept))]
            arrays = [piece.column("row"), pa.array(texts, pa.string()), *columns, *lists]
            yield pa.RecordBatch.from_arrays(arrays, ["row", "text", *counted, *kept])

    given = trees.select("row", "text", *TREE, edits.cast(T.ArrayType(EDIT)).alias("edits"))
    schema = T.StructType([given.schema["row"], given.schema["text"]])
    for name in counted:
        schema = schema.add(name, T.LongType())
    for name in kept:
        schema = schema.add(name, T.ArrayType(T.IntegerType()))
    return given.mapInArrow(run, schema)


def edited_counts(docs: DataFrame, vocab_path: str) -> DataFrame:
    """``row`` (the columns of ``docs`` but ``text`` and ``edits``) and the counts of ``edit_trees`` for
    the ``edits`` of each row, from written trees; the new text is ``edited``.
    """
    trees = write_trees(docs, vocab_path)
    done = edit_trees(trees, F.col("row.edits"), vocab_path, keep_trees=False)
    return done.withColumn("row", F.col("row").dropFields("edits")).withColumnRenamed("text", "edited")
