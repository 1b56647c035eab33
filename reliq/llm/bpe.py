"""Byte-level BPE: words of a compiled lexicon by one walk, all others by exact merges.

Encoding cuts a text at special tokens, then into pre-tokens, and encodes each pre-token on its
own. Pre-tokens that are frequent in the corpus are compiled into a lexicon (``lexicon.py``) that
executors map into memory; a pre-token outside it is merged pair by pair. The vocabulary file and
the lexicon reach executors as files of the Spark context.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reliq.llm.arrow import pieces, texts_of, with_columns
from reliq.llm.lexicon import Lexicon, compile_lexicon
from reliq.llm.sharing import share_bytes, share_file, ship_package
from reliq.llm.text import stored, whole_text

# Fixed value: how byte-level BPE cuts a text into pre-tokens.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PRE_TOKENS = regex.compile(PATTERN)
#: The same cuts by the standard library, for texts of these characters only: it is faster.
PLAIN_TOKENS = re.compile(r" ?[^\W\d_]+|'s|'t|'re|'ve|'m|'ll|'d| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
NOT_PLAIN = re.compile("[^\\x00-\\x1b\\x20-\\x7f\\xa0\\xc0-\u024f\u2013\u2014\u2018\u2019\u201c\u201d\u2026]")
#: Characters whose class is the same in every Unicode version: others are cut by the library itself.
OTHERS = regex.compile("[^\\u0000-\\u0557\\u1E00-\\u1FFF\\u2000-\\u206F\\u20A0-\\u20BF\\u3041-\\u30FF\\u4E00-\\u9FBF\\uAC00-\\uD7A3\\U0001F300-\\U0001F64F]")
#: A word is in the lexicon if more than one in so many pre-tokens is this word: a bound of its size.
LEXICON_WORDS = 1 << 16
#: Words a task remembers; beyond it the memory starts anew.
REMEMBERED = 500_000
#: Up to this many symbols the best pair is looked for anew after each merge, beyond it in a heap.
SHORT = 24
COUNTED = 200_000


def byte_letters() -> list[str]:
    """The character that stands for each byte in the vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Ids, merges and special tokens of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        letters = byte_letters()
        self.byte_of = {letter: b for b, letter in enumerate(letters)}
        vocab = content["model"]["vocab"]
        self.bytes_of = {i: bytes(self.byte_of[c] for c in token) for token, i in vocab.items()}
        self.id_of_byte = [vocab[letter] for letter in letters]
        # The rank of a pair of ids, and the id that a rank makes of its pair.
        self.ranks: dict[tuple[int, int], int] = {}
        self.merged: list[int] = []
        for rank, merge in enumerate(content["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.ranks[vocab[left], vocab[right]] = rank
            self.merged.append(vocab[left + right])
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        names = sorted(self.special, key=len, reverse=True)
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.path = path
        self._library = None
        longest = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)]
        self.token_bytes = np.frombuffer(b"".join(longest), np.uint8)
        self.token_sizes = np.array([len(token) for token in longest])
        self.token_starts = np.cumsum(self.token_sizes) - self.token_sizes

    def cut(self, text: str) -> list[str]:
        """The pre-tokens of a text without special tokens."""
        if not NOT_PLAIN.search(text):
            return PLAIN_TOKENS.findall(text)
        if not OTHERS.search(text):
            return PRE_TOKENS.findall(text)
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path).pre_tokenizer
        return [text[a:b] for _, (a, b) in self._library.pre_tokenize_str(text)]

    def segments(self, text: str) -> list[tuple[bool, str]]:
        """The text in parts, each with whether it is a special token."""
        if not self.at_special:
            return [(False, text)]
        return [(i % 2 == 1, part) for i, part in enumerate(self.at_special.split(text)) if part]

    def merge(self, word: bytes) -> list[int]:
        """The ids of a pre-token: always the merge of lowest rank first, leftmost among equals."""
        ids = [self.id_of_byte[b] for b in word]
        rank_of, merged, n = self.ranks.get, self.merged, len(ids)
        if n <= SHORT:
            return self._merge_short(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank, i) for i, pair in enumerate(zip(ids, ids[1:])) if (rank := rank_of(pair)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or rank_of((ids[i], ids[j])) != rank:
                continue
            ids[i], ids[j] = merged[rank], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (made := rank_of((ids[i], ids[after[i]]))) is not None:
                    heapq.heappush(heap, (made, i))
            if before[i] >= 0 and (made := rank_of((ids[before[i]], ids[i]))) is not None:
                heapq.heappush(heap, (made, before[i]))
        return [i for i in ids if i >= 0]

    def _merge_short(self, ids: list[int]) -> list[int]:
        rank_of, merged, never = self.ranks.get, self.merged, len(self.merged)
        ranks = [rank_of(pair, never) for pair in zip(ids, ids[1:])]
        while ranks and (least := min(ranks)) < never:
            i = ranks.index(least)
            made = ids[i] = merged[least]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank_of((ids[i - 1], made), never)
            if i < len(ranks):
                ranks[i] = rank_of((made, ids[i + 1]), never)
        return ids


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Remembered(dict):
    """Values by word, worked out when first asked for."""

    def __init__(self, make: Callable[[str], object]):
        super().__init__()
        self.make = make

    def __missing__(self, word: str):
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = self.make(word)
        return value


class Encoder:
    def __init__(self, vocab: Vocabulary, lexicon: Lexicon | None = None):
        self.vocab, self.lexicon = vocab, lexicon
        self.packed = Remembered(lambda word: array("i", self.word_ids(word)).tobytes())

    def word_ids(self, word: str) -> list[int]:
        raw = word.encode()
        found = self.lexicon.get(raw) if self.lexicon else None
        return self.vocab.merge(raw) if found is None else found

    def encode(self, text: str) -> bytes:
        """The ids of a whole text as packed 32-bit integers."""
        packed = self.packed.__getitem__
        parts = []
        for special, part in self.vocab.segments(text):
            if special:
                parts.append(np.int32(self.vocab.special[part]).tobytes())
            else:
                parts.extend(map(packed, self.vocab.cut(part)))
        return b"".join(parts)

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts of ids that end at some places; bytes that are no UTF-8 become replacement characters."""
        vocab = self.vocab
        sizes = vocab.token_sizes[ids]
        reached = np.concatenate(([0], np.cumsum(sizes)))
        places = np.repeat(vocab.token_starts[ids] - reached[:-1], sizes) + np.arange(reached[-1])
        raw = vocab.token_bytes[places].tobytes()
        cuts = reached[ends].tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip([0, *cuts], cuts)]


@lru_cache(maxsize=2)
def encoder(vocab_file: str, lexicon_file: str) -> Encoder:
    """The encoder of a worker, by the names of its Spark files."""
    return Encoder(vocabulary(SparkFiles.get(vocab_file)), Lexicon.mapped(SparkFiles.get(lexicon_file)))


def word_counts(docs: DataFrame, vocab_file: str) -> DataFrame:
    """How often each pre-token occurs in all texts: ``word``, ``n``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, found = vocabulary(SparkFiles.get(vocab_file)), Counter()

        def drained() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_pydict(
                {"word": pa.array(found.keys(), pa.string()), "n": pa.array(found.values(), pa.int64())}
            )
            found.clear()
            return batch

        for piece in pieces(batches):
            for text in texts_of(piece):
                for special, part in vocab.segments(text):
                    if not special:
                        found.update(vocab.cut(part))
            if len(found) > COUNTED:
                yield drained()
        yield drained()

    words = docs.select(whole_text(docs).alias("text")).mapInArrow(count, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, vocab_path: str, most_words: int = LEXICON_WORDS) -> str:
    """Compile the frequent pre-tokens of a corpus and share the file; fewer than ``most_words``.

    A word is frequent if its count times ``most_words`` is over the count of all words.
    """
    spark = ship_package(docs.sparkSession)
    counts = word_counts(docs, share_file(spark, vocab_path))
    counted = stored(counts, "pre-tokens")
    total = counted.agg(F.sum("n")).head()[0] or 0
    frequent = counted.filter(F.col("n") * most_words > total).select("word").collect()
    vocab = vocabulary(vocab_path)
    words = [row[0].encode() for row in frequent]
    return share_bytes(spark, compile_lexicon({word: vocab.merge(word) for word in words}), "lexicon")


def encode(docs: DataFrame, vocab_path: str, lexicon_file: str | None = None) -> DataFrame:
    """The columns of ``docs`` without ``text`` as ``row``, plus ``ids`` and the ``decoded`` text.

    A null text counts as empty and has no ids. Special tokens in a text get their own id.
    """
    spark = ship_package(docs.sparkSession)
    lexicon_file = lexicon_file or build_lexicon(docs, vocab_path)
    vocab_file = share_file(spark, vocab_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocab_file, lexicon_file)
        for piece in pieces(batches):
            packed = [coder.encode(text) for text in texts_of(piece)]
            ends = np.cumsum([0, *(len(ids) // 4 for ids in packed)]).astype(np.int32)
            flat = np.frombuffer(b"".join(packed), np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            texts = coder.decode(flat, ends[1:])
            yield with_columns(piece, ["text"], {"ids": ids, "decoded": pa.array(texts, pa.string())})

    rest = [docs[name] for name in docs.columns if name != "text"]
    given = docs.select(F.struct(*rest).alias("row"), whole_text(docs).alias("text"))
    schema = given.drop("text").schema.add("ids", T.ArrayType(T.IntegerType())).add("decoded", T.StringType())
    return given.mapInArrow(run, schema)
