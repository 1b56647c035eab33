"""Language-model scores: prediction by partial matching over bytes, pretrained on a corpus.

The model is a trie of byte contexts of up to ``ORDER`` bytes with the counts of the bytes that
follow them. A byte is predicted by the longest context of the trie; bytes that context has not
seen share its escape probability (its distinct followers over their number plus all it saw),
are looked up one byte shorter, and there the bytes seen before are excluded.

Counts are taken over all training texts by Spark, and every context seen there is in the trie,
which grows with the corpus. As it no longer changes, the code length of a byte is fixed by the
``ORDER`` bytes before it, and is worked out once however often these stand in the corpus:

- Contexts before more than one in ``CONTEXTS`` places become the states of an automaton with
  exact code lengths, walked through many pieces of text at a time.
- For places whose longest context is rarer, Spark works out the code lengths of all bytes that
  the texts have there from the stored counts. Those of more than one in ``HEAD_GRAMS`` places
  travel to the tasks, all others are joined.

Besides the model, a smoothed unigram score of words is returned. Frequent words (more than one
in ``HEAD_WORDS``) travel to the tasks, all others are joined.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reliq.llm.arrow import pieces, texts_of
from reliq.llm.sharing import ship_package
from reliq.llm.text import stored, whole_text

ORDER = 4
#: Contexts of one length in the automaton: fewer than this.
CONTEXTS = 16384
#: Bytes after rarer contexts whose code lengths are sent to the tasks: fewer than this.
HEAD_GRAMS = 1 << 21
#: Symbols a text may have after any context.
SYMBOLS = 255
#: Words whose counts are sent to the tasks: fewer than this.
HEAD_WORDS = 1 << 19
#: Bytes that no UTF-8 text has: what stands before a text, and the symbol of its end.
START, END = 0xFF, 0xFE
#: Bytes walked through at once, and the length of a piece.
WALKED, PIECE = 4 << 20, 1024
COUNTED_WORDS = 200_000
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training; one without an id is not."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 1


def stream_of(raws: list[bytes]) -> np.ndarray:
    """Lower-cased texts one after the other, each between start bytes and its end."""
    start, end = bytes([START]) * ORDER, bytes([END])
    joined = b"".join(part for raw in raws for part in (start, raw, end))
    return LOWERED[np.frombuffer(joined, np.uint8)]


def grams_of(stream: np.ndarray) -> np.ndarray:
    """Every byte from the ``ORDER``-th on with those before it, from near to far, as one number."""
    wide = stream.astype(np.int64)
    keys = wide[ORDER:].copy()
    for back in range(1, ORDER + 1):
        keys = (keys << 8) | wide[ORDER - back : len(wide) - back]
    return keys


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


class Grams:
    """Counts of a byte after the ``ORDER`` bytes before it: the byte, then those from near to far."""

    def __init__(self):
        self.keys, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, stream: np.ndarray) -> None:
        keys = np.sort(grams_of(stream)[stream[ORDER:] != START])
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        self.waiting.append((keys[first], np.diff(np.append(first, len(keys)))))
        self.size += len(first)
        if self.size > 2_000_000:
            self.settle()

    def settle(self) -> None:
        parts = [(self.keys, self.counts), *self.waiting]
        self.keys, self.counts = summed(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))
        self.waiting, self.size = [], 0

    def by_order(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Counts for every length of context; shorter ones are prefixes of the sorted keys."""
        self.settle()
        for order in range(ORDER + 1):
            keys = self.keys >> (8 * (ORDER - order))
            if len(keys):
                first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
                yield order, keys[first], np.add.reduceat(self.counts, first)


def corpus_counts(docs: DataFrame) -> DataFrame:
    """Counts over the texts not ``held_out``, stored: words (``kind`` -1, ``word``; the end of a
    text is the empty word) and bytes after contexts of each length (``kind`` 0 to ``ORDER``,
    ``gram``). ``held`` counts the bytes after whole contexts in texts held out."""
    ship_package(docs.sparkSession)
    names = ["kind", "word", "gram", "n", "held"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, others, words = Grams(), Grams(), Counter()

        def drained() -> pa.RecordBatch:
            size = len(words)
            arrays = [
                pa.array(np.full(size, -1, np.int32)),
                pa.array(list(words.keys()), pa.binary()),
                pa.nulls(size, pa.int64()),
                pa.array(list(words.values()), pa.int64()),
                pa.array(np.zeros(size, np.int64)),
            ]
            words.clear()
            return pa.RecordBatch.from_arrays(arrays, names)

        for piece in pieces(batches):
            raws, apart = [], []
            for text, held in zip(texts_of(piece), piece.column("held_out").to_pylist()):
                (apart if held else raws).append(text.encode())
            for part, kept in ((raws, grams), (apart, others)):
                if part:
                    kept.add(stream_of(part))
            for raw in raws:
                words.update(raw.lower().split())
            words[b""] += len(raws)
            if len(words) > COUNTED_WORDS:
                yield drained()
        yield drained()

        def counted(order: int, keys: np.ndarray, n: np.ndarray, held: np.ndarray) -> pa.RecordBatch:
            kinds = pa.array(np.full(len(keys), order, np.int32))
            return pa.RecordBatch.from_arrays([kinds, pa.nulls(len(keys), pa.binary()), *map(pa.array, (keys, n, held))], names)

        for order, keys, counts in grams.by_order():
            yield counted(order, keys, counts, np.zeros_like(counts))
        others.settle()
        yield counted(ORDER, others.keys, np.zeros_like(others.counts), others.counts)

    rows = docs.select("held_out", whole_text(docs).alias("text")).mapInArrow(
        count, "kind int, word binary, gram long, n long, held long"
    )
    return stored(rows.groupBy("kind", "word", "gram").agg(F.sum("n").alias("n"), F.sum("held").alias("held")), "counts")


@dataclass
class CodeLengths:
    """Sorted grams and log10 of the probability of their bytes."""

    grams: np.ndarray
    costs: np.ndarray

    def of(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which grams are known, and the costs of these (0 for others)."""
        if not len(self.grams):
            return np.zeros(len(grams), bool), np.zeros(len(grams))
        places = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        known = self.grams[places] == grams
        return known, np.where(known, self.costs[places], 0.0)


@dataclass
class Trie:
    """Contexts as states: log10 of every byte's probability in each, and the state it leads to."""

    costs: np.ndarray
    following: np.ndarray
    #: Whether the context of a state has ``ORDER`` bytes, so that none is longer.
    whole: np.ndarray

    @classmethod
    def build(cls, orders: np.ndarray, grams: np.ndarray, counts: np.ndarray) -> Trie:
        """From the counts of bytes after kept contexts (``order``, ``gram``, count)."""
        contexts = grams & ((np.int64(1) << (8 * orders)) - 1)
        symbols = (grams >> (8 * orders)).astype(np.int64)
        marks = (orders << 40) | contexts
        known = np.unique(np.append(marks, 0))
        size = len(known)
        table = np.zeros((size, 256))
        np.add.at(table, (np.searchsorted(known, marks), symbols), counts)
        order, context = known >> 40, known & ((1 << 40) - 1)

        def state(orders: np.ndarray, contexts: np.ndarray) -> np.ndarray:
            """The states of contexts; -1 for those that are not kept."""
            wanted = (orders << 40) | contexts
            places = np.minimum(np.searchsorted(known, wanted), size - 1)
            return np.where(known[places] == wanted, places, -1)

        shorter = state(np.maximum(order - 1, 0), np.where(order > 0, context >> 8, 0))
        costs = np.empty((size, 256), np.float32)
        following = np.zeros((size, 256), np.int32)
        for length in range(ORDER + 1):
            own = np.flatnonzero(order == length)
            for part in np.array_split(own, max(1, len(own) // 2048)):
                costs[part] = cls._code_lengths(table, shorter, part, length)
            if length:
                following[own] = following[shorter[own]]
            longer = np.flatnonzero(order == length + 1)
            before = state(order[longer] - 1, context[longer] & ((np.int64(1) << (8 * length)) - 1))
            linked = before >= 0
            following[before[linked], context[longer][linked] >> (8 * length)] = longer[linked]
        costs[:, START] = 0
        return cls(costs, following, order == ORDER)

    @staticmethod
    def _code_lengths(table: np.ndarray, shorter: np.ndarray, states: np.ndarray, length: int) -> np.ndarray:
        """log10 probabilities of all bytes in some contexts of one length."""
        alive = np.ones((len(states), 256), bool)
        alive[:, START] = False
        found, escaped, current = np.zeros((len(states), 256)), np.zeros(len(states)), states
        with np.errstate(divide="ignore", invalid="ignore"):
            for depth in range(length, -1, -1):
                seen = np.where(alive, table[current], 0)
                total, distinct = seen.sum(1), (seen > 0).sum(1)
                left = alive.sum(1) - distinct
                # Where every byte is seen there is nothing to escape to.
                whole = total + np.where(left > 0, distinct, 0)
                found = np.where(seen > 0, escaped[:, None] + np.log10(seen / whole[:, None]), found)
                escaped = escaped + np.where(total > 0, np.log10(np.where(left > 0, distinct, 1) / whole), 0.0)
                alive &= seen == 0
                if depth:
                    current = shorter[current]
            rest = alive.sum(1)
            return np.where(alive, escaped[:, None] - np.log10(np.maximum(rest, 1))[:, None], found)

    def scores(self, raws: list[bytes]) -> np.ndarray:
        """log10 of the probability of each text, its end included, by the contexts of the trie."""
        return self.split_scores(raws, None)[0]

    def split_scores(self, raws: list[bytes], others: CodeLengths | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The scores of texts where ``others`` has the places without a whole context, and the
        places it lacks: numbers of texts in order, and grams."""
        totals, owners, grams = [np.empty(0)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        batch: list[bytes] = []
        size, before = 0, 0
        for i, raw in enumerate(raws):
            batch.append(raw)
            size += len(raw)
            if size > WALKED or i + 1 == len(raws):
                each, owner, gram = self._walk(batch, others)
                totals.append(each)
                owners.append(owner + before)
                grams.append(gram)
                before += len(batch)
                batch, size = [], 0
        return np.concatenate(totals), np.concatenate(owners), np.concatenate(grams)

    def _walk(self, raws: list[bytes], others: CodeLengths | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        stream = stream_of(raws)
        rows = -(-len(stream) // PIECE)
        padded = np.full(ORDER + rows * PIECE, START, np.uint8)
        padded[ORDER : ORDER + len(stream)] = stream
        # Pieces start ORDER bytes early: after these the state does not depend on what came before.
        steps = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, ORDER + PIECE)[::PIECE].T).astype(np.int64)
        costs, following = self.costs.ravel(), self.following.ravel()
        state, spent, whole = np.zeros(rows, np.int64), np.empty((PIECE, rows), np.float32), np.empty((PIECE, rows), bool)
        for t, symbols in enumerate(steps):
            at = state * 256 + symbols
            if t >= ORDER:
                np.take(costs, at, out=spent[t - ORDER], mode="clip")
                if others is not None:
                    np.take(self.whole, state, out=whole[t - ORDER], mode="clip")
            state = following[at].astype(np.int64)
        each = spent.T.ravel()[: len(stream)].astype(np.float64)
        lengths = np.array([len(raw) + ORDER + 1 for raw in raws])
        starts = np.cumsum(lengths) - lengths
        owner, grams = np.empty(0, np.int64), np.empty(0, np.int64)
        if others is not None:
            short = np.flatnonzero(~whole.T.ravel()[: len(stream)] & (stream != START))
            grams = grams_of(stream)[short - ORDER]
            known, each[short] = others.of(grams)
            short, grams = short[~known], grams[~known]
            owner = np.searchsorted(starts, short, side="right") - 1
        return np.add.reduceat(each, starts), owner, grams


@dataclass
class Model:
    """The automaton of frequent contexts, and the code lengths of bytes after rarer ones: those
    sent to the tasks, and a frame of the others (``gram``, ``cost``)."""

    trie: Trie
    head: CodeLengths
    tail: DataFrame


def context_of(kind: Column | int) -> Column:
    """The context of ``gram``, which has ``kind`` bytes."""
    mask = F.lit((1 << (8 * kind)) - 1) if isinstance(kind, int) else F.expr("shiftleft(1L, 8 * kind) - 1")
    return F.col("gram").bitwiseAND(mask)


def unseen_costs(unseen: DataFrame, seen: DataFrame, contexts: DataFrame) -> DataFrame:
    """``gram``, ``times`` and ``cost`` of bytes never seen after their whole context."""
    above = contexts.select(
        (F.col("kind") + 1).alias("kind"), F.col("context").alias("above"), F.col("total").alias("more"), F.col("distinct").alias("others")
    )
    # What is left of the shorter context once the bytes seen after the longer one are excluded.
    left = F.col("more") - F.col("covered")
    whole = left + F.when(F.col("others") < SYMBOLS, F.col("others") - F.col("distinct")).otherwise(0)
    own = F.col("total") + F.when(F.col("distinct") < SYMBOLS, F.col("distinct")).otherwise(0)
    escapes = (
        contexts.withColumn("above", F.shiftright("context", 8))
        .join(above, ["kind", "above"], "left")
        .select(
            "kind",
            "context",
            F.log10(own).alias("own"),
            (F.log10("distinct") - F.log10(own)).alias("leave"),
            F.log10(whole).alias("whole"),
            F.when(left > 0, F.log10(F.col("others") - F.col("distinct")) - F.log10(whole)).otherwise(0.0).alias("step"),
        )
    )
    escapes = stored(escapes, "escapes")
    first = contexts.filter("kind = 0").select("distinct").head()
    rows = unseen
    for k in range(ORDER, -1, -1):
        # Contexts of two bytes and grams of two bytes are at most 65,536 each.
        here = escapes.filter(F.col("kind") == k).select(F.col("context").alias(f"c{k}"), *[F.col(x).alias(f"{x}{k}") for x in ("own", "leave", "whole", "step")])
        key = F.shiftright("gram", 8 * (ORDER - k))
        rows = rows.withColumn(f"c{k}", key.bitwiseAND(F.lit((1 << (8 * k)) - 1))).join(F.broadcast(here) if k <= 2 else here, f"c{k}", "left")
        if k < ORDER:
            grams = seen.filter(F.col("kind") == k).select(F.col("gram").alias(f"g{k}"), F.log10("n").alias(f"n{k}"))
            rows = rows.withColumn(f"g{k}", key).join(F.broadcast(grams) if k <= 1 else grams, f"g{k}", "left")
    # Of a byte looked up at an order from a longer stored context, and of one whose longest stored context has that order.
    below = F.lit(-float(np.log10(max(SYMBOLS - (first[0] if first else 0), 1))))
    cost = below
    for k in range(ORDER + 1):
        found = F.col(f"n{k}") if k < ORDER else F.lit(None).cast("double")
        cost = F.when(F.col(f"own{k}").isNull(), cost).otherwise(F.coalesce(found - F.col(f"own{k}"), F.col(f"leave{k}") + below))
        if k < ORDER:
            below = F.coalesce(found - F.col(f"whole{k + 1}"), F.col(f"step{k + 1}") + below)
    return rows.select("gram", "times", cost.alias("cost"))


def build_model(counts: DataFrame) -> Model:
    """All contexts of the training texts. Those that stand before more than one in ``CONTEXTS``
    places become states; the rest is worked out for the bytes that any text has after them."""
    seen = counts.filter("kind >= 0 and n > 0").select("kind", "gram", "n", context_of(F.col("kind")).alias("context"))
    shorter = seen.select((F.col("kind") + 1).alias("kind"), F.col("gram").alias("above"), F.col("n").alias("more"))
    linked = seen.withColumn("above", F.shiftright("gram", 8)).join(shorter, ["kind", "above"], "left")
    contexts = stored(
        linked.groupBy("kind", "context").agg(F.sum("n").alias("total"), F.count("*").alias("distinct"), F.sum("more").alias("covered")),
        "contexts",
    )
    places = contexts.filter("kind = 0").agg(F.sum("total")).head()[0] or 0
    frequent = F.col("total") * CONTEXTS > places
    rows = seen.join(contexts.filter(frequent), ["kind", "context"], "left_semi").select("kind", "gram", "n").toPandas()
    trie = Trie.build(*[rows[name].to_numpy(np.int64) for name in ("kind", "gram", "n")])

    whole = counts.filter(F.col("kind") == ORDER).select("gram", "n", (F.col("n") + F.col("held")).alias("times"))
    everywhere = whole.agg(F.sum("times")).head()[0] or 0
    longest = contexts.filter(F.col("kind") == ORDER).select("context", "total", "distinct")
    rare = whole.withColumn("context", context_of(ORDER)).join(longest, "context", "left").filter(F.col("total").isNull() | ~frequent)
    size = F.col("total") + F.when(F.col("distinct") < SYMBOLS, F.col("distinct")).otherwise(0)
    known = rare.filter("n > 0").select("gram", "times", (F.log10("n") - F.log10(size)).alias("cost"))
    costs = stored(known.union(unseen_costs(rare.filter("n = 0").select("gram", "times"), seen, contexts)), "lengths")
    often = F.col("times") * HEAD_GRAMS > everywhere
    head = costs.filter(often).select("gram", "cost").toArrow()
    grams = head.column("gram").to_numpy()
    order = np.argsort(grams)
    return Model(trie, CodeLengths(grams[order], head.column("cost").to_numpy()[order].astype(np.float32)), costs.filter(~often).select("gram", "cost"))


def score(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` and ``score``.

    The model learns from the rows that are not held out. Texts are lower-cased (A-Z); a null
    text is empty, and has one token, its end. Repeated rows are scored, and learned from, one
    by one. Without training rows every byte is equally likely and no token is known.
    """
    spark = ship_package(docs.sparkSession)
    given = docs.select(docs["doc_id"].alias("doc_id"), held_out(docs["doc_id"]).alias("held_out"), whole_text(docs).alias("text"))
    counts = corpus_counts(given)
    words = counts.filter("kind = -1").select("word", "n")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).head()
    scale = total + 0.5 * (distinct + 1)
    head = words.filter(F.col("n") * HEAD_WORDS > total).toArrow()
    logs = np.log10((head.column("n").to_numpy() + 0.5) / scale)
    model = build_model(counts)
    shared = spark.sparkContext.broadcast((dict(zip(head.column("word").to_pylist(), logs.tolist())), model.trie, model.head))
    names = ["uid", "doc_id", "held_out", "n_tokens", "known", "base", "score", "words", "times", "grams", "gram_times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_logs, trie, lengths = shared.value
        uid = TaskContext.get().partitionId() << 33
        for piece in pieces(batches):
            raws = [text.encode() for text in texts_of(piece)]
            tokens, known, base, rare, times = [], [], [], [], []
            for raw in raws:
                found = Counter(raw.lower().split())
                found[b""] = 1
                hits, sums, unknown = 0, 0.0, []
                for word, n in found.items():
                    value = known_logs.get(word)
                    if value is None:
                        unknown.append(word)
                    else:
                        hits += n
                        sums += n * value
                tokens.append(found.total())
                known.append(hits)
                base.append(sums)
                rare.append(unknown)
                times.append([found[word] for word in unknown])
            scores, owners, grams = trie.split_scores(raws, lengths)
            # Each gram once per text, with how often it has it.
            order = np.lexsort((grams, owners))
            owners, grams = owners[order], grams[order]
            first = np.flatnonzero(np.concatenate(([True], (owners[1:] != owners[:-1]) | (grams[1:] != grams[:-1])))) if len(grams) else owners
            offsets = pa.array(np.searchsorted(owners[first], np.arange(len(raws) + 1)).astype(np.int32))
            arrays = [
                pa.array(np.arange(uid, uid + len(raws))),
                piece.column("doc_id"),
                piece.column("held_out"),
                pa.array(tokens, pa.int64()),
                pa.array(known, pa.int64()),
                pa.array(base, pa.float64()),
                pa.array(scores),
                pa.array(rare, pa.list_(pa.binary())),
                pa.array(times, pa.list_(pa.int64())),
                pa.ListArray.from_arrays(offsets, pa.array(grams[first])),
                pa.ListArray.from_arrays(offsets, pa.array(np.diff(np.append(first, len(grams))))),
            ]
            uid += len(raws)
            yield pa.RecordBatch.from_arrays(arrays, names)

    kind = given.schema["doc_id"].dataType.simpleString()
    layout = (
        f"uid long, doc_id {kind}, held_out boolean, n_tokens long, known long, base double, score double, "
        "words array<binary>, times array<long>, grams array<long>, gram_times array<long>"
    )
    scored = stored(given.mapInArrow(run, layout), "scores")
    rare = scored.select("uid", F.explode(F.arrays_zip("words", "times")).alias("r")).select("uid", "r.words", "r.times")
    tail = words.filter(F.col("n") * HEAD_WORDS <= total)
    joined = rare.join(tail, rare["words"] == tail["word"], "left")
    value = F.log10((F.coalesce("n", F.lit(0)) + 0.5) / F.lit(scale))
    by_word = joined.select(
        "uid",
        (F.col("times") * value).alias("more"),
        F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0).alias("found"),
        F.lit(0.0).alias("longer"),
    )
    places = scored.select("uid", F.explode(F.arrays_zip("grams", "gram_times")).alias("r")).select("uid", F.col("r.grams").alias("gram"), "r.gram_times")
    by_gram = places.join(model.tail, "gram").select(
        "uid", F.lit(0.0).alias("more"), F.lit(0).cast("bigint").alias("found"), (F.col("gram_times") * F.col("cost")).alias("longer")
    )
    sums = by_word.union(by_gram).groupBy("uid").agg(*[F.sum(name).alias(name) for name in ("more", "found", "longer")])
    return scored.drop("words", "times", "grams", "gram_times").join(sums, "uid", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("found", F.lit(0))).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("longer", F.lit(0.0))).alias("score"),
    )
