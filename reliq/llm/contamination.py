"""Benchmark decontamination through a positional inverted index.

Test items become windows of consecutive words. The index stores, per term and text, the sorted
places of the term, for the two rarest terms of each window (rarity is counted over the whole
corpus). The two lists, shifted by their offsets in the window, are intersected; what survives is
compared with the whole window.

Texts are known by a 128-bit hash: copies of a text share their postings and matches. Terms are
64-bit hashes; a collision only adds a candidate, which the comparison of the window (128 bits)
drops again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reliq.llm.text import ascii_lower, key128, small_side, stored, whole_text

WINDOW = 10
#: Words that may stand between the terms of a window of a proximity match.
SLACK = 5
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: Rows up to which terms, anchors, candidates and matched texts are broadcast (at most 40 bytes each).
BROADCAST_ROWS = 500_000
TEXT = ["h1", "h2"]


def item_words(text: Column) -> Column:
    """Lower-cased words of digits, letters and characters beyond ASCII."""
    return F.array_remove(F.split(ascii_lower(text), SEPARATORS), "")


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Every window of every item: ``item_id``, ``w1`` and ``w2`` (its hash), ``terms``.

    An item of fewer words than ``size`` is one window; an item without words has none. A
    null item id stands for no item: its windows are found, but name none.
    """
    worded = items.select("item_id", item_words(whole_text(items)).alias("words"))
    # The step of one guards the sequence of an item without words, which the filter drops.
    last = F.greatest(F.size("words") - size, F.lit(0))
    starts = worded.filter(F.size("words") > 0).select("item_id", "words", F.explode(F.sequence(F.lit(0), last)).alias("i"))
    sliced = starts.select("item_id", F.slice("words", F.col("i") + 1, size).alias("terms"))
    w1, w2 = key128(F.col("terms"))
    return sliced.select("item_id", w1.alias("w1"), w2.alias("w2"), "terms").distinct()


def _worded(docs: DataFrame) -> DataFrame:
    text = whole_text(docs)
    h1, h2 = key128(text)
    return docs.select(h1.alias("h1"), h2.alias("h2"), item_words(text).alias("words"))


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Occurrences of each of some terms in all texts."""
    tokens = _worded(docs).select(F.explode("words").alias("word")).select(F.xxhash64("word").alias("term"))
    return tokens.join(terms, "term", "left_semi").groupBy("term").agg(F.count("*").alias("n"))


def anchors(tests: DataFrame, counts: DataFrame) -> DataFrame:
    """The rarest term of each window and its second rarest: ``w1, w2, width, term, offset, rank``.

    Windows with a term that no text has are left out. A window of one word has one anchor.
    """
    placed = tests.select("w1", "w2", F.size("terms").alias("width"), F.posexplode("terms").alias("offset", "word"))
    known = placed.select("w1", "w2", "width", "offset", F.xxhash64("word").alias("term")).join(counts, "term")
    ranked = known.groupBy("w1", "w2", "width").agg(
        F.sort_array(F.collect_list(F.struct("n", "offset", "term"))).alias("found")
    )
    whole = ranked.filter(F.size("found") == F.col("width"))
    both = whole.select("w1", "w2", "width", F.posexplode(F.slice("found", 1, 2)).alias("rank", "a"))
    return both.select("w1", "w2", "width", "a.term", "a.offset", "rank")


def positional_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings of some terms: ``term, h1, h2`` and the sorted ``places``, sorted by term."""
    tokens = _worded(docs).select("h1", "h2", F.posexplode("words").alias("place", "word"))
    found = tokens.select("h1", "h2", "place", F.xxhash64("word").alias("term")).join(terms, "term", "left_semi")
    lists = found.groupBy("term", *TEXT).agg(F.sort_array(F.collect_set("place")).alias("places"))
    return lists.sortWithinPartitions("term")


def _starts(index: DataFrame, chosen: DataFrame) -> DataFrame:
    """Places of terms, moved to where their windows would begin."""
    moved = index.join(chosen, "term").select("h1", "h2", "w1", "w2", "width", "offset", F.explode("places").alias("place"))
    return moved.select(*TEXT, "w1", "w2", "width", (F.col("place") - F.col("offset")).alias("start")).filter("start >= 0")


@dataclass(frozen=True)
class Index:
    """Written windows, their anchors, and the postings of the anchors' terms."""

    tests: DataFrame
    anchors: DataFrame
    postings: DataFrame


def indexed(docs: DataFrame, tests: DataFrame) -> Index:
    """The postings that exact and proximity matches of some windows are read from."""
    distinct = stored(tests.drop("item_id").distinct(), "windows")
    words = distinct.select(F.explode("terms").alias("word")).select(F.xxhash64("word").alias("term")).distinct()
    terms = small_side(stored(words, "terms"), BROADCAST_ROWS)
    chosen = stored(anchors(distinct, term_counts(docs, terms)), "anchors")
    rare = small_side(stored(chosen.select("term").distinct(), "anchor-terms"), BROADCAST_ROWS)
    return Index(distinct, chosen, stored(positional_index(docs, rare), "postings"))


def phrase_matches(docs: DataFrame, tests: DataFrame, index: Index | None = None) -> DataFrame:
    """Exact occurrences of windows, once per distinct text: ``h1, h2, w1, w2, start, width``."""
    index = index or indexed(docs, tests)
    first = _starts(index.postings, small_side(index.anchors.filter("rank = 0"), BROADCAST_ROWS))
    second = _starts(index.postings, small_side(index.anchors.filter("rank = 1"), BROADCAST_ROWS))
    place = [*TEXT, "w1", "w2", "start"]
    found = first.filter("width > 1").join(second.select(*place), place, "left_semi")
    candidates = stored(found.unionByName(first.filter("width = 1")), "candidates")
    return _confirmed(docs, candidates)


def _confirmed(docs: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates whose whole window stands in the text."""
    held = candidates.groupBy(*TEXT).agg(F.collect_list(F.struct("start", "width", "w1", "w2")).alias("found"))
    texts = F.broadcast(held) if candidates.count() <= BROADCAST_ROWS else held
    text = whole_text(docs)
    h1, h2 = key128(text)
    read = docs.select(h1.alias("h1"), h2.alias("h2"), text.alias("text")).join(texts, TEXT)
    worded = read.select(*TEXT, "found", item_words(F.col("text")).alias("words"))
    n = F.size("words")

    def stands(c: Column) -> Column:
        w1, w2 = key128(F.slice("words", c["start"] + 1, c["width"]))
        return (c["start"] + c["width"] <= n) & (w1 == c["w1"]) & (w2 == c["w2"])

    right = worded.select(*TEXT, F.explode(F.filter("found", stands)).alias("m"))
    # Copies of a text confirm the same matches.
    return right.select(*TEXT, "m.w1", "m.w2", "m.start", "m.width").distinct()


def _sections(index: Index, rank: int, slack: int) -> DataFrame:
    """Per window and text, the sections of ``width + slack`` words that hold the anchor of a rank."""
    held = index.postings.join(small_side(index.anchors.filter(F.col("rank") == rank), BROADCAST_ROWS), "term")
    length = F.col("width") + slack
    section = F.transform("places", lambda p: F.floor(p / length).cast("int"))
    return held.select(*TEXT, "w1", "w2", "width", F.array_distinct(section).alias("sections"))


def proximity_matches(docs: DataFrame, tests: DataFrame, slack: int, index: Index | None = None) -> DataFrame:
    """Texts that hold all terms of a window close together, in any order: ``h1, h2, w1, w2``.

    Some ``width + slack`` consecutive words must hold every term at least as often as the window
    does. Such words lie in the section of the rarest term or a neighbour, and so does the second
    rarest term: only sections of the first with one of the second beside it are read.
    """
    index = index or indexed(docs, tests)
    first = _sections(index, 0, slack)
    beside = F.flatten(F.transform("sections", lambda s: F.array(s - 1, s, s + 1))).alias("beside")
    second = _sections(index, 1, slack).select(*TEXT, "w1", "w2", beside)
    both = first.filter("width > 1").join(second, [*TEXT, "w1", "w2"])
    both = both.select(*TEXT, "w1", "w2", "width", F.array_intersect("sections", "beside").alias("sections"))
    found = both.filter(F.size("sections") > 0).unionByName(first.filter("width = 1"))
    candidates = stored(found, "near-candidates")
    at = candidates.select(*TEXT, "w1", "w2", (F.col("width") + slack).alias("length"), F.explode("sections").alias("section"))
    held = at.groupBy(*TEXT).agg(F.collect_list(F.struct("w1", "w2", "length", "section")).alias("found"))
    text = whole_text(docs)
    h1, h2 = key128(text)
    read = docs.select(h1.alias("h1"), h2.alias("h2"), text.alias("text")).join(small_side(stored(held, "near-texts"), BROADCAST_ROWS), TEXT)
    worded = read.select(*TEXT, "found", item_words(F.col("text")).alias("words"))

    def around(c: Column) -> Column:
        begin = F.greatest((c["section"] - 1) * c["length"], F.lit(0))
        words = F.slice("words", begin + 1, (c["section"] + 2) * c["length"] - begin)
        return F.struct(c["w1"].alias("w1"), c["w2"].alias("w2"), c["length"].alias("length"), words.alias("around"))

    cut = worded.select(*TEXT, F.explode(F.transform("found", around)).alias("c")).select(*TEXT, "c.*")
    near = cut.join(small_side(index.tests, BROADCAST_ROWS), ["w1", "w2"]).filter(F.size(F.array_except("terms", "around")) == 0)

    def enough(stretch: Column) -> Column:
        return F.forall("terms", lambda t: F.size(F.filter(stretch, lambda x: x == t)) >= F.size(F.filter("terms", lambda x: x == t)))

    starts = F.sequence(F.lit(1), F.greatest(F.size("around") - F.col("length") + 1, F.lit(1)))
    stands = F.exists(starts, lambda s: enough(F.slice("around", s, F.col("length"))))
    return near.filter(stands).select(*TEXT, "w1", "w2").distinct()


def _item_ids(matches: DataFrame, tests: DataFrame, name: str) -> DataFrame:
    """Per text, the sorted ids of the items whose windows it matches."""
    named = matches.select(*TEXT, "w1", "w2").distinct().join(tests.select("w1", "w2", "item_id"), ["w1", "w2"])
    return named.groupBy(*TEXT).agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias(name))


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW, slack: int | None = None) -> DataFrame:
    """Rows ``row`` (the columns of ``docs``), ``n_words``, ``n_hit`` and ``items``; with a ``slack`` also ``near``.

    ``n_hit`` counts the words inside any occurrence of a window, ``items`` are the sorted ids
    (as strings) of the items with such windows, ``near`` those of the items with a window whose terms
    stand within ``slack`` words more than it has, in any order, exact ones included. Null text has no words; repeated rows get
    equal results. Without test windows nothing is hit.
    """
    tests = stored(windows(items, size), "test-windows")
    index = indexed(docs, tests)
    hits = stored(phrase_matches(docs, tests, index), "matches")
    spans = hits.groupBy(*TEXT).agg(F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("width")).alias("end")))).alias("spans"))
    union = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n")),
        lambda a, s: F.struct(
            F.greatest(a["end"], s["end"]).alias("end"),
            (a["n"] + F.greatest(s["end"] - F.greatest(a["end"], s["start"]), F.lit(0))).alias("n"),
        ),
    )
    named = spans.join(_item_ids(hits, tests, "items"), TEXT).select(*TEXT, union["n"].alias("n_hit"), "items")
    lists = ["items"]
    if slack is not None:
        near = stored(proximity_matches(docs, tests, slack, index), "near-matches")
        named = named.join(_item_ids(near, tests, "near"), TEXT, "full")
        lists.append("near")
    matched = stored(named, "matched")
    text = whole_text(docs)
    h1, h2 = key128(text)
    whole = docs.select(
        F.struct(*[docs[name] for name in docs.columns]).alias("row"),
        h1.alias("h1"),
        h2.alias("h2"),
        F.size(item_words(text)).cast("bigint").alias("n_words"),
    )
    return whole.join(small_side(matched, BROADCAST_ROWS), TEXT, "left").select(
        "row",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        *[F.coalesce(name, F.array().cast("array<string>")).alias(name) for name in lists],
    )
