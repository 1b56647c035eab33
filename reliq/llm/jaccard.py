"""Near duplicates by word shingles: a size-aware heavy-light join.

Documents with equal shingle sets form a class; classes are joined. All tasks order the shingles
of a set alike: those of heavy buckets (many sets) last. Two sets that overlap in at least 75 in
100 share their first common shingle, so

* small sets enumerate every two-shingle subset of their prefix, and meet by equal subsets;
* large sets enter their prefix into inverted lists, which are scanned in order.

The boundary between them is where a subset enumeration costs as much as scanning the lists. Sets
near the boundary do both. A list or subset links each member to its smallest member only (its
cell), never all pairs. Within a cell the whole sets are compared: all members of a large cell with its
smallest set first, then only those that are not linked to it with all others, block by block.

Prefixes are longer than one shared shingle needs: linked large sets share k list keys at least.
Each set may then leave cells that hold fewer than half of k of its keys in all: two linked sets
together leave fewer than the k keys they share, so one cell still has both.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from reliq.llm.arrow import pieces, texts_of
from reliq.llm.components import components
from reliq.llm.sharing import ship_package
from reliq.llm.text import key128, small_side, stored, whole_text

WORDS = 5
#: Sets are linked when 100 * shared >= PERCENT * all.
PERCENT = 75
#: Buckets of shingles for the common order: 8 bytes each at most, however large the corpus.
BUCKETS = 1 << 20
#: Largest boundary between small and large sets.
MOST_SMALL = 64
#: Members of a block of a cell.
BLOCK = 1024
BROADCAST_ROWS = 1_000_000
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Hashes of words, kept for a bounded number of them."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 300_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


@lru_cache(maxsize=1)
def word_hashes() -> WordHashes:
    return WordHashes()


def shingle_set(text: str) -> np.ndarray:
    """The sorted distinct hashes of the text's shingles of ``WORDS`` lower-cased words.

    A text of fewer words has one shingle, its whole sequence; a text without words has none.
    """
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(word_hashes().__getitem__, words), np.uint64, len(words))
    if len(words) < WORDS:
        total = (hashes * FACTORS[: len(words)]).sum(dtype=np.uint64) + np.uint64(len(words))
        return mixed(np.array([total], np.uint64))
    last = len(words) - WORDS + 1
    found = hashes[:last] * FACTORS[0]
    for i in range(1, WORDS):
        found += hashes[i : last + i] * FACTORS[i]
    found = np.sort(mixed(found))
    return found[np.concatenate(([True], found[1:] != found[:-1]))]


def class_of(shingles: np.ndarray, shared: frozenset[int] = frozenset()) -> int:
    """The id of all sets with these shingles: 63 bits of a hash of the whole set.

    ``shared`` holds the ids under which different sets have met; those take 63 other bits.
    """
    low, high = both_classes(shingles)
    return high if low in shared else low


def both_classes(shingles: np.ndarray) -> tuple[int, int]:
    whole = xxhash.xxh3_128_intdigest(shingles)
    return whole & ((1 << 63) - 1), whole >> 65


def bucket_of(shingles: np.ndarray) -> np.ndarray:
    return (shingles & np.uint64(BUCKETS - 1)).astype(np.int64)


def overlap_needed(n: int) -> int:
    """Shingles that a set of ``n`` shares at least with any set it is linked to."""
    return -(-PERCENT * n // 100)


def sized_sets(docs: DataFrame) -> tuple[DataFrame, DataFrame, frozenset[int]]:
    """Per row ``doc_id``, its text's hash (``h1``, ``h2``), ``n`` (shingles) and ``class``; the heavy buckets,
    ``bucket`` and ``hits``; and the ids under which different sets have met.

    A set without shingles has no class. A bucket is heavy if it stands out in some task, and
    has the counts of those tasks: they only steer the order of shingles, any such table gives the
    same links. All come from one pass over the texts, which is stored. Of ids of 63 bits, some five
    are shared at ten billion sets; they are found by the other bits of the hash.
    """
    ship_package(docs.sparkSession)
    names = ["doc_id", "h1", "h2", "n", "class", "other", "bucket", "hits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = np.zeros(BUCKETS, np.int64), set()
        for piece in pieces(batches):
            sets = [shingle_set(text) for text in texts_of(piece)]
            both = [both_classes(s) if len(s) else (None, None) for s in sets]
            fresh = []
            for (key, _), shingles in zip(both, sets):
                if key is not None and key not in seen:
                    fresh.append(shingles)
                    if len(seen) < 300_000:
                        seen.add(key)
            if fresh:
                np.add.at(counts, bucket_of(np.concatenate(fresh)), 1)
            none, sizes = pa.nulls(len(sets), pa.int64()), pa.array([len(s) for s in sets], pa.int64())
            given = [piece.column(name) for name in names[:3]]
            classes = [pa.array([pair[k] for pair in both], pa.int64()) for k in range(2)]
            yield pa.RecordBatch.from_arrays([*given, sizes, *classes, none, none], names)
        mean = counts.mean()
        heavy = np.flatnonzero(counts > mean + 6 * mean**0.5 + 8)
        none = pa.nulls(len(heavy), pa.int64())
        yield pa.RecordBatch.from_arrays([none.cast(doc_id), *[none] * 5, pa.array(heavy), pa.array(counts[heavy])], names)

    text = whole_text(docs)
    h1, h2 = key128(text)
    kind = docs.schema["doc_id"].dataType
    doc_id = to_arrow_type(kind)
    given = docs.select(docs["doc_id"], h1.alias("h1"), h2.alias("h2"), text.alias("text"))
    layout = f"doc_id {kind.simpleString()}, " + ", ".join(f"{name} long" for name in names[1:])
    rows = stored(given.mapInArrow(run, layout), "sets")
    heavy = rows.filter("bucket is not null").groupBy("bucket").agg(F.sum("hits").alias("hits"))
    sets = rows.filter("bucket is null").drop("bucket", "hits")
    met = sets.filter("class is not null").groupBy("class").agg(F.min("other").alias("a"), F.max("other").alias("b"))
    shared = frozenset(row["class"] for row in met.filter("a <> b").select("class").collect())
    if shared:
        sets = sets.withColumn("class", F.when(F.col("class").isin(list(shared)), F.col("other")).otherwise(F.col("class")))
    return sets.drop("other"), stored(heavy, "heavy"), shared


def prefix(shingles: np.ndarray, weights: np.ndarray, shared: int) -> np.ndarray:
    """The first shingles in the common order: two linked sets share ``shared`` of them."""
    length = len(shingles) - overlap_needed(len(shingles)) + shared
    order = np.lexsort((shingles, weights[bucket_of(shingles)]))
    return shingles[order[:length]]


def keys_shared(n: int) -> int:
    """List keys that a set of ``n`` shares at least with any linked set of its size or more."""
    return 1 + (n - overlap_needed(n) + 1) // 2


def keys_spared(n: Column, small: int) -> Column:
    """List keys whose cells a set may leave: less than half of what it shares with its smallest partner."""
    partner = F.ceil(n * PERCENT / 100)
    shared = 1 + F.floor((partner - F.ceil(partner * PERCENT / 100) + 1) / 2)
    return F.when(n > small, F.floor((shared - 1) / 2)).otherwise(0)


def boundary(list_length: float) -> int:
    """The largest small set: enumerating its subsets costs no more than scanning its lists."""
    small = 2
    for n in range(3, MOST_SMALL + 1):
        single = n - overlap_needed(n) + 1
        if single * (single + 1) / 2 <= single * list_length:
            small = n
    return small


def signatures(shingles: np.ndarray, weights: np.ndarray, small: int) -> np.ndarray:
    """The keys under which a set meets the sets it may be linked to."""
    n = len(shingles)
    found = []
    if 2 <= n <= small:
        first = prefix(shingles, weights, 2)
        i, j = np.triu_indices(len(first), 1)
        low, high = np.minimum(first[i], first[j]), np.maximum(first[i], first[j])
        found.append(mixed(low * FACTORS[1] + high * FACTORS[2] + np.uint64(1)))
    if 100 * n > PERCENT * small and n >= 2:
        found.append(prefix(shingles, weights, keys_shared(n)))
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def cells(docs: DataFrame, sized: DataFrame, heavy: DataFrame, list_length: float, ids: frozenset[int] = frozenset()) -> DataFrame:
    """``cell`` and ``member``: the classes of each list or subset, under its smallest class; ``members`` of
    the cell, and ``center``, the smallest of them.

    Every pair of linked classes is in a cell; ``sized`` holds the ``class`` and ``n`` of all sets, ``ids``
    are the class ids that different sets share.
    """
    spark = ship_package(docs.sparkSession)
    # At most BUCKETS rows of 16 bytes.
    table = heavy.toPandas()
    steering = spark.sparkContext.broadcast((table["bucket"].to_numpy(np.int64), table["hits"].to_numpy(np.int64)))
    small = boundary(list_length)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(BUCKETS, np.int64)
        weights[steering.value[0]] = steering.value[1]
        seen: set[int] = set()
        for piece in pieces(batches):
            keys, owners = [], []
            for text in texts_of(piece):
                shingles = shingle_set(text)
                if not len(shingles) or (key := class_of(shingles, ids)) in seen:
                    continue
                if len(seen) < 300_000:
                    seen.add(key)
                own = signatures(shingles, weights, small)
                keys.append(own)
                owners.append(np.full(len(own), key, np.int64))
            if keys:
                arrays = [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(owners))]
                yield pa.RecordBatch.from_arrays(arrays, ["key", "class"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key = last_owner = last_cell = None
        for batch in batches:
            keys, owners = batch.column("key").to_numpy(), batch.column("class").to_numpy()
            if not len(keys):
                continue
            starts = np.concatenate(([keys[0] != last_key], keys[1:] != keys[:-1]))
            fresh = starts | np.concatenate(([owners[0] != last_owner], owners[1:] != owners[:-1]))
            places = np.maximum.accumulate(np.where(starts, np.arange(len(keys)), -1))
            own = np.where(places < 0, last_cell, owners[places])
            last_key, last_owner, last_cell = keys[-1], owners[-1], own[-1]
            own, member = own[fresh], owners[fresh]
            order = np.lexsort((member, own))
            own, member = own[order], member[order]
            first = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (member[1:] != member[:-1]))))[: len(own)]
            counts = np.diff(np.append(first, len(own)))
            arrays = [pa.array(own[first]), pa.array(member[first]), pa.array(counts)]
            yield pa.RecordBatch.from_arrays(arrays, ["cell", "member", "keys"])

    given = docs.select(whole_text(docs).alias("text"))
    postings = given.mapInArrow(post, "key long, class long")
    ordered = postings.repartition("key").sortWithinPartitions("key", "class")
    stars = ordered.mapInArrow(scan, "cell long, member long, keys long")
    # Written, because it is read twice: a class alone in its own cell meets nobody there.
    counted = stored(stars.groupBy("cell", "member").agg(F.sum("keys").alias("keys")), "counted")
    shared = counted.filter("cell <> member").select("cell").distinct()
    met = stored(counted.join(shared, "cell", "left_semi"), "cells")
    sizes = sized.filter("class is not null").groupBy(F.col("class").alias("member")).agg(F.first("n").alias("n"))
    left = F.sum("keys").over(Window.partitionBy("member").orderBy("keys", "cell"))
    chosen = met.join(sizes, "member").withColumn("left", left).filter(F.col("left") > keys_spared(F.col("n"), small))
    kept = chosen.select("cell", "member")
    several = kept.groupBy("cell").agg(F.count("*").alias("members"), F.min("member").alias("center")).filter("members > 1")
    # Written first, so that the join deals both sides anew and can split a large cell.
    return stored(kept, "kept").join(stored(several, "several"), "cell")


def packed_sets(docs: DataFrame, ids: frozenset[int] = frozenset()) -> DataFrame:
    """``class`` and the low 48 bits of its shingles, at least once per class and task."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for piece in pieces(batches):
            keys, sets = [], []
            for text in texts_of(piece):
                shingles = shingle_set(text)
                if not len(shingles) or (key := class_of(shingles, ids)) in seen:
                    continue
                if len(seen) < 300_000:
                    seen.add(key)
                keys.append(key)
                sets.append(np.sort(shingles & np.uint64((1 << 48) - 1)).view(np.uint8).reshape(-1, 8)[:, :6].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sets, pa.binary())], ["class", "set"])

    return docs.select(whole_text(docs).alias("text")).mapInArrow(run, "class long, set binary")


def unpacked(packed: bytes) -> np.ndarray:
    wide = np.zeros((len(packed) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    return wide.view(np.uint64).ravel()


class Forest:
    """Components of the members of a block while their links are found."""

    def __init__(self, size: int):
        self.root = np.arange(size)

    def union(self, a: int, others: np.ndarray) -> list[int]:
        """Join ``a`` with others; those that were apart before."""
        joined = []
        for b in others:
            if self.root[a] != self.root[b]:
                self.root[self.root == self.root[b]] = self.root[a]
                joined.append(int(b))
        return joined

    def next_open(self, done: np.ndarray) -> int | None:
        """A member that is not compared yet and not in the largest component."""
        largest = np.bincount(self.root).argmax()
        rest = np.flatnonzero(~done & (self.root != largest))
        return int(rest[0]) if len(rest) else None


def block_links(sets: list[np.ndarray], asked: list[int] | None = None) -> list[tuple[int, int]]:
    """Links that join the sets of a block as all their links would, or all links of the sets ``asked``.

    Every set asked is compared with all others, through the inverted lists of the block; where none
    are named, every set outside the largest component is: within a component nothing is left to find.
    """
    sizes = np.array([len(s) for s in sets])
    tokens, ids = np.unique(np.concatenate(sets), return_inverse=True)
    owners = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(ids, kind="stable")
    lists, ends = owners[order], np.concatenate(([0], np.cumsum(np.bincount(ids, minlength=len(tokens)))))
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    forest, done, links = Forest(len(sets)), np.zeros(len(sets), bool), []
    left = iter(asked or ())
    current = next(left, None) if asked is not None else 0
    while current is not None:
        done[current] = True
        own = ids[offsets[current] : offsets[current + 1]]
        lengths = ends[own + 1] - ends[own]
        places = np.repeat(ends[own] - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths) + np.arange(lengths.sum())
        shared = np.bincount(lists[places], minlength=len(sets))
        every = sizes + sizes[current] - shared
        alike = np.flatnonzero(100 * shared >= PERCENT * every)
        links += [(current, b) for b in forest.union(current, alike[alike != current])]
        current = next(left, None) if asked is not None else forest.next_open(done)
    return links


def with_center(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """``cell``, ``member``, ``center`` and whether both are ``alike``, for the members of large cells."""
    middle = rows.select("cell", F.col("center").alias("class")).distinct().join(sets, "class")
    pairs = rows.select("cell", "center", F.col("member").alias("class")).join(sets, "class")
    both = pairs.join(middle.select("cell", F.col("set").alias("middle")), "cell")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, middle = None, np.empty(0, np.uint64)
        for batch in batches:
            alike = []
            for own, other in zip(batch.column("set").to_pylist(), batch.column("middle").to_pylist()):
                if other != last:
                    last, middle = other, unpacked(other)
                one = unpacked(own)
                shared = len(np.intersect1d(one, middle, assume_unique=True))
                alike.append(100 * shared >= PERCENT * (len(one) + len(middle) - shared))
            kept = [batch.column(name) for name in ("cell", "class", "center")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(alike, pa.bool_())], ["cell", "member", "center", "alike"])

    read = both.select("cell", "class", "center", "set", "middle")
    return stored(read.mapInArrow(compare, "cell long, member long, center long, alike boolean"), "centers")


def links(docs: DataFrame, sized: DataFrame, found: DataFrame, ids: frozenset[int] = frozenset()) -> DataFrame:
    """Links between the members of cells, enough to join all that are linked: ``a``, ``b``.

    The members of a cell of at most ``BLOCK`` are compared in one task. Those of a larger one are
    compared with its center, one row each; members that are not linked to it are compared with all
    others: each block of members meets each block of these strays. Members that are linked to
    the center are in one component, and between them nothing is left to find.
    """
    ship_package(docs.sparkSession)
    # One text of each class that has a cell is taken apart once more.
    wanted = sized.join(found.select(F.col("member").alias("class")).distinct(), "class", "left_semi")
    first = wanted.groupBy("class").agg(F.min(F.struct("h1", "h2")).alias("t")).select("t.h1", "t.h2")
    first = small_side(stored(first.distinct(), "candidates"), BROADCAST_ROWS)
    h1, h2 = key128(whole_text(docs))
    texts = docs.select(whole_text(docs).alias("text"), h1.alias("h1"), h2.alias("h2")).join(first, ["h1", "h2"], "left_semi")
    sets = packed_sets(texts, ids).dropDuplicates(["class"])
    large = found.filter(F.col("members") > BLOCK)
    nothing = F.lit(0)
    dealt = found.filter(F.col("members") <= BLOCK).select("cell", nothing.alias("i"), nothing.alias("j"), F.col("member").alias("class"), F.lit(None).cast("boolean").alias("stray"))
    joined = None
    if not large.isEmpty():
        sets = stored(sets, "candidate-sets")
        judged = with_center(large, sets)
        joined = judged.filter("alike and member <> center").select(F.col("center").alias("a"), F.col("member").alias("b"))
        counts = judged.groupBy("cell").agg(F.count("*").alias("members"), F.count_if(~F.col("alike")).alias("strays"))
        blocks = [F.ceil(F.col(name) / BLOCK).cast("int") for name in ("members", "strays")]
        split = judged.join(stored(counts.filter("strays > 0"), "strays"), "cell")
        split = split.withColumns({"rows": blocks[0], "columns": blocks[1], "hash": F.xxhash64("member", "cell")})
        own, asked = F.pmod("hash", F.col("rows")).cast("int"), F.pmod("hash", F.col("columns")).cast("int")

        def every(name: str) -> Column:
            return F.explode(F.sequence(F.lit(0), F.col(name) - 1))

        base = split.select("cell", own.alias("i"), every("columns").alias("j"), F.col("member").alias("class"), F.lit(False).alias("stray"))
        strays = split.filter(~F.col("alike")).select("cell", every("rows").alias("i"), asked.alias("j"), F.col("member").alias("class"), F.lit(True).alias("stray"))
        dealt = dealt.unionByName(base).unionByName(strays)
    rows = dealt.join(sets, "class").repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, members, packed, strays = None, [], [], []

        def closed() -> pa.RecordBatch:
            asked = [i for i, stray in enumerate(strays) if stray] if strays[0] is not None else None
            ends = block_links([unpacked(p) for p in packed], asked) if len(members) > 1 else []
            ends = [(members[i], members[j]) for i, j in ends if members[i] != members[j]]
            arrays = [pa.array([pair[k] for pair in ends], pa.int64()) for k in range(2)]
            return pa.RecordBatch.from_arrays(arrays, ["a", "b"])

        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("cell", "i", "j", "class", "set", "stray")]
            for cell, i, j, member, content, stray in zip(*columns):
                if (cell, i, j) != block:
                    if members:
                        yield closed()
                    block, members, packed, strays = (cell, i, j), [], [], []
                members.append(member)
                packed.append(content)
                strays.append(stray)
        if members:
            yield closed()

    made = rows.select("cell", "i", "j", "class", "set", "stray").mapInArrow(compare, "a long, b long")
    return made if joined is None else made.unionByName(joined)


def grouped(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``h1``, ``h2``, ``n``, ``class`` and ``component`` (of its class; null without shingles)."""
    sized, heavy, ids = sized_sets(docs)
    shingles = sized.agg(F.sum("n")).head()[0] or 0
    seen, squares = heavy.agg(F.sum("hits"), F.sum(F.col("hits").cast("double") * F.col("hits"))).head()
    # How many sets a list holds on average, if lists were as long as the heavy buckets say.
    list_length = 1 + min(15.0, (squares / shingles) if shingles and seen else 0.0)
    found = stored(cells(docs, sized, heavy, list_length, ids), "members")
    groups = stored(components(stored(links(docs, sized, found, ids), "class-links")), "class-components")
    joined = sized.join(groups.withColumnRenamed("node", "class"), "class", "left")
    return joined.withColumn("component", F.coalesce("component", "class"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_shingles`` and ``component_id``, the smallest doc_id
    that links reach.

    Null text counts as empty: no shingles, linked with nothing. Rows with equal sets are linked.
    A null doc_id takes part, but names a component only where no member has an id.
    """
    rows = stored(grouped(docs), "grouped")
    known = rows.filter("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    alone = F.when(F.col("class").isNull(), F.col("doc_id"))
    named = rows.join(stored(known, "named"), "component", "left")
    return named.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce(alone, F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each component: that of the smallest doc_id, and of its rows that of the smallest text hash.

    Rows are told apart by doc_id and text, so of rows that share an id only near duplicates go. Of
    rows with equal id and text one stays, by a hash of the other columns. A null doc_id is above
    all others. Rows without shingles are alone and all stay.
    """
    rows = stored(grouped(docs).filter("component is not null").select("doc_id", "h1", "h2", "component"), "judged")
    key = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "h1", "h2")
    first = rows.groupBy("component").agg(F.min(key).alias("first"))
    marked = rows.join(stored(first, "firsts"), "component").withColumn("stays", F.col("first") == key)
    judged = marked.groupBy("doc_id", "h1", "h2").agg(F.max("stays").alias("stays"), F.count("*").alias("times"))
    judged = stored(judged.filter("not stays or times > 1").toDF("id_", "h1_", "h2_", "stays", "times"), "not-alone")
    h1, h2 = key128(whole_text(docs))
    read = docs.select(F.struct(*[docs[name] for name in docs.columns]).alias("row"), h1.alias("h1"), h2.alias("h2"))
    same = F.col("row.doc_id").eqNullSafe(F.col("id_")) & (F.col("h1") == F.col("h1_")) & (F.col("h2") == F.col("h2_"))
    lost = small_side(stored(judged.filter("not stays").drop("stays", "times"), "lost"), BROADCAST_ROWS)
    kept = read.join(lost, same, "left_anti")
    repeated = stored(judged.filter("stays").drop("stays", "times"), "repeated")
    if repeated.isEmpty():
        return kept.select("row.*")
    repeated = small_side(repeated, BROADCAST_ROWS)
    place = F.row_number().over(Window.partitionBy("row.doc_id", "h1", "h2").orderBy(F.xxhash64("row")))
    once = kept.join(repeated, same, "left_semi").withColumn("place", place).filter("place = 1").drop("place")
    return kept.join(repeated, same, "left_anti").unionByName(once).select("row.*")
