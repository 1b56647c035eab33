"""Conversation prefix trie, rolled up by centroid decomposition of its parent edges.

Conversations that begin with the same turns share nodes. A node is known by its smallest
member and its depth, so the nodes of one member are the lower end of that member's own path,
and the path of any node to the root is read from the turns of its member.

Sums over subtrees come from recursive splits. A component of more than ``most`` nodes is cut at
its centroid: the centroid's own part of the sum is final, its children become components of
their own, and the total below the cut is added to the nodes on the path from the centroid to the
top of the component. Every cut at least halves what it cuts, and nodes of small components are set
aside. Those are solved by the same recursion within a task, one bounded component at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reliq.llm.ranks import ranked
from reliq.llm.sharing import ship_package
from reliq.llm.text import key128, stored

# How conversations are rebuilt.
FAMILY, LONGEST_HEAD = 5, 8
#: Nodes of a component that one task may solve at once.
COMPONENT = 1 << 14
#: Conversation ids written as one piece of text, and rows of an Arrow batch.
CHUNK, BATCH = 1 << 13, 1 << 13
NODE, TOP, CUT = ["rep", "depth"], ["top_rep", "top_depth"], ["cut_rep", "cut_depth"]
HASHES = ["p1", "p2"]


def head_length(conv: Column) -> Column:
    """How many turns a conversation takes from the first of its family."""
    return F.crc32(conv.cast("string").cast("binary")) % (LONGEST_HEAD + 1)


def stored_turns(conversations: DataFrame) -> DataFrame:
    """Turns in order: ``conv``, ``place``, ``size``, the hash of role and text, and the bytes of the text."""
    role, text = (F.coalesce(conversations[name].cast("string"), F.lit("")) for name in ("role", "text"))
    h1, h2 = key128(role, text)
    read = conversations.select(
        conversations["conv_id"].cast("bigint").alias("conv"),
        conversations["turn"].alias("turn"),
        h1.alias("h1"),
        h2.alias("h2"),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
        # Equal rows are told apart only so that they can be dealt to several tasks.
        F.monotonically_increasing_id().alias("salt"),
    )
    turns = stored(read.filter("conv is not null"), "turns")
    return stored(ranked(turns, "conv", ["turn", "h1", "h2", "salt"], "turns-sorted"), "turns-placed")


def _mark(depth: Column, turn: Column) -> list[Column]:
    """The hash of a turn at its depth; a prefix is known by the exclusive or of those it holds."""
    return key128(depth.cast("bigint"), turn["h1"], turn["h2"])


def rebuilt_prefixes(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (``conv``, ``length``) and their prefixes (``conv``, ``depth``, ``p1``, ``p2``, ``n_bytes``).

    The first turns come from the first conversation of the family, at most eight; the rest from
    the conversation itself. Turns of one conversation may lie in many tasks: hashes run along
    each range of them and are joined with the hash of the ranges before.
    """
    base = F.col("conv") - F.col("conv") % FAMILY
    struct = F.struct("place", "h1", "h2", "n_bytes")
    first = turns.filter((F.col("conv") == base) & (F.col("place") < LONGEST_HEAD))
    heads = first.groupBy(F.col("conv").alias("base")).agg(F.sort_array(F.collect_list(struct)).alias("turns"))
    sizes = turns.groupBy("conv").agg(F.max("size").alias("size"))
    known = sizes.withColumns({"base": base, "h": head_length(F.col("conv"))}).join(heads, "base", "left")
    head = F.when(F.col("turns").isNull() | (F.col("h") == 0), F.array().cast("array<struct<place:bigint,h1:bigint,h2:bigint,n_bytes:bigint>>"))
    lead = known.withColumn("head", head.otherwise(F.slice("turns", 1, F.greatest(F.col("h"), F.lit(1)).cast("int"))))

    def marks(k: int) -> Column:
        return F.transform("head", lambda turn, i: _mark(i + 1, turn)[k])

    def running(values: str) -> Column:
        upto = F.transform(values, lambda _, i: F.slice(values, F.lit(1), i + 1))
        return F.transform(upto, lambda part: F.aggregate(part, F.lit(0).cast("bigint"), lambda a, b: a.bitwiseXOR(b)))

    marked = lead.withColumns({"m1": marks(0), "m2": marks(1)})
    convs = marked.select(
        "conv",
        "h",
        F.size("head").cast("bigint").alias("lead"),
        (F.size("head") + F.greatest(F.col("size") - F.col("h"), F.lit(0))).cast("bigint").alias("length"),
        F.transform("head", lambda turn: turn["n_bytes"]).alias("bytes"),
        running("m1").alias("r1"),
        running("m2").alias("r2"),
    )
    convs = stored(convs, "conversations")
    early = convs.select("conv", F.posexplode(F.arrays_zip("r1", "r2", "bytes")).alias("i", "turn")).select(
        "conv", (F.col("i") + 1).cast("bigint").alias("depth"), F.col("turn.r1").alias("p1"), F.col("turn.r2").alias("p2"), F.col("turn.bytes").alias("n_bytes")
    )
    last = [F.coalesce(F.element_at(F.when(F.size(r) > 0, F.col(r)), -1), F.lit(0)) for r in ("r1", "r2")]
    joints = convs.select("conv", "lead", last[0].alias("b1"), last[1].alias("b2"))
    own = turns.filter(F.col("place") >= head_length(F.col("conv"))).join(joints, "conv")
    depth = F.col("lead") + F.col("place") - head_length(F.col("conv")) + 1
    m1, m2 = _mark(F.col("depth"), F.struct("h1", "h2"))
    own = own.withColumn("depth", depth).select("conv", "part", "depth", "b1", "b2", "n_bytes", m1.alias("m1"), m2.alias("m2"))
    own = stored(own, "own-turns")
    pieces = own.groupBy("conv", "part").agg(F.bit_xor("m1").alias("x1"), F.bit_xor("m2").alias("x2"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = pieces.select("conv", "part", *[F.coalesce(F.bit_xor(x).over(earlier), F.lit(0)).alias(x) for x in ("x1", "x2")])
    within = Window.partitionBy("conv", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    late = own.join(before, ["conv", "part"]).select(
        "conv",
        "depth",
        *[F.col(f"b{k}").bitwiseXOR(F.col(f"x{k}")).bitwiseXOR(F.bit_xor(f"m{k}").over(within)).alias(f"p{k}") for k in (1, 2)],
        "n_bytes",
    )
    nothing = F.lit(0).cast("bigint")
    root = convs.select("conv", nothing.alias("depth"), nothing.alias("p1"), nothing.alias("p2"), nothing.alias("n_bytes"))
    return convs.select("conv", "length"), root.unionByName(early).unionByName(late)


def build_trie(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The nodes, the paths and the ends of a trie, each stored.

    Nodes have ``rep`` (smallest member), ``depth``, ``parent_rep``, ``n_convs``, ``n_children`` and
    ``n_bytes`` (of the last text). Paths have the node (``rep``, ``depth``) of each member ``conv`` that
    owns nodes, at each depth. Ends have the node that each conversation ends in.
    """
    convs, prefixes = rebuilt_prefixes(stored_turns(conversations))
    prefixes = stored(prefixes, "prefixes")
    found = prefixes.groupBy("depth", *HASHES).agg(
        F.min("conv").alias("rep"), F.count("*").alias("n_convs"), F.max("n_bytes").alias("n_bytes")
    )
    # Written first, so that the join deals both sides anew and can split the prefix of a third of all.
    found = stored(found, "prefix-counts")
    placed = prefixes.drop("n_bytes").join(found, ["depth", *HASHES]).join(convs, "conv")
    placed = stored(placed.select("conv", "depth", "rep", "n_convs", "n_bytes", "length"), "members")
    own = placed.filter("conv = rep")
    paths = stored(placed.join(own.select("conv").distinct(), "conv", "left_semi").select("conv", *NODE), "paths")
    above = paths.select(F.col("conv").alias("rep"), (F.col("depth") + 1).alias("depth"), F.col("rep").alias("parent_rep"))
    linked = stored(own.select(*NODE, "n_convs", "n_bytes").join(above, NODE, "left"), "linked")
    children = linked.filter("parent_rep is not null").groupBy(F.col("parent_rep").alias("rep"), (F.col("depth") - 1).alias("depth"))
    counted = linked.join(children.agg(F.count("*").alias("n_children")), NODE, "left").fillna({"n_children": 0})
    return stored(counted, "nodes"), paths, placed.filter("depth = length").select(*NODE, "conv")


def subtree_sizes(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """The nodes with ``size``, the number of nodes in their subtree.

    A member owns one unbroken stretch of nodes; each node on its path has below it as much of
    the stretch as lies at its depth or deeper.
    """
    stretch = nodes.groupBy(F.col("rep").alias("conv")).agg(F.min("depth").alias("start"), F.max("depth").alias("end"))
    below = F.col("end") - F.greatest("start", "depth") + 1
    return nodes.join(paths.join(stretch, "conv").groupBy(*NODE).agg(F.sum(below).alias("size")), NODE)


def rollup(nodes: DataFrame, paths: DataFrame, values: list[str], most: int = COMPONENT) -> DataFrame:
    """``rep``, ``depth`` and for each of some whole-number columns its sum over the node's subtree.

    ``nodes`` and ``paths`` are stored frames of one trie. Components larger than ``most`` are cut by
    joins, round by round; each round is written, so lineage stays short.
    """
    ship_package(nodes.sparkSession)
    sums = [f"sum_{name}" for name in values]
    state = subtree_sizes(nodes.select(*NODE, "parent_rep", *values), paths).withColumns(
        {name: F.lit(0).cast("bigint") for name in sums}
    )
    # One root, which holds all others.
    root = state.filter("depth = 0").select("rep", "size").head() or (0, 0)
    start = dict(zip([*TOP, "total"], (root[0], 0, root[1])))
    state = stored(state.withColumns({name: F.lit(n).cast("bigint") for name, n in start.items()}), "components")
    final, small = [], []
    while True:
        small.append(state.filter(F.col("total") <= most))
        state = state.filter(F.col("total") > most)
        if state.isEmpty():
            break
        done, state = _cut(state, paths, values, sums)
        final.append(done)
    rest = reduce(DataFrame.unionByName, small).select(*TOP, *NODE, "parent_rep", *values, *sums)
    dealt = rest.repartition(*TOP).sortWithinPartitions(*TOP, "depth")
    schema = ", ".join(f"{name} bigint" for name in [*NODE, *values])
    solved = dealt.mapInArrow(lambda batches: _solved(batches, len(values)), schema)
    return reduce(DataFrame.unionByName, final, solved)


def _cut(state: DataFrame, paths: DataFrame, values: list[str], sums: list[str]) -> tuple[DataFrame, DataFrame]:
    """Cut every component at its centroid: the centroids with their sums, and the new components."""
    best = F.min(F.struct("size", *NODE)).alias("c")
    heavy = state.filter(2 * F.col("size") >= F.col("total"))
    cuts = heavy.groupBy(*TOP).agg(best).select(
        *TOP, F.col("c.rep").alias("cut_rep"), F.col("c.depth").alias("cut_depth"), F.col("c.size").alias("cut_size")
    )
    cuts = stored(cuts, "cuts")
    # Members that pass through a centroid, and the child they go on to.
    here = paths.select("conv", F.col("rep").alias("cut_rep"), F.col("depth").alias("cut_depth"))
    below = paths.select("conv", F.col("rep").alias("child_rep"), (F.col("depth") - 1).alias("cut_depth"))
    through = here.join(cuts, CUT).join(below, ["conv", "cut_depth"], "left")
    through = through.select(*TOP, *CUT, F.col("conv").alias("rep"), "child_rep")
    where = (
        F.when(F.col("depth") > F.col("cut_depth"), "child")
        .when((F.col("depth") == F.col("cut_depth")) & (F.col("rep") == F.col("cut_rep")), "cut")
        .otherwise("above")
    )
    marked = stored(state.join(through, [*TOP, "rep"], "left").withColumn("side", where), "sides")
    under = marked.filter("side <> 'above'").groupBy(*TOP).agg(*[F.sum(name).alias(f"under_{name}") for name in values])
    totals = stored(cuts.join(under, TOP), "totals")
    added = [(F.col(s) + F.col(f"under_{name}")).alias(s) for name, s in zip(values, sums)]
    done = marked.filter("side = 'cut'").join(totals.drop(*CUT), TOP).select(*NODE, *[a.alias(name) for a, name in zip(added, values)])
    # The path from a centroid's parent to the top is read from the turns of its member.
    path = paths.withColumnRenamed("conv", "cut_rep").join(totals, "cut_rep")
    path = path.filter((F.col("depth") < F.col("cut_depth")) & (F.col("depth") >= F.col("top_depth")))
    lifted = path.select(*NODE, F.lit(True).alias("lifted"))
    above = marked.filter("side = 'above'").drop("side", *CUT, "child_rep").join(totals, TOP).join(lifted, NODE, "left")
    plain = [name for name in state.columns if name not in ("size", "total", *sums)]
    above = above.select(
        *plain,
        F.when(F.col("lifted"), F.col("size") - F.col("cut_size")).otherwise(F.col("size")).alias("size"),
        (F.col("total") - F.col("cut_size")).alias("total"),
        *[F.when(F.col("lifted"), a).otherwise(F.col(s)).alias(s) for a, s in zip(added, sums)],
    )
    child = marked.filter("side = 'child'").withColumns({"top_rep": F.col("child_rep"), "top_depth": F.col("cut_depth") + 1})
    tops = child.filter("rep = top_rep and depth = top_depth").select(*TOP, F.col("size").alias("total"))
    child = child.drop("total").join(tops, TOP).select(*state.columns)
    return stored(done, "centroids"), stored(above.select(*state.columns).unionByName(child), "components")


def subtree_sums(parents: list[int], values: list[list[int]], sums: list[list[int]]) -> None:
    """Add to ``sums`` the values of each node's subtree within one component, by centroids.

    Nodes come with parents before children; ``parents`` holds places, -1 at the top.
    """
    size, side, fields = [0] * len(parents), [0] * len(parents), range(len(values))
    stack = [list(range(len(parents)))] if parents else []
    while stack:
        nodes = stack.pop()
        top, total = nodes[0], len(nodes)
        for v in nodes:
            size[v] = 1
        for v in reversed(nodes[1:]):
            size[parents[v]] += size[v]
        cut = next(v for v in reversed(nodes) if 2 * size[v] >= total)
        # -1 is above the cut; below it every node knows the child of the centroid it hangs from.
        below: dict[int, list[int]] = {}
        above = []
        for v in nodes:
            if v == cut:
                side[v] = cut
            elif v == top or side[parents[v]] == -1:
                side[v] = -1
                above.append(v)
            elif parents[v] == cut:
                side[v] = v
                below[v] = [v]
            else:
                side[v] = side[parents[v]]
                below[side[v]].append(v)
        under = [column[cut] + sum(column[v] for part in below.values() for v in part) for column in values]
        v = cut
        while True:
            for k in fields:
                sums[k][v] += under[k]
            if v == top:
                break
            v = parents[v]
        stack.extend(below.values())
        if above:
            stack.append(above)


def _batches(rows: Iterator[tuple], names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    return chain.from_iterable(zip(*[column.to_pylist() for column in batch.columns]) for batch in batches)


def _solved(batches: Iterator[pa.RecordBatch], fields: int) -> Iterator[pa.RecordBatch]:
    """Sums of whole components, which come one after another, parents first."""
    names: list[str] = []

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names[:] = [*NODE, *batch.schema.names[5 : 5 + fields]]
            yield batch

    def solve() -> Iterator[tuple]:
        for _, component in groupby(_rows(named(batches)), key=lambda row: row[:2]):
            rows = list(component)
            places = {row[2:4]: i for i, row in enumerate(rows)}
            parents = [-1, *[places[(row[4], row[3] - 1)] for row in rows[1:]]]
            columns = [list(column) for column in zip(*rows)]
            sums = columns[5 + fields :]
            subtree_sums(parents, columns[5 : 5 + fields], sums)
            yield from zip(columns[2], columns[3], *sums)

    solved = solve()
    first = next(solved, None)
    if first is not None:
        yield from _batches(chain([first], solved), list(names), [pa.int64()] * (2 + fields))


def end_digests(ends: DataFrame) -> DataFrame:
    """``rep``, ``depth`` and ``ends_sha256``: the hash of the conversations that end in a node.

    A hash of ordered text can only be taken from front to back, so ids are first written as long
    pieces of text in many tasks; what goes through one task per node is a stream of those pieces.
    """
    keys, parts = [*NODE, "conv"], int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ends = ends.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).select(*keys)
    pieces = sorted_ends.mapInArrow(_pieces, "rep bigint, depth bigint, conv bigint, ids string")
    dealt = pieces.repartition(*NODE).sortWithinPartitions(*keys)
    return dealt.mapInArrow(_digests, "rep bigint, depth bigint, ends_sha256 string")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def cut() -> Iterator[tuple]:
        for node, rows in groupby(_rows(batches), key=lambda row: row[:2]):
            held: list[int] = []
            for row in rows:
                held.append(row[2])
                if len(held) == CHUNK:
                    yield (*node, held[0], ",".join(map(str, held)))
                    held = []
            if held:
                yield (*node, held[0], ",".join(map(str, held)))

    yield from _batches(cut(), [*NODE, "conv", "ids"], [pa.int64()] * 3 + [pa.string()])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def hashed() -> Iterator[tuple]:
        for node, rows in groupby(_rows(batches), key=lambda row: row[:2]):
            digest, mark = hashlib.sha256(), b""
            for row in rows:
                digest.update(mark + row[3].encode())
                mark = b","
            yield (*node, digest.hexdigest())

    yield from _batches(hashed(), [*NODE, "ends_sha256"], [pa.int64()] * 2 + [pa.string()])


def prefix_trie(conversations: DataFrame, most: int = COMPONENT) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    Turns are ordered by ``turn``, null first; turns of one number by the hash of role and text.
    Null roles and texts are empty. Rows without conv_id belong to no conversation; repeated rows
    are turns of their own. Without conversations there is no node, not even a root. A turn is
    known by 128 bits of hash, a prefix by 128 bits over its turns and their depths.
    """
    ship_package(conversations.sparkSession)
    nodes, paths, ends = build_trie(conversations)
    leaf, saved = (F.col("n_children") == 0).cast("bigint"), (F.col("n_convs") - 1) * F.col("n_bytes")
    sums = rollup(nodes.withColumns({"n_leaves": leaf, "saved_tokens": saved}), paths, ["n_leaves", "saved_tokens"], most)
    whole = nodes.join(sums, NODE).join(end_digests(ends), NODE, "left")
    return whole.select(
        F.col("rep").alias("conv_id"),
        "depth",
        F.col("parent_rep").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
