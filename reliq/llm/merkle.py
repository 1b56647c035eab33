"""Merkle manifest of a dataset: a root over all rows, and a proof for each of them.

Rows are leaves. Each language has a tree whose nodes are the hashes of runs of eight; the roots of
the languages form a tree of their own. ``SPAN`` leaves in a row are a superblock: a task of its
own reduces it to one digest, and the digests of a tree's superblocks are the leaves of the next,
much smaller tree, until one digest is left. On the way back each superblock is cogrouped
with the outer nodes that it requires: the runs on the path from its digest to the root.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reliq.llm.ranks import ranked
from reliq.llm.sharing import ship_package
from reliq.llm.text import ascii_lower, stored

# Nodes of a run, fields of a leaf, and which rows are tampered with.
ARITY = 8
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
TAMPERED = 3
#: Levels that a superblock reduces, and so its leaves.
LEVELS = 4
PATH = "array<struct<pos:int,run:array<string>>>"
BLOCK = ["tree", "block"]


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(columns: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[_field(columns[name]) for name in FIELDS]), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """A leaf per row: ``tree`` (its language as text that sorts null first), ``doc_id`` as text, ``leaf``, ``altered``."""
    own = {name: docs[name] for name in FIELDS}
    changed = own | {"text": ascii_lower(docs["text"].cast("string"))}
    doc_id = docs["doc_id"].cast("string")
    chosen = F.crc32(doc_id.cast("binary")) % TAMPERED == 0
    leaf = leaf_hash(own)
    return docs.select(
        F.coalesce(F.concat(F.lit("="), docs["lang"].cast("string")), F.lit("")).alias("tree"),
        docs["doc_id"].alias("key"),
        doc_id.alias("doc_id"),
        leaf.alias("digest"),
        F.when(chosen, leaf_hash(changed)).otherwise(leaf).alias("altered"),
        # Equal rows are told apart only so that they can be dealt to several tasks.
        F.monotonically_increasing_id().alias("salt"),
    )


def next_level(digests: list[str]) -> list[str]:
    return [digest("".join(digests[i : i + ARITY])) for i in range(0, len(digests), ARITY)]


def local_levels(digests: list[str], size: int, levels: int) -> list[list[str]]:
    """The levels of a superblock from its leaves up, the last of one node.

    A superblock of a larger tree has all its levels, be it ever so short; a whole tree ends
    where one node remains.
    """
    whole, found = size <= ARITY**levels, [digests]
    while len(found[-1]) > 1 or (not whole and len(found) <= levels):
        found.append(next_level(found[-1]))
    return found


def _runs(found: list[list[str]], i: int) -> list[tuple[int, list[str]]]:
    """The place of a leaf's ancestor in its run, and the run, for each level below the last."""
    runs = []
    for level in found[:-1]:
        start = i // ARITY * ARITY
        runs.append((i - start, level[start : start + ARITY]))
        i //= ARITY
    return runs


def blocks(nodes: DataFrame, levels: int) -> DataFrame:
    """``tree``, ``place``, ``size`` and ``digest`` of the superblocks of some trees."""

    def reduced(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        size = int(rows["size"].iloc[0])
        top = local_levels(rows.sort_values("place")["digest"].tolist(), size, levels)[-1][0]
        return pd.DataFrame({"tree": [key[0]], "place": [key[1]], "size": [-(-size // ARITY**levels)], "digest": [top]})

    return _dealt(nodes, levels).groupBy(*BLOCK).applyInPandas(reduced, "tree string, place bigint, size bigint, digest string")


def _dealt(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"place div {ARITY**levels}"))


def paths(nodes: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``tree``, ``place``, ``root`` and ``path`` of each leaf of some trees: its runs up to the root.

    ``nodes`` is a stored frame of ``tree``, ``place``, ``size`` and ``digest``. Each step is ``8**levels``
    times smaller than the one before.
    """
    if (nodes.agg(F.max("size")).head()[0] or 0) <= 1:
        return nodes.select("tree", "place", F.col("digest").alias("root"), F.array().cast(PATH).alias("path"))
    outer = paths(stored(blocks(nodes, levels), "superblocks"), levels).withColumnRenamed("place", "block")

    def joined(inner: pd.DataFrame, beyond: pd.DataFrame) -> pd.DataFrame:
        inner = inner.sort_values("place")
        found = local_levels(inner["digest"].tolist(), int(inner["size"].iloc[0]), levels)
        rest = [(step["pos"], list(step["run"])) for step in beyond["path"].iloc[0]]
        runs = [[{"pos": p, "run": run} for p, run in [*_runs(found, i), *rest]] for i in range(len(inner))]
        return pd.DataFrame({"tree": inner["tree"], "place": inner["place"], "root": beyond["root"].iloc[0], "path": runs})

    pairs = _dealt(nodes.select("tree", "place", "size", "digest"), levels).groupBy(*BLOCK).cogroup(outer.groupBy(*BLOCK))
    return stored(pairs.applyInPandas(joined, f"tree string, place bigint, root string, path {PATH}"), "outer-paths")


def manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """One row per document: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``.

    Leaves of a language ascend by doc_id, null first, and equal ids by their leaf; a null
    language is one of its own and comes first. Repeated rows are leaves of their own. A null
    doc_id is never tampered with. Without documents there is no row.
    """
    ship_package(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType
    read = stored(leaves(docs), "leaves")
    placed = stored(ranked(read, "tree", ["key", "digest", "salt"], "leaves-sorted").drop("key", "salt", "part", "seq"), "leaves-placed")
    inner = paths(stored(blocks(placed, levels), "superblocks"), levels).withColumnRenamed("root", "subroot")
    inner = stored(inner, "inner-paths")
    # The languages in order are the leaves of the last tree.
    tops = stored(inner.filter("place = 0").select(F.lit("").alias("all"), "tree", F.col("subroot").alias("digest")), "subroots")
    tops = stored(ranked(tops, "all", ["tree"], "subroots-sorted"), "subroots-placed")
    outer = paths(tops.select(F.col("all").alias("tree"), "place", "size", "digest"), levels)
    upper = tops.select("tree", "place").join(outer.drop("tree"), "place").select("tree", "root", F.col("path").alias("upper"))
    required = inner.join(upper, "tree").select(
        "tree", F.col("place").alias("block"), "subroot", "root", F.concat("path", "upper").alias("path")
    )

    def folded(inside: pd.DataFrame, beyond: pd.DataFrame) -> pd.DataFrame:
        inside, top = inside.sort_values("place"), beyond.iloc[0]
        found = local_levels(inside["digest"].tolist(), int(inside["size"].iloc[0]), levels)
        rest = [(step["pos"], list(step["run"])) for step in top["path"]]
        proofs, roots = [], []
        for i, node in enumerate(inside["altered"]):
            proof = hashlib.sha256()
            for p, run in [*_runs(found, i), *rest]:
                before, after = "".join(run[:p]), "".join(run[p + 1 :])
                proof.update((before + after).encode())
                node = digest(before + node + after)
            proofs.append(proof.hexdigest())
            roots.append(node)
        made = {"subroot": top["subroot"], "root": top["root"], "proof_sha256": proofs, "folded_root": roots}
        return inside[["doc_id", "digest"]].rename(columns={"digest": "leaf"}).assign(**made)

    schema = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    pairs = _dealt(placed, levels).groupBy(*BLOCK).cogroup(required.groupBy(*BLOCK))
    verified = F.col("folded_root") == F.col("root")
    return pairs.applyInPandas(folded, schema).withColumns({"doc_id": F.col("doc_id").cast(kind), "verified": verified})
