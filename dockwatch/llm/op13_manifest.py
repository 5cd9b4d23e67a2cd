"""Merkle manifest of a data set: trees of a fixed fanout per group, one tree over the groups, and a proof for every row.

Rows get their place in the group's order. Blocks of ``fanout ** levels`` neighbouring rows form the aligned partitions: each
hashes its own subtree. Then the partitions exchange roots in a butterfly: in round r, partitions whose numbers differ in digit r
only (to the base of the fanout) swap the roots of their subtrees, so every partition has the neighbours' roots and hashes the common parent itself.
Where the last subtree has fewer partitions than its neighbours, its members send to the partners that would be missing. After
the last round every partition holds the root and the upper part of the proofs of its rows, and no pass leads down again.
The subroots of the groups go through the same exchange. Only digests are shuffled, texts never.
"""

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockwatch.llm.common import materialise
from dockwatch.llm.ordered import in_order, with_place

FANOUT = 8
#: Levels that a partition hashes on its own: 8 ** 4 rows.
LEVELS = 4
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(values: list[Column]) -> Column:
    """SHA-256 of the values, each as its number of bytes, a colon and its text; a null as a dash. Binary."""
    parts = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def local_levels(leaves: list[str], levels: int, fanout: int) -> list[list[str]]:
    """Nodes of a subtree level by level, from the leaves to its root."""
    out = [leaves]
    for _ in range(levels):
        nodes = out[-1]
        out.append([_hash("".join(nodes[i:i + fanout])) for i in range(0, len(nodes), fanout)])
    return out


def _rise(rows: int, fanout: int, most: int) -> int:
    """Levels up to a single node, ``most`` at most."""
    n = 0
    while rows > 1 and n < most:
        rows, n = -(-rows // fanout), n + 1
    return n


def butterfly(nodes: DataFrame, keys: list[str], fanout=FANOUT) -> DataFrame:
    """``keys, p, h, lefts, rights`` for partitions ``keys, p, size, h`` (number, partitions of the key, root as hex text).

    ``h`` becomes the root of all partitions of the key; ``lefts`` and ``rights`` hold, level by level from below, the roots that stand
    before and after the partition's own subtree in its run. One round per level; each stores one small row per partition.
    """
    nothing = F.array().cast("array<string>")
    nodes = materialise(nodes.select(*keys, "p", "size", "h", nothing.alias("lefts"), nothing.alias("rights")), "nodes")
    largest = nodes.agg(F.max("size")).first()[0] or 0
    span = 1
    while span < largest:
        wide = span * fanout
        done, active = nodes.where(F.col("size") <= span), nodes.where(F.col("size") > span)
        low, start = F.col("p") % span, F.floor(F.col("p") / span) * span
        members = F.least(F.lit(span), F.col("size") - start)  # partitions of the own subtree
        alone = (start % wide == 0) & (start + span >= F.col("size"))
        # a member of a short last subtree also sends to the partners that would be missing, in steps of its size
        sends = F.when(alone | (members == span), F.array(low)).otherwise(F.sequence(low, F.lit(span - 1).cast("long"), members))
        sent = active.withColumn("own", low).withColumn("to", F.explode(sends))
        entry = F.struct(F.floor(start / span).alias("digit"), "h", "p", "size", "lefts", "rights", (F.col("to") == F.col("own")).alias("real"))
        swapped = sent.groupBy(*keys, F.floor(F.col("p") / wide).alias("run"), "to").agg(F.array_sort(F.collect_list(entry)).alias("e"))
        swapped = swapped.withColumn("parent", F.sha2(F.expr("array_join(transform(e, x -> x.h), '')").cast("binary"), 256))
        swapped = swapped.select("*", F.explode(F.expr("filter(e, x -> x.real)")).alias("m"))
        nodes = done.unionByName(swapped.select(
            *keys, F.col("m.p").alias("p"), F.col("m.size").alias("size"), F.col("parent").alias("h"),
            F.expr("array_append(m.lefts, array_join(transform(filter(e, x -> x.digit < m.digit), x -> x.h), ''))").alias("lefts"),
            F.expr("array_append(m.rights, array_join(transform(filter(e, x -> x.digit > m.digit), x -> x.h), ''))").alias("rights")))
        nodes = materialise(nodes, "nodes")
        span = wide
    return nodes.drop("size")


def manifest(df: DataFrame, columns=COLUMNS, group_col="lang", id_col="doc_id", changed=None, fanout=FANOUT, levels=LEVELS) -> DataFrame:
    """``id_col, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row of ``df``; digests as lowercase hex.

    Leaves hash ``columns``; per value of ``group_col`` they ascend by ``id_col``. ``changed`` maps columns to expressions of a
    later state of the rows, whose leaves are folded with the stored proofs; ``verified`` tells whether that gives the root.

    A null group is a group of its own, before all others; null ids come first; rows with equal ids ascend by their leaves, and
    equal rows take neighbouring places. Null values hash as a dash, an empty text as ``0:``. Other columns are ignored; an
    empty table gives an empty result.
    """
    size = fanout**levels
    changed = changed or {}
    now, later = [F.col(c) for c in columns], [changed.get(c, F.col(c)) for c in columns]
    group = F.col(group_col).cast("string")
    rows = df.select(F.col(id_col).cast("long").alias("id"), group.isNotNull().alias("named"), F.coalesce(group, F.lit("")).alias("grp"),
                     leaf_digest(now).alias("leaf"), leaf_digest(later).alias("later"), F.monotonically_increasing_id().alias("row"))
    keys = ["named", "grp"]
    order = [F.asc("named"), F.asc("grp"), F.asc_nulls_first("id"), F.asc("leaf"), F.asc("row")]
    placed = with_place(in_order(materialise(rows, "leaves"), order, "ordered_leaves"), keys)
    placed = placed.select("id", *keys, "leaf", "later", "of", F.floor(F.col("place") / size).alias("block"), "place")
    placed = materialise(placed, "placed_leaves")

    def leaves_of(table):
        table = table.sort_by("place")
        return table, [x.hex() for x in table["leaf"].to_pylist()], _rise(table["of"][0].as_py(), fanout, levels)

    def roots(table):
        table, leaves, rise = leaves_of(table)
        first = table.slice(0, 1)
        return pa.table({"named": first["named"], "grp": first["grp"], "p": first["block"], "size": pa.array([-(-first["of"][0].as_py() // size)]),
                         "h": pa.array([local_levels(leaves, rise, fanout)[-1][0]])})

    narrow = placed.select(*keys, "block", "place", "of", "leaf")
    blocks = narrow.groupBy(*keys, "block").applyInArrow(roots, "named boolean, grp string, p long, size long, h string")
    blocks = butterfly(blocks, keys, fanout).withColumnRenamed("h", "subroot")

    groups = materialise(blocks.where("p = 0").select(*keys, "subroot"), "subroots")
    numbered = with_place(in_order(groups, [F.asc("named"), F.asc("grp")], "groups"), [])
    top = butterfly(numbered.select(F.col("place").alias("p"), F.col("of").alias("size"), F.col("subroot").alias("h")), [], fanout)
    top = numbered.select(*keys, F.col("place").alias("p")).join(top, "p").select(
        *keys, F.col("h").alias("root"), F.col("lefts").alias("top_lefts"), F.col("rights").alias("top_rights"))
    upper = blocks.join(top, keys).select(
        *keys, F.col("p").alias("block"), "subroot", "root", F.concat("lefts", "top_lefts").alias("lefts"), F.concat("rights", "top_rights").alias("rights"))
    upper = materialise(upper, "upper")

    def proofs(table, above):
        table, leaves, rise = leaves_of(table)
        above = above.to_pylist()[0]
        tree = local_levels(leaves, rise, fanout)
        runs = [["".join(nodes[i:i + fanout]) for i in range(0, len(nodes), fanout)] for nodes in tree[:-1]]
        upper = "".join(a + b for a, b in zip(above["lefts"], above["rights"]))
        shown, folded = [], []
        for i, (then, now) in enumerate(zip(leaves, table["later"].to_pylist())):
            node, siblings = now.hex(), []
            for run in runs:
                i, digit = divmod(i, fanout)
                left, right = run[i][:64 * digit], run[i][64 * (digit + 1):]
                siblings.append(left + right)
                node = _hash(left + node + right)
            for left, right in zip(above["lefts"], above["rights"]):
                node = _hash(left + node + right)
            shown.append(_hash("".join(siblings) + upper))
            folded.append(node)
        n = len(leaves)
        return pa.table({"id": table["id"], "leaf": pa.array(leaves), "subroot": pa.array([above["subroot"]] * n), "root": pa.array([above["root"]] * n),
                         "proof_sha256": pa.array(shown), "folded_root": pa.array(folded), "verified": pa.array([x == above["root"] for x in folded])})

    given = placed.groupBy(*keys, "block").cogroup(upper.groupBy(*keys, "block"))
    out = given.applyInArrow(proofs, "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    return out.withColumnRenamed("id", id_col)
