"""A Merkle manifest of a dataset: leaves, subroots, a root, proofs and their verification.

1. **Leaves.** The digest of a row's fields, hashed where the text is read;
   only digests leave that task. They are written once.
2. **Order.** Leaves are dealt by range of (group, key, digest) and sorted, so
   no group, however large, meets in one task; a leaf's position is its place
   in its task plus the group's leaves in the tasks before.
3. **Levels.** Per level a window of one run of ``fan`` consecutive nodes has
   fixed-offset lag and lead columns, masked by slot and run length: a node's
   siblings. First children hash their runs to parents, the next level. A
   level has an eighth of the nodes of the one below. The groups' subroots are the leaves of one more such tree.
4. **Proofs** go down from the root: a node's proof is its siblings and its
   parent's proof. The leaf's window and the join with the parents are dealt
   by the same key, so leaves move once. Folding a leaf over its proof gives a root.

A digest is the lower-case hex SHA-256 of digests or fields joined as text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.plans.materialize import materialize, remove_tables

FAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

# A proof: per level, from the leaf up, the digests left and right of the node, joined.
PROOF = "array<struct<left:string,right:string>>"


def digest_of(fields: Sequence[Column]) -> Column:
    """The digest of a row: each field as its UTF-8 length, ``:`` and value; a null is ``-``."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def positions(leaves: DataFrame, group: str, order: Sequence[str], name: str, paths: list[str]
              ) -> tuple[DataFrame, DataFrame, list[str]]:
    """``leaves`` with ``(g, pos, n)``, ``(group, g, n)``, and the paths of the tables that the first reads.

    ``g`` numbers the groups in ascending order (null first), ``pos`` the leaves of a
    group in ``order`` from 0, ``n`` is their number.
    """
    # Equal rows are told apart by a number, so that no key of the ranges is large.
    row = F.monotonically_increasing_id()
    dealt = (leaves.withColumn("__row", row).repartitionByRange(group, *order, "__row")
             .sortWithinPartitions(group, *order, "__row").drop("__row").withColumn("__at", row))
    placed = materialize(dealt, f"{name}_sorted", paths)
    read = paths[-1:]
    task = F.shiftright("__at", 33)
    shares = placed.groupBy(F.col(group).alias("__of"), task.alias("__task")).agg(
        F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__size"))
    # One row a group and task: as many as tasks and groups together.
    shares = materialize(shares, f"{name}_shares", paths)
    earlier = Window.partitionBy("__of").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    groups = shares.groupBy("__of").agg(F.sum("__size").alias("n"))
    groups = numbered_groups(groups, "__of", name, paths)
    named = groups.select(F.col("__of").alias("__name"), "g", "n")
    shares = (shares.withColumn("__before", F.coalesce(F.sum("__size").over(earlier), F.lit(0)))
              .join(named, F.col("__of").eqNullSafe(F.col("__name"))).drop("__name"))
    shares = materialize(shares, f"{name}_offsets", paths)
    read += paths[-1:]
    same = F.col(group).eqNullSafe(F.col("__of")) & (task == F.col("__task"))
    out = (placed.join(shares, same)
           .withColumn("pos", F.col("__at") - F.col("__first") + F.col("__before"))
           .drop("__of", "__task", "__first", "__size", "__before", "__at"))
    return out, groups.withColumnRenamed("__of", group), read


def numbered_groups(groups: DataFrame, group: str, name: str, paths: list[str]) -> DataFrame:
    """Groups with ``g``, their number from 0 in ascending order, null first.

    Sorted by range; a task's groups follow those of the tasks before.
    """
    at = materialize(groups.repartitionByRange(group).sortWithinPartitions(group).withColumn(
        "__at", F.monotonically_increasing_id()), f"{name}_named", paths)
    task = F.shiftright("__at", 33)
    # One row a task here.
    sizes = at.groupBy(task.alias("__task")).agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("__before", F.coalesce(F.sum("__size").over(before), F.lit(0)))
    inside = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = (at.join(sizes, task == F.col("__task"))
                .withColumn("g", inside + F.col("__before")).drop("__at", "__task", "__size", "__before"))
    return materialize(numbered, f"{name}_groups", paths)


def with_siblings(nodes: DataFrame, fan: int = FAN) -> DataFrame:
    """Nodes ``(g, pos, n, digest, ...)`` with ``run``, ``slot``, and the digests ``left`` and ``right`` in their run."""
    run = F.floor(F.col("pos") / fan).cast("bigint")
    nodes = nodes.withColumn("run", run).withColumn("slot", F.col("pos") - F.col("run") * fan)
    length = F.least(F.lit(fan), F.col("n") - F.col("run") * fan)
    # The window is the run itself: no group meets in one task, and parents join by the same key.
    w = Window.partitionBy("g", "run").orderBy("pos")
    nothing = F.lit("")
    left = [F.when(F.col("slot") >= k, F.lag("digest", k).over(w)).otherwise(nothing) for k in range(fan - 1, 0, -1)]
    right = [F.when(F.col("slot") + k < length, F.lead("digest", k).over(w)).otherwise(nothing) for k in range(1, fan)]
    return nodes.withColumns({"left": F.concat(*left), "right": F.concat(*right)})


def tree(leaves: DataFrame, name: str, paths: list[str], fan: int = FAN) -> list[DataFrame]:
    """The levels ``(g, pos, n, digest)`` above leaves ``(g, pos, n, digest)`` with more than one node, and all roots last.

    The number of levels is the logarithm of the largest group's size.
    """
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels, below = [], leaves.select("g", "pos", "n", "digest")
    roots = below.filter("n = 1")
    while most > 1:
        first = with_siblings(below.filter("n > 1"), fan).filter("slot = 0")
        above = first.select("g", F.col("run").alias("pos"),
                             F.floor((F.col("n") + fan - 1) / fan).cast("bigint").alias("n"),
                             F.sha2(F.concat("digest", "right"), 256).alias("digest"))
        below = materialize(above, f"{name}_level", paths)
        levels.append(below)
        roots = roots.union(below.filter("n = 1"))
        most = -(-most // fan)
    return [*levels, roots]


def proven(nodes: DataFrame, above: DataFrame, fan: int = FAN) -> DataFrame:
    """Nodes of more than one a group with ``proof`` (their siblings, then the proof of their parent in ``above``)
    and what else ``above`` says of the parent."""
    up = above.withColumnsRenamed({"g": "__g", "pos": "__pos", "proof": "__proof"})
    own = F.array(F.struct("left", "right"))
    return (with_siblings(nodes, fan).join(up, (F.col("g") == F.col("__g")) & (F.col("run") == F.col("__pos")))
            .withColumn("proof", F.concat(own, "__proof"))
            .drop("run", "slot", "left", "right", "__g", "__pos", "__proof"))


def with_proofs(leaves: DataFrame, levels: list[DataFrame], beyond: DataFrame, name: str, paths: list[str],
                fan: int = FAN) -> DataFrame:
    """Leaves with ``proof`` and the other columns of ``beyond``, which has a row ``(g, proof, ...)`` for each group's root.

    ``paths`` ends with the one table that the result reads.
    """
    ends = beyond.withColumnRenamed("g", "__g")

    def closed(nodes):  # nodes that are their group's root: one a group
        return nodes.filter("n = 1").join(ends, F.col("g") == F.col("__g")).drop("__g")

    above = None
    for level in reversed(levels[:-1]):
        here = closed(level)
        if above is not None:
            here = here.unionByName(proven(level.filter("n > 1"), above, fan))
        above = materialize(here.drop("n", "digest"), f"{name}_proofs", paths)
    out = closed(leaves)
    return out if above is None else out.unionByName(proven(leaves.filter("n > 1"), above, fan))


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf gives with a proof. A level without siblings (a run of one) hashes the digest alone."""
    return F.aggregate(proof, leaf, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """The digest of all siblings, level by level from the leaf, left to right; of nothing if there are none."""
    joined = F.transform(proof, lambda s: F.concat(s["left"], s["right"]))
    return F.sha2(F.array_join(joined, ""), 256)


def lowered(text: Column) -> Column:
    """The text with A-Z in lower case; null stays null."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "lang", key: str = "doc_id",
             altered: dict[str, Column] | None = None, fan: int = FAN) -> DataFrame:
    """``(key, leaf, subroot, root, proof, altered_leaf)``, a row for each input row.

    ``altered`` gives other values of some fields; ``altered_leaf`` is the
    digest with them (null where it is the same), as a reader of a copy would compute it.

    Leaves of a group ascend by ``key``, null keys first, then by digest; rows
    that are equal in all fields have places of their own. A null group is a
    group, the first. Null and empty fields have different digests; texts of any length are hashed
    where they are read. An empty table gives no rows. Other columns are ignored, whatever their names.
    """
    spark, paths = docs.sparkSession, []
    plain = docs.select(*[F.col(f).alias(f"__{i}") for i, f in enumerate(fields)],
                        F.col(group).alias("grp"), F.col(key).alias("key"),
                        *[c.alias(f"__other_{f}") for f, c in (altered or {}).items()])
    own = [F.col(f"__{i}") for i in range(len(fields))]
    other = [F.col(f"__other_{f}") if f in (altered or {}) else c for f, c in zip(fields, own)]
    leaf, second = digest_of(own), digest_of(other)
    leaves = materialize(plain.select("grp", "key", leaf.alias("digest"),
                                      F.when(leaf != second, second).alias("altered_leaf")), "leaves", paths)
    placed, groups, read = positions(leaves, "grp", ["key", "digest"], "leaves", paths)
    levels = tree(placed, "leaves", paths, fan)
    # The groups' roots are the leaves of the tree above, one group.
    number = groups.agg(F.count(F.lit(1))).first()[0]
    subroots = materialize(levels[-1].select(F.lit(0).cast("bigint").alias("g"), F.col("g").alias("pos"),
                                             F.lit(number).cast("bigint").alias("n"), "digest"), "subroots", paths)
    top = tree(subroots, "top", paths, fan)
    root = top[-1].select("g", F.array().cast(PROOF).alias("proof"), F.col("digest").alias("root"))
    ends = with_proofs(subroots, top, root, "top", paths, fan).select(
        F.col("pos").alias("g"), "proof", F.col("digest").alias("subroot"), "root")
    ends = materialize(ends, "group_proofs", paths)
    read.append(paths[-1])
    out = with_proofs(placed, levels, ends, "leaves", paths, fan)
    read.append(paths[-1])
    remove_tables(spark, [p for p in paths if p not in read])
    return out.select(F.col("key").alias(key), F.col("digest").alias("leaf"), "subroot", "root", "proof", "altered_leaf")
