"""Operator 11: Merkle manifest of a dataset, by checkpoints and recomputation.

Every row is a leaf. The leaves of one source form a tree, FAN nodes to a parent, and the
tops of all sources, ordered by source, form one more tree, whose top is the root.

* Places. Leaves are sorted over all machines by (source, doc_id), and a leaf's place in
  its source follows from the number of rows that each sorted part holds of it; no
  source has to fit a task.
* Checkpoints. Of each tree only every STEP-th level is stored. FAN ** STEP consecutive
  nodes are an aligned subtree: they meet in one row, which computes the levels between
  without storing them.
* Proofs. From the top down, each stored level is gathered into its aligned subtrees
  again; the missing levels are computed anew, the siblings of every node are written out
  as one (left, right) step a level, and the levels are thrown away. The steps
  above a subtree are the same for all its nodes and come from the level above.

A proof is an array of steps; `fold` runs a leaf through them. A level at which a node
has no siblings is a step with two empty sides.

Null values are a `-` in the leaf. A null source is a source of its own and comes first;
null doc_ids come first in theirs; rows of equal doc_id are ordered by their digest, and
equal rows are interchangeable. An empty table has no rows and no root (None).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestrata.session import stage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Nodes of one parent.
FAN = 16
#: Levels from one stored level to the next.
STEP = 2
BLOCK = FAN**STEP


def leaf_digest(*values: Column) -> Column:
    """SHA-256 over the values, each as its length in bytes and itself, or `-`."""
    parts = []
    for value in values:
        text = value.cast("string")
        sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(sized, F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings of a proof, level by level, left to right."""
    sides = F.transform(path, lambda s: F.concat(s["left"], s["right"]))
    return F.sha2(F.array_join(sides, ""), 256)


@dataclass(frozen=True)
class Tree:
    """Stored levels of the trees of a forest: (tree, pos, n, node, row), bottom first."""

    levels: list[DataFrame]

    def tops(self) -> DataFrame:
        """(tree, node) of the tops."""
        ends = [level.where("n = 1").select("tree", "node") for level in self.levels]
        out = ends[0]
        for more in ends[1:]:
            out = out.unionAll(more)
        return out


@dataclass(frozen=True)
class Manifest:
    sources: Tree
    whole: Tree
    root: str | None


def _placed(rows: DataFrame) -> DataFrame:
    """(tree, pos, n, node, row) of (tree, key, node, row): places within every tree."""
    order = ["tree", "key", "node", "_at"]
    rows = rows.withColumn("_at", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_at")
    # the id counts a partition's rows in their order below its number
    rows = rows.withColumn("_id", F.monotonically_increasing_id())
    rows = stage(rows.withColumn("_part", F.shiftright("_id", 33)), "sorted")
    runs = rows.groupBy("tree", "_part").agg(F.count(F.lit(1)).alias("m"), F.min("_id").alias("_first"))
    along = Window.partitionBy("tree").orderBy("_part")
    before = F.coalesce(F.sum("m").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.withColumn("_before", before).withColumn("n", F.sum("m").over(Window.partitionBy("tree")))
    placed = rows.join(runs.drop("m"), ["tree", "_part"])
    pos = F.col("_before") + F.col("_id") - F.col("_first")
    return placed.select("tree", pos.alias("pos"), "n", "node", "row")


def _less(n: Column) -> Column:
    """Nodes of a tree one level up."""
    return F.floor((n + (FAN - 1)) / FAN)


def _parents(nodes: Column) -> Column:
    """Digests of consecutive runs of nodes."""
    last = F.floor((F.size(nodes) - 1) / FAN)
    return F.transform(
        F.sequence(F.lit(0).cast("bigint"), last),
        lambda g: F.sha2(F.array_join(F.slice(nodes, (g * FAN + 1).cast("int"), F.lit(FAN)), ""), 256),
    )


def _subtrees(level: DataFrame, *extra: str) -> DataFrame:
    """A row for each aligned subtree of a stored level, its levels l0, l1, ... computed.

    `n0`, `n1`, ... are the nodes that the whole tree has there. A level above the top
    repeats the top.
    """
    block = F.floor(F.col("pos") / BLOCK).alias("block")
    own = F.sort_array(F.collect_list(F.struct("pos", "node", *extra)))
    out = level.where("n > 1").groupBy("tree", block, F.col("n").alias("n0")).agg(own.alias("own"))
    out = out.withColumn("l0", F.col("own.node"))
    for s in range(STEP):
        more = F.col(f"n{s}") > 1
        out = out.withColumn(f"n{s + 1}", _less(F.col(f"n{s}")))
        out = out.withColumn(f"l{s + 1}", F.when(more, _parents(F.col(f"l{s}"))).otherwise(F.col(f"l{s}")))
    return out


def grow(leaves: DataFrame) -> Tree:
    """Trees over the leaves (tree, key, node, row); `row` comes along to the proofs."""
    levels = [stage(_placed(leaves), "level")]
    most = levels[0].agg(F.max("n")).first()[0] or 0
    while most > 1:
        up = _subtrees(levels[-1]).select(
            "tree",
            F.col("block").alias("pos"),
            F.col(f"n{STEP}").alias("n"),
            F.element_at(f"l{STEP}", 1).alias("node"),
            F.lit(None).cast(leaves.schema["row"].dataType).alias("row"),
        )
        levels.append(stage(up, "level"))
        for _ in range(STEP):
            most = -(-most // FAN)
    return Tree(levels)


def _steps(j: Column) -> Column:
    """The steps of node j of a subtree within it."""
    steps = []
    for s in range(STEP):
        nodes, at = F.col(f"l{s}"), F.floor(j / FAN**s).cast("int")
        begin = (F.floor(at / FAN) * FAN).cast("int")
        left = F.array_join(F.slice(nodes, begin + 1, at - begin), "")
        right = F.array_join(F.slice(nodes, at + 2, begin + (FAN - 1) - at), "")
        steps.append(F.when(F.col(f"n{s}") > 1, F.struct(left.alias("left"), right.alias("right"))))
    return F.filter(F.array(*steps), lambda x: x.isNotNull())


def _proved(tree: Tree, above: DataFrame) -> DataFrame:
    """(tree, pos, node, row, path, facts) of all leaves; `above` has a path and facts a tree."""
    paths = None
    for level in reversed(tree.levels):
        tops = level.where("n = 1").join(above, "tree")
        tops = tops.select("tree", "pos", "node", "row", "path", "facts")
        if paths is None:
            paths = tops
            continue
        upper = paths.select("tree", F.col("pos").alias("block"), F.col("path").alias("upper"), "facts")
        met = _subtrees(level, "row").join(upper, ["tree", "block"])
        each = F.transform(
            "own", lambda x, j: F.struct(x.alias("x"), _steps(j).alias("steps"))
        )
        met = met.select("tree", F.explode(each).alias("e"), "upper", "facts")
        paths = tops.unionAll(
            met.select(
                "tree", "e.x.pos", "e.x.node", "e.x.row", F.concat("e.steps", "upper").alias("path"), "facts"
            )
        )
    return paths


def build(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    by: str = "source",
    key: str = "doc_id",
    carry: Mapping[str, Column] | None = None,
) -> Manifest:
    """Manifest of a table. `carry` names further columns that the proofs shall have."""
    tree = F.coalesce(F.concat(F.lit("s"), F.col(by).cast("string")), F.lit("n"))
    row = [F.col(key).alias("key"), *[c.alias(n) for n, c in (carry or {}).items()]]
    leaves = docs.select(
        tree.alias("tree"),
        F.col(key).alias("key"),
        leaf_digest(*[F.col(f) for f in fields]).alias("node"),
        F.struct(*row).alias("row"),
    )
    sources = grow(stage(leaves, "leaves"))
    tops = sources.tops().select(
        F.lit("").alias("tree"), F.col("tree").alias("key"), "node", F.struct("tree").alias("row")
    )
    whole = grow(stage(tops, "tops"))
    first = whole.tops().first()
    return Manifest(sources, whole, first.node if first else None)


def proofs(manifest: Manifest) -> DataFrame:
    """A row for each leaf: key, leaf, subroot, root, path, and the carried columns.

    `path` is an array of (left, right), from the leaf to the root.
    """
    step = "array<struct<left:string,right:string>>"
    start = manifest.whole.tops().select("tree", F.array().cast(step).alias("path"), F.lit("").alias("facts"))
    above = _proved(manifest.whole, start)
    above = stage(above.select("row.tree", "path", F.col("node").alias("facts")), "paths")
    found = _proved(manifest.sources, above)
    return found.select(
        "row.key",
        F.col("node").alias("leaf"),
        F.col("facts").alias("subroot"),
        F.lit(manifest.root).cast("string").alias("root"),
        "path",
        *[f"row.{name}" for name in found.schema["row"].dataType.fieldNames()[1:]],
    )


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def tampered(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified after tampering.

    Where 5 divides the CRC of the doc_id, the capitals of the text are lower-cased
    after the manifest was made; proofs are checked with what the rows hold then.
    """
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lower = F.translate("text", _UPPER, _UPPER.lower())
    values = [F.col(f) for f in FIELDS[:-1]]
    found = proofs(build(docs, carry={"now": F.when(hit, leaf_digest(*values, lower))}))
    folded = fold(F.coalesce("now", "leaf"), F.col("path"))
    out = found.select(
        F.col("key").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


#: The same rows by whole levels: a node's level, place and number of nodes beside it.
ORACLE_SQL = """
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
    CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i)) AS t
), base AS (
  SELECT doc_id, coalesce('s' || source, 'n') AS tree, text,
    coalesce(octet_length(encode(doc_id::VARCHAR))::VARCHAR || ':' || doc_id, '-')
      || coalesce(octet_length(encode(source))::VARCHAR || ':' || source, '-')
      || coalesce(octet_length(encode(lang))::VARCHAR || ':' || lang, '-')
      || coalesce(octet_length(encode(n_chars::VARCHAR))::VARCHAR || ':' || n_chars, '-') AS head,
    coalesce(xor(4294967295, list_reduce(
      list_transform(regexp_extract_all(hex(encode(doc_id::VARCHAR)), '..'), lambda b: ('0x' || b)::BIGINT),
      lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), 4294967295)) % 5 = 0, false) AS hit
  FROM documents, crc_table
), leaves AS (
  SELECT *, sha256(head || coalesce(octet_length(encode(text))::VARCHAR || ':' || text, '-')) AS leaf,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM base
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY tree) AS n,
    CASE WHEN hit THEN sha256(head || coalesce(octet_length(encode(low))::VARCHAR || ':' || low, '-'))
      ELSE leaf END AS now
  FROM leaves
), nodes AS (
  SELECT 0 AS level, tree, pos, n, leaf AS node FROM placed
  UNION ALL
  SELECT any_value(level) + 1, tree, pos // 16, any_value((n + 15) // 16), sha256(string_agg(node, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY tree, pos // 16
), tops AS (
  SELECT tree, level AS height, node, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n
  FROM nodes WHERE n = 1
), upper_nodes AS (
  SELECT 0 AS level, pos, n, node FROM tops
  UNION ALL
  SELECT any_value(level) + 1, pos // 16, any_value((n + 15) // 16), sha256(string_agg(node, '' ORDER BY pos))
  FROM upper_nodes WHERE n > 1 GROUP BY pos // 16
), sides AS (
  SELECT level, tree, pos,
    coalesce(string_agg(node, '') OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(node, '') OVER (r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM nodes WHERE n > 1 WINDOW r AS (PARTITION BY level, tree, pos // 16 ORDER BY pos)
  UNION ALL
  SELECT level, NULL, pos,
    coalesce(string_agg(node, '') OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ''),
    coalesce(string_agg(node, '') OVER (r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '')
  FROM upper_nodes WHERE n > 1 WINDOW r AS (PARTITION BY level, pos // 16 ORDER BY pos)
), walk AS (
  SELECT p.doc_id, p.leaf, p.tree AS home, p.tree, 0 AS level, p.pos, t.height, p.now AS node, '' AS siblings, t.pos AS up, t.node AS subroot
  FROM placed p JOIN tops t USING (tree)
  UNION ALL
  SELECT w.doc_id, w.leaf, w.home, CASE WHEN w.level < w.height THEN w.tree END,
    CASE WHEN w.level < w.height THEN w.level + 1 WHEN w.tree IS NOT NULL THEN 0 ELSE w.level + 1 END,
    CASE WHEN w.level < w.height OR w.tree IS NULL THEN w.pos // 16 ELSE w.up END,
    CASE WHEN w.tree IS NOT NULL AND w.level = w.height THEN -1 ELSE w.height END,
    CASE WHEN s.l IS NULL THEN w.node ELSE sha256(s.l || w.node || s.r) END,
    w.siblings || coalesce(s.l, '') || coalesce(s.r, ''), w.up, w.subroot
  FROM walk w LEFT JOIN sides s ON s.level = w.level AND s.pos = w.pos AND s.tree IS NOT DISTINCT FROM w.tree
  WHERE w.tree IS NOT NULL OR s.l IS NOT NULL
)
SELECT doc_id, leaf, subroot, top.node AS root, sha256(siblings) AS proof_sha256, w.node AS folded_root,
  w.node = top.node AS verified
FROM walk w, (SELECT node FROM upper_nodes WHERE n = 1) top
WHERE w.tree IS NULL AND w.level = (SELECT max(level) FROM upper_nodes)
"""
