"""Merkle manifest of a table of documents, with a proof for every row.

A row's leaf is the digest of its fields. The leaves of a source ascend by ``doc_id``; every
``FAN`` consecutive nodes hash into their parent until one node, the subroot, remains. Subroots in
order of source hash the same way into the root.

Per level, lag and lead columns at the fixed offsets 1 to ``FAN - 1`` supply a node's siblings,
masked by its slot (place among the siblings) and by the length of its run, which is shorter at
the end of a series. Rows in slot 0 hash their run into the parent. Levels are tables that shrink
by ``FAN``; on the way down a row receives the path of its parent, so only digests of a level, never
whole proofs of documents, are shuffled with it. No window holds more than one run: a hot source is
as many window partitions as any other, and positions come from a range sort by (source, id, leaf)
with counts per partition.

Null fields have a mark of their own, empty texts have length 0, texts are hashed whole whatever
their length. A missing id sorts first, a missing source is a source of its own and comes first.
Rows that repeat whole have equal leaves in neighbouring slots; rows that share an id are ordered by
leaf. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.sinks.writers import written

FAN = 16
#: Fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_PATH = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """A value as a leaf holds it: ``-`` if missing, else its bytes after their number."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def leaf(values: Sequence[Column]) -> Column:
    return digest(*[field(v) for v in values])


def positions(rows: DataFrame, series: str, order: Sequence[str], purpose: str) -> DataFrame:
    """Rows with ``pos`` (from 0) and ``n`` (rows) of their series, written.

    Rows are sorted by range; each range is numbered on its own and starts where the counts of the
    ranges before it end. ``order`` must keep the rows of a series together. Equal rows are told
    apart by their place in the table, so no group of copies is bound to one range.
    """
    spread = rows.withColumn("__tie", F.xxhash64(F.monotonically_increasing_id()))
    ordered = spread.repartitionByRange(*order, "__tie").sortWithinPartitions(*order, "__tie")
    placed = ordered.drop("__tie").withColumn("__at", F.monotonically_increasing_id())
    placed = written(placed.withColumn("__range", F.shiftrightunsigned("__at", 33)), purpose)
    ranges = placed.groupBy(series, "__range").agg(
        F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__rows")
    )
    whole = Window.partitionBy(series)
    before = whole.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select(
        series,
        "__range",
        (F.coalesce(F.sum("__rows").over(before), F.lit(0)) - F.col("__first")).alias("__shift"),
        F.sum("__rows").over(whole).alias("n"),
    )
    return (
        placed.join(starts, [series, "__range"])
        .withColumn("pos", F.col("__at") + F.col("__shift"))
        .drop("__at", "__shift", "__range")
    )


def with_siblings(nodes: DataFrame) -> DataFrame:
    """Nodes (``series, n, pos, node``) with ``run`` and the siblings to the ``left`` and ``right``.

    Both are the digests' hex texts, in order, joined; empty for a node that has none.
    """
    run = F.floor(F.col("pos") / FAN).cast("long")
    slot, length = F.col("pos") - F.col("run") * FAN, F.col("n") - F.col("run") * FAN
    window = Window.partitionBy("series", "run").orderBy("pos")
    left = [F.when(slot >= k, F.lag("node", k).over(window)) for k in range(FAN - 1, 0, -1)]
    right = [F.when(slot + k < length, F.lead("node", k).over(window)) for k in range(1, FAN)]
    return nodes.withColumn("run", run).withColumns(
        {"left": F.concat_ws("", *left), "right": F.concat_ws("", *right)}
    )


def climb(nodes: DataFrame) -> list[DataFrame]:
    """Tables of all levels, written: from the given nodes to one node per series.

    A series that has one node left passes it on unchanged.
    """
    levels = [nodes]
    while (levels[-1].agg(F.max("n")).first()[0] or 0) > 1:
        joined = F.when(F.col("n") > 1, digest(F.col("node"), F.col("right"))).otherwise(F.col("node"))
        parents = with_siblings(levels[-1].select("series", "n", "pos", "node")).where(
            F.col("pos") == F.col("run") * FAN
        )
        parents = parents.select(
            "series", F.ceil(F.col("n") / FAN).cast("long").alias("n"), F.col("run").alias("pos"),
            joined.alias("node"),
        )
        levels.append(written(parents, "merkle-level"))
    return levels


def _under(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """Nodes with the siblings of every level from their own to the last, as ``path``.

    ``above`` has the paths of their parents and whatever else is handed down.
    """
    parents = above.withColumnsRenamed({"pos": "run", "path": "__path"})
    own = F.array(F.struct("left", "right")).cast(_PATH)
    path = F.when(F.col("n") > 1, F.concat(own, "__path")).otherwise(F.col("__path"))
    joined = with_siblings(nodes).join(parents, ["series", "run"])
    return joined.withColumn("path", path).drop("left", "right", "run", "__path")


def descend(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The first level's nodes with ``path``; ``tops`` has ``series, path, ...`` of the last."""
    paths = levels[-1].select("series", "pos").join(tops, "series")
    if len(levels) == 1:
        return levels[0].join(paths.drop("pos"), "series")
    for level in reversed(levels[1:-1]):
        handed = _under(level.select("series", "n", "pos", "node"), paths).drop("n", "node")
        paths = written(handed, "merkle-paths")
    return _under(levels[0], paths)


def fold(node: Column, path: Column) -> Column:
    """The root that a node and its siblings lead to."""
    return F.aggregate(path, node, lambda h, x: digest(x.left, h, x.right))


def proof(path: Column) -> Column:
    """Digest of all siblings, level by level and left to right."""
    return digest(F.array_join(F.transform(path, lambda x: F.concat(x.left, x.right)), ""))


def manifest(docs: DataFrame, **extra: Column) -> DataFrame:
    """``doc_id, leaf, subroot, root, path`` of every row, and the ``extra`` columns.

    ``path`` holds the siblings to the left and right of every level up to the root; :func:`fold`
    leads from a leaf and its path to the root.
    """
    source = F.col("source")
    leaves = docs.select(
        field(source).alias("series"), source.alias("source"), F.col("doc_id").alias("doc_id"),
        leaf([F.col(c) for c in FIELDS]).alias("node"), *[c.alias(name) for name, c in extra.items()],
    )
    order = ["source", "doc_id", "node"]
    levels = climb(written(positions(leaves, "series", order, "merkle-leaves").drop("source"), "merkle-placed"))
    tops = _top(levels[-1], docs.select(field(source).alias("series"), source.alias("source")).distinct())
    found = descend(levels, tops)
    return found.select("doc_id", F.col("node").alias("leaf"), "subroot", "root", "path", *extra)


def _top(subroots: DataFrame, sources: DataFrame) -> DataFrame:
    """``series, subroot, root, path``: the tree over the subroots in order of source."""
    named = subroots.select(F.col("series").alias("name"), "node").join(
        sources.withColumnRenamed("series", "name"), "name"
    )
    named = named.withColumn("series", F.lit(""))
    levels = climb(written(positions(named, "series", ["source"], "merkle-subroots"), "merkle-placed"))
    root = levels[-1].select("node").first()
    empty = subroots.sparkSession.range(1).select(F.lit("").alias("series"), F.array().cast(_PATH).alias("path"))
    return descend(levels, empty).select(
        F.col("name").alias("series"), F.col("node").alias("subroot"),
        F.lit(root[0] if root else None).cast("string").alias("root"), "path",
    )


def verified_manifest(docs: DataFrame, tampered: Column, altered: Column) -> DataFrame:
    """Every row's proof, and the root it leads to after tampering with some texts.

    Where ``tampered`` holds, the text is replaced by ``altered`` before the leaf is folded with
    the siblings of the untampered table; ``verified`` tells whether the root is still reached.
    """
    changed = leaf([altered if c == "text" else F.col(c) for c in FIELDS])
    rows = manifest(docs, __changed=F.when(F.coalesce(tampered, F.lit(False)), changed))
    folded = fold(F.coalesce("__changed", "leaf"), F.col("path"))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
