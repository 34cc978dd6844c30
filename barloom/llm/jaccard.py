"""N-gram Jaccard join by parity sketches.

A document's set holds its distinct word shingles, as 64-bit hashes. Two sets of sizes ``a`` and
``b`` with Jaccard similarity of at least ``t`` differ in at most ``D = (a + b)(1 - t) / (1 + t)``
elements. A parity sketch deals the elements over ``m`` cells and XORs the hashes of a cell: every
element that one set has and the other lacks changes one cell, so the number of unequal cells (the
Hamming distance over cells) never exceeds the symmetric difference, and of ``m = D + 1 + slack``
cells at least ``1 + slack`` are equal in both. Documents are joined on equal cells.

* Size bands: ``m`` depends on ``D``, so each document emits the sketch of every band that one of
  its possible partners can fall into (one or two bands).
* Empty cells are equal in unrelated documents and are left out. A document that has more than
  ``EMPTY`` of them emits them too. So two similar documents share ``slack + 1 - EMPTY`` emitted cells
  at least.
* Equal sets are one class, by a digest of the set. The digest and the shingle hashes have 64 bits;
  the chance of any false merge among ``n`` classes is about ``n^2 / 2^65``.
* Cells go to tasks by hash, sorted, and stream by: the first class of a cell leads, all others are
  paired with it, so a cell that a third of all documents share gives as many pairs as members, not
  their square. Pairs are filtered by size and by a bit sketch of about two bits per element whose
  Hamming distance is a lower bound as well; sketches of different length are folded. What is left
  is verified on the texts. Linked classes form components. A cell that still holds several
  components may hide pairs that its leader resembles neither of. Classes that are in as many such
  cells as similar sets share at least are joined on their rarest shingles: ordered by how many of
  these classes hold them, two similar sets have one of their first ones in common, while a passage
  that many of them hold comes last. Every candidate pair is thereby verified, ruled out or already
  connected.

Documents without words (null, empty) are linked with nothing; very long ones are read whole. Ties
between shingles or leaders change the order of work, not a link. With fewer words than a shingle the whole sequence
is one shingle. Rows that share an id each count; a row without id joins the component of its exact
copies only. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import look_up, map_batches, text_or_empty
from barloom.llm.components import components
from barloom.sinks.writers import written

SHINGLE = 4
PERCENT = 85
#: Empty cells that a document leaves out.
EMPTY = 2
#: Cells beyond the bound of the difference, at most.
SLACK = 15
#: Pairs that share one copy of their leader's set when pairs are verified.
PAIRS_PER_COPY = 20_000
#: Rows of shared cells for each file of an intermediate table.
ROWS_PER_FILE = 100_000
#: Sets of which a task remembers that their cells are out already.
REMEMBERED = 200_000

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes; A-Z count as a-z, words are runs of non-space characters."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(size, len(words))
    count = len(words) - width + 1
    x = np.full(count, width, np.uint64) * _STEP
    for j in range(width):
        x = mix(x + h[j : j + count] + _STEP)
    return np.unique(x)


def digest(shingles: np.ndarray) -> int:
    """Class of equal sets."""
    return int(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes())).view(np.int64))


def most_different(a: int, b: int, percent: int = PERCENT) -> int:
    """Largest symmetric difference of two sets that are still similar enough."""
    return (100 - percent) * (a + b) // (100 + percent)


def bands(up_to: int) -> list[int]:
    """Bounds of the symmetric difference that have a sketch each."""
    out = [1]
    while out[-1] < up_to:
        out.append(max(out[-1] + 1, int(out[-1] * 1.4)))
    return out


def slack(difference: int) -> int:
    """Cells beyond the largest symmetric difference: few where a set is small."""
    return min(SLACK, EMPTY + difference // 8)


_BANDS = np.array(bands(1 << 40), np.int64)


def cells(shingles: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Join keys of a set: the cells of its sketches."""
    n = len(shingles)
    smallest, largest = -(-n * percent // 100), n * 100 // percent
    high = most_different(n, largest, percent)
    if high == 0:
        return np.zeros(0, np.uint64)  # only equal sets are similar, and they are one class
    low = max(1, most_different(n, smallest, percent))
    out = []
    for band in range(np.searchsorted(_BANDS, low), np.searchsorted(_BANDS, high) + 1):
        m = int(_BANDS[band]) + 1 + slack(int(_BANDS[band]))
        cell = (mix(shingles ^ np.uint64(band + 1)) % np.uint64(m)).astype(np.int64)
        order = np.argsort(cell, kind="stable")
        filled, first = np.unique(cell[order], return_index=True)
        parity = np.bitwise_xor.reduceat(shingles[order], first)
        keys = [mix(parity + mix(filled.astype(np.uint64) * _STEP + np.uint64(band)))]
        if m - len(filled) > EMPTY:
            empty = np.setdiff1d(np.arange(m), filled).astype(np.uint64)
            keys.append(mix(mix(empty * _STEP + np.uint64(band)) + np.uint64(0x5D)))
        # Of sketches of neighbouring bands, the last bit of a key tells which it is of.
        odd = np.uint64(band & 1)
        out += [(k & ~np.uint64(1)) | odd for k in keys]
    return np.concatenate(out)


def bit_sketch(shingles: np.ndarray) -> np.ndarray:
    """One parity bit per position, in 64-bit words.

    The Hamming distance of two sketches never exceeds the symmetric difference of the sets. The
    length is a power of two; XOR of the halves of a sketch gives the sketch of half the length.
    """
    bits = 64
    while bits < 2 * len(shingles):
        bits *= 2
    position = (mix(shingles ^ _STEP) % np.uint64(bits)).astype(np.int64)
    odd = np.bincount(position, minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def signatures(docs: DataFrame, doc_id: str, text: str, percent: int, size: int) -> DataFrame:
    """``doc_id, n, ref, sketch, cells``: set size, class, bit sketch and join keys.

    Copies that one task meets leave sketch and keys out.
    """

    def make():
        out_already: set[int] = set()

        def step(batch: pa.RecordBatch) -> dict:
            n, ref, sketches, keys = [], [], [], []
            for value in batch.column(1).to_pylist():
                s = shingle_set(value, size)
                r = digest(s)
                n.append(len(s))
                ref.append(r)
                if r in out_already or not len(s):
                    sketches.append(None)
                    keys.append(None)
                else:
                    if len(out_already) >= REMEMBERED:
                        out_already.clear()
                    out_already.add(r)
                    sketches.append(bit_sketch(s))
                    keys.append(cells(s, percent).view(np.int64))
            return {"doc_id": batch.column(0), "n": n, "ref": ref, "sketch": sketches, "cells": keys}

        return step

    whole = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("text")
    )
    return map_batches(
        whole,
        make,
        "doc_id bigint, n bigint, ref bigint, sketch array<bigint>, cells array<bigint>",
    )


def _shared_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of cells that two classes or more share, from rows in order of cell and class.

    ``place`` counts the classes of a cell; the class at place 0 leads. Only the open cell's key,
    leader, last class and count are kept between batches.
    """
    key = leader = last = None
    count = 0
    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        refs = batch.column(1).to_numpy(zero_copy_only=False)
        if not len(keys):
            continue
        fresh = np.empty(len(keys), bool)
        fresh[0] = not (keys[0] == key and refs[0] == last)
        fresh[1:] = (keys[1:] != keys[:-1]) | (refs[1:] != refs[:-1])
        keys, refs = keys[fresh], refs[fresh]
        if not len(keys):
            continue
        start = np.empty(len(keys), bool)
        start[0] = keys[0] != key
        start[1:] = keys[1:] != keys[:-1]
        first = np.flatnonzero(np.concatenate([[True], start[1:]]))
        group = np.cumsum(np.concatenate([[0], start[1:].astype(np.int64)]))
        carried = not start[0]
        place = np.arange(len(keys)) - first[group]
        lead = refs[first][group]
        size = np.bincount(group)
        extra = ([], [], [], [])
        if carried:
            place[group == 0] += count
            lead[group == 0] = leader
            if count == 1:  # the leader had no partner so far
                extra = ([key], [leader], [leader], [0])
            size[0] += count
        keep = size[group] > 1
        ended = int(size[-1])
        key, last, leader, count = int(keys[-1]), int(refs[-1]), int(lead[-1]), ended
        out = [np.concatenate([np.array(e, np.int64), x[keep]]) for e, x in zip(extra, (keys, refs, lead, place))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in out], ["cell", "ref", "leader", "place"]
        )


def _texts(
    docs: DataFrame, classes: DataFrame, involved: DataFrame, doc_id: str, text: str, size: int
) -> DataFrame:
    """``ref, text`` of one document of every class in ``involved``, written."""
    wanted = written(
        classes.where("first_id IS NOT NULL")
        .join(involved, "ref", "left_semi")
        .select(F.col("first_id").alias("doc_id"), "ref"),
        "jaccard-wanted",
    )
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("text")
    ).join(wanted.hint("shuffle_hash"), "doc_id")

    def make():
        done: set[int] = set()

        def step(batch: pa.RecordBatch) -> dict:
            out = {"ref": [], "text": []}
            for ref, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                # Ids may repeat, with other texts too; rows of one id meet in one task.
                if ref not in done and digest(shingle_set(value, size)) == ref:
                    done.add(ref)
                    out["ref"].append(ref)
                    out["text"].append(value)
            return out

        return step

    return written(map_batches(rows.select("ref", "text"), make, "ref bigint, text string"), "jaccard-texts")


def _with_sides(pairs: DataFrame, side: DataFrame, salts: int) -> DataFrame:
    """Columns of ``side`` (one row per ``ref``) for both classes of a pair (``a, b``).

    A salt deals the pairs of one leader out to many tasks; the leader's row is copied once for
    every salt that its pairs have.
    """
    names = [c for c in side.columns if c != "ref"]
    pairs = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(salts)))
    one, two = (side.select(F.col("ref").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in names]) for x in "ab")
    leaders = pairs.select("a", "salt").distinct().join(one, "a")
    return pairs.join(leaders, ["a", "salt"]).join(two, "b")


def _may_link(percent: int) -> Column:
    """Whether size and sketches of a pair leave room for enough similarity."""
    allowed = F.floor((F.col("n_a") + F.col("n_b")) * (100 - percent) / (100 + percent))

    def folded(x: str, y: str) -> Column:
        half = F.size(y)
        halves = F.slice(F.col(x), F.lit(1), half), F.slice(F.col(x), half + 1, half)
        xor = F.zip_with(*halves, lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(x) > half, xor).otherwise(F.col(x))

    unequal = F.zip_with(
        folded("sketch_a", "sketch_b"),
        folded("sketch_b", "sketch_a"),
        lambda p, q: F.bit_count(p.bitwiseXOR(q)).cast("long"),
    )
    distance = F.aggregate(unequal, F.lit(0).cast("long"), lambda s, x: s + x)
    near = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    return F.when(near, distance <= allowed).otherwise(False)


def _verified(near: DataFrame, texts: DataFrame, percent: int, size: int, work: "_Work") -> DataFrame:
    """The pairs (``a, b``) whose sets are similar enough, written."""
    both = _with_sides(near, texts, work.salts)

    def make():
        leader, its_set = None, np.zeros(0, np.uint64)

        def step(batch: pa.RecordBatch) -> dict:
            nonlocal leader, its_set
            a, b = [], []
            for left, right, x, y in zip(*(c.to_pylist() for c in batch.columns)):
                if left != leader:
                    leader, its_set = left, shingle_set(x, size)
                other = shingle_set(y, size)
                common = len(np.intersect1d(its_set, other, assume_unique=True))
                if 100 * common >= percent * (len(its_set) + len(other) - common):
                    a.append(left)
                    b.append(right)
            return {"a": a, "b": b}

        return step

    links = map_batches(both.select("a", "b", "text_a", "text_b"), make, "a bigint, b bigint")
    return work.written(links, "jaccard-links")


@dataclass(frozen=True)
class _Work:
    """Files per intermediate table and salts per leader, by the number of shared-cell rows."""

    files: int
    salts: int

    @classmethod
    def of(cls, rows: int) -> "_Work":
        return cls(max(24, -(-rows // ROWS_PER_FILE)), max(1, -(-rows // PAIRS_PER_COPY)))

    def written(self, df: DataFrame, purpose: str) -> DataFrame:
        return written(df.coalesce(self.files), purpose)


def similar_classes(
    shared: DataFrame, sketches: DataFrame, texts: DataFrame, percent: int, size: int, work: _Work
) -> DataFrame:
    """``ref, root`` of all classes that are linked with another one."""
    spark = shared.sparkSession
    roots = spark.createDataFrame([], "ref bigint, root bigint")
    links = spark.createDataFrame([], "a bigint, b bigint")

    def verify(near: DataFrame) -> None:
        nonlocal roots, links
        if near.isEmpty():
            return
        links = links.unionByName(_verified(near, texts, percent, size, work))
        found = components(links, work.files).withColumnsRenamed({"node": "ref"})
        roots = work.written(found, "jaccard-roots")

    # The first class of every cell against the others.
    star = shared.where("ref <> leader").select(F.col("leader").alias("a"), F.col("ref").alias("b"))
    near = _with_sides(star.distinct(), sketches, work.salts).where(_may_link(percent))
    verify(work.written(near.select("a", "b"), "jaccard-near"))

    # Cells whose other members are not one component: these classes may still have partners there.
    rest = shared.where("place > 0").select("cell", "ref").join(roots, "ref", "left")
    rest = rest.withColumn("root", F.coalesce("root", "ref"))
    mixed = rest.groupBy("cell").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    open_ = rest.join(mixed.where("low <> high").select("cell"), "cell")
    # Two similar classes of different components share several such cells of one band.
    held = open_.groupBy("ref", "root", F.col("cell").bitwiseAND(1).alias("band")).agg(F.count(F.lit(1)).alias("cells"))
    held = held.groupBy("ref", "root").agg(F.max("cells").alias("cells"))
    least = F.ceil(F.col("n") * percent / 100)
    difference = F.floor((F.col("n") + least) * (100 - percent) / (100 + percent))
    shared_cells = F.least(F.lit(SLACK), F.lit(EMPTY) + F.floor(F.greatest(F.lit(1), difference) / 8)) + 1 - EMPTY
    many = held.join(sketches, "ref").where(F.col("cells") >= shared_cells)
    many = many.select("ref", "root", _folded(F.col("sketch")).alias("fold"))
    pairs = _sharing_rare_shingles(many, texts, percent, size, work)
    near = _with_sides(pairs, sketches, work.salts).where(_may_link(percent))
    verify(work.written(near.select("a", "b"), "jaccard-near"))
    return roots


#: Words that a sketch is folded to while pairs are looked for.
FOLD = 2


def _folded(sketch: Column) -> Column:
    """A sketch of at most ``FOLD`` words: XOR of the words whose places are equal modulo that."""

    def word(k: Column) -> Column:
        places = F.sequence(k, F.size(sketch) - 1, F.lit(FOLD))
        return F.aggregate(places, F.lit(0).cast("long"), lambda x, i: x.bitwiseXOR(F.get(sketch, i)))

    folded = F.transform(F.sequence(F.lit(0), F.lit(FOLD - 1)), word)
    return F.when(F.size(sketch) > FOLD, folded).otherwise(sketch)


def _sharing_rare_shingles(
    open_: DataFrame, texts: DataFrame, percent: int, size: int, work: _Work
) -> DataFrame:
    """Pairs (``a < b``) of classes (``ref, root, fold``) of different components that share a rare shingle.

    In any order of all shingles, of two similar sets the larger one's first ``n - ceil(t n) + 1`` and
    the smaller one's first ``n - ceil(2 t n / (1 + t)) + 1`` have one in common, and from the first
    common one on both must hold enough more to overlap. Here rare ones come first, so a passage that
    many classes hold comes last and is not reached. Shingles of one class alone match nothing; they
    only use up its places. Folded sketches rule most pairs out where they meet.
    """

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            sets = [shingle_set(x, size) for x in batch.column(1).to_pylist()]
            shingles = [s.view(np.int64) for s in sets]
            return {"ref": batch.column(0), "shingles": shingles}

        return step

    open_ = work.written(open_, "jaccard-many")
    held = texts.join(open_, "ref", "left_semi").select("ref", "text")
    sets = work.written(map_batches(held, make, "ref bigint, shingles array<bigint>"), "jaccard-sets")
    each = sets.select("ref", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    counts = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1")
    common = each.join(counts, "shingle")
    of_class = Window.partitionBy("ref")
    in_order = of_class.orderBy("holders", "shingle")
    alone = F.col("n") - F.count(F.lit(1)).over(of_class)
    place = alone + F.row_number().over(in_order)
    longer = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    shorter = F.col("n") - F.ceil(F.col("n") * (2 * percent) / (100 + percent)) + 1
    first = common.withColumns({"place": place, "prior": F.lag("shingle").over(in_order)})
    first = first.where(F.col("place") <= longer)
    first = first.select("shingle", "prior", "ref", "n", "place", (F.col("place") <= shorter).alias("short"))
    return _meetings(work.written(first.join(open_, "ref"), "jaccard-first"), percent).distinct()


def _meetings(first: DataFrame, percent: int) -> DataFrame:
    """Pairs (``a < b``) that meet at a shingle of both, each once per run of shingles that both have in order.

    Two classes whose shingles before this one are equal too met there already: both are one place
    earlier, where every condition on places holds if it does here.
    """
    names = ("ref", "root", "n", "place", "prior", "fold")
    one, two = (
        first.where(f"short OR {x == 'b'}").select("shingle", *[F.col(c).alias(f"{c}_{x}") for c in names])
        for x in "ab"
    )
    overlap = 1 + F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    enough = (100 + percent) * overlap >= percent * (F.col("n_a") + F.col("n_b"))
    in_order = "n_a < n_b OR (n_a = n_b AND ref_a < ref_b)"
    allowed = F.floor((F.col("n_a") + F.col("n_b")) * (100 - percent) / (100 + percent))
    unequal = F.zip_with("fold_a", "fold_b", lambda p, q: F.bit_count(p.bitwiseXOR(q)).cast("long"))
    apart = F.aggregate(unequal, F.lit(0).cast("long"), lambda s, x: s + x)
    near = (F.size("fold_a") != F.size("fold_b")) | (apart <= allowed)
    new = F.coalesce(F.col("prior_a") != F.col("prior_b"), F.lit(True))
    pairs = one.join(two, "shingle").where("root_a <> root_b").where(in_order).where(enough & near & new)
    return pairs.select(F.least("ref_a", "ref_b").alias("a"), F.greatest("ref_a", "ref_b").alias("b"))


def similar_documents(
    docs: DataFrame,
    percent: int = PERCENT,
    size: int = SHINGLE,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row."""
    signed = written(signatures(docs, doc_id, text, percent, size), "jaccard-signatures")
    rows = (
        signed.where("cells IS NOT NULL")
        .select(F.explode("cells").alias("cell"), "ref")
        .repartition("cell")
        .sortWithinPartitions("cell", "ref")
    )
    shared = written(
        rows.mapInArrow(_shared_cells, "cell bigint, ref bigint, leader bigint, place bigint"),
        "jaccard-cells",
    )
    classes = signed.where("n > 0").groupBy("ref").agg(
        F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("rows")
    )
    classes = written(classes, "jaccard-classes")
    involved = shared.select("ref").distinct()
    sketches = written(
        signed.where("cells IS NOT NULL")
        .select("ref", "n", "sketch")
        .join(involved, "ref", "left_semi")
        .dropDuplicates(["ref"]),
        "jaccard-sketches",
    )
    texts = _texts(docs, classes, involved, doc_id, text, size)
    roots = similar_classes(shared, sketches, texts, percent, size, _Work.of(shared.count()))
    linked = roots.join(classes.select("ref", "first_id"), "ref")
    smallest = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = linked.join(smallest, "root").select("ref", "component_id")
    named = classes.join(linked, "ref", "left").select(
        "ref", F.coalesce("component_id", "first_id").alias("component_id"), "rows"
    )
    return look_up(
        signed.select("doc_id", F.col("n").alias("n_shingles"), "ref"),
        written(named, "jaccard-names"),
        "ref",
        ["component_id"],
        "rows",
    ).select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
