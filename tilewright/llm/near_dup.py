"""Near-duplicate documents by MinHash with tensored banding, confirmed on full shingle sets.

The set of a document is its distinct runs of five lower-cased words (with fewer words, the whole
sequence). Two small collections of ``HALVES`` half keys are made of ``ROWS`` minhashes each; the
keys of the hash tables are all pairs of a half key of the first and one of the second collection.
``HALVES ** 2`` tables of ``2 * ROWS`` rows thus cost ``2 * HALVES * ROWS`` minhashes. A pair of
similarity ``s`` meets with probability ``(1 - (1 - s ** ROWS) ** HALVES) ** 2``: 0.99998 at 0.75.

Documents of equal sets form a class and are represented by its smallest id. Within a table key,
every class is first compared with the smallest of the key. What is linked so far is united. Classes
that share a key with one of another component are then compared across components, where they also
share one of their rarest shingles: the first quarter of a set in order of rarity must meet that of
any set of similarity 0.75, so no link among classes that each share a key with some other class is
lost, and large groups of copies or of texts that are only half alike are not expanded into all
pairs. A class that shares no key with any other is not looked at again.

Defined cases: null or blank texts have no set and are linked with nothing; rows with a null
``doc_id`` are left out; of a repeated ``doc_id`` each row is judged by its own text; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm import bitfilter, dense, textkit
from tilewright.llm.components import components
from tilewright.llm.shared import stored

SHINGLE = 5
HALVES = 14
ROWS = 2
PERCENT = 75
#: Cells (a power of two) of the table by which shingles are called rare.
SKETCH_LOG = 22
NAMED_LOG_BITS = 25
KEY_LOG_BITS = 27

_SALT = np.uint64(0xA24BAED4963EE407)


def shingle_sets(column: pa.Array) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(rows, hashes, first): sorted distinct shingle hashes of row i are ``hashes[first[i]:first[i + 1]]``."""
    for w in textkit.words(column):
        hashes = w.hashes(lower=True)
        windows, at = textkit.window_hashes(hashes, w.first, SHINGLE)
        bounds = np.searchsorted(at, w.first)
        counts = w.counts
        parts = []
        for row, n in enumerate(counts):
            if n >= SHINGLE:
                parts.append(np.unique(windows[bounds[row] : bounds[row + 1]]))
            elif n:
                ends = np.array([w.first[row + 1]])
                parts.append(textkit.span_hashes(hashes, ends - n, ends))
            else:
                parts.append(windows[:0])
        first = np.zeros(len(counts) + 1, dtype=np.int64)
        np.cumsum([len(p) for p in parts], out=first[1:])
        yield w.rows, np.concatenate(parts), first


def _half_keys(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(2 * HALVES, groups) keys, each of ROWS minhashes of the groups that begin at ``starts``."""
    numbers = np.random.default_rng(75).integers(0, 2**32, (2 * HALVES * ROWS, 2), dtype=np.uint32)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    keys = np.empty((2 * HALVES, len(starts)), dtype=np.uint64)
    for k in range(2 * HALVES):
        key = np.full(len(starts), k + 1, dtype=np.uint64)
        for r in range(ROWS):
            a, c = numbers[k * ROWS + r]
            least = np.minimum.reduceat(short * (a | np.uint32(1)) + c, starts)
            key = textkit.mix64(key * _SALT + least)
        keys[k] = key
    return keys


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for rows, hashes, first in shingle_sets(batch.column(1)):
            sizes = np.diff(first)
            full = sizes > 0
            starts = first[:-1][full]
            n = len(sizes)
            digests, keys = np.zeros((2, n), dtype=np.uint64), np.zeros((2 * HALVES, n), dtype=np.uint64)
            if len(starts):
                digests[0, full] = np.add.reduceat(textkit.mix64(hashes), starts)
                digests[1, full] = np.add.reduceat(textkit.mix64(hashes ^ _SALT), starts)
                keys[:, full] = _half_keys(hashes, starts)

            def lists(part: np.ndarray) -> pa.Array:
                flat = pa.array(np.ascontiguousarray(part.T).reshape(-1).view(np.int64))
                return pa.ListArray.from_arrays(pa.array(np.arange(0, HALVES * n + 1, HALVES, dtype=np.int32)), flat)

            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(rows.start, n),
                    pa.array(sizes.astype(np.int64)),
                    pa.array(digests[0].view(np.int64)),
                    pa.array(digests[1].view(np.int64)),
                    lists(keys[:HALVES]),
                    lists(keys[HALVES:]),
                ],
                names=["doc_id", "n_shingles", "d1", "d2", "left", "right"],
            )


def signatures(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, d1, d2 (128-bit digest of the set), left, right (half keys)."""
    schema = "doc_id long, n_shingles long, d1 long, d2 long, left array<long>, right array<long>"
    return documents.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text").mapInArrow(_signatures, schema)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, hashes, first in shingle_sets(batch.column(1)):
            lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(rows.start, len(first) - 1), lists], names=["class", "shingles"])


def joined_pairs(pairs: DataFrame, items: DataFrame) -> DataFrame:
    """a, b, sb, sa: the pairs with the second column of ``items`` for either class.

    That of ``b`` goes to ``a``, so a hub's own is sent once, not once for each partner. Small pairs are
    shuffled too: a task that reads ``items`` from Python doesn't go on to a second Python step.
    """
    content = items.columns[1]
    with_b = pairs.join(items.select(F.col("class").alias("b"), F.col(content).alias("sb")).hint("merge"), "b")
    return with_b.join(items.select(F.col("class").alias("a"), F.col(content).alias("sa")).hint("merge"), "a").select("a", "b", "sb", "sa")


def similar_sets(both: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets ``sa`` and ``sb`` are similar enough."""
    common = F.size(F.array_intersect("sa", "sb"))
    return (
        both.select("a", "b", common.alias("i"), (F.size("sa") + F.size("sb")).alias("n"))
        .where(100 * F.col("i") >= percent * (F.col("n") - F.col("i")))
        .select("a", "b")
    )


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << SKETCH_LOG, dtype=np.int64)
    for batch in batches:
        hashes = np.asarray(batch.column(1).flatten()).view(np.uint64)
        np.add.at(counts, hashes >> np.uint64(64 - SKETCH_LOG), 1)
    yield from dense.rows(counts)


def _rarest(sketch: Broadcast, percent: int) -> Callable:
    """A row for each shingle of the prefix, but for those that no other class can have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sketch.value.values
        for batch in batches:
            prefixes, rows, sizes, places = [np.zeros(0, dtype=np.uint64)], [], [], [np.zeros(0, dtype=np.int64)]
            for row, shingles in enumerate(batch.column(1)):
                hashes = np.asarray(shingles.values).view(np.uint64)
                n = len(hashes)
                seen = counts[hashes >> np.uint64(64 - SKETCH_LOG)]
                first = np.lexsort((hashes, seen))[: n - (percent * n + 99) // 100 + 1]
                place = np.flatnonzero(seen[first] > 1)
                prefix = hashes[first[place]]
                prefixes.append(prefix)
                places.append(place)
                rows.extend([row] * len(prefix))
                sizes.extend([n] * len(prefix))
            at = pa.array(rows, pa.int64())
            columns = [pa.array(np.concatenate(prefixes).view(np.int64)), batch.column(0).take(at)]
            columns += [pa.array(sizes, pa.int32()), pa.array(np.concatenate(places), pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "class", "n", "i"])

    return run


def _met(table: Broadcast) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(bitfilter.contains(table, np.asarray(batch.column(0)).view(np.uint64), KEY_LOG_BITS)))

    return run


def _named(table: Broadcast) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = bitfilter.contains(table, np.asarray(batch.column(2)).view(np.uint64), NAMED_LOG_BITS)
            yield batch.select([0, 1]).filter(pa.array(hit))

    return run


def linked_classes(
    keyed: DataFrame,
    items_of: Callable[[DataFrame], DataFrame],
    percent: int,
    name: str,
    sets_of: Callable = lambda batches: batches,
    similar: Callable[[DataFrame, int], DataFrame] = similar_sets,
) -> DataFrame:
    """node, component of the classes that share a key and are similar enough.

    ``keyed`` has key and class; ``items_of`` turns a frame of ``class`` into class and what is kept
    of it; ``sets_of`` turns batches of that into class, shingles, and ``similar`` picks the pairs alike.
    """
    # only keys that a first count finds twice are shuffled
    met = bitfilter.build_twice(keyed.select("key"), KEY_LOG_BITS)
    keyed = keyed.select("key", "class").mapInArrow(_met(met), "key long, class long")
    heads = keyed.groupBy("key").agg(F.min("class").alias("head"), F.max("class").alias("last")).where("head < last")
    members = stored(keyed.join(heads.select("key", "head"), "key").distinct(), f"{name}-members")
    items = stored(items_of(members.select("class").distinct()), f"{name}-items")
    stars = members.where("class <> head").select(F.col("head").alias("a"), F.col("class").alias("b")).distinct()
    first_links = stored(similar(joined_pairs(stars, items), percent), f"{name}-stars")
    return linked_apart(members, items, first_links, percent, name, sets_of, similar)


def linked_apart(
    members: DataFrame,
    items: DataFrame,
    first_links: DataFrame,
    percent: int,
    name: str,
    sets_of: Callable = lambda batches: batches,
    similar: Callable[[DataFrame, int], DataFrame] = similar_sets,
) -> DataFrame:
    """node, component by ``first_links`` and by links across their components among the ``members`` (key, class) of a key."""
    united = components(first_links)
    labelled = members.join(united.withColumnRenamed("node", "class"), "class", "left").select(
        "key", "class", F.coalesce("component", "class").alias("component")
    )
    mixed = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    apart = stored(labelled.join(mixed.select("key"), "key", "left_semi").select("class", "component").distinct(), f"{name}-apart")
    # two sets that are similar enough share one of their rarest shingles, in any order that is the same for all
    some = items.join(apart.select("class").distinct(), "class", "left_semi")
    sketch = dense.total(some.mapInArrow(lambda batches: _sketch(sets_of(batches)), dense.SCHEMA), 1 << SKETCH_LOG, at_once=True)
    rarest = _rarest(members.sparkSession.sparkContext.broadcast(dense.Packed(sketch.astype(np.int32))), percent)
    prefixes = some.mapInArrow(lambda batches: rarest(sets_of(batches)), "key long, class long, n int, i int")
    prefixes = stored(prefixes.join(apart, "class"), f"{name}-prefixes")
    several = prefixes.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    rest = prefixes.join(several.select("key"), "key", "left_semi")
    # what can still be common from the first common shingle on is at most the rest of either set;
    # the bound is tried on whole components first, so a large one is not met row by row
    sides = rest.groupBy("key", F.col("component").alias("other")).agg(F.min("n").alias("least"), F.max(F.col("n") - F.col("i")).alias("most"))
    crossing = (
        rest.join(sides, "key")
        .where(f"component < other and {100 + percent} * least(n - i, most) >= {percent} * (n + least)")
        .join(
            rest.select("key", F.col("class").alias("c"), F.col("n").alias("m"), F.col("i").alias("j"), F.col("component").alias("other")),
            ["key", "other"],
        )
        .where(f"{100 + percent} * least(n - i, m - j) >= {percent} * (n + m)")
        .select(F.least("class", "c").alias("a"), F.greatest("class", "c").alias("b"))
        .distinct()
    )
    crossing = stored(crossing, f"{name}-crossing")
    return components(stored(first_links.unionByName(confirmed(crossing, items, percent, similar)), f"{name}-links"))


def confirmed(pairs: DataFrame, items: DataFrame, percent: int, similar: Callable[[DataFrame, int], DataFrame]) -> DataFrame:
    """The ``pairs`` (a, b) that are similar enough; ``items`` has class and what is kept of it."""
    # only what the pairs name is joined with them; the bit table keeps the rest out of the shuffle
    named = pairs.select(F.explode(F.array("a", "b")).alias("class"))
    table = bitfilter.build(named.select(F.xxhash64("class")), NAMED_LOG_BITS, at_once=True)
    few = items.withColumn("h", F.xxhash64("class")).mapInArrow(_named(table), items.schema)
    return similar(joined_pairs(pairs, few), percent)


def _table_keys(classes: DataFrame) -> DataFrame:
    """key, class of the table keys that more than one class can have.

    A table key is met twice only if both its halves are, so classes first meet by their
    ``2 * HALVES`` half keys, and the pairs are formed of those that are left.
    """
    halves = classes.select("class", F.posexplode(F.concat("left", "right")).alias("i", "x")).select("x", "class", "i")
    table = bitfilter.build_twice(halves.select("x"), KEY_LOG_BITS)
    some = stored(halves.mapInArrow(_met(table), "x long, class long, i int"), "near-halves")
    twice = some.groupBy("x").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("x")
    side = lambda first: F.collect_list(F.when((F.col("i") < HALVES) == F.lit(first), F.struct("i", "x")))
    left = some.join(twice, "x", "left_semi").groupBy("class").agg(side(True).alias("left"), side(False).alias("right"))
    pairs = left.select("class", F.explode("left").alias("l"), "right").select("class", "l", F.explode("right").alias("r"))
    return pairs.select(F.xxhash64("l.i", "l.x", "r.i", "r.x").alias("key"), "class")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept; one row per row of ``documents`` with an id."""
    docs = stored(signatures(documents), "near-signatures")
    classes = stored(
        docs.where("n_shingles > 0")
        .groupBy("d1", "d2", "n_shingles")
        .agg(F.min("doc_id").alias("class"), F.first("left").alias("left"), F.first("right").alias("right")),
        "near-classes",
    )
    keyed = stored(_table_keys(classes), "near-keys")

    def sets_of_documents(wanted: DataFrame) -> DataFrame:
        texts = documents.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("class"), "text")
        return texts.join(wanted, "class", "left_semi").mapInArrow(_sets, "class long, shingles array<long>")

    found = linked_classes(keyed, sets_of_documents, PERCENT, "near")
    labelled = classes.select("d1", "d2", "n_shingles", "class").join(found.withColumnRenamed("node", "class"), "class", "left")
    of_set = labelled.select("d1", "d2", "n_shingles", F.coalesce("component", "class").alias("component"))
    component = F.coalesce("component", "doc_id")
    return docs.join(of_set, ["d1", "d2", "n_shingles"], "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), (component == F.col("doc_id")).alias("kept")
    )
