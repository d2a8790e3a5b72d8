"""Similarity join of documents on their sets of five-word shingles.

Documents with the same set are one class from the start. A class enters one tile per shingle of its
prefix: the ``n - ceil(0.8 n) + 1`` first shingles in an order that puts very common ones last, so two
sets that are similar enough always meet, and texts that only share a passage do not. Within tiles:

1. every class is paired with the one that has the tile's shingle earliest in its prefix, so the one
   with the fewest shingles of its own (linear in the tile, also for huge groups);
2. pairs must pass the bound of their places: behind the first shingle that two sets share, each has only
   so many left, which bounds the overlap from above (:func:`_reachable`; sizes are bounded by it too).
   Then they must pass the bound of their hashed bitmaps: a bit set on one
   side only is a shingle the other side lacks, so bit counts bound the overlap from above;
3. what is left is decided by the exact intersection of the sorted arrays, and links make components;
4. classes of a tile that are still in different components are paired with each other and decided
   the same way, so no link between different texts is lost, and none within a component is repeated.

The common shingles are found by lossy counting over all documents: counts are taken per stretch of a
task's shingles, kept from two up, summed, and a shingle is common from ``max(64, total / 2^20)`` on. There are at most 2^20
of those, 8 MB, whatever the corpus; the order only has to be the same for all documents.

Defined results: null or blank text has no shingle and stands alone; rows that repeat a doc_id are
documents of their own; a null doc_id stands alone with a null component; an empty table gives no
rows; other columns are ignored by :func:`near_groups` and kept by :func:`representatives`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.shared import components, compressed, plain_names, scratch, stage, unpacked
from opinara.llm.shingles import chunks, mixed, set_digests, shingle_sets

SIMILARITY_PERCENT = 80
COMMON_FROM = 64
COUNTED_AT_ONCE = 1 << 20
ARROW_ROWS = 500
COMMON_AT_MOST = 1 << 20


def _texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    return [t or b"" for t in batch.column(name).cast(pa.binary()).to_pylist()]


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _bitmaps(hashes: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """One bitmap per set, of 2^k bits, at least twice as many as shingles; none for an empty set."""
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        size = 1 << max(6, (b - a - 1).bit_length() + 1)
        bits = np.zeros(size, bool)
        bits[mixed(hashes[a:b]) & np.uint64(size - 1)] = True
        out.append(np.packbits(bits, bitorder="little").tobytes() if b > a else None)
    return pa.array(out, pa.binary())


_COUNTED = ["doc_id", "n_shingles", "id", "bitmap", "shingle", "times"]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc_id, n_shingles, id, bitmap`` per document (id: name of its set), and the counts of
    shingles that repeat among ``COUNTED_AT_ONCE`` as further rows ``shingle, times``."""
    seen, held, kind = [], 0, pa.int64()
    for batch in batches:
        kind = batch.schema.field("doc_id").type
        for lo, part in chunks(_texts(batch)):
            hashes, offsets = shingle_sets(part)
            n = len(part)
            none = pa.nulls(n, pa.int64())
            names, sizes = _signed(set_digests(hashes, offsets)), pa.array(np.diff(offsets))
            ids, maps = batch.column("doc_id").slice(lo, n), _bitmaps(hashes, offsets)
            yield pa.RecordBatch.from_arrays([ids, sizes, names, maps, none, none], names=_COUNTED)
            seen.append(hashes)
            held += len(hashes)
            if held >= COUNTED_AT_ONCE:
                yield _repeated(seen, kind)
                seen, held = [], 0
    if seen:
        yield _repeated(seen, kind)


def _repeated(seen: list[np.ndarray], kind: pa.DataType) -> pa.RecordBatch:
    found, times = np.unique(np.concatenate(seen), return_counts=True)
    found, times = found[times > 1], times[times > 1]
    none = pa.nulls(len(found), pa.int64())
    left = [pa.nulls(len(found), kind), none, none, pa.nulls(len(found), pa.binary())]
    return pa.RecordBatch.from_arrays([*left, _signed(found), pa.array(times)], names=_COUNTED)


def prefix_length(n: np.ndarray) -> np.ndarray:
    return n - (n * SIMILARITY_PERCENT + 99) // 100 + 1


def _prefixes(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """``shingle, id, place``: the prefix of every document in the common order; ``place`` is the size of the
    set and, in its lower 32 bits, the shingle's place in that order from 0."""
    shipped = docs.sparkSession.sparkContext.broadcast(common)  # at most 2^20 hashes

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late = shipped.value
        for batch in batches:
            for _, part in chunks(_texts(batch)):
                hashes, offsets = shingle_sets(part)
                n = np.diff(offsets)
                owner = np.repeat(np.arange(len(part)), n)
                place = np.searchsorted(late, hashes)
                last = np.zeros(len(hashes), bool)
                if len(late):
                    last = late[np.minimum(place, len(late) - 1)] == hashes
                order = np.lexsort((hashes, last, owner))
                rank = np.arange(len(hashes)) - np.repeat(offsets[:-1], n)
                inside = rank < prefix_length(n)[owner]
                chosen = order[inside]
                names = set_digests(hashes, offsets)
                place = (n[owner[chosen]] << 32) | rank[inside]
                yield pa.RecordBatch.from_arrays(
                    [_signed(hashes[chosen]), _signed(names[owner[chosen]]), pa.array(place)],
                    names=["shingle", "id", "place"],
                )

    return docs.select("text").mapInArrow(entries, "shingle bigint, id bigint, place bigint")


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``id, want, hashes`` per text."""
    for batch in batches:
        wanted = batch.column("want")
        for lo, part in chunks([unpacked(t.as_py()) for t in batch.column("packed")]):
            hashes, offsets = shingle_sets(part)
            bounds = zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    _signed(set_digests(hashes, offsets)),
                    wanted.slice(lo, len(part)),
                    pa.array([hashes[a:b].tobytes() for a, b in bounds], pa.binary()),
                ],
                names=["id", "want", "hashes"],
            )


def _folded(bitmap: bytes, size: int) -> np.ndarray:
    bits = np.frombuffer(bitmap, np.uint8)
    return np.bitwise_or.reduce(bits.reshape(-1, size), axis=0)


def overlap_bound(a: bytes, b: bytes, n_a: int, n_b: int) -> int:
    """At least the size of the intersection, from two bitmaps; the longer is folded to the shorter."""
    size = min(len(a), len(b))
    x, y = _folded(a, size), _folded(b, size)
    return min(n_a - int(np.bitwise_count(x & ~y).sum()), n_b - int(np.bitwise_count(y & ~x).sum()))


def _passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose bitmaps allow enough overlap."""
    for batch in batches:
        na, nb = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
        rows = zip(batch.column("bitmap_a"), batch.column("bitmap_b"), na.tolist(), nb.tolist(), strict=True)
        bound = np.array([overlap_bound(x.as_py(), y.as_py(), n, m) for x, y, n, m in rows], np.int64)
        keep = bound * 100 >= (na + nb - bound) * SIMILARITY_PERCENT
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose sorted arrays intersect in enough places."""
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("hashes_a"), batch.column("hashes_b"), strict=True):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            at = np.minimum(np.searchsorted(x, y), len(x) - 1)
            shared = int((x[at] == y).sum())
            keep.append(shared * 100 >= (len(x) + len(y) - shared) * SIMILARITY_PERCENT)
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _both(pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    """The pairs ``a, b`` with columns of both sides' ids."""
    for side in ("a", "b"):
        own = table.select(F.col("id").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns])
        pairs = pairs.join(own, side)
    return pairs


def _verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that are similar enough; ``sets`` holds ``id, n, bitmap, doc`` per set.

    Arrays are made again from the texts of those sets only that the bitmaps have let pass.
    """
    marked = _both(pairs, sets, "n", "bitmap").select("a", "b", "n_a", "n_b", "bitmap_a", "bitmap_b")
    passing = stage(marked.mapInArrow(_passing, "a bigint, b bigint"))
    ids = passing.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    wanted = stage(ids.join(sets.select("id", "doc"), "id").select(F.col("id").alias("want"), "doc"))
    # A doc_id that is there twice may give a set twice, which only repeats its pairs.
    arrays = stage(
        compressed(docs)
        .join(wanted, F.col("doc_id") == F.col("doc"))
        .select("want", "packed")
        .mapInArrow(_arrays, "id bigint, want bigint, hashes binary")
        .where("id = want")
        .select("id", "hashes")
    )
    whole = _both(passing, arrays, "hashes").select("a", "b", "hashes_a", "hashes_b")
    return stage(whole.mapInArrow(_linked, "a bigint, b bigint").distinct())


def _reachable(n_x: Column, n_y: Column, at_x: Column, at_y: Column) -> Column:
    """Whether sets of these sizes can be similar if a shingle at these places is the first they share.

    No pair is lost: similar sets meet in the tile of the first shingle they share, and nothing before it
    is in both. In tiles of later shared shingles the test is only stricter than it need be.
    """
    left = F.least(n_x - at_x, n_y - at_y)
    return left * (100 + SIMILARITY_PERCENT) >= (n_x + n_y) * SIMILARITY_PERCENT


def _centres(members: DataFrame) -> DataFrame:
    """``shingle, low, n_low, at_low``: of each tile the class that has the shingle earliest, ties by name.

    Place and name are one number, so that the choice is combined before the shuffle; a place beyond its
    23 bits counts as the last of them, which is earlier, so :func:`_reachable` stays on the safe side.
    """
    key = F.shiftleft(F.least("at", F.lit((1 << 23) - 1)), 40).bitwiseOR(F.shiftrightunsigned("id", 24))
    return (
        members.select("shingle", "id", "n", key.alias("key"))
        .groupBy("shingle")
        .agg(F.min_by("id", "key").alias("low"), F.min_by("n", "key").alias("n_low"), F.min("key").alias("key"))
        .select("shingle", "low", "n_low", F.shiftright("key", 40).alias("at_low"))
    )


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def near_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents as ``doc_id, n_shingles, id`` and the components as ``node, component`` of ids."""
    kind = dict(docs.dtypes)["doc_id"]
    own = docs.select("doc_id", "text")
    counted = stage(
        own.mapInArrow(
            _counted,
            f"doc_id {kind}, n_shingles bigint, id bigint, bitmap binary, shingle bigint, times bigint",
        )
    )
    sizes = counted.where("id IS NOT NULL").select("doc_id", "n_shingles", "id")
    total = sizes.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    least = max(COMMON_FROM, -(-total // COMMON_AT_MOST))
    common = (
        counted.where("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("times").alias("times"))
        .where(F.col("times") >= least)
    )
    late = np.array([r[0] for r in common.select("shingle").collect()], np.int64).view(np.uint64)
    late.sort()

    entries = _prefixes(own.where(F.col("doc_id").isNotNull()), late)
    shared = stage(
        entries.groupBy("shingle")
        .agg(F.min("id").alias("low"), F.max("id").alias("high"))
        .where("low != high")
        .select("shingle")
    )
    members = stage(
        entries.join(shared, "shingle")
        .distinct()
        .select("shingle", "id", F.shiftright("place", 32).alias("n"), F.col("place").bitwiseAND(0xFFFFFFFF).alias("at"))
    )
    wanted = stage(members.select("id").distinct())
    sets = stage(
        counted.where("doc_id IS NOT NULL")
        .join(wanted, "id")
        .groupBy("id")
        .agg(F.min("doc_id").alias("doc"), F.any_value("n_shingles").alias("n"), F.any_value("bitmap").alias("bitmap"))
    )
    starred = members.join(_centres(members), "shingle").where(
        (F.col("id") != F.col("low")) & _reachable(*[F.col(c) for c in ("n", "n_low", "at", "at_low")])
    )
    tried = stage(_ordered(starred.select(F.col("id").alias("x"), F.col("low").alias("y"))))
    links = _verified(tried, sets, own)
    found = stage(components(links))

    # Tiles that still hold several components: their members, one side against the other.
    rooted = stage(
        members.drop("low")
        .join(found, members["id"] == found["node"], "left")
        .select("shingle", "id", "n", "at", F.coalesce("component", "id").alias("root"))
    )
    split = stage(
        rooted.groupBy("shingle")
        .agg(F.min("root").alias("_low"), F.max("root").alias("_high"))
        .where("_low != _high")
        .select("shingle")
    )
    open_ = stage(rooted.join(split, "shingle"))
    x, y = (
        open_.select("shingle", F.col("id").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("n", "at", "root")]) for s in "xy"
    )
    reachable = _reachable(*[F.col(c) for c in ("n_x", "n_y", "at_x", "at_y")])
    rest = x.join(y, "shingle").where((F.col("root_x") < F.col("root_y")) & reachable)
    crossed = stage(_ordered(rest.select("x", "y")).join(tried, ["a", "b"], "left_anti"))
    more = _verified(crossed, sets, own)
    return sizes, stage(components(links.unionByName(more)))


def near_groups(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``."""
    with scratch(docs.sparkSession, ARROW_ROWS) as result:
        return result(_named(*near_classes(docs)))


def _named(sizes: DataFrame, found: DataFrame) -> DataFrame:
    """The smallest doc_id of each document's component."""
    sizes = sizes.withColumnRenamed("id", "_id")
    least = stage(
        sizes.where("n_shingles > 0").groupBy("_id").agg(F.min("doc_id").alias("least"))
        .join(found, F.col("_id") == F.col("node"), "left")
        .select("_id", "least", F.coalesce("component", "_id").alias("root"))
    )
    roots = stage(least.groupBy("root").agg(F.min("least").alias("component_id")))
    named = stage(least.join(roots, "root").select(F.col("_id").alias("_name"), "component_id"))
    real = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    return sizes.join(named, F.col("_id") == F.col("_name"), "left").select(
        "doc_id", "n_shingles", F.when(real, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def representatives(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest doc_id.

    Rows that repeat that doc_id stay together; of rows that repeat another one only the near copies go.
    """
    names, docs = docs.columns, plain_names(docs, "doc_id", "text")
    # A row is named by its doc_id and a hash of its text; a null doc_id stays null.
    name = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", F.xxhash64("text").alias("digest")))
    found = near_groups(docs.select(name.alias("doc_id"), "text"))
    gone = stage(
        found.where(F.col("doc_id.doc_id") != F.col("component_id.doc_id")).select(F.col("doc_id").alias("_gone")).distinct()
    )
    return docs.join(
        gone, (F.col("doc_id") == F.col("_gone.doc_id")) & (F.xxhash64("text") == F.col("_gone.digest")), "left_anti"
    ).toDF(*names)
