"""Fuzzy line deduplication by MinHash.

A line is what stands between two line feeds, compared trimmed and lower-cased. A line's signature is
drawn from the set that is verified, all its 5-character shingles (:mod:`opinara.llm.line_sets`): a band
joins the least hashes of one stretch of the set under six independent hashes. Lines that share one of 20
bands are candidates, decided by the exact Jaccard similarity of their sets; links make components
(distributed union-find), and the first line of a component (smallest doc_id, then place) stays.

Candidates are looked at in two rounds. Every line of a bucket is compared with the bucket's first one;
a bucket that repeats within a batch of lines is combined there, so that it sends one row per batch, and
its lines meet their own first. Then buckets that still hold several components are cut into blocks, and
blocks are compared with each other inside tasks, but for those of one component; a task gives a forest
of the links it finds. No candidate is left out, and no pairs are made beyond the first round's one a line.

Line texts are read twice, to be signed and where candidates need them; what is staged in between are
64-bit names (equal lines are grouped by 128 bits).

Defined results: null text is one empty line; blank lines are never compared and stay; rows that
repeat doc_id and text are one document and share its result; documents may lose all their lines
and stay with empty text; an empty table gives no rows; other columns pass through
:func:`deduplicated` unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.llm import line_sets
from opinara.llm.shared import components, plain_names, scratch, stage

SIMILARITY_PERCENT = 80
BLOCK = 256  # lines of a bucket that are compared at a time
ARROW_ROWS = 2000
BLOCK_ROWS = 32


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _norm(line: str) -> Column:
    return F.trim(F.lower(line))


def named_lines(docs: DataFrame) -> DataFrame:
    """``norm, name`` of every line that is not blank; 64 bits name a line."""
    rows = docs.select(F.explode(_lines(F.col("text"))).alias("raw")).select(_norm("raw").alias("norm"))
    return rows.where("norm != ''").withColumn("name", F.xxhash64("norm"))


def _band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``band, part, name``. Where several lines of a batch share a band they make a part of their own,
    and only their first one meets the lines of other batches in part 0."""
    for number, batch in enumerate(batches):
        names, first = np.unique(batch.column("name").to_numpy(), return_index=True)
        if not len(names):
            continue
        texts = batch.column("norm").take(pa.array(first)).to_pylist()
        keys = np.concatenate([line_sets.bands(texts[lo:hi]) for lo, hi in line_sets.chunks(texts)]).ravel()
        keys = (keys >> np.uint64(16)).view(np.int64)  # 48 bits: short rows, and a collision only costs a look
        owner = np.repeat(names, line_sets.BANDS)
        order = np.lexsort((owner, keys))
        keys, owner = keys[order], owner[order]
        head = np.append(True, keys[1:] != keys[:-1])
        many = np.append(~head[1:], False) | ~head
        own = 1 + (hash((int(names[0]), int(names[-1]), number)) & 0x3FFFFFFF)
        band = np.concatenate([keys[head], keys[many]])
        part = np.concatenate([np.zeros(int(head.sum()), np.int32), np.full(int(many.sum()), own, np.int32)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(band), pa.array(part), pa.array(np.concatenate([owner[head], owner[many]]))],
            names=["band", "part", "name"],
        )


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, right = (batch.column(c).to_pylist() for c in ("norm_a", "norm_b"))
        flags = [np.zeros(0, bool)]
        for lo, hi in line_sets.chunks([x + y for x, y in zip(left, right, strict=True)]):
            flags.append(line_sets.pairs_similar(left[lo:hi], right[lo:hi], SIMILARITY_PERCENT))
        yield batch.select(["a", "b"]).filter(pa.array(np.concatenate(flags)))


def _packed_block(table: pa.Table) -> pa.Table:
    """The lines of a block as one row; lines of a bucket resemble each other and compress well."""
    buffer = pa.BufferOutputStream()
    inner = table.select(["name", "root", "norm"])
    with pa.ipc.new_stream(buffer, inner.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(inner)
    packed = pa.array([buffer.getvalue().to_pybytes()], pa.binary())
    return pa.table({"band": table.column("band")[:1], "block": table.column("block")[:1], "lines": packed})


def _compare_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within each pair of blocks; the two sides of a block with itself are the same."""
    for batch in batches:
        for low, high, same in zip(*[batch.column(c).to_pylist() for c in ("lines_x", "lines_y", "same")], strict=True):
            sides = [pa.ipc.open_stream(x).read_all() for x in ((low,) if same else (low, high))]
            run = pa.concat_tables(sides).combine_chunks()
            side = np.repeat(np.arange(len(sides)), [s.num_rows for s in sides])
            names = run.column("name").to_numpy()
            found = line_sets.links_between(run.column("norm").to_pylist(), run.column("root").to_numpy(), side, SIMILARITY_PERCENT)
            at = np.array(found, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(names[at[:, 0]]), pa.array(names[at[:, 1]])], names=["a", "b"])


def _open_blocks(candidates: DataFrame, found: DataFrame, texts: DataFrame) -> DataFrame:
    """``lines_x, lines_y, same``: the pairs of blocks of the buckets that hold several components, without
    pairs of blocks of one and the same component."""
    both = F.explode(F.array("a", "b")).alias("name")
    members = candidates.select("band", both).distinct()
    rooted = stage(
        members.join(found, members["name"] == found["node"], "left").select(
            "band", "name", F.coalesce("component", "name").alias("root")
        )
    )
    kinds = rooted.groupBy("band").agg(F.min("root").alias("_low"), F.max("root").alias("_high"))
    several = kinds.where("_low != _high").select("band")
    order = Window.partitionBy("band").orderBy("root", "name")
    blocked = stage(
        rooted.join(several, "band").withColumn("block", ((F.row_number().over(order) - 1) / BLOCK).cast("int"))
    )
    packed = stage(
        blocked.join(texts, "name")
        .select("band", "block", "name", "root", "norm")
        .groupBy("band", "block")
        .applyInArrow(_packed_block, "band bigint, block int, lines binary")
    )
    blocks = stage(
        blocked.groupBy("band", "block").agg(F.min("root").alias("least"), F.max("root").alias("most"))
    )
    x, y = (blocks.select("band", *[F.col(c).alias(f"{c}_{s}") for c in ("block", "least", "most")]) for s in "xy")
    one = (F.col("least_x") == F.col("most_y")) & (F.col("most_x") == F.col("least_y"))
    pairs = x.join(y, "band").where((F.col("block_x") <= F.col("block_y")) & ~one)
    sides = [packed.select("band", F.col("block").alias(f"block_{s}"), F.col("lines").alias(f"lines_{s}")) for s in "xy"]
    whole = pairs.select("band", "block_x", "block_y").join(sides[0], ["band", "block_x"]).join(sides[1], ["band", "block_y"])
    return whole.select("lines_x", "lines_y", (F.col("block_x") == F.col("block_y")).alias("same"))


def candidates(named: DataFrame) -> DataFrame:
    """``band, a, b``: the lines of each bucket with more than one, with its first line as ``a``."""
    rows = named.mapInArrow(_band_rows, "band bigint, part int, name bigint")
    bucket = Window.partitionBy("band", "part")
    return (
        rows.withColumn("low", F.min("name").over(bucket))
        .where("name != low")
        .select("band", F.col("low").alias("a"), F.col("name").alias("b"))
    )


def linked(found: DataFrame, named: DataFrame) -> DataFrame:
    """``node, component`` of the lines that are similar to others of their buckets, see :func:`candidates`."""
    wanted = stage(found.select(F.explode(F.array("a", "b")).alias("wanted")).distinct())
    texts = stage(
        named.join(wanted, F.col("name") == F.col("wanted")).groupBy("name").agg(F.any_value("norm").alias("norm"))
    )
    left, right = (texts.select(F.col("name").alias(s), F.col("norm").alias(f"norm_{s}")) for s in "ab")
    pairs = found.select("a", "b").distinct().join(left, "a").join(right, "b")
    links = stage(pairs.select("a", "b", "norm_a", "norm_b").mapInArrow(_verify, "a bigint, b bigint"))
    blocks = _open_blocks(found, stage(components(links)), texts)
    with scratch(named.sparkSession, BLOCK_ROWS) as result:  # rows of two blocks each
        more = result(blocks.mapInArrow(_compare_blocks, "a bigint, b bigint"))
    return components(links.unionByName(more))


def near_lines(docs: DataFrame) -> DataFrame:
    """``node, component`` of the names of lines that resemble others; a component is its least name."""
    named = named_lines(docs)
    return linked(stage(candidates(named)), named)


def line_groups(docs: DataFrame) -> DataFrame:
    """One row per line: ``doc_id, digest, at, keep, group_lines`` (keep: struct of the kept line)."""
    with scratch(docs.sparkSession, ARROW_ROWS) as result:
        return result(_line_groups(docs))


def _line_groups(docs: DataFrame) -> DataFrame:
    found = stage(near_lines(docs))
    name, more = F.xxhash64("norm"), F.xxhash64(F.lit(1), "norm")
    real = F.col("norm") != ""
    lines = stage(
        docs.select("doc_id", F.xxhash64("text").alias("digest"), F.posexplode(_lines(F.col("text"))).alias("at", "raw"))
        .withColumn("norm", _norm("raw"))
        .select("doc_id", "digest", "at", F.when(real, name).alias("name"), F.when(real, more).alias("more"))
    )
    place = F.struct("doc_id", "digest", "at")
    distinct = lines.where("name IS NOT NULL").groupBy("name", "more").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    rooted = stage(
        distinct.join(found, F.col("name") == F.col("node"), "left").select("name", "more", "first", "n", "component")
    )
    near = rooted.where("component IS NOT NULL")
    groups = stage(near.groupBy("component").agg(F.min("first").alias("keep"), F.sum("n").alias("group_lines")))
    # Lines that stand alone keep themselves and need no look-up.
    alone = rooted.where("component IS NULL AND n > 1").select("name", "more", F.col("first").alias("keep"), F.col("n").alias("group_lines"))
    named = near.select("name", "more", "component").join(groups, "component").drop("component").unionByName(alone)
    named = named.select(F.col("name").alias("_name"), F.col("more").alias("_more"), "keep", "group_lines")
    own = F.struct("doc_id", "digest", "at")
    return lines.join(named, F.expr("name = _name AND more = _more"), "left").select(
        "doc_id",
        "digest",
        "at",
        F.coalesce("keep", own).alias("keep"),
        F.coalesce("group_lines", F.lit(1)).alias("group_lines"),
    )


def line_dedup(docs: DataFrame) -> DataFrame:
    """``doc_id, line_no, keep_doc_id, keep_line_no, group_lines, kept``, one row per line."""
    kept = F.struct("doc_id", "digest", "at").eqNullSafe(F.col("keep"))
    return line_groups(docs).select(
        "doc_id",
        F.col("at").alias("line_no"),
        F.col("keep.doc_id").alias("keep_doc_id"),
        F.col("keep.at").alias("keep_line_no"),
        "group_lines",
        kept.alias("kept"),
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with the dropped lines taken out of ``text``; columns and rows stay."""
    names, docs = docs.columns, plain_names(docs, "doc_id", "text")
    own = F.struct("doc_id", "digest", "at")
    gone = (
        line_groups(docs)
        .where(~own.eqNullSafe(F.col("keep")))
        .groupBy(F.col("doc_id").alias("_doc"), F.col("digest").alias("_digest"))
        .agg(F.collect_set("at").alias("_gone"))
    )
    rows = docs.join(
        stage(gone), F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.xxhash64("text") == F.col("_digest")), "left"
    )
    numbers = F.sequence(F.lit(0), F.size(_lines(F.col("text"))) - 1)

    def joined(lines: Column) -> Column:  # one look at the split text for all its lines
        left = F.array_sort(F.array_except(numbers, F.col("_gone")))
        return F.array_join(F.transform(left, lambda i: lines[i]), "\n")

    text = F.transform(F.array(_lines(F.col("text"))), joined)[0]
    return rows.withColumn("text", F.when(F.col("_gone").isNull(), F.col("text")).otherwise(text)).select(
        *docs.columns
    ).toDF(*names)
