"""SimHash near-duplicates by segment popcounts: a grid of bit counts finds candidates, exact distances decide.

The 64 bits are cut into 32 segments of two bits. A fingerprint's counts of set bits by segment are an integer vector;
flipping one bit moves one count by one, so the Manhattan distance of two vectors never exceeds the Hamming distance.
Written in unary (0, 1, 2 as 00, 01, 11) the vector is again 64 bits and its Manhattan distance is one ``bit_count``.

Candidates: fingerprints within three bits of each other have one half (16 segments) within one bit, so their count
vectors on that half are equal or one step apart. Cells of the grid are the count vectors of a half. Every fingerprint
stands in its own cell of each half; those with an odd sum also probe the neighbouring cells (neighbours differ in the
parity of the sum, so one of the two probes). The join in a cell keeps pairs by the Manhattan bound and then exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricecast.llm.graph import components
from pricecast.llm.line_dedup import FILTER, _filter_of
from pricecast.llm.text import Chunk, chunks, mix, rows_of, run_hashes
from pricecast.session import materialise

LOW = 0x5555555555555555  # the lower bit of every segment
SHINGLES_AT_ONCE = 1 << 15


def _majority(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), SHINGLES_AT_ONCE):
        part = hashes[at : at + SHINGLES_AT_ONCE]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprint(text: bytes, width: int = 3) -> int:
    """SimHash over the XXH64 (seed 42) of word shingles of the text with A-Z in lower case; 0 without words."""
    words = text.lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        hashes = [digest(joined, 42)]
    else:
        ends = (np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1).tolist()
        starts = [0] + [e + 1 for e in ends[:-width]]
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts, ends[width - 1 :])]
    return _majority(np.array(hashes, dtype=np.uint64))


def with_fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """id and ``fp`` (the 64 bits as a bigint) of every row; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t or b"", width) for t in rows_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(fps, dtype=np.uint64).view(np.int64))], ["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("t")).mapInArrow(run, "id long, fp long")


def unary_counts(fp: Column) -> Column:
    """Set bits by segment of two, in unary."""
    high = F.shiftrightunsigned(fp, 1)
    either = fp.bitwiseOR(high).bitwiseAND(F.lit(LOW))
    both = fp.bitwiseAND(high).bitwiseAND(F.lit(LOW))
    return either.bitwiseOR(F.shiftleft(both, 1))


def grid_cells(nodes: DataFrame) -> DataFrame:
    """Rows (cell, id, sig, probe) of every fingerprint: its own cell of each half and the cells that it probes."""
    halves = nodes.select("id", "sig", unary_counts(F.col("sig")).alias("u")).select(
        "id",
        "sig",
        F.posexplode(F.array(F.col("u").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("u", 32))).alias("half", "u"),
    )
    # a lower bit may flip where the upper is 0, an upper where the lower is 1: counts stay between 0 and 2
    steps = F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i)),
        lambda m: F.when(m.bitwiseAND(F.lit(LOW)) != 0, F.col("u").bitwiseAND(m * 2) == 0).otherwise(
            F.col("u").bitwiseAND(F.shiftrightunsigned(m, 1)) != 0
        ),
    )
    moves = F.concat(F.array(F.lit(0).cast("long")), F.when(F.bit_count("u") % 2 == 1, steps).otherwise(F.array().cast("array<bigint>")))
    return halves.select("id", "sig", "half", "u", F.explode(moves).alias("m")).select(
        (F.shiftleft(F.col("half").cast("long"), 32) + F.col("u").bitwiseXOR(F.col("m"))).alias("cell"), "id", "sig", (F.col("m") != 0).alias("probe")
    )


def within(bits: int) -> Callable[[Column, Column], Column]:
    """Fingerprints at most so many bits apart; the Manhattan bound is tried first."""
    return lambda a, b: (F.bit_count(unary_counts(a).bitwiseXOR(unary_counts(b))) <= bits) & (F.bit_count(a.bitwiseXOR(b)) <= bits)


def link_in_cells(
    cells: DataFrame, close: Callable[[Column, Column], Column], verify: Callable[[DataFrame], DataFrame] = lambda p: p, linked: DataFrame | None = None
) -> DataFrame:
    """Root of every id that has a link, where links are close pairs that share a cell.

    cells: (cell, id, sig, probe), a row with probe meets only the cell's own rows. First every row meets its cell's
    least id; what that links becomes one component. Then only pairs of different components meet, so a dense group
    of near copies costs about one pair a member, and none of its links is lost.

    linked: (id, root) of links that are known; they count as links, and ids of one root do not meet.
    """
    if linked is None:
        cells = cells.withColumn("known", F.col("id"))
    else:
        cells = cells.join(linked.withColumnRenamed("root", "known").hint("merge"), "id", "left").withColumn("known", F.coalesce("known", "id"))
    own = cells.filter(~F.col("probe"))
    head = own.groupBy("cell").agg(F.min(F.struct("id", "sig", "known")).alias("head"))
    tagged = materialise(cells.join(head.hint("merge"), "cell"), "cells")
    star = tagged.filter(F.col("known") != F.col("head.known")).filter(close(F.col("sig"), F.col("head.sig")))
    star = verify(star.select(F.col("id").alias("a"), F.col("head.id").alias("b")).distinct()).select("a", "b")
    if linked is not None:
        star = star.union(linked.select("id", "root"))
    star = materialise(star, "links")
    first = components(star)
    named = materialise(
        tagged.select("cell", "id", "sig", "probe").join(first.hint("merge"), "id", "left").withColumn("root", F.coalesce("root", "id")), "cells"
    )
    x, y = named.alias("x"), named.filter(~F.col("probe")).alias("y").hint("merge")
    pairs = x.join(
        y,
        (F.col("x.cell") == F.col("y.cell"))
        & (F.col("x.root") != F.col("y.root"))
        & (F.col("x.probe") | (F.col("x.id") > F.col("y.id")))
        & close(F.col("x.sig"), F.col("y.sig")),
    )
    rest = verify(pairs.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct())
    return components(star.select("a", "b").union(rest.select("a", "b")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, bits: int = 3) -> DataFrame:
    """Columns doc_id, fingerprint (16 hex digits) and component_id (least doc_id reachable) of every row.

    Joins are merges by hint: a table that grows with the input looks small in its files, and smaller before an explode, and
    Spark would send it through the driver. Equal fingerprints are one node, so groups of copies cost one row each. A null text is empty; texts without words
    have fingerprint zero and link like any other. Rows may repeat an id or have none: a null id is never the name of
    a component unless all of its ids are null. An empty table gives an empty result.
    """
    if bits > 3:
        raise ValueError("two halves within one step cover at most three bits")
    fps = materialise(with_fingerprint(docs, id_col, text_col, width), "fingerprints")
    nodes = materialise(fps.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    roots = link_in_cells(grid_cells(nodes.select(F.col("fp").alias("id"), F.col("fp").alias("sig"))), within(bits))
    named = nodes.join(roots.select(F.col("id").alias("fp"), "root").hint("merge"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = materialise(named, "nodes")
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    table = materialise(named.join(names.hint("merge"), "root").select("fp", "component_id"), "nodes")
    return fps.join(table.hint("merge"), "fp").select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


# Near copies by the likeness of shingle sets. Fingerprints of the sets meet in the grid of segment popcounts and the
# shingles decide. Likeness down to 0.8 reaches beyond the bits that a grid covers, so sets of different groups then meet
# by prefixes, an exact set-similarity join, and no pair is lost.

RARITY = 1 << 20  # counters of shingles


class Shingles:
    """Distinct word shingles of every text of a chunk in the common order, the rarer first; none for a text without words."""

    def __init__(self, c: Chunk, width: int, counts: np.ndarray | None = None):
        _, _, hashes, bounds = c.words()
        words = np.diff(bounds)
        n = np.where(words > 0, np.maximum(1, words - width + 1), 0)
        text = np.repeat(np.arange(len(n)), n)
        starts = bounds[:-1][text] + np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
        grams = run_hashes(hashes, starts, np.minimum(starts + width, bounds[1:][text]), "word")
        order = np.lexsort((grams, text) if counts is None else (grams, counts[rarity_cells(grams)], text))
        text, grams = text[order], grams[order]
        fresh = np.ones(len(text), dtype=bool)
        fresh[1:] = (text[1:] != text[:-1]) | (grams[1:] != grams[:-1])
        self.grams = grams[fresh]
        self.size = np.bincount(text[fresh], minlength=len(n))
        self.offset = np.cumsum(self.size) - self.size
        total = np.zeros(len(self.grams) + 1, dtype=np.uint64)
        np.cumsum(mix(self.grams ^ np.uint64(0xA5A5A5A5A5A5A5A5)), out=total[1:])
        self.key = mix(total[self.offset + self.size] - total[self.offset] + self.size.astype(np.uint64)).view(np.int64)


def rarity_cells(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(44)).astype(np.int64)


def _shingled(column: pa.Array, width: int, counts: np.ndarray | None = None) -> Iterator[tuple[Chunk, Shingles]]:
    for c in chunks(t and t.lower() for t in rows_of(column)):
        yield c, Shingles(c, width, counts)


def _keys(width: int):
    """Key and SimHash of every row's set; equal sets have one key, a set without shingles has no SimHash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, fps = [np.zeros(0, np.int64)], []
            for _, x in _shingled(batch.column(1), width):
                keys.append(x.key)
                fps += [_majority(x.grams[o : o + n]) if n else None for o, n in zip(x.offset.tolist(), x.size.tolist())]
            signed = pa.array(fps, pa.uint64()).view(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(keys)), signed], ["id", "key", "fp"])

    return run


def _count_shingles(width: int):
    """Counters of one partition; those of one set only say nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(RARITY, dtype=np.int64)
        for batch in batches:
            for _, x in _shingled(batch.column(0), width):
                total += np.bincount(rarity_cells(x.grams), minlength=RARITY)
        at = np.flatnonzero(total > 1)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["cell", "n"])

    return run


def _shingle_prefixes(width: int, num: int, den: int, counts: Broadcast):
    """Prefix of every different set of a chunk: shingle, set, size and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in _shingled(batch.column(0), width, counts.value):
                _, at = np.unique(x.key, return_index=True)
                at = at[x.size[at] > 0]
                size = x.size[at]
                take = size - (num * size + den - 1) // den + 1
                place = np.arange(take.sum()) - np.repeat(np.cumsum(take) - take, take)
                gram = x.grams[np.repeat(x.offset[at], take) + place].view(np.int64)
                columns = (gram, np.repeat(x.key[at], take), np.repeat(size, take) << 32 | place)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["cell", "id", "sig"])

    return run


def _sets_of(width: int, asked: Broadcast):
    """Shingles of the sets whose key passes the filter; a few others come along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in _shingled(batch.column(0), width):
                _, first = np.unique(x.key, return_index=True)
                at = x.key[first] & (FILTER - 1)
                hit = first[(asked.value[at >> 5] >> (at & 31).astype(np.uint32) & 1).astype(bool)]
                sets = [x.grams[o : o + n].view(np.int64) for o, n in zip(x.offset[hit], x.size[hit])]
                yield pa.RecordBatch.from_arrays([pa.array(x.key[hit]), pa.array(sets, pa.list_(pa.int64()))], ["key", "grams"])

    return run


def similar_groups(keys: DataFrame, width: int = 5, similarity: float = 0.8, bits: int = 3) -> DataFrame:
    """Group of every row of (id, text): texts whose sets of word shingles have a Jaccard likeness of ``similarity`` or more.

    Sets whose SimHash differs in ``bits`` or fewer meet first, in the cells of :func:`grid_cells`. Sets of different
    groups then meet by their prefixes: sets of that likeness share a shingle among the first few of each in any order
    common to all sets; the rarer shingles come first, by counters of fixed size, and sizes and places rule most meetings
    out. In both, the shingles themselves (64-bit hashes) decide, so no pair is missed and none is linked below
    ``similarity``. Returns id, group_id (least id of the group); equal sets are one node, as are texts without words.
    """
    if bits > 3:
        raise ValueError("two halves within one step cover at most three bits")
    share = Fraction(similarity).limit_denominator(1000)
    num, den = share.numerator, share.denominator
    spark = keys.sparkSession
    texts = keys.select(F.col("text").cast("binary").alias("t"))
    known = materialise(keys.select("id", F.col("text").cast("binary").alias("t")).mapInArrow(_keys(width), "id long, key long, fp long"), "sets")
    rows = texts.mapInArrow(_count_shingles(width), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # RARITY rows at most
    counts = np.zeros(RARITY, dtype=np.int64)
    counts[rows["cell"].to_numpy()] = rows["n"].to_numpy()
    prefixes = texts.mapInArrow(_shingle_prefixes(width, num, den, spark.sparkContext.broadcast(counts)), "cell long, id long, sig long")
    dealt = prefixes.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "cell").distinct()
    met = dealt.withColumn("n", F.count("*").over(Window.partitionBy("cell"))).filter("n > 1")
    cells = materialise(met.select("cell", "id", "sig", F.lit(False).alias("probe")), "cells")

    def near(a: Column, b: Column) -> Column:
        size_a, size_b = F.shiftright(a, 32), F.shiftright(b, 32)
        after = F.least(size_a - a.bitwiseAND(F.lit(0xFFFFFFFF)), size_b - b.bitwiseAND(F.lit(0xFFFFFFFF)))
        return (F.least(size_a, size_b) * den >= F.greatest(size_a, size_b) * num) & (after * (num + den) >= (size_a + size_b) * num)

    def verify(pairs: DataFrame) -> DataFrame:
        pairs = materialise(pairs, "meetings")
        if pairs.isEmpty():
            return pairs
        asked = materialise(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "asked")
        passing = spark.sparkContext.broadcast(_filter_of(asked))
        sets = texts.mapInArrow(_sets_of(width, passing), "key long, grams array<long>").join(asked.hint("merge"), "key", "left_semi")
        sets = materialise(sets.groupBy("key").agg(F.first("grams").alias("grams")), "shingles")
        a, b = (sets.select(F.col("key").alias(k), F.col("grams").alias(f"of_{k}")) for k in "ab")
        shared = F.size(F.array_intersect("of_a", "of_b"))
        return pairs.join(a.hint("merge"), "a").join(b.hint("merge"), "b").filter(shared * (num + den) >= (F.size("of_a") + F.size("of_b")) * num).select("a", "b")

    nodes = known.filter("fp IS NOT NULL").groupBy(F.col("key").alias("id")).agg(F.first("fp").alias("sig"))
    linked = link_in_cells(grid_cells(nodes), within(bits), verify)
    roots = materialise(link_in_cells(cells, near, verify, linked), "roots").withColumnRenamed("id", "key")
    nodes = known.groupBy("key").agg(F.min("id").alias("least")).join(roots.hint("merge"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    nodes = materialise(nodes, "nodes")
    table = materialise(nodes.join(nodes.groupBy("root").agg(F.min("least").alias("group_id")).hint("merge"), "root").select("key", "group_id"), "nodes")
    return known.join(table.hint("merge"), "key").select("id", "group_id")


def near_copies(keys: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """id, group_id of every row of (id, text): groups by links of :func:`near_duplicates` and of :func:`similar_groups`.

    Both name a group by its least id, so a row joins the two names and only differing names are edges.
    """
    close = near_duplicates(keys, "id", "text").select(F.col("doc_id").alias("id"), "component_id").distinct()
    alike = materialise(similar_groups(keys, width, similarity), "alike")
    both = materialise(alike.join(close.hint("merge"), "id"), "alike")
    roots = components(both.select(F.col("component_id").alias("a"), F.col("group_id").alias("b")))
    named = both.join(roots.withColumnRenamed("id", "group_id").hint("merge"), "group_id", "left")
    return named.select("id", F.coalesce("root", "group_id").alias("group_id"))


def keep_one(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """docs with one row of every group of near copies: the one of least doc_id (none first), then of least text hash.

    Texts are near copies by :func:`near_duplicates`, the SimHash of all their three-word shingles, and by
    :func:`similar_groups`, the likeness of their sets of ``width``-word shingles; a group is what links of either kind
    reach. Of rows equal in id and text one stays too.
    """
    rows = docs.select(F.struct(*docs.columns).alias("row")).withColumn("tag", F.xxhash64("row.text"))
    keys = rows.select(F.col("row.doc_id").alias("doc_id"), "tag", F.xxhash64("row.doc_id", "tag").alias("id"), F.col("row.text").alias("text"))
    groups = near_copies(keys.select("id", "text"), width, similarity).groupBy("id").agg(F.min("group_id").alias("group_id"), F.count("*").alias("times"))
    named = keys.select("doc_id", "tag", "id").distinct().join(groups.hint("merge"), "id")
    best = named.groupBy("group_id").agg(F.min(F.struct("doc_id", "tag", "times")).alias("best"))
    best = materialise(best.select(F.col("best.doc_id").alias("doc_id"), F.col("best.tag").alias("own"), F.col("best.times").alias("times")), "best")
    kept = rows.join(best.hint("merge"), F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("tag") == F.col("own")))
    once = kept.filter("times = 1").select("row", "tag")
    again = kept.filter("times > 1").withColumn("key", F.xxhash64("row.doc_id", "tag")).dropDuplicates(["key"]).select("row", "tag")
    return once.union(again).select("row.*")
