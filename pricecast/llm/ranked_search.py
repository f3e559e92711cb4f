"""Ranked lexical search with integer weights, skipping by bounds on pairs of terms (MaxScore).

``Searcher`` reads the texts once: every task keeps, of each document, its length and the asked terms in it, and the
counts N, L and the document frequencies are added up. In a second pass every task inverts a shard of documents after
the other. The terms of a query stand in a chain by rising maximum, and its pairs are the neighbours in the chain. Before
any query runs, the list of the shard's documents that hold both is made for every asked pair, and the largest and the
20th largest joint impact of the list are stored.

At query time the bound of the first i terms is the least sum over ways to take them singly, by their own maxima, or as
neighbouring pairs, by the pair's maximum (of both, or of either alone). It is never above the sum of the single maxima.
Terms whose bound stays below the score of the 20th document found so far open no candidates, and a candidate is dropped
as soon as its score and the bound of what is left stay below. A pair's 20th joint impact is such a score from the start.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from pricecast.llm.text import chunks, rows_of, run_hashes
from pricecast.session import materialise

TOP = 20
SHARD_DOCS = 1 << 13  # documents inverted together
SHARD_POSTINGS = 1 << 21  # and their postings, at most about
BLOCK_ITEMS = 1 << 12  # queries sent to the tasks together
BLOCK_BYTES = 1 << 22  # and their text; a longer query is a block of its own
SCALE, K1, FIXED_M, LENGTH_M = 1_000_000_000, 12, 75, 25  # of the score; fixed by its definition

#: Bytes of terms: digits, ASCII letters and all bytes of characters from U+0080 on.
TERM = np.zeros(256, dtype=bool)
TERM[np.r_[0x30:0x3A, 0x41:0x5B, 0x61:0x7B, 0x80:0x100]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

POSTINGS = "doc_id long, n long, terms array<int>, times array<int>"
FOUND = "item long, doc_id long, score long"


def term_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and byte past the end of every term."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = TERM[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


@dataclass
class Asked:
    """A block of queries: the hashes of its terms in order and, by query, (term number, repeats)."""

    hashes: np.ndarray
    queries: list[tuple[int, np.ndarray, np.ndarray]]


def ask(items: list[Row]) -> Asked:
    """The terms of queries (n, text); null has none."""
    found = []
    for item in items:
        data = LOWER[np.frombuffer((item["text"] or "").encode(), dtype=np.uint8)]
        starts, ends = term_spans(data)
        found.append(np.unique(run_hashes(data, starts, ends, "byte"), return_counts=True))
    hashes = np.unique(np.concatenate([h for h, _ in found] or [np.zeros(0, np.uint64)]))
    return Asked(hashes, [(int(item["n"]), np.searchsorted(hashes, h), c.astype(np.int64)) for item, (h, c) in zip(items, found)])


def _count_terms(asked: Broadcast):
    """(doc_id, text) to the length in terms and the asked terms of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = asked.value.hashes
        for batch in batches:
            ids = batch.column("doc_id")
            for chunk in chunks(rows_of(batch.column("text"))):
                n_docs = len(chunk.blobs)
                data = LOWER[chunk.data]
                starts, ends = term_spans(data)
                bounds = np.append(np.searchsorted(starts, chunk.text_starts), len(starts))
                n = np.diff(bounds)
                h = run_hashes(data, starts, ends, "byte")
                at = np.minimum(np.searchsorted(hashes, h), max(0, len(hashes) - 1))
                known = hashes[at] == h if len(hashes) else np.zeros(len(h), dtype=bool)
                doc = np.repeat(np.arange(n_docs), n)[known]
                both, times = np.unique(doc * max(1, len(hashes)) + at[known], return_counts=True)
                doc, term = np.divmod(both, max(1, len(hashes)))
                offsets = pa.array(np.searchsorted(doc, np.arange(n_docs + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (term, times)]
                yield pa.RecordBatch.from_arrays([ids.slice(chunk.first, n_docs), pa.array(n), *lists], names=["doc_id", "n", "terms", "times"])

    return run


class Shard:
    """Inverted lists of some documents, their largest impacts, and the joint impacts of pairs of terms."""

    def __init__(self, ids: np.ndarray, missing: np.ndarray, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, times: np.ndarray, weights: np.ndarray, total: tuple[int, int]):
        n_docs, length = total
        self.ids, self.missing = ids, missing
        doc = np.repeat(np.arange(len(ids)), sizes)
        m = FIXED_M + (LENGTH_M * n * n_docs) // length
        impact = weights[terms] * ((SCALE * times) // (1000 * times + K1 * m[doc]))
        order = np.argsort(terms, kind="stable")
        self.doc, self.impact = doc[order], impact[order]
        self.starts = np.searchsorted(terms[order], np.arange(len(weights) + 1))
        self.most = np.zeros(len(weights), dtype=np.int64)
        held = np.flatnonzero(np.diff(self.starts))
        if len(held):
            self.most[held] = np.maximum.reduceat(self.impact, self.starts[held])
        self.pairs: dict[tuple[int, int, int, int], tuple[int, int]] = {}

    def postings(self, t: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.starts[t], self.starts[t + 1]
        return self.doc[a:b], self.impact[a:b]

    def index_pairs(self, chains: list[tuple[np.ndarray, np.ndarray]], top: int = TOP) -> None:
        """Largest and top-th largest joint impact in the list of documents that hold both (0 where it is shorter).

        Done once for every pair that stands side by side in a chain, before any query runs.
        """
        wanted: dict[int, set[tuple[int, int, int]]] = {}
        for terms, repeats in chains:
            for a, b, ra, rb in zip(terms.tolist(), terms[1:].tolist(), repeats.tolist(), repeats[1:].tolist()):
                wanted.setdefault(a, set()).add((b, ra, rb))
        dense = np.full(len(self.ids), -1, dtype=np.int64)
        for a, others in wanted.items():
            docs, impact = self.postings(a)
            dense[docs] = impact
            for b, ra, rb in others:
                docs_b, impact_b = self.postings(b)
                mine = dense[docs_b]
                both = mine >= 0
                joint = ra * mine[both] + rb * impact_b[both]
                least = int(np.partition(joint, len(joint) - top)[len(joint) - top]) if len(joint) >= top else 0
                self.pairs[a, b, ra, rb] = int(joint.max(initial=0)), least
            dense[docs] = -1

    def chain(self, terms: np.ndarray, repeats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The query's terms that occur here, by rising maximum."""
        here = self.most[terms] > 0
        terms, repeats = terms[here], repeats[here]
        order = np.lexsort((terms, self.most[terms] * repeats))
        return terms[order], repeats[order]

    def _neighbours(self, terms: np.ndarray, repeats: np.ndarray) -> list[tuple[int, int]]:
        t, r = terms.tolist(), repeats.tolist()
        return [self.pairs[key] for key in zip(t, t[1:], r, r[1:])]

    def bounds(self, terms: np.ndarray, repeats: np.ndarray) -> np.ndarray:
        """Entry i: no document scores more on the first i terms of the chain."""
        single = (self.most[terms] * repeats).tolist()
        joint = self._neighbours(terms, repeats)
        out = [0]
        for i, s in enumerate(single):
            best = out[i] + s
            if i:
                best = min(best, out[i - 1] + max(joint[i - 1][0], single[i - 1], s))
            out.append(best)
        return np.array(out)

    def search(self, terms: np.ndarray, repeats: np.ndarray, floor: int, top: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) among which are the ``top`` best of those that score at least ``floor`` (1 or more)."""
        bound = self.bounds(terms, repeats)
        floor = max([floor, *(least for _, least in self._neighbours(terms, repeats))])  # so many documents reach it by a pair alone
        score = np.zeros(len(self.ids), dtype=np.int64)
        live = np.zeros(0, dtype=np.int64)
        opening = True
        for i in range(len(terms) - 1, -1, -1):
            if opening and bound[i + 1] < floor:  # what holds only this term and lesser ones cannot reach the floor
                opening = False
                live = np.flatnonzero(score)
            docs, impact = self.postings(int(terms[i]))
            score[docs] += impact * repeats[i]
            at_hand = score[score > 0] if opening else score[live]
            if len(at_hand) >= top:  # sums so far are never above the final scores
                floor = max(floor, int(np.partition(at_hand, len(at_hand) - top)[len(at_hand) - top]))
            if not opening:
                live = live[score[live] + bound[i] >= floor]
                if not len(live):
                    break
        live = np.flatnonzero(score) if opening else live
        live = live[score[live] >= floor]
        return live, score[live]


def _best(ids: np.ndarray, missing: np.ndarray, scores: np.ndarray, top: int) -> np.ndarray:
    """Places of the best, equal scores by id, a missing id first."""
    return np.lexsort((ids, ~missing, -scores))[:top]


def _search(asked: Broadcast, counted: Broadcast, top: int):
    """Postings of a partition to the best documents of every query in it, one shard after the other."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
        weights, total = counted.value

        def build(held: list[pa.RecordBatch]) -> Shard:
            t = pa.Table.from_batches(held).combine_chunks()
            ids = t.column("doc_id").combine_chunks()
            lists = [t.column(c).combine_chunks() for c in ("terms", "times")]
            flat = [x.flatten().to_numpy().astype(np.int64) for x in lists]
            sizes = lists[0].value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            missing = ids.is_null().to_numpy(zero_copy_only=False)
            return Shard(ids.fill_null(0).to_numpy(), missing, t.column("n").to_numpy(), sizes, *flat, weights, total)

        held, docs, postings = [], 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                held.append(part)
                docs += part.num_rows
                postings += len(part.column("terms").flatten())
                if docs >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                    yield build(held)
                    held, docs, postings = [], 0, 0
        if held:
            yield build(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = asked.value.queries
        found = {q: (np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)) for q, _, _ in queries}
        for shard in shards(batches):
            chains = [shard.chain(t, r) for _, t, r in queries]
            shard.index_pairs(chains, top)
            for (q, _, _), (terms, repeats) in zip(queries, chains):
                ids, missing, scores = found[q]
                docs, own = shard.search(terms, repeats, int(scores[-1]) if len(scores) == top else 1, top)
                ids, missing, scores = (np.concatenate(x) for x in ((ids, shard.ids[docs]), (missing, shard.missing[docs]), (scores, own)))
                keep = _best(ids, missing, scores, top)
                found[q] = ids[keep], missing[keep], scores[keep]
        for q, (ids, missing, scores) in found.items():
            if len(ids):
                columns = [pa.array(np.full(len(ids), q)), pa.array(ids, mask=missing), pa.array(scores)]
                yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

    return run


def _blocks(items: DataFrame) -> Iterator[list[Row]]:
    """Queries in blocks of bounded size, one block on the driver at a time."""
    held, size = [], 0
    for row in items.toLocalIterator():
        n = len(row["text"] or "")
        if held and (len(held) >= BLOCK_ITEMS or size + n > BLOCK_BYTES):
            yield held
            held, size = [], 0
        held.append(row)
        size += n
    if held:
        yield held


class Searcher:
    """Search over all documents (doc_id, text). Every document row counts as one document, with a null id too."""

    def __init__(self, documents: DataFrame, top: int = TOP):
        self.documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
        self.spark: SparkSession = documents.sparkSession
        self.top = top

    def _block(self, items: list[Row]) -> DataFrame:
        """(item, doc_id, score): the best documents of every partition for one block of queries."""
        sc = self.spark.sparkContext
        asked = sc.broadcast(ask(items))
        postings = materialise(self.documents.mapInArrow(_count_terms(asked), POSTINGS).filter("n > 0"), "postings")
        n_docs, length = postings.agg(F.count("*"), F.sum("n")).first()
        weights = np.zeros(len(asked.value.hashes), dtype=np.int64)
        # One row for every asked term: bounded by the block's text.
        for row in postings.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():
            weights[row["t"]] = np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * row["count"] + 1)))
        counted = sc.broadcast((weights, (int(n_docs), int(length or 1))))
        return postings.mapInArrow(_search(asked, counted, self.top), FOUND)

    def search(self, items: DataFrame) -> DataFrame:
        """(item_id, rank, doc_id, score): the best documents for every row of items (item_id, text).

        Scores above 0 only, highest first, equal scores by ascending doc_id (null first). Null texts, and texts whose
        terms no document holds, have no rows; empty tables give none. Repeated item rows are queries of their own,
        with their own ranks, and repeated documents are ranked each. Further columns are not read. The queries go to
        the tasks in blocks of bounded size; a text of any length is read whole.
        """
        numbered = materialise(items.select(F.monotonically_increasing_id().alias("n"), "item_id", "text"), "items")
        parts = [materialise(self._block(block), "found") for block in _blocks(numbered.select("n", "text"))]
        if not parts:
            return numbered.select("item_id", F.lit(1).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).filter("1 = 0")
        found = parts[0]
        for p in parts[1:]:
            found = found.unionByName(p)
        # Two steps, so that no task ranks the results of all partitions for a query.
        order = [F.desc("score"), F.asc_nulls_first("doc_id")]
        dealt = found.withColumn("slice", F.pmod(F.xxhash64("doc_id"), F.lit(64)))
        some = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("item", "slice").orderBy(*order))).filter(F.col("rank") <= self.top)
        best = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= self.top)
        return best.join(numbered.select(F.col("n").alias("item"), "item_id"), "item").select("item_id", "rank", "doc_id", "score")

