"""Toxicity by the votes of the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are words and beginnings of words.  The vocabulary is chosen from labelled rows: terms that are in toxic texts more
often than chance explains.  Everything that is fitted comes from at most ``EXAMPLES`` labelled rows, those whose hash
is smallest, so what is broadcast has a fixed bound; document frequencies count all documents.

The index keeps examples in blocks and, for each term and block, the largest weight.  The sum of these bounds every
cosine in a block, so blocks are read in order of their bound, until no block can hold a nearer example: the k nearest
are exact.  Their labels vote with their cosine, beside a small vote for the overall rate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lists, lower_latin, mapped, slices, span_hashes, table, text_bytes, word_spans, written

#: Labelled rows that are fitted at most; the bound of the vocabulary, the index and what is broadcast.
EXAMPLES = 20_000
TERMS = 4_096
#: A term's likelihood ratio (G squared) against chance, and the toxic texts it must be in.
LEAST_G2, LEAST_DF = 18.0, 3
NEAREST = 25
BLOCK = 64
#: Weight of the overall rate among the votes.
PRIOR = 0.5
#: Bytes of the word beginnings that are terms of their own.
BEGINNINGS = (5, 7)

_APART = np.array([not (48 <= b < 58 or 97 <= b < 123 or b >= 128) for b in range(256)])


def terms_of(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and term (a hash) of every occurrence in a batch of texts."""
    data = lower_latin(data)
    begin, end, row = word_spans(data, ends, _APART)
    rows, terms = [row], [span_hashes(data, begin, end)]
    for k in BEGINNINGS:
        long = end - begin > k
        rows.append(row[long])
        terms.append(span_hashes(data, begin[long], begin[long] + k) ^ np.uint64(k))
    return np.concatenate(rows), np.concatenate(terms)


def _counts(rows: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, term) in order of row, and how often each occurs."""
    order = np.lexsort((terms, rows))
    rows, terms = rows[order], terms[order]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:] != rows[:-1]) | (terms[1:] != terms[:-1])
    at = np.flatnonzero(first)
    return rows[at], terms[at], np.diff(np.append(at, len(rows)))


def features(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and count of a batch's texts in order of row; a term that a text repeats makes one more term."""
    rows, terms, tf = _counts(*terms_of(data, ends))
    more = tf > 1
    rows, terms = np.append(rows, rows[more]), np.append(terms, ~terms[more])
    order = np.lexsort((terms, rows))
    return rows[order], terms[order], np.append(tf, np.ones(int(more.sum()), tf.dtype))[order]


def choose_terms(examples: DataFrame) -> np.ndarray:
    """Sorted hashes of the vocabulary.  ``examples`` has text and toxic (0 or 1)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, 0):
                rows, terms, _ = features(*text_bytes(b.column(0)))
                toxic = np.asarray(b.column(1).to_pylist(), np.int64)[rows]
                keys, place = np.unique(terms, return_inverse=True)
                with_it = np.bincount(place, toxic, len(keys)).astype(np.int64)
                found = np.bincount(place, minlength=len(keys)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(with_it), pa.array(found)], ["term", "toxic", "n"])

    totals = examples.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    if not totals["toxic"] or totals["toxic"] == totals["n"]:
        return np.empty(0, np.uint64)
    by = mapped(examples.select("text", "toxic"), count, "term long, toxic long, n long")
    by = by.groupBy("term").agg(F.sum("toxic").alias("a"), F.sum("n").alias("n")).where(F.col("a") >= LEAST_DF)
    rate = totals["toxic"] / totals["n"]
    a, c = F.col("a"), F.col("n") - F.col("a")
    part = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    g2 = 2 * (part(a, F.col("n") * rate) + part(c, F.col("n") * (1 - rate)))
    best = (by.where(a > F.col("n") * rate).withColumn("g2", g2).where(F.col("g2") >= LEAST_G2)
            .orderBy(F.desc("g2"), "term").limit(TERMS))
    return np.sort(np.array([r["term"] for r in best.select("term").collect()], np.int64).view(np.uint64))


def vectors(docs: DataFrame, vocabulary: np.ndarray, *keep: str) -> DataFrame:
    """``keep``, terms (places in the vocabulary) and tf of every whole text; nothing for null and empty texts."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, 0):
                rows, terms, tf = features(*text_bytes(b.column(0)))
                place = np.searchsorted(vocabulary, terms)
                known = np.flatnonzero(place < len(vocabulary))
                known = known[vocabulary[place[known]] == terms[known]]
                rows, terms, tf = rows[known], place[known], tf[known]
                starts = np.searchsorted(rows, np.arange(b.num_rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[1:], lists(terms.astype(np.int32), starts), lists(tf.astype(np.int32), starts)],
                    [*keep, "terms", "tf"])

    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return mapped(docs.select("text", *keep), read, f"{kinds}terms array<int>, tf array<int>")


class Index:
    """Examples in blocks, with the largest weight of each term in each block."""

    def __init__(self, examples: list[tuple[int, int, list[int], list[int]]], idf: np.ndarray):
        """``examples``: (id, label, terms, tf); those without terms only make the rate of such texts."""
        self.idf = idf
        self.rate = sum(e[1] for e in examples) / max(1, len(examples))
        bare = [e[1] for e in examples if not e[2]]
        self.bare = (sum(bare) + PRIOR * self.rate) / (len(bare) + PRIOR)
        own = [(self.unit(e[2], e[3]), e) for e in examples if e[2]]
        # Examples with the same strongest terms share blocks, so that bounds are close.
        own.sort(key=lambda x: (sorted(x[1][2], key=lambda t: -x[0][x[1][2].index(t)]), x[1][0]))
        self.ids = np.array([e[0] for _, e in own], np.int64)
        self.labels = np.array([e[1] for _, e in own], float)
        postings: dict[int, list[tuple[int, float]]] = {}
        for i, (w, e) in enumerate(own):
            for t, x in zip(e[2], w, strict=True):
                postings.setdefault(t, []).append((i, x))
        self.postings = {}
        for t, found in postings.items():
            at, w = np.array([i for i, _ in found]), np.array([x for _, x in found])
            blocks, first = np.unique(at // BLOCK, return_index=True)
            self.postings[t] = (blocks, np.maximum.reduceat(w, first), np.append(first, len(at)), at, w)
        self.blocks = -(-len(own) // BLOCK)

    def unit(self, terms, tf) -> np.ndarray:
        w = (1 + np.log(np.asarray(tf, float))) * self.idf[np.asarray(terms, int)]
        return w / max(np.sqrt((w * w).sum()), 1e-300)

    def nearest(self, terms, tf, k: int = NEAREST) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the k nearest examples, nearest first, ties by place; only those with a common term."""
        q = self.unit(terms, tf)
        bound = np.zeros(self.blocks)
        used = [(x, self.postings[t]) for t, x in zip(terms, q, strict=True) if t in self.postings]
        for x, (blocks, most, *_) in used:
            bound[blocks] += x * most
        order = np.argsort(-bound, kind="stable")
        best, cos = np.empty(0, int), np.empty(0)
        for b in order[: int((bound > 0).sum())]:
            if len(cos) == k and bound[b] < cos[-1] - 1e-12:
                break
            score = np.zeros(BLOCK)
            for x, (blocks, _, first, at, w) in used:
                i = np.searchsorted(blocks, b)
                if i < len(blocks) and blocks[i] == b:
                    score[at[first[i]:first[i + 1]] - b * BLOCK] += x * w[first[i]:first[i + 1]]
            hit = np.flatnonzero(score)
            best, cos = np.append(best, hit + b * BLOCK), np.append(cos, np.round(score[hit], 12))
            top = np.lexsort((best, -cos))[:k]
            best, cos = best[top], cos[top]
        return best, cos

    def score(self, terms, tf) -> tuple[float, list[int]]:
        """The vote, and the ids of the nearest toxic examples as evidence."""
        if not len(terms):
            return self.bare, []
        best, cos = self.nearest(terms, tf)
        y = self.labels[best]
        return (float((cos * y).sum()) + PRIOR * self.rate) / (float(cos.sum()) + PRIOR), self.ids[best[y > 0][:3]].tolist()


def classify(docs: DataFrame, labelled: DataFrame, key: str = "doc_id") -> DataFrame:
    """Every row of ``docs`` as (key, score, predicted, evidence): evidence are keys of near toxic examples.

    ``labelled`` has key and toxic; rows with nulls are not used, rows of keys that ``docs`` lacks teach nothing, and equal
    texts count once.  Null and empty texts get the rate of examples without a term.  Without toxic or without other
    examples all scores are the rate of the labels (0 without any).  Repeated rows of ``docs`` stay; other columns are left out.
    """
    few = labelled.where(F.col("toxic").isNotNull() & F.col(key).isNotNull())
    few = few.select(F.col(key).alias("of_"), F.col("toxic").cast("long").alias("toxic")).distinct()
    few = written(few.orderBy(F.xxhash64("of_", F.lit(3)), "of_", "toxic").limit(EXAMPLES), "examples")
    rows = docs.select(F.col(key).alias("key_"), "text")
    # At most EXAMPLES rows of two numbers are broadcast.
    known = rows.join(F.broadcast(few), F.col("key_") == F.col("of_")).select("key_", "toxic", "text", F.xxhash64("text").alias("h"))
    one = Window.partitionBy("h").orderBy("key_", F.desc("toxic"))
    known = known.withColumn("n", F.row_number().over(one)).where("n = 1").drop("n", "h")
    known = written(known, "labelled")
    vocabulary = choose_terms(known)
    examples = vectors(known, vocabulary, "key_", "toxic").collect()  # at most EXAMPLES, on terms of the vocabulary
    all_docs = written(vectors(rows, vocabulary, "key_"), "vectors")
    n = all_docs.count()
    df = np.zeros(len(vocabulary))
    for r in all_docs.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # at most TERMS rows
        df[r["t"]] = r["count"]
    idf = np.log((1 + n) / (1 + df)) + 1e-9
    index = Index([(r["key_"], r["toxic"], r["terms"], r["tf"]) for r in examples], idf)
    kind = rows.schema["key_"].dataType.simpleString()

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, tuple[float, list[int]]] = {}
        for b in batches:
            out = []
            for terms, tf in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                at = (*terms, *tf)
                if at not in seen:
                    if len(seen) > 100_000:
                        seen.clear()
                    seen[at] = index.score(terms, tf)
                out.append(seen[at])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([x for x, _ in out], pa.float64()), pa.array([x for _, x in out], pa.list_(pa.int64()))],
                ["key_", "score", "evidence"])

    voted = mapped(all_docs, vote, f"key_ {kind}, score double, evidence array<long>")
    return voted.select(F.col("key_").alias(key), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def held_out(key: str = "doc_id"):
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0


def query(spark, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(~held_out()).select("doc_id", "toxic")
    out = classify(table(spark, sf_dir, "documents"), labels)
    return out.select("doc_id", held_out().alias("held_out"), "score", "predicted", "evidence")
