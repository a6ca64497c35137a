"""Exact Jaccard join of documents on word shingles, filtered under several global orders of the shingles.

Two sets with 0.8 or more in common share shingles among the first of each, whatever order all shingles are in.

Order 1 is by hash.  A set's first n - ceil(0.8 n) + t shingles are read, of which two linked sets share t; t is larger for
short texts.  It costs no statistics, and shingles that no other set has among its first are dropped without a pair being made.
Order 2 is by frequency among those, rarest first: of them, only so many are looked up that one of the t is among them, so a
passage that many documents hold is looked up by documents that consist of little else.  There each shingle carries how many
of its set's common shingles stand from it on.  At the first shingle that two sets share, both must have as many left as their
sizes ask for, so a pair whose sets meet too late under order 2 is never made.  It carries 256 parities of its set, too, if that
is no longer than they can tell apart: two sets differ in as many shingles as parities at least, so a pair that differs in too
many for a link is never made either.
Candidate pairs get each other's parities again, now as many as their sets need, and those that differ in too many go before
any set is read.  Order 3 and 4 are two more hash orders, in which the pairs left must share a first shingle too before their sets are compared.

Pairs within a group are not all made.  Equal sets are one class from the start.  Then each shingle's sets are compared with
one of them.  In the first round it is drawn for each of a few kinds of shingles, so a group whose sets are all alike is compared
with a few of its members.  In later rounds each shingle draws its own, for groups of which each set is linked to few others.
What links becomes one component, and only shingles with several components left go on, until no link is found this way or all
remaining pairs across components are few enough.  These are compared outright.  No link that joins components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lists, lower_ascii, mapped, mix, slices, span_hashes, table, text_bytes, word_spans, written
from .components import components

WORDS = 5
#: Sets with no more shingles than this are read whole under order 1.
SHORT = 160
#: A link: 100 * intersection >= SHARE * union.
SHARE = 80
#: Rounds against one set of each shingle, at most, before all remaining pairs are made.
ROUNDS = 2
#: Kinds of shingles, each of which draws the sets to compare with by a hash of its own, in the first round.
DRAWS = 4
#: All remaining pairs are made as soon as there are no more than this many for each looked-up shingle.
FEW = 8
#: So many times more after the first round, when copies are one component and the join itself turns most of the rest down.
LATER = 4
#: Sets with more shingles than this are not told apart by 256 parities: half of them differ then, whether the sets are linked or not.
TELLING = 512

#: Pairs a worker gets at once; each holds two whole sets, which can have eight bytes for every word of a long text.
PAIRS = 200
#: Pairs a worker gets at once with no more than the parities of both.
SKETCHES = 2000
#: Names of the parities of a set, 64 in each.
_PARITIES = ("p0", "p1", "p2", "p3")

_ORDERS = tuple(np.uint64(x) for x in (0xA24BAED4963EE407, 0x9FB21C651E98DF25))
_KINDS = np.uint64(0xC2B2AE3D27D4EB4F)
_PLACE = mix(np.arange(1, WORDS + 1, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(data: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles; a shorter text is one shingle, one without words none."""
    data = lower_ascii(data)
    begin, end, row = word_spans(data, ends)
    words = span_hashes(data, begin, end)
    first = np.searchsorted(row, np.arange(len(ends)))
    n = max(0, len(words) - WORDS + 1)
    whole = np.zeros(n, np.uint64)
    for j in range(WORDS):
        whole += words[j:j + n] * _PLACE[j]
    whole = mix(whole)
    out = []
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if hi - lo >= WORDS:
            out.append(np.unique(whole[lo:hi - WORDS + 1]))
        elif hi > lo:
            out.append(mix((words[lo:hi] * _PLACE[: hi - lo]).sum(keepdims=True) + np.uint64(hi - lo)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """256 bits a set, as four 64-bit numbers: for each of 256 kinds of shingles, whether the set has an odd number of them."""
    kind = mix(np.concatenate([*sets, np.empty(0, np.uint64)]) ^ _KINDS) >> np.uint64(56)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    odd = np.bincount(row * 256 + kind.astype(np.int64), minlength=256 * len(sets)) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(-1, len(_PARITIES))


def sketch(s: np.ndarray) -> np.ndarray:
    """Parities of one set as bytes, four to eight of them a shingle, 256 to 16,384 in all.  Of half as many, the halves xored are the same."""
    bits = 1 << min(max((4 * len(s) - 1).bit_length(), 8), 14)
    kind = (mix(s ^ _KINDS) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(kind, minlength=bits) & 1).astype(np.uint8))


def apart(x: np.ndarray, y: np.ndarray) -> int:
    """In how many shingles two sets differ at least, by their sketches."""
    x, y = sorted((x, y), key=len)
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def _overlap(n):
    """Shingles that a set of n shares with any set it is linked to, at least."""
    return -(-SHARE * n // 100)


def _first(n: int) -> int:
    """How many shingles are read under order 1: three in ten, and of short texts all, as they may be little but a passage."""
    return min(n, max(n - _overlap(n) + 1 + n // 10, SHORT))


def _need(n: int) -> int:
    """How many of its first shingles a set of n surely shares with the first ones of any set it is linked to.

    Two linked sets share at least the lesser of first(m) - (m - overlap(m)) of both sizes.  That falls and rises again in m,
    so the sizes a partner can have are tried at their ends and at the bends; 2 less covers rounding.
    """
    low, high = _overlap(n), 100 * n // SHARE
    bends = [m for k in (SHORT, SHORT * 10 // 3) for m in (k - 4, k, k + 4) if low < m < high]
    return max(1, min(_first(m) - (m - _overlap(m)) for m in (low, n, high, *bends)) - 2)


def _signatures(docs: DataFrame) -> DataFrame:
    """x1, x2 (the text), n, need, unread, s1, s2 (the set), its parities, first (its first shingles under order 1) for rows of doc, text, x1, x2.

    ``unread`` is how many shingles of the set are not among ``first``.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, 0):
                sets = shingle_sets(*text_bytes(b.column(0)))
                n = np.array([len(s) for s in sets], np.int64)
                need = np.array([_need(len(s)) for s in sets], np.int64)
                unread = np.array([len(s) - _first(len(s)) for s in sets], np.int64)
                keys = np.array([[mix(s ^ k).sum() for k in _ORDERS] for s in sets], np.uint64).reshape(-1, 2)
                odd = parities(sets)
                first = [s[:_first(len(s))] for s in sets]
                starts = np.concatenate([[0], np.cumsum([len(x) for x in first])])
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[1:], pa.array(n), pa.array(need), pa.array(unread), pa.array(keys[:, 0].view(np.int64) if len(keys) else [], pa.int64()),
                     pa.array(np.ascontiguousarray(keys[:, 1]).view(np.int64)), *(pa.array(odd[:, i]) for i in range(len(_PARITIES))),
                     lists(np.concatenate(first).view(np.int64), starts)],
                    ["doc", "x1", "x2", "n", "need", "unread", "s1", "s2", *_PARITIES, "first"])

    kind = docs.schema["doc"].dataType.simpleString()
    return mapped(
        docs.select("text", "doc", "x1", "x2"), read, f"doc {kind}, x1 long, x2 long, n long, need long, unread long, s1 long, s2 long, "
              f"{', '.join(f'{p} long' for p in _PARITIES)}, first array<long>")


def _sets(texts: DataFrame) -> DataFrame:
    """rep, its sketch and its whole set, for rows of text, rep."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, 0):
                sets = shingle_sets(*text_bytes(b.column(0)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array([sketch(s).tobytes() for s in sets], pa.binary()),
                     pa.array([s.tobytes() for s in sets], pa.binary())], ["rep", "n", "odd", "shingles"])

    return mapped(texts.select("text", "rep"), read, "rep long, n long, odd binary, shingles binary")


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """What two sorted sets have in common if they are linked, or 0: filters under further orders first, then the sets."""
    if SHARE * max(len(a), len(b)) > 100 * min(len(a), len(b)):
        return 0
    for by in _ORDERS:
        x, y = (np.sort(mix(s ^ by))[: len(s) - _overlap(len(s)) + 1] for s in (a, b))
        if not len(np.intersect1d(x, y, assume_unique=True)):
            return 0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both if 100 * both >= SHARE * (len(a) + len(b) - both) else 0


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    return overlap(a, b) > 0


def _not_apart(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b, to) whose sketches differ in no more than the sets of a link do."""
    held = pairs.join(sets.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("odd").alias("oa")), "a")
    held = held.join(sets.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("odd").alias("ob")), "b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.column(3).to_numpy() + b.column(4).to_numpy()
            most = n - 2 * -(-SHARE * n // (100 + SHARE))
            found = [apart(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8))
                     for x, y in zip(b.column(5).to_pylist(), b.column(6).to_pylist(), strict=True)]
            on = pa.array(np.flatnonzero(np.array(found, np.int64) <= most), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(c).take(on) for c in range(3)], ["a", "b", "to"])

    return mapped(held.select("a", "b", "to", "na", "nb", "oa", "ob"), check, "a long, b long, to long")


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b, to) whose sets are linked, with the sizes of intersection and union."""
    pairs = written(_not_apart(pairs, sets), "near", rows=SKETCHES)
    paired = pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))).distinct()
    sets = sets.join(written(paired, "paired"), "rep", "left_semi")
    held = pairs.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa")), "a")
    held = held.join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb")), "b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64))
                    for x, y in zip(b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True)]
            both = np.array([overlap(x, y) for x, y in sets], np.int64)
            union = np.array([len(x) + len(y) for x, y in sets], np.int64) - both
            on = np.flatnonzero(both)
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(pa.array(on, pa.int64())) for c in range(3)), pa.array(both[on]),
                                              pa.array(union[on])], ["a", "b", "to", "intersection", "union"])

    return mapped(held.select("a", "b", "to", "sa", "sb"), check, "a long, b long, to long, intersection long, union long")


def _lookups(signatures: DataFrame, reps: DataFrame) -> DataFrame:
    """(shingle, rep, n, unread, left, parities): the shingles each class is looked up by, under orders 1 and 2, where two classes share one.

    ``left`` counts the class's common shingles from this one on, itself included, in order 2.
    """
    each = signatures.where("n > 0").select("row", F.explode("first").alias("shingle"))
    seen = written(each.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1"), "frequencies")
    # Dealt out before lists are made, or each row would travel as a list of its own.
    common = each.join(seen.hint("shuffle_hash"), "shingle").repartition("row").groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("common"))  # no more than the set's own first shingles
    # Of long sets they say nothing, and each lookup would carry them.
    telling = [F.when(F.col("n") <= TELLING, F.col(p)).otherwise(0).alias(p) for p in _PARITIES]
    sizes = signatures.join(reps.select(F.col("rep").alias("row")), "row").select("row", "n", "need", "unread", *telling)
    ranked = common.join(sizes, "row").where("size(common) >= need")
    last = (F.size("common") - F.col("need") + 1).cast("int")
    ranked = ranked.select(F.col("row").alias("rep"), "n", "unread", *_PARITIES, F.size("common").alias("size"),
                           F.posexplode(F.slice("common", 1, last)).alias("nth", "one"))
    out = written(ranked.select("rep", "n", "unread", F.col("one.shingle").alias("shingle"), F.expr("size - nth").alias("left"), *_PARITIES), "ranked")
    several = out.groupBy("shingle").agg(F.count("*").alias("c")).where("c > 1").select("shingle")
    return written(out.join(several, "shingle"), "lookups")


def _may_link() -> Column:
    """Whether two classes that meet at a shingle can be linked, by their sizes, their parities and what they have left from it on.

    A link needs at least (na + n) * SHARE / (100 + SHARE) shared shingles, of which at most the larger number of unread ones is
    not among the first of both.  What else is shared stands, in both, from the first shared shingle on.  All but the shared
    ones are in one set alone; where parities differ, there is at least one of these.
    """
    needed = f"(({SHARE} * (na + n) + {99 + SHARE}) div {100 + SHARE})"
    differ = " + ".join(f"bit_count({p} ^ {p}_a)" for p in _PARITIES)
    return F.expr(f"{SHARE} * greatest(n, na) <= 100 * least(n, na) and "
                  f"(greatest(n, na) > {TELLING} or {differ} <= na + n - 2 * {needed}) and "
                  f"least(left, left_a) >= {needed} - greatest(unread, unread_a)")


def _asking(lookups: DataFrame, *more: Column) -> DataFrame:
    """Lookups as the first side of pairs."""
    return lookups.select("shingle", F.col("rep").alias("a"), F.col("n").alias("na"), F.col("unread").alias("unread_a"),
                          F.col("left").alias("left_a"), *(F.col(p).alias(f"{p}_a") for p in _PARITIES), *more)


def _text_ids(text) -> list:
    return [F.xxhash64(text).alias("x1"), F.xxhash64(F.lit(7), text).alias("x2")]


def join_components(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: key, n_shingles, component_id, n_copies (rows with an equal set, itself included).

    component_id is the least key reachable over links (equal sets are linked).  Null and blank texts have no shingles, are
    linked with nothing, and their component is their own key.  Rows with equal keys stay; null keys are never least.  Other
    columns are left out.
    """
    return _joined(docs, key).select(F.col("doc").alias(key), "n_shingles", "component_id", "n_copies")


def all_links(docs: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(a, b, intersection, union) of all linked pairs of classes, a < b, and (key, class, n_copies) of all rows of ``docs``.

    A class is the rows with one set of shingles, numbered; the numbers mean nothing beyond these two tables.  Rows without
    shingles are in no class.  Pairs inside one component are in it too, so a large group of near copies has as many rows
    as it has links.
    """
    rows, signatures, members, classes, lookups = _prepared(docs, key)
    pairs = _asking(lookups).join(lookups.withColumnRenamed("rep", "b"), "shingle").where("a < b")
    pairs = pairs.where(_may_link()).select("a", "b").distinct()
    pairs = written(pairs.withColumn("to", F.lit(0).cast("long")), "pairs")
    links = written(_links(pairs, _lookup_sets(rows, signatures, lookups)).drop("to"), "links", rows=PAIRS)
    held = members.join(classes, ["s1", "s2", "n"], "left")
    return links, held.select(F.col("doc").alias(key), F.col("rep").alias("class"), F.coalesce("n_copies", F.lit(1)).alias("n_copies"))


def _prepared(docs: DataFrame, key: str) -> tuple[DataFrame, ...]:
    rows = docs.select(F.col(key).alias("doc"), F.col("text"), *_text_ids(F.coalesce("text", F.lit(""))))
    signatures = written(_signatures(rows).withColumn("row", F.monotonically_increasing_id()), "signatures")
    members = signatures.select("row", "doc", "x1", "x2", "n", "s1", "s2")
    classes = written(members.where("n > 0").groupBy("s1", "s2", "n").agg(
        F.min("row").alias("rep"), F.min("doc").alias("least"), F.count("*").alias("n_copies")), "classes")
    return rows, signatures, members, classes, _lookups(signatures, classes)


def _joined(docs: DataFrame, key: str) -> DataFrame:
    rows, signatures, members, classes, lookups = _prepared(docs, key)
    labels = written(component_labels(docs, rows, signatures, lookups), "labels")
    label = F.coalesce("label", "rep")
    classes = classes.join(labels, classes["rep"] == labels["node"], "left").withColumn("label", label)
    least = classes.groupBy("label").agg(F.min("least").alias("component_id"))
    classes = classes.join(least, "label").select("s1", "s2", "n", "n_copies", "component_id")
    out = members.join(classes, ["s1", "s2", "n"], "left")
    return out.select(
        "doc", "x1", "x2", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc")).alias("component_id"),
        F.coalesce("n_copies", F.lit(1)).alias("n_copies"))


def _lookup_sets(rows: DataFrame, signatures: DataFrame, lookups: DataFrame) -> DataFrame:
    """rep and its whole set, for the classes that are looked up."""
    wanted = lookups.select("rep").distinct()
    wanted = signatures.join(wanted, signatures["row"] == wanted["rep"]).select("rep", "doc", "x1", "x2")
    texts = rows.withColumn("text", F.coalesce("text", F.lit(""))).join(
        wanted.withColumnRenamed("doc", "doc_"), ["x1", "x2"]).where(F.col("doc").eqNullSafe(F.col("doc_")))
    return written(_sets(texts).dropDuplicates(["rep"]), "sets")


def component_labels(docs: DataFrame, rows: DataFrame, signatures: DataFrame, lookups: DataFrame) -> DataFrame:
    """(node, label) of the classes that are linked to another."""
    sets = _lookup_sets(rows, signatures, lookups)
    spark = docs.sparkSession
    edges = spark.createDataFrame([], "u long, v long")
    labelled = lookups.withColumn("label", F.col("rep"))
    done, stuck = None, False  # pairs compared so far; whether the last round found no link
    for turn in range(ROUNDS + 1):
        if turn == 0:  # each class is a component of its own, so a shingle's pairs are all across components
            open_ = labelled.groupBy("shingle").agg(F.count("*").alias("c")).withColumn("cc", F.col("c"))
        else:  # shingles that several components are still looked up by
            by = labelled.groupBy("shingle", "label").agg(F.count("*").alias("c"))
            open_ = written(by.groupBy("shingle").agg(F.sum("c").alias("c"), F.sum(F.col("c") * F.col("c")).alias("cc"),
                                                      F.count("*").alias("labels")).where("labels > 1"), "counts")
            labelled = written(labelled.join(open_.select("shingle"), "shingle"), "open")
        size = open_.agg(F.sum("c").alias("rows"), (F.sum(F.col("c") * F.col("c") - F.col("cc")) / 2).alias("pairs")).first()
        if not size["rows"]:
            break
        last = stuck or turn == ROUNDS or size["pairs"] <= FEW * (LATER if turn else 1) * size["rows"]
        mine = _asking(labelled, F.col("label").alias("la"))
        if not last:
            draw = F.xxhash64("a", F.col("shingle") if turn else F.pmod("shingle", F.lit(DRAWS)), F.lit(turn)).alias("draw")
            lead = mine.groupBy("shingle").agg(F.min(
                F.struct(draw, "la", "a", "na", "unread_a", "left_a", *(f"{p}_a" for p in _PARITIES))).alias("l"))
            lead = lead.select("shingle", "l.*").drop("draw")
            pairs = lead.join(labelled, "shingle").where("label <> la")
        else:
            pairs = mine.join(labelled, "shingle").where("a < rep and label <> la")
        pairs = pairs.where(_may_link())
        pairs = pairs.groupBy(F.col("rep").alias("a"), F.col("a").alias("b")).agg(F.min("la").alias("to"))
        if done is not None:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        found = written(_links(pairs, sets).select("a", "b"), "links", rows=PAIRS)
        edges = edges.unionByName(found.select(F.col("a").alias("u"), F.col("b").alias("v")))
        if last:
            break
        both = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        done = both if done is None else done.unionByName(both)
        stuck = found.isEmpty()
        if stuck:
            continue
        # Whole components, or members of one would meet again under several labels.
        labels = components(edges).withColumnRenamed("node", "rep")
        labelled = labelled.drop("label").join(labels, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    return components(edges)


def one_of_each(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, all columns, that have the least key of their component.

    Of equal rows one stays.  Rows without shingles stay, and so do components without any key.
    """
    found = _joined(docs, key).where(F.col("doc").eqNullSafe(F.col("component_id")))
    keep = written(found.select(F.col("doc").alias("k2"), "x1", "x2").distinct(), "kept")
    one = Window.partitionBy("x1", "x2", "k").orderBy("x1")
    held = docs.select(F.struct("*").alias("whole"), F.col(key).alias("k"), *_text_ids(F.coalesce("text", F.lit(""))))
    held = held.join(keep, ["x1", "x2"]).where(F.col("k").eqNullSafe(F.col("k2")))
    return held.withColumn("nth", F.row_number().over(one)).where("nth = 1").select("whole.*")


def query(spark, sf_dir: str) -> DataFrame:
    return join_components(table(spark, sf_dir, "documents"))


SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as words from documents
), s as (
  select distinct doc_id, md5(array_to_string(words[i:i + 4], ' ')) as s
  from (select doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) as i from w where len(words) > 0)
), c as (
  select doc_id, count(*) as n, md5(string_agg(s, '' order by s)) as k from s group by doc_id
), r as (
  select k, min(doc_id) as rep, count(*) as n_copies, any_value(n) as n from c group by k
), t as (
  select rep, n, s from r join s on s.doc_id = r.rep
), l as (
  select a.rep as a, b.rep as b from t a join t b on a.s = b.s and a.rep <> b.rep
  group by a.rep, b.rep, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))
), p as (
  select rep, rep as label from r union select p.rep, l.b from p join l on p.label = l.a
)
select w.doc_id, coalesce(c.n, 0) as n_shingles, coalesce(g.label, w.doc_id) as component_id,
       coalesce(r.n_copies, 1) as n_copies
from w left join c on w.doc_id = c.doc_id left join r on c.k = r.k
left join (select rep, min(label) as label from p group by rep) g on g.rep = r.rep
"""
