"""Remove text that occurs elsewhere: every byte under a string of ``LENGTH`` bytes that starts at more than one place.

Finding where to look.  Each window of 200 bytes is filed under its minimizer, the 32-gram in it with the least hash, so equal
windows are filed together.  Neighbouring windows share a minimizer; what they cover together is a segment.  Segments
under a minimizer that occurs once have no partner and go.  Equal segments are counted and one of each is kept.

Comparing.  Different segments under a minimizer are put into blocks of bounded size, all of one minimizer in one block, and a
block's suffix array says which windows occur twice: suffixes smaller than their successors are sorted directly, the others are
induced by scanning the buckets in order, and neighbours in the order with a common prefix of 200 bytes are repeats.  A
minimizer with very many different segments (a short phrase in many contexts) is not put into one block; its windows are
counted one by one instead.

Going back.  Repeated windows are joined to where their segments lie, and each text loses what its repeated windows cover.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _BYTE, _POWERS, lists, mix, slices, span_hashes, table, text_bytes, written

LENGTH = 200
GRAM = 32
#: Bytes of segments in a block, about.
BLOCK = 1 << 20
#: A minimizer with more different segments than this is counted window by window.
CROWD = 1_500
#: Windows of a text that are read at once.
_CHUNK = 1 << 20
_INDEX = np.uint64((1 << 24) - 1)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    out, by, have = _BYTE[data], 0xD6E8FEB86659FD93, 1
    while have < GRAM:
        out = out[:-have] * np.uint64(by) + out[have:]
        have, by = have * 2, (by * by + 2) % (1 << 64)
    return mix(out)


def segments(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, number of windows, and minimizer of the segments of a text, in order; every window is in one."""
    begins, runs, keys = [], [], []
    for lo in range(0, max(0, len(data) - LENGTH + 1), _CHUNK):
        grams = _gram_hashes(data[lo:lo + _CHUNK + LENGTH - 1])
        # The place in the low bits breaks ties to the left and tells where the least one is.
        least, have, width = (grams & ~_INDEX) | np.arange(len(grams), dtype=np.uint64), 1, LENGTH - GRAM + 1
        while have * 2 <= width:
            least = np.minimum(least[:-have], least[have:])
            have *= 2
        if have < width:
            least = np.minimum(least[: len(least) - (width - have)], least[width - have:])
        new = np.ones(len(least), bool)
        new[1:] = least[1:] != least[:-1]
        first = np.flatnonzero(new)
        begins.append(first + lo)
        runs.append(np.diff(np.append(first, len(least))))
        keys.append(grams[(least[first] & _INDEX).astype(np.int64)])
    if not begins:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(begins), np.concatenate(runs), np.concatenate(keys)


# -- the suffix array of a block ---------------------------------------------------------------------


class Block:
    """Segments one after the other, each followed by a 0; letters are bytes plus 1.  A 0 is less than one further on."""

    def __init__(self, pieces: list[bytes]):
        self.text = t = np.frombuffer(b"".join(x for p in pieces for x in (p, b"\xff")), np.uint8) + np.uint8(1)
        n = len(t)
        zero = np.flatnonzero(t == 0)
        self.begin = np.concatenate([[0], zero[:-1] + 1])
        #: Letters from a place to the end of its segment.
        self.rest = np.repeat(zero, np.diff(np.concatenate([[-1], zero]))) - np.arange(n)
        _POWERS.upto(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[t] * _POWERS.up[:n], out=self.sums[1:])
        # Eight letters as a number, nothing behind the end of a segment.
        key = t.astype(np.uint64)
        for have in (1, 2, 4):
            after = np.zeros(n, np.uint64)
            after[: max(0, n - have)] = key[have:]
            key = key << np.uint64(8 * have) | np.where(self.rest >= have, after, np.uint64(0))
        self.key = np.append(key, np.zeros(16, np.uint64))
        # Suffixes smaller than their successors.
        change = np.where(t[1:] != t[:-1], np.arange(n - 1), n)
        change = np.minimum.accumulate(change[::-1])[::-1]
        self.small = np.ones(n, bool)
        self.small[:-1] = t[change] < t[np.minimum(change + 1, n - 1)]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the common prefixes of suffixes a and b, a before b or after, by halving on hashes."""
        swap = a > b
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        most = np.minimum(self.rest[a], self.rest[b])
        move = _POWERS.up[b - a]
        at_a, at_b, n = self.sums[a] * move, self.sums[b], np.zeros(len(a), np.int64)
        step = 1 << max(0, int(most.max(initial=0)).bit_length() - 1)
        while step:
            to = np.minimum(n + step, most)
            same = self.sums[a + to] * move - at_a == self.sums[b + to] - at_b
            n = np.where(same, to, n)
            step >>= 1
        # Steps were cut at ``most``, so a last stretch may be left.
        to = most
        same = self.sums[a + to] * move - at_a == self.sums[b + to] - at_b
        return np.where(same, to, n)

    def _sorted_small(self) -> np.ndarray:
        """Suffixes that are smaller than their successors and begin with a letter, in order."""
        p = np.flatnonzero(self.small & (self.text > 0))
        if not len(p):
            return p
        p = p[np.argsort(self.key[p], kind="stable")]
        key = self.key[p]
        group = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
        # Suffixes that ended within their eight letters are in order of place, which the stable sort has kept.
        open_ = self.rest[p] >= 8
        while True:
            size = np.bincount(group)
            live = np.flatnonzero((size[group] > 1) & open_)
            if not len(live):
                return p
            e, g = p[live], group[live]
            head = np.concatenate([[True], g[1:] != g[:-1]])
            q = e[head][np.cumsum(head) - 1]
            n = self.common(e, q)
            mine, its = self.key[e + n], self.key[q + n]
            # Of those before the first one of the group the least alike come first, of those behind it last.
            side = np.where(mine < its, n, np.where(mine == its, 1 << 20, (1 << 21) - n))
            mine = np.where(mine == its, e.astype(np.uint64), mine)  # equal to the end: by place
            order = np.lexsort((mine, side, g))
            e, g, n, side, mine = e[order], g[order], n[order], side[order], mine[order]
            p[live] = e
            new = np.concatenate([[True], (g[1:] != g[:-1]) | (side[1:] != side[:-1]) | (mine[1:] != mine[:-1])])
            # Numbers stay in order: a group's new parts lie between it and the next one.
            split = np.zeros(len(p), np.int64)
            split[live] = new & ~np.concatenate([[True], g[1:] != g[:-1]])
            group = group + np.cumsum(split)
            open_[live] = (side != 1 << 20) & (self.rest[e] - n >= 8)

    def suffix_array(self) -> np.ndarray:
        t, small = self.text, self.small
        direct = self._sorted_small()
        letters = np.searchsorted(t[direct], np.arange(257)) if len(direct) else np.zeros(257, np.int64)
        waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
        out = []
        for c in np.unique(t).tolist():
            if c:
                large = [x for x in waiting[c] if len(x)]
                wave = np.concatenate(large) if large else np.empty(0, np.int64)
                parts = [wave]
                while len(wave):  # of a run of one letter, each suffix follows from the next
                    wave = wave[wave > 0] - 1
                    wave = wave[(t[wave] == c) & ~small[wave]]
                    parts.append(wave)
                bucket = np.concatenate([*parts, direct[letters[c]:letters[c + 1]]])
            else:
                bucket = np.flatnonzero(t == 0)
            out.append(bucket)
            before = bucket[bucket > 0] - 1
            before = before[~small[before] & (t[before] > c)]
            letter = t[before]
            order = np.argsort(letter, kind="stable")
            before, letter = before[order], letter[order]
            cut = np.flatnonzero(letter[1:] != letter[:-1]) + 1
            for piece in np.split(before, cut) if len(before) else ():
                waiting[int(t[piece[0]])].append(piece)
        return np.concatenate(out)

    def repeated(self) -> np.ndarray:
        """Places where a string of ``LENGTH`` bytes begins that begins at another place of the block too."""
        order = self.suffix_array()
        long = self.rest[order] >= LENGTH
        near = np.flatnonzero(long[1:] & long[:-1])
        a, b = order[near], order[near + 1]
        alike = self.common(a, b) >= LENGTH
        a, b = a[alike], b[alike]
        for at in range(0, LENGTH, 8):  # the bytes themselves
            same = self.key[a + at] == self.key[b + at]
            a, b = a[same], b[same]
        return np.unique(np.concatenate([a, b]))


def _flags(pieces: list[bytes]) -> list[np.ndarray]:
    """For each segment, its windows (counted from 0) that are in another of the segments or twice in it."""
    block = Block(pieces)
    found = block.repeated()
    which = np.searchsorted(block.begin, found, side="right") - 1
    cut = np.searchsorted(which, np.arange(len(pieces) + 1))
    return [found[i:j] - block.begin[k] for k, (i, j) in enumerate(zip(cut[:-1], cut[1:], strict=True))]


def _runs(places: np.ndarray) -> tuple[list[int], list[int]]:
    if not len(places):
        return [], []
    cut = np.flatnonzero(np.diff(places) > 1)
    return places[np.append(0, cut + 1)].tolist(), (places[np.append(cut, len(places) - 1)] + 1).tolist()


# -- the job -----------------------------------------------------------------------------------------


def _segment_table(rows: DataFrame) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, 0):
                data, ends = text_bytes(b.column(0))
                at, runs, keys, bodies, starts = [], [], [], [], [0]
                for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                    own = data[lo:hi]
                    begin, run, key = segments(own)
                    at.append(begin)
                    runs.append(run)
                    keys.append(key)
                    bodies.append(span_hashes(own, begin, begin + run + LENGTH - 1))
                    starts.append(starts[-1] + len(begin))
                arrays = [lists(np.concatenate(x).astype(k) if k != np.uint64 else np.concatenate(x).view(np.int64), np.array(starts))
                          for x, k in ((at, np.int32), (runs, np.int32), (keys, np.uint64), (bodies, np.uint64))]
                yield pa.RecordBatch.from_arrays([*b.columns[1:], *arrays], ["x1", "x2", "doc", "at", "run", "h", "g"])

    kind = rows.schema["doc"].dataType.simpleString()
    return rows.select("text", "x1", "x2", "doc").mapInArrow(
        read, f"x1 long, x2 long, doc {kind}, at array<int>, run array<int>, h array<long>, g array<long>")


def _bytes_of(wanted: DataFrame, rows: DataFrame) -> DataFrame:
    """h, g, body for segments (h, g, at, run) of texts (x1, x2, doc)."""
    by = wanted.groupBy("x1", "x2", "doc").agg(F.collect_list(F.struct("at", "run", "h", "g")).alias("s"))  # of one text
    by = by.withColumnRenamed("doc", "doc_")
    held = rows.join(by, ["x1", "x2"]).where(F.col("doc").eqNullSafe(F.col("doc_"))).select("text", "s")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, 0):
                data, ends = text_bytes(b.column(0))
                h, g, body = [], [], []
                for lo, s in zip(ends[:-1].tolist(), b.column(1).to_pylist(), strict=True):
                    for x in s:
                        h.append(x["h"])
                        g.append(x["g"])
                        body.append(data[lo + x["at"]:lo + x["at"] + x["run"] + LENGTH - 1].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h, pa.int64()), pa.array(g, pa.int64()), pa.array(body, pa.binary())], ["h", "g", "body"])

    return held.mapInArrow(cut, "h long, g long, body binary")


def _compare(bodies: DataFrame, n_blocks: int) -> DataFrame:
    """h, g, lo, hi: runs of windows of each segment that another segment of its minimizer holds, or it twice."""

    def sort(block: pa.Table) -> pa.Table:
        h, g, body = (block.column(c).to_pylist() for c in ("h", "g", "body"))
        once = {(x, y): z for x, y, z in zip(h, g, body, strict=True)}  # equal rows may own a segment
        found = [_runs(f) for f in _flags(list(once.values()))]
        return pa.table([pa.array([k[0] for k in once], pa.int64()), pa.array([k[1] for k in once], pa.int64()),
                         pa.array([f[0] for f in found], pa.list_(pa.int32())),
                         pa.array([f[1] for f in found], pa.list_(pa.int32()))], ["h", "g", "lo", "hi"])

    blocks = bodies.groupBy(F.pmod(F.xxhash64("h"), F.lit(n_blocks)).alias("block"))
    return blocks.applyInArrow(sort, "h long, g long, lo array<int>, hi array<int>")


def _count_windows(bodies: DataFrame) -> DataFrame:
    """The same for minimizers with very many segments: each window is a row, and those that come twice are repeats."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, 2, 1 << 17):
                for h, g, body in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    data = np.frombuffer(body, np.uint8)
                    at = np.arange(len(data) - LENGTH + 1)
                    w = span_hashes(data, at, at + LENGTH)
                    # A second hash, of the two halves, makes it 128 bits.
                    v = mix(span_hashes(data, at, at + 100) + mix(span_hashes(data, at + 100, at + LENGTH)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), h)), pa.array(np.full(len(at), g)), pa.array(at.astype(np.int32)),
                         pa.array(w.view(np.int64)), pa.array(v.view(np.int64))], ["h", "g", "at", "w", "v"])

    each = bodies.dropDuplicates(["h", "g"]).mapInArrow(windows, "h long, g long, at int, w long, v long")
    each = written(each, "windows")
    twice = each.groupBy("h", "w", "v").agg(F.count("*").alias("n")).where("n > 1").select("h", "w", "v")
    one = each.join(twice, ["h", "w", "v"]).select("h", "g", "at")
    return one.groupBy("h", "g").agg(F.collect_list("at").alias("lo")).select(  # windows of one segment
        "h", "g", "lo", F.transform("lo", lambda x: x + 1).alias("hi"))


def repeats(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """x1, x2 (hashes of a text) and lo, hi: runs of window starts that are repeated, for each text that has any."""
    rows = _rows(docs, key)
    table_ = written(_segment_table(rows).withColumn("row", F.monotonically_increasing_id()), "segments")
    each = table_.select("row", F.inline(F.arrays_zip("at", "run", "h", "g")))
    shared = each.groupBy("h").agg(F.count("*").alias("n"), F.min("g").alias("g0"), F.max("g").alias("g1")).where("n > 1")
    shared = written(shared.select("h", (F.col("g0") != F.col("g1")).alias("differ")), "minimizers")
    each = written(each.join(shared.hint("shuffle_hash"), "h"), "occurrences")
    # One row for each different segment; its place is the one whose hash is least.
    place = F.xxhash64("row", "at")
    kinds = each.where("differ").groupBy("h", "g").agg(F.count("*").alias("n"), F.min(place).alias("place"),
                                                       F.max("run").alias("run"))
    kinds = written(kinds, "kinds")
    crowded = written(kinds.groupBy("h").agg(F.count("*").alias("c")).where(F.col("c") > CROWD).select("h"), "crowds")
    texts = table_.select("row", "x1", "x2", "doc")
    own = each.where("differ").withColumn("place", place).join(kinds.select("h", "g", "place"), ["h", "g", "place"])
    own = own.select("row", "at", "run", "h", "g").join(texts, "row")
    bodies = written(_bytes_of(own, rows), "bodies")
    few = bodies.join(crowded, "h", "left_anti")
    total = bodies.agg(F.sum(F.length("body")).alias("n")).first()["n"] or 0
    found = _compare(few, 1 + total // BLOCK).unionByName(_count_windows(bodies.join(crowded, "h", "left_semi")))
    found = kinds.select("h", "g", "n", "run").join(found, ["h", "g"], "left")
    whole = F.col("n") > 1  # the segment itself occurs twice
    found = found.select("h", "g", F.when(whole, F.array(F.lit(0))).otherwise(F.col("lo")).alias("lo"),
                         F.when(whole, F.array(F.col("run"))).otherwise(F.col("hi")).alias("hi"))
    found = written(found.where("size(lo) > 0"), "repeats")
    # Results depend on the text alone, so one row of each text is enough.
    first = table_.groupBy("x1", "x2").agg(F.min("row").alias("row"))
    each = each.join(first.select("row"), "row", "left_semi")
    same = each.where("not differ").select("row", "at", F.array(F.lit(0)).alias("lo"), F.array("run").alias("hi"))
    mixed = each.where("differ").select("row", "at", "h", "g").join(found, ["h", "g"]).select("row", "at", "lo", "hi")
    all_ = same.unionByName(mixed).groupBy("row").agg(F.collect_list(F.struct("at", "lo", "hi")).alias("runs"))  # of one text
    return written(all_.join(first, "row").select("x1", "x2", "runs"), "removals")


def _rows(docs: DataFrame, key: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col(key).alias("doc"), text.alias("text"), F.xxhash64(text).alias("x1"), F.xxhash64(F.lit(7), text).alias("x2"))


def remove_repeats(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: key, n_bytes, kept (the bytes left, binary), removed (array of start and end, in bytes).

    A text is its UTF-8 bytes; a null text is empty.  Repeated rows stay, each a copy of the other.  Strings never cross texts.
    The kept bytes of a text may begin or end within a character.  Other columns are left out.
    """
    rows = _rows(docs, key).join(repeats(docs, key), ["x1", "x2"], "left").select("text", "doc", "runs")
    kind = rows.schema["doc"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, 0):
                data, ends = text_bytes(b.column(0))
                kept, spans = [], []
                for i, runs in enumerate(b.column(2).to_pylist()):
                    own = data[ends[i]:ends[i + 1]]
                    if not runs:
                        kept.append(own.tobytes())
                        spans.append([])
                        continue
                    step = np.zeros(len(own) + 1, np.int64)
                    lo = np.array([r["at"] + x for r in runs for x in r["lo"]])
                    hi = np.array([r["at"] + x for r in runs for x in r["hi"]]) + LENGTH - 1
                    np.add.at(step, lo, 1)
                    np.add.at(step, hi, -1)
                    gone = np.cumsum(step[:-1]) > 0
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                    kept.append(own[~gone].tobytes())
                    spans.append([{"start": int(x), "end": int(y)} for x, y in edge.reshape(-1, 2)])
                yield pa.RecordBatch.from_arrays(
                    [b.column(1), pa.array(np.diff(ends)), pa.array(kept, pa.binary()),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                    ["doc", "n_bytes", "kept", "removed"])

    out = rows.mapInArrow(cut, f"doc {kind}, n_bytes long, kept binary, removed array<struct<start:bigint,end:bigint>>")
    return out.withColumnRenamed("doc", key)


def query(spark, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
                      F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
