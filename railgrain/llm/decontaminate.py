"""Find benchmark items in documents, edited ones too: CGK embeddings, bit-sampling LSH, and exact edit distances.

Texts are compared as lower-case letters and digits with single blanks between.  An item is found where a piece of the
document is within ``RATE`` of the item's length in edits.

1. Items of about one size are a class.  By the q-gram lemma a piece that is near an item shares many of its q-grams,
   so only stretches of a document with that many q-grams of any item can hold one; nothing is lost here.
2. In those stretches a window of about 32 characters begins at every word.  A CGK walk reads it: each step writes a character and moves on or
   stays by a random bit of step and character, so texts at a small edit distance soon write the same again.  Some
   steps, chosen at random, are the window's key; walks and steps are drawn ``repeats(size)`` times.  Windows of the items begin at
   every word too, so that one window without an edit in reach of its sampled steps is enough.
   Walks stop at the end of a text.  Items too short for such windows (below ``LEAST`` characters, or with few words for
   their size) have exact keys instead: cut into one piece more than edits are allowed, they keep one piece whole.
3. Stretches and items that share a key are compared by their exact edit distance.

Items so short that no edit is allowed (below 13 characters) are found where they stand as whole words.

What tasks hold of the benchmark are bitmaps of fixed size; keys and texts of items are joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _BYTE, lower_latin, mapped, mix, slices, table, text_bytes, written

#: Edits per character of an item up to which it counts as found.
RATE = 0.08
#: Items with fewer characters are too short for walks.
LEAST = 50
SAMPLES, STEPS = 10, 64
#: Part of the items that share a key with a piece at the full edit rate, and how often walks are drawn for it from a size on.
#: Simulated leaks (300 a size, edits at random places or as far apart as can be) needed 30 repeats at 40 characters, 14 at
#: 50, 7 at 63, 5 at 75 and 88, and 3 at 100 and above to reach the target; the table has about twice that from 50 on.
TARGET = 0.99
REPEATS_FROM = {LEAST: 24, 63: 14, 75: 10, 100: 6}
REPEATS = max(REPEATS_FROM.values())
#: Sizes of a class are within this factor.
SPREAD = 1.5
_GRAM_BITS, _KEY_BITS = 23, 24
_PAD = STEPS + 8
#: Pieces of items with exact keys have this many characters at most.
_SEED = 12

_KEEP = np.array([48 <= b < 58 or 97 <= b < 123 or b >= 128 for b in range(256)])
_RANDOM = np.random.default_rng(20)
_MOVES = _RANDOM.integers(0, 2, (REPEATS, STEPS, 256)).astype(np.int64)
_MOVES[:, :, 0] = 0  # a walk stops at the end of its text
_PICKS = np.sort(np.stack([_RANDOM.permutation(STEPS)[:SAMPLES] for _ in range(REPEATS)]), 1)


def normalise_all(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Many texts as lower-case letters and digits with single blanks, and where each byte came from."""
    data = lower_latin(data)
    data = np.where(_KEEP[data], data, np.uint8(32))
    keep = data != 32
    keep[1:] |= data[:-1] != 32
    keep[ends[:-1][ends[:-1] < len(data)]] = True
    at = np.flatnonzero(keep)
    return data[at], at


def normalise(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same of one text, without blanks at its ends."""
    data, at = normalise_all(data, np.array([0, len(data)]))
    first, last = int(len(data) > 0 and data[0] == 32), len(data) - int(len(data) > 1 and data[-1] == 32)
    return data[first:last], at[first:last]


def edits(length: int) -> int:
    return int(RATE * length)


#: Items with fewer characters allow no edit.
_NO_EDIT = next(n for n in range(1, 1000) if edits(n))


def grams_shared(q: int, low: int, high: int) -> int:
    """How many q-grams a near piece shares at least with an item of any size from low to high.

    The bound falls by q wherever one more edit is allowed, so it is not least at the shortest item.
    """
    return min(n - q + 1 - q * edits(n) for n in range(low, high + 1))


def gram_size(low: int, high: int = 0) -> int:
    """The longest q-grams of which a piece near an item of these sizes surely shares enough."""
    return next((q for q in (10, 8, 6, 4) if grams_shared(q, low, max(low, high)) >= 4), 2)


_BYTE32 = (_BYTE >> np.uint64(32)).astype(np.uint32)


def _grams(data: np.ndarray, q: int) -> np.ndarray:
    """Hashes of all q-grams, q even, by doubling; they only have to be small and mostly different."""
    out, by, have, done, reach = _BYTE32[data], 0x5BD1E995, 1, None, 0
    while True:
        if q & have:
            done = out if done is None else done[: max(0, len(out) - reach)] * np.uint32(31) + out[reach:] * np.uint32(by) if reach else out
            reach += have
        if reach == q:
            done = done[: max(0, len(data) - q + 1)]
            done = (done ^ (done >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            return (done ^ (done >> np.uint32(12))) >> np.uint32(32 - _GRAM_BITS)
        n = max(0, len(out) - have)
        out = out[:n] * np.uint32(by) + out[have:have + n]
        have, by = have * 2, (by * by + 2) % (1 << 32)


def repeats(length: int) -> int:
    """How often walks are drawn for items of this size so that ``TARGET`` of their leaks share a key."""
    return next(n for size, n in sorted(REPEATS_FROM.items(), reverse=True) if length >= size)


def walk_keys(data: np.ndarray, starts: np.ndarray, first: int = 0, last: int = REPEATS) -> np.ndarray:
    """A key for each start and repetition; ``data`` has at least ``_PAD`` bytes after the last start's text."""
    out = np.empty((len(starts), last - first), np.uint64)
    for r in range(first, last):
        at, key, picks = starts.copy(), np.full(len(starts), r + 1, np.uint64), set(_PICKS[r].tolist())
        for j in range(max(picks) + 1):
            c = data[at]
            if j in picks:
                key = key * np.uint64(0x9E3779B97F4A7C15) + _BYTE[c]
            at += _MOVES[r, j][c]
        out[:, r - first] = mix(key)
    return out


def span_keys(data: np.ndarray, starts: np.ndarray, sizes: list[int], kind: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each of ``sizes`` and the keys of so many bytes from each start; ``data`` has so many bytes after the last start."""
    key = np.full(len(starts), 1000 + kind, np.uint64)
    for n in range(1, max(sizes, default=0) + 1):
        key = key * np.uint64(0x9E3779B97F4A7C15) + _BYTE[data[starts + n - 1]]
        if n in sizes:
            yield n, mix(key + np.uint64(n))


def by_walks(data: np.ndarray) -> bool:
    """Whether an item has enough windows to be found by walks."""
    return len(data) >= LEAST and 12 * len(word_starts(data)) >= len(data)


def seed_size(length: int) -> int:
    return min(_SEED, length // (edits(length) + 1))


def exact_keys(data: np.ndarray) -> np.ndarray:
    """Keys of one piece more than edits are allowed; of the whole item where none is."""
    n = seed_size(len(data))
    if not edits(len(data)):
        return np.concatenate([k for _, k in span_keys(data, np.zeros(1, np.int64), [len(data)], 1)])
    return np.concatenate([k for _, k in span_keys(data, np.arange(edits(len(data)) + 1) * n, [n], 0)])


def word_starts(data: np.ndarray) -> np.ndarray:
    first = np.zeros(len(data), bool)
    first[1:] = (data[:-1] == 32) | (data[:-1] == 0)
    if len(data):
        first[0] = True
    return np.flatnonzero(first & (data != 32) & (data != 0))


def nearest_piece(pattern: bytes, text: bytes) -> tuple[int, int, int]:
    """Least edit distance of ``pattern`` to any piece of ``text``, and that piece; Myers' bit vectors, a column a step."""

    def search(p: bytes, t: bytes, free: bool) -> tuple[int, int]:
        m, where = len(p), {}
        for i, c in enumerate(p):
            where[c] = where.get(c, 0) | 1 << i
        ones, top = (1 << m) - 1, 1 << (m - 1)
        up, down, score, best, end = ones, 0, m, m, 0
        for j, c in enumerate(t):
            eq = where.get(c, 0)
            x = eq | down
            d = (((eq & up) + up) ^ up) | eq
            h_up, h_down = down | ~(d | up) & ones, up & d
            if h_up & top:
                score += 1
            elif h_down & top:
                score -= 1
            if score < best:
                best, end = score, j + 1
            h_up = (h_up << 1 | (not free)) & ones
            h_down = h_down << 1 & ones
            up, down = h_down | ~(x | h_up) & ones, h_up & x
        return best, end

    best, end = search(pattern, text, True)
    _, length = search(pattern[::-1], text[max(0, end - 2 * len(pattern)):end][::-1], False)
    return best, end - length, end


def _classes(lengths: list[int]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for n in sorted(lengths):
        if out and n <= SPREAD * out[-1][0]:
            out[-1] = (out[-1][0], n)
        else:
            out.append((n, n))
    return out


def find_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", item: str = "item_id") -> DataFrame:
    """Rows (key, item, distance, start, end): each document and each item found in it, at its nearest piece.

    start and end are places in the document's text, in characters.  Null texts and those without a letter or digit are in
    no row.  Repeated documents and items each give their own rows; other columns are left out.
    """
    spark = docs.sparkSession
    wanted = items.select(F.col(item).alias("item"), "text").where("text is not null")

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own, texts, keys, walks = [], [], [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                data, _ = normalise(np.frombuffer(t.encode(), np.uint8))
                if not len(word_starts(data)):
                    continue
                walks.append(by_walks(data))
                if walks[-1]:
                    starts = word_starts(data)
                    # A walk goes half its steps far on average; windows that would leave the item are of no use.
                    starts = starts[(starts == 0) | (starts + STEPS // 2 + 4 <= len(data))]
                    k = walk_keys(np.concatenate([data, np.zeros(_PAD, np.uint8)]), starts, 0, repeats(len(data)))
                else:
                    k = exact_keys(data)
                own.append(i)
                texts.append(data.tobytes())
                keys.append(k.view(np.int64).ravel().tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, b.column(0).type), pa.array(texts, pa.binary()), pa.array(keys, pa.list_(pa.int64())),
                 pa.array(walks, pa.bool_())], ["item", "norm", "keys", "walks"])

    kind = wanted.schema["item"].dataType.simpleString()
    known = written(mapped(wanted, prepare, f"item {kind}, norm binary, keys array<long>, walks boolean")
                    .withColumn("no", F.monotonically_increasing_id()), "items")
    sizes = known.select(F.length("norm"), "walks").distinct().collect()  # item lengths, not items
    word_sizes = sorted({n for n, _ in sizes if not edits(n)})
    sizes = [(n, walks) for n, walks in sizes if edits(n)]
    # Each class, and the sizes of pieces in it that have exact keys.
    classes = [(low, high, walks, sorted({seed_size(n) for n, w in sizes if w == walks and low <= n <= high} if not walks else ()))
               for walks in (False, True) for low, high in _classes([n for n, w in sizes if w == walks])]
    seed_sizes = sorted({n for c in classes for n in c[3]})
    used = {gram_size(low, high) for low, high, _, _ in classes}

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in b.column(0).to_pylist():
                data = np.frombuffer(t, np.uint8)
                for q in used:
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(max(0, len(data) - q + 1), q, np.int32)),
                                                      pa.array(_grams(data, q).astype(np.int64))], ["q", "bit"])

    # Bitmaps of 2 ** 23 and 2 ** 24 bits, whatever the size of the benchmark.
    gram_bits = {q: np.zeros(1 << _GRAM_BITS, bool) for q in used}
    for r in mapped(known.select("norm").where(F.length("norm") >= _NO_EDIT), grams, "q int, bit long").distinct().collect():
        gram_bits[r["q"]][r["bit"]] = True
    item_keys = written(known.select("no", F.explode(F.array_distinct("keys")).alias("key")), "item_keys")
    key_bits = np.zeros(1 << _KEY_BITS, bool)
    for r in item_keys.select(F.shiftrightunsigned("key", 64 - _KEY_BITS).alias("bit")).distinct().collect():
        key_bits[r["bit"]] = True
    packed = {q: np.packbits(x) for q, x in gram_bits.items()}, np.packbits(key_bits)

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_gram, by_key = {q: np.unpackbits(x).view(bool) for q, x in packed[0].items()}, np.unpackbits(packed[1]).view(bool)
        for whole in batches:
            for b in slices(whole, 1):
                data, ends = text_bytes(b.column(1))
                norm, at = normalise_all(data, ends)
                # A zero byte at the end of each text, which no gram, window or stretch goes past.
                apart = np.searchsorted(at, ends[1:-1])
                norm, at = np.insert(norm, apart, 0), np.insert(at, apart, ends[1:-1])
                inside, drawn = np.zeros(len(norm), bool), np.zeros(len(norm), np.int8)
                seeded = {n: np.zeros(len(norm), bool) for n in seed_sizes}
                near = {q: np.concatenate([[0], np.cumsum(bits[_grams(norm, q)], dtype=np.int32)])
                        for q, bits in by_gram.items() if len(norm) >= q}
                for low, high, walks, seeds in classes:
                    q = gram_size(low, high)
                    if q not in near:
                        continue
                    width = min(high + edits(high) - q + 1, len(near[q]) - 1)
                    full = near[q][width:] - near[q][:-width] >= grams_shared(q, low, high)
                    if full.any():  # a place is inside if such a window begins less than its length before it
                        begun, reach = np.cumsum(full, dtype=np.int32), width + q - 1
                        begun = np.append(begun, np.full(len(norm) - len(begun), begun[-1]))
                        begun = np.concatenate([begun[:reach] > 0, begun[reach:] > begun[:-reach]])
                        inside |= begun
                        # Short items need more walks than long ones; each place has as many as the classes it may belong to.
                        if walks:
                            np.maximum(drawn, np.int8(repeats(low)), out=drawn, where=begun)
                        for n in seeds:
                            seeded[n] |= begun
                inside &= norm != 0
                edge = np.flatnonzero(np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))).reshape(-1, 2)
                starts = word_starts(norm)
                whole_words, starts = starts, starts[inside[starts]]
                padded, done, hit_at, hit_keys = np.concatenate([norm, np.zeros(_PAD, np.uint8)]), 0, [], []
                for n in sorted({repeats(low) for low, _, walks, _ in classes if walks}):
                    starts = starts[drawn[starts] >= n]
                    keys = walk_keys(padded, starts, done, n)
                    which, column = np.nonzero(by_key[(keys >> np.uint64(64 - _KEY_BITS)).astype(np.int64)])
                    hit_at.append(starts[which])
                    hit_keys.append(keys[which, column])
                    done = n
                for n in seed_sizes:
                    starts = np.flatnonzero(seeded[n] & inside)
                    for _, keys in span_keys(padded, starts, [n], 0):
                        which = by_key[(keys >> np.uint64(64 - _KEY_BITS)).astype(np.int64)]
                        hit_at.append(starts[which])
                        hit_keys.append(keys[which])
                hit_at, hit_keys = np.concatenate([whole_words[:0], *hit_at]), np.concatenate([np.empty(0, np.uint64), *hit_keys])
                # The stretches that some hit lies in, and their distinct keys.
                stretch = np.searchsorted(edge[:, 0], hit_at, side="right") - 1
                rows, texts, places, hits = [], [], [], []
                for e in np.unique(stretch):
                    mine = stretch == e
                    lo, hi = at[edge[e, 0]], at[edge[e, 1] - 1] + 1
                    row = int(np.searchsorted(ends, lo, side="right")) - 1
                    rows.append(row)
                    texts.append(data[lo:hi].tobytes())
                    places.append(int((data[ends[row]:lo] & 0xC0 != 0x80).sum()))
                    hits.append(np.unique(hit_keys[mine]).view(np.int64).tolist())
                # Words that are an item are rows of their own, each the first of its document.
                for n, keys in span_keys(padded, whole_words, word_sizes, 1):
                    which = by_key[(keys >> np.uint64(64 - _KEY_BITS)).astype(np.int64)]
                    which &= (padded[whole_words + n] == 32) | (padded[whole_words + n] == 0)
                    row = np.searchsorted(ends, at[whole_words[which]], side="right") - 1
                    _, first = np.unique(np.stack([row.astype(np.uint64), keys[which]]), axis=1, return_index=True)
                    for w in np.flatnonzero(which)[first].tolist():
                        lo, hi = at[whole_words[w]], at[whole_words[w] + n - 1] + 1
                        rows.append(int(np.searchsorted(ends, lo, side="right")) - 1)
                        texts.append(data[lo:hi].tobytes())
                        places.append(int((data[ends[rows[-1]]:lo] & 0xC0 != 0x80).sum()))
                        hits.append(keys[w:w + 1].view(np.int64).tolist())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(rows, pa.int32())), pa.array(texts, pa.binary()), pa.array(places, pa.int64()),
                     pa.array(hits, pa.list_(pa.int64()))], ["doc", "piece", "place", "keys"])

    rows = docs.select(F.col(key).alias("doc"), "text")
    doc_kind = rows.schema["doc"].dataType.simpleString()
    # A row of ``docs`` may have several stretches; ``row`` tells rows apart that share a key.
    rows = rows.withColumn("doc", F.struct(F.monotonically_increasing_id().alias("row"), "doc"))
    found = mapped(rows, stretches, f"doc struct<row:bigint,doc:{doc_kind}>, piece binary, place long, keys array<long>")
    found = written(found.withColumn("id", F.monotonically_increasing_id()), "stretches")
    pairs = found.select("id", F.explode("keys").alias("key")).join(item_keys, "key").select("id", "no").distinct()
    pairs = pairs.join(found.select("id", "doc", "piece", "place"), "id").join(known.select("no", "item", "norm"), "no")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, out = [], []
            for i, (piece, place, norm) in enumerate(zip(*(b.column(c).to_pylist() for c in (1, 2, 3)), strict=True)):
                own = np.frombuffer(piece, np.uint8)
                data, at = normalise(own)
                if not edits(len(norm)) and data.tobytes() != norm:
                    continue
                q, want = gram_size(len(norm)), np.frombuffer(norm, np.uint8)
                # The lemma once more, for this item alone: most pairs that met by chance end here.
                if edits(len(norm)) and np.isin(_grams(want, q), _grams(data, q)).sum() < len(norm) - q + 1 - q * edits(len(norm)):
                    continue
                distance, first, last = nearest_piece(norm, data.tobytes())
                if distance <= edits(len(norm)) and last > first:
                    letters = np.cumsum(own & 0xC0 != 0x80)
                    keep.append(i)
                    out.append((distance, place + int(letters[at[first]]) - 1, place + int(letters[at[last - 1]])))
            picked = pa.array(keep, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(picked), b.column(4).take(picked), b.column(5).take(picked),
                 *(pa.array([x[c] for x in out], pa.int64()) for c in range(3))], ["doc", "no", "item", "distance", "start", "end"])

    checked = mapped(
        pairs.select("doc", "piece", "place", "norm", "no", "item"),
        verify, f"doc struct<row:bigint,doc:{doc_kind}>, no long, item {kind}, distance long, start long, end long")
    best = checked.groupBy("doc", "no").agg(
        F.first("item").alias("item"), F.min(F.struct("distance", "start", "end")).alias("b"))
    return best.select(F.col("doc.doc").alias(key), F.col("item").alias(item), "b.distance", "b.start", "b.end")


def without_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, all columns, whose key no leak has; rows with a null key stay."""
    leaks = written(find_leaks(docs, items, key).select(F.col(key).alias("key_")).distinct(), "leaks")
    return docs.join(leaks, docs[key] == leaks["key_"], "left_anti")


def query(spark, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
