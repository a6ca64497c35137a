"""Token-id output: whole texts encoded, written as Parquet lists in key order, and read back, all or in part.

A store is two Parquet tables below one path.

``tokens``: one row per document, ascending by key over all files: key, run_ (the file's place in the order), local_start
(ids of the run before the document), n_tokens, ids (list of 32-bit ids, end id included).  Ids are dictionary encoded
while a row group's dictionary holds (bit-packed, as few bits as its ids need) and plain or delta encoded beyond that;
the long columns are delta encoded.  Row groups are about ``ROW_GROUP`` bytes and have column and page indexes, so a
filter on the key or on local_start skips row groups and pages, and metadata is read without touching ids.

``runs``: one row per run: run_, base (ids of all runs before it), n (its ids).  A document's place in the whole is base + local_start.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import lists, mapped, once_per_process, parts, save, slices, table, text_bytes

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
ROW_GROUP = 32 << 20
#: Distinct pieces of text whose ids a worker process keeps, about 80 MB; it encodes others in each slice that has them.
CACHE = 400_000
#: Bytes of the longest piece that is kept.
LONGEST = 64
#: Bytes of text that are cut and looked up together: the more there are, the more often a piece is one of them already.
SLICE = 4 << 20

_BLANK, _LETTER, _STOP = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_BLANK[[10, 32]] = True
_LETTER[65:91] = _LETTER[97:123] = True
_STOP[list(b",.;:!?")] = True
#: All other white space.
_ODD_SPACE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
_ODD_ASCII = [c for c in _ODD_SPACE if c.isascii()]
_FORMAT = {
    "parquet.block.size": str(ROW_GROUP), "parquet.page.size": str(1 << 20), "parquet.writer.version": "v2",
    "parquet.enable.dictionary": "true", "parquet.dictionary.page.size": str(1 << 20),
    "parquet.enable.dictionary#local_start": "false", "parquet.enable.dictionary#n_tokens": "false",
}


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def piece_starts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where pieces begin in texts without white space other than blanks and line feeds.

    A piece begins where the tokenizer's own pattern begins a new one whatever follows or precedes, so encoding the pieces is
    encoding the text: at each run of white space, at its last character if text follows, after that character if it is a
    line feed, and after the letters (of Latin-1) that a word begins with if one of ``,.;:!?`` follows them.
    """
    begin = np.zeros(len(data) + 1, bool)
    begin[ends] = True
    new = begin[:-1]
    blank, letter = _BLANK[data], _LETTER[data]
    at = np.flatnonzero(data[:-1] == 0xC3)
    at = at[(data[at + 1] != 0x97) & (data[at + 1] != 0xB7)]
    letter[at] = letter[at + 1] = True

    def back(x: np.ndarray) -> np.ndarray:
        """``x`` of the byte in front, which is False at a text's first."""
        out = np.zeros_like(x)
        out[1:] = x[:-1]
        return out & ~new

    after_blank = back(blank)
    out = new | (blank & ~after_blank)
    word = after_blank & ~blank
    out[:-1] |= word[1:]
    out |= word & back(data == 10)
    first = np.flatnonzero(letter & ~back(letter))
    last = letter.copy()
    last[:-1] &= ~letter[1:] | new[1:]
    after = np.flatnonzero(last) + 1
    after = after[(new | after_blank)[first]]
    after = after[~begin[after]]
    out[after[_STOP[data[after]]]] = True
    return np.flatnonzero(out)


class Encoder:
    """Ids of whole texts; pieces seen before are looked up."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.known = Tokenizer.from_file(path), {}
        # The tokenizer cuts these out before it looks at anything else.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _whole(self, text: str) -> bool:
        # Looking for single characters is much faster than a pattern.
        return any(c in text for c in (_ODD_ASCII if text.isascii() else _ODD_SPACE)) or any(t in text for t in self.added)

    def _ids(self, pieces: list[bytes]) -> list[bytes]:
        got = list(map(self.known.get, pieces))
        new = [i for i, g in enumerate(got) if g is None]
        # One call for all that is new, because a call costs as much as several pieces.
        found = self.tokenizer.encode_batch_fast([pieces[i].decode() for i in new], add_special_tokens=False)
        for i, x in zip(new, found, strict=True):
            ids = got[i] = array("i", x.ids).tobytes()
            if len(self.known) < CACHE and len(pieces[i]) <= LONGEST:
                self.known[pieces[i]] = ids
        return got

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows, one after the other, and the places where rows begin (one more than rows); nulls are empty."""
        data, ends = text_bytes(texts)
        starts = piece_starts(data, ends)
        # A text that can't be cut is a piece.
        whole = np.array([bool(t) and self._whole(t) for t in texts.to_pylist()], bool)
        if whole.any():
            row = np.searchsorted(ends, starts, side="right") - 1
            starts = starts[~whole[row] | (starts == ends[row])]
        offsets = np.append(starts, len(data))
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        pieces = pieces.dictionary_encode()
        _, at, raw = pieces.dictionary.buffers()
        at, raw = np.frombuffer(at, np.int64, len(pieces.dictionary) + 1).tolist(), raw.to_pybytes() if raw else b""
        found = self._ids([raw[i:j] for i, j in zip(at[:-1], at[1:], strict=True)])
        which, rows = pieces.indices.to_numpy(), np.searchsorted(starts, ends)
        if end_id is not None:
            which, rows = np.insert(which, rows[1:], len(found)), rows + np.arange(len(rows))
            found.append(array("i", [end_id]).tobytes())
        flat = np.frombuffer(b"".join(found), np.int32)
        length = np.fromiter(map(len, found), np.int64, len(found)) // 4
        begin = np.cumsum(length) - length
        n = length[which]
        to = np.concatenate([[0], np.cumsum(n)])
        return flat[np.repeat(begin[which] - to[:-1], n) + np.arange(to[-1])], to[rows]

    def ids(self, texts: list[str]) -> list[bytes]:
        ids, at = self.encode(pa.array(texts, pa.string()))
        return [ids[i:j].astype("<i4", copy=False).tobytes() for i, j in zip(at[:-1], at[1:], strict=True)]


def write_tokens(docs: DataFrame, path: str, key: str = "doc_id", tokenizer: str | None = None, end_id: int = END_ID) -> None:
    """Encode ``text`` of all rows of ``docs`` and write a store at ``path``.

    Null texts are empty: the end id alone.  Rows with equal or null keys stay, in order of a hash of their text, nulls
    first.  Columns other than key and ``text`` are left out.  ``tokenizer`` is a file that every executor can read.
    """
    spark, file = docs.sparkSession, tokenizer or tokenizer_path()
    rows = docs.select(F.col(key).alias("key_"), "text", F.xxhash64("text").alias("tie_"))
    rows = rows.repartitionByRange(parts(spark), "key_", "tie_").sortWithinPartitions("key_", "tie_")
    rows = rows.select("key_", "text", F.spark_partition_id().alias("run_"))
    kind = rows.schema["key_"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = once_per_process(f"encoder {file}", lambda: Encoder(file))
        before = 0
        for whole in batches:
            for b in slices(whole, 1, SLICE):
                ids, at = encoder.encode(b.column(1), end_id)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(2), pa.array(before + at[:-1]), pa.array(np.diff(at)), lists(ids, at)],
                    ["key_", "run_", "local_start", "n_tokens", "ids"])
                before += int(at[-1])

    encoded = mapped(rows, encode, f"key_ {kind}, run_ int, local_start long, n_tokens long, ids array<int>", keep=f"encoder {file}")
    save(encoded.withColumnRenamed("key_", key), f"{path}/tokens", **_FORMAT)
    lengths = spark.read.parquet(f"{path}/tokens").groupBy("run_").agg(F.sum("n_tokens").alias("n"))
    ahead = Window.orderBy("run_").rowsBetween(Window.unboundedPreceding, -1)
    save(lengths.select("run_", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"), "n").coalesce(1), f"{path}/runs")


def read_tokens(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Documents of a store with ``start``; with ``first`` and ``last``, those that hold any id from first up to last.

    Select the columns you need: ids are read only if they are selected.  Filters on the key reach the scan.  A range is
    first resolved on the runs, a few rows, to whole runs and places in the two runs at its ends; these are literals of
    the scan, so files, row groups and pages beyond the range are not read.
    """
    runs = spark.read.parquet(f"{path}/runs")
    tokens = spark.read.parquet(f"{path}/tokens")
    if first is not None or last is not None:
        first, last = first or 0, (1 << 62) if last is None else last
        # As many rows as the store has files in the range.
        held = runs.where((F.col("base") < last) & (F.col("base") + F.col("n") > first)).orderBy("run_").collect() if first < last else []
        if not held:
            return _placed(tokens.where("false"), runs)
        tokens = tokens.where(F.col("run_").between(held[0]["run_"], held[-1]["run_"]))
        begin, end = first - held[0]["base"], last - held[-1]["base"]
        # A document that begins before the range may reach into it; it is the last that begins so early.
        before = tokens.where((F.col("run_") == held[0]["run_"]) & (F.col("local_start") <= begin)).agg(F.max("local_start")).first()[0]
        tokens = tokens.where((F.col("run_") > held[0]["run_"]) | (F.col("local_start") >= (before or 0)))
        tokens = tokens.where((F.col("run_") < held[-1]["run_"]) | (F.col("local_start") < end))
    return _placed(tokens, runs)


def _placed(tokens: DataFrame, runs: DataFrame) -> DataFrame:
    # One row for each file of the store.
    out = tokens.join(F.broadcast(runs.drop("n")), "run_")
    return out.withColumn("start", F.col("base") + F.col("local_start")).drop("run_", "base", "local_start")


def with_crc32(tokens: DataFrame) -> DataFrame:
    """``ids`` replaced by ids_crc32, the unsigned crc32 of the ids as little-endian 32-bit numbers."""
    names = [c for c in tokens.columns if c != "ids"]
    schema = ", ".join(f"`{c}` {tokens.schema[c].dataType.simpleString()}" for c in names)

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(b.num_columns - 1)
            values = np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False))
            at = ids.offsets.to_numpy()
            sums = [zlib.crc32(values[i:j]) for i, j in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(sums, pa.int64())], [*names, "ids_crc32"])

    return mapped(tokens.select(*names, "ids"), crc, f"{schema}, ids_crc32 long")


def digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    path = scratch_path(spark, "tokens")
    write_tokens(docs, path)
    return with_crc32(read_tokens(spark, path).select("doc_id", "start", "n_tokens", "ids"))


def query(spark, sf_dir: str) -> DataFrame:
    return digest(spark, table(spark, sf_dir, "documents"))
