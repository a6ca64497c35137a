"""Spelling variants by a variable-length gram index: words that differ by one code point, and the form each stands for.

A dictionary of grams is grown from the words: all grams of QMIN code points, and a longer one where the gram it extends is
frequent (pruned by frequency, so that no list of the index is long).  A word is decomposed from left to right into the
longest dictionary grams that no earlier gram covers.  For every word the number of its grams that any one edit can
affect is worked out (its affected-gram bound): grams over the edit, grams before it that the dictionary might extend
through it, and grams that such an extension would cover.  Words one edit apart share all others, at a place shifted by the
edit at most, so a word is filed under its rarest grams, one more than the bound; lists are merged by gram, length and
place, and the pairs that meet are verified.  Words whose bound leaves no gram are compared with each other by grams of
QMIN alone, of which one edit affects two at most.

A word's form is its near word of most occurrences where these are FACTOR times its own; roots follow forms by pointer
doubling.  Counts come from all texts, reduced in tasks before they are shuffled.  Null texts and texts without letters have no words; repeated rows count
again; a null key is written as nothing in the tampering rule.  An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table, written

LEAST_LENGTH, LEAST_COUNT, FACTOR = 6, 5, 5
QMIN, QMAX = 2, 4
#: A gram is extended if it has more than this share of all grams of its length: at most so many grams are.
FREQUENT = 1 << 13
#: Distinct words a task counts before it hands them on.
_HELD = 200_000
_RUN = re.compile("[A-Za-zÀ-ÿ]+")


def _lower(text: str) -> str:
    """A-Z in lower case, nothing else."""
    return text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text", one_in: int = 199, least_length: int = LEAST_LENGTH,
                least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): letter runs of all texts; where ``one_in`` divides the crc32 of key and run, the run has lost a letter."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

        for whole in batches:
            for b in slices(whole, 1, 1 << 23):
                for doc, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    if not body:
                        continue
                    head = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                    for run, n in Counter(_RUN.findall(_lower(body))).items():
                        h = zlib.crc32(run.encode(), head)
                        if not h % one_in:
                            at = h % len(run)
                            run = run[:at] + run[at + 1:]
                        if len(run) >= least_length:
                            seen[run] += n
                    if len(seen) >= _HELD:
                        yield out()
                        seen.clear()
        if seen:
            yield out()

    found = docs.select(F.col(key).cast("string"), F.col(text)).mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# -- grams -------------------------------------------------------------------------------------------


def padded(word: str) -> str:
    return f"^{word}$"


class Grams:
    """A gram dictionary: how frequent grams are, and what a gram with one unknown letter can be."""

    def __init__(self, longer: dict[str, int], frequency: dict[str, int], qmax: int = QMAX):
        self.longer, self.frequency, self.qmax = longer, frequency, qmax
        self.known = set(longer)
        for g in longer:
            self.known.update(f"{g[:i]}?{g[i + 1:]}" for i in range(len(g)))

    def decompose(self, s: str) -> list[tuple[int, int]]:
        """First and last place of each gram of the padded word ``s``."""
        out, covered = [], -1
        for p in range(len(s) - QMIN + 1):
            q = QMIN
            for m in range(self.qmax, QMIN, -1):
                if p + m <= len(s) and s[p:p + m] in self.longer:
                    q = m
                    break
            if p + q - 1 > covered:
                covered = p + q - 1
                out.append((p, covered))
        return out

    def _lost(self, grams: list[tuple[int, int]], t: str, i: int, first: int, shift: int) -> int:
        """Grams an edit can affect.  ``t`` is the edited word, the edit at place i ('?' a letter not known); grams
        from ``first`` on lie after the edit and are moved by ``shift``."""
        own = t[i:i + 1] == "?"  # a letter at i is new, so grams may begin there
        opened, reach = len(t), i
        for p in range(max(0, i - self.qmax + 1), i + own):
            for m in range(self.qmax, QMIN - 1, -1):
                if i < p + m <= len(t) and (m == QMIN or t[p:p + m] in self.known):
                    if p < i - QMIN + 1:
                        opened = min(opened, p)
                    reach = max(reach, p + m - 1)
                    break
        lost = 0
        for p, e in grams:
            if e < i:
                lost += p >= opened
            elif p >= first:
                lost += e + shift <= reach
            else:
                lost += 1
        return lost

    def affected(self, s: str, grams: list[tuple[int, int]]) -> int:
        """The most grams of ``s`` that one inserted, deleted or replaced letter can affect."""
        most = 0
        for i in range(1, len(s)):
            most = max(most, self._lost(grams, f"{s[:i]}?{s[i:]}", i, i, 1))
            if i < len(s) - 1:
                most = max(most, self._lost(grams, f"{s[:i]}?{s[i + 1:]}", i, i + 1, 0),
                           self._lost(grams, s[:i] + s[i + 1:], i, i + 1, -1))
        return most

    def filed(self, word: str) -> tuple[list[tuple[str, int]], bool]:
        """Grams and places that a word is filed under, rarest first, and whether its bound leaves any gram."""
        s = padded(word)
        grams = self.decompose(s)
        bound = self.affected(s, grams)
        rare = sorted((self.frequency.get(s[p:e + 1], 0), s[p:e + 1], p) for p, e in grams)
        return [(g, p) for _, g, p in rare[:bound + 1]], bound < len(grams)


def gram_dictionary(words: DataFrame, qmax: int = QMAX, frequent: int = FREQUENT) -> Grams:
    """The dictionary of ``words``, on the driver: its size has a bound whatever the number of words.

    All grams of QMIN letters of an alphabet of 92 are at most 8,464.  A longer one extends a gram that has more than one in
    ``frequent`` of all occurrences, of which there are fewer than ``frequent``, by one of 92 letters; that twice for QMAX = 4.
    """
    spark, s = words.sparkSession, F.concat(F.lit("^"), "word", F.lit("$"))
    at = lambda q: F.explode(F.transform(F.sequence(F.lit(1), F.length(s) - (q - 1)), lambda p: s.substr(p, F.lit(q)))).alias("gram")
    frequency, longer, prefixes = {}, {}, None
    for q in range(QMIN, qmax + 1):
        found = words.where(F.length("word") + 2 >= q).select(at(q))
        if prefixes is not None:
            if not prefixes:
                break
            kept = spark.createDataFrame([(p,) for p in prefixes], "prefix string")
            found = found.withColumn("prefix", F.substring("gram", 1, q - 1)).join(F.broadcast(kept), "prefix", "left_semi")
        counted = {r["gram"]: r["count"] for r in found.groupBy("gram").count().collect()}
        frequency |= counted
        longer |= counted if q > QMIN else {}
        least = max(32, -(-sum(counted.values()) // frequent)) if prefixes is None else least
        prefixes = [g for g, n in counted.items() if n > least and not g.endswith("$")]
    return Grams(longer, frequency, qmax)


# -- near words --------------------------------------------------------------------------------------


def _merged(filed: DataFrame) -> DataFrame:
    """Near pairs (a, b) of filed words.  Of equal lengths, places of a shared gram are equal; a longer word's are equal or one more."""
    size = F.length("word")
    own = filed.select("word", "n", "gram", size.alias("size"), "place")
    longer = own.select(F.col("word").alias("b"), F.col("n").alias("n_b"), "gram", F.col("size") - 1, F.explode(
        F.array(F.col("place"), F.col("place") - 1)).alias("place"))
    same = own.select(F.col("word").alias("b"), F.col("n").alias("n_b"), "gram", "size", "place")
    right = same.toDF("b", "n_b", "gram", "size", "place").unionByName(longer.toDF("b", "n_b", "gram", "size", "place"))
    left = own.toDF("a", "n_a", "gram", "size", "place")
    pairs = left.join(right, ["gram", "size", "place"]).where(
        ((F.length("a") < F.length("b")) | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1))
    return pairs.select("a", "n_a", "b", "n_b").distinct()


def near_words(words: DataFrame, grams: Grams) -> DataFrame:
    """(a, n_a, b, n_b): all pairs of words that differ by one inserted, deleted or replaced code point, once each."""
    kept = words.sparkSession.sparkContext.broadcast((grams.longer, grams.frequency, grams.qmax))

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Grams(*kept.value)
        plain = Grams({}, index.frequency, QMIN)
        for b in batches:
            out: list[tuple[str, int, str, int, bool]] = []
            for word, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                places, bounded = index.filed(word)
                out += [(word, n, g, p, False) for g, p in places]
                if not bounded:
                    out += [(word, n, g, p, True) for g, p in plain.filed(word)[0]]
            columns = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (
                pa.string(), pa.int64(), pa.string(), pa.int32(), pa.bool_()), strict=True)], ["word", "n", "gram", "place", "plain"])

    filed = written(words.select("word", "n").mapInArrow(file, "word string, n long, gram string, place int, plain boolean"), "grams")
    return _merged(filed.where("not plain")).unionByName(_merged(filed.where("plain"))).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, form) to (word, root) by pointer doubling; forms occur ever more often, so there is no cycle."""
    chain = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = chain.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = written(chain.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                                F.col("further").isNotNull().alias("moved")), "roots")
        chain = step.select("word", "root")
        if step.where("moved").isEmpty():
            return chain


def variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """(word, n) to word, form, root, n, n_near, form_n."""
    words = written(words, "words")
    pairs = written(near_words(words, gram_dictionary(words)), "near")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("n_b").alias("n_a"), F.col("a").alias("b"), F.col("n_a").alias("n_b")))
    best = both.groupBy("a").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("form"))).alias("best"))
    found = words.join(best.withColumnRenamed("a", "word"), "word", "left")
    form_n = -F.col("best.less")
    chosen = form_n >= factor * F.col("n")
    found = written(found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                 F.when(chosen, F.col("best.form")).alias("form"), F.when(chosen, form_n).alias("form_n")), "forms")
    ends = roots(found.where("form is not null"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(count_words(table(spark, sf_dir, "documents")))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_CRC = """xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(range(0, octet_length(encode(k)) * 2, 2),
    lambda i: ('0x' || substr(hex(encode(k)), i + 1, 2))::UBIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
    lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (x & 1)) + y)), 4294967295::UBIGINT)"""

SQL = rf"""
with recursive docs as (
    select row_number() over () as id, doc_id, text from documents where text is not null
), runs as (
    select id, doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) as run from docs
), hashed as (
    select run, c, {_CRC} as h from (select run, count(*) as c, coalesce(doc_id::varchar, '') || ':' || run as k from runs group by id, doc_id, run)
), words as (
    select word, sum(c)::bigint as n
    from (select case when h % 199 = 0 then left(run, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word, c from hashed)
    where length(word) >= {LEAST_LENGTH} group by word having sum(c) >= {LEAST_COUNT}
), cuts as (
    select distinct word, n, i, left(word, i::int) || substr(word, i::int + 2) as cut from (select word, n, unnest(range(length(word))) as i from words)
), pairs as (
    select c.word as a, c.n as n_a, w.word as b, w.n as n_b from cuts c join words w on w.word = c.cut
    union select w.word, w.n, c.word, c.n from cuts c join words w on w.word = c.cut
    union select x.word, x.n, y.word, y.n from cuts x join cuts y on x.cut = y.cut and x.i = y.i and x.word <> y.word
), ranked as (
    select *, count(*) over (partition by a) as n_near, row_number() over (partition by a order by n_b desc, encode(b)) as r from pairs
), forms as (
    select w.word, w.n, coalesce(p.n_near, 0) as n_near, case when p.n_b >= {FACTOR} * w.n then p.b end as form,
        case when p.n_b >= {FACTOR} * w.n then p.n_b end as form_n
    from words w left join ranked p on p.a = w.word and p.r = 1
), follow as (
    select word, word as root, form as further, 0 as step from forms
    union all
    select f.word, f.further, g.form, f.step + 1 from follow f join forms g on g.word = f.further
)
select f.word, f.form, r.root, f.n, f.n_near, f.form_n from forms f join follow r on r.word = f.word and r.further is null
"""
