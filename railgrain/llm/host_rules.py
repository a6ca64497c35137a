"""Quality rules of documents, and verdicts on their hosts from how often the rules fail there.

DataFrame functions only.  The text is read once; what the rules need of it is a handful of counts, which are written
and read back for the two passes that follow (rates by host, and the join of verdicts to documents).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, written

#: Words in a window; a window that occurs twice in a text marks its words as repeated.
WINDOW = 8
#: A host is rejected where the shrunk rate of some rule's failures is above this.
MAX_RATE = 0.5
SYMBOLS = "#*$%&|<>"

#: Rules by name; each is a condition over the columns of :func:`counts` that is true where a document fails.
RULES: dict[str, Column | str] = {
    "short": "n_words < 20",
    "repeats": "100 * n_repeat_words > 30 * n_words",
}


def counts(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of every whole ``text``.

    A null or blank text has no words and counts 0 everywhere.  Rows are neither merged nor dropped.
    """
    text = F.coalesce("text", F.lit(""))
    base = docs.select(
        *keep,
        F.array_remove(F.split(text, f"{SPACE}+"), "").alias("words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE[1:]}")).alias("lines"),
        F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    windows = F.when(
        F.size("words") >= WINDOW,
        F.transform(F.sequence(F.lit(1), F.size("words") - (WINDOW - 1)),
                    lambda i: F.xxhash64(F.slice("words", i, WINDOW))))
    base = base.select(
        *keep, "word_chars", "n_symbols", F.size("words").cast("long").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("windows"))
    # Most texts repeat no window; only the others are sorted.
    base = base.withColumn("ranked", F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda x, j: F.get("ranked", j)["h"].eqNullSafe(x["h"])
    base = base.withColumn("at", F.sort_array(F.transform(
        F.filter("ranked", lambda x, j: same(x, j - 1) | same(x, j + 1)), lambda x: x["i"])))
    covered = F.aggregate(
        "at", F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda s, i: F.struct(i.alias("last"), (s["n"] + F.least(F.lit(WINDOW), i - s["last"])).alias("n")))["n"]
    return base.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def host_verdicts(failures: DataFrame, host: str, rules: list[str], max_rate: float = MAX_RATE) -> DataFrame:
    """One row per host: n_docs, a shrunk failure rate for each rule, and host_ok.

    A rule's prior is a beta distribution fitted to the rates of all hosts by moments: mean m, and strength
    m(1-m)/v - 1 between 1 and a million, where v is the variance of the rates less what chance alone gives.  A host's
    rate is the mean of its posterior, so that small hosts lean on the others.  A null host is a host of its own.
    """
    by = failures.groupBy(host).agg(
        F.count("*").alias("n_docs"), *(F.sum(F.col(r).cast("long")).alias(f"f_{r}") for r in rules))
    by = written(by, "hosts")
    moments = []
    for r in rules:
        rate = F.col(f"f_{r}") / F.col("n_docs")
        moments += [F.avg(rate).alias(f"m_{r}"), F.var_pop(rate).alias(f"v_{r}"),
                    F.avg(1 / F.col("n_docs")).alias(f"c_{r}")]
    prior = by.agg(*moments)
    for r in rules:
        m, spread = F.col(f"m_{r}"), F.col(f"m_{r}") * (1 - F.col(f"m_{r}"))
        between = F.greatest(F.col(f"v_{r}") - spread * F.col(f"c_{r}"), F.lit(1e-9))
        strength = F.least(F.greatest(spread / between - 1, F.lit(1.0)), F.lit(1e6))
        prior = prior.withColumns({f"a_{r}": m * strength, f"s_{r}": strength})
    # The prior is one row of an aggregate without keys.
    out = by.join(F.broadcast(prior), how="left", on=F.lit(True))
    for r in rules:
        out = out.withColumn(f"rate_{r}", (F.col(f"f_{r}") + F.col(f"a_{r}")) / (F.col("n_docs") + F.col(f"s_{r}")))
    worst = F.greatest(*(F.col(f"rate_{r}") for r in rules), F.lit(0.0))
    return out.select(host, "n_docs", *(f"rate_{r}" for r in rules), (worst <= max_rate).alias("host_ok"))


def apply_rules(docs: DataFrame, key: str = "doc_id", host: str = "source", max_rate: float = MAX_RATE) -> DataFrame:
    """One row per row of ``docs``: key, host, the counts, base_failed, host_ok, kept, and rates of the host.

    kept is false where a rule fails or the host is rejected.  Columns of ``docs`` other than key, host and ``text``
    are left out, so none can clash.  Repeated rows stay, and an empty table gives an empty result.
    """
    found = counts(docs.select(F.col(key).alias("k_"), F.col(host).alias("h_"), "text"), "k_", "h_")
    failed = found.select("*", *(F.expr(c).alias(r) if isinstance(c, str) else c.alias(r) for r, c in RULES.items()))
    failed = written(failed, "rules")
    rates = host_verdicts(failed, "h_", list(RULES), max_rate)
    rates = rates.withColumnRenamed("h_", "host_")
    joined = failed.join(rates, F.col("h_").eqNullSafe(F.col("host_")), "left")
    base_failed = F.expr(" or ".join(RULES))
    return joined.select(
        F.col("k_").alias(key), F.col("h_").alias(host), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", base_failed.alias("base_failed"), "host_ok",
        (~base_failed & F.col("host_ok")).alias("kept"), *(f"rate_{r}" for r in RULES))


def query(spark, sf_dir: str) -> DataFrame:
    return apply_rules(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


SQL = r"""
with w as (
  select doc_id, source, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
), c as (
  select *, len(words) as n_words,
         len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) -
         len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) as dl
  from w
), g as (
  select doc_id, i, list_aggregate(words[i:i + 7], 'string_agg', ' ') as g
  from (select doc_id, words, unnest(range(1, n_words - 6)) as i from c where n_words >= 8)
), r as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as n from g) where n >= 2
), p as (
  select doc_id, count(distinct i + k) as n from r, (select unnest(range(0, 8)) as k) group by doc_id
), b as (
  select c.doc_id, source, n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols, dl as n_dup_lines,
         coalesce(p.n, 0) as n_repeat_words,
         n_words < 20 as short, 100 * coalesce(p.n, 0) > 30 * n_words as repeats
  from c left join p on c.doc_id = p.doc_id
), h as (
  select source, count(*) as n, sum(short::int)::double as fs, sum(repeats::int)::double as fr from b group by source
), m as (
  select avg(fs / n) as ms, var_pop(fs / n) as vs, avg(fr / n) as mr, var_pop(fr / n) as vr, avg(1.0 / n) as c from h
), q as (
  select ms, mr, c,
    least(greatest(ms * (1 - ms) / greatest(vs - ms * (1 - ms) * c, 1e-9) - 1, 1), 1e6) as ss,
    least(greatest(mr * (1 - mr) / greatest(vr - mr * (1 - mr) * c, 1e-9) - 1, 1), 1e6) as sr from m
), v as (
  select source, (fs + ms * ss) / (n + ss) <= 0.5 and (fr + mr * sr) / (n + sr) <= 0.5 as ok from h, q
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short or repeats as base_failed,
       not (short or repeats) and ok as kept
from b join v on b.source is not distinct from v.source
"""
