"""Operators against brute force on small tables, nulls, empty and very long texts, ties, repeated rows and empty tables."""

import hashlib
import itertools
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from railgrain.llm import (chat, common, components, decontaminate, hilbert, host_rules, jaccard, mixing, pages, suffix_dedup,
                           token_store, toxicity)

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WORD = re.compile("[^\x20\x09-\x0D]+")


def odd_rows(rng, prose):
    """Nulls, blanks, repeated rows, equal keys, a very long text, non-ASCII and NUL."""
    text = prose(rng, 80)
    return [(0, text, "s1"), (0, text, "s1"), (0, prose(rng, 30), None), (1, None, None), (None, text, "s1"), (None, None, None),
            (2, "", "s2"), (3, " \n\t ", "s2"), (4, "Ünïcode \x00 nul", "s2"), (5, prose(rng, 20_000), "s1"), (6, "word", "s3")]


# -- 1: tokens ---------------------------------------------------------------------------------------


def test_token_store_round_trip(spark, tmp_path, documents, prose):
    rows = odd_rows(random.Random(1), prose)
    docs = documents(*rows)
    path = str(tmp_path / "t")
    token_store.write_tokens(docs, path)
    tokenizer = token_store.Encoder(token_store.tokenizer_path()).tokenizer
    want = Counter((d, tuple([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0])) for d, t, _ in rows)
    got = token_store.read_tokens(spark, path).orderBy("start").collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == want
    assert [r.doc_id for r in got] == sorted((d for d, *_ in rows), key=lambda d: (d is not None, d))
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(len(got))]
    some = token_store.read_tokens(spark, path, got[3].start, got[5].start).orderBy("start").collect()
    assert [r.start for r in some] == [r.start for r in got[3:5]]
    total = got[-1].start + got[-1].n_tokens
    for first, last in [(0, total), (0, 1), (total - 1, total), (5, 5), (total, total + 9), *([random.Random(2).randrange(total) for _ in range(2)] for _ in range(3))]:
        part = token_store.read_tokens(spark, path, min(first, last), max(first, last)).collect()
        first, last = min(first, last), max(first, last)
        assert sorted(r.start for r in part) == [r.start for r in got if first < last and r.start < last and r.start + r.n_tokens > first]
    text = spark._jvm.PythonSQLUtils.explainString(token_store.read_tokens(spark, path, got[3].start, got[5].start)._jdf.queryExecution(), "formatted")
    assert re.search(r"PushedFilters: .*run_,.*local_start,", text)
    crc = {r.start: r.ids_crc32 for r in token_store.with_crc32(token_store.read_tokens(spark, path)).collect()}
    assert crc == {r.start: zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got}
    plan = token_store.read_tokens(spark, path).where("doc_id = 3").select("doc_id", "n_tokens")
    text = spark._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "formatted")
    assert "EqualTo(doc_id,3)" in text and "ids" not in text


def test_token_store_of_nothing(spark, documents):
    assert token_store.digest(spark, documents("x").where("false")).count() == 0


# -- 2: near copies ----------------------------------------------------------------------------------


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(rows):
    sets = [shingles(t) for _, t, *_ in rows]
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = defaultdict(list)
    for (d, *_), x in zip(rows, label):
        least[x] += [d] if d is not None else []
    return [(d, len(s), min(least[x], default=None) if s else d) for (d, *_), x, s in zip(rows, label, sets)]


@pytest.mark.parametrize("few", [jaccard.FEW, 0])  # 0: rounds against one set of each group first
def test_jaccard_components(spark, documents, prose, monkeypatch, few):
    monkeypatch.setattr(jaccard, "FEW", few)
    rng = random.Random(7)
    rows = odd_rows(rng, prose)
    passage = prose(rng, 40)
    for family in range(6):  # chains of near copies, around a passage that all families share
        words = (prose(rng, 90) + " " + passage).split()
        for _ in range(14):
            rows.append((len(rows) + 100, " ".join(words), "s1"))
            for _ in range(rng.randint(1, 3)):
                words[rng.randrange(len(words))] = rng.choice("abcdefgh") * 3
    got = jaccard.join_components(documents(*rows)).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=key) == sorted(brute_components(rows), key=key)


def test_one_of_each_keeps_all_columns(spark, documents, prose):
    rng = random.Random(8)
    rows = odd_rows(rng, prose)
    docs = documents(*rows)
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    # The text of key 0 is also under a null key; that copy, and one of two equal rows, go.
    assert Counter(r.doc_id for r in kept.collect()) == Counter([0, 0, 1, None, 2, 3, 4, 5, 6])
    assert jaccard.join_components(docs.where("false")).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1200)] + [(7, 7), (300, 299), (299, 300)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 1000 for i in range(1000, 1200)}, 299: 299, 300: 299}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("few", [jaccard.FEW, 0])
def test_texts_of_shared_passages_make_no_pairs(spark, documents, prose, monkeypatch, few):
    """Every shingle is common, so sets meet early in every order, but two texts share two passages of three at most."""
    monkeypatch.setattr(jaccard, "FEW", few)
    seen, links = [], jaccard._links
    monkeypatch.setattr(jaccard, "_links", lambda pairs, sets: seen.append(pairs.count()) or links(pairs, sets))
    rng = random.Random(8)
    passages = [prose(rng, 40) for _ in range(7)]
    texts = [" ".join(x) for x in itertools.combinations(passages, 3)]
    near = texts[0].rsplit(" ", 2)[0] + " other end"
    got = {r["doc_id"]: r["component_id"] for r in jaccard.join_components(documents(*texts, near)).collect()}
    assert got == {i: i for i in range(len(texts))} | {len(texts): 0}
    assert 1 <= sum(seen) <= 3


def test_a_group_of_few_links_each_becomes_one_component_before_all_pairs(spark, documents, prose, monkeypatch):
    """All members share most of their shingles, but are linked only to those of which four variants at most differ."""
    monkeypatch.setattr(jaccard, "FEW", 0)
    seen, links = [], jaccard._links
    monkeypatch.setattr(jaccard, "_links", lambda pairs, sets: seen.append(pairs.count()) or links(pairs, sets))
    rng = random.Random(12)
    base, rows = prose(rng, 200).split(), []
    for i in range(300):
        words = list(base)
        for place in range(6, 198, 12):
            words[place] = rng.choice(("north", "south"))
        rows.append((i, " ".join(words)))
    got = {r["doc_id"]: r["component_id"] for r in jaccard.join_components(documents(*rows)).collect()}
    want = {r[0]: r[2] for r in brute_components(rows)}
    linked = Counter(want.values()).most_common(1)[0][1]
    assert got == want and linked > 250 and seen[2] < 1500


def test_parities_of_long_sets_are_not_carried(spark, documents, prose):
    rng = random.Random(13)
    texts = [prose(rng, n) for n in (90, 90, 900, 900)]
    rows = [(i, t) for i, t in enumerate([x + end for x in texts for end in ("", " and one end more")])]
    lookups = jaccard._prepared(documents(*rows), "doc_id")[-1].collect()
    assert {r["n"] > 512 for r in lookups} == {False, True}
    assert all(any(r[p] for p in jaccard._PARITIES) == (r["n"] <= 512) for r in lookups)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.join_components(documents(*rows)).collect()}
    assert got == {i: i - i % 2 for i in range(8)}


def test_all_links_inside_components_too(spark, documents, prose):
    rng = random.Random(21)
    rows = odd_rows(rng, prose)
    for i in range(8):
        words = prose(rng, 60).split()
        for j in range(5):  # a group of near copies, each linked to several others, and one exact copy
            x = list(words)
            x[3 + 2 * j] = f"new{j}"
            rows.append((100 + 10 * i + j, " ".join(x)))
        rows.append((100 + 10 * i + 9, " ".join(words).upper()))
        rows.append((100 + 10 * i + 8, " ".join(words)))
    links, members = jaccard.all_links(documents(*rows))
    members = members.collect()
    assert Counter(r.doc_id for r in members) == Counter(r[0] for r in rows)
    texts, sets = {r[0]: r[1] for r in rows if r[0] is not None and r[0] >= 100}, {}
    for r in members:
        if r.doc_id in texts:
            w = texts[r.doc_id].lower().split()
            sets[r["class"]] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
            assert r.n_copies == (2 if r.doc_id % 10 >= 8 else 1)
    want = {}
    for a in sets:
        for b in sets:
            both, union = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if a < b and 100 * both >= jaccard.SHARE * union:
                want[a, b] = both, union
    got = [r for r in links.collect() if r.a in sets and r.b in sets]
    assert len(want) > 8 * 5 and len(got) == len(want) and {(r.a, r.b): (r.intersection, r.union) for r in got} == want


# -- 3: host rules -----------------------------------------------------------------------------------


def brute_counts(text):
    words, lines = WORD.findall(text or ""), [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if grams[tuple(words[i:i + 8])] > 1 for k in range(8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_rules_and_hosts(spark, documents, prose):
    rng = random.Random(9)
    rows = odd_rows(rng, prose)
    line = prose(rng, 12)
    rows += [(50 + i, "\n".join([line, prose(rng, 9), line, "#$ <x>", "", line]), "s4") for i in range(4)]
    rows += [(100 + i, "too short", "bad") for i in range(30)] + [(200, prose(rng, 50), "bad")]
    rows += [(300 + i, prose(rng, 60), "good") for i in range(30)]
    got = host_rules.apply_rules(documents(*rows)).collect()
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert Counter((r.doc_id, *(r[c] for c in columns)) for r in got) == Counter((d, *brute_counts(t)) for d, t, _ in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed and r.host_ok)
        assert r.host_ok == (r.rate_short <= 0.5 and r.rate_repeats <= 0.5)
    by = {(r.source, r.host_ok) for r in got}
    assert ("bad", False) in by and ("good", True) in by
    assert host_rules.apply_rules(documents("x").where("false")).count() == 0


def test_counts_have_no_python(spark, documents):
    df = host_rules.counts(documents("a b"), "doc_id")
    assert "EvalPython" not in spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


# -- 4: repeated strings -----------------------------------------------------------------------------


def brute_removal(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(t[i:i + 200] for t in data for i in range(len(t) - 199))
    out = []
    for t in data:
        gone = bytearray(len(t))
        for i in range(len(t) - 199):
            if seen[t[i:i + 200]] > 1:
                gone[i:i + 200] = b"\1" * 200
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(t)))
        out.append((len(t), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(t, gone) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("crowd", [suffix_dedup.CROWD, 1])  # 1: every shared minimizer is counted window by window
def test_repeated_strings_go(spark, documents, prose, monkeypatch, crowd):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 1 << 14)
    rng = random.Random(10)
    rows = [r for r in odd_rows(rng, prose) if r[0] != 5]
    passages = [prose(rng, n) for n in (25, 34, 60, 300)]
    for i in range(40):
        parts = [prose(rng, rng.randint(1, 60)) for _ in range(3)]
        rows.append((100 + i, rng.choice(passages).join(parts), "s"))
    rows += [(200, "ab" * 700, "s"), (201, "z" * 199, "s"), (202, "z" * 200, "s"), (203, "q" * 201, "s"), (204, passages[3], "s")]
    docs = documents(*rows)
    got = suffix_dedup.remove_repeats(docs).collect()
    found = [(r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), len(r.removed), hashlib.sha256(r.kept).hexdigest()) for r in got]
    want = [(d, *w) for (d, *_), w in zip(rows, brute_removal([t for _, t, *_ in rows]))]
    assert Counter(found) == Counter(want)
    assert suffix_dedup.remove_repeats(docs.where("false")).count() == 0


# -- 5: shards ---------------------------------------------------------------------------------------


def test_shards_hold_every_row_once(spark, tmp_path, documents, prose):
    rng = random.Random(11)
    docs = documents(*odd_rows(rng, prose), *[(7, "same", "s1")] * 40, *[(100 + i, prose(rng, 5), f"s{i % 5}") for i in range(50)])
    docs = docs.selectExpr("*", "1 as shard", "2 as curve_")
    path = str(tmp_path / "s")
    hilbert.write_shards(docs, ["lang", "source", "n_chars"], ["doc_id", "text"], path, 7)
    back = hilbert.read_shards(spark, path, docs.schema)
    rows = back.collect()
    plain = [c for c in docs.columns if c not in hilbert.OWN]
    assert Counter(tuple(r[c] for c in plain) for r in rows) == Counter(map(tuple, docs.select(plain).collect()))
    sizes = Counter(r.shard for r in rows)
    assert set(sizes) == set(range(7)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r.slot_ for r in rows if r.shard == shard) == list(range(n))
    ordered = sorted(rows, key=lambda r: (r.shard, r.slot_))
    assert [r.curve_ for r in ordered] == sorted(r.curve_ for r in rows)


def test_strings_with_one_beginning_have_cells_of_their_own(spark):
    hosts = [f"https://common-crawl.example/{i}" for i in range(8)] + ["é", "e", ""]
    rows = [(h, float(n)) for h in hosts for n in range(64)] + [(hosts[0], 1.0)] * 500 + [(None, 3.0), (hosts[1], None)]
    df = spark.createDataFrame(rows, "host string, n double")
    assert [c.decode() for c in hilbert._byte_cuts(df, "host", 32)] == sorted(hosts, key=str.encode)[1:]
    alone = hilbert.with_curve(df, ["host"]).select("host", "curve_").distinct().where("host is not null").collect()
    assert [r.host for r in sorted(alone, key=lambda r: r.curve_)] == sorted(hosts, key=str.encode)
    assert len({r.curve_ for r in alone}) == len(hosts)
    assert hilbert._byte_cuts(df.where("false"), "host", 32) == [] and hilbert.with_curve(df.where("false"), ["host", "n"]).count() == 0


def test_cuts_of_many_values_are_even_and_the_same(spark, monkeypatch):
    monkeypatch.setattr(hilbert, "DISTINCT", 500)
    df = spark.range(5000).selectExpr("concat('prefix-of-all/', lpad(id, 6, '0')) as path", "id % 2 = 0 as flag")
    cuts = hilbert._byte_cuts(df, "path", 32)
    assert len(cuts) == 31 and cuts == hilbert._byte_cuts(df.repartition(7, "path"), "path", 32)
    cells = [r["count"] for r in hilbert.with_curve(df, ["path"]).groupBy("curve_").count().collect()]
    assert len(cells) == 32 and max(cells) < 3 * 5000 / 32
    assert hilbert.with_curve(df, ["path", "flag"]).select("curve_").distinct().count() == 64


def test_file_statistics_prune_by_either_dimension(spark, tmp_path):
    docs = spark.range(6000).selectExpr("id as doc_id", "concat('common-crawl-', id % 8) as source", "(id * 7919) % 6000 as n_chars")
    path = str(tmp_path / "s")
    hilbert.write_shards(docs, ["source", "n_chars"], ["doc_id"], path, 24)
    box = hilbert.read_shards(spark, path, docs.schema).groupBy("shard").agg(
        F.min("source").alias("a"), F.max("source").alias("b"), F.min("n_chars").alias("c"), F.max("n_chars").alias("d")).collect()
    by_source = [sum(r.a <= f"common-crawl-{i}" <= r.b for r in box) for i in range(8)]
    by_size = [sum(r.c <= n <= r.d for r in box) for n in range(0, 6000, 100)]
    assert max(by_source) <= 12 and sum(by_size) / len(by_size) <= 12


# -- 6: chats ----------------------------------------------------------------------------------------


def test_events_fold_to_final_messages(spark):
    e = [(1, 1, 0, "user", "message", "hi"), (1, 2, 1, "assistant", "message", ""), (1, 3, 1, None, "delta", "Hel"),
         (1, 4, 1, None, "delta", "lo"), (1, 5, 2, "user", None, "more"), (1, 6, 3, "assistant", "message", "a"),
         (1, 7, 3, "assistant", "regenerate", "b"), (1, 8, 3, None, "delta", "c"),
         (2, 1, 0, "user", "message", "one"), (2, 2, 1, "assistant", "message", "two"), (2, 3, 0, "user", "edit", "ONE"),
         (2, 4, 1, "assistant", "message", "TWO"), (None, 1, None, None, None, None)]
    got = chat.fold_events(spark.createDataFrame(e, chat.EVENTS)).collect()
    assert sorted(((r.conv_id, r.turn, r.role, r.text) for r in got), key=str) == sorted([
        (1, 0, "user", "hi"), (1, 1, "assistant", "Hello"), (1, 2, "user", "more"), (1, 3, "assistant", "bc"),
        (2, 0, "user", "ONE"), (2, 1, "assistant", "TWO"), (None, None, None, "")], key=str)


def test_chats_round_trip(spark):
    said = ["", None, "plain", "<turn assistant>x</turn>", "\\l \\b \\\\ </turn", "a<b>c\\", "🙂\n\ttabs", "x" * 100_000]
    rows = [(c, t, r, said[(c + t) % len(said)]) for c in range(9) for t, r in enumerate(["system", "user", "assistant", "<odd>", None])]
    rows += rows[:3]  # repeated rows are turns of their own
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as seq", "2 as kind")
    back = chat.parse(chat.format_chats(chat.events_of(df))).collect()
    want = defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda r: (r[0], r[1], r[2] or "", r[3] or "")):
        want[c].append((r or "", x or "", r == "assistant"))
    assert {r.conv_id: [tuple(t) for t in r.turns] for r in back} == want
    assert all(r.formatted.count("</turn>") == len(r.turns) for r in back)
    assert chat.format_chats(chat.events_of(df.where("false"))).count() == 0


# -- 7: pages ----------------------------------------------------------------------------------------


def test_page_differencing(spark):
    frame = "<body><div>Home page</div><div>All topics</div>{}<div>Written by us</div></body>".format
    rows = [(1, "http://a.com/x/1", frame("<p>one</p><p>two</p>")), (2, "http://a.com/x/2", frame("<p>three</p>")),
            (3, "http://b.com/x/1", frame("<p>alone</p>")), (4, None, None), (5, "http://[bad", ""),
            (6, "http://a.com/x/3", "<article><p>Home page</p><p>z</p></article><div>Home page</div>"),
            (7, "http://c.com/1", frame("<p>copy</p>")), (8, "http://c.com/1", frame("<p>copy</p>"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'clash' as lines", "1 as id", "2 as rank")
    got = {r.page_id: (r.lines, r.n_shared) for r in pages.extract(df).collect()}
    full = lambda x: ["Home page", "All topics", x, "Written by us"]
    assert got == {1: (["one", "two"], 3), 2: (["three"], 3), 3: (full("alone"), 0), 4: ([], 0), 5: ([], 0),
                   6: (["Home page", "z"], 0), 7: (full("copy"), 0), 8: (full("copy"), 0)}
    assert pages.extract(df.where("false")).count() == 0


def test_pages_with_little_text_and_copies_lose_their_frame(spark):
    frame = ["Home page", "All topics", "Imprint", "Contact us", "All rights reserved"]
    page = lambda *own: "<body>" + "".join(f"<div>{x}</div>" for x in frame + list(own)) + "</body>"
    want = {(1, i): [f"news {i}"] for i in range(5)}  # one own line each
    want |= {(2, i): ["a first line", "a second line"] for i in range(3)} | {(2, 3): ["another page"]}  # three copies in a row
    # Twenty near copies in a row, on a host with many other pages.
    text = [f"line {i}" for i in range(40)]
    want |= {(3, i): text + [f"visited {i} times"] for i in range(20)} | {(3, i): [f"own {i}"] for i in range(20, 100)}
    want |= {(4, 0): ["only one"], (4, 1): ["and two"]}
    rows = [(1000 * h + i, f"http://h{h}.com/x/{i:03}", page(*own)) for (h, i), own in want.items()]
    # A host of copies alone keeps all, and so does one whose one page is a piece of the other.
    rows += [(5000 + i, f"http://h5.com/{i}", page("same")) for i in range(4)]
    rows += [(6000, "http://h6.com/0", page()), (6001, "http://h6.com/1", page("and more"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {(r.page_id // 1000, r.page_id % 1000): (r.lines, r.n_shared) for r in pages.extract(df).collect()}
    assert {k: got[k] for k in want} == {k: (v, 5) for k, v in want.items()}
    assert all(got[5, i] == (frame + ["same"], 0) for i in range(4)) and got[6, 0] == (frame, 0)


def test_marked_articles_lose_what_their_neighbours_repeat(spark):
    page = "<body><div>Home</div><main><p>Please sign up</p><p>{}</p><p>Please pay</p></main></body>".format
    rows = [(i, f"http://a.com/{i}", page(f"text {i}")) for i in range(5)] + [(9, "http://a.com/2b", "<div>Home</div><p>Please pay</p>")]
    got = {r.page_id: (r.lines, r.n_shared) for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: ([f"text {i}"], 2) for i in range(5)} | {9: (["Home", "Please pay"], 0)}


def test_marked_articles_keep_what_only_few_share(spark):
    page = "<body><main><h1>News</h1><p>{}</p><p>{}</p></main></body>".format
    rows = [(1, "http://two.com/1", page("a", "same end")), (2, "http://two.com/2", page("b", "same end"))]
    rows += [(10 + i, f"http://ten.com/{i}", page(f"text {i}", "same end" if i in (4, 5) else f"end {i}")) for i in range(10)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert all(r.n_shared == 0 and r.lines[0] == "News" and len(r.lines) == 3 for r in pages.extract(df).collect())


def test_no_heading_or_rare_line_of_a_given_article_goes(spark):
    df = common.table(spark, SF_DIR, "pages")
    read = {r.page_id: (pages._split_url(r.url)[0], *pages.read_page(r.html or "")) for r in df.collect()}
    different = {(host, tuple(lines)) for host, lines, marked, _ in read.values() if marked}
    on = Counter((host, x) for host, lines in different for x in set(lines))
    for r in pages.extract(df).collect():
        host, lines, marked, headings = read[r.page_id]
        left = Counter(lines) - Counter(r.lines)
        assert not Counter(r.lines) - Counter(lines) and len(lines) - len(r.lines) == r.n_shared
        assert not marked or all(on[host, x] >= 3 for x in left) and not left & Counter(x for x, h in zip(lines, headings) if h)


# -- 8: benchmark items ------------------------------------------------------------------------------


def test_leaks_are_found_with_edits_and_nothing_else(spark, documents, prose):
    rng = random.Random(12)
    items = [(i, prose(rng, rng.randint(12, 60))) for i in range(12)] + [(90, None), (91, "short"), (92, "")]
    rows, planted = odd_rows(rng, prose), set()
    for i in range(60):
        text = prose(rng, 150)
        if i % 2:
            item, passage = rng.choice(items[:12])
            x = list(passage.upper() if i % 3 == 0 else passage)
            for _ in range(rng.randint(0, int(0.04 * len(x)))):
                x[rng.randrange(len(x))] = rng.choice("abcz")
            text = prose(rng, 40) + "  \n" + "".join(x).replace(" ", rng.choice([" ", "\n", ", "])) + ". " + text
            planted.add((100 + i, item))
        rows.append((100 + i, text, "s"))
    docs = documents(*rows)
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'clash' as norm", "3 as no")
    got = decontaminate.find_leaks(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == planted and len(got) == len(planted)
    texts, wanted = {d: t for d, t, _ in rows}, dict(items)
    flat = lambda t: decontaminate.normalise(np.frombuffer(t.encode(), np.uint8))[0].tobytes()
    for r in got:
        piece = texts[r.doc_id][r.start:r.end]
        assert abs(len(flat(piece)) - len(flat(wanted[r.item_id]))) <= r.distance
        assert decontaminate.nearest_piece(flat(wanted[r.item_id]), flat(piece))[0] == r.distance
    left = decontaminate.without_leaks(docs, bench)
    assert left.columns == docs.columns and left.count() == len(rows) - len(planted)
    assert decontaminate.find_leaks(docs, bench.where("false")).count() == 0
    assert decontaminate.find_leaks(docs.where("false"), bench).count() == 0


@pytest.mark.parametrize("sizes", [range(50, 75), range(75, 112), range(112, 168)])
def test_leaks_with_edits_far_apart_are_found_at_every_size(spark, documents, sizes):
    rng = random.Random(13)
    letters = lambda n: "".join(rng.choice("etaoinshrdlucmfwypvbgk") for _ in range(n))
    prose = lambda n: " ".join(letters(rng.randint(2, 7)) for _ in range(n))[:n].rstrip()
    items = [(n, (prose(4 * n)[:n - 1] + "e").replace("  ", " a")) for n in sizes]
    rows = []
    for n, item in items:
        x, e = list(item), decontaminate.edits(n)
        for i in range(e):
            x[int((i + 0.5) * n / e)] = "0"
        rows.append((n, f"{prose(90)} {''.join(x)} {prose(90)}"))
    got = decontaminate.find_leaks(documents(*rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} >= {(n, n) for n in sizes}


def test_leaks_of_short_items_and_of_items_without_blanks_are_found(spark, documents):
    rng = random.Random(14)
    letters = lambda n: "".join(rng.choice("etaoinshrdlucmfwypvbgk") for _ in range(n))
    prose = lambda n: " ".join(letters(rng.randint(2, 7)) for _ in range(n))
    cut = lambda n: (prose(n)[:n - 1] + "e").replace(" e", "ae")
    items = [(n + 1000 * k, cut(n)) for n in range(6, 80) for k in range(3)] + [(5000, letters(90)), (5001, "é" + letters(60))]
    rows, planted = [], set()
    for i, (no, item) in enumerate(items):
        x, e = list(item), decontaminate.edits(len(item.encode()))
        # Edited, at a document's end, in front of other documents' beginnings; unedited; glued to a word, if edits are allowed.
        for place in sorted((int((j + 0.5) * len(item) / e) for j in range(e)), reverse=True):
            x[place:place + 1] = rng.choice(["", "0", "0" + x[place]])
        for k, text in enumerate((f"{prose(30)} {''.join(x)}", f"{item.upper()}, {prose(30)}", f"{prose(3)} {'q' * (e > 0)}{item}!")):
            rows.append((3 * i + k, text))
            planted.add((3 * i + k, no))
    rows.append((-1, f"{prose(5)} q{items[0][1]} {items[1][1]}q"))  # no whole words
    docs, bench = documents(*rows), spark.createDataFrame(items + [(-2, "?!"), (-3, None)], "item_id long, text string")
    got = decontaminate.find_leaks(docs, bench).collect()
    missed = planted - {(r.doc_id, r.item_id) for r in got}
    assert {i for _, i in missed if i % 1000 < decontaminate.LEAST or i >= 5000} == set() and len(missed) <= 0.01 * len(planted)
    assert len(got) == len({(r.doc_id, r.item_id) for r in got}) and not {r for r in got if r.doc_id == -1}
    texts, wanted = dict(rows), dict(items)
    flat = lambda t: decontaminate.normalise(np.frombuffer(t.encode(), np.uint8))[0].tobytes()
    for r in got:
        piece = texts[r.doc_id][r.start:r.end]
        assert decontaminate.nearest_piece(flat(wanted[r.item_id]), flat(piece))[0] == r.distance <= decontaminate.edits(len(flat(wanted[r.item_id])))


# -- 9: mixing ---------------------------------------------------------------------------------------


def brute_targets(sizes, share=1.5, limit=2.0):
    sources = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    total, full = share * sum(sizes.values()), set()
    while True:
        rest = {s for s in sources if s not in full}
        left = total - sum(limit * sizes[s] for s in full)
        aim = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = {s for s in rest if aim[s] > limit * sizes[s] + 1e-9}
        if not over:
            return {**{s: limit * sizes[s] for s in full}, **aim}
        full |= over


def test_mix_meets_its_targets(spark, documents, prose):
    rng = random.Random(13)
    rows = [(i, prose(rng, rng.randint(1, 60)), rng.choice(["a", "b", "b", "b", "c", "d", None, "é"])) for i in range(700)]
    rows += [(5000, None, "a"), (5001, "", "zero"), (5002, prose(rng, 10), "b")] + [(6000, "same words here", "c")] * 9
    docs = documents(*rows)
    got = mixing.mix(docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(d for d, *_ in rows)
    size = defaultdict(int)
    for _, t, s in rows:
        size[s] += len(WORD.findall(t or ""))
    aims, taken = brute_targets(size), defaultdict(int)
    for r in got:
        assert r.source_size == size[r.source] and abs(r.target - aims[r.source]) < 1e-6
        assert 0 <= r.copies <= 2
        taken[r.source] += r.size * r.copies
    for s in size:
        assert abs(taken[s] - aims[s]) <= 60, s  # one document
    again = mixing.mix(docs.repartition(5)).collect()
    rows_of = lambda x: Counter((r.doc_id, r.source, r.size, r.copies) for r in x)
    assert rows_of(got) == rows_of(again)
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    want = Counter()
    for r in got:
        want[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in mixed.select("doc_id").collect()) == +want
    assert mixing.mix(docs.where("false")).count() == mixing.mixed(docs.where("false")).count() == 0


def test_mixed_rows_are_the_same_again(spark):
    rows = [(1, "one text of some words", "a", i, {"k": i}) for i in range(40)] + [(2, "more words here " * 40, "b", 0, None)]
    runs = []
    for n in (1, 7):
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string, other long, more map<string,int>").repartition(n)
        runs.append(Counter((r.doc_id, r.other) for r in mixing.mixed(docs).collect()))
    assert runs[0] == runs[1] and runs[0]


def test_rounding_keeps_means(spark):
    units = spark.range(300).selectExpr("id as u", "-id as v", "'s' as source", "cast(5 + id % 7 as double) as s", "0.3d as p")
    taken = [sum(r.copy for r in mixing.round_copies(units, seed).collect()) for seed in range(3)]
    first = [{r.u for r in mixing.round_copies(units, seed).where("copy = 1").collect()} for seed in range(2)]
    assert all(80 <= n <= 100 for n in taken) and first[0] != first[1]


# -- 10: toxicity ------------------------------------------------------------------------------------


def test_toxicity_held_out(spark, documents, prose):
    rng = random.Random(14)
    rows, labels = [], []
    for i in range(400):
        words = prose(rng, rng.randint(30, 80)).split()
        toxic = rng.random() < 0.25
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(["Nasty", "VILE", "rottenest", "rotteners"])
        rows.append((i, " ".join(words), "s"))
        labels.append((i, int(toxic)))
    rows += [(None, "nasty vile", "s"), (900, None, "s"), (901, "", "s"), (902, "nasty " * 50_000, "s"), (7, rows[7][1], "s")]
    known = spark.createDataFrame([x for x in labels if x[0] % 5] + [(None, 1), (3, None), (777, 1)], "doc_id long, toxic int")
    known = known.selectExpr("*", "'clash' as text", "1 as score")
    got = toxicity.classify(documents(*rows), known).collect()
    assert Counter(r.doc_id for r in got) == Counter(d for d, *_ in rows)
    by = {r.doc_id: r for r in got}
    held = [(by[i], y) for i, y in labels if i % 5 == 0]
    assert sum(r.predicted == y for r, y in held) >= 0.97 * len(held)
    assert by[902].predicted == 1 and by[None].predicted == 1 and by[900].predicted == by[901].predicted == 0
    assert all(0 <= r.score <= 1 for r in got) and all(dict(labels)[e] for r in got for e in r.evidence if e < 400)


def test_toxicity_without_examples(spark, documents):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [(r.score, r.predicted) for r in toxicity.classify(documents("a", "b"), none).collect()] == [(0.0, 0)] * 2
    one = spark.createDataFrame([(0, 0)], "doc_id long, toxic int")
    assert toxicity.classify(documents("a", "b"), one).where("predicted = 0").count() == 2
    assert toxicity.classify(documents("a").where("false"), one).count() == 0


def test_written_tables_take_empty_and_null(spark):
    df = spark.createDataFrame([(None, [1]), (2, None)], "a long, b array<long>")
    assert sorted(map(str, common.written(df, "t").collect())) == sorted(map(str, df.collect()))
