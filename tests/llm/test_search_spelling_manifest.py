"""Exact search, spelling variants and the manifest against brute force: nulls, ties, repeated rows, empty tables, extra columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from railgrain.llm import manifest, spelling, vector_search

# -- 11: exact search --------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, score string, cls string"


def brute_top(rows, k):
    clean = [(i, [int(256 * x // 1) for x in v]) for i, v in rows
             if v is not None and all(x is not None and abs(x) < float("inf") for x in v)]
    out = Counter()
    for a, (q, x) in enumerate(clean):
        if q is None or q % 50:
            continue
        found = [(-sum(s * t for s, t in zip(x, y)), i is None, i) for b, (i, y) in enumerate(clean) if b != a and len(x) == len(y)]
        for rank, (score, _, i) in enumerate(sorted(found, key=lambda f: (f[0], f[1], f[2] or 0))[:k], 1):
            out[q, rank, i, -score] += 1
    return out


def search(spark, rows, **options):
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], VECTORS)
    found = vector_search.top_k(df, "vec_id", "embedding", F.col("vec_id") % 50 == 0, **options)
    return Counter(map(tuple, found.select("query_id", "rank", "vec_id", "score").collect()))


@pytest.mark.parametrize("block, bits", [(1_024, 6), (16, 2)])  # small blocks and coarse cells: many rounds of reading
def test_search_equals_brute_force(spark, monkeypatch, block, bits):
    monkeypatch.setattr(vector_search, "BLOCK", block)
    monkeypatch.setattr(vector_search, "QUERIES", 4)
    rng = random.Random(3)
    # quarters are exact in 32 bits, so the brute force sees the same numbers
    rows = [(i, [rng.randrange(-40, 40) / 64 for _ in range(6)]) for i in range(300)]
    rows += [(1_000 + i, [0.25] * 6) for i in range(60)]  # equal vectors, some of them queries
    rows += [(50, rows[50][1]), (50, rows[51][1]), (None, [0.25] * 6), (None, rows[7][1])]  # repeated keys and null keys
    rows += [(2_000, None), (2_050, [0.5, None] * 3), (2_100, [float("nan")] * 6), (2_150, [float("inf")] * 6), (2_200, []), (2_201, [])]
    rows += [(3_000, [0.5, 0.25]), (3_001, [0.25, 0.5]), (4_000, [1.0])]  # other lengths, and a query without candidates
    assert search(spark, rows, bits=bits) == brute_top(rows, 5)


def test_search_with_few_rows_and_none(spark):
    rows = [(0, [1.0, 0.0]), (50, [1.0, 0.0]), (3, [0.0, 1.0])]
    assert search(spark, rows) == brute_top(rows, 5)
    assert search(spark, []) == Counter()
    assert search(spark, [(1, [1.0])]) == Counter()


def test_large_components_saturate(spark):
    got = search(spark, [(0, [1e30, -1e30]), (1, [1e30, 1.0])])
    assert got == Counter({(0, 1, 1, 2 ** 40 - 256 * 2 ** 20): 1})


# -- 12: spelling ------------------------------------------------------------------------------------


def near(a, b):
    cuts = lambda w: {(i, w[:i] + w[i + 1:]) for i in range(len(w))}
    if len(a) == len(b):
        return a != b and bool(cuts(a) & cuts(b))
    return abs(len(a) - len(b)) == 1 and min(a, b, key=len) in {c for _, c in cuts(max(a, b, key=len))}


def brute_variants(counts):
    form, out = {}, {}
    for w, n in counts.items():
        them = [v for v in counts if near(w, v)]
        best = min(them, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * n else None
        out[w] = len(them)
    def root(w):
        return w if form[w] is None else root(form[w])
    return {(w, form[w], root(w), n, out[w], counts.get(form[w])) for w, n in counts.items()}


def alter(rng, word, letters):
    i = rng.randrange(len(word) + 1)
    kind = rng.randrange(3)
    if kind == 0:
        return word[:i] + rng.choice(letters) + word[i:]
    i = min(i, len(word) - 1)
    return word[:i] + (rng.choice(letters) if kind == 1 else "") + word[i + 1:]


def vocabulary(rng, n, letters):
    words = set()
    for _ in range(n):
        word = "".join(rng.choice(letters) for _ in range(rng.randrange(6, 11)))
        words |= {word, alter(rng, word, letters), alter(rng, alter(rng, word, letters), letters)}
    return sorted(w for w in words if len(w) >= 6)


@pytest.mark.parametrize("letters, frequent", [("ab", 1 << 13), ("ab", 8), ("aeinrsté", 1 << 13), ("aeinrstéß", 40)])
def test_near_words_equal_brute_force(spark, letters, frequent):
    rng = random.Random(len(letters) + frequent)
    words = vocabulary(rng, 150, letters)
    df = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    grams = spelling.gram_dictionary(df, frequent=frequent)
    got = Counter(frozenset((r.a, r.b)) for r in spelling.near_words(df, grams).collect())
    assert got == Counter({frozenset((a, b)): 1 for a in words for b in words if a < b and near(a, b)})


@pytest.mark.parametrize("letters", ["ab", "abcdé"])
def test_affected_gram_bound_holds(letters):
    rng = random.Random(9)
    for _ in range(300):
        longer = {}
        for _ in range(rng.randrange(30)):  # closed under prefixes, as grown dictionaries are
            g = "".join(rng.choice(letters + "^$"[:rng.randrange(3)]) for _ in range(4))
            longer |= {g[:3]: 1, g: 1}
        grams = spelling.Grams(longer, {})
        word = "".join(rng.choice(letters) for _ in range(rng.randrange(2, 12)))
        s = spelling.padded(word)
        own = grams.decompose(s)
        bound = grams.affected(s, own)
        for _ in range(40):
            other = alter(rng, word, letters + "z")
            t = spelling.padded(other)
            shift = len(t) - len(s)
            theirs = Counter((t[p:e + 1], p) for p, e in grams.decompose(t))
            shared = sum(bool(theirs[s[p:e + 1], p] or theirs[s[p:e + 1], p + shift]) for p, e in own)
            assert shared >= len(own) - bound, (word, other, longer)


def test_variants_of_texts(spark, documents):
    rng = random.Random(4)
    words = vocabulary(rng, 40, "abcdeé")
    body = [" ".join(rng.choice(words[:40] + words[:6] * 20) for _ in range(300)) for _ in range(30)]
    texts = [*enumerate(body), (3, body[3].upper()), (None, body[2]), (90, None), (91, ""), (92, "12 -- 34"), (93, "x" * 50_000),
             (94, "Ünïcödé÷word×pair " * 6), (94, "Ünïcödé÷word×pair " * 6), (95, "éÉéÉéÉé " * 5)]
    counts = Counter()
    for doc, text in texts:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            counts[run if h % 199 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    got = spelling.variants(spelling.count_words(documents(*texts))).collect()
    assert {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == brute_variants(counts) and len(got) == len(counts)
    assert any(r.form for r in got)


def test_roots_follow_long_chains(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(11)], "word string, form string")
    assert {r.root for r in spelling.roots(forms).collect()} == {"w11"}


def test_variants_of_nothing(spark, documents):
    assert spelling.variants(spelling.count_words(documents("x").where("false"))).count() == 0


# -- 13: manifest ------------------------------------------------------------------------------------


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def brute_manifest(rows):
    """Rows of (doc_id, source, lang, n_chars, text) to result rows, by whole levels."""
    def leaf(*values):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def up(level):
        levels = [level]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][i:i + 2])) for i in range(0, len(levels[-1]), 2)])
        return levels

    def siblings(levels, i):
        out = []
        for level in levels[:-1]:
            out.append((i & 1, level[i ^ 1] if i ^ 1 < len(level) else ""))
            i >>= 1
        return out

    trees = defaultdict(list)
    for r in rows:
        hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
        changed = leaf(*r[:3], None if r[3] is None else r[3] + 1, r[4]) if hit else None
        trees[r[2]].append((r[0], leaf(*r), changed))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for t in trees.values():
        t.sort(key=lambda x: (x[0] is not None, x[0], x[1]) if x[0] is not None else (False, 0, x[1]))
    levels = {x: up([r[1] for r in trees[x]]) for x in langs}
    top = up([levels[x][-1][0] for x in langs])
    root, out = top[-1][0] if langs else None, Counter()
    for j, x in enumerate(langs):
        for i, (doc, own, changed) in enumerate(trees[x]):
            path = siblings(levels[x], i) + siblings(top, j)
            digest = changed or own
            for right, s in path:
                digest = sha(s + digest if right else digest + s)
            out[doc, own, levels[x][-1][0], root, sha("".join(s for _, s in path)), digest, digest == root] += 1
    return out


@pytest.mark.parametrize("bits", [1, 2, 12])
def test_manifest_equals_brute_force(spark, monkeypatch, tmp_path, bits):
    monkeypatch.setattr(manifest, "BITS", bits)
    rng = random.Random(bits)
    rows = [(i, f"s{i % 3}", rng.choice(["en", "en", "en", "de", "ß", "", None]), i, f"text {i} é") for i in range(90)]
    rows += [(100, "s", "solo", 1, "alone"), (101, None, None, None, None), (None, "s", "en", 3, ""), (None, "s", "en", 4, ""),
             (5, "s", "en", 9, "same key"), (5, "s", "en", 9, "same key"), (7, "s", "en", -1, "x" * 200_000), (8, "a:b", "en", 1, "-")]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    df = df.selectExpr("*", "'clash' as key_", "'clash' as tree", "'clash' as digest")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = manifest.query(spark, str(tmp_path))
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(map(tuple, got.select(columns).collect())) == brute_manifest(rows)


def test_manifest_of_many_trees_and_of_none(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(manifest, "BITS", 2)
    rows = [(i, "s", f"l{i % 37}", i, "t") for i in range(80)]
    columns = "doc_id long, source string, lang string, n_chars long, text string"
    spark.createDataFrame(rows, columns).write.parquet(str(tmp_path / "a/documents.parquet"))
    got = manifest.query(spark, str(tmp_path / "a"))
    assert Counter(map(tuple, got.collect())) == brute_manifest(rows)
    assert got.where("verified").count() == sum(n for r, n in brute_manifest(rows).items() if r[-1])
    spark.createDataFrame([], columns).write.parquet(str(tmp_path / "b/documents.parquet"))
    assert manifest.query(spark, str(tmp_path / "b")).count() == 0
