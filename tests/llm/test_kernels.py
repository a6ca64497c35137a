"""Kernels that need no session, against plain versions of themselves."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from railgrain.llm import common, decontaminate, hilbert, jaccard, pages, suffix_dedup, token_store, toxicity


def edit_distance(p, t, anywhere):
    before = [0] * (len(t) + 1) if anywhere else list(range(len(t) + 1))
    for i, c in enumerate(p):
        now = [i + 1]
        for j, d in enumerate(t):
            now.append(min(before[j] + (c != d), before[j + 1] + 1, now[j] + 1))
        before = now
    return min(before) if anywhere else before[-1]


def test_words_and_span_hashes():
    texts = ["a b\x0bab", None, "", " a b ", "é  é"]
    data, ends = common.text_bytes(pa.array(texts))
    begin, end, row = common.word_spans(data, ends)
    found = [(int(r), bytes(data[b:e]).decode()) for b, e, r in zip(begin, end, row)]
    assert found == [(i, w) for i, t in enumerate(texts) for w in (t or "").split()]
    hashes = common.span_hashes(data, begin, end)
    assert len(set(hashes.tolist())) == len({w for _, w in found})
    assert bytes(common.lower_latin(np.frombuffer("ÀÞ×ßAZ".encode(), np.uint8))).decode() == "àþ×ßaz"


def test_slices_cover_a_batch_in_order():
    column = pa.array(["x" * n for n in (0, 5, 100, 0, 1, 300)] + [None])
    batch = pa.RecordBatch.from_arrays([column], ["t"])
    assert pa.concat_arrays([s.column(0) for s in common.slices(batch, 0, 10)]) == column
    assert list(common.slices(batch.slice(0, 0), 0)) == []


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_visits_every_cell_and_moves_one_step(dims, bits):
    points = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    place = hilbert.hilbert_index(points, bits)
    assert sorted(place.tolist()) == list(range(len(points)))
    path = points[np.argsort(place)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_suffix_array_and_repeats():
    rng = random.Random(4)
    for _ in range(150):
        letters = rng.choice([b"a", b"ab", b"abc", bytes(range(97, 110))])
        base = bytes(rng.choice(letters) for _ in range(rng.randint(1, 50)))
        pieces = []
        for _ in range(rng.randint(1, 7)):
            x = bytearray(base)
            for _ in range(rng.randint(0, 3)):
                x[rng.randrange(len(x))] = rng.choice(letters)
            pieces.append(bytes(x[rng.randint(0, 5) if len(x) > 6 else 0:]))
        block = suffix_dedup.Block(pieces)
        text = block.text.tobytes()
        ends = [i for i, c in enumerate(text) if c == 0]
        stop = lambda i: next(e for e in ends if e >= i)
        assert block.suffix_array().tolist() == sorted(range(len(text)), key=lambda i: (text[i:stop(i)], stop(i)))


def test_every_window_is_in_a_segment_that_depends_on_content_alone():
    rng = random.Random(1)
    text = bytes(rng.choice(b"abcde \n") for _ in range(3000)) + b"x" * 700
    moved = b"yy" * 31 + text
    filed = []
    for data, shift in ((text, 0), (moved, 62)):
        at, run, key = suffix_dedup.segments(np.frombuffer(data, np.uint8))
        assert at[0] == 0 and (at[1:] == at[:-1] + run[:-1]).all() and at[-1] + run[-1] == len(data) - 199
        filed.append({int(a) + i - shift: int(k) for a, r, k in zip(at, run, key) for i in range(r)})
    assert all(filed[1][i] == k for i, k in filed[0].items())


def test_edit_distance_and_pieces():
    rng = random.Random(2)
    for _ in range(400):
        p = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 12)))
        t = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 25)))
        d, a, e = decontaminate.nearest_piece(p, t)
        assert d == edit_distance(p, t, True) == edit_distance(p, t[a:e], False)


def test_walk_keys_reach_their_recall(prose):
    rng, hit, n = random.Random(3), 0, 150
    pad = np.zeros(decontaminate._PAD, np.uint8)
    for _ in range(n):
        a, _ = decontaminate.normalise(np.frombuffer(prose(rng, 30).encode(), np.uint8))
        x = bytearray(a.tobytes())
        for _ in range(decontaminate.edits(len(a))):
            at = rng.randrange(len(x))
            how = rng.random()
            x[at:at + (how < 0.6)] = b"" if how < 0.3 else bytes([rng.choice(b"abcxyz ")])
        b = np.frombuffer(bytes(x), np.uint8)
        keys = [set(decontaminate.walk_keys(np.concatenate([y, pad]), decontaminate.word_starts(y)).ravel().tolist()) for y in (a, b)]
        hit += bool(keys[0] & keys[1])
    assert hit >= 0.95 * n


def test_gram_size_keeps_enough_grams():
    for length in range(decontaminate.LEAST, 600):
        q = decontaminate.gram_size(length)
        assert length - q + 1 - q * decontaminate.edits(length) >= 1


@pytest.mark.parametrize("length", [50, 56, 62, 63, 70, 75, 87, 100, 150, 250])
def test_walks_reach_their_target_at_the_full_edit_rate(length):
    rng, n, hit = random.Random(length), 300, 0
    pad = np.zeros(decontaminate._PAD, np.uint8)
    prose = lambda n: " ".join("".join(rng.choice("etaoinshrdlucmfwypvbgk") for _ in range(rng.randint(2, 8)))
                               for _ in range(n))[:n - 1].rstrip().ljust(n, "e")
    for i in range(n):
        item = prose(length)
        x, e = list(item), decontaminate.edits(length)
        places = [int((j + 0.5) * length / e) for j in range(e)] if i % 2 else [rng.randrange(length - e) for _ in range(e)]
        for at in sorted(places, reverse=True):
            how = rng.random()
            x[at:at + (how < 0.66)] = "" if how < 0.33 else rng.choice("etaoinshrd lu")
        doc = np.frombuffer(f"{prose(60)} {''.join(x)} {prose(60)}".encode(), np.uint8)
        own, last = np.frombuffer(item.encode(), np.uint8), decontaminate.repeats(length)
        starts = decontaminate.word_starts(own)
        starts = starts[(starts == 0) | (starts + decontaminate.STEPS // 2 + 4 <= length)]
        keys = [set(decontaminate.walk_keys(np.concatenate([y, pad]), s, 0, last).ravel().tolist())
                for y, s in ((own, starts), (doc, decontaminate.word_starts(doc)))]
        hit += bool(keys[0] & keys[1])
    assert hit >= decontaminate.TARGET * n


def test_the_gram_bound_of_a_class_holds_at_each_of_its_sizes():
    rng = random.Random(5)
    for low in range(decontaminate.LEAST, 200):
        high = int(decontaminate.SPREAD * low)
        q = decontaminate.gram_size(low, high)
        bound = decontaminate.grams_shared(q, low, high)
        assert bound >= 1
        for n in range(low, high + 1, 1 if low < 80 else 7):
            a = np.array([rng.randrange(97, 123) for _ in range(n)], np.uint8)
            b, e = a.copy(), decontaminate.edits(n)
            b[[int((i + 0.5) * n / e) for i in range(e)]] = 48  # as far from each other as can be
            whole = [{bytes(x[i:i + q]) for i in range(n - q + 1)} for x in (a, b)]
            assert len(whole[0] & whole[1]) >= min(bound, len(whole[0]) - q * e) and n - q + 1 - q * e >= bound


def test_longest_common_subsequence():
    rng = random.Random(3)
    for _ in range(500):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(0, 9))] for _ in range(2))
        on = pages.shared(a, b)
        kept, rest = [x for x, o in zip(a, on) if o], iter(b)
        assert all(x in rest for x in kept)
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert len(kept) == best[-1][-1]


def test_pages_are_read_as_blocks():
    read = pages.lines_of
    assert read("") == ([], False)
    assert read("a &amp; b&nbsp;<b>c</b>\n d<br>e<p>f &lt;g") == (["a & b c d e", "f <g"], False)
    assert read('<nav>m<article><header><h1>T</h1></header><p>x<aside>s</aside>y</p><footer>f</footer>'
                '<section id="comments"><article>c</article></section></article>z') == (["T", "x", "y"], True)
    assert read('<body><div class="top-nav">n</div><p class=notice>n<p>d<ul><li>1<li>2</ul><form>f</form>'
                '<div class="user-comments"><p>c</div><script>var a="</p><p>";</script><!-- no -->t')[0] == ["d", "1", "2", "t"]
    assert read("<p>" * 3000 + "deep")[0] == ["deep"]


def test_pieces_encode_like_whole_texts():
    rng = random.Random(1)
    letters = " \n,.;:!?abÀ1'$²\t xz"
    texts = ["", "  ", " a  b\n\n c", "x\n\n\ny", "a\tb  c", "don't we'll  x's\n", "é è².3 Ⅷa", "\n", " \n x", "w,foo..'s <|endoftext|> a",
             "naïve x  ", "a\x1cb c", "汉字 かな,x ", "x̂y, z!?;;  \n"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    # Added tokens among anything, runs of blanks and line feeds around them included.
    pieces = ["<|endoftext|>", "\n\n", "  ", " ", "\n", "a", " b", "<", "|>", "endoftext", ".", "\t", "é", "\u3000"]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 12))) for _ in range(5000)]
    encoder = token_store.Encoder(token_store.tokenizer_path())
    want = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    for at in range(0, len(texts), 97):
        for text, w, got in zip(texts[at:], want[at:], encoder.ids(texts[at:at + 97])):
            assert got == np.array(w.ids, "<i4").tobytes(), text


def test_texts_of_a_batch_share_lookups():
    encoder = token_store.Encoder(token_store.tokenizer_path())
    asked, found = [], encoder._ids
    encoder._ids = lambda pieces: asked.append(len(pieces)) or found(pieces)
    texts = ["so it goes, " * 500, None, "", "\n", "so it goes, é\tx", "goes, so it"] * 20
    ids, at = encoder.encode(pa.array(texts), 0)
    assert asked == [9] and len(at) == len(texts) + 1
    for text, i, j in zip(texts, at[:-1], at[1:]):
        assert ids[i:j].tolist() == encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def test_tasks_drop_what_others_kept(spark):
    def hold(batches):
        common.once_per_process("held", lambda: [1])
        yield from batches

    def held(batches):
        import sys
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([int(hasattr(sys.modules.get("_railgrain_worker"), "held"))] * b.num_rows)], ["id"])

    rows = spark.range(0, 8, 1, 1)  # one task after the other, in one worker
    for keep in ("", "held"):
        assert common.mapped(rows, hold, "id long").count() == 8
        assert {r.id for r in common.mapped(rows, held, "id long", keep=keep).collect()} == {int(keep == "held")}


def test_long_pieces_are_not_kept():
    encoder = token_store.Encoder(token_store.tokenizer_path())
    encoder.ids(["a b\tc " + "x" * 2000, "word " + "y" * 2000])
    assert max(map(len, encoder.known)) <= token_store.LONGEST


def test_shingle_sets():
    texts = ["A b c d e F", "a b c d e f", "a b", "b a", "", None, " a\tb ", "x y z x y z x y z"]
    sets = jaccard.shingle_sets(*common.text_bytes(pa.array(texts)))
    assert [len(s) for s in sets] == [2, 2, 1, 1, 0, 0, 1, 3]
    assert (sets[0] == sets[1]).all() and sets[2] != sets[3] and sets[2] == sets[6]


def test_first_shingles_of_linked_sets_meet():
    rng = np.random.default_rng(5)
    for _ in range(300):
        n = int(rng.integers(1, 900))
        both = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        cut = int(rng.integers(0, n // 5 + 1))
        a = np.unique(np.concatenate([both, rng.integers(0, 1 << 63, int(rng.integers(0, cut + 1)), dtype=np.uint64)]))
        b = np.unique(both[: n - cut] if n > cut else both)
        common_ = len(np.intersect1d(a, b))
        on = 100 * common_ >= 80 * (len(a) + len(b) - common_)
        assert jaccard.linked(a, b) == on
        if on:
            first = [x[: jaccard._first(len(x))] for x in (a, b)]
            assert len(np.intersect1d(*first)) >= max(jaccard._need(len(x)) for x in (a, b))


def test_need_is_a_lower_bound_for_every_partner():
    for n in [*range(1, 900, 7), 5000]:
        sizes = range(jaccard._overlap(n), 100 * n // 80 + 1)
        assert jaccard._need(n) <= max(1, min(jaccard._first(m) - (m - jaccard._overlap(m)) for m in sizes))


def test_index_finds_the_nearest_exactly():
    rng = np.random.default_rng(6)
    idf = rng.random(12) + 0.1
    examples = []
    for i in range(500):
        terms = np.flatnonzero(rng.random(12) < 0.2)
        examples.append((i, int(rng.random() < 0.5), terms.tolist(), rng.integers(1, 4, len(terms)).tolist()))
    index = toxicity.Index(examples, idf)
    by_id = {e[0]: e for e in examples}
    for _ in range(60):
        terms = np.flatnonzero(rng.random(12) < 0.3)
        if not len(terms):
            continue
        tf = rng.integers(1, 4, len(terms)).tolist()
        q = dict(zip(terms.tolist(), index.unit(terms, tf)))
        cosines = {e[0]: sum(q.get(t, 0) * w for t, w in zip(e[2], index.unit(e[2], e[3]))) for e in examples if e[2]}
        want = sorted((round(c, 9) for c in cosines.values() if c > 0), reverse=True)[: toxicity.NEAREST]
        best, cos = index.nearest(terms.tolist(), tf)
        assert [round(c, 9) for c in cos] == want
        assert all(abs(cosines[int(index.ids[b])] - c) < 1e-9 for b, c in zip(best, cos))
        assert Counter(index.labels[best].astype(int).tolist()) == Counter(by_id[int(index.ids[b])][1] for b in best)


def test_parities_differ_in_no_more_kinds_than_sets_in_shingles():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 3000, np.uint64)
    sets = [np.unique(rng.choice(base, int(rng.integers(1, 900)))) for _ in range(60)] + [np.empty(0, np.uint64), base[:1]]
    odd = jaccard.parities(sets).view(np.uint64)
    assert odd.shape == (len(sets), 4) and not odd[60].any() and np.bitwise_count(odd[61]).sum() == 1
    for i in range(len(sets)):
        for j in range(i):
            apart = len(np.setxor1d(sets[i], sets[j]))
            found = int(np.bitwise_count(odd[i] ^ odd[j]).sum())
            assert found <= apart and found % 2 == apart % 2
    assert jaccard.parities([]).shape == (0, 4)


def test_sketches_tell_sets_apart_that_are_no_link():
    rng = np.random.default_rng(6)
    for n in (1, 40, 300, 2500):
        base = np.unique(rng.integers(0, 2**63, 2 * n, np.uint64))
        for k in (n, n - n // 10, n - n // 4, n // 2):
            for other in (base[n - k:2 * n - k], base[n - k:n], base[n - k:2 * n - k + n // 5]):
                a, apart = base[:n], len(np.setxor1d(base[:n], other))
                found = jaccard.apart(jaccard.sketch(a), jaccard.sketch(other))
                assert found <= apart and found % 2 == apart % 2 and found >= 0.6 * apart - 2
