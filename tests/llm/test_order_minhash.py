"""Order MinHash classes against all pairs."""

import random
from collections import Counter

import numpy as np
import pytest

from giftlink.llm import order_minhash as M


def lcs_share(a, b):
    a, b = (a or "").lower().split(), (b or "").lower().split()
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return 1.0 if not a and not b else 2 * row[-1] / (len(a) + len(b))


def brute(texts):
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(texts)):
        for j in range(i):
            if lcs_share(texts[i], texts[j]) >= .8 - 1e-12:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(texts))]


def text(rnd, n):
    return [rnd.choice("the of and to in is it for on with as at by from or").join(
        rnd.choice("abcdefghij") for _ in range(3)) for _ in range(n)]


def corpus(seed, group=25):
    rnd = random.Random(seed)
    out = [None, "", "  ", "a b", "a b", "A  b", "c d e f g", "x " * 40, "x " * 60]
    for _ in range(12):
        out.append(" ".join(text(rnd, rnd.randint(3, 120))))
    base = text(rnd, 200)
    for _ in range(group):  # copies of one text, each with changes of its own
        w = list(base)
        for _ in range(rnd.randint(0, 4)):
            i = rnd.randrange(len(w))
            w[i:i + 1] = rnd.choice([[], ["new"], ["two", "words"]])
        out.append(" ".join(w))
    passage = text(rnd, 60)
    for _ in range(group):  # different texts round one passage
        out.append(" ".join(text(rnd, 40) + passage + text(rnd, 40)))
    moved = text(rnd, 120)
    out += [" ".join(moved), " ".join(moved[60:] + moved[:60])]
    return out


def frame(spark, texts, ids=None):
    rows = [(ids[i] if ids else i, t, "th", i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, root string, place int").repartition(3)


@pytest.mark.parametrize("seed,small", [(1, 12), (2, 3)])
def test_classes_equal_all_pairs(spark, seed, small):
    texts = corpus(seed)
    got = {r.doc_id: r.class_id for r in M.near_duplicates(frame(spark, texts), small=small).collect()}
    assert got == dict(enumerate(brute(texts)))


def test_deduplicate_keeps_one_row_of_each_class(spark):
    texts = corpus(3, 8) + ["same text here"] * 3
    ids = [*range(len(texts) - 3), None, 5000, 5000]
    out = M.deduplicate(frame(spark, texts, ids))
    assert out.columns == ["doc_id", "text", "root", "place"]
    kept = sorted(r.place for r in out.collect())
    classes = brute(texts)
    assert len(kept) == len(set(classes)) == len({classes[i] for i in kept})
    assert [ids[i] for i in kept if texts[i] == "same text here"] == [5000]
    first = {}
    for i, c in enumerate(classes[:-3]):
        first.setdefault(c, i)
    assert [i for i in kept if i < len(texts) - 3] == sorted(first.values())
    assert M.deduplicate(frame(spark, [])).count() == 0


def test_sketch_sees_order_and_similarity():
    rnd = random.Random(5)
    cache, hits, moved = {}, 0, 0
    for _ in range(100):
        a = text(rnd, 300)
        b, c = list(a), a[150:] + a[:150]
        for _ in range(6):
            b[rnd.randrange(300)] = "changed"
        s = [M.sketch(M.labelled(M.shingles(M.word_hashes(x, cache)))) for x in (a, b, c)]
        hits += (s[0] == s[1]).any()
        moved += int((s[0] == s[2]).sum()) / M.SKETCHES
    assert hits == 100
    assert moved / 100 < 0.6  # a moved half keeps the shingles, not their order


@pytest.mark.parametrize("row", [4096, 7])
def test_alignment_equals_lcs(row, monkeypatch):
    monkeypatch.setattr(M, "ALIGN_WORDS", row)
    rnd = random.Random(6)
    for k in range(500):
        a = [rnd.randrange(6) for _ in range(rnd.randint(0, 25 if k % 5 else 90))]
        b = [x if rnd.random() < .85 else rnd.randrange(6) for x in a if rnd.random() < .95]
        if k % 3 == 0:
            b = b[:len(b) // 2] + [rnd.randrange(9) for _ in range(rnd.randint(0, len(a) // 4))] + b[len(b) // 2:]
        want = lcs_share(" ".join(map(str, a)), " ".join(map(str, b)))
        for threshold in (.8, .6):
            got = M.aligned(np.array(a, np.uint64), np.array(b, np.uint64), threshold)
            assert got == (want >= threshold - 1e-12), (a, b, threshold)


def test_alignment_of_very_long_texts():
    rnd = np.random.default_rng(7)
    a = rnd.integers(0, 5000, 30_000).astype(np.uint64)
    b = np.delete(np.where(rnd.random(30_000) < .9, a, np.uint64(9999)), slice(100, 600))
    assert M.aligned(a, b, 0.8) and not M.aligned(a, b, 0.95)
    assert not M.aligned(a, rnd.permutation(a), 0.8)


def test_recall_against_all_pairs_of_alignments(spark):
    """Pairs of texts of 300 words; every r-th word of one is replaced."""
    rnd = random.Random(8)
    for share, least in ((.05, 1.0), (.1, .93)):
        texts = []
        for _ in range(120):
            w = [f"w{rnd.randrange(3000)}" for _ in range(300)]
            texts += [" ".join(w), " ".join(x if rnd.random() >= share else "other" for x in w)]
        got = {r.doc_id: r.class_id for r in M.near_duplicates(frame(spark, texts)).collect()}
        pairs = [(i, i + 1) for i in range(0, len(texts), 2) if lcs_share(texts[i], texts[i + 1]) >= .8]
        assert len(pairs) >= 118
        assert sum(got[i] == got[j] for i, j in pairs) >= least * len(pairs)
        assert len(set(got.values())) >= len(texts) // 2  # nothing else is linked


def test_repeated_shingles_are_told_apart():
    s = M.shingles(M.word_hashes("a a a a a a a a".split(), {}))
    assert len(set(s.tolist())) == 1 and len(set(M.labelled(s).tolist())) == len(s)


def template_pages(seed, n, words=60, rounds=0.6):
    """Pages of one template, with a page's own words in one piece; every
    second one with a partner that is similar to it and to no other page."""
    rnd = random.Random(seed)
    template = [f"t{rnd.randrange(10 ** 6)}" for _ in range(int(5 * words * rounds))]
    out = []
    for i in range(n):
        own = [f"w{rnd.randrange(10 ** 6)}" for _ in range(5 * words - len(template))]
        out.append(" ".join(template[:100] + own + template[100:]))
        if i % 2:
            own[-len(own) // 6:] = [f"v{rnd.randrange(10 ** 6)}" for _ in range(len(own) // 6)]
            out.append(" ".join(template[:100] + own + template[100:]))
    return out


@pytest.mark.parametrize("n", [120])
def test_pairs_among_pages_of_one_template(spark, n):
    texts = template_pages(11, n)
    hashed = [M.word_hashes(t.split(), {}) for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if M.aligned(hashed[i], hashed[j]):
                root[i] = min(root[i], root[j])
    assert len(texts) - len(set(root)) == n // 2  # the planted pairs, all other pages alone
    got = {r.doc_id: r.class_id for r in M.near_duplicates(frame(spark, texts)).collect()}
    assert got == dict(enumerate(root))


def test_columns_of_any_name_come_back(spark):
    names = ["doc_id", "text", "_th", "_k", "th", "k", "h", "i", "row", "_i", "_t", "root", "a b"]
    rows = [(i, " ".join(f"w{i // 2}x{j}" for j in range(20)), *[f"{n}{i}" for n in names[2:]]) for i in range(6)]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` {'long' if n == 'doc_id' else 'string'}" for n in names))
    out = M.deduplicate(df)
    assert out.columns == names
    assert sorted(map(tuple, out.collect())) == [r for r in rows if r[0] % 2 == 0]


def test_a_repeated_shingle_leaves_the_others_alike():
    one = M.labelled(M.shingles(M.word_hashes("a b c d e f g h i j".split(), {})))
    two = M.labelled(M.shingles(M.word_hashes("a b c d e f g h i j a b c d e".split(), {})))
    assert len(np.intersect1d(one, two)) == len(one)
