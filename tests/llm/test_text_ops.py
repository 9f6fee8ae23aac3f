"""Token counts, SentencePiece and packing against plain restatements."""

import random
import zlib

import numpy as np
import pytest
from giftlink.llm import common, packing, sentence_pieces, token_counts

ODD = [None, "", " ", "a", "Hello, World! it's 42.", "naïve café ÀÉ ß Σίσυφος 日本語 😀", "x" * 5000, "a\x1cb c\u3000d",
       "e\u0301te\u0301 ² Ⅷ ½ <|endoftext|> x<|y", "İstanbul dz Dž", "  two  spaces\n\nand lines. End! No end", "▁mark▁ here",
       "word. " * 3000]


def docs_of(spark, texts, ids=None):
    rows = [(ids[i] if ids else i, t, "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string")


# ---- token counts --------------------------------------------------------

def greedy(word, pieces, longest):
    n = at = 0
    while at < len(word):
        for k in range(min(longest, len(word) - at), 0, -1):
            if word[at:at + k] in pieces:
                at, n = at + k, n + 1
                break
        else:
            return -1
    return n


def test_automaton_equals_greedy_on_random_vocabularies():
    rnd = random.Random(5)
    for _ in range(300):
        pieces = {"".join(rnd.choice("abc") for _ in range(rnd.randint(1, 5))) for _ in range(rnd.randint(1, 9))}
        a = token_counts.Automaton(pieces)
        for _ in range(30):
            w = "".join(rnd.choice("abcd" if rnd.random() < .1 else "abc") for _ in range(rnd.randint(1, 14)))
            assert a.count(w) == greedy(w, pieces, 5), (pieces, w)


def test_token_counts_query(spark):
    pieces = set(token_counts.vocabulary_pieces(common.file_bytes(common.vocabulary("piece_bpe_32k.model"))))
    longest = max(map(len, pieces))
    df = token_counts.count_tokens(docs_of(spark, ODD, [None, *range(1, len(ODD) - 1), 1]))
    got = [tuple(r) for r in df.collect()]
    for (i, words, tokens, unknown), t in zip(got, ODD):
        ws = (t or "").split()
        counts = [greedy("▁" + w, pieces, longest) for w in ws]
        assert (words, tokens, unknown) == (len(ws), sum(max(c, 1) for c in counts), sum(c < 0 for c in counts))
    assert got[0][0] is None
    assert token_counts.count_tokens(docs_of(spark, [])).count() == 0


# ---- SentencePiece -------------------------------------------------------

def dp_score(p, word):
    """Best (score, -pieces) by trying every piece at every position."""
    by_text = {v: k for k, v in p.text.items()}
    scores = p.scores
    best = [(0.0, 0)] + [None] * len(word)
    for e in range(1, len(word) + 1):
        opts = [(best[s][0] + scores[word[s:e]], best[s][1] - 1) for s in range(max(0, e - 20), e)
                if word[s:e] in by_text]
        if not opts:
            opts = [(best[e - 1][0] + p.unknown_score, best[e - 1][1] - 1)]
        best[e] = max(opts)
    return best[-1]


@pytest.fixture(scope="module")
def pieces():
    import sentencepiece
    model = common.file_bytes(common.vocabulary("piece_bpe_32k.model"))
    p = sentence_pieces.Pieces(model)
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    p.scores = {p.text[i]: sp.get_score(i) for i in p.text}
    return p


def test_viterbi_finds_the_best_score(pieces):
    rnd = random.Random(3)
    words = [w for t in ODD if t for w in sentence_pieces.UNIT.findall("▁" + t.replace(" ", "▁"))][:400]
    words += ["▁" + "".join(rnd.choice("theranioné日q") for _ in range(rnd.randint(1, 15))) for _ in range(400)]
    words += ["▁a b c d".replace(" ", "▁"), "▁the\nend"]  # whole texts: cutting at words loses nothing
    for w in words:
        ids = pieces.viterbi(w)
        known = [pieces.text[i] for i in ids if i in pieces.text]
        n = len(known) + len(w) - sum(map(len, known))  # one step for an unknown character
        score = sum(pieces.scores[x] for x in known)
        score += pieces.unknown_score * (len(w) - sum(map(len, known)))
        assert (score, -n) == pytest.approx(dp_score(pieces, w))


def test_units_are_encoded_like_whole_texts(pieces):
    rnd = random.Random(8)
    for t in [x for x in ODD if x and len(x) < 500] + [
            "".join(rnd.choice("the an  \n.é▁\0") for _ in range(40)) for _ in range(200)]:
        whole = pieces.viterbi("▁" + t.replace(" ", "▁"))
        assert pieces.encode(t).tolist() == whole, t


def test_sentence_pieces_round_trip(spark, pieces):
    docs = docs_of(spark, ODD + ["\U000f0041 private", "a\0b \n\n c"])
    texts = ODD + ["\U000f0041 private", "a\0b \n\n c"]
    df = sentence_pieces.decode(sentence_pieces.encode(docs))
    once = sentence_pieces.round_trip(docs).collect()
    for r, o, t in zip(df.collect(), once, texts):
        assert r.decoded == o.decoded == (t if t is None else t.replace("▁", " "))
        assert (r.ids is None) == (o.ids_le is None) == (t is None)
        if t is not None:
            assert np.frombuffer(o.ids_le, "<i4").tolist() == r.ids == pieces.encode(t).tolist()
    assert sentence_pieces.encode(docs_of(spark, [])).count() == 0
    assert sentence_pieces.round_trip(docs_of(spark, [])).count() == 0


def test_ids_that_are_no_text(spark):
    df = spark.createDataFrame([(1, [-5, 1, 99999, None]), (2, [3 + 0xC3, 260]), (3, None), (4, [])],
                               "doc_id long, ids array<int>")
    assert [r.decoded for r in sentence_pieces.decode(df).collect()] == ["", "\ufffd" + " " * 4, None, ""]


# ---- packing -------------------------------------------------------------

def test_runs_give_the_tokenizers_ids():
    w = packing.Words(common.file_bytes(common.vocabulary("word_bpe_49k.json")), limit=50)
    rnd = random.Random(1)
    texts = [t or "" for t in ODD] + ["".join(rnd.choice("abÀéß'sţ.,!?0 9x\u0301\n²") for _ in range(60))
                                     for _ in range(300)]
    for t in texts:
        ids, stops = w.document(t)
        assert np.frombuffer(ids, "<u4").tolist() == w.tokenizer.encode(t, add_special_tokens=False).ids + [2], t
        assert all(0 <= s < len(ids) // 4 for s in stops)


@pytest.mark.parametrize("n", [10, 11])
def test_words_with_equal_polynomial_hashes_keep_their_own_ids(n):
    """A Thue-Morse word and its complement hash alike under every odd base
    modulo 2**64 from 1,024 letters on."""
    word = "a"
    for _ in range(n):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    w = packing.Words(common.file_bytes(common.vocabulary("word_bpe_49k.json")))
    for (ids, _), t in zip(w.documents([word, other, word + " " + other]), [word, other, word + " " + other]):
        assert np.frombuffer(ids, "<u4").tolist() == w.tokenizer.encode(t, add_special_tokens=False).ids + [2]


def brute_cost(pos, cost, window):
    points, pen = [0, *pos], [0.0, *cost]
    f = [0.0] + [float("inf")] * len(pos)
    for j in range(1, len(points)):
        for i in range(j):
            n = points[j] - points[i]
            if n <= window:
                f[j] = min(f[j], f[i] + pen[i] + (0 if n & (n - 1) == 0 else window - n))
    return f[-1]


def test_best_cuts_are_optimal():
    rnd = random.Random(2)
    for _ in range(300):
        window = rnd.choice([4, 8, 16])
        pos, at = [], 0
        for _ in range(rnd.randint(1, 25)):
            at += rnd.randint(1, window)
            pos.append(at)
        cost = [rnd.choice([0.0, 2.0, 5.0]) for _ in pos]
        cuts = packing.best_cuts(pos, cost, window)
        assert cuts[-1] == len(pos) - 1
        points, total, prev = [pos[c] for c in cuts], 0.0, 0
        for c, p in zip(cuts, points):
            n = p - prev
            assert 0 < n <= window
            total += (0 if n & (n - 1) == 0 else window - n) + (cost[c] if c != len(pos) - 1 else 0)
            prev = p
        assert total == pytest.approx(brute_cost(pos, cost, window))


@pytest.mark.parametrize("window", [64, 4096])
def test_pack_covers_every_token_once(spark, window):
    ids = [None, *range(1, len(ODD) - 1), 1]
    rows = packing.pack(docs_of(spark, ODD, ids).repartition(2), window=window, block_windows=4).collect()
    tok = packing.Words(common.file_bytes(common.vocabulary("word_bpe_49k.json")))
    want = sorted((str(i), np.frombuffer(tok.document(t)[0], "<u4").tolist()) for i, t in zip(ids, ODD))
    docs, seqs = {}, {}
    for r in rows:
        assert r.length == len(r.ids) > 0 and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        docs.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.ids))
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted((str(k[0]), [x for _, p in sorted(v) for x in p]) for k, v in docs.items()) == want
    for v in seqs.values():
        at = 0
        for offset, length in sorted(v):
            assert offset == at
            at += length
        assert at <= window
    assert packing.pack(docs_of(spark, [])).count() == 0
