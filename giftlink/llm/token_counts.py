"""Token counts: a linear longest-match automaton over a vocabulary trie.

Greedy longest-match word pieces are counted without being built. Words (runs
of non-white-space) start with a word mark; pieces that continue a word have
none, so one trie holds both kinds. Each trie node has a failure link to the
node that is left when the greedy pieces so far are cut off, and the
precomputed number of pieces cut off on the way. A word is then read once,
left to right: on a missing child, follow the link and add its count.

A word that the vocabulary cannot spell counts as one unknown token.

Defined results: null and empty texts have zero words and tokens; words of
any length are read whole; repeated rows each get their row; an empty table
gives no rows; other columns than id and text are not read.
"""

from __future__ import annotations

from collections import Counter, deque

import pyarrow as pa
from pyspark.sql import DataFrame

from giftlink.llm import common
from giftlink.llm.tasks import slices, worker_state

MARK = "▁"
CACHE_WORDS = 200_000


class Automaton:
    """Trie arrays: child maps, failure link (-1: none) and popped counts."""

    def __init__(self, pieces):
        self.child, self.depth, self.final = [{}], [0], [False]
        for p in pieces:
            at = 0
            for ch in p:
                nxt = self.child[at].get(ch)
                if nxt is None:
                    nxt = len(self.child)
                    self.child[at][ch] = nxt
                    self.child.append({})
                    self.depth.append(self.depth[at] + 1)
                    self.final.append(False)
                at = nxt
            self.final[at] = bool(p) or self.final[at]
        n = len(self.child)
        self.link, self.popped = [-1] * n, [0] * n
        queue = deque([0])
        while queue:  # breadth first: links of shorter strings are ready
            v = queue.popleft()
            for ch, u in self.child[v].items():
                queue.append(u)
                if self.final[u]:
                    # the whole string is one piece: cut it, nothing is left
                    self.link[u], self.popped[u] = 0, 1
                    continue
                # cut what v cuts, then try to read ch from what is left
                at, cut = self.link[v], self.popped[v]
                while at != -1 and ch not in self.child[at]:
                    at, cut = self.link[at], cut + self.popped[at]
                if at != -1:
                    self.link[u], self.popped[u] = self.child[at][ch], cut

    def count(self, word: str) -> int:
        """Greedy pieces of ``word``, or -1 if it cannot be spelled."""
        child, link, popped = self.child, self.link, self.popped
        at = n = 0
        for ch in word:
            nxt = child[at].get(ch)
            while nxt is None:
                n += popped[at]
                at = link[at]
                if at == -1:
                    return -1
                nxt = child[at].get(ch)
            at = nxt
        while at:  # cut off what is left at the end
            n += popped[at]
            at = link[at]
            if at == -1:
                return -1
        return n


def vocabulary_pieces(model: bytes) -> list:
    """The text pieces of a SentencePiece model (no control, unknown or byte
    pieces)."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    return [sp.id_to_piece(i) for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]


def text_counts(text, automaton: Automaton, cache: dict) -> tuple:
    """(words, tokens, unknown words) of one text."""
    words = tokens = unknown = 0
    for w, n in Counter((text or "").split()).items():
        c = cache.get(w)
        if c is None:
            c = automaton.count(MARK + w)
            if len(cache) >= CACHE_WORDS:
                cache.clear()
            if len(w) <= 64:
                cache[w] = c
        words += n
        tokens += n * (c if c > 0 else 1)
        unknown += n if c <= 0 else 0
    return words, tokens, unknown


def count_tokens(docs: DataFrame, model_path: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, n_words long, n_tokens long, n_unknown long) of every row."""
    spark = common.in_small_batches(docs).sparkSession
    path = model_path or common.vocabulary("piece_bpe_32k.model")
    model = spark.sparkContext.broadcast(common.file_bytes(path))
    schema = common.schema_of(docs, id_col, "n_words long, n_tokens long, n_unknown long")

    def run(batches):
        automaton, cache = worker_state(("token_counts", path), lambda: (Automaton(vocabulary_pieces(model.value)), {}))
        for batch in slices(batches):
            out = [text_counts(t, automaton, cache) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([x[i] for x in out], pa.int64()) for i in range(3)]],
                names=[id_col, "n_words", "n_tokens", "n_unknown"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


common.ship(__name__)
