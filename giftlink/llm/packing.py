"""Packing: order-preserving dynamic programming over window cuts.

Documents stay in the order in which the table stores them. Their token ids,
each document closed by the end id, form one stream per input partition. The
stream is cut into sequences of at most ``window`` tokens. Cuts may fall at
document ends (free), at sentence ends (``sentence_penalty``) and, inside a
sentence, at every ``step`` tokens (``hard_penalty``). The dynamic programme
chooses the cuts with the least padding plus penalties:

    f(j) = min over i, 0 < pos(j)-pos(i) <= window, of
           f(i) + cut(i) + window - (pos(j) - pos(i))

The bracket splits into a term of i and a term of j, so the minimum over the
sliding range of i comes from a monotone queue in constant time per cut. A
sequence that is a power of two long needs no padding; those predecessors,
one per power, are tried besides.

Cutting needs no shuffle and a bounded buffer: after every ``block_windows``
windows the cuts so far are fixed, except for the last sequence, whose tokens
are carried on, so only the last sequence of an input partition is short. A
lost task is cut again from its input split with the same result.

Defined results: a null text is an empty one; an empty text is its end id
alone; texts of any length are packed whole and span several sequences if
need be; repeated rows and null ids each keep their row; an empty table gives
no rows; other columns than id and text are not read.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import deque
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from giftlink.llm import common
from giftlink.llm.tasks import slices, worker_state

WINDOW = 4096
END_ID = 2
SENTENCE_PENALTY = 2.0
HARD_PENALTY = 24.0
STEP = 64
BLOCK_WINDOWS = 256
CACHE_WORDS = 400_000

# white space as the tokenizer's pattern \s knows it: ASCII, and the rest
WHITE = re.compile("[\\t-\\r ]")
WIDE_SPACES = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
# runs for which the tokenizer's own splitting is restated below
PLAIN = re.compile("[\n!-~À-ÖØ-öø-ɏ]*")
PARTS = re.compile("[a-zß-öø-ɏ]+|\n|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^\na-z0-9À-ÖØ-öø-ɏ]+")
STOP = "\U0010ffff"  # ends a run's ids; no id is spelled by it
SENTENCE = 0x10FFFE  # follows the ids of a run that ends a sentence
CHUNK = 1 << 20  # characters split at once


def spell(ids) -> str:
    """Ids as a string, one character each (surrogates are left out)."""
    if not ids or max(ids) < 0xD800:
        return "".join(map(chr, ids))
    return "".join([chr(i if i < 0xD800 else i + 0x2000) for i in ids])


def spelled_ids(text: str):
    """The ids (and sentence marks) of such a string."""
    ids = np.frombuffer(text.encode("utf-32-le"), "<u4")
    return np.where((ids < 0xD800) | (ids == SENTENCE), ids, ids - 0x2000).astype("<u4")


class Numbers(dict):
    """Runs of bytes, numbered as they come."""

    def __missing__(self, run):
        self[run] = n = len(self)
        return n


def byte_letters() -> dict:
    """Byte-level BPE spells each byte by a printable character: printable
    Latin-1 bytes by themselves, the others by the characters from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {**{b: chr(b) for b in own}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


class Words:
    """Ids of texts by a word-end BPE, one run of non-white-space at a time.

    The tokenizer drops white space and never merges over it, so a text's ids
    are its runs' ids one after another. Runs repeat: each that is new to a batch
    is numbered by its bytes, and the ids of the numbers so far lie in one array, from which a
    batch of texts is put together by array operations. Past ``limit`` runs
    the numbering begins anew. New runs of Latin letters, digits and marks are
    taken apart as the tokenizer does it, all at once, and their new parts go
    straight to its BPE model; other runs go through the whole tokenizer."""

    def __init__(self, json_bytes: bytes, limit: int = CACHE_WORDS):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(json_bytes.decode("utf-8"))
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.limit, self.parts = limit, {"\n": STOP}
        self.spelled = [spell([i]) for i in range(self.tokenizer.get_vocab_size())]
        self.clear()

    def clear(self) -> None:
        self.numbers, self.ids = Numbers(), np.zeros(1 << 16, "<u4")
        self.begin = np.zeros(1, np.int64)  # where each number's ids begin in ``ids``, and where the last ones end
        self.numbers[b""]  # number 0, no ids: beside white space at a text's edges

    def learn_parts(self, parts: set) -> None:
        """Ids of lower-cased letter runs, digits and runs of marks."""
        tokenize, known, spelled = self.model.tokenize, self.parts, self.spelled
        for part in parts:
            raw = part if part.isascii() else "".join([self.letters[b] for b in part.encode("utf-8")])
            ids = tokenize(raw)
            known[part] = spelled[ids[0].id] if len(ids) == 1 else "".join([spelled[t.id] for t in ids])

    def plain(self, text: str) -> str | None:
        """``text`` in lower case, if the restated splitting holds for it."""
        if "<|" in text or not PLAIN.fullmatch(text):
            return None
        if text.isascii():
            return text.lower()
        if not unicodedata.is_normalized("NFC", text):
            return None
        low = text.lower()
        return low if PLAIN.fullmatch(low) else None

    def learn(self, text: str) -> list:
        """Ids of new runs, one a line."""
        low = self.plain(text)
        if low is None:
            runs = text.split("\n")
            odd = [r for r in runs if self.plain(r) is None] if len(runs) > 1 else runs
            ids = {r: spell(self.tokenizer.encode(r, add_special_tokens=False).ids) for r in odd}
            rest = [r for r in runs if r not in ids]
            ids.update(zip(rest, self.learn("\n".join(rest)) if rest else []))
            return [ids[r] for r in runs]
        parts = PARTS.findall(low)
        if len(self.parts) > self.limit:
            self.parts = {"\n": STOP}
        self.learn_parts(set(parts).difference(self.parts))
        return "".join(map(self.parts.__getitem__, parts)).split(STOP)

    def _note(self) -> None:
        """Ids of the runs that were numbered since the last time."""
        known = len(self.begin) - 1
        new, mark = list(islice(self.numbers, max(known, 1), None)), chr(SENTENCE)
        spelled = self.learn(b"\n".join(new).decode("utf-8", "surrogatepass")) if new else []
        spelled = [x + mark if r[-1] in b".!?" else x for r, x in zip(new, spelled)]
        ids = spelled_ids("".join(spelled))
        end = int(self.begin[-1])
        if end + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids[:end], np.zeros(end + 2 * len(ids), "<u4")))
        self.ids[end:end + len(ids)] = ids
        sizes = np.fromiter(map(len, spelled), np.int64, len(spelled))
        self.begin = np.concatenate((self.begin, [end] if not known else [], end + np.cumsum(sizes))).astype(np.int64)

    def chunk(self, raws: list) -> tuple:
        """Of texts as UTF-8: their ids with sentence marks, and where each
        text's ids end."""
        if len(self.numbers) > self.limit:
            self.clear()
        lists = pc.ascii_split_whitespace(pa.array(raws, pa.binary()).view(pa.string()))
        runs = lists.flatten().dictionary_encode()
        distinct = runs.dictionary.view(pa.binary()).to_pylist()
        numbers = np.fromiter(map(self.numbers.__getitem__, distinct), np.int64, len(distinct))
        self._note()
        numbers = numbers[runs.indices.to_numpy()]
        each = self.begin[numbers + 1] - self.begin[numbers]
        upto = np.concatenate(([0], np.cumsum(each)))
        ids = self.ids[np.repeat(self.begin[numbers] - upto[:-1], each) + np.arange(upto[-1])]
        return ids, upto[lists.offsets.to_numpy()[1:]]

    def documents(self, texts: list):
        """Of each text: ids with the end id as bytes, and the token positions
        after sentences."""
        batch, size = [], 0
        for text in texts:
            text = text or ""
            if not text.isascii() and WIDE_SPACES.search(text):
                text = WIDE_SPACES.sub(" ", text)
            if len(text) > CHUNK:
                yield from self._batch(batch)
                yield self._long(text)
                batch, size = [], 0
                continue
            batch.append(text)
            size += len(text)
            if size >= CHUNK:
                yield from self._batch(batch)
                batch, size = [], 0
        yield from self._batch(batch)

    def _batch(self, texts: list):
        if not texts:
            return
        ids, ends = self.chunk([t.encode("utf-8", "surrogatepass") for t in texts])
        at = 0
        for end in ends.tolist():
            yield self._done(ids[at:end])
            at = end

    def _long(self, text: str) -> tuple:
        """The same for one long text, cut at white space."""
        out, at = [], 0
        while at < len(text):
            cut = WHITE.search(text, at + CHUNK)
            stop = cut.end() if cut else len(text)
            out.append(self.chunk([text[at:stop].encode("utf-8", "surrogatepass")])[0])
            at = stop
        return self._done(np.concatenate(out))

    @staticmethod
    def _done(ids) -> tuple:
        marks = np.flatnonzero(ids == SENTENCE)
        if len(marks):
            ids = ids[ids != SENTENCE]
            marks = marks - np.arange(len(marks))
        return ids.tobytes() + END_ID.to_bytes(4, "little"), marks

    def document(self, text: str | None) -> tuple:
        return next(self.documents([text]))


def cut_points(doc_ends, sentence_stops, start: int = 0, step: int = STEP) -> tuple:
    """Cut positions of a stream of documents that begins at ``start``,
    ascending, and their kinds (0 document end, 1 sentence end, 2 inside a
    sentence, so that neighbours lie at most ``step`` apart)."""
    stops = np.union1d(doc_ends, sentence_stops[sentence_stops > start]).astype(np.int64)
    kind = np.ones(len(stops), np.int8)
    kind[np.searchsorted(stops, doc_ends)] = 0
    starts = np.concatenate(([start], stops[:-1]))
    inside = (stops - starts - 1) // step
    if inside.any():
        seg = np.repeat(np.arange(len(stops)), inside)
        nth = np.arange(len(seg)) - np.repeat(np.cumsum(inside) - inside, inside) + 1
        pos = np.concatenate((stops, starts[seg] + nth * step))
        order = np.argsort(pos, kind="stable")
        return pos[order], np.concatenate((kind, np.full(len(seg), 2, np.int8)))[order]
    return stops, kind


def best_cuts(pos: list, cost: list, window: int = WINDOW) -> list:
    """Indexes of the chosen cuts of a stream that starts at 0; the last
    position is always chosen. ``pos`` ascends with gaps of at most
    ``window``; ``cost[j]`` is the penalty of cutting at j."""
    points, penalty = [0, *pos], [0.0, *cost]
    n = len(points)
    f, back = [0.0] * n, [0] * n
    # predecessors that make a sequence a power of two long, by successor
    where, pairs = np.array(points), []
    for power in (1 << k for k in range(window.bit_length())):
        i = np.minimum(np.searchsorted(where, where - power), n - 1)
        j = np.flatnonzero(where[i] == where - power)
        pairs.append((j, i[j]))
    after, before = (np.concatenate(x) for x in zip(*pairs))
    order = np.argsort(after, kind="stable")
    after, before, at = [*after[order].tolist(), n], before[order].tolist(), 0
    queue: deque = deque()  # indexes with increasing key = f + penalty + pos
    key = [0.0] * n
    for j in range(1, n):
        i = j - 1
        key[i] = k = f[i] + penalty[i] + points[i]
        while queue and key[queue[-1]] >= k:
            queue.pop()
        queue.append(i)
        p = points[j]
        while points[queue[0]] < p - window:
            queue.popleft()
        best = queue[0]
        value = key[best] + window - p
        while after[at] == j:
            i = before[at]
            at += 1
            if f[i] + penalty[i] < value:
                value, best = f[i] + penalty[i], i
        f[j], back[j] = value, best
    out, j = [], n - 1
    while j:
        out.append(j - 1)
        j = back[j]
    return out[::-1]


class Packer:
    """Packs a stream of documents; ``ready`` holds the finished pieces
    (document, start, length, crc, doc_tokens, sequence, offset, ids)."""

    def __init__(self, window=WINDOW, sentence_penalty=SENTENCE_PENALTY, hard_penalty=HARD_PENALTY, step=STEP,
                 block_windows=BLOCK_WINDOWS):
        self.window, self.step, self.block = window, step, block_windows * window
        self.costs = np.array([0.0, sentence_penalty, hard_penalty])
        self.docs: deque = deque()  # (key, ids bytes, tokens, tokens packed)
        self.ends, self.stops, self.base, self.end, self.sequence = [], [], 0, 0, 0
        self.ready: list = []

    def add(self, key, ids: bytes, stops) -> None:
        n = len(ids) // 4
        self.stops.append(stops + self.end)
        self.end += n
        self.ends.append(self.end)
        self.docs.append([key, ids, n, 0])
        if self.end - self.base >= self.block:
            self.flush(False)

    def flush(self, last: bool) -> None:
        if not self.ends:
            return
        ends, stops = np.array(self.ends), np.concatenate(self.stops)
        pos, kind = cut_points(ends, stops, self.base, min(self.step, self.window))
        cuts = best_cuts((pos - self.base).tolist(), self.costs[kind].tolist(), self.window)
        if not last:
            cuts = cuts[:-1]  # the last sequence may still grow
        for stop in pos[cuts].tolist():
            self._take(stop - self.base)
            self.base = stop
        self.ends, self.stops = ends[ends > self.base].tolist(), [stops[stops > self.base]]

    def _take(self, n: int) -> None:
        """The next ``n`` tokens as one sequence."""
        offset = 0
        while offset < n:
            doc = self.docs[0]
            key, ids, tokens, start = doc
            length = min(tokens - start, n - offset)
            own = ids[4 * start:4 * (start + length)]
            self.ready.append((key, start, length, zlib.crc32(own), tokens, self.sequence, offset, own))
            offset += length
            if start + length == tokens:
                self.docs.popleft()
            else:
                doc[3] += length
        self.sequence += 1

    def taken(self) -> list:
        out, self.ready = self.ready, []
        return out


def pack(docs: DataFrame, tokenizer_path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, with_ids: bool = True, **settings) -> DataFrame:
    """One row per piece of a document in a sequence: id, start, length,
    ids_crc32, doc_tokens, sequence_id, offset, and ids (array<int>) with
    ``with_ids``. A sequence id holds the partition in its upper half."""
    path = tokenizer_path or common.vocabulary("word_bpe_49k.json")
    spec = common.in_small_batches(docs).sparkSession.sparkContext.broadcast(common.file_bytes(path))
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    id_type = docs.schema[id_col].dataType

    def run(batches):
        words = worker_state(("packing", path), lambda: Words(spec.value))
        packer = Packer(window, **settings)
        first = TaskContext.get().partitionId() << 32
        key_type = None

        def rows(out):
            cols = [pa.array([x[0] for x in out], key_type)]
            cols += [pa.array([x[i] + (first if i == 5 else 0) for x in out], pa.int64()) for i in range(1, 7)]
            if with_ids:
                cols.append(pa.array([np.frombuffer(x[7], "<u4").astype(np.int32) for x in out],
                                     pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(cols, names=names + ["ids"] * with_ids)

        for batch in slices(batches, 2048):
            key_type = batch.schema.field(0).type
            for key, (ids, stops) in zip(batch.column(0).to_pylist(), words.documents(batch.column(1).to_pylist())):
                packer.add(key, ids, stops)
                if len(packer.ready) >= 4096:
                    yield rows(packer.taken())
        packer.flush(True)
        if packer.ready:
            yield rows(packer.taken())

    schema = f"`{id_col}` {id_type.simpleString()}, " + ", ".join(f"{n} long" for n in names[1:])
    return docs.select(id_col, text_col).mapInArrow(run, schema + ", ids array<int>" * with_ids)


common.ship(__name__)
