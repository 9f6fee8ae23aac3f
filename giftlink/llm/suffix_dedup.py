"""Suffix-array dedup: bytes of passages that occur more than once.

A byte is removed if a string of ``length`` bytes that covers it also starts
anywhere else in the table (the same document included). Strings never cross
documents and are judged on the input.

A suffix array of all text would need one sort of everything. Here every
string of ``length`` bytes has an *anchor*, the leftmost of its grams of
``gram`` bytes with the smallest hash. Equal strings have equal anchors at
equal distance, and neighbouring strings mostly share one, so a document
yields one row per about ``(length - gram) / 2`` bytes: the anchor's gram
hash and the stretch of text that its strings cover (its context).

* A gram that occurs once has no repeated string.
* Contexts that are equal as a whole repeat in all their strings. They are
  found by an aggregate over a cryptographic 128-bit digest (BLAKE2b) of their
  bytes, so neither chance nor built collisions of the polynomial hashes make
  different contexts one; copies, however many, never meet in one task.
* Different contexts round one gram are what is left to compare: the edges of
  repeated passages. One of each goes to a suffix sort. The suffixes that start
  at the gram, and the reversed texts before it, are merge-sorted; a
  comparison finds the common extension of two suffixes by binary search on
  prefix polynomial hashes. Common extensions of neighbours in the two orders
  are verified byte by byte (a batch with a hash collision is sorted again by
  its bytes). A string that starts ``o`` bytes before the gram
  repeats if two contexts agree on ``o`` bytes before and ``length - o`` from
  the gram on: both are runs of neighbours in the two sorted orders.
* A gram with more than ``max_contexts`` different contexts is not sorted in
  one task: its strings are counted one by one by a 128-bit hash.

Texts are told apart by 128 bits of their SHA-256, so equal rows are judged
once and share the outcome. Polynomial hashes only choose anchors and speed up
comparisons: what they call equal is settled by digests or by bytes.

Defined results: a null text is an empty one; texts shorter than ``length``
keep all bytes; texts of any length are cut into overlapping chunks, so memory
is bounded; repeated rows are occurrences of their own, so equal texts of
``length`` bytes or more are removed entirely; an empty table gives no rows;
columns other than those named are not read. ``judged`` returns the kept
columns as one, so that no name can clash; in ``remove_repeats`` a kept column
with the name of a result column comes back with underscores added.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from giftlink.llm import common
from giftlink.llm.tasks import worker_state
from giftlink.session import drop_table

LENGTH = 400
GRAM = 128
MAX_CONTEXTS = 50_000
CHUNK = 1 << 18
BATCH_BYTES = 2 << 20

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
U = np.uint64


def mix(h):
    """A bijective scramble of 64-bit values."""
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    return h ^ (h >> U(32))


class Powers:
    """Powers of the base and of its inverse modulo 2**64."""

    def __init__(self):
        self.up = self.down = np.ones(1, U)

    def upto(self, n: int):
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            for name, base in (("up", BASE), ("down", INVERSE)):
                steps = np.full(n, base, U)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down


class Hashed:
    """Prefix polynomial hashes of a byte buffer."""

    def __init__(self, buf, powers: Powers):
        up, self.down = powers.upto(len(buf) + 1)
        self.prefix = np.zeros(len(buf) + 1, U)
        np.cumsum((buf.astype(U) + U(1)) * up[:len(buf)], out=self.prefix[1:])

    def of(self, start, length):
        """Hashes of buf[start:start+length], comparable between places."""
        return (self.prefix[start + length] - self.prefix[start]) * self.down[start]


def sliding_min(x, w: int):
    """Minimum of each ``w`` neighbours."""
    n = len(x)
    padded = np.full(-(-n // w) * w, np.iinfo(U).max, U)
    padded[:n] = x
    rows = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - w + 1], ahead[w - 1:n])


def anchors(buf, powers: Powers, length: int = LENGTH, gram: int = GRAM, chunk: int = CHUNK):
    """(gram hash, context digest in two halves, first start, starts, first
    start to anchor) arrays of a text's bytes: each row is a run of starts
    that share an anchor."""
    out, raw = [], memoryview(buf)
    bits = U((chunk + length).bit_length())
    for at in range(0, len(buf) - length + 1, chunk):
        part = buf[at:at + chunk + length - 1]
        h = Hashed(part, powers)
        grams = mix(h.of(np.arange(len(part) - gram + 1), gram))
        place = np.arange(len(grams), dtype=U)
        # the position in the low bits makes the minimum the leftmost one
        least = sliding_min(grams >> bits << bits | place, length - gram + 1)
        anchor = (least & ((U(1) << bits) - U(1))).astype(np.int64)
        first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
        starts = np.diff(np.append(first, len(anchor)))
        a = anchor[first]
        digests = b"".join([blake2b(raw[s:e], digest_size=16).digest() for s, e in zip(
            (first + at).tolist(), (first + at + starts + length - 1).tolist())])
        halves = np.frombuffer(digests, np.int64).reshape(-1, 2)
        out.append((grams[a].view(np.int64), halves[:, 0], halves[:, 1], first + at, starts, a - first))
    return [np.concatenate(x) for x in zip(*out)]


# ---- the suffix sort -----------------------------------------------------

class Suffixes:
    """Suffixes of a buffer, given by their starts and lengths, in groups."""

    def __init__(self, buf, start, size, group, powers: Powers):
        self.buf, self.start, self.size, self.group = buf, start, size, group
        self.hashed = Hashed(buf, powers)

    def common(self, i, j):
        """Common extensions of suffixes i and j: binary search on hashes."""
        a, b = self.start[i], self.start[j]
        low, high = np.zeros(len(a), np.int64), np.minimum(self.size[i], self.size[j])
        while (low < high).any():
            mid = (low + high + 1) >> 1
            same = self.hashed.of(a, mid) == self.hashed.of(b, mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def less(self, i, j):
        n = self.common(i, j)
        ended_i, ended_j = n >= self.size[i], n >= self.size[j]
        last = len(self.buf) - 1
        ci = self.buf[np.minimum(self.start[i] + n, last)]
        cj = self.buf[np.minimum(self.start[j] + n, last)]
        return np.where(ended_i | ended_j, ended_i & ~ended_j, ci < cj)

    def order(self):
        """Indexes in sorted order within groups (groups stay in order): a
        bottom-up mergesort of all groups at once. An element's place in a
        merge is its place in its own run plus its rank in the other run,
        found by binary search."""
        n = len(self.start)
        index = np.arange(n)
        new = np.append(True, self.group[1:] != self.group[:-1]) if n else np.zeros(0, bool)
        begin = np.flatnonzero(new)
        sizes = np.diff(np.append(begin, n))
        first, size = np.repeat(begin, sizes), np.repeat(sizes, sizes)
        place, width = np.arange(n) - first, 1
        while n and width < sizes.max():
            run = place // width
            other = (run ^ 1) * width
            todo = np.flatnonzero(other < size)
            lo = other[todo]
            hi = np.minimum(lo + width, size[todo])
            base, me, left = first[todo], index[todo], run[todo] % 2 == 0
            start_lo = lo.copy()
            while (lo < hi).any():
                mid = np.minimum((lo + hi) >> 1, size[todo] - 1)
                them = index[base + mid]
                # elements of the left run go first among equals
                lower = np.where(left, self.less(them, me), ~self.less(me, them))
                open_ = lo < hi
                lo, hi = np.where(open_ & lower, mid + 1, lo), np.where(open_ & ~lower, mid, hi)
            where = place.copy()
            where[todo] = place[todo] // (2 * width) * (2 * width) + place[todo] % width + lo - start_lo
            index[first + where] = index.copy()
            width *= 2
        return index

    def by_bytes(self):
        """The same order from the bytes themselves."""
        raw = self.buf.tobytes()
        key = [(g, raw[s:s + z]) for g, s, z in zip(self.group.tolist(), self.start.tolist(), self.size.tolist())]
        return np.array(sorted(range(len(key)), key=key.__getitem__), dtype=np.int64)

    def sorted_with_extensions(self):
        """(order, common extension with the suffix before in the order, -1
        where a group begins), verified by bytes."""
        order = self.order()
        raw, before, after = self.buf.tobytes(), order[:-1], order[1:]
        lcp = self.common(before, after)
        ok = True
        for i, j, n in zip(before.tolist(), after.tolist(), lcp.tolist()):
            if self.group[i] == self.group[j]:
                a, b = int(self.start[i]), int(self.start[j])
                x, y = raw[a:a + int(self.size[i])], raw[b:b + int(self.size[j])]
                if x > y or x[:n] != y[:n] or (x[n:n + 1] == y[n:n + 1] != b""):
                    ok = False
                    break
        if not ok:
            order = self.by_bytes()
            before, after = order[:-1], order[1:]
            lcp = np.array([_common_bytes(raw, *z) for z in zip(
                self.start[before].tolist(), self.size[before].tolist(), self.start[after].tolist(),
                self.size[after].tolist())], dtype=np.int64)
        lcp = np.where(self.group[before] == self.group[after], lcp, -1)
        return order, np.append(-1, lcp)


def _common_bytes(raw: bytes, a: int, na: int, b: int, nb: int) -> int:
    n = min(na, nb)
    x, y = np.frombuffer(raw, np.uint8, n, a), np.frombuffer(raw, np.uint8, n, b)
    return int(np.argmin(np.append(x == y, False)))


def repeated_starts(contexts: list, group, to_anchor, starts, powers: Powers, length: int = LENGTH) -> list:
    """For contexts (bytes) round grams, grouped by gram: boolean arrays that
    tell which of each context's starts begin a string that another context
    of the group holds too."""
    n = len(contexts)
    flags = [np.zeros(s, bool) for s in starts]
    if n < 2:
        return flags
    buf = np.frombuffer(b"".join(contexts), np.uint8)
    sizes = np.array([len(c) for c in contexts], np.int64)
    begin = np.cumsum(sizes) - sizes
    right = Suffixes(buf, begin + to_anchor, sizes - to_anchor, group, powers)
    # the reversed buffer: the text before an anchor is read backwards
    left = Suffixes(buf[::-1].copy(), len(buf) - begin - to_anchor, to_anchor, group, powers)
    (r_order, r_lcp), (l_order, l_lcp) = right.sorted_with_extensions(), left.sorted_with_extensions()
    r_class, l_class = np.empty(n, np.int64), np.empty(n, np.int64)
    lowest = to_anchor - starts + 1
    for o in range(int(lowest.min()), int(to_anchor.max()) + 1):
        has = np.flatnonzero((lowest <= o) & (o <= to_anchor))
        if len(has) < 2:
            continue
        r_class[r_order] = np.cumsum(r_lcp < length - o)
        l_class[l_order] = np.cumsum(l_lcp < o)
        both = r_class[has] * (n + 1) + l_class[has]
        order = np.argsort(both, kind="stable")
        v = both[order]
        same = v[1:] == v[:-1]
        twice = has[order[np.append(same, False) | np.append(False, same)]]
        for i in twice.tolist():
            flags[i][to_anchor[i] - o] = True
    return flags


def runs_of(flags) -> list:
    """(first, end) of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


# ---- the job -------------------------------------------------------------

def text_key(text):
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)), 1, 16)


def _anchor_rows(docs: DataFrame, text_col: str, length: int, gram: int, chunk: int) -> DataFrame:

    def run(batches):
        powers = worker_state("suffix_powers", Powers)
        for b in batches:
            for lo in range(0, b.num_rows, 256):  # bounds the rows held at once
                keys, cols = [], []
                part = b.slice(lo, 256)
                for key, text in zip(part.column(0).to_pylist(), part.column(1)):
                    raw = text.as_buffer() if text.is_valid else b""
                    buf = np.frombuffer(raw, np.uint8)
                    if len(buf) >= length:
                        got = anchors(buf, powers, length, gram, chunk)
                        keys += [key] * len(got[0])
                        cols.append(got)
                if cols:
                    g, c, d, s, n, o = (np.concatenate(x) for x in zip(*cols))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys, pa.binary()), pa.array(g), pa.array(c), pa.array(d), pa.array(s, pa.int64()),
                         pa.array(n.astype(np.int32)), pa.array(o.astype(np.int32))],
                        names=["th", "g", "c", "d", "s", "n", "o"])

    return (docs.select(text_key(F.col(text_col)).alias("th"), F.col(text_col))
            .where(F.octet_length(text_col) >= length)
            .mapInArrow(run, "th binary, g long, c long, d long, s long, n int, o int"))


def _contexts(reps: DataFrame, docs: DataFrame, text_col: str, length: int) -> DataFrame:
    """``reps`` with their text, one row per context; every text is read from
    one of its rows."""
    wanted = reps.groupBy("th").agg(F.collect_list(F.struct("g", "s", "n", "o", "alone")).alias("w"))
    texts = (docs.select(text_key(F.col(text_col)).alias("th"), F.encode(text_col, "UTF-8").alias("b"))
             .join(wanted, "th").dropDuplicates(["th"]))
    return (texts.select("th", "b", F.explode("w").alias("w"))
            .select("th", "w.*", F.expr(f"substring(b, cast(w.s + 1 as int), w.n + {length - 1})").alias("context")))


def _sorted_edges(contexts: DataFrame, length: int, batch_bytes: int) -> DataFrame:
    """(th, s, e): spans of repeated strings among contexts of one gram."""

    def judge(rows, powers):
        rows.sort(key=lambda r: r[0])
        flags = repeated_starts([r[6] for r in rows], np.array([r[0] for r in rows]),
                                np.array([r[4] for r in rows]), np.array([r[3] for r in rows]), powers, length)
        out = [(r[1], r[2] + a, r[2] + z - 1 + length) for r, f in zip(rows, flags) if r[5] for a, z in runs_of(f)]
        return pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.int64()),
             pa.array([x[2] for x in out], pa.int64())], names=["th", "s", "e"])

    def run(batches):
        powers = worker_state("suffix_powers", Powers)
        rows, size, last = [], 0, None
        for b in batches:  # sorted by gram: whole groups are judged together
            for r in zip(*(c.to_pylist() for c in b.columns)):
                if size >= batch_bytes and r[0] != last:
                    yield judge(rows, powers)
                    rows, size = [], 0
                rows.append(r)
                size, last = size + len(r[6]), r[0]
        if rows:
            yield judge(rows, powers)

    return (contexts.select("g", "th", "s", "n", "o", "alone", "context").repartition("g").sortWithinPartitions("g")
            .mapInArrow(run, "th binary, s long, e long"))


def _counted_edges(contexts: DataFrame, length: int) -> DataFrame:
    """The same by counting every string, for grams with very many contexts."""
    one = contexts.select("th", "s", "alone", F.posexplode(F.expr(
        f"transform(sequence(1, n), i -> md5(substring(context, i, {length})))")).alias("i", "h"))
    twice = one.groupBy("h").agg(F.count("*").alias("k")).where("k > 1")
    return (one.where("alone").join(twice, "h")
            .select("th", (F.col("s") + F.col("i")).alias("s"), (F.col("s") + F.col("i") + length).alias("e")))


def repeated_spans(docs: DataFrame, text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                   max_contexts: int = MAX_CONTEXTS, chunk: int = CHUNK, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """(th, s, e): spans of bytes covered by repeated strings, by text key.
    Spans may overlap."""
    rows = common.written(_anchor_rows(common.in_small_batches(docs), text_col, length, gram, chunk), "anchors")
    context = ["g", "c", "d", "n", "o"]
    differ = F.lit(False)
    for x in context[1:]:
        differ = differ | (F.min(x) != F.max(x))
    grams = rows.groupBy("g").agg(F.count("*").alias("k"), differ.alias("mixed")).where("k > 1").select("g", "mixed")
    hits = common.written(rows.join(grams, "g"), "anchor-hits")
    drop_table(rows)
    end = F.col("s") + F.col("n") - 1 + length
    equal = hits.where(~F.col("mixed")).select("th", "s", end.alias("e"))
    classes = common.written(
        hits.where("mixed").groupBy(*context)
        .agg(F.count("*").alias("k"), F.min(F.struct("th", "s")).alias("rep")), "contexts")
    copies = (hits.where("mixed").join(classes.where("k > 1").select(*context), context, "left_semi")
              .select("th", "s", end.alias("e")))
    per_gram = classes.groupBy("g").agg(F.count("*").alias("kinds"))
    reps = (classes.join(per_gram, "g").where("kinds > 1")
            .select("g", "n", "o", (F.col("k") == 1).alias("alone"), "rep.th", "rep.s", "kinds"))
    contexts = common.written(_contexts(reps.where(F.col("kinds") <= max_contexts), docs, text_col, length), "edges")
    spans = equal.unionAll(copies).unionAll(_sorted_edges(contexts, length, batch_bytes))
    crowded = reps.where(F.col("kinds") > max_contexts)
    if not crowded.isEmpty():
        spans = spans.unionAll(_counted_edges(_contexts(crowded, docs, text_col, length), length))
    return spans


RESULT = ("n_bytes", "n_removed", "spans", "kept")


def judged(docs: DataFrame, text_col: str = "text", keep: list | None = None, **settings) -> DataFrame:
    """Every row: its columns ``keep`` as one (``row``), n_bytes, n_removed,
    spans (array of [start, end) of the maximal removed runs) and kept (the
    remaining bytes)."""
    names = keep or ["doc_id"]
    spans = (repeated_spans(docs, text_col, **settings).distinct()
             .groupBy("th").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("w")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
                       F.encode(F.coalesce(text_col, F.lit("")), "UTF-8").alias("b"),
                       text_key(F.col(text_col)).alias("th")).join(spans, "th", "left").select("row", "b", "w")

    def cut(batch):
        sizes, removed, runs, kept = [], [], [], []
        for raw, spans_ in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            merged = []
            for x in spans_ or ():
                if merged and x["s"] <= merged[-1]["e"]:
                    merged[-1]["e"] = max(merged[-1]["e"], x["e"])
                else:
                    merged.append(dict(x))
            at, parts = 0, []
            for x in merged:
                parts.append(raw[at:x["s"]])
                at = x["e"]
            parts.append(raw[at:])
            rest = b"".join(parts)
            sizes.append(len(raw))
            removed.append(len(raw) - len(rest))
            runs.append(merged)
            kept.append(rest)
        span_type = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(runs, span_type), pa.array(kept, pa.binary())], names=["row", *RESULT])

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):  # bounds the rows held at once
                yield cut(batch.slice(lo, 256))

    return rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("n_bytes", T.LongType()),
                                               T.StructField("n_removed", T.LongType()),
                                               T.StructField("spans", T.ArrayType(T.StructType(
                                                   [T.StructField(c, T.LongType()) for c in ("s", "e")]))),
                                               T.StructField("kept", T.BinaryType())]))


def remove_repeats(docs: DataFrame, text_col: str = "text", keep: list | None = None, **settings) -> DataFrame:
    """The columns ``keep`` (default: doc_id) of every row, with the columns
    of ``judged``."""
    taken, named = {*(keep or ["doc_id"]), *RESULT}, []  # names that are in use
    for c in keep or ["doc_id"]:
        as_ = c
        while c in RESULT and as_ in taken:
            as_ += "_"
        taken.add(as_)
        named.append(F.col(f"row.`{c}`").alias(as_))
    return judged(docs, text_col, keep, **settings).select(*named, *RESULT)


common.ship(__name__)
