"""MinHash near-dedup: Order MinHash.

A text is the sequence of its lower-cased words; its k-mers are shingles of
five words, each labelled with how often it has occurred before. A sketch
takes the ``in_order`` shingles with the smallest hashes and keeps them in
their order in the text, so it changes when content is moved. ``sketches``
independent sketches are made per text; texts that agree on one whole sketch
are candidates. A candidate pair is a link if a banded alignment of the two
word sequences reaches ``threshold``: 2 * aligned words / all words. The band
holds the diagonals that the insertions and deletions still allowed can reach;
in it the longest common subsequence is found bit by bit, a word of the one
text against all words of the other at once. Classes are the connected
components of the links.

Candidate rule and recall: with one word in r replaced at random, two texts
share about (1 - 1/r)**5 of their shingles. Two-shingle sketches, 20 of them,
then miss a pair whose alignment is 0.95 with probability under 0.001, and at
0.9 with 0.02; nearer to 0.8 the sketches see fewer (about four in five at
0.85). Tests hold the classes against all pairs.

Scale: exact copies are collapsed to one text first (partial aggregate).
First every text of a bucket is paired with the bucket's hub, the text that
shares most buckets with others, so a group of copies of one text costs one
pair per copy, however large. Then buckets that still hold several classes are
looked at again, between different classes only: up to ``small`` texts by all
their pairs, larger ones bucketed once more by pairs of sketches, which
separates texts that merely share a hot passage. The texts of large buckets
that hold several classes even then are compared without a cap
(``close_pairs``): with a text's labelled shingles ordered from the rarest on,
two texts with a shingle similarity of ``threshold`` share one so early that
enough shingles follow in both, so these pairs are found by a join on those
first shingles. No row is capped or sampled.

Texts are told apart by 128 bits of their SHA-256. Texts that share a bucket
are fetched and written once and later joins read only those.

Defined results: texts without words (null, empty, white space) are copies of
each other; texts under five words are one shingle; repeated rows and
repeated ids each keep their row; a class's id is its smallest document id
(null only if all are null); an empty table gives no rows; other columns than
id and text are not read by ``near_duplicates``, and ``deduplicate`` returns
them as they are, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from giftlink.llm import common
from giftlink.llm.tasks import slices, worker_state
from giftlink.llm.components import components
from giftlink.session import drop_table

SHINGLE = 5
IN_ORDER = 2
SKETCHES = 20
THRESHOLD = 0.8
SMALL = 12
OFFSETS = (1, 2, 5, 9)  # partners of a sketch in the second bucketing
CACHE_WORDS = 200_000
SLOTS = 1 << 22  # counters of shingle frequencies, a byte each
CHUNK = 256  # texts of one class in a block of the exact comparison
ALIGN_WORDS = 4096  # words of a text in one row of bits

MULT = np.uint64(0x9E3779B97F4A7C15)
BASE = np.uint64(0xBF58476D1CE4E5B9)


def mix(h):
    """A bijective scramble of 64-bit values (multiply and shift)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(words: list, cache: dict):
    """64-bit hashes of words; repeated words come from a bounded cache."""
    import xxhash
    digest, out = xxhash.xxh64_intdigest, []
    for w in words:
        h = cache.get(w)
        if h is None:
            h = digest(w.encode("utf-8", "surrogatepass"))
            if len(cache) >= CACHE_WORDS:
                cache.clear()
            cache[w] = h
        out.append(h)
    return np.array(out, dtype=np.uint64)


def shingles(hashes, k: int = SHINGLE):
    """Hashes of the k-word shingles, in order; a shorter text is one."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(k, n)
    h = np.full(n - width + 1, np.uint64(width))
    for i in range(width):
        h = h * BASE + hashes[i:n - width + 1 + i]
    return mix(h)


def labelled(s):
    """Each shingle hashed with its number of earlier occurrences."""
    order = np.argsort(s, kind="stable")
    v = s[order]
    new = np.ones(len(v), bool)
    new[1:] = v[1:] != v[:-1]
    if new.all():
        return mix(s)
    at = np.arange(len(v))
    nth = np.empty(len(v), np.uint64)
    nth[order] = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64)
    return mix(s + nth * MULT)


def sketch(s, in_order: int = IN_ORDER, n: int = SKETCHES) -> np.ndarray:
    """``n`` sketches of labelled shingles, one 64-bit value each."""
    seeds = mix(np.arange(1, n + 1, dtype=np.uint64) * MULT)
    take = min(in_order, len(s))
    at_once = max(1, 1_000_000 // len(s))  # bounds the memory of long texts
    out = []
    for i in range(0, n, at_once):
        seed = seeds[i:i + at_once]
        h = mix(s[None, :] ^ seed[:, None])
        at = np.argpartition(h, take - 1, axis=1)[:, :take]
        at.sort(axis=1)  # back in text order
        v = seed.copy()
        for x in s[at].T:
            v = v * BASE + x
        out.append(mix(v))
    return np.concatenate(out)


def aligned(a, b, threshold: float = THRESHOLD) -> bool:
    """Banded alignment: whether two sequences can be aligned so that
    2 * matches / (len(a) + len(b)) reaches ``threshold``.

    The longest common subsequence by bits: a row has a bit for each place of
    ``a``, cleared where the count grows by one; a word of ``b`` updates the
    whole row with one addition. Only matches inside the band count; an
    alignment that reaches the threshold never leaves it. Long sequences take
    several rows, with the carries of one handed to the next."""
    total = len(a) + len(b)
    if not len(a) or not len(b):
        return total == 0
    same = min(len(a), len(b))
    head = int(np.argmin(np.append(a[:same] == b[:same], False)))
    a, b = a[head:], b[head:]
    same = min(len(a), len(b))
    tail = int(np.argmin(np.append(a[::-1][:same] == b[::-1][:same], False)))
    a, b = a[:len(a) - tail].tolist(), b[:len(b) - tail].tolist()
    need = -int(-(threshold * total / 2 - 1e-9) // 1) - head - tail  # matches still wanted
    n, m = len(a), len(b)
    if need <= 0:
        return True
    if min(n, m) < need:
        return False
    band = int((1 - threshold) * total + 1e-9)
    found, carries = 0, None
    for lo in range(0, n, ALIGN_WORDS):
        part = a[lo:lo + ALIGN_WORDS]
        places = {}
        for i, w in enumerate(part):
            places[w] = places.get(w, 0) | 1 << i
        width, at_most = len(part), n - lo - len(part)
        full = row = (1 << width) - 1
        out = bytearray(m) if at_most else None
        for j, w in enumerate(b):
            match = row & places.get(w, 0)
            if match:
                low, high = j - band - lo, j + band + 1 - lo
                if low > 0:
                    match = match >> low << low
                if high < width:
                    match &= (1 << max(high, 0)) - 1
            carry = carries[j] if carries is not None else 0
            if match or carry:
                grown = row + match + carry
                row = (grown | (row ^ match)) & full
                if out is not None:
                    out[j] = grown >> width
            if not j & 255 and carries is None and out is None and width - row.bit_count() + m - j - 1 < need:
                return False
        found += width - row.bit_count()
        if found >= need:
            return True
        if found + at_most < need:
            return False
        carries = out
    return False


def similar(ta: str, tb: str, threshold: float, cache: dict) -> bool:
    a, b = (word_hashes((t or "").lower().split(), cache) for t in (ta, tb))
    return aligned(a, b, threshold)


def text_key(text):
    """128-bit key of a text; null and empty texts share one."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)), 1, 16)


def _sketched(docs: DataFrame, id_col: str, text_col: str, in_order: int, sketches: int) -> DataFrame:
    names = [id_col, "th", "sk"]

    def run(batches):
        cache = worker_state("order_minhash", dict)
        for b in slices(batches):
            out = []
            for t in b.column(2).to_pylist():
                w = word_hashes((t or "").lower().split(), cache)
                # all texts without words agree on all sketches
                s = labelled(shingles(w)) if len(w) else np.zeros(1, np.uint64)
                out.append(sketch(s, in_order, sketches).view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.list_(pa.int64()))],
                                             names=names)

    return (docs.select(id_col, text_key(F.col(text_col)).alias("th"), text_col)
            .mapInArrow(run, common.schema_of(docs, id_col, "th binary, sk array<bigint>")))


def _stars(rows: DataFrame, above: int = 1) -> DataFrame:
    """Candidate pairs (a, b) of bucket rows (key, th, deg, root): each text
    of a bucket of more than ``above`` with its hub, unless both are in one
    class (``root``) already."""
    hubs = (rows.groupBy("key").agg(F.count("*").alias("n"), F.max(F.struct("deg", "th", "root")).alias("hub"))
            .where(F.col("n") > above).select("key", "hub"))
    return (rows.join(hubs, "key").where((F.col("th") != F.col("hub.th")) & (F.col("root") != F.col("hub.root")))
            .select(F.least(F.col("th"), F.col("hub.th")).alias("a"), F.greatest(F.col("th"), F.col("hub.th")).alias("b"))
            .distinct())


def _all_pairs(rows: DataFrame, small: int) -> DataFrame:
    """All pairs (a, b) of different classes in buckets of up to ``small``."""
    little = (rows.groupBy("key").agg(F.count("*").alias("n")).where((F.col("n") > 1) & (F.col("n") <= small)))
    held = (rows.join(little.select("key"), "key", "left_semi").groupBy("key")
            .agg(F.sort_array(F.collect_list(F.struct("th", "root"))).alias("m")))
    one = held.select(F.explode("m").alias("x"), "m")
    return (one.select("x", F.explode(F.filter("m", lambda y: (y["th"] > F.col("x.th")) & (y["root"] != F.col("x.root"))))
                       .alias("y")).select(F.col("x.th").alias("a"), F.col("y.th").alias("b")).distinct())


def shared_buckets(texts: DataFrame) -> DataFrame:
    """(t, s, n, th, deg): each text's sketches that others have too, the
    bucket's size, and the sum of the text's bucket sizes."""
    rows = texts.select("th", F.posexplode("sk").alias("t", "s"))
    sizes = rows.groupBy("t", "s").agg(F.count("*").alias("n")).where("n > 1")
    shared = common.written(rows.join(sizes, ["t", "s"]), "buckets")
    out = common.written(shared.join(shared.groupBy("th").agg(F.sum("n").alias("deg")), "th"), "degrees")
    drop_table(shared)
    return out


def mixed_texts(shared: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of ``shared`` in buckets that hold several classes, with each
    text's class (``root``)."""
    rooted = (shared.join(classes.withColumnRenamed("v", "th"), "th", "left")
              .withColumn("root", F.coalesce("root", "th")))
    mixed = (rooted.groupBy("t", "s").agg(F.min("root").alias("r1"), F.max("root").alias("r2"))
             .where("r1 <> r2").select("t", "s"))
    return rooted.join(mixed, ["t", "s"])


def linked(rows: DataFrame, docs: DataFrame, threshold: float, text_col: str, small: int,
           offsets: tuple = OFFSETS) -> DataFrame:
    """(v, root): classes of the texts (th, sk) that have a link."""
    shared = shared_buckets(rows)
    wanted = shared.select("th").distinct()
    texts = common.written(
        docs.select(text_key(F.col(text_col)).alias("th"), F.col(text_col).alias("text"))
        .join(wanted, "th", "left_semi").groupBy("th").agg(F.first("text").alias("text")), "texts")
    key = F.struct("t", "s").alias("key")
    tried = common.written(_stars(shared.select(key, "th", "deg", F.col("th").alias("root"))), "stars")
    links = common.written(verified(tried, texts, threshold), "verified")
    classes = components(links)

    open_ = common.written(mixed_texts(shared, classes), "mixed")
    again = (open_.where(F.col("n") > small).join(rows, "th")
             .withColumn("o", F.explode(F.array(*[F.lit(o) for o in offsets]))).select(
        F.struct("t", "s", "o", F.get("sk", (F.col("t") + F.col("o")) % F.size("sk")).alias("s2")).alias("key"),
        "th", "deg", "root"))
    few = _all_pairs(open_.where(F.col("n") <= small).select(key, "th", "root"), small)
    more = common.written(few.unionByName(_all_pairs(again, small)).unionByName(_stars(again, small)).distinct()
                          .join(tried, ["a", "b"], "left_anti"), "more")
    if not more.isEmpty():
        links = common.written(links.unionByName(verified(more, texts, threshold)), "verified")
        classes = components(links)
        open_ = mixed_texts(shared, classes)
    # what is still mixed in large buckets is compared exactly
    rest = common.written(open_.where(F.col("n") > small).select("th", "root").distinct(), "rest")
    if rest.isEmpty():
        return classes
    pairs = close_pairs(rest, texts, threshold)
    pairs = common.written(pairs.join(tried, ["a", "b"], "left_anti").join(more, ["a", "b"], "left_anti"), "close")
    found = common.written(verified(pairs, texts, threshold), "found")
    return classes if found.isEmpty() else components(links.unionByName(found))


def first_shingles(s, counts, threshold: float):
    """(shingles, places): the labelled shingles of a text, from the rarest
    on, of which a text with similarity ``threshold`` shares one at least.
    Those that no other text has are left out."""
    n = len(s)
    c = counts[(s % np.uint64(len(counts))).astype(np.int64)]
    order = np.lexsort((s, c))[:int((1 - threshold) * n + 1e-6) + 1]
    at = np.flatnonzero(c[order] > 1)
    return s[order[at]], at


def close_pairs(rest: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """All pairs (a, b) of the texts ``rest`` (th, root) in different classes
    that can be similar. In the order by frequency, the first shingle that
    two texts share has all others they share behind it: it is a match only
    if enough shingles follow in both."""
    texts = common.written(texts.join(rest, "th"), "rest-texts")

    def shingled(t, cache):
        w = word_hashes((t or "").lower().split(), cache)
        return labelled(shingles(w)) if len(w) else np.zeros(1, np.uint64)

    def count(batches):
        cache, total = worker_state("order_minhash", dict), np.zeros(SLOTS, np.int64)
        for b in batches:
            for t in b.column(0):
                total += np.bincount((shingled(t.as_py(), cache) % np.uint64(SLOTS)).astype(np.int64),
                                     minlength=SLOTS)
        at = np.flatnonzero(total)
        for lo in range(0, len(at), 10_000):
            part = at[lo:lo + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], names=["slot", "n"])

    frequency = (texts.select("text").mapInArrow(count, "slot bigint, n bigint")
                 .groupBy("slot").agg(F.sum("n").alias("n")).toArrow())  # at most SLOTS rows
    counts = np.zeros(SLOTS, np.uint8)  # any order serves; frequent ones need no telling apart
    counts[frequency["slot"].to_numpy()] = np.minimum(frequency["n"].to_numpy(), 255)

    def first(batches):
        cache = worker_state("order_minhash", dict)
        for b in slices(batches):
            found = [(len(s), *first_shingles(s, counts, threshold))
                     for s in (shingled(t, cache) for t in b.column(2).to_pylist())]
            many = [len(x[1]) for x in found]
            row = np.repeat(np.arange(len(found)), many)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row)),
                 pa.array(np.concatenate([x[1] for x in found]).view(np.int64)),
                 pa.array(np.repeat([x[0] for x in found], many).astype(np.int32)),
                 pa.array(np.repeat([x[0] for x in found], many).astype(np.int32)
                          - np.concatenate([x[2] for x in found]).astype(np.int32))],
                names=["th", "root", "g", "n", "left"])

    rows = common.written(texts.select("th", "root", "text").mapInArrow(
        first, "th binary, root binary, g bigint, n int, left int"), "first")
    # texts of one class stand together, in blocks, and are not compared
    sizes = rows.groupBy("g", "root").agg(F.count("*").alias("size"))
    several = sizes.groupBy("g").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).where("r1 <> r2")
    blocks = (rows.join(sizes.join(several.select("g"), "g"), ["g", "root"])
              .withColumn("chunk", F.pmod(F.xxhash64("th"), F.ceil(F.col("size") / CHUNK)))
              .groupBy("g", "root", "chunk").agg(F.collect_list(F.struct("th", "n", "left")).alias("m"),
                                                 F.min("n").alias("n"), F.max("left").alias("left")))
    blocks = common.written(blocks.drop("chunk"), "blocks")
    need = threshold / (1 + threshold)

    def fits(x, y):
        return F.least(x("left"), y("left")) >= need * (x("n") + y("n")) - 1e-6

    x, y = blocks.alias("x"), blocks.alias("y")
    both = x.join(y, (F.col("x.g") == F.col("y.g")) & (F.col("x.root") < F.col("y.root"))
                  & fits(lambda c: F.col(f"x.{c}"), lambda c: F.col(f"y.{c}")))
    # one text of the one block after the other, and only then its partners
    one = both.select(F.explode("x.m").alias("p"), F.col("y.m").alias("m"))
    pairs = one.select("p", F.explode(F.filter("m", lambda q: fits(F.col("p").getField, q.getField))).alias("q"))
    return pairs.select(F.least("p.th", "q.th").alias("a"), F.greatest("p.th", "q.th").alias("b")).distinct()


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of ``texts`` (th, text) that pass the banded alignment."""
    both = (pairs.join(texts.select(F.col("th").alias("a"), F.col("text").alias("ta")), "a")
            .join(texts.select(F.col("th").alias("b"), F.col("text").alias("tb")), "b"))

    def run(batches):
        cache = worker_state("order_minhash", dict)
        for b in batches:
            ok = [similar(x.as_py(), y.as_py(), threshold, cache) for x, y in zip(b.column(2), b.column(3))]
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], names=["a", "b"])

    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a binary, b binary")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                    in_order: int = IN_ORDER, sketches: int = SKETCHES, small: int = SMALL) -> DataFrame:
    """(id, class_id, class_rows, th, root) of every row: its class and the
    class's number of rows. ``th`` is the text's key, ``root`` the class's."""
    rows = common.written(_sketched(common.in_small_batches(docs), id_col, text_col, in_order, sketches), "sketches")
    sketched = rows.groupBy("th").agg(F.first("sk").alias("sk"))  # equal texts have equal sketches
    classes = linked(sketched, docs, threshold, text_col, small)
    member = (rows.select(id_col, "th").join(classes.withColumnRenamed("v", "th"), "th", "left")
              .select(id_col, "th", F.coalesce("root", "th").alias("root")))
    ids = member.groupBy("root").agg(F.min(id_col).alias("class_id"), F.count("*").alias("class_rows"))
    return member.join(ids, "root").select(id_col, "class_id", "class_rows", "th", "root")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs`` with one row of each class: the smallest id (nulls last),
    then the smallest text key; of rows that repeat both, the one with the
    smallest row hash. All columns come back as they are."""
    classes = near_duplicates(docs, id_col, text_col, **settings)
    chosen = (classes.groupBy("root")
              .agg(F.min(F.struct(F.col(id_col).isNull().alias("u"), F.col(id_col).alias("i"), "th")).alias("k"))
              .select(F.col("k.i").alias("_i"), F.col("k.th").alias("_t")))
    # all columns travel as one, so that none can clash
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("i"),
                       text_key(F.col(text_col)).alias("th"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("h"))
    kept = rows.join(chosen, (F.col("th") == F.col("_t")) & F.col("i").eqNullSafe(F.col("_i")), "left_semi")
    one = W.partitionBy("th", "i").orderBy("h")
    return kept.withColumn("k", F.row_number().over(one)).where("k = 1").select("row.*")


common.ship(__name__)
