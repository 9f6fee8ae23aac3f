"""Language identification by interpolated Kneser-Ney character models.

One model per language predicts every letter of a word from up to ``ORDER - 1``
letters before it. Words are runs of letters (with their marks), lower-cased
and closed by a start and an end sign; other characters are not read. With c
the count of a gram (the number of different letters before it, for grams that
are shorter than ``ORDER`` and do not begin a word), D the discount of its
length and h' the context h without its first letter:

    P(x|h) = max(c(hx) - D, 0) / c(h.) + D * types(h.) / c(h.) * P(x|h')

and below the single letters a uniform share of all symbols. A text goes to
the language with the lowest cross-entropy per symbol. How sure that is comes
from a calibration: documents of every sixteenth text (by hash) are judged by
models that have not seen them, and a logistic curve over margin, length and
cross-entropy is fitted to how often they were right. ``accepted`` tells which
predictions stay above the score at which accepted ones err in at most
``MAX_ERROR`` of the calibration documents.

Counts cover all training documents: tasks count the grams of distinct words,
Spark adds them up, and the models are joins over the gram table. For scoring,
each language's grams are sorted arrays of 64-bit hashes beside their values,
found by binary search; each worker keeps the scores of words it has met. The
arrays are broadcast while they hold at most ``MAX_ENTRIES`` entries (checked
by a count before anything is sent). Larger models are not sent anywhere:
``by_join`` then scores the distinct grams of the documents by joins with the
gram table and adds them up per document, with the same results.

Defined results: ``und`` with score 0 for a null text, a text without letters,
and where nothing was learned; ties go to the smaller language name; rows
without language or text teach nothing; repeated rows count each time; texts
and words of any length are read whole; null and repeated ids keep all rows;
an empty table gives no rows. Other columns are not read and do no harm.
"""

from __future__ import annotations

from collections import Counter
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from giftlink.llm import common
from giftlink.llm.cotraining import Logistic, sigmoid
from giftlink.llm.tasks import slices

ORDER = 5
CALIBRATE_EVERY = 16
MAX_ERROR = 0.01
MAX_ENTRIES = 4_000_000  # 16 bytes each
CACHE_WORDS = 200_000
PART = 1 << 20  # letters of a text split at once
START, END = "<", ">"  # no letters
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
GAP = regex.compile(r"[^\p{L}\p{M}]")
UNKNOWN = "und"


def words(text: str) -> list:
    """The words of a text; very long texts are split between words."""
    if len(text) <= PART:
        return WORD.findall(text.lower())
    out, at = [], 0
    while at < len(text):
        gap = GAP.search(text, at + PART)
        stop = gap.end() if gap else len(text)
        out += WORD.findall(text[at:stop].lower())
        at = stop
    return out


def grams(word: str, order: int) -> list:
    """For every symbol after the start sign: it and up to order - 1 before it."""
    s = START + word + END
    return [s[max(0, i - order + 1):i + 1] for i in range(1, len(s))]


def step(h, symbols):
    """The hash of a gram with one more symbol before it."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + symbols + np.uint64(1)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(27))


def codes(text: str):
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


def hashes(many: list):
    """The hashes of grams, from their last symbol to their first."""
    flat, sizes = codes("".join(many)), np.fromiter(map(len, many), np.int64, len(many))
    ends, h = np.cumsum(sizes), np.zeros(len(many), np.uint64)
    for k in range(int(sizes.max(initial=0))):
        on = np.flatnonzero(sizes > k)
        h[on] = step(h[on], flat[ends[on] - 1 - k])
    return h


def windows_of(many: list, counts, order: int):
    """The distinct longest grams of words, and the sums of the words' counts
    (one column each). Grams are told apart by exact codes of their symbols."""
    text = "".join([START + w + END for w in many])
    sizes = np.fromiter(map(len, many), np.int64, len(many)) + 2
    letters, symbols = np.unique(codes(text), return_inverse=True)
    place = np.arange(len(text)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.flatnonzero(place > 0)
    base, code, reach = len(letters) + 1, np.zeros(len(at), np.int64), 1
    for k in range(order):  # 0: before the word
        if reach * base >= 1 << 62:
            distinct, code = np.unique(code, return_inverse=True)
            reach = len(distinct)
        code = code * base + np.where(place[at] >= k, symbols[np.maximum(at - k, 0)] + 1, 0)
        reach *= base
    _, first, inverse = np.unique(code, return_index=True, return_inverse=True)
    word = np.repeat(np.arange(len(many)), sizes)[at]
    sums = [np.zeros(len(first), np.int64) for _ in range(counts.shape[1])]
    for k, total in enumerate(sums):
        np.add.at(total, inverse, counts[word, k])
    ends = at[first]
    starts = ends - np.minimum(place[ends], order - 1)
    return [text[i:j] for i, j in zip(starts.tolist(), (ends + 1).tolist())], sums


def _count(order: int):
    def run(batches):
        held, size = {}, 0

        def out():
            for lang, (every, fit) in held.items():
                many = list(every)
                for lo in range(0, len(many), 1 << 16):
                    part = many[lo:lo + (1 << 16)]
                    keys, sums = windows_of(part, np.array([(every[w], fit[w]) for w in part], np.int64), order)
                    yield pa.record_batch({"lang": [lang] * len(keys), "gram": keys, "n": pa.array(sums[0]),
                                           "n_fit": pa.array(sums[1])})

        for b in batches:
            for lang, text, fold in zip(*(c.to_pylist() for c in b.columns)):
                every, fit = held.setdefault(lang, (Counter(), Counter()))
                before, own = len(every), words(text)
                every.update(own)
                if not fold:
                    fit.update(own)
                size += len(every) - before
                if size > CACHE_WORDS:
                    yield from out()
                    held, size = {}, 0
        yield from out()
    return run


class Tables:
    """The models as tables: grams (lang, gram, v) with their discounted
    shares, contexts (lang, gram, v) with the weight of what lies below, and
    the number of symbols."""

    def __init__(self, windows: DataFrame, column: str, order: int):
        counts = windows.where(F.col(column) > 0).select("lang", "gram", F.col(column).alias("c"))
        level = counts.where(F.length("gram") == order)
        levels = [level.withColumn("n", F.lit(order))]
        for n in range(order - 1, 0, -1):
            begins = counts.where((F.length("gram") == n) & F.col("gram").startswith(START))
            level = begins.unionByName(level.groupBy("lang", F.expr(f"substring(gram, 2, {n})").alias("gram"))
                                       .agg(F.count("*").alias("c")))
            levels.append(level.withColumn("n", F.lit(n)))
        every = levels[0]
        for x in levels[1:]:
            every = every.unionByName(x)
        every = common.written(every, "grams").withColumn("ctx", F.expr("left(gram, n - 1)"))
        once, twice = (F.sum((F.col("c") == k).cast("long")) for k in (1, 2))
        # n1 / (n1 + 2 n2), kept off 0 and 1 where there are few grams
        cut = every.groupBy("lang", "n").agg(((once + 0.5) / (once + 2 * twice + 1.0)).alias("d"))
        ctx = (every.groupBy("lang", "n", "ctx").agg(F.sum("c").alias("t"), F.count("*").alias("k"))
               .join(cut, ["lang", "n"]))
        self.grams = (every.join(ctx.select("lang", "n", "ctx", "t", "d"), ["lang", "n", "ctx"])
                      .select("lang", "gram", ((F.col("c") - F.col("d")) / F.col("t")).alias("v")))
        self.contexts = ctx.select("lang", F.col("ctx").alias("gram"), (F.col("d") * F.col("k") / F.col("t")).alias("v"))
        self.langs = [r[0] for r in windows.select("lang").distinct().orderBy("lang").collect()]
        symbols = every.where("n = 1").select("gram").distinct().count() if self.langs else 0
        self.floor, self.order = 1.0 / (symbols + 1), order

    def union(self) -> DataFrame:
        return common.written(self.grams.select("lang", F.lit(0).alias("kind"), "gram", "v").unionByName(
            self.contexts.select("lang", F.lit(1).alias("kind"), "gram", "v")), "model")


def _hash_rows(batches):
    for b in batches:
        yield pa.record_batch({"lang": b["lang"], "kind": b["kind"],
                               "h": pa.array(hashes(b["gram"].to_pylist()).view(np.int64)), "v": b["v"]})


class Arrays:
    """One language after the other: sorted gram hashes with their shares,
    sorted context hashes with their weights."""

    def __init__(self, langs: list, order: int, floor: float, model: DataFrame):
        self.langs, self.order, self.floor, self.models = langs, order, floor, []
        rows = model.mapInArrow(_hash_rows, "lang string, kind int, h long, v double").toArrow()
        lang, kind = (rows[c].to_numpy() for c in ("lang", "kind"))
        h, v = rows["h"].to_numpy().astype(np.int64).view(np.uint64), rows["v"].to_numpy()
        for name in langs:
            own = lang == name
            self.models.append([x for k in (0, 1) for x in self._sorted(h[own & (kind == k)], v[own & (kind == k)])])

    @staticmethod
    def _sorted(h, v):
        at = np.argsort(h, kind="stable")
        return h[at], v[at]

    @staticmethod
    def _find(keys, values, h, missing: float):
        if not len(keys):
            return np.full(len(h), missing)
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        return np.where(keys[at] == h, values[at], missing)

    def word_scores(self, many: list):
        """Log-probabilities (words, languages) and the words' symbols."""
        flat = codes("".join([START + w + END for w in many]))
        sizes = np.fromiter(map(len, many), np.int64, len(many)) + 2
        starts = np.cumsum(sizes) - sizes
        place = np.arange(len(flat)) - np.repeat(starts, sizes)  # 0: the start sign
        chain = [np.zeros(len(flat), np.uint64)]
        for n in range(1, self.order + 1):
            on = np.flatnonzero(place >= n - 1)
            h = chain[-1].copy()
            h[on] = step(h[on], flat[on - n + 1])
            chain.append(h)
        at = np.flatnonzero(place > 0)
        # everything follows from the longest gram: look up distinct ones only
        _, first, inverse = np.unique(chain[-1][at], return_index=True, return_inverse=True)
        pick, out = at[first], np.empty((len(many), len(self.langs)))
        depth = np.minimum(place[pick] + 1, self.order)
        p = np.full((len(self.langs), len(pick)), self.floor)
        for n in range(1, self.order + 1):
            # few distinct keys, in order, serve all models
            on = np.flatnonzero(depth >= n)
            keys, key_of = np.unique(chain[n][pick[on]], return_inverse=True)
            below, below_of = np.unique(chain[n - 1][pick[on] - 1] if n > 1 else np.zeros(len(on), np.uint64),
                                        return_inverse=True)
            for k, (gh, gv, ch, cv) in enumerate(self.models):
                p[k, on] = (self._find(gh, gv, keys, 0.0)[key_of] + self._find(ch, cv, below, 1.0)[below_of] * p[k, on])
        for k in range(len(self.langs)):
            each = np.zeros(len(flat))
            each[at] = np.log(p[k])[inverse]
            out[:, k] = np.add.reduceat(each, starts)
        return out, sizes - 1


class Numbers(dict):
    """Words numbered as they come."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def _sums(model: Arrays):
    """Of lists of texts: log-probabilities (texts, languages) and symbols."""
    known, scores, symbols = Numbers(), np.zeros((0, len(model.langs))), np.zeros(0, np.int64)

    def run(texts: list):
        nonlocal known, scores, symbols
        if len(known) > CACHE_WORDS:
            known, scores, symbols = Numbers(), scores[:0], symbols[:0]
        numbers = []
        for t in texts:
            own = words(t or "")
            numbers.append(np.fromiter(map(known.__getitem__, own), np.int64, len(own)))
        done = len(symbols)
        if len(known) > done:
            new, length = model.word_scores(list(islice(known, done, None)))
            scores, symbols = np.vstack([scores, new]), np.concatenate([symbols, length])
        total, n = np.zeros((len(texts), len(model.langs))), np.zeros(len(texts), np.int64)
        for i, own in enumerate(numbers):
            if len(own):
                total[i], n[i] = scores[own].sum(0), symbols[own].sum()
        return total, n
    return run


def _judge(total, n):
    """Best language's number (-1: none), margin, cross-entropy, symbols."""
    ok = n > 0
    h = -total / np.maximum(n, 1)[:, None]
    best = np.where(ok, h.argmin(1), -1) if h.shape[1] else np.full(len(n), -1)
    low = np.sort(h, 1)
    h1 = low[:, 0] if h.shape[1] else np.zeros(len(n))
    margin = low[:, 1] - low[:, 0] if h.shape[1] > 1 else np.full(len(n), 10.0)
    return best, np.where(ok, margin, 0.0), np.where(ok, h1, 0.0)


JUDGED = "best int, margin double, entropy double, symbols long"


def by_arrays(docs: DataFrame, model: Arrays, keep: str) -> DataFrame:
    """``keep`` and the judgement of every row, from broadcast arrays."""
    names, sent = keep.split(","), docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        sums = _sums(sent.value)
        for b in slices(batches):
            total, n = sums(b.column(0).to_pylist())
            best, margin, h1 = _judge(total, n)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[1:], pa.array(best, pa.int32()), pa.array(margin), pa.array(h1), pa.array(n)],
                names=[*names, "best", "margin", "entropy", "symbols"])

    return (common.in_small_batches(docs).select(F.col("text").alias("_text"), *names)
            .mapInArrow(run, common.schema_of(docs, keep, JUDGED)))


def by_join(docs: DataFrame, tables: Tables, model: DataFrame, keep: str) -> DataFrame:
    """The same by joins, for models of any size: every document's distinct
    longest grams, scored once each."""
    names, order = keep.split(","), tables.order

    def run(batches):
        row = TaskContext.get().partitionId() << 40
        for b in slices(batches):
            for i, text in enumerate(b.column(0).to_pylist()):
                seen = Counter(g for w in words(text or "") for g in grams(w, order)) or {None: 0}
                keys, own = list(seen), [c.slice(i, 1) for c in b.columns[1:]]
                same = pa.array(np.zeros(len(keys), np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), row)), pa.array(keys, pa.string()),
                     pa.array(list(seen.values()), pa.int64()), *[c.take(same) for c in own]],
                    names=["_row", "_gram", "_n", *names])
                row += 1

    found = common.written(
        common.in_small_batches(docs).select(F.col("text").alias("_text"), *names)
        .mapInArrow(run, "_row long, _gram string, _n long, " + common.schema_of(docs, keep, "").rstrip(", ")), "doc-grams")
    langs = F.array(*[F.lit(x) for x in tables.langs])
    # for each gram: its values, one place a language
    wide = (model.groupBy("kind", "gram").agg(F.map_from_entries(F.collect_list(F.struct("lang", "v"))).alias("m")))
    scored = found.where("_gram is not null").select("_gram").distinct().withColumn(
        "_p", F.transform(langs, lambda _: F.lit(tables.floor)))
    for n in range(1, order + 1):
        end = F.expr(f"right(_gram, {n})")
        for kind, gram, name in ((0, end, "_a"), (1, F.expr(f"left(right(_gram, {n}), {n - 1})"), "_b")):
            # grams too short for this length keep what they have
            side = wide.where(F.col("kind") == kind).select(F.col("gram").alias("_k"), F.col("m").alias(name))
            key = F.when(F.length("_gram") >= n, gram)
            scored = scored.withColumn("_k", key).join(side, "_k", "left").drop("_k")
        value = lambda m, lang, missing: F.coalesce(F.try_element_at(m, lang), F.lit(missing))
        scored = scored.withColumn("_p", F.when(F.length("_gram") < n, F.col("_p")).otherwise(F.zip_with(
            langs, "_p", lambda x, p: value(F.col("_a"), x, 0.0) + value(F.col("_b"), x, 1.0) * p))).drop("_a", "_b")
    logs = scored.select("_gram", F.transform("_p", lambda p: F.log(p)).alias("_p"))
    sums = (found.join(logs, "_gram", "left").groupBy("_row", *names)
            .agg(F.sum("_n").alias("symbols"),
                 *[F.coalesce(F.sum(F.col("_n") * F.col("_p")[i]), F.lit(0.0)).alias(f"_s{i}")
                   for i in range(len(tables.langs))]))
    h = F.array(*[-F.col(f"_s{i}") / F.greatest("symbols", F.lit(1)) for i in range(len(tables.langs))])
    low = F.array_sort("_h")
    some = F.col("symbols") > 0
    return (sums.withColumn("_h", h).select(
        *names, F.when(some, (F.array_position("_h", F.array_min("_h")) - 1).cast("int")).otherwise(-1).alias("best"),
        F.when(some, low[1] - low[0] if len(tables.langs) > 1 else F.lit(10.0)).otherwise(0.0).alias("margin"),
        F.when(some, F.array_min("_h")).otherwise(0.0).alias("entropy"), "symbols"))


def _place(margin, entropy, symbols):
    """Columns of the calibration curve."""
    return np.column_stack([np.minimum(margin, 4.0), np.log2(np.maximum(symbols, 1)), np.minimum(entropy, 12.0)])


class Calibration:
    """How often predictions of a kind were right: a logistic curve over
    binned calibration documents (at most 81 x 41 x 49 bins)."""

    def __init__(self, bins: list, max_error: float):
        self.curve, self.least = None, 0.5
        n, right = (np.array([r[k] for r in bins], np.float64) for k in ("n", "right"))
        if not n.sum():
            return
        x = _place(np.array([(r["m"] + 0.5) / 20 for r in bins]), np.array([(r["e"] + 0.5) / 4 for r in bins]),
                   2.0 ** np.array([r["s"] + 0.5 for r in bins]))
        both = np.concatenate([right, n - right])
        self.curve = Logistic(np.vstack([x, x]), np.repeat([1.0, 0.0], len(x)), both)
        p = self.score(*[np.array(v) for v in ([(r["m"] + 0.5) / 20 for r in bins], [(r["e"] + 0.5) / 4 for r in bins],
                                               [2.0 ** (r["s"] + 0.5) for r in bins])])
        order = np.argsort(-p)
        error = np.cumsum((n - right)[order]) / np.cumsum(n[order])
        good = np.flatnonzero(error <= max_error)
        self.least = float(p[order][good[-1]]) if len(good) else 1.0

    def score(self, margin, entropy, symbols):
        if self.curve is None:
            return 1.0 / (1.0 + np.exp(-np.minimum(margin * np.minimum(symbols, 50), 35)))
        return sigmoid(self.curve.logit(_place(margin, entropy, symbols)))


def calibrate(judged: DataFrame, langs: list, max_error: float) -> Calibration:
    """From judged documents with their true language ``lang``."""
    names = F.array(*[F.lit(x) for x in langs])
    right = (F.element_at(names, F.col("best") + 1) == F.col("lang")).cast("long")
    bins = (judged.where("best >= 0").select(
        F.least(F.floor(F.col("margin") * 20), F.lit(80)).cast("int").alias("m"),
        F.floor(F.log2("symbols")).cast("int").alias("s"),
        F.least(F.floor(F.col("entropy") * 4), F.lit(48)).cast("int").alias("e"), right.alias("right"))
        .groupBy("m", "s", "e").agg(F.count("*").alias("n"), F.sum("right").alias("right"))
        .orderBy("m", "s", "e").collect())
    return Calibration([r.asDict() for r in bins], max_error)


class Identifier:
    """Models and calibration learned from ``train`` (text, lang)."""

    def __init__(self, train: DataFrame, order: int = ORDER, calibrate_every: int = CALIBRATE_EVERY,
                 max_error: float = MAX_ERROR, max_entries: int = MAX_ENTRIES):
        train = train.where("lang is not null and text is not null").select(
            "lang", "text", (F.pmod(F.xxhash64("text"), F.lit(calibrate_every)) == 0).alias("fold"))
        windows = common.written(
            common.in_small_batches(train).mapInArrow(_count(order), "lang string, gram string, n long, n_fit long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n"), F.sum("n_fit").alias("n_fit")), "windows")
        self.max_entries = max_entries
        part = self._load(Tables(windows, "n_fit", order))
        judged = self._apply(train.where("fold").select("text", "lang"), part, "lang")
        self.curve = calibrate(judged, part[0].langs, max_error)
        self.model = self._load(Tables(windows, "n", order))
        self.langs = self.model[0].langs

    def _load(self, tables: Tables) -> tuple:
        """(tables, their rows, arrays or None)."""
        rows = tables.union()
        if rows.count() > self.max_entries:
            return tables, rows, None
        return tables, rows, Arrays(tables.langs, tables.order, tables.floor, rows)

    @staticmethod
    def _apply(docs: DataFrame, model: tuple, keep: str) -> DataFrame:
        tables, rows, arrays = model
        return by_join(docs, tables, rows, keep) if arrays is None else by_arrays(docs, arrays, keep)

    def predict(self, docs: DataFrame, keep: str = "doc_id") -> DataFrame:
        """``keep`` (comma separated) with lang_pred, score, accepted, entropy
        (nats a symbol), margin to the second language, and symbols, for every row."""
        curve, langs, names = self.curve, self.langs, keep.split(",")

        def finish(batches):
            for b in batches:
                best, margin, h1, n = (b[c].to_numpy(zero_copy_only=False)
                                       for c in ("best", "margin", "entropy", "symbols"))
                some = best >= 0
                score = np.where(some, curve.score(margin, h1, n), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [*[b[c] for c in names], pa.array([langs[i] if i >= 0 else UNKNOWN for i in best.tolist()]),
                     pa.array(score), pa.array(some & (score >= curve.least)), b["entropy"], b["margin"], b["symbols"]],
                    names=[*names, "lang_pred", "score", "accepted", "entropy", "margin", "symbols"])

        if not langs:
            return docs.select(*names, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
                               F.lit(False).alias("accepted"), F.lit(0.0).alias("entropy"),
                               F.lit(0.0).alias("margin"), F.lit(0).cast("long").alias("symbols"))
        judged = self._apply(docs, self.model, keep)
        return judged.mapInArrow(finish, common.schema_of(
            docs, keep, "lang_pred string, score double, accepted boolean, entropy double, margin double, symbols long"))


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from: CRC-32 of the id leaves 1 by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


common.ship(__name__)
common.ship("giftlink.llm.cotraining")
