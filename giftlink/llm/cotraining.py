"""Quality classifier: co-training of a text view and a metadata view.

Two logistic models see different sides of a document: ``text`` its words and
characters, ``meta`` its language, source, length and line layout. Both start
from the labelled rows. In each round every unlabelled document is scored by
both; the texts one view is confident about and has not taught yet become
pseudo-labelled training rows of the *other* view, each text once. At the end both views are calibrated on
labelled rows that no model was fitted on (Platt scaling), a small logistic
model combines the two calibrated views, and every document is scored.

What is bounded: the fit uses at most ``max_labelled`` labelled rows (a hash
sample, the same at every run) and at most ``per_round`` pseudo-labels per
view, class and round, as the method itself prescribes; both are parameters.
Confident documents are looked for among all documents, and all documents
are scored. Features are computed by Spark tasks; only the bounded training
rows reach the driver, where the two small models are fitted.

Defined results: null and empty texts have all-zero text features and are
scored like any other row; null metadata count as a value of their own; null
or duplicate document ids keep all their rows; a document labelled twice
takes the lower label and null labels are ignored; with no labels, or labels
of one class only, every score is that class (1.0 without any); an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from giftlink.llm import common
from giftlink.llm.tasks import slices

MAX_LABELLED = 20_000
PER_ROUND = 500
ROUNDS = 3
CONFIDENT = 0.98
PARTS = 64  # of the confident texts, each of which is ranked by itself first
KEEP_FROM = 0.5
LANG_SLOTS, SOURCE_SLOTS = 8, 32

# byte classes whose shares describe a text
CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t", b"\n\r", b".", b",",
           b"!?", b"|", b"*#$%&", b"'\"`", b";:-_", b"()[]{}<>", b"/\\=+~^@"]
CLASS_OF = np.full(256, len(CLASSES), dtype=np.int64)  # the last class: all other bytes
for _i, _c in enumerate(CLASSES):
    CLASS_OF[list(_c)] = _i
N_TEXT = len(CLASSES) + 1 + 10
N_META = 9 + LANG_SLOTS + SOURCE_SLOTS


def text_features(text: str) -> list:
    raw = text.encode("utf-8", "surrogatepass")
    words = text.split()
    if not words:
        return [0.0] * N_TEXT
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    shares = np.bincount(CLASS_OF, weights=counts, minlength=len(CLASSES) + 1) / len(raw)
    p = counts[counts > 0] / len(raw)
    n = len(words)
    freq = Counter(words)
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=n)
    pairs = len(set(zip(words, words[1:])))
    return [*shares.tolist(),
            math.log1p(n), float(lengths.mean()), float(lengths.std()), len(freq) / n, max(freq.values()) / n,
            sum(a == b for a, b in zip(words, words[1:])) / n,
            pairs / max(1, n - 1),
            sum(w.isupper() and len(w) > 1 for w in words) / n,
            sum(not w[-1].isalnum() for w in words) / n,
            float(-(p * np.log2(p)).sum())]


def meta_features(text: str, lang, source, n_chars) -> list:
    lines = text.split("\n")
    lengths = np.fromiter(map(len, lines), dtype=np.float64, count=len(lines))
    full = [x for x in lines if x.strip()]
    out = [math.log1p(max(0, n_chars or 0)), float(n_chars is None),
           math.log1p(abs((n_chars or 0) - len(text))), math.log1p(len(lines)),
           math.log1p(float(lengths.mean())), math.log1p(float(lengths.max())),
           1.0 - len(set(full)) / len(full) if full else 0.0, 1.0 - len(full) / len(lines),
           float((lengths < 30).mean())]
    for value, slots in ((lang, LANG_SLOTS), (source, SOURCE_SLOTS)):
        one = [0.0] * slots
        one[0 if value is None else 1 + zlib.crc32(value.encode("utf-8", "replace")) % (slots - 1)] = 1.0
        out += one
    return out


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


class Logistic:
    """Ridge logistic regression on standardised columns (Newton steps)."""

    def __init__(self, x, y, weight=None, ridge: float = 1.0, steps: int = 25):
        x = np.asarray(x, np.float64)
        self.mean, self.scale = x.mean(0), x.std(0)
        self.scale[self.scale < 1e-9] = np.inf  # constant columns say nothing
        a = np.column_stack([np.ones(len(x)), (x - self.mean) / self.scale])
        weight = np.ones(len(x)) if weight is None else weight
        keep = np.full(a.shape[1], ridge)
        keep[0] = 1e-6
        b = np.zeros(a.shape[1])
        for _ in range(steps):
            p = sigmoid(a @ b)
            h = weight * np.maximum(p * (1 - p), 1e-6)
            move = np.linalg.solve((a * h[:, None]).T @ a + np.diag(keep), a.T @ (weight * (y - p)) - keep * b)
            b = b + np.clip(move, -5, 5)
            if np.abs(move).max() < 1e-6:
                break
        self.b = b

    def logit(self, x):
        return np.column_stack([np.ones(len(x)), (np.asarray(x, np.float64) - self.mean) / self.scale]) @ self.b


class Constant:
    def __init__(self, p: float):
        self.p = p

    def probabilities(self, text, meta):
        c = np.full(len(text), self.p)
        return c, c, c


class TwoViews:
    """Two fitted views, their calibrations and their combination."""

    def __init__(self, text_rows, meta_rows, held, stacked=None):
        self.text, self.meta = Logistic(*text_rows), Logistic(*meta_rows)
        xt, xm, y = held
        both = len(y) >= 10 and 0 < y.sum() < len(y)
        lt, lm = self.text.logit(xt), self.meta.logit(xm)
        # Platt scaling; without a usable held-out part the raw logits stand
        self.cal_text = Logistic(lt[:, None], y) if both else None
        self.cal_meta = Logistic(lm[:, None], y) if both else None
        self.top = Logistic(np.column_stack(self._calibrated(lt, lm)), y) if both else None

    def _calibrated(self, lt, lm):
        return (self.cal_text.logit(lt[:, None]) if self.cal_text else lt,
                self.cal_meta.logit(lm[:, None]) if self.cal_meta else lm)

    def probabilities(self, text, meta):
        ct, cm = self._calibrated(self.text.logit(text), self.meta.logit(meta))
        top = self.top.logit(np.column_stack([ct, cm])) if self.top else ct + cm
        return sigmoid(ct), sigmoid(cm), sigmoid(top)


def _matrix(rows, width):
    return np.array(rows, dtype=np.float64).reshape(len(rows), width)


def featurize(docs: DataFrame, keep: list | None = None) -> DataFrame:
    """Of every row: its columns ``keep`` (default: doc_id) as one (``row``),
    doc_id, h (its place in hash samples), t (a hash of its text), text and
    meta features."""
    names = ["row", "doc_id", "h", "t", "text_x", "meta_x"]
    rows = common.in_small_batches(docs).select(
        F.struct(*[F.col(f"`{c}`") for c in keep or ["doc_id"]]).alias("row"), "doc_id",
        F.xxhash64("doc_id", "text").alias("h"), F.xxhash64("text").alias("t"), "text", "lang", "source",
        F.col("n_chars").cast("long").alias("n_chars"))

    def run(batches):
        for b in slices(batches):
            texts = [x or "" for x in b.column(4).to_pylist()]
            xt = [np.array(text_features(x), np.float32) for x in texts]
            xm = [np.array(meta_features(x, *m), np.float32)
                  for x, *m in zip(texts, *(b.column(i).to_pylist() for i in (5, 6, 7)))]
            arr = pa.list_(pa.float32())
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(xt, arr), pa.array(xm, arr)], names=names)

    floats = T.ArrayType(T.FloatType())
    return rows.mapInArrow(run, T.StructType([*(rows.schema[c] for c in names[:4]), T.StructField("text_x", floats),
                                              T.StructField("meta_x", floats)]))


def score_features(rows: DataFrame, model, keep: list) -> DataFrame:
    """The columns ``keep`` of a feature table, with p_text, p_meta and
    p_quality. The models are small arrays that travel with the task."""
    views = ("p_text", "p_meta", "p_quality")

    def run(batches):
        for b in slices(batches):
            n = b.num_rows
            xt = b.column(b.schema.get_field_index("text_x")).flatten().to_numpy(zero_copy_only=False)
            xm = b.column(b.schema.get_field_index("meta_x")).flatten().to_numpy(zero_copy_only=False)
            p = model.probabilities(xt.reshape(n, N_TEXT), xm.reshape(n, N_META)) if n else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [*[b.column(b.schema.get_field_index(c)) for c in keep], *[pa.array(x, pa.float64()) for x in p]],
                names=[*keep, *views])

    return rows.select(*keep, "text_x", "meta_x").mapInArrow(
        run, T.StructType([*(rows.schema[c] for c in keep), *(T.StructField(v, T.DoubleType()) for v in views)]))


def _labels(labels: DataFrame) -> DataFrame:
    return (labels.where("doc_id is not null and quality is not null")
            .groupBy("doc_id").agg((F.min("quality") > 0).cast("int").alias("y")))


def fit(features: DataFrame, labels: DataFrame, rounds: int = ROUNDS, per_round: int = PER_ROUND,
        max_labelled: int = MAX_LABELLED, confident: float = CONFIDENT):
    """The combined model. ``features`` is a written table: it is read twice
    for the labelled rows and twice per round. Only ids, hashes and votes are
    shuffled; the wide feature rows stay where they are and meet the few that
    are wanted by broadcast."""
    y, spark = _labels(labels), features.sparkSession
    first = (features.select("doc_id", "h").join(y, "doc_id").orderBy("h", "y").limit(max_labelled).toArrow())
    # a row of every one taken; rows that are alike in id and text stand for each other
    wanted = spark.createDataFrame(first.group_by(["doc_id", "h", "y"]).aggregate([])) if first.num_rows else None
    seed = (features.join(F.broadcast(wanted), ["doc_id", "h"]).select("h", "text_x", "meta_x", "y")
            .orderBy("h", "y").limit(max_labelled).toArrow().to_pydict()) if first.num_rows else {"y": []}
    ys = np.array(seed["y"], np.float64)
    if not len(ys) or ys.min() == ys.max():
        return Constant(float(ys[0]) if len(ys) else 1.0)
    xt, xm = _matrix(seed["text_x"], N_TEXT), _matrix(seed["meta_x"], N_META)
    held = np.array(seed["h"], np.int64) % 5 == 0  # calibration rows, never fitted on
    if len(set(ys[held])) < 2 or len(set(ys[~held])) < 2:
        held[:] = False
    fitted = ~held
    calibration = (xt[held], xm[held], ys[held])
    train = {"text": [xt[fitted], ys[fitted]], "meta": [xm[fitted], ys[fitted]]}
    model = TwoViews(train["text"], train["meta"], calibration)
    taught = []  # (teacher, t): bounded by the rounds
    for _ in range(rounds):
        scored = score_features(features, model, ["doc_id", "h", "t"])
        # a view's confident documents, as (teacher, label, confidence)
        votes = F.array(*[F.struct(F.lit(n).alias("teacher"), F.lit(v).alias("y"), c.alias("sure"))
                          for n, p in (("text", F.col("p_text")), ("meta", F.col("p_meta")))
                          for v, c in ((1, p), (0, 1 - p))])
        sure = (scored.select("doc_id", "h", "t", F.filter(votes, lambda x: x["sure"] >= confident).alias("votes"))
                .where(F.size("votes") > 0).join(y, "doc_id", "left_anti")
                .select("h", "t", F.explode("votes").alias("vote")).select("h", "t", "vote.*"))
        if taught:
            sure = sure.join(spark.createDataFrame(taught, "teacher string, t long"), ["teacher", "t"], "left_anti")
        # texts that were not taught yet, once each; the best of every part of them, then the best of all
        fresh = sure.groupBy("teacher", "y", "t").agg(F.min(F.struct((-F.col("sure")).alias("doubt"), "h")).alias("m"))
        first = W.orderBy("m.doubt", "m.h")
        fresh = (fresh.withColumn("part", F.pmod("t", F.lit(PARTS)))
                 .withColumn("k", F.row_number().over(first.partitionBy("teacher", "y", "part")))
                 .where(F.col("k") <= per_round)
                 .withColumn("k", F.row_number().over(first.partitionBy("teacher", "y"))).where(F.col("k") <= per_round))
        # at most 4 * per_round rows
        best = fresh.select("teacher", "y", "k", F.col("m.h").alias("h"))
        picked = (features.join(F.broadcast(best), "h").join(y.select("doc_id"), "doc_id", "left_anti")
                  .select("teacher", "y", "k", "t", "text_x", "meta_x").dropDuplicates(["teacher", "y", "t"])
                  .orderBy("teacher", "y", "k").toArrow().to_pydict())
        if not picked["t"]:
            break
        taught += list(zip(picked["teacher"], picked["t"]))
        for teacher, pupil, xs, width in (("text", "meta", "meta_x", N_META), ("meta", "text", "text_x", N_TEXT)):
            new = [i for i, n in enumerate(picked["teacher"]) if n == teacher]
            if new:
                x, v = train[pupil]
                train[pupil] = [np.vstack([x, _matrix([picked[xs][i] for i in new], width)]),
                                np.concatenate([v, np.array([picked["y"][i] for i in new], np.float64)])]
        model = TwoViews(train["text"], train["meta"], calibration)
    return model


def scored_rows(docs: DataFrame, labels: DataFrame, keep: list | None = None, **settings) -> DataFrame:
    """Every row: its columns ``keep`` (default: doc_id) as one (``row``), so
    that no name can clash, with p_text, p_meta and p_quality. Features are
    computed once and written."""
    features = common.written(featurize(docs, keep), "features")
    return score_features(features, fit(features, labels, **settings), ["row"])


def classify(docs: DataFrame, labels: DataFrame, keep_from: float = KEEP_FROM, **settings) -> DataFrame:
    """(doc_id, p_text, p_meta, p_quality, keep) of every row."""
    scored = scored_rows(docs, labels, **settings)
    return scored.select("row.doc_id", "p_text", "p_meta", "p_quality", (F.col("p_quality") >= keep_from).alias("keep"))


common.ship(__name__)
