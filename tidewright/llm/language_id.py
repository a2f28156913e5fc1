"""Language identification by nearest centroid.

A text's vector counts its byte n-grams (2 and 3 bytes, A-Z lowered, digits and marks left out, word ends kept) in
hashed buckets, damped by a logarithm, weighted by inverse document frequency and scaled to length 1. Each language has
several centroids, found by spherical k-means over its training vectors; a text gets the language of the centroid with
the largest cosine. The score turns the two best languages' cosines into a number from 0 to 1. A text is rejected if its
cosine is below ``reject_below`` times the median cosine of its centroid's training texts of about the same length.
Short texts have few n-grams and small cosines, so each binary order of different n-grams has its own median. Clusters
with less than ``least_share`` of a language's texts are dissolved, so no centroid or median stands on a few odd texts.

Training takes about ``sample`` labelled texts and never more than twice as many, those whose ids and texts hash
lowest, so it is bounded and repeats, whatever ids are null or shared. One task fits them, so the driver holds no texts' counts. The IDF and
the centroids are the fitted model. Every text is classified whole, by tasks that each get the model (a few hundred
kilobytes, whatever the input).

Null texts and texts without a letter are ``und`` with score 0 and are rejected. With no labelled text at all, every
text is ``und``, and only those without a letter are rejected. Repeated rows get equal results; an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import flat_text, place_of, slices, small_batches, tidy

#: Byte classes: letters keep a code (lower case; bytes of longer characters their own), all else is a word end.
_FOLD = np.zeros(256, np.uint32)
_FOLD[97:123] = np.arange(1, 27)
_FOLD[65:91] = np.arange(1, 27)
_FOLD[128:] = np.arange(27, 155)
BUCKETS = 1 << 13
#: Length bins, and how many training texts a bin needs for a median of its own.
BINS, ENOUGH = 14, 20
_CHOSEN = pa.schema([("lang", pa.string()), ("counts", pa.binary()), ("place", pa.int64())])


def ngram_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts (rows x BUCKETS, float32) of hashed 2- and 3-byte n-grams."""
    n = len(offsets) - 1
    out = np.zeros(n * BUCKETS, np.float32)
    if len(data) < 2:
        return out.reshape(n, BUCKETS)
    c = _FOLD[data]
    row = np.repeat(np.arange(n), np.diff(offsets))
    two = c[:-1] * np.uint32(155) + c[1:]
    some = (c[:-1] > 0) | (c[1:] > 0)
    three = two[:-1] * np.uint32(155) + c[2:]
    for grams, ok, width in ((two, some, 2), (three, (some[:-1] | (c[2:] > 0)), 3)):
        same = row[: len(grams)] == row[width - 1 :]
        ok = ok & same
        h = (grams[ok] + np.uint32(width)) * np.uint32(2654435761) >> np.uint32(19)
        out += np.bincount(row[: len(grams)][ok] * BUCKETS + h.astype(np.int64), minlength=n * BUCKETS).astype(np.float32)
    return out.reshape(n, BUCKETS)


def _damped(counts: np.ndarray) -> np.ndarray:
    return np.log1p(counts)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


@dataclass
class Model:
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray  # language index of each centroid
    least: np.ndarray  # cosine below which a text is rejected, for each centroid and length bin
    languages: list[str]


def _bins(counts: np.ndarray) -> np.ndarray:
    """Length bin of each row: the binary logarithm of how many different n-grams it has."""
    some = np.array([np.count_nonzero(row) for row in counts], int)
    return np.minimum(np.log2(np.maximum(some, 1)).astype(int), BINS - 1)


def _clusters(own: np.ndarray, wanted: int, rounds: int, least_share: float) -> np.ndarray:
    """Spherical k-means from random texts. Clusters with less than ``least_share`` of the texts are dissolved, the smallest first."""
    means = own[np.sort(np.random.default_rng(17).choice(len(own), min(wanted, len(own)), replace=False))]
    while True:
        for _ in range(rounds):
            near = (own @ means.T).argmax(1)
            means = _unit(np.array([own[near == j].mean(0) if (near == j).any() else means[j] for j in range(len(means))]))
        sizes = np.bincount((own @ means.T).argmax(1), minlength=len(means))
        if len(means) == 1 or sizes.min() >= max(2, least_share * len(own)):
            return means
        means = np.delete(means, sizes.argmin(), axis=0)


def _bounds(groups: list[tuple[np.ndarray, np.ndarray]], reject_below: float) -> np.ndarray:
    """The rejection bound of each length bin. ``groups`` has cosines and bins of a centroid's texts, its language's and
    all texts'; a bin takes its median from the first group with ``ENOUGH`` texts there."""
    out = np.full(BINS, np.nan)
    for b in range(BINS):
        for cos, bins in groups:
            if np.count_nonzero(bins == b) >= ENOUGH:
                out[b] = reject_below * np.median(cos[bins == b])
                break
    if np.isnan(out).all():
        cos, bins = groups[0]
        out[int(np.median(bins))] = reject_below * np.median(cos)
    known = np.flatnonzero(~np.isnan(out))
    for b in range(known[0] - 1, -1, -1):
        out[b] = out[b + 1] / np.sqrt(2)  # the cosine of a short text grows with the root of its n-grams
    for b in range(known[0], BINS):
        out[b] = out[b - 1] if np.isnan(out[b]) else out[b]
    return out


def fit(counts: np.ndarray, languages: list[str], per_language: int = 4, rounds: int = 12, least_share: float = 0.05, reject_below: float = 0.5) -> Model:
    """Centroids of TF-IDF vectors by spherical k-means, deterministically. ``counts`` is used up."""
    names = sorted(set(languages))
    y = np.array([names.index(x) for x in languages], int)
    idf = (np.log((1 + len(counts)) / (1 + np.count_nonzero(counts, axis=0))) + 1).astype(np.float32)
    bins = _bins(counts)
    x = np.log1p(counts, out=counts)  # in place: up to 260 MB
    x *= idf
    x /= np.maximum(np.sqrt(np.einsum("ij,ij->i", x, x)), 1e-9)[:, None]
    centroids, owner, nearest = [], [], []
    for k, _ in enumerate(names):
        own = x[y == k]
        means = _clusters(own, per_language, rounds, least_share)
        cos = own @ means.T
        near = cos.argmax(1)
        nearest.append((cos.max(1), bins[y == k], near))
        centroids.extend(means)
        owner.extend([k] * len(means))
    every = tuple(np.concatenate([n[i] for n in nearest]) for i in (0, 1)) if nearest else None
    least = []
    for cos, own_bins, near in nearest:
        for j in range(near.max() + 1):  # no cluster is empty
            least.append(_bounds([(cos[near == j], own_bins[near == j]), (cos, own_bins), every], reject_below))
    return Model(idf, np.array(centroids, np.float32).reshape(-1, BUCKETS), np.array(owner, int), np.array(least).reshape(-1, BINS), names)


def classify(model: Model, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Language index, score and cosine margin over the rejection bound of each row."""
    bins = _bins(counts)
    cos = _unit(_damped(counts) * model.idf) @ model.centroids.T
    best = cos.argmax(1)
    by = np.stack([cos[:, model.owner == k].max(1) if (model.owner == k).any() else np.full(len(cos), -1.0) for k in range(len(model.languages))], 1)
    top = by.max(1)
    share = np.exp(20 * (by - top[:, None]))
    return model.owner[best], 1 / share.sum(1), top - model.least[best, bins]


def train(docs: DataFrame, learn: Column, sample: int = 4000, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> Model:
    """A model from about ``sample`` of the labelled texts for which ``learn`` holds, split among the languages."""
    labelled = docs.where(learn & F.col(lang_col).isNotNull())
    kinds = labelled.groupBy(lang_col).agg(F.count("*").alias("n")).orderBy(lang_col).collect()  # one row a language
    # a language's rows are those in the low share of the ids' hashes that holds about its part of the sample
    place, each = place_of(F.col(id_col), F.col(text_col), F.lit(17)), sample / max(1, len(kinds))
    low = F.lit(False)
    for kind in kinds:
        low = low | ((F.col(lang_col) == kind[lang_col]) & (place < int(min(1.0, each / kind["n"]) * (1 << 20))))
    chosen = labelled.where(low & F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), place.alias("place"))
    small_batches(docs.sparkSession, 8 << 20)
    rows = chosen.mapInArrow(_counts, "lang string, counts binary, place long").orderBy("place", "lang", "counts").limit(2 * sample)

    def learn_all(batches):
        found = pa.Table.from_batches(batches, _CHOSEN)
        counts = np.zeros((len(found), BUCKETS), np.float32)
        for i, x in enumerate(found.column("counts")):
            pairs = np.frombuffer(x.as_buffer(), np.uint32).reshape(2, -1)
            counts[i, pairs[0]] = pairs[1]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(counts, found.column("lang").to_pylist(), **options))], pa.binary())], ["model"])
        del found, counts
        tidy()

    told = rows.mapInArrow(learn_all, "model binary").collect()  # the bounded sample is one task's; the driver gets the centroids alone
    return pickle.loads(told[0].model) if told else fit(np.zeros((0, BUCKETS), np.float32), [], **options)


def _counts(batches):
    for batch in batches:
        data, offsets = flat_text(batch.column(0))
        for a, b in _bounded(offsets):
            counts = ngram_counts(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            yield pa.RecordBatch.from_arrays([batch.column(1).slice(a, b - a), pa.array([np.concatenate((at := np.flatnonzero(c), c[at])).astype(np.uint32).tobytes() for c in counts], pa.binary()), batch.column(2).slice(a, b - a)], ["lang", "counts", "place"])


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and lang_rejected. A letter is any Unicode letter."""
    small_batches(docs.sparkSession, 8 << 20)
    spread = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double, lang_rejected boolean")
    def predict(text: pa.Array) -> pa.Array:
        m = spread.value
        data, offsets = flat_text(text)
        lang, score, margin = (np.zeros(len(text), t) for t in (int, float, float))
        if len(m.languages):
            for a, b in _bounded(offsets):
                lang[a:b], score[a:b], margin[a:b] = classify(m, ngram_counts(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))
        names = pa.array(m.languages or ["und"], pa.string()).take(pa.array(lang))
        return pa.StructArray.from_arrays([names, pa.array(score), pa.array(margin < 0)], ["lang_pred", "score", "lang_rejected"])

    predict = predict.asNondeterministic()  # else a filter on its result is pushed down and evaluates it twice
    fresh = [c for c in docs.columns if c not in {"lang_pred", "score", "lang_rejected"}]
    letter = F.coalesce(F.col(text_col).rlike("\\p{L}"), F.lit(False))
    told = docs.select(*fresh, letter.alias("_letter"), predict(F.coalesce(F.col(text_col), F.lit(""))).alias("_p"))
    known = F.col("_letter") & (F.col("_p.lang_pred") != "und")
    return told.select(*fresh, F.when(known, F.col("_p.lang_pred")).otherwise("und").alias("lang_pred"), F.when(known, F.col("_p.score")).otherwise(0.0).alias("score"), F.when(known, F.col("_p.lang_rejected")).otherwise(~F.col("_letter") if not model.languages else F.lit(True)).alias("lang_rejected"))


def _bounded(offsets: np.ndarray):
    """Row ranges of at most 1 MB of text and 256 rows."""
    for a, b in slices(offsets, 1 << 20):
        for i in range(a, b, 256):
            yield i, min(b, i + 256)
