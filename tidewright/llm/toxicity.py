"""Toxicity: a convolutional text classifier in numpy.

Words (runs of letters, digits and non-ASCII bytes, A-Z lowered) are hashed to rows of an embedding table, and their
first four and first seven bytes to rows of two more, so that unseen words share what their stems have; a word's vector
is the sum. Filters of several widths slide over a text's words, the largest response of each filter is kept (max pooling), and a logistic
layer reads those maxima. Training follows the pooled positions alone, so it costs little more than a forward pass.

Thresholds are calibrated by language on every labelled text, each by a network that didn't learn from it (``FOLDS``
networks learn from all texts but a fold each, whatever their number; equal texts are in one fold); the network that
scores learns from all. The language is guessed from a text's own function words, each language's best threshold is moved
to a score of 0.3, and languages with too few toxic rows share the threshold of all. No label, id, source or language
column is read for a score.

All labelled texts are learnt from, whole. They are dealt by a hash into parts of about ``PART`` texts or ``PART_BYTES``,
which Spark keeps on the executors' disks. The networks learn from the first part, and from there in ``SWEEPS`` sweeps over all
parts: in a sweep each part is a task a network that begins with the shared weights, and what the tasks have changed is averaged
by shuffled blocks of the tables. A table's row takes the mean of the parts that touched it, weighted by their steps on it, so
a word that few parts hold isn't diluted. Logits of the folds are counted by language in steps of 1/``GRID``, and Spark takes
the best threshold from these counts. The driver gets four networks a phase, of some five megabytes, whatever the input, and tasks
one at a time. ``sample`` bounds the labelled texts for those who ask for it: up to a third of them toxic, those whose ids hash lowest.

A null or empty text is scored as a text without words. Without labels of both kinds to learn from, all scores are 0.
Labels other than 0 and 1, and labels of null ids, are left out; an id with several labels or texts may be learnt from
with each. Repeated rows and texts that tie get equal scores, and a score of exactly 0.3 is predicted 1. An empty table
gives an empty result. Other columns are left alone, but for ``score`` and ``predicted``, which are replaced.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewright.llm.common import BROADCAST_ROWS, flat_text, place_of, slices, small_batches, span_hashes, tidy, word_spans

BITS, STEMS, DIM, FILTERS, WIDTHS = 15, (4, 7), 12, 12, (1, 2, 3)
ROWS = 1 << BITS
TABLES = ("word", *(f"stem{k}" for k in STEMS))
PAD = sum(ROWS << 16 * i for i in range(len(TABLES))) # rows of zeros, which stand after a text's last word
CUT = 0.3
FOLDS = 3
PART, PART_BYTES, SWEEPS, RATE, GRID = 8192, 32 << 20, 2, 0.01, 1024
BLOCK = 512  # rows of a table that are averaged together

_NOT_WORD = np.ones(256, bool)
_NOT_WORD[48:58] = _NOT_WORD[65:91] = _NOT_WORD[97:123] = _NOT_WORD[128:] = False

#: Frequent function words of each language that the others lack.
FUNCTION_WORDS = {
    "en": "the and of to is that it for with was on as are this be by from have not",
    "de": "der die und das ist nicht ein eine zu den mit von für auf dem sich des im",
    "fr": "le les et des est une dans du qui pour pas sur au avec ce il elle vous",
    "es": "el los y que las una por con para su se lo como más pero sus al este",
}


def _coded(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The rows of a word and of its stems, 16 bits each from the lowest."""
    out = np.zeros(len(starts), np.uint64)
    for i, e in enumerate((ends, *(np.minimum(ends, starts + k) for k in STEMS))):
        out |= span_hashes(data, starts, e) >> np.uint64(64 - BITS) << np.uint64(16 * i)
    return out


def word_rows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Embedding rows of the words of each text, each text followed by len(WIDTHS) pads, flat, and the offsets."""
    starts, ends, row = word_spans(data, offsets, _NOT_WORD)
    rows = _coded(data, starts, ends)
    n, pads = len(offsets) - 1, len(WIDTHS)
    count = np.bincount(row, minlength=n)
    at = np.concatenate((np.zeros(1, np.int64), np.cumsum(count + pads)))
    out = np.full(at[-1], PAD, np.uint64)
    out[np.arange(len(rows)) + pads * row] = rows
    return out, at


def _rows_of(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _ = word_spans(raw, np.array([0, len(raw)]), _NOT_WORD)
    return _coded(raw, starts, ends) & np.uint64(0xFFFF)


def _marks() -> np.ndarray:
    """For each embedding row which language's function word it is (0: none)."""
    marks = np.zeros(ROWS + 1, np.int8)
    for k, words in enumerate(FUNCTION_WORDS.values()):
        marks[_rows_of(words)] = k + 1
    return marks


def guess(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The language whose function words a text has most of, from 1; 0 if it has none."""
    marks = _marks()[rows & np.uint64(0xFFFF)]
    hits = np.stack([np.add.reduceat(marks == k + 1, at[:-1]) for k in range(len(FUNCTION_WORDS))], 1)
    return np.where(hits.max(1) > 0, hits.argmax(1) + 1, 0)


@dataclass
class Model:
    weights: dict[str, np.ndarray] = field(default_factory=dict)
    cuts: np.ndarray = field(default_factory=lambda: np.zeros(len(FUNCTION_WORDS) + 1))

    @classmethod
    def fresh(cls, seed: int = 3) -> Model:
        r = np.random.default_rng(seed)
        w = {**{t: r.normal(0, 0.1, (ROWS + 1, DIM)) for t in TABLES}, "out": r.normal(0, 0.3, len(WIDTHS) * FILTERS), "bias": np.full(1, -2.0)}
        for t in TABLES:
            w[t][ROWS] = 0
        for k in WIDTHS:
            w[f"conv{k}"], w[f"shift{k}"] = r.normal(0, 0.3, (k, DIM, FILTERS)), np.zeros(FILTERS)
        return cls({k: v.astype(np.float32) for k, v in w.items()})


def ids_of(rows: np.ndarray, i: int) -> np.ndarray:
    """The rows of table ``i``."""
    return (rows >> np.uint64(16 * i) & np.uint64(0xFFFF)).astype(np.int64)


def vectors_of(w: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
    return sum(w[t][ids_of(rows, i)] for i, t in enumerate(TABLES))


def pooled(w: dict[str, np.ndarray], rows: np.ndarray, at: np.ndarray, where: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The largest response of each filter over each text, and (``where``) its position."""
    used, back = np.unique(rows, return_inverse=True)
    vectors = vectors_of(w, used)
    peaks, places = [], []
    for k in WIDTHS:
        response = np.zeros((len(rows) - k + 1, FILTERS), np.float32)
        for j in range(k):
            response += (vectors @ w[f"conv{k}"][j])[back[j : len(rows) - k + 1 + j]]
        ends = np.minimum(at[1:] - len(WIDTHS) + 1, len(response))  # windows begin at words, or at the first pad
        if where:
            place = np.stack([response[a:b].argmax(0) + a for a, b in zip(at[:-1], ends, strict=True)])
            peaks.append(response[place, np.arange(FILTERS)])
            places.append(place)
        else:
            # windows that begin at later pads never win
            bounds = np.stack((at[:-1], ends), 1).ravel()
            peaks.append(np.maximum.reduceat(np.concatenate((response, np.full((1, FILTERS), -np.inf, np.float32))), bounds)[::2])
    shift = np.concatenate([w[f"shift{k}"] for k in WIDTHS])
    return np.maximum(np.concatenate(peaks, 1) + shift, 0), np.concatenate(places, 1) if where else np.zeros(0)


def train(
    texts: list[np.ndarray], toxic: np.ndarray, rounds: int = 10, batch: int = 32, rate: float = RATE, decay: float = 1e-3, drop: float = 0.3, seed: int = 3,
    start: Model | None = None, steps: dict[str, np.ndarray] | None = None,
) -> Model:
    """Adam on the cross entropy; ``texts`` are padded row arrays. Words are dropped at random while learning.

    Of the embedding tables a step changes the rows of its pooled words alone, with moments of their own; ``steps`` counts
    them. Weights begin with those of ``start``, which stay as they are, or fresh."""
    model, r, step = Model({k: v.copy() for k, v in start.weights.items()}) if start else Model.fresh(seed), np.random.default_rng(seed), 0
    w = model.weights
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))

    def moved(k: str, at, g: np.ndarray, by: float) -> None:
        g = g + decay * w[k][at]
        first[k][at] = f = 0.9 * first[k][at] + 0.1 * g
        second[k][at] = v = 0.99 * second[k][at] + 0.01 * g * g
        w[k][at] -= by / (1 - 0.9**step) * f / (np.sqrt(v / (1 - 0.99**step)) + 1e-5)

    for epoch in range(rounds):
        order = r.permutation(len(texts))
        for a in range(0, len(order), batch):
            own = order[a : a + batch]
            rows = np.concatenate([texts[i] for i in own])
            at = np.concatenate((np.zeros(1, np.int64), np.cumsum([len(texts[i]) for i in own])))
            seen = np.where(r.random(len(rows)) < drop, np.uint64(PAD), rows)
            top, place = pooled(w, seen, at, True)
            p = 1 / (1 + np.exp(-np.clip(top @ w["out"] + w["bias"], -30, 30)))
            dz = ((p - toxic[own]) / len(own)).astype(np.float32)
            grad = {"out": top.T @ dz, "bias": dz.sum(keepdims=True)}
            dtop = dz[:, None] * w["out"] * (top > 0)
            words, backs = [], []
            for i, k in enumerate(WIDTHS):
                d, where = dtop[:, i * FILTERS : (i + 1) * FILTERS], place[:, i * FILTERS : (i + 1) * FILTERS]
                grad[f"shift{k}"], grad[f"conv{k}"] = d.sum(0), np.zeros_like(w[f"conv{k}"])
                for j in range(k):
                    ids = seen[where + j]
                    grad[f"conv{k}"][j] = np.einsum("nfd,nf->df", vectors_of(w, ids), d)
                    words.append(ids.ravel())
                    backs.append((d[:, :, None] * w[f"conv{k}"][j].T[None]).reshape(-1, DIM))
            words, backs = np.concatenate(words), np.concatenate(backs)
            step += 1
            by = rate * (1 - 0.8 * epoch / rounds)
            for n, t in enumerate(TABLES):
                ids = ids_of(words, n)
                order_ = np.argsort(ids, kind="stable")
                ids = ids[order_]
                begin = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
                moved(t, ids[begin], np.add.reduceat(backs[order_], begin), by)
                w[t][ROWS] = 0
                if steps is not None:
                    steps[t][ids[begin]] += 1
            for k, g in grad.items():
                moved(k, slice(None), g, by)
    return model


def logits(model: Model, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
    return pooled(model.weights, rows, at)[0] @ model.weights["out"] + model.weights["bias"]


def joined(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate(texts), np.concatenate((np.zeros(1, np.int64), np.cumsum([len(x) for x in texts])))


def chosen(labels: DataFrame, sample: int | None = None, id_col: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """(id, label, place) of all labels of 0 and 1, or of at most ``sample`` of them, up to a third of these 1."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(id_col, label_col).distinct()
    place = place_of(F.col(id_col), F.lit(29))
    told = (id_col, F.col(label_col).cast("int").alias(label_col), place.alias("_place"))
    if sample is None:
        return known.select(*told)
    counts, low = {x[0]: x[1] for x in known.groupBy(label_col).agg(F.count("*")).collect()}, F.lit(False)  # two rows
    for label, share in ((1, sample // 3), (0, sample - sample // 3)):
        low = low | ((F.col(label_col) == label) & (place < int(min(1.0, share / max(1, counts.get(label, 0))) * (1 << 20))))
    return known.where(low).select(*told).orderBy("_place", id_col).limit(sample)


def fit(docs: DataFrame, labels: DataFrame, sample: int | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", part: int = PART) -> Model | None:
    """A calibrated model from all labelled texts, about ``part`` of them a task; None without labels of both kinds."""
    small_batches(docs.sparkSession, 8 << 20)
    known = chosen(labels, sample, id_col, label_col).select(F.col(id_col).alias("id"), F.col(label_col).alias("toxic"))
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    known = known.withColumn("id", F.col("id").cast(docs.schema["id"].dataType))  # hashes differ by type
    n, toxic, size = docs.select("id", F.octet_length("text").alias("size")).join(known, "id").agg(F.count("*"), F.sum("toxic"), F.sum("size")).first()
    if not n or not 0 < toxic < n:
        return None
    parts = max(1, math.ceil(n / part), math.ceil((size or 0) / PART_BYTES))
    texts = labelled(docs, known, parts).mapInArrow(_encoded, "rows binary, toxic int, place long, part int, fold int").sortWithinPartitions("place", "rows", "toxic").persist(StorageLevel.DISK_ONLY)
    try:
        models = swept(texts.where("part = 0"), [Model.fresh()] * (FOLDS + 1), _rounds(n // parts), RATE, 3)
        for j in range(SWEEPS if parts > 1 else 0):
            models = swept(texts, models, 1, RATE * (1 - 0.8 * j / SWEEPS), 3 + (j + 1) * parts)
        cuts = best_cuts(counted(texts, models[:FOLDS]))
    finally:
        texts.unpersist()
    models[FOLDS].cuts[:] = [cuts.get(k, cuts[-1]) for k in range(len(FUNCTION_WORDS) + 1)]
    return models[FOLDS]


def labelled(docs: DataFrame, known: DataFrame, parts: int, most_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(text, toxic, place, part) of the documents with a label, each part in a partition, by the id's hash.

    Up to ``most_rows`` labels are broadcast. Beyond that texts are shuffled once, to their parts; those whose ids have no bit in a
    bitmap of the labels' (of at most 16 MB) stay where they are."""
    told = ("text", "toxic", place_of(F.col("id"), F.col("text"), F.lit(29)).alias("place"), F.pmod(F.hash("id"), F.lit(parts)).alias("part"))  # the part as repartition deals ids
    if known.count() <= most_rows:
        return docs.join(F.broadcast(known), "id").select(*told).repartitionById(parts, "part")
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 27))
    bucket, bit = F.shiftright(place, 15).alias("bucket"), place.bitwiseAND(F.lit((1 << 15) - 1))
    bits = known.groupBy(bucket).agg(F.bitmap_construct_agg(bit).alias("bits"))
    byte = F.conv(F.hex(F.substring(F.col("bits"), (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    some = docs.withColumn("bucket", bucket).join(F.broadcast(bits), "bucket").where(byte.bitwiseAND(F.pow(F.lit(2), bit % 8).cast("int")) > 0)
    return some.select("id", "text").repartition(parts, "id").join(known.repartition(parts, "id").hint("merge"), "id").select(*told)


def _rounds(n: int) -> int:
    return int(np.clip(40_000 // max(1, n), 6, 60))


def swept(texts: DataFrame, models: list[Model], rounds: int, rate: float, seed: int) -> list[Model]:
    """The networks after ``rounds`` over ``texts`` (rows, toxic, fold, part): each part learns from the weights given, and
    their changes are averaged. Network ``k`` doesn't see fold ``k``; the last one sees all."""
    context = texts.sparkSession.sparkContext
    shared = [context.broadcast(m) for m in models]

    def learning(k: int):
        def run(batches):
            start = model = shared[k].value
            steps, n = {t: np.zeros(ROWS + 1, np.uint32) for t in TABLES}, 0
            for own, toxic, part in _bounded(batches):
                model = train(own, toxic, rounds, rate=rate, seed=seed + part, start=model, steps=steps)
                n += len(own)
            if n:
                yield from _changes(k, part, n, start.weights, model.weights, steps)
            tidy()

        return texts.where(F.col("fold") != k).select("rows", "toxic", "part").mapInArrow(run, "net int, block int, part int, n long, at binary, steps binary, change binary")

    changes = reduce(DataFrame.union, [learning(k) for k in range(len(models))])
    found = changes.groupBy("net", "block").applyInArrow(_averaged, "net int, block int, at binary, change binary").toArrow()  # at most a network's size each
    out = [Model({name: v.copy() for name, v in m.weights.items()}) for m in models]
    for net, block, at, change in zip(*(found.column(c).to_pylist() for c in ("net", "block", "at", "change")), strict=True):
        w, change = out[net].weights, np.frombuffer(change, np.float32)
        if block < 0:
            for name in _dense(w):
                w[name] += change[: w[name].size].reshape(w[name].shape)
                change = change[w[name].size :]
        else:
            table, begin = divmod(block * BLOCK, ROWS)
            w[TABLES[table]][begin + np.frombuffer(at, np.uint16)] += change.reshape(-1, DIM)
    for x in shared:
        x.destroy()
    return out


def _dense(w: dict[str, np.ndarray]) -> list[str]:
    return sorted(set(w) - set(TABLES))


def _bounded(batches):
    """Texts, labels and the first part number of about a part at a time, so that memory is bounded however rows are dealt."""
    texts, toxic, part, size = [], [], 0, 0
    for batch in batches:
        for x, t, p in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            part = part if texts else p
            texts.append(np.frombuffer(x.as_buffer(), np.uint64))
            toxic.append(t)
            size += 8 * len(texts[-1])
            if len(texts) >= 2 * PART or size >= 4 * PART_BYTES:
                yield texts, np.array(toxic, np.float32), part
                texts, toxic, size = [], [], 0
    if texts:
        yield texts, np.array(toxic, np.float32), part


def _changes(k: int, part: int, n: int, old: dict[str, np.ndarray], new: dict[str, np.ndarray], steps: dict[str, np.ndarray]):
    """What a part has changed: the touched rows of each block of the tables in half precision, and (block -1) all other weights."""
    blocks, at, counts, change = [-1], [b""], [b""], [np.concatenate([(new[x] - old[x]).ravel() for x in _dense(new)]).astype(np.float32).tobytes()]
    for i, t in enumerate(TABLES):
        for b in range(ROWS // BLOCK):
            touched = np.flatnonzero(steps[t][b * BLOCK : (b + 1) * BLOCK])
            if len(touched):
                rows = b * BLOCK + touched
                blocks.append(i * (ROWS // BLOCK) + b)
                at.append(touched.astype(np.uint16).tobytes())
                counts.append(steps[t][rows].tobytes())
                change.append((new[t][rows] - old[t][rows]).astype(np.float16).tobytes())
    same = [pa.array([x] * len(blocks), kind) for x, kind in ((k, pa.int32()), (part, pa.int32()), (n, pa.int64()))]
    yield pa.RecordBatch.from_arrays([same[0], pa.array(blocks, pa.int32()), *same[1:], *(pa.array(x, pa.binary()) for x in (at, counts, change))], ["net", "block", "part", "n", "at", "steps", "change"])


def _averaged(rows: pa.Table) -> pa.Table:
    """The mean change of a block, over the parts that touched it: at most half a thousand table rows a part."""
    rows = rows.sort_by("part")  # sums of floats follow the order
    net, block = rows.column("net")[0].as_py(), rows.column("block")[0].as_py()
    if block < 0:
        at, each = b"", rows.column("n").to_pylist()
        change = sum(n * np.frombuffer(x.as_buffer(), np.float32).astype(float) for n, x in zip(each, rows.column("change"), strict=True)) / sum(each)
    else:
        total, weight = np.zeros((BLOCK, DIM)), np.zeros(BLOCK)
        for a, s, x in zip(rows.column("at"), rows.column("steps"), rows.column("change"), strict=True):
            a, s = np.frombuffer(a.as_buffer(), np.uint16), np.frombuffer(s.as_buffer(), np.uint32)
            total[a] += s[:, None] * np.frombuffer(x.as_buffer(), np.float16).reshape(-1, DIM).astype(float)
            weight[a] += s
        touched = np.flatnonzero(weight)
        at, change = touched.astype(np.uint16).tobytes(), total[touched] / weight[touched, None]
    return pa.table({"net": pa.array([net], pa.int32()), "block": pa.array([block], pa.int32()), "at": pa.array([at], pa.binary()), "change": pa.array([change.astype(np.float32).tobytes()], pa.binary())})


def learnt(k: int, texts: list[np.ndarray], toxic: np.ndarray, model: Model | None = None) -> np.ndarray:
    """Logits of fold ``k`` by ``model``; without one, by a network that learns from all other texts."""
    fold = folds(texts, toxic)
    own, rest = np.flatnonzero(fold == k), np.flatnonzero(fold != k)
    if model is None:
        if not len(own) or not len(rest):
            return np.zeros(len(own))
        model = train([texts[i] for i in rest], toxic[rest], rounds=_rounds(len(texts)))
    return np.concatenate([np.zeros(0), *(logits(model, *x) for x in _some([texts[i] for i in own]))])


def folds(texts: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Each text's fold, from its words alone: equal texts are in one, whatever their labels and wherever they lie."""
    return np.array([zlib.crc32(x.tobytes()) % FOLDS for x in texts], int)


def _some(texts: list[np.ndarray]):
    """Texts joined, some hundred thousand words at a time."""
    for a, b in slices(np.concatenate((np.zeros(1, np.int64), np.cumsum([len(x) for x in texts]))), 1 << 17) if texts else ():
        yield joined(texts[a:b])


def counted(texts: DataFrame, models: list[Model]) -> DataFrame:
    """(lang, z, n, toxic): how many texts of each guessed language have a logit, in steps of 1/GRID, by their fold's network."""
    shared = texts.sparkSession.sparkContext.broadcast(models)

    def run(batches):
        for own, toxic, _ in _bounded(batches):
            fold = folds(own, toxic)
            for k, model in enumerate(shared.value):
                at = np.flatnonzero(fold == k)
                if len(at):
                    z = np.round(learnt(k, own, toxic, model) * GRID).astype(np.int64)
                    lang = np.concatenate([guess(*x) for x in _some([own[i] for i in at])])
                    yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int32()), pa.array(z, pa.int64()), pa.array(toxic[at], pa.int64())], ["lang", "z", "toxic"])
        tidy()

    rows = texts.select("rows", "toxic", "part").mapInArrow(run, "lang int, z long, toxic long")
    return rows.groupBy("lang", (F.col("z") / GRID).alias("z")).agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic"))


def best_cuts(counts: DataFrame, least: int = 15) -> dict[int, float]:
    """Thresholds by language, and that of all at -1; languages with fewer than ``least`` texts of a label have none.

    A threshold has the best F1, and is in the middle of the gap below the lowest logit that it takes."""
    own = counts.unionByName(counts.groupBy("z").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")).select(F.lit(-1).alias("lang"), "z", "n", "toxic"))
    down, every = Window.partitionBy("lang").orderBy(F.desc("z")), Window.partitionBy("lang")  # a language has no more rows than steps
    f1 = 2 * F.sum("toxic").over(down) / (F.sum("n").over(down) + F.greatest(F.lit(1), F.sum("toxic").over(every)))
    cut = F.coalesce((F.col("z") + F.lead("z").over(down)) / 2, F.col("z") - 1)
    cuts = own.select("lang", "z", "n", "toxic", f1.alias("f1"), cut.alias("cut")).groupBy("lang").agg(F.max_by("cut", F.struct("f1", "z")).alias("cut"), F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
    return {r.lang: r.cut for r in cuts.collect() if r.lang == -1 or min(r.toxic, r.n - r.toxic) >= least}


def _encoded(batches):
    for batch in batches:
        data, offsets = flat_text(batch.column(0))
        for a, b in slices(offsets, 1 << 20):
            rows, at = word_rows(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            own = [rows[at[i] : at[i + 1]] for i in range(b - a)]
            told = [batch.column(i).slice(a, b - a) for i in (1, 2, 3)]
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in own], pa.binary()), *told, pa.array(folds(own, told[0]), pa.int32())], ["rows", "toxic", "place", "part", "fold"])


def scored(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (score >= 0.3)."""
    small_batches(docs.sparkSession, 8 << 20)
    spread = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        m = spread.value
        out = np.zeros(len(text))
        if m is not None:
            data, offsets = flat_text(text)
            for a, b in slices(offsets, 1 << 20):
                rows, at = word_rows(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                z = logits(m, rows, at) - m.cuts[guess(rows, at)] + np.log(CUT / (1 - CUT))
                out[a:b] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return pa.array(out)

    score = score.asNondeterministic()  # else a filter on its result is pushed down and evaluates it twice
    fresh = [c for c in docs.columns if c not in {"score", "predicted"}]
    return docs.select(*fresh, score(F.coalesce(F.col(text_col), F.lit(""))).alias("score")).withColumn("predicted", (F.col("score") >= CUT).cast("int"))
