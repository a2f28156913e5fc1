"""Near-duplicate detection with HyperMinHash.

A document's set holds the 64-bit hashes of its distinct word shingles (A-Z lowered). One hash a shingle feeds its
HyperMinHash sketch: the top bits choose one of 128 buckets, and a bucket keeps its smallest remainder, compressed to
its leading-zero count (6 bits) and the next 10 bits. Four neighbouring registers are one 64-bit band, so the sketch
is 32 longs and each is a banding key. At a similarity of 0.85 two documents share no band with a chance of 6e-11.

Steps, each on what the one before left:

1. Documents with equal sets form a class; only class representatives go on. Copies cost one row each.
2. Bands with two or more classes stay. Each band's leader is its most central member, the one with the most company
   over all its bands. Members are compared with the leaders that they meet in most bands: by the collision-corrected sketch estimate, then, unless that
   is 5 standard errors below the threshold, on whole sets. Linear in the rows of the bands.
3. Connected components of the links so far. Pairs inside one component need no more work. For bands that still span
   components: a shingle that only one of their members has can't be shared, which bounds a member's similarity to any
   other; members that can't reach the threshold leave. The rest of a band of up to ``BLOCK`` members are compared by
   bounds and estimates (members by the parity of 1024 bits bound two sets' difference from below, without error),
   across components only, each pair in the first band that it shares. Members of larger bands are joined by prefixes
   instead: of n shingles ordered from the rarest, similar sets share one of the first n - ceil(threshold * n) + 1, so
   only documents with such a shingle in common are compared, in square blocks of bounded size. Whole sets confirm.
4. Components of all links; copies get their class's component.

Pairs are never listed within a component or within a group of copies, and no bucket is capped. Joins by band, set or
node move rows of a few numbers; a hot key's side is split by adaptive execution. What is written on the way is deleted.

Null texts and texts without words have an empty set, n_shingles 0 and link with nothing. Fewer words than a shingle
form one shingle. Rows that share a doc_id are compared as separate texts under one id. A null doc_id is left out of linking and keeps
itself as component (null). Other columns are left alone; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import discard, flat_text, mix64, slices, small_batches, span_hashes, tidy, with_found, word_spans, written

BUCKET_BITS, MANTISSA_BITS, BAND = 7, 10, 4
REGISTERS, BANDS = 1 << BUCKET_BITS, (1 << BUCKET_BITS) // BAND
#: 64-bit words of a set's parities, which stand after its bands.
PARITY_WORDS = 16
EMPTY = 0xFFFF
#: How many leaders a member is compared with before components are formed; it meets at most one in each band.
LEADERS = 2
#: Chance that two different minima get one register value; see the HyperMinHash paper, for sets of any size here.
COLLISION = 0.17 / (1 << MANTISSA_BITS)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, flat, and their offsets."""
    starts, ends, row = word_spans(data, offsets)
    n = len(offsets) - 1
    words = span_hashes(data, starts, ends)
    count = np.bincount(row, minlength=n)
    first = np.concatenate(([0], np.cumsum(count)))[:-1]
    last = np.repeat(first + count, count) - np.arange(len(words)) if len(words) else np.zeros(0, np.int64)  # words from here to the row's end
    begins = np.flatnonzero((last >= width) | (np.arange(len(words)) == np.repeat(first, count)))
    length = np.minimum(last[begins], width)
    h = np.zeros(len(begins), np.uint64)
    for j in range(width):
        there = length > j
        at = np.minimum(begins + j, len(words) - 1)
        h = np.where(there, mix64(h * np.uint64(3) + words[at] + np.uint64(j + 1)), h) if len(words) else h
    owner = row[begins]
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])
    owner, h = owner[keep], h[keep]
    return h, np.searchsorted(owner, np.arange(n + 1))


def sketches(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Registers (rows x 128, uint16) of sets of hashes."""
    n = len(at) - 1
    out = np.full(n * REGISTERS, EMPTY, np.uint16)
    if len(h):
        owner = np.repeat(np.arange(n), np.diff(at))
        cell = owner * REGISTERS + (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        rest = h << np.uint64(BUCKET_BITS)
        new = np.ones(len(h), bool)
        new[1:] = cell[1:] != cell[:-1]  # sets are sorted, so a cell's smallest rest comes first
        cell, rest = cell[new], rest[new]
        zeros = np.minimum(64 - np.frexp((rest >> np.uint64(11)).astype(np.float64))[1] - 11, 62).astype(np.uint64)
        mantissa = (rest << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA_BITS)
        out[cell] = (zeros << np.uint64(MANTISSA_BITS) | mantissa).astype(np.uint16)
    return out.reshape(n, REGISTERS)


def parities(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each set, the parity of how many members fall to each of 1024 bits (rows x 16, int64)."""
    n = len(at) - 1
    out = np.zeros(n * PARITY_WORDS, np.uint64)
    bit = h & np.uint64(64 * PARITY_WORDS - 1)
    np.bitwise_xor.at(out, np.repeat(np.arange(n), np.diff(at)) * PARITY_WORDS + (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    return out.view(np.int64).reshape(n, PARITY_WORDS)


def least_difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Per row a lower bound of the symmetric difference: every parity that differs needs a member of one set alone."""
    return np.bitwise_count((a ^ b).astype(np.uint64)).sum(-1, dtype=np.int64)  # signed numbers would count their absolute values


def most_difference(sizes: np.ndarray, threshold: float) -> np.ndarray:
    """The largest symmetric difference of two similar sets, from the sum of their sizes."""
    return (1 - threshold) / (1 + threshold) * sizes + 1e-6


def matching(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row: how many registers agree, and how many either holds."""
    full = (a != EMPTY) | (b != EMPTY)
    return ((a == b) & full).sum(-1), full.sum(-1)


def estimate(same: np.ndarray, full: np.ndarray) -> np.ndarray:
    """Jaccard similarity from agreeing registers, less those that agree by chance."""
    return np.clip((same - COLLISION * full) / np.maximum(full * (1 - COLLISION), 1), 0, 1)


def floor_of(threshold: float, full: np.ndarray) -> np.ndarray:
    """The lowest estimate, 5 standard errors below the threshold, that still goes to the whole sets."""
    return threshold - 5 * np.sqrt(threshold * (1 - threshold) / np.maximum(full, 1))


SET_ROWS = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"


def _sketched(docs: DataFrame, width: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            data, offsets = flat_text(batch.column(1))
            for a, b in slices(offsets, 1 << 20):
                h, at = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], width)
                n = np.diff(at)
                prints = []
                for salt in (0x51ED270B, 0x2545F491):  # two sums of mixed members: a 128-bit fingerprint of the set
                    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix64(h + np.uint64(salt)), dtype=np.uint64)))
                    prints.append((total[at[1:]] - total[at[:-1]]).view(np.int64))
                bands = np.concatenate((np.ascontiguousarray(sketches(h, at)).view(np.int64).reshape(b - a, BANDS), parities(h, at)), 1).reshape(-1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(prints[0]), pa.array(prints[1]), pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1) * (BANDS + PARITY_WORDS), pa.int32()), pa.array(bands))],
                    ["doc_id", "n_shingles", "set_a", "set_b", "bands"],
                )
        tidy()

    return docs.mapInArrow(run, SET_ROWS)


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """(rep, shingles) of documents, the shingles as one binary of sorted 64-bit hashes."""

    def run(batches):
        for batch in batches:
            data, offsets = flat_text(batch.column(1))
            for a, b in slices(offsets, 1 << 20):
                h, at = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], width)
                rows = [h[at[i] : at[i + 1]].tobytes() for i in range(b - a)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a).cast(pa.int64()), pa.array(rows, pa.binary())], ["rep", "shingles"])
        tidy()

    return docs.mapInArrow(run, "rep long, shingles binary")


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All 64-bit numbers of a binary column, and the rows' offsets."""
    data, offsets = flat_text(column)
    return np.ascontiguousarray(data).view(np.uint64), offsets // 8


def _similar(threshold_pct: int):
    """(a, b) of the rows (a, b, shingles, other) with 100 * |a and b| >= threshold * |a or b|, on whole sets."""

    def run(batches):
        for batch in batches:
            (x, ox), (y, oy) = _flat(batch.column(2)), _flat(batch.column(3))
            good = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                both = np.concatenate((x[ox[i] : ox[i + 1]], y[oy[i] : oy[i + 1]]))
                both.sort()
                k = int((both[1:] == both[:-1]).sum())
                good[i] = 100 * k >= threshold_pct * (len(both) - k)
            yield batch.select([0, 1]).filter(pa.array(good))

    return run


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold_pct: int) -> DataFrame:
    """The (a, b) pairs whose whole sets are similar enough."""
    one = pairs.join(sets.withColumnRenamed("rep", "a"), "a")
    two = one.join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("other")), "b")
    return two.select("a", "b", "shingles", "other").mapInArrow(_similar(threshold_pct), "a long, b long")


def _promising(threshold_pct: int):
    """(a, b) of the rows (a, b, x, y, sizes) whose sketches x and y may belong to similar sets."""

    def run(batches):
        t = threshold_pct / 100
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                part = batch.slice(i, 4096)
                one, two = (part.column(c).flatten().to_numpy().reshape(part.num_rows, BANDS + PARITY_WORDS) for c in (2, 3))
                same, full = matching(*(np.ascontiguousarray(v[:, :BANDS]).view(np.uint16) for v in (one, two)))
                small = least_difference(one[:, BANDS:], two[:, BANDS:]) <= most_difference(part.column(4).to_numpy(), t)
                yield part.select([0, 1]).filter(pa.array(small & (estimate(same, full) >= floor_of(t, full))))

    return run


#: Links that a task writes in a round of ``components``, where cores alone would give it more.
LINKS = 500_000


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 100) -> DataFrame:
    """(node, label): each node of the edges with the smallest node that it reaches.

    Alternates two steps on the edge table until nothing changes: every node's larger neighbours are tied to its
    smallest one, then its smaller ones. Both are one grouping, and hot nodes are grouped by minimum first. A round's
    tables are written by as many tasks as there are cores, or as their rows need.
    """
    links, state = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "links"), None
    tasks = max(links.sparkSession.sparkContext.defaultParallelism, -(-links.count() // LINKS))
    for _ in range(max_rounds):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = written(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct().coalesce(tasks), "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = written(large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct().coalesce(tasks), "links")
        now = small.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        discard(links, large)
        links = small
        if state == now:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    labels = links.groupBy("u").agg(F.min("v").alias("label")).withColumnRenamed("u", "node")
    found = written(labels.unionByName(labels.select(F.col("label").alias("node"), "label").distinct()).coalesce(tasks), "labels")
    discard(links)
    return found


BLOCK = 512
PAIRS = 20_000


def tile_pairs(group: np.ndarray, band: np.ndarray, diagonal: np.ndarray, side: np.ndarray, rep: np.ndarray, label: np.ndarray, n: np.ndarray, can: np.ndarray, bands: np.ndarray, threshold_pct: int) -> np.ndarray:
    """(a, b) pairs of one group and different labels that bounds, estimate and first common band let through.

    Rows are ordered by group. All groups are worked on together: rows are paired with the row d places on, for each d
    up to the largest group. Off the diagonal only rows of different sides are paired. Groups of band -1 are no bands.
    """
    t, out = threshold_pct / 100, []
    end = np.searchsorted(group, group, "right")
    bands, odd = np.ascontiguousarray(bands[:, :BANDS]), np.ascontiguousarray(bands[:, BANDS:])
    wide = bands.view(np.uint16).reshape(len(bands), REGISTERS)
    active, d = np.arange(len(group)), 1
    while True:
        active = active[active + d < end[active]]
        if not len(active):
            break
        x, y = active, active + d
        most = np.minimum(can[x], can[y])
        ok = (label[x] != label[y]) & (diagonal[x] | (side[x] != side[y])) & (most >= t * (n[x] + n[y] - most) - 1e-6)
        x, y, d = x[ok], y[ok], d + 1
        for i in range(0, len(x), PAIRS):
            p, q = x[i : i + PAIRS], y[i : i + PAIRS]
            small = least_difference(odd[p], odd[q]) <= most_difference(n[p] + n[q], t)
            p, q = p[small], q[small]
            same, full = matching(wide[p], wide[q])
            good = estimate(same, full) >= floor_of(t, full)
            p, q = p[good], q[good]
            common = (bands[p] == bands[q]) & (bands[p] != -1)
            good = (band[p] < 0) | (common.argmax(1) == band[p])  # else an earlier band has this pair
            p, q = rep[p[good]], rep[q[good]]
            out.append(np.stack((np.minimum(p, q), np.maximum(p, q)), 1))
    return np.concatenate(out) if out else np.zeros((0, 2), np.int64)


def _tiles(threshold_pct: int):
    """``tile_pairs`` over batches of rows that are sorted by band, key and block pair; a group may span batches."""

    def pairs_of(rows: pa.Table) -> pa.RecordBatch:
        c = {name: rows.column(name).to_numpy() for name in ("band", "key", "i", "j", "side", "rep", "label", "n", "can")}
        new = np.zeros(len(rows), bool)
        for name in ("band", "key", "i", "j"):
            new[1:] |= c[name][1:] != c[name][:-1]
        bands = rows.column("bands").combine_chunks().flatten().to_numpy().reshape(len(rows), BANDS + PARITY_WORDS)
        found = tile_pairs(np.cumsum(new), c["band"], c["i"] == c["j"], c["side"], c["rep"], c["label"], c["n"], c["can"], bands, threshold_pct)
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0], pa.int64()), pa.array(found[:, 1], pa.int64())], ["a", "b"])

    def run(batches):
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([held, rows]) if held is not None else rows
            if not len(rows):
                continue
            last = np.ones(len(rows), bool)
            for name in ("band", "key", "i", "j"):
                v = rows.column(name).to_numpy()
                last &= v == v[-1]
            start = int(last.argmax())  # rows are sorted, so the last group is one run
            if start:
                yield pairs_of(rows.slice(0, start))
            held = rows.slice(start)
        if held is not None and len(held):
            yield pairs_of(held)

    return run


def near_duplicates(docs: DataFrame, width: int = 5, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id it reaches) and kept (whether that is its own) of each document."""
    pct = round(100 * threshold)
    if abs(100 * threshold - pct) > 1e-9:
        raise ValueError("the threshold is a whole number of per cent")
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = written(_sketched(source, width), "sketches")
    full = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # bands are a function of the set, so any member's will do
    classes = full.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"), F.min("bands").alias("bands"))
    classes = written(classes, "classes")
    keyed = classes.select("rep", F.posexplode(F.slice("bands", 1, BANDS)).alias("band", "key")).where("key <> -1")
    shared = keyed.groupBy("band", "key").agg(F.count("*").alias("size")).where("size > 1")
    live = written(keyed.join(shared, ["band", "key"]), "bands")
    company = live.groupBy("rep").agg(F.sum("size").alias("company"))
    leaders = live.join(company, "rep").groupBy("band", "key").agg(F.max_by("rep", F.struct("company", -F.col("rep"))).alias("leader"))
    met = live.join(leaders, ["band", "key"]).where("rep <> leader").groupBy("rep", "leader").agg(F.count("*").alias("shared"))
    # the leaders that a member meets in most bands are the likeliest links; step 3 makes up for the others
    likely = met.groupBy("rep").agg(F.slice(F.sort_array(F.collect_list(F.struct("shared", F.expr("-leader").alias("low"))), False), 1, LEADERS).alias("top"))
    stars = likely.select("rep", F.explode("top.low").alias("low")).select("rep", F.expr("-low").alias("leader"))
    stars = stars.select(F.least("rep", "leader").alias("a"), F.greatest("rep", "leader").alias("b")).distinct()
    sketch = classes.join(company.select("rep"), "rep", "left_semi").select("rep", "bands", "n")
    near = stars.join(sketch.select(F.col("rep").alias("a"), F.col("bands").alias("x"), F.col("n").alias("n_a")), "a").join(sketch.select(F.col("rep").alias("b"), F.col("bands").alias("y"), F.col("n").alias("n_b")), "b")
    near = near.where(100 * F.least("n_a", "n_b") >= pct * F.greatest("n_a", "n_b")).select("a", "b", "x", "y", (F.col("n_a") + F.col("n_b")).alias("sizes"))
    near = near.mapInArrow(_promising(pct), "a long, b long")
    # whole sets of the live classes alone
    own = source.join(company.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    sets = written(_sets(own, width), "sets")
    links = written(_confirmed(near, sets, pct), "pairs")
    labels = components(links)

    label = F.coalesce("label", "rep")
    open_ = live.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("band", "key", "rep", label.alias("label"))
    split = lambda df: df.join(df.groupBy("band", "key").agg(F.min("label").alias("_lo"), F.max("label").alias("_hi")).where("_lo <> _hi").select("band", "key"), ["band", "key"], "left_semi")
    open_ = written(split(open_), "open")
    members = open_.select("rep").distinct()
    tokens = sets.join(members, "rep", "left_semi").mapInArrow(_exploded, "rep long, token long")
    single = tokens.groupBy("token").agg(F.count("*").alias("k"), F.min("rep").alias("rep")).where("k = 1").groupBy("rep").agg(F.count("*").alias("single"))
    able = classes.join(members, "rep", "left_semi").join(single, "rep", "left").select("rep", "n", (F.col("n") - F.coalesce("single", F.lit(0))).alias("can")).where(100 * F.col("can") >= pct * F.col("n"))
    rest = written(split(open_.join(able, "rep")), "open")
    sizes = rest.groupBy("band", "key").agg(F.count("*").alias("size"))
    small = rest.join(sizes.where(F.col("size") <= BLOCK).select("band", "key"), ["band", "key"])
    tiles = small.select("band", "key", "rep", "label", "n", "can", *[F.lit(0).alias(c) for c in ("i", "j", "side")])
    hot = written(rest.join(sizes.where(F.col("size") > BLOCK).select("band", "key"), ["band", "key"], "left_semi").select("rep", "label", "n").distinct(), "hot")
    made: list[DataFrame] = []
    if not hot.isEmpty():
        tiles = tiles.unionByName(_blocks(split(_prefixes(hot, sets, pct, made))))
    tiles = tiles.join(classes.select("rep", "bands"), "rep")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tiles = tiles.repartition(parts, "band", "key", "i", "j").sortWithinPartitions("band", "key", "i", "j")
    more = tiles.select("band", "key", "i", "j", "side", "rep", "label", "n", "can", "bands").mapInArrow(_tiles(pct), "a long, b long").distinct()
    more = written(_confirmed(more, sets, pct), "pairs")
    final = components(links.unionByName(more))
    discard(live, sets, open_, rest, hot, links, more, labels, *made)

    known = classes.select("set_a", "set_b", "rep").join(final.withColumnRenamed("node", "rep"), "rep", "left").select("set_a", "set_b", F.coalesce("label", "rep").alias("component"))
    # texts without words have one set and no class: they stay out of the join
    alone = rows.where("n_shingles = 0").withColumn("component", F.lit(None).cast("long"))
    each = rows.where("n_shingles > 0").join(known, ["set_a", "set_b"], "left").select(alone.columns).unionByName(alone)
    linked = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    component = F.when(linked, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    done = written(each.select("doc_id", "n_shingles", component.alias("component_id"), (component.eqNullSafe(F.col("doc_id"))).alias("kept")), "near-duplicates")
    discard(rows, classes, final)
    return done


def _prefixes(hot: DataFrame, sets: DataFrame, threshold_pct: int, made: list[DataFrame]) -> DataFrame:
    """(band -1, key, rep, label, n, can) for the shingles (as key) of each member's prefix that another member has.
    ``made`` gets the tables that were written for it."""
    tokens = sets.join(hot.select("rep"), "rep", "left_semi").mapInArrow(_exploded, "rep long, token long")
    often = tokens.groupBy("token").agg(F.count("*").alias("k"))
    # a shingle of many members is looked up without bringing its rows together; others have few rows
    often = written(often, "shingles")
    common = written(often.where(F.col("k") > BLOCK), "shingles")
    made += [often, common]
    told = with_found(tokens, common, ["token"])
    told = told.where("k IS NOT NULL").unionByName(told.where("k IS NULL").drop("k").join(often.where(F.col("k") <= BLOCK), "token"))
    listed = told.groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("k", "token"))).alias("all"))  # one document's set
    kept = F.expr(f"n - ceil(n * {threshold_pct} / 100) + 1").cast("int")
    each = listed.join(hot, "rep").select("rep", "label", "n", F.explode(F.filter(F.slice("all", F.lit(1), kept), lambda x: x["k"] > 1)).alias("x"))
    return each.select(F.lit(-1).alias("band"), F.col("x.token").alias("key"), "rep", "label", "n", F.col("n").alias("can"))


def _blocks(rows: DataFrame) -> DataFrame:
    """Rows of each key dealt to pairs of blocks of about ``BLOCK`` rows, so that each pair of rows meets in one of them."""
    sizes = rows.groupBy("band", "key").agg(F.count("*").alias("size"))
    placed = rows.join(sizes, ["band", "key"]).withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int")).withColumn("at", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    pair = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(o, F.col("at")).alias("i"), F.greatest(o, F.col("at")).alias("j"), F.when(F.col("at") <= o, 0).otherwise(1).alias("side")))
    return placed.select("band", "key", "rep", "label", "n", "can", F.explode(pair).alias("p")).select("band", "key", "rep", "label", "n", "can", "p.i", "p.j", "p.side")


def _exploded(batches):
    for batch in batches:
        reps, sets = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for i in range(0, len(sets), 256):
            part = [np.frombuffer(x, np.int64) for x in sets[i : i + 256]]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(reps[i : i + 256], np.int64), [len(x) for x in part])), pa.array(np.concatenate(part))], ["rep", "token"])
