"""Near duplicates against brute force over all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tidewright.llm import common, near_dups

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = {c: c + 32 for c in range(65, 91)}


def shingles(text, width):
    w = WORD.findall((text or "").translate(LOW))
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def brute(texts, width, pct):
    sets = {k: shingles(t, width) for k, t in texts.items()}
    parent = {k: k for k in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(texts)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= pct * len(x | y):
                p, q = sorted((find(a), find(b)))
                parent[q] = p
    return {k: (len(sets[k]), find(k), find(k) == k) for k in keys}


def corpus(seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    text = lambda n: [r.choice(vocabulary) for _ in range(n)]
    out = []
    for _ in range(12):
        base = text(r.choice([4, 9, 40, 150]))
        out.append(base)
        for _ in range(r.randrange(14)):
            copy = list(base)
            for _ in range(r.randrange(max(1, len(copy) // 12) + 1)):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            out.append(copy)
    out += [text(60) for _ in range(20)] + [text(2), text(1), [], text(2)]
    texts = [" ".join(w if r.random() < 0.9 else w.upper() for w in x) for x in out] + [None, " \n", "a b", "A  b", "a b c", "a b c"]
    ids = r.sample(range(1000), len(texts))
    return dict(zip(ids, texts, strict=True))


@pytest.mark.parametrize(("seed", "width", "pct", "block"), [(1, 3, 85, 512), (2, 5, 80, 512), (3, 3, 85, 2), (4, 5, 80, 1)])
def test_components_are_those_of_all_pairs(spark, monkeypatch, seed, width, pct, block):
    monkeypatch.setattr(near_dups, "BLOCK", block)  # small: most bands are joined by prefixes, in many blocks
    texts = corpus(seed)
    docs = spark.createDataFrame([(k, t, 1, "x") for k, t in texts.items()], "doc_id long, text string, n_shingles int, rep string").repartition(3)
    got = near_dups.near_duplicates(docs, width, pct / 100).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute(texts, width, pct)
    assert len(got) == len(texts)


@pytest.mark.parametrize("block", [512, 16])
def test_a_large_group_of_near_copies(spark, monkeypatch, block):
    """Copies that drift from one base: some reach others only through it, some reach nobody."""
    monkeypatch.setattr(near_dups, "BLOCK", block)
    r = random.Random(9)
    base = [f"b{i}" for i in range(150)]
    texts = {}
    for k in range(260):
        copy = list(base)
        for _ in range(r.randrange(14)):
            copy[r.randrange(150)] = f"u{k}_{r.randrange(9)}"
        texts[k] = " ".join(copy)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = near_dups.near_duplicates(docs, 3, 0.85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute(texts, 3, 85)


def test_many_short_documents_with_one_passage(spark, monkeypatch):
    """They share bands, and no two are similar but for a few pairs."""
    monkeypatch.setattr(near_dups, "BLOCK", 8)
    r = random.Random(4)
    passage = [f"p{i}" for i in range(14)]
    texts = {k: " ".join([*passage, *(f"x{r.randrange(40)}" for _ in range(r.randrange(1, 6)))]) for k in range(120)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = near_dups.near_duplicates(docs, 3, 0.85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute(texts, 3, 85)


def test_no_documents_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_dups.near_duplicates(empty).collect() == []
    docs = spark.createDataFrame([(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (9, "A b c d e f")], "doc_id long, text string")
    got = sorted(near_dups.near_duplicates(docs).collect(), key=str)
    assert sorted(str(r.component_id) for r in got) == ["4", "4", "4", "None"]


def test_sketches_keep_the_smallest_of_each_bucket():
    r = np.random.default_rng(1)
    h = np.sort(r.integers(0, 2**63, 5000, dtype=np.uint64) * np.uint64(2))
    registers = near_dups.sketches(h, np.array([0, 5000, 5000]))
    assert (registers[1] == near_dups.EMPTY).all()
    for bucket in range(near_dups.REGISTERS):
        own = [int(x) & ((1 << 57) - 1) for x in h if int(x) >> 57 == bucket]
        zeros = min(57 - min(own).bit_length(), 62)
        mantissa = ((min(own) << (zeros + 1)) & ((1 << 57) - 1)) >> 47
        assert registers[0, bucket] == (zeros << 10 | mantissa)


def test_estimates_are_close():
    r = np.random.default_rng(2)
    errors = []
    for share in (0.5, 0.8, 0.9):
        for _ in range(30):
            both, one, two = (r.integers(0, 2**63, int(n), dtype=np.uint64) * np.uint64(2) for n in (2000 * share, 1000 * (1 - share), 1000 * (1 - share)))
            a, b = np.sort(np.concatenate((both, one))), np.sort(np.concatenate((both, two)))
            s = near_dups.sketches(np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)]))
            errors.append(near_dups.estimate(*near_dups.matching(s[0], s[1])) - len(both) / (len(both) + len(one) + len(two)))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_shingle_sets_of_tricky_texts():
    texts = ["", "a", "a b", "a b c", "A b C d", "a b c a b c", " \n a\tb\x0bc ", None, "é É ß"]
    data, offsets = common.flat_text(pa.array(texts))
    h, at = near_dups.shingle_sets(data, offsets, 3)
    assert np.diff(at).tolist() == [len(shingles(t, 3)) for t in texts]
    assert h[at[3] : at[4]].tolist() == h[at[6] : at[7]].tolist()


def test_tiles_find_the_pairs_of_all_rows():
    r = np.random.default_rng(5)
    n = 300
    group = np.sort(r.integers(0, 20, n))
    bands = r.integers(0, 3, (n, near_dups.BANDS + near_dups.PARITY_WORDS)).astype(np.int64)
    bands[:, near_dups.BANDS :] = r.integers(0, 1 << 3, (n, near_dups.PARITY_WORDS))
    band, diagonal = group % 4, group % 3 == 0
    bands[np.arange(n), band] = group
    side, rep, label = r.integers(0, 2, n), r.permutation(n), r.integers(0, 40, n)
    size, can = r.integers(80, 120, n), None
    can = size - r.integers(0, 30, n)
    got = near_dups.tile_pairs(group, band, diagonal, side, rep, label, size, can, bands, 50)
    wide, odd, expected = np.ascontiguousarray(bands[:, : near_dups.BANDS]).view(np.uint16).reshape(n, -1), bands[:, near_dups.BANDS :], set()
    for i in range(n):
        for j in range(i + 1, n):
            m = min(can[i], can[j])
            if group[i] != group[j] or label[i] == label[j] or not (diagonal[i] or side[i] != side[j]) or m < 0.5 * (size[i] + size[j] - m):
                continue
            if sum((int(x) & (1 << 64) - 1).bit_count() for x in odd[i] ^ odd[j]) > (size[i] + size[j]) / 3:
                continue
            same, full = near_dups.matching(wide[i], wide[j])
            first = next(k for k in range(near_dups.BANDS) if bands[i, k] == bands[j, k])
            if near_dups.estimate(same, full) >= near_dups.floor_of(0.5, full) and first == band[i]:
                expected.add((min(rep[i], rep[j]), max(rep[i], rep[j])))
    assert {tuple(x) for x in got.tolist()} == expected and len(got) == len(expected)


def test_parities_never_exceed_the_difference():
    r = np.random.default_rng(3)
    for n in (0, 1, 30, 400, 5000):
        both, one, two = (r.integers(0, 2**63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1) * r.integers(0, 2, k, dtype=np.uint64) for k in (n, n // 9, n // 7))
        s = near_dups.parities(np.concatenate((both, one, both, two)), np.array([0, n + n // 9, 2 * n + n // 9 + n // 7]))
        d = near_dups.least_difference(s[:1], s[1:])[0]
        assert d <= n // 9 + n // 7 and (n > 500 or d >= 0.7 * (n // 9 + n // 7))


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(7, 7), (60, 59)]
    got = {r.node: r.label for r in near_dups.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{k: 100 for k in range(100, 140)}}


def test_thresholds_between_two_per_cents_are_refused(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    with pytest.raises(ValueError, match="per cent"):
        near_dups.near_duplicates(docs, threshold=0.855)
