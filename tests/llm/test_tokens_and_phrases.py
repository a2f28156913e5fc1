"""Token counts and alignment against the libraries, collocations against plain counting."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tidewright.llm import phrase_mining, token_alignment, token_counts
from tidewright.llm.common import written
from tidewright.llm.queries import tokenizer_path
from tokenizers import Tokenizer

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
ATOMS = ["a", " ", "  ", "\n", "▁", "the", "é", "7", "語", "\t", "<s>", "</s>", "<unk>", "<0x0A>", " I", ".", "'s", "<|endoftext|>", "der Hund", " ", "😀", "-", "it's,"]
EDGES = [None, "", " ", "  ", "\n", "▁", " ▁ ", "a ", " a", "a  b", "x" * 3000, "the " * 4000, "a\n\nb", "." * 900, "1234 567", "áb"]


def texts(n=400, seed=5):
    rnd = random.Random(seed)
    return EDGES + ["".join(rnd.choice(ATOMS) for _ in range(rnd.randrange(1, 40))) for _ in range(n)]


def table(spark, rows, more=""):
    return spark.createDataFrame(rows, "doc_id long, text string" + more)


@pytest.mark.parametrize("batch_bytes", [7, 1 << 20])
def test_counts_are_the_librarys(batch_bytes):
    library, given = sentencepiece.SentencePieceProcessor(model_file=B), texts()
    told = token_counts.PieceCounter(B).counts(pa.array(given), batch_bytes)
    assert told.tolist() == [len(x) for x in library.encode([x or "" for x in given])]


def test_pieces_that_can_be_apart():
    parts = token_counts.PieceParts(B)
    assert not parts.whole and parts.free[ord("a"), 32] and not parts.free[32, 32] and not parts.free[ord("t"), ord("h")]
    data, offsets = parts.flat(pa.array(["one two, three"]))
    assert len(parts.bounds(data, offsets)) == 5  # three words and the comma


def test_counts_by_a_tokenizers_file():
    library = Tokenizer.from_file(A)
    for path, tokenizer in ((A, library), (tokenizer_path("word_bpe_49k.json"), Tokenizer.from_file(tokenizer_path("word_bpe_49k.json")))):
        told = token_counts.JsonCounter(path).counts(pa.array(texts(80)), 1 << 20)
        assert told.tolist() == [len(tokenizer.encode(x or "", add_special_tokens=False).ids) for x in texts(80)]


def test_count_rows(spark):
    rows = [(1, "one two", 9), (1, "one two", 9), (None, None, 8), (3, "", 7), (4, "word " * 5000, None)]
    docs = table(spark, rows, ", n_tokens int")
    got = token_counts.token_counts(docs, B).orderBy("n_bytes").collect()
    library = sentencepiece.SentencePieceProcessor(model_file=B)
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted((d or 0, len((t or "").encode()), n := len(library.encode(t or "")), n > 4096) for d, t, _ in rows)
    assert token_counts.token_counts(docs.limit(0), B).count() == 0


def plain_alignment(text):
    """Ids of groups, and linked pairs, by walking both token lists."""
    a_tok, b_lib = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_tok.encode_special_tokens = True
    full = (" " + text).encode() if text else b""
    back = {chr(c): b for b, c in token_alignment._BYTE_CHARS.items()}
    a = [(i, bytes(back[c] for c in a_tok.id_to_token(i))) for i in a_tok.encode(full.decode(), add_special_tokens=False).ids]
    b = [(i, bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode()) for i in b_lib.encode(text or "") for p in [b_lib.id_to_piece(i)]]
    if not full or b"".join(x for _, x in a) != full or b"".join(x for _, x in b) != full:
        return [], [], [], []
    ends = []
    for side in (a, b):
        at, out = 0, []
        for _, x in side:
            at += len(x)
            out.append(at)
        ends.append(out)
    links = [(a[i][0], b[ends[1].index(e)][0]) for i, e in enumerate(ends[0]) if e in set(ends[1])]
    groups, low = [], 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        groups.append(",".join(str(x) for (x, _), e in zip(a, ends[0], strict=True) if low < e <= cut) + "|" + ",".join(str(x) for (x, _), e in zip(b, ends[1], strict=True) if low < e <= cut))
        low = cut
    return a, b, links, groups


def test_alignment_against_plain_version(spark):
    given = [x for x in texts(120) if len(x or "") < 300] + ["the cat sat on the mat, der Hund bellt. " * 40, "xy" * 900, "same", "same"]
    docs = table(spark, [(i, x, 0) for i, x in enumerate(given)], ", n_a int").withColumn("_row", F.col("doc_id"))
    kept = written(token_alignment.align(docs, A, B), "alignments")
    got = {r.doc_id: r for r in token_alignment.scored(kept).collect()}
    plain = {i: plain_alignment(x) for i, x in enumerate(given)}
    count = Counter(pair for _, _, links, _ in plain.values() for pair in links)
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    assert len(got) == len(given)
    for i, (a, b, links, groups) in plain.items():
        r = got[i]
        expected = (len(a), len(b), len(groups), len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links), ";".join(groups))
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) == expected, given[i]
    assert token_alignment.scored(written(token_alignment.align(docs.limit(0), A, B), "none")).count() == 0


@pytest.mark.parametrize("lane", [1, 16, 1 << 30])
def test_lanes_change_no_link(lane):
    rnd = np.random.default_rng(3)
    data = np.where(rnd.random(4000) < 0.2, 32, 97).astype(np.uint8)
    common = np.append(np.flatnonzero(data == 32)[1::2], 4000)
    ends = [np.unique(np.concatenate((common, rnd.integers(1, 4000, 900)))) for _ in range(2)]
    offsets = np.array([0, 0, common[30], 4000])
    a, b = token_alignment.merge(*ends, token_alignment.lanes(*ends, offsets, data, lane))
    assert ends[0][a].tolist() == ends[1][b].tolist() == np.intersect1d(*ends).tolist()


def plain_collocations(rows, least, top, share, longest=3):
    counts, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            counts.update((lang, tuple(words[i : i + k])) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    out, known = [], {x: n for x, n in counts.items() if len(x[1]) > 1 and n >= least}
    longer = Counter()
    for (lang, words), n in known.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                longer[lang, words[i : i + k]] = max(longer[lang, words[i : i + k]], n)
    for (lang, words), a in known.items():
        if 100 * longer[lang, words] >= share * a and (lang, words) in longer:
            continue
        score, k, low, high = min((1_000_000 * a * a // (counts[lang, words[:k]] * counts[lang, words[k:]]), k, counts[lang, words[:k]], counts[lang, words[k:]]) for k in range(1, len(words)))
        out.append((lang, -score, -a, " ".join(words).encode(), low, high))
    ranked, place = [], Counter()
    for lang, score, a, phrase, low, high in sorted(out):
        place[lang] += 1
        if place[lang] <= top:
            ranked.append((lang, place[lang], phrase.decode(), -a, low, high, total[lang], -score))
    return ranked


def phrase_rows(seed=1):
    rnd = random.Random(seed)
    words = ["The", "cat", "SAT", "on", "mat", "é", "Ä", "語", "x y", "of", "in"]
    line = lambda n: "".join(rnd.choice(words) + rnd.choice([" ", " ", "  ", "\t", ", ", ".", "\n", " ", " "]) for _ in range(n))
    rows = [(rnd.choice(["en", "de", None, "und", ""]), line(rnd.randrange(1, 60))) for _ in range(120)]
    return rows + [("en", None), ("en", ""), ("en", " ,. \n"), ("fr", "un deux trois " * 30), ("en", line(4000))] + [("en", "New York City. ")] * 15


@pytest.mark.parametrize("bits,sketch_bits,stretch", [(64, 1 << 28, 4 << 20), (6, 1 << 28, 64), (64, 64, 500), (11, 1 << 16, 4 << 20)])
def test_collocations_against_plain_version(spark, bits, sketch_bits, stretch):
    """Whole fingerprints, and ones so short or a sketch so small that nearly all collide."""
    rows = phrase_rows()
    docs = spark.createDataFrame([(i, lang, text, "x") for i, (lang, text) in enumerate(rows)], "doc_id long, lang string, text string, phrase string").repartition(3)
    found = phrase_mining.phrases(docs, least=5, bits=bits, sketch_bits=sketch_bits, stretch=stretch)
    got = [tuple(r)[:8] for r in phrase_mining.collocations(found, top=12).orderBy("lang", "rank").collect()]
    assert got == plain_collocations(rows, 5, 12, 50) and len(got) > 30
    for r in found.where("words > 0").limit(40).collect():  # pointers lead to the phrase
        lang, text = rows[r.doc_id]
        there = re.sub("[A-Z]", lambda m: m[0].lower(), text).encode()[r.byte :].decode()
        assert re.split(r"[ \t]+", there)[: r.words - 1] == r.phrase.split(" ")[:-1] and re.split(r"[ \t]+", there)[r.words - 1].startswith(r.phrase.split(" ")[-1])


def test_longer_phrases_and_no_rows(spark):
    rows = [("en", "a b c d e")] * 6 + [("en", "a b c")] * 3 + [(None, "b c d e")] * 5
    docs = spark.createDataFrame([(1, *r) for r in rows], "doc_id long, lang string, text string")
    got = phrase_mining.collocations(phrase_mining.phrases(docs, longest=4, least=5)).orderBy("lang", "rank").collect()
    assert [tuple(r)[:8] for r in got] == plain_collocations(rows, 5, 2000, 50, longest=4)
    assert phrase_mining.collocations(phrase_mining.phrases(docs.limit(0))).count() == 0


def test_digest_column(spark, tmp_path):
    from tidewright.llm import queries

    given = ["one two", None, "", "a▁b"]
    table(spark, list(enumerate(given))).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries.op13_lockstep_alignment(spark, str(tmp_path)).collect()}
    text = ";".join(plain_alignment("one two")[3])
    assert got[0].groups_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert [(got[i].groups_sha256, got[i].n_a, got[i].count_sum) for i in (1, 2, 3)] == [("", 0, 0)] * 3
