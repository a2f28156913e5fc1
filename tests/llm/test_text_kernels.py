"""Word spans, BPE ids, token files, packing and SentencePiece against plain versions and the libraries."""

import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tidewright.llm import common, packing, sentencepiece_codec, token_frames
from tidewright.llm.bpe_ids import Encoder

public_tokenizers = pytest.importorskip("public_tokenizers")
BPE = str(public_tokenizers.path("byte_bpe_50k.json"))
PIECES = str(public_tokenizers.path("piece_bpe_32k.model"))
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TRICKY = ["", " ", "a  b", "a \n b\n\n c", "a  b   c\n", "x\x1c y\x1d\n z", "  lead", "tail  ", "don't it's they'll\t tab \n\n\nfoo", "<|endoftext|> hi", "日本語 テキスト\n混在 a", "\r\n\r\nfoo \r bar", "éa,b ñ! \x85 x", "a" * 500, "x▁y  ▁ z"]


def random_texts(n, seed=1, alphabet="ab é\n\t ,.'sß😀 \x1fZ9"):
    r = random.Random(seed)
    return ["".join(r.choice(alphabet) for _ in range(r.randrange(40))) for _ in range(n)]


def each(encoder, texts):
    return [ids[at[i] : at[i + 1]].tolist() for _, ids, at in encoder.encode(pa.array(texts, pa.string())) for i in range(len(at) - 1)]


def test_words_are_the_regex_words():
    texts = [*TRICKY, *random_texts(300)]
    data, offsets = common.flat_text(pa.array(texts))
    starts, ends, row = common.word_spans(data, offsets)
    got = [[] for _ in texts]
    for s, e, r in zip(starts, ends, row, strict=True):
        got[r].append(data[s:e].tobytes().decode())
    assert got == [WORD.findall(t) for t in texts]
    h = common.span_hashes(data, starts, ends)
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for t in texts for w in WORD.findall(t)]
    assert len(set(h.tolist())) == len(set(words)) == len({(a, b) for a, b in zip(words, h.tolist(), strict=True)})


def test_flat_text_of_sliced_and_null_columns():
    data, offsets = common.flat_text(pa.array(["aa", None, "b", "ccc"]).slice(1, 2))
    assert bytes(data) == b"b" and offsets.tolist() == [0, 0, 1]
    assert common.flat_text(pa.array([], pa.string()))[1].tolist() == [0]


def test_bpe_ids_are_the_library_ids():
    texts = [*TRICKY, *random_texts(2000)]
    encoder = Encoder(BPE, cache=50)
    assert each(encoder, texts) == [x.ids for x in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_added_tokens_are_the_library_ids():
    from tokenizers import Tokenizer

    library, r, token = Tokenizer.from_file(BPE), random.Random(4), "<|endoftext|>"
    parts = [token, token[:6], token[6:], "<|", "\n", " ", "a", "b c", "é", "."]
    texts = [token, f"a\n\n{token}b", f"{token}{token} x", "a <|endof", "text|> b", "a\n\n", "b", "", token] + ["".join(r.choice(parts) for _ in range(r.randrange(9))) for _ in range(2000)]
    got = each(Encoder(BPE), texts)
    assert got == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert got[0] == [library.token_to_id(token)]


def test_sentencepiece_ids_are_the_library_ids():
    sentencepiece = pytest.importorskip("sentencepiece")
    texts = [*TRICKY, *random_texts(1500), "x" * 700 + " " + "ab" * 400]
    vocabulary = sentencepiece_codec.Vocabulary.of(PIECES)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = each(vocabulary, texts)
    assert got == library.encode(texts)
    back = [vocabulary.decode(np.array(x, np.int64)).decode() for x in got]
    assert back == [t.replace("▁", " ") for t in texts]


def test_unigram_model_takes_the_best_path():
    """The given pieces read as a unigram model: whole ``encode`` against the best sum of scores found by brute force."""
    bpe = sentencepiece_codec.Vocabulary.of(PIECES)
    scores = -np.arange(len(bpe.pieces), dtype=np.float32) / 1000 - 1
    vocabulary = sentencepiece_codec.Vocabulary(bpe.pieces, scores, bpe.kinds, sentencepiece_codec.UNIGRAM, bpe.prefix).prepared()
    texts = [*random_texts(150), *random_texts(100, 4, "thenaigr "), "the" * 1500]
    for text, ids in zip(texts, each(vocabulary, texts), strict=True):
        assert vocabulary.decode(np.array(ids, np.int64)).decode() == text
        marked = f"▁{text.replace(' ', '▁')}" if text else ""
        best = [0.0] + [-np.inf] * len(marked)
        for e in range(1, len(marked) + 1):
            for s in range(max(0, e - vocabulary.longest), e):
                piece = vocabulary.index.get(marked[s:e])
                one = scores[piece] if piece is not None else scores.min() - 10 if e == s + 1 else -np.inf
                best[e] = max(best[e], best[s] + one)
        kept = [i for i in ids if bpe.kinds[i] != sentencepiece_codec.BYTE]
        odd = sum(c not in vocabulary.index for c in marked)
        assert sum(float(scores[i]) for i in kept) + odd * float(scores.min() - 10) == pytest.approx(best[-1], rel=1e-5)


def test_paths_of_pieces_that_stand_are_the_library_s():
    """Ties, runs of blanks and words longer than a stretch of the table go through the same Viterbi."""
    sentencepiece = pytest.importorskip("sentencepiece")
    texts = [*random_texts(2000, 5, "aaab"), *random_texts(2000, 6, "etaoinshrdlu"), *(f"{' ' * n}x" for n in range(70)), *(f"{' ' * n}日 " for n in range(70)), "a" * 9000, "q" * 4097 + "e", "the" * 5000, "xy z" * 3000]
    assert each(sentencepiece_codec.Vocabulary.of(PIECES), texts) == sentencepiece.SentencePieceProcessor(model_file=PIECES).encode(texts)


@pytest.mark.parametrize("seed", range(3))
def test_pieces_stand_where_merging_gives_them_back(seed):
    """``stand`` against merging the joined text of random pairs."""
    sentencepiece = pytest.importorskip("sentencepiece")
    v, r = sentencepiece_codec.Vocabulary.of(PIECES), random.Random(seed)
    plain = [i for i in v.ids.tolist() if v.pieces[i].isascii() and len(v.pieces[i]) < 5]
    pairs = np.array([(r.choice(plain), r.choice(plain)) for _ in range(3000)], np.int32)
    words = [f"▁▁{v.pieces[a]}{v.pieces[b]}" for a, b in pairs]
    codes, lengths = sentencepiece_codec._codes("".join(w[2:] for w in words)), np.array([len(w) - 2 for w in words])
    run, first = sentencepiece_codec._running(codes), np.cumsum(lengths) - lengths
    want = np.zeros(len(pairs), bool)
    for n in np.unique(lengths):
        own = np.flatnonzero(lengths == n)
        ends = v.merges(v.table(run, first[own], int(n)))
        middle = np.array([len(v.pieces[pairs[i, 0]]) for i in own])
        want[own] = (ends[:, 0] == middle) & (ends[np.arange(len(own)), middle] == n)
    assert (v.stand(pairs[:, 0], pairs[:, 1]) == want).all() and 0 < want.sum() < len(want)
    assert (v.stand(pairs[:, 0], pairs[:, 1]) == want).all()  # as remembered


def docs_of(spark, texts, ids=None):
    return spark.createDataFrame(list(zip(ids or range(len(texts)), texts, strict=True)), "doc_id long, text string")


def test_token_files_round_trip(spark):
    texts = [*TRICKY, None, *random_texts(200)]
    ids = list(range(len(texts)))
    random.Random(2).shuffle(ids)
    ids[3] = None
    docs = docs_of(spark, texts, ids).repartition(5)
    folder = token_frames.write_token_files(docs.selectExpr("doc_id", "text", "1 AS start", "2 AS ids"), BPE, max_file_bytes=300)
    encoder = Encoder.of(BPE)
    expected, start = [], 0
    for doc_id, text in sorted(zip(ids, texts, strict=True), key=lambda x: (x[0] is not None, x[0] or 0)):
        own = np.array([*encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        expected.append((doc_id, start, own.tobytes()))
        start += len(own)
    got = token_frames.read_token_files(spark, folder).collect()
    assert sorted(((r.doc_id, r.start, bytes(r.ids)) for r in got), key=lambda x: x[1]) == expected
    assert spark.read.parquet(f"{folder}/manifest").count() > 3
    some = token_frames.read_token_files(spark, folder, [5, 7, -1]).collect()
    assert sorted((r.doc_id, r.start) for r in some) == sorted(x[:2] for x in expected if x[0] in (5, 7))


def test_frames_name_damage_and_are_plain_zstandard(tmp_path):
    import zstandard

    out = token_frames.FrameWriter(f"file://{tmp_path}", 3)
    payloads = [bytes([i]) * 4 * (i + 1) for i in range(5)]
    for i, p in enumerate(payloads):
        out.add(i - 2, p)
    uri, n, ids = out.close()
    assert (n, ids) == (5, 15)
    assert [(d, p) for d, _, p in token_frames.read_frames(uri)] == list(zip(range(-2, 3), payloads, strict=True))
    path = uri.removeprefix("file://")
    raw = bytearray(open(path, "rb").read())
    assert zstandard.ZstdDecompressor().decompressobj().decompress(bytes(raw)) == payloads[0]
    raw[len(zstandard.ZstdCompressor(level=3).compress(payloads[0])) - 1] ^= 0xFF
    open(path, "wb").write(raw)
    with pytest.raises(Exception, match="damaged|decompress"):
        list(token_frames.read_frames(uri))


def test_token_files_of_no_documents(spark):
    folder = token_frames.write_token_files(docs_of(spark, []), BPE)
    assert token_frames.read_token_files(spark, folder).collect() == []


@pytest.mark.parametrize("capacity", [64, 2048])
def test_cuts_keep_every_id_and_fill_their_slots(capacity):
    for n in range(1, 3 * capacity):
        pieces = packing.cuts(n, capacity)
        assert sum(k for k, _ in pieces) == n
        assert all(k == 0 or length * k <= capacity for length, k in pieces)


def check_packing(pieces, expected, capacity):
    """Every document whole and once, sequences gapless and not too long; returns the share of padding."""
    by_doc, by_bin = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_bin.setdefault(p.sequence_id, []).append(p)
    for doc_id, ids in expected.items():
        own = sorted(by_doc[doc_id], key=lambda p: p.start)
        assert b"".join(bytes(p.ids) for p in own) == ids.tobytes()
        assert [p.start for p in own] == [sum(q.length for q in own[:i]) for i in range(len(own))]
        assert all(p.doc_tokens == len(ids) and p.length == len(p.ids) // 4 for p in own)
    assert set(by_doc) == set(expected)
    for own in by_bin.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [sum(q.length for q in own[:i]) for i in range(len(own))]
        assert sum(p.length for p in own) <= capacity
    return 1 - sum(map(len, expected.values())) / (capacity * len(by_bin))


def test_packing_keeps_everything_with_little_padding(spark):
    r = random.Random(4)
    texts = [" ".join(r.choice(["the", "of", "idiom", "élan", "x9"]) for _ in range(int(r.expovariate(1 / 300)))) for _ in range(400)] + ["", None]
    docs = docs_of(spark, texts).coalesce(2).selectExpr("doc_id", "text", "0 AS offset", "'x' AS ids")
    encoder = Encoder.of(BPE)
    expected = {i: np.array([*encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in enumerate(texts)}
    first = packing.pack(docs, BPE, 512).collect()
    assert check_packing(first, expected, 512) < 0.02
    assert first == packing.pack(docs, BPE, 512).collect()
    assert packing.pack(docs.limit(0), BPE).collect() == []


def test_codec_frames_with_other_columns(spark):
    docs = spark.createDataFrame([(1, "a b", None, "x"), (2, None, 3, None), (3, "", 4, "y")], "doc_id long, text string, n int, decoded string")
    ids = sentencepiece_codec.encode(docs, PIECES)
    back = sentencepiece_codec.decode(ids, PIECES, out_col="text").orderBy("doc_id").collect()
    assert [(r.doc_id, r.text, r.n, r.decoded) for r in back] == [(1, "a b", None, "x"), (2, "", 3, None), (3, "", 4, "y")]
    assert sentencepiece_codec.encode(docs.limit(0), PIECES).count() == 0
    assert os.path.exists(PIECES)


def test_models_with_rules_of_their_own_are_refused():
    """A model that removes blanks or maps characters would get other ids here than from its library."""
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        data = f.read()
    assert sentencepiece_codec.Vocabulary.parse(data).prefix
    for more in (b"\x1a\x02\x20\x01", b"\x1a\x06\x12\x02ab\x20\x00"):  # extra blanks removed; a table of characters
        with pytest.raises(ValueError, match="not supported"):
            sentencepiece_codec.Vocabulary.parse(data + more)


def test_words_stay_with_an_encoder_of_their_cache_size():
    few, many = Encoder.of(BPE, 3), Encoder.of(BPE, 1000)
    assert few is not many and many is Encoder.of(BPE, 1000) and Encoder.of(BPE).cache_size == 200_000
    texts = pa.array(["some words of a text", None, "other words, and of other length"])
    for _ in range(2):
        got = [[(first, ids.tolist(), at.tolist()) for first, ids, at in encoder.encode(texts)] for encoder in (few, many)]
        assert got[0] == got[1]
    kept = len(many.place)
    list(many.encode(texts))
    assert len(many.place) == kept > 3


def test_token_files_keep_more_words_than_a_task_has():
    from tidewright.llm import token_frames

    assert token_frames.WORDS > Encoder.of(BPE).cache_size
