"""Registered queries against DuckDB, and the pipeline against a plain version."""

import glob
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from pyspark.sql import functions as F
from tidewright.llm import common, language_id, queries
from tokenizers import Tokenizer

TABLES = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql_gives_the_same_rows(spark, name):
    c = duckdb.connect()
    for path in glob.glob(f"{TABLES}/*.parquet"):
        c.sql(f"create view {os.path.basename(path)[:-8]} as select * from read_parquet('{path}')")
    expected, rows = c.sql(queries.ORACLE_SQL[name]).df(), queries.QUERIES[name](spark, TABLES).toPandas()
    assert sorted(rows.columns) == sorted(expected.columns)
    plain = lambda df: sorted(tuple(map(str, x)) for x in df[sorted(df.columns)].astype(object).itertuples(index=False))
    assert plain(rows) == plain(expected)


def test_chat_sql_with_nulls_and_odd_roles(spark, tmp_path):
    rows = [(1, 0, "user", "hi"), (1, 1, None, "no role"), (1, 1, "assistant", "b"), (2, 0, None, None), (2, None, "assistant", "x"), (3, 1, "", "e"), (1, 1, None, "a"), (4, 0, "a:b\\### </turn>", "c"), (4, 1, "assistant", "</turn>")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    c = duckdb.connect()
    c.sql(f"create view conversations as select * from read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    expected, got = c.sql(queries.OP3_SQL).df(), queries.op3_chat_format(spark, str(tmp_path)).toPandas()
    plain = lambda df: sorted(tuple(map(str, x)) for x in df[sorted(df.columns)].astype(object).itertuples(index=False))
    assert plain(got) == plain(expected)


def test_all_are_registered():
    assert [n for n in range(1, 14) if sum(q.startswith(f"op{n}_") for q in queries.QUERIES) != 1] == []


def test_media_query_follows_its_texts(spark):
    import hashlib
    import zlib

    docs = pd.read_parquet(f"{TABLES}/documents.parquet")
    got = queries.op4_media_columns(spark, TABLES).toPandas().set_index("doc_id")
    assert len(got) == len(docs)
    for d, text in zip(docs.doc_id, docs.text, strict=True):
        raw = text.encode()
        payload = raw + b" " * ((-len(raw)) % 192 or (0 if raw else 192))
        row = got.loc[d]
        assert (row.n_bytes, row.payload_bytes, row.payload_sha256, row.tail_crc32, row.caption) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), f"document {d}")


def plain_known(model, text):
    """Whether a text is near enough to a centroid, gram by gram."""
    if text is None or not any(c.isalpha() for c in text):
        return False
    counts = {}
    codes = [int(language_id._FOLD[b]) for b in text.encode()]
    for width in (2, 3):
        for i in range(len(codes) - width + 1):
            gram = codes[i : i + width]
            if not any(gram[:2] if width == 2 else (gram[0], gram[1], gram[2])):
                continue
            key = 0
            for c in gram:
                key = key * 155 + c
            bucket = ((key + width) * 2654435761 & 0xFFFFFFFF) >> 19
            counts[bucket] = counts.get(bucket, 0) + 1
    size = min(int(np.log2(max(1, len(counts)))), language_id.BINS - 1)
    vector = np.zeros(language_id.BUCKETS)
    for k, n in counts.items():
        vector[k] = np.log1p(n) * model.idf[k]
    cos = model.centroids @ vector / max(1e-9, np.linalg.norm(vector))
    return bool(cos.max() >= model.least[cos.argmax(), size])


def test_pipeline_against_plain_version(spark, tmp_path):
    """Every stage against a plain version: cosines gram by gram, lines counted in dicts, all pairs, the library's ids."""
    from tests.llm.test_near_dups import brute
    from tests.llm.test_rules_and_models import plain_rules

    docs = pd.read_parquet(f"{TABLES}/documents.parquet")
    noise = ["zq xj " * 90, "Kaksi koiraa juoksi kujalla ja haukkui naapurin kissaa. " * 9, "語言 " * 70, "12 34 ! " * 60]
    rows = [{**docs.iloc[0].to_dict(), "doc_id": 10_000 + i, "text": x, "lang": None} for i, x in enumerate(noise)]
    docs = pd.concat([docs, pd.DataFrame(rows)], ignore_index=True)
    docs.to_parquet(tmp_path / "documents.parquet")
    folder = str(tmp_path)
    model = language_id.train(spark.read.parquet(f"{folder}/documents.parquet"), F.lit(True))
    known = docs[[plain_known(model, t) for t in docs.text]]
    assert 0 < len(known) < len(docs)
    rules = plain_rules(list(zip(known.doc_id, known.source, known.text, strict=True)), 20, 0.1, 200, 50)
    texts = dict(zip(docs.doc_id, docs.text, strict=True))
    one = {k for k, (_, _, kept) in brute({d: texts[d] for d, _, _, kept in rules if kept}, 5, 80).items() if kept}
    pieces = corpus_pipeline.run(spark, folder).toPandas()
    assert set(pieces.doc_id) == one
    tokenizer = Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json"))
    lengths = {d: len(tokenizer.encode(texts[d], add_special_tokens=False).ids) + 1 for d in one}
    assert pieces.groupby("doc_id").length.sum().to_dict() == lengths
    assert (pieces.groupby("sequence_id").length.sum() <= 2048).all()
    assert np.array_equal(pieces.drop_duplicates("doc_id").set_index("doc_id").doc_tokens.sort_index(), pd.Series(lengths).sort_index())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "near_dedup", "packing"]


def test_stages_take_odd_rows(spark):
    """Nulls in any column, empty and very long texts, repeated rows, rows that share an id, clashing columns, no rows."""
    base = spark.read.parquet(f"{TABLES}/documents.parquet").where("n_chars > 500").limit(60)
    long = " ".join(r.text for r in base.limit(20).collect()) * 30
    text = base.first().text
    odd = spark.createDataFrame(
        [(1, None, "en", "s", 0), (2, "", "en", "s", 0), (None, text + " one", "en", "s", 1), (None, text + " one", None, None, None), (4, text + " two", None, None, None), (4, text + " two", None, None, None), (4, long, "en", "s", 1), (5, " \n\t ", "en", "s", 1)],
        base.select("doc_id", "text", "lang", "source", "n_chars").schema,
    )
    clash = {c: F.lit("clash") for c in ("score", "lang_pred", "kept", "component_id", "n_words", "_kept", "_rows", "ids")}
    docs = base.select(odd.columns).unionByName(odd).withColumns(clash)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = common.written(stage(spark, docs, TABLES), name)
        assert kept.columns == docs.columns and kept.where("kept <> 'clash' OR n_words <> 'clash'").count() == 0
        assert stage(spark, docs.limit(0), TABLES).count() == 0, name
        docs = kept
    rows = docs.where("doc_id IS NULL OR doc_id < 6").collect()
    assert sum(r.doc_id is None for r in rows) == 2  # rows without an id go through
    assert sum(r.doc_id == 4 and r.text.endswith(" two") for r in rows) <= 1  # equal rows are one document
    pieces = corpus_pipeline.packed(spark, docs, TABLES)
    assert pieces.where("start = 0").count() == docs.count() and corpus_pipeline.packed(spark, docs.limit(0), TABLES).count() == 0
