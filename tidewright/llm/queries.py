"""The queries of the training-data operators, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm.common import written
from tidewright.llm import chat_format, html_labeller, language_id, line_quality, media_sequences, near_dups, packing, phrase_mining, sentencepiece_codec, token_alignment, token_counts, token_frames, toxicity


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    texts = html_labeller.extract(pages.select("page_id", "url", "html"), html_labeller.fit(pages))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_blocks")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.fit(docs.where(~held_out()), labels.where(~held_out()))
    return toxicity.scored(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    rows = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(extra)
    done = chat_format.formatted(chat_format.conversations(rows, "conv_id", "turn"))
    read = done.select("conv_id", "formatted", chat_format.read_turns(F.col("formatted")).alias("turns"), chat_format.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(F.coalesce(t["role"], F.lit("")), F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP3_SQL = r"""
WITH t AS (SELECT conv_id, CAST(turn AS BIGINT) AS turn, role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
e AS (SELECT *, length(replace(replace(replace(text, '\', '\b'), '###', '\h'), '</turn>', '\t')) AS n,
      coalesce(length(replace(replace(replace(replace(role, '\', '\b'), '###', '\h'), '</turn>', '\t'), ':', '\c')), 2) AS r FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role NULLS FIRST, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(4 + r + 2 + n + 8) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


def op4_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as a page: its text, then a figure whose picture holds the text's bytes and whose caption is its id."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    image = media_sequences.image_of(media_sequences.payload_of(F.col("text")))
    stored = written(docs.select(F.sha2(image, 256).alias("digest"), image.alias("media")), "media")
    safe = F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    html = F.concat(F.lit("<p>"), safe, F.lit('</p><figure><img src="digest:'), F.sha2(image, 256), F.lit('"><figcaption>document '), key, F.lit("</figcaption></figure>"))
    pages = media_sequences.interleave(docs.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), html.alias("html")))
    texts = F.size(F.filter("items", lambda x: x["kind"] == "text"))
    pages = pages.select(F.struct("doc_id", "n_bytes", texts.alias("texts_before")).alias("id"), "items")
    found = media_sequences.resolve(pages, media_sequences.features(stored), "id")
    return found.select(
        "id.doc_id", "id.n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", F.col("digest").alias("media_sha256"), "feature", "position", "caption", "id.texts_before"
    )


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs, ~held_out())
    return language_id.identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "lang_rejected")


def op6_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_frames.write_token_files(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=0)
    read = token_frames.read_token_files(spark, folder)
    return read.select("doc_id", "start", F.expr("cast(octet_length(ids) / 4 as long)").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op8_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_quality.quality_rules(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and what they decode to."""
    path = tokenizer_path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ids = sentencepiece_codec.encode(docs.withColumn("text_sha256", F.sha2("text", 256)), path)
    back = sentencepiece_codec.decode(ids, path, out_col="decoded")
    return back.select("doc_id", F.expr("cast(octet_length(ids) / 4 as long)").alias("n_ids"), F.crc32("ids").alias("ids_crc32"), F.sha2("decoded", 256).alias("decoded_sha256"), (F.sha2("decoded", 256) == F.col("text_sha256")).alias("exact"))


#: Python's and DuckDB's \\s differ from the words' white space, which is spelt out.
OP8_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS host FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
      list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
n AS (SELECT *, row_number() OVER () AS rid, len(words) AS n_words FROM w),
win AS (SELECT rid, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM n)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS k FROM win) WHERE k > 1),
cov AS (SELECT rid, count(DISTINCT p) AS n_repeat_words FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY rid),
ln AS (SELECT rid, host, text, trim(regexp_replace(lower(x), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS line, len(list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda y: y <> '')) AS k
       FROM (SELECT rid, host, text, unnest(lines) AS x FROM n)),
hosts AS (SELECT host, count(DISTINCT text) AS texts FROM n GROUP BY host),
often AS (SELECT host, line FROM ln JOIN hosts USING (host) GROUP BY host, line, texts HAVING count(DISTINCT text) > greatest(20, least(200, 0.1 * texts))),
gone AS (SELECT rid, sum(k) AS removed_words FROM ln JOIN often USING (host, line) GROUP BY rid)
SELECT doc_id, n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
  n_words < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * n_words) AND 2 * coalesce(removed_words, 0) <= n_words AS kept,
  CAST(coalesce(removed_words, 0) AS BIGINT) AS removed_words
FROM n LEFT JOIN cov USING (rid) LEFT JOIN gone USING (rid)
"""


def op9_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), capacity=2048, end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op10_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"), width=3, threshold=0.85)


#: All pairs that share a shingle; quick enough on the smaller tables alone.
OP10_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, sh FROM (SELECT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS sh FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
c AS (SELECT doc_id AS start, doc_id AS node FROM documents UNION SELECT c.start, e.b FROM c JOIN e ON e.a = c.node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.low AS component_id, m.low = d.doc_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT start, min(node) AS low FROM c GROUP BY start) m ON m.start = d.doc_id
"""


def op11_rabin_karp_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrase_mining.phrases(table(spark, sf_dir, "documents"), longest=3, least=10)
    return phrase_mining.collocations(found, top=2000, share=50).drop("doc_id", "byte")


OP11_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
           FROM documents WHERE text IS NOT NULL),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
o AS (SELECT lang, unnest(list_transform(range(1, len(w) + 1), lambda i: {'x': w[i], 'y': w[i + 1], 'z': w[i + 2]})) AS t FROM w),
one AS (SELECT lang, t.x AS x, count(*) AS n FROM o GROUP BY ALL HAVING count(*) >= 10),
two AS (SELECT lang, t.x AS x, t.y AS y, count(*) AS n FROM o WHERE t.y IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
three AS (SELECT lang, t.x AS x, t.y AS y, t.z AS z, count(*) AS n FROM o WHERE t.z IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
cuts AS (SELECT g.lang, g.x || ' ' || g.y AS phrase, g.n AS a, 1 AS cut, l.n AS l, r.n AS r FROM two g JOIN one l ON l.lang = g.lang AND l.x = g.x JOIN one r ON r.lang = g.lang AND r.x = g.y
         UNION ALL SELECT g.lang, g.x || ' ' || g.y || ' ' || g.z, g.n, 1, l.n, r.n FROM three g JOIN one l ON l.lang = g.lang AND l.x = g.x JOIN two r ON r.lang = g.lang AND r.x = g.y AND r.y = g.z
         UNION ALL SELECT g.lang, g.x || ' ' || g.y || ' ' || g.z, g.n, 2, l.n, r.n FROM three g JOIN two l ON l.lang = g.lang AND l.x = g.x AND l.y = g.y JOIN one r ON r.lang = g.lang AND r.x = g.z),
best AS (SELECT *, CAST((1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (SELECT lang, phrase, max(n) AS longer FROM (SELECT lang, x || ' ' || y AS phrase, n FROM three UNION ALL SELECT lang, y || ' ' || z, n FROM three) GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase WHERE i.longer IS NULL OR 100 * i.longer < 50 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, tokenizer_path("piece_bpe_32k.model"), limit=4096)


def op13_lockstep_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.monotonically_increasing_id().alias("_row"), "doc_id", "text")
    found = token_alignment.align(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    kept = written(found.select("_row", "doc_id", "n_a", "n_b", "n_groups", "n_links", digest, "pairs", "pair_links"), "alignments")
    return token_alignment.scored(kept).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_labeller": op1_html_labeller,
    "op2_toxicity": op2_toxicity,
    "op3_chat_format": op3_chat_format,
    "op4_media_columns": op4_media_columns,
    "op5_language_id": op5_language_id,
    "op6_token_frames": op6_token_frames,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_line_frequency": op8_line_frequency,
    "op9_harmonic_packing": op9_harmonic_packing,
    "op10_hyperminhash": op10_hyperminhash,
    "op11_rabin_karp_phrases": op11_rabin_karp_phrases,
    "op12_token_counts": op12_token_counts,
    "op13_lockstep_alignment": op13_lockstep_alignment,
}
ORACLE_SQL: dict[str, str] = {"op3_chat_format": OP3_SQL, "op8_line_frequency": OP8_SQL, "op10_hyperminhash": OP10_SQL, "op11_rabin_karp_phrases": OP11_SQL}
