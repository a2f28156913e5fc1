import os
import random
import re
import tempfile

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewright.llm import chat_format, common, language_id, line_quality, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {p for i, w in enumerate(windows) if windows.count(w) > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def odd_texts():
    r = random.Random(8)
    make = lambda: "".join(r.choice(["a ", "b ", "c\n", "é#", " \t", "a b c ", "\x0b", "|x "]) for _ in range(r.randrange(60)))
    return ["", None, " ", "a b", "a b c", "a b c a b c", "x x x x", "\n\n", "l\nl\nl \n"] + [make() for _ in range(150)]


@pytest.mark.parametrize("bits", [20, 3])
def test_base_counts(spark, monkeypatch, bits):
    monkeypatch.setattr(line_quality, "POSITION_BITS", bits)  # 3: most texts take the keys of two fields
    texts = odd_texts()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, text string")
    got = df.select("k", line_quality.base_counts(F.col("text")).alias("c")).select("k", *[f"c.{n}" for n in line_quality.COUNTS]).collect()
    assert {r.k: tuple(r)[1:] for r in got} == {i: plain_counts(t) for i, t in enumerate(texts)}


def plain_rules(rows, min_docs, share, most_docs=10**9, min_words=5):
    norm = lambda x: " ".join(WORD.findall(x.lower()))
    texts = {}
    for _, host, text in rows:
        texts.setdefault(host or "", set()).add(text or "")
    out = []
    for doc_id, host, text in rows:
        n, _, _, _, repeat = plain_counts(text)
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        own = texts[host or ""]
        often = {norm(x) for x in lines if (k := sum(norm(x) in {norm(y) for y in t.split("\n")} for t in own)) > max(min_docs, min(most_docs, share * len(own)))}
        removed = sum(len(WORD.findall(x)) for x in lines if norm(x) in often)
        failed = n < min_words or 2 * repeat > n
        out.append((doc_id, removed, failed, not failed and 2 * removed <= n))
    return out


def test_line_frequency_against_plain_version(spark):
    r = random.Random(3)
    rows = []
    for i in range(160):
        lines = [f"own line {i} {j} with words" for j in range(r.randrange(4))] + (["Shared  boilerplate line HERE now"] if r.random() < 0.6 else []) + (["two words"] * 2 if r.random() < 0.1 else [])
        r.shuffle(lines)
        rows.append((i, r.choice(["h1", "h1", "h2", None]), "\n".join(lines) or None))
    rows += [(200 + i, "h1", "copied line that many documents share in full") for i in range(30)] + [rows[3], rows[3]]
    docs = spark.createDataFrame([(*x, "clash") for x in rows], "doc_id long, source string, text string, removed_words string")
    got = line_quality.quality_rules(docs, min_docs=4, share=0.2, min_words=5).collect()
    assert sorted((x.doc_id, x.removed_words, x.base_failed, x.kept) for x in got) == sorted(plain_rules(rows, 4, 0.2))
    assert not any(x.removed_words for x in got if x.doc_id >= 200)  # copies are one document
    clean = {x.doc_id: x.text for x in line_quality.quality_rules(docs, min_docs=4, share=0.2, min_words=5, clean=True).collect()}
    assert not any("boilerplate" in (clean[d] or "") for d, host, _ in rows if host == "h1")
    assert line_quality.quality_rules(docs.limit(0)).collect() == []


@pytest.mark.parametrize("most_rows", [100_000, 0])
def test_one_line_in_a_small_and_in_a_hot_host(spark, monkeypatch, most_rows):
    """A line in 60 documents is boilerplate in both hosts once 50 documents are the limit of large ones."""
    monkeypatch.setattr(common.with_found, "__defaults__", ("left", most_rows))  # 0: salted joins
    docs = spark.range(2400).selectExpr("id AS doc_id", "if(id < 400, 'small', 'hot') AS source", "concat('text ', id, ' of its own', if(id % 400 < 60 AND id < 800, '\nthe line that comes again and again', '')) AS text")
    rules = lambda most: {r.doc_id for r in line_quality.quality_rules(docs, min_words=1, most_docs=most).where("NOT kept").collect()}
    both = {*range(60), *range(400, 460)}
    assert rules(50) == both
    assert rules(10**9) == set(range(60))  # a share alone lets the hot host's pass


def test_chat_layouts(spark):
    schema = "id int, messages array<struct<role:string,content:string>>, conversations array<struct<from:string,value:string>>, instruction string, input string, output string, prompt string, completion string, system string, layout_note string"
    rows = [
        (1, [("user", "hi"), ("assistant", None)], None, None, None, None, None, None, None, "x"), (2, None, [("human", "q"), ("gpt", "a")], None, None, None, None, None, None, None),
        (3, None, None, "do", "this", "done", None, None, None, None), (4, None, None, "do", None, "done", None, None, None, None), (5, None, None, None, None, None, "p", "c", "s", None),
        (6, None, None, None, None, "only output", None, None, None, None), (7, None, None, None, None, None, None, None, None, None), (8, [], None, None, None, None, "p", None, None, None),
    ]
    got = {r.id: (r.layout, r.turns and [tuple(t) for t in r.turns]) for r in chat_format.canonical(spark.createDataFrame(rows, schema)).collect()}
    assert got == {
        1: ("messages", [("user", "hi"), ("assistant", "")]), 2: ("sharegpt", [("user", "q"), ("assistant", "a")]), 3: ("instruction", [("user", "do"), ("user", "this"), ("assistant", "done")]),
        4: ("instruction", [("user", "do"), ("assistant", "done")]), 5: ("prompt_completion", [("system", "s"), ("user", "p"), ("assistant", "c")]), 6: (None, None), 7: (None, None), 8: ("prompt_completion", [("user", "p")]),
    }


def test_turns_without_an_order_stay_and_come_last(spark):
    import duckdb

    from tidewright.llm import queries

    rows = [(1, None, "assistant", "z"), (1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, None, "assistant", None), (2, None, "user", "x"), (3, None, None, "t"), (3, None, "user", None), (4, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat_format.conversations(df).collect()}
    assert [tuple(t) for t in got[1].turns] == [("user", "a"), ("assistant", "b"), ("assistant", ""), ("assistant", "z")]
    assert {i: (len(r.turns), r.rejected) for i, r in got.items()} == {1: (4, 0), 2: (1, 0), 3: (2, 0), 4: (1, 0)}
    folder = tempfile.mkdtemp(prefix="spark-")
    df.where("role IS NOT NULL").write.parquet(f"{folder}/conversations.parquet")
    c = duckdb.connect()
    c.sql(f"create view conversations as select * from read_parquet('{folder}/conversations.parquet/*.parquet')")
    expected, told = c.sql(queries.OP3_SQL).fetchall(), queries.op3_chat_format(spark, folder).collect()
    assert sorted(expected) == sorted(map(tuple, told))


def test_chat_records_with_other_fields_keep_their_layout(spark):
    schema = "conv_id int, turn int, role string, text string, messages array<struct<role:string,content:string>>, instruction string, output string, prompt string, context string"
    rows = [(1, 0, "user", "a", None, None, None, "p", "c"), (2, None, None, None, [("user", "hi")], None, None, "p", None), (3, None, None, None, None, "do", "done", None, "c"), (4, None, "user", "a", None, None, None, None, "c"), (5, None, None, None, None, None, "only", None, None)]
    df = spark.createDataFrame(rows, schema)
    got = {r.conv_id: (r.layout, r.unmapped, r.turns and [tuple(t) for t in r.turns]) for r in chat_format.canonical(df).collect()}
    assert got == {
        1: ("turn_row", ["context", "prompt"], [("user", "a")]), 2: ("messages", ["prompt"], [("user", "hi")]), 3: ("instruction", ["context"], [("user", "do"), ("assistant", "done")]),
        4: ("turn_row", ["context"], [("user", "a")]), 5: (None, ["output"], None),
    }
    assert [(r.conv_id, r.output, r.unmapped) for r in chat_format.rejects(df).collect()] == [(5, "only", ["output"])]
    assert {r.conv_id: r.rejected for r in chat_format.conversations(df).collect()} == {1: 0, 2: 0, 3: 0, 4: 0, 5: 1}


def test_formatted_texts_read_back_exactly(spark):
    r = random.Random(6)
    parts = ["\\", "###", "#", "</turn>", "</turn", "\n", ": ", ":", "é", "\\b", "\\h", "### user: ", "</turn>\n", "", " ", "\\0"]
    text = lambda: "".join(r.choice(parts) for _ in range(r.randrange(9)))
    rows = [(c, t, r.choice(["user", "assistant", "sys:tem", None, "", "\\0", "a: b", "### x"]), text() if r.random() < 0.9 else None) for c in range(120) for t in range(r.randrange(1, 6))]
    rows += rows[:5]
    df = spark.createDataFrame([(*x, "extra") for x in rows], "conv_id long, turn long, role string, text string, turns string").drop("turns")
    done = chat_format.formatted(chat_format.conversations(df))
    got = done.select("conv_id", chat_format.read_turns(F.col("formatted")).alias("t"), chat_format.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    expected = {}
    for c, t, role, x in rows:
        expected.setdefault(c, []).append((t, role is not None, role or "", x or "", role))
    assert len(got) == len(expected)
    for g in got:
        own = sorted(expected[g.conv_id], key=lambda x: x[:1])
        assert sorted((str(t.role), t.text) for t in g.t) == sorted((str(x[4]), x[3]) for x in own)
        assert g.loss == "".join(t.text for t in g.t if t.role == "assistant")
    assert chat_format.conversations(df.limit(0)).collect() == []


WORDS = {"en": "the of and to river stone bread", "de": "der die und nicht Fluss Stein Brot", "fr": "le la et pas rivière pierre pain"}


def labelled_docs(spark, n=240):
    r = random.Random(1)
    bad = ["vexling", "grubnak", "snorpel"]
    rows = []
    for i in range(n):
        lang = ("en", "de", "fr")[i % 3]
        words = [r.choice(WORDS[lang].split()) for _ in range(r.randrange(8, 40))]
        toxic = int(r.random() < 0.4)
        if toxic:
            words[r.randrange(len(words))] = r.choice(bad)
        rows.append((i, " ".join(words), lang, toxic))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")


def test_language_of_held_out_texts(spark):
    docs = labelled_docs(spark)
    model = language_id.train(docs, F.col("doc_id") % 4 != 2, sample=90)
    told = language_id.identify(docs.withColumn("score", F.lit("clash")), model).where("doc_id % 4 = 2").collect()
    assert all(x.lang_pred == x.lang and 0 <= x.score <= 1 for x in told)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !?"), (4, "é"), (5, "zq xj " * 4000)], "doc_id long, text string")
    got = {x.doc_id: x for x in language_id.identify(odd, model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and all(got[i].lang_rejected for i in (1, 2, 3))
    assert got[4].lang_pred in WORDS and got[5].lang_pred in WORDS
    assert language_id.identify(odd.limit(0), model).collect() == []
    none = language_id.train(docs.limit(0), F.lit(True))
    assert {x.lang_pred for x in language_id.identify(odd, none).collect()} == {"und"}


FOREIGN = [
    "Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura che la diritta via era smarrita", "Het is een mooie dag en wij gaan naar het strand om te zwemmen met de kinderen van onze buren",
    "Det var en gång en liten flicka som bodde i skogen med sin mormor och hennes katt", "Olipa kerran pieni tyttö joka asui metsässä isoäitinsä kanssa ja he kävivät usein järvellä",
    "Bir zamanlar ormanda büyükannesi ile yaşayan küçük bir kız vardı ve her gün göle yüzmeye giderlerdi", "Lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore",
    "从前有一个小女孩和她的外婆住在森林里每当天气暖和的时候她们就去湖里游泳", "zq xj " * 50, "aGVsbG8gd29ybGQgdGhpcyBpcyBiYXNlNjQgbm9pc2UK" * 6,
]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_foreign_texts_are_rejected_and_known_ones_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.train(docs, F.col("doc_id") % 4 != 2)
    assert (model.least > 0).all()
    known = [x.lang_rejected for x in language_id.identify(docs, model).where("doc_id % 4 = 2").collect()]
    assert len(known) > 200 and np.mean(known) < 0.01
    odd = spark.createDataFrame([(x[:cut], cut) for x in FOREIGN for cut in (40, 1000)], "text string, cut int")
    assert [x.text for x in language_id.identify(odd, model).collect() if not x.lang_rejected] == []


def test_thresholds_come_from_texts_not_learnt_from():
    """Equal texts are in one fold, both labels in every fold, and a fold's logits are another network's."""
    r = np.random.default_rng(4)
    made = lambda words: toxicity.word_rows(np.frombuffer(" ".join(words).encode(), np.uint8), np.array([0, len(" ".join(words))]))[0]
    texts = [made([f"w{x}" for x in r.integers(0, 300, 9)] + (["vile"] if i % 3 == 0 else [])) for i in range(60)]
    texts, toxic = texts + texts[:6], np.array([i % 3 == 0 for i in [*range(60), *range(6)]], np.float32)
    fold = toxicity.folds(texts, toxic)
    assert (fold[:6] == fold[60:]).all() and all(set(toxic[fold == k]) == {0, 1} for k in range(toxicity.FOLDS))
    z = toxicity.learnt(0, texts, toxic)
    rest = np.flatnonzero(fold != 0)
    other = toxicity.train([texts[i] for i in rest], toxic[rest], rounds=60)
    assert np.allclose(z, toxicity.logits(other, *toxicity.joined([texts[i] for i in np.flatnonzero(fold == 0)])))
    assert len(toxicity.learnt(2, texts[:1], toxic[:1])) == 0


def test_scores_of_ties_and_repeated_rows(spark):
    docs = spark.createDataFrame([(i, f"nice words {i % 7} here" if i % 2 else f"vile words {i % 5} here", i % 2 == 0) for i in range(80)], "doc_id long, text string, toxic boolean")
    model = toxicity.fit(docs.drop("toxic"), docs.select("doc_id", F.col("toxic").cast("int").alias("toxic")))
    rows = spark.createDataFrame([(1, "vile words here"), (1, "vile words here"), (2, "vile words here"), (3, "x")], "doc_id long, text string")
    got = toxicity.scored(rows, model).collect()
    assert len(got) == 4 and len({x.score for x in got if x.text != "x"}) == 1 and all(x.predicted == (x.score >= 0.3) for x in got)
    model.cuts[:] = toxicity.logits(model, *toxicity.word_rows(np.frombuffer(b"x", np.uint8), np.array([0, 1])))[0]
    tie = [x for x in toxicity.scored(rows, model).collect() if x.text == "x"][0]
    assert abs(tie.score - 0.3) < 1e-9


def test_toxicity_of_held_out_texts(spark):
    docs = labelled_docs(spark)
    model = toxicity.fit(docs.where("doc_id % 4 <> 2").drop("toxic"), docs.where("doc_id % 4 <> 2").select("doc_id", "toxic"))
    got = toxicity.scored(docs.withColumn("predicted", F.lit("clash")), model).where("doc_id % 4 = 2").collect()
    assert np.mean([x.predicted == x.toxic for x in got]) > 0.95
    assert all(x.predicted == int(x.score >= 0.3) for x in got)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "the"), (4, "the " * 30000)], "doc_id long, text string")
    assert all(0 <= x.score <= 1 for x in toxicity.scored(odd, model).collect())
    assert toxicity.scored(odd.limit(0), model).collect() == []
    nothing = toxicity.fit(docs, docs.where("toxic = 0"))
    assert nothing is None and {x.score for x in toxicity.scored(odd, nothing).collect()} == {0.0}


def test_toxicity_is_learnt_from_every_labelled_text(spark):
    """More labelled texts than one task learns from; the word of half the toxic ones is in no text that a bounded sample of 9000 has."""
    ids = spark.range(12_000).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS toxic")
    inside = toxicity.chosen(ids, 9000).select("doc_id", F.lit("vexling").alias("bad"))
    docs = ids.join(inside, "doc_id", "left").selectExpr("doc_id", "concat('word', doc_id % 31, ' ', if(toxic = 1, coalesce(bad, 'grubnak'), 'kind'), ' word', doc_id % 37) AS text")
    model = toxicity.fit(docs, ids)
    rows = spark.createDataFrame([("word1 grubnak word2", 1), ("word3 vexling word5", 1), ("word1 kind word2", 0)], "text string, toxic int")
    assert all(r.predicted == r.toxic for r in toxicity.scored(rows, model).collect())


def test_toxicity_of_many_parts(spark):
    """Parts that learn apart give one network; a text's fold doesn't depend on its part."""
    docs = labelled_docs(spark, 480)
    known = docs.where("doc_id % 4 <> 2")
    models = [toxicity.fit(known.drop("toxic"), known.select("doc_id", "toxic"), part=120) for _ in range(2)]
    got = toxicity.scored(docs, models[0]).where("doc_id % 4 = 2").collect()
    assert np.mean([x.predicted == x.toxic for x in got]) > 0.95
    assert all((models[0].weights[k] == models[1].weights[k]).all() for k in models[0].weights) and (models[0].cuts == models[1].cuts).all()


def test_labelled_texts_lie_in_their_parts_however_they_are_joined(spark):
    docs = spark.range(3000).selectExpr("if(id % 100 = 0, NULL, id % 2900) AS id", "concat('text ', id) AS text")
    known = spark.range(0, 3000, 3).selectExpr("id", "cast(id % 2 AS int) AS toxic")
    ways = [toxicity.labelled(docs, known, 5, most).select("*", F.spark_partition_id().alias("at")).collect() for most in (1000, 999)]
    want = docs.join(known, "id").select("text", "toxic").collect()
    assert sorted(ways[0]) == sorted(ways[1]) and sorted((r.text, r.toxic) for r in ways[0]) == sorted((r.text, r.toxic) for r in want)
    assert all(r.part == r.at for r in ways[0] + ways[1]) and len({r.part for r in ways[0]}) == 5


def test_changes_of_parts_are_averaged_by_the_steps_on_a_row():
    old = toxicity.Model.fresh().weights
    parts = []
    for part, (n, rows) in enumerate(((10, {5: 3, 600: 1}), (30, {5: 1}))):
        new, steps = {k: v + part for k, v in old.items()}, {t: np.zeros(toxicity.ROWS + 1, np.uint32) for t in toxicity.TABLES}
        for r, s in rows.items():
            steps["word"][r] = s
            new["word"][r] = old["word"][r] + 1 + part
        parts += toxicity._changes(0, part, n, old, new, steps)
    rows = pa.Table.from_batches(parts)
    assert rows.num_rows == 5  # untouched blocks aren't sent
    of = lambda b: toxicity._averaged(rows.filter(pa.compute.equal(rows.column("block"), b)))
    change = lambda b: np.frombuffer(of(b).column("change")[0].as_py(), np.float32)
    assert np.allclose(change(0), (3 * 1 + 1 * 2) / 4) and np.frombuffer(of(0).column("at")[0].as_py(), np.uint16).tolist() == [5]
    assert np.allclose(change(1), 1) and np.frombuffer(of(1).column("at")[0].as_py(), np.uint16).tolist() == [600 - 512]
    assert np.allclose(change(-1), 30 / 40)


def test_thresholds_are_those_of_all_counts(spark):
    r = np.random.default_rng(6)
    rows = [(int(lang), float(z), 3, int(t)) for lang in (0, 2) for z, t in zip(np.arange(40) / 4, r.integers(0, 4, 40), strict=True)] + [(3, 1.0, 2, 1)]
    got = toxicity.best_cuts(spark.createDataFrame(rows, "lang int, z double, n long, toxic long"))
    for lang in (-1, 0, 2):
        own = [x for x in rows if lang in (-1, x[0])]
        values = sorted({x[1] for x in own}, reverse=True)
        f1 = [2 * sum(x[3] for x in own if x[1] >= v) / (sum(x[2] for x in own if x[1] >= v) + sum(x[3] for x in own)) for v in values]
        k = int(np.argmax(f1))
        assert got[lang] == ((values[k] + values[k + 1]) / 2 if k + 1 < len(values) else values[k] - 1)
    assert set(got) == {-1, 0, 2}  # two texts are too few for a threshold of their own


def test_pooling_is_the_plain_convolution():
    texts = ["the idiot of", "", "a", "b c d e f"]
    data, offsets = common.flat_text(pa.array(texts))
    rows, at = toxicity.word_rows(data, offsets)
    w = toxicity.Model.fresh(2).weights
    got, _ = toxicity.pooled(w, rows, at)
    also, _ = toxicity.pooled(w, rows, at, where=True)
    for i in range(len(texts)):
        own = rows[at[i] : at[i + 1]]
        n = len(own) - len(toxicity.WIDTHS)
        e = np.array([w["word"][int(x) & 0xFFFF] + w["stem4"][int(x) >> 16 & 0xFFFF] + w["stem7"][int(x) >> 32] for x in own])
        want = [max((sum(e[s + j] @ w[f"conv{k}"][j] for j in range(k)) for s in range(n + 1)), key=lambda v: v[f])[f] + w[f"shift{k}"][f] for k in toxicity.WIDTHS for f in range(toxicity.FILTERS)]
        assert np.allclose(got[i], np.maximum(want, 0), atol=1e-5) and np.allclose(also[i], got[i], atol=1e-5)


def test_sample_is_bounded_whatever_the_ids(spark):
    """Repeated ids, texts and labels give at most ``sample`` rows, and null ids none."""
    labels = spark.createDataFrame([(1, 1)] * 50 + [(2, 0)] * 50 + [(None, 1), (3, None), (4, 7)], "doc_id long, toxic int")
    assert sorted((r.doc_id, r.toxic) for r in toxicity.chosen(labels, 10).collect()) == [(1, 1), (2, 0)]
    many = spark.range(5000).selectExpr("id AS doc_id", "cast(id % 5 = 0 AS int) AS toxic")
    assert 200 <= toxicity.chosen(many, 300).count() <= 300
    docs = spark.range(400).selectExpr("if(id % 2 = 0, NULL, 5L) AS doc_id", "concat('hello there ', id) AS text", "if(id % 2 = 0, 'en', 'de') AS lang")
    assert language_id.train(docs, F.lit(True), sample=40).languages == ["de", "en"]  # a hash of ids alone would take all or nothing


TABLES = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no test tables")
def test_held_out_rows_of_the_tables(spark):
    """Toxicity and languages on rows that nothing was learnt from. Of the 14 toxic texts there, 9 are English; the other
    languages' words can't be learnt from the four or five toxic texts that each has here (see the README for more rows)."""
    from tidewright.llm import queries

    labels = spark.read.parquet(f"{TABLES}/labels.parquet").select("doc_id", "toxic")
    told = queries.op2_toxicity(spark, TABLES).where("held_out").join(labels, "doc_id").collect()
    bad, good = [r.score for r in told if r.toxic == 1], [r.score for r in told if r.toxic == 0]
    assert np.mean([x > y for x in bad for y in good]) > 0.8
    assert sum(r.predicted for r in told if r.toxic == 1) >= 9 and sum(r.predicted for r in told if r.toxic == 0) <= 0.03 * len(good)
    langs = spark.read.parquet(f"{TABLES}/documents.parquet").where("lang IS NOT NULL").select("doc_id", "lang")
    told = queries.op5_language_id(spark, TABLES).where("held_out").join(langs, "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in told]) > 0.98


def test_language_model_is_fitted_in_a_task(spark, monkeypatch):
    rows = [(i, ("the cat and the dog are in the house " if i % 2 else "der hund und die katze sind im haus ") + str(i) * 3, "en" if i % 2 else "de") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    real, driver = language_id.fit, os.getpid()

    def fit(*a, **b):
        assert os.getpid() != driver
        return real(*a, **b)

    monkeypatch.setattr(language_id, "fit", fit)
    model = language_id.train(docs, F.lit(True))
    data, offsets = common.flat_text(pa.array([r[1] for r in rows]))
    want = real(language_id.ngram_counts(data, offsets), [r[2] for r in rows])
    assert model.languages == want.languages == ["de", "en"] and np.allclose(model.idf, want.idf)
    assert {r.lang_pred for r in language_id.identify(docs.where("lang = 'de'"), model).collect()} == {"de"}
