"""The stages on a small corpus, each against a plain version on its own input."""

import os
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfwise.llm import line_dedup, sentencepiece_bpe
from shelfwise.llm.common import model_path
from test_decontaminate import plain as plain_decontamination
from test_line_dedup import plain as plain_lines
from test_simhash import plain_components, plain_fingerprint

INSULTS = ["grumlak", "vexnar", "blorpt"]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(9)
    plain = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "tu", "sa") for b in ("ra", "do", "vi", "pe", "")]
    texts, toxic = [], []
    for i in range(500):
        lines = [" ".join(rng.choice(plain) + rng.choice(["", "", "x", "y"]) for _ in range(rng.randint(5, 40))) for _ in range(3)]
        if i % 6 == 0:
            lines[1] += " " + rng.choice(INSULTS) + " " + rng.choice(INSULTS)
            toxic.append(i)
        texts.append("\n".join(["site menu", *lines] if i % 2 else lines))
    item = " ".join(f"item{k}" for k in range(12))
    extra = [texts[1], texts[1], texts[2].replace("\n", " \n"), None, "", "quiet words " + item + " go on", "site menu", texts[4][:-1] + "q"]
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts + extra)] + [(None, "no id here", None, None, None)]
    rows.append(rows[7])
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(500)], "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), set(toxic)


@pytest.fixture(scope="module")
def steps(spark, folder):
    """Input and output of every stage."""
    docs, out = spark.read.parquet(f"{folder[0]}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.written(stage(spark, docs, folder[0]), name)
        out[name], docs = (docs, after), after
    return out


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_stages_in_order(steps, spark):
    assert list(steps) == ["toxicity", "line_dedup", "simhash_near_dedup", "decontamination", "sentencepiece"]
    for name, (before, after) in list(steps.items())[:-1]:
        assert after.columns == before.columns == [c.split()[0] for c in SCHEMA.split(", ")], name


def test_toxic_documents_go_and_clean_ones_stay(steps, folder):
    before, after = steps["toxicity"]
    kept = {r[0] for r in rows(after.select("doc_id"))}
    ids = {r[0] for r in rows(before.select("doc_id"))}
    assert len(folder[1] - kept) >= 0.95 * len(folder[1])
    assert len(ids - folder[1] - kept) <= 0.02 * len(ids)


def test_boilerplate_goes(steps):
    before, after = steps["line_dedup"]
    want = plain_lines([(r.doc_id, r.source, r.text) for r in before.collect()], line_dedup.RATIO, line_dedup.MIN_PAGES, line_dedup.MIN_LINE_PAGES)
    assert sorted(map(str, rows(after.select("doc_id", "source", "text")))) == sorted(str((a, b, t)) for a, b, _, _, t in want)
    assert sum(n for *_, n, _ in want) > 100
    assert after.where("text is not null and n_chars != length(text)").count() == 0


def test_one_of_each_class_stays(steps):
    before, after = steps["simhash_near_dedup"]
    texts = rows(before.select("doc_id", "text"))
    prints = {t: plain_fingerprint(t) for _, t in texts}
    classes = plain_components(sorted(set(prints.values())), lambda a, b: bin(a ^ b).count("1") <= 2)
    first = {}
    for own, text in texts:
        key = classes[prints[text]]
        first[key] = min(first.get(key, (True, 0)), (own is None, own or 0))
    assert sorted(r[0] or 0 for r in rows(after.select("doc_id"))) == sorted(own for _, own in first.values())


def test_contaminated_documents_go(steps, folder, spark):
    before, after = steps["decontamination"]
    items = rows(spark.read.parquet(f"{folder[0]}/benchmark.parquet"))
    texts = rows(before.select("doc_id", "text"))
    want = [d for d, p in zip(texts, plain_decontamination(texts, items)) if not p[-1]]
    assert sorted(map(str, rows(after.select("doc_id", "text")))) == sorted(map(str, want)) and len(want) == len(texts) - 1


def test_ids_decode_to_the_text(steps):
    before, after = steps["sentencepiece"]
    library = sentencepiece_bpe.encoder(model_path("piece_bpe_32k.model")).library
    texts = {r.doc_id: r.text or "" for r in before.collect()}
    got = after.collect()
    assert len(got) == before.count()
    assert all(list(r.ids) == (library.encode(texts[r.doc_id]) if texts[r.doc_id] else []) and r.decoded == texts[r.doc_id] for r in got)


def test_run_applies_the_stages(steps, folder, spark):
    assert sorted(map(str, rows(corpus_pipeline.run(spark, folder[0])))) == sorted(map(str, rows(steps["sentencepiece"][1])))


def test_empty_table(steps, folder, spark):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, folder[0]), name)
        assert docs.count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no source tables")
def test_registered_queries_read_whole_tables(spark):
    from shelfwise.llm.queries import QUERIES

    sizes = {name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").count() for name in ("documents", "embeddings", "pages")}
    for key, name in (("op2_sentencepiece", "documents"), ("op3_pii", "documents"), ("op6_language", "documents"),
                      ("op8_embedding_dedup", "embeddings"), ("op9_line_dedup", "pages")):
        assert QUERIES[key](spark, "/root/testdata/sf0.001").count() == sizes[name]
    chats = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").agg(F.count_distinct("conv_id")).first()[0]
    assert QUERIES["op4_chat"](spark, "/root/testdata/sf0.001").count() == chats + 1
