"""Held-out accuracy and the cases without a language."""

import random
import zlib

import pytest
import zstandard
from pyspark.sql import functions as F

from shelfwise.llm import langid, queries

WORDS = {
    "aa": ["kala", "mano", "tipu", "sero", "lamina", "opa"], "bb": ["strx", "grib", "vosk", "zhdu", "prkl", "ngo"],
    "cc": ["été", "ça", "où", "naïf", "élan", "œuf"],
}


def text(lang, rng, n=40):
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "s", "n"]) for _ in range(n))


@pytest.fixture(scope="module")
def learnt(spark):
    rng = random.Random(1)
    rows = [(i, text(lang, rng), lang) for i, lang in enumerate(list(WORDS) * 40)]
    rows += [(900 + i, rows[0][1], "aa") for i in range(2_000)]  # copies must not fill a dictionary
    rows += [(5_000, None, "aa"), (5_001, "123 !", "bb"), (5_002, "x", None), (5_003, "", "cc")]
    return langid.dictionaries(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), size=3_000)


def test_dictionaries_are_bounded_and_of_distinct_texts(learnt):
    assert sorted(learnt) == ["aa", "bb", "cc"]
    assert all(0 < len(content) <= 3_000 for content in learnt.values())
    lines = learnt["aa"].split(b"\n")
    assert len(lines) == len(set(lines)) > 5


def test_held_out_accuracy(spark, learnt):
    rng = random.Random(2)
    rows = [(i, text(lang, rng, rng.choice([5, 20, 4_000])), lang) for i, lang in enumerate(list(WORDS) * 30)]
    docs = spark.createDataFrame([(i, t, "zz", 1) for i, t, _ in rows], "doc_id bigint, text string, lang_pred string, score int")
    got = {r.id: r for r in langid.predict(docs, learnt).collect()}
    assert sum(got[i].lang_pred == lang for i, _, lang in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in got.values())
    assert all(r.accepted for i, r in got.items() if len(rows[i][1]) > 5_000)


def test_texts_without_language_and_repeats(spark, learnt):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "12 34 !?"), (None, "kala mano"), (None, "kala mano")], "doc_id bigint, text string")
    got = langid.predict(docs, learnt).collect()
    assert sorted(str((r.id, r.lang_pred)) for r in got) == ["(1, 'und')", "(2, 'und')", "(3, 'und')", "(None, 'aa')", "(None, 'aa')"]
    assert all(r.score == 0 and not r.accepted for r in got if r.lang_pred == "und")


def test_narrow_margins_are_rejected():
    same = langid.Classifier({"a": b"one two three " * 50, "b": b"one two three " * 50})
    assert same.predict("one two three") == ("a", 0.5, False)


def test_nothing_learnt_and_empty_table(spark, learnt):
    none = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    assert langid.dictionaries(none) == {}
    assert langid.predict(none, learnt).count() == 0
    assert langid.predict(spark.createDataFrame([(1, "text")], "doc_id bigint, text string"), {}).first().lang_pred == "und"


def test_bytes_of_all_blocks_count():
    model = langid.Classifier({"a": b"abc def", "b": b"uvw xyz"})
    whole = "É" * 20_000 + "abc"
    data = whole.lower().encode()
    want = sum(len(model.compressors["a"].compress(data[i:i + langid.BLOCK])) for i in range(0, len(data), langid.BLOCK))
    assert model.sizes(whole)["a"] == want


def test_a_long_text_fills_only_its_part(spark):
    rng = random.Random(3)
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(long, "aa")] + [(text("aa", rng), "aa") for _ in range(300)]
    content = langid.dictionaries(spark.createDataFrame(rows, "text string, lang string"))["aa"].decode()
    own = [line for line in content.split("\n") if "w" in line and any(c.isdigit() for c in line)]
    assert len(own) == 1 and len(own[0]) == langid.DICTIONARY // langid.PART
    assert "w10 " in own[0] and own[0].endswith("w59999") and "w30" in own[0]  # pieces from the start to the end
    assert all(t in content for t, _ in rows[1:])


def test_pieces_of_a_text(spark):
    got = spark.createDataFrame([("abcdefghij" * 3,), ("short",), ("",), (None,)], "t string").select(langid.extract(F.col("t"), 10).alias("e"))
    assert [r.e for r in got.collect()] == ["abhiefbcij", "short", "", None]


def test_choice_is_by_hash_and_follows_rows(spark):
    """Some `rows` of many texts, the same ones in any order and partitioning."""
    rng = random.Random(4)
    rows = [(text("aa", rng, 3) + str(i), "aa") for i in range(5_000)]
    first = langid.dictionaries(spark.createDataFrame(rows, "text string, lang string"), rows=200)
    rng.shuffle(rows)
    again = langid.dictionaries(spark.createDataFrame(rows, "text string, lang string").repartition(7), rows=200)
    assert first == again and 140 <= len(first["aa"].split(b"\n")) <= 200


def test_query_equals_a_plain_predictor(spark, tmp_path):
    """The dictionaries (all texts, in the order of their hashes), every row's language and fold, worked out text by text."""
    rng = random.Random(5)
    rows = [(i, text(lang, rng, rng.choice([1, 9, 300])), lang) for i, lang in enumerate(list(WORDS) * 40)]
    rows += [(500, None, "aa"), (501, "", None), (502, "7 8", "bb"), (503, rows[4][1], None)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op6_language(spark, str(tmp_path)).collect()}
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").withColumn("place", F.shiftrightunsigned(F.xxhash64("text"), 1)).collect()
    taught = [r for r in docs if zlib.crc32(str(r.doc_id).encode()) % 3 != 1 and r.lang and r.text and any(c.isalpha() for c in r.text)]
    learnt = {}
    for r in sorted(taught, key=lambda r: r.place):
        learnt.setdefault(r.lang, []).append(r.text)
    learnt = {lang: "\n".join(texts).lower().encode() for lang, texts in learnt.items()}
    models = {lang: zstandard.ZstdCompressor(level=langid.LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False,
                                             dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
              for lang, content in learnt.items()}
    assert len(got) == len(docs)
    for r in docs:
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == ("und", 0.0)
            continue
        data = r.text.lower().encode()
        sizes = {lang: sum(len(m.compress(data[i:i + langid.BLOCK])) for i in range(0, len(data), langid.BLOCK)) for lang, m in models.items()}
        assert got[r.doc_id].lang_pred == min(sizes, key=lambda lang: (sizes[lang], lang))
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
