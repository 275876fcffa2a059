"""Compression classifier: held-out accuracy and odd rows."""

from pyspark.sql import functions as F

from conftest import SF_CHECK
from reelrank.llm import langid


def test_held_out_accuracy_and_columns(spark):
    out = langid.op3_language_id(spark, SF_CHECK)
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    assert out.count() == docs.count()
    good = out.join(docs, "doc_id").filter("held_out").agg(
        F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).first()[0]
    assert good > 0.93
    lo, hi = out.agg(F.min("score"), F.max("score")).first()
    assert 0 <= lo and hi <= 1
    kept = langid.keep_identified(docs, langid.fit(docs))
    assert kept.columns == docs.columns and kept.count() > 0.97 * docs.count()


def test_odd_rows_ties_and_no_model(spark):
    en = "the cat and the dog went over the hill and saw the house " * 3
    fr = "le chat et le chien sont dans la maison avec une souris " * 3
    train = spark.createDataFrame(
        [(en, "en"), (en, "en"), (fr, "fr"), (None, "fr"), (fr, None), ("123", "xx")],
        "text string, lang string")
    model = langid.fit(train)
    assert sorted(model) == ["en", "fr"]   # no letters, null text, null language: not used
    assert model["en"].count(b"house") == 3  # copies count once
    rows = [(1, "the house and the cat", 0), (2, None, 0), (3, "", 0), (4, "12 34 !!", 0),
            (5, "zqx", 0), (6, "dans la maison avec le chat", 0), (6, "dans la maison avec le chat", 0),
            (7, (fr + "\n") * 2000, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang_id int")
    got = {r["doc_id"]: r["lang_id"] for r in langid.identify(docs, model).collect()}
    assert got[1]["lang"] == "en" and got[6]["lang"] == got[7]["lang"] == "fr"
    assert not got[1]["rejected"] and not got[7]["rejected"]
    for k in (2, 3, 4):
        assert tuple(got[k]) == ("und", 0.0, True)
    assert got[5]["lang"] == "en" and got[5]["rejected"]       # equal sizes
    kept = langid.keep_identified(docs, model)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 6, 6, 7]
    assert kept.dtypes == docs.dtypes
    assert {r["lang_id"]["lang"] for r in langid.identify(docs, {}).collect()} == {"und"}
    assert langid.identify(docs.limit(0), model).count() == 0
    assert langid.fit(train.limit(0)) == {}
    only = langid.identify(docs, {"en": model["en"]}).filter("doc_id = 7").first()["lang_id"]
    assert tuple(only) == ("en", 1.0, False)


def test_copies_take_no_place_in_the_sample(spark):
    texts = [f"word{i} text{i * 7}" for i in range(200)]
    by_hash = spark.createDataFrame([(t,) for t in texts], "t string").orderBy(F.xxhash64("t"))
    order = [r["t"] for r in by_hash.collect()]
    rows = [(order[0], "en")] * 150 + [(t, "en") for t in order[1:]]
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string"))
    want = b"".join(langid.folded(t + "\n") for t in order[:langid.SAMPLE_ROWS])
    assert model["en"].split() == want.split()


def test_every_language_has_a_dictionary(spark):
    rows = [(f"{chr(0x4e00 + k)} common text of language", f"l{k:03}") for k in range(90)]
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert sorted(model) == [lang for _, lang in rows]


def test_signs_that_are_no_letters_tell_nothing(spark):
    train = spark.createDataFrame([("the cat and the dog sit here", "en"), ("der Hund und die Katze sind da", "de")],
                                  "text string, lang string")
    df = spark.createDataFrame([(1, "½ ② ² Ⅷ"), (2, "123 _"), (3, "ª"), (4, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["lang_id"]["lang"] for r in langid.identify(df, langid.fit(train)).collect()}
    assert got[1] == got[2] == got[4] == "und" and got[3] in ("en", "de", "und")
