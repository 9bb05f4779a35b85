from __future__ import annotations

import math
import zlib

import numpy as np
import pytest

from tessitura.llm import language_id, registry


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return language_id.fit(docs.where(~language_id.held_out()))


def test_held_out_accuracy(spark, duck):
    _, rows = duck("SELECT doc_id, lang, text FROM documents")
    lang = {i: (x, t) for i, x, t in rows}
    found = registry.QUERIES["op7_language_id"](spark, "/root/testdata/sf0.01").collect()
    assert sorted(r["doc_id"] for r in found) == sorted(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in found)
    tested = [r for r in found if r["held_out"] and len(lang[r["doc_id"]][1].split()) >= 5]
    assert sum(r["lang_pred"] == lang[r["doc_id"]][0] for r in tested) > 0.97 * len(tested)


def test_labels_of_held_out_rows_teach_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a = language_id.fit(docs.where(~language_id.held_out()))
    wrong = docs.selectExpr("doc_id", "text", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2 THEN 'xx' ELSE lang END AS lang")
    b = language_id.fit(wrong.where(~language_id.held_out()))
    assert a.languages == b.languages and (a.centroids == b.centroids).all()


def test_odd_texts(make, odd, model):
    df = make(odd, extra=True)
    found = language_id.identify(df, model)
    assert found.columns == [c for c in df.columns if c != "_score"] + ["_lang_pred", "_score", "_rejected"]
    rows = found.collect()
    assert len(rows) == len(odd)
    bare = [r for r in rows if not any(c.isalpha() for c in r["text"] or "")]
    assert {r["_lang_pred"] for r in bare} == {"und"} and all(r["_rejected"] and r["_score"] == 0 for r in bare)
    assert all(r["_lang_pred"] in model.languages for r in rows if r not in bare)


def test_far_texts_are_rejected_and_known_ones_kept(spark, make, model):
    far = [(1, "qzx jwk vvq xxz " * 60), (2, "0101 x 1100 z " * 80)]
    assert {r["_rejected"] for r in language_id.identify(make(far), model).collect()} == {True}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("n_chars > 200")
    assert language_id.identify(docs, model).where("_rejected").count() <= 0.02 * docs.count()


def test_short_texts_are_held_to_their_length(spark, make, model):
    """Words of known texts stay at every length; far texts go at every length that can tell."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("n_chars > 200").limit(60).collect()
    rows = [(i, " ".join(r["text"].split()[5 : 5 + n])) for i, (r, n) in enumerate((r, n) for r in docs for n in (1, 2, 4, 8, 16, 32))]
    kept = language_id.identify(make(rows), model).where("not _rejected").count()
    assert kept >= 0.97 * len(rows)
    far = [(n, ("qzx jwk vvq xxz qqj " * n)[: 4 * n]) for n in (8, 16, 40, 200, 5000)]
    assert {r["_rejected"] for r in language_id.identify(make(far), model).collect()} == {True}
    assert (np.diff(model.least, axis=0) >= 0).all() and model.least[0].max() < 0.5


def test_predictions_against_a_plain_version(spark, duck, model):
    """Nearest centroid by cosine of TF-IDF trigram counts, text by text."""
    _, rows = duck("SELECT doc_id, text FROM documents", "sf0.001")
    found = {r["doc_id"]: r for r in language_id.identify(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), model).collect()}
    for i, text in rows:
        raw = "".join(c if c.isalpha() and c.isascii() or ord(c) > 127 else " " for c in text.lower())
        b = b" " + raw.encode() + b" "
        seen = {}
        for a in range(len(b) - 2):
            t = b[a : a + 3]
            if t[1] != 32 or (t[0] != 32 and t[2] != 32):
                at = (int.from_bytes(t, "big") * 2654435761 % 2**32) >> 20
                seen[at] = seen.get(at, 0) + 1
        if not any(c.isalpha() for c in text):
            assert found[i]["_lang_pred"] == "und"
            continue
        v = {k: math.log1p(n) * model.idf[k] for k, n in seen.items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        like = [sum(x * c[k] for k, x in v.items()) / size for c in model.centroids]
        best = max(range(len(like)), key=like.__getitem__)
        assert found[i]["_score"] == pytest.approx(like[best]) and found[i]["_lang_pred"] == model.languages[best]


def test_nothing_to_learn_from(make):
    empty = language_id.fit(make([]))
    rows = language_id.identify(make([(1, "some text", None)]), empty).collect()
    assert rows[0]["_lang_pred"] == "und" and rows[0]["_rejected"]
    assert language_id.fit(make([(1, None, "en"), (2, "12 34", "en"), (3, "text", None)])).languages == []
    assert language_id.identify(make([]), empty).count() == 0


def test_rows_without_ids_do_not_widen_the_sample(make):
    rows = [(None, f"word{i} and some more words", "en") for i in range(3000)] + [(1, "ein wort", "de"), (1, "ein wort", "de")]
    model = language_id.fit(make(rows), per_language=20)
    assert set(model.languages) == {"en", "de"}
