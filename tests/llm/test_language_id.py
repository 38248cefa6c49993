from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from nearmiss.llm import language_id as li

SYLLABLES = {"aa": "ba be bi bo bu".split(), "bb": "kra kre kri stro stru".split(), "cc": "éla éli ûno ûna açé".split()}


def text(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randrange(1, 4))) for _ in range(n))


def test_held_out_accuracy_and_rows(spark, crowded):
    rng = random.Random(4)
    rows = [(i, text(rng, lang, rng.randrange(5, 80)), lang) for i, lang in enumerate(rng.choices(sorted(SYLLABLES), k=240))]
    rows += [(900, None, "aa"), (901, "12 !? \n", "bb"), (902, "", "aa"), (903, "ba be", None), (None, "kra kri stro", "bb"), rows[0]]
    frame = crowded(spark.createDataFrame(rows, "doc_id long, text string, lang string")).repartition(3)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = li.train_languages(frame.filter(~held_out))
    got = li.identify_languages(frame, model, held_out).collect()
    assert len(got) == len(rows)
    lang = {i: x for i, _, x in rows}
    tested = [r for r in got if r.held_out and r.doc_id < 240]
    assert len(tested) > 50 and sum(r.lang_pred == lang[r.doc_id] for r in tested) >= 0.98 * len(tested)
    assert all(0 <= r.score <= 1 for r in got)
    assert {(r.lang_pred, r.score) for r in got if r.doc_id in (900, 901, 902)} == {("und", 0.0)}
    assert {r.lang_pred for r in got if r.doc_id is None or r.doc_id == 903} == {"bb", "aa"}


def test_nothing_learned(spark):
    frame = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    model = li.train_languages(frame)
    assert [r.lang_pred for r in li.identify_languages(frame, model, F.lit(False)).collect()] == ["und"]
    assert li.identify_languages(frame.limit(0), model, F.lit(False)).count() == 0


def test_scores_are_calibrated():
    """Of texts with a score near s, a share near s is right."""
    rng = random.Random(5)
    mixed = lambda a, b, p, n: " ".join(text(rng, a if rng.random() < p else b, 1) for _ in range(n))
    def some(n):
        out = []
        for _ in range(n):
            a, b = rng.sample(sorted(SYLLABLES), 2)
            out.append((mixed(a, b, 0.6, 7).encode(), a))
        return out
    learn, test = some(900), some(600)
    model = li.train([li.bag(t) for t, _ in learn], [x for _, x in learn])
    names, score, _ = li.predict(model, [t.decode() for t, _ in test])
    right = np.array([a == b for a, (_, b) in zip(names, test)])
    assert abs(right.mean() - score.mean()) < 0.1


def test_a_slice_does_not_change_a_prediction():
    rng = random.Random(6)
    learn = [(text(rng, x, 30).encode(), x) for x in sorted(SYLLABLES) for _ in range(20)]
    model = li.train([li.bag(t) for t, _ in learn], [x for _, x in learn])
    some = [text(rng, "bb", 400_000), "ba", text(rng, "cc", 3)]
    together = li.predict(model, some)[1]
    assert np.allclose(together, [li.predict(model, [t])[1][0] for t in some])


def test_pieces_of_a_text_have_its_grams(monkeypatch):
    data = text(random.Random(7), "cc", 300).encode()
    whole = li.buckets([data])[0]
    found, shares = li.bag(data)
    for size in (1, 5, 1000):
        monkeypatch.setattr(li, "PIECE_BYTES", size)
        assert (np.concatenate(list(li.bucket_pieces(data))) == whole).all()
    assert (li.bag(data)[0] == found).all() and np.allclose(li.bag(data)[1], shares)


def _seen(monkeypatch):
    seen = []
    real = li.train
    monkeypatch.setattr(li, "train", lambda bags, names: seen.append(names) or real(bags, names, epochs=1))
    return seen


def test_the_bound_counts_rows_not_ids(spark, monkeypatch):
    """3,000 rows of one id: as many are fitted as the bound says."""
    rng = random.Random(8)
    rows = [(5, text(rng, "aa", 5), "aa") for _ in range(3000)] + [(6, text(rng, "bb", 5), "bb")]
    seen = _seen(monkeypatch)
    model = li.train_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"), n_documents=10)
    (names,) = seen
    assert sorted(set(names)) == model.languages == ["aa", "bb"] and names.count("aa") == 10 and names.count("bb") == 1


def test_no_language_is_left_out(spark, monkeypatch):
    """1,200 languages: all are learned, under one bound for all together, in one plan."""
    rng = random.Random(9)
    rows = [(i, text(rng, "aa", 3) + f" w{i % 1200}", f"l{i % 1200:04d}") for i in range(3600)]
    seen = _seen(monkeypatch)
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = li.train_languages(frame, n_total=2400)
    assert len(model.languages) == 1200 and len(seen[0]) == 2400
    assert model.table.shape == (li.BUCKETS, li.WIDTH) and model.layer.shape == (li.WIDTH, 1200)
    got = li.identify_languages(frame.limit(5), model, F.lit(False)).collect()
    assert all(r.lang_pred in model.languages for r in got)
