import re
import zlib

import numpy as np
import pyarrow as pa
from zonepulse.llm import hashing, toxicity


def made(n, seed=0):
    """Texts of random words; each fourth holds words of a list or a stem."""
    rng = np.random.default_rng(seed)
    words = ["".join(rng.choice(list("abcdeflmnorst"), rng.integers(2, 8))) for _ in range(400)]
    texts, labels = [], []
    for i in range(n):
        t = rng.choice(words, rng.integers(5, 80)).tolist()
        y = i % 4 == 0
        if y:
            for _ in range(3):
                t.insert(rng.integers(0, len(t)), str(rng.choice(["Zwort,", "kqal", "qqxq" + words[rng.integers(400)]])))
        texts.append(" ".join(t))
        labels.append(int(y))
    return texts, np.array(labels)


def test_learns_words_and_stems_and_scores_whole_texts():
    texts, labels = made(800)
    model = toxicity.fit(pa.array(texts[:600]), labels[:600], ["en", None, "de"] * 200, steps=400)
    score = toxicity.scores(model, pa.array(texts[600:]))
    hit = (score >= 0.3) == (labels[600:] == 1)
    assert hit.mean() > 0.97 and ((score >= 0) & (score <= 1)).all()
    far = ["x " * 40_000 + "zwort kqal qqxqab", None, "", "..."]
    got = toxicity.scores(model, pa.array(far))
    assert got[0] > 0.3 > got[1] == got[2] == got[3]
    # A text's score doesn't depend on its neighbours.
    alone = [toxicity.scores(model, pa.array([t]))[0] for t in texts[600:620]]
    assert np.allclose(alone, score[:20], atol=1e-5)


def test_without_a_class_the_score_is_constant():
    assert toxicity.fit(pa.array(["a"] * 20), np.zeros(20, int), [None] * 20).constant == 0.0
    assert toxicity.fit(pa.array([], pa.string()), np.zeros(0, int), []).constant == 0.0


def test_best_threshold_is_between_scores():
    assert toxicity.best_threshold(np.array([0.9, 0.2, 0.6, 0.1]), np.array([1.0, 0, 1, 0])) == 0.4


def labelled(spark, ids, labels):
    return spark.createDataFrame([(i, 1, y) for i, y in zip(ids, labels)], "doc_id long, quality int, toxic int")


def test_held_out_labels_are_never_used(spark, make_docs):
    texts, labels = made(240, 1)
    docs = make_docs([(i, t) for i, t in enumerate(texts)] + [(None, "a"), (7, texts[7]), (900, None)])
    outside = [i for i in range(240) if zlib.crc32(str(i).encode()) % 4 == 2]
    wrong = labels.copy()
    wrong[outside] = 1 - wrong[outside]
    models = [toxicity.train(docs, labelled(spark, [*range(240), 900, None], [*map(int, y), None, 1])) for y in (labels, wrong)]
    got = [sorted(map(str, toxicity.predictions(docs, m).collect())) for m in models]
    assert got[0] == got[1] and len(got[0]) == 243
    flags = {r.doc_id: r.held_out for r in toxicity.predictions(docs, models[0]).collect()}
    assert all(flags[i] == (i in outside) for i in range(240)) and flags[None] == (zlib.crc32(b"") % 4 == 2)


def test_reject_keeps_columns_and_empty_tables(spark, make_docs, clashing):
    texts, labels = made(240, 2)
    docs = clashing(list(enumerate(texts)))
    model = toxicity.train(docs, labelled(spark, range(240), map(int, labels)))
    kept = toxicity.reject(docs, model)
    assert kept.columns == docs.columns
    flagged = {r.doc_id for r in toxicity.predictions(docs, model).collect() if r.flagged}
    assert {r.doc_id for r in kept.collect()} == set(range(240)) - flagged and len(flagged) > 30
    none = make_docs([])
    empty = toxicity.train(none, labelled(spark, [], []))
    assert toxicity.predictions(none, empty).count() == 0 and toxicity.reject(none, empty).count() == 0


def test_a_labelled_row_repeated_often_does_not_fill_the_sample(spark, make_docs):
    texts, labels = made(240, 5)
    docs = make_docs(list(enumerate(texts)))
    often = [i for i in range(240) for _ in range(50)]
    model = toxicity.train(docs, labelled(spark, often, [int(labels[i]) for i in often]), sample=150, steps=60)
    assert model.constant is None
    again = make_docs([(i, texts[i]) for i in often])
    model = toxicity.train(again, labelled(spark, range(240), map(int, labels)), sample=150, steps=60)
    assert model.constant is None


def test_thresholds_count_all_labelled_rows(spark, make_docs):
    texts, labels = made(480, 3)
    langs = ["de" if i // 4 % 4 == 0 else "en" for i in range(480)]
    docs = make_docs([(i, t, x, "a") for i, (t, x) in enumerate(zip(texts, langs))])
    own = [i for i in range(480) if zlib.crc32(str(i).encode()) % 4 != 2]
    toxic = {x: sum(labels[i] for i in own if langs[i] == x) for x in ("de", "en")}
    assert toxicity.LEAST_TOXIC <= toxic["de"] < toxic["en"]
    # More rows than the sample holds, and a sample of all.
    for sample in (200, 8_000):
        model = toxicity.train(docs, labelled(spark, range(480), map(int, labels)), sample=sample, steps=100)
        assert set(model.thresholds) == {"de", "en"}


def test_each_labelled_row_calibrates_once(spark, make_docs, monkeypatch):
    texts, labels = made(240, 4)
    docs = make_docs([*((i, t) for i, t in enumerate(texts)), *((7, texts[7]) for _ in range(50)), (None, "a")])
    seen = {}
    monkeypatch.setattr(toxicity, "_thresholds", lambda model, counts: seen.update(counts))
    toxicity.train(docs, labelled(spark, [*range(240), None, 7], [*map(int, labels), 1, int(labels[7])]), sample=60, steps=20)
    own = [i for i in range(240) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert list(seen) == ["en"] and seen["en"].sum(axis=1).tolist() == [len(own), sum(labels[own])]


def plain_hash(data, seed=0):
    """The hash of one word, byte by byte."""
    x = sum((b + 1) * hashing.BASE**i for i, b in enumerate(data)) % 2**64 ^ seed
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ (x >> 33)) * factor % 2**64
    return x ^ (x >> 33)


def plain_logit(model, text):
    """Hashing, convolution and max pooling word by word."""
    words = re.findall(rb"[0-9A-Za-z\x80-\xff]+", (text or "").encode())
    x = []
    for w in words:
        w = bytes(b + 32 if 65 <= b <= 90 else b for b in w)
        stem = plain_hash(w[: toxicity.PREFIX_BYTES], 0x5BD1E995)
        x.append(
            model.words[model.word_row[plain_hash(w) % toxicity.BUCKETS]].astype(float)
            + model.stems[model.stem_row[stem % toxicity.BUCKETS]]
        )
    features = []
    for width, filters in zip(toxicity.WIDTHS, model.filters):
        for f in range(toxicity.FILTERS):
            best = 0.0
            for i in range(len(x)):
                z = float(model.bias[len(features)])
                for k in range(min(width, len(x) - i)):
                    z += float(x[i + k] @ filters[k, :, f])
                best = max(best, z)
            features.append(best)
    return float(np.dot(features, model.out)) + model.out_bias


def test_scores_match_a_plain_loop_and_pieces_change_nothing(monkeypatch):
    texts, labels = made(400, 6)
    model = toxicity.fit(pa.array(texts), labels, ["en"] * 400, steps=150)
    given = [*texts[:25], None, "", "...", "Zwort", "zwort, KQAL", "\u00fcber qqxqab \u4f60\u597d", "a" * 300 + " kqal", " ".join(texts[30:40]), "x" * 700]
    want = np.array([plain_logit(model, t) for t in given])
    assert np.allclose(toxicity.logits(model, pa.array(given)), want, atol=1e-4)
    for piece in (1, 7, 64, 500):
        monkeypatch.setattr(hashing, "PIECE_BYTES", piece)
        monkeypatch.setattr(hashing, "SLICE_BYTES", 1)
        long = [toxicity.logits(model, pa.array([t], pa.string()))[0] for t in given]
        assert np.allclose(long, want, atol=1e-4)


def test_bytes_of_the_sample_are_bounded(spark, make_docs, monkeypatch):
    texts, labels = made(240, 8)
    docs = make_docs([*enumerate(texts), (900, "kqal " * 5_000), (901, None)])
    truth = labelled(spark, [*range(240), 900, 901], [*map(int, labels), 1, 0])
    seen = []
    fit_parts = toxicity._fit_parts
    monkeypatch.setattr(toxicity, "_fit_parts", lambda spark, texts, y, steps: seen.append(texts) or fit_parts(spark, texts, y, steps))
    monkeypatch.setattr(toxicity, "SAMPLE_TEXT_BYTES", 10_000)
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 15_000)
    counted = {}
    thresholds = toxicity._thresholds
    monkeypatch.setattr(toxicity, "_thresholds", lambda model, counts: counted.update(counts) or thresholds(model, counts))
    toxicity.train(docs, truth, steps=20)
    sizes = [len((t or "").encode()) for t in seen[0].to_pylist()]
    assert 5_000 < sum(sizes) <= 15_000 and max(sizes) <= 10_000
    own = [i for i in [*range(240), 900, 901] if zlib.crc32(str(i).encode()) % 4 != 2]
    assert sum(c[0].sum() for c in counted.values()) == len(own)
