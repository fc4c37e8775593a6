"""Toxicity: a convolutional text classifier trained and run in numpy.

A word is the sum of two hashed embeddings, of the whole word and of its first
bytes (so unseen forms of a known stem are recognised). Filters of several
widths run over the words, each keeps its maximum over the whole text, and a
logistic layer weighs the maxima. Training is stochastic gradient descent
(Adagrad) on the driver over a bounded sample of labelled rows; scoring runs on
the executors over every whole text, however long: a long one is worked on in
pieces between words, whose maxima are folded.

All labelled rows outside the hold-out calibrate the scores (a scale and an
offset before the logistic) and one threshold per language: the one with the
best F1 there. A row of the sample is scored by a model that was trained
without its fifth of the sample; all other rows are scored on the executors
and only counts of (language, score bin, label) come back. Languages with too
few labelled rows use the threshold over all. Only the text enters a score;
the language picks a threshold and nothing else.

Defined cases: null and empty texts are scored as a text without words; a null
id counts as the empty text in the hold-out rule; labels that are null are no
labels; if a class is missing among the labels, all scores are the share of
toxic labels (0 without labels); rows equal in id, language and score calibrate
once, rows that share the id of a sampled one don't; other columns pass through
``reject`` whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonepulse.llm.common import member_filter, probe, ship, stored
from zonepulse.llm.hashing import LETTERS, LOWER, is_long, text_slices, word_hashes, word_pieces

#: Labelled rows that are fetched for training, by hash of the id: the bound.
SAMPLE_ROWS = 8_000
#: Bytes of text that are fetched for training, and of one text among them:
#: what lies beyond stays out of the weights and calibrates all the same.
SAMPLE_BYTES = 64 << 20
SAMPLE_TEXT_BYTES = 1 << 18
#: Parts of the sample; each calibrates with a model of the others.
CALIBRATE = 5
#: Calibrating scores are counted in bins, so many to a unit before the
#: logistic and so many on each side of 0.
PER_UNIT = 64
BINS = 32 * PER_UNIT
#: Labelled toxic rows of a language that its own threshold needs.
LEAST_TOXIC = 20
BUCKETS = 1 << 18
#: Words and stems of fewer training texts stay without an embedding.
LEAST_TEXTS = 3
#: Part of the words that each mini-batch leaves out.
DROPPED = 0.3
DIM = 16
WIDTHS = (1, 2, 3)
FILTERS = 12
PREFIX_BYTES = 4
#: Mini-batches, whatever the number of labelled rows.
STEPS = 1_500
BATCH = 32
#: A mini-batch of long texts ends early, after so many words.
BATCH_WORDS = 30_000
RATE = 0.05
THRESHOLD = 0.3


@dataclass
class Model:
    words: np.ndarray  # BUCKETS x DIM
    stems: np.ndarray  # BUCKETS x DIM
    filters: list[np.ndarray]  # per width: width x DIM x FILTERS
    bias: np.ndarray  # of all filters
    out: np.ndarray
    out_bias: float
    scale: float = 1.0
    offset: float = 0.0
    constant: float | None = None  # the score of all texts, if nothing was learned
    #: Once trained: the row of each bucket in tables that keep only what was
    #: seen often enough (row 0 is zero).
    word_row: np.ndarray | None = None
    stem_row: np.ndarray | None = None
    threshold: float = THRESHOLD
    thresholds: dict[str, float] = field(default_factory=dict)


def _new_model(seed: int = 7) -> Model:
    rng = np.random.default_rng(seed)
    f32 = np.float32
    return Model(
        rng.normal(0, 0.1, (BUCKETS, DIM)).astype(f32),
        rng.normal(0, 0.1, (BUCKETS, DIM)).astype(f32),
        [rng.normal(0, (2 / (w * DIM)) ** 0.5, (w, DIM, FILTERS)).astype(f32) for w in WIDTHS],
        np.zeros(len(WIDTHS) * FILTERS, f32),
        rng.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(f32),
        0.0,
    )


def buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word bucket, stem bucket) of every word, and the words before each row."""
    words, begins, stems = word_hashes(data, offsets, LETTERS, LOWER, PREFIX_BYTES)
    return _bucket(words), _bucket(stems), begins


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(BUCKETS)).astype(np.int32)


def _convolved(model: Model, x: np.ndarray) -> np.ndarray:
    """Filter outputs at every word; ``x`` ends with zero rows."""
    n = len(x) - max(WIDTHS) + 1
    made = []
    for w, filters in zip(WIDTHS, model.filters, strict=True):
        z = x[:n] @ filters[0]
        for k in range(1, w):
            z += x[k : n + k] @ filters[k]
        made.append(z)
    return np.concatenate(made, axis=1) + model.bias


def _spaced(model: Model, words: np.ndarray, stems: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Embeddings with zero rows after each text, so no filter sees two texts;
    and where each text begins in them."""
    pad = max(WIDTHS) - 1
    lengths = np.diff(begins)
    at = begins[:-1] + pad * np.arange(len(lengths))
    x = np.zeros((len(words) + pad * len(lengths) + pad, DIM), np.float32)
    rows = np.arange(len(words)) + pad * np.repeat(np.arange(len(lengths)), lengths)
    if model.word_row is not None:
        words, stems = model.word_row[words], model.stem_row[stems]
    x[rows] = model.words[words] + model.stems[stems]
    return x, at


def _logits(model: Model, words: np.ndarray, stems: np.ndarray, begins: np.ndarray) -> np.ndarray:
    lengths = np.diff(begins)
    features = np.zeros((len(lengths), len(model.out)), np.float32)
    some = np.flatnonzero(lengths)
    if len(some):
        x, at = _spaced(model, words, stems, begins)
        z = _convolved(model, x)
        edges = np.stack((at[some], at[some] + lengths[some]), axis=1).ravel()
        # A last edge beyond the array is the array's end.
        edges = edges[: -1 if edges[-1] >= len(z) else None]
        features[some] = np.maximum(np.maximum.reduceat(z, edges, axis=0)[::2], 0)
    return features @ model.out + model.out_bias


def _long_logit(model: Model, data: np.ndarray) -> np.ndarray:
    """``_logits`` of one long text: maxima over its pieces. The last words of
    a piece, whose followers are in the next one, are carried into it."""
    pad = max(WIDTHS) - 1
    best = np.zeros(len(model.out), np.float32)
    words = stems = np.zeros(0, np.int32)

    def fold(best: np.ndarray, followed: int) -> np.ndarray:
        """Maxima with those of the words that are followed by enough others."""
        if followed <= 0:
            return best
        x, _ = _spaced(model, words, stems, np.array([0, len(words)]))
        return np.maximum(best, _convolved(model, x[: followed + pad]).max(axis=0))

    for w, s in word_pieces(data, LETTERS, LOWER, PREFIX_BYTES):
        words, stems = np.concatenate((words, _bucket(w))), np.concatenate((stems, _bucket(s)))
        followed = max(len(words) - pad, 0)
        best = fold(best, followed)
        words, stems = words[followed:], stems[followed:]
    # The text ends here: zero rows follow its last words.
    best = fold(best, len(words))
    return best[None] @ model.out + model.out_bias


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def logits(model: Model, texts: pa.Array) -> np.ndarray:
    """What enters the logistic before scale and offset."""
    made = [
        _long_logit(model, data) if is_long(offsets) else _logits(model, *buckets(data, offsets))
        for _, data, offsets in text_slices(texts)
    ]
    return np.concatenate(made).astype(np.float64) if made else np.zeros(0)


def scores(model: Model, texts: pa.Array) -> np.ndarray:
    """A number from 0 to 1 for every text of an Arrow array."""
    if model.constant is not None:
        return np.full(len(texts), model.constant)
    return _sigmoid(model.scale * logits(model, texts) + model.offset)


def _batches(order: np.ndarray, lengths: list[int]) -> list[np.ndarray]:
    cuts, first, words = [], 0, 0
    for k, n in enumerate(lengths):
        if k > first and (k - first == BATCH or words + n > BATCH_WORDS):
            cuts.append(k)
            first, words = k, 0
        words += n
    return np.split(order, cuts)


def _train(model: Model, texts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, steps: int, seed: int) -> None:
    """Adagrad over mini-batches; through a maximum the gradient reaches only
    the words under it."""
    rng = np.random.default_rng(seed)
    tables = [model.words, model.stems, *model.filters, model.bias, model.out]
    squares = [np.full(t.shape if t.ndim != 2 else t.shape[:1], 1e-4, np.float32) for t in tables]
    bias_square = 1e-4
    some = [i for i, (w, _) in enumerate(texts) if len(w)]
    owner = np.repeat(np.arange(len(WIDTHS)), FILTERS)
    known = []
    for side, table in enumerate(tables[:2]):
        found, texts_with = np.unique(np.concatenate([np.unique(t[side]) for t in texts]), return_counts=True)
        known.append(np.zeros(len(table), bool))
        known[side][found[texts_with >= LEAST_TEXTS]] = True
        table[~known[side]] = 0
    done = 0
    while some and done < steps:
        order = rng.permutation(some)
        for batch in _batches(order, [len(texts[i][0]) for i in order])[: steps - done]:
            done += 1
            kept = [rng.random(len(texts[i][0])) >= DROPPED for i in batch]
            batch, kept = batch[[k.any() for k in kept]], [k for k in kept if k.any()]
            if not len(batch):
                continue
            w = np.concatenate([texts[i][0][k] for i, k in zip(batch, kept, strict=True)])
            s = np.concatenate([texts[i][1][k] for i, k in zip(batch, kept, strict=True)])
            lengths = np.array([k.sum() for k in kept])
            x, at = _spaced(model, w, s, np.concatenate(([0], np.cumsum(lengths))))
            z = _convolved(model, x)
            where = np.stack([a + z[a : a + n].argmax(axis=0) for a, n in zip(at, lengths, strict=True)])
            top = z[where, np.arange(z.shape[1])]
            features = np.maximum(top, 0)
            error = (_sigmoid(features @ model.out + model.out_bias) - labels[batch]).astype(np.float32) / len(batch)
            back = error[:, None] * model.out * (top > 0)
            grads_filters = [np.zeros_like(f) for f in model.filters]
            rows, pulls = [], []
            word_at = np.full(len(x), -1)
            pad = max(WIDTHS) - 1
            word_at[np.arange(len(w)) + pad * np.repeat(np.arange(len(lengths)), lengths)] = np.arange(len(w))
            for g, width in enumerate(WIDTHS):
                mine = owner == g
                spots, pull = where[:, mine], back[:, mine]
                for k in range(width):
                    grads_filters[g][k] = np.einsum("bf,bfd->df", pull, x[spots + k])
                    rows.append(word_at[spots + k].ravel())
                    pulls.append((pull[:, :, None] * model.filters[g][k].T[None]).reshape(-1, DIM))
            rows, pulls = np.concatenate(rows), np.concatenate(pulls)
            real = (rows >= 0) & (np.abs(pulls).max(axis=1) > 0)
            rows, pulls = rows[real], pulls[real]
            for table, square, seen, ids in (
                (model.words, squares[0], known[0], w),
                (model.stems, squares[1], known[1], s),
            ):
                mine = seen[ids[rows]]
                touched, inverse = np.unique(ids[rows[mine]], return_inverse=True)
                grad = np.zeros((len(touched), DIM), np.float32)
                np.add.at(grad, inverse, pulls[mine])
                square[touched] += (grad**2).mean(axis=1)
                table[touched] -= RATE * grad / np.sqrt(square[touched])[:, None]
            for table, square, grad in zip(
                tables[2:], squares[2:], [*grads_filters, back.sum(axis=0), features.T @ error], strict=True
            ):
                square += grad**2
                table -= RATE * grad / np.sqrt(square)
            bias_grad = float(error.sum())
            bias_square += bias_grad**2
            model.out_bias -= RATE * bias_grad / bias_square**0.5
    model.words, model.word_row = _kept(model.words, known[0])
    model.stems, model.stem_row = _kept(model.stems, known[1])


def _kept(table: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rows = np.where(known, np.cumsum(known), 0).astype(np.int32)
    return np.concatenate((np.zeros((1, table.shape[1]), table.dtype), table[known])), rows


def _calibrate(model: Model, at: np.ndarray, rows: np.ndarray, toxic: np.ndarray) -> None:
    """Scale and offset by Newton steps on the log loss of ``rows`` rows at
    each place ``at``, with a weak pull to scale 1 so that a separable sample
    stays finite."""
    a, b = 1.0, 0.0
    for _ in range(30):
        p = _sigmoid(a * at + b)
        e, v = rows * p - toxic, rows * np.maximum(p * (1 - p), 1e-9)
        grad = np.array([(e * at).sum() + 0.1 * (a - 1), e.sum() + 0.1 * b])
        hess = np.array([[(v * at**2).sum() + 0.1, (v * at).sum()], [(v * at).sum(), v.sum() + 0.1]])
        step = np.linalg.solve(hess, grad)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -2, 2)
    if a > 0:
        model.scale, model.offset = float(a), float(b)


def best_threshold(score: np.ndarray, labels: np.ndarray, rows: np.ndarray | None = None, lowest: float = 0.0) -> float:
    """The middle of the gap below the score whose cut has the best F1; with
    ``rows``, each score stands for so many rows, ``labels`` of them toxic."""
    order = np.argsort(-score, kind="stable")
    hits = np.cumsum(labels[order])
    taken = np.arange(1, len(order) + 1) if rows is None else np.cumsum(rows[order])
    f1 = 2 * hits / (taken + labels.sum())
    k = int(np.argmax(f1))
    below = score[order[k + 1]] if k + 1 < len(order) else lowest
    return float((score[order[k]] + below) / 2)


def bins_of(found: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(found * PER_UNIT), -BINS, BINS - 1).astype(np.int32)


def _thresholds(model: Model, counts: dict[str, np.ndarray]) -> None:
    """Scale, offset and thresholds from, per language, the rows and the toxic
    rows of each bin."""
    rows, toxic = sum(counts.values())
    some = np.flatnonzero(rows)
    _calibrate(model, (some - BINS + 0.5) / PER_UNIT, rows[some], toxic[some])

    def chosen(rows: np.ndarray, toxic: np.ndarray) -> float:
        some = np.flatnonzero(rows)
        # The middles of two bins next to each other are half a bin off their edge.
        cut = best_threshold((some - BINS + 0.5) / PER_UNIT, toxic[some], rows[some], (some[0] - BINS - 0.5) / PER_UNIT)
        return float(_sigmoid(model.scale * cut + model.offset))

    if toxic.any():
        model.threshold = chosen(rows, toxic)
    for lang, (rows, toxic) in sorted(counts.items()):
        if toxic.sum() >= LEAST_TOXIC:
            model.thresholds[lang] = chosen(rows, toxic)


def _count(counts: dict[str, np.ndarray], langs: list, bins: np.ndarray, labels: np.ndarray, n: np.ndarray) -> None:
    for lang, k, y, m in zip(langs, bins.tolist(), labels.tolist(), n.tolist(), strict=True):
        mine = counts.setdefault(lang or "", np.zeros((2, 2 * BINS)))
        mine[0, k + BINS] += m
        mine[1, k + BINS] += m * y


def learned(texts: pa.Array, labels: np.ndarray, part: int, steps: int = STEPS, seed: int = 7) -> tuple[Model, np.ndarray]:
    """A model of all parts of the sample but one, and the logits of that one."""
    model = _new_model(seed)
    aside = np.arange(len(labels)) % CALIBRATE == part
    learn = np.flatnonzero(~aside)
    cut = []
    for _, data, offsets in text_slices(texts.take(pa.array(learn))):
        w, s, begins = buckets(data, offsets)
        cut += [(w[a:b], s[a:b]) for a, b in zip(begins[:-1], begins[1:], strict=True)]
    _train(model, cut, labels[learn].astype(np.float32), steps, seed)
    return model, logits(model, texts.take(pa.array(np.flatnonzero(aside))))


def _constant(labels: np.ndarray) -> Model | None:
    if len(labels) < 2 * CALIBRATE or labels.min() == labels.max():
        return Model(*[np.zeros(0)] * 2, [], *[np.zeros(0)] * 2, 0.0, constant=float(labels.mean()) if len(labels) else 0.0)
    return None


def _parts(
    made: list[tuple[Model | None, np.ndarray]], labels: np.ndarray, langs: list
) -> tuple[Model, dict[str, np.ndarray]]:
    """The model without part 0, and the counts of the whole sample."""
    found = np.zeros(len(labels))
    for part, (_, mine) in enumerate(made):
        found[part::CALIBRATE] = mine
    counts: dict[str, np.ndarray] = {}
    _count(counts, langs, bins_of(found), labels, np.ones(len(labels)))
    return made[0][0], counts


def fit(texts: pa.Array, labels: np.ndarray, langs: list, steps: int = STEPS, seed: int = 7) -> Model:
    """A model from labelled texts, in memory."""
    if (same := _constant(labels)) is not None:
        return same
    model, counts = _parts([learned(texts, labels, k, steps, seed) for k in range(CALIBRATE)], labels, langs)
    _thresholds(model, counts)
    return model


def _fit_parts(spark: SparkSession, texts: pa.Array, labels: np.ndarray, steps: int) -> list[tuple[Model | None, np.ndarray]]:
    """``learned`` for every part of the sample, a task each."""
    ship(spark)
    shared = spark.sparkContext.broadcast((texts, labels))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.column(0).to_pylist():
                model, found = learned(*shared.value, part, steps)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part]), pa.array([None if part else pickle.dumps(model)], pa.binary()), pa.array([found.tolist()], pa.list_(pa.float64()))],
                    ["part", "model", "logits"],
                )

    rows = spark.range(0, CALIBRATE, 1, CALIBRATE).mapInArrow(of_batches, "part long, model binary, logits array<double>").collect()
    shared.unpersist()
    return [(pickle.loads(r.model) if r.model else None, np.array(r.logits)) for r in sorted(rows, key=lambda r: r.part)]


def held_out(id_col: str = "doc_id") -> Column:
    text = F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(4)) == 2


def train(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text", steps: int = STEPS
) -> Model:
    """Weights from at most ``sample`` labelled rows and ``SAMPLE_BYTES`` of text
    outside the hold-out, the rows with the smallest hash of the id: a bounded
    sample that reruns agree on.
    Scale, offset and thresholds from all labelled rows outside the hold-out."""
    truth = labels.where(F.col("toxic").isNotNull()).select(
        F.col("doc_id").cast("long").alias("l_id"), (F.col("toxic") > 0).cast("int").alias("y")
    )
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    own = F.col(id_col).cast("long").alias("d_id")
    order = [F.xxhash64("d_id"), "d_id", "y"]
    # First which rows, from ids alone, then their texts: no text shuffles.
    chosen = (
        docs.where(~held_out(id_col)).select(own).join(truth, F.col("d_id") == F.col("l_id")).select("d_id", "y")
    )
    # Repeats are folded before the bound, so no repeated row fills the sample.
    chosen = stored(chosen.distinct().orderBy(*order).limit(sample), "toxicity-sample")
    texts = stored(
        docs.select(own, F.struct(F.col(text_col).cast("string").alias("text"), lang.alias("lang")).alias("row"))
        .join(F.broadcast(chosen), "d_id")
        .groupBy("d_id", "y")
        .agg(F.max("row").alias("row")),
        "toxicity-texts",
    )
    # At most ``sample`` rows of numbers in this window.
    size = F.coalesce(F.octet_length("row.text"), F.lit(0)).cast("long")
    sizes = texts.select("d_id", "y", size.alias("size")).where(F.col("size") <= SAMPLE_TEXT_BYTES)
    sizes = sizes.withColumn("so_far", F.sum("size").over(Window.orderBy(*order)))
    chosen = stored(sizes.where(F.col("so_far") <= SAMPLE_BYTES).select("d_id", "y"), "toxicity-chosen")
    rows = texts.join(F.broadcast(chosen), ["d_id", "y"]).orderBy(*order).select("row.text", "row.lang", "y").toArrow()
    texts = pa.concat_arrays(rows["text"].chunks) if rows.num_rows else pa.array([], pa.string())
    y = rows["y"].to_numpy().astype(np.int64) if rows.num_rows else np.zeros(0, np.int64)
    if (same := _constant(y)) is not None:
        return same
    model, counts = _parts(_fit_parts(docs.sparkSession, texts, y, steps), y, rows["lang"].to_pylist())
    texts = docs.where(~held_out(id_col)).select(own, lang.alias("lang"), F.col(text_col).cast("string").alias("text"))
    rest = _rest_counts(texts, truth, chosen.select("d_id").distinct(), model)
    _count(counts, rest["lang"].to_pylist(), rest["bin"].to_numpy(), rest["y"].to_numpy(), rest["n"].to_numpy())
    _thresholds(model, counts)
    return model


def _rest_counts(docs: DataFrame, truth: DataFrame, chosen: DataFrame, model: Model) -> pa.Table:
    """lang, bin, y, n of the labelled rows that aren't in the sample. Texts are
    scored where they are; ids and bins alone meet the labels."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("int")
    def bin_of(texts: pa.Array) -> pa.Array:
        return pa.array(bins_of(logits(shared.value, texts)), pa.int32())

    truth = truth.withColumnRenamed("l_id", "d_id").join(F.broadcast(chosen), "d_id", "left_anti").where("d_id IS NOT NULL")
    h = F.xxhash64("d_id").alias("h")
    members = stored(member_filter(truth.where(~held_out("d_id")).select(h), "h"), "toxicity-labelled")
    found = probe(docs.where("d_id IS NOT NULL").withColumn("h", h), "h", members, "maybe").where("maybe")
    return (
        found.select("d_id", "lang", bin_of("text").alias("bin"))
        .distinct()
        .join(truth.distinct(), "d_id")
        .groupBy("lang", "bin", "y")
        .agg(F.count(F.lit(1)).alias("n"))
        .toArrow()
    )


def scored(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(scores(shared.value, texts))

    return docs.withColumn(out, score(F.col(text_col).cast("string")))


def threshold_of(lang: Column, model: Model) -> Column:
    """The language's own threshold, else the one over all."""
    found = F.lit(float(model.threshold))
    for name, value in sorted(model.thresholds.items()):
        found = F.when(lang == name, F.lit(float(value))).otherwise(found)
    return found


def predictions(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted (at ``threshold``), lang_threshold,
    flagged (at the language's own)."""
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), lang.alias("lang"), F.col(text_col).cast("string").alias("text"))
    return scored(rows, model).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        threshold_of(F.col("lang"), model).alias("lang_threshold"),
        (F.col("score") >= threshold_of(F.col("lang"), model)).cast("int").alias("flagged"),
    )


def reject(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without the texts at or above their language's threshold."""
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), lang.alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return scored(rows, model).where(F.col("score") < threshold_of(F.col("lang"), model)).select("row.*")
