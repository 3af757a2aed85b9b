"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear SVM.

Two strings are alike by their common subsequences of four bytes; each occurrence counts
the decay to the power of its span, so gapped and padded spellings still match. A unit is
a word in lower case without its punctuation, between two blanks; letters set apart by
blanks are joined. The kernel of a sentence and a landmark is that of its best unit. The
Nyström map of some dozens of landmarks - words and beginnings of words that set the
labelled documents apart - gives each sentence a short vector, and a linear support vector machine is trained on sentences: all
sentences of clean documents count as clean, while of a toxic document only the most
toxic one so far counts (its other sentences may be harmless), in a few rounds. A
document scores as its worst sentence. Work and memory per text are linear in its length.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.llm import words as W
from sparkwright.session import materialize, ship_package

DECAY, SPAN = 0.65, 7
UNIT = 24
INNER = UNIT - 2
SLOTS = 1 << 18
# Offsets of the other three bytes of a subsequence from its first.
STEPS = [(j, k, m) for m in range(3, SPAN) for k in range(2, m) for j in range(1, k)]
MARK = W._flags((0x21, 0x21), (0x2E, 0x2E), (0x3F, 0x3F))


def _slot(c: np.ndarray, at: list[int]) -> np.ndarray:
    """Table slot of the bytes of ``c`` (one row per unit) in four columns."""
    out = c[:, at[0]].astype(np.int64)
    for i in at[1:]:
        out = (out * 8363 + c[:, i]) & (SLOTS - 1)
    return out


def units_of(texts: pa.Array):
    """Padded bytes and lengths of the distinct units, the unit of each occurrence, and
    the (row, sentence) each occurrence stands in. Units longer than a window are taken
    in overlapping windows."""
    data, offsets = W.text_bytes(texts)
    data = W.LOWER[data]
    follows = np.r_[W.SPACE[data[1:]], [True]] if len(data) else np.zeros(0, dtype=bool)
    mark = (MARK[data] & follows) | (data == 0x0A)
    keep = ~W.NOT_ALNUM[data] | W.SPACE[data]
    sentence = np.cumsum(mark, dtype=np.int32)[keep]
    kept = np.zeros(len(keep) + 1, dtype=np.int32)
    np.cumsum(keep, out=kept[1:])
    data, offsets = data[keep], kept[offsets].astype(np.int64)
    del kept, mark, keep
    starts, ends, first = W.word_bounds(data, offsets)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    where = sentence[starts] if len(starts) else np.zeros(0, dtype=np.int64)

    # Runs of three or more single letters are one unit more; a run ends with its text.
    size = ends - starts
    single = (size == 1) | ((size == 2) & (data[starts] >= 0xC2)) if len(starts) else size > 0
    cut = np.r_[True, row[1:] != row[:-1], True] if len(row) else np.ones(1, dtype=bool)
    begin = np.flatnonzero(single & (cut[:-1] | ~np.r_[False, single][:-1]))
    end = np.flatnonzero(single & (cut[1:] | ~np.r_[single, False][1:])) + 1
    joined = [
        (row[a], where[a], np.concatenate([data[starts[i] : ends[i]] for i in range(a, b)]))
        for a, b in zip(begin, end)
        if b - a >= 3
    ]

    long = np.flatnonzero(size > INNER)
    if len(long):
        pieces = np.maximum(1, -(-(size[long] - INNER) // (INNER // 2)) + 1)
        step = np.concatenate([np.arange(p) for p in pieces]) * (INNER // 2)
        again = np.repeat(long, pieces)
        more = starts[again] + step
        keep_short = np.flatnonzero(size <= INNER)
        starts = np.r_[starts[keep_short], more]
        ends = np.r_[ends[keep_short], np.minimum(more + INNER, ends[again])]
        row, where = np.r_[row[keep_short], row[again]], np.r_[where[keep_short], where[again]]
        order = np.argsort(starts, kind="stable")
        starts, ends, row, where = starts[order], ends[order], row[order], where[order]

    hashes = W.hash_words(data, starts, ends)
    _, one, unit = np.unique(hashes, return_index=True, return_inverse=True)
    length = (ends - starts)[one]
    at = starts[one][:, None] + np.arange(INNER)[None, :]
    inside = np.arange(INNER)[None, :] < length[:, None]
    letters = np.full((len(one), UNIT), 0x20, dtype=np.uint8)
    if len(one):
        letters[:, 1:-1] = np.where(inside, data[np.minimum(at, len(data) - 1)], 0x20)
    if joined:
        extra = []
        for r, s, chars in joined:
            for a in range(0, max(1, len(chars) - INNER // 2), INNER // 2):
                extra.append((r, s, chars[a : a + INNER]))
        more = np.full((len(extra), UNIT), 0x20, dtype=np.uint8)
        for i, (_, _, chars) in enumerate(extra):
            more[i, 1 : len(chars) + 1] = chars
        unit = np.r_[unit, len(length) + np.arange(len(extra))]
        row = np.r_[row, [e[0] for e in extra]]
        where = np.r_[where, [e[1] for e in extra]]
        length = np.r_[length, [len(e[2]) for e in extra]]
        letters = np.concatenate([letters, more])
    return letters, length + 2, unit, row, where


def _padded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    out = np.full((len(words), UNIT), 0x20, dtype=np.uint8)
    for i, w in enumerate(words):
        out[i, : len(w)] = np.frombuffer(w, dtype=np.uint8)
    return out, np.array([len(w) for w in words], dtype=np.int64)


def _features(word: bytes) -> dict[int, float]:
    """Slot and weight of every subsequence of a landmark, with length one in all."""
    c, out = _padded([word])[0], {}
    for i in range(len(word)):
        for j, k, m in STEPS:
            if i + m < len(word):
                slot = int(_slot(c, [i, i + j, i + k, i + m])[0])
                out[slot] = out.get(slot, 0.0) + DECAY ** (m + 1)
    size = sum(v * v for v in out.values())
    return {slot: v / size for slot, v in out.items()}


class Landmarks:
    """The kernel between units and landmarks as table look-ups. A unit is taken as it is;
    a landmark is scaled so that its kernel with itself is 1. (The scale of a landmark is
    one of a feature; the kernel itself is symmetric.)"""

    def __init__(self, words: list[str]):
        self.words = [w.encode()[:UNIT] for w in words]
        feats = [_features(w) for w in self.words]
        slots = sorted({s for f in feats for s in f})
        self.line = np.zeros(SLOTS, dtype=np.int32)
        self.line[slots] = np.arange(1, len(slots) + 1)
        self.table = np.zeros((len(slots) + 1, len(words)), dtype=np.float32)
        for j, f in enumerate(feats):
            for s, v in f.items():
                self.table[self.line[s], j] = v

    def kernel(self, letters: np.ndarray, length: np.ndarray) -> np.ndarray:
        out = np.zeros((len(length), len(self.words)), dtype=np.float32)
        order = np.argsort(length, kind="stable")
        sizes, begin = np.unique(length[order], return_index=True)
        for n, a, b in zip(sizes, begin, np.r_[begin[1:], len(order)]):
            n, rows = int(min(n, UNIT)), order[a:b]
            chars = letters[rows]
            part = np.zeros((len(rows), len(self.words)), dtype=np.float32)
            for i in range(n - 3):
                for j, k, m in STEPS:
                    if i + m < n:
                        line = self.line[_slot(chars, [i, i + j, i + k, i + m])]
                        hit = np.flatnonzero(line)
                        if len(hit):
                            part[hit] += np.float32(DECAY ** (m + 1)) * self.table[line[hit]]
            out[rows] = np.minimum(part, 1.5)
        return out


def sentence_kernels(texts: pa.Array, landmarks: Landmarks):
    """Row of each sentence and its kernel with each landmark, best unit of each."""
    letters, length, unit, row, where = units_of(texts)
    if not len(unit):
        return np.zeros(0, dtype=np.int64), np.zeros((0, len(landmarks.words)), np.float32)
    kernel = landmarks.kernel(letters, length)
    order = np.lexsort((where, row))
    unit, row, where = unit[order], row[order], where[order]
    begin = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (where[1:] != where[:-1])])
    out = np.empty((len(begin), kernel.shape[1]), dtype=np.float32)
    # Sentences in pieces of some ten thousand occurrences.
    i = 0
    while i < len(begin):
        j = max(i + 1, int(np.searchsorted(begin, begin[i] + (1 << 15))))
        hi = begin[j] if j < len(begin) else len(unit)
        out[i:j] = np.maximum.reduceat(kernel[unit[begin[i] : hi]], begin[i:j] - begin[i], axis=0)
        i = j
    return row[begin], out


@dataclass
class Model:
    """Landmarks, their Nyström map, and the support vector machine with its link."""

    words: list[str]
    root: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float
    shift: float

    def direction(self) -> np.ndarray:
        return (self.root @ self.weight).astype(np.float32)


def _pieces(texts: pa.Array, limit: int = 2 << 20):
    """Row ranges of about ``limit`` bytes; a longer text is alone."""
    _, offsets = W.text_bytes(texts)
    return W.spans_of_rows(offsets, limit)


def score_batches(batches, model: Model):
    landmarks, direction = Landmarks(model.words), model.direction()
    for batch in batches:
        worst = np.full(batch.num_rows, -np.inf)
        text = batch.column(1)
        for lo, hi in _pieces(text):
            row, kernels = sentence_kernels(text.slice(lo, hi - lo), landmarks)
            np.maximum.at(worst, row + lo, kernels @ direction + model.bias)
        # A text without units is like a sentence that no landmark knows.
        worst = np.where(np.isfinite(worst), worst, model.bias)
        score = 1 / (1 + np.exp(-(model.slope * worst + model.shift)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(score)], ["doc", "score"]
        )


def unit_batches(batches):
    """Distinct units of each labelled text, and their beginnings of four to seven bytes."""
    for batch in batches:
        labels, text = np.asarray(batch.column(0)), batch.column(1)
        for lo, hi in _pieces(text):
            letters, length, unit, row, _ = units_of(text.slice(lo, hi - lo))
            names = []
            for x, n in zip(letters, length.tolist()):
                word = bytes(x[: min(n, UNIT)])
                forms = {word} | {word[:k] for k in range(5, 9) if k < n - 1}
                names.append([w.decode("utf-8", "ignore") for w in forms if len(w) > 4])
            held = [set() for _ in range(hi - lo)]
            for r, u in zip(row.tolist(), unit.tolist()):
                held[r].update(names[u])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x for h in held for x in h], pa.string()),
                    pa.array(np.repeat(labels[lo:hi], [len(h) for h in held]).astype(np.int32)),
                ],
                ["unit", "label"],
            )


def witness_batches(batches, words: list[str], direction: np.ndarray):
    """The most toxic sentence of each labelled text by ``direction``; of clean texts the
    next two in that order as well."""
    landmarks = Landmarks(words)
    for batch in batches:
        labels, text = np.asarray(batch.column(0)), batch.column(1)
        for lo, hi in _pieces(text):
            row, kernels = sentence_kernels(text.slice(lo, hi - lo), landmarks)
            if not len(row):
                continue
            order = np.lexsort((-(kernels @ direction), row))
            row = row[order]
            begin = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            place = np.arange(len(row)) - np.repeat(begin, np.diff(np.r_[begin, len(row)]))
            label = labels[lo:hi][row]
            keep = place < np.where(label == 1, 1, 3)
            step = np.arange(keep.sum() + 1) * len(words)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(label[keep].astype(np.int32)),
                    W.lists(kernels[order][keep].ravel(), step, pa.float32()),
                ],
                ["label", "kernel"],
            )


def _svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 60):
    """Linear support vector machine with squared hinge loss, by Newton steps. Both
    classes weigh the same."""
    x = np.c_[x, np.ones(len(x))]
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)) * len(y)
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        slack = 1 - y * (x @ w)
        on = slack > 0
        gradient = ridge @ w - 2 * cost * (x[on] * (share * y * slack)[on, None]).sum(0)
        hessian = ridge + 2 * cost * (x[on] * share[on, None]).T @ x[on]
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w[:-1], float(w[-1])


def _link(margin: np.ndarray, y: np.ndarray):
    """Slope and shift of the logistic curve over the margins (Platt's targets)."""
    good, bad = (y > 0).sum(), (y < 0).sum()
    goal = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    weight = np.where(y > 0, 0.5 / max(good, 1), 0.5 / max(bad, 1)) * len(y)
    x = np.c_[margin, np.ones(len(margin))]
    w = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - goal)) + 1e-3 * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(w[0], 1e-3)), float(w[1])


def _spread(words: list[str], many: int, taken: list[str], near: float = 0.5) -> list[str]:
    """The first words of the list of which no two, nor a taken one, are much alike."""
    out: list[str] = []
    for w in words:
        if len(out) == many:
            break
        if taken + out:
            known = Landmarks(taken + out)
            there = known.kernel(*_padded([w.encode()[:UNIT]]))
            back = Landmarks([w]).kernel(*_padded(known.words))
            if max(there.max(), back.max()) > near:
                continue
        out.append(w)
    return out


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "label", sample: int = 1500, toxic_landmarks: int = 40,
    clean_landmarks: int = 8, rounds: int = 3,
) -> Model | None:
    """Train on at most ``sample`` documents of each label (0 and 1; the bound is the one
    limit of the training set), chosen by a hash of the id. Null texts, ids and labels are
    left out, and labels without a document; of several labels of one id the larger
    counts. None if either label is missing."""
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text")
    )
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.max(F.col(label_col).cast("int")).alias("label"))
        .join(texts.select("id").distinct(), "id", "left_semi")
    )
    chosen = None
    for label in (0, 1):
        some = known.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(sample)
        chosen = some if chosen is None else chosen.unionByName(some)
    # At most two samples of ids go to the texts; no text is shuffled.
    texts = materialize(texts.join(F.broadcast(chosen), "id").select("label", "text"), "labelled")
    n = {r.label: r["count"] for r in texts.groupBy("label").count().collect()}
    if not n.get(0) or not n.get(1):
        return None

    seen = texts.mapInArrow(unit_batches, "unit string, label int").groupBy("unit").agg(
        F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c")
    )
    rate_t = (F.col("t") + 0.5) / (n[1] + 1)
    rate_c = (F.col("c") + 0.5) / (n[0] + 1)
    gain = F.log(rate_t / rate_c) * F.col("t") / n[1]
    loss = F.log(rate_c / rate_t) * F.col("c") / n[0]

    def best(rows, value, many):
        """A fixed number of the best units; of equal ones the longer."""
        order = [value.desc(), F.length("unit").desc(), F.col("unit")]
        return [r.unit for r in rows.orderBy(*order).limit(many).collect()]

    toxic, clean = best(seen.where("t > 2"), gain, 1000), best(seen.where("c > 2"), loss, 300)
    toxic = _spread(toxic, toxic_landmarks, [])
    words = toxic + _spread(clean, clean_landmarks, toxic)
    if not words:
        return None
    marks = Landmarks(words)
    gram = marks.kernel(*_padded(marks.words)).astype(np.float64)
    value, vector = np.linalg.eigh((gram + gram.T) / 2)
    root = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-3))) @ vector.T

    direction = np.r_[np.ones(len(toxic)), -np.ones(len(words) - len(toxic))].astype(np.float32)
    for _ in range(rounds):
        found = texts.mapInArrow(
            functools.partial(witness_batches, words=words, direction=direction),
            "label int, kernel array<float>",
        ).collect()  # at most four sentences for each document of the sample
        x = np.array([r.kernel for r in found], dtype=np.float64) @ root
        y = np.array([1.0 if r.label else -1.0 for r in found])
        weight, bias = _svm(x, y)
        direction = (root @ weight).astype(np.float32)
    slope, shift = _link(x @ weight + bias, y)
    return Model(words, root, weight, bias, slope, shift)


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for every row, 0 to 1. Null and empty texts score as a sentence that no
    landmark knows; without a model every score is 0. Repeated rows score alike. Other
    columns are not looked at."""
    if model is None:
        return docs.select(id_col, F.lit(0.0).alias("score"))
    ship_package(docs.sparkSession)
    return (
        docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
        .mapInArrow(functools.partial(score_batches, model=model), "doc long, score double")
        .withColumnRenamed("doc", id_col)
    )


def in_training(id_col: str = "doc_id"):
    """Whether a row's label may be learnt: two thirds of the ids."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 != 1


def fit_on(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> Model | None:
    known = labels.where(in_training(id_col)).select(id_col, F.col("toxic").alias("label"))
    return fit(docs, known, id_col)


def without_toxic(docs: DataFrame, model: Model | None, threshold: float = 0.7) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; columns unchanged."""
    if model is None:
        return docs
    ship_package(docs.sparkSession)
    schema = docs.schema
    text = docs.columns.index("text")

    return docs.mapInArrow(functools.partial(clean_batches, model=model, text=text, threshold=threshold), schema)


def clean_batches(batches, model: Model, text: int, threshold: float):
    for batch in batches:
        pair = pa.RecordBatch.from_arrays(
            [pa.array(np.arange(batch.num_rows)), batch.column(text)], ["doc", "text"]
        )
        (scored,) = score_batches([pair], model)
        yield batch.filter(pa.array(np.asarray(scored.column(1)) < threshold))
