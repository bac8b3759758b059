"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

Two words are as similar as the weights of the letter triples they share, in this order but
not necessarily side by side: a triple spans up to two letters or signs between neighbours,
and each of them costs a factor. Signs that are no letters can only stand in such gaps, and
single letters in a row are read as one word, so that ``i.d.i.o.t``, ``id-iot``, ``idixot``
and ``i d i o t`` stay close to the plain word. The kernel is normalised, cut off below
``FLOOR`` and raised to ``POWER``; that of two sentences is its sum over pairs of words.
Landmark words from the labelled rows give every sentence a vector of fixed length (the
Nyström map), and a linear support vector machine with squared hinge loss separates the
sentences. Labels are known for documents only: all sentences of clean ones are clean, and
of a toxic one the sentences that look toxic so far count as such, or the worst one, and of
clean ones the sentences that looked worst are learnt from, in a few rounds. A
document scores as its worst sentence, mapped to a probability on the labelled rows.

A sentence's vector is a sum over its words, so a word adds one number to the decision; the
tasks keep the numbers of the words met so far, up to a bound. The machine is fitted on a
bounded sample of labelled rows (``max_rows``), chosen by a hash of the id.

Defined results: a NULL text is empty; an empty text scores as a sentence without words. Without
rows of both labels to learn from, every score is the share of toxic ones (0 without any). Rows
with a NULL label, or without an id, are never learnt from. Repeated rows are scored each. An empty table gives an
empty result. Columns of the input named like an added one are replaced, and those that start
with an underscore are left out.
"""

from __future__ import annotations

import functools
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.langid import held_out
from lakeops.llm.registry import cleared, query, table
from lakeops.llm.secrets import segments

MAX_ROWS = 3000
LANDMARKS = 128
DECAY = 0.7
REACH = 3
FLOOR = 0.5
POWER = 2
#: landmarks are less alike than this
APART = 0.7
MOST_CACHED = 1 << 18
LONGEST_WORD = 64
BLOCK_CHARS = 1 << 20
#: characters whose triples are held at a time
STRIP_CHARS = 1 << 16
#: characters of all texts that a model is learnt from
MOST_LEARNT = 1 << 26
SIGNS = 64
N_TRIPLES = SIGNS**3
#: words whose triples are held at a time
STRIP, FEW = 4096, 128
STEPS = [(a, b) for a in range(1, REACH + 1) for b in range(1, REACH + 1)]


@functools.cache
def sign_of() -> np.ndarray:
    """Code points as letters 1 to 26, other letters 27 to 63 by their remainder, all else 0."""
    points = np.arange(sys.maxunicode + 1)
    is_letter = np.fromiter(map(str.isalpha, map(chr, points)), bool, len(points))
    signs = np.where(is_letter, 27 + points % (SIGNS - 27), 0)
    signs[ord("a") : ord("z") + 1] = np.arange(1, 27)
    return signs.astype(np.int32)


def triples(
    words: list[str], wanted: np.ndarray | None = None, first: int | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, triple, weight) of all subsequences of three letters; a triple may come repeatedly.

    ``wanted`` picks triples; with ``first`` they begin among so many first characters. Words are read as they are, also beyond ``LONGEST_WORD``.
    """
    points = np.frombuffer(("\n".join(words) + "\n" * (2 * REACH + 1)).encode("utf-32-le"), np.uint32)
    signs, n = sign_of()[points], len(points) - 2 * REACH
    n = n if first is None else min(n, first)
    word_of = np.cumsum(points == 10)
    found = []
    for a, b in STEPS:
        x, y, z = signs[:n], signs[a : a + n], signs[a + b : a + b + n]
        triple = (x * SIGNS + y) * SIGNS + z
        fits = (x > 0) & (y > 0) & (z > 0) & (word_of[:n] == word_of[a + b : a + b + n])
        if wanted is not None:
            fits &= wanted[triple]
        at = np.flatnonzero(fits)
        found.append((word_of[at], triple[at], np.full(len(at), DECAY ** (a + b - 2))))
    return tuple(map(np.concatenate, zip(*found, strict=True)))


def summed(words: np.ndarray, triple: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One entry for each word and triple."""
    keys, where = np.unique(words.astype(np.int64) * N_TRIPLES + triple, return_inverse=True)
    return *np.divmod(keys, N_TRIPLES), np.bincount(where, weight, len(keys))


class Landmarks:
    """The normalised kernel between words and the landmark words."""

    def __init__(self, words: list[str]):
        self.words = words
        of, triple, weight = summed(*triples(words))
        length = np.sqrt(np.bincount(of, weight**2, len(words)))
        known, row = np.unique(triple, return_inverse=True)
        self.row_of = np.full(N_TRIPLES, -1, np.int32)
        self.row_of[known] = np.arange(len(known))
        self.rows = np.zeros((len(known), len(words)), np.float32)
        self.rows[row, of] = weight / np.maximum(length[of], 1e-9)
        self.most = self.rows.max(axis=1, initial=0)

    def plain(self, words: list[str]) -> np.ndarray:
        """Cosine of each word and landmark."""
        if len(words) > FEW:  # the rows of more words would not stay in the processor's cache
            return np.concatenate([self.plain(words[i : i + FEW]) for i in range(0, len(words), FEW)])
        out = np.zeros((len(words), len(self.words)), np.float32)
        if not words:
            return out
        of, triple, weight = triples(words, self.row_of >= 0)
        met = np.unique(of)
        if not len(met):
            return out
        order = np.argsort(of, kind="stable")
        shared = self.rows[self.row_of[triple[order]]] * weight[order, None].astype(np.float32)
        out[met] = np.add.reduceat(shared, np.searchsorted(of[order], met))
        number, _, own = summed(*triples([words[i] for i in met]))
        length = np.sqrt(np.bincount(number, own**2, len(met)))
        out[met] /= np.maximum(length, 1e-9)[:, None]
        return out

    def strips(self, word: str) -> np.ndarray:
        """The cosines of one long word, whose triples are added up strip by strip."""
        total = np.zeros(N_TRIPLES)
        for low in range(0, len(word), STRIP_CHARS):
            # a triple belongs to the strip of its first letter
            _, triple, weight = triples([word[low : low + STRIP_CHARS + 2 * REACH]], first=STRIP_CHARS)
            total += np.bincount(triple, weight, N_TRIPLES)
        known = np.flatnonzero((self.row_of >= 0) & (total > 0))
        shared = total[known] @ self.rows[self.row_of[known]]
        return (shared / max(np.sqrt(total @ total), 1e-9)).astype(np.float32)[None]

    def may_reach(self, words: list[str]) -> np.ndarray:
        """Whether a word's cosine with some landmark can be ``FLOOR`` or more.

        No landmark has more of a triple than the most of any, and a word is at least as long
        as the root of its squared weights before equal triples are added up.
        """
        of, triple, weight = triples(words)
        row = self.row_of[triple]
        met = row >= 0
        most = np.bincount(of[met], weight[met] * self.most[row[met]], len(words))
        return most >= FLOOR * np.sqrt(np.bincount(of, weight**2, len(words))) * (1 - 1e-6)

    def __call__(self, words: list[str]) -> np.ndarray:
        out, low = np.zeros((len(words), len(self.words)), np.float32), 0
        for part in segments(words, STRIP_CHARS):
            if len(part) == 1 and len(part[0]) > STRIP_CHARS:
                close, alike = np.zeros(1, np.int64), self.strips(part[0])
            else:
                close = np.flatnonzero(self.may_reach(part))
                alike = self.plain([part[i] for i in close])
            out[low + close] = np.where(alike >= FLOOR, alike, 0) ** POWER
            low += len(part)
        return out


def tokens(text: str) -> list[str]:
    """Words of a text in lower case; a line ends a sentence like a full stop."""
    return text.lower().replace("\n", " . ").split()


class Words:
    """Numbers of words seen so far, with what each adds to a decision."""

    def __init__(self, value_of):
        self.value_of = value_of
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.size = 0
        self.values, self.ends, self.single = np.zeros(0), np.zeros(0, bool), np.zeros(0, bool)

    def learn(self, words: set[str]) -> None:
        new = sorted(words.difference(self.number))
        size = sum(map(len, new))
        if self.number and (len(self.number) + len(new) > MOST_CACHED or self.size + size > MOST_CACHED * LONGEST_WORD):
            self.forget()
            new = sorted(words)
            size = sum(map(len, new))
        if not new:
            return
        self.size += size
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new)), strict=True))
        self.values = np.concatenate([self.values, self.value_of(new)])
        self.ends = np.concatenate([self.ends, np.array([w[-1] in ".!?" for w in new])])
        self.single = np.concatenate([self.single, np.array([len(w) == 1 and w.isalpha() for w in new])])

    def sentences(self, words: list[str]) -> np.ndarray:
        """Sums of what the words of each sentence add; one empty sentence without words."""
        if not words:
            return np.zeros(1)
        numbers = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        values, ends, single = self.values[numbers], self.ends[numbers], self.single[numbers]
        for start, stop in spelled(single):
            values[start] += self.value_of(["".join(words[start:stop])])[0]
        starts = np.concatenate(([0], np.flatnonzero(ends[:-1]) + 1))
        return np.add.reduceat(values, starts)


def spelled(single: np.ndarray) -> list[tuple[int, int]]:
    """Runs of three and more single letters."""
    if single.sum() < 3:
        return []
    edges = np.flatnonzero(np.diff(np.concatenate(([0], single.astype(np.int8), [0]))))
    return [(a, b) for a, b in edges.reshape(-1, 2).tolist() if b - a >= 3]


def sentences(text: str) -> list[list[str]]:
    """The words of each sentence, single letters in a row also as one word."""
    out: list[list[str]] = [[]]
    words = tokens(text)
    runs = dict(spelled(np.array([len(w) == 1 and w.isalpha() for w in words], bool)))
    for i, w in enumerate(words):
        out[-1].append(w)
        if i in runs:
            out[-1].append("".join(words[i : runs[i]]))
        if w[-1] in ".!?":
            out.append([])
    return [s for s in out if s] or [[]]


@dataclass
class Model:
    landmarks: list[str]
    weights: np.ndarray
    bias: float
    slope: float
    shift: float
    _words: Words | None = field(default=None, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_words": None}

    def decisions(self, texts: list[str]) -> np.ndarray:
        """The decision value of each text's worst sentence."""
        if self._words is None:
            kernel = Landmarks(self.landmarks) if self.landmarks else None
            self._words = Words(lambda words: kernel(words) @ self.weights if kernel else np.zeros(len(words)))
        out = []
        # new words are compared with the landmarks once for a block of texts
        for block in segments(texts, BLOCK_CHARS):
            said = [tokens(t) for t in block]
            self._words.learn(set().union(*said))
            out += [self._words.sentences(words).max() + self.bias for words in said]
        return np.array(out)

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.decisions(texts) + self.shift, -500, 500)))


def choose_landmarks(words: list[str], times: np.ndarray, rate: float, most: int = LANDMARKS) -> list[str]:
    """Words that, or whose triples, are most over-represented in toxic rows, and words close to them.

    ``times`` has the numbers of toxic and of clean rows with each word, ``rate`` the share of toxic rows.
    """
    short = np.array([len(w) <= LONGEST_WORD for w in words])
    words, times = [w for w, s in zip(words, short, strict=True) if s], times[short]
    for_toxic, for_clean, score = np.zeros(N_TRIPLES), np.zeros(N_TRIPLES), np.zeros(len(words))
    for low in range(0, len(words), STRIP):
        of, triple, weight = summed(*triples(words[low : low + STRIP]))
        for_toxic += np.bincount(triple, weight * times[low + of, 0], N_TRIPLES)
        for_clean += np.bincount(triple, weight * times[low + of, 1], N_TRIPLES)
    ratio = for_toxic.sum() / max(1.0, for_clean.sum())
    odds = np.log((for_toxic + 1) / (for_clean * ratio + 1))
    in_toxic = np.flatnonzero(times[:, 0] > 0)
    for low in range(0, len(in_toxic), STRIP):
        part = in_toxic[low : low + STRIP]
        of, triple, weight = summed(*triples([words[i] for i in part]))
        length = np.sqrt(np.bincount(of, weight**2, len(part)))
        score[part] = np.bincount(of, weight * odds[triple], len(part)) / np.maximum(length, 1e-9)
    by_triples = [words[i] for i in np.argsort(-score, kind="stable").tolist() if score[i] > 0]
    # words that are themselves more frequent in toxic rows, against what chance would give
    excess = (times[:, 0] - rate * times.sum(axis=1)) / np.sqrt(rate * times.sum(axis=1) + 1)
    by_words = [words[i] for i in np.argsort(-excess, kind="stable").tolist() if excess[i] > 2]
    chosen = unlike(by_words, [], most // 2)
    chosen = unlike(by_triples, chosen, most * 3 // 4)
    return chosen + near_misses(chosen, words, times[:, 1], most - len(chosen))


def near_misses(chosen: list[str], words: list[str], in_clean: np.ndarray, most: int) -> list[str]:
    """Words of clean rows that resemble a chosen one most often: they let a machine tell the two apart."""
    if not chosen:
        return []
    known, close, own = Landmarks(chosen), [], set(chosen)
    others = [i for i in np.flatnonzero(in_clean > 0).tolist() if words[i] not in own]
    for low in range(0, len(others), STRIP):
        part = others[low : low + STRIP]
        alike = known.plain([words[i] for i in part])
        for row in np.flatnonzero(alike.max(axis=1, initial=0) >= FLOOR).tolist():
            j = int(alike[row].argmax())
            close.append((-float(alike[row, j]) ** (2 * POWER) * in_clean[part[row]], words[part[row]], j))
    taken, found = Counter(), []
    for _, word, j in sorted(close):
        if len(found) == most:
            break
        if taken[j] < 4 and not (found and Landmarks(found).plain([word]).max() >= 0.9):
            taken[j] += 1
            found.append(word)
    return found


def unlike(words: list[str], chosen: list[str], most: int) -> list[str]:
    """``chosen`` with further words in their order, none close to another, up to ``most``."""
    chosen = list(chosen)
    for low in range(0, len(words), 512):
        if len(chosen) >= most:
            break
        part = words[low : low + 512]
        free = Landmarks(chosen).plain(part).max(axis=1, initial=0) < APART
        near = Landmarks(part).plain(part) >= APART
        for i, word in enumerate(part):
            if free[i] and len(chosen) < most:
                chosen.append(word)
                free &= ~near[i]
    return chosen


def svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 25, penalty: float = 1e-4):
    """A linear machine with squared hinge loss, by Newton steps on the rows inside the margin."""
    x1 = np.column_stack([x, np.ones(len(x))])
    ridge = np.full(x1.shape[1], penalty)
    ridge[-1] = 1e-9
    w = np.zeros(x1.shape[1])

    def loss(w: np.ndarray) -> float:
        return weight @ np.maximum(0, 1 - y * (x1 @ w)) ** 2 + ridge @ w**2

    for _ in range(rounds):
        inside = y * (x1 @ w) < 1
        part, of = x1[inside], weight[inside]
        aim = np.linalg.solve(part.T @ (part * of[:, None]) + np.diag(ridge), part.T @ (of * y[inside]))
        before, step = loss(w), 1.0
        while step > 1e-3 and loss(w + step * (aim - w)) > before - 1e-12:
            step /= 2
        if step <= 1e-3:
            break
        w = w + step * (aim - w)
    return w[:-1], float(w[-1])


def calibrate(values: np.ndarray, toxic: np.ndarray, share: float) -> tuple[float, float]:
    """Slope and shift of a logistic curve; ``share`` is that of toxic rows outside the sample.

    The aims are not quite 0 and 1, as in Platt's method, so that the curve stays finite.
    """
    n1, n0 = toxic.sum(), (~toxic).sum()
    aims = np.where(toxic, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(toxic, share / n1, (1 - share) / n0)
    slope, shift = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(slope * values + shift, -500, 500)))
        pull, bend = weight * (aims - p), np.maximum(weight * p * (1 - p), 1e-12)
        g = np.array([pull @ values - 1e-6 * slope, pull.sum()])
        h = np.array([[bend @ values**2 + 1e-6, bend @ values], [bend @ values, bend.sum() + 1e-9]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2 / max(np.abs(step).max(), 1e-12))
        slope, shift = max(slope + step[0], 1e-3), shift + step[1]
    return float(slope), float(shift)


def fit(texts: list[str], toxic: np.ndarray, share: float, rounds: int = 6) -> Model:
    number: dict[str, int] = {}
    said = [[[number.setdefault(w, len(number)) for w in s] for s in sentences(t)] for t in texts]
    said = [[np.array(s, np.int32) for s in doc] for doc in said]
    words, times = list(number), np.zeros((len(number), 2))
    for doc, is_toxic in zip(said, toxic.tolist(), strict=True):
        times[np.unique(np.concatenate(doc)), 0 if is_toxic else 1] += 1
    landmarks = choose_landmarks(words, times, toxic.mean())
    if not landmarks:
        return Model([], np.zeros(0), 0.0, 1e-3, float(np.log(share / (1 - share))))
    kernel = Landmarks(landmarks)
    # the Nyström map: with it, products of two mapped words give their kernel
    values, vectors = np.linalg.eigh(kernel(landmarks).astype(np.float64))
    useful = values > 1e-3 * values.max()
    mapping = vectors[:, useful] / np.sqrt(values[useful])

    # most words are like no landmark, and most sentences have no other words: a row keeps one such sentence
    row_of, rows = np.full(len(words), -1), []
    for low in range(0, len(words), STRIP):
        alike = kernel(words[low : low + STRIP])
        met = np.flatnonzero(alike.any(axis=1))
        row_of[low + met] = len(rows) + np.arange(len(met))
        rows += list(alike[met])
    vectors_of, likeness, of = np.array(rows).reshape(-1, len(landmarks)), [], []
    for doc, content in enumerate(said):
        at = [row_of[s] for s in content]
        hits = [a[a >= 0] for a in at]
        found = [vectors_of[h].sum(axis=0) for h in hits if len(h)]
        if len(found) < len(content):
            found.append(np.zeros(len(landmarks), np.float32))
        likeness += found
        of += [doc] * len(found)
    likeness, of = np.stack(likeness), np.array(of)
    x = (likeness @ mapping.astype(np.float32)).astype(np.float64)
    starts = np.searchsorted(of, np.arange(len(texts)))
    ends = [*starts[1:], len(of)]
    per_row = np.where(toxic, share / toxic.sum(), (1 - share) / (~toxic).sum())

    # at first, rows as a whole tell which landmarks matter
    w, b = svm(np.maximum.reduceat(likeness, starts).astype(np.float64), np.where(toxic, 1.0, -1.0), per_row)
    looks = likeness @ w + b
    hard: set[int] = set()  # sentences of clean rows that looked worst in some round
    for _ in range(rounds):
        worst = np.array([a + looks[a:b].argmax() for a, b in zip(starts, ends, strict=True)])
        # what looks worse than nearly all clean rows counts even if it is not yet decided so
        limit = min(0.0, np.quantile(looks[worst[~toxic]], 0.99) + 0.25)
        bad = np.union1d(worst[toxic], np.flatnonzero(toxic[of] & (looks > limit)))
        hard.update(worst[~toxic].tolist())
        used = np.concatenate([bad, sorted(hard)]).astype(np.int64)
        # a row weighs the same with any number of sentences
        weight = per_row[of[used]] / np.bincount(of[used])[of[used]]
        w, b = svm(x[used], np.where(toxic[of[used]], 1.0, -1.0), weight)
        looks = x @ w + b
    model = Model(landmarks, mapping @ w, b, 1.0, 0.0)
    model.slope, model.shift = calibrate(np.maximum.reduceat(looks, starts), toxic, share)
    return model


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_rows: int = MAX_ROWS
) -> Model:
    """A model from at most about ``max_rows`` labelled rows, half of each label or all there are.

    The rows are chosen by their ids alone, one row of an id that repeats, and by the length of
    their texts: a text that would bring all of them beyond ``MOST_LEARNT`` characters is left out.
    The chosen ids are few by their bound and are sent to the texts, so that only these few texts
    are shuffled.
    """
    labels = labels.filter(F.col(label_col).isin(0, 1)).select(id_col, F.col(label_col).alias("label"))
    known = docs.select(id_col).join(labels, id_col)
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    share = sizes.get(1, 0) / max(1, sum(sizes.values()))
    if len(sizes) < 2:
        return Model([], np.zeros(0), 0.0, 0.0, 50.0 if share else -50.0)
    draw = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 30))
    part = {label: int(min(1.0, max_rows / 2 / n) * (1 << 30)) for label, n in sizes.items()}
    chosen = known.filter(draw < F.when(F.col("label") == 1, part[1]).otherwise(part[0]))
    # the limit only guards against ids that repeat
    chosen = chosen.groupBy(id_col).agg(F.max("label").alias("label")).orderBy(draw, id_col).limit(2 * max_rows)
    texts = docs.select(id_col, F.coalesce(text_col, F.lit("")).alias("text"))
    first = F.min(F.struct(F.xxhash64("text").alias("hash"), F.length("text").alias("length"))).alias("first")
    sizes_of = texts.join(F.broadcast(chosen), id_col).groupBy(id_col, "label").agg(first).orderBy(draw, id_col)
    few, left = [], MOST_LEARNT
    for key, label, (hashed, length) in sizes_of.collect():
        if length <= left:
            few.append((key, label, hashed))
            left -= length
    picked = docs.sparkSession.createDataFrame(few, known.select(id_col, "label", F.lit(0).cast("long").alias("hash")).schema)
    found = texts.join(F.broadcast(picked), id_col).filter(F.xxhash64("text") == F.col("hash"))
    rows = sorted(map(tuple, found.select(id_col, "text", "label").distinct().collect()))
    toxic = np.array([r[2] == 1 for r in rows], bool)
    if not toxic.any() or toxic.all():
        return Model([], np.zeros(0), 0.0, 0.0, float(np.log(share / (1 - share))))
    return fit([r[1] for r in rows], toxic, share)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with score and predicted. The model has a fixed number of landmarks."""

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.scores([t or "" for t in texts]))

    docs = cleared(docs, "score", "predicted").withColumn("score", of(F.col(text_col)))
    return docs.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("op8_toxicity")
def op8_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", held_out())
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = learn(docs.filter(~F.col("held_out")), labels, "doc_id", "text", "toxic")
    return score(docs, model).drop("text")
