"""Language identification by error-correcting output codes.

Every language has a codeword of bits. For each bit a binary classifier (logistic regression
over hashed letter n-grams, n from 1 to 3) predicts it from the text; the language whose
codeword has the least loss, summed over the bits, wins. The loss of a bit is the log loss
of the classifier's margin, so that a bit counts as much as its classifier is sure of it.
With up to seven languages the code is the exhaustive one (every split of the languages in
two); beyond that, random words with the largest least distance among a number of draws.
An answer is flagged as ambiguous if the best two words are hardly apart in loss.

Counts of n-grams are taken in the tasks, over whole texts. The classifiers are fitted on a
bounded sample of labelled rows (``max_rows`` in all, spread evenly over the languages,
chosen by a hash of the id), which the driver fits in memory by its bound.

Defined results: a NULL text, and one without a letter, is ``und`` with score 0 and is
ambiguous. Without any row to learn from all texts are. Rows with a NULL language, or with
``und`` as their language, are never learnt from. Ties go to the first language in code point order. Repeated rows are labelled each.
An empty table gives an empty result. Columns of the input named like an added one are replaced,
and those that start with an underscore are left out.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.registry import cleared, query, table

UNDETERMINED = "und"
N_FEATURES = 1 << 12
CHUNK = 1 << 18
MAX_ROWS = 2400
EXHAUSTIVE = 7
#: a lead in loss below this is ambiguous
LEAD = 0.1


@functools.cache
def letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter(map(str.isalpha, map(chr, range(sys.maxunicode + 1))), bool, sys.maxunicode + 1)


def ngram_counts(text: str) -> np.ndarray | None:
    """How often each hashed n-gram of letters occurs; None without a letter.

    What is no letter counts as a border: n-grams hold one at their ends at most.
    """
    counts = np.zeros(N_FEATURES, np.int64)
    lowered = text.lower()
    seen = False
    for start in range(0, len(lowered), CHUNK):
        # the last two characters of the chunk before, or borders
        head = lowered[max(0, start - 2) : start].rjust(2)
        tail = " " if start + CHUNK >= len(lowered) else ""
        points = np.frombuffer((head + lowered[start : start + CHUNK] + tail).encode("utf-32-le"), np.uint32)
        is_letter = letters()[points]
        here = np.where(is_letter, points, 0).astype(np.uint64)
        a, b, c = here[:-2], here[1:-1], here[2:]
        is_a, is_b, is_c = is_letter[:-2], is_letter[1:-1], is_letter[2:]
        seen = seen or bool(is_c.any())
        one = c[is_c] * np.uint64(0x9E3779B97F4A7C15)
        two = ((b << np.uint64(21) | c) + np.uint64(1 << 62))[is_b | is_c] * np.uint64(0x9E3779B97F4A7C15)
        three = (((a << np.uint64(21) | b) << np.uint64(21) | c) + np.uint64(1 << 63))[is_b & (is_a | is_c)]
        three = three * np.uint64(0x9E3779B97F4A7C15)
        for grams in (one, two, three):
            counts += np.bincount((grams >> np.uint64(52)).astype(np.int64), minlength=N_FEATURES)
    return counts if seen else None


def features(text: str | None) -> np.ndarray | None:
    """Square roots of the n-gram shares: a vector of length 1."""
    counts = ngram_counts(text or "")
    return None if counts is None else np.sqrt(counts / counts.sum()).astype(np.float32)


def codewords(n_languages: int, seed: int = 11) -> np.ndarray:
    """One row of +1 and -1 per language; no column is constant and no two rows are equal."""
    if n_languages == 1:
        return np.ones((1, 1))
    if n_languages <= EXHAUSTIVE:
        splits = range(1, 2 ** (n_languages - 1))
        return np.array([[1 if i == 0 or not s >> (i - 1) & 1 else -1 for s in splits] for i in range(n_languages)], float)
    draw = np.random.default_rng(seed)
    bits = int(np.ceil(10 * np.log2(n_languages)))
    best, widest = None, -1
    for _ in range(200):
        words = draw.choice([-1.0, 1.0], (n_languages, bits))
        apart = (bits - words @ words.T) / 2
        least = apart[~np.eye(n_languages, dtype=bool)].min()
        if least > widest and (np.abs(words.sum(axis=0)) < n_languages).all():
            best, widest = words, least
    return best


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    words: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def losses(self, x: np.ndarray) -> np.ndarray:
        """Of rows of features: the loss of every language's codeword."""
        margins = x @ self.weights + self.bias
        return np.stack([np.logaddexp(0, -margins * word).sum(axis=1) for word in self.words], axis=1)

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the language, score and whether it is ambiguous, for rows of features."""
        losses = self.losses(x)
        best = losses.argmin(axis=1)
        shares = np.exp(losses.min(axis=1, keepdims=True) - losses)
        score = 1 / shares.sum(axis=1)
        ordered = np.sort(losses, axis=1)
        close = ordered[:, 1] - ordered[:, 0] < LEAD if len(self.languages) > 1 else np.zeros(len(x), bool)
        return best, score, close


def fit(x: np.ndarray, labels: list[str], rounds: int = 150, penalty: float = 1e-4) -> Model:
    """Logistic regressions for all bits at once, by accelerated gradient steps.

    Every language weighs the same, whatever its share of the rows.
    """
    languages = tuple(sorted(set(labels), key=lambda s: s.encode()))
    number = {language: i for i, language in enumerate(languages)}
    of = np.array([number[s] for s in labels])
    words = codewords(len(languages))
    weight = (1 / np.bincount(of))[of][:, None] / len(languages)
    x = x.astype(np.float32)
    aims = words[of]
    w, b = np.zeros((x.shape[1], words.shape[1])), np.zeros(words.shape[1])
    ahead_w, ahead_b, speed, step = w, b, 1.0, 4.0
    for _ in range(rounds):
        margins = x @ ahead_w.astype(np.float32) + ahead_b
        pull = weight * aims / (1 + np.exp(aims * margins))
        next_w = ahead_w + step * (x.T @ pull.astype(np.float32) - penalty * ahead_w)
        next_b = ahead_b + step * pull.sum(axis=0)
        next_speed = (1 + np.sqrt(1 + 4 * speed**2)) / 2
        ahead_w = next_w + (speed - 1) / next_speed * (next_w - w)
        ahead_b = next_b + (speed - 1) / next_speed * (next_b - b)
        w, b, speed = next_w, next_b, next_speed
    return Model(languages, words, w.astype(np.float32), b)


def feature_bytes(text: Column) -> Column:
    """Features of a text column as packed 32-bit floats; NULL without a letter."""

    @F.pandas_udf("binary")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = (features(t) for t in texts)
            yield pd.Series([None if x is None else x.tobytes() for x in found], dtype=object)

    return of(text)


def in_bounds(rows: DataFrame, id_col: str, text_col: str, most: int) -> DataFrame:
    """``rows``, or ``most`` of them in the order of ids and hashes of texts if ids repeat that often.

    Of rows equal in both any are as good as the others.
    """
    if rows.count() <= most:
        return rows
    place = F.struct(F.col(id_col).cast("string").alias("id"), F.xxhash64(text_col).alias("text"))
    narrow = rows.select(place.alias("place")).orderBy("place").limit(most)
    last = narrow.agg(F.max("place").alias("last"), F.count("*")).first()["last"]
    edge = F.struct(F.lit(last["id"]).cast("string").alias("id"), F.lit(last["text"]).alias("text"))
    return rows.filter(place <= edge).orderBy(place).limit(most)


def learn(
    labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_rows: int = MAX_ROWS
) -> Model | None:
    """A model of the languages of ``labelled``, from at most about ``max_rows`` rows of them.

    Each language gives an even share of the rows, or all of its rows if it has fewer; they
    are chosen by a hash of the id. None without any row to learn from.
    """
    labelled = labelled.filter(F.col(lang_col).isNotNull() & (F.col(lang_col) != UNDETERMINED))
    sizes = labelled.groupBy(lang_col).count().orderBy(lang_col).limit(max_rows + 1).collect()
    if len(sizes) > max_rows:
        raise ValueError("there are more languages than rows to learn from")
    if not sizes:
        return None
    share = max(1, max_rows // len(sizes))
    draw = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 30))
    few = functools.reduce(
        lambda a, b: a | b,
        ((F.col(lang_col) == r[lang_col]) & (draw < int(min(1.0, share / r["count"]) * (1 << 30))) for r in sizes),
    )
    sample = in_bounds(labelled.filter(few), id_col, text_col, 2 * max_rows)
    sample = sample.select(id_col, lang_col, feature_bytes(F.col(text_col)).alias("x"))
    rows = [r for r in sample.collect() if r["x"] is not None]
    rows.sort(key=lambda r: (r[lang_col], r[id_col] is None, r[id_col] or 0, r["x"]))
    if not rows:
        return None
    return fit(np.stack([np.frombuffer(r["x"], np.float32) for r in rows]), [r[lang_col] for r in rows])


def predict(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and ambiguous. The model has a fixed number of features."""
    docs = cleared(docs, "lang_pred", "score", "ambiguous")
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0), "ambiguous": F.lit(True)})

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out: list[tuple[str, float, bool]] = []
            for text in texts:
                x = features(text)
                if x is None:
                    out.append((UNDETERMINED, 0.0, True))
                    continue
                # one row at a time: the last digits of a product depend on how many rows it takes
                (n,), (score,), (close,) = model.decode(x[None])
                out.append((model.languages[n], float(score), bool(close)))
            yield pd.DataFrame(out, columns=["lang_pred", "score", "ambiguous"])

    return docs.withColumn("_found", of(F.col(text_col))).select(*docs.columns, "_found.*")


def held_out(id_col: str = "doc_id") -> Column:
    """Every fifth document by a checksum of its id; a NULL id is learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


@query("op4_language_id")
def op4_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out())
    model = learn(docs.filter(~F.col("held_out")))
    return predict(docs.select("doc_id", "text", "held_out"), model).drop("text")
