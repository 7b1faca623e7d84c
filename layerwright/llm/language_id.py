"""Language identification: multinomial logistic regression on TF-IDF of character n-grams.

Characters are lower-cased, other characters than letters become one space, and pairs and triples of them are hashed
to a fixed number of features. A document's features are relative frequencies times inverse document frequencies.
Weights are trained by follow-the-regularised-leader with elastic-net penalties, which leaves most at exactly zero; a temperature
fitted on documents left out of training turns margins into probabilities.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerwright.llm.common import packed, unpacked

BITS = 16
FEATURES = 1 << BITS
#: Brings features, which are shares of a text, near one.
SCALE = 100.0


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)])


def ngrams(text: str | None) -> np.ndarray:
    """Hashed pairs and triples of characters, with repeats; empty where the text has no letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return np.empty(0, np.int64)
    codes = np.where(letter, codes, np.uint32(32))
    gap = ~letter
    kept = codes[~(gap & np.concatenate([[False], gap[:-1]]))]  # one space for a run of others
    c = np.concatenate([[32], kept, [32]]).astype(np.uint32)
    two = c[:-1] * np.uint32(2654435761) + c[1:] * np.uint32(2246822519)
    three = two[:-1] * np.uint32(3266489917) + c[2:] * np.uint32(668265263) + np.uint32(374761393)
    both = np.concatenate([two, three])
    both ^= both >> np.uint32(15)
    return ((both * np.uint32(2246822519)) >> np.uint32(32 - BITS)).astype(np.int64)


@dataclass
class Model:
    """``table`` has, for each feature, its inverse document frequency times its weight for each language."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float

    def margins(self, grams: np.ndarray) -> np.ndarray:
        total = np.zeros(len(self.languages))
        for at in range(0, len(grams), 1 << 16):
            total += self.table[grams[at:at + (1 << 16)]].sum(axis=0, dtype=np.float64)
        return self.bias + SCALE * total / len(grams)

    def predict(self, text: str | None) -> tuple[str, float]:
        grams = ngrams(text)
        if not len(grams) or not self.languages:
            return "und", 0.0
        p = softmax(self.margins(grams) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of the texts (column ``text``) each feature is, and their number: over all rows, a row per task and feature."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, seen, n = np.zeros(FEATURES + 1, np.int64), np.zeros(FEATURES, bool), 0
        for batch in batches:
            for text in batch.column(0):
                seen[ngrams(text.as_py())] = True
                df[:-1] += seen
                seen[:] = False
                n += 1
        df[-1] = n
        feature = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(feature), pa.array(df[feature])], names=["feature", "n"])

    rows = texts.select("text").mapInArrow(count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(FEATURES + 1, np.int64)
    df[rows["feature"]] = rows["n"]
    return df[:-1], int(df[-1])


def ftrl(samples: list[tuple[np.ndarray, np.ndarray, int]], classes: int, *, epochs: int = 3, alpha: float = 0.5, beta: float = 1.0,
         l1: float = 0.05, l2: float = 0.001) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias from (features, values, class), by per-coordinate FTRL-proximal."""
    z, n = np.zeros((FEATURES + 1, classes)), np.zeros((FEATURES + 1, classes))

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(samples)):
            at, x, label = samples[i]
            at, x = np.append(at, FEATURES), np.append(x, 1.0)
            w = weights(z[at], n[at])
            p = softmax(x @ w)
            p[label] -= 1
            g = x[:, None] * p
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
    w = weights(z, n)
    return w[:-1], w[-1]


def best_temperature(margins: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of the least log loss, on a fixed grid from 1/2 to 8."""
    if not len(labels):
        return 1.0
    grid = 2.0 ** np.arange(-1, 3.01, 0.125)
    loss = [-np.log(np.maximum(softmax(margins / t)[np.arange(len(labels)), labels], 1e-300)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def _sample(labelled: DataFrame, most: int) -> DataFrame:
    """Of each language the ``most`` rows of smallest hash, numbered as ``nth``.

    About twice as many, by the share that they are of the language's rows, are picked before anything is shuffled, so that no
    task meets a whole language.
    """
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    share = F.lit(1.0)
    for lang, n in counts.items():
        if n > 2 * most:
            share = F.when(F.col("lang") == lang, F.lit(2.0 * most / n)).otherwise(share)
    place = F.xxhash64("text", "id")
    picked = labelled.filter(F.pmod(place, F.lit(1 << 40)) < share * F.lit(float(1 << 40)))
    by_hash = Window.partitionBy("lang").orderBy(F.pmod(place, F.lit(1 << 40)), "text")
    return picked.withColumn("nth", F.row_number().over(by_hash)).filter(F.col("nth") <= most)


def train(labelled: DataFrame, *, max_docs_per_language: int = 2_000) -> Model:
    """A model from ``id, text, lang`` with neither text nor lang null.

    Document frequencies are counted over all rows. Weights come from a bounded sample: of each language the
    ``max_docs_per_language`` rows whose hash is smallest, whole texts, fitted in one task; every fifth of them only sets the temperature.
    """
    df, n = document_frequencies(labelled)
    idf = np.log((1 + n) / (1 + df)) + 1
    sample = _sample(labelled, max_docs_per_language).select("lang", "nth", "text")

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        languages = sorted(rows["lang"].unique())
        kept, tuning = [], []
        for row in rows.sort_values(["nth", "lang"]).itertuples():
            grams = ngrams(row.text)
            if len(grams):
                at, counts = np.unique(grams, return_counts=True)
                x = counts * idf[at] * (SCALE / len(grams))
                (tuning if row.nth % 5 == 0 else kept).append((at, x, languages.index(row.lang)))
        weights, bias = ftrl(kept, len(languages))
        margins = np.array([x @ weights[at] + bias for at, x, _ in tuning])
        heat = best_temperature(margins, np.array([label for *_, label in tuning], int))
        table = (weights * idf[:, None]).astype(np.float32)
        return pd.DataFrame({"languages": [languages], "weights": [table.tobytes()], "bias": [list(bias)], "heat": [heat]})

    kind = "languages array<string>, weights binary, bias array<double>, heat double"
    got = sample.groupBy().applyInPandas(fit, kind).collect()
    if not got:
        return Model([], np.zeros((FEATURES, 0), np.float32), np.zeros(0), 1.0)
    row = got[0]
    table = np.frombuffer(row["weights"], np.float32).reshape(FEATURES, len(row["languages"]))
    return Model(list(row["languages"]), table, np.array(row["bias"]), row["heat"])


def predictor(spark, model: Model):
    """The model as a column function: text to ``struct<lang_pred, score>``."""
    shared = spark.sparkContext.broadcast(model)
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("lang_pred string, score double")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        for texts in batches:
            found = [own.predict(t.as_py()) for t in texts]
            yield pa.StructArray.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                                             fields=list(kind))

    return predict


def held_out(ident: Column) -> Column:
    """Whether crc32 of an id, as text, leaves 2 when divided by 4; a null id is not held out."""
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", *,
             max_docs_per_language: int = 2_000) -> DataFrame:
    """``docs`` plus ``held_out, lang_pred, score``.

    Learns only from text and non-null language of rows that have an id and are not held out; predicts each row from its whole text
    alone, however long: n-grams are added up in pieces. Languages that are equally likely go by the smaller name. A null text, one without a letter, and any
    text when there is nothing to learn from gets ``und`` and score 0. Repeated rows count and are predicted each; an empty table gives an empty table. Columns of the input with these names are replaced.
    """
    base = packed(docs, id=id_col, text=text_col, lang=lang_col)
    learnt = base.filter("id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL").filter(~held_out(F.col("id")))
    model = train(learnt.select("id", "text", "lang"), max_docs_per_language=max_docs_per_language)
    predict = predictor(docs.sparkSession, model)
    out = packed(docs, id=id_col, found=predict(F.col(f"`{text_col}`")))
    return unpacked(out, docs.columns, held_out=held_out(F.col("id")), lang_pred=F.col("found.lang_pred"), score=F.col("found.score"))
