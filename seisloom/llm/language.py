"""Language ID by hierarchical discrimination (operator 10).

First the family of the language, then, between languages of that family,
one-versus-one linear support vector machines; both levels use the same
machines. A text is the unit-length vector of square roots of its hashed byte
trigram counts (letters lower-cased, everything else a space), over the whole text.

Training: ``PER_CLASS`` labelled documents of each language are expected in the
sample, chosen by a hash of the id, so the model is of bounded size; each machine
is trained in a group of its own from sparse vectors.

Scale: prediction is one pass without a shuffle; the model (a machine of ``SIZE`` floats for
each pair of families and each pair of a family's languages) is broadcast. More than ``MOST_LANGUAGES``
labels are an error, since labels are then no languages. A machine's group holds the sparse
vectors of two classes' sample, some ``2 * PER_CLASS`` by the trigrams of a text. Vectors of long texts are summed over slices.

Cases: null text or no letter: ``und`` with score 0; without labels every text is
``und``; one label: that one; null ids are never trained on and not held out;
extra columns of any name stay; equal votes go to the larger sum of margins, then to the first in order; repeated rows repeat.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, read, unused

SIZE, SLICE, PER_CLASS, FOLDS, HELD_OUT, MOST_LANGUAGES = 4096, 1 << 20, 1000, 4, 2, 300
PASSES, COST, SLOPE = 12, 10.0, 4.0
UNKNOWN = "und"
#: Families of language codes; any other code is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "fy"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}


def family(language: str) -> str:
    return FAMILY_OF.get(language.lower().partition("-")[0], language)


def counts(text: str) -> np.ndarray | None:
    """Hashed trigram counts; None without a letter."""
    out, letters = np.zeros(SIZE, np.float64), False
    for at in range(0, max(len(text), 1), SLICE):
        part = text[at : at + SLICE].lower()
        kept = part if part.isalpha() else part.translate(_SPACES)
        if not part.isascii():
            kept = "".join(c if c.isalpha() else " " for c in kept) if not kept.isascii() and _odd(kept) else kept
        words = kept.split()
        if not words:
            continue
        letters = letters or any(map(str.isalpha, words))
        b = np.frombuffer(f"  {' '.join(words)}  ".encode(), np.uint8).astype(np.uint32)
        code = (b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]) * np.uint32(2654435761) >> np.uint32(20)
        out += np.bincount(code, minlength=SIZE)
    return out if letters else None


_SPACES = {i: " " for i in range(128) if not chr(i).isalpha()}


def _odd(text: str) -> bool:
    """Whether there is anything but letters and white space."""
    return not text.translate({32: None, 160: None}).isalpha()


def features(text: str | None) -> np.ndarray | None:
    c = counts(text) if text else None
    if c is None:
        return None
    x = np.sqrt(c)
    return x / np.linalg.norm(x)


def train_machine(at: list[np.ndarray], value: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss by dual coordinate descent (Hsieh et al.,
    2008) on sparse rows, ``value`` in the columns ``at``, and a constant one. ``y`` is 1 or -1."""
    w, bias, a = np.zeros(SIZE), 0.0, np.zeros(len(y))
    diagonal = [float(v @ v) + 1.0 + 0.5 / COST for v in value]
    order = np.random.default_rng(7)
    for _ in range(PASSES):
        for i in order.permutation(len(y)):
            step = y[i] * (w[at[i]] @ value[i] + bias) - 1 + a[i] * 0.5 / COST
            new = max(a[i] - step / diagonal[i], 0.0)
            if new != a[i]:
                by = (new - a[i]) * y[i]
                w[at[i]] += by * value[i]
                bias += by
                a[i] = new
    return w, float(bias)


class Model:
    """``machines``: (level, a, b) with weights for a against b; level is ``""``
    for families or a family's name."""

    def __init__(self, languages: list[str], machines: dict[tuple[str, str, str], tuple[np.ndarray, float]]):
        self.languages = sorted(languages)
        self.machines = machines
        self.families: dict[str, list[str]] = {}
        for x in self.languages:
            self.families.setdefault(family(x), []).append(x)

    def _choose(self, level: str, classes: list[str], x: np.ndarray) -> tuple[str, float]:
        votes = dict.fromkeys(classes, 0)
        margin = {c: [] for c in classes}
        for a, b in combinations(classes, 2):
            w, bias = self.machines[level, a, b]
            m = float(w @ x) + bias
            votes[a if m >= 0 else b] += 1
            margin[a].append(m)
            margin[b].append(-m)
        best = max(classes, key=lambda c: (votes[c], sum(margin[c])))
        return best, 1 / (1 + np.exp(-SLOPE * min(margin[best]))) if margin[best] else 1.0

    def predict(self, text: str | None) -> tuple[str, float]:
        x = features(text)
        if x is None or not self.languages:
            return UNKNOWN, 0.0
        f, p = self._choose("", sorted(self.families), x)
        language, q = self._choose(f, self.families[f], x)
        return language, float(p * q)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def train(docs: DataFrame, text: str = "text", label: str = "lang", doc_id: str = "doc_id", per_class: int = PER_CLASS) -> Model:
    """A model from labelled documents that are not held out."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(label).alias("label")).where(
        F.col("label").isNotNull() & F.col("id").isNotNull() & ~held_out(F.col("id"))
    )
    found = rows.groupBy("label").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} different labels: these are no languages")
    number = {r["label"]: r["n"] for r in found}
    languages = sorted(number)
    if not languages:
        return Model([], {})
    share = F.lit(0.0)
    for language, n in number.items():
        share = F.when(F.col("label") == language, F.lit(per_class / n)).otherwise(share)
    draw = F.pmod(F.xxhash64("id", F.lit("language")), F.lit(1 << 30)) / F.lit(float(1 << 30))

    pairs = [("", a, b) for a, b in combinations(sorted({family(x) for x in languages}), 2)]
    for f in sorted({family(x) for x in languages}):
        pairs += [(f, a, b) for a, b in combinations([x for x in languages if family(x) == f], 2)]

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            level, a, b, y, at, value = [], [], [], [], [], []
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = features(text)
                if x is None:
                    continue
                some = np.flatnonzero(x)
                for pair in pairs:
                    name = family(label) if pair[0] == "" else label
                    if name in pair[1:]:
                        for column, v in zip((level, a, b, y, at, value), (*pair, 1 if name == pair[1] else -1, some, x[some]), strict=True):
                            column.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(level, pa.string()), pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(y, pa.int32()),
                 pa.array(at, pa.list_(pa.int32())), pa.array(value, pa.list_(pa.float64()))],
                ["level", "a", "b", "y", "at", "value"],
            )

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        rows = sorted(zip(group["at"], group["value"], group["y"], strict=True), key=lambda r: (len(r[0]), r[0].tobytes(), r[1].tobytes(), r[2]))
        w, bias = train_machine([r[0] for r in rows], [r[1] for r in rows], np.array([r[2] for r in rows]))
        return pd.DataFrame({"level": group["level"].iloc[:1], "a": group["a"].iloc[:1], "b": group["b"].iloc[:1], "w": [w.tolist()], "bias": [bias]})

    sample = rows.where(draw < share).select("text", "label").mapInArrow(vectors, "level string, a string, b string, y int, at array<int>, value array<double>")
    fitted = sample.groupBy("level", "a", "b").applyInPandas(fit, "level string, a string, b string, w array<double>, bias double")
    machines = {(r["level"], r["a"], r["b"]): (np.array(r["w"]), r["bias"]) for r in fitted.collect()}  # a row for each pair of classes
    empty = (np.zeros(SIZE), 0.0)  # no letters in any text of either class
    return Model(languages, {p: machines.get(p, empty) for p in pairs})


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns of those names are replaced."""
    spread = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def judge(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([spread.value.predict(t) for t in texts], columns=["lang_pred", "score"])

    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    found = judge(F.col(text).cast("string"))
    judged = unused(docs, "judged")
    return docs.select(*kept, found.alias(judged)).select(*kept, f"{judged}.lang_pred", f"{judged}.score")


def keep_known(docs: DataFrame, least_score: float = 0.25, **options) -> DataFrame:
    """The documents whose language is known with ``least_score`` at least."""
    found = predict(docs, train(docs, **options))
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score)).select(*[F.col(f"`{c}`") for c in docs.columns])


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = train(docs)
    return predict(docs.select("doc_id", "text", "lang"), model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
