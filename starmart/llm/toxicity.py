"""Toxicity from class-conditional Kneser-Ney models."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.words import Memo, per_text, slices, split_words
from starmart.plans import scratch_folder

_COUNTS = ("toxic", "ordinary", "shared")
_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”„’‘…¡¿"


# A rare word is judged by its first letters, longest known beginning first.
STEMS = (5, 4)


@dataclass(frozen=True)
class ToxicityModel:
    """Log-likelihood ratios of words, and what turns a text's ratios into a score.

    ``units`` are the words, then the beginnings (``"lowe*"``) that rare words back off to; row
    ``i`` of ``unit`` holds the probabilities in the toxic and the ordinary model, the last row
    those of a word nothing is known of. ``pairs`` (unit before * number of units + unit, sorted)
    and ``pair`` are the discounted probabilities of a unit after another, ``rest`` is what the
    one before leaves to units alone.
    """

    units: tuple[str, ...]
    unit: np.ndarray
    rest: np.ndarray
    pairs: np.ndarray
    pair: np.ndarray
    weights: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def places(self) -> Callable[[str], int]:
        place = {unit: i for i, unit in enumerate(self.units)}

        def find(word: str) -> int:
            word = _normal(word)
            names = [word, *(f"{word[:n]}*" for n in STEMS if len(word) >= n)]
            return next((place[name] for name in names if name in place), len(place))

        return find

    def ratios(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """log P(toxic) - log P(ordinary) of each unit after the one before it, ``first`` after none."""
        unknown = len(self.units)
        before = np.concatenate(([unknown], ids[:-1])) if len(ids) else ids
        before[first] = unknown
        chance = self.rest[before] * self.unit[ids]
        if len(self.pairs):
            keys = before * unknown + ids
            at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
            found = (self.pairs[at] == keys) & (before < unknown) & (ids < unknown)
            chance[found] += self.pair[at[found]]
        return np.log(chance[:, 0]) - np.log(chance[:, 1])


def _normal(word: str) -> str:
    return word.strip(_EDGES) or word


def _contexts(docs: DataFrame) -> DataFrame:
    """Three words of ``text`` in a row with ``toxic``: in how many texts of each class they occur."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column(1)
            for low, texts in slices(batch.column(0)):
                distinct, places, bounds = split_words(pc.utf8_lower(texts))
                normal = np.array([_normal(word) for word in distinct] + [""], dtype=object)
                for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    here = normal[np.concatenate(([len(distinct)] * 2, places[a:b]))]
                    seen = {*zip(here[:-2], here[1:-1], here[2:])}
                    if seen:
                        earlier, before, word = zip(*seen)
                        toxic = pa.array([marks[low + i].as_py()] * len(seen), pa.int64())
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(earlier), pa.array(before), pa.array(word), toxic],
                            names=["earlier", "before", "word", "toxic"],
                        )

    rows = docs.select("text", F.col("toxic").cast("long")).mapInArrow(
        find, "earlier string, before string, word string, toxic long"
    )
    return rows.groupBy("earlier", "before", "word").agg(
        F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("ordinary")
    )


def _sample(labels: DataFrame, trained: Column, per_class: int) -> DataFrame:
    """Labelled keys to learn from, at most ``per_class`` of each class, with a fold from 0 to 3."""
    known = (
        labels.filter(trained & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").alias("toxic"))
        .withColumn("_draw", F.xxhash64("doc_id"))
    )
    chosen = [
        known.filter(F.col("toxic") == mark).orderBy("_draw", "doc_id").limit(per_class)
        for mark in (0, 1)
    ]
    fold = F.pmod(F.shiftright("_draw", 7), F.lit(4))
    return chosen[0].union(chosen[1]).select("doc_id", "toxic", fold.alias("fold"))


def _units(words: DataFrame) -> DataFrame:
    """Counts of words and of the beginnings they share: ``unit, parent, toxic, ordinary, shared``."""
    chain = [F.col("word"), *(F.concat(F.substring("word", 1, n), F.lit("*")) for n in STEMS), F.lit("*")]
    long = [F.lit(True), *(F.length("word") >= n for n in STEMS), F.lit(True)]

    def parent(level: int):
        later = [F.when(long[i], chain[i]) for i in range(level + 1, len(chain))]
        return F.coalesce(*later)

    levels = [
        F.when(long[i], F.struct(chain[i].alias("unit"), parent(i).alias("parent")))
        for i in range(len(chain) - 1)
    ]
    return (
        words.select(F.explode(F.array_compact(F.array(*levels))).alias("_u"), *_COUNTS)
        .groupBy("_u.unit", "_u.parent")
        .agg(*[F.sum(c).alias(c) for c in _COUNTS])
    )


def _estimate(
    counts: DataFrame, discount: float, pair_discount: float, most: int
) -> ToxicityModel:
    both = ("toxic", "ordinary")
    # A pair counts once for each word before it, so copies and near copies of a text add nothing.
    pairs = counts.groupBy("before", "word").agg(
        *[F.sum(F.signum(c).cast("long")).alias(c) for c in both]
    )
    words = pairs.groupBy("word").agg(
        *[F.sum(F.signum(c).cast("long")).alias(c) for c in both],
        F.count("*").alias("shared"),
    )
    totals = words.agg(*[F.sum(c) for c in _COUNTS], F.count("*")).first()
    total = np.maximum([float(x or 0) for x in totals], 1.0)
    rows = (
        _units(words)
        .filter(F.greatest(*both) > discount)
        .orderBy(F.greatest(*both).desc(), "unit")
        .limit(most)
        .collect()
    )
    rows.sort(key=lambda row: row.unit)
    units = tuple(row.unit for row in rows)
    place = {unit: i for i, unit in enumerate(units)}
    own = np.array([[row.toxic, row.ordinary] for row in rows], dtype=float).reshape(-1, 2)
    shared = np.array([row.shared for row in rows], dtype=float)
    known = np.maximum(own - discount, 0) / total[:2]

    # What discounting takes from a beginning's members goes to the counts both classes share.
    root = len(units)
    up = np.array([place.get(row.parent, root) for row in rows], dtype=np.int64)
    taken = np.zeros((root + 1, 2))
    np.add.at(taken, up, known)
    crowd = np.concatenate((shared, [total[2]]))
    chance = np.vstack([known, np.ones((1, 2))])
    for i in sorted(range(root), key=lambda i: (units[i][-1] != "*", len(units[i]))):
        left = np.maximum(chance[up[i]] - taken[up[i]], 1e-12)
        chance[i] += left * min(1.0, shared[i] / crowd[up[i]])
    unit = np.maximum(chance, 1e-12)
    stems = np.array([name.endswith("*") for name in units] + [True])
    rare = np.maximum(chance - taken, 1e-12) / np.maximum(crowd, 1)[:, None]
    unit[stems] = rare[stems]

    heads = pairs.groupBy(F.col("before").alias("head")).agg(*[F.sum(c).alias(f"all_{c}") for c in both])
    frequent = (
        pairs.filter((F.greatest(*both) > pair_discount) & (F.col("before") != ""))
        .orderBy(F.greatest(*both).desc(), "before", "word")
        .limit(most)
        .join(heads, F.col("before") == F.col("head"))
        .collect()
    )
    found = sorted(
        (place[r.before] * root + place[r.word], r)
        for r in frequent
        if r.before in place and r.word in place
    )
    pair = np.array(
        [[max(r[c] - pair_discount, 0) / max(1, r[f"all_{c}"]) for c in both] for _, r in found]
    ).reshape(-1, 2)
    keys = np.array([key for key, _ in found], dtype=np.int64)
    rest = np.ones((root + 1, 2))
    if len(keys):
        np.subtract.at(rest, keys // root, pair)
    return ToxicityModel(units, unit, np.maximum(rest, 1e-6), keys, pair)


def _measure(texts: pa.Array, model: ToxicityModel, memo: Memo, window: int) -> np.ndarray:
    """Length-normalised ratio of each whole text, and the highest of a window of its words."""
    means, tops = [np.zeros(0)], [np.zeros(0)]
    for _, some in slices(texts):
        distinct, places, bounds = split_words(pc.utf8_lower(some))
        ids = memo.rows(distinct)[:, 0].astype(np.int64)[places]
        lengths = np.diff(bounds)
        ratios = model.ratios(ids, bounds[:-1][lengths > 0])
        means.append(per_text(ratios, bounds, np.add, 0) / np.maximum(lengths, 1))
        upto = np.concatenate(([0], np.cumsum(ratios)))
        at = np.arange(len(ratios))
        low = np.maximum(at + 1 - window, np.repeat(bounds[:-1], lengths))
        tops.append(per_text((upto[at + 1] - upto[low]) / window, bounds, np.maximum, 0))
    return np.column_stack([np.concatenate(means), np.concatenate(tops)])


def _features(docs: DataFrame, model: ToxicityModel, window: int, carried: str) -> DataFrame:
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(model.places(), 1, capacity=200_000)
        for batch in batches:
            found = _measure(batch.column(0), model, memo, window)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(found[:, 0]), pa.array(found[:, 1])],
                names=[carried, "mean_ratio", "top_ratio"],
            )

    picked = docs.select("text", F.col(carried).cast("long").alias(carried))
    return picked.mapInArrow(measure, f"{carried} long, mean_ratio double, top_ratio double")


def _logistic(rows: np.ndarray, marks: np.ndarray) -> tuple[float, float, float]:
    """Ridge logistic regression by Newton steps."""
    x = np.column_stack([rows, np.ones(len(rows))])
    ridge = np.diag([1e-3, 1e-3, 1e-6])
    beta = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (marks - p) - ridge @ beta
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, gradient)
        beta += step / max(1.0, np.abs(step).max() / 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(b) for b in beta)


def learn(
    docs: DataFrame,
    labels: DataFrame,
    trained: Column,
    per_class: int = 4000,
    discount: float = 3.0,
    pair_discount: float = 8.0,
    most: int = 100_000,
    window: int = 1,
) -> ToxicityModel:
    """Fit on the labelled rows that ``trained`` (on ``labels.doc_id``) admits.

    The bounded sample: ``per_class`` keys of each class with the lowest hash. Three of four folds
    are counted: a word's count in a class is the number of distinct words before it there, so
    copies of a text add nothing; what is discounted goes to the counts that both classes share.
    A pair's count is the number of distinct words before the pair; what ``pair_discount`` takes of a
    class's pairs goes to single words. A rare word backs off to the words that begin alike. At most
    ``most`` words and beginnings and as many pairs are kept, the most frequent ones; the others count as rare. The fourth fold sets
    the weights of the score. A key with several labels is toxic if any says so; null labels and
    keys are left out.
    """
    sample = F.broadcast(_sample(labels, trained, per_class))
    texts = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .filter(F.col("text").isNotNull())
        .join(sample, "doc_id")
    )
    folder = scratch_folder(docs.sparkSession)
    _contexts(texts.filter(F.col("fold") > 0)).write.parquet(folder)
    counts = docs.sparkSession.read.parquet(folder)
    model = _estimate(counts, discount, pair_discount, most)
    held = _features(texts.filter(F.col("fold") == 0), model, window, "toxic").collect()
    marks = np.array([row.toxic for row in held], dtype=float)
    if not len(marks) or marks.min() == marks.max():
        weights = (0.0, 0.0, 5.0 if len(marks) and marks.min() == 1 else -5.0)
    else:
        weights = _logistic(np.array([[r.mean_ratio, r.top_ratio] for r in held]), marks)
    return replace(model, weights=weights)


def score(docs: DataFrame, model: ToxicityModel, window: int = 1) -> DataFrame:
    """``doc_id, score, predicted`` of every whole text; only the text is an input.

    Each word's log-likelihood under the toxic model is compared with the ordinary one; the mean
    over the text and the highest mean over ``window`` neighbouring words give the score from
    0 to 1, and 0.5 or more predicts toxic. Null and empty texts have both means 0.
    ``doc_id`` may be null or repeated; other columns, whatever their names, are not read.
    """
    a, b, c = (F.lit(float(w)) for w in model.weights)
    logit = a * F.col("mean_ratio") + b * F.col("top_ratio") + c
    chance = 1 / (1 + F.exp(-F.least(F.greatest(logit, F.lit(-30.0)), F.lit(30.0))))
    return (
        _features(docs, model, window, "doc_id")
        .withColumn("score", chance)
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    )


def keep_ordinary(docs: DataFrame, model: ToxicityModel, window: int = 1) -> DataFrame:
    """The rows, all columns unchanged, whose ``text`` scores below 0.5.

    Only texts go to Python and only a flag comes back; the rows wait in the JVM.
    """
    *weights, bias = model.weights

    @F.arrow_udf("boolean")
    def ordinary(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memo = Memo(model.places(), 1, capacity=200_000)
        for some in texts:
            yield pa.array(_measure(some, model, memo, window) @ np.array(weights) + bias < 0)

    return docs.filter(ordinary("text"))
