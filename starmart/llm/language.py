"""Language identification by cross-parsing against suffix automata."""

from __future__ import annotations

from collections.abc import Iterator
from math import log2

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.words import Memo, kept, per_text, slices, split_words

UNKNOWN = "und"
# Of a shorter learning text, which knows few characters, phrases would cost too little.
_LEAST_CHARS = 256


def _letters(texts: pa.Array) -> pa.Array:
    """Lower-cased words; whatever is no letter becomes a blank."""
    return pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\p{L}]+", " ")


class SuffixAutomaton:
    """Recognises every substring of a text, walked from state 0."""

    def __init__(self, text: str):
        self.steps: list[dict[str, int]] = [{}]
        links, lengths, last = [-1], [0], 0
        for char in text:
            state = len(self.steps)
            self.steps.append({})
            links.append(0)
            lengths.append(lengths[last] + 1)
            at = last
            while at >= 0 and char not in self.steps[at]:
                self.steps[at][char] = state
                at = links[at]
            if at >= 0:
                found = self.steps[at][char]
                if lengths[found] == lengths[at] + 1:
                    links[state] = found
                else:
                    copy = len(self.steps)
                    self.steps.append(dict(self.steps[found]))
                    links.append(links[found])
                    lengths.append(lengths[at] + 1)
                    links[found] = links[state] = copy
                    while at >= 0 and self.steps[at].get(char) == found:
                        self.steps[at][char] = copy
                        at = links[at]
            last = state

    def phrases(self, text: str) -> int:
        """Number of longest matches that cover ``text`` from left to right.

        A character that the automaton has never seen is a phrase of its own.
        """
        steps, count, at = self.steps, 0, 0
        for char in text:
            step = steps[at].get(char)
            if step is None:
                count += at != 0
                step = steps[0].get(char)
                if step is None:
                    count += 1
                    step = 0
            at = step
        return count + (at != 0)


def learn(
    docs: DataFrame, trained: Column, per_language: int = 40, excerpt: int = 1500
) -> dict[str, str]:
    """A learning text per language.

    The bounded sample: texts of the rows that ``trained`` admits, whose language is not null, are cut into
    passages of ``excerpt`` characters from beginning to end; of those with a letter, the ``per_language``
    distinct ones of each language with the lowest hash are taken, whole passages before the shorter
    rests of longer texts. Passages that differ only in case or in what is no letter count as one.
    Lengths may differ between languages: phrases are weighed by the length of the learning text.
    """
    begins = F.sequence(F.lit(1), F.greatest(F.length("text"), F.lit(1)), F.lit(excerpt))
    rows = docs.filter(trained & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.select("lang", "text", F.explode(begins).alias("_at"))
    rows = rows.select("lang", "_at", F.col("text").substr(F.col("_at"), F.lit(excerpt)).alias("text"))
    plain = F.trim(F.regexp_replace(F.lower("text"), r"[^\p{L}]+", " "))
    rest = (F.col("_at") > 1) & (F.length("text") < excerpt)
    rows = rows.select("lang", "text", plain.alias("_plain"), rest.alias("_rest"))
    rows = rows.filter(F.col("_plain") != "")
    rows = rows.select("lang", "text", "_rest", F.xxhash64("_plain").alias("_draw"))

    def lowest(drawn: DataFrame, *group: str) -> DataFrame:
        order = Window.partitionBy("lang", *group).orderBy("_rest", "_draw")
        numbered = drawn.withColumn("_place", F.row_number().over(order))
        return numbered.filter(F.col("_place") <= per_language).drop("_place")

    # A common language is narrowed in parts first.
    part = F.pmod(F.col("_draw"), F.lit(64))
    distinct = rows.groupBy("lang", "_draw").agg(F.min("_rest").alias("_rest"))
    drawn = lowest(lowest(distinct.withColumn("_part", part), "_part"))
    chosen = drawn.select("lang", "_draw")
    found = rows.join(chosen, ["lang", "_draw"], "left_semi").groupBy("lang", "_draw")
    texts: dict[str, set[str]] = {}
    for row in found.agg(F.min("text").alias("text")).collect():
        texts.setdefault(row.lang, set()).add(" ".join(_letters(pa.array([row.text]))[0].as_py().split()))
    return {lang: f" {' '.join(sorted(texts[lang]))} " for lang in sorted(texts)}


def _parser(learned: tuple[tuple[str, str], ...]) -> Memo:
    """Phrases of a word in each language; the worker's automata, one per language."""

    def make() -> Memo:
        automata = [SuffixAutomaton(text) for _, text in learned]

        def parse(word: str) -> list[int]:
            return [automaton.phrases(f" {word} ") for automaton in automata]

        return Memo(parse, len(automata), capacity=300_000)

    return kept(("phrases", learned), make)


def _predict(
    texts: pa.Array, models: tuple[tuple[str, str], ...], weights: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Winner of each text (the number of languages for none) and its score."""
    winners, scores = [np.zeros(0, dtype=np.int64)], [np.zeros(0)]
    for _, some in slices(texts):
        distinct, places, bounds = split_words(_letters(some))
        phrases = _parser(models).rows(distinct)[places]
        bits = per_text(phrases, bounds, np.add, 0) * weights
        ordered = np.sort(bits, axis=1)
        sure = np.ones(len(bits))
        if len(models) > 1:
            sure = 1 - ordered[:, 0] / np.maximum(ordered[:, 1], 1e-9)
        letters = np.diff(bounds) > 0
        winners.append(np.where(letters, np.argmin(bits, axis=1), len(models)))
        scores.append(np.where(letters, sure, 0.0))
    return np.concatenate(winners), np.concatenate(scores)


def _weights(learned: dict[str, str]) -> np.ndarray:
    return np.array([log2(max(_LEAST_CHARS, len(text))) for text in learned.values()])


def identify(docs: DataFrame, learned: dict[str, str]) -> DataFrame:
    """``doc_id, lang_pred, score`` of every whole text.

    A text is lower-cased and cut into runs of letters; each of them, with the blanks around it, is
    parsed into the longest substrings of each language's learning text. The language with the
    fewest phrases wins, normalised as bits per character: phrases times log2 of the learning
    text's length (256 at least), by the length of the text; ties go to the first language by code point.
    ``score`` is 1 less the winner's share of the runner-up's bits (1 with one language).

    A null text, one without a letter, or any text when nothing was learned is ``und`` with score 0.
    ``doc_id`` may be null or repeated; other columns, whatever their names, are not read.
    """
    models, weights = tuple(learned.items()), _weights(learned)
    names = np.array([*learned, UNKNOWN], dtype=object)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            winners, scores = _predict(batch.column(1), models, weights)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names[winners], pa.string()), pa.array(scores)],
                names=["doc_id", "lang_pred", "score"],
            )

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    if not models:
        return keyed.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    return keyed.mapInArrow(predict, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, learned: dict[str, str]) -> DataFrame:
    """The rows, all columns unchanged, whose ``text`` has a language.

    Only texts go to Python and only a flag comes back; the rows wait in the JVM.
    """
    models, weights = tuple(learned.items()), _weights(learned)

    @F.arrow_udf("boolean")
    def identified(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for some in texts:
            yield pa.array(_predict(some, models, weights)[0] < len(models))

    return docs.filter(identified("text"))
