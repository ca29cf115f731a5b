"""Language-model scores from Brown classes: a class after a class, a word of its class.

Frequent words and endings are clustered by exchange; then every other word that occurs often
enough moves, in tasks of its own, to the class that its neighbours in all learning texts speak for.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.words import Memo, per_text, slices, split_words
from starmart.plans import scratch_folder

SUFFIX = 3
_DISCOUNT = 0.5
_PRIOR = 20.0
# A row per run of texts; few rows a file, since a row holds some megabytes.
_ROWS_PER_FILE = 2
# A run asks once for each of its words: the longer it is, the fewer rows are asked for.
_RUN_BYTES = 16 << 20
# Rows of contexts that a task merges, and runs that may name one word in a merge.
_MERGE_ROWS, _MERGE_RUNS = 400_000, 512
_SLICES = (
    "slice long, doc_ids array<long>, held array<boolean>, bounds binary, codes binary,"
    " words array<string>, counts array<long>"
)
_SCORES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("held_out", T.BooleanType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()),
        T.StructField("train_tokens", T.LongType()),
        T.StructField("base_score", T.DoubleType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def _repeat(bounds: np.ndarray, flags: np.ndarray) -> np.ndarray:
    return np.repeat(flags, np.diff(bounds))


def _packed(codes: np.ndarray) -> bytes:
    """Compressed by place value: all lowest bytes, then all second ones, and so on."""
    return zstandard.compress(codes.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), 3)


def _unpacked(codes: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(codes), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one: a row is a run of texts and holds some megabytes."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _code(docs: DataFrame, held_out: Column, folder: str) -> DataFrame:
    """All texts as numbers, a run of texts a row, with the run's own words and their counts
    in learning texts."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, texts in slices(batch.column(1), _RUN_BYTES):
                distinct, places, bounds = split_words(pc.ascii_lower(texts))
                rows = slice(low, low + len(texts))
                held = batch.column(2).to_numpy(zero_copy_only=False)[rows].astype(bool)
                learned = places[~_repeat(bounds, held)]
                counts = np.bincount(learned, minlength=len(distinct))
                row = {
                    "slice": [uuid4().int >> 65],
                    "doc_ids": [batch.column(0).slice(low, len(texts)).to_pylist()],
                    "held": [held.tolist()],
                    "bounds": [bounds.astype("<i8").tobytes()],
                    "codes": [_packed(places)],
                    "words": [distinct],
                    "counts": [counts],
                }
                kinds = {
                    "slice": pa.int64(),
                    "doc_ids": pa.list_(pa.int64()),
                    "held": pa.list_(pa.bool_()),
                    "bounds": pa.binary(),
                    "codes": pa.binary(),
                    "words": pa.list_(pa.string()),
                    "counts": pa.list_(pa.int64()),
                }
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row[name], kind) for name, kind in kinds.items()], names=list(kinds)
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text"), held_out)
    coded = rows.mapInArrow(code, _SLICES)
    path = f"{folder}/slices"
    coded.write.option("maxRecordsPerFile", _ROWS_PER_FILE).option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.parquet(path)


@dataclass(frozen=True)
class ClassModel:
    """Class of every word, transitions between classes, and what a class emits.

    ``types`` are frequent words and frequent endings (``"*ing"``); ``classes`` has the class of
    each, then that of words with another ending, then that of the end of a text, which stands alone and
    also precedes every text. Words that are no type have classes of their own, kept in files.
    ``follow`` is log10 P(class | class before); ``size`` and ``variety``
    are the learning tokens and distinct words of each class.
    """

    types: tuple[str, ...]
    classes: np.ndarray
    follow: np.ndarray
    size: np.ndarray
    variety: np.ndarray
    tokens: int
    distinct: int
    texts: int

    def emit(self, classes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """log10 P(word | class) of words with their counts; 0 stands for any unknown word."""
        size, variety = self.size[classes], self.variety[classes]
        known = np.where(counts > 0, counts - _DISCOUNT, _DISCOUNT * variety + 1)
        return np.log10(known / (size + 1))


def _finder(types: tuple[str, ...]) -> Callable[[str], int]:
    """Type of a word: its own, that of its ending, or the one for all others."""
    place = {name: i for i, name in enumerate(types)}

    def find(word: str) -> int:
        known = place.get(word)
        return known if known is not None else place.get(f"*{word[-SUFFIX:]}", len(place))

    return find


def exchange(pairs: np.ndarray, classes: int, sweeps: int = 8) -> np.ndarray:
    """Brown classes of types from counts of adjacent types, by exchange clustering.

    The last type (the end of a text) keeps a class of its own, the last. The other types, most
    frequent first, are dealt to the classes in turn; then each moves to the class with which
    the mutual information of adjacent classes is highest, until no type moves or ``sweeps`` are
    done. Ties go to the lowest class.
    """
    count = len(pairs)
    classes = max(1, min(classes, count - 1))
    order = np.argsort(-(pairs.sum(1) + pairs.sum(0))[:-1], kind="stable")
    of = np.full(count, classes, dtype=np.int64)
    of[order] = np.arange(count - 1) % classes
    pairs = pairs.astype(np.float64)

    def h(x: np.ndarray) -> np.ndarray:
        return x * np.log(np.maximum(x, 1))

    def fold(rows: np.ndarray) -> np.ndarray:
        """Sums of the last axis by class."""
        return np.array([np.bincount(of, row, minlength=classes + 1) for row in np.atleast_2d(rows)])

    table = fold(fold(pairs).T).T
    for _ in range(sweeps):
        moved = 0
        for t in order:
            own, here = pairs[t, t], of[t]
            after, before = fold(pairs[t])[0], fold(pairs[:, t])[0]
            after[here] -= own
            before[here] -= own
            table[here, :] -= after
            table[:, here] -= before
            table[here, here] -= own
            old = h(table)
            into = h(table + before[:, None]) - old
            out = (h(table.T + after[:, None]) - old.T)
            corner = np.diag(table)
            gain = into.sum(0) - np.diag(into) + out.sum(0) - np.diag(out)
            gain += h(corner + before + after + own) - h(corner)
            left, right = table.sum(1), table.sum(0)
            gain -= h(left + after.sum() + own) - h(left) + h(right + before.sum() + own) - h(right)
            best = int(np.argmax(gain[:classes]))
            if gain[best] <= gain[here] + 1e-9:
                best = here
            moved += best != here
            of[t] = best
            table[best, :] += after
            table[:, best] += before
            table[best, best] += own
        if not moved:
            break
    return of


def _types(listed: DataFrame, words: int, endings: int) -> tuple[dict[str, int], tuple[str, ...]]:
    """The most frequent words with their counts; those and the most frequent endings.

    ``listed`` has ``word, n`` of each run. Words are added up by 64-bit names, which are shorter to
    shuffle; equal counts at the border go to the lowest name.
    """
    name = F.xxhash64("word")
    totals = listed.groupBy(name.alias("name")).agg(F.sum("n").alias("n"))
    names = [r.name for r in totals.orderBy(F.col("n").desc(), "name").limit(words).collect()]
    chosen = listed.filter(name.isin(names)).groupBy("word").agg(F.sum("n").alias("n"))
    frequent = {r.word: r.n for r in chosen.orderBy(F.col("n").desc(), "word").limit(words).collect()}
    sums = listed.groupBy(_ending().alias("ending")).agg(F.sum("n").alias("n"))
    rows = sums.orderBy(F.col("n").desc(), "ending").limit(endings).collect()
    return frequent, tuple(dict.fromkeys([*frequent, *(r.ending for r in rows)]))


def _ending() -> Column:
    return F.concat(F.lit("*"), F.substring("word", -SUFFIX, SUFFIX))


def _sequence(row: dict, kinds: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The kinds of a run's tokens, with an end after each text, and where ends lie."""
    bounds = np.frombuffer(row["bounds"], "<i8")
    return np.insert(kinds[_unpacked(row["codes"])], bounds[1:], end), bounds[1:] + np.arange(len(bounds) - 1)


def _learned(row: dict) -> np.ndarray:
    """Which tokens, ends too, belong to learning texts."""
    bounds = np.frombuffer(row["bounds"], "<i8")
    return np.repeat(~np.array(row["held"], dtype=bool), np.diff(bounds) + 1)


def _pairs(runs: DataFrame, kinds_of: Callable[[], Callable[[dict], np.ndarray]], width: int) -> np.ndarray:
    """How often each kind follows each kind in the learning texts; the last kind is the end.

    ``kinds_of()``, called once a task, gives what finds the kinds of a run's words.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = kinds_of()
        for row in _rows(batches):
            sequence, _ = _sequence(row, kinds(row), width - 1)
            before = np.concatenate(([width - 1], sequence[:-1]))
            found = np.bincount((before * width + sequence)[_learned(row)], minlength=width * width)
            some = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(some), pa.array(found[some])], names=["pair", "n"]
            )

    pairs = runs.mapInArrow(count, "pair long, n long")
    table = np.zeros(width * width)
    for row in pairs.groupBy("pair").agg(F.sum("n").alias("n")).collect():
        table[row.pair] = row.n
    return table.reshape(width, width)


def _type_kinds(types: tuple[str, ...]) -> Callable[[], Callable[[dict], np.ndarray]]:
    def start() -> Callable[[dict], np.ndarray]:
        memo = Memo(_finder(types), 1, capacity=300_000)
        return lambda row: memo.rows(row["words"])[:, 0].astype(np.int64)

    return start


def _seen(keys: np.ndarray, counts: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Contexts and counts of each word, and which word; keys are word << 16 | context, sorted.

    Two bytes an entry, context and count: a count above 255 takes several entries.
    """
    times = -(-counts // 255)
    word, context = np.repeat(keys >> 16, times), np.repeat(keys & 0xFFFF, times)
    entries = np.full((len(word), 2), 255, dtype=np.uint8)
    entries[:, 0] = context
    entries[np.cumsum(times) - 1, 1] = counts - 255 * (times - 1)
    heads = np.flatnonzero(np.diff(word, prepend=-1))
    offsets = 2 * np.append(heads, len(word)).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(entries)]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(heads), buffers), word[heads]


def _contexts(
    runs: DataFrame, types: tuple[str, ...], frequent: frozenset, of: np.ndarray, parts: int
) -> DataFrame:
    """``word, part, seen``: of each run's words that are no type, the classes beside them.

    A context is the class before or (number of classes + the class after). Runs are dealt to ``parts``.
    """
    end = int(of[-1])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = _type_kinds(types)()
        for row in _rows(batches):
            classes, ends = _sequence(row, of[kinds(row)], end)
            other = np.array([word not in frequent for word in row["words"]], dtype=bool)
            codes = np.insert(_unpacked(row["codes"]).astype(np.int64), np.frombuffer(row["bounds"], "<i8")[1:], 0)
            inner = _learned(row)
            inner[ends] = False
            inner = np.flatnonzero(inner)
            inner = inner[other[codes[inner]]]
            before, after = classes[inner - 1], classes[inner + 1]
            before[inner == 0] = end
            at = codes[inner] << 16
            keys = np.concatenate((at | before, at | (end + 1 + after)))
            del classes, codes, inner, before, after, at  # some hundred MB before sorting
            keys.sort()
            heads = np.flatnonzero(np.diff(keys, prepend=-1))
            counts, keys = np.diff(np.append(heads, len(keys))), keys[heads]
            seen, at = _seen(keys, counts)
            words = pa.array(row["words"], pa.string()).take(pa.array(at))
            for low in range(0, len(at), 65536):
                part = slice(low, low + 65536)
                yield pa.RecordBatch.from_arrays(
                    [
                        words[part],
                        pa.array(np.full(len(words[part]), row["slice"] % parts, dtype=np.int32)),
                        seen[part].cast(pa.binary()),
                    ],
                    names=["word", "part", "seen"],
                )

    columns = runs.select("slice", "held", "bounds", "codes", "words")
    return columns.mapInArrow(find, "word string, part int, seen binary")


def _merged(table: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words; word, context and count of each sum, by word."""
    encoded = table.column("word").combine_chunks().dictionary_encode()
    seen = table.column("seen").to_pylist()
    sizes = np.array([len(x) // 2 for x in seen], dtype=np.int64)
    entries = np.frombuffer(b"".join(seen), np.uint8).reshape(-1, 2)
    keys = np.repeat(np.asarray(encoded.indices).astype(np.int64), sizes) << 16 | entries[:, 0]
    keys, at = np.unique(keys, return_inverse=True)
    counts = np.bincount(at, entries[:, 1], minlength=len(keys)).astype(np.int64)
    return encoded.dictionary, keys >> 16, keys & 0xFFFF, counts


def affinity(table: np.ndarray) -> np.ndarray:
    """What a neighbour adds to each class: the change of the classes' mutual information.

    Row ``c`` stands for class ``c`` before a word, row ``number of classes + c`` for one after it.
    First order in the moved counts, so exact in the limit of words that are small beside classes.
    """
    filled = table + 0.5
    gain = np.log(filled) - np.log(filled.sum(1, keepdims=True)) - np.log(filled.sum(0, keepdims=True))
    return np.vstack([gain, gain.T])


def _lexicon(contexts: DataFrame, rows: int, parts: int, model: dict, least: int) -> DataFrame:
    """``word, n, class`` of every learned word that is no type.

    A word with ``least`` occurrences takes the class with the highest gain over all of its neighbours
    (one exchange sweep, all words at once; ties to the lowest class), a rarer one that of its
    ending. A word of very many runs is merged in parts first.
    """
    types, of, gain = model["types"], model["of"], model["gain"]
    buckets = max(1, -(-rows // _MERGE_ROWS))
    bucket = F.pmod(F.xxhash64("word"), F.lit(buckets)).alias("bucket")

    def merge(table: pa.Table) -> pa.Table:
        words, word, context, counts = _merged(table)
        seen, at = _seen(word << 16 | context, counts)
        return pa.table({"word": words.take(pa.array(at)), "seen": seen.cast(pa.binary())})

    def assign(table: pa.Table) -> pa.Table:
        words, word, context, counts = _merged(table)
        total = gain.shape[1]
        n = np.bincount(word, counts * (context < total), minlength=len(words)).astype(np.int64)
        best = np.empty(len(words), dtype=np.int32)
        for low in range(0, len(words), 20_000):
            high = min(low + 20_000, len(words))
            here = slice(*np.searchsorted(word, [low, high]))
            near = np.zeros((high - low, 2 * total))
            near[word[here] - low, context[here]] = counts[here]
            # The end of a text keeps its class for itself, the last.
            best[low:high] = (near @ gain)[:, : max(1, total - 1)].argmax(1)
        rare, find = np.flatnonzero(n < least), _finder(types)
        best[rare] = of[[find(word) for word in words.take(pa.array(rare)).to_pylist()]]
        return pa.table({"word": words, "n": pa.array(n), "class": pa.array(best)})

    if parts > 1:
        contexts = contexts.groupBy(bucket, "part").applyInArrow(merge, "word string, seen binary")
    return contexts.select("word", "seen").groupBy(bucket).applyInArrow(assign, "word string, n long, class int")


def score_texts(
    docs: DataFrame,
    held_out: Column,
    words: int = 400,
    endings: int = 110,
    classes: int = 40,
    least: int = 3,
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every text.

    Tokens are the words of the text (A-Z lowered, cut at ASCII white space) and one end. Learned
    from all rows that ``held_out`` doesn't mark. ``base_score`` is the add-one unigram model;
    ``score`` sums log10 P(class | class before) + log10 P(word | class), transitions smoothed by
    the classes' own shares; unknown words, as one symbol, get what discounting leaves in their class.

    Classes are built from ``words`` frequent words and ``endings`` frequent endings by exchange
    clustering. Then every learned word that occurs ``least`` times moves to the class that
    its neighbours in all learning texts speak for, however many such words there are. Rarer and
    unknown words belong where their ending does. Transitions are counted after that, over all
    learning texts.

    ``classes`` is at most 127, since a context is a byte. Words, their counts, contexts and classes stay distributed: texts are coded by runs of some megabytes,
    and each run asks for the counts and classes of its own distinct words. Null texts are empty and hold the end
    alone. ``doc_id`` may be null or repeated; other columns, whatever their names, are not read. Without
    any learning text all words are unknown. An empty table gives no rows.
    """
    if not 0 < classes < 128:
        raise ValueError("classes must lie between 1 and 127")
    spark, folder = docs.sparkSession, scratch_folder(docs.sparkSession)
    runs = _code(docs, F.coalesce(held_out, F.lit(False)), folder)
    listed = runs.select(F.explode(F.arrays_zip("words", "counts")).alias("_e"))
    listed = listed.select(F.col("_e.words").alias("word"), F.col("_e.counts").alias("n")).filter("n > 0")
    learned = F.size(F.filter("held", lambda x: ~x))
    sums = runs.agg(F.sum(learned), F.count("*"), F.sum(F.size("words"))).first()
    texts, run_count, rows = (int(x or 0) for x in sums)

    frequent, types = _types(listed, words, endings)
    coded = runs.select("held", "bounds", "codes", "words")
    pairs = _pairs(coded, _type_kinds(types), len(types) + 2)
    of = exchange(pairs, classes)
    total = int(of[-1]) + 1
    table = np.zeros((total, total))
    np.add.at(table, (of[:, None], of[None, :]), pairs)
    seeds = {"types": types, "of": of, "gain": affinity(table)}
    parts = max(1, -(-run_count // _MERGE_RUNS))
    contexts = _contexts(runs, types, frozenset(frequent), of, parts)
    place = {name: i for i, name in enumerate(types)}
    common = spark.createDataFrame(
        [(word, n, int(of[place[word]])) for word, n in frequent.items()],
        "word string, n long, class int",
    )
    _lexicon(contexts, rows, parts, seeds, least).union(common).write.parquet(f"{folder}/lexicon")
    lexicon = spark.read.parquet(f"{folder}/lexicon")

    size, variety = np.zeros(total), np.zeros(total)
    for row in lexicon.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        size[row["class"]], variety[row["class"]] = row.n, row.v

    # What is not in the lexicon was never learned: its ending decides.
    by_ending = [F.lit(x) for name, i in place.items() if name[:1] == "*" for x in (name, int(of[i]))]
    other = F.lit(int(of[len(types)]))
    ending = F.coalesce(F.create_map(*by_ending)[_ending()], other) if by_ending else other
    asked = runs.select("slice", F.posexplode("words").alias("place", "word"))
    # Count and class in one number: fewer bytes to shuffle.
    answer = F.shiftleft(F.coalesce("n", F.lit(0)), 16).bitwiseOR(F.coalesce("class", ending).cast("long"))
    answers = asked.join(lexicon, "word", "left").select("slice", "place", answer.alias("answer"))

    def answered(run: pa.Table, answer: pa.Table) -> pa.Table:
        places = answer.column("place").to_numpy()
        n, kinds = np.zeros(len(places), dtype="<i8"), np.zeros(len(places), dtype="<i4")
        n[places] = answer.column("answer").to_numpy() >> 16
        kinds[places] = answer.column("answer").to_numpy() & 0xFFFF
        for name, values in (("n", n), ("kinds", kinds)):
            run = run.append_column(name, pa.array([values.tobytes()], pa.binary()))
        return run.drop_columns(["slice"])

    again = spark.read.parquet(f"{folder}/slices")  # apart from the plan that joins its words
    by_run = again.select("slice", "doc_ids", "held", "bounds", "codes").groupBy("slice")
    classed = by_run.cogroup(answers.groupBy("slice")).applyInArrow(
        answered,
        "doc_ids array<long>, held array<boolean>, bounds binary, codes binary, n binary, kinds binary",
    )
    path = f"{folder}/classed"
    classed.write.option("maxRecordsPerFile", _ROWS_PER_FILE).option("compression", "zstd").parquet(path)
    classed = spark.read.parquet(path)

    def own_kinds() -> Callable[[dict], np.ndarray]:
        return lambda row: np.frombuffer(row["kinds"], "<i4").astype(np.int64)

    table = _pairs(classed.select("held", "bounds", "codes", "kinds"), own_kinds, total)
    share = (table.sum(0) + 1) / (table.sum() + total)
    follow = np.log10((table + _PRIOR * share) / (table.sum(1, keepdims=True) + _PRIOR))
    tokens, distinct = int(size.sum()) + texts, int(variety.sum()) + (texts > 0)
    model = ClassModel(types, of, follow, size, variety, tokens, distinct, texts)
    return classed.mapInArrow(_scorer(model), _SCORES)


def _scorer(model: ClassModel) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    end = len(model.size) - 1

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            codes, bounds = _unpacked(row["codes"]), np.frombuffer(row["bounds"], "<i8")
            n = np.frombuffer(row["n"], "<i8")
            kinds = np.frombuffer(row["kinds"], "<i4").astype(np.int64)
            emitted = np.insert(model.emit(kinds, n)[codes], bounds[1:], 0.0)
            sequence = np.insert(kinds[codes], bounds[1:], end)
            before = np.concatenate(([end], sequence[:-1]))
            ends = bounds + np.arange(len(bounds))
            count = np.insert(n[codes], bounds[1:], model.texts)
            base = np.log10((count + 1) / (model.tokens + model.distinct + 1))
            scores = emitted + model.follow[before, sequence]
            columns = [
                pa.array(row["doc_ids"], pa.int64()),
                pa.array(row["held"], pa.bool_()),
                pa.array(np.diff(ends)),
                pa.array(per_text(count > 0, ends, np.add, 0).astype(np.int64)),
                pa.array(np.full(len(ends) - 1, model.tokens)),
                pa.array(per_text(base, ends, np.add, 0)),
                pa.array(per_text(scores, ends, np.add, 0)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=_SCORES.names)

    return score
