"""Document quality from a linear-chain conditional random field over lines.

Every line has a state, good or bad. Its score comes from features of the line and of the
lines beside it, a transition weight ties neighbours together, and forward-backward gives each
line's probability of being good given the whole document. A document's quality is the mean of
these probabilities weighted by line length, put on a scale where 0.5 separates the labels.

The field is trained on a bounded sample of labelled documents (``PER_LABEL`` of each label),
on all their lines: lines start with their document's label; then lines of bad documents that
look like those of good ones are set right, and it is trained again. Gradients are sums over
documents; the driver takes them itself while the lines are few, and beyond that sums those
of tasks, so it never holds more than ``DRIVER_LINES``. Scores depend on the text alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starloom.llm.arrays import bound_batches, runs, utf8, words
from starloom.sinks.scratch import pin

#: Bound of the training sample: documents of each label.
PER_LABEL = 1500
#: Lines up to which the driver trains alone; lines worked on at a time, whole documents.
DRIVER_LINES, CHUNK_LINES = 400_000, 20_000
#: Lines of a document that are gone through one after the other.
RUN_LINES = 128

_upper = np.zeros(256, bool)
_upper[65:91] = True
_lower = np.zeros(256, bool)
_lower[97:123] = True
_digit = np.zeros(256, bool)
_digit[48:58] = True
_high = np.zeros(256, bool)
_high[128:] = True
_blank = np.zeros(256, bool)
_blank[[9, 11, 12, 13, 32]] = True
_mark = ~(_upper | _lower | _digit | _high | _blank)
_mark[10] = False
_stop = np.zeros(256, bool)
_stop[[44, 46]] = True  # comma, point
_bar = np.zeros(256, bool)
_bar[[124, 61, 59, 123, 125, 60, 62, 92]] = True  # table and markup signs
_WORD_BREAK = _blank.copy()
_WORD_BREAK[10] = True

#: Features of one line; a line has its own, those of its neighbours, and two border flags.
FEATURES = 14


def _per_line(flags: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return (sums[end] - sums[start]).astype(np.float64)


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, bytes, ``at``) of the lines of some documents; ``at[d]:at[d + 1]`` are those
    of document d. An empty document has one empty line."""
    docs = len(offsets) - 1
    breaks = np.flatnonzero(data == 10)
    of = np.searchsorted(offsets, breaks, "right") - 1
    start = np.concatenate([offsets[:-1], breaks + 1])
    owner = np.concatenate([np.arange(docs), of])
    order = np.lexsort((np.concatenate([np.full(docs, -1), np.arange(len(breaks))]), owner))
    start, doc = start[order], owner[order]
    at = np.searchsorted(doc, np.arange(docs + 1))
    end = np.concatenate([start[1:] - 1, [len(data)]])
    end[at[1:] - 1] = offsets[1:]
    size = (end - start).astype(np.float64)
    share = 1.0 / np.maximum(size, 1)

    w = words(data, offsets, _WORD_BREAK)
    line = np.searchsorted(start, w.start, "right") - 1
    n = len(start)
    count = np.bincount(line, minlength=n).astype(np.float64)
    per = 1.0 / np.maximum(count, 1)
    again = np.zeros(len(line), bool)
    again[1:] = (w.hash[1:] == w.hash[:-1]) & (line[1:] == line[:-1])
    # Distinct words: equal hashes lie together within a line when sorted.
    folded = np.sort((line.astype(np.uint64) << np.uint64(40)) | (w.hash >> np.uint64(24)))
    fresh = np.ones(len(folded), bool)
    fresh[1:] = folded[1:] != folded[:-1]
    distinct = np.bincount((folded[fresh] >> np.uint64(40)).astype(np.int64), minlength=n)
    length = (w.end - w.start).astype(np.float64)
    marked = _mark[data[w.end - 1]] & ~_stop[data[w.end - 1]] if len(line) else np.zeros(0, bool)
    alone = _mark[data[w.start]] & (length <= 3) if len(line) else np.zeros(0, bool)
    # Lines that occur before in their document.
    sums = np.zeros(n + 1, np.uint64)
    if len(line):
        place = np.arange(len(line)) - np.searchsorted(line, line) + 1
        np.add.at(sums, line, w.hash * place.astype(np.uint64))
    key = np.stack([doc[: n].astype(np.uint64), sums[:n]], axis=1)
    ranks = np.lexsort((np.arange(n), key[:, 1], key[:, 0]))
    repeat = np.zeros(n)
    same = (key[ranks[1:]] == key[ranks[:-1]]).all(axis=1)
    repeat[ranks[1:]] = same & (count[ranks[1:]] > 0)

    x = np.stack(
        [
            np.log1p(size) / 5,
            np.log1p(count) / 4,
            _per_line(_upper[data], start, end) * share,
            _per_line(_digit[data], start, end) * share,
            _per_line(_mark[data] & ~_stop[data], start, end) * share * 5,
            _per_line(_stop[data], start, end) * per,
            _per_line(_bar[data], start, end) * per,
            np.bincount(line, again, n) * per,
            1 - distinct * per,
            (1 - distinct * per) * np.log1p(count) / 4,
            np.bincount(line, length, n) * per / 10,
            np.bincount(line, marked, n) * per,
            np.bincount(line, alone, n) * per,
            repeat,
        ],
        axis=1,
    )
    return x, size, at


def with_neighbours(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Features of each line, of the line before and of the line after, zero beyond the
    document, then flags of the first and the last line, and a constant."""
    n = len(x)
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    first, last = np.zeros(n), np.zeros(n)
    first[at[:-1]], last[at[1:] - 1] = 1, 1
    before[first > 0] = 0
    after[last > 0] = 0
    return np.column_stack([x, before, after, first, last, np.ones(n)])


def _step(prior: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Log sums over the state before: ``prior`` holds its weights (last axis), ``move`` those
    of going from it (last axis but one) to the next."""
    return np.logaddexp(
        prior[..., 0, None] + move[..., 0, :], prior[..., 1, None] + move[..., 1, :]
    )


def _step_back(move: np.ndarray, later: np.ndarray) -> np.ndarray:
    """The same from the other side: log sums over the state after."""
    return np.logaddexp(move[..., 0] + later[..., None, 0], move[..., 1] + later[..., None, 1])


def marginals(
    score: np.ndarray, at: np.ndarray, tie: np.ndarray
) -> tuple[np.ndarray, np.ndarray, float]:
    """(probability of good per line, expected transitions 2 x 2, sum of log partitions).

    ``score`` is the weight of good over bad per line, ``tie[a, b]`` that of state b after a.
    Documents are cut into runs of ``RUN_LINES``. The lines of a run multiply to one 2 x 2
    matrix; these tell what comes into each run from before and from behind. All runs take a
    step together, so a long document takes few steps more than many short ones.
    """
    lengths = np.diff(at)
    n = len(score)
    if not n:
        return np.zeros(0), np.zeros((2, 2)), 0.0
    # Weight of going from the state before a line to its own; before a document nothing counts.
    move = np.zeros((n, 2, 2)) + tie
    move[at[:-1]] = 0
    move[:, :, 1] += score[:, None]

    per_doc = -(-lengths // RUN_LINES)
    run_at = np.concatenate([[0], np.cumsum(per_doc)])
    doc = np.repeat(np.arange(len(lengths)), per_doc)
    place = np.arange(run_at[-1]) - run_at[doc]
    begin = at[doc] + place * RUN_LINES
    size = np.minimum(at[doc + 1] - begin, RUN_LINES)
    order = np.argsort(-size, kind="stable")
    steps = int(size[order[0]])
    active = np.searchsorted(-size[order], -np.arange(1, steps + 1), "right")  # runs at step t

    ahead = np.tile([0.0, -np.inf], (len(begin), 1))  # at the line before the run
    behind = np.zeros((len(begin), 2))  # at the run's last line
    most = int(per_doc.max())
    if most > 1:
        long = order[per_doc[doc[order]] > 1]
        more = np.searchsorted(-size[long], -np.arange(1, steps + 1), "right")
        product = np.zeros((len(begin), 2, 2))
        product[long] = move[begin[long]]
        for t in range(1, steps):
            here = long[: more[t]]
            product[here] = _step(product[here], move[begin[here] + t][:, None])
        for k in range(1, most):
            here = run_at[:-1][per_doc > k] + k
            ahead[here] = _step(ahead[here - 1], product[here - 1])
        for k in range(most - 1, 0, -1):
            here = run_at[:-1][per_doc > k] + k
            behind[here - 1] = _step_back(product[here], behind[here])

    forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
    for t in range(steps):
        here = order[: active[t]]
        line = begin[here] + t
        forward[line] = _step(ahead[here] if t == 0 else forward[line - 1], move[line])
    backward[begin + size - 1] = behind
    for t in range(steps - 2, -1, -1):
        line = begin[order[: active[t + 1]]] + t
        backward[line] = _step_back(move[line + 1], backward[line + 1])

    last = at[1:] - 1
    partition = np.logaddexp(forward[last, 0], forward[last, 1])
    after = np.ones(n, bool)
    after[at[:-1]] = False
    after = np.flatnonzero(after)  # lines with a line before
    whole = np.repeat(partition, lengths)[after]
    joint = forward[after - 1][:, :, None] + move[after] + backward[after][:, None, :]
    expected = np.exp(joint - whole[:, None, None]).sum(axis=0)
    both = forward + backward
    good = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -500, 500)))
    return good, expected, float(partition.sum())


@dataclass
class Field:
    """Trained weights: of features, of transitions, and of the scale of scores."""

    weight: np.ndarray
    tie: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def lines(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The probability of each line to be good."""
        return marginals(with_neighbours(x, at) @ self.weight, at, self.tie)[0]

    def quality(self, x: np.ndarray, size: np.ndarray, at: np.ndarray) -> np.ndarray:
        """A score per document, 0 to 1; 0 for a document without a visible character."""
        raw = _weighted(self.lines(x, at), size, at)
        score = 1 / (1 + np.exp(-(self.slope * _logit(raw) + self.shift)))
        return np.where(_visible(x, at), score, 0.0)


def _visible(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.add.reduceat(x[:, 1], at[:-1]) > 0 if len(at) > 1 else np.zeros(0, bool)


def _weighted(good: np.ndarray, size: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Means per document, weighted by bytes plus one."""
    if len(at) == 1:
        return np.zeros(0)
    return np.add.reduceat(good * (size + 1), at[:-1]) / np.add.reduceat(size + 1, at[:-1])


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


@dataclass
class Lines:
    """Lines of some documents, their bytes, and the documents' labels."""

    x: np.ndarray
    size: np.ndarray
    at: np.ndarray
    label: np.ndarray


def _states(part: Lines, rich: np.ndarray, before: np.ndarray | None) -> np.ndarray:
    """States that lines are trained to: their document's label, or set right by the weights
    of a round before."""
    own = np.repeat(part.label, np.diff(part.at)).astype(np.int64)
    if before is None:
        return own
    # Without ties a line speaks for itself and its neighbours' looks.
    alone = 1 / (1 + np.exp(-np.clip(rich @ before, -50, 50)))
    state = np.where((own == 0) & (alone > 0.5), 1, own)
    worst = np.add.reduceat(1 - state, part.at[:-1]) == 0
    for d in np.flatnonzero(worst & (part.label == 0)):
        state[part.at[d] + int(np.argmin(alone[part.at[d] : part.at[d + 1]]))] = 0
    return state


def _slope(part: Lines, parameters: np.ndarray, before: np.ndarray | None) -> np.ndarray:
    """Gradient of the likelihood of some documents, and their number of lines."""
    rich = with_neighbours(part.x, part.at)
    n, f = rich.shape
    state = _states(part, rich, before)
    pair = np.ones(n, bool)
    pair[part.at[:-1]] = False  # lines with a line before
    seen = np.zeros((2, 2))
    np.add.at(seen, (state[np.flatnonzero(pair) - 1], state[pair]), 1)
    good, expected, _ = marginals(rich @ parameters[:f], part.at, parameters[f:].reshape(2, 2))
    return np.concatenate([rich.T @ (state - good), (seen - expected).ravel(), [n]])


#: Runs a function over all parts and returns its results.
Each = Callable[[Callable[[Lines], np.ndarray]], list[np.ndarray]]


def _fit(each: Each, before: np.ndarray | None, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights that maximise the likelihood of the line states, with a penalty on their size
    (Adam on the exact gradient)."""
    f = 3 * FEATURES + 3
    parameters = np.zeros(f + 4)
    first, second = np.zeros_like(parameters), np.zeros_like(parameters)
    for k in range(1, rounds + 1):
        now = parameters.copy()
        total = np.sum(each(lambda part: _slope(part, now, before)), axis=0)
        slope = total[:-1] / total[-1] - 1e-3 * parameters
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        step = first / (1 - 0.9**k) / (np.sqrt(second / (1 - 0.99**k)) + 1e-8)
        parameters += 0.15 * min(1.0, 3 * (1 - k / (rounds + 1))) * step
    return parameters[:f], parameters[f:].reshape(2, 2)


def _scale(raw: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic scale on which 0.5 separates the labels, both labels
    counting alike."""
    z, slope, shift = _logit(raw), 1.0, 0.0
    weight = np.where(label == 1, 0.5 / max(1, label.sum()), 0.5 / max(1, (1 - label).sum()))
    for _ in range(400):
        gap = weight * (label - 1 / (1 + np.exp(-np.clip(slope * z + shift, -50, 50))))
        slope += 0.5 * (float((gap * z).sum()) - 0.01 * (slope - 1))
        shift += 0.5 * float(gap.sum())
    return max(0.05, slope), shift


def fit_field(each: Each) -> Field:
    """Train on documents with a label of 0 or 1 each."""
    weight, _ = _fit(each, None, 40)
    weight, tie = _fit(each, weight, 100)
    field = Field(weight, tie)
    scored = each(
        lambda part: np.stack(
            [_weighted(field.lines(part.x, part.at), part.size, part.at), part.label], axis=1
        )
    )
    raw, label = np.concatenate(scored).T
    field.slope, field.shift = _scale(raw, label)
    return field


def _parts(rows: Iterator[tuple[int, bytes, bytes]]) -> Iterator[Lines]:
    """(quality, features, sizes) of documents, some thousands of lines at a time."""
    held, lines = [], 0

    def part() -> Lines:
        x = [np.frombuffer(f, np.float32).reshape(-1, FEATURES) for _, f, _ in held]
        return Lines(
            np.concatenate(x).astype(np.float64),
            np.concatenate([np.frombuffer(s, np.float32) for _, _, s in held]).astype(np.float64),
            np.concatenate([[0], np.cumsum([len(p) for p in x])]),
            np.array([q for q, _, _ in held], np.int64),
        )

    for row in rows:
        held.append(row)
        lines += len(row[2]) // 4
        if lines >= CHUNK_LINES:
            yield part()
            held, lines = [], 0
    if held:
        yield part()


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(quality, text) to (quality, features, bytes) of each document's lines."""
    for batch in batches:
        features, sizes = [], []
        data, offsets = utf8(batch.column(1))
        for a, b in runs(offsets):
            x, size, at = line_features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            for d in range(b - a):
                lines = slice(at[d], at[d + 1])
                features.append(x[lines].astype(np.float32).tobytes())
                sizes.append(size[lines].astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(features, pa.binary()), pa.array(sizes, pa.binary())],
            ["quality", "features", "sizes"],
        )


def train(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Field:
    """Train on at most ``per_label`` labelled documents of each quality.

    Those with the smallest hash of their id are taken, which is the same choice every time
    and has nothing to do with their text. Labels that are not 0 or 1, ids that are null and
    ids with labels that disagree do not count. Without documents of both labels there is
    nothing to learn, and every text that shows something scores 0.5.
    """
    bound_batches(docs.sparkSession)
    known = (
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("_most"))
        .filter("quality = _most")
    )
    turn = F.xxhash64(F.col("doc_id").cast("string"), F.lit("train"))
    chosen = [
        known.filter(F.col("quality") == q)
        .orderBy(turn, "doc_id")
        .limit(per_label)
        .select("doc_id", "quality")
        for q in (0, 1)
    ]
    # At most 2 * per_label ids and numbers.
    sample = F.broadcast(chosen[0].union(chosen[1]).withColumnRenamed("doc_id", "_labelled"))
    rows = pin(
        docs.select("doc_id", "text")
        .join(sample, F.col("doc_id") == F.col("_labelled"))
        .select("quality", "text")
        .mapInArrow(_extracted, "quality int, features binary, sizes binary"),
        "lines",
    )
    # One row per label.
    counted = rows.groupBy("quality").agg(F.sum(F.octet_length("sizes") / 4).alias("lines")).collect()
    if len(counted) < 2:
        return Field(np.zeros(3 * FEATURES + 3), np.zeros((2, 2)))
    if sum(r["lines"] for r in counted) <= DRIVER_LINES:
        # Documents of like length lie together, as a part takes as many steps as its longest.
        own = sorted(rows.collect(), key=lambda r: (len(r["sizes"]), r["features"], r["quality"]))
        parts = list(_parts((r["quality"], r["features"], r["sizes"]) for r in own))
        return fit_field(lambda work: [work(part) for part in parts])

    def each(work: Callable[[Lines], np.ndarray]) -> list[np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            documents = (
                row
                for batch in batches
                for row in zip(*(batch.column(k).to_pylist() for k in range(3)))
            )
            for part in _parts(documents):
                found = work(part)
                data, width = found.astype(np.float64).tobytes(), found.shape[-1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([data], pa.binary()), pa.array([width], pa.int64()), pa.array([found.ndim], pa.int64())],
                    ["data", "width", "ndim"],
                )

        found = rows.mapInArrow(run, "data binary, width long, ndim long").collect()
        arrays = [np.frombuffer(r["data"], np.float64) for r in found]
        return [a if r["ndim"] == 1 else a.reshape(-1, r["width"]) for a, r in zip(arrays, found)]

    return fit_field(each)


def add_scores(docs: DataFrame, field: Field, name: str = "score", text: str = "text") -> DataFrame:
    """``docs`` plus the quality of its whole texts, 0 to 1. Null, empty and blank texts score
    0. Other columns pass through; one with the name of the score is replaced."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            data, offsets = utf8(batch)
            found = [
                field.quality(*line_features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))
                for a, b in runs(offsets)
            ]
            yield pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())

    bound_batches(docs.sparkSession)
    return docs.withColumn(name, score(text))


def held_out(key: str = "doc_id"):
    """Whether a document is kept from training: a third of all ids, by checksum."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 from 0.5 on)."""
    field = train(docs, labels.filter(~held_out()))
    scored = add_scores(docs.select("doc_id", "text"), field)
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
