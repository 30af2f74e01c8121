"""Operator 2: language of whole texts by a byte convolutional network.

The network reads windows of 256 bytes. Filters of widths 2, 3 and 4 slide over the bytes (one
weight per filter, place and byte value), the largest response of each filter in the window goes
through a rectifier and a softmax layer. It is trained in numpy on the driver, with Adam, on
windows of a bounded sample: at most ``SAMPLE`` labelled documents per language, drawn by hash,
and one window of each, in ``STEPS`` steps. The trained weights have a fixed size and are sent to the tasks, where
every byte of every text is read: a text is cut into windows, the windows run in batches, and the
text's probabilities are the mean of its windows' by their length.

For speed the filters are applied as tables over byte pairs, two look-ups per byte.

Defined cases: the prediction is ``und`` with score 0 for a null text or one without a letter,
and for every text if no labelled document may be learned from. Rows are predicted one by one, so
repeated rows and null ids are kept. Null languages are not learned. Ties between languages go to
the first by code point. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm.shared import arrow_map
from threadloom.llm.words import CHUNK_BYTES, chunks
from threadloom.sources.tables import stage

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
SAMPLE = 1500
STEPS = 300
BATCH = 128
# languages whose counts are broadcast; more of them are joined by a shuffle
FEW = 10_000
UNKNOWN = "und"


class Network:
    """Byte filters, max pooling, rectifier, softmax."""

    def __init__(self, languages: list[str], seed: int = 11):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.filters = [rng.normal(0, 0.15, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        for f in self.filters:
            f[:, 0] = 0  # bytes after the end of a text
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.out = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages))).astype(np.float32)
        self.out_bias = np.zeros(len(languages), np.float32)
        self._tables()

    def _tables(self) -> None:
        """Responses by byte pair: the first two places of every width, and the places after."""
        w2, w3, w4 = self.filters
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, FILTERS)
        self.head = np.concatenate([pair(w2[0], w2[1]), pair(w3[0], w3[1]), pair(w4[0], w4[1])], axis=1)
        third = np.repeat(w3[2], 256, axis=0)
        self.tail = np.concatenate([third, pair(w4[2], w4[3])], axis=1)

    def responses(self, windows: np.ndarray) -> np.ndarray:
        """[window, place, filter]; ``windows`` are bytes with 3 places of padding at the end."""
        pairs = windows[:, :-1].astype(np.int32) << 8
        pairs |= windows[:, 1:]
        places = windows.shape[1] - 3
        out = self.head[pairs[:, :places]]
        out[:, :, FILTERS:] += self.tail[pairs[:, 2 : places + 2]]
        return out

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        return self.responses(windows).max(axis=1)

    def probabilities(self, pooled: np.ndarray) -> np.ndarray:
        z = np.maximum(pooled + self.bias, 0) @ self.out + self.out_bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def train(self, windows: np.ndarray, labels: np.ndarray, steps: int = STEPS, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        state = [[np.zeros_like(p), np.zeros_like(p)] for p in (*self.filters, self.bias, self.out, self.out_bias)]
        step = 0
        share = np.bincount(labels, minlength=len(self.languages)).astype(np.float32)
        weight = (len(labels) / np.maximum(share, 1) / len(self.languages))[labels]
        while step < steps:
            order = rng.permutation(len(labels))
            for at in range(0, len(order), BATCH)[: steps - step]:
                rows = order[at : at + BATCH]
                step += 1
                self._update(windows[rows], labels[rows], weight[rows], state, step)
                self._tables()

    def _update(self, windows, labels, weight, state, step, rate=0.004) -> None:
        n = len(labels)
        all_responses = self.responses(windows)
        place = all_responses.argmax(axis=1)
        pooled = np.take_along_axis(all_responses, place[:, None, :], axis=1)[:, 0]
        hidden = np.maximum(pooled + self.bias, 0)
        wrong = self.probabilities(pooled)
        wrong[np.arange(n), labels] -= 1
        wrong *= (weight / n)[:, None]
        back = (wrong @ self.out.T) * (hidden > 0)
        slopes = []
        rows = np.arange(n)[:, None]
        for k, width in enumerate(WIDTHS):
            mine = slice(k * FILTERS, (k + 1) * FILTERS)
            slope = np.zeros_like(self.filters[k])
            for offset in range(width):
                byte = windows[rows, place[:, mine] + offset]
                np.add.at(slope[offset], (byte, np.arange(FILTERS)[None, :]), back[:, mine])
            slope[:, 0] = 0
            slopes.append(slope)
        slopes += [back.sum(axis=0), hidden.T @ wrong, wrong.sum(axis=0)]
        for value, slope, (mean, square) in zip((*self.filters, self.bias, self.out, self.out_bias), slopes, state):
            mean += 0.1 * (slope - mean)
            square += 0.01 * (slope * slope - square)
            value -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-7)


def windows_of(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all windows (padded), each one's text, and the bytes of the text it has."""
    size = np.diff(offsets)
    count = -(-size // window)
    text = np.repeat(np.arange(len(size)), count)
    number = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[:-1][text] + number * window
    have = np.minimum(window, offsets[1:][text] - start)
    place = np.arange(window + 3)
    padded = np.concatenate([data, np.zeros(window + 3, np.uint8)])
    out = padded[start[:, None] + place]
    out[place >= have[:, None]] = 0
    return out, text, have


def _predict(batches: Iterator, network: Network | None) -> Iterator:
    for batch in batches:
        for texts in chunks(batch.column(1), CHUNK_BYTES // 2):
            lettered = batch.column(0).slice(texts.first, len(texts)).fill_null(False).to_numpy(zero_copy_only=False)
            label = np.full(len(texts), UNKNOWN, object)
            score = np.zeros(len(texts))
            if network is not None and lettered.any():
                total = np.zeros((len(texts), len(network.languages)))
                windows, text, have = windows_of(texts.data, texts.offsets)
                for at in range(0, len(text), 256):
                    part = slice(at, at + 256)
                    p = network.probabilities(network.pooled(windows[part])) * have[part, None]
                    np.add.at(total, text[part], p)
                total /= np.maximum(total.sum(axis=1, keepdims=True), 1e-30)
                best = total.argmax(axis=1)
                label[lettered] = np.array(network.languages, object)[best[lettered]]
                score[lettered] = np.minimum(total.max(axis=1)[lettered], 1.0)
            rest = [batch.column(i).slice(texts.first, len(texts)) for i in range(2, batch.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(label, pa.string()), pa.array(score)],
                names=[*batch.schema.names[2:], "lang_pred", "score"],
            )


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves 2 by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, sample: int = SAMPLE, window: int = WINDOW, steps: int = STEPS) -> Network | None:
    """A network trained on at most ``sample`` windows per language; None without labels.

    Each task forwards at most ``sample`` rows per language. Documents and the place of the window
    in each are chosen by hash, so that a rerun learns the same.
    """
    usable = docs.where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & F.col("doc_id").isNotNull()
        & ~held_out(F.col("doc_id"))
    )
    # pieces of a window's length are all that moves, and of each language only as many as the
    # hash lets through: about the sample, however large the language
    last = F.greatest(F.lit(1), F.length("text") - window)
    at = F.pmod(F.xxhash64("doc_id", F.lit(4)), last).cast("int") + 1
    pieces = usable.select(
        "lang", F.shiftrightunsigned(F.xxhash64(F.col("doc_id"), F.lit(3)), 33).alias("_draw"),
        F.expr("text").substr(at, F.lit(window)).alias("piece"),
    )
    counts = stage(usable.groupBy(F.col("lang").alias("_lang")).agg(F.count(F.lit(1)).alias("_all")), "languages")
    if counts.count() <= FEW:  # so that no window is shuffled before the hash has let it through
        counts = F.broadcast(counts)
    through = F.col("_draw") * F.col("_all") < F.lit(1.2 * sample * 2**31)
    drawn = pieces.join(counts, F.col("lang") == F.col("_lang")).where(through)
    place = F.row_number().over(Window.partitionBy("lang").orderBy("_draw", "piece"))
    rows = drawn.withColumn("_n", place).where(F.col("_n") <= sample).select("lang", "_draw", "piece").collect()
    rows.sort(key=lambda r: (r["_draw"], r["lang"], r["piece"]))
    if not rows:
        return None
    languages = sorted({r["lang"] for r in rows})
    pieces = [r["piece"].encode()[:window] for r in rows]
    offsets = np.cumsum([0, *map(len, pieces)])
    windows, text, _ = windows_of(np.frombuffer(b"".join(pieces), np.uint8), offsets, window)
    labels = np.array([languages.index(r["lang"]) for r in rows])[text]
    network = Network(languages)
    network.train(windows, labels, steps)
    return network


def identify(docs: DataFrame, network: Network | None, *keep: str) -> DataFrame:
    """The columns ``keep`` with ``lang_pred`` and ``score``; the prediction reads the text alone."""
    rows = docs.select(F.col("text").rlike(r"\p{L}").alias("_lettered"), F.col("text").alias("_text"), *keep)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[2:]]
    return arrow_map(rows, _predict, ", ".join([*fields, "lang_pred string", "score double"]), network=network)


def language_id(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` for every document."""
    network = fit(docs, sample)
    return identify(docs, network, "doc_id").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )
