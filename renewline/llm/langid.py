"""Language identification by a byte convolutional network, trained in numpy.

A text is lower-cased, stripped of everything but letters and single blanks at the
byte level, and cut into windows of fixed length that cover it whole. Per window:
byte embeddings, filters of several widths, maximum over the positions, softmax.
A text's label has the largest mean log probability over its windows, each weighted
by its bytes; its score is the weighted mean probability of that label.

The network is fitted on a bounded sample: about ``docs_per_label`` documents of each
label, picked by a hash of id and text, and at most ``windows_per_doc`` windows of
each, spread over the text. So the driver holds at most
``max_labels * docs_per_label * windows_per_doc * WINDOW`` bytes, about 80 MB at the
defaults, however large the table is. Everything else covers all rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from renewline.llm.common import map_batches, small_batches

#: Bytes of a window.
WINDOW = 256
EMBEDDING = 8
WIDTHS = (3, 5)
FILTERS = 24
#: Positions between two applications of a filter.
STRIDE = 2
#: Windows that go through the network at once.
CHUNK = 256

DOCS_PER_LABEL = 250
WINDOWS_PER_DOC = 4
MAX_LABELS = 256
EPOCHS = 6
UNKNOWN = "und"

#: A letter is a code point of category L: no digits, fractions, or numerals in circles.
_LETTER = regex.compile(r"\p{L}")
_OTHER = re.compile(rb"[^a-z\x80-\xff]+")


def windows(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The windows of a text, padded with blanks, and the bytes each one holds."""
    data = _OTHER.sub(b" ", text.encode().lower()).strip()
    n = max(1, -(-len(data) // WINDOW))
    sizes = np.full(n, WINDOW, np.float32)
    sizes[-1] = max(1, len(data) - (n - 1) * WINDOW)
    flat = np.frombuffer(data.ljust(n * WINDOW), np.uint8)
    return flat.reshape(n, WINDOW), sizes


class ByteNet:
    """Embedding, convolutions of several widths, maximum, softmax."""

    def __init__(self, labels: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.labels = labels
        self.weights = {"embed": rng.normal(0, 0.5, (256, EMBEDDING))}
        for width in WIDTHS:
            scale = np.sqrt(2 / (width * EMBEDDING))
            self.weights[f"filter{width}"] = rng.normal(0, scale, (width * EMBEDDING, FILTERS))
            self.weights[f"shift{width}"] = np.zeros(FILTERS)
        hidden = FILTERS * len(WIDTHS)
        self.weights["out"] = rng.normal(0, np.sqrt(1 / hidden), (hidden, len(labels)))
        self.weights["bias"] = np.zeros(len(labels))
        self.weights = {k: v.astype(np.float32) for k, v in self.weights.items()}

    def _slices(self, embedded: np.ndarray, width: int) -> np.ndarray:
        """Every STRIDE-th run of ``width`` embedded bytes, as one row each."""
        n = len(embedded)
        steps = (WINDOW - width) // STRIDE + 1
        a, b, c = embedded.strides
        view = np.lib.stride_tricks.as_strided(
            embedded, (n, steps, width * EMBEDDING), (a, b * STRIDE, c), writeable=False
        )
        return view.reshape(n * steps, width * EMBEDDING)

    def _forward(self, data: np.ndarray, keep: bool = False):
        w = self.weights
        embedded = np.ascontiguousarray(w["embed"][data])
        pooled, kept = [], []
        for width in WIDTHS:
            rows = self._slices(embedded, width)
            maps = (rows @ w[f"filter{width}"]).reshape(len(data), -1, FILTERS)
            top = maps.max(axis=1) + w[f"shift{width}"]
            pooled.append(np.maximum(top, 0))
            if keep:
                kept.append((rows, maps.argmax(axis=1)))
        hidden = np.concatenate(pooled, axis=1)
        logits = hidden @ w["out"] + w["bias"]
        logits -= logits.max(axis=1, keepdims=True)
        odds = np.exp(logits)
        return odds / odds.sum(axis=1, keepdims=True), hidden, kept

    def predict(self, data: np.ndarray) -> np.ndarray:
        """Label probabilities of each window."""
        parts = [self._forward(data[at : at + CHUNK])[0] for at in range(0, len(data), CHUNK)]
        return np.concatenate(parts)

    def _gradients(self, data: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        n = len(data)
        odds, hidden, kept = self._forward(data, keep=True)
        odds[np.arange(n), target] -= 1
        odds /= n
        grads = {"out": hidden.T @ odds, "bias": odds.sum(axis=0)}
        back = (odds @ w["out"].T) * (hidden > 0)
        embed = np.zeros_like(w["embed"])
        for i, (width, (rows, best)) in enumerate(zip(WIDTHS, kept)):
            part = back[:, i * FILTERS : (i + 1) * FILTERS]
            grads[f"shift{width}"] = part.sum(axis=0)
            steps = len(rows) // n
            picked = rows[(np.arange(n)[:, None] * steps + best).ravel()]
            picked = picked.reshape(n, FILTERS, width * EMBEDDING)
            grads[f"filter{width}"] = np.einsum("nf,nfk->kf", part, picked)
            # Only the positions that won the maximum pass a gradient on to their bytes.
            spread = (part[:, :, None] * w[f"filter{width}"].T[None]).reshape(n, FILTERS, width, EMBEDDING)
            at = best[:, :, None] * STRIDE + np.arange(width)
            taken = data[np.arange(n)[:, None, None], at]
            np.add.at(embed, taken.ravel(), spread.reshape(-1, EMBEDDING))
        grads["embed"] = embed
        return grads

    def fit(
        self, data: np.ndarray, target: np.ndarray, epochs: int = EPOCHS, batch: int = 64, rate: float = 3e-3, seed: int = 7
    ) -> ByteNet:
        """Adam over shuffled batches."""
        rng = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(data))
            for at in range(0, len(order), batch):
                step += 1
                rows = order[at : at + batch]
                for k, g in self._gradients(data[rows], target[rows]).items():
                    mean[k] = 0.9 * mean[k] + 0.1 * g
                    square[k] = 0.999 * square[k] + 0.001 * g * g
                    m, s = mean[k] / (1 - 0.9**step), square[k] / (1 - 0.999**step)
                    self.weights[k] = (self.weights[k] - rate * m / (np.sqrt(s) + 1e-8)).astype(np.float32)
        return self


def sample_windows(
    labelled: DataFrame,
    text: str = "text",
    label: str = "lang",
    key: str = "doc_id",
    docs_per_label: int = DOCS_PER_LABEL,
    windows_per_doc: int = WINDOWS_PER_DOC,
    max_labels: int = MAX_LABELS,
) -> DataFrame:
    """Columns ``label`` and ``window``: the bounded sample that the network learns from."""
    small_batches(labelled.sparkSession)
    rows = labelled.where(F.col(label).isNotNull() & F.col(text).rlike(r"\p{L}")).select(
        F.col(label).alias("label"),
        F.col(text).alias("text"),
        # A uniform draw in [0, 1) that depends on the row alone.
        (F.pmod(F.xxhash64(key, text), F.lit(1 << 30)) / float(1 << 30)).alias("draw"),
    )
    counts = rows.groupBy("label").count().orderBy(F.desc("count"), "label").limit(max_labels).collect()
    share = {r["label"]: docs_per_label / r["count"] for r in counts}
    if not share:
        picked = rows.where("false")
    else:
        bound = F.create_map(*(F.lit(x) for pair in share.items() for x in pair))
        picked = rows.where(F.col("draw") < F.coalesce(F.try_element_at(bound, F.col("label")), F.lit(0.0)))

    def cut(batches):
        for batch in batches:
            labels, out = [], []
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data, _ = windows(value)
                at = np.unique(np.linspace(0, len(data) - 1, windows_per_doc).astype(int))
                out += [row.tobytes() for row in data[at]]
                labels += [name] * len(at)
            yield pa.record_batch([pa.array(labels, pa.string()), pa.array(out, pa.binary())], names=["label", "window"])

    return picked.select("label", "text").mapInArrow(cut, "label string, window binary")


def train(labelled: DataFrame, **sampling) -> ByteNet | None:
    """Fit a network on the sample; None if no row has both a label and a letter."""
    rows = sample_windows(labelled, **sampling).collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["label"], bytes(r["window"])))
    labels = sorted({r["label"] for r in rows})
    data = np.frombuffer(b"".join(bytes(r["window"]) for r in rows), np.uint8).reshape(-1, WINDOW)
    target = np.array([labels.index(r["label"]) for r in rows])
    # Every window counts twice, once cut short, so that short texts are learned as well.
    short = np.where(
        np.arange(WINDOW) < np.random.default_rng(7).integers(8, WINDOW, len(data))[:, None], data, ord(" ")
    ).astype(np.uint8)
    return ByteNet(labels).fit(np.concatenate([data, short]), np.concatenate([target, target]))


def classify(net: ByteNet | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Label and score of each text; ``und`` and 0 for a text that is null or has no letter."""
    labels, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    known = [i for i, t in enumerate(texts) if t and _LETTER.search(t)] if net else []
    if not known:
        return labels, scores
    cut = [windows(texts[i]) for i in known]
    odds = net.predict(np.concatenate([w for w, _ in cut])).astype(np.float64)
    sizes = np.concatenate([s for _, s in cut]).astype(np.float64)[:, None]
    starts = np.concatenate(([0], np.cumsum([len(w) for w, _ in cut])[:-1]))
    total = np.add.reduceat(sizes, starts)
    votes = np.add.reduceat(np.log(odds + 1e-12) * sizes, starts) / total
    means = np.add.reduceat(odds * sizes, starts) / total
    best = votes.argmax(axis=1)
    for row, i in enumerate(known):
        labels[i] = net.labels[best[row]]
        scores[i] = min(1.0, max(0.0, float(means[row, best[row]])))
    return labels, scores


def predict(docs: DataFrame, net: ByteNet | None, text: str = "text", columns: list[str] | None = None) -> DataFrame:
    """The given columns of every row with ``lang_pred`` and ``score``."""
    small_batches(docs.sparkSession)
    kept = docs.select(*(columns or []), F.col(text).alias("_text"))

    def label(batches):
        for batch in batches:
            names, scores = classify(net, batch.column(batch.num_columns - 1).to_pylist())
            arrays = [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.record_batch(arrays, names=[*batch.schema.names[:-1], "lang_pred", "score"])

    schema = kept.drop("_text").schema.add("lang_pred", "string").add("score", "double")
    return kept.mapInArrow(label, schema)


def keep_identified(docs: DataFrame, net: ByteNet | None, text: str = "text", label: str = "lang") -> DataFrame:
    """The rows whose text gets a label; a missing ``label`` becomes the predicted one, other columns are unchanged.

    Rows without a letter go. Without a network, where no row has a label to learn, every
    text with a letter stays as it is.
    """
    small_batches(docs.sparkSession)
    at, lang = docs.columns.index(text), docs.columns.index(label)

    def keep(batch):
        texts = batch.column(at).to_pylist()
        if net is None:
            return batch.filter(pa.array([bool(t and _LETTER.search(t)) for t in texts], pa.bool_()))
        names, _ = classify(net, texts)
        columns = list(batch.columns)
        columns[lang] = pc.coalesce(columns[lang], pa.array(names, columns[lang].type))
        filled = pa.RecordBatch.from_arrays(columns, names=batch.schema.names)
        return filled.filter(pa.array([name != UNKNOWN for name in names], pa.bool_()))

    return map_batches(docs, keep)


def held_out(doc_id: Column) -> Column:
    """A quarter of the ids is never learned from. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    net = train(docs.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()))
    return predict(docs, net, columns=["doc_id"]).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )
