"""Quality classifier: histogram gradient-boosted trees over statistics of a document.

Trees are complete binary trees in flat arrays: node i's children are 2 i + 1 and 2 i + 2, inner nodes hold a feature and
a threshold, leaves a value. All rows walk all trees at once, one level a step.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held_out, labelled_sample, text_bytes

#: Labelled rows that the trees are fitted to at most.
SAMPLE_ROWS = 20_000
TREES, DEPTH, BINS, RATE, RIDGE, LEAST_ROWS = 80, 4, 64, 0.15, 1.0, 20

FEATURES = ("log_bytes", "log_words", "word_bytes", "long_words", "letters", "upper", "digits", "spaces", "beyond_ascii", "punctuation", "marks", "full_stops", "commas", "bars", "brackets", "control", "distinct_words", "common_word", "lines", "distinct_lines", "short_lines", "line_bytes", "capital_words", "marked_words", "letter_entropy", "repeats_next")


def statistics(text: bytes) -> list[float]:
    """The numbers that the trees see, in the order of FEATURES. An empty text has zeros."""
    from collections import Counter

    import numpy as np

    if not text:
        return [0.0] * len(FEATURES)
    n = len(text)
    c = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    upper, lower, digits = int(c[65:91].sum()), int(c[97:123].sum()), int(c[48:58].sum())
    high, space = int(c[128:].sum()), int(c[9:14].sum() + c[32])
    control = int(c[:32].sum()) - int(c[9:14].sum()) + int(c[127])
    punctuation = n - upper - lower - digits - high - space - control
    words = text.split()
    m = max(1, len(words))
    counts = Counter(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    k = max(1, len(lines))
    p = c[c > 0] / n
    # a word begins in capitals or ends in a mark: read from the byte after or before white space
    return [
        math.log1p(n), math.log1p(len(words)), sum(map(len, words)) / m, sum(1 for w in counts if len(w) > 24) / m, (upper + lower + high) / n, upper / max(1, upper + lower), digits / n, space / n, high / n,
        punctuation / n, int(c[33] + c[35] + c[36] + c[37] + c[38] + c[42] + c[63] + c[64]) / n, int(c[46]) / m, int(c[44]) / m, int(c[124]) / m, int(c[[40, 41, 60, 62, 91, 93, 123, 125]].sum()) / n, control / n,
        len(counts) / m, max(counts.values(), default=0) / m, len(lines) / m, len(set(lines)) / k, sum(1 for x in lines if len(x) < 20) / k, math.log1p(n / k),
        sum(v for w, v in counts.items() if w[:1].isupper()) / m, sum(v for w, v in counts.items() if not w[-1:].isalnum() and w[-1] < 128) / m, float(-(p * np.log2(p)).sum()), sum(1 for a, b in zip(words, words[1:]) if a == b) / m,
    ]


class Trees:
    def __init__(self, base: float, depth: int):
        self.base, self.depth, self.feature, self.threshold, self.value = base, depth, [], [], []

    def add(self, feature, threshold, value) -> None:
        self.feature.append(feature)
        self.threshold.append(threshold)
        self.value.append(value)

    def raw(self, x):
        """The margin of each row of x (rows, features)."""
        import numpy as np

        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            out += value[at - (2**self.depth - 1)]
        return out

    def score(self, x):
        import numpy as np

        return 1 / (1 + np.exp(-np.clip(self.raw(x), -700, 700)))


def fit_trees(x, y, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE) -> Trees:
    """Boosting on the logistic loss with second-order gains; a feature's values are put in at most `bins` quantile bins once."""
    import numpy as np

    n, f = x.shape
    share = (y.sum() + 0.5) / (n + 1)
    model = Trees(math.log(share / (1 - share)), depth)
    if n == 0:
        return model
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for j in range(f)]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
    margin = np.full(n, model.base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        feature, threshold = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            width, first = 2**level, 2**level - 1
            slot = (at - first) * bins
            best = np.zeros(width)
            for j in range(f):
                key = slot + binned[:, j]
                gs, hs, cs = (np.bincount(key, w, width * bins).reshape(width, bins) for w in (g, h, None))
                gl, hl, cl = gs.cumsum(1), hs.cumsum(1), cs.cumsum(1)
                gt, ht, ct = gl[:, -1:], hl[:, -1:], cl[:, -1:]
                gain = gl**2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE) - gt**2 / (ht + RIDGE)
                gain[(cl < LEAST_ROWS) | (ct - cl < LEAST_ROWS)] = 0
                gain = gain[:, : len(edges[j])]
                if gain.shape[1]:
                    cut = gain.argmax(1)
                    top = gain[np.arange(width), cut]
                    for k in np.flatnonzero(top > best + 1e-9):
                        best[k], feature[first + k], threshold[first + k] = top[k], j, edges[j][cut[k]]
            at = 2 * at + 1 + (x[np.arange(n), feature[at]] > threshold[at])
        leaf = at - (2**depth - 1)
        value = -rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + RIDGE)
        margin += value[leaf]
        model.add(feature, threshold, value)
    return model


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS, modulus: int = 5, remainder: int = 0) -> Trees:
    """Trees learned from labelled rows whose crc32(id) mod modulus is not the remainder, at most sample_rows of them.

    They see nothing but the text. Only the sample's statistics and labels come to the driver.
    """
    import numpy as np

    ids = F.broadcast(labelled_sample(labels, label_col, ~held_out("doc_id", modulus, remainder), sample_rows))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def count(batches):
        import pyarrow as pa

        for batch in batches:
            rows = [statistics(t) for t in text_bytes(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column(1)], names=["x", "label"])

    sample = texts.join(ids, texts["doc_id"] == ids["sample_id"]).select("text", "label").mapInArrow(count, "x array<double>, label int")
    known = sample.toArrow()
    x = known.column("x").combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES))
    y = (known.column("label").to_numpy() > 0).astype(float)
    order = np.lexsort((*x.T, y))  # the order in which rows arrive means nothing
    return fit_trees(x[order], y[order])


def _scored(rows: DataFrame, text_col: str, model: Trees) -> DataFrame:
    """rows with the column _score; all others pass through."""
    at = rows.columns.index(text_col)
    schema = T.StructType([*rows.schema.fields, T.StructField("_score", T.DoubleType())])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            x = np.array([statistics(t) for t in text_bytes(batch.column(at))], float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(x), pa.float64())], names=[*batch.schema.names, "_score"])

    return rows.mapInArrow(run, schema)


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, modulus: int = 5, remainder: int = 0, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.

    score is 0 to 1, predicted 1 at the threshold and above. Null texts count as empty, long texts count whole. Without labelled rows every
    score is 0.5. Repeated rows and null ids stay. Extra columns are ignored, whatever their names; an empty table gives no rows.
    """
    model = fit_quality(docs, labels, id_col, text_col, modulus=modulus, remainder=remainder, **options)
    rows = _scored(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), "text", model)
    return rows.select("doc_id", held_out("doc_id", modulus, remainder).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, **options) -> DataFrame:
    """The rows of docs that the classifier doesn't reject, in the columns of docs, whatever their names.

    Null and empty texts are scored like any other, long texts whole. Repeated rows and null ids stay or go by their text alone. An empty table gives no rows.
    """
    model = fit_quality(docs, labels, id_col, text_col, **options)
    at = docs.columns.index(text_col)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            x = np.array([statistics(t) for t in text_bytes(batch.column(at))], float).reshape(-1, len(FEATURES))
            yield batch.filter(pa.array(model.score(x) >= threshold))

    return docs.mapInArrow(run, docs.schema)
