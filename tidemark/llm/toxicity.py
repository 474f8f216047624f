"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

Texts are folded first: lower case, lookalike letters of other scripts and digits that stand for letters become plain
letters, punctuation becomes space. Lexicon entries are words and beginnings of words with a weight, learned from labelled rows
as smoothed log odds of document frequencies. A word counts with its heaviest entry. Matches inside an
exception phrase don't count. The mass of a text and its mass per word give the score through a logistic curve.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, keep, labelled_sample

#: Labelled rows that a lexicon is learned from at most, and entries it has at most.
SAMPLE_ROWS, LEXICON = 40_000, 20_000
#: Letters of a beginning, at least and at most.
PREFIX = (4, 8)
#: Least toxic documents of an entry, least weight, and least weight in standard errors.
SUPPORT, WEIGHT, CERTAINTY = 5, 2.0, 3.3

#: Harmless phrases with words that a lexicon may hold.
EXCEPTIONS = ("trash can", "trash bin", "white trash bag", "clown fish", "clown school")

#: Lookalikes of a letter in other scripts and shapes, and digits and signs that stand for it.
LOOKALIKES = {
    "a": "аɑαàáâãåāă4@", "b": "ьƅ", "c": "сϲçć", "d": "ԁɗ", "e": "еєéèêëēĕɛ3", "g": "ɡց", "h": "һհ", "i": "іιíìîïīı1", "j": "јϳ",
    "k": "κк", "l": "ӏⅼ|", "m": "мⅿ", "n": "ոпñń", "o": "оοσօõóòôō0", "p": "рρ", "q": "ԛզ", "r": "гᴦ", "s": "ѕꜱš5$", "t": "тτ7",
    "u": "υսúùûū", "v": "νѵ", "w": "ԝѡ", "x": "хχ", "y": "уүýÿ", "z": "ᴢž2",
}


def _table() -> dict:
    table = {ord(x): letter for letter, alike in LOOKALIKES.items() for x in alike}
    table |= {0xFF41 + k: chr(97 + k) for k in range(26)}
    return {k: " " for k in range(128) if not chr(k).isalnum()} | table


TABLE = _table()


def fold(text: str | None) -> str:
    """Plain letters, words apart by one space, a space at both ends."""
    words = (text or "").lower().translate(TABLE).split()
    return f" {' '.join(words)} " if words else " "


def entries(word: str) -> list[str]:
    """What a word can be matched by: itself between spaces, and its beginnings after a space."""
    return [f" {word} ", *(f" {word[:n]}" for n in range(PREFIX[0], min(PREFIX[1], len(word)) + 1))]


def learn_lexicon(sample: DataFrame) -> list[tuple[str, float]]:
    """(text, label) rows -> (entry, weight), heaviest first. An entry that only lengthens another of like weight is left out."""

    def count(batches):
        from collections import Counter

        import pyarrow as pa

        tables = (Counter(), Counter())
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen = {e for w in set(fold(text).split()) for e in entries(w)}
                tables[label > 0].update(seen)
        keys = list(tables[0].keys() | tables[1].keys())
        for at in range(0, len(keys), 100_000):
            part = keys[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), *(pa.array([t[k] for k in part], pa.int64()) for t in (tables[1], tables[0]))], names=["entry", "toxic", "clean"])

    totals = {r["toxic"]: r["count"] for r in sample.groupBy((F.col("label") > 0).alias("toxic")).count().collect()}
    counts = sample.select("text", "label").mapInArrow(count, "entry string, toxic long, clean long").groupBy("entry").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    t, c = F.col("t") + F.lit(0.5), F.col("c") + F.lit(0.5)
    weight = F.log(t / F.lit(totals.get(True, 0) + 1.0)) - F.log(c / F.lit(totals.get(False, 0) + 1.0))
    # by rates, so that it doesn't matter how rare the label is
    sure = counts.withColumn("w", weight).where((F.col("t") >= SUPPORT) & (F.col("w") >= WEIGHT) & (F.col("w") / F.sqrt(1 / t + 1 / c) >= CERTAINTY))
    weights = {r["entry"]: r["w"] for r in sure.orderBy(F.desc("w"), "entry").limit(LEXICON * 5).collect()}
    kept = {}
    for e in sorted(weights, key=len):
        if all(kept.get(e[:n], 0) < weights[e] - 1 for n in range(PREFIX[0] + 1, len(e))):
            kept[e] = weights[e]
    return sorted(kept.items(), key=lambda x: (-x[1], x[0]))[:LEXICON]


class Matcher:
    def __init__(self, lexicon, exceptions=EXCEPTIONS):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for e, w in lexicon:
            self.automaton.add_word(e, (len(e), w))
        for e in exceptions:
            self.automaton.add_word(fold(e), (len(fold(e)), None))
        self.empty = not len(self.automaton)
        if not self.empty:
            self.automaton.make_automaton()

    def mass(self, text: str | None) -> tuple[float, int, int]:
        """(weight of the matched words, matched words, all words)"""
        folded = fold(text)
        n = folded.count(" ") - 1
        if self.empty or not n:
            return 0.0, 0, n
        words, spared = {}, []
        for end, (length, weight) in self.automaton.iter(folded):
            start = end - length + 1
            if weight is None:
                spared.append((start, end))
            else:
                words[start] = max(words.get(start, 0.0), weight)
        if spared:
            spared.sort()
            starts, ends = [a for a, _ in spared], list(accumulate((b for _, b in spared), max))
            inside = lambda s: (at := bisect_right(starts, s) - 1) >= 0 and s < ends[at]
            words = {s: w for s, w in words.items() if not inside(s)}
        return sum(words.values()), len(words), n


def shape(mass: float, hits: int, n: int) -> list[float]:
    return [1.0, math.log1p(mass), math.log1p(100.0 * mass / max(n, 1)), 1.0 if hits else 0.0]


def fit_curve(x, y, penalty: float = 1.0, rounds: int = 30):
    """Logistic regression by Newton steps with a ridge."""
    import numpy as np

    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w)), x.T @ (p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS, modulus: int = 5, remainder: int = 0) -> DataFrame:
    """(doc_id, held_out, score, predicted, hits) of every row.

    Lexicon and curve are learned from labelled rows whose crc32(id) mod modulus is not the remainder, at most sample_rows of them.
    score is 0 to 1; predicted is 1 at 0.5 and above; hits is the number of matched words. Null texts count as empty.
    Without any labelled row every score is 0. Long texts are matched whole. Repeated rows and null ids stay. Extra columns are ignored, whatever their names; an empty table gives no rows.
    """
    import numpy as np

    ids = F.broadcast(labelled_sample(labels, label_col, ~held_out("doc_id", modulus, remainder), sample_rows))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sample = keep(texts.join(ids, texts["doc_id"] == ids["sample_id"]).select("text", "label"), "sample")
    lexicon = learn_lexicon(sample)

    def shapes(batches):
        import pyarrow as pa

        matcher = Matcher(lexicon)
        for batch in batches:
            rows = [matcher.mass(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([float(r[k]) for r in rows], pa.float64()) for k in range(3)] + [batch.column(1)], names=["mass", "hits", "n", "label"])

    known = sample.mapInArrow(shapes, "mass double, hits double, n double, label int").collect()  # four numbers for each row of the sample
    x = np.array([shape(r["mass"], r["hits"], r["n"]) for r in known]).reshape(-1, 4)
    curve = fit_curve(x, np.array([float(r["label"] > 0) for r in known])).tolist() if len(known) else None

    def run(batches):
        import pyarrow as pa

        matcher = Matcher(lexicon)
        for batch in batches:
            found = [matcher.mass(t) for t in batch.column(1).to_pylist()]
            scores = [1 / (1 + math.exp(-max(-700.0, min(700.0, sum(a * b for a, b in zip(curve, shape(*f))))))) if curve else 0.0 for f in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array([f[1] for f in found], pa.int64())], names=["doc_id", "score", "hits"])

    scored = texts.mapInArrow(run, "doc_id long, score double, hits long")
    return scored.select("doc_id", held_out("doc_id", modulus, remainder).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "hits")
