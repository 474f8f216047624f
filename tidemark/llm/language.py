"""Language of words and documents by a linear-chain conditional random field.

A word's features are its affixes (2 and 3 bytes with the boundary), the n-grams of 2 to 4 bytes in it, and in which
languages' lexicons it stands. N-grams are hashed into a fixed weight table. Transitions between the labels of
neighbouring words are learned too, from texts of one language and from texts made of two that take turns; how much a
label is kept depends on a feature of the text, how many neighbouring words agree by themselves. The
forward-backward recursion gives each word's probability of each language, so a text that switches language is
labelled word by word; a document's language is the one with the largest sum over its words.

Texts of a batch are handled together: features for all bytes at once, recursions for all documents at once, the
longest first, so that step t touches only documents with more than t words.
"""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, held_out, keep

#: Labelled rows that the field is fitted to at most, for each language: documents that are drawn, whole, and pieces drawn from all of theirs.
SAMPLE_DOCS, SAMPLE_PIECES = 400, 600
#: Bytes of a piece at most.
PIECE_BYTES = 512
#: Texts are told apart by how many of their neighbouring words agree on a label by themselves; how much a label is kept is learned for each kind.
STEADY = (0.2, 0.4, 0.6, 0.8)
#: Words after which training texts of two languages switch, in turn.
RUNS = (1, 2, 4, 8)
TABLE_BITS, GRAMS = 16, (2, 3, 4)
#: A language's lexicon: words that stand there so often at least and in no other language more than a tenth as often.
LEXICON_LEAST = 5
ROUNDS, BATCH_LINES, RATE, PENALTY = 6, 200, 0.25, 1e-4
#: Documents of a batch that are in memory at once, and their bytes at most but for a longer document alone.
BATCH_DOCS, BATCH_BYTES = 2000, 4 << 20

#: Letters: a-z and all beyond ASCII. What stands between is cut.
_LETTERS = bytes(x if x > 0x7F or 0x61 <= x <= 0x7A else 0x20 for x in range(256))


def letters(text: str | None) -> bytes:
    """Lower-cased words of letters with one space around each."""
    return b" " + b" ".join((text or "").lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split()) + b" "


def pieces(text: bytes, most: int) -> list[bytes]:
    """All of letters() in pieces of whole words, most bytes or fewer; a longer word is cut."""
    out, at = [], 1
    while at < len(text) - 1:
        end = text.rfind(b" ", at, at + most - 1)
        end = end if end > 0 else at + most - 2
        out.append(b" " + text[at:end] + b" ")
        at = end + (text[end : end + 1] == b" ")
    return out


class Order:
    """Where the words of documents of some lengths stand when step t of all of them is together, the longest document first."""

    def __init__(self, lengths):
        import numpy as np

        self.lengths = lengths
        self.doc = np.repeat(np.arange(len(lengths)), lengths)
        self.by_length = np.argsort(-lengths, kind="stable")
        rank = np.empty(len(lengths), np.int64)
        rank[self.by_length] = np.arange(len(lengths))
        first = np.cumsum(lengths) - lengths
        alive = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(int(lengths.max(initial=0))), side="right")
        self.steps = np.concatenate([[0], np.cumsum(alive)]).astype(np.int64)  # packed rows steps[t]:steps[t + 1] are the words at t
        self.packed = self.steps[np.arange(len(self.doc)) - first[self.doc]] + rank[self.doc] if len(self.doc) else np.zeros(0, np.int64)


class Words(Order):
    """The words of some documents: buffer, where words begin, and their order."""

    def __init__(self, texts: list[bytes]):
        import numpy as np

        self.buffer = np.frombuffer(b"".join(texts), np.uint8)
        space = self.buffer == 0x20
        self.starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1 if len(space) else np.zeros(0, np.int64)
        ends = np.cumsum([len(t) for t in texts])
        super().__init__(np.bincount(np.searchsorted(ends, self.starts, side="right"), minlength=len(texts)).astype(np.int64))

    def grams(self, n: int):
        """Table rows of the n-grams that end at each byte; 0 where none lies within a word and its two spaces."""
        import numpy as np

        b = self.buffer
        code, inner = b.astype(np.uint32), np.zeros(len(b), bool)
        for k in range(1, n):
            code[k:] |= b[:-k].astype(np.uint32) << np.uint32(8 * k)
        for k in range(1, n - 1):
            inner[k:] |= b[:-k] == 0x20
        row = (code * np.uint32(2654435761) + np.uint32(n * 40503)) >> np.uint32(32 - TABLE_BITS)
        row = np.maximum(row, 1)
        both = (b == 0x20) & np.concatenate([np.zeros(n - 1, bool), b[: len(b) - n + 1] == 0x20])[: len(b)] if n == 2 else False
        row[inner | both] = 0
        row[: n - 1] = 0
        return row

    def hashes(self):
        """A hash of each word, from its 4-grams."""
        import numpy as np

        b = self.buffer.astype(np.uint64)
        code = b.copy()
        for k in range(1, 4):
            code[k:] |= b[:-k] << np.uint64(8 * k)
        code = (code + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        code ^= code >> np.uint64(29)
        code *= np.uint64(0xBF58476D1CE4E5B9)
        code[self.buffer == 0x20] = 0
        return np.add.reduceat(code, self.starts) if len(self.starts) else code[:0]


class Field:
    """Weights: emission (table rows, labels), lexicon (lexicons, labels), transition (labels, labels), stay (by steadiness of the text)."""

    def __init__(self, names: list[str]):
        import numpy as np

        k = len(names)
        self.names = names
        self.table = np.zeros((1 << TABLE_BITS, k), np.float32)
        self.lexicon = np.zeros((k, k), np.float32)
        self.transition = np.zeros((k, k))
        self.stay = np.zeros(len(STEADY) + 1)
        self.known, self.owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def owners(self, words: Words):
        """The lexicon that each word stands in, or -1."""
        import numpy as np

        if not len(self.known):
            return np.full(len(words.starts), -1)
        h = words.hashes()
        at = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
        return np.where(self.known[at] == h, self.owner[at], -1)

    def emissions(self, words: Words, owner):
        import numpy as np

        total = self.table[words.grams(GRAMS[0])]
        for n in GRAMS[1:]:
            total += self.table[words.grams(n)]
        out = np.add.reduceat(total, words.starts, axis=0).astype(np.float64) if len(words.starts) else np.zeros((0, len(self.names)))
        out[owner >= 0] += self.lexicon[owner[owner >= 0]]
        return out

    def steadiness(self, words: Order, emissions):
        """The row of stay of each document: how often neighbouring words agree on the label that they have by themselves."""
        import numpy as np

        best = emissions.argmax(1)
        within = words.doc[1:] == words.doc[:-1]
        same = np.bincount(words.doc[1:][within], (best[1:] == best[:-1])[within], len(words.lengths))
        return np.searchsorted(STEADY, same / np.maximum(words.lengths - 1, 1), side="right")

    def marginals(self, words: Order, emissions, steady=None):
        """(probability of each label for each word, expected transitions) with the transitions alone, or those of texts so steady."""
        return self.expected(words, emissions, steady)[:2]

    def expected(self, words: Order, emissions, steady=None):
        """marginals(), and how often each document is expected to keep a label."""
        import numpy as np

        k = len(self.names)
        e = np.empty_like(emissions)
        e[words.packed] = np.exp(emissions - emissions.max(1, keepdims=True, initial=-1e9))
        move = np.exp(self.transition - self.transition.max())
        keeps = np.diag(move)
        # what a document's own bonus adds to keeping each label, the longest document first
        more = keeps * (np.exp(self.stay[steady[words.by_length]]) - 1)[:, None] if steady is not None else np.zeros((len(words.lengths), k))
        alpha, beta, pairs, kept = np.empty_like(e), np.ones_like(e), np.zeros((k, k)), np.zeros(len(words.lengths))
        steps = words.steps
        for t in range(len(steps) - 1):
            a, z = steps[t], steps[t + 1]
            now = e[a:z]
            if t:
                last = alpha[steps[t - 1] : steps[t - 1] + z - a]
                now = now * (last @ move + last * more[: z - a])
            alpha[a:z] = now / now.sum(1, keepdims=True)
        for t in range(len(steps) - 2, 0, -1):
            a, z = steps[t], steps[t + 1]
            back, extra = e[a:z] * beta[a:z], more[: z - a]
            before = slice(steps[t - 1], steps[t - 1] + z - a)
            b = back @ move.T + back * extra
            back = back / (alpha[before] * b).sum(1, keepdims=True)
            own = alpha[before] * back
            pairs += move * (alpha[before].T @ back)
            pairs[np.arange(k), np.arange(k)] += (own * extra).sum(0)
            kept[: z - a] += (own * (keeps + extra)).sum(1)
            beta[before] = b / b.sum(1, keepdims=True)
        both = alpha * beta
        stays = np.empty_like(kept)
        stays[words.by_length] = kept
        return (both / both.sum(1, keepdims=True))[words.packed], pairs, stays

    def label_words(self, words: Words):
        """The probability of each label for each word."""
        emissions = self.emissions(words, self.owners(words))
        return self.marginals(words, emissions, self.steadiness(words, emissions))[0]

    def fit(self, texts: list[bytes], labels) -> None:
        """Adagrad on the log likelihood of the texts, whose words have the text's language, and of the switched ones.

        A word's features depend on the word alone, so gradients are summed by distinct words of a batch and touch the table rows of those only.
        """
        import numpy as np

        labels = np.asarray(labels, np.int64)
        k = len(self.names)
        words = Words(texts)
        if not len(words.starts):
            return
        known, at, kind = np.unique(words.hashes(), return_index=True, return_inverse=True)
        counts = np.stack([np.bincount(kind, labels[words.doc] == c, len(known)) for c in range(k)], 1)
        top = counts.max(1)
        sure = (top >= LEXICON_LEAST) & (counts.sum(1) - top <= 0.1 * top)
        self.known, self.owner = known[sure], counts.argmax(1)[sure]
        whole = b"".join(texts)
        distinct = [whole[i : whole.index(b" ", i)] for i in words.starts[at].tolist()]
        ends = np.cumsum(words.lengths)
        lines = [(kind[e - n : e], np.full(n, c)) for e, n, c in zip(ends.tolist(), words.lengths.tolist(), labels.tolist()) if n]
        rng = np.random.default_rng(11)
        lines += switched(lines, k, rng)
        batches = [_Batch([lines[i] for i in some], distinct, self) for some in np.array_split(rng.permutation(len(lines)), -(-len(lines) // BATCH_LINES))]
        squares = [np.full_like(w, 1e-3, dtype=np.float64) for w in (self.table, self.lexicon, self.transition, self.stay)]
        for _ in range(ROUNDS):
            for batch in batches:
                rows, *grads = batch.gradients(self)
                for weights, square, part, grad in zip((self.table, self.lexicon, self.transition, self.stay), squares, (rows, *[slice(None)] * 3), grads):
                    grad = grad / len(batch.kind) - PENALTY * weights[part]
                    square[part] += grad * grad
                    weights[part] += RATE * grad / np.sqrt(square[part])

    def label(self, texts: list[str | None]) -> list[tuple[str | None, float]]:
        """(language, its share of the text's words by probability) of each text; (None, 0) without a letter."""
        import numpy as np

        out, at, cut = [], 0, [letters(t) for t in texts]
        while at < len(cut):
            end, size = at, 0
            while end < len(cut) and end - at < BATCH_DOCS and (end == at or size + len(cut[end]) <= BATCH_BYTES):
                size += len(cut[end])
                end += 1
            words = Words(cut[at:end])
            p = self.label_words(words)
            share = np.stack([np.bincount(words.doc, p[:, c], end - at) for c in range(len(self.names))], 1)
            best = share.argmax(1)
            for i, (b, n) in enumerate(zip(best.tolist(), words.lengths.tolist())):
                out.append((self.names[b], min(1.0, float(share[i, b]) / n)) if n else (None, 0.0))
            at = end
        return out

    def words(self, text: str) -> list[tuple[str, str, float]]:
        """(word, language, probability) of each word of one text."""
        cut = Words([letters(text)])
        if not len(cut.starts):
            return []
        p = self.label_words(cut)
        found = letters(text).decode("utf-8", "replace").split()
        return [(w, self.names[int(r.argmax())], float(r.max())) for w, r in zip(found, p)]


def switched(lines, k: int, rng) -> list:
    """Of each of the (words, labels) lines, which have one label each, and one of another label: the two by turns, after each so many words of RUNS."""
    import numpy as np

    own = [[w for w, y in lines if y[0] == c] for c in range(k)]
    others = [[d for d in range(k) if d != c and own[d]] for c in range(k)]
    out = []
    for n, (w, y) in enumerate(lines):
        if not (choice := others[y[0]]):
            continue
        d = choice[int(rng.integers(len(choice)))]
        v = own[d][int(rng.integers(len(own[d])))]
        run, size = RUNS[n % len(RUNS)], min(len(w), len(v))
        turns = 2 * (np.arange(size) // run)
        by = np.argsort(np.concatenate([turns, turns + 1]), kind="stable")
        out.append((np.concatenate([w[:size], v[:size]])[by], np.repeat([y[0], d], size)[by]))
    return out


class _Batch(Order):
    """Training lines: kinds of words, gold labels, and the table rows of the distinct kinds."""

    def __init__(self, lines, distinct: list[bytes], field: Field):
        import numpy as np

        super().__init__(np.array([len(w) for w, _ in lines], np.int64))
        self.gold = np.concatenate([y for _, y in lines])
        kinds, self.kind = np.unique(np.concatenate([w for w, _ in lines]), return_inverse=True)
        words = Words([b" " + b" ".join(distinct[i] for i in kinds.tolist()) + b" "])
        self.owner = field.owners(words)[self.kind]
        rows = np.stack([words.grams(n)[1:] for n in GRAMS], 1)
        of = np.repeat(np.arange(len(kinds)), np.diff(np.append(words.starts, len(words.buffer))))
        used = rows > 0
        rows, self.of = rows[used], np.broadcast_to(of[:, None], used.shape)[used]
        self.rows, self.at = np.unique(rows, return_inverse=True)
        self.firsts = np.flatnonzero(np.diff(self.of, prepend=-1))
        self.by_row = np.argsort(self.at, kind="stable")
        self.row_firsts = np.flatnonzero(np.diff(self.at[self.by_row], prepend=-1))
        within = self.doc[1:] == self.doc[:-1]
        self.kept = np.bincount(self.doc[1:][within], (self.gold[:-1] == self.gold[1:])[within], len(lines))
        k = len(field.names)
        self.moves = np.bincount((self.gold[:-1] * k + self.gold[1:])[within], minlength=k * k).reshape(k, k)

    def gradients(self, field: Field):
        """(touched table rows, gradients of those, of the lexicon's, the transitions' and the stays' weights): observed less expected."""
        import numpy as np

        lexicon = self.owner >= 0
        emissions = np.add.reduceat(field.table[self.rows][self.at], self.firsts, axis=0).astype(np.float64)[self.kind]
        emissions[lexicon] += field.lexicon[self.owner[lexicon]]
        steady = field.steadiness(self, emissions)
        p, pairs, stays = field.expected(self, emissions, steady)
        off = -p
        off[np.arange(len(off)), self.gold] += 1
        sums = [np.stack([np.bincount(which, o[:, c], size) for c in range(off.shape[1])], 1) for which, o, size in ((self.kind, off, self.of[-1] + 1), (self.owner[lexicon], off[lexicon], off.shape[1]))]
        return self.rows, np.add.reduceat(sums[0][self.of[self.by_row]], self.row_firsts, axis=0), sums[1], self.moves - pairs, np.bincount(steady, self.kept - stays, len(field.stay))


def fit_field(docs: DataFrame, train, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", sample_docs: int = SAMPLE_DOCS, sample_pieces: int = SAMPLE_PIECES) -> Field | None:
    """The field learned from at most sample_pieces pieces of at most sample_docs documents of each language; None without any.

    Drawn are the documents with the smallest hash of the id and text among training rows with a language and a letter. They are cut into pieces as a
    whole, in tasks; of all their pieces, those with the smallest hash of the document's and the place come to the driver, so no text counts by
    its beginning and the driver holds sample_pieces times PIECE_BYTES for each language. Numbers of rows tell
    up to which hash to look, with a margin of four deviations, so no language's rows meet in one task.
    """
    rows = docs.where(train & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"[A-Za-z]|[^\x00-\x7F]"))
    rows = rows.select(F.col(lang_col).alias("l"), F.xxhash64(F.col(id_col).cast("long"), F.col(text_col)).alias("h"), F.col(text_col).alias("t"))

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            for lang, h, t in zip(*(batch.column(c).to_pylist() for c in range(3))):
                texts = pieces(letters(t), PIECE_BYTES)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(texts), pa.string()), pa.array([h] * len(texts), pa.int64()), pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.binary())], names=["l", "d", "i", "t"])

    # rows that repeat an id and its text share a hash; one of them is enough
    few, names = _smallest(rows, sample_docs)
    if not names:
        return None
    table = keep(few.dropDuplicates(["l", "h"]).mapInArrow(cut, "l string, d long, i long, t binary"), "pieces")
    drawn, _ = _smallest(table.select("l", F.xxhash64("d", "i").alias("h"), "t"), sample_pieces)
    found = sorted((r["l"], r["h"], bytes(r["t"])) for r in drawn.collect())
    discard(table)
    sample = [x for _, one in groupby(found, key=lambda x: x[0]) for x in list(one)[:sample_pieces]]
    field = Field(names)
    field.fit([t for _, _, t in sample], [names.index(lang) for lang, _, _ in sample])
    return field


def _smallest(rows: DataFrame, wanted: int) -> tuple[DataFrame, list[str]]:
    """The rows of each l with about the wanted number of smallest hashes h, rather more than fewer, and all l in order."""
    sizes = {r["l"]: r["n"] for r in rows.groupBy("l").agg(F.count("*").alias("n")).collect()}
    limits = [(lang, min(2**63 - 1, int(-(2**63) + (wanted + 4 * wanted**0.5 + 10) / n * 2**64))) for lang, n in sizes.items()]
    pairs = [F.lit(x) for pair in limits for x in pair]
    return rows.where(F.col("h") <= F.element_at(F.create_map(*pairs), F.col("l")) if pairs else F.lit(False)), sorted(sizes)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", modulus: int = 4, remainder: int = 2, **options) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row.

    Learns only from text and language of rows whose crc32(id) mod modulus is not the remainder. lang_pred is a
    learned language, or und for a text that is null or has no letter, and for every text if nothing could be learned; score is the
    language's share of the words by probability, 0 for und; of equal shares the first language by code point wins. Long texts are labelled whole. Repeated rows and null ids stay. Extra columns are ignored, whatever their names; an empty table gives no rows.
    """
    field = fit_field(docs, ~held_out(id_col, modulus, remainder), text_col, lang_col, id_col, **options)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(1).to_pylist()
            texts = [t if t is not None and any(map(str.isalpha, t)) else None for t in texts]
            found = field.label(texts) if field else [(None, 0.0)] * len(texts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n or "und" for n, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], names=["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")
    return rows.select("doc_id", held_out("doc_id", modulus, remainder).alias("held_out"), "lang_pred", "score")
