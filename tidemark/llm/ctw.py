"""Language-model scoring by context-tree weighting over bytes.

A byte is eight binary decisions, from the highest bit down: node 1 is the first, node 2 n + bit follows node n. Each node
has a context tree whose contexts are the 0 to DEPTH bytes before. A context with a zeros and b ones has the
Krichevsky-Trofimov probability of its block, which depends on the counts alone:

    P_e(a, b) = G(a + 1/2) G(b + 1/2) / (G(1/2)^2 G(a + b + 1)),

and the weighted probability P_w = P_e at the full depth, else P_w = P_e / 2 + prod(P_w of the longer contexts) / 2. A
context weighs in with w = P_e / (2 P_w). A bit is predicted by mixing (b + 1/2) / (a + b + 1) over the depths: each
context takes w of what shorter ones left, the longest context seen in training takes the rest.

All of this follows from counts, so training is one aggregation of byte n-grams. A task streams its documents and cuts
them into buckets of bounded size, in the order in which it meets them, so that repeated rows make no bucket larger than
others. A bucket asks once for each of its distinct n-grams and words; totals meet the requests in a window over the key, the
model's answers in a join, and the bucket's answers come before its texts in one sorted partition, where texts are scored as they stream by.
No group of texts is ever in memory. Between the passes texts travel in pages: compressed Arrow batches of about BATCH_BYTES.

Texts are lower-cased (A-Z); the byte 0xFF, which no UTF-8 text has, ends a text and stands DEPTH times before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import equal_runs, held_out, keep

#: Bytes of context.
DEPTH = 5
#: Bytes of text of a bucket. A larger one asks less often for the same n-grams; its distinct words and n-grams are in memory at once.
BUCKET_BYTES = 48 << 20
#: n-grams that one task gets on average when the tree is weighted, and how many are in memory at once, but for those that share their newest bytes.
PART_GRAMS, RUN_GRAMS = 200_000, 100_000
#: Contexts of up to TOP bytes are weighted on the driver and broadcast, if their nodes are no more than TOP_ROWS (32 bytes each); else
#: those of one byte, which have at most 65,280 nodes whatever the corpus. Longer ones are weighted in tasks.
TOP, TOP_ROWS = 2, 2_000_000
#: Bytes of text whose n-grams are in memory at once, whatever the length of a text.
BATCH_BYTES = 1 << 20
END = 0xFF


def log_gamma(x):
    """Natural logarithm of the gamma function of an array of positive numbers, to about 1e-13."""
    import numpy as np

    x = np.asarray(x, float)
    shift = np.ones_like(x)
    y = x.copy()
    for _ in range(8):
        low = y < 9
        if not low.any():
            break
        shift[low] *= y[low]
        y[low] += 1
    z = 1 / (y * y)
    tail = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z * (1 / 1680 - z * (1 / 1188 - z * 691 / 360360))))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + tail - np.log(shift)


def log_kt(a, b):
    """ln P_e of blocks with a zeros and b ones."""
    import numpy as np

    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1.0) - np.log(np.pi)


def nodes(grams):
    """(keys, bits): for each n-gram (newest byte lowest) its eight nodes, keyed context << 8 | node, and their bits."""
    import numpy as np

    grams = grams.astype(np.int64)
    byte, context = grams & 0xFF, grams >> 8 << 8
    k = np.arange(8)
    return context[:, None] | (1 << k) | (byte[:, None] >> (8 - k)), byte[:, None] >> (7 - k) & 1


def fold_up(keys, a, b, below):
    """Sum zeros, ones and the logarithms below by key: (keys, a, b, below)."""
    import numpy as np

    keys, at = np.unique(keys, return_inverse=True)
    at = at.ravel()
    return keys, *(np.bincount(at, w, len(keys)) for w in (a, b, below))


def weigh(a, b, below, leaf: bool):
    """(ln P_w, w) of contexts whose longer ones have the sum below of ln P_w."""
    import numpy as np

    own = log_kt(a, b)
    if leaf:
        return own, np.ones_like(own)
    both = np.logaddexp(own, below) - np.log(2)
    return both, np.exp(own - np.log(2) - both)


def shorter(keys, depth: int):
    """The keys of the contexts without their oldest byte; depth counts the bytes they had."""
    return keys & ((1 << 8 * depth) - 1)


def mix_down(level, above):
    """Predictions of the contexts of one level, given those of the next shorter one.

    level: (keys, a, b, w) and depth; above: (keys, left, mixed, leaf) or None at depth 0. Returns (keys, left, mixed,
    leaf): what is left of the weight, the mixture of the contexts so far, and the prediction of a one if no longer
    context was seen. A context without counts takes no weight.
    """
    import numpy as np

    keys, a, b, w, depth = level
    if above is None:
        left, mixed, leaf = np.ones(len(keys)), np.zeros(len(keys)), np.full(len(keys), 0.5)
    else:
        at = np.searchsorted(above[0], shorter(keys, depth))
        left, mixed, leaf = (x[at] for x in above[1:])
    own, seen = (b + 0.5) / (a + b + 1.0), a + b > 0
    w = np.where(seen, w, 0.0)
    return keys, left * (1 - w), mixed + left * w * own, np.where(seen, mixed + left * own, leaf)


class Levels:
    """The levels of the tree over some n-grams, from the full depth down to `least`."""

    def __init__(self, grams, counts, depth: int, least: int):
        import numpy as np

        keys, bits = nodes(grams)
        n = np.repeat(np.asarray(counts, float), 8)
        bits = bits.ravel()
        level = fold_up(keys.ravel(), n * (1 - bits), n * bits, np.zeros(len(n)))
        self.levels, self.below = [], None
        for d in range(depth, least - 1, -1):
            keys, a, b, below = level
            log_w, w = weigh(a, b, below, d == depth)
            self.levels.append((keys, a, b, w, d))
            level = fold_up(shorter(keys, d), a, b, log_w) if d else None
        #: Zeros, ones and sums of ln P_w for the contexts just shorter than the last level.
        self.up = level

    def predictions(self, above):
        """The full depth's (keys, left, mixed, leaf)."""
        for level in reversed(self.levels):
            above = mix_down(level, above)
        return above


def top_levels(up, depth: int):
    """(keys, left, mixed, leaf) of the contexts of `depth` bytes, from their (keys, a, b, below), through all shorter ones."""
    levels, level = [], up
    for d in range(depth, -1, -1):
        keys, a, b, below = level
        log_w, w = weigh(a, b, below, False)
        levels.append((keys, a, b, w, d))
        level = fold_up(shorter(keys, d), a, b, log_w) if d else None
    above = None
    for level in reversed(levels):
        above = mix_down(level, above)
    return above


def log10_bytes(grams, found):
    """log10 of each n-gram's last byte's probability, found: the full depth's predictions."""
    import numpy as np

    keys, bits = nodes(grams)
    one = found[3][np.searchsorted(found[0], keys)]
    return np.log10(np.where(bits == 1, one, 1 - one)).sum(1)


def _windows(texts: list[bytes], depth: int):
    """(codes, text): n-grams of at most about BATCH_BYTES at once, and the number of the text each one's last byte belongs to."""
    import numpy as np

    start = bytes([END]) * depth
    flat = np.frombuffer(b"".join(start + t + start[:1] for t in texts), np.uint8)
    sizes = np.array([len(t) + depth + 1 for t in texts])
    ends = np.cumsum(sizes)
    for lo in range(0, len(flat), BATCH_BYTES):
        part = flat[max(0, lo - depth) : lo + BATCH_BYTES]
        codes = part.astype(np.int64)
        for k in range(1, depth + 1):
            codes[k:] |= part[:-k].astype(np.int64) << (8 * k)
        codes = codes[min(lo, depth) :]
        hi = lo + len(codes)
        i, j = np.searchsorted(ends, [lo, hi - 1], side="right")
        text = np.repeat(np.arange(i, j + 1), np.minimum(ends[i : j + 1], hi) - np.maximum((ends - sizes)[i : j + 1], lo))
        whole = np.arange(lo, hi) - (ends - sizes)[text] >= depth
        yield codes[whole], text[whole]


def gram_codes(texts: list[bytes], depth: int = DEPTH):
    """n-grams of depth + 1 bytes of all texts with their ends, newest byte lowest, and how many each text has."""
    import numpy as np

    return np.concatenate([np.zeros(0, np.int64), *[c for c, _ in _windows(texts, depth)]]), np.array([len(t) + 1 for t in texts])


def _words(text: bytes):
    """Lists of the words of a text, of about BATCH_BYTES at once."""
    import re

    start, space = 0, re.compile(rb"[\x20\x09-\x0D]")
    while start < len(text):
        cut = space.search(text, start + BATCH_BYTES)
        end = cut.start() if cut else len(text)
        yield text[start:end].split()
        start = end


def word_keys(words):
    """Keys of words: negative, so that they and n-grams, which are not, stand in one column."""
    import numpy as np
    from xxhash import xxh64_intdigest

    return (np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words)) | np.uint64(1 << 63)).view(np.int64)


def runs_of(batch):
    """Slices of an Arrow batch (id, train, text) whose texts have at most BATCH_BYTES together, but for one longer text alone."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_pylist()
    start, size = 0, 0
    for i, n in enumerate([*sizes, BATCH_BYTES + 1]):
        if i > start and size + n > BATCH_BYTES:
            yield batch.slice(start, i - start), size
            start, size = i, 0
        size += n


def _page(batch) -> bytes:
    """A batch (id, train, text) as a compressed Arrow stream."""
    import pyarrow as pa

    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd"))) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _texts(batch) -> list[bytes]:
    return [(t or b"").lower() for t in batch.column(2).to_pylist()]


def distinct(codes):
    """(keys, at): the distinct codes in order, and each code's place among them."""
    import numpy as np
    import pyarrow as pa

    found = pa.array(codes).dictionary_encode()
    keys, at = found.dictionary.to_numpy(), found.indices.to_numpy()
    order = np.argsort(keys)
    place = np.empty(len(keys), np.int64)
    place[order] = np.arange(len(keys))
    return keys[order], place[at]


class _Counts:
    """Keys with counts, merged whenever half as many new ones have come as there are, or `most`."""

    def __init__(self, most: int = 500_000):
        import numpy as np

        self.keys, self.counts, self.new, self.most = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], 0, most

    def add(self, keys, counts) -> None:
        """Keys have to be in order, which makes merging cheap."""
        self.keys.append(keys)
        self.counts.append(counts)
        self.new += len(keys)
        if self.new > max(self.most, len(self.keys[0]) // 2):
            self.merge()

    def merge(self):
        """(keys, counts) so far, in the order of the keys."""
        import numpy as np

        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        self.keys, self.counts = [], []
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
        self.keys, self.counts, self.new = [keys[first]], [np.add.reduceat(counts, first) if len(first) else counts], 0
        return self.keys[0], self.counts[0]


#: A page of texts, or a key that the bucket asks for with its count in the bucket's training documents.
REQUEST = "bucket long, key long, n long, page binary"


def _requests(bucket_bytes: int):
    """Pages and requests of a stream of (id, train, text), bucket by bucket."""

    def run(batches):
        from collections import Counter
        from itertools import chain

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        schema = pa.schema([("bucket", pa.int64()), ("key", pa.int64()), ("n", pa.int64()), ("page", pa.binary())])
        bucket, size, pages, counts = TaskContext.get().partitionId() << 24, 0, 0, _Counts()

        def asked():
            keys, n = counts.merge()
            for at in range(0, len(keys), 100_000):
                part = keys[at : at + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), bucket)), pa.array(part), pa.array(n[at : at + 100_000].astype(np.int64)), pa.nulls(len(part), pa.binary())], schema=schema)

        for batch in batches:
            for run_, bytes_ in runs_of(batch):
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in ((bucket, pa.int64()), (pages, pa.int64()), (0, pa.int64()), (_page(run_), pa.binary()))], schema=schema)
                texts, learn = _texts(run_), np.array(run_.column(1).to_pylist(), bool)
                for wanted in (True, False):
                    own = [t for t, w in zip(texts, learn.tolist()) if w == wanted]
                    for parts in [map(bytes.split, own)] if bytes_ <= BATCH_BYTES else map(_words, own):
                        for words in [chain.from_iterable(parts)] if bytes_ <= BATCH_BYTES else parts:
                            seen = Counter(words)
                            keys, n = word_keys(seen), np.fromiter(seen.values(), np.int32, len(seen)) * np.int32(wanted)
                            order = np.argsort(keys)
                            counts.add(keys[order], n[order])
                for codes, text in _windows(texts, DEPTH):
                    keys, at = distinct(codes)
                    counts.add(keys, np.bincount(at, learn[text], len(keys)).astype(np.int32))
                size, pages = size + bytes_, pages + 1
                if size >= bucket_bytes:
                    yield from asked()
                    bucket, size, pages, counts = bucket + 1, 0, 0, _Counts()
        if pages:
            yield from asked()

    return run


def _answered(total: int, vocabulary: int, ends: int):
    """Scores of documents, from a stream in which a bucket's answers, in the order of their keys, come before its pages."""
    schema = "doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double, n_bytes long"

    def run(batches):
        from itertools import chain

        import numpy as np
        import pyarrow as pa

        names, kinds = ("n_tokens", "n_known", "base_score", "score", "n_bytes"), (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64())
        base = lambda c: np.log10((c + 1.0) / (total + 1.0 * (vocabulary + 1)))

        def answer(wanted, keys, values):
            """The values of the wanted keys; 1 for a key without one."""
            if not len(keys):
                return np.ones(len(wanted))
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            return np.where(keys[at] == wanted, values[at], 1.0)

        def scored(page, keys, values):
            batch = pa.ipc.open_stream(page).read_next_batch()
            texts = _texts(batch)
            n, known, sums = np.ones(len(texts), np.int64), np.full(len(texts), int(ends > 0)), np.full(len(texts), base(ends))
            short = sum(map(len, texts)) <= BATCH_BYTES
            for group in [[(i, t.split()) for i, t in enumerate(texts)]] if short else ([(i, w)] for i, t in enumerate(texts) for w in _words(t)):
                seen = list(set().union(*(w for _, w in group)))
                counted = dict(zip(seen, answer(word_keys(seen), keys, values).tolist()))
                c = np.fromiter(map(counted.__getitem__, chain.from_iterable(w for _, w in group)), float)
                text = np.repeat([i for i, _ in group], [len(w) for _, w in group])
                n += np.bincount(text, minlength=len(texts))
                known += np.bincount(text[c > 0], minlength=len(texts))
                sums += np.bincount(text, base(c), len(texts))
            score = np.zeros(len(texts))
            for codes, text in _windows(texts, DEPTH):
                asked, at = distinct(codes)
                score += np.bincount(text, answer(asked, keys, values)[at], len(texts))
            all_ = [n, known, sums, score, [len(t) + 1 for t in texts]]
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(v, k) for v, k in zip(all_, kinds)]], names=["doc_id", "train", *names])

        bucket, parts, keys, values = None, [], np.zeros(0, np.int64), np.zeros(0)
        for batch in batches:
            rows = batch.column(0).to_numpy()
            for lo, hi in equal_runs(rows):
                if rows[lo] != bucket:
                    bucket, parts, keys, values = rows[lo], [], np.zeros(0, np.int64), np.zeros(0)
                part = batch.slice(lo, hi - lo)
                asked = part.column(3).null_count
                if asked:
                    parts.append((part.column(1).slice(0, asked).to_numpy(), part.column(2).slice(0, asked).to_numpy()))
                if asked < hi - lo and parts:
                    keys, values = (np.concatenate(c) for c in zip(*parts))
                    parts = []
                for page in part.column(3).slice(asked):
                    yield scored(page.as_buffer(), keys, values)

    return run, schema


def _trees(batches, top: int):
    """(keys, Levels) of a stream of (key, n) in the order of the contexts' newest top + 1 bytes, cut where these change."""
    import numpy as np

    near = lambda keys: (keys >> 8) & ((1 << 8 * (top + 1)) - 1)
    keys, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        keys, n = np.concatenate([keys, batch.column(0).to_numpy()]), np.concatenate([n, batch.column(1).to_numpy()])
        if len(keys) > RUN_GRAMS:
            cut = int(np.searchsorted(near(keys), near(keys[-1:])[0]))
            if cut:
                yield keys[:cut], Levels(keys[:cut], n[:cut], DEPTH, top + 1)
                keys, n = keys[cut:], n[cut:]
    if len(keys):
        yield keys, Levels(keys, n, DEPTH, top + 1)


def _model(grams: DataFrame, rows: int) -> DataFrame:
    """(key, value) of n-grams (key, n): log10 of the probability of an n-gram's last byte after the others."""
    for top in (TOP, 1):
        near = F.expr(f"(key >> 8) & {(1 << 8 * (top + 1)) - 1}")  # contexts with the same newest bytes share a task
        dealt = grams.withColumn("near", near).repartition(max(1, -(-rows // PART_GRAMS)), "near").sortWithinPartitions("near", "key").select("key", "n")

        def up(batches, top=top):
            import pyarrow as pa

            for _, tree in _trees(batches, top):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in tree.up], names=["key", "a", "b", "below"])

        summed = dealt.mapInArrow(up, "key long, a double, b double, below double").groupBy("key").agg(*[F.sum(c).alias(c) for c in ("a", "b", "below")])
        summed = keep(summed, "top")
        if summed.count() <= TOP_ROWS:
            break
    above = _broadcast_top(summed, top)

    def predict(batches):
        import pyarrow as pa

        for keys, tree in _trees(batches, top):
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(log10_bytes(keys, tree.predictions(above.value)))], names=["key", "value"])

    return dealt.mapInArrow(predict, "key long, value double")


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 7, remainder: int = 2) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) of every row.

    The model learns from rows whose crc32(id) mod modulus is not the remainder. score is log10 of the
    probability of the text and its end, bits_per_byte its code length for each byte, the end counted as one. base_score adds one to each token's count; tokens are words and the end.
    Null texts count as empty, which have one token. Repeated rows and null ids stay and count as often as they
    stand. Texts of any length are scored whole, in pieces of bounded size. Extra columns are ignored, whatever their names; an empty table gives no rows. Words are told apart by
    a 63-bit hash. What the model knows of the corpus grows with it; only contexts of up to two bytes are broadcast, behind a count.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), (~held_out(id_col, modulus, remainder)).alias("train"), F.col(text_col).cast("binary").alias("text"))
    size, ends = texts.agg(F.sum(F.octet_length("text")), F.sum(F.col("train").cast("long"))).first()
    size, ends = size or 0, ends or 0
    # small inputs still use all cores
    bucket = max(1, min(BUCKET_BYTES, max(BATCH_BYTES, size // spark.sparkContext.defaultParallelism)))
    asked = keep(texts.coalesce(max(1, size // bucket)).mapInArrow(_requests(bucket), REQUEST), "requests")
    pages, requests = asked.where("page is not null"), asked.where("page is null").select("bucket", "key", "n")
    totals = keep(requests.withColumn("n", F.expr("sum(n) over (partition by key)")), "totals")

    one = totals.where("key >= 0 or n > 0").groupBy("key").agg(F.max("n").alias("n"))
    counts = keep(one, "counts")
    tokens, vocabulary, rows = counts.agg(F.sum(F.expr("if(key < 0, n, 0)")), F.count_if(F.expr("key < 0")), F.count_if(F.expr("key >= 0"))).first()
    total, vocabulary = (tokens or 0) + ends, vocabulary + (ends > 0)

    model = _model(counts.where("key >= 0"), rows)
    # a word seen once in training, which most words are, isn't answered: the bucket takes 1 for a word without answer
    words = totals.where("key < 0 and n <> 1").select("bucket", "key", F.col("n").cast("double").alias("value"))
    grams = totals.where("key >= 0").select("bucket", "key").join(model, "key").select("bucket", "key", "value")
    answers = words.unionByName(grams).withColumn("page", F.lit(None).cast("binary"))
    both = answers.unionByName(pages.select("bucket", "key", F.lit(0.0).alias("value"), "page"))
    parts = max(1, -(-size // bucket))
    score, schema = _answered(total, vocabulary, ends)
    # more partitions than buckets, so that few tasks get two of them
    scored = both.repartition(4 * parts, "bucket").sortWithinPartitions("bucket", F.col("page").isNotNull(), "key").mapInArrow(score, schema)
    bits = -F.col("score") / F.lit(0.30102999566398120) / F.col("n_bytes")
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score", bits.alias("bits_per_byte"))


def _broadcast_top(summed: DataFrame, top: int):
    """Predictions of the contexts of `top` bytes or fewer as a broadcast variable, from their sums (key, a, b, below)."""
    import numpy as np

    rows = summed.toArrow().sort_by("key")
    up = [rows.column(c).to_numpy() for c in ("key", "a", "b", "below")]
    found = top_levels(up, top) if rows.num_rows else [np.zeros(0)] * 4
    return summed.sparkSession.sparkContext.broadcast(found)
