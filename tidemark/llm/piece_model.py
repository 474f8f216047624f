"""SentencePiece encoding and decoding by a merge-type prefix table.

The model's merges join the two adjacent symbols whose joint piece scores best, the leftmost of equal ones. Two facts make
a table of prefixes enough. Pieces that follow each other in an encoding are, taken alone, encoded as themselves, so a prefix that ends where a
piece ends is encoded as it is inside the whole. And pieces follow each other in some encoding exactly if each two neighbours do. So
every prefix has one last piece: among the vocabulary's pieces that end there, found by an automaton, the one that is compatible with the last piece of
the prefix before it. The table is filled from left to right and the ids are read from its end backwards.

Two pieces are compatible if encoding them together leaves the boundary: the merges inside either go on by themselves, best first, and
at no moment is the joint piece of the two symbols at the boundary better than the next merge of both. A piece's merges, with
the symbols at its ends after each, are worked out once.

A text's normal form is cut into runs where no piece of the vocabulary goes across. What a table has to know to go on is a state: the longest end of
the prefix that begins a piece, and the last pieces of the prefixes that end inside it. States and the steps between them are
worked out when they are first met, and the tables of all runs of many texts grow by a character at a time as arrays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, text_bytes

#: What stands for a space inside pieces.
MARK = "▁"
#: Ranges of Latin letters; no piece of the usual vocabularies mixes them with other characters.
LETTERS = ((0x41, 0x5A), (0x61, 0x7A), (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x24F))
#: States that are remembered from batch to batch.
STATES = 400_000
#: Characters of a run whose table grows among others; longer ones, and those with characters outside the vocabulary, go one by one.
LONGEST = 64
#: Texts of a batch that are encoded together, and their characters, but for a longer text alone.
SLICE, SLICE_CHARS = 512, 1 << 20
_NEVER = float("-inf")


class _Steps:
    """A hash table from (state, character) to the next state, in arrays."""

    def __init__(self, bits: int = 16):
        import numpy as np

        self.bits, self.used = bits, 0
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)

    def _places(self, keys):
        import numpy as np

        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys):
        """The values of keys, and which of them aren't there."""
        import numpy as np

        at, size = self._places(keys), len(self.keys) - 1
        there = self.keys[at]
        found, missing = self.values[at], there == -1
        open_ = np.flatnonzero((there != keys) & ~missing)
        while len(open_):
            at[open_] = (at[open_] + 1) & size
            there = self.keys[at[open_]]
            found[open_] = self.values[at[open_]]
            missing[open_] = there == -1
            open_ = open_[(there != keys[open_]) & (there != -1)]
        return found, missing

    def add(self, key: int, value: int) -> None:
        import numpy as np

        if 3 * self.used > len(self.keys):
            more = _Steps(self.bits + 1)
            for k in np.flatnonzero(self.keys != -1).tolist():
                more._put(int(self.keys[k]), int(self.values[k]))
            self.bits, self.keys, self.values = more.bits, more.keys, more.values
        self._put(key, value)
        self.used += 1

    def _put(self, key: int, value: int) -> None:
        at = ((key * 0x9E3779B97F4A7C15) & (2**64 - 1)) >> (64 - self.bits)
        while self.keys[at] != -1:
            at = (at + 1) & (len(self.keys) - 1)
        self.keys[at], self.values[at] = key, value


class Encoder:
    """Ids of texts by a SentencePiece BPE model with byte fallback, given as the bytes of its file.

    Models of another kind, without byte fallback, or with unused or user-defined pieces are an error.
    """

    def __init__(self, model: bytes):
        import re

        import numpy as np
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        at = range(self.library.get_piece_size())
        names = [self.library.id_to_piece(i) for i in at]
        kinds = [(self.library.is_unknown(i), self.library.is_control(i), self.library.is_byte(i), self.library.is_unused(i)) for i in at]
        plain = [i for i in at if not any(kinds[i])]
        self.bytes = {int(names[i][3:5], 16): i for i in at if kinds[i][2]}
        self.score = {names[i]: self.library.get_score(i) for i in plain}
        self.id = {names[i]: i for i in plain}
        self._require_merges(names)
        self.names, self.sizes = names, np.array([len(n) for n in names], np.int64)
        #: The states of the automaton that finds pieces: whatever begins one.
        self.begins = {n[:k] for n in self.score for k in range(len(n) + 1)}
        self.ends: dict[str, tuple | None] = {}
        chars = sorted({c for n in self.score for c in n})
        #: A number for each character of the vocabulary, 0 for others, and what kinds of characters runs are made of: 2 marks, 1 Latin letters, 0 others.
        self.number, self.kind = np.zeros(0x110000, np.int64), np.zeros(0x110000, np.int8)
        self.number[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.chars, self.shift = ["", *chars], (len(chars) + 1).bit_length()
        letters = "".join(f"{chr(a)}-{chr(z)}" for a, z in LETTERS)
        self.whole = any(map(re.compile(f"[^{MARK}]{MARK}").search, self.score))
        if not any(map(re.compile(f"[{letters}][^{letters}{MARK}]|[^{letters}{MARK}][{letters}]").search, self.score)):
            for a, z in LETTERS:
                self.kind[a : z + 1] = 1
        self.kind[ord(MARK)] = 2
        self._clear()
        #: The bytes that each id decodes to; ids without any of their own are left to the library.
        self.shown = [bytes([int(names[i][3:5], 16)]) if kinds[i][2] else b"" if kinds[i][1] else None if kinds[i][0] else names[i].replace(MARK, " ").encode() for i in at]
        self.unknown = {i for i in at if kinds[i][0]}
        self.marked = {i for i in plain if names[i][0] == MARK} if self.library.normalize("a").startswith(MARK) else set()

    def _require_merges(self, names) -> None:
        """Raises for models whose encodings aren't merges by score alone: asked of the library on a few strings that would tell."""
        odd = [i for i in range(len(names)) if self.library.is_unused(i)]
        lone = next(chr(c) for c in range(0xE000, 0xF8FF) if chr(c) not in self.score)
        if odd or len(self.bytes) != 256 or self.bytes[ord(lone.encode()[:1])] not in self.library.encode(lone):
            raise ValueError("not a merge model with byte fallback alone")
        # a model that looks for the best sum of scores, not for merges, has scores that aren't ranks
        if any(s != int(s) or s > 0 for s in self.score.values()):
            raise ValueError("not a merge model: scores aren't ranks")

    def _merges(self, piece: str):
        """The symbols of a piece's encoding, and of each merge: its score, then the first and the last symbol before it."""
        score, symbols, steps = self.score.get, list(piece), []
        while True:
            best, where = _NEVER, -1
            for k in range(len(symbols) - 1):
                s = score(symbols[k] + symbols[k + 1])
                if s is not None and s > best:
                    best, where = s, k
            steps.append((best, symbols[0], symbols[-1]))
            if where < 0:
                return symbols, steps
            symbols[where : where + 2] = [symbols[where] + symbols[where + 1]]

    def _ends(self, piece: str):
        """(scores of the merges, last symbols before each, first symbols before each); None if merges don't lead to the piece as a whole."""
        found = self.ends.get(piece, 0)
        if found == 0:
            symbols, steps = self._merges(piece)
            found = tuple(zip(*steps)) if len(symbols) == 1 else None
            found = self.ends[piece] = (found[0], found[2], found[1]) if found else None
        return found

    def compatible(self, a: str, b: str) -> bool:
        """True if the encoding of a + b is a, b. Both are encoded as themselves."""
        (ka, last, _), (kb, _, first) = self._ends(a), self._ends(b)
        score, i, j = self.score.get, 0, 0
        while True:
            x, y, across = ka[i], kb[j], score(last[i] + first[j])
            if across is not None and across > x and across >= y:  # of equal scores the leftmost merge comes first
                return False
            if x >= y:
                if x == _NEVER:
                    return True
                i += 1
            else:
                j += 1

    def _clear(self) -> None:
        import numpy as np

        self.states, self.state_ids, self.steps, self.next, self.pairs = [], {}, _Steps(), {}, {}
        self.last = np.zeros(1024, np.int32)
        self._state("", (None,))

    def _state(self, end: str, lasts: tuple) -> int:
        """The number of a state; 0 is the start of a run, where no piece is the last."""
        import numpy as np

        found = self.state_ids.get((end, lasts))
        if found is None:
            found = self.state_ids[end, lasts] = len(self.states)
            self.states.append((end, lasts))
            if found == len(self.last):
                self.last = np.concatenate([self.last, np.zeros(found, np.int32)])
            self.last[found] = lasts[-1] if isinstance(lasts[-1], int) else -1
        return found

    def _follows(self, left, piece: str) -> bool:
        """True if the piece may follow the last one, which is None at the start of a run."""
        found = self.pairs.get((left, piece))
        if found is None:
            found = self._ends(piece) is not None and (left is None or self.compatible(left if isinstance(left, str) else self.names[left], piece))
            self.pairs[left, piece] = found
        return found

    def _longer(self, state: int, c: str) -> int:
        """The state of a prefix with one more character: its last piece is the one that ends here and may follow the last piece before it.

        A character outside the vocabulary that no piece takes up is itself in the place of an id.
        """
        end, lasts = self.states[state]
        end += c
        last = next((self.id[end[k:]] for k in range(len(end)) if end[k:] in self.id and self._follows(lasts[k], end[k:])), c)
        k = next(k for k in range(len(end) + 1) if end[k:] in self.begins)
        return self._state(end[k:], (*lasts, last)[k:])

    def _alone(self, run: str):
        """(place of its last character, ids) of the pieces of a run, from its end backwards."""
        state, table = 0, []
        for c in run:
            found = self.next.get((state, c))
            if found is None:
                found = self.next[state, c] = self._longer(state, c)
            state = found
            table.append(self.states[state][1][-1])
        at = len(run) - 1
        while at >= 0:
            piece = table[at]
            yield at, [self.bytes[b] for b in piece.encode()] if isinstance(piece, str) else [piece]
            at -= 1 if isinstance(piece, str) else int(self.sizes[piece])

    def _step(self, states, numbers):
        """The next states, from arrays of states and characters' numbers."""
        import numpy as np

        keys = states.astype(np.int64) << self.shift | numbers
        found, missing = self.steps.find(keys)
        if missing.any():
            for key in np.unique(keys[missing]).tolist():
                self.steps.add(key, self._longer(key >> self.shift, self.chars[key & (1 << self.shift) - 1]))
            found, _ = self.steps.find(keys)
        return found

    def encode(self, texts: list[str]) -> list:
        """The ids of each text, as arrays."""
        import numpy as np

        if len(self.states) > STATES or len(self.next) > STATES:
            self._clear()
        normal = self.library.normalize(texts)
        points = np.frombuffer("".join(normal).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        bounds = np.cumsum([0, *map(len, normal)])
        if not len(points):
            return [np.zeros(0, np.int32) for _ in texts]
        kinds, numbers = self.kind[points], self.number[points]
        cut = np.zeros(len(points), bool)
        if not self.whole:
            cut[1:] = (kinds[1:] != kinds[:-1]) & (kinds[:-1] != 2)
        cut[bounds[:-1][np.diff(bounds) > 0]] = True
        starts = np.flatnonzero(cut)
        sizes = np.diff(starts, append=len(points))
        alone = np.logical_or.reduceat(numbers == 0, starts) | (sizes > LONGEST)
        last, many = np.zeros(len(points), np.int32), np.zeros(len(points), np.int64)  # last pieces of prefixes; ids that end at a character
        extra = []
        for a, n in zip(starts[alone].tolist(), sizes[alone].tolist()):
            for at, ids in self._alone("".join(map(chr, points[a : a + n].tolist()))):
                last[a + at], many[a + at] = ids[0], len(ids)
                if len(ids) > 1:
                    extra.append((a + at, ids))
        order = np.argsort(-sizes[~alone], kind="stable")
        first, length = starts[~alone][order], sizes[~alone][order]
        state, n = np.zeros(len(first), np.int32), len(first)
        for k in range(int(length[0]) if n else 0):
            n = int(np.searchsorted(-length, -k, "left"))  # runs longer than k
            state[:n] = self._step(state[:n], numbers[first[:n] + k])
            last[first[:n] + k] = self.last[state[:n]]
        at = first + length - 1
        while len(at):
            many[at] = 1
            at = at - self.sizes[last[at]]
            within = at >= first
            at, first = at[within], first[within]
        ends = np.cumsum(many)
        out = np.repeat(last, many)
        for place, ids in extra:
            out[ends[place] - len(ids) : ends[place]] = ids
        counts = np.concatenate([[0], ends])[bounds]
        return [out[a:b] for a, b in zip(counts, counts[1:])]

    def decode(self, ids: list[int]) -> str:
        """The text of ids: what the library decodes them to. Bytes that make no characters and unknown ids are left to the library."""
        shown = self.shown
        if self.unknown.isdisjoint(ids):
            try:
                text = b"".join(map(shown.__getitem__, ids)).decode()
            except UnicodeDecodeError:
                return self.library.decode(ids)
            # the space that the normal form has before a text goes
            return text[1:] if text[:1] == " " and next(i for i in ids if shown[i]) in self.marked else text
        return self.library.decode(ids)


def encoded(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) of every row: the ids of its whole text, and the text that they decode to.

    Null texts are empty, which has no ids. model is a file that the driver can open; tasks get its bytes. Texts of any length are encoded whole; rows
    that repeat, or share an id, or have none, stay as they are; extra columns are ignored, whatever their names; an empty table gives no rows.
    """
    return _each(docs, model, id_col, text_col, "ids array<int>, decoded string", lambda ids, decoded, _: (ids, decoded), ("list<int32>", "string"))


def digests(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row: hashes of the decimal ids with commas and of the decoded text, in hexadecimal. See encoded()."""

    def told(ids, decoded, decimal):
        from hashlib import sha256

        return len(ids), sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest(), sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest()

    return _each(docs, model, id_col, text_col, "n_tokens long, ids_sha256 string, decoded_sha256 string", told, ("int64", "string", "string"))


def _slices(column):
    """Texts of an Arrow column, some at a time."""
    texts, start, size = text_bytes(column), 0, 0
    for i, t in enumerate(texts):
        if i > start and (size + len(t) > SLICE_CHARS or i - start == SLICE):
            yield start, [x.decode("utf-8", "replace") for x in texts[start:i]]
            start, size = i, 0
        size += len(t)
    yield start, [x.decode("utf-8", "replace") for x in texts[start:]]


def _each(docs: DataFrame, model: str, id_col: str, text_col: str, columns: str, told, kinds) -> DataFrame:
    """doc_id and `columns`, which told() makes of a text's ids and what they decode to."""
    with open(model, "rb") as f:
        side = docs.sparkSession.sparkContext.broadcast((f.read(), {}))
    names = [c.split(" ")[0] for c in columns.split(", ")]

    def run(batches):
        import pyarrow as pa

        proto, kept = side.value  # a worker keeps it from task to task, and with it what the encoder has worked out
        encoder = kept.get("encoder") or kept.setdefault("encoder", Encoder(proto))
        types = [pa.list_(pa.int32()) if k == "list<int32>" else pa.type_for_alias(k) for k in kinds]
        decimal = [str(i) for i in range(len(encoder.names))]
        for batch in batches:
            for start, texts in _slices(batch.column(1)):
                found = (x.tolist() for x in encoder.encode(texts))
                rows = [told(ids, encoder.decode(ids), decimal) for ids in found]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(texts)), *[pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]], names=["doc_id", *names])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))
    return keep(rows.mapInArrow(run, f"doc_id long, {columns}"), "encoded")
