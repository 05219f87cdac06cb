"""Operator 6: SentencePiece encoding and decoding.

Unigram Viterbi over a double-array trie of the pieces with their log scores: the
segmentation of largest total score, ties to the longer piece that starts first.
A space becomes the marker U+2581, a marker is put in front, and a character that
no piece has becomes its UTF-8 bytes as byte pieces.  Decoding joins the pieces,
reads byte pieces as UTF-8, turns markers into spaces and drops the one in front.
A U+2581 in the text itself is written as bytes, so decoding gives back any text.

No piece holds a marker behind another character, and a character outside all
pieces ends every path; so the best path of a text is the best path of each
stretch between such places.  Stretches repeat, and a bounded cache keeps their ids and what
these decode to.  New ones are solved together: the dynamic programme advances one position at a
time for thousands of stretches, which are rows of the matrices and cells of the trie.
The trie is built once on the driver and shipped as three arrays.

Defined results: null text: null ids, decoded to null; empty text: no ids, decoded
to ''; repeated rows get equal results; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.llm.common import bounded_batches, table

MODEL = "piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0          # an unknown character scores so much below the least piece
CACHE = 300_000                 # stretches kept by one worker
MATRIX = 64                     # characters of the longest stretch that is solved with others
TOGETHER = 8192                 # stretches solved together
NUL = " "                       # stands for U+0000 between two parts; no stretch holds a space


class Trie:
    """Double array over code points mapped to 1..n: child(s, c) = base[s] + c if check agrees."""

    def __init__(self, base, check, value, chars):
        self.base, self.check, self.value, self.chars = base, check, value, chars

    @classmethod
    def build(cls, pieces: dict[str, int]) -> Trie:
        chars = {c: i + 1 for i, c in enumerate(sorted({c for p in pieces for c in p}))}
        root: dict = {}
        for p, v in pieces.items():
            node = root
            for c in p:
                node = node.setdefault(chars[c], {})
            node[0] = v
        base, check, value = [0], [-1], [-1]
        free = 1                            # no free cell lies before it

        def grow(n):
            while len(base) < n:
                base.append(0)
                check.append(-1)
                value.append(-1)

        todo = [(0, root)]
        while todo:
            at, node = todo.pop()
            value[at] = node.pop(0, -1)
            if not node:
                continue
            codes = sorted(node)
            while free < len(check) and check[free] >= 0:
                free += 1
            b = max(0, free - codes[0])
            while True:
                grow(b + codes[-1] + 1)
                if b + codes[0] > 0 and all(check[b + c] < 0 for c in codes):
                    break
                b += 1
            base[at] = b
            for c in codes:
                check[b + c] = at
            todo += [(b + c, node[c]) for c in codes]
        return cls(base, check, value, chars)

    def packed(self):
        return [np.array(x, dtype=np.int32) for x in (self.base, self.check, self.value)], "".join(self.chars)

    @classmethod
    def unpack(cls, packed) -> Trie:
        (base, check, value), chars = packed
        return cls(base.tolist(), check.tolist(), value.tolist(), {c: i + 1 for i, c in enumerate(chars)})


class Codec:
    """Encoder and decoder of one model; ``spec`` is what ``read_model`` returns."""

    def __init__(self, spec):
        trie, self.scores, self.pieces, byte_ids = spec
        self.trie = Trie.unpack(trie)
        self.byte_ids = byte_ids                                  # id of each byte's piece
        self.bytes_of = {i: b for b, i in enumerate(byte_ids)}
        self.unknown = min(self.scores) - UNKNOWN_PENALTY
        known = set(self.trie.chars)
        ends = "".join(re.escape(c) for c in "\n\t\r" if c not in known)
        # Stretches: markers and what follows up to the next marker or an unknown control character.
        self.stretches = re.compile(f"[{ends}]|{MARK}*[^{MARK}{ends}]+|{MARK}+" if ends
                                    else f"{MARK}*[^{MARK}]+|{MARK}+")
        self.arrays = [np.array(x, dtype=np.int64) for x in (self.trie.base, self.trie.check, self.trie.value)]
        self.values = np.array(self.scores, dtype=np.float64)
        self.plain = [p.replace(MARK, " ") for p in self.pieces]
        self.marked = [p.startswith(MARK) for p in self.pieces]
        self.code_of = np.zeros(0x110000, dtype=np.int32)
        for c, i in self.trie.chars.items():
            self.code_of[ord(c)] = i
        self.single = np.zeros(len(self.trie.chars) + 1, dtype=bool)     # characters that are pieces, by code
        for p in self.pieces:
            if len(p) == 1 and p in self.trie.chars and self._value(p) >= 0:
                self.single[self.trie.chars[p]] = True
        # stretch -> (ids as little-endian 32-bit numbers, bytes among them, decoded, whether a marked piece leads)
        self.cache: dict[str, tuple[bytes, int, str, bool]] = {}

    def _value(self, char: str) -> int:
        to = self.trie.base[0] + self.trie.chars[char]
        return self.trie.value[to] if to < len(self.trie.check) and self.trie.check[to] == 0 else -1

    def best(self, s: str) -> list[int]:
        """Viterbi over one stretch; a raw marker is held as U+0000 (never in a piece)."""
        trie, scores, n = self.trie, self.scores, len(s)
        base, check, value = trie.base, trie.check, trie.value
        codes = [trie.chars.get(c, 0) if c != "\0" else 0 for c in s]
        total: list[float | None] = [None] * (n + 1)
        came: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        total[0] = 0.0
        cells = len(check)
        for i in range(n):
            here = total[i]
            at, one = 0, False
            for j in range(i, n):
                c = codes[j]
                if not c:
                    break
                to = base[at] + c
                if to >= cells or check[to] != at:
                    break
                at = to
                v = value[at]
                if v >= 0:
                    if j == i:
                        one = True
                    x = here + scores[v]
                    old = total[j + 1]
                    if old is None or x > old:
                        total[j + 1], came[j + 1] = x, (i, v)
            if not one:
                x = here + self.unknown
                old = total[i + 1]
                if old is None or x > old:
                    total[i + 1], came[i + 1] = x, (i, -1)
        out: list[int] = []
        j = n
        while j:
            i, v = came[j]
            if v >= 0:
                out.append(v)
            else:
                raw = (MARK if s[i] == "\0" else s[i]).encode()
                out += [self.byte_ids[x] for x in reversed(raw)]
            j = i
        return out[::-1]

    def best_many(self, some: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends): ``best`` of stretches of at most MATRIX characters, one after the
        other; none for those with a character that is no piece of its own, for which bytes
        may be cheaper.  The same sums in the same order as ``best``, for all at once."""
        n, width = len(some), max(map(len, some))
        size = np.array([len(x) for x in some])
        codes = np.zeros((n, width), dtype=np.int64)
        row = np.repeat(np.arange(n), size)
        place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        codes[row, place] = self.code_of[np.frombuffer("".join(some).encode("utf-32-le"), "<u4")]
        base, check, value = self.arrays
        total = np.full((n, width + 1), -np.inf)
        total[:, 0] = 0.0
        came, piece = np.zeros((2, n, width + 1), dtype=np.int64)
        whole = (self.single[codes] | (np.arange(width)[None, :] >= size[:, None])).all(axis=1)
        for i in range(width):
            live = np.flatnonzero(whole & (size > i))
            at = np.zeros(len(live), dtype=np.int64)
            for j in range(i, width):
                c = codes[live, j]
                to = base[at] + c
                ok = (c > 0) & (to < len(check))
                ok[ok] = check[to[ok]] == at[ok]
                live, at = live[ok], to[ok]
                if not len(live):
                    break
                v = value[at]
                ends = np.flatnonzero(v >= 0)
                hit, v = live[ends], v[ends]
                x = total[hit, i] + self.values[v]
                better = x > total[hit, j + 1]
                hit = hit[better]
                total[hit, j + 1], came[hit, j + 1], piece[hit, j + 1] = x[better], i, v[better]
        live, at, rows, ids = np.flatnonzero(whole), size[whole], [], []
        while len(live):
            rows.append(live)
            ids.append(piece[live, at])
            at = came[live, at]
            live, at = live[at > 0], at[at > 0]
        if not rows:
            return np.zeros(0, "<i4"), np.zeros(n, np.int64)
        row, ids = np.concatenate(rows[::-1]), np.concatenate(ids[::-1]).astype("<i4")
        return ids[np.argsort(row, kind="stable")], np.cumsum(np.bincount(row, minlength=n))

    def _entry(self, ids: list[int]) -> tuple[bytes, int, str, bool]:
        return (np.array(ids, dtype="<i4").tobytes(), sum(i in self.bytes_of for i in ids), self._joined(ids),
                bool(ids) and self.marked[ids[0]])

    def learn(self, stretches) -> None:
        """Put the stretches that are not there into the cache."""
        new = sorted({s for part in stretches for s in part if s not in self.cache}, key=len)
        short = [s for s in new if len(s) <= MATRIX and s != NUL]
        plain, cache = self.plain, self.cache
        for lo in range(0, len(short), TOGETHER):
            some = short[lo:lo + TOGETHER]
            ids, ends = self.best_many(some)
            raw, listed, at = ids.tobytes(), ids.tolist(), 0
            for s, end in zip(some, ends.tolist()):
                if end == at:
                    cache[s] = self._entry(self.best(s))
                    continue
                text = "".join([plain[i] for i in listed[at:end]])           # pieces only, no bytes
                cache[s] = (raw[4 * at:4 * end], 0, text, self.marked[listed[at]])
                at = end
        for s in new:
            if s == NUL:
                self.cache[s] = self._entry([self.byte_ids[0]])
            elif len(s) > MATRIX:
                self.cache[s] = self._entry(self.best(s))

    def split(self, text: str) -> list[str]:
        """The stretches of a text; raw markers are U+0000 in them, NUL stands for U+0000."""
        if not text:
            return []
        out: list[str] = []
        for k, part in enumerate(text.split("\0")):
            if k:
                out.append(NUL)
            part = (MARK if k == 0 else "") + part.replace(MARK, "\0").replace(" ", MARK)
            out += self.stretches.findall(part)
        return out

    def round_trips(self, texts: list[str | None]) -> list[tuple[bytes, int, str] | None]:
        """Per text its ids (as bytes), how many of them are bytes, and what they decode to."""
        if len(self.cache) > CACHE:
            self.cache.clear()
        parts = [None if t is None else self.split(t) for t in texts]
        self.learn(p for p in parts if p)
        out: list[tuple[bytes, int, str] | None] = []
        for part in parts:
            if part is None:
                out.append(None)
                continue
            got = [self.cache[s] for s in part]
            back = "".join([g[2] for g in got])
            out.append((b"".join([g[0] for g in got]), sum([g[1] for g in got]), back[1:] if got and got[0][3] else back))
        return out

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit numbers."""
        return self.round_trips([text])[0][0]

    def _joined(self, ids) -> str:
        """The decoded ids, a marker in front kept as a space."""
        out, raw = [], bytearray()
        for i in ids:
            b = self.bytes_of.get(i)
            if b is not None:
                raw.append(b)
                continue
            if raw:
                out.append(bytes(raw).decode("utf-8", "replace"))
                raw.clear()
            out.append(self.plain[i])
        if raw:
            out.append(bytes(raw).decode("utf-8", "replace"))
        return "".join(out)

    def decode(self, ids) -> str:
        ids = list(ids)
        text = self._joined(ids)
        return text[1:] if ids and self.marked[ids[0]] else text


def read_model(path: str | None = None):
    """(packed trie, scores, pieces, byte ids) of a model file with byte pieces."""
    import sentencepiece
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(MODEL)
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    normal = {p: i for i, p in enumerate(pieces)
              if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
    if any(MARK in p.lstrip(MARK) for p in normal):
        raise ValueError("a piece holds the marker behind another character")
    scores = [sp.get_score(i) for i in range(len(pieces))]
    return Trie.build(normal).packed(), scores, pieces, byte_ids


_CODECS: dict = {}


def _digest(spec) -> str:
    """Of everything that a codec is made of."""
    (arrays, chars), scores, pieces, byte_ids = spec
    h = hashlib.sha256(repr((chars, scores, pieces, byte_ids)).encode())
    for x in arrays:
        h.update(x.tobytes())
    return h.hexdigest()


def _codec(key: str, spec) -> Codec:
    if key not in _CODECS:
        _CODECS[key] = Codec(spec)
    return _CODECS[key]


def _encoder(spec, check):
    key = _digest(spec)

    def run(batches):
        codec = _codec(key, spec)
        for b in batches:
            texts = b.column(1).to_pylist()
            got = codec.round_trips(texts)
            if not check:
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([None if x is None else np.frombuffer(x[0], "<i4") for x in got],
                                           pa.list_(pa.int32()))], names=["id", "ids"])
                continue
            cols = [[None if x is None else f(x) for x in got] for f in (lambda x: len(x[0]) // 4, lambda x: x[1], lambda x: zlib.crc32(x[0]))]
            same = [(None if x is None else x[2]) == t for x, t in zip(got, texts)]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, pa.int64()) for c in cols], pa.array(same)],
                                             names=["id", "n_ids", "n_byte_ids", "ids_crc32", "decoded_equal"])
    return run


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None) -> DataFrame:
    """Per row: id and ids (array<int>)."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(_encoder(read_model(model), False), "id long, ids array<int>").withColumnRenamed("id", id_col)


def _decoder(spec):
    key = _digest(spec)

    def run(batches):
        codec = _codec(key, spec)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([None if x is None else codec.decode(x) for x in b.column(1).to_pylist()],
                                       pa.string())], names=["id", "text"])
    return run


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model: str | None = None) -> DataFrame:
    """Per row: id and text."""
    bounded_batches(encoded.sparkSession)
    return encoded.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).alias("ids")) \
        .mapInArrow(_decoder(read_model(model)), "id long, text string").withColumnRenamed("id", id_col)


def op6_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Per row of ``documents``: number and checksum of the ids (as little-endian 32-bit
    numbers), how many are bytes, and whether decoding gives the text back."""
    docs = table(spark, sf_dir, "documents")
    bounded_batches(spark)
    return docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(_encoder(read_model(), True),
                    "id long, n_ids long, n_byte_ids long, ids_crc32 long, decoded_equal boolean") \
        .withColumnRenamed("id", "doc_id")
