"""Operator 11: product codes of vectors in exact integer arithmetic (limb-split GEMM).

Components become integers floor(1024 * x); a vector is cut into PARTS equal consecutive
parts, and every part gets the index of the nearest entry of its position's codebook.
Codebooks are refined for ROUNDS rounds: assign all parts, replace entries by floored means.

Squared distances come from dot products, and these from float64 matrix products that are
exact: integers are split into signed limbs so narrow that a whole dot product of two limbs
stays below 2^53.  The products are shifted and added in int64, or in Python's integers
where magnitudes ask for more, and the first smallest distance wins.  Number and width of
limbs follow from the values at hand, so every finite component is coded exactly.

Each round is one pass over the written vectors: a task keeps one total for a codebook cell,
the totals are summed by cell, and the driver gets ENTRIES x dimension sums in 32-bit limbs.
That, the ENTRIES seed vectors and the codebooks in the closures are all that the driver
holds; none of them grows with the rows, and a hot vector or label costs a task nothing extra.

Defined results: null vectors and those with null or non-finite components are left out.
The dimension is that of the smallest id's vector among lengths that PARTS divides; vectors
of another length have null code and error and do not train.  Null ids come after all ids,
equal ids are ordered by their vectors.  With fewer than ENTRIES vectors the codebooks are
that small.  Errors beyond 64 bits are null, and so is the sum of a label that has one.
Null labels are one label.  An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.llm.common import Keeper, scratch, table

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
EXACT_BITS = 53                # integers below 2^53 are exact in float64
BLOCK_ROWS = 4096              # rows of one matrix product
COUNT = -1                     # limb number of the rows that hold counts


def integers(v: np.ndarray) -> np.ndarray:
    """floor(1024 * x) of finite doubles: int64, or Python integers where that is too narrow."""
    if not v.size or np.abs(v).max() < 2.0 ** 48:
        return np.floor(v * SCALE).astype(np.int64)
    wide = [int(x) * SCALE if abs(x) >= 2.0 ** 53 else math.floor(x * SCALE) for x in v.ravel().tolist()]
    return np.array(wide, dtype=object).reshape(v.shape)


def bits_of(a: np.ndarray) -> int:
    return int(abs(a).max()).bit_length() if a.size else 0


def limb_bits(d: int) -> int:
    """Width of limbs whose dot products of length ``d`` stay below 2^53."""
    return (EXACT_BITS - 1 - max(d - 1, 1).bit_length()) // 2


def limbs(a: np.ndarray, width: int) -> list[np.ndarray]:
    """Float64 matrices l with a = sum(l[i] * 2^(width * i)); all but the last are not negative."""
    out = []
    while bits_of(a) > width:
        out.append((a & ((1 << width) - 1)).astype(np.float64))
        a = a >> width
    return [*out, a.astype(np.float64)]


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact dot products of the rows of ``a`` with those of ``b``."""
    d = a.shape[1]
    width = limb_bits(d)
    narrow = bits_of(a) + bits_of(b) + d.bit_length() < 62
    out = np.zeros((len(a), len(b)), dtype=np.int64 if narrow else object)
    right = limbs(b, width)
    for i, x in enumerate(limbs(a, width)):
        for j, y in enumerate(right):
            product = (x @ y.T).astype(np.int64)
            out += (product if narrow else product.astype(object)) << (width * (i + j))
    return out


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row of ``x`` the first of the nearest entries and its squared distance."""
    if 2 * (max(bits_of(x), bits_of(entries)) + 1) + x.shape[1].bit_length() >= 62:
        x, entries = x.astype(object), entries.astype(object)
    index, error = [np.zeros(0, np.int64)], [np.zeros(0, x.dtype)]
    own = (entries * entries).sum(axis=1)
    for lo in range(0, len(x), BLOCK_ROWS):
        block = x[lo:lo + BLOCK_ROWS]
        far = own[None, :] - 2 * dots(block, entries)
        best = far.argmin(axis=1)
        index.append(best)
        error.append((block * block).sum(axis=1) + far[np.arange(len(block)), best])
    return np.concatenate(index), np.concatenate(error)


def _rows(b: pa.RecordBatch, column: int, dim: int):
    """Rows of dimension ``dim`` and their integers, cut into parts."""
    col = b.column(column)
    at = np.flatnonzero(np.diff(col.offsets.to_numpy()) == dim)
    v = col.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
    return at, integers(v).reshape(len(at), PARTS, max(dim, 0) // PARTS)


def _totals(dim: int, books: list[np.ndarray]):
    """Totals of one task: (cell, limb, s) with 32-bit limbs of a cell's sum, and counts."""
    w = dim // PARTS

    def run(batches):
        counts = np.zeros((PARTS, ENTRIES), dtype=np.int64)
        high, low = np.zeros((2, PARTS, ENTRIES, w), dtype=np.int64)
        wide = np.zeros((PARTS, ENTRIES, w), dtype=object)
        for b in batches:
            _, x = _rows(b, 0, dim)
            for p in range(PARTS):
                index, _ = nearest(x[:, p], books[p])
                np.add.at(counts[p], index, 1)
                if x.dtype == object:
                    np.add.at(wide[p], index, x[:, p])
                else:
                    np.add.at(high[p], index, x[:, p] >> 32)
                    np.add.at(low[p], index, x[:, p] & 0xFFFFFFFF)
        cell, limb, s = [], [], []
        for c in np.flatnonzero(counts.ravel()).tolist():
            cell.append(c * w)
            limb.append(COUNT)
            s.append(int(counts.ravel()[c]))
            for j in range(c * w, (c + 1) * w):
                rest, i = (int(high.ravel()[j]) << 32) + int(low.ravel()[j]) + wide.ravel()[j], 0
                while True:
                    last = -(1 << 31) <= rest < 1 << 31
                    cell.append(j)
                    limb.append(i)
                    s.append(rest if last else rest & 0xFFFFFFFF)
                    if last:
                        break
                    rest, i = rest >> 32, i + 1
        yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array(limb, pa.int32()), pa.array(s, pa.int64())],
                                         names=["cell", "limb", "s"])
    return run


def _refined(rows: DataFrame, dim: int, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round."""
    w = dim // PARTS
    sums = rows.select("v").mapInArrow(_totals(dim, books), "cell long, limb int, s long") \
        .groupBy("cell", "limb").agg(F.sum("s").alias("s")).toArrow()
    total, count = {}, {}
    for cell, limb, s in zip(*(sums[c].to_pylist() for c in ("cell", "limb", "s"))):
        if limb == COUNT:
            count[cell // w] = s
        else:
            total[cell] = total.get(cell, 0) + (s << (32 * limb))
    out = []
    for p, book in enumerate(books):
        new = [[total[(p * ENTRIES + k) * w + j] // count[p * ENTRIES + k] for j in range(w)]
               if p * ENTRIES + k in count else list(map(int, book[k])) for k in range(len(book))]
        out.append(_narrowed(new, w))
    return out


def _narrowed(entries: list[list[int]], w: int) -> np.ndarray:
    a = np.array(entries, dtype=object).reshape(len(entries), w)
    return a.astype(np.int64) if bits_of(a) < 62 else a


def _coded(dim: int, books: list[np.ndarray]):
    """(id, label, v) to (id, label, code, error)."""
    def run(batches):
        for b in batches:
            code, error = [None] * b.num_rows, [None] * b.num_rows
            at, x = _rows(b, 2, dim)
            found = [nearest(x[:, p], book) for p, book in enumerate(books)]
            for i, row in enumerate(at.tolist()):
                code[row] = "".join(f"{int(index[i]):02x}" for index, _ in found)
                e = sum(int(err[i]) for _, err in found)
                error[row] = e if e < 1 << 63 else None
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(code, pa.string()), pa.array(error, pa.int64())],
                                             names=["id", "label", "code", "error"])
    return run


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def train(rows: DataFrame, rounds: int = ROUNDS) -> tuple[int, list[np.ndarray]]:
    """(dimension, codebooks) of rows (id, v); (-1, []) if no row can be coded."""
    usable = rows.where(f"size(v) > 0 and size(v) % {PARTS} = 0")
    order = [F.col("id").asc_nulls_last(), F.col("v")]
    first = usable.orderBy(*order).select(F.size("v").alias("n")).first()
    if first is None:
        return -1, []
    dim = first["n"]
    seeds = [r["v"] for r in usable.where(F.size("v") == dim).orderBy(*order).limit(ENTRIES).select("v").collect()]
    cut = integers(np.array(seeds, dtype=np.float64)).reshape(len(seeds), PARTS, dim // PARTS)
    books = [_narrowed(cut[:, p].tolist(), dim // PARTS) for p in range(PARTS)]
    for _ in range(rounds):
        books = _refined(rows, dim, books)
    return dim, books


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """(rows, codebooks): id, label, code, error and label_error of every kept vector."""
    with scratch() as keep:
        v = F.col(vector_col).cast("array<double>")
        rows = keep(vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), v.alias("v"))
                    .where("v is not null and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))"),
                    "code-vectors")
        dim, books = train(rows, rounds)
        types = {f.name: f.dataType.simpleString() for f in rows.schema}
        coded = keep.last(rows.mapInArrow(_coded(dim, books), f"id {types['id']}, label {types['label']}, code string, error long"),
                          "codes")
        return coded.join(_label_sums(coded, keep), F.col("label").eqNullSafe(F.col("l"))) \
            .select("id", "label", "code", "error", "label_error"), books


def _label_sums(coded: DataFrame, keep: Keeper) -> DataFrame:
    """A row for a label, written, so that Spark knows its size when it picks the join; a
    label's rows are summed in each task first, and a hot one is split by adaptive execution."""
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    lost = F.count(F.when(F.col("code").isNotNull() & F.col("error").isNull(), 1))
    return keep.last(coded.groupBy(F.col("label").alias("l")).agg(total.alias("total"), lost.alias("lost"))
                     .select("l", F.when((F.col("lost") == 0) & (F.col("total") <= (1 << 63) - 1),
                                         F.col("total")).cast("long").alias("label_error")), "code-labels")


def op11_vector_codes(spark, sf_dir: str) -> DataFrame:
    rows, books = compress(table(spark, sf_dir, "embeddings"))
    return rows.select(F.col("id").alias("vec_id"), "code", "error", "label_error",
                       F.lit(digest(books)).alias("codebooks_sha256"))


def _round(r: int) -> str:
    return f"""
a{r} AS MATERIALIZED (
  SELECT vec_id, p, min(d * {ENTRIES} + k) AS m FROM (
    SELECT q.vec_id, q.p, c.k, CAST(sum((q.x - c.x) * (q.x - c.x)) AS BIGINT) AS d
    FROM q JOIN c{r} c ON q.p = c.p AND q.j = c.j GROUP BY q.vec_id, q.p, c.k) GROUP BY vec_id, p)"""


def _refine(r: int) -> str:
    return f"""
c{r + 1} AS MATERIALIZED (
  SELECT c.p, c.k, c.j, CASE WHEN n IS NULL THEN c.x ELSE (s - (((s % n) + n) % n)) // n END AS x
  FROM c{r} c LEFT JOIN (
    SELECT q.p, a.m % {ENTRIES} AS k, q.j, CAST(sum(q.x) AS BIGINT) AS s, count(*) AS n
    FROM q JOIN a{r} a ON q.vec_id = a.vec_id AND q.p = a.p GROUP BY ALL) t ON t.p = c.p AND t.k = c.k AND t.j = c.j)"""


ORACLE = f"""WITH e AS MATERIALIZED (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS MATERIALIZED (
  SELECT vec_id, i // (n // {PARTS}) AS p, i % (n // {PARTS}) AS j, CAST(floor({SCALE} * v[i + 1]) AS BIGINT) AS x
  FROM (SELECT vec_id, v, len(v) AS n, unnest(range(len(v))) AS i FROM e)),
c0 AS MATERIALIZED (
  SELECT q.p, s.k, q.j, q.x FROM q JOIN
    (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS k FROM e ORDER BY vec_id LIMIT {ENTRIES}) s ON q.vec_id = s.vec_id),
{",".join(_round(r) + "," + _refine(r) for r in range(ROUNDS))},
{_round(ROUNDS)},
coded AS (
  SELECT vec_id, string_agg(printf('%02x', m % {ENTRIES}), '' ORDER BY p) AS code, CAST(sum(m // {ENTRIES}) AS BIGINT) AS error
  FROM a{ROUNDS} GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, k, j)) FROM c{ROUNDS}) AS codebooks_sha256
FROM coded JOIN e USING (vec_id)"""
