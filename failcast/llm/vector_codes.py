"""Vector code compression: product codes by exact integer k-means.

Every component x becomes the integer floor(scale * x). Vectors are cut into equal
consecutive parts; each part position has a codebook that starts as that part of the
vectors with the smallest ids. A round assigns every part to the nearest entry and then moves each
entry to the mean of its parts, rounded down; entries without parts stay.

The nearest entry is found by float32 matrix products: ``|c|^2 - 2 x.c`` with an interval that
holds the true value whatever the products' rounding was. Every entry whose interval overlaps
the best one's is computed again in int64, and ties go to the lower index. So codes are exact,
and nearly all of the work is a matrix product.

Vectors stay where they are read: a task sends its sums for each entry (at most parts x entries
rows, in pieces of ``LANES`` components), the driver gets one codebook, whose size follows from
the parameters and the vectors' length alone. Nothing moves by label but sums: labels with many rows
are broadcast, of which there can be few only, the others are joined.

Defined cases: a vector that is null, or has a null, NaN or infinite component, is dropped; shorter
vectors, empty ones too, count as filled up with zeros to the longest, and that to a multiple of the
number of parts; fewer vectors than entries make smaller codebooks; null ids come
last, rows that repeat an id in the order of their components; components so large that squares exceed int64
are worked with as Python integers, and an error beyond a long is null; null labels are one
label; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from failcast.deploy import ship
from failcast.llm.common import spread, written

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
BLOCK = 2048
LANES = 16
#: Labels that are joined by broadcast: those with at least this share of all rows.
HOT_SHARE = 1e-4
LONG = 2**63


def _finite(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which lists are kept; the components and lengths of those."""
    lengths = np.nan_to_num(vectors.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)  # null is NaN
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
    ends = np.cumsum(lengths)
    keep = vectors.is_valid().to_numpy(zero_copy_only=False) & (bad[ends] == bad[ends - lengths])
    return keep, flat[np.repeat(keep, lengths)], lengths[keep]


def _whole(flat: np.ndarray, scale: int, wide: bool) -> np.ndarray:
    if not wide:
        return np.floor(flat * float(scale)).astype(np.int64)
    exact = [x.as_integer_ratio() for x in flat.tolist()]
    return np.array([scale * a // b for a, b in exact], dtype=object)


def _filled(values: np.ndarray, lengths: np.ndarray, dim: int) -> np.ndarray:
    """Lists end to end -> a row each, filled up with zeros."""
    if len(lengths) and (lengths == dim).all():
        return values.reshape(len(lengths), dim)
    out = np.zeros((len(lengths), dim), dtype=values.dtype)
    starts = np.cumsum(lengths) - lengths
    rows = np.repeat(np.arange(len(lengths)), lengths)
    out[rows, np.arange(len(values)) - starts[rows]] = values
    return out


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return (d * d).sum(axis=-1)


def screened(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """For each row of ``x`` and entry of ``book`` (int64): whether the entry's interval overlaps that of the best.

    With u = 2^-24, a product of d terms has an error of at most (d + 2)u |x||c|, with both
    roundings to float32; the square and the difference add u each of what they are; so do the two
    interval ends. (d + 8) * 2u times (|c|^2 + 2|x||c|) is more than all of these together.
    """
    d = x.shape[1]
    squares = (book * book).sum(axis=1)
    norm_c, norm_x = np.sqrt(squares.astype(np.float64)), np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
    near = squares.astype(np.float32) - np.float32(2) * (x.astype(np.float32) @ book.astype(np.float32).T)
    slack = (d + 8) * 2.0**-23
    error = (slack * norm_c**2 * 1.001).astype(np.float32) + np.outer((2 * slack * norm_x * 1.001).astype(np.float32), norm_c.astype(np.float32)) * np.float32(1.001)
    return near - error <= (near + error).min(axis=1, keepdims=True)


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each row's nearest entry (ties: the lower) and its squared distance, exactly."""
    n, index = len(x), np.zeros(len(x), np.int64)
    if x.dtype == object or book.dtype == object:
        for i in range(n):
            index[i] = int(np.argmin(_squares(book, x[i])))
        return index, _squares(x, book[index])
    for at in range(0, n, BLOCK):
        some = x[at : at + BLOCK]
        overlap = screened(some, book)
        index[at : at + BLOCK] = overlap.argmax(axis=1)
        several = np.flatnonzero(overlap.sum(axis=1) > 1)
        if len(several):
            row, entry = np.nonzero(overlap[several])
            distance = np.empty(len(row), np.int64)
            for k in range(0, len(row), 1 << 16):  # equal entries can make all of them overlap
                distance[k : k + (1 << 16)] = _squares(some[several[row[k : k + (1 << 16)]]], book[entry[k : k + (1 << 16)]])
            order = np.lexsort((entry, distance, row))
            first = order[np.flatnonzero(np.diff(row[order], prepend=-1))]
            index[at + several] = entry[first]
    return index, _squares(x, book[index])


class Codebooks:
    """One integer array (entries, components of a part) for each part position."""

    def __init__(self, books: list[np.ndarray], dim: int, scale: int, wide: bool):
        self.books, self.dim, self.scale, self.wide = books, dim, scale, wide

    @property
    def sha256(self) -> str:
        """Of all components' decimal digits by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(str(int(c)) for book in self.books for c in book.ravel()).encode()).hexdigest()

    def parts_of(self, flat: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
        rows = _filled(_whole(flat, self.scale, self.wide), lengths, self.dim)
        return np.split(rows, len(self.books), axis=1)

    def decode(self, code: str) -> list[int]:
        """The integer components that a code stands for."""
        return [int(c) for k, book in enumerate(self.books) for c in book[int(code[2 * k : 2 * k + 2], 16)]]


def _first_pass(vectors: DataFrame, entries: int) -> DataFrame:
    """(id, vector, longest, largest): of each task the vectors with the smallest ids, and two maxima over all it kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple] = []
        longest, largest, n = 0, 0.0, 0
        for batch in batches:
            keep, flat, lengths = _finite(batch.column("vector"))
            if not keep.any():
                continue
            n += len(lengths)
            longest, largest = max(longest, int(lengths.max())), max(largest, float(np.abs(flat).max(initial=0.0)))
            ends = np.cumsum(lengths)
            ids = batch.column("id").filter(pa.array(keep))
            null, values = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(zero_copy_only=False)
            # Those of ids up to the last one taken, so that rows repeating it are compared by components.
            order = np.lexsort((values, null))[:entries]
            edge = (bool(null[order[-1]]), values[order[-1]].item())
            taken = np.flatnonzero((null < edge[0]) | ((null == edge[0]) & (values <= edge[1])))
            best += [((bool(null[i]), values[i].item()), flat[ends[i] - lengths[i] : ends[i]].tolist()) for i in taken]
            best = sorted(best)[:entries]
        if n:
            out = {"id": pa.array([None if k[0] else k[1] for k, _ in best], pa.int64()), "vector": pa.array([v for _, v in best], pa.list_(pa.float64()))}
            out |= {"longest": pa.array([longest] * len(best), pa.int64()), "largest": pa.array([largest] * len(best), pa.float64())}
            yield pa.RecordBatch.from_pydict(out)

    return vectors.mapInArrow(run, "id long, vector array<double>, longest long, largest double")


def _sums(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """(part, entry, lane, n, s0...): of each task the number and sums of what falls to each entry, ``LANES`` components a row."""
    kind = "string" if books.wide else "long"
    schema = "part int, entry int, lane int, n long, " + ", ".join(f"s{k} {kind}" for k in range(LANES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = books.dim // len(books.books)
        n = [np.zeros(len(b), np.int64) for b in books.books]
        total = [np.zeros((len(b), size), object if books.wide else np.int64) for b in books.books]
        for batch in batches:
            keep, flat, lengths = _finite(batch.column("vector"))
            if not keep.any():
                continue
            for p, x in enumerate(books.parts_of(flat, lengths)):
                index, _ = nearest(x, books.books[p])
                order = np.argsort(index, kind="stable")
                starts = np.flatnonzero(np.diff(index[order], prepend=-1))
                total[p][index[order][starts]] += np.add.reduceat(x[order], starts, axis=0)
                n[p] += np.bincount(index, minlength=len(n[p]))
        for p in range(len(n)):
            used = np.flatnonzero(n[p])
            for lane in range(max(1, -(-size // LANES)) if len(used) else 0):
                own = total[p][used][:, lane * LANES : (lane + 1) * LANES]
                filled = np.zeros((len(used), LANES), own.dtype)
                filled[:, : own.shape[1]] = own
                columns = [pa.array([p] * len(used), pa.int32()), pa.array(used, pa.int32()), pa.array([lane] * len(used), pa.int32()), pa.array(n[p][used], pa.int64())]
                columns += [pa.array([str(v) for v in filled[:, k]] if books.wide else filled[:, k]) for k in range(LANES)]
                yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "lane", "n", *[f"s{k}" for k in range(LANES)]])

    parted = vectors.mapInArrow(run, schema)
    keys, lanes = ["part", "entry", "lane"], [f"s{k}" for k in range(LANES)]
    if not books.wide:
        return parted.groupBy(*keys).agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in lanes])

    def merge(pdf):
        out = pdf.iloc[:1].copy()
        out["n"] = pdf["n"].sum()
        for s in lanes:
            out[s] = str(sum(map(int, pdf[s])))
        return out

    return parted.groupBy(*keys).applyInPandas(merge, schema)


def train(vectors: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks | None:
    """Codebooks of the kept rows of (id, vector); None where there are none."""
    if not 1 <= entries <= 256:
        raise ValueError("train: a code has two hex digits for each part, so 1 to 256 entries")
    ship(vectors.sparkSession)
    first = written(_first_pass(vectors, entries))
    longest, largest = first.agg(F.max("longest"), F.max("largest")).first()
    if longest is None:
        return None
    dim = -(-longest // parts) * parts
    # Differences of two components, squared and summed over a part, stay below 2^62.
    wide = largest * scale + 1 > (2**60 / max(1, dim // parts)) ** 0.5
    start = first.orderBy(F.asc_nulls_last("id"), "vector").limit(entries).select("vector").collect()
    flat, lengths = np.array([x for r in start for x in r.vector], dtype=np.float64), np.array([len(r.vector) for r in start])
    books = Codebooks([np.zeros((1, dim // parts))] * parts, dim, scale, wide)
    books.books = books.parts_of(flat, lengths)
    for _ in range(rounds):
        new = [b.copy() for b in books.books]
        for r in _sums(vectors, books).collect():  # parts x entries x components at most
            lane = r.lane * LANES
            for k, at in enumerate(range(lane, min(lane + LANES, dim // parts))):
                new[r.part][r.entry, at] = int(r[f"s{k}"]) // r.n
        books = Codebooks(new, dim, scale, wide)
    return books


def encode(vectors: DataFrame, books: Codebooks, keep_columns: list[str]) -> DataFrame:
    """Kept rows of (keep_columns..., vector) -> keep_columns..., code string, error long."""
    schema = vectors.select(*keep_columns).schema.add("code", "string").add("error", "long")
    ship(vectors.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hexes = np.array([f"{i:02x}" for i in range(256)], dtype=object)
        for batch in batches:
            keep, flat, lengths = _finite(batch.column("vector"))
            if not keep.any():
                continue
            code, error = None, 0
            for p, x in enumerate(books.parts_of(flat, lengths)):
                index, distance = nearest(x, books.books[p])
                code, error = hexes[index] if code is None else code + hexes[index], error + distance
            kept = batch.filter(pa.array(keep))
            errors = pa.array([int(e) if e < LONG else None for e in error] if books.wide else error, pa.int64())
            yield pa.RecordBatch.from_arrays([*[kept.column(c) for c in keep_columns], pa.array(code, pa.string()), errors], schema.names)

    return vectors.select(*keep_columns, "vector").mapInArrow(run, schema)


def decoded(codes: DataFrame, books: Codebooks, *, code_col: str = "code", output: str = "vector") -> DataFrame:
    """``codes`` with the vector that each code stands for: its entries end to end, in the scale of the input."""
    ship(codes.sparkSession)

    @F.udf("array<double>")
    def back(code: str | None):
        return None if code is None else [c / books.scale for c in books.decode(code)]

    return codes.withColumn(output, back(code_col))


def with_group_sums(rows: DataFrame, key: str, value: str, output: str) -> DataFrame:
    """Written ``rows`` with the sum of ``value`` over rows of equal ``key``, nulls together; null beyond a long.

    Keys with ``HOT_SHARE`` of all rows are at most 1 / ``HOT_SHARE``, so their sums are broadcast;
    rows of the others are joined, none of which is large.
    """
    exact = F.sum(F.col(value).cast("decimal(38,0)"))
    sums = rows.groupBy(F.col(key).alias("__key")).agg(exact.alias("__sum"), F.count("*").alias("__n"), F.count(value).alias("__known"))
    whole = F.when((F.col("__known") == F.col("__n")) & (F.col("__sum") < F.lit(str(LONG)).cast("decimal(38,0)")), F.col("__sum").cast("long"))
    sums = written(sums.select("__key", whole.alias("__sum"), "__n"))
    total = sums.agg(F.sum("__n")).first()[0] or 0
    hot = (F.col("__n") >= F.lit(total * HOT_SHARE)) | F.col("__key").isNull()
    same = F.col(key).eqNullSafe(F.col("__key"))
    marked = rows.join(F.broadcast(sums.where(hot).withColumn("__hot", F.lit(True))), same, "left")
    done = marked.where("__hot").select(*rows.columns, F.col("__sum").alias(output))
    cold = sums.where(~hot)
    if cold.isEmpty():
        return done
    rest = marked.where("__hot is null").select(*rows.columns).join(cold, F.col(key) == F.col("__key"))
    return done.unionByName(rest.select(*rows.columns, F.col("__sum").alias(output)))


def compress(rows: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", **options) -> tuple[DataFrame, Codebooks | None]:
    """(id, label, code, error) of all kept rows, and the codebooks."""
    vectors = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), F.col(label_col).alias("label"))
    books = train(vectors.select("id", "vector"), **options)
    if books is None:
        return rows.sparkSession.createDataFrame([], vectors.select("id", "label").schema.add("code", "string").add("error", "long")), None
    return encode(vectors, books, ["id", "label"]), books


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = compress(spread(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))
    found = with_group_sums(written(codes), "label", "error", "label_error")
    return found.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(books.sha256 if books else "").alias("codebooks_sha256"))


def oracle_sql() -> str:
    """All rounds as DuckDB SQL: squared distances are whole numbers below 2^53, so doubles hold them exactly."""
    distance = "list_inner_product(a.x, a.x) - 2 * list_inner_product(a.x, b.x) + list_inner_product(b.x, b.x)"
    rounds = []
    for k in range(ROUNDS + 1):
        rounds.append(
            f"""near{k} AS MATERIALIZED (
  SELECT rn, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d
  FROM (SELECT a.rn, a.part, b.entry, {distance} AS d FROM parts a JOIN book{k} b USING (part))
  GROUP BY rn, part)"""
        )
        if k < ROUNDS:
            rounds.append(
                f"""moved{k} AS (
  SELECT part, entry, list(c ORDER BY pos) AS x
  FROM (SELECT part, entry, pos, floor(sum(v) / count(*)) AS c
        FROM (SELECT part, entry, unnest(x) AS v, generate_subscripts(x, 1) AS pos FROM parts JOIN near{k} USING (rn, part))
        GROUP BY part, entry, pos)
  GROUP BY part, entry),
book{k + 1} AS MATERIALIZED (
  SELECT part, entry, coalesce(m.x, b.x) AS x FROM book{k} b LEFT JOIN moved{k} m USING (part, entry))"""
            )
    return f"""
WITH kept AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS rn, [floor({SCALE} * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
parts AS MATERIALIZED (
  SELECT rn, part, v[part * (len(v) // {PARTS}) + 1 : (part + 1) * (len(v) // {PARTS})] AS x FROM kept, range({PARTS}) AS r(part)),
book0 AS (SELECT part, rn - 1 AS entry, x FROM parts WHERE rn <= {ENTRIES}),
{", ".join(rounds)},
coded AS (
  SELECT rn, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM near{ROUNDS} GROUP BY rn),
sums AS (SELECT label, sum(error)::BIGINT AS label_error FROM kept JOIN coded USING (rn) GROUP BY label),
hashed AS (
  SELECT sha256(string_agg(v::BIGINT::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256
  FROM (SELECT part, entry, unnest(x) AS v, generate_subscripts(x, 1) AS pos FROM book{ROUNDS}))
SELECT vec_id, code, error, label_error, codebooks_sha256
FROM kept JOIN coded USING (rn) JOIN sums ON kept.label IS NOT DISTINCT FROM sums.label, hashed
"""
