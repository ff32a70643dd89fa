"""Exact top-k search by inner product, with segment statistics at several resolutions.

A vector is cut into 1, 4, 16 … segments. Segment means and deviations bound the distance of two
vectors from below, which with the exact norms bounds their inner product from above:

    x . y  <=  sum over segments of  length * (mean_x * mean_y + deviation_x * deviation_y)

Vectors of similar statistics lie in common blocks. Every query first meets the block it lies in, which gives it a
k-th best score to start from. The ranges of a block's statistics then bound what the query could find
in any other block, and it goes only to blocks that may hold something better. There candidates are judged
from coarse to fine, as long as that rules enough of them out; those left get their exact score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeloft.llm.common import workers
from gaugeloft.operators.joins import join_small
from gaugeloft.session import settle

LEVELS = (1, 4, 16)
#: Segments whose ranges describe a block, and those whose signs order the rows.
COARSE, SIGNS = 4, 16
BLOCK = 8192
STRIP = 128
#: A finer level is worth its cost only after one that ruled out this share of what it was given.
WORTH = 0.1
#: Blocks whose ranges go to the tasks at once.
RANGES = 50_000
SLACK = 1e-9
EXACT = 1 << 53
LONG = (1 << 63) - 1
ROWS = "row bigint, id bigint, asks boolean, dim int, v array<double>, coarse array<double>, pattern int, mean double"
FOUND = "row bigint, query_id bigint, vec_id bigint, score bigint"


def segment_features(x: np.ndarray, segments: int) -> np.ndarray:
    """Per segment sqrt(length) * mean and sqrt(length) * deviation, so that bounds are dot products."""
    dim = x.shape[1]
    starts = np.unique(np.linspace(0, dim, min(segments, dim) + 1).astype(int)[:-1])
    lengths = np.diff(np.append(starts, dim))
    root = np.sqrt(lengths)
    mean = np.add.reduceat(x, starts, axis=1) / lengths
    spread = x - np.repeat(mean, lengths, axis=1)
    return np.hstack([mean * root, np.sqrt(np.add.reduceat(spread * spread, starts, axis=1))])


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of paired rows; beyond a long they are cut to its ends."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1]
    if top < 2**62:
        return np.einsum("ij,ij->i", q.astype(np.int64), c.astype(np.int64))
    exact = [sum(int(a) * int(b) for a, b in zip(x, y, strict=True)) for x, y in zip(q, c, strict=True)]
    return np.array([min(max(s, -LONG - 1), LONG) for s in exact], dtype=np.int64)


def largest_score(q: np.ndarray, c: np.ndarray) -> float:
    return float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1]


def _best(scores: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row the k best columns that reach its floor, equal ones from the left; -inf is no score."""
    if scores.shape[1] > k:
        floor = np.maximum(floor, np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k])
    row, column = np.nonzero((scores >= floor[:, None]) & (scores > -np.inf))
    value = scores[row, column]
    order = np.lexsort((column, -value, row))
    row, column, value = row[order], column[order], value[order]
    best = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[best], column[best], value[best]


def best_of_block(q: np.ndarray, q_ids: np.ndarray, c: np.ndarray, c_ids: np.ndarray, k: int, reach: np.ndarray, tally: dict | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each query its k best candidates of other ids with a score of ``reach`` or more: query index, candidate index, score.

    Candidates come sorted by id. Scores are products of whole numbers, which doubles hold exactly below 2**53, so
    what the bounds leave is scored by a matrix product; larger ones pair by pair. ``tally`` counts pairs, and those
    that got an exact score.
    """
    out: list[tuple] = []
    tally = {} if tally is None else tally
    wide = largest_score(q, c) >= EXACT
    fine_q, fine_c = ([], []) if wide else ([segment_features(x, s) for s in LEVELS] for x in (q, c))
    norm = np.linalg.norm(c, axis=1).max(initial=0)
    for start in range(0, len(q), STRIP):
        strip = slice(start, start + STRIP)
        own = q_ids[strip, None] == c_ids[None, :]
        if wide:
            out += [_far_out(q, c, c_ids, own[i - start], i, k) for i in range(start, min(len(q), start + STRIP))]
            continue
        floor = reach[strip]
        low = floor - SLACK * (np.abs(floor) + np.linalg.norm(q[strip], axis=1) * norm) - 0.5
        columns, alive = np.arange(len(c)), np.ones(own.shape, dtype=bool)
        for fq, fc in zip(fine_q, fine_c, strict=True):
            before = int(alive.sum())
            alive &= fq[strip] @ fc[columns].T >= low[:, None]
            some = alive.any(axis=0)
            columns, alive = columns[some], alive[:, some]
            if before - int(alive.sum()) < WORTH * before:
                break
        tally["pairs"] = tally.get("pairs", 0) + own.size
        tally["exact"] = tally.get("exact", 0) + alive.size
        scores = q[strip] @ c[columns].T
        scores[own[:, columns]] = -np.inf
        row, column, value = _best(scores, k, floor)
        out.append((row + start, columns[column], value.astype(np.int64)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, int),) * 3


def _far_out(q: np.ndarray, c: np.ndarray, c_ids: np.ndarray, own: np.ndarray, i: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of one query whose scores may pass what doubles hold exactly."""
    column = np.flatnonzero(~own)
    score = _scores(np.broadcast_to(q[i], (len(column), q.shape[1])), c[column])
    order = sorted(range(len(column)), key=lambda j: (-int(score[j]), column[j]))[:k]
    return np.full(len(order), i), column[order], score[order]


def quantized(vectors: pd.Series, scale: float) -> np.ndarray:
    return np.floor(scale * np.stack([np.asarray(v, dtype=np.float64) for v in vectors]))


def _describer(scale: float):
    """Quantizes vectors and gives each its statistics: of a few segments, and what orders it."""
    names = [c.split()[0] for c in ROWS.split(", ")]
    doubles = pa.list_(pa.float64())

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim in np.unique(batch.column("dim").to_numpy()):
                part = batch.filter(pa.array(batch.column("dim").to_numpy() == dim))
                v = np.floor(scale * part.column("v").flatten().to_numpy().reshape(-1, dim))
                with np.errstate(over="ignore", invalid="ignore"):
                    coarse, fine = (segment_features(v, n) for n in (COARSE, SIGNS))
                    mean = v.mean(axis=1)
                    signs = fine[:, : fine.shape[1] // 2] > (mean * np.sqrt(dim / (fine.shape[1] // 2)))[:, None]
                pattern = (signs * (1 << np.arange(signs.shape[1]))).sum(axis=1).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel()), doubles) for x in (v, coarse)]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names[:4]), *lists, pa.array(pattern), pa.array(mean)], names)

    return describe


def _compare(k: int):
    def compare(key, theirs: pd.DataFrame, mine: pd.DataFrame) -> pd.DataFrame:
        if not len(theirs) or not len(mine):
            return pd.DataFrame({"row": [], "query_id": [], "vec_id": [], "score": []}).astype("int64")
        theirs = theirs.sort_values("id", kind="stable")
        c_ids, q_ids = theirs["id"].to_numpy(), mine["id"].to_numpy()
        reach = mine["reach"].to_numpy(dtype=float, na_value=-np.inf)
        at, found, score = best_of_block(np.stack(mine["v"]), q_ids, np.stack(theirs["v"]), c_ids, k, reach)
        return pd.DataFrame({"row": mine["row"].to_numpy()[at], "query_id": q_ids[at], "vec_id": c_ids[found], "score": score})

    return compare


def _router(ranges: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]):
    """Sends queries to the blocks other than their own whose ranges leave a score of ``reach`` possible.

    ``ranges`` has for each dimension the blocks and the least and greatest of their rows' statistics.
    """

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                if int(dim) not in ranges:
                    continue
                part = batch.filter(pa.array(dims == dim))
                blocks, low, high = ranges[int(dim)]
                f = part.column("coarse").flatten().to_numpy().reshape(part.num_rows, -1)
                reach = part.column("reach").fill_null(-np.inf).to_numpy()
                half = f.shape[1] // 2
                up, down = np.maximum(f[:, :half], 0), np.minimum(f[:, :half], 0)
                with np.errstate(over="ignore", invalid="ignore"):
                    bound = up @ high[:, :half].T + down @ low[:, :half].T + f[:, half:] @ high[:, half:].T
                    size = np.abs(up) @ np.abs(high[:, :half]).T + np.abs(down) @ np.abs(low[:, :half]).T + f[:, half:] @ high[:, half:].T
                    ruled_out = bound + SLACK * size + 0.5 < reach[:, None]
                query, block = np.nonzero(~ruled_out & (blocks[None, :] != part.column("block").to_numpy()[:, None]))
                yield pa.RecordBatch.from_arrays([part.column("row").take(pa.array(query)), pa.array(blocks[block].astype(np.int32))], ["row", "block"])

    return route


def _ranges(stats: DataFrame, first: int, last: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    by_dim: dict[int, list] = {}
    for r in stats.filter(F.col("block").between(first, last)).collect():
        by_dim.setdefault(r["dim"], []).append((r["block"], [x for x in r["low"] if x is not None], [x for x in r["high"] if x is not None]))
    return {dim: tuple(np.array(c) for c in zip(*rows, strict=True)) for dim, rows in by_dim.items()}


def nearest(df: DataFrame, query, k: int, vector_id: str = "vec_id", vector: str = "embedding", scale: float = 256.0, block: int = BLOCK) -> DataFrame:
    """The k highest scores of every query row against all rows of other ids: ``query_id, rank, vec_id, score``.

    ``query`` is a condition on the input's columns; components become floor(scale * x). Equal scores
    go to the smaller id. Rows with a null id, and vectors that are null, empty or hold null or
    non-finite components, take no part. Vectors of different length are not compared. Rows repeated
    under one id are rows of their own, each of which may take a rank; a repeated query asks again.
    Scores beyond a long are cut to its ends.

    Blocks of about ``block`` rows are ranges of the rows' statistics and, last, of a hash, so that copies spread over
    many. A task compares one block of candidates with one block of queries; candidates are copied only for blocks of
    queries of which some may find better there than they have. A last ranking sees k rows per query and
    block. Where the statistics tell nothing apart every query meets every block, as an exact search then must.
    """
    fit = F.expr(f"`{vector_id}` IS NOT NULL AND size(`{vector}`) > 0 AND forall(`{vector}`, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))")
    doubles = F.col(f"`{vector}`").cast("array<double>")
    chosen = workers(df).filter(fit).select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{vector_id}`").cast("bigint").alias("id"), F.coalesce(query, F.lit(False)).alias("asks"),
        F.size(doubles).alias("dim"), doubles.alias("v"),
    )
    described = settle(chosen.mapInArrow(_describer(scale), ROWS))
    total, asking = described.agg(F.count("*"), F.count_if("asks")).first()
    ordered = described.repartitionByRange(-(-total // block) or 1, "dim", "pattern", "mean", F.xxhash64("row"))
    rows = settle(ordered.select("row", "id", "asks", "dim", "v", "coarse", F.spark_partition_id().alias("block")))
    asked = rows.filter("asks").select("row", "id", "v", "dim", "coarse", "block")

    def cells(queries: DataFrame, candidates: DataFrame, cell: list[str]) -> DataFrame:
        return candidates.groupBy(*cell).cogroup(queries.groupBy(*cell)).applyInPandas(_compare(k), FOUND)

    order = W.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    best_of = lambda found: found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    candidates = rows.select("id", "v", "dim", "block")
    unknown = F.lit(None).cast("double").alias("reach")
    at_home = settle(cells(asked.select("row", "id", "v", "dim", "block", unknown), candidates, ["dim", "block"]))
    reach = best_of(at_home).filter(F.col("rank") == k).select("row", F.col("score").cast("double").alias("reach"))
    asked = settle(asked.join(reach, "row", "left"))

    places = range(2 * COARSE)
    stats = settle(rows.groupBy("dim", "block").agg(*[f(F.get("coarse", F.lit(i))).alias(f"{f.__name__}_{i}") for f in (F.min, F.max) for i in places])).select(
        "dim", "block", *[F.array(*[f"{f}_{i}" for i in places]).alias(name) for f, name in (("min", "low"), ("max", "high"))]
    )
    last = rows.agg(F.max("block")).first()[0] or 0
    found = at_home
    for first in range(0, last + 1, RANGES):
        routes = asked.select("row", "dim", "coarse", "reach", "block").mapInArrow(_router(_ranges(stats, first, first + RANGES - 1)), "row bigint, block int")
        part = F.pmod(F.xxhash64("row"), F.lit(-(-asking // block) or 1)).cast("int").alias("part")
        routes = settle(routes.select("row", "block", part))
        sent = routes.join(asked.select("row", "id", "v", "dim", "reach"), "row")
        live = settle(sent.select("dim", "block", "part").distinct())
        copied = join_small(candidates, live.groupBy("dim", "block").agg(F.collect_list("part").alias("parts")), ["dim", "block"]).withColumn("part", F.explode("parts"))
        found = found.unionByName(cells(sent, copied.drop("parts"), ["dim", "block", "part"]))
    return best_of(found).select("query_id", "rank", "vec_id", "score")
