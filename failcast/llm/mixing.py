"""Mix sources to target weights by cube-method balanced sampling.

A source's target, divided by its size, is the mean number of times that each of its
documents is taken. The whole part is taken for sure; the fraction is an inclusion
probability for the cube method. The flight phase takes three undecided documents at a
time and moves their probabilities along the null space of the two balancing
constraints (documents and words), until one of the three is decided; both totals stay
exactly what they were. Two undecided documents are left of each block, and blocks'
leftovers meet again in fewer blocks. Of a source with several blocks ``LANDED`` documents,
chosen by hash, wait for its last block, whatever other sources have left. Of that block as many,
spread over its sizes, sit out the flight; they and the two that are left are landed together,
on the choice nearest to the target.

Blocks hold about ``BLOCK`` documents (the last also those that waited), whichever source they are of. Which documents are
taken follows from ids, sizes and the seed alone, so reruns and retries agree.

Defined cases: a null text has size 0; a null source is a source of its own, ordered
last; documents of size 0 are balanced by number only; rows that repeat an id are
separate documents; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from failcast.deploy import ship
from failcast.llm.common import documents, n_words, rank_of, small_side, whole_text, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
BLOCK = 4_000
LEAST_BLOCK = 4
NEAR = 1e-9
LANDED = 14


def source_targets(sizes: DataFrame, *, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size) -> with ``target``: shares by weight, capped at ``most`` times the size, the excess reshared.

    Each round of resharing is one aggregate over the table of sources; it ends when no
    further source reaches its cap.
    """
    last = F.col("source").isNull().cast("int")
    ranked = rank_of(sizes, [last, F.col("source")], "__rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("__rank") % len(weights) + 1).cast("int"))
    # More sources than rows in one partition stay spread out; nothing here is collected but sums.
    table = written(ranked.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * F.lit(most)).alias("cap")))
    total = float(table.agg(F.sum("source_size")).first()[0] or 0) * share
    level = 0.0
    while True:
        capped = F.col("cap") <= F.col("weight") * F.lit(level)
        held, free = table.agg(F.sum(F.when(capped, F.col("cap")).otherwise(0.0)), F.sum(F.when(capped, 0.0).otherwise(F.col("weight")))).first()
        if not free:
            break
        new = (total - held) / free
        if new <= level:
            break
        level = new
    return table.select("source", "source_size", F.least("cap", F.col("weight") * F.lit(level)).alias("target"))


def flight(p: np.ndarray, size: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """Move probabilities until at most two are undecided; sum(p) and sum(p * size) stay."""
    p = p.astype(float).copy()
    undecided = (p > NEAR) & (p < 1 - NEAR)
    p[~undecided] = np.round(p[~undecided])
    open_ = np.flatnonzero(undecided).tolist()
    hold: list[int] = []
    values, sizes, draws = p.tolist(), size.tolist(), draw.tolist()
    for at in open_:
        hold.append(at)
        while len(hold) == 3:
            a, b, c = hold
            u, v, w = sizes[b] - sizes[c], sizes[c] - sizes[a], sizes[a] - sizes[b]
            if u == v == w == 0:
                u, v, w = 1.0, -1.0, 0.0
            up = down = math.inf
            for i, d in ((a, u), (b, v), (c, w)):
                if d > 0:
                    up, down = min(up, (1 - values[i]) / d), min(down, values[i] / d)
                elif d < 0:
                    up, down = min(up, -values[i] / d), min(down, (values[i] - 1) / d)
            step = up if draws[a] * (up + down) < down else -down
            draws[a] = (draws[a] * 7919.0 + draws[b] + 0.6180339887498949) % 1.0
            for i, d in ((a, u), (b, v), (c, w)):
                values[i] = min(1.0, max(0.0, values[i] + step * d))
            decided = [i for i in hold if not NEAR < values[i] < 1 - NEAR]
            for i in decided or [min(hold, key=lambda i: min(values[i], 1 - values[i]))]:
                values[i] = float(round(values[i]))
                hold.remove(i)
    return np.array(values)


def _landed(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Decide the undecided, ``LANDED`` + 2 at most: the choice whose words, and then number, are nearest to what they should be."""
    open_ = np.flatnonzero((p > NEAR) & (p < 1 - NEAR))
    out = np.round(p)
    if len(open_):
        choices = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_))) & 1
        words, number = choices @ size[open_] - p[open_] @ size[open_], choices.sum(1) - p[open_].sum()
        out[open_] = choices[np.argmin(np.abs(words) + np.abs(number) * 0.02 * (1 + size.mean()))]
    return out


def fly_and_land(p: np.ndarray, size: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """Decide all documents of a last block."""
    undecided = np.flatnonzero((p > NEAR) & (p < 1 - NEAR))
    by_size = undecided[np.argsort(size[undecided], kind="stable")]
    out = by_size[np.unique(np.linspace(0, len(by_size) - 1, LANDED).round().astype(int))] if len(by_size) else by_size
    rest = np.setdiff1d(np.arange(len(p)), out)
    flown = p.astype(float).copy()
    flown[rest] = flight(p[rest], size[rest], draw[rest])
    return _landed(flown, size)


def cube_sample(units: DataFrame, group: list[str], *, seed: int = 9, block: int = BLOCK) -> DataFrame:
    """(uid, group..., prob, size) -> (uid, chosen int): a sample balanced on number and size within every group.

    Blocks are dealt by the rows that fly; those that wait only join the last one. A turn leaves two
    rows of each block at most, so with ``block`` at least 4 every turn has fewer rows than the one before.
    """
    if block < LEAST_BLOCK:
        raise ValueError(f"cube_sample: a block of fewer than {LEAST_BLOCK} documents may decide none of them")
    ship(units.sparkSession)
    keys = [*group, "block"]
    units = units.withColumn("prob", F.col("prob").cast("double")).withColumn("size", F.col("size").cast("double"))
    open_ = f"prob > {NEAR} and prob < {1 - NEAR}"
    now = written(units.where(open_).select("uid", *group, "prob", "size", F.lit(False).alias("waits")))
    done = [units.where(f"not ({open_})").select("uid", F.round("prob").alias("prob"))]
    schema = now.schema
    turn, before = 0, None
    while True:
        flying = F.count_if(~F.col("waits"))
        counts = written(now.groupBy(*group).agg(F.greatest(F.lit(1), F.ceil(flying / F.lit(block))).cast("int").alias("blocks"), flying.alias("flying")))
        most, rows = counts.agg(F.max("blocks"), F.sum(F.when(F.col("blocks") > 1, F.col("flying")))).first()
        last = (most or 1) == 1
        if not last and before is not None and rows >= before:
            raise RuntimeError(f"cube_sample: turn {turn} decided no document")
        before = rows
        salt = F.lit(f"{seed}.{turn}")
        same = F.lit(True)
        for g in group:
            same = same & F.col(g).eqNullSafe(F.col(f"__{g}"))
        dealt = now.join(small_side(counts.select(*[F.col(g).alias(f"__{g}") for g in group], "blocks")), same).drop(*[f"__{g}" for g in group])
        if turn == 0 and not last:
            # One document of each stratum of hashes: ``LANDED`` at most for each group.
            stratum = F.pmod(F.xxhash64("uid", F.lit("stratum")), F.lit(LANDED))
            waiting = written(dealt.where("blocks > 1").groupBy(*group, stratum.alias("stratum")).agg(F.min("uid").alias("__waits")).select("__waits"))
            dealt = dealt.join(small_side(waiting), F.col("uid") == F.col("__waits"), "left").withColumn("waits", F.col("__waits").isNotNull()).drop("__waits")
        held = F.col("waits") & (F.col("blocks") > 1)
        flying_now = dealt.where(~held).withColumn("block", F.pmod(F.xxhash64(salt, "uid"), F.col("blocks")).cast("int")).withColumn("draw", F.pmod(F.xxhash64("uid", salt), F.lit(1 << 30)) / float(1 << 30))

        def fly(pdf: pd.DataFrame) -> pd.DataFrame:
            landing = pdf["blocks"].iloc[0] == 1  # of this group; others may have more
            pdf = pdf.sort_values(["draw", "uid"], kind="stable").reset_index(drop=True)
            p, size = pdf["prob"].to_numpy(float), pdf["size"].to_numpy(float)
            pdf["prob"] = (fly_and_land if landing else flight)(p, size, pdf["draw"].to_numpy(float))
            return pdf[[f.name for f in schema]]

        flown = written(flying_now.groupBy(*keys).applyInPandas(fly, schema))
        done.append(flown.where(f"not ({open_})").select("uid", F.round("prob").alias("prob")))
        if last:
            break
        now = written(flown.where(open_).unionByName(dealt.where(held).select(*schema.names)))
        turn += 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("uid", F.col("prob").cast("int").alias("chosen"))


def uid(id_: Column, hash_: Column, number: Column) -> Column:
    """A name for a row that reruns give it again."""
    return F.concat_ws(":", F.coalesce(id_.cast("string"), F.lit("-")), F.hex(hash_), number)


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 9) -> DataFrame:
    """(doc_id, size, source_size, target, copies long, uid): how often the mix takes each row of ``docs``."""
    text = whole_text(text_col)
    order = Window.partitionBy("doc_id", "hash").orderBy(F.lit(0))
    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(text).alias("size"), F.xxhash64(text, F.col(source_col)).alias("hash"))
    # Rows alike in id, text and source differ by a number alone; which of them gets which does not matter.
    rows = written(sized.withColumn("uid", uid(F.col("doc_id"), F.col("hash"), F.row_number().over(order))).drop("hash"))
    targets = written(source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights=weights, share=share, most=most))
    per = targets.select(F.col("source").alias("__source"), "source_size", "target")
    joined = rows.join(small_side(per), F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    mean = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(mean + NEAR)
    planned = written(joined.withColumn("whole", whole.cast("long")).withColumn("prob", F.greatest(F.lit(0.0), mean - whole)))
    chosen = cube_sample(planned.select("uid", "source", "prob", F.col("size").cast("double").alias("size")), ["source"], seed=seed)
    return planned.join(chosen, "uid").withColumn("copies", F.col("whole") + F.col("chosen")).select("doc_id", "uid", "source", "size", "source_size", "target", "copies")


def repeat_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """``docs`` as the mix takes them: rows left out, or repeated as often as they are taken.

    Rows alike in id, text and source share one line of how many of them are taken how often, so rows move once.
    """
    found = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    keys = ["__id", "__hash"]
    found = found.select(*[F.regexp_extract("uid", "^(.*):([0-9A-F]+):[0-9]+$", i + 1).alias(k) for i, k in enumerate(keys)], "copies")
    per = found.groupBy(*keys, "copies").agg(F.count("*").alias("n"))
    shares = per.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("copies", "n")), asc=False).alias("__shares"))
    marked = docs.withColumn("__id", F.coalesce(F.col(id_col).cast("string"), F.lit("-"))).withColumn("__hash", F.hex(F.xxhash64(whole_text(text_col), F.col(source_col))))
    joined = marked.join(shares.where(F.col("__shares")[0]["copies"] > 0), keys)
    # The first n of them by the first line, the next by the second: at most one line for each number of copies.
    number = F.when(F.size("__shares") == 1, F.lit(1)).otherwise(F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0))))
    turn = F.aggregate("__shares", F.struct(F.lit(0).cast("long").alias("to"), F.lit(-1).cast("long").alias("copies")), lambda a, x: F.struct((a["to"] + x["n"]).alias("to"), F.when((a["copies"] < 0) & (F.col("__number") <= a["to"] + x["n"]), x["copies"]).otherwise(a["copies"]).alias("copies")))
    taken = joined.withColumn("__number", number).withColumn("__copies", turn["copies"]).where("__copies > 0")
    return taken.withColumn("__turn", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))).select(*docs.columns)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mix(documents(spark, sf_dir).select("doc_id", "source", "text"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
