"""Temporal split, entity overlap and class rebalancing."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from failcast.functions.scalars import micros
from failcast.schema import LABEL, POSITIVE_RATE, TIME, TRAIN_FRACTION, VALIDATION_FRACTION, ContractError, require


@dataclass(frozen=True)
class Cuts:
    """Microseconds up to which (inclusive) rows are train, then validation."""

    train_to: int
    val_to: int


#: Counts that the driver gets for each rank and round.
SLICES = 1 << 16


def _at_ranks(values: DataFrame, ranks: list[int], low: int, high: int) -> list[tuple[int, int]]:
    """(v long) between ``low`` and ``high`` -> for each rank the value of that rank, and how many are up to it.

    The range is cut into at most ``SLICES`` slices, and the slice that holds a rank is cut
    again; all ranks share a round, which is one narrow aggregate. No task sorts the values.
    """
    found: list[tuple[int, int] | None] = [None] * len(ranks)
    state = [(low, high, 0)] * len(ranks)
    while open_ := [i for i, x in enumerate(found) if x is None]:
        steps = {i: max(1, -(-(state[i][1] - state[i][0] + 1) // SLICES)) for i in open_}
        # Ranks that are still in the same range share its counts.
        same = {i: min(j for j in open_ if state[j] == state[i]) for i in open_}
        places = [F.when(F.col("v").between(*state[i][:2]), F.struct(F.lit(i).alias("i"), F.floor((F.col("v") - F.lit(state[i][0])) / steps[i]).cast("long").alias("slice"))) for i in sorted(set(same.values()))]
        counted = values.select(F.explode(F.array_compact(F.array(*places))).alias("x")).groupBy("x.i", "x.slice").agg(F.count("*").alias("n"))
        by: dict[int, list] = {}
        for r in sorted(counted.collect()):
            by.setdefault(r.i, []).append((r.slice, r.n))
        for i in open_:
            start, end, before = state[i]
            for at, n in by.get(same[i], ()):
                if before + n > ranks[i]:
                    start = start + at * steps[i]
                    end = min(end, start + steps[i] - 1)
                    state[i] = (start, end, before)
                    if start == end:
                        found[i] = (start, before + n)
                    break
                before += n
            else:
                raise ContractError("a rank beyond the rows")
    return found  # type: ignore[return-value]


def cut_times(df: DataFrame, *, time_col: str = TIME, train_frac: float = TRAIN_FRACTION, val_frac: float = VALIDATION_FRACTION) -> Cuts:
    """Where the split falls: rows tied with a boundary go to the earlier part."""
    if not (0 < train_frac < 1 and 0 < val_frac < 1 and train_frac + val_frac < 1):
        raise ValueError("fractions must be over 0 and leave a test part")
    require(df, [time_col], "temporal_split")
    times = df.where(F.col(time_col).isNotNull()).select(micros(df, time_col).alias("v"))
    n, low, high = times.agg(F.count("*"), F.min("v"), F.max("v")).first()
    if not n:
        raise ContractError("temporal_split: the frame is empty")
    n_train, n_val = int(n * train_frac), int(n * val_frac)
    if not n_train or not n_val:
        raise ContractError("temporal_split: too few rows")
    (first, taken), (second, _) = _at_ranks(times, [n_train - 1, n_train + n_val - 1], low, high)
    # Ties moved into train can reach into what would have been validation.
    if taken >= n_train + n_val or second <= first or high <= second:
        raise ContractError("temporal_split: a part collapsed")
    return Cuts(first, second)


def assigned(df: DataFrame, cuts: Cuts, *, time_col: str = TIME) -> DataFrame:
    """``df`` with split = train, val or test: a comparison, no shuffle."""
    us = micros(df, time_col)
    return df.withColumn("split", F.when(us <= cuts.train_to, "train").when(us <= cuts.val_to, "val").otherwise("test"))


def split_metrics(marked: DataFrame, *, time_col: str = TIME, label_col: str = LABEL) -> DataFrame:
    rate = F.avg(F.col(label_col).cast("double")) if label_col in marked.columns else F.lit(None).cast("double")
    return marked.groupBy("split").agg(F.count("*").alias("n_rows"), F.min(time_col).alias("start"), F.max(time_col).alias("end"), rate.alias("positive_rate"))


def temporal_split(df: DataFrame, *, time_col: str = TIME, label_col: str = LABEL, train_frac: float = TRAIN_FRACTION, val_frac: float = VALIDATION_FRACTION):
    """(train, val, test, metrics): strictly ordered in time."""
    cuts = cut_times(df, time_col=time_col, train_frac=train_frac, val_frac=val_frac)
    marked = assigned(df, cuts, time_col=time_col)
    parts = [marked.where(F.col("split") == s).drop("split") for s in ("train", "val", "test")]
    return *parts, split_metrics(marked, time_col=time_col, label_col=label_col)


def entity_overlap(left: DataFrame, right: DataFrame, key: str = "pod_uid") -> DataFrame:
    return left.select(key).intersect(right.select(key))


def write_entity_overlap_opt_in(out_dir: str | Path, allowed=("pod_uid",)) -> Path:
    path = Path(out_dir) / "entity_overlap.json"
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(sorted(set(allowed)), indent=2))
    return path


@dataclass(frozen=True)
class Balance:
    n_positive: int
    n_negative: int
    n_kept: int

    @property
    def sample_ratio(self) -> float:
        return self.n_kept / self.n_negative if self.n_negative else 1.0

    def as_dict(self) -> dict:
        return asdict(self) | {"sample_ratio": self.sample_ratio}


def negatives_to_keep(n_positive: int, n_negative: int, rate: float = POSITIVE_RATE) -> Balance:
    """Exactly how many negatives give the rate; all of them where it is reached already."""
    if not 0 < rate < 1:
        raise ValueError("the target rate must be between 0 and 1")
    if n_positive + n_negative == 0:
        raise ContractError("downsample_negatives: the frame is empty")
    if not n_positive:
        raise ContractError("downsample_negatives: no positive rows")
    return Balance(n_positive, n_negative, min(n_negative, round(n_positive * (1 - rate) / rate)))


def downsample_negatives(df: DataFrame, *, label_col: str = LABEL, target_positive_rate: float = POSITIVE_RATE, keys=None, random_state: int = 42, order: Column | None = None) -> tuple[DataFrame, float]:
    """All positives and an exact number of negatives, the least by a seeded hash of ``keys``, or by ``order``.

    ``order`` is a whole number from 0 to 2^63 - 1 for each row, for a choice that other systems can make too.

    Counts of the hashes' top bits find the bound like a rank in time; the slice that holds it is
    counted finer. Rows that tie at the bound are settled by a window over those rows alone.
    """
    require(df, [label_col], "downsample_negatives")
    keys = list(keys or [c for c in df.columns if c != label_col])
    # The hash is taken as a whole number below 2^63, so that ranges of it do not overflow.
    hashed = F.shiftrightunsigned(F.xxhash64(F.lit(random_state), *keys), 1) if order is None else order.cast("long")
    marked = df.withColumn("__hash", hashed)
    positive = F.col(label_col) == 1
    n_pos, n_neg = df.agg(F.count_if(positive), F.count_if(~positive)).first()
    plan = negatives_to_keep(n_pos, n_neg, target_positive_rate)
    if plan.n_kept == plan.n_negative:
        return df, 1.0
    if plan.n_kept == 0:
        return df.where(positive), 0.0
    bound, up_to = _hash_at_rank(marked.where(~positive).select(F.col("__hash").alias("v")), plan.n_kept - 1)
    if up_to == plan.n_kept:  # no tie is cut
        return marked.where(positive | (F.col("__hash") <= bound)).drop("__hash"), plan.sample_ratio
    at = marked.where(~positive & (F.col("__hash") == bound)).withColumn("__n", F.row_number().over(Window.partitionBy("__hash").orderBy(*keys)))
    tied = at.count()
    kept = marked.where(positive | (F.col("__hash") < bound)).unionByName(at.where(F.col("__n") <= tied - (up_to - plan.n_kept)).drop("__n"))
    return kept.drop("__hash"), plan.sample_ratio


#: So many hashes of one slice are looked at one by one.
LOOKED_AT = 100_000


def _hash_at_rank(hashes: DataFrame, rank: int) -> tuple[int, int]:
    """The hash of this rank and how many are up to it: one pass, or a few where there are billions, and one over a narrow slice."""
    low, bits, before = 0, 63, 0
    while True:
        step = max(0, bits - 16)
        inside = hashes.where(F.col("v").between(low, low + (1 << bits) - 1))
        counts = inside.groupBy(F.shiftright("v", step).alias("slice")).agg(F.count("*").alias("n")).collect()
        for r in sorted(counts):
            if before + r.n > rank:
                break
            before += r.n
        low, bits = r.slice << step, step
        if not step:
            return low, before + r.n
        if r.n <= LOOKED_AT:
            values = sorted(x[0] for x in hashes.where(F.col("v").between(low, low + (1 << bits) - 1)).collect())
            value = values[rank - before]
            return value, before + sum(v <= value for v in values)
