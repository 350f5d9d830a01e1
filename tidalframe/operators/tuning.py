"""Resampling, grids, racing, ranking, stacking.

Every fit is a Spark job; the driver only holds the list of candidates and one
number per candidate and fold.
"""

from __future__ import annotations

import math
import threading
import uuid
from collections.abc import Callable, Sequence
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator, Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidalframe.functions.quantiles import t_quantile
from tidalframe.operators import models
from tidalframe.operators.models import Design
from tidalframe.session import cut_by, cut_lineage

Candidate = tuple[str, Design, Estimator]


def grid(**options: Sequence) -> list[dict]:
    """Every combination of parameter values."""
    return [dict(zip(options, values)) for values in product(*options.values())]


def cross(designs: dict[str, Design], learners: dict[str, Estimator]) -> list[Candidate]:
    """Every pairing of a feature design and a learner."""
    return [(f"{d}_{m}", design, learner) for (d, design), (m, learner) in product(designs.items(), learners.items())]


def out_of_fold(
    df: DataFrame | dict[int, DataFrame], candidates: Sequence[Candidate], keep: Sequence[str], folds: int, parallel: int = 8
) -> DataFrame:
    """Predictions of every candidate on every held-out fold.

    ``df`` carries a ``fold`` column; a dict of tables gives each fold a table of its own,
    whose columns were learnt without it. Feature stages are learnt once per design
    and fold and shared by the learners. Fits run a few at a time, each on the
    whole cluster.
    """
    table = (lambda i: df[i]) if isinstance(df, dict) else (lambda i: df)
    designs = list(dict.fromkeys(design for _, design, _ in candidates))

    def prepare(task):
        design, i = task
        return task, Pipeline(stages=models.stages(design)).fit(table(i).where(F.col("fold") != i))

    def run(task):
        (name, design, learner), i = task
        ready = prepared[design, i].transform  # of chosen rows: a filter does not pass the stages
        model = models.aimed(design, learner).fit(ready(table(i).where(F.col("fold") != i)))
        held = models.tidy(model.transform(ready(table(i).where(F.col("fold") == i))), [*keep, "fold"])
        return held.select(F.lit(name).alias("candidate"), "*")

    with ThreadPool(parallel) as pool:
        prepared = dict(pool.map(prepare, list(product(designs, range(folds))), chunksize=1))
        parts = pool.map(run, list(product(candidates, range(folds))), chunksize=1)
    return reduce(DataFrame.unionByName, parts)


def summarise_folds(fold_metrics: DataFrame, metric: str) -> DataFrame:
    """Mean, count and standard error of a metric per candidate."""
    return fold_metrics.groupBy("candidate").agg(
        F.avg(metric).alias("mean"),
        F.count(metric).alias("n"),
        F.try_divide(F.stddev_samp(metric), F.sqrt(F.count(metric).cast("double"))).alias("std_err"),
    )


def rank_results(summary: DataFrame, metric: str = "mean", largest: bool = False) -> DataFrame:
    """Rank candidates, best first. There is one row per candidate."""
    order = F.col(metric).desc() if largest else F.col(metric).asc()
    return summary.withColumn("rank", F.rank().over(Window.partitionBy(F.lit(0)).orderBy(order)))


def race(
    spark: SparkSession,
    candidates: Sequence,
    evaluate: Callable[[Sequence, int], DataFrame],
    folds: int,
    burn_in: int = 3,
) -> DataFrame:
    """Evaluate fold by fold and drop candidates that are clearly behind.

    After ``burn_in`` folds, and after each further one, a candidate leaves when
    the 95 % interval of its error minus that of the leader lies above zero.
    Returns (candidate, n_folds, mean_metric, dropped).
    """
    scores: dict = {c: [] for c in candidates}
    alive = list(candidates)
    for i in range(folds):
        for row in evaluate(alive, i).collect():
            scores[row["candidate"]].append(row["metric"])
        n = i + 1
        if n < burn_in:
            continue
        leader = min(alive, key=lambda c: (sum(scores[c]) / n, c))
        stay = []
        for c in alive:
            gaps = [a - b for a, b in zip(scores[c], scores[leader])]
            mean = sum(gaps) / n
            sd = math.sqrt(sum((g - mean) ** 2 for g in gaps) / (n - 1))
            if mean - t_quantile(0.975, n - 1) * sd / math.sqrt(n) <= 0:
                stay.append(c)
        alive = stay
    rows = [(c, len(s), sum(s) / len(s), c not in alive) for c, s in scores.items() if s]
    kind = "int" if isinstance(candidates[0], int) else "string"
    return spark.createDataFrame(
        rows, f"candidate {kind}, n_folds int, mean_metric double, dropped boolean"
    )


def stack_weights(
    oof: DataFrame, members: Sequence[str], target: str, penalty: float = 0.01, steps: int = 200
) -> dict[str, float]:
    """Non-negative lasso weights of member probabilities for a 0/1 target.

    Least squares needs only the products of the member columns, added up in
    one pass; coordinate descent then runs on that small matrix.
    """
    import numpy as np

    cols = [*members, target]
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    row = oof.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(a) * F.col(b)).alias(f"s{i}") for i, (a, b) in enumerate(pairs)]).first()
    k = len(members)
    full = np.zeros((k + 1, k + 1))
    full[np.triu_indices(k + 1)] = [row[f"s{i}"] / row["n"] for i in range(len(pairs))]
    full = full + np.triu(full, 1).T
    x, y = full[:k, :k], full[:k, k]
    w = np.zeros(k)
    for _ in range(steps):
        for j in range(k):
            if x[j, j] > 0:
                rest = y[j] - x[j] @ w + x[j, j] * w[j]
                w[j] = max(0.0, (rest - penalty) / x[j, j])
    return {m: float(v) for m, v in zip(members, w)}


def blend(df: DataFrame, weights: dict[str, float], out: str = "blend") -> DataFrame:
    """Members weighted by their share of the total weight."""
    total = sum(weights.values()) or 1.0
    value = F.lit(0.0)
    for member, w in weights.items():
        if w > 0:
            value = value + F.lit(w / total) * F.col(member)
    return df.withColumn(out, value)


# -- racing of learners -----------------------------------------------------


def behind(scores: dict[str, Sequence[float]], level: float = 0.95) -> set[str]:
    """Candidates clearly worse than the best, by repeated-measures analysis of variance.

    ``scores`` holds an error of each candidate on each of the same folds. The residual of
    the sum of a candidate's and a fold's effect is pooled over all candidates; one is
    behind if the interval of its mean less the best mean lies above zero.
    """
    names = sorted(scores)
    c, n = len(names), len(scores[names[0]])
    if c < 2 or n < 2:
        return set()
    own = {x: sum(scores[x]) / n for x in names}
    fold = [sum(scores[x][j] for x in names) / c for j in range(n)]
    grand = sum(own.values()) / c
    rest = sum((scores[x][j] - own[x] - fold[j] + grand) ** 2 for x in names for j in range(n))
    freedom = (c - 1) * (n - 1)
    reach = t_quantile((1 + level) / 2, freedom) * math.sqrt(2 * rest / freedom / n)
    best = min(names, key=lambda x: (own[x], x))
    return {x for x in names if own[x] - own[best] - reach > 0}


def prepared_folds(df: DataFrame, designs: Sequence[Design], keep: Sequence[str], folds: int) -> dict:
    """For each design and fold the rows of the other folds and its own, with features learnt on the others.

    The rows are written once, by fold: a fit reads the other folds, a score its own.
    """
    rows, out = cut_by(df, "fold"), {}
    for design, i in product(dict.fromkeys(designs), range(folds)):
        others, own = rows.where(F.col("fold") != i), rows.where(F.col("fold") == i)
        ready = Pipeline(stages=models.stages(design)).fit(others)
        columns = list(dict.fromkeys([*keep, design.target, "fold"]))
        out[design, i] = tuple(ready.transform(part).select(*columns, "features") for part in (others, own))
    return out


def race_learners(
    df: DataFrame,
    candidates: Sequence[Candidate],
    keep: Sequence[str],
    folds: int,
    error: Callable[[DataFrame], DataFrame],
    burn_in: int = 3,
    parallel: int = 4,
) -> tuple[DataFrame, DataFrame]:
    """Candidates raced over the folds of ``df``: (elimination table, error of each fit that counts).

    All candidates are fitted on the first ``burn_in`` folds, then fold by fold those that
    are not ``behind``. ``error`` makes one number of held-out predictions. The next fold
    is begun while the last one is judged; the jobs of a candidate that leaves are ended
    by their tag, and its later errors do not count, so the table does not depend on speed.
    Columns: candidate, n_folds, mean, dropped.
    """
    from concurrent.futures import CancelledError, ThreadPoolExecutor

    spark, race_id = df.sparkSession, uuid.uuid4().hex[:8]
    ready = prepared_folds(df, [d for _, d, _ in candidates], keep, folds)
    held = {name: (design, learner) for name, design, learner in candidates}
    left = set()

    def run(name: str, i: int) -> float | None:
        if name in left:
            return None
        tag = f"race-{race_id}-{name}".replace(",", " ")
        spark.sparkContext.addJobTag(tag)
        try:
            design, learner = held[name]
            others, own = ready[design, i]
            model = models.aimed(design, learner).fit(others)
            scored = models.tidy(model.transform(own), [*keep, "fold"])
            return float(error(scored).first()[0])
        except Exception:
            if name in left:  # ended on purpose
                return None
            raise
        finally:
            spark.sparkContext.removeJobTag(tag)

    scores: dict[str, list[float]] = {name: [] for name in held}
    alive, dropped_at = list(held), {}
    with ThreadPoolExecutor(parallel) as pool:
        runs = {(name, i): pool.submit(run, name, i) for i in range(min(burn_in + 1, folds)) for name in alive}
        for i in range(folds):
            for name in alive:
                scores[name].append(runs[name, i].result())
            if i + 1 < burn_in:
                continue
            for name in behind({x: scores[x] for x in alive}):
                left.add(name)
                dropped_at[name] = i + 1
                spark.sparkContext.cancelJobsWithTag(f"race-{race_id}-{name}".replace(",", " "))
            alive = [x for x in alive if x not in left]
            if i + 2 < folds:
                runs |= {(name, i + 2): pool.submit(run, name, i + 2) for name in alive if (name, i + 2) not in runs}
        for run_ in runs.values():
            run_.cancel()
            try:
                run_.result()
            except CancelledError:
                pass
    table = [(x, len(s), sum(s) / len(s), x in dropped_at) for x, s in scores.items()]
    every = [(x, j, v) for x, s in scores.items() for j, v in enumerate(s)]
    return (
        spark.createDataFrame(table, "candidate string, n_folds int, mean double, dropped boolean"),
        spark.createDataFrame(every, "candidate string, fold int, error double"),
    )


# -- stacking with a chosen penalty -----------------------------------------


def gram_sums(oof: DataFrame, members: Sequence[str], target: str, by: str) -> dict:
    """Per value of ``by``: (rows, matrix of the sums of products of all members and the target); one pass."""
    import numpy as np

    cols = [*members, target]
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    sums = oof.groupBy(by).agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(a).cast("double") * F.col(b)).alias(f"s{i}") for i, (a, b) in enumerate(pairs)])
    out = {}
    for row in sums.collect():  # one row a fold
        full = np.zeros((len(cols), len(cols)))
        full[np.triu_indices(len(cols))] = [row[f"s{i}"] or 0.0 for i in range(len(pairs))]
        out[row[by]] = (row["n"], full + np.triu(full, 1).T)
    return out


def nonnegative_lasso(gram, start, penalty: float, tolerance: float = 1e-10):
    """Weights of 0 or more that minimise (mean square error) / 2 + penalty * (sum of weights).

    ``gram`` holds mean products of the members and, last, the target. Members enter one by
    one, those with a weight in ``start`` first, and leave where their weight reaches 0;
    between, the weights of the entered ones are solved for. So members that are nearly or
    wholly sums of others need no more steps than different ones: such a member takes
    weight from the others until one of them leaves.
    """
    import numpy as np

    size = np.sqrt(np.diag(gram)[:-1])
    used = size > 0
    unit = np.where(used, size, 1.0)
    x, b = gram[:-1, :-1] / unit / unit[:, None], np.where(used, (gram[:-1, -1] - penalty) / unit, 0.0)
    u, on, refused = np.zeros(len(b)), np.zeros(len(b), bool), np.zeros(len(b), bool)
    enough = tolerance * max(1.0, np.abs(b).max(initial=0.0))
    for _ in range(100 + 50 * len(b)):
        slope = b - x @ u
        waiting = used & ~on & ~refused & (slope > enough)
        if not waiting.any():
            break
        waiting = waiting & (start > 0) if (waiting & (start > 0)).any() else waiting
        j = int(np.argmax(np.where(waiting, slope, -np.inf)))
        held = np.flatnonzero(on)
        pull = np.linalg.solve(x[np.ix_(held, held)], x[held, j])
        bend = x[j, j] - x[j, held] @ pull
        step = slope[j] / bend if bend > 1e-11 else np.inf
        out = held[pull > 0]
        step = min(step, (u[out] / pull[pull > 0]).min(initial=np.inf))
        if not 0 < step < np.inf:
            refused[j] = True
            continue
        u[held] -= step * pull
        u[j], on[j] = step, True
        on &= u > 1e-14
        while on.any():  # each turn settles the weights or drops a member
            held = np.flatnonzero(on)
            best = np.linalg.solve(x[np.ix_(held, held)], b[held])
            if (best > 0).all():
                u[held] = best
                break
            low = best <= 0
            u[held] += (u[held][low] / (u[held][low] - best[low])).min() * (best - u[held])
            on[held[low][np.argmin(u[held][low])]] = False
            on &= u > 1e-14
        u[~on] = 0.0
        refused[:] = False
    slope = b - x @ u
    if (slope[used & ~refused] > 1e-6 * max(1.0, np.abs(b).max(initial=0.0))).any():
        raise ValueError(f"no solution for penalty {penalty}")
    return u / unit


def stack_path(oof: DataFrame, members: Sequence[str], target: str, penalties: Sequence[float], fold: str = "fold") -> tuple[dict[str, float], float, DataFrame]:
    """Non-negative lasso weights of stacked members, the penalty chosen over the folds.

    The rows are read once, for sums of products per fold. Every fold's path and its error
    come from these; a path goes from the largest penalty down, each from the weights
    before. Returns (weights at the penalty of the least mean error, the larger of several;
    that penalty; table penalty, mse, members).
    """
    import numpy as np

    sums = gram_sums(oof, members, target, fold)
    n, whole = sum(k for k, _ in sums.values()), sum(g for _, g in sums.values())
    order = sorted(penalties, reverse=True)

    def path(gram):
        w, out = np.zeros(len(members)), {}
        for p in order:
            out[p] = w = nonnegative_lasso(gram, w, p)
        return out

    errors = {p: [] for p in order}
    for k, own in sums.values():
        if n > k:
            for p, w in path((whole - own) / (n - k)).items():
                errors[p].append(float(own[-1, -1] - 2 * w @ own[:-1, -1] + w @ own[:-1, :-1] @ w) / k)
    final = path(whole / n)
    mean = {p: sum(e) / len(e) if e else math.inf for p, e in errors.items()}
    chosen = min(order, key=lambda p: mean[p])
    table = oof.sparkSession.createDataFrame([(p, mean[p], int((final[p] > 0).sum())) for p in order], "penalty double, mse double, members int")
    return {m: float(v) for m, v in zip(members, final[chosen], strict=True)}, chosen, table


def fit_members(train: DataFrame, candidates: Sequence[Candidate], weights: dict[str, float]) -> dict:
    """The members with a weight above 0, fitted on all training rows; the others are not fitted."""
    return {name: models.fit(design, learner, train) for name, design, learner in candidates if weights[name] > 0}


# -- search under a budget --------------------------------------------------


def halving(
    df: DataFrame,
    key: str,
    candidates: Sequence[Candidate],
    error: Callable[[DataFrame], DataFrame],
    eta: int = 3,
    fits: int | None = None,
    seconds: float | None = None,
    held: float = 0.25,
    seed: int = 1,
) -> DataFrame:
    """Successive halving: all candidates on a small sample, the best 1 / eta of them on a larger one, and so on.

    A hash of the key holds out the share ``held`` for all errors and orders the rest, of
    which each rung takes eta times as many rows, the last all. The search ends after
    ``fits`` fits or ``seconds`` seconds, whichever comes first; a fit that runs then is
    ended by its job tag. Returns a row for every candidate and rung it reached (rung,
    candidate, share, error, status), status being done, out of budget or failed. With a
    budget of fits alone the result does not depend on speed.
    """
    import time

    spark, tag = df.sparkSession, f"halving-{uuid.uuid4().hex[:8]}"
    place = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1_000_000)) / 1_000_000
    rows = cut_lineage(df.withColumn("_place", place))
    test, train = rows.where(F.col("_place") < held), rows.where(F.col("_place") >= held)
    rungs = 1 + max(0, math.ceil(math.log(max(len(candidates), 1), eta) - 1e-9))
    begun, used, out, alive = time.monotonic(), 0, [], list(candidates)
    for rung in range(rungs):
        share = float(eta) ** (rung + 1 - rungs)
        part = train.where(F.col("_place") < held + (1 - held) * share) if share < 1 else train
        found = {}
        for name, design, learner in alive:
            left = None if seconds is None else seconds - (time.monotonic() - begun)
            if fits is not None and used >= fits or left is not None and left <= 0:
                out.append((rung, name, share, None, "out of budget"))
                continue
            used += 1
            alarm = threading.Timer(left, spark.sparkContext.cancelJobsWithTag, [tag]) if left is not None else None
            spark.sparkContext.addJobTag(tag)
            try:
                if alarm:
                    alarm.start()
                found[name] = float(error(models.predict(models.fit(design, learner, part), test, [design.target])).first()[0])
                out.append((rung, name, share, found[name], "done"))
            except Exception as err:
                late = left is not None and time.monotonic() - begun >= seconds
                out.append((rung, name, share, None, "out of budget" if late else f"failed: {type(err).__name__}"))
            finally:
                spark.sparkContext.removeJobTag(tag)
                if alarm:
                    alarm.cancel()
        best = sorted(found, key=lambda x: (found[x], x))[: max(1, len(alive) // eta)]
        alive = [c for c in alive if c[0] in best]
        if not alive:
            break
    return spark.createDataFrame(out, "rung int, candidate string, share double, error double, status string")
