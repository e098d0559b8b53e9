"""Automatic search: a trial plan run on one shared feature table, ranked in a leaderboard."""

from __future__ import annotations

import ast
import datetime
import math
import threading
import time
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.operators import trials as TR
from tabwright.operators.models import effective_params, family_for
from tabwright.operators.target import SEARCH_TARGET_NAMES, infer_target
from tabwright.operators.profile import profile
from tabwright.plans.experiment import (
    CUSTOM_FAMILIES,
    RUN_SCHEMA,
    Prepared,
    fit_and_score,
    neighbours,
    prepare,
    save_scorer,
)
from tabwright.streaming.scoring import Scorer

TIMEOUT = 600.0
PARALLEL = 3


def _value(text: str | None) -> Any:
    """A parameter value from its text."""
    try:
        return ast.literal_eval(text)
    except (ValueError, SyntaxError):
        return text


@dataclass
class SearchResult:
    trials: DataFrame
    prepared: Prepared
    metric: str
    models: dict[str, Any] = field(default_factory=dict)  # run id -> fitted model, a few trials

    def best(self) -> str:
        """Run id of the first trial of the leaderboard."""
        first = self.ranked().orderBy("rank").first()
        if first is None:
            raise ValueError("no trial was completed")
        return first["run_id"]

    def scorer(self) -> Scorer:
        """The winner, ready to score tables and streams."""
        return Scorer(self.prepared.preprocessor, self.prepared.names, self.models[self.best()])

    def save_best(self, path: str) -> None:
        """Save the winner below ``path``; ``Scorer.load`` reads it."""
        save_scorer(self.prepared.table.sparkSession, self.prepared, self.models[self.best()], path)

    def run_rows(self, experiment: str) -> DataFrame:
        """The completed trials as rows of a run table, under the ids of the trials."""
        return self.trials.filter("status = 'completed'").select(
            "run_id",
            F.lit(experiment).alias("experiment"),
            "trial_id",
            F.lit("FINISHED").alias("status"),
            "started",
            "ended",
            "metrics",
            F.map_concat("params", F.create_map(F.lit("model_type"), F.col("model_type"))).alias("params"),
            F.lit(None).cast("string").alias("model_path"),
        ).toDF(*[c.split(" ")[0] for c in RUN_SCHEMA.split(", ")])

    def leaderboard(self) -> DataFrame:
        return TR.leaderboard(self.trials, self.metric)

    def ranked(self) -> DataFrame:
        return TR.rank(self.trials, self.metric)

    def header(self, data: str) -> DataFrame:
        """One row: data, target, task and trial counts."""
        roles = self.prepared.preprocessor.roles
        return TR.trial_summary(self.trials).select(
            F.lit(data).alias("data"),
            F.lit(roles.target).alias("target"),
            F.lit(roles.task).alias("task"),
            "total_trials",
            "successful",
        )


def _run_trial(prepared: Prepared, trial, group: str, fits: dict[str, Any]) -> tuple:
    """One trial row; a failure becomes a row with the error text."""
    sc = prepared.table.sparkSession.sparkContext
    params = {k: _value(v) for k, v in trial["params"].items()}
    trial_id = f"trial_{uuid.uuid4().hex[:8]}"
    started = datetime.datetime.now(datetime.timezone.utc)
    head = (trial_id, trial["trial_no"], trial["model_name"], trial["model_type"], trial["params"])
    sc.setJobGroup(group, f"{trial['model_name']} {trial['trial_no']}", interruptOnCancel=True)
    try:
        metrics, fitted, model = fit_and_score(
            prepared, trial["model_type"], {**params, "random_state": trial["seed"]}
        )
        run_id = uuid.uuid4().hex
        fits[run_id] = fitted if fitted is not None else neighbours(prepared, model)
        return (*head, metrics, "completed", None, run_id, model.dropped, started, datetime.datetime.now(datetime.timezone.utc))
    except Exception as e:
        return (*head, {}, "failed", str(e)[:2000], None, [], started, None)


def _without_repeats(plan: list, task: str) -> list:
    """Leave out trials whose effective parameters repeat an earlier one's."""
    seen, kept = set(), []
    for trial in plan:
        if trial["model_type"] in CUSTOM_FAMILIES:
            kept.append(trial)
            continue
        params = {k: _value(v) for k, v in trial["params"].items()}
        used, _ = effective_params(trial["model_type"], params, task)
        used.pop("random_state", None)
        mark = (family_for(trial["model_type"], task), trial["model_type"], tuple(sorted((k, str(v)) for k, v in used.items())))
        if mark not in seen:
            seen.add(mark)
            kept.append(trial)
    return kept


def different_plan(spark: SparkSession, models: Sequence[str] | None, n_trials: int, task: str) -> DataFrame:
    """The shipped plan without repeats: a family's first three combinations that train differently, ``n_trials`` in all."""
    every = TR.trial_plan(TR.param_grid(TR.grid_table(spark)), models, len_of_space(), len_of_space())
    by_family: dict[str, list] = {}
    for trial in _without_repeats(sorted(every.collect(), key=lambda t: t["trial_no"]), task):  # the shipped space
        by_family.setdefault(trial["model_name"], []).append(trial)
    chosen = [t for family in by_family.values() for t in family[: TR.PER_FAMILY]][:n_trials]
    rows = [{**t.asDict(), "trial_no": i, "seed": i} for i, t in enumerate(chosen, 1)]
    return spark.createDataFrame(rows, every.schema)


def len_of_space() -> int:
    """Combinations of the shipped search space."""
    return sum(math.prod(len(values) for values in space.values()) for _, _, space in TR.GRIDS)


def run_trials(
    prepared: Prepared,
    plan: DataFrame,
    timeout: float = TIMEOUT,
    parallel: int = PARALLEL,
    fits: dict[str, Any] | None = None,
) -> DataFrame:
    """Run the planned trials, a few at a time, and return one row per trial.

    ``fits`` receives the fitted model of each completed trial by its run id.

    Training is Spark work; the threads here only submit it. At the deadline the
    running trials' jobs are cancelled and they, like the trials not yet begun,
    become ``timeout`` rows.
    """
    spark: SparkSession = prepared.table.sparkSession
    sc = spark.sparkContext
    planned = sorted(plan.collect(), key=lambda t: t["trial_no"])  # n_trials rows
    fits = {} if fits is None else fits
    deadline = time.monotonic() + timeout
    group = f"trials-{uuid.uuid4().hex[:8]}"
    expired = threading.Event()

    def late(trial) -> tuple:
        return (
            f"trial_{uuid.uuid4().hex[:8]}",
            trial["trial_no"],
            trial["model_name"],
            trial["model_type"],
            trial["params"],
            {},
            "timeout",
            f"not finished within {timeout} s",
            None,
            [],
            None,
            None,
        )

    def work(trial) -> tuple:
        if expired.is_set() or time.monotonic() > deadline:
            return late(trial)
        row = _run_trial(prepared, trial, f"{group}-{trial['trial_no']}", fits)
        return late(trial) if row[6] == "failed" and expired.is_set() else row

    finished = threading.Event()

    def expire() -> None:
        if finished.wait(timeout):
            return
        expired.set()
        while not finished.wait(0.5):  # a fit submits further jobs until one of them fails
            for trial in planned:
                sc.cancelJobGroup(f"{group}-{trial['trial_no']}")

    watcher = threading.Thread(target=expire, daemon=True)
    watcher.start()
    try:
        with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
            rows = list(pool.map(work, planned))
    finally:
        finished.set()
        watcher.join()
    return spark.createDataFrame(rows, TR.TRIAL_SCHEMA + ", started timestamp, ended timestamp")


def search(
    df: DataFrame,
    target: str | None = None,
    task: str = "auto",
    test_size: float = 0.2,
    n_trials: int = TR.MAX_TRIALS,
    timeout: float = TIMEOUT,
    models: Sequence[str] | None = None,
    keys: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    plan: DataFrame | None = None,
    parallel: int = PARALLEL,
    seed: int = 42,
    runs_path: str | None = None,
    experiment: str = "search",
    **options: Any,
) -> SearchResult:
    """Try several families and parameters on a table and rank them.

    Without a target the short name list decides, else the last column. All
    trials share one split, so their scores compare. Trials that would repeat an
    earlier fit are left out of the plan, so ``n_trials`` different ones run.
    Completed trials are appended to ``runs_path``; the result keeps their
    models. ``options`` go to :func:`prepare`.
    """
    spark = df.sparkSession
    if target is None:
        profiled = profile(df.drop(*exclude), distinct="adaptive")
        target = infer_target(profiled, names=SEARCH_TARGET_NAMES, by_kind=False).first()[0]
    prepared = prepare(df, target, task, keys, test_size, seed, exclude=exclude, **options)
    if plan is None:
        plan = different_plan(spark, models, n_trials, prepared.task)
    fits: dict[str, Any] = {}
    rows = run_trials(prepared, plan, timeout, parallel, fits)
    result = SearchResult(rows, prepared, "r2" if prepared.task == "regression" else "accuracy", fits)
    if runs_path:
        result.run_rows(experiment).write.mode("append").parquet(runs_path)
    return result


def save_results(result: SearchResult, data: str, path: str) -> None:
    """Write the result header and the trial rows below ``path``."""
    result.header(data).coalesce(1).write.json(f"{path}/header")
    result.trials.coalesce(1).write.json(f"{path}/trials")
