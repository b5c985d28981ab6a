"""Steps in order, each finished once: a run that stopped goes on where it stopped."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from millrace.sinks.versions import Versions

#: A step makes its rows from the rows of the steps before it, by name.
Step = Callable[[Mapping[str, DataFrame]], DataFrame]


def run_steps(spark: SparkSession, folder: str, run: str, steps: Sequence[tuple[str, Step]], tables: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Run the steps that ``run`` has not finished yet and publish their rows; {step: its rows as written}.

    A step is finished when the manifest says so, which is after all its rows are written. A step that failed,
    or whose driver was lost, is made anew from the written rows of the steps before it; nothing that was
    finished is made again, so results are there once. Readers of the folder's ``Versions`` see the ``tables``
    (all steps unless named) of a run change together, when its last step is finished.
    """
    names = [name for name, _ in steps]
    if len(set(names)) < len(names):
        raise ValueError(f"steps need names of their own: {names}")
    state, seen = Versions(spark, f"{folder.rstrip('/')}/_steps"), Versions(spark, folder)
    done, made = state.current(run), {}
    for name, step in steps:
        if name not in done:
            path = state.write(name, step(made))
            state.publish({name: path}, run)
            done[name] = path
        made[name] = spark.read.parquet(done[name])
    shown = seen.current(run)
    late = {name: done[name] for name in (tables or names) if shown.get(name) != done[name]}
    if late:
        seen.publish(late, run)
    return made
