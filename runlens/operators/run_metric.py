"""Metrics of the caller's own, with a state of their own.

A ``RunMetric`` says how one run becomes a state, how the states of two adjacent
stretches of runs join (left before right), and how a state becomes the metric.
The join must be associative; it need not be commutative, so a metric may depend
on the order of the runs. That is all a kernel needs:

  nested kernel   the runs of a row are folded in order
  plain plan      runs are folded in blocks of ``BLOCK`` inside a session, then the blocks
  chunked plan    the same inside a chunk, then the states of adjacent chunks
                  join at their borders

No fold holds more than ``BLOCK`` runs, the blocks of a chunk or the chunks of a session.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK_BITS = 12
BLOCK = 1 << BLOCK_BITS  # runs folded at once

Fields = Mapping[str, Column]


@dataclass(frozen=True)
class RunMetric:
    """``state`` names the fields of the state and their SQL types. ``per_run`` gets a function that returns a field
    of the run by name, ``merge`` gets two that return a field of the left and the right state, ``finish`` one for a state.
    A session without runs has no state and a NULL metric."""

    name: str
    state: Mapping[str, str]
    per_run: Callable[[Callable[[str], Column]], Fields]
    merge: Callable[[Callable[[str], Column], Callable[[str], Column]], Fields]
    finish: Callable[[Callable[[str], Column]], Column]
    type: str = "double"

    @property
    def column(self) -> str:
        """The state's column in the kernels' tables."""
        return f"_state_{self.name}"

    def _struct(self, fields: Fields) -> Column:
        if set(fields) != set(self.state):
            raise ValueError(f"{self.name}: the state has the fields {sorted(self.state)}, not {sorted(fields)}")
        return F.struct(*[fields[f].cast(t).alias(f) for f, t in self.state.items()])

    def lift(self, run: Callable[[str], Column]) -> Column:
        return self._struct(self.per_run(run))

    def joined(self, left: Column, right: Column) -> Column:
        return self._struct(self.merge(left.getField, right.getField))

    def fold(self, states: Column) -> Column:
        """One state from an array of adjacent ones; NULL from an empty array."""
        rest = F.slice(states, 2, F.greatest(F.size(states) - 1, F.lit(0)))
        return F.aggregate(rest, F.get(states, F.lit(0)), lambda acc, s: F.when(acc.isNull(), s).otherwise(self.joined(acc, s)))

    def folded(self, position: str | Column, state: Column) -> Column:
        """Aggregate: the states of a group in the order of ``position``, as one."""
        rows = F.sort_array(F.collect_list(F.struct(F.col(position) if isinstance(position, str) else position, state.alias("s"))))
        return self.fold(F.transform(rows, lambda r: r["s"])).alias(self.column)

    def over(self, runs: Column) -> Column:
        """The state of a row's array of runs."""
        return self.fold(F.transform(runs, lambda r: self.lift(r.getField)))

    def value(self, state: Column) -> Column:
        return F.when(state.isNotNull(), self.finish(state.getField)).cast(self.type).alias(self.name)


_registered: dict[str, RunMetric] = {}


def register_metric(metric: RunMetric) -> RunMetric:
    """Make a metric known by its name; a name can be taken once."""
    if metric.name in _registered and _registered[metric.name] is not metric:
        raise ValueError(f"a metric named {metric.name!r} is registered already")
    _registered[metric.name] = metric
    return metric


def run_metrics(chosen: Sequence[RunMetric | str] | None) -> list[RunMetric]:
    """Metrics given by themselves or by their registered names."""
    out = []
    for m in chosen or []:
        if isinstance(m, str) and m not in _registered:
            raise ValueError(f"no metric named {m!r} is registered (known: {sorted(_registered)})")
        out.append(_registered[m] if isinstance(m, str) else m)
    return out


def _rising(left: Column, right: Column) -> Column:
    return F.coalesce(right > left, F.lit(False))


def _rising_merge(a: Callable[[str], Column], b: Callable[[str], Column]) -> Fields:
    meets = _rising(a("last"), b("first"))
    across = F.when(meets, a("tail") + b("lead")).otherwise(F.lit(0))
    return {
        "n": a("n") + b("n"), "first": a("first"), "last": b("last"),
        "lead": F.when(meets & (a("lead") == a("n")), a("n") + b("lead")).otherwise(a("lead")),
        "tail": F.when(meets & (b("tail") == b("n")), b("n") + a("tail")).otherwise(b("tail")),
        "best": F.greatest(a("best"), b("best"), across),
    }


# The longest stretch of runs in which every run uses more tokens than the one before (1 for a single run).
LONGEST_RISE = register_metric(RunMetric(
    name="longest_token_rise",
    state={"n": "bigint", "first": "double", "last": "double", "lead": "bigint", "tail": "bigint", "best": "bigint"},
    per_run=lambda run: {"n": F.lit(1), "first": run("total_tokens"), "last": run("total_tokens"),
                         "lead": F.lit(1), "tail": F.lit(1), "best": F.lit(1)},
    merge=_rising_merge,
    finish=lambda s: s("best"),
    type="bigint",
))

# The deepest fall of the token count below the highest one before it (0 if it never falls).
DEEPEST_FALL = register_metric(RunMetric(
    name="deepest_token_fall",
    state={"high": "double", "low": "double", "fall": "double"},
    per_run=lambda run: {"high": run("total_tokens"), "low": run("total_tokens"), "fall": F.lit(0.0)},
    merge=lambda a, b: {"high": F.greatest(a("high"), b("high")), "low": F.least(a("low"), b("low")),
                        "fall": F.greatest(a("fall"), b("fall"), a("high") - b("low"))},
    finish=lambda s: s("fall"),
))
