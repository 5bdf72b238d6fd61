"""Trial definitions, spike bookkeeping."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf
from pyspark.sql.types import StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from .graph import written
from .windows import dealt

#: Trial functions by name: each takes a table of events and gives trials.
TRIAL_FUNCTIONS: dict[str, Callable[..., DataFrame]] = {}


def trial_function(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Registers a trial function, the user's own too."""
    TRIAL_FUNCTIONS[f.__name__] = f
    return f


@trial_function
def around_events(events: DataFrame, kinds: Sequence[str], before: float, after: float, *, kind: str = "event_type", t: str = "t") -> DataFrame:
    """A window around every event of some kinds; windows that reach past the recording go."""
    rows = events.where(F.col(kind).isin(list(kinds)))
    ends = events.agg(F.min(t).alias("_lo"), F.max(t).alias("_hi"))
    out = rows.join(F.broadcast(ends)).withColumns({"start": F.col(t) - before, "end": F.col(t) + after, "t0": F.col(t)})  # one row
    return out.where("start >= _lo AND end <= _hi").drop("_lo", "_hi")


@trial_function
def consecutive(events: DataFrame, first: str, then: str, *, kind: str = "event_type", t: str = "t", by: Sequence[str] = ()) -> DataFrame:
    """From an event of one kind to the next event, if that is of another kind."""
    w = Window.partitionBy(*by).orderBy(t)
    rows = events.withColumns({"_next": F.lead(kind).over(w), "end": F.lead(t).over(w)})
    return rows.where((F.col(kind) == first) & (F.col("_next") == then)).withColumn("start", F.col(t)).drop("_next")


@trial_function
def crossings(samples: DataFrame, threshold: float, refractory: int, *, by: Sequence[str] = ("channel",), tasks: int | None = None) -> DataFrame:
    """Samples at which a signal rises through a threshold, without those within ``refractory`` of the last one kept."""
    w = Window.partitionBy(*by).orderBy("sample")
    up = dealt(samples, tasks, *by).withColumn("_was", F.lag("v").over(w)).where((F.col("v") >= threshold) & (F.col("_was") < threshold)).drop("_was")
    return drop_duplicates_within(up, refractory, by=by, t="sample", key="sample")


def _chain(t: np.ndarray, window: float) -> np.ndarray:
    """For each time the place of the first one further away than ``window``."""
    return np.searchsorted(t, t + window, "right")


def drop_duplicates_within(spikes: DataFrame, window: float, *, by: Sequence[str] = ("channel",), t: str = "t", key: str = "spike_id", width: float | None = None) -> DataFrame:
    """Of spikes on a channel closer than ``window`` to the last kept one, none; in the order of time and key.

    Which spike is kept depends on the one kept before, however far back that goes.
    Each stretch of time (``width``, a thousand windows unless given) works out, for
    every spike that may be its first kept one, which is the next stretch's; only
    those few, which lie in a stretch's first window, are followed channel by
    channel; then each stretch keeps what its first one leads to. No task holds
    more of a channel than a stretch, or a window of every stretch.
    """
    width = float(width or 1000 * window)
    if width < window:
        raise ValueError("a stretch has to be as wide as the window")
    here = F.floor(F.col(t) / width).cast("long")
    rows = spikes.withColumn("_part", here)
    names = spikes.columns
    kinds = "".join(f"`{c}` {spikes.schema[c].dataType.simpleString()}, " for c in by)
    place = [*by, "_part"]

    def leads(pdf: pd.DataFrame) -> pd.DataFrame:
        """Where each spike of a stretch's first window, and its first spike, leads to in the stretches behind: the least time that is allowed there."""
        at = np.sort(pdf[t].to_numpy(float))
        at = at[np.r_[True, np.diff(at) > 0]]  # of equal times the first is kept, and none of the others ever
        after, last = _chain(at, window), np.arange(len(at))
        for i in range(len(at) - 1, -1, -1):
            last[i] = last[after[i]] if after[i] < len(at) else i
        first = np.searchsorted(at, max(at[0], pdf["_part"].iloc[0] * width) + window, "right")
        first = min(len(at), int(first) + 1)  # the first one behind that window too, where none in it is free
        return pd.DataFrame({**{c: [pdf[c].iloc[0]] * first for c in place}, "entry": at[:first], "free": at[last[:first]] + window})[[*place, "entry", "free"]]

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        """The first kept time of each stretch of a channel, if it has one."""
        pdf = pdf.sort_values(["_part", "entry"], kind="stable")
        part, entry, free = (pdf[c].to_numpy() for c in ("_part", "entry", "free"))
        cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True])
        out, least = [], -np.inf
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            k = i + np.searchsorted(entry[i:j], least, "right") if np.isfinite(least) else i
            if k < j:
                out.append((part[i], entry[k]))
                least = free[k]
        found = pd.DataFrame(out, columns=["_part", "_first"])
        return found.assign(**{c: [pdf[c].iloc[0]] * len(found) for c in by})[[*place, "_first"]]

    def keep(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([t, key], kind="stable")
        at = pdf[t].to_numpy(float)
        after, kept = _chain(at, window), []
        k = int(np.searchsorted(at, pdf["_first"].iloc[0], "left"))
        while k < len(at):
            kept.append(k)
            k = int(after[k])
        return pdf.iloc[kept][names]

    leading = rows.select(*place, t).groupBy(*place).applyInPandas(leads, f"{kinds}_part long, entry double, free double")
    firsts = leading.groupBy(*by).applyInPandas(walk, f"{kinds}_part long, _first double")
    return rows.join(firsts, place).groupBy(*place).applyInPandas(keep, spikes.schema)


def append_spikes(samples: DataFrame, spikes: DataFrame, rate: float, *, on: Sequence[str] = ("channel",)) -> DataFrame:
    """How many spikes fall on each sample, as a column ``spikes``."""
    counts = spikes.withColumn("sample", F.round(F.col("t_s") * rate).cast("long")).groupBy(*on, "sample").agg(F.count("*").alias("spikes"))
    return samples.join(counts, [*on, "sample"], "left").withColumn("spikes", F.coalesce("spikes", F.lit(0)))


def lateralized(left: DataFrame, right: DataFrame, pairs: DataFrame) -> DataFrame:
    """Half the sum over hands of contralateral minus ipsilateral, for channel pairs (plus, minus)."""
    a = pairs.join(left.select(F.col("channel").alias("plus"), "t", F.col("v").alias("lp")), "plus").join(left.select(F.col("channel").alias("minus"), "t", F.col("v").alias("lm")), ["minus", "t"])
    b = a.join(right.select(F.col("channel").alias("plus"), "t", F.col("v").alias("rp")), ["plus", "t"]).join(right.select(F.col("channel").alias("minus"), "t", F.col("v").alias("rm")), ["minus", "t"])
    return b.select("plus", "minus", "t", ((F.col("lp") - F.col("lm") + F.col("rm") - F.col("rp")) / 2).alias("lrp"))


def random_per_group(df: DataFrame, by: Sequence[str], n: int, key: str, seed: int = 1) -> DataFrame:
    """At most ``n`` rows of each group, by a digest of the key: the same rows every time and on every engine."""
    w = Window.partitionBy(*by).orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))), key)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def nth_of(df: DataFrame, by: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The n-th row of each group."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_n") == n).drop("_n")


#: Trials that a named condition takes: what it needs, and that none were aborted.
MASKS: dict[str, str] = {
    "correct": "correct AND NOT aborted",
    "incorrect": "incorrect AND NOT aborted",
    "omission": "omission AND NOT aborted",
    "allInitiated": "NOT aborted",
}


def by_condition(trials: DataFrame, masks: dict[str, str | Column]) -> DataFrame:
    """Each trial once for every condition that takes it, as ``mask``; the user's own conditions, SQL or columns, are further entries."""
    named = F.array_compact(F.array(*[F.when(F.coalesce(F.expr(test) if isinstance(test, str) else test, F.lit(False)), F.lit(name)) for name, test in masks.items()]))
    return trials.withColumn("mask", F.explode(named))


def resolve_duplicates(spikes: DataFrame, window: float, *, by: Sequence[str] = ("channel",), t: str = "t", key: str = "spike_id", width: float | None = None) -> DataFrame:
    """Spikes of a channel (unit, template, ampl) without their duplicates within ``window``.

    Of two such spikes of one template the smaller goes, of different templates the
    one whose unit has fewer spikes; the later goes on a tie. A spike that has gone
    removes no other. Pairs are taken in the order of their first spikes' time and key.

    Stretches of time (``width``, a thousand windows unless given) are worked on side by side,
    each with the next one's first window; what it takes there is told to the next
    one, and they go on until nothing new is told. A stretch's end seldom
    depends on its beginning, so that is after two or three rounds; no task holds more than a stretch.
    """
    width = float(width or 1000 * window)
    if width < window:
        raise ValueError("a stretch has to be as wide as the window")
    size = spikes.groupBy("unit").agg(F.count("*").alias("_size"))
    here = F.floor(F.col(t) / width).cast("long")
    place = [*by, "_part"]
    near = F.when(F.col(t) <= here * width + window, F.array(here - 1, here)).otherwise(F.array(here))
    rows = spikes.join(size, "unit").select(*by, t, key, "ampl", "template", "_size", here.alias("_home"), F.explode(near).alias("_part"))
    rows = written(rows.withColumn("_own", F.col("_part") == F.col("_home")).drop("_home"))
    kinds = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in [*place, t, key])

    def decide(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([t, key], kind="stable")
        at, ampl, template, size, own = (pdf[c].to_numpy() for c in (t, "ampl", "template", "_size", "_own"))
        kept = ~pdf["_gone"].to_numpy(bool)
        for i in np.flatnonzero(own):
            j = i + 1
            while kept[i] and j < len(pdf) and at[j] - at[i] <= window:
                if kept[j]:
                    first, second = (ampl[i], ampl[j]) if template[i] == template[j] else (size[i], size[j])
                    kept[j if second <= first else i] = False
                j += 1
        return pdf[[*place, t, key, "_own"]].assign(_kept=kept)

    told = rows.limit(0).select(*place, t, key)
    while True:
        marked = rows.join(told.withColumn("_told", F.lit(True)), [*place, t, key], "left").withColumn("_gone", F.coalesce("_told", F.lit(False)) & F.col("_own")).drop("_told")
        found = written(marked.groupBy(*place).applyInPandas(decide, f"{kinds}_own boolean, _kept boolean"))
        new = found.where(~F.col("_own") & ~F.col("_kept")).select(*by, (F.col("_part") + 1).alias("_part"), t, key)
        if new.exceptAll(told).isEmpty() and told.exceptAll(new).isEmpty():
            break
        told = written(new)
    return spikes.join(found.where("_own AND _kept").select(*by, t, key), [*by, t, key], "left_semi").select(*spikes.columns)


def events_to_trials(events: DataFrame, *, sample: str = "sample", duration: str = "duration", offset: str = "offset") -> DataFrame:
    """Events as trials from ``start`` to ``end`` (the last sample, at least one long) with their offset; other columns stay."""
    size = F.greatest(F.lit(1), F.coalesce(duration, F.lit(1)))
    return events.withColumns({"start": F.col(sample), "end": F.col(sample) + size - 1, "offset": F.coalesce(F.col(offset), F.lit(0))}).drop(sample, duration)


def trials_to_events(trials: DataFrame, kind: str = "trial") -> DataFrame:
    """Trials (start, end, offset) as events with sample, duration, offset and type."""
    return trials.withColumns({"sample": F.col("start"), "duration": F.col("end") - F.col("start") + 1, "type": F.lit(kind)}).drop("start", "end")


def artifacts_to_trials(artifacts: DataFrame) -> DataFrame:
    """Intervals (start, end) as trials of offset 0."""
    return artifacts.withColumn("offset", F.lit(0))


def digital_events(pins: DataFrame, skip: int, span: int, *, low_pins: int = 4, gap: int = 2) -> DataFrame:
    """Codes of pulses on digital lines (sample, pin from 1, v): onset sample, ``standard`` code of the low pins, ``extra`` of the others.

    What was up before all pins were first down is left out. A pulse begins where a
    pin is up for the first time in more than ``gap`` samples; its code is read over
    ``span`` further samples from ``skip`` after that on, so that bouncing doesn't count.
    """
    up = pins.groupBy("sample").agg(F.bit_or(F.expr("CASE WHEN v <> 0 THEN shiftleft(1, pin - 1) ELSE 0 END")).alias("code"))
    quiet = up.where("code = 0").agg(F.min("sample").alias("_quiet"))
    on = up.where("code <> 0").join(F.broadcast(quiet)).where("_quiet IS NULL OR sample > _quiet").drop("_quiet")  # one row
    onsets = on.withColumn("_was", F.lag("sample").over(Window.orderBy("sample"))).where(F.col("_was").isNull() | (F.col("sample") - F.col("_was") > gap)).select(F.col("sample").alias("onset"))
    reach = onsets.select("onset", F.explode(F.sequence(F.col("onset") + skip, F.col("onset") + skip + span)).alias("sample"))
    code = reach.join(on, "sample", "left").groupBy("onset").agg(F.bit_or(F.coalesce("code", F.lit(0))).alias("code"))
    mask = (1 << low_pins) - 1
    return code.select(F.col("onset").alias("sample"), F.col("code").bitwiseAND(mask).alias("standard"), F.col("code").bitwiseAND(~mask).alias("extra"))


def pair_by_counts(a: DataFrame, b: DataFrame, by: Sequence[str], counts: Sequence[str], key: str = "trial") -> DataFrame:
    """Trials of two conditions paired by like spike counts: by, ``<key>_a``, ``<key>_b``, cost (summed differences).

    Greedy: the closest pair of trials left is taken next (the first of equals), then
    two pairs swap partners as long as that lowers their cost. A group's trials,
    hundreds at most, are one task's work; what one side has too many of stays out.
    """
    kind = a.schema[key].dataType.simpleString()
    fields = ", ".join(f"`{c}` {a.schema[c].dataType.simpleString()}" for c in by) + f", {key}_a {kind}, {key}_b {kind}, cost double"

    def pair(far: np.ndarray) -> list[tuple[int, int]]:
        open_, link = far.copy(), []
        for _ in range(min(far.shape)):
            i, j = divmod(int(open_.argmin()), far.shape[1])
            open_[i], open_[:, j] = np.inf, np.inf
            link.append([i, j])
        moved = True
        while moved:
            moved = False
            for p in range(len(link)):
                for q in range(p + 1, len(link)):
                    (i, j), (k, n) = link[p], link[q]
                    if far[i, n] + far[k, j] < far[i, j] + far[k, n]:
                        link[p][1], link[q][1], moved = n, j, True
        return sorted((i, j) for i, j in link)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Group by group, from the batch's flat columns: a small group costs no frame of its own."""
        for batch in batches:
            ends, flat = [], []
            for side in (0, 1):
                rows = batch.column(f"_s{side}")
                ends.append(np.r_[0, np.cumsum(pa.compute.list_value_length(rows).to_numpy())])
                fields_ = rows.flatten().flatten()
                flat.append((fields_[0], np.stack([f.to_numpy(zero_copy_only=False).astype(float) for f in fields_[1:]], 1)))
            group, left, right, cost = [], [], [], []
            for g in range(len(batch)):
                (i, j), (p, q) = ends[0][g : g + 2], ends[1][g : g + 2]
                if i < j and p < q:
                    far = np.abs(flat[0][1][i:j, None] - flat[1][1][None, p:q]).sum(2)
                    for m, n in pair(far):
                        group.append(g)
                        left.append(i + m)
                        right.append(p + n)
                        cost.append(far[m, n])
            at = [pa.array(np.array(x, np.int64)) for x in (group, left, right)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(at[0]) for c in by], flat[0][0].take(at[1]), flat[1][0].take(at[2]), pa.array(np.array(cost, float))], names=[*by, f"{key}_a", f"{key}_b", "cost"])

    values = F.struct(key, *[F.col(c).cast("double").alias(f"_c{k}") for k, c in enumerate(counts)]).alias("_row")
    both = a.select(*by, F.lit(0).alias("_side"), values).unionByName(b.select(*by, F.lit(1).alias("_side"), values))
    sides = [F.array_sort(F.collect_list(F.when(F.col("_side") == k, F.col("_row")))).alias(f"_s{k}") for k in (0, 1)]
    return both.groupBy(*by).agg(*sides).mapInArrow(run, fields)


class TriggeredTrials:
    """A trial function as a table function: trials from a kind of event to the next one of another kind, a partition's events in order.

    In SQL, once ``register_trial_functions`` has made it known::

        SELECT * FROM trials_from(TABLE(events) PARTITION BY subject ORDER BY (t), 'view', 'purchase', longest => 5000, copy => 'value')

    The table needs ``event_type`` and ``t``; ``subject`` names the column that is
    handed on as the trial's, and the columns listed in ``copy`` come with the opening
    event, with their types: the result's schema follows from the arguments. A new opening event
    takes the place of one that waits; ``longest`` drops longer trials.
    """

    @staticmethod
    def analyze(events: AnalyzeArgument, first: AnalyzeArgument, then: AnalyzeArgument, longest: AnalyzeArgument | None = None, subject: AnalyzeArgument | None = None, copy: AnalyzeArgument | None = None) -> AnalyzeResult:
        known = {f.name: f.dataType for f in events.dataType.fields}
        missing = {"event_type", "t"} - known.keys()
        names = [n.strip() for n in str(copy.value).split(",")] if copy is not None and copy.value else []
        who = str(subject.value) if subject is not None and subject.value else None
        missing |= {n for n in [*names, *([who] if who else [])] if n not in known}
        if missing:
            raise ValueError(f"the table has no {', '.join(sorted(missing))}")
        schema = StructType()
        if who:
            schema = schema.add(who, known[who])
        schema = schema.add("nth", "long").add("start", known["t"]).add("end", known["t"])
        for n in names:
            schema = schema.add(n, known[n])
        return AnalyzeResult(schema=schema)

    def __init__(self):
        self.waits: tuple | None = None
        self.nth = 0

    def eval(self, events: Row, first: str, then: str, longest: float | None = None, subject: str | None = None, copy: str | None = None):
        kind, at = events["event_type"], events["t"]
        if kind == then and self.waits is not None:
            start, copied = self.waits
            self.waits = None
            if longest is None or at - start <= longest:
                self.nth += 1
                yield (*([events[subject]] if subject else []), self.nth, start, at, *copied)
        if kind == first:
            self.waits = (at, [events[n.strip()] for n in copy.split(",")] if copy else [])

    def terminate(self):
        self.waits = None
        return
        yield


def register_trial_functions(spark: SparkSession) -> None:
    """Makes ``trials_from`` known to SQL."""
    spark.udtf.register("trials_from", udtf(TriggeredTrials))
