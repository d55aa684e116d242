"""Row filters with provenance: every filter is a predicate, and the master filter names the first one that a row fails."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specfold.functions.arrays import count_where, is_finite, scalar
from specfold.operators.ranks import quantiles

#: Calibration and reference classes that object filters leave alone.
PROTECTED = ("SKYCHOPDIFF", "SKYDIFF", "SKY-DIFF", "TAU_SIG", "TSYS")
#: Classes that observing-mode and value filters leave alone.
CALIBRATION = ("TSYS", "TAU_SIG")


def any_of(conditions: Iterable[Column], empty: bool = False) -> Column:
    out = None
    for c in conditions:
        out = c if out is None else out | c
    return F.lit(empty) if out is None else out


def contains_any(column: str, parts: Iterable[str]) -> Column:
    return any_of(F.contains(F.col(column).cast("string"), F.lit(p)) for p in parts)


def equals_any(column: str, values: Iterable) -> Column:
    return F.trim(F.col(column).cast("string")).isin([str(v).strip() for v in values])


def cut(column: str, op: str, value: float | Column) -> Column:
    """Passes values on the right side of the limit, and all that are not finite."""
    c = F.col(column)
    good = c <= value if op == "<=" else c >= value
    return ~is_finite(c.cast("double")) | good


def strict_cut(column: str, op: str, value: float | Column) -> Column:
    """Passes only finite values strictly beyond the limit."""
    c = F.col(column)
    return is_finite(c.cast("double")) & (c > value if op == ">" else c < value)


def over_peak(spectrum: str, limit: float) -> Column:
    """Some channel exceeds the limit in size; NaN does not."""
    return F.exists(spectrum, lambda x: ~F.isnan(x) & (F.abs(x) > limit))


def nan_fraction(spectrum: str) -> Column:
    return count_where(spectrum, F.isnan) / F.size(spectrum)


def all_zero(spectrum: str) -> Column:
    """Every channel is 0 or NaN."""
    return F.forall(spectrum, lambda x: F.isnan(x) | (x == 0))


def blank(x: Column, limit: float = 1e30) -> Column:
    """Not finite, exactly zero, or a blanking value."""
    return ~is_finite(x) | (x == 0) | (F.abs(x) > limit)


def blank_fraction(spectrum: str, limit: float = 1e30) -> Column:
    return count_where(spectrum, lambda x: blank(x, limit)) / F.size(spectrum)


def bad_tau(spectrum: str, low: float = 0.001, high: float = 1.0) -> Column:
    return F.exists(spectrum, lambda x: is_finite(x) & ((x < low) | (x > high)))


def valid(spectrum: str, least: int) -> Column:
    return count_where(spectrum, is_finite) >= least


def percentile_limit(df: DataFrame, column: str, percent: float, limit: float, where: Column | None = None) -> DataFrame:
    """One row, `limit`: the percentile of the column's finite values, or the given limit if that is lower."""
    rows = df if where is None else df.where(where)
    value = scalar(quantiles(rows, column, (percent / 100,)).select(F.col("values")[0]))
    return df.sparkSession.range(1).select(F.least(value, F.lit(limit)).alias("limit"))


def science_rows(object_column: str = "object", mode_column: str | None = None, contains: str | None = None, calibration: Iterable[str] = CALIBRATION) -> Column:
    """On-source rows that are no calibration class; contains: part of the object, in either case."""
    good = ~any_of(F.startswith(F.col(object_column), F.lit(c)) for c in calibration)
    if mode_column:
        good &= F.col(mode_column) == "ON"
    if contains:
        good &= F.contains(F.upper(object_column), F.lit(contains.upper()))
    return good


#: Columns that stand for one another where a table has only one of them.
STAND_IN = {"rmsratio": "rmsratiob", "rmsratiob": "rmsratio"}


def prepare_cuts(rows: DataFrame, cuts: Iterable[tuple[str, str, float]], object_column: str = "object") -> DataFrame:
    """Science and reference rows on the right side of all limits, and all calibration rows. A column that the table lacks is replaced by its stand-in, else its limit is left out."""
    keep = F.lit(True)
    for column, op, value in cuts:
        name = column if column in rows.columns else STAND_IN.get(column)
        if name in rows.columns:
            keep &= cut(name, op, value)
    return rows.where(F.col(object_column).isin(*CALIBRATION) | keep)


def selected(columns: Mapping[str, tuple[str, Iterable]]) -> Column:
    """All of the conditions hold: column -> ("is", values), which it must equal one of, or ("has", parts), which it must contain one of; empty lists ask nothing."""
    out = F.lit(True)
    for column, (how, values) in columns.items():
        values = list(values)
        if values:
            out &= contains_any(column, values) if how == "has" else F.col(column).isin(values)
    return out


def prepare_selector(source: str, part: str | None = None, missions: Iterable[str] = (), flights: Iterable[str] = (), scans: Iterable[int] = (), aors: Iterable[str] = (), object_column: str = "object") -> Column:
    """Rows of the source, of objects whose name contains `part` (any case), and calibration; of the missions, flights (parts of mission names), scans and AORs asked for."""
    named = (F.col(object_column) == source) | F.col(object_column).isin(*CALIBRATION)
    if part:
        named |= F.contains(F.upper(object_column), F.lit(part.upper()))
    good = named & selected({"mission_id": ("is", missions), "scan": ("is", scans), "aor_id": ("has", aors)})
    return good & contains_any("mission_id", flights) if list(flights) else good


@dataclass(frozen=True)
class CorrectionRows:
    """Which rows a correction is for; empty parts ask nothing. faintest: least amplitude over the largest of all rows asked for."""

    part: str = ""
    missions: tuple[str, ...] = ()
    flights: tuple[str, ...] = ()
    scans: tuple[int, ...] = ()
    subscans: tuple[int, ...] = ()
    telescopes: tuple[str, ...] = ()
    aors: tuple[str, ...] = ()
    faintest: float = 1e-10


def correction_rows(rows: DataFrame, spec: CorrectionRows, spectrum: str = "spectrum", object_column: str = "object") -> DataFrame:
    """The rows to correct: those asked for whose largest channel exceeds the faintest share of the largest channel of all."""
    good = selected({"mission_id": ("is", spec.missions), "scan": ("is", spec.scans), "subscan": ("is", spec.subscans), "telescop": ("is", spec.telescopes), "aor_id": ("has", spec.aors)})
    if spec.flights:
        good &= contains_any("mission_id", spec.flights)
    if spec.part:
        good &= F.contains(F.upper(object_column), F.lit(spec.part.upper()))
    amplitude = F.array_max(F.transform(F.filter(spectrum, is_finite), lambda x: F.abs(x)))
    asked = rows.where(good).withColumn("_amplitude", amplitude)
    top = asked.agg(F.max("_amplitude")).scalar()
    return asked.where(F.col("_amplitude") > spec.faintest * top).drop("_amplitude")


def in_cycles(scans: Iterable[int] = (), subscans: Iterable[int] = (), cycles: Iterable[tuple[int, int]] = ()) -> Column:
    """Rows of the scans, of the subscans, and of the (scan, subscan) cycles; empty lists ask nothing."""
    good = selected({"scan": ("is", scans), "subscan": ("is", subscans)})
    pairs = list(cycles)
    return good & any_of((F.col("scan") == a) & (F.col("subscan") == b) for a, b in pairs) if pairs else good


def parse_cycle(text: str) -> tuple[int, int]:
    """(scan, subscan) of "scan:subscan"."""
    scan, sep, subscan = text.partition(":")
    if not sep or not scan.strip().isdigit() or not subscan.strip().isdigit():
        raise ValueError(f"not of the form scan:subscan: {text!r}")
    return int(scan), int(subscan)


@dataclass(frozen=True)
class FilterSpec:
    """What the master filter asks; every part is optional, and parts apply in the order of the fields."""

    keep_missions: tuple[str, ...] = ()
    keep_aors: tuple[str, ...] = ()
    remove: Mapping[str, tuple] = field(default_factory=dict)
    drop_flights: tuple[str, ...] = ()
    drop_obsmodes: tuple[str, ...] = ()
    keep_objects: tuple[str, ...] = ()
    drop_objects: tuple[str, ...] = ()
    cuts: tuple[tuple[str, str, float], ...] = ()
    peak: float | None = None
    tau_id: str | None = None
    nan_below: float | None = None
    nan_science_only: bool = False
    drop_zero: bool = False
    science: str = ""
    mission: str = "mission_id"
    aor: str = "aor_id"
    object: str = "object"
    obsmode: str = "obsmode"
    spectrum: str = "spectrum"
    row_id: str = "row_id"


#: Reasons whose rows are in neither output.
UNSEEN = ("mission_keep", "aor_keep", "object_exact")


def with_reject_reason(df: DataFrame, spec: FilterSpec) -> DataFrame:
    """Adds reject_reason: null for rows that pass, else the first filter that they fail.

    Value, peak and opacity filters apply to science rows (object contains spec.science, any case)
    only. An opacity row out of range rejects itself and the science rows linked to it.
    """
    cal = F.col(spec.object).isin(*CALIBRATION)
    science = ~cal & F.contains(F.upper(spec.object), F.lit(spec.science.upper()))
    reasons: list[tuple[str, Column]] = []
    if spec.keep_missions:
        reasons.append(("mission_keep", ~contains_any(spec.mission, spec.keep_missions)))
    if spec.keep_aors:
        reasons.append(("aor_keep", ~contains_any(spec.aor, spec.keep_aors)))
    for column, values in spec.remove.items():
        reasons.append(("removed", equals_any(column, values)))
    if spec.drop_flights:
        reasons.append(("flight", contains_any(spec.mission, spec.drop_flights)))
    if spec.drop_obsmodes:
        reasons.append(("obsmode", F.col(spec.obsmode).isin(*spec.drop_obsmodes) & ~cal))
    protected = F.col(spec.object).isin(*PROTECTED)
    if spec.keep_objects:
        reasons.append(("object_exact", ~F.col(spec.object).isin(*spec.keep_objects) & ~protected))
    if spec.drop_objects:
        reasons.append(("object_exact", F.col(spec.object).isin(*spec.drop_objects) & ~protected))
    for column, op, value in spec.cuts:
        reasons.append(("param", science & ~cut(column, op, value)))
    if spec.peak is not None:
        reasons.append(("peak", science & over_peak(spec.spectrum, spec.peak)))
    if spec.tau_id:
        bad = df.where((F.col(spec.object) == "TAU_SIG") & bad_tau(spec.spectrum)).select(F.col(spec.row_id).alias("_bad_tau"))
        df = df.join(bad, (F.col(spec.tau_id) == F.col("_bad_tau")) | F.lit(False), "left")
        reasons.append(("tau", science & F.col("_bad_tau").isNotNull()))
        reasons.append(("tau_cal", (F.col(spec.object) == "TAU_SIG") & bad_tau(spec.spectrum)))
    if spec.nan_below is not None:
        much = nan_fraction(spec.spectrum) >= spec.nan_below
        reasons.append(("nan", science & much if spec.nan_science_only else much))
    if spec.drop_zero:
        reasons.append(("zero", all_zero(spec.spectrum)))
    reason = F.lit(None).cast("string")
    for name, fails in reversed(reasons):
        reason = F.when(fails, name).otherwise(reason)
    return df.withColumn("reject_reason", reason).drop("_bad_tau")


def split(df: DataFrame, spec: FilterSpec) -> tuple[DataFrame, DataFrame]:
    """Clean and rejected rows; those of UNSEEN reasons are in neither."""
    marked = with_reject_reason(df, spec)
    return marked.where("reject_reason is null").drop("reject_reason"), marked.where(F.col("reject_reason").isNotNull() & ~F.col("reject_reason").isin(*UNSEEN))


def reason_counts(marked: DataFrame) -> DataFrame:
    return marked.groupBy(F.coalesce("reject_reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def remap_links(df: DataFrame, survivors: DataFrame, links: Iterable[str], row_id: str = "row_id") -> DataFrame:
    """Sets links to rows that are gone to null."""
    ids = survivors.select(F.col(row_id).alias("_id"))
    for link in links:
        there = ids.select(F.col("_id").alias("_there"))
        df = df.join(there, F.col(link) == F.col("_there"), "left").withColumn(link, F.col("_there")).drop("_there")
    return df


def with_referenced(science: DataFrame, everything: DataFrame, links: Iterable[str], row_id: str = "row_id") -> DataFrame:
    """Science rows and the rows that their links point at."""
    wanted = None
    for link in links:
        own = science.select(F.col(link).alias(row_id)).where(F.col(row_id).isNotNull())
        wanted = own if wanted is None else wanted.union(own)
    return science.unionByName(everything.join(wanted.distinct(), row_id, "left_semi").join(science.select(row_id), row_id, "left_anti"))
