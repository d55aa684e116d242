"""The whole way from raw spectra to a cube, as stages on tables."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specfold.functions import arrays as A
from specfold.functions import kernels as K
from specfold.operators import axes, droprules, filters, grid, learned, links, quality
from specfold.operators import spectra as S


@dataclass(frozen=True)
class Plan:
    """Settings of all stages. Windows are channels [start, end) of the reduced axis."""

    filters: filters.FilterSpec = field(default_factory=filters.FilterSpec)
    reduction: S.Reduction = field(default_factory=S.Reduction)
    window: tuple[int, int] = (0, 0)
    n_components: int = 5
    gates: K.Gates = field(default_factory=K.Gates)
    reference: str = "SKYCHOPDIFF"
    detect: bool = True
    kernel: float = 0.004
    pixel: float = 0.002
    cuts: tuple[tuple[str, str, float], ...] = ()
    correct: filters.CorrectionRows | None = None
    telluric: DataFrame | None = None


def prepare(rows: DataFrame, science: str, rules: DataFrame | None = None, selector: Column | None = None, cuts: Iterable[tuple[str, str, float]] = (), telluric: DataFrame | None = None, baseline: int | None = None, window: tuple[int, int] | None = None, seed: int = 42) -> DataFrame:
    """Science, reference and calibration rows, with links to calibration.

    In this order: the selector (by default the science object, in any case, and the protected classes), the rules that
    drop rows, the value cuts, which calibration passes, telluric channels replaced by noise around 0, and clipped baselines of all rows but calibration.
    """
    keep = rows.where(F.contains(F.upper("object"), F.lit(science.upper())) | F.col("object").isin(*filters.PROTECTED) if selector is None else selector)
    if rules is not None:
        keep = droprules.apply_rules(keep, rules)
    keep = filters.prepare_cuts(keep, cuts)
    if telluric is not None:
        keep = S.noise_filled(keep, telluric, seed, False, window=window)
    if baseline is not None:
        keep = S.baselined(keep, baseline, window, object_column="object")
    targets = keep.where(~F.col("object").isin(*filters.CALIBRATION))
    calibration = keep.where(F.col("object").isin(*filters.CALIBRATION))
    for kind, name in (("TSYS", "tsys_id"), ("TAU_SIG", "tau_id")):
        targets = links.link_calibration(targets.drop(name), calibration.where(F.col("object") == kind), name=name)
    return targets.unionByName(calibration, allowMissingColumns=True)


def post_process(rows: DataFrame, window: tuple[int, int], whiteness_width: int = 4, sigmas: float = 3.0, most_order: int = 3, folder: str | None = None, telluric: DataFrame | None = None, seed: int = 42) -> DataFrame:
    """Baseline of automatic order, ripple, line-free noise and its ratio to the theoretical one, and whiteness flags.

    rows: rms_theoretical, or the columns that it follows from (tsys, on and off times, opacity, elevation, deltav, restfreq).
    With telluric (mission_id, telluric_line_center, telluric_line_width) those channels are replaced at last by noise as it is after the correction.
    The flags read the scored rows three times: with a folder these are written there first.
    """
    import numpy as np

    n = rows.agg(F.max(F.size("spectrum")).alias("n")).first()
    free = np.array([i < window[0] or i >= window[1] for i in range(n["n"] or 0)])
    if "rms_theoretical" not in rows.columns:
        rows = rows.withColumn("rms_theoretical", quality.theoretical_rms(*map(F.col, ("tsys", "spectime", "reftime", "tau_atm", "elevatio", "deltav", "restfreq"))))
    out = S.auto_baselined(rows, "rms_theoretical", window, most=most_order)
    out = S.map_arrays(out, "spectrum", lambda y: K.ripple_ratio(y, free), {"ripple": "double"})
    out = out.withColumn("rms_baseline", A.std(S.outside("spectrum", window))).withColumn("rmsratiob", F.col("rms_baseline") / F.col("rms_theoretical"))
    if telluric is not None:
        out = S.noise_filled(out, telluric, seed, False, window=window)
    if folder:
        out.write.mode("overwrite").parquet(f"{folder}/scored")
        out = rows.sparkSession.read.parquet(f"{folder}/scored")
    return S.whiteness_flags(out, whiteness_width, sigmas, free)


def run(raw: DataFrame, plan: Plan, science: str, folder: str, rules: DataFrame | None = None) -> dict[str, DataFrame]:
    """Filter, reduce, prepare, decompose, correct and grid; the table of each stage."""
    spark = raw.sparkSession
    clean, rejected = filters.split(raw, plan.filters)
    reduced = S.reduce_spectra(clean, plan.reduction)
    prepared = prepare(reduced, science, rules, cuts=plan.cuts, telluric=plan.telluric)
    prepared.write.mode("overwrite").parquet(f"{folder}/prepared")
    prepared = spark.read.parquet(f"{folder}/prepared")
    models = learned.fit_models(prepared.where(F.col("object") == plan.reference), plan.n_components, core=plan.window)
    models.write.mode("overwrite").parquet(f"{folder}/models")
    models = spark.read.parquet(f"{folder}/models")
    targets = prepared.where(F.contains(F.upper("object"), F.lit(science.upper())))
    if plan.correct is not None:
        targets = filters.correction_rows(targets, plan.correct)
    if plan.telluric is not None:
        targets = axes.with_telluric_mask(targets, plan.telluric)
    corrected = learned.correct_with_lines(targets, models, plan.window, folder, plan.gates, detect=plan.detect)
    corrected.write.mode("overwrite").parquet(f"{folder}/corrected")
    corrected = spark.read.parquet(f"{folder}/corrected")
    cube = grid.grid_cube(corrected, grid.frame_of(corrected, plan.pixel), plan.kernel)
    return {"clean": clean, "rejected": rejected, "prepared": prepared, "models": models, "corrected": corrected, "cube": cube}
