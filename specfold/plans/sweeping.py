"""Queries of sweeps over the settings of a correction, with three cosines as components of each mission."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specfold.operators import sweeps
from specfold.plans.registry import query
from specfold.plans.shapes import _MODEL, _RATIO, OFF, _models
from specfold.plans.spectral import LINE, LONG, R6, r6, spectra

_COUNTS, _SHARES, _LEAST = (1, 2, 3), (0.0, 0.2, 0.4), (0.0, 0.05, 0.15)


def _swept(shares: Sequence[float]) -> str:
    """SQL of the corrections one by one: residuals of every channel, then noise outside the line and flux inside, by row."""
    lists = [f"(VALUES {', '.join(f'({v})' for v in values)})" for values in (_COUNTS, shares, _LEAST)]
    return f"""{LONG}, {_MODEL},
g AS (SELECT CAST(row_number() OVER (ORDER BY n, share, least) - 1 AS INTEGER) AS setting, n, CAST(share AS DOUBLE) AS share, CAST(least AS DOUBLE) AS least FROM {lists[0]} a(n), {lists[1]} b(share), {lists[2]} d(least)),
k AS (SELECT row_id, component, sum(x * p) AS k FROM c JOIN p USING (i) GROUP BY row_id, component),
u AS (SELECT row_id, setting, component, k FROM k, g WHERE component < n AND {list(_RATIO)}[component + 1] > share AND abs(k) >= least),
f AS (SELECT row_id, setting, i, sum(k * p) AS f FROM u JOIN p USING (component) GROUP BY row_id, setting, i),
n AS (SELECT row_id, setting, count(*) AS n FROM u GROUP BY row_id, setting),
y AS (SELECT c.row_id, mission, g.setting, c.i, x, x - coalesce(f.f, 0) AS y FROM c CROSS JOIN g LEFT JOIN f ON f.row_id = c.row_id AND f.setting = g.setting AND f.i = c.i),
e AS (SELECT row_id, mission, setting, stddev_pop(x) FILTER (WHERE {OFF}) AS a, stddev_pop(y) FILTER (WHERE {OFF}) AS b, sum(x) FILTER (WHERE NOT {OFF}) AS c, sum(y) FILTER (WHERE NOT {OFF}) AS d FROM y GROUP BY row_id, mission, setting),
t AS (SELECT CAST(mission AS VARCHAR) AS mission_id, 'PX' AS telescop, setting, count(*) AS n_rows, avg(a) AS noise_before, avg(b) AS noise, avg(c) AS flux_before, avg(d) AS flux, sum(coalesce(n.n, 0)) / count(*) AS n_used
      FROM e LEFT JOIN n USING (row_id, setting) GROUP BY mission, setting)"""


_ROUNDED = ("noise_before", "noise", "flux_before", "flux", "n_used")
_COLUMNS = "mission_id, telescop, setting, n_rows, " + ", ".join(f"{R6.format(c)} AS {c}" for c in _ROUNDED)


def _sweep(spark: SparkSession, sf_dir: str, shares: Sequence[float]) -> DataFrame:
    rows = spectra(spark, sf_dir).withColumns({"mission_id": F.col("mission").cast("string"), "telescop": F.lit("PX")})
    return sweeps.sweep(rows, _models(spark, sf_dir), sweeps.settings_of(_COUNTS, shares, _LEAST), LINE)


@query(f"WITH {_swept(_SHARES)} SELECT {_COLUMNS} FROM t")
def parameter_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """27 settings by numbers of components, shares of variance and least coefficients, in one pass over the rows."""
    return _sweep(spark, sf_dir, _SHARES).withColumns({c: r6(c) for c in _ROUNDED})


@query(f"WITH {_swept(_SHARES[:1])} SELECT {_COLUMNS} FROM t WHERE abs(flux) >= 0.5 * abs(flux_before) QUALIFY row_number() OVER (PARTITION BY mission_id ORDER BY noise, setting) = 1")
def best_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each mission's setting of least noise that keeps half of the line's flux."""
    return sweeps.best_settings(_sweep(spark, sf_dir, _SHARES[:1]), 0.5).withColumns({c: r6(c) for c in _ROUNDED})
