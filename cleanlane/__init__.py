"""cleanlane — Spark-native tabular preparation and binary-classification toolkit.

Every operator follows one convention:

* ``fit_<op>(df, ...)`` runs at most one aggregate job (a couple for exact
  quantiles) and returns a small parameter record;
* ``apply_<op>(df, params)`` is pure ``Column`` work, so Catalyst sees one
  logical plan for a whole chain and no row-level Python runs;
* ``<op>(df, ...)`` does both.

Sub-packages: ``sources`` (readers/writers), ``functions`` (column
expressions), ``operators`` (profiling, cleaning, screening, features,
modelling, evaluation, reports), ``plans`` (multi-step pipelines, presets and
the driver query catalogue) and ``streaming`` (fitted transforms on streams).
"""

__version__ = "0.1.0"
