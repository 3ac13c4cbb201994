"""panelforge: a PySpark-native engine for entity-period panels.

Turns per-period fact tables into a joined panel, adds targets, lags,
rolling / trend / consistency / availability and domain features with shared
window and column expressions, profiles and prepares the features without
leakage, evaluates baselines, fits Spark ML regressors per target and
combines them into ensembles and ranked projections.
"""

from .spec import DEFAULT_SPEC, PanelSpec  # noqa: F401

__version__ = "0.1.0"
