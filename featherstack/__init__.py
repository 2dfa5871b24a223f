"""featherstack: entity-level feature engineering, preparation, cross-validated
prediction and stacking as Spark DataFrame plans."""

__version__ = "0.1.0"
