"""rillmark: change-data, data-quality, metric and alert analytics on Spark DataFrames."""

from rillmark.spec import CheckSpec, ForeignKey, RuleSpec, TableSpec

__all__ = ["CheckSpec", "ForeignKey", "RuleSpec", "TableSpec"]
