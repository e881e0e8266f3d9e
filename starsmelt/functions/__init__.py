"""Column expressions."""

from starsmelt.functions.columns import null_token_to_null, stable_round

__all__ = ["null_token_to_null", "stable_round"]
