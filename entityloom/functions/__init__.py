from entityloom.functions.registry import PAIR_FUNCTIONS, canonical_name, register

__all__ = ["PAIR_FUNCTIONS", "canonical_name", "register"]
