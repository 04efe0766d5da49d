"""Spark-native analytics over the outputs of agent-based mobility simulations.

All scenario runs ("cases") live in one set of DataFrames keyed by ``folder``.
Ids are unique only within a case, so every join key includes ``folder``.
"""
