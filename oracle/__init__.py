"""The same results as plain SQL over the benchmark tables, for checking.

Tables are derived from the base tables directly and not by way of JSON, and with
the joins and windows that the Spark plans leave out, so agreement also checks the
document round trip and the simplified plans.
"""
