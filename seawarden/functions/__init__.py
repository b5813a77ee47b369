"""Expressions from rule data.

Rules are given as SQL expression text and come back as text, to be nested further or handed to
``F.expr``. Spark parses each once; building the same tree call by call from Python costs a round
trip to the JVM per node, which for a plan of this size is seconds.
"""
