"""Contact-centre analytics as Spark DataFrame jobs.

Layers, in the order data flows through them: ``sources`` and ``streaming``
bring raw records in, ``operators`` hold the reusable table transformations,
``functions`` the column expressions, and ``plans`` wires both into the
staging, mart, daily and scorecard tables and keeps them up to date.
"""
