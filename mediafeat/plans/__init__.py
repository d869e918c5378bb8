"""Composed plans and the registered query catalog.

fixtures            the fx_* inputs, built from the driver tables (+ DuckDB twins)
training_table      the flagship plan (entry of the driver contract)
conversion          shard conversion end to end
evaluation          train on record shards, evaluate on held-out shards
sequence_training   sequence features, per-epoch validation, early stopping
catalog / oracle    registered queries and their DuckDB twins
compare             exact rendering of arrays for value comparison
"""
