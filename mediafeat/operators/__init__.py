"""DataFrame -> DataFrame operators.

labels      label histogram, vocabulary fit, multi-hot encoders, slot join, coverage
sequences   steps per video, first-T assembly, length policies, pooling
assemble    frame/video joins, anti-join report, integrity counts, pairs
split       seeded shuffle, exact hold-out split, limits, chunks, set checks
ordering    skew-safe exact row numbers and running statistics
geo         grid radius join (+ adaptive exact hierarchy), search pages, keyed lookup
metrics     accuracy, cross-entropy, speed-up/efficiency, early stopping
train       standardisation, data-parallel fit with averaging, scoring, model table, MLP
parallel    keep CPU-heavy narrow stages wide; size-conditional reuse checkpoint
"""
