"""Column expressions (Catalyst built-ins; Arrow UDFs only for byte decoding).

labels      positional and vocabulary multi-hot vectors
vectors     arg-max, dims, fusion, flattening, dot products, uint8 decoding
geo         haversine distance
text        whitespace tokens, query terms, percent-quoting, base names, run labels
"""
