"""Sources and sinks.

records     record files (Example / SequenceExample): whole-shard and splittable
            readers, streaming reader, retry-safe writer with per-shard directories
crc32c      vectorised CRC-32C for record framing
tables      multi-path scans, quarantine, shard naming, CSV/JSON sinks, text tokens
"""
