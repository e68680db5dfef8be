"""Operations of a training-data pipeline: scoring, near-duplicates, packing, archives, sharding.

Nothing outside this subpackage imports it; ``queries`` holds what the driver registers.
"""
