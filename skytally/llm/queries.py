"""All registered queries of this package."""

from skytally.llm import (  # noqa: F401
    jaccard, merkle, nbest, packing, periodic, pii, quality, secrets, sharding, token_files, urls,
    whitening, windows,
)
from skytally.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
