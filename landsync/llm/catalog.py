"""All queries of the subpackage, collected from the modules that register them."""

from landsync.llm.registry import ORACLES, QUERIES  # noqa: F401
from landsync.llm import bilinear, conversations, curriculum, decontaminate, extract, language, packing, quality, simhash, spelling, substring, toxicity, url_rules  # noqa: F401  (these register their queries)
