"""The registry of this subpackage's queries, their SQL where SQL can express them, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe import op7_bpe
from .fingerprints import op4_fingerprints
from .licenses import op5_licenses
from .linededup import OP10_SQL, op10_lines
from .media import op1_media
from .packing import op9_packing
from .quality import op3_quality
from .simhash import op8_simhash
from .suffixes import op6_repeats
from .tokenfiles import op2_tokens


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_media": op1_media, "op2_tokens": op2_tokens, "op3_quality": op3_quality, "op4_fingerprints": op4_fingerprints, "op5_licenses": op5_licenses, "op6_repeats": op6_repeats, "op7_bpe": op7_bpe, "op8_simhash": op8_simhash, "op9_packing": op9_packing, "op10_lines": op10_lines}


def oracle_sql() -> dict[str, str]:
    return {"op10_lines": OP10_SQL}
