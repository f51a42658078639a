"""The queries of this subpackage by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from amplicore.llm.avi_mjpeg import op3_avi_mjpeg
from amplicore.llm.chat_windows import OP2_SQL, op2_chat_windows
from amplicore.llm.html_template import op4_html_template
from amplicore.llm.minhash_near import op7_minhash
from amplicore.llm.mixing import op5_mixing
from amplicore.llm.pivot_near import OP8_SQL, op8_pivot_near
from amplicore.llm.ppm_language import op1_language_id
from amplicore.llm.rff_quality import op10_quality
from amplicore.llm.sentencepiece_bpe import op9_sentencepiece
from amplicore.llm.zstd_toxicity import op6_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_chat_windows": op2_chat_windows,
    "op3_avi_mjpeg": op3_avi_mjpeg,
    "op4_html_template": op4_html_template,
    "op5_mixing": op5_mixing,
    "op6_toxicity": op6_toxicity,
    "op7_minhash": op7_minhash,
    "op8_pivot_near": op8_pivot_near,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_quality": op10_quality,
}
ORACLE_SQL: dict[str, str] = {"op2_chat_windows": OP2_SQL, "op8_pivot_near": OP8_SQL}
