"""The registered queries of this subpackage."""

from __future__ import annotations

from .bpe import op12_bpe
from .chat import chat_turn_order, op10_chat
from .decontam import op5_decontaminate
from .lexical import op11_lexical_search
from .license_scan import op1_license_scan
from .linededup import op6_line_dedup
from .merkle import op13_merkle
from .mixing import op2_mix
from .quality import op4_quality
from .secrets import op8_secrets
from .simhash import op9_simhash
from .topk import op7_topk
from .warc import op3_warc


def pipeline(spark, sf_dir: str):
    """All stages of ``corpus_pipeline`` over ``documents``."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_license_scan, op2_mix, op3_warc, op4_quality, op5_decontaminate, op6_line_dedup, op7_topk,
                                   op8_secrets, op9_simhash, op10_chat, chat_turn_order, op11_lexical_search, op12_bpe,
                                   op13_merkle, pipeline)}
