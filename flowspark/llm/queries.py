"""The subpackage's queries and their SQL."""

from __future__ import annotations

from .chat import OP2_SQL, op2_chat
from .hmm import op3_hmm
from .linededup import OP1_SQL, op1_line_dedup
from .media import OP4_SQL, op4_media
from .merkle import OP13_SQL, op13_merkle
from .minhash import OP10_SQL, op10_minhash
from .mixing import OP9_SQL, op9_mixing
from .packing import op5_packing
from .periodic import op12_runs
from .quality import OP8_SQL, op8_quality
from .tokencount import op11_tokens
from .toxicity import op7_toxicity
from .warc import OP6_SQL, op6_warc

QUERIES = {
    "op4_media": op4_media,
    "op6_warc": op6_warc,
    "op3_hmm": op3_hmm,
    "op1_line_dedup": op1_line_dedup,
    "op10_minhash": op10_minhash,
    "op7_toxicity": op7_toxicity,
    "op5_packing": op5_packing,
    "op2_chat": op2_chat,
    "op8_quality": op8_quality,
    "op9_mixing": op9_mixing,
    "op11_tokens": op11_tokens,
    "op12_runs": op12_runs,
    "op13_merkle": op13_merkle,
}

ORACLES = {
    "op1_line_dedup": OP1_SQL,
    "op4_media": OP4_SQL,
    "op10_minhash": OP10_SQL,
    "op6_warc": OP6_SQL,
    "op2_chat": OP2_SQL,
    "op8_quality": OP8_SQL,
    "op9_mixing": OP9_SQL,
    "op13_merkle": OP13_SQL,
}
