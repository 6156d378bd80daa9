"""The queries of the package on the driver's tables, and their oracle SQL where SQL can express them."""

from __future__ import annotations

from tessera.llm.chat import op7_chat
from tessera.llm.cluster import OP11_SQL, op11_shallot
from tessera.llm.decontam import OP8_SQL, op8_decontam
from tessera.llm.dedup import op2_icws
from tessera.llm.langid import op5_langid
from tessera.llm.packing import op6_packing
from tessera.llm.phrases import OP13_SQL, op13_phrases
from tessera.llm.pii import op9_pii
from tessera.llm.quality import op10_quality
from tessera.llm.repeats import OP12_SQL, op12_repeats
from tessera.llm.tokenfile import op4_tokenfile
from tessera.llm.topk import OP3_SQL, op3_pivots
from tessera.llm.toxicity import op1_toxicity

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_icws": op2_icws,
    "op3_pivots": op3_pivots,
    "op4_tokenfile": op4_tokenfile,
    "op5_langid": op5_langid,
    "op6_packing": op6_packing,
    "op7_chat": op7_chat,
    "op8_decontam": op8_decontam,
    "op9_pii": op9_pii,
    "op10_quality": op10_quality,
    "op11_shallot": op11_shallot,
    "op12_repeats": op12_repeats,
    "op13_phrases": op13_phrases,
}
ORACLES: dict[str, str] = {
    "op3_pivots": OP3_SQL,
    "op8_decontam": OP8_SQL,
    "op11_shallot": OP11_SQL,
    "op12_repeats": OP12_SQL,
    "op13_phrases": OP13_SQL,
}
