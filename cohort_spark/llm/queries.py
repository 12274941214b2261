"""Registry of the training-data operators: name -> query, and SQL twins."""
from __future__ import annotations

from .bitpack import op6_bitpack
from .chatformat import OP13_SQL, op13_chatformat
from .decontaminate import op3_decontaminate
from .htmltext import op8_htmltext
from .jaccard import op9_jaccard
from .langid import op7_langid
from .linededup import OP5_SQL, op5_linededup
from .merkle import OP12_SQL, op12_merkle
from .packing import op4_packing
from .rabitq import op2_rabitq
from .toxicity import op1_toxicity
from .warc import OP10_SQL, op10_warc
from .whitening import op11_whitening

QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_rabitq, op3_decontaminate, op4_packing, op5_linededup, op6_bitpack, op7_langid, op8_htmltext,
    op9_jaccard, op10_warc, op11_whitening, op12_merkle, op13_chatformat)}
SQL = {"op5_linededup": OP5_SQL, "op10_warc": OP10_SQL, "op12_merkle": OP12_SQL, "op13_chatformat": OP13_SQL}
