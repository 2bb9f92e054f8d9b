"""The queries of this package, with SQL where a result has an SQL form; the others are tested against brute force."""

from __future__ import annotations

from farespark.llm import lexical, warc
from farespark.llm.bpe import op2_bpe
from farespark.llm.language import op6_language
from farespark.llm.lattice import op3_lattice
from farespark.llm.lexical import op12_k2_treap
from farespark.llm.mixing import op7_mixing
from farespark.llm.passages import op5_suffix_array
from farespark.llm.sharding import op4_sharding
from farespark.llm.simhash import op9_simhash
from farespark.llm.spelling import op13_spelling
from farespark.llm.token_shards import op1_token_shards
from farespark.llm.toxicity import op8_toxicity
from farespark.llm.warc import op11_warc
from farespark.llm.winnowing import op10_winnowing

QUERIES = {
    f.__name__: f
    for f in (
        op1_token_shards,
        op2_bpe,
        op3_lattice,
        op4_sharding,
        op5_suffix_array,
        op6_language,
        op7_mixing,
        op8_toxicity,
        op9_simhash,
        op10_winnowing,
        op11_warc,
        op12_k2_treap,
        op13_spelling,
    )
}
SQL: dict[str, str] = {"op11_warc": warc.SQL, "op12_k2_treap": lexical.SQL}
