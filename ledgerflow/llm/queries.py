"""The registered queries of this package, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.llm import bpe, chat, colloc, decontam, hpylm, langid, licenses, lzprint, mainhtml, merkle, minhash, tokencount, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_hpylm": hpylm.documents,
    "op2_text_density": mainhtml.pages,
    "op3_lempel_ziv": lzprint.documents,
    "op4_greedy_string_tiling": decontam.documents,
    "op5_reply_trees": chat.conversations,
    "op6_fast_similarity_sketch": minhash.documents,
    "op7_trie_token_counts": tokencount.documents,
    "op8_license_diagonals": licenses.documents,
    "op9_language_ecoc": langid.languages,
    "op10_byte_bpe": bpe.digests,
    "op11_merkle_butterfly": merkle.documents,
    "op12_warc_transactions": warc.pages,
    "op13_stripe_collocations": colloc.documents,
}

ORACLES: dict[str, str] = {
    "op5_reply_trees": chat.SQL,
    "op6_fast_similarity_sketch": minhash.SQL,
    "op11_merkle_butterfly": merkle.SQL,
    "op12_warc_transactions": warc.SQL,
    "op13_stripe_collocations": colloc.SQL,
}
