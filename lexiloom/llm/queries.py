"""Queries op1 to op13 and the pipeline, with SQL where SQL can express them."""

from __future__ import annotations

from lexiloom.llm import alignment, bpe, chat, infill, minhash, neighbours, packing, pages, quality, recipes, slices, substrings, tokenfiles


def pipeline(spark, sf_dir: str):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_embedding_near_dedup": neighbours.op1,
    "op2_exact_top_k": slices.op2,
    "op3_chat_formatting": chat.op3,
    "op4_html_extraction": pages.op4,
    "op5_best_fit_packing": packing.op5,
    "op6_bpe": bpe.op6,
    "op7_token_files": tokenfiles.op7,
    "op8_substring_dedup": substrings.op8,
    "op9_minhash_near_dedup": minhash.op9,
    "op10_quality_classifier": quality.op10,
    "op11_exact_dedup": recipes.op11,
    "op12_tokenizer_alignment": alignment.op12,
    "op13_fill_in_middle": infill.op13,
    "pipeline": pipeline,
}

ORACLES = {
    "op1_embedding_near_dedup": neighbours.OP1_SQL,
    "op2_exact_top_k": slices.OP2_SQL,
    "op3_chat_formatting": chat.OP3_SQL,
    "op4_html_extraction": pages.OP4_SQL,
    "op8_substring_dedup": substrings.OP8_SQL,
    "op9_minhash_near_dedup": minhash.OP9_SQL,
    "op11_exact_dedup": recipes.OP11_SQL,
    "op13_fill_in_middle": infill.OP13_SQL,
}
