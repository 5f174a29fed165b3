"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from dirspark.llm import alignment, audio, bpe, mixing, neardup, phrases, quality, suffixes, tokencounts, tokenfiles, toolcalls, toxicity, warc


def queries() -> dict[str, Callable]:
    return {
        "op1_mix": mixing.op1_mix,
        "op2_suffixes": suffixes.op2_suffixes,
        "op3_token_files": tokenfiles.op3_token_files,
        "op4_bpe": bpe.op4_bpe,
        "op5_neardup": neardup.op5_neardup,
        "op6_token_counts": tokencounts.op6_token_counts,
        "op7_warc": warc.op7_warc,
        "op8_quality": quality.op8_quality,
        "op9_tool_calls": toolcalls.op9_tool_calls,
        "op10_audio": audio.op10_audio,
        "op11_toxicity": toxicity.op11_toxicity,
        "op12_alignment": alignment.op12_alignment,
        "op13_phrases": phrases.op13_phrases,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_mix": mixing.ORACLE,
        "op7_warc": warc.ORACLE,
        "op8_quality": quality.ORACLE,
        "op9_tool_calls": toolcalls.ORACLE,
        "op13_phrases": phrases.ORACLE,
    }
