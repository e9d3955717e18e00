"""Registry of the operators: one thin query each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tierwise.llm import oracle
from tierwise.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = oracle.SQL

# Fixed value of the contract: the conversation that speaks the template's own marks.
CONTROL_TURNS = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op1_quality_rules")
def op1(spark, d):
    from tierwise.llm.quality_rules import apply_rules
    return apply_rules(table(spark, d, "documents"), with_text=False)


@register("op5_prefix_tokens")
def op5(spark, d):
    from tierwise.llm.prefix_tokens import count_tokens
    return count_tokens(table(spark, d, "documents"), tokenizer("word_bpe_49k.json"))


@register("op9_chat_format")
def op9(spark, d):
    from tierwise.llm.chat_format import format_turns, read_back
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame(CONTROL_TURNS, "conv_id bigint, turn bigint, role string, text string")
    return read_back(format_turns(turns.unionByName(control)))


@register("op10_decontaminate")
def op10(spark, d):
    from tierwise.llm.decontaminate import report
    return report(table(spark, d, "documents"), table(spark, d, "benchmark"))


@register("op6_sentencepiece")
def op6(spark, d):
    from tierwise.llm.pieces import encode_documents
    return encode_documents(table(spark, d, "documents"), tokenizer("piece_bpe_32k.model"))


@register("op8_simhash")
def op8(spark, d):
    from tierwise.llm import simhash
    rows = simhash.near_duplicates(table(spark, d, "documents"))
    return rows.select("doc_id", simhash.hex_of(rows["fp"]).alias("fingerprint"), "component_id")


@register("op7_quality_mil")
def op7(spark, d):
    from tierwise.llm.quality_mil import classify
    return classify(table(spark, d, "documents"), table(spark, d, "labels"))


@register("op3_pii")
def op3(spark, d):
    from tierwise.llm.pii import find
    return find(table(spark, d, "documents"))


@register("op2_substring_dedup")
def op2(spark, d):
    from tierwise.llm.substring_dedup import dedup
    return dedup(table(spark, d, "documents"), with_text=False)


@register("op4_ppm_score")
def op4(spark, d):
    from tierwise.llm.ppm import score_documents
    return score_documents(table(spark, d, "documents"))


@register("op11_periodic_runs")
def op11(spark, d):
    from tierwise.llm.periodic_runs import detect
    return detect(table(spark, d, "documents"), plant=True, with_text=False)


@register("op12_pair_counts")
def op12(spark, d):
    from tierwise.llm.pair_counts import align
    return align(table(spark, d, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"),
                 with_text=False)


@register("op13_sharding")
def op13(spark, d):
    from tierwise.llm.sharding import assign
    return assign(table(spark, d, "documents"))
